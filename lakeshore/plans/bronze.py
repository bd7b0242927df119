"""Raw layer: ERP rows stamped with their load day, both channels as one table, order lines rolled up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stamp_load(df: DataFrame, *times: str) -> DataFrame:
    """Add report_date and report_month of the first time that isn't null, and _loaded_at unless the frame has it."""
    at = F.coalesce(*map(F.col, times))
    out = df.withColumn("report_date", F.date_format(at, "yyyyMMdd")).withColumn("report_month", F.date_format(at, "yyyyMM"))
    return out if "_loaded_at" in df.columns else out.withColumn("_loaded_at", F.current_timestamp())


def unify_transactions(pos: DataFrame, online: DataFrame) -> DataFrame:
    """Order headers of both channels; columns that a channel lacks are null."""
    both = pos.withColumn("channel", F.lit("offline")).unionByName(online.withColumn("channel", F.lit("online")), allowMissingColumns=True)
    return stamp_load(both, "updated_at", "created_at")


def rollup_details(pos: DataFrame, online: DataFrame) -> DataFrame:
    """One row for each order, channel and branch (null online): line and unit counts, with and without promotion, and the lines.

    created_at is the earliest of its lines. trans_metadata holds the lines as structs in the order of their ids.
    """
    both = pos.withColumn("channel", F.lit("offline")).unionByName(online.withColumn("channel", F.lit("online")), allowMissingColumns=True)
    units = lambda promo: F.sum(F.when(F.col("is_promo") == promo, F.col("trans_qty")).otherwise(0)).cast("long")
    # The lines are at hand in any case: distinct ones are counted in their array, and no line is expanded for each count.
    lines = lambda promo: F.size(F.array_distinct(F.filter(F.transform(F.filter("trans_metadata", lambda x: x.is_promo == promo), lambda x: x.transaction_detail_id), lambda x: x.isNotNull()))).cast("long")
    line = F.struct(
        "transaction_detail_id", "product_id", "is_promo", "product_uom_code", "trans_qty", "trans_line_amount",
        F.coalesce("variant_size", F.lit("")).alias("variant_size"), F.coalesce("variant_color", F.lit("")).alias("variant_color"),
    )
    rolled = both.groupBy("transaction_id", "channel", "branch_id").agg(
        F.coalesce(units(0), F.lit(0)).alias("order_total_sku"),
        F.coalesce(units(1), F.lit(0)).alias("promo_total_sku"),
        F.max("is_promo").alias("is_promo"),
        F.min("created_at").alias("created_at"),
        F.sort_array(F.collect_list(line)).alias("trans_metadata"),
    )
    return rolled.select(
        "transaction_id", "channel", "branch_id", lines(0).alias("order_total_line"), "order_total_sku", lines(1).alias("promo_total_line"), "promo_total_sku",
        "is_promo", "created_at", "trans_metadata", F.date_format("created_at", "yyyyMMdd").alias("report_date"),
    )
