"""A Merkle manifest of a table: ranks from bitmaps of ids place the leaves, arrays keyed by slot reduce the levels."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, dealt_anew

#: So many consecutive nodes are one run, which a node of the next level hashes. A pass reduces two levels at once.
ARITY, PASS = 16, 256
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A directory row counts what lies below so many bits of word numbers.
_RADIX = 16
_STEPS = "array<struct<left: string, right: string>>"


def leaf(*fields: Column) -> Column:
    """SHA-256 of the fields, each as its UTF-8 byte count, a colon and its value, or - if null. Numbers are decimal."""
    value = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[value(c.cast("string")) for c in fields]), 256)


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf gives with its path."""
    return F.aggregate(path, digest, lambda at, p: F.sha2(F.concat(p["left"], at, p["right"]), 256))


def siblings_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def _located(leaves: DataFrame) -> DataFrame:
    """Add an id's place in the bitmap of its group: the number of a word of 64 ids, and a bit of it. Null ids are a word before all."""
    at = F.col("doc_id").bitwiseXOR(F.lit(-(1 << 63)))
    return leaves.withColumns({"word": F.coalesce(F.shiftrightunsigned(at, 6), F.lit(-1)), "bit": F.coalesce(at.bitwiseAND(F.lit(63)), F.lit(0)).cast("int")})


def bitmaps(located: DataFrame) -> DataFrame:
    """(g, word, mask, n, before): the bitmap of each group's ids with a directory: n leaves in a word, `before` in all words before it.

    Only words with an id are stored. Masks merge by OR and counts by sums, both combined before the shuffle. The
    directory has levels of 16 bits of a word's number, so that no window holds more than 65,536 rows.
    """
    mask = F.expr("bit_or(shiftleft(1L, bit))").alias("mask")
    words = checkpointed(located.groupBy("g", "word").agg(mask, F.count(F.lit(1)).alias("n")))
    levels = [words.select("g", "word", "n")]
    while len(levels) < 4:
        levels.append(levels[-1].groupBy("g", F.shiftright("word", _RADIX).alias("word")).agg(F.sum("n").alias("n")))

    def counted(level: DataFrame, last: bool) -> DataFrame:
        above = Window.partitionBy("g") if last else Window.partitionBy("g", F.shiftright("word", _RADIX))
        before = F.sum("n").over(above.orderBy("word").rowsBetween(Window.unboundedPreceding, -1))
        return level.withColumn("before", F.coalesce(before, F.lit(0)))

    upper = counted(levels[3], True)
    for level in (levels[2], levels[1], words):
        here = counted(level, False).withColumn("up", F.shiftright("word", _RADIX))
        above = upper.select("g", F.col("word").alias("up"), F.col("before").alias("rest"))
        upper = here.join(above, ["g", "up"]).withColumn("before", F.col("before") + F.col("rest")).drop("up", "rest")
    return upper


def ranked(leaves: DataFrame) -> DataFrame:
    """leaves(g, doc_id, leaf, carried) with `at`: how many leaves of the group come before, by id; null ids come first.

    A rank is the directory's count and the bits of lower ids in the word; documents aren't sorted. Leaves of one id are in the order
    of their digests; identical rows are a leaf each. These are placed by counts of digest beginnings, so that an id of very many
    rows is no single task's.
    """
    located = _located(leaves)
    index = checkpointed(bitmaps(located))
    lower = F.bit_count(F.col("mask").bitwiseAND(F.expr("~shiftleft(-1L, bit)")))
    met = located.join(dealt_anew(index, "word").hint("shuffle_hash"), ["g", "word"])
    columns = [*leaves.columns, "at"]
    crowded = index.where(F.col("n") > F.bit_count("mask")).select("g", "word")
    if crowded.isEmpty():
        return met.withColumn("at", F.col("before") + lower).select(*columns)
    there = located.join(crowded, ["g", "word"], "left_semi")
    several = checkpointed(there.groupBy("g", "word", "bit").agg((F.count(F.lit(1)) - 1).alias("more")).where("more > 0"))
    more = several.groupBy("g", "word").agg(F.collect_list(F.struct("bit", "more")).alias("extra"))  # 64 at most
    passed = F.aggregate(F.coalesce("extra", F.array().cast("array<struct<bit: int, more: bigint>>")), F.lit(0).cast("long"), lambda n, x: n + F.when(x["bit"] < F.col("bit"), x["more"]).otherwise(F.lit(0)))
    placed = met.join(more, ["g", "word"], "left").withColumn("at", F.col("before") + lower + passed)
    alone = placed.join(several.select("g", "word", "bit"), ["g", "word", "bit"], "left_anti").select(*columns)
    key = ["g", "word", "bit"]
    tied = placed.join(several.select(*key), key, "left_semi").groupBy(*key, "at", *leaves.columns[1:]).agg(F.count(F.lit(1)).alias("copies"))
    tied = checkpointed(tied.withColumn("beginning", F.substring("leaf", 1, 3)))
    sums = tied.groupBy(*key, "beginning").agg(F.sum("copies").alias("copies"))
    before = F.coalesce(F.sum("copies").over(Window.partitionBy(*key).orderBy("beginning").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = F.coalesce(F.sum("copies").over(Window.partitionBy(*key, "beginning").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spread = tied.withColumn("own", own).join(sums.select(*key, "beginning", before.alias("rest")), [*key, "beginning"])
    spread = spread.withColumn("at", F.explode(F.expr("sequence(at + own + rest, at + own + rest + copies - 1)")))
    return alone.unionByName(spread.select(*columns))


def _passed(nodes: DataFrame, *carried: str) -> DataFrame:
    """One pass over nodes(g, at, digest, n): (g, at, n, total, items, slots, runs, digest) of each PASS consecutive ones.

    slots are the digests in their places, by a map from slot to digest; runs are the digests one level up. digest is the
    node two levels up, or the only run, or the only node, where its group has no more. n nodes of `total` are left.
    """
    item = F.struct(F.col("at").bitwiseAND(F.lit(PASS - 1)).cast("int").alias("slot"), "digest", *carried)
    grouped = nodes.groupBy("g", F.shiftright("at", 8).alias("at"), F.col("n").alias("total")).agg(F.collect_list(item).alias("items"))
    keyed = grouped.withColumn("of", F.map_from_entries(F.transform("items", lambda x: F.struct(x["slot"], x["digest"]))))
    slots = keyed.withColumn("slots", F.expr("transform(sequence(0, size(items) - 1), k -> of[k])")).drop("of")
    run = f"sha2(array_join(slice(slots, {ARITY} * r + 1, {ARITY}), ''), 256)"
    runs = slots.withColumn("runs", F.expr(f"transform(sequence(0, cast((size(slots) - 1) div {ARITY} AS int)), r -> {run})"))
    digest = F.when(F.col("total") > ARITY, F.sha2(F.array_join("runs", ""), 256)).when(F.col("total") > 1, F.col("runs")[0]).otherwise(F.col("slots")[0])
    return runs.withColumns({"digest": digest, "n": F.shiftright(F.col("total") + (PASS - 1), 8)})


def _steps(slot: Column, slots: Column, runs: Column, total: Column) -> Column:
    """The path of a slot through its pass, where its group has `total` nodes before."""

    def own(array: Column, k: Column) -> Column:
        left = F.slice(array, F.lit(1) + k - k % ARITY, k % ARITY)
        return F.struct(F.array_join(left, "").alias("left"), F.array_join(F.slice(array, k + 2, F.lit(ARITY - 1) - k % ARITY), "").alias("right"))

    one = own(slots, slot)
    # The runs of a pass are one run of the next level.
    return F.when(total > ARITY, F.array(one, own(runs, F.shiftright(slot, 4)))).when(total > 1, F.array(one)).otherwise(F.array().cast(_STEPS))


def tree(nodes: DataFrame, *carried: str) -> tuple[DataFrame, DataFrame]:
    """Reduce nodes(g, at, digest, n, carried), n in a group, at 0 to n - 1: (g, root) of each group, and its runs for paths_of().

    Each pass shuffles the nodes that are left, and leaves a 256th of them. Runs have the path from their node to the root.
    """
    most = nodes.agg(F.max("n")).first()[0] or 1
    passes = [checkpointed(_passed(nodes, *carried))]
    while (most := -(-most // PASS)) > 1:
        passes.append(checkpointed(_passed(passes[-1].select("g", "at", "digest", "n"))))
    here = passes[-1].withColumn("path", F.array().cast(_STEPS))
    for below in reversed(passes[:-1]):
        above = here.select("g", F.col("at").alias("up"), *[F.col(c).alias(f"_{c}") for c in ("slots", "runs", "total", "path")])
        steps = _steps(F.col("at").bitwiseAND(F.lit(PASS - 1)).cast("int"), F.col("_slots"), F.col("_runs"), F.col("_total"))
        joined = below.withColumn("up", F.shiftright("at", 8)).join(above, ["g", "up"])
        here = joined.withColumn("path", F.concat(steps, "_path")).drop("up", "_slots", "_runs", "_total", "_path")
    return passes[-1].select("g", F.col("digest").alias("root")), here


def paths_of(runs: DataFrame) -> DataFrame:
    """(digest, carried, path) of each node of tree()'s runs: the siblings left and right of it at each level, from its own up."""
    each = runs.select(F.explode("items").alias("item"), *[c for c in runs.columns if c != "items"])
    path = F.concat(_steps(F.col("item.slot"), F.col("slots"), F.col("runs"), F.col("total")), "path")
    return each.select("item.*", path.alias("path"), *[c for c in runs.columns if c not in ("g", "at", "n", "total", "items", "slots", "runs", "digest", "path")]).drop("slot")


def numbered(groups: DataFrame) -> DataFrame:
    """groups(g, n) with `at`, the number of groups before in the order of their names: counts of sorted parts, one for each, come to the driver."""
    dealt = checkpointed(groups.orderBy("g").withColumn("part", F.spark_partition_id()))
    sizes = dict(dealt.groupBy("part").count().collect())
    before = list(accumulate((sizes.get(p, 0) for p in range(max(sizes, default=0))), initial=0))
    place = F.row_number().over(Window.partitionBy("part").orderBy("g")) - 1
    return dealt.withColumn("at", (F.element_at(F.array(*map(F.lit, before)), F.col("part") + 1) + place).cast("long")).drop("part")


def with_sizes(nodes: DataFrame, sizes: DataFrame) -> DataFrame:
    """nodes with n of sizes(g, n). Groups are named anew after the join, so that the nodes of one aren't left in the task of its join."""
    return dealt_anew(nodes.join(dealt_anew(sizes, "g").select("g", "n"), "g"), "g")


def manifest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", fields: tuple[str, ...] = FIELDS, altered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, altered) of every row; `altered` is another leaf for it, null unless given.

    A row is a leaf of its source. Leaves of a source ascend by id, null ids first, rows of one id by their digests; rows that are alike are
    a leaf each. Runs of 16 nodes are hashed until one is left, the subroot; subroots in the order of their sources, null
    first, are reduced alike to the root. path holds the siblings at each level up to the root. A field that is null counts as -, a
    text of any length is hashed whole, other columns are ignored, an empty table gives no rows.
    """
    # Names of sources in order: null first.
    group = F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit(""))
    carried = F.lit(None).cast("string") if altered is None else altered
    leaves = checkpointed(docs.select(group.alias("g"), F.col(id_col).cast("long").alias("doc_id"), leaf(*map(F.col, fields)).alias("leaf"), carried.alias("altered")))
    sizes = numbered(leaves.groupBy("g").agg(F.count(F.lit(1)).alias("n")))
    nodes = with_sizes(ranked(leaves).withColumnRenamed("leaf", "digest"), sizes)
    subroots, runs = tree(nodes, "doc_id", "altered")
    n_sources = sizes.count()
    tops = subroots.join(sizes.select("g", "at"), "g").select(F.lit("").alias("g"), "at", F.col("root").alias("digest"), F.lit(n_sources).cast("long").alias("n"), F.col("g").alias("source"))
    whole, upper = tree(tops, "source")
    root = whole.first()
    above = checkpointed(paths_of(upper)).select(F.col("source").alias("g"), F.col("digest").alias("subroot"), F.col("path").alias("rest"))
    found = paths_of(runs.join(dealt_anew(above, "g"), "g"))
    return found.select("doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(root and root["root"]).cast("string").alias("root"), F.concat("path", "rest").alias("path"), "altered")
