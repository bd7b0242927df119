"""Benchmark decontamination: rare n-gram seeds join passages to test items, Smith-Waterman alignment scores them."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, slices

#: Three words, so that a copy in which every fourth word is another still has seeds.
SEED_WORDS = 3
#: A seed is rare if at most this share of all documents has it, or at most RELATIVE times (1 + the median of its item's seeds).
RARE_SHARE, RELATIVE = 0.05, 3
#: A document is contaminated by an item from this share of the score of a full copy.
LEAST_SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
#: Bits of the set that tells which n-grams of a document can be seeds; a larger benchmark fills it more, but never makes it larger.
BITS = 1 << 24
_words = re.compile(r"\w+").findall


class Grams:
    """Hashes of the n-grams of a row of words; the hashes of words are remembered, MOST_WORDS at most."""

    MOST_WORDS = 300_000

    def __init__(self):
        self.known: dict[str, int] = {}

    def words(self, words: list[str]) -> np.ndarray:
        if len(self.known) > self.MOST_WORDS:
            self.known = {}
        known = self.known
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    @staticmethod
    def of(words: np.ndarray, size: int) -> np.ndarray:
        out = np.full(max(0, len(words) - size + 1), size, np.uint64)
        for k in range(size):
            out = (out ^ words[k : k + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out


def seeds(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", n: int = SEED_WORDS) -> DataFrame:
    """(key, item_id, item, n_words, size, hs) of each distinct item with words: its n-grams' hashes by place.

    An item of fewer words is one seed of its own length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for b in slices(batches, "item"):
            texts = [_words(x.lower()) for x in b["item"].to_pylist()]
            sizes = [min(n, len(w)) for w in texts]
            hs = [grams.of(grams.words(w), k).view(np.int64) for w, k in zip(texts, sizes)]
            yield pa.record_batch({"key": b["key"], "item_id": b["item_id"], "item": b["item"], "n_words": pa.array([len(w) for w in texts], pa.int32()), "size": pa.array(sizes, pa.int32()), "hs": pa.array(hs, pa.list_(pa.int64()))})

    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("item")).where("item_id is not null and item is not null").distinct()
    cut = items.select(F.xxhash64("item_id", "item").alias("key"), "item_id", "item").mapInArrow(run, "key long, item_id long, item string, n_words int, size int, hs array<long>")
    return cut.where("n_words > 0")


def bit_set(hashes: DataFrame, bits: int = BITS) -> np.ndarray:
    """The set of the column h modulo `bits`, as bytes: made from bitmaps of 4096 bytes each, whatever the number of rows."""
    slot = F.pmod("h", F.lit(bits)) + 1
    maps = hashes.groupBy(F.bitmap_bucket_number(slot).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    out = np.zeros(-(-bits // 32768) * 4096, np.uint8)
    for k, x in maps.collect():
        out[(k - 1) * 4096 : k * 4096] = np.frombuffer(x, np.uint8)
    return out


def regions(docs: DataFrame, chosen: np.ndarray, sizes: list[int], margin: int, bits: int = BITS) -> DataFrame:
    """(doc_id, start, words, hs, at): stretches of each text around the n-grams that the set has, `margin` words to each side.

    hs and at are the n-grams' hashes and places. Stretches that meet are one, so that all together are no longer than the
    text. Null texts and ids have none.
    """
    told = docs.sparkSession.sparkContext.broadcast(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, chosen = Grams(), told.value
        for b in slices(batches, "text"):
            rows = []
            for doc, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                if doc is None or not text:
                    continue
                words = _words(text.lower())
                codes = grams.words(words)
                hs, at = [], []
                for size in sizes:
                    h = grams.of(codes, size)
                    slot = h & np.uint64(bits - 1)
                    hit = np.nonzero(chosen[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)[0]
                    hs.append(h[hit].view(np.int64))
                    at.append(hit)
                hs, at = np.concatenate(hs), np.concatenate(at)
                order = np.argsort(at, kind="stable")
                hs, at = hs[order], at[order]
                breaks = np.nonzero(np.diff(at) > 2 * margin)[0] + 1
                for h, a in zip(np.split(hs, breaks), np.split(at, breaks)) if len(at) else ():
                    start = max(0, int(a[0]) - margin)
                    rows.append((doc, start, " ".join(words[start : int(a[-1]) + margin]), h, a))
            doc, start, words, hs, at = zip(*rows) if rows else ((),) * 5
            yield pa.record_batch({"doc_id": pa.array(doc, pa.int64()), "start": pa.array(start, pa.int32()), "words": pa.array(words, pa.string()), "hs": pa.array(hs, pa.list_(pa.int64())), "at": pa.array(at, pa.list_(pa.int32()))})

    return docs.mapInArrow(run, "doc_id long, start int, words string, hs array<long>, at array<int>")


def can_reach(item: Counter, passage: list[str], least: float) -> bool:
    """Whether the words that both have allow a score of `least`: each of them adds MATCH at most."""
    both = sum((Counter(w for w in passage if w in item) & item).values())
    return both >= least * item.total()


def align(pairs: list[tuple[str, str]]) -> np.ndarray:
    """Best local alignment of each (item, passage), as a share of the score of a full copy of the item.

    Linear gaps; all pairs go through the rows of their tables together. A row's gaps along it are a running maximum.
    """
    if not pairs:
        return np.zeros(0)
    number: dict[str, int] = {}
    coded = [[np.array([number.setdefault(w, len(number)) for w in _words(x.lower())], np.int64) for x in pair] for pair in pairs]
    rows, columns = max(len(a) for a, _ in coded), max(len(b) for _, b in coded)
    item, text = np.full((len(pairs), rows), -1), np.full((len(pairs), columns), -2)
    for k, (a, b) in enumerate(coded):
        item[k, : len(a)], text[k, : len(b)] = a, b
    slope = -GAP * np.arange(columns + 1)
    before, best = np.zeros((len(pairs), columns + 1), np.int64), np.zeros(len(pairs), np.int64)
    for i in range(rows):
        now = np.zeros_like(before)
        now[:, 1:] = np.maximum(before[:, :-1] + np.where(text == item[:, i : i + 1], MATCH, MISMATCH), 0)
        now = np.maximum(now, before + GAP)
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        best = np.maximum(best, np.where(item[:, i] >= 0, now.max(1), 0))
        before = now
    return best / np.maximum(1, [MATCH * len(a) for a, _ in coded])


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least: float = LEAST_SCORE,
    rare_share: float = RARE_SHARE,
    bits: int = BITS,
) -> DataFrame:
    """(doc_id, item_id, score, n_seeds, passage): the best passage of each document for each item that it contaminates.

    The seeds are a table. One scan of the documents, for a benchmark of any size, keeps the stretches around the n-grams that a
    bit set of fixed size can't rule out; these meet the seeds in a join. A passage is aligned if one of its seeds is
    rare; how many documents have a seed is counted over all of them. Null texts and ids have no leaks; of rows that share
    an id the best counts, of equal scores the one with more seeds, then the greater text. Items without a word, and empty
    tables, have no leaks. Columns of other names are ignored; a text of any length is searched whole.
    """
    spark = docs.sparkSession
    items = checkpointed(seeds(benchmark, item_col, item_text_col))
    empty = spark.createDataFrame([], "doc_id long, item_id long, score double, n_seeds int, passage string")
    longest = items.agg(F.max("n_words"), F.collect_set("size")).first()
    if longest[0] is None:
        return empty
    places = items.select("key", "n_words", F.posexplode("hs").alias("place", "h"))
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = regions(kept, bit_set(places, bits), sorted(longest[1]), longest[0] + SEED_WORDS, bits)
    found = checkpointed(found.withColumn("region", F.monotonically_increasing_id()))
    hits = found.select("region", "doc_id", F.explode(F.arrays_zip("hs", "at")).alias("x")).select("region", "doc_id", "x.hs", "x.at").withColumnRenamed("hs", "h")
    seen = hits.select("doc_id", "h").distinct().groupBy("h").agg(F.count("*").alias("n"))
    spread = places.join(seen, "h")
    middle = spread.groupBy("key").agg(F.percentile_approx("n", 0.5, 1000).alias("middle"))
    rare = spread.join(middle, "key").where((F.col("n") <= rare_share * kept.count()) | (F.col("n") <= RELATIVE * (1 + F.col("middle"))))
    # Seeds of one copy of an item start it at about the same word: passages are told apart by that place, in steps of the item's length.
    step = F.floor((F.col("at") - F.col("place")) / F.col("n_words")).alias("step")
    near = hits.join(rare.select("h", "key", "place", "n_words"), "h").groupBy("region", "key", step)
    near = near.agg(F.min("at").alias("first"), F.max("at").alias("last"), F.size(F.collect_set("place")).alias("n_seeds"))
    wanted = near.join(items.select("key", "item_id", "item", "n_words"), "key").groupBy("region")
    wanted = wanted.agg(F.collect_list(F.struct("item_id", "item", "n_words", "first", "last", "n_seeds")).alias("wanted"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Counter] = {}
        for b in batches:
            out = []
            for doc, start, text, own in zip(*(b[c].to_pylist() for c in ("doc_id", "start", "words", "wanted"))):
                words = text.split(" ")
                for w in own:
                    item = known.get(w["item"])
                    if item is None:
                        known = {} if len(known) > 100_000 else known
                        item = known[w["item"]] = Counter(_words(w["item"].lower()))
                    passage = words[max(0, w["first"] - start - w["n_words"]) : w["last"] - start + SEED_WORDS + w["n_words"]]
                    if can_reach(item, passage, least):
                        out.append((doc, w["item_id"], w["n_seeds"], w["item"], " ".join(passage)))
            for k in range(0, len(out), 128):
                doc, item_id, n, item, passage = zip(*out[k : k + 128])
                yield pa.record_batch({"doc_id": pa.array(doc, pa.int64()), "item_id": pa.array(item_id, pa.int64()), "score": pa.array(align(list(zip(item, passage)))), "n_seeds": pa.array(n, pa.int32()), "passage": pa.array(passage)})

    met = found.select("region", "doc_id", "start", "words").join(wanted, "region").drop("region")
    scored = met.mapInArrow(score, empty.schema).where(F.col("score") >= least)
    best = F.max_by(F.struct("n_seeds", "passage"), F.struct("score", "n_seeds", "passage")).alias("b")
    return scored.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), best).select("doc_id", "item_id", "score", "b.n_seeds", "b.passage")


def drop_leaking(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """`docs` without the documents that hold a test item.

    Rows with a null id or a null or empty text stay, rows of one id stay or go together, columns of any name stay as they are.
    """
    goes = leaks(docs, benchmark, id_col=id_col, **options).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(goes, id_col, "left_anti").select(*docs.columns)
