"""Substring dedup: hashed runs of consecutive sentences, joined over all documents."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import accumulate, count

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import dealt_anew, free_name, slices

#: A run is RUN consecutive sentences, and as many more as it takes to have LEAST_WORDS words; at a text's end LEAST_TAIL words do.
RUN, LEAST_WORDS, LEAST_TAIL = 3, 25, 12
# A sentence ends after . ! or ? before white space, and at each line break; the white space belongs to it.
_cut = re.compile(r"(?<=[.!?])\s+|\s*\n\s*").finditer
# A word and the white space after it.
_word = re.compile(r"\S+\s*").sub


def sentences(text: str) -> list[str]:
    """The text cut into sentences; joined they are the text again."""
    ends = [m.end() for m in _cut(text)]
    return [x for a, b in zip([0, *ends], [*ends, len(text)]) if (x := text[a:b])]


def spans(text: str, run: int = RUN, least: int = LEAST_WORDS) -> Iterator[tuple[bytes, int, int]]:
    """(128-bit hash, first sentence, number of sentences) of each run; sentences are equal if their words are.

    A run starts at every sentence with words and goes on to the first one at which it has `run` sentences and `least`
    words; blank sentences between don't count. Where the text ends before, the run is all that is left, if that has `run` sentences and
    LEAST_TAIL words (or `least`, if that is fewer). A text of `run` sentences or more is a run, however few words it has.
    """
    words = [x.split() for x in sentences(text)]
    full = [i for i, w in enumerate(words) if w]
    if len(full) < run:
        return
    digests = b"".join(xxhash.xxh3_128_digest(" ".join(words[i])) for i in full)
    so_far = [0, *accumulate(len(words[i]) for i in full)]
    end = 0
    for k, i in enumerate(full):
        end = max(end, k + run)
        while end < len(full) and so_far[end] - so_far[k] < least:
            end += 1
        if end > len(full) or k and so_far[end] - so_far[k] < min(least, LEAST_TAIL):
            return
        yield xxhash.xxh3_128_digest(digests[16 * k : 16 * end]), i, full[end - 1] - i + 1


def word_runs(text: str, passage: int) -> Iterator[tuple[bytes, int, int]]:
    """(128-bit hash, first word, number of words) of some runs of passage // 2 + 1 words: at least one in any `passage` consecutive words.

    Of the runs within each such stretch that with the least polynomial in its words' hashes is taken, the first of equal ones. So equal
    stretches have an equal run, wherever they lie and wherever sentences end, and the runs of a longer stretch leave no word out between them.
    """
    words, size = text.split(), passage // 2 + 1
    if len(words) < passage:
        return
    one = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), np.uint64)
    order = sliding_window_view(one, size) @ np.cumprod(np.full(size, 0x9E3779B97F4A7C15, np.uint64))
    least = sliding_window_view(order, passage - size + 1).argmin(axis=1)
    for i in np.unique(least + np.arange(len(least))).tolist():
        yield xxhash.xxh3_128_digest(" ".join(words[i : i + size]), seed=1), i, size  # the seed keeps them apart from runs of sentences


def _key(text_col: str):
    return F.xxhash64(text_col).alias("_version")


def _all_spans(docs: DataFrame, id_col: str, text_col: str, spans_of: Callable[[str], Iterator[tuple[bytes, int, int]]]) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            hashes, sizes, first, count = [], [], [], []
            for text in b["text"].to_pylist():
                before = len(first)
                for h, i, n in spans_of(text or ""):
                    hashes.append(h)
                    first.append(i)
                    count.append(n)
                sizes.append(len(first) - before)
            both = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            at = pa.array(np.repeat(np.arange(b.num_rows), sizes))
            yield pa.record_batch({"a": pa.array(both[:, 0].copy()), "b": pa.array(both[:, 1].copy()), "doc_id": b["doc_id"].take(at), "_version": b["_version"].take(at), "first": pa.array(first, pa.int32()), "n": pa.array(count, pa.int32())})

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), _key(text_col), F.col(text_col).alias("text"))
    return kept.mapInArrow(cut, "a long, b long, doc_id long, _version long, first int, n int")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN, least: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, _version, first, n) of every run that isn't the first of its kind, by doc_id (null first), text hash and place.

    Counts and first places are aggregates that combine before the shuffle. The join back to the runs deals both sides anew, so
    that adaptive execution can split a run of many places.
    """
    return _repeated(_all_spans(docs, id_col, text_col, lambda text: spans(text, run, least)))


def repeated_passages(docs: DataFrame, passage: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, _version, first, n), first and n in words, of every word run that isn't the first of its kind, as in repeated_spans()."""
    return _repeated(_all_spans(docs, id_col, text_col, lambda text: word_runs(text, passage)))


def _repeated(every: DataFrame) -> DataFrame:
    place = F.struct("doc_id", "_version", "first")
    kinds = every.groupBy("a", "b").agg(F.min(place).alias("origin"), F.max(place).alias("last"))
    again = dealt_anew(kinds.where("origin <> last").drop("last"), "a")
    return every.join(again, ["a", "b"]).where(place != F.col("origin")).select("doc_id", "_version", "first", "n")


def _without(text: str, gone: set[int], words: set[int]) -> tuple[str, int]:
    """The text without the sentences and words of these numbers, and how many sentences that changed."""
    at, kept, changed = count(), [], len(gone)
    for i, x in enumerate(sentences(text)):
        left = _word(lambda m: "" if next(at) in words else m[0], x) if words else x
        if i not in gone:
            kept.append(left)
            changed += left != x
    return "".join(kept), changed


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN, least: int = LEAST_WORDS, passage: int | None = None) -> DataFrame:
    """`docs` with the sentences of every non-first repeated run cut from the text, and _n_removed, their number.

    Null and empty texts stay as they are, with 0, and so do texts of fewer than `run` sentences without `passage`. A run that a text repeats
    within itself goes too. A text of any length is worked on whole. Rows with the same id and the same text are one document: their spans
    count once and they are cut alike. A column that is called _n_removed already is replaced.

    Runs are whole sentences, so a copied passage with fewer than `run` of them may stay. With `passage` every copy of that many words or
    more is found as well, also inside sentences. Of those words the repeated word runs go, with the white space after each word; fewer than
    (passage + 1) // 2 words of the copy may stay at either end. A copy of over passage // 2 words may go too. Sentences that only lose words count as removed.
    """
    base = docs.drop("_n_removed")
    of, id_, cut_ = (free_name(base, x) for x in ("_of", "_doc", "_cut"))
    found = repeated_spans(docs, id_col, text_col, run, least).withColumn("of_words", F.lit(False))
    if passage is not None:
        found = found.unionByName(repeated_passages(docs, passage, id_col, text_col).withColumn("of_words", F.lit(True)))
    cuts = found.groupBy(F.col("doc_id").alias(id_), F.col("_version").alias(of)).agg(F.collect_set(F.struct("first", "n", "of_words")).alias(cut_))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(id_)) & (F.xxhash64(text_col) == F.col(of))
    joined = base.join(cuts, same, "left").drop(id_, of)
    names = base.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col):
            texts, removed = b[text_col].to_pylist(), [0] * b.num_rows
            for k, cut in enumerate(b[cut_].to_pylist()):
                if cut:
                    gone, words = ({i for c in cut if c["of_words"] == w for i in range(c["first"], c["first"] + c["n"])} for w in (False, True))
                    texts[k], removed[k] = _without(texts[k], gone, words)
            columns = {n: pa.array(texts, pa.string()) if n == text_col else b[n] for n in names}
            yield pa.record_batch(columns | {"_n_removed": pa.array(removed, pa.int32())})

    schema = T.StructType([*base.schema.fields, T.StructField("_n_removed", T.IntegerType())])
    return joined.mapInArrow(cut, schema)
