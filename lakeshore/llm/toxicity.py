"""Toxicity: a factorization machine over hashed terms, fitted to labelled documents."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Size of the hash space, and the lengths of word beginnings that count as terms beside the word itself.
SPACE, BEGINNINGS = 1 << 20, (4, 5, 6)
#: At most so many labelled documents are fitted: those whose hashed ids are smallest.
MOST_LABELS = 6_000
#: At most so many terms take part in the model, each with a z statistic of LEAST_Z or more, and so many factors describe each.
MOST_TERMS, LEAST_Z, FACTORS = 4096, 4, 8

_words = re.compile(r"\w+").findall


def _terms(word: str) -> list[int]:
    """Hashed terms of a lower-case word: the word, and its beginnings."""
    return [xxhash.xxh32_intdigest("w" + word) % SPACE, *(xxhash.xxh32_intdigest(f"b{word[:n]}") % SPACE for n in BEGINNINGS if n <= len(word))]


@dataclass
class Machine:
    """score = sigmoid(bias + sum of weights + sum over pairs of terms of the inner product of their factors)."""

    term: np.ndarray  # sorted hashed terms that take part
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    known: dict[str, int] = field(default_factory=dict)  # word -> place in spans; this process's own
    spans: list[np.ndarray] = field(default_factory=list)

    def __getstate__(self) -> dict:
        return {"term": self.term, "bias": self.bias, "weight": self.weight, "factor": self.factor, "known": {}, "spans": []}

    def places(self, word: str) -> np.ndarray:
        found = np.array(_terms(word))
        if not len(self.term):
            return found[:0]
        at = np.minimum(np.searchsorted(self.term, found), len(self.term) - 1)
        return np.unique(at[self.term[at] == found])

    def score(self, texts: list[str | None], most_words: int = 300_000) -> np.ndarray:
        if len(self.known) > most_words:
            self.known, self.spans = {}, []
        known, spans, docs, places = self.known, self.spans, [], []
        for doc, text in enumerate(texts):
            for word in set(_words((text or "").lower())):
                k = known.get(word)
                if k is None:
                    at = self.places(word)
                    k = -1
                    if len(at):
                        k = len(spans)
                        spans.append(at)
                    known[word] = k
                if k >= 0:
                    docs.append(doc)
                    places.append(k)
        linear, sums, squares = np.full(len(texts), self.bias), np.zeros((len(texts), self.factor.shape[1])), np.zeros(len(texts))
        if docs:
            lists = [spans[k] for k in places]
            pair = np.unique(np.repeat(docs, [len(x) for x in lists]) * len(self.term) + np.concatenate(lists))
            doc, at = np.divmod(pair, len(self.term))
            linear += np.bincount(doc, self.weight[at], len(texts))
            squares = np.bincount(doc, (self.factor[at] ** 2).sum(1), len(texts))
            for f in range(sums.shape[1]):
                sums[:, f] = np.bincount(doc, self.factor[at, f], len(texts))
        return _sigmoid(linear + ((sums**2).sum(1) - squares) / 2)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(lists: list[np.ndarray], labels: np.ndarray, epochs: int = 30, steps: int = 300, rate: float = 0.1, shrink: float = 1e-4, seed: int = 0) -> Machine:
    """Fit a machine to documents, each the distinct hashed terms it has, by AdaGrad on the logistic loss.

    Terms take part if documents of the two labels have them at clearly different rates (the MOST_TERMS with the
    largest z statistic, LEAST_Z at least). Without both labels the score is the share of label 1.
    """
    n, share = len(labels), float((labels.sum() + 0.5) / (len(labels) + 1))
    none = Machine(np.zeros(0, np.int64), float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, FACTORS)))
    if not 0 < labels.sum() < n:
        return none
    flat, doc = np.concatenate(lists), np.repeat(np.arange(n), [len(x) for x in lists])
    have = np.bincount(flat, minlength=SPACE)
    hits = np.bincount(flat, labels[doc], SPACE)
    with np.errstate(divide="ignore", invalid="ignore"):
        z = (hits - have * share) / np.sqrt(have * share * (1 - share) * (1 - have / (n + 1)))
    z = np.abs(np.nan_to_num(z, posinf=0, neginf=0))
    term = np.sort(np.argsort(-z, kind="stable")[:MOST_TERMS])
    term = term[z[term] >= LEAST_Z]
    if not len(term):
        return none
    place = np.full(SPACE, -1)
    place[term] = np.arange(len(term))
    at = place[flat]
    doc, at = doc[at >= 0], at[at >= 0]
    begin = np.searchsorted(doc, np.arange(n + 1))
    rng = np.random.default_rng(seed)
    weight, factor, bias = np.zeros(len(term)), rng.normal(0, 0.01, (len(term), FACTORS)), none.bias
    g_weight, g_factor, g_bias = np.full(len(term), 1e-2), np.full(factor.shape, 1e-2), 1e-2
    for _ in range(max(epochs, steps * 256 // n)):
        order = rng.permutation(n)
        for k in range(0, n, 256):
            batch = order[k : k + 256]
            size = begin[batch + 1] - begin[batch]
            row = np.repeat(np.arange(len(batch)), size)
            f = at[np.repeat(begin[batch] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            v = factor[f]
            sums = np.stack([np.bincount(row, v[:, j], len(batch)) for j in range(FACTORS)], 1)
            raw = bias + np.bincount(row, weight[f], len(batch)) + ((sums**2).sum(1) - np.bincount(row, (v**2).sum(1), len(batch))) / 2
            error = (_sigmoid(raw) - labels[batch]) / len(batch) * 16
            slope = np.bincount(f, error[row], len(term)) + shrink * weight
            change = error[row, None] * (sums[row] - v)
            slopes = np.stack([np.bincount(f, change[:, j], len(term)) for j in range(FACTORS)], 1) + shrink * factor
            g_weight += slope**2
            g_factor += slopes**2
            g_bias += error.sum() ** 2
            weight -= rate * slope / np.sqrt(g_weight)
            factor -= rate * slopes / np.sqrt(g_factor)
            bias -= rate * error.sum() / np.sqrt(g_bias)
    return Machine(term, float(bias), weight, factor)


def is_held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, divided by 5, leaves 0; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_labels: int = MOST_LABELS) -> Machine:
    """Fit to the labelled documents that aren't held out, most_labels of them at most.

    Labels that are null, or of a null id or one that docs lacks, are left out; of several labels of an id the largest counts.
    Rows with one id are one document, that with the greatest text. Ids with equal hashes are taken in their order.
    """
    told = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~is_held_out(id_col))
    told = told.groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_label"))
    there = docs.select(F.col(id_col).cast("long").alias("_id"))
    told = told.join(there, "_id", "left_semi").orderBy(F.xxhash64("_id"), "_id").limit(most_labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            lists = [sorted({t for w in set(_words((x or "").lower())) for t in _terms(w)}) for x in b["text"].to_pylist()]
            yield pa.record_batch({"label": b["_label"], "terms": pa.array(lists, pa.list_(pa.int32()))})

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(told), "_id")
    once = rows.groupBy("_id").agg(F.max("_label").alias("_label"), F.max("text").alias("text"))
    got = once.select("_label", "text").mapInArrow(run, "label int, terms array<int>").toArrow().combine_chunks()
    lists = [x.values.to_numpy() if len(x) else np.zeros(0, np.int32) for x in got["terms"]]
    order = sorted(range(len(lists)), key=lambda i: (len(lists[i]), lists[i].tobytes()))
    return train([lists[i] for i in order], got["label"].to_numpy().astype(float)[order]) if order else train([], np.zeros(0))


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; an empty, blank or null text gets the score of no terms.

    A text of any length is scored whole. Null and repeated ids pass through, other columns are ignored, an empty table gives
    no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            yield pa.record_batch({"doc_id": b["doc_id"], "score": pa.array(model.value.score(b["text"].to_pylist()))})

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = kept.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, machine: Machine, text_col: str = "text", most: float = 0.5) -> DataFrame:
    """`docs` without those whose score is `most` or more; the columns stay as they are.

    Each row counts for itself: a null text is scored as an empty one, null and repeated ids and columns of any name pass
    through, an empty table stays empty. A text of any length is scored whole.
    """
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col):
            yield b.filter(pa.array(model.value.score(b[text_col].to_pylist()) < most))

    return docs.mapInArrow(run, docs.schema)
