"""Quality rules: a short-circuit cascade in the order of rejection per cost."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

WINDOW, LEAST_WORDS, MOST_REPEATED_PERCENT = 8, 20, 30
#: So many documents at most, those with the smallest hashed ids, are the sample that the order of the rules comes from.
SAMPLE = 500
_SPACES = "".join(map(chr, [*range(9, 14), 32]))
_lines = re.compile(rf"[^{_SPACES}]").search


def repeated(codes: np.ndarray, doc: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which words stand in a window of words that its document has twice or more. codes: a number for each word.

    Windows get numbers by doubling: a number for each pair of halves, so equal numbers mean equal windows, exactly.
    """
    n = len(codes) - window + 1
    out = np.zeros(len(codes), bool)
    if n < 1:
        return out
    size, at = 1, codes.astype(np.int64)
    while size < window:
        step = min(size, window - size)
        pair = at[: len(at) - step] * (int(at.max()) + 1) + at[step:]
        at, size = np.unique(pair, return_inverse=True)[1], size + step
    whole = np.nonzero(doc[:n] == doc[window - 1 :])[0]
    key = doc[whole] * (int(at.max()) + 1) + at[whole]
    _, which, times = np.unique(key, return_inverse=True, return_counts=True)
    starts = whole[times[which] > 1]
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return np.cumsum(edge[:-1]) > 0


def measures(texts: list[str | None]) -> dict[str, np.ndarray]:
    """Counts for each text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = [(x or "").encode().split() for x in texts]
    n_words = np.array([len(w) for w in words], np.int64)
    doc = np.repeat(np.arange(len(texts)), n_words)
    number: dict[bytes, int] = {}
    codes = np.array([number.setdefault(w, len(number)) for one in words for w in one], np.int64)
    size = np.array([len(w.decode()) for w in number], np.int64)
    symbols = [sum(map(x.count, "#*$%&|<>")) if x else 0 for x in texts]
    dup_lines = []
    for x in texts:
        lines = [y for y in (x or "").split("\n") if _lines(y)]
        dup_lines.append(len(lines) - len(set(lines)))
    again = repeated(codes, doc)
    return {
        "n_words": n_words,
        "word_chars": np.bincount(doc, size[codes] if len(codes) else [], len(texts)).astype(np.int64),
        "n_symbols": np.array(symbols, np.int64),
        "n_dup_lines": np.array(dup_lines, np.int64),
        "n_repeat_words": np.bincount(doc[again], minlength=len(texts)).astype(np.int64),
    }


def base_failures(m: dict[str, np.ndarray]) -> np.ndarray:
    return (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED_PERCENT * m["n_words"])


# Each rule says which texts fail; m has the measures of these texts. word_length and letters are the usual bounds on prose;
# tables that hold no such junk give them no selectivity, and the cascade then runs them last.
Rule = Callable[[list[str], dict[str, np.ndarray]], np.ndarray]


def _word_length(texts: list[str], m: dict[str, np.ndarray]) -> np.ndarray:
    """Mean word length of 2 to 15 characters."""
    return (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"])


def _symbols(texts: list[str], m: dict[str, np.ndarray]) -> np.ndarray:
    """At most a symbol to ten words."""
    return 10 * m["n_symbols"] > m["n_words"]


def _lines_twice(texts: list[str], m: dict[str, np.ndarray]) -> np.ndarray:
    """At most 60 % of lines repeat an earlier one."""
    lines = np.array([sum(1 for y in x.split("\n") if _lines(y)) for x in texts])
    return 10 * m["n_dup_lines"] > 6 * lines


def _letters(texts: list[str], m: dict[str, np.ndarray]) -> np.ndarray:
    """At least 70 % of distinct words hold a letter."""
    return np.array([10 * sum(1 for w in set(x.split()) if not any(map(str.isalpha, w))) > 3 * len(set(x.split())) for x in texts], bool)


def _capitals(texts: list[str], m: dict[str, np.ndarray]) -> np.ndarray:
    """At most half of the letters are capitals."""
    return np.array([2 * sum(map(str.isupper, x)) > sum(map(str.isalpha, x)) for x in texts], bool)


def _stutter(texts: list[str], m: dict[str, np.ndarray]) -> np.ndarray:
    """At most 30 % of words equal the word before."""
    def share(x: str) -> bool:
        words = x.encode().split()
        return 10 * sum(map(bytes.__eq__, words, words[1:])) > 3 * len(words)

    return np.array([share(x) for x in texts], bool)


def _one_word(texts: list[str], m: dict[str, np.ndarray]) -> np.ndarray:
    """No word is over 40 % of the text."""
    def most(x: str) -> bool:
        words = x.split()
        return bool(words) and 5 * np.unique(words, return_counts=True)[1].max() > 2 * len(words)

    return np.array([most(x) for x in texts], bool)


RULES: dict[str, Rule] = {"word_length": _word_length, "symbols": _symbols, "lines_twice": _lines_twice, "letters": _letters, "capitals": _capitals, "stutter": _stutter, "one_word": _one_word}


#: Each timing on the sample is the shortest of so many.
TIMINGS = 3


def cascade_order(texts: list[str], rules: dict[str, Rule] = RULES) -> list[str]:
    """Rules by rejections per second on a sample, the highest first.

    Only texts that pass the base rule are measured, as only they come to the cascade; each rule is measured on those that the
    rules chosen before it let pass. Rules that reject nothing more come last, the cheapest first. The order changes
    the work, never the verdict.
    """
    texts = [x for x in texts if x]
    m, left, order = measures(texts), dict(rules), []
    alive = np.nonzero(~base_failures(m))[0]
    while left:
        gain, failed = {}, {}
        for name, rule in left.items():
            own, counts, took = [texts[i] for i in alive], {k: v[alive] for k, v in m.items()}, []
            for _ in range(TIMINGS):
                begin = time.perf_counter()
                failed[name] = rule(own, counts)
                took.append(time.perf_counter() - begin)
            gain[name] = (failed[name].sum() / min(took), -min(took))
        best = max(left, key=lambda name: gain[name])
        order.append(best)
        del left[best]
        alive = alive[~failed[best]]
    return order


def judge(texts: list[str | None], order: list[str], rules: dict[str, Rule] = RULES) -> dict[str, np.ndarray]:
    """The measures, base_failed and kept. A rule looks only at texts that all rules before it let pass."""
    m = measures(texts)
    failed = base_failures(m)
    alive = np.nonzero(~failed)[0]
    for name in order:
        if len(alive):
            alive = alive[~rules[name]([texts[i] for i in alive], {k: v[alive] for k, v in m.items()})]
    kept = np.zeros(len(texts), bool)
    kept[alive] = True
    return m | {"base_failed": failed, "kept": kept}


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of every row.

    A null text has no words and fails the base rule, as an empty one does. Null and repeated ids pass through, and a text of
    any length is measured whole. Other columns are ignored; an empty table gives no rows. Ids with equal hashes are
    sampled in the order of the ids.
    """
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Ids first, so that the sort moves no texts.
    ids = kept.where("doc_id is not null").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = kept.join(F.broadcast(ids.distinct()), "doc_id").select("text").limit(sample)
    order = cascade_order([r.text for r in texts.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 2 << 20):
            yield pa.record_batch({"doc_id": b["doc_id"]} | {k: pa.array(v) for k, v in judge(b["text"].to_pylist(), order).items()})

    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    return kept.mapInArrow(run, f"doc_id long, {counts}, base_failed boolean, kept boolean")
