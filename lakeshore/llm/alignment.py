"""Two tokenizers' tokens of the same texts, aligned by merging their byte ends along merge paths."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, dealt_anew, dropped, fresh_path, slices
from .sentencepieces import encoder

#: So many token ends are one piece of the merge.
PIECE = 256
#: At most so many pairs, those of most links, are sent to all tasks; the others are joined.
MOST_PAIRS = 1 << 20
#: A pair of ids is one number: B's id, then so many bits of A's.
A_BITS, B_BITS = 24, 18
#: The published pattern by which byte-level BPE cuts text before it merges: a fixed value.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LINKED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>, a array<int>, b array<int>, a_sizes array<int>, b_sizes array<int>"


def _byte_of() -> dict[str, int]:
    """The byte of each letter of a byte-level vocabulary: printable Latin-1 stands for itself, other bytes from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class ByteTokens:
    """A byte-level BPE from its tokenizer file. Special tokens' strings in a text are plain text.

    Where a vocabulary is ordered by its merges, its entries are ranks, and a faster library gives the same ids.
    """

    def __init__(self, path: str):
        told, of = json.load(open(path, encoding="utf-8")), _byte_of()
        model, cut = told["model"], told.get("pre_tokenizer") or {}
        if cut.get("type") != "ByteLevel" or told.get("normalizer"):
            raise ValueError("only byte-level tokenizers without a normaliser are supported")
        entries = {i: bytes(of[c] for c in x) for x, i in model["vocab"].items()}
        entries |= {x["id"]: x["content"].encode() for x in told.get("added_tokens", []) if x["id"] not in entries}
        text = [entries.get(i, b"") for i in range(max(entries) + 1)]
        self.size = np.array([len(x) for x in text])
        self.at, self.bytes = np.cumsum(self.size) - self.size, np.frombuffer(b"".join(text), np.uint8)
        pair = lambda m: "".join(m) if isinstance(m, list) else m.replace(" ", "")
        ranked = all(model["vocab"].get(pair(m)) == 256 + k for k, m in enumerate(model["merges"])) and len(model["vocab"]) == 256 + len(model["merges"])
        plain = cut.get("use_regex", True) and not cut.get("add_prefix_space") and not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        if ranked and plain:
            ranks = {bytes(of[c] for c in x): i for x, i in model["vocab"].items()}
            fast = tiktoken.Encoding("byte-level", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._ids = lambda texts: [fast.encode_to_numpy(x, disallowed_special=()) for x in texts]
        else:
            slow = tokenizers.Tokenizer.from_file(path)
            slow.encode_special_tokens = True
            self._ids = lambda texts: [np.array(e.ids) for e in slow.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number for each."""
        ids = self._ids(texts)
        return np.concatenate([np.empty(0, np.int64), *ids]).astype(np.int64), np.array([len(x) for x in ids], np.int64)


@lru_cache(maxsize=2)
def _byte_tokens(path: str) -> ByteTokens:
    return ByteTokens(path)


def cuts(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces of about `piece` ends begin in a and b, two strictly ascending arrays; the last entries are their lengths.

    Each diagonal of the merge path is searched for by bisection, all at once: the place where i ends of a and j of b,
    i + j being the diagonal, are the smallest ones. Equal ends stay in one piece.
    """
    diagonal = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        taken = np.zeros(len(middle), bool)
        taken[open_] = a[middle[open_]] <= b[(diagonal - 1 - middle)[open_]]
        low, high = np.where(open_ & taken, middle + 1, low), np.where(open_ & ~taken, middle, high)
    i, j = low, diagonal - low
    split = (i > 0) & (j < len(b))
    split[split] = a[i[split] - 1] == b[j[split]]
    return i, j + split


def links(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the ends of two tokenisations of the same bytes: (token of a, token of b, group) of each pair that overlaps, in order.

    All pieces are merged side by side, one end of each at a time: the bytes before an end, back to the one before, are one
    token's of a and one's of b. A group ends where both do. Pieces number their groups for themselves; the sum of those
    before stitches them, and a group that a piece leaves open goes on in the next.
    """
    i_at, j_at = cuts(a, b, piece)
    i, j, i_end, j_end = i_at[:-1].copy(), j_at[:-1].copy(), i_at[1:], j_at[1:]
    rounds = int((i_end - i + j_end - j).max(initial=0))
    left, right = np.zeros((rounds, len(i)), np.int32), np.zeros((rounds, len(i)), np.int32)
    closes, used = np.zeros((rounds, len(i)), bool), np.zeros((rounds, len(i)), bool)
    last = np.iinfo(np.int64).max
    a, b = np.append(a, last), np.append(b, last)
    for k in range(rounds):
        busy = (i < i_end) | (j < j_end)
        x, y = a[i], b[j]
        left[k], right[k], used[k] = i, j, busy
        closes[k] = busy & (x == y)
        i += busy & (x <= y)
        j += busy & (y <= x)
    base = np.cumsum(closes.sum(0)) - closes.sum(0)
    group = base + np.cumsum(closes, 0) - closes
    return left.T[used.T], right.T[used.T], group.T[used.T]


def _flat(at: np.ndarray, size: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The bytes of entries, one after the other."""
    total = np.concatenate([[0], np.cumsum(size)])
    return data[np.repeat(at - total[:-1], size) + np.arange(total[-1])]


@lru_cache(maxsize=1)
def _decimals(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each number below n the decimal text with a comma: where it begins, its size, and the bytes of all."""
    text = [b"%d," % k for k in range(n)]
    size = np.array([len(x) for x in text])
    return np.cumsum(size) - size, size, np.frombuffer(b"".join(text), np.uint8)


def group_text(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups as text, `a1,a2|b1;a3|b2,b3;`: the bytes of all, and where each group ends."""
    n = int(a_group[-1]) + 1 if len(a_group) else 0
    in_a, in_b = np.bincount(a_group, minlength=n), np.bincount(b_group, minlength=n)
    of_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[a_group]
    of_b = np.arange(len(b)) + np.cumsum(in_a)[b_group]
    ids = np.empty(len(a) + len(b), np.int64)
    ids[of_a], ids[of_b] = a, b
    at, size, data = _decimals(int(ids.max(initial=0)) + 1)
    out, ends = _flat(at[ids], size[ids], data), np.cumsum(size[ids])
    last_a = np.cumsum(in_a + in_b) - in_b - 1
    out[ends[last_a] - 1], out[ends[last_a + in_b] - 1] = ord("|"), ord(";")
    return out, ends[last_a + in_b]


def _lists(flat: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat, kind))


def aligned(texts: list[str | None], first: ByteTokens, second: object, digest: bool, piece: int = PIECE) -> dict[str, pa.Array]:
    """The columns of align() for some texts, but for their ids."""
    whole = [b"" if not x else b" " + x.encode() for x in texts]
    a, n_a = first.encode([" " + x if x else "" for x in texts])
    b, n_b = second.encode(texts)
    size = np.array([len(x) for x in whole])
    want = np.frombuffer(b"".join(whole), np.uint8)
    a_bytes, b_bytes = first.size[a], second.piece_size[b]
    joined = [_flat(first.at[a], a_bytes, first.bytes), _flat(second.piece_at[b], b_bytes, second.piece_bytes)]
    texts_of = lambda n: np.repeat(np.arange(len(texts)), n)
    bad = np.zeros(len(texts), bool)
    for flat, n, each in zip(joined, (n_a, n_b), (a_bytes, b_bytes)):
        held = np.bincount(texts_of(n), each, len(texts)).astype(np.int64)
        if not np.array_equal(held, size) or not np.array_equal(flat, want):
            begins = np.cumsum(held) - held
            bad |= np.array([flat[s : s + k].tobytes() != w for s, k, w in zip(begins.tolist(), held.tolist(), whole)])
    if bad.any():
        keep_a, keep_b = ~bad[texts_of(n_a)], ~bad[texts_of(n_b)]
        a, b, a_bytes, b_bytes = a[keep_a], b[keep_b], a_bytes[keep_a], b_bytes[keep_b]
        n_a, n_b = np.where(bad, 0, n_a), np.where(bad, 0, n_b)
    # All texts are one merge: they begin and end with both tokenisations.
    i, j, group = links(np.cumsum(a_bytes), np.cumsum(b_bytes), piece)
    a_group, b_group = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
    a_group[i], b_group[j] = group, group
    of_a = texts_of(n_a)
    n_all = int(group[-1]) + 1 if len(group) else 0
    of_group = np.empty(n_all, np.int64)
    of_group[a_group] = of_a
    n_groups = np.bincount(of_group, minlength=len(texts))
    of_link = of_a[i]
    n_links = np.bincount(of_link, minlength=len(texts))
    if len(second.piece_size) > 1 << B_BITS or len(first.size) > 1 << A_BITS or len(texts) >> 63 - A_BITS - B_BITS:
        raise ValueError("the vocabularies are too large")
    both = np.sort(of_link << A_BITS + B_BITS | b[j].astype(np.int64) << A_BITS | a[i])
    new = np.nonzero(np.concatenate([[True], both[1:] != both[:-1]]))[0] if len(both) else np.empty(0, np.int64)
    kinds, times = both[new], np.diff(np.append(new, len(both)))
    n_pairs = np.bincount(kinds >> A_BITS + B_BITS, minlength=len(texts))
    out = {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links}
    out = {k: pa.array(v, pa.int64()) for k, v in out.items()}
    if digest:
        text, ends = group_text(a, b, a_group, b_group)
        upto = np.append(0, ends)[np.append(0, np.cumsum(n_groups))].tolist()
        out["groups_sha256"] = pa.array([hashlib.sha256(text[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(upto, upto[1:])])
        whole_lists = {}
    else:
        out["groups_sha256"] = pa.nulls(len(texts), pa.string())
        whole_lists = {"a": (a, n_a), "b": (b, n_b), "a_sizes": (np.bincount(a_group, minlength=n_all), n_groups), "b_sizes": (np.bincount(b_group, minlength=n_all), n_groups)}
    out["pairs"] = _lists(kinds & (1 << A_BITS + B_BITS) - 1, n_pairs, pa.int64())
    out["times"] = _lists(times, n_pairs, pa.int32())
    for c in ("a", "b", "a_sizes", "b_sizes"):
        out[c] = _lists(*whole_lists[c], pa.int32()) if whole_lists else pa.nulls(len(texts), pa.list_(pa.int32()))
    return out


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, piece: int = PIECE) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times, a, b, a_sizes, b_sizes) of every row.

    A's tokens are those of a space and the text, by the byte-level tokenizer in a_path; B's those of the text, by the SentencePiece
    model in b_path, which puts a space before. They are cut into groups where both end. a and b are their ids, a_sizes and b_sizes the
    numbers of them in each group; with `digest` these are null, and groups_sha256 is of the groups as `a1,a2|b1;a3|b2,b3`.
    pairs are the distinct linked ids, b << A_BITS | a, in ascending order, times the links of each. `row` numbers rows.

    Null and empty texts, and those whose tokens' bytes aren't the text's, have no tokens: zeros and an empty string. Texts are taken
    whole; null and repeated ids pass through; other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = _byte_tokens(a_path), encoder(b_path)
        row = TaskContext.get().partitionId() << 40
        for b in slices(batches, "text", 1 << 20):
            numbers = pa.array(np.arange(row, row := row + b.num_rows))
            yield pa.record_batch({"row": numbers, "doc_id": b["doc_id"]} | aligned(b["text"].to_pylist(), first, second, digest, piece))

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(run, _LINKED)


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, n, is_best) over align()'s rows: the links of each pair, and whether no other pair of its B id has more."""
    each = found.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = checkpointed(each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n")))
    b = F.shiftright("pair", A_BITS).alias("b")
    best = counts.groupBy(b).agg(F.max("n").alias("most"))
    return counts.select("pair", "n", b).join(best, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("is_best"))


def _threshold(counts: DataFrame, most: int) -> int:
    """The smallest power of two such that `most` pairs at most have as many links. A count for each power comes to the driver."""
    sizes = dict(counts.groupBy((F.length(F.bin("n")) - 1).alias("power")).count().collect())
    power = 64
    while power > 0 and (most := most - sizes.get(power - 1, 0)) >= 0:
        power -= 1
    return 1 << power


def _scored(spark: SparkSession, found: DataFrame, counts: DataFrame, most_pairs: int) -> DataFrame:
    """found with n_best and count_sum. Frequent pairs are looked up in a table of bounded size, which all tasks get; the others are
    joined, so that no pair of very many links is joined at all."""
    least = _threshold(counts, most_pairs)
    frequent = counts.where(F.col("n") >= least).toArrow()
    order = np.argsort(pair := frequent["pair"].to_numpy())
    table = spark.sparkContext.broadcast((pair[order], frequent["n"].to_numpy()[order], frequent["is_best"].to_numpy()[order]))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = table.value
        for b in batches:
            sizes = np.diff(b["pairs"].offsets.to_numpy())
            pairs, times = (b[c].flatten().to_numpy() for c in ("pairs", "times"))
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            hit, times_hit = at[known], times[known].astype(np.int64)
            ends = np.append(0, np.cumsum(sizes))
            inside = np.append(0, np.cumsum(known))[ends]
            rest = sizes - np.diff(inside)
            total = lambda values: np.diff(np.append(0, np.cumsum(values))[inside])
            yield pa.record_batch({
                **{c: b[c] for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}, "n_best": pa.array(total(times_hit * best[hit]), pa.int64()), "count_sum": pa.array(total(times_hit * n[hit]), pa.int64()),
                "pairs": _lists(pairs[~known], rest, pa.int64()), "times": _lists(times[~known], rest, pa.int32()),
            })

    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, pairs array<long>, times array<int>"
    looked = checkpointed(found.mapInArrow(look_up, schema))
    rare = counts.where(F.col("n") < least)
    each = looked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    more = each.join(dealt_anew(rare, "pair"), "pair").groupBy("row")
    more = more.agg(F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("_best"), F.sum(F.col("times") * F.col("n")).alias("_sum"))
    joined = looked.drop("pairs", "times").join(more, "row", "left")
    return joined.withColumns({"n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0))}).drop("_best", "_sum", "row")


def agreement(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", most_pairs: int = MOST_PAIRS, piece: int = PIECE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of every row of align().

    n_best are the links whose pair is its B id's most frequent one in all documents, ties included; count_sum adds the
    numbers of links of their pairs. See align() for nulls, repeated ids and texts without tokens. The documents are encoded once: what
    is counted and looked up is written in between, and deleted.
    """
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "aligned")
    align(docs, a_path, b_path, id_col, text_col, True, piece).drop("a", "b", "a_sizes", "b_sizes").write.option("compression", "zstd").parquet(path)
    found = spark.read.parquet(path)
    out = checkpointed(_scored(spark, found, checkpointed(pair_counts(found)), most_pairs))
    dropped(spark, path)
    return out
