"""SentencePiece BPE encoding by vectorised merge rounds over flat symbol arrays, and decoding."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

SPACE, NONE = "▁", np.int64(1) << 40
#: Symbols from here on are characters without a piece.
OTHER = 1 << 21


class Encoder:
    """One model's merge table, and the words that this process has met (at most `most_words`, then it starts anew)."""

    def __init__(self, model: str, most_words: int = 300_000):
        self.library = p = sentencepiece.SentencePieceProcessor(model_file=model)
        n = p.get_piece_size()
        special = [p.is_control(i) or p.is_unknown(i) or p.is_byte(i) for i in range(n)]
        pieces = {p.id_to_piece(i): i for i in range(n) if not special[i]}
        sample = " A  ﬁ① "
        if any(p.is_unused(i) for i in range(n)) or not p.is_byte(p.piece_to_id("<0x00>")) or p.normalize(sample) != SPACE + sample.replace(" ", SPACE):
            raise ValueError("only BPE models with byte fallback, identity normalisation and no unused pieces are supported")
        if any(re.search(f"[^{SPACE}]{SPACE}", x) for x in pieces):
            raise ValueError("a piece spans words")
        self.bytes_at = np.array([p.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        self.of_char = np.arange(0x110000, dtype=np.int64) + OTHER
        for x, i in pieces.items():
            if len(x) == 1:
                self.of_char[ord(x)] = i
        symbol = lambda x: int(self.of_char[ord(x)]) if len(x) == 1 else pieces.get(x)
        rank_of = {s: k for k, s in enumerate(sorted({p.get_score(i) for i in pieces.values()}, reverse=True))}
        pairs = {}
        for x, i in pieces.items():
            for k in range(1, len(x)):
                if (a := symbol(x[:k])) is not None and (b := symbol(x[k:])) is not None:
                    pairs[a << 22 | b] = (rank_of[p.get_score(i)], i)
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks, self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int64).T.copy()
        alone = "\n" if not any("\n" in x for x in pieces) else ""
        self.words = re.compile(f" +[^ {alone}]*|[^ {alone}]+" + f"|{alone}" * bool(alone)).findall
        self.most_words = most_words
        text = [bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else b"" if special[i] else p.id_to_piece(i).replace(SPACE, " ").encode() for i in range(n)]
        self.piece_bytes = np.frombuffer(b"".join(text), np.uint8)
        self.piece_size = np.array([len(x) for x in text])
        self.piece_at = np.cumsum(self.piece_size) - self.piece_size
        self.piece_spaced = np.array([x[:1] == b" " and not p.is_byte(i) for i, x in enumerate(text)])
        self.piece_other = np.array([p.is_control(i) or p.is_unknown(i) for i in range(n)])
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.starts, self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (NONE if it has no piece), and its place in the table."""
        key = left << 22 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE), at

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, one after the other, and the number for each word.

        In each round every word takes its smallest pair rank and merges that pair's occurrences at once, leftmost
        first. Where such a merge makes a pair of the same or a smaller rank, which the sequential order would take
        first, the word merges only its leftmost occurrence in that round. Words without a pair left are put aside and
        the arrays are closed up.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = "".join(words).replace(" ", SPACE)
        sym = self.of_char[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        word = np.repeat(np.arange(len(words)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            n = len(sym)
            rank, at = np.full(n, NONE), np.zeros(n, np.int64)
            inner = np.nonzero(word[1:] == word[:-1])[0]
            rank[inner], at[inner] = self.lookup(sym[inner], sym[inner + 1])
            first = np.nonzero(np.concatenate([[True], word[1:] != word[:-1]]))[0]
            least = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, n))
            if (least == NONE).any():
                stay = np.repeat(least != NONE, size)
                done.append((word[~stay], sym[~stay]))
                sym, word, rank, at = sym[stay], word[stay], rank[stay], at[stay]
                size, least = size[least != NONE], least[least != NONE]
                n = len(sym)
                if not n:
                    break
                first = np.concatenate([[0], np.cumsum(size)[:-1]])
            hit = np.nonzero(rank == np.repeat(least, size))[0]
            # Of a run of overlapping occurrences every second one goes, from the left.
            run = np.concatenate([[True], np.diff(hit) != 1])
            begin = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - begin) % 2 == 0]
            of = word[hit]
            lead = np.concatenate([[True], of[1:] != of[:-1]])
            if not lead.all():
                new, least_here = self.merged[at[hit]], rank[hit]
                before = np.maximum(hit - 1, 0)
                left = sym[before]
                chained = np.nonzero(np.concatenate([[False], (np.diff(hit) == 2) & (of[1:] == of[:-1])]))[0]
                left[chained] = new[chained - 1]
                bad = (hit > 0) & (word[before] == of) & (self.lookup(left, new)[0] <= least_here)
                after = np.minimum(hit + 2, n - 1)
                bad |= (hit + 2 < n) & (word[after] == of) & (self.lookup(new, sym[after])[0] <= least_here)
                if bad.any():
                    hit = hit[lead | ~np.isin(of, of[bad])]
            sym[hit] = self.merged[at[hit]]
            keep = np.ones(n, bool)
            keep[hit + 1] = False
            sym, word = sym[keep], word[keep]
        if not done:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        word, sym = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        word, sym = word[order], sym[order]
        if (odd := sym >= OTHER).any():
            found, which = np.unique(sym[odd] - OTHER, return_inverse=True)
            coded = [np.frombuffer(chr(c).encode("utf-8", "replace"), np.uint8) for c in found.tolist()]
            times = np.ones(len(sym), np.int64)
            times[odd] = np.array([len(c) for c in coded])[which]
            out, word = np.repeat(sym, times), np.repeat(word, times)
            begins = (np.cumsum(times) - times)[odd]
            for k in range(4):
                has = np.array([len(c) > k for c in coded])[which]
                out[begins[has] + k] = self.bytes_at[np.array([c[k] if len(c) > k else 0 for c in coded])[which[has]]]
            sym = out
        return sym.astype(np.int32), np.bincount(word, minlength=len(words))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number for each; a null or empty text has none."""
        words: list[str] = []
        ends = []
        for x in texts:
            if x:
                words += self.words(" " + x.replace(SPACE, " "))
            ends.append(len(words))
        if len(self.known) > self.most_words:
            self.forget()
        known = self.known
        if fresh := list(set(words).difference(known)):
            flat, sizes = self.merge(fresh)
            known.update(zip(fresh, range(len(self.sizes), len(self.sizes) + len(fresh))))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
            self.sizes, self.flat = np.concatenate([self.sizes, sizes]), np.concatenate([self.flat, flat])
        codes = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        sizes = self.sizes[codes]
        total = np.concatenate([[0], np.cumsum(sizes)])
        take = np.repeat(self.starts[codes] - total[:-1], sizes) + np.arange(total[-1])
        return self.flat[take], np.diff(total[np.array([0, *ends])])


    def decode(self, flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """The library's decode(ids) of each list: the pieces' bytes are gathered at once, less the space that encoding put first.

        Lists with control or unknown ids, or with byte pieces that aren't UTF-8, go through the library.
        """
        ends = np.cumsum(sizes)
        lead = (ends - sizes)[sizes > 0]
        start, size = self.piece_at[flat], self.piece_size[flat]
        spaced = lead[self.piece_spaced[flat[lead]]]
        start[spaced] += 1
        size[spaced] -= 1
        total = np.concatenate([[0], np.cumsum(size)])
        data = self.piece_bytes[np.repeat(start - total[:-1], size) + np.arange(total[-1])]
        out = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(total[np.append(0, ends)].astype(np.int32)), pa.py_buffer(data)])
        bad = np.zeros(len(sizes), bool)
        if self.piece_other[flat].any():
            bad[np.searchsorted(ends, np.nonzero(self.piece_other[flat])[0], "right")] = True
        texts = out.cast(pa.string(), safe=False)
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            bad |= np.array([x.decode("utf-8", "ignore").encode() != x for x in out.to_pylist()])
        if not bad.any():
            return texts
        spans = zip((ends - sizes).tolist(), ends.tolist())
        return pa.array([self.library.decode(flat[i:k].tolist()) if b else x.decode() for b, x, (i, k) in zip(bad, out.to_pylist(), spans)], pa.string())


@lru_cache(maxsize=2)
def _encoder(model: str) -> Encoder:
    return Encoder(model)


def encoder(model: str) -> Encoder:
    """This process's encoder of a model file."""
    return _encoder(model)


def encode_decode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of every row: the library's ids of the whole text, and its decode(ids).

    A null or empty text gives no ids and an empty string; a text of any length is encoded whole. Ids of documents pass through as they are, null and
    repeated ones too. Other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for b in slices(batches, "text", 1 << 20):
            flat, sizes = own.encode(b["text"].to_pylist())
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.record_batch({"doc_id": b["doc_id"], "ids": ids, "decoded": own.decode(flat, sizes)})

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the comma-joined ids and of the decoded text, for each row of encode_decode().

    Of a text without ids these are 0 and the digests of empty strings; null and repeated ids pass through; other columns are
    ignored; an empty table gives no rows.
    """
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
