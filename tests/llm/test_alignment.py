import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given
from hypothesis import strategies as st
from lakeshore.llm import alignment

from tests.llm.skew import splits

A, B = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, row string, pairs string"


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(libraries, text):
    """[(id, bytes)] of both tokenizers; none where the bytes aren't the text's."""
    if not text:
        return [], []
    a, b = libraries
    of = alignment._byte_of()
    first = [(i, bytes(of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    piece = lambda x: bytes([int(x[3:5], 16)]) if len(x) == 6 and x.startswith("<0x") else x.replace("▁", " ").encode()
    second = [(i, piece(b.id_to_piece(i))) for i in b.encode(text)]
    same = {b"".join(x for _, x in ids) for ids in (first, second)} == {b" " + text.encode()}
    return (first, second) if same else ([], [])


def plain(libraries, rows):
    """Rows of the contract, by comparing all byte ranges of a text's tokens."""
    every, found = [], Counter()
    for doc, text in rows:
        sides = []
        for ids in tokens(libraries, text):
            end, spans = 0, []
            for i, x in ids:
                spans.append((i, end, end := end + len(x)))
            sides.append(spans)
        a, b = sides
        pairs = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        found.update(pairs)
        common = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [",".join(str(i) for i, _, e in a if low < e <= high) + "|" + ",".join(str(i) for i, _, e in b if low < e <= high) for low, high in zip([0, *common], common)]
        every.append((doc, len(a), len(b), len(groups), pairs, ";".join(groups)))
    most = Counter()
    for (_, j), n in found.items():
        most[j] = max(most[j], n)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest() if x else ""
    return sorted(((d, na, nb, ng, len(p), digest(g), sum(found[x] == most[x[1]] for x in p), sum(found[x] for x in p)) for d, na, nb, ng, p, g in every), key=repr)


def corpus():
    rng = random.Random(8)
    words = ["international", "The", "naïve", "日本語の", "\n\n", "    ", "<|endoftext|>", "<s>", "</s>", "<0x41>", "🙂", "x" * 70, "1234567", "don't", "\u3000", "e\u0301", "\x00", "#include<a.h>"]
    rows = [(d, " ".join(rng.choices(words, k=rng.randint(0, 25)))) for d in range(60)]
    return rows + [(100, None), (None, ""), (101, "a▁b"), (102, " leading"), (103, "trailing  "), (None, "The The"), (5, rows[5][1]), (104, "\t"), (105, "word " * 3000)]


@pytest.mark.parametrize("most_pairs", [0, 1, 40, 1 << 20])
def test_against_brute_force(spark, libraries, most_pairs):
    docs = spark.createDataFrame([(d, t, "clash", "clash") for d, t in corpus()[: 40 if most_pairs < 40 else None]], SCHEMA)
    got = alignment.agreement(docs, A, B, most_pairs=most_pairs, piece=7)
    rows = [tuple(r) for r in got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum").collect()]
    assert sorted(rows, key=repr) == plain(libraries, corpus()[: 40 if most_pairs < 40 else None])
    if most_pairs < 1 << 20:
        assert alignment._threshold(alignment.pair_counts(alignment.align(docs, A, B)), most_pairs) > 1


def test_groups_as_arrays(spark, libraries):
    docs = spark.createDataFrame([(d, t, "clash", "clash") for d, t in corpus()], SCHEMA)
    lists = alignment.align(docs, A, B).collect()
    digests = {r.row: r.groups_sha256 for r in alignment.align(docs, A, B, digest=True).collect()}
    for r in lists:
        at_a, at_b, text = 0, 0, []
        for n, m in zip(r.a_sizes, r.b_sizes):
            text.append(",".join(map(str, r.a[at_a : at_a + n])) + "|" + ",".join(map(str, r.b[at_b : at_b + m])))
            at_a, at_b = at_a + n, at_b + m
        assert (at_a, at_b) == (r.n_a, r.n_b) == (len(r.a), len(r.b)) and len(text) == r.n_groups
        assert digests[r.row] == (hashlib.sha256(";".join(text).encode()).hexdigest() if text else "")
        assert r.pairs == sorted(set(r.pairs)) and sum(r.times) == r.n_links


ends = st.lists(st.integers(1, 60), max_size=40)


@given(ends, ends, st.integers(1, 200), st.integers(1, 9))
def test_links_of_any_ends(a, b, last, piece):
    """Every piece size gives the pairs that comparing all ranges does."""
    a, b = (np.array(sorted({*(x for x in e if x < last), last})) for e in (a, b))
    i, j, group = alignment.links(a, b, piece)
    spans = lambda e: list(zip([0, *e[:-1].tolist()], e.tolist()))
    want = [(x, y) for x, (s, e) in enumerate(spans(a)) for y, (t, f) in enumerate(spans(b)) if s < f and t < e]
    assert list(zip(i.tolist(), j.tolist())) == sorted(want)
    common = sorted(set(a.tolist()) & set(b.tolist()))
    assert group.tolist() == [sum(c < min(a[x], b[y]) for c in common) for x, y in zip(i, j)]
    begins = alignment.cuts(a, b, piece)
    work = np.diff(begins[0]) + np.diff(begins[1])
    assert work.sum() == len(a) + len(b) and (work <= piece + 1).all() and (work[:-1] >= piece - 1).all()


def test_the_faster_library_gives_the_same_ids(libraries):
    """Every code point in four contexts, and the special token's text."""
    ours = alignment.ByteTokens(A)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}b {chr(c)}1{chr(c)} {chr(c)}{chr(c)}" for c in points[k : k + 64]) for k in range(0, len(points), 64)] + ["<|endoftext|> a<|endoftext|>", " " * 3000 + "a", "ab" * 3000]
    flat, sizes = ours.encode(texts)
    want = [e.ids for e in libraries[0].encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(x) for x in want] and flat.tolist() == [i for x in want for i in x]


def test_empty_table(spark):
    assert alignment.agreement(spark.createDataFrame([], SCHEMA), A, B).count() == 0


def test_a_pair_of_many_documents_is_split(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('the same words ', id * 7919) AS text")
    found = alignment.align(docs, A, B, digest=True)
    assert splits(spark, lambda: alignment._scored(spark, found, alignment.pair_counts(found), 0))
