import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from lakeshore.llm import sentencepieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ENCODER = sentencepieces.encoder(MODEL)


def same(texts):
    flat, sizes = ENCODER.encode(texts)
    ids, at = flat.tolist(), 0
    for text, n in zip(texts, sizes.tolist()):
        assert ids[at : at + n] == ENCODER.library.encode(text or ""), repr(text)[:200]
        at += n
    assert at == len(ids)
    decoded = ENCODER.decode(flat, sizes).to_pylist()
    assert decoded == [ENCODER.library.decode(ENCODER.library.encode(x)) if x else "" for x in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab eéßthinoO \n\t▁.,01日本​①ﬁ"), max_size=60), max_size=5))
def test_small_alphabet(texts):
    same(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=5))
def test_any_text(texts):
    same(texts)


def test_words_that_repeat_their_pairs():
    rng = random.Random(3)
    same(["".join(rng.choices("ab", k=400)) for _ in range(40)] + ["a" * k for k in range(60)] + ["=" * 5000, "the" * 3000, " " * 999, "ing " * 2000])
    same(["".join(rng.choices(["th", "e", "in", "g", "ion", "s"], k=30)) for _ in range(3000)])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 270), st.sampled_from([29871, 259])), max_size=12), max_size=4))
def test_decoding_any_ids(lists):
    flat, sizes = np.array([i for x in lists for i in x], np.int32), np.array([len(x) for x in lists], np.int64)
    assert ENCODER.decode(flat, sizes).to_pylist() == [ENCODER.library.decode(x) if x else "" for x in lists]


def test_forgetting_changes_nothing():
    small = sentencepieces.Encoder(MODEL, most_words=3)
    for text in ("one two three four", "five six", "one two"):
        assert small.encode([text])[0].tolist() == small.library.encode(text)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.union(spark.createDataFrame([(None, None, "x"), (5, "", "x"), (5, " a  b", None)], docs.schema))
    want = []
    for r in docs.collect():
        ids = ENCODER.library.encode(r.text or "")
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((r.doc_id, len(ids), digest(",".join(map(str, ids))), digest(ENCODER.library.decode(ids) if ids else "")))
    got = [tuple(r) for r in sentencepieces.digests(sentencepieces.encode_decode(docs, MODEL)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sentencepieces.encode_decode(docs.limit(0), MODEL).count() == 0


def test_other_models_are_refused():
    with pytest.raises((ValueError, OSError, RuntimeError)):
        sentencepieces.Encoder("/no/such.model")
