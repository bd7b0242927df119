import hashlib

import corpus_pipeline
import public_tokenizers
import sentencepiece
from lakeshore.llm import simhash, toxicity

from tests.llm.test_lines import plain as plain_lines
from tests.llm.test_decontaminate import plain_align


def groups(rows):
    """The smallest id that pairs of five-word shingle sets with Jaccard 0.8 or more link each row to."""
    sets = [set(simhash.shingle_set(t, 5).tolist()) for _, t in rows]
    at = [i for i, _ in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for i, j in near:
            if at[i] != at[j]:
                at[i] = at[j] = min(at[i], at[j])
                changed = True
    return at


def test_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    machine = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = [(r.doc_id, r.text, r.source) for r in docs.orderBy("doc_id").collect()]
    rows = [r for r, s in zip(rows, machine.score([r[1] for r in rows])) if s < 0.5]
    rows = [(d, t) for d, t, _ in sorted(plain_lines(rows, 10))]
    rows = [r for r, g in zip(rows, groups(rows)) if r[0] == g]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    words = [set(x.lower().split()) for x in items]

    def leaks(text):
        own = set(text.lower().split())
        clean = lambda x: " ".join(toxicity._words(x.lower()))
        return any(len(w & own) > 0.4 * len(w) and plain_align(clean(x), clean(text)) >= 0.5 for w, x in zip(words, items))

    rows = [r for r in rows if not leaks(r[1])]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for d, t in rows:
        ids = library.encode(t)
        want.append((d, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids) if ids else ""))))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, sf).collect()]
    assert sorted(got) == sorted(want) and 20 < len(want) < docs.count()


def test_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0


def test_stages_on_edge_rows(spark, sf):
    """Nulls in every column, empty and long texts, repeated rows, and columns named as the operators' own."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, _gone string, _id string, _cut string, fp string, score string, h string"
    rest = ("g", "i", "c", "f", "s", "h")
    rows = [(1, "a b c", "en", "s1", 5), (1, "a b c", "en", "s1", 5), (2, None, None, None, None), (None, "q r", "en", None, 3), (None, None, None, None, None), (3, "", "en", "s2", 0), (4, "word " * 50000, "en", "s3", 250000)]
    docs = spark.createDataFrame([(*r, *rest) for r in rows], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, sf)
        assert got.columns == docs.columns
        # Only near-dedup drops any: the empty text is a copy of the null one.
        assert got.count() == (6 if name == "SimHash near-dedup" else 7), name
        assert {r._gone for r in got.collect()} == {"g"}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == 7


def test_operators_beside_columns_of_their_own_names(spark):
    from lakeshore.llm import pii, sentence_spans

    docs = spark.createDataFrame([(1, "from 227.5.221.1", "p", "c", "o", "d")], "doc_id long, text string, _parts string, _cut string, _of string, _doc string")
    assert sentence_spans.remove_repeats(docs).columns == [*docs.columns, "_n_removed"]
    got = pii.pseudonymize(docs, "k").first()
    assert got._parts == "p" and len(got._pii) == 1
