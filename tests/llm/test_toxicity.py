import zlib

import numpy as np
import pytest
from lakeshore.llm import toxicity

SCHEMA = "doc_id long, text string, score string"


@pytest.fixture(scope="module")
def scored(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    machine = toxicity.fit(docs, labels)
    return machine, toxicity.score(docs.join(labels, "doc_id"), machine).toPandas().merge(labels.toPandas(), on="doc_id")


def test_held_out_accuracy(scored):
    _, got = scored
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.5)).all() and got.score.between(0, 1).all()
    held = got[got.held_out]
    rank = held.score.rank()
    ones = held.toxic.sum()
    area = (rank[held.toxic == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(held) - ones))
    assert area > 0.93
    assert (held.predicted == held.toxic).mean() > 0.97
    assert (held.predicted[held.toxic == 0] == 0).mean() > 0.99


def test_pairs_of_terms_count():
    """Neither of two terms alone means label 1, only both together."""
    rng = np.random.default_rng(0)
    has = rng.random((4000, 2)) < 0.5
    lists = [np.array([t for t, h in zip((3, 9), row) if h] + [50 + i % 7], np.int32) for i, row in enumerate(has)]
    labels = has.all(1).astype(float)
    machine = toxicity.train(lists, labels)
    place = {int(t): k for k, t in enumerate(machine.term)}
    raw = lambda *ts: machine.bias + sum(machine.weight[place[t]] for t in ts) + (machine.factor[place[3]] @ machine.factor[place[9]] if len(ts) == 2 else 0)
    assert raw(3, 9) > 0 > max(raw(3), raw(9))


def test_score_equals_the_double_sum(scored):
    machine, _ = scored
    text = "you IDIOT and loser, such a moron loser"
    at = sorted({int(k) for w in text.lower().replace(",", "").split() for k in machine.places(w)})
    raw = machine.bias + machine.weight[at].sum() + sum(machine.factor[i] @ machine.factor[j] for i in at for j in at if i < j)
    assert len(at) > 1 and np.isclose(machine.score([text])[0], 1 / (1 + np.exp(-raw)))


def test_edges(spark, scored):
    machine, _ = scored
    docs = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, "", "b"), (2, " \n", None), (3, "word " * 200000, "c")], SCHEMA)
    rows = toxicity.score(docs, machine).collect()
    assert len(rows) == 5 and len({r.score for r in rows if r.doc_id != 3}) == 1
    assert toxicity.score(docs.limit(0), machine).count() == 0
    assert toxicity.drop_toxic(docs, machine).columns == docs.columns and toxicity.drop_toxic(docs, machine).count() == 5


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", "a")], SCHEMA)
    for rows in ([], [(1, None)], [(None, 1)], [(7, 1), (7, 0)], [(1, 0), (1, 0)]):
        machine = toxicity.fit(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert 0 <= toxicity.score(docs, machine).first().score <= 0.5
