import random

import pytest
from lakeshore.llm import secrets
from pyspark.sql import Observation
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, candidate string"
HEX = "0123456789abcdef"
MIXED = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def corpus(n, seed):
    """(text, secret or None): secrets and look-alikes among prose."""
    rng = random.Random(seed)
    prose = lambda: " ".join(rng.choices("the reader of this page would find international communication departments very interesting indeed".split(), k=12))
    of = lambda letters, k: "".join(rng.choices(letters, k=k))
    out = []
    for _ in range(n):
        secret = rng.choice([None, None, 'token = "{}"', "password={}", "api_key: {}", "AKIA"])
        if secret == "AKIA":
            value = "AKIA" + of("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16)
            line = value
        elif secret:
            value = of(rng.choice([HEX, MIXED]), rng.randint(24, 40))
            line = secret.format(value)
        else:
            value = None
            line = rng.choice([
                "commit " + of(HEX, 40), "sha256: " + of(HEX, 64), f"see /usr/share/{rng.choice(['page', 'reader'])}/departments/page{rng.randrange(50)}.html",
                "".join(rng.choices(["international", "communication", "departments", "reader"], k=3)), f"number {rng.randrange(10**16, 10**17)}",
            ])
        out.append((f"{prose()} {line} {prose()}", value))
    return out


@pytest.fixture(scope="module")
def scanned(spark):
    rows = corpus(500, 1)
    docs = spark.createDataFrame([(i, t, "clash") for i, (t, _) in enumerate(rows)], SCHEMA)
    return rows, secrets.scan(docs).collect()


def test_labelled_findings(scanned):
    rows, found = scanned
    kept = {(r.doc_id, r.candidate) for r in found if r.is_secret}
    want = {(i, v) for i, (_, v) in enumerate(rows) if v}
    assert len(want & kept) / len(want) > 0.97 and len(want & kept) / len(kept) > 0.97
    assert len(found) > len(kept) + 100


def lookalikes(n, seed):
    """(text, value, is it a secret): in half of the texts words and form tell different things, or no word tells anything."""
    rng = random.Random(seed)
    of = lambda letters, k: "".join(rng.choices(letters, k=k))
    kinds = [
        lambda: (f'secret = "{(v := of(MIXED, rng.randint(24, 40)))}"', v, True), lambda: (f"api_key={(v := of(HEX, 32))}", v, True),
        lambda: (f"password: {(v := of(MIXED, 8) + rng.choice('!#$%') + of(MIXED, 4))}", v, True),
        lambda: (f"bearer {(v := of(MIXED, rng.randint(24, 40)))}", v, True), lambda: (f"we used {(v := of(MIXED, rng.randint(24, 40)))} there", v, True),
        lambda: (f"commit {(v := of(HEX, 40))}", v, False), lambda: (f"sha256: {(v := of(HEX, 64))}", v, False),
        lambda: (f"token: {(v := str(rng.randrange(10**15, 10**17)))}", v, False), lambda: (f"token: {(v := '2024-03-0%d-%08d' % (rng.randint(1, 9), rng.randrange(10**8)))}", v, False),
        lambda: (f"secret: {(v := '/usr/share/' + '/'.join(rng.choices(['page', 'international', 'communication', 'reader'], k=3)) + str(rng.randrange(10**5)) + '.html')}", v, False),
        lambda: (f"{(v := '/usr/share/' + '/'.join(rng.choices(['page', 'international', 'communication', 'reader'], k=3)) + str(rng.randrange(10**5)) + '.html')}", v, False),
        lambda: (f"on {(v := '2024-03-0%d-%08d' % (rng.randint(1, 9), rng.randrange(10**8)))}", v, False),
        lambda: (f"number {(v := str(rng.randrange(10**16, 10**18)))}", v, False),
    ]
    out = []
    for _ in range(n):
        line, value, secret = rng.choice(kinds)()
        prose = [" ".join(rng.choices("the reader of this page would find international communication departments very interesting indeed".split(), k=12)) for _ in range(2)]
        out.append((f"{prose[0]} {line} {prose[1]}", value, secret))
    return out


def test_forest_judges_lookalikes_it_was_not_fitted_to(spark):
    rows = lookalikes(1500, 2)
    docs = spark.createDataFrame([(i, t, None) for i, (t, *_) in enumerate(rows)], SCHEMA)
    found = secrets.scan(docs).withColumn("fitted", secrets.is_fitted(F.col("candidate"))).collect()
    held = {(r.doc_id, r.candidate): r.is_secret for r in found if not r.fitted}
    truth = {(i, v): s for i, (_, v, s) in enumerate(rows)}
    assert {k for k, s in truth.items() if s} <= {(r.doc_id, r.candidate) for r in found}
    hit = sum(truth.get(k, False) for k, s in held.items() if s)
    assert hit / sum(held.values()) >= 0.9 and hit / sum(truth.get(k, False) for k in held) >= 0.9
    # Nothing tells of findings after neutral words, and of public forms after secret words two things; both are judged.
    untold = [(truth.get((r.doc_id, r.candidate), False), r.is_secret) for r in found if r.label is None]
    assert len(untold) > 300 and sum(a == b for a, b in untold) / len(untold) >= 0.9


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (None, 'token = "0123456789abcdef0123"', "x"), (2, "", None), (2, "AKIA" + "Q" * 15 + "7", None), (3, "word " * 100000, None)], SCHEMA)
    assert "label" in secrets.scan(docs).columns
    got = secrets.scan(docs).collect()
    assert {(r.doc_id, r.candidate) for r in got if r.is_secret} == {(None, "0123456789abcdef0123"), (2, "AKIA" + "Q" * 15 + "7")}
    assert secrets.scan(docs.limit(0)).count() == 0
    assert secrets.scan(docs.where("doc_id = 1")).count() == 0


def test_scan_after_an_observation(spark):
    """A session that has an Observation scans as any other does."""
    seen = Observation("rows before a scan")
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 5
    docs = spark.createDataFrame([(i, t, None) for i, (t, _) in enumerate(corpus(120, 3))], SCHEMA)
    assert secrets.scan(docs).where("is_secret").count() > 10


def test_candidates_before_candidates(spark):
    """A candidate that is the word before another is found too, and a value is found in both spellings."""
    keys = ["AKIA" + "".join(random.Random(k).choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16)) for k in range(8)]
    texts = ["keys:\n" + "\n".join(keys), "aws_access_key_id=" + keys[0] + "\naws_secret_access_key=" + keys[1] * 2, "password=abcd1234", 'password = "abcd1234"', "pwd=abcd1234", "pwd = abcd1234"]
    got = {}
    for r in secrets.candidates(spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], SCHEMA)).orderBy("place").collect():
        got.setdefault(r.doc_id, []).append((r.candidate, r.before))
    assert [c for c, _ in got[0]] == keys and got[0][1][1] == f"{keys[0]}\n"
    assert got[1] == [(keys[0], "aws_access_key_id="), (keys[1] * 2, f"{('aws_access_key_id=' + keys[0])[-40:]}\naws_secret_access_key=")]
    assert [[c for c, _ in got[i]] for i in range(2, 6)] == [["abcd1234"]] * 4
    assert all(b.startswith(("password", "pwd")) for i in range(2, 6) for _, b in got[i])
