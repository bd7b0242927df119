import random

from lakeshore.llm import lines

from tests.llm.skew import splits

SCHEMA = "doc_id long, text string, source string, h string"


def plain(rows, min_sites):
    sites, first = {}, {}
    trim = lambda x: x.strip(" \t\r\x0b\x0c")
    for doc, text, site in rows:
        for x in (text or "").split("\n"):
            if trim(x):
                sites.setdefault(trim(x), set()).update([site] if site is not None else [])
                first[trim(x)] = min((i for i in (first.get(trim(x)), doc) if i is not None), default=None)
    out = []
    for doc, text, site in rows:
        parts = (text or "").split("\n")
        left = [x for x in parts if not trim(x) or len(sites[trim(x)]) < min_sites or first[trim(x)] == doc]
        out.append((doc, None if text is None else "\n".join(left), len(parts) - len(left)))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(6)
    common = [f"All rights reserved {k}." for k in range(12)]
    rows = []
    for d in range(300):
        text = [f"line {rng.randrange(3000)}" for _ in range(rng.randint(1, 9))]
        text += [rng.choice(["", " ", "\t"]) + rng.choice(common[: rng.randint(1, 12)]) for _ in range(rng.randint(0, 3))]
        text += [""] * rng.randint(0, 2)
        rng.shuffle(text)
        rows.append((d, rng.choice(["\n", "\r\n"]).join(text), rng.choice([f"s{rng.randrange(25)}", "s0", None])))
    return [*rows, (None, common[0], "s1"), (None, "only\n" + common[0], "s1"), (400, None, "s1"), (401, "", "s2"), (3, rows[3][1], rows[3][2]), (402, (common[0] + "\n") * 50000, "s3")]


def test_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    for least in (2, 10, 14):
        got = lines.remove_boilerplate(docs, min_sites=least)
        assert got.columns == ["doc_id", "text", "source", "h", "_n_removed"]
        want = plain(rows, least)
        assert sorted(((r.doc_id, r.text, r._n_removed) for r in got.collect()), key=repr) == want
        assert sum(n for *_, n in want) > 100


def test_many_sites_and_exact_counts_near_the_threshold(spark):
    rows = [(k, f"everywhere\nnearly {k % 2}", f"site {k}") for k in range(0, 2000)]
    docs = spark.createDataFrame([(*r, None) for r in rows], SCHEMA)
    found = {r.n_sites for r in lines.boilerplate(docs, min_sites=1000).collect()}
    assert found == {None, 1000}
    assert {r.n_sites for r in lines.boilerplate(docs, min_sites=1001).collect()} == {None}


def test_empty_table(spark):
    assert lines.remove_boilerplate(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark, capsys):
    lines.remove_boilerplate(spark.createDataFrame(spark.createDataFrame([(1, "a", "b", "c")], SCHEMA).toPandas(), SCHEMA)).explain()
    plan = capsys.readouterr().out
    assert "MapInArrow" not in plan and "Python" not in plan and "HashAggregate" in plan


def test_rows_without_an_id_are_split(spark):
    docs = spark.range(30000).selectExpr("if(id % 3 = 0, id, null) AS doc_id", "concat('everywhere\n', id) AS text", "concat('s', id % 20) AS source", "'x' AS h")
    assert splits(spark, lambda: lines.remove_boilerplate(docs))
