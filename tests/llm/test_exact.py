import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from lakeshore.llm import exact
from pyspark.sql import functions as F

from tests.llm.skew import splits

SCHEMA = "doc_id long, text string, _full string, kept string, group_size long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    """(doc_id, keep_id, group_size, text_sha256) of each row, by a dictionary of whole texts."""
    of = {}
    for doc, text in rows:
        of.setdefault((text or "").translate(LOWER), []).append(doc)
    out = []
    for doc, text in rows:
        t = (text or "").translate(LOWER)
        ids = [x for x in of[t] if x is not None]
        out.append((doc, max(ids) if ids else None, len(of[t]), hashlib.sha256(t.encode()).hexdigest()))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "clash", "clash", 7) for d, t in rows], SCHEMA)


def rows():
    rng = random.Random(5)
    words = ["Straße", "İstanbul", "ÉTÉ", "one", "Two", "ǅ", "K", "\u0000", "日本"]
    text = lambda: " ".join(rng.choices(words, k=rng.randint(0, 6)))
    same = [text() for _ in range(20)]
    out = [(d, rng.choice([text(), rng.choice(same), rng.choice(same).swapcase(), rng.choice(same).upper()])) for d in rng.sample(range(10**6), 300)]
    # Equal lengths and prefixes with different ends, and different prefixes of one length.
    long = "x" * 5000
    out += [(2000000 + k, long + end) for k, end in enumerate(["a", "A", "b", "c", "B"])] + [(2000010 + k, f"{k % 2}{long}") for k in range(5)]
    return out + [(None, None), (None, ""), (3000000, ""), (3000001, None), (3000002, " "), (None, "alone"), (-5, "two"), (-6, "TWO"), (None, "pair"), (None, "PAIR")]


def test_against_brute_force(spark):
    got = exact.groups(frame(spark, rows()), digests=True).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == sorted(plain(rows()), key=repr)
    by = {}
    for r in got:
        by.setdefault(r.text_sha256, []).append(r)
    for own in by.values():
        (stays,) = [r for r in own if r.kept]
        assert stays.doc_id == stays.keep_id and all(r.keep_id == stays.doc_id for r in own)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.text(st.sampled_from("aAbBéÉß "), max_size=3))), max_size=25))
def test_any_rows(spark, some):
    got = exact.groups(frame(spark, some), digests=True, prefix=1).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == sorted(plain(some), key=repr)
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})


def test_only_surviving_groups_are_hashed(spark):
    got = exact.groups(frame(spark, [(1, "abc"), (2, "abd"), (3, "abcd"), (4, "ABC"), (5, "x" * 300 + "1"), (6, "x" * 300 + "2")]))
    assert {r.doc_id for r in got.collect() if r.text_sha256} == {1, 4, 5, 6}


def test_rows_that_stay_keep_their_columns(spark):
    docs = frame(spark, [(1, "Same"), (1, "same"), (2, "other"), (None, "third"), (0, "SAME")])
    got = exact.remove_duplicates(docs)
    assert got.columns == docs.columns
    kept = sorted(map(tuple, got.collect()), key=repr)
    assert [k[0] for k in kept] == [1, 2, None] and all(k[2:] == ("clash", "clash", 7) for k in kept)


def test_empty_table(spark):
    assert exact.groups(frame(spark, [])).count() == 0 and exact.remove_duplicates(frame(spark, [])).count() == 0


def test_a_large_group_is_split(spark):
    docs = spark.range(30000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("own "), F.col("id"))).otherwise("one text of most documents").alias("text"))
    assert splits(spark, lambda: exact.groups(docs))
