import hashlib
import random
import zlib

from lakeshore.llm import merkle
from lakeshore.llm.common import lowered
from pyspark.sql import functions as F

from tests.llm.skew import splits

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g string, at long, digest string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text=None):
    return digest("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in [*row[:4], text or row[4]]))


def reduced(nodes):
    """(root, path of each node) of a list of digests, level by level."""
    paths = [[] for _ in nodes]
    below = [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        runs = [list(range(k, min(k + 16, len(nodes)))) for k in range(0, len(nodes), 16)]
        for run in runs:
            for k in run:
                step = ("".join(nodes[j] for j in run if j < k), "".join(nodes[j] for j in run if j > k))
                for leaf_at in below[k]:
                    paths[leaf_at].append(step)
        below = [[x for k in run for x in below[k]] for run in runs]
        nodes = [digest("".join(nodes[k] for k in run)) for run in runs]
    return nodes[0], paths


def plain(rows):
    """(doc_id, leaf, subroot, root, siblings, folded root) of each row, in one process."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((own, *reduced([leaf(r) for r in own])))
    root, tops = reduced([t[1] for t in trees])
    out = []
    for (own, subroot, paths), top in zip(trees, tops):
        for r, path in zip(own, paths):
            path = path + top
            at = leaf(r, r[4].translate(LOWER) if r[4] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else None)
            for left, right in path:
                at = digest(left + at + right)
            out.append((r[0], leaf(r), subroot, root, digest("".join(a + b for a, b in path)), at))
    return sorted(out, key=repr)


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def found(spark, rows):
    docs = spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA)
    fields = [F.col(c) for c in merkle.FIELDS]
    altered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, merkle.leaf(*fields[:-1], lowered(fields[-1])))
    got = merkle.manifest(docs, altered=altered)
    at = merkle.folded(F.coalesce("altered", "leaf"), F.col("path"))
    return sorted(map(tuple, got.select("doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("path")), at).collect()), key=repr)


def corpus(sizes, seed=3):
    """Rows of sources of the given sizes, ids close together and far apart, negative ones too."""
    rng = random.Random(seed)
    rows, ids = [], rng.sample(range(-3000, 3000), sum(sizes))
    for k, n in enumerate(sizes):
        name = None if k == 0 else rng.choice(["src", "Źródło", "", "z\U0001f600", "\uffee"]) + str(k)
        for _ in range(n):
            i = ids.pop() if k % 2 else ids.pop() * 2**rng.choice([0, 8, 40, 50])
            text = rng.choice([None, "", "Ab Ż", "only lower", f"Text {i}"])
            rows.append((i, name, rng.choice([None, "en", "pl"]), rng.choice([None, len(text or "")]), text))
    return rows


def test_against_brute_force(spark):
    rows = corpus([3, 1, 16, 17, 257, 700, *[2] * 14])
    got = found(spark, rows)
    assert got == plain(rows)
    # Where nothing was tampered with, the path leads to the root.
    assert 0 < sum(r[5] != r[3] for r in got) < len(got) / 4


def test_repeated_and_null_ids(spark):
    rows = corpus([5, 40, 300], 4)
    rows += [rows[7]] * 5 + [(rows[50][0], rows[50][1], "xx", k % 9, "other") for k in range(40)]
    rows += [(None, rows[50][1], None, None, f"no id {k % 20}") for k in range(50)] + [(None, None, None, None, None)]
    assert found(spark, rows) == plain(rows)


def test_few_rows(spark):
    one = [(1, "a", "en", 3, "ABC")]
    (got,) = found(spark, one)
    assert got[1] == got[2] == got[3] and got[4] == digest("")
    assert found(spark, []) == []
    two = [*one, (2, None, "en", 3, "abc")]
    assert found(spark, two) == plain(two)


def test_more_than_one_pass(spark):
    """70,000 leaves of one source take three passes; the root is the same in one process."""
    n = 70_000
    docs = spark.range(n).selectExpr("id * 3 AS doc_id", "'one' AS source", "'en' AS lang", "id AS n_chars", "concat('t', id) AS text")
    got = merkle.manifest(docs).where("doc_id % 6999 = 0").select("doc_id", "root", merkle.folded(F.col("leaf"), F.col("path")).alias("at"), F.size("path").alias("levels")).collect()
    nodes = [leaf((3 * k, "one", "en", k, f"t{k}")) for k in range(n)]
    while len(nodes) > 1:
        nodes = [digest("".join(nodes[k : k + 16])) for k in range(0, len(nodes), 16)]
    assert len(got) == 31 and {(r.root, r["at"], r.levels) for r in got} == {(nodes[0], nodes[0], 5)}


def test_no_window_holds_more_than_a_directory_row(spark):
    """The ids of a group are ranked by words of 64; two billion apart or next to each other makes no difference."""
    docs = spark.range(5000).selectExpr("'g' AS g", "if(id % 2 = 0, id, id * 2000000000) AS doc_id", "cast(id AS string) AS leaf", "cast(null AS string) AS altered")
    got = {r.doc_id: r["at"] for r in merkle.ranked(docs).collect()}
    assert got == {i: k for k, i in enumerate(sorted(got))}


def test_a_source_of_most_rows_is_split(spark):
    docs = spark.range(30000).selectExpr("id AS doc_id", "if(id % 3 = 0, concat('s', id % 50), 'most') AS source", "'en' AS lang", "id AS n_chars", "'text' AS text")
    leaves = docs.selectExpr("source AS g", "doc_id", "sha2(cast(doc_id AS string), 256) AS digest", "cast(null AS string) AS altered", "doc_id AS at")
    sizes = leaves.groupBy("g").agg(F.count("*").alias("n"))
    assert splits(spark, lambda: merkle._passed(merkle.with_sizes(leaves, sizes), "doc_id", "altered"))
