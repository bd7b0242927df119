import random

import numpy as np
import xxhash
from lakeshore.llm import simhash

from tests.llm.skew import splits

SCHEMA = "doc_id long, text string, fp string"


def plain_fingerprint(text):
    words = [w for w in (text or "").replace("\n", " ").replace("\t", " ").split(" ") if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_components(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    at = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fps[i] ^ fps[j]).bit_count() <= 4 and at[j] < at[i]:
                    at[i], changed = at[j], True
    groups = {}
    for (doc, _), g in zip(rows, at):
        groups.setdefault(g, []).append(doc)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return sorted(((d, f, least[g]) for (d, _), f, g in zip(rows, fps, at)), key=str)


def corpus():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdeÄéß", k=rng.randint(1, 6))) for _ in range(300)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 200)))) for i in range(60)]
    for i in range(60, 160):
        words = rng.choice(rows[:60])[1].split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    return [*rows, (160, None), (161, ""), (162, " \n"), (None, "one two"), (163, "ONE two"), (7, rows[7][1]), (164, "x " * 60000)]


def test_against_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "clash") for d, t in rows], SCHEMA)
    got = [(r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.components(docs, tile=8).collect()]
    assert sorted(got, key=str) == plain_components(rows)


def test_a_component_of_many_fingerprints_is_split(spark):
    """The component is made from links, as if two thirds of the fingerprints were in one."""
    groups = spark.range(30000).selectExpr("id AS fp", "id AS first_id", "if(id % 3 = 0, id, 1L) AS root")
    assert splits(spark, lambda: simhash.by_root(groups))


def test_empty_table(spark):
    assert simhash.components(spark.createDataFrame([], SCHEMA)).count() == 0
    assert simhash.keep_one(spark.createDataFrame([], SCHEMA)).columns == ["doc_id", "text", "fp"]


def test_keep_one(spark):
    docs = spark.createDataFrame([(3, "a b c", "x"), (1, "a b c", "y"), (2, "q r s t", None), (None, "a b c", "z")], SCHEMA)
    assert sorted((r.doc_id or 0, r.fp or "") for r in simhash.keep_one(docs).collect()) == [(0, "z"), (1, "y"), (2, "")]


def test_forest_links_what_all_pairs_link():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    x = np.unique(np.concatenate([base, *(base ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for _ in range(20))]))
    rng.shuffle(x)
    for cut in (len(x), 300):
        u, v = simhash.forest(x[:cut, None], x[cut:, None] if cut < len(x) else None, block=16)
        label = list(range(len(x)))

        def root(f):
            while label[f] != f:
                f = label[f]
            return f

        for a, b in zip(u.tolist(), v.tolist()):
            label[root(a)] = root(b)
        assert len(u) < len(x)
        for a in range(len(x)):
            for b in range(len(x)):
                if (int(x[a]) ^ int(x[b])).bit_count() <= 4 and (a < cut) != (b < cut) | (cut == len(x)):
                    assert root(a) == root(b)


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_similar_texts_are_grouped(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(60, 300)))) for i in range(120)]
    for i in range(120, 360):
        origin = rng.randrange(120)
        text = rows[origin][1].split()
        for _ in range(max(1, len(text) // 60)):
            text[rng.randrange(len(text))] = "changed"
        rows.append((i, " ".join(text)))
    groups = {r.doc_id: r.component_id for r in simhash.similar(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), tile=64).collect()}
    wrong = near = 0
    for i, a in rows:
        for j, b in rows[:120]:
            shared = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
            near += i != j and shared >= 0.8
            wrong += shared >= 0.85 and groups[i] != groups[j]
            assert shared > 0.3 or groups[i] != groups[j]
    assert near > 100 and wrong <= 2


def edited(rng, text, n):
    """The text with n words replaced, each in five shingles of its own."""
    words = text.split()
    for k in rng.sample(range(1, len(words) // 10), n):
        words[10 * k] = f"edit{rng.random()}"
    return " ".join(words)


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def test_pairs_just_above_and_below_the_threshold(spark):
    """Of 204 words (200 shingles), four edits leave 0.82 of the shingles and five 0.78; no pair between is missed or made."""
    rng = random.Random(3)
    rows = []
    for i in range(0, 400, 2):
        text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(204))
        rows += [(i, text), (i + 1, edited(rng, text, 4 + i // 2 % 2))]
    got = {r.doc_id: r.component_id for r in simhash.similar(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()}
    assert [got[i + 1] == i for i in range(0, 400, 2)] == [jaccard(rows[i][1], rows[i + 1][1]) >= 0.8 for i in range(0, 400, 2)]


def test_groups_of_many_chunks_are_those_of_all_pairs(spark):
    rng = random.Random(4)
    first = " ".join(f"w{rng.randrange(10**6)}" for _ in range(204))
    texts = [first]
    for _ in range(99):
        texts.append(edited(rng, rng.choice([first, texts[-1], rng.choice(texts)]), rng.randint(1, 5)))
    label, near = list(range(100)), [[j for j in range(100) if jaccard(a, texts[j]) >= 0.8] for a in texts]
    for _ in range(100):
        label = [min(label[j] for j in own) for own in near]
    got = simhash.similar(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA), chunk=4).collect()
    assert len(set(label)) > 3 and {r.doc_id: r.component_id for r in got} == dict(enumerate(label))


def test_a_repeated_line_counts_once(spark):
    rng = random.Random(6)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    loop = " ".join([words(10)] * 30)
    one, other = words(100), words(100)
    texts = [f"{one} {loop}", f"{other} {loop}", one]
    got = {r.doc_id: r.component_id for r in simhash.similar(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA)).collect()}
    assert jaccard(one, texts[0]) >= 0.8 > jaccard(texts[0], texts[1]) and got == {0: 0, 1: 1, 2: 0}
