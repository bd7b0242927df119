import random

from hypothesis import given, settings
from hypothesis import strategies as st
from lakeshore.llm import decontaminate

DOCS = "doc_id long, text string, item_id string, score string"
ITEMS = "item_id long, text string, doc_id string"


def plain_align(item, passage):
    a, b = item.lower().split(), passage.lower().split()
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h)) / max(1, 2 * len(a))


WORDS = st.lists(st.sampled_from("a b c d e".split()), max_size=14).map(" ".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(WORDS, WORDS), max_size=5))
def test_alignment(pairs):
    assert decontaminate.align(pairs).tolist() == [plain_align(*p) for p in pairs]


def corpus(seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(900)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(15, 50)))) for i in range(12)] + [(50, "tiny item"), (51, "")]
    docs, want = [], set()
    for d in range(160):
        body = rng.choices(words, k=rng.randint(30, 300))
        if d % 4 == 0:
            item, text = rng.choice(items[:12])
            text = text.split()
            for _ in range(len(text) // 10 if d % 8 else 0):
                text[rng.randrange(len(text))] = "edited"
            at = rng.randrange(len(body))
            body[at:at] = [w.upper() + "," for w in text]
            want.add((d, item))
        docs.append((d, " ".join(body)))
    return docs, items, want


def plain_leaks(docs, items, least=0.5):
    """Every item against every whole document."""
    clean = lambda x: x.lower().replace(",", "")
    return {(d, i): s for d, text in docs for i, item in items if item and (s := plain_align(item, clean(text))) >= least}


def test_against_all_pairs(spark):
    docs, items, want = corpus()
    small = [d for d in docs if len(d[1].split()) < 120][:30]
    frame = spark.createDataFrame([(d, t, "x", "y") for d, t in docs], DOCS)
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], ITEMS)
    for bits in (1 << 24, 1 << 15):  # the small set lets many n-grams pass that are no seeds
        got = {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(frame, bench, bits=bits).collect()}
        assert set(got) == want
        ids = {d for d, _ in small}
        assert {k: v for k, v in got.items() if k[0] in ids} == plain_leaks(small, items)
    kept = {r.doc_id for r in decontaminate.drop_leaking(frame, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_item_that_most_documents_hold(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    frame = spark.createDataFrame([(d, f"doc {d} {item if d % 3 else 'clean'} end", None, None) for d in range(60)], DOCS)
    bench = spark.createDataFrame([(1, item, None), (2, "some other item that nothing holds", None)], ITEMS)
    assert {r.doc_id for r in decontaminate.leaks(frame, bench).collect()} == {d for d in range(60) if d % 3}


def test_edges(spark):
    frame = spark.createDataFrame([(1, None, "x", "y"), (None, "tiny item", "x", "y"), (2, "", "x", "y"), (3, "a tiny item", "x", "y"), (3, "a tiny item", "x", "y"), (4, "pad " * 100000 + "tiny item", "x", "y")], DOCS)
    bench = spark.createDataFrame([(7, "Tiny, item!", None), (7, "Tiny, item!", None), (None, "pad pad", None), (8, None, None), (9, "...", None)], ITEMS)
    got = sorted((r.doc_id, r.item_id, r.score) for r in decontaminate.leaks(frame, bench).collect())
    assert got == [(3, 7, 1.0), (4, 7, 1.0)]
    assert decontaminate.leaks(frame.limit(0), bench).count() == 0
    assert decontaminate.leaks(frame, bench.limit(0)).count() == 0
    assert decontaminate.drop_leaking(frame, bench.limit(0)).count() == 6


def test_paraphrases(spark):
    """Copies with every fourth word another, with words left out or put in, and with a quarter edited at random: against all-pairs alignment."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(16, 60)))) for i in range(20)]
    docs = []
    for d in range(240):
        text = rng.choice(items)[1].split()
        kind = d % 4
        if kind == 0:
            at = rng.randrange(4)
            text = [f"e{rng.randrange(10**6)}" if k % 4 == at else w for k, w in enumerate(text)]
        elif kind == 1:
            text = [w for w in text if rng.random() > 0.15]
        elif kind == 2:
            text = [x for w in text for x in ([w, f"e{rng.randrange(10**6)}"] if rng.random() < 0.2 else [w])]
        else:
            text = [f"e{rng.randrange(10**6)}" if rng.random() < 0.25 else w for w in text]
        body = rng.choices(words, k=60)
        body[30:30] = text
        docs.append((d, " ".join(body)))
    want = set(plain_leaks(docs, items))
    frame = spark.createDataFrame([(d, t, None, None) for d, t in docs], DOCS)
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame, spark.createDataFrame([(i, t, None) for i, t in items], ITEMS)).collect()}
    assert got <= want and len(got) / len(want) > 0.99 and len(want) > 180
    assert all(len({d for d, _ in got if d % 4 == k}) / len({d for d, _ in want if d % 4 == k}) > 0.97 for k in range(4))
