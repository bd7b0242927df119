import random

from hypothesis import given
from hypothesis import strategies as st
from lakeshore.llm import sentence_spans as ss

SCHEMA = "doc_id long, text string, first string, _version string"


@given(st.text(st.sampled_from("ab .!?\n\t é"), max_size=60))
def test_sentences_are_the_text(text):
    assert "".join(ss.sentences(text)) == text
    assert all(ss.sentences(text))


def plain(rows):
    """Brute force: every span of every document against all before it."""
    rows = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = {}, {}
    for doc, text in rows:
        parts, gone = ss.sentences(text or ""), set()
        words = [x.split() for x in parts]
        full = [i for i, w in enumerate(words) if w]
        for k in range(len(full)):
            ends = [z for z in range(k + 3, min(len(full), k + 30) + 1) if sum(len(words[i]) for i in full[k:z]) >= 25]  # 25 sentences have 25 words
            if not ends and len(full) - k >= 3 and (k == 0 or sum(len(words[i]) for i in full[k:]) >= 12):
                ends = [len(full)]
            for z in ends[:1]:
                key = tuple(" ".join(words[j]) for j in full[k:z])
                if seen.setdefault(key, (doc, full[k])) != (doc, full[k]):
                    gone |= set(range(full[k], full[z - 1] + 1))
        out[doc, text] = (None if text is None else "".join(x for j, x in enumerate(parts) if j not in gone), len(gone))
    return out


def corpus():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(200)]
    sentence = lambda: " ".join(rng.choices(words, k=rng.randint(1, 25))) + rng.choice([".", "!", "?", ""]) + rng.choice([" ", "\n", "  \n"])
    shared = ["".join(sentence() for _ in range(6)) for _ in range(5)]
    rows = []
    for d in range(80):
        parts = [sentence() for _ in range(rng.randint(1, 12))]
        if d % 3:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
        rows.append((d, "".join(parts)))
    return [*rows, (200, rows[3][1]), (201, rows[3][1]), (202, None), (203, ""), (None, shared[0]), (204, "Yes. " * 3000 + "A " * 15 + ". " + "A " * 15 + "."), (205, "One. Two. Three."), (206, "One.\n\nTwo. Three.  "), (207, "One. Two.")]


def test_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "clash", "clash") for d, t in [*rows, rows[5]]], SCHEMA)
    got = ss.remove_repeats(docs)
    assert got.columns == ["doc_id", "text", "first", "_version", "_n_removed"]
    want = plain(rows)
    expect = sorted(((d, *want[d, t]) for d, t in [*rows, rows[5]]), key=repr)
    assert sorted(((r.doc_id, r.text, r._n_removed) for r in got.collect()), key=repr) == expect
    assert sum(n for _, _, n in expect) > 100


def test_long_passages_go_and_clean_text_stays(spark):
    rng = random.Random(2)
    clean = lambda: " ".join(" ".join(rng.choices([f"v{i}" for i in range(5000)], k=9)) + "." for _ in range(8))
    passage = " ".join(" ".join(rng.choices([f"p{i}" for i in range(500)], k=9)) + "." for _ in range(7))
    rows = [(d, f"{clean()} {passage} {clean()}" if d % 2 else clean()) for d in range(20)]
    got = {r.doc_id: (r._n_removed, r.text) for r in ss.remove_repeats(spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)).collect()}
    for d, text in rows:
        assert got[d][0] == (7 if d % 2 and d > 1 else 0)
        assert (passage[:40] in got[d][1]) == (d == 1)


def test_empty_table(spark):
    assert ss.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_passages_of_short_sentences_and_of_glued_ones_go(spark):
    """Twelve lines of five words; and four sentences of which the first is glued to the text before it."""
    rng = random.Random(4)
    of = lambda n, k: " ".join(f"{k}{rng.randrange(10**6)}" for _ in range(n))
    lines = "\n".join(of(5, "l") for _ in range(12))
    glued = " ".join(of(15, "g") + "." for _ in range(4))
    rows = [(d, f"{of(9, 'a')}.\n{lines}\n{of(9, 'b')}." if d < 5 else f"{of(9, 'a')} {glued} {of(9, 'b')}.") for d in range(10)]
    got = {r.doc_id: r._n_removed for r in ss.remove_repeats(spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)).collect()}
    assert got == {d: 0 if d in (0, 5) else 12 if d < 5 else 3 for d in range(10)}


def test_a_passage_at_the_end_goes(spark):
    """Two texts with beginnings of their own and the same last three sentences, of 24 words: shorter than a run elsewhere."""
    rng = random.Random(6)
    of = lambda n, k: " ".join(f"{k}{rng.randrange(10**6)}" for _ in range(n)) + "."
    tail = " ".join(of(8, "t") for _ in range(3))
    short = " ".join(of(2, "s") for _ in range(3))
    rows = [(d, " ".join([of(9, "a"), of(12, "b"), of(7, "c"), tail if d < 2 else short])) for d in range(4)]
    got = {r.doc_id: (r._n_removed, r.text) for r in ss.remove_repeats(spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)).collect()}
    assert got == {0: (0, rows[0][1]), 1: (3, rows[1][1].removesuffix(tail)), 2: (0, rows[2][1]), 3: (0, rows[3][1])}


def test_a_run_of_many_places_is_split(spark):
    from tests.llm.skew import splits

    docs = spark.range(30000).selectExpr("id AS doc_id", "concat('Alpha beta gamma delta one two three four five. Six seven eight nine ten eleven twelve. Thirteen to the end of nine more words here. ', 'Own', id, '.') AS text")
    assert splits(spark, lambda: ss.repeated_spans(docs))


@given(*[st.lists(st.sampled_from(["a", "b", "c."]), max_size=12)] * 4, st.lists(st.sampled_from(["a", "b", "c."]), min_size=7, max_size=20))
def test_texts_with_a_common_passage_have_a_common_word_run(a, b, c, d, passage):
    of = lambda *x: {h for h, _, _ in ss.word_runs(" ".join(w for y in x for w in y), 7)}
    assert of(passage) and of(passage) <= of(a, passage, b) & of(c, passage, d)


def test_passages_inside_sentences_go(spark):
    """Copies of 51 words and more with two, one and no whole sentences go; 25 words that are copied and all other words stay."""
    rng = random.Random(8)
    of = lambda n, k: [f"{k}{rng.randrange(10**9)}" for _ in range(n)]
    two, one = of(70, "p"), of(51, "q")
    two[9] += "."
    two[30] += "\n"
    two[55] += "?"
    one[20] += "."
    one[33] += "."
    passages = [two, one, of(120, "r"), of(51, "s"), of(25, "t")]
    rows, own = [], {}
    for d in range(20):
        a, b = of(40, "a"), of(40, "b")
        a[20], b[20] = f"{a[20]}.", f"{b[20]}!"
        rows.append((d, " ".join([*a, *passages[d % 5], *b])))
        own[d] = [*a, *b]
    docs = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    got = {r.doc_id: (r._n_removed, r.text) for r in ss.remove_repeats(docs, passage=51).collect()}
    for d, text in rows:
        n, left = got[d]
        passage = " ".join(passages[d % 5]).split()
        if d < 5 or d % 5 == 4:
            assert (n, left) == (0, text)
        else:
            words = left.split()
            first, last = (words.index(x) for x in (own[d][39], own[d][40]))
            stays = words[first + 1 : last]
            assert words[: first + 1] + words[last:] == own[d]
            ends = next(k for k in range(len(stays) + 1) if stays == passage[:k] + passage[len(passage) - len(stays) + k :])
            assert n >= 1 and ends < 26 and len(stays) - ends < 26
