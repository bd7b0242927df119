import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from lakeshore.llm import quality

SPACES = " \t\n\x0b\x0c\r"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def plain_kept(text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words):
    words = (text or "").encode().split()
    if n_words < 20 or 100 * n_repeat_words > 30 * n_words:
        return False
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    distinct, every = set(text.split()), text.split()
    return not (
        not 2 * n_words <= word_chars <= 15 * n_words
        or n_symbols / n_words > 0.1
        or n_dup_lines > 0.6 * len(lines)
        or sum(not any(c.isalpha() for c in w) for w in distinct) > 0.3 * len(distinct)
        or sum(c.isupper() for c in text) > 0.5 * sum(c.isalpha() for c in text)
        or sum(a == b for a, b in zip(words, words[1:])) > 0.3 * len(words)
        or max(every.count(w) for w in distinct) > 0.4 * len(every)
    )


def check(texts):
    got = quality.judge(texts, list(quality.RULES))
    backwards = quality.judge(texts, list(quality.RULES)[::-1])
    assert (got["kept"] == backwards["kept"]).all()
    for i, text in enumerate(texts):
        want = plain(text)
        assert tuple(int(got[k][i]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want, repr(text)
        assert got["kept"][i] == plain_kept(text, *want), repr(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab É#|\n\t\r\x0b\x1c\x85  ."), max_size=120)), max_size=5))
def test_any_text(texts):
    check(texts)


def test_prose_and_junk(spark, sf):
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["one", "two", "Three", "vier", "5", "###", "SIX"], weights=[rng.random() for _ in range(7)], k=rng.randint(1, 90))) for _ in range(150)]
    check([*texts, *(x + "\n" + x for x in texts[:40]), *("word " * k for k in range(7, 30)), None, ""])
    check([r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect() if len(r.text) < 9000])


def test_order_is_rejection_per_cost():
    import time

    def slow(texts, m):
        time.sleep(0.05)
        return np.ones(len(texts), bool)

    def nothing(texts, m):
        return np.zeros(len(texts), bool)

    def quick(texts, m):
        return np.arange(len(texts)) % 2 == 0

    assert quality.cascade_order([" ".join(f"w{i}" for i in range(30))] * 100, {"slow": slow, "nothing": nothing, "quick": quick}) == ["quick", "slow", "nothing"]


def test_order_comes_from_texts_that_pass_the_base_rule():
    """A rule that rejects only what the base rule has rejected gains nothing, however much of the sample that is."""
    short, good = ["one two"] * 90, [" ".join(f"w{k}x{i}" for i in range(30)) for k in range(10)]
    seen = []

    def shorts(texts, m):
        seen.append(len(texts))
        return m["n_words"] < 5

    def few(texts, m):
        return np.array([x.startswith("w3") for x in texts], bool)

    assert quality.cascade_order(short + good, {"shorts": shorts, "few": few}) == ["few", "shorts"]
    assert max(seen) == 10


def test_documents(spark):
    long = "alpha beta gamma delta epsilon " * 60000
    docs = spark.createDataFrame([(1, None, "x"), (None, "", "x"), (2, long, "x"), (2, "q", None)], "doc_id long, text string, kept string")
    got = {(r.doc_id, r.n_words): (r.base_failed, r.kept) for r in quality.assess(docs).collect()}
    assert got == {(1, 0): (True, False), (None, 0): (True, False), (2, 300000): (True, False), (2, 1): (True, False)}
    assert quality.assess(docs.limit(0)).count() == 0
