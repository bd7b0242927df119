import datetime
import hashlib
import random
import re

from lakeshore.llm import pii
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, _parts string"
KEY = "k"


def plain_round(kind, r, value):
    return int(hashlib.sha256(f"{KEY}|{kind}|{r}|{value}".encode()).hexdigest()[:15], 16)


def plain_feistel(kind, a, b, size_a, size_b):
    for r in range(8):
        if r % 2 == 0:
            a = (a + plain_round(kind, r, b)) % size_a
        else:
            b = (b + plain_round(kind, r, a)) % size_b
    return a, b


def plain_digits(kind, d):
    k = len(d) // 2
    a, b = plain_feistel(kind, int(d[:k] or 0), int(d[k:]), 10**k, 10 ** (len(d) - k))
    return (str(a).zfill(k) if k else "") + str(b).zfill(len(d) - k)


def luhn(d):
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10


def plain_card(x):
    d = re.sub(r"\D", "", x)
    body = d[0] + plain_digits("card", d[1:-1])
    d = iter(body + str(-luhn(body + "0") % 10))
    return re.sub(r"\d", lambda _: next(d), x)


def plain_ip(x):
    o = list(map(int, x.split(".")))
    a, b = plain_feistel("ip", o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536)
    return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"


def masked(spark, *texts):
    rows = pii.pseudonymize(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA).select("doc_id", "text"), KEY).orderBy("doc_id").collect()
    return [(r.text, [(m.kind, m.value, m.pseudonym) for m in r._pii]) for r in rows]


def test_kinds_and_formats(spark):
    text = "Mail Jo.Doe+x@mail.example.com, call +1 (743) 555-3824 or +44 20 7946 0958; card 4539 1488 0343 6467\nfrom 227.5.221.1 born 1984-02-29 and 31.12.1999, ssn 123-45-6789."
    (out, found), = masked(spark, text)
    assert [k for k, *_ in found] == ["email", "phone", "phone", "card", "ip", "date", "date", "ssn"]
    values = {k + v[:3]: p for k, v, p in found}
    assert values["card453"] == plain_card("4539 1488 0343 6467") and luhn(re.sub(r"\D", "", values["card453"])) == 0
    assert values["ip227"] == plain_ip("227.5.221.1")
    assert re.fullmatch(r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}", values["phone+1 "]) and values["phone+44"].startswith("+44 2")
    datetime.date.fromisoformat(values["date198"])
    datetime.datetime.strptime(values["date31."], "%d.%m.%Y")
    assert re.fullmatch(r"\d{3}-\d{2}-\d{4}", values["ssn123"])
    expected = text
    for _, v, p in found:
        assert v != p
        expected = expected.replace(v, p)
    assert out == expected


def mod97(x):
    return int("".join(str(int(c, 36)) for c in x)) % 97


def test_ibans(spark):
    texts = ["pay DE89 3704 0044 0532 0130 00 now", "GB82WEST12345698765432", "DE88370400440532013000", "FR1420041010050500013M02606"]
    got = masked(spark, *texts)
    assert [[k for k, *_ in found] for _, found in got] == [["iban"], ["iban"], [], ["iban"]]
    for text, found in got:
        for _, old, new in found:
            bare = new.replace(" ", "")
            assert mod97(bare[4:] + bare[:4]) == 1 and new != old and new in text
            assert [c.isdigit() for c in new] == [c.isdigit() for c in old] and new[:2] == old[:2]


def test_invalid_values_stay(spark):
    text = "4539148803436468 300.1.1.1 1999-02-30 666-12-3456 000-12-3456 v1.2.3.4.5 12345 a@b 1234567890123456789012 x@y"
    assert masked(spark, text, None, "", "no digits") == [(text, []), (None, []), ("", []), ("no digits", [])]


def test_equal_values_stay_linked_and_others_differ(spark):
    rng = random.Random(1)
    cards = []
    while len(cards) < 300:
        d = "4" + "".join(rng.choices("0123456789", k=14))
        cards.append(d + str(-luhn(d + "0") % 10))
    got = masked(spark, *[f"a {c} b" for c in cards], f"again {cards[0]}")
    new = [f[0][2] for _, f in got]
    assert new[-1] == new[0] and len(set(new[:-1])) == len(set(cards)) and new[:-1] == list(map(plain_card, cards))


def test_permutations_are_one_to_one(spark):
    pairs = spark.range(35).select(pii.feistel(KEY, "t", F.floor(F.col("id") / 7), F.col("id") % 7, 5, 7).alias("s"))
    assert pairs.distinct().count() == 35
    assert spark.range(1000).select(pii.permuted_digits(KEY, "t", F.lpad(F.col("id").cast("string"), 3, "0")).alias("d")).distinct().count() == 1000
    days = spark.range(146097).select(F.date_format(F.expr("date_add(date'1800-01-01', cast(id as int))"), "yyyy-MM-dd").alias("d"))
    assert days.select(pii._date(KEY, F.col("d")).alias("d")).distinct().count() == 146097


def test_documents(spark, sf):
    """Pieces between values are unchanged, found values are gone, and the key decides."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    kinds = set()
    for r in pii.pseudonymize(docs, KEY).collect():
        rest, out = before[r.doc_id], ""
        for m in r._pii:
            kinds.add(m.kind)
            head, value, rest = rest.partition(m.value)
            out += head + m.pseudonym
            assert value
        assert out + rest == r.text
    assert {"email", "card", "ip", "phone"} <= kinds
    other = pii.pseudonymize(docs, "other").where(F.size("_pii") > 0).select("doc_id", F.col("text").alias("t"))
    assert pii.pseudonymize(docs, KEY).join(other, "doc_id").where("text = t").count() == 0


def test_edges(spark):
    long = "x 227.5.221.1 y " * 20000
    rows = spark.createDataFrame([(None, long, "x"), (None, long, "y"), (2, None, None)], SCHEMA)
    got = pii.pseudonymize(rows, KEY)
    assert got.columns == ["doc_id", "text", "_parts", "_pii"]
    assert sorted((len(r._pii), (r.text or "").count(plain_ip("227.5.221.1"))) for r in got.collect()) == [(0, 0), (20000, 20000), (20000, 20000)]
    assert pii.pseudonymize(rows.limit(0), KEY).count() == 0


def test_cards_among_other_numbers(spark):
    card, bare = "4111 1111 1111 1111", "4111111111111111"
    texts = [f"{card} 12/25", f"{bare} 123", f"{bare} 078-05-1120", f"no 12 {card}", f"{bare} 123 {bare} 456 {card}", f"{card} 12 or 3782-822463-10005 99 a\ue000"]
    got = masked(spark, *texts)
    assert [[v for k, v, _ in found if k == "card"] for _, found in got] == [[card], [bare], [bare], [card], [bare, bare, card], [card, "3782-822463-10005"]]
    assert [v for k, v, _ in got[2][1] if k == "ssn"] == ["078-05-1120"]
    for text, (out, found) in zip(texts, got):
        for _, v, p in found:
            text = text.replace(v, p)
        assert out == text and card not in out and bare not in out


def iban(rng, country, n):
    """A valid number of a country: its check digits are the remainder of its letters and digits read as a number."""
    rest = "".join(rng.choices("0123456789", k=n))
    digits = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{country}{98 - int(digits) % 97:02d}{rest}"


def planted(rng):
    """(text, kind or None): a value that is valid by its construction, or one that breaks its kind's rule in one place."""
    digits = lambda k: "".join(rng.choices("0123456789", k=k))
    day = datetime.date(1900, 1, 1) + datetime.timedelta(rng.randrange(70000))
    number = "4" + digits(14)
    check = str(-luhn(number + "0") % 10)
    spaced = lambda d: rng.choice([d, " ".join(d[i : i + 4] for i in range(0, 16, 4)), "-".join(d[i : i + 4] for i in range(0, 16, 4))])
    account = iban(rng, *rng.choice([("DE", 18), ("PL", 24), ("ES", 20)]))
    wrong = account[:2] + f"{(int(account[2:4]) + rng.randint(1, 9)) % 100:02d}" + account[4:]
    area = rng.choice([k for k in range(1, 900) if k != 666])
    return rng.choice([
        (f"{day:%Y-%m-%d}", "date"), (f"{day:%d.%m.%Y}", "date"), (f"{day.year}-13-01", None), (f"{2001 + 4 * rng.randrange(5)}-02-29", None), (f"31.04.{day.year}", None),
        (spaced(number + check), "card"), (spaced(number + str((int(check) + rng.randint(1, 9)) % 10)), None),
        (account, "iban"), (wrong, None),
        (f"{area:03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}", "ssn"), (f"{rng.choice([0, 666, 950]):03d}-12-3456", None), (f"{area:03d}-00-3456", None), (f"{area:03d}-12-0000", None),
        (".".join(str(rng.randint(1, 255)) for _ in range(4)), "ip"), (f"{rng.randint(256, 999)}.{rng.randint(1, 255)}.1.2", None),
        (f"{rng.choice(['ann', 'j.doe', 'x_y+z'])}@{rng.choice(['mail', 'post-box'])}.example.{rng.choice(['com', 'org'])}", "email"), ("ann@mail", None), ("@example.com", None),
        (f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{digits(4)}", "phone"), (f"+49 30 {digits(6)}", "phone"), (f"{digits(3)}-{digits(3)}", None),
    ])


def test_detection_of_planted_values(spark):
    """What is found is what was put in, by rules that make the values, not by patterns that find them."""
    rng = random.Random(11)
    words = "the reader of page 12 would call Section A4 quite 3.5 times (or more) than in 1999 before".split()
    texts, want = [], []
    for _ in range(300):
        parts, own = [], []
        for _ in range(rng.randint(1, 6)):
            value, kind = planted(rng)
            parts += [*rng.choices(words, k=rng.randint(1, 5)), "so", value + rng.choice(["", ",", ";", " and"]), "then"]
            own += [(kind, value)] * bool(kind)
        texts.append(" ".join(parts))
        want.append(own)
    got = [[(k, v) for k, v, _ in found] for _, found in masked(spark, *texts)]
    wrong = [(t, w, g) for t, w, g in zip(texts, want, got) if w != g]
    assert not wrong, wrong[0]
