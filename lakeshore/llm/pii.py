"""Personal data: validated values become format-preserving Feistel pseudonyms. DataFrame functions only.

Equal values get equal pseudonyms in all documents, different values of a kind different ones; without the key
neither can be told from the other. E-mail addresses, which have no numeric format, get a keyed name instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

ROUNDS = 8
KINDS = ("email", "iban", "date", "ssn", "ip", "card", "phone")

# One pattern finds candidates of all kinds; each is then validated.
_EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
_ISO, _DAY_FIRST = r"\d{4}-\d{2}-\d{2}", r"\d{2}[./]\d{2}[./]\d{4}"
_SSN = r"\d{3}-\d{2}-\d{4}"
_IP = r"\d{1,3}(?:\.\d{1,3}){3}"
_CARD = r"\d(?:[ -]?\d){12,18}"
_NANP = r"(?:\+?1[ .-]?)?(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[ .-])[2-9]\d{2}[ .-]?\d{4}"
_PHONE = r"\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,5}"
# What a candidate starts with; words of letters alone are passed by at once.
_START = r"(?=[0-9+(]|[A-Z]{2}[0-9]|[A-Za-z._%-][A-Za-z0-9._%+-]*+@)"
PATTERN = rf"(?<![\p{{L}}\p{{N}}_@.+%-]){_START}(?:{_EMAIL}|{_IBAN}|{_ISO}|{_DAY_FIRST}|{_SSN}|{_IP}|{_CARD}|{_NANP}|{_PHONE})(?![\p{{L}}\p{{N}}_@])(?!\.\p{{N}})"

# Forms that a card has within a longer row of digit groups, each with all places where it starts.
_CARD_FORMS = [rf"(?<![0-9])(?=({x})(?![0-9]))" for x in (r"\d{4}(?:[ -]\d{4}){3}", r"\d{4}[ -]\d{6}[ -]\d{4,5}", r"\d{13,19}", r"\d{4}(?:[ -]\d{4}){3}[ -]\d{1,3}")]
# Stands around cards while a text is cut: private characters, which no pattern takes for part of a value.
_MARK = "\ue000\ue001\ue002"

# Days of 400 years, 189 times 773; the first is 1800-01-01.
_EPOCH = (189, 773)


def _with(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with the value computed once; an expression that a function over an array names is computed again for each element."""
    return F.transform(F.array(value), f)[0]


def _round(key: str, kind: str, r: Column, value: Column) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(key: str, kind: str, a: Column, b: Column, size_a: Column | int, size_b: Column | int) -> Column:
    """A keyed permutation of the pairs (a, b), 0 <= a < size_a, 0 <= b < size_b: struct(a, b).

    An even number of rounds; each adds a keyed function of one half to the other, modulo that one's size.
    """
    pair = lambda x, y: F.struct(x.cast("long").alias("a"), y.cast("long").alias("b"))
    wide = lambda x: x if isinstance(x, Column) else F.lit(x)

    def step(s: Column, r: Column) -> Column:
        first = pair((s["a"] + _round(key, kind, r, s["b"])) % wide(size_a), s["b"])
        second = pair(s["a"], (s["b"] + _round(key, kind, r, s["a"])) % wide(size_b))
        return F.when(r % 2 == 0, first).otherwise(second)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), pair(a, b), step)


def _ten_to(n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(10**k) for k in range(11)]), n + 1)


def permuted_digits(key: str, kind: str, digits: Column) -> Column:
    """A string of digits (at most 19) as another of the same length, one to one."""

    def halves(d: Column) -> Column:
        left = F.floor(F.length(d) / 2).cast("int")
        return F.struct(
            left.alias("left"), (F.length(d) - left).alias("right"),
            F.coalesce(F.substring(d, F.lit(1), left).try_cast("long"), F.lit(0)).alias("a"), F.substring(d, left + 1, F.length(d) - left).cast("long").alias("b"),
            _ten_to(left).alias("size_a"), _ten_to(F.length(d) - left).alias("size_b"),
        )

    def text(h: Column, out: Column) -> Column:
        return F.concat(F.when(h["left"] > 0, F.lpad(out["a"].cast("string"), h["left"], "0")).otherwise(""), F.lpad(out["b"].cast("string"), h["right"], "0"))

    return _with(_with(digits, halves), lambda h: _with(feistel(key, kind, h["a"], h["b"], h["size_a"], h["size_b"]), lambda out: text(h, out)))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def _refill(shape: Column, digits: Column) -> Column:
    """`shape` with its digits replaced by the given ones, in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("i"))

    def filled(d: Column) -> Column:
        def step(s: Column, c: Column) -> Column:
            with_digit = F.struct(F.concat(s["out"], F.substring(d, s["i"], F.lit(1))).alias("out"), (s["i"] + 1).alias("i"))
            return F.when(c.between("0", "9"), with_digit).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["i"].alias("i")))

        return F.aggregate(F.split(shape, ""), start, step, lambda s: s["out"])

    return _with(digits, filled)


def _luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits; of a valid number it is a multiple of ten."""

    def total(n: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            d = F.substring(n, F.length(n) - i + 1, F.lit(1)).cast("int")
            return s + F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

        return F.aggregate(F.sequence(F.lit(1), F.length(n)), F.lit(0), step)

    return _with(digits, total)


def _card(key: str, x: Column) -> Column:
    body = lambda d: F.concat(F.substring(d, 1, 1), permuted_digits(key, "card", F.substring(d, F.lit(2), F.length(d) - 2)))
    check = lambda b: (10 - _luhn(F.concat(b, F.lit("0"))) % 10) % 10
    return _refill(x, _with(_with(_digits(x), body), lambda b: F.concat(b, check(b).cast("string"))))


def _card_in(x: Column) -> Column:
    """The card that a candidate holds, with or without other digit groups around it, or else is in an odd form; else null."""
    forms = F.concat(*[F.regexp_extract_all(x, F.lit(form), F.lit(1)) for form in _CARD_FORMS], F.array(x))
    valid = F.filter(forms, lambda c: c.rlike(f"^{_CARD}$") & (_luhn(_digits(c)) % 10 == 0))
    return F.when(x.rlike(f"^{_CARD}$"), F.get(valid, F.lit(0)))


def _marked(text: Column, found: Column) -> Column:
    """The text with marks around its cards, if one of them stands in a longer candidate; else the text."""
    hidden = F.exists(found, lambda x: F.coalesce(_card_in(x) != x, F.lit(False)))
    marked = lambda x: _with(_card_in(x), lambda c: F.coalesce(F.replace(x, c, F.concat(F.lit(_MARK), c, F.lit(_MARK))), x))
    pieces = F.zip_with(F.concat(F.array(F.lit("")), F.transform(found, marked)), F.split(text, PATTERN, -1), lambda m, rest: F.concat(m, rest))
    return F.when(hidden & ~text.contains(_MARK), F.array_join(pieces, "")).otherwise(text)


def _mod97(x: Column) -> Column:
    """Remainder of a string of digits and capitals, A counting as 10 to Z as 35."""

    def step(s: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (s * 10 + c.try_cast("int")) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(x, ""), F.lit(0), step)


def _bare(x: Column) -> Column:
    return F.replace(x, F.lit(" "), F.lit(""))


def _valid_iban(x: Column) -> Column:
    bare = _bare(x)
    return (F.length(bare) >= 15) & (_mod97(F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))) == 1)


def _iban(key: str, x: Column) -> Column:
    # The last digits of the account (18 at most) are permuted, letters and country stay, the check digits follow.
    country = F.substring(x, 1, 2)

    def moved(digits: Column) -> Column:
        kept = F.greatest(F.length(digits) - 18, F.lit(0))
        return F.concat(F.substring(digits, F.lit(1), kept), permuted_digits(key, "iban", F.substring(digits, kept + 1, F.length(digits))))

    def new(account: Column) -> Column:
        return _with(_digits(account), lambda digits: F.when(F.length(digits) > 0, _refill(account, moved(digits))).otherwise(account))

    def with_check(account: Column) -> Column:
        return F.concat(F.lpad((98 - _mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0"), account)

    account = F.substring(_bare(x), F.lit(5), F.length(x))
    return F.concat(country, _respaced(F.substring(x, F.lit(3), F.length(x)), _with(_with(account, new), with_check)))


def _respaced(shape: Column, text: Column) -> Column:
    """`text` with spaces where `shape` has them."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("i"))

    def spaced(t: Column) -> Column:
        def step(s: Column, c: Column) -> Column:
            letter = F.struct(F.concat(s["out"], F.substring(t, s["i"], F.lit(1))).alias("out"), (s["i"] + 1).alias("i"))
            return F.when(c == " ", F.struct(F.concat(s["out"], c).alias("out"), s["i"].alias("i"))).otherwise(letter)

        return F.aggregate(F.split(shape, ""), start, step, lambda s: s["out"])

    return _with(text, spaced)


def _phone(key: str, x: Column) -> Column:
    def nanp(digits: Column) -> Column:
        last = F.substring(digits, F.length(digits) - 9, F.lit(10))
        area, rest = F.substring(last, 1, 3).cast("long"), F.substring(last, 4, 7).cast("long")
        new = lambda out: F.concat((out["a"] + 200).cast("string"), (out["b"] + 2_000_000).cast("string"))
        return F.concat(F.substring(digits, F.lit(1), F.length(digits) - 10), _with(feistel(key, "nanp", area - 200, rest - 2_000_000, 800, 8_000_000), new))

    def other(digits: Column) -> Column:
        # Other numbers keep their first three digits, the country with them.
        return F.concat(F.substring(digits, 1, 3), permuted_digits(key, "phone", F.substring(digits, F.lit(4), F.length(digits) - 3)))

    return _refill(x, _with(_digits(x), lambda digits: F.when(x.rlike(f"^{_NANP}$"), nanp(digits)).otherwise(other(digits))))


def _ip(key: str, x: Column) -> Column:
    octet = lambda i: F.split_part(x, F.lit("."), F.lit(i)).cast("long")
    parts = lambda out: [F.floor(out["a"] / 256), out["a"] % 256, F.floor(out["b"] / 256), out["b"] % 256]
    new = feistel(key, "ip", octet(1) * 256 + octet(2), octet(3) * 256 + octet(4), 65536, 65536)
    return _with(new, lambda out: F.concat_ws(".", *[p.cast("string") for p in parts(out)]))


def _ssn(key: str, x: Column) -> Column:
    part = lambda i, n: F.substring(x, i, n).cast("long")
    area = part(1, 3) - 1 - F.when(part(1, 3) > 666, 1).otherwise(0)
    padded = lambda v, n: F.lpad(v.cast("string"), n, "0")
    new_area = lambda a: a + 1 + F.when(a + 1 >= 666, 1).otherwise(0)
    new = feistel(key, "ssn", area, (part(5, 2) - 1) * 9999 + part(8, 4) - 1, 898, 99 * 9999)
    return _with(new, lambda out: F.concat_ws("-", padded(new_area(out["a"]), 3), padded(F.floor(out["b"] / 9999) + 1, 2), padded(out["b"] % 9999 + 1, 4)))


def _as_date(x: Column) -> Column:
    year = F.when(x.rlike(f"^{_ISO}$"), F.substring(x, 1, 4)).otherwise(F.substring(x, 7, 4)).try_cast("int")
    iso = x.rlike(f"^{_ISO}$")
    two, three = F.when(iso, F.substring(x, 6, 2)).otherwise(F.substring(x, 4, 2)), F.when(iso, F.substring(x, 9, 2)).otherwise(F.substring(x, 1, 2))
    made = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), two, three).try_cast("date")
    return F.when(made.between(F.lit("1800-01-01").cast("date"), F.lit("2199-12-31").cast("date")), made)


def _date(key: str, x: Column) -> Column:
    day = F.datediff(_as_date(x), F.lit("1800-01-01").cast("date"))
    sign = F.substring(x, 3, 1)
    day_first = lambda new: F.concat_ws("", F.date_format(new, "dd"), sign, F.date_format(new, "MM"), sign, F.date_format(new, "yyyy"))
    moved = _with(
        _with(day, lambda d: feistel(key, "date", F.floor(d / _EPOCH[1]), d % _EPOCH[1], *_EPOCH)),
        lambda out: F.date_add(F.lit("1800-01-01").cast("date"), (out["a"] * _EPOCH[1] + out["b"]).cast("int")),
    )
    return _with(moved, lambda new: F.when(x.rlike(f"^{_ISO}$"), F.date_format(new, "yyyy-MM-dd")).otherwise(day_first(new)))


def _email(key: str, x: Column) -> Column:
    return F.concat(F.lit("user-"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(x)), 256), 1, 16), F.lit("@example.org"))


_PSEUDONYM: dict[str, Callable[[str, Column], Column]] = {"email": _email, "iban": _iban, "date": _date, "ssn": _ssn, "ip": _ip, "card": _card, "phone": _phone}


def kind_of(x: Column) -> Column:
    """The kind of a candidate that is valid as such, else null."""
    digits = _digits(x)
    octets = [F.split_part(x, F.lit("."), F.lit(i)).try_cast("int") for i in range(1, 5)]
    valid_ssn = ~F.substring(x, 1, 3).isin("000", "666") & (F.substring(x, 1, 1) != "9") & (F.substring(x, 5, 2) != "00") & (F.substring(x, 8, 4) != "0000")
    return (
        F.when(x.contains("@"), "email")
        .when(x.rlike(f"^{_IBAN}$"), F.when(_valid_iban(x), F.lit("iban")))
        .when(x.rlike(f"^(?:{_ISO}|{_DAY_FIRST})$"), F.when(_as_date(x).isNotNull(), F.lit("date")))
        .when(x.rlike(f"^{_SSN}$"), F.when(valid_ssn, F.lit("ssn")))
        .when(x.rlike(f"^{_IP}$"), F.when((octets[0] <= 255) & (octets[1] <= 255) & (octets[2] <= 255) & (octets[3] <= 255), F.lit("ip")))
        .when(x.rlike(f"^{_CARD}$"), F.when(_luhn(digits) % 10 == 0, F.lit("card")))
        .when(x.rlike(f"^{_NANP}$") | F.length(digits).between(8, 15), "phone")
    )


def pseudonymize(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """`docs` with every personal value of the text replaced, and _pii: an array of (kind, value, pseudonym) in the order of the text.

    Values that look like a kind but aren't valid (Luhn sum, octets, calendar, area) stay. Null texts stay null with an
    empty array; a text of any length is searched whole. Other columns, null and repeated rows pass through; a column called _pii is replaced.
    """
    base = docs.drop("_pii")
    parts, marked = free_name(base, "_parts"), free_name(base, "_marked")
    found = lambda c: F.when(F.col(c).rlike("[0-9@]"), F.regexp_extract_all(c, F.lit(PATTERN), F.lit(0)))
    kinds = F.transform(F.col("_pii"), lambda x: F.struct(kind_of(x).alias("kind"), x.alias("value")))

    def new(m: Column) -> Column:
        out = m["value"]
        for kind in KINDS:
            out = F.when(m["kind"] == kind, _PSEUDONYM[kind](key, m["value"])).otherwise(out)
        return F.struct(m["kind"].alias("kind"), m["value"].alias("value"), out.alias("pseudonym"))

    has = F.size("_pii") > 0
    none = F.array().cast("array<string>")
    staged = base.withColumn("_pii", F.coalesce(found(text_col), none))
    staged = staged.withColumn(marked, _marked(F.col(text_col), F.col("_pii")))
    again = F.when(F.col(marked) == F.col(text_col), F.col("_pii")).otherwise(found(marked))
    staged = staged.withColumn("_pii", F.coalesce(again, none))
    pieces = F.split(marked, PATTERN, -1)
    unmarked = F.when(F.col(marked) == F.col(text_col), pieces).otherwise(F.transform(pieces, lambda x: F.replace(x, F.lit(_MARK), F.lit(""))))
    staged = staged.withColumn(parts, F.when(has, unmarked))
    staged = staged.withColumn("_pii", F.transform(kinds, new))
    ends = F.zip_with(F.transform("_pii", lambda m: m["pseudonym"]), F.slice(parts, F.lit(2), F.size("_pii")), lambda a, b: F.concat(a, b))
    text = F.when(has, F.concat(F.col(parts)[0], F.array_join(ends, ""))).otherwise(F.col(text_col))
    valid = F.filter("_pii", lambda m: m["kind"].isNotNull())
    return staged.select(*[text.alias(c) if c == text_col else staged[c] for c in base.columns], valid.alias("_pii"))


def count_of(kind: str) -> Column:
    """How many values of a kind _pii has."""
    return F.size(F.filter("_pii", lambda m: m["kind"] == kind))
