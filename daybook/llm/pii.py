r"""Format-preserving pseudonyms for personal data, in DataFrame operations only.

Found and validated: payment card numbers (13 to 19 digits, Luhn; where the longest run of digit
groups fails, its prefixes up to a separator, longest first, and then card-shaped groups further in,
so that an expiry date or a security code beside a card doesn't hide it), international and
parenthesised phone numbers (7 to 15 digits), national ones (3-3-4 groups, with or without a leading
1, and groups with a leading 0, 9 to 12 digits; the 0 or 1 stays), IPv4 addresses (octets up to 255), dates
(``yyyy-mm-dd``, ``dd.mm.yyyy``, ``mm/dd/yyyy``; real days of 1800 to 2199), social security
numbers in groups (3-2-4, no zero group), e-mail addresses, and hexadecimal secrets of 16 digits
or more behind a word such as token or password.  Anything else is left as it is, e.g. 16 digits
with a wrong check digit.

A value is a pair (x, y) in Z_a x Z_b; ``ROUNDS`` Feistel rounds (x, y) -> (y, x + F(round, y) mod a),
with a and b changing places, permute that set: digits halve into 10^i and 10^j, days of the
400-year calendar cycle are 189 x 773, addresses 65536 x 65536, hex digits halve as well.  F is a keyed
SHA-256.  So equal values get equal pseudonyms in every document, different ones different
pseudonyms, the format (separators, length, check digit, valid day) stays, and the key takes a
permutation back.  A card within a longer run is permuted again until no candidate before it passes
Luhn, so that the way back finds the same digits.  E-mail addresses keep their domain, and their local part becomes a keyed digest.

The key is passed as a literal into the plan; give it from a secret store.

Defined cases: null texts stay null, empty texts empty; repeated rows and ties get equal results;
texts without a digit or ``@`` are not touched; other columns are passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import let

ROUNDS = 8
KEY = "public-test-key"

# Fixed patterns, one group of alternatives each, in order of precedence.
EMAIL = r"(?<![\w.%+-])[\w.%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
SECRET = r"(?i:(?:token|secret|password|passwd|api[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?)[0-9a-fA-F]{16,}+(?![0-9A-Za-z])"
IPV4 = r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)"
DATE = r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\w/-]|\.\d)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
PHONE_ABROAD = r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){1,2}(?![\w])|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?![\w])"
PHONE_GROUPS = r"(?<![\w+])(?<!\d[ .-])(?:(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}|(?=0(?:[ .-]?\d){8,11}(?![ .-]?\d))0\d{1,4}(?:[ .-]\d{2,8}){1,4})(?![\w]|[ .-]\d)"
PHONE = f"{PHONE_ABROAD}|{PHONE_GROUPS}"
CARD = r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])"
CARD_SHAPE = r"^(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,4}(?:\1\d{1,3})?|\d{4}([ -])\d{6}\2\d{4,5})$"
CARD_WALK = 64
ANY = "|".join((EMAIL, SECRET, IPV4, DATE, SSN, PHONE, CARD))
KINDS = ("email", "secret", "ipv4", "date", "ssn", "phone", "card")


def _round(key: str, tweak: Column, i: Column, x: Column, size: Column) -> Column:
    """A keyed number in [0, size)."""
    text = F.concat_ws("|", F.lit(key), tweak, i.cast("string"), x.cast("string"))
    return F.pmod(F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("long"), size)


def feistel(x: Column, y: Column, a: Column, b: Column, tweak: Column, key: str, back: bool = False) -> Column:
    """struct(x, y): the keyed permutation of Z_a x Z_b (``back``: its inverse)."""
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), a.cast("long").alias("a"), b.cast("long").alias("b"))

    def forth(s: Column, i: Column) -> Column:
        return F.struct(s["y"].alias("x"), ((s["x"] + _round(key, tweak, i, s["y"], s["a"])) % s["a"]).alias("y"),
                        s["b"].alias("a"), s["a"].alias("b"))

    def undo(s: Column, i: Column) -> Column:
        return F.struct(F.pmod(s["y"] - _round(key, tweak, i, s["x"], s["b"]), s["b"]).alias("x"), s["x"].alias("y"),
                        s["b"].alias("a"), s["a"].alias("b"))

    steps = F.array(*(F.lit(i) for i in (range(ROUNDS, 0, -1) if back else range(1, ROUNDS + 1))))
    return F.aggregate(steps, start, undo if back else forth)


def _digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _based(digits: Column, base: int) -> Column:
    return F.conv(digits, base, 10).cast("long") if base != 10 else digits.cast("long")


def _written(value: Column, width: Column, base: int) -> Column:
    return F.lpad(F.lower(F.conv(value.cast("string"), 10, base)) if base != 10 else value.cast("string"), width, F.lit("0"))


def permute_digits(digits: Column, tweak: str, key: str, back: bool = False, base: int = 10) -> Column:
    """Digits (2 to 36 decimal ones) permuted among those of the same length."""

    def body(d: Column) -> Column:
        n = F.length(d)
        half = F.floor(n / 2).cast("int")
        power = lambda k: F.pow(F.lit(float(base)), k).cast("long")
        parts = feistel(_based(F.substr(d, F.lit(1), half), base), _based(F.substr(d, half + 1), base),
                        power(half), power(n - half), F.concat(F.lit(tweak), n.cast("string")), key, back)
        return let(parts, lambda p: F.concat(_written(p["x"], half, base), _written(p["y"], n - half, base)))

    return let(digits, body)


def _hex(digits: Column, key: str, back: bool) -> Column:
    """Hex digits in groups of 16, each permuted; the last one is longer by what is left, or has 15 (31 digits
    don't halve into 64-bit numbers)."""

    def body(d: Column) -> Column:
        groups = F.greatest(F.lit(1), F.floor((F.length(d) + 1) / 16)).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), groups - 1), lambda i: permute_digits(
            F.substr(d, i * 16 + 1, F.when(i == groups - 1, F.length(d) - i * 16).otherwise(F.lit(16))), "hex", key, back, 16)), "")

    return let(F.lower(digits), body)


def _refill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced in order (forms are a few dozen characters)."""
    chars = F.split(form, "")
    return let(F.struct(chars.alias("c"), digits.alias("d")), lambda s: F.array_join(F.transform(
        s["c"], lambda ch, i: F.when(ch.rlike("^[0-9]$"), F.substr(
            s["d"], F.size(F.filter(F.slice(s["c"], 1, i + 1), lambda x: x.rlike("^[0-9]$"))), F.lit(1))).otherwise(ch)), ""))


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of digits whose last one counts once."""
    return let(F.reverse(F.filter(F.split(digits, ""), lambda c: c != "")), lambda d: F.aggregate(
        F.transform(d, lambda c, i: let(c.cast("int") * (1 + i % 2), lambda v: v - F.when(v > 9, 9).otherwise(0))),
        F.lit(0), lambda s, v: s + v))


def _luhn(digits: Column) -> Column:
    return _luhn_sum(digits) % 10 == 0


def _card_payload(d: Column, key: str, back: bool) -> Column:
    payload = permute_digits(F.substr(d, F.lit(1), F.length(d) - 1), "card", key, back)
    return let(payload, lambda p: F.concat(p, ((10 - _luhn_sum(F.concat(p, F.lit("0"))) % 10) % 10).cast("string")))


def _card_within(m: Column, key: str, back: bool) -> Column:
    """``m``, whose digits as a whole fail Luhn, with the first candidate that passes replaced."""
    part = lambda t, c: _digits_of(F.substr(t, c["at"], c["n"]))
    cuts = F.filter(F.sequence(F.lit(1), F.length(m)), lambda i: F.substr(m, i, F.lit(1)).rlike("[ -]"))

    def candidates(cut: Column) -> Column:
        starts = F.concat(F.array(F.lit(1)), F.transform(cut, lambda i: i + 1))
        ends = F.concat(F.array(F.length(m)), F.reverse(F.transform(cut, lambda i: i - 1)))
        spans = F.flatten(F.transform(starts, lambda a: F.transform(
            F.filter(ends, lambda e: e >= a + 12), lambda e: F.struct(a.alias("at"), (e - a + 1).alias("n")))))
        return F.filter(spans, lambda c: (F.length(part(m, c)) >= 13) & (
            (c["at"] == 1) | F.substr(m, c["at"], c["n"]).rlike(CARD_SHAPE)))

    def body(s: Column) -> Column:
        c, before = F.get(s["all"], s["k"] - 1), F.slice(s["all"], F.lit(1), s["k"] - 1)
        put = lambda d: F.concat(
            F.substr(m, F.lit(1), c["at"] - 1), _refill(F.substr(m, c["at"], c["n"]), d), F.substr(m, c["at"] + c["n"]))
        step = lambda d: let(_card_payload(d, key, back), lambda p: let(put(p), lambda t: F.struct(
            p.alias("d"), t.alias("t"), (~F.exists(before, lambda x: _luhn(part(t, x)))).alias("done"))))
        first = F.struct(part(m, c).alias("d"), m.alias("t"), F.lit(False).alias("done"))
        walk = F.aggregate(F.sequence(F.lit(1), F.lit(CARD_WALK)), first, lambda a, _: F.when(a["done"], a).otherwise(step(a["d"])))
        return F.when(s["k"] > 0, walk["t"]).otherwise(m)

    return let(let(cuts, candidates), lambda cs: let(F.struct(
        cs.alias("all"), F.array_position(F.transform(cs, lambda c: _luhn(part(m, c))), F.lit(True)).cast("int").alias("k")), body))


def _card(m: Column, key: str, back: bool) -> Column:
    return let(_digits_of(m), lambda d: F.when(_luhn(d), _refill(m, _card_payload(d, key, back))).otherwise(_card_within(m, key, back)))


def _ipv4(m: Column, key: str, back: bool) -> Column:
    def body(o: Column) -> Column:
        n = lambda i: F.get(o, F.lit(i)).cast("int")
        half = F.lit(65536)
        p = feistel(n(0) * 256 + n(1), n(2) * 256 + n(3), half, half, F.lit("ipv4"), key, back)
        valid = F.forall(o, lambda x: x.cast("int") <= 255) & ~F.exists(o, lambda x: x.rlike("^0[0-9]"))
        return F.when(valid, let(p, lambda s: F.concat_ws(".", *(
            F.floor(s[c] / d).cast("int").cast("string") if d > 1 else (s[c] % 256).cast("string")
            for c in ("x", "y") for d in (256, 1))))).otherwise(m)

    return let(F.split(m, r"\."), body)


def _date(m: Column, key: str, back: bool) -> Column:
    def as_format(form: str) -> Column:
        day = F.try_to_date(m, form)
        first = F.lit("1800-01-01").cast("date")

        def moved(d: Column) -> Column:
            at = F.datediff(d, first)
            p = feistel(F.floor(at / 773), at % 773, F.lit(189), F.lit(773), F.lit("date"), key, back)
            return let(p, lambda s: F.date_format(F.date_add(first, (s["x"] * 773 + s["y"]).cast("int")), form))

        ok = lambda d: d.isNotNull() & (F.year(d) >= 1800) & (F.year(d) <= 2199)
        return let(day, lambda d: F.when(ok(d), moved(d)).otherwise(m))

    return (F.when(m.contains("-"), as_format("yyyy-MM-dd")).when(m.contains("."), as_format("dd.MM.yyyy"))
            .otherwise(as_format("MM/dd/yyyy")))


def _phone(m: Column, key: str, back: bool) -> Column:
    """The country code (digits straight behind +, where a separator follows) stays, as do the 1 before
    3-3-4 groups and the 0 before other groups."""
    code = F.regexp_extract(m, r"^(?:\+\d{1,3}(?=[ .(-])|1(?=[ .-]\d{3}[ .-]\d{3}[ .-]\d{4}$)|0(?!\d{2}[ .-]\d{3}[ .-]\d{4}$))", 0)

    def body(rest: Column) -> Column:
        return F.concat(code, _refill(rest, permute_digits(_digits_of(rest), "phone", key, back)))

    n = F.length(_digits_of(m))
    return F.when((n >= 7) & (n <= 15), let(F.substr(m, F.length(code) + 1), body)).otherwise(m)


def _ssn(m: Column, key: str, back: bool) -> Column:
    """Groups 001-999, 01-99, 0001-9999: exactly these are permuted, so a valid number stays one."""
    part = lambda at, n: F.substring(m, at, n).cast("int")
    p = feistel((part(1, 3) - 1) * 99 + part(5, 2) - 1, part(8, 4) - 1, F.lit(999 * 99), F.lit(9999), F.lit("ssn"), key, back)
    written = let(p, lambda s: F.format_string(
        "%03d-%02d-%04d", F.floor(s["x"] / 99) + 1, s["x"] % 99 + 1, s["y"] + 1))
    return F.when(~m.rlike("^000|-00-|0000$"), written).otherwise(m)


def _secret(m: Column, key: str, back: bool) -> Column:
    value = F.regexp_extract(m, "[0-9a-fA-F]{16,}$", 0)
    return F.concat(F.substr(m, F.lit(1), F.length(m) - F.length(value)), _hex(value, key, back))


def _email(m: Column, key: str) -> Column:
    name = F.regexp_extract(m, "^[^@]+", 0)
    digest = F.sha2(F.concat(F.lit(key + "|email|"), F.lower(name), F.regexp_extract(m, "@.*$", 0)).cast("binary"), 256)
    return F.concat(F.lit("u"), F.substring(digest, 1, 12), F.regexp_extract(m, "@.*$", 0))


def _kind(m: Column) -> Column:
    return (F.when(m.contains("@"), "email")
            .when(m.rlike("^(?i:token|secret|password|passwd|api[_-]?key)"), "secret")
            .when(m.rlike(r"^(?:\d{1,3}\.){3}\d{1,3}$"), "ipv4")
            .when(m.rlike(r"^(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})$"), "date")
            .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(m.rlike(r"^[+(]") | (F.length(_digits_of(m)) < 13), "phone")
            .otherwise("card"))


def _replaced(m: Column, key: str, back: bool) -> Column:
    kind = _kind(m)
    return let(kind, lambda k: (
        F.when(k == "email", m if back else _email(m, key)).when(k == "secret", _secret(m, key, back))
        .when(k == "ipv4", _ipv4(m, key, back)).when(k == "date", _date(m, key, back))
        .when(k == "ssn", _ssn(m, key, back)).when(k == "phone", _phone(m, key, back))
        .otherwise(_card(m, key, back))))


def pseudonymise(docs: DataFrame, text_col: str = "text", key: str = KEY, *, back: bool = False) -> DataFrame:
    """``docs`` with ``text_col`` pseudonymised (``back``: numbers and dates restored), and per kind how
    many values were replaced: ``pii`` array<struct<kind, n>> (kinds found only)."""
    text = F.col(f"`{text_col}`")

    def rewritten(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(ANY), F.lit(0))
        new = let(found, lambda ms: F.transform(ms, lambda m: F.struct(
            let(_replaced(m, key, back), lambda r: r).alias("new"), m.alias("old"), _kind(m).alias("kind"))))
        return let(F.struct(F.split(t, ANY, -1).alias("rest"), new.alias("new")), lambda s: F.struct(
            F.array_join(F.transform(s["rest"], lambda r, i: F.concat(r, F.coalesce(F.get(s["new"], i)["new"], F.lit("")))), "").alias("text"),
            F.filter(s["new"], lambda x: x["new"] != x["old"])["kind"].alias("kinds")))

    none = F.struct(text.alias("text"), F.array().cast("array<string>").alias("kinds"))
    result = F.when(text.rlike(r"[0-9@]") & text.rlike(ANY), let(text, rewritten)).otherwise(none)
    out = docs.select(*(F.col(f"`{c}`") for c in docs.columns), result.alias("__pii"))
    counted = F.filter(F.transform(F.array(*map(F.lit, KINDS)), lambda k: F.struct(
        k.alias("kind"), F.size(F.filter(F.col("__pii.kinds"), lambda x: x == k)).alias("n"))), lambda s: s["n"] > 0)
    return out.select(
        *(F.col("__pii.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns), counted.alias("pii"))
