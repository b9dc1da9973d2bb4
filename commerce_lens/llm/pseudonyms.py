"""Format-preserving pseudonyms for personal numbers, dates, addresses and secrets, in DataFrame functions only.

A value is found by pattern, validated, and permuted by a keyed Feistel network within its own format: two halves in turn
are shifted by a keyed digest of the other half, each digit within the digits and each letter within
its case, or as numbers modulo the size of their half. A permutation never maps two values to one, and the same value
gets the same pseudonym in every document, however it is punctuated. Check digits are set anew, so a valid
number stays valid. What fails validation stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# The patterns of the kinds, without groups. Each starts where no run of its own characters goes on.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "secret": r"(?<![A-Za-z0-9])(?:password|passwd|pwd|secret|token|api[_-]?key)\s?[=:]\s?\"?[A-Za-z0-9+/_-]{8,}+|(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9]|[/.-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?<![A-Za-z0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)|[0-9]{3})[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9]|-[0-9])",
    "card": r"(?<![A-Za-z0-9.])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# A text without any of these holds nothing to find.
_HINT = r"[0-9@]|AKIA|(?:password|passwd|pwd|secret|token|api[_-]?key)\s?[=:]"
_DATE_FORMATS = {"-": "yyyy-MM-dd", "/": "dd/MM/yyyy", ".": "dd.MM.yyyy"}
# Dates are permuted among these days, 256 x 288 of them from the first one on.
_FIRST_DAY, _DAYS = "1900-01-01", (256, 288)


def _chars(s: Column) -> Column:
    return F.split(s, "")


def _digest(key: str, kind: str, i: Column, other: Column) -> Column:
    """64 hex digits that depend on the key, the kind, the round and the other half."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), other.cast("string")), 256)


def _hex_number(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("long")


def _shifted(half: Column, digest: Column) -> Column:
    """Each digit and letter of a half moved within its kind by two hex digits of the digest."""

    def moved(c: Column, j: Column) -> Column:
        by = _hex_number(F.substr(digest, (j % 32) * 2 + 1, F.lit(2)))
        code = F.ascii(c)

        def within(first: int, size: int) -> Column:
            return F.char(F.lit(first) + (code - first + by) % size)

        return (
            F.when(code.between(48, 57), within(48, 10)).when(code.between(65, 90), within(65, 26)).when(code.between(97, 122), within(97, 26)).otherwise(c)
        )

    return F.array_join(F.transform(_chars(half), moved), "")


def permuted_text(core: Column, key: str, kind: str) -> Column:
    """A permutation of the texts with the same pattern of digits, capitals and small letters."""
    cut = F.floor(F.length(core) / 2).cast("int")
    start = F.struct(F.substr(core, F.lit(1), cut).alias("l"), F.substr(core, cut + 1).alias("r"))

    def turn(acc: Column, i: Column) -> Column:
        left = F.when(i % 2 == 0, _shifted(acc["l"], _digest(key, kind, i, acc["r"]))).otherwise(acc["l"])
        right = F.when(i % 2 == 1, _shifted(acc["r"], _digest(key, kind, i, acc["l"]))).otherwise(acc["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    # An odd and an even round more than once each half: the shorter half may be empty.
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda acc: F.concat(acc["l"], acc["r"]))


def permuted_pair(a: Column, b: Column, sizes: tuple[int, int], key: str, kind: str) -> Column:
    """A permutation of the pairs a < sizes[0], b < sizes[1], as struct (a, b) of longs."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def turn(acc: Column, i: Column) -> Column:
        def by(other: Column) -> Column:
            return _hex_number(F.substr(_digest(key, kind, i, other), F.lit(1), F.lit(12)))

        left = F.when(i % 2 == 0, (acc["a"] + by(acc["b"])) % sizes[0]).otherwise(acc["a"])
        right = F.when(i % 2 == 1, (acc["b"] + by(acc["a"])) % sizes[1]).otherwise(acc["b"])
        return F.struct(left.alias("a"), right.alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _only(x: Column, keep: str) -> Column:
    return F.regexp_replace(x, f"[^{keep}]", "")


def _refilled(x: Column, core: Column, keep: str) -> Column:
    """x with its characters of the class `keep` replaced by those of core, in order."""

    def put(c: Column, j: Column) -> Column:
        nth = F.length(_only(F.substr(x, F.lit(1), j + 1), keep))
        return F.when(c.rlike(f"[{keep}]"), F.substr(core, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(_chars(x), put), "")


def _luhn_sum(digits: Column) -> Column:
    """The weighted digit sum of a number whose last digit counts once."""

    def weighed(acc: Column, pair: Column) -> Column:
        return acc + pair

    n = F.length(digits)

    def weight(c: Column, j: Column) -> Column:
        d = F.ascii(c) - 48
        doubled = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return F.when((n - j) % 2 == 0, doubled).otherwise(d)

    return F.aggregate(F.transform(_chars(digits), weight), F.lit(0), weighed)


def _mod97(text: Column) -> Column:
    """The remainder by 97 of a text whose letters stand for 10 to 35."""

    def more(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    return F.aggregate(_chars(text), F.lit(0), more)


def _email(x: Column, key: str) -> Column:
    local = F.substring_index(x, "@", 1)
    core = _only(local, "A-Za-z0-9")
    return F.concat(_refilled(local, permuted_text(core, key, "email"), "A-Za-z0-9"), F.lit("@"), F.substring_index(x, "@", -1))


def _secret(x: Column, key: str) -> Column:
    head = F.regexp_extract(x, r"^(?:AKIA|[A-Za-z_-]+\s?[=:]\s?\"?)", 0)
    value = F.substr(x, F.length(head) + 1)
    return F.concat(head, _refilled(value, permuted_text(_only(value, "A-Za-z0-9"), key, "secret"), "A-Za-z0-9"))


def _iban(x: Column, key: str) -> Column:
    core = _only(x, "A-Z0-9")
    country, body = F.substr(core, F.lit(1), F.lit(2)), F.substr(core, F.lit(5))
    valid = (_mod97(F.concat(body, F.substr(core, F.lit(1), F.lit(4)))) == 1) & F.length(core).between(15, 34)
    new = permuted_text(body, key, "iban")
    check = F.lpad((F.lit(98) - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    return F.when(valid, _refilled(x, F.concat(country, check, new), "A-Z0-9"))


def _ip(x: Column, key: str) -> Column:
    octets = F.transform(F.split(x, r"\."), lambda o: o.cast("long"))
    pair = permuted_pair(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], (65536, 65536), key, "ip")
    new = F.transform(F.array(pair), lambda p: F.concat_ws(".", F.floor(p["a"] / 256), p["a"] % 256, F.floor(p["b"] / 256), p["b"] % 256))
    return F.when(F.forall(octets, lambda o: o <= 255), new[0])


def _date(x: Column, key: str) -> Column:
    out = F.lit(None).cast("string")
    for mark, form in _DATE_FORMATS.items():
        day = F.try_to_timestamp(x, F.lit(form)).cast("date")
        n = F.datediff(day, F.lit(_FIRST_DAY).cast("date"))
        pair = permuted_pair(F.floor(n / _DAYS[1]), n % _DAYS[1], _DAYS, key, "date")
        new = F.transform(F.array(pair), lambda p: F.date_format(F.date_add(F.lit(_FIRST_DAY).cast("date"), (p["a"] * _DAYS[1] + p["b"]).cast("int")), form))
        known = F.coalesce(n.between(0, _DAYS[0] * _DAYS[1] - 1), F.lit(False))
        out = F.when(x.contains(mark), F.when(known, new[0])).otherwise(out)
    return out


def _ssn(x: Column, key: str) -> Column:
    area, group, serial = (F.split(x, "-")[i].cast("long") for i in range(3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    # Areas 1 to 899 without 666, groups 1 to 99, serials 1 to 9999.
    place = area - F.when(area > 666, 2).otherwise(1)
    pair = permuted_pair(place * 99 + group - 1, serial - 1, (898 * 99, 9999), key, "ssn")

    def shown(p: Column) -> Column:
        new = F.floor(p["a"] / 99) + 1
        new = F.when(new >= 666, new + 1).otherwise(new)
        parts = ((new, 3), (p["a"] % 99 + 1, 2), (p["b"] + 1, 4))
        return F.concat_ws("-", *[F.lpad(c.cast("string"), n, "0") for c, n in parts])

    return F.when(valid, F.transform(F.array(pair), shown)[0])


def _phone(x: Column, key: str) -> Column:
    core = _only(x, "0-9")
    national = F.right(core, F.lit(10))
    return _refilled(x, F.concat(F.substr(core, F.lit(1), F.length(core) - 10), permuted_text(national, key, "phone")), "0-9")


def _card(x: Column, key: str) -> Column:
    core = _only(x, "0-9")
    # The first digit names the network and stays; the last one is the check digit.
    body = F.substr(core, F.lit(2), F.length(core) - 2)
    new = F.concat(F.substr(core, F.lit(1), F.lit(1)), permuted_text(body, key, "card"))
    check = (10 - _luhn_sum(F.concat(new, F.lit("0"))) % 10) % 10
    valid = (_luhn_sum(core) % 10 == 0) & F.length(core).between(13, 19)
    return F.when(valid, _refilled(x, F.concat(new, check.cast("string")), "0-9"))


_MAKERS = {"email": _email, "secret": _secret, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def _pseudonym(x: Column, key: str) -> Column:
    """struct (kind, value) of a found value; null where it isn't valid."""
    out = F.lit(None).cast("struct<kind:string,value:string>")
    for kind, make in reversed(_MAKERS.items()):
        out = F.when(x.rlike(f"^(?:{PATTERNS[kind]})$"), F.struct(F.lit(kind).alias("kind"), make(x, key).alias("value"))).otherwise(out)
    return F.transform(F.array(out), lambda m: F.when(m["value"].isNotNull(), m))[0]


def pseudonymise(df: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """(row, text, kinds): every row of df as a struct, its text with pseudonyms, and the kinds replaced, in order.

    A null text stays null. Equal values get equal pseudonyms under one key, whatever document or punctuation
    they stand in. Repeated rows are treated alike; rows need no other columns, and may have any.
    """
    text = F.col(text_col)
    hinted = text.rlike(_HINT)
    none = F.expr("cast(array() AS array<string>)")
    cut = df.select(
        F.struct("*").alias("row"),
        text.alias("text"),
        F.when(hinted, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none).alias("found"),
    )
    made = cut.select("row", "text", "found", F.transform("found", lambda x: _pseudonym(x, key)).alias("made"))
    new = F.transform(F.arrays_zip("found", "made"), lambda p: F.coalesce(p["made"]["value"], p["found"]))
    kept = F.split("text", ANY, -1)
    joined = F.array_join(F.zip_with(kept, new, lambda k, v: F.concat(k, F.coalesce(v, F.lit("")))), "")
    return made.select(
        "row",
        F.when(F.size("found") > 0, joined).otherwise(F.col("text")).alias("text"),
        F.transform(F.filter("made", lambda m: m.isNotNull()), lambda m: m["kind"]).alias("kinds"),
    )
