"""Format-preserving pseudonyms for personal numbers, dates and mail names.

A match is validated (Luhn digit, octets, number ranges, calendar), read as a vector of
symbols with one modulus each, and permuted by a keyed Feistel network over that vector:
the halves take turns to be shifted, symbol by symbol, by a keyed SHA-256 of the other half.
That is a permutation of the values of one format, so equal values get equal
pseudonyms in all documents, different ones stay different, and the result is valid
again (the Luhn digit is computed anew, dates stay dates, octets stay octets).

Only DataFrame functions run. Defined cases: a null text stays null and counts 0; an empty
one stays empty; matches that fail validation stay as they are; repeated rows are each
treated; all other columns are kept, and columns named like the added counts are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Kinds and their patterns, the first that matches decides.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "phone": r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}",
    "ssn": r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}",
    "date": r"(?:1[89]|2[01])[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./](?:1[89]|2[01])[0-9]{2}",
    "ip": r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}",
    "card": r"[1-9][0-9]{3}(?:([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{9,15})",
}
KINDS = tuple(PATTERNS)
_GUARD = r"(?<![A-Za-z0-9_.@-])", r"(?![A-Za-z0-9_@]|[.-][0-9])"
#: 400 Gregorian years, 146,097 days = 189 x 773.
FIRST_DAY, DAYS_HIGH, DAYS_LOW = "1800-01-01", 189, 773

_VECTOR = "array<struct<v:int,m:int>>"


def _pattern() -> str:
    # one capture group, the card's separator; its number in the joint pattern is 1
    return _GUARD[0] + "(?:" + "|".join(PATTERNS.values()) + ")" + _GUARD[1]


def _feistel(vector: Column, key: str, kind: str) -> Column:
    """A keyed permutation of vectors with the same moduli; 1 symbol is shifted by a keyed constant."""
    half = F.floor((F.size(vector) + 1) / 2).cast("int")

    def turn(acc: Column, r: Column) -> Column:
        left, right = acc["a"], acc["b"]
        seen = F.concat_ws(".", F.transform(right, lambda s: s["v"].cast("string")))
        shifted = F.transform(left, lambda s, i: F.struct(
            F.pmod(s["v"] + F.conv(F.substring(F.sha2(F.concat_ws(
                "|", F.lit(key), F.lit(kind), r.cast("string"), i.cast("string"), seen).cast("binary"), 256), 1, 7), 16, 10).cast("int"),
                s["m"]).cast("int").alias("v"), s["m"].alias("m")))
        return F.struct(right.alias("a"), shifted.alias("b"))

    start = F.struct(F.slice(vector, F.lit(1), half).alias("a"),
                     F.slice(vector, half + 1, F.size(vector)).alias("b"))
    # an even number of turns leaves the halves in their places
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda acc: F.concat(acc["a"], acc["b"]))


def _vector(*symbols: tuple[Column, int]) -> Column:
    return F.array(*[F.struct(v.cast("int").alias("v"), F.lit(m).alias("m")) for v, m in symbols])


def _digits_in(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in turn; other characters stay."""
    filled = F.aggregate(
        F.split(shape, ""), F.struct(F.lit(0).alias("i"), F.lit("").alias("out")),
        lambda acc, c: F.when(c.rlike("^[0-9]$"), F.struct(
            (acc["i"] + 1).alias("i"), F.concat(acc["out"], F.substr(digits, acc["i"] + 1, F.lit(1))).alias("out"))
        ).otherwise(F.struct(acc["i"].alias("i"), F.concat(acc["out"], c).alias("out"))),
        lambda acc: acc["out"])
    return filled


def _padded(v: Column, n: int) -> Column:
    return F.lpad(v.cast("string"), n, "0")


def _luhn_sum(digits: Column, doubled_from_end: int) -> Column:
    """Sum of the digits, every other doubled (cast out nines), starting so many places from the end."""
    return F.aggregate(
        F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(
            i % 2 == doubled_from_end, F.lit(2) * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int"))),
        F.lit(0), lambda a, x: a + x)


def _with(value: Column, f) -> Column:
    """f of a value that is computed once."""
    return F.transform(F.array(value), f)[0]


def _card(m: Column, key: str) -> Column:
    digits = F.regexp_replace(m, "[ -]", "")

    def renamed(d: Column) -> Column:
        body = F.substr(d, F.lit(1), F.length(d) - 1)
        vector = F.transform(F.split(body, ""), lambda c, i: F.struct(
            F.when(i == 0, c.cast("int") - 1).otherwise(c.cast("int")).alias("v"), F.when(i == 0, 9).otherwise(10).alias("m")))
        new = F.array_join(F.transform(_feistel(vector, key, "card"), lambda s, i: F.when(i == 0, s["v"] + 1).otherwise(s["v"]).cast("string")), "")
        return _with(new, lambda n: F.concat(n, F.pmod(-_luhn_sum(n, 0), F.lit(10)).cast("string")))

    ok = (F.length(digits).between(13, 19)) & (_luhn_sum(digits, 1) % 10 == 0)
    return F.when(ok, _digits_in(m, _with(digits, renamed)))


def _email(m: Column, key: str) -> Column:
    name, rest = F.substring_index(m, "@", 1), F.substr(m, F.length(F.substring_index(m, "@", 1)) + 1)
    code = lambda c: F.ascii(c)
    vector = F.transform(F.split(name, ""), lambda c: F.when(c.rlike("[0-9]"), F.struct((code(c) - 48).alias("v"), F.lit(10).alias("m")))
                         .when(c.rlike("[A-Z]"), F.struct((code(c) - 65).alias("v"), F.lit(26).alias("m")))
                         .when(c.rlike("[a-z]"), F.struct((code(c) - 97).alias("v"), F.lit(26).alias("m")))
                         .otherwise(F.struct(F.lit(0).alias("v"), F.lit(1).alias("m"))))
    new = F.zip_with(F.split(name, ""), _feistel(vector, key, "email"), lambda c, s: F.when(
        c.rlike("[0-9]"), F.char(s["v"] + 48)).when(c.rlike("[A-Z]"), F.char(s["v"] + 65)).when(c.rlike("[a-z]"), F.char(s["v"] + 97)).otherwise(c))
    return F.concat(F.array_join(new, ""), rest)


def _phone(m: Column, key: str) -> Column:
    d = F.substr(F.regexp_replace(m, "[^0-9]", ""), F.lit(2))
    # any area code and exchange: a number that can't be dialled may still be someone's, mistyped or foreign
    vector = F.transform(F.split(d, ""), lambda c: F.struct(c.cast("int").alias("v"), F.lit(10).alias("m")))
    new = F.array_join(F.transform(_feistel(vector, key, "phone"), lambda s: s["v"].cast("string")), "")
    return _digits_in(m, F.concat(F.lit("1"), new))


def _ssn(m: Column, key: str) -> Column:
    area = F.substring(m, 1, 3).cast("int")
    vector = _vector((F.when(area > 666, area - 2).otherwise(area - 1), 898), (F.substring(m, 5, 2).cast("int") - 1, 99),
                     (F.substring(m, 8, 4).cast("int") - 1, 9999))

    def text(v: Column) -> Column:
        a = v[0]["v"] + 1
        return F.concat_ws("-", _padded(F.when(a >= 666, a + 1).otherwise(a), 3), _padded(v[1]["v"] + 1, 2), _padded(v[2]["v"] + 1, 4))

    return _with(_feistel(vector, key, "ssn"), text)


def _ip(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("int"))
    new = _feistel(F.transform(octets, lambda o: F.struct(o.alias("v"), F.lit(256).alias("m"))), key, "ip")
    return F.when(F.forall(octets, lambda o: o <= 255), F.array_join(F.transform(new, lambda s: s["v"].cast("string")), "."))


def _date(m: Column, key: str) -> Column:
    form = F.when(m.rlike("^[0-9]{4}-"), "yyyy-MM-dd").when(m.contains("."), "dd.MM.yyyy").otherwise("dd/MM/yyyy")
    iso = F.when(m.rlike("^[0-9]{4}-"), m).otherwise(F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2)))
    day = F.datediff(iso.try_cast("date"), F.lit(FIRST_DAY).cast("date"))
    new = _feistel(_vector((F.floor(day / DAYS_LOW), DAYS_HIGH), (day % DAYS_LOW, DAYS_LOW)), key, "date")

    def text(v: Column) -> Column:
        y = F.date_add(F.lit(FIRST_DAY).cast("date"), v[0]["v"] * DAYS_LOW + v[1]["v"]).cast("string")
        return F.when(form == "yyyy-MM-dd", y).otherwise(F.concat(
            F.substring(y, 9, 2), F.substring(m, 3, 1), F.substring(y, 6, 2), F.substring(m, 3, 1), F.substring(y, 1, 4)))

    return F.when(day.isNotNull(), _with(new, text))


_RENAME = {"email": _email, "phone": _phone, "ssn": _ssn, "date": _date, "ip": _ip, "card": _card}


def _renamed(m: Column, key: str) -> Column:
    """(kind, new text) of one match; kind is null where validation fails."""
    whole = {k: m.rlike(f"^(?:{p})$") for k, p in PATTERNS.items()}
    kind, new = None, None
    for k in KINDS:
        kind = F.when(whole[k], F.lit(k)) if kind is None else kind.when(whole[k], F.lit(k))
        new = F.when(whole[k], _RENAME[k](m, key)) if new is None else new.when(whole[k], _RENAME[k](m, key))
    return _with(F.struct(kind.alias("k"), new.alias("n")), lambda s: F.struct(
        F.when(s["n"].isNotNull(), s["k"]).alias("kind"), F.coalesce(s["n"], m).alias("text")))


def _count_of(kind: str) -> Column:
    return F.coalesce(F.size(F.filter("_found", lambda f: f["kind"] == kind)), F.lit(0)).cast("long")


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with the text rewritten and ``n_<kind>`` (long), the validated matches of each kind."""
    pattern = _pattern()
    text = F.col("text").cast("string")
    found = F.when(text.rlike(pattern), F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: _renamed(m, key)))
    out = docs.withColumn("text", text).withColumn("_found", found)
    pieces = F.split("text", pattern, -1)
    joined = F.array_join(F.flatten(F.zip_with(pieces, F.transform("_found", lambda f: f["text"]), lambda p, f: F.array(p, F.coalesce(f, F.lit(""))))), "")
    counts = {f"n_{k}": _count_of(k) for k in KINDS}
    return out.withColumns(counts | {"text": F.when(F.col("_found").isNull(), F.col("text")).otherwise(joined)}).drop("_found")
