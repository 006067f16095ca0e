"""Secret scans: fixed patterns, and a battery of randomness tests for everything else.

Base spans are pattern matches, leftmost and not overlapping for each kind. Beyond them, each long run of
encoding characters that no base span touches is a candidate. Its encoding (hex, base32,
base62, base64) is inferred from its characters, and two hypotheses are tested of it:

* that it is a random string over its alphabet, by a battery of three tests: chi-squared uniformity of the
  symbols, runs about the middle of the alphabet, and serial correlation. The chi-squared statistic of short
  tokens over large alphabets is far from its limit, so its null has the exact mean, variance and
  skewness for the token's length (it counts pairs of equal symbols). The battery's p is three times the least p;
* that it is ordinary text, by the chance that text switches between lower case, upper case, digits and marks as
  often over that length (a Chernoff bound).

Over the corpus, within each band of lengths, a Benjamini-Hochberg step over the battery's p finds the tokens that
are not random, which leaves out true secrets at a share of ``FALSE_SHARE`` among those at most; and another over the second p
finds those that are not text, ordinary tokens among them at most at that share. A secret is a
token that is not text and could be random. The steps need only counts by band and evidence bin (at most
``BANDS`` x ``BINS`` rows each), so they are grouped counts, not sorts. Texts are scanned once; what was found is
written and read for counting and for judging.

Only DataFrame functions run. Positions are code points of the whole text.
Defined cases: null and empty texts have no spans; rows are independent, so repeated rows
and null ids are scanned each; equal evidence falls into the same bin and is decided alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgate.llm.common import materialize

# Fixed values of the contract.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex")

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
SWITCH_RATE = 0.12
FALSE_SHARE = 0.01
BANDS, BINS, BIN_WIDTH = 8, 400, 0.25
TESTS = 3
#: Alphabets in order of value.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
_SPAN = "array<struct<start:int,end:int,text:string>>"


def _matches(text: Column, pattern: str) -> Column:
    """All matches as (start, end, text): what lies between two matches gives their distance."""
    lit = F.lit(pattern)
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, lit, F.lit(0))
    run = F.aggregate(
        F.zip_with(pieces, found, lambda p, f: F.struct(p.alias("p"), f.alias("f"))),
        F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["p"]) + F.coalesce(F.length(x["f"]), F.lit(0))).alias("at"),
            F.when(x["f"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + F.length(x["p"])).alias("start"),
                (acc["at"] + F.length(x["p"]) + F.length(x["f"])).alias("end"),
                x["f"].alias("text"))))).alias("out")),
        lambda acc: acc["out"])
    return F.when(text.rlike(pattern), run).otherwise(F.array().cast(_SPAN))


def with_base_spans(docs: DataFrame) -> DataFrame:
    """Adds ``_text`` and one span array for each kind."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (docs.withColumn("_text", text)
            .withColumn("_assign", F.filter(_matches(F.col("_text"), ASSIGN),
                                            lambda s: F.length(F.regexp_extract(s["text"], ASSIGN, 2)) >= 6))
            .withColumn("_access", _matches(F.col("_text"), ACCESS))
            .withColumn("_hex", _matches(F.col("_text"), HEX)))


def _tail(z: Column) -> Column:
    """Chance of a normal value beyond z, from above; within 3 % for z >= 0."""
    above = F.exp(-z * z / 2) / (1.64 * F.abs(z) + F.sqrt(0.76 * z * z + 4))
    return F.when(z < 0, 1 - above).otherwise(above)


def _collisions_z(c: Column, n: Column, a: Column) -> Column:
    """How far a count of pairs of equal symbols lies above that of random strings of n over a symbols, as a normal value.

    Mean, variance and third moment are exact for each length; the Pearson III law with these moments is
    turned into a normal one by Wilson and Hilferty's cube root. Chi-squared is 2 a / n times the count, plus a constant.
    """
    p = 1 / a
    pairs, triples = n * (n - 1) / 2, n * (n - 1) * (n - 2) / 6
    mean, var = pairs * p, pairs * p * (1 - p)
    third = pairs * p * (1 - p) * (1 - 2 * p) + 6 * triples * p * p * (1 - p)
    shape = 4 * F.pow(var, F.lit(3)) / (third * third)
    value = F.greatest(1 + (c - 0.5 - mean) / F.sqrt(var * shape), F.lit(1e-9))
    return 3 * F.sqrt(shape) * (F.pow(value, F.lit(1 / 3)) - 1 + 1 / (9 * shape))


def _battery(t: Column) -> Column:
    """(encoding, length band, evidence bins against randomness and against text) of one token."""
    body = F.regexp_replace(t, "=+$", "")
    n = F.length(body).cast("double")
    encoding = (F.when(body.rlike("^[0-9a-f]+$") | body.rlike("^[0-9A-F]+$"), "hex")
                .when(body.rlike("^[A-Z2-7]+$"), "base32").when(body.rlike("^[A-Za-z0-9]+$"), "base62").otherwise("base64"))
    plain = F.when(body.rlike("^[0-9A-F]+$"), F.lower(body)).otherwise(F.translate(body, "-_", "+/"))
    symbols = F.split(plain, "")
    alphabet = F.create_map(*[F.lit(x) for kv in ALPHABETS.items() for x in kv])[encoding]
    size = F.length(alphabet).cast("double")
    zero = F.lit(0.0)

    def total(xs: Column, f) -> Column:
        return F.aggregate(xs, zero, lambda a, x: a + f(x))

    values = F.transform(symbols, lambda c: (F.position(c, alphabet) - 1).cast("double"))
    state = F.struct(values.alias("v"), symbols.alias("s"), n.alias("n"), size.alias("a"), encoding.alias("e"), plain.alias("p"))

    def judged(x: Column) -> Column:
        v, s, n, a = x["v"], x["s"], x["n"], x["a"]
        collisions = total(F.array_distinct(s), lambda c: (n - F.length(F.replace(x["p"], c, F.lit("")))) * (n - F.length(F.replace(x["p"], c, F.lit(""))) - 1) / 2)
        p_chi = _tail(_collisions_z(collisions, n, a))
        middle = (a - 1) / 2
        after = F.slice(v, F.lit(2), F.size(v))
        pairs = F.zip_with(F.slice(v, F.lit(1), F.size(v) - 1), after, lambda p, q: F.struct(p.alias("p"), q.alias("q")))
        high = total(v, lambda y: (y > middle).cast("double"))
        runs = 1 + total(pairs, lambda y: ((y["p"] > middle) != (y["q"] > middle)).cast("double"))
        twice = 2 * high * (n - high)
        spread = twice * (twice - n) / (n * n * (n - 1))
        z_runs = F.when(spread > 0, F.greatest(F.abs(runs - twice / n - 1) - 0.5, zero) / F.sqrt(spread)).otherwise(F.lit(99.0))
        mean = total(v, lambda y: y) / n
        var = total(v, lambda y: F.pow(y - mean, F.lit(2)))
        serial = F.when(var > 0, total(pairs, lambda y: (y["p"] - mean) * (y["q"] - mean)) / var).otherwise(F.lit(1.0))
        z_serial = F.abs(serial + 1 / n) * F.sqrt(n)
        p_random = F.least(TESTS * F.least(p_chi, 2 * _tail(z_runs), 2 * _tail(z_serial)), F.lit(1.0))
        kind = F.translate(F.regexp_replace(F.regexp_replace(F.regexp_replace(x["p"], "[0-9]", "0"), "[a-z]", "l"), "[A-Z]", "u"),
                           "+/", "mm")
        kinds = F.split(kind, "")
        switches = total(F.zip_with(F.slice(kinds, F.lit(1), F.size(kinds) - 1), F.slice(kinds, F.lit(2), F.size(kinds)),
                                    lambda p, q: (p != q).cast("double")), lambda y: y)
        share = F.least(switches / (n - 1), F.lit(1 - 1e-9))
        bound = F.when(share > SWITCH_RATE, (n - 1) * (share * F.log(share / SWITCH_RATE) + (1 - share) * F.log((1 - share) / (1 - SWITCH_RATE))))
        return F.struct(
            x["e"].alias("encoding"),
            F.least(F.floor(n / 16).cast("int"), F.lit(BANDS - 1)).alias("band"),
            F.least(F.floor(-F.log(F.greatest(p_random, F.lit(1e-300))) / BIN_WIDTH).cast("int"), F.lit(BINS - 1)).alias("unlike_random"),
            F.least(F.floor(F.coalesce(bound, zero) / BIN_WIDTH).cast("int"), F.lit(BINS - 1)).alias("unlike_text"))

    return F.transform(F.array(state), judged)[0]


def _candidates(doc: DataFrame) -> Column:
    """Runs that no base span touches, with their test results."""
    base = F.concat("_assign", "_access", "_hex")
    free = F.filter(_matches(F.col("_text"), CANDIDATE), lambda s: ~F.exists(
        base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return F.transform(free, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), _battery(s["text"]).alias("t")))


def _steps(counts: list[tuple[int, int, int]], false_share: float) -> dict[int, int]:
    """Benjamini-Hochberg by band: the least bin whose tokens are discoveries, from (band, bin, tokens)."""
    out: dict[int, int] = {}
    for band in {b for b, _, _ in counts}:
        rows = sorted(((at, n) for b, at, n in counts if b == band), reverse=True)
        tested, rank = sum(n for _, n in rows), 0
        for at, n in rows:
            rank += n
            if math.exp(-at * BIN_WIDTH) <= false_share * rank / tested:
                out[band] = at
    return out


def thresholds(scanned: DataFrame, false_share: float = FALSE_SHARE) -> tuple[dict[int, int], dict[int, int]]:
    """For each length band the least bins of tokens that are not random, and of tokens that aren't text; counts cover every candidate."""
    tests = scanned.select(F.explode("_free").alias("c")).select("c.t.band", "c.t.unlike_random", "c.t.unlike_text")
    counts = tests.groupBy("band", "unlike_random", "unlike_text").agg(F.count(F.lit(1)).alias("n")).collect()
    return (_steps(_summed(counts, "unlike_random"), false_share), _steps(_summed(counts, "unlike_text"), false_share))


def _summed(counts: list, kind: str) -> list[tuple[int, int, int]]:
    out: dict[tuple[int, int], int] = {}
    for r in counts:
        out[r["band"], r[kind]] = out.get((r["band"], r[kind]), 0) + r["n"]
    return [(band, at, n) for (band, at), n in out.items()]


def _at_least(least: dict[int, int], test: Column, kind: str) -> Column:
    limit = F.create_map(*[F.lit(x) for kv in sorted(least.items()) for x in kv]) if least else F.lit(None).cast("map<int,int>")
    return test[kind] >= F.coalesce(F.try_element_at(limit, test["band"]), F.lit(BINS))


def scan_secrets(docs: DataFrame, false_share: float = FALSE_SHARE, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: all) with ``assign``, ``access``, ``hex`` (base spans) and ``random`` (added spans), whole texts."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in (*KINDS, "random")]
    scanned = with_base_spans(docs)
    scanned = scanned.withColumn("_free", _candidates(scanned))
    scanned = materialize(scanned.select(*[F.col(f"`{c}`") for c in kept], "_assign", "_access", "_hex", "_free"), "secret-candidates")
    not_random, not_text = thresholds(scanned, false_share)
    hit = F.filter("_free", lambda c: _at_least(not_text, c["t"], "unlike_text") & ~_at_least(not_random, c["t"], "unlike_random"))
    extra = F.transform(hit, lambda c: F.struct(c["start"], c["end"]))
    return scanned.select(*[F.col(f"`{c}`") for c in kept], F.col("_assign").alias("assign"), F.col("_access").alias("access"), F.col("_hex").alias("hex"), extra.alias("random"))


def _numbered(kind: str, no: int) -> Column:
    return F.transform(kind, lambda s: F.struct(
        s["start"].alias("start"), F.lit(no).alias("no"), F.concat_ws(":", F.lit(kind), s["start"], s["end"]).alias("text")))


def spans_text(*kinds: str) -> Column:
    """kind:start:end of the named span columns by start, then by the order given, comma-joined."""
    rows = F.concat(*[_numbered(k, no) for no, k in enumerate(kinds)])
    return F.array_join(F.transform(F.array_sort(rows), lambda s: s["text"]), ",")
