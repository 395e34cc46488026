"""Secrets in texts: fixed forms, and tokens that a battery of randomness tests takes for keys.

Everything here is built-in expressions. Fixed forms are found by pattern. Other candidates are
runs of 20 or more key characters with two of digits, lower- and upper-case letters. The encoding of
each (hex, base32, base36, letters, base62, base64, base64url) is the smallest alphabet that holds
its characters; over that alphabet it must pass three tests of randomness: chi-squared uniformity, runs above and below the middle, and lag-1 serial correlation.
Against the hypothesis "ordinary word" (whose character class changes at few places) the number of
class changes gives a p-value by Chernoff's bound. Benjamini-Hochberg within strata of length
controls the share of ordinary words among the reported ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The forms asked for, leftmost matches that do not overlap.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # the leftmost runs of [0-9a-f]+ that are long enough are these
KINDS = ("assign", "access", "hex", "random")
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encodings, most specific first: hex of one case, base32, base36, letters, base62, base64, base64url, both of the latter mixed.
#: A key that happens to fit a smaller alphabet is as random over that one.
ALPHABETS = (
    ("^([0-9a-f]+|[0-9A-F]+)$", _DIGITS + "abcdef"),
    ("^[A-Z2-7]+=*$", _UPPER + "234567"),
    ("^[a-z2-7]+=*$", _LOWER + "234567"),
    ("^[0-9A-Z]+=*$", _DIGITS + _UPPER),
    ("^[0-9a-z]+=*$", _DIGITS + _LOWER),
    ("^[A-Za-z]+=*$", _UPPER + _LOWER),
    ("^[A-Za-z0-9]+=*$", _UPPER + _LOWER + _DIGITS),
    ("^[A-Za-z0-9+/]+=*$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("^[A-Za-z0-9_-]+=*$", _UPPER + _LOWER + _DIGITS + "-_"),
    ("^[A-Za-z0-9+/_-]+=*$", _UPPER + _LOWER + _DIGITS + "+/-_"),
)
#: Shortest token of each length stratum.
STRATA = (20, 32, 48, 96)
#: A test of the battery rejects randomness beyond this many standard deviations.
Z_LIMIT = 3.3
#: Share of places where an ordinary word changes its character class.
CLASS_CHANGE = 0.08
FALSE_DISCOVERY = 0.01
BINS = 60

_SPAN = "array<struct<start:int,end:int,token:string,value:string>>"


def _matches(df: DataFrame, name: str, pattern: str, group: int = 0) -> DataFrame:
    """Adds a column of matches in the column __text; texts without one cost a single scan."""
    has = F.col("__text").rlike(pattern)
    none = F.array().cast("array<string>")
    cut = df.withColumns(
        {
            "__p": F.when(has, F.split("__text", pattern, -1)).otherwise(none),
            "__m": F.when(has, F.regexp_extract_all("__text", F.lit(pattern), F.lit(0))).otherwise(none),
            "__v": F.when(has, F.regexp_extract_all("__text", F.lit(pattern), F.lit(group))).otherwise(none),
        }
    )
    return cut.withColumn("__z", F.expr("zip_with(__m, __v, (a, b) -> named_struct('token', a, 'value', b))")).withColumn(
        name,
        F.expr(
            f"""aggregate(
            zip_with(__p, __z, (a, b) -> named_struct('gap', a, 'token', b.token, 'value', b.value)),
            named_struct('at', 0, 'out', cast(array() as {_SPAN})),
            (acc, x) -> named_struct(
                'at', acc.at + length(x.gap) + coalesce(length(x.token), 0),
                'out', if(x.token is null, acc.out, concat(acc.out, array(named_struct('start', acc.at + length(x.gap),
                    'end', acc.at + length(x.gap) + length(x.token), 'token', x.token, 'value', x.value))))),
            acc -> acc.out)"""
        ),
    ).drop("__p", "__m", "__v", "__z")


def _tested(df: DataFrame) -> DataFrame:
    """Column __tested: candidates with the stratum of their length and the bin of their p-value, -1 if not random."""
    alphabet = "case " + " ".join(f"when x.token rlike '{p}' then '{a}'" for p, a in ALPHABETS) + " end"
    plain = f"if(x.token rlike '{ALPHABETS[0][0]}', lower(x.token), rtrim('=', x.token))"
    classes = "translate(x.token, 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789', repeat('A', 26) || repeat('a', 26) || repeat('0', 10))"
    # A token of one class has no evidence against the ordinary word.
    several = "(x.token rlike '[0-9]' and x.token rlike '[A-Za-z]' or x.token rlike '[a-z]' and x.token rlike '[A-Z]')"
    # Squared counts of the letters, one scan of the token a letter: linear in its length.
    count = "(length(x.plain) - length(replace(x.plain, substr(x.alphabet, j, 1), '')))"
    squares = f"aggregate(sequence(1, length(x.alphabet)), 0D, (s, j) -> s + {count} * double({count}))"
    steps = [
        # token, its alphabet, its characters as letters of classes
        f"""transform(filter(__found, x -> {several}), x -> named_struct(
            'start', x.start, 'end', x.end, 'alphabet', {alphabet}, 'plain', {plain}, 'classes', {classes}))""",
        f"""transform(filter(__t, x -> x.alphabet is not null and length(x.plain) >= 2), x -> named_struct('start', x.start, 'end', x.end,
            'k', length(x.alphabet), 'n', length(x.plain),
            'classes', filter(split(x.classes, ''), c -> c <> ''), 'squares', {squares},
            'v', transform(filter(split(x.plain, ''), c -> c <> ''), c -> instr(x.alphabet, c) - 1)))""",
        """transform(__t, x -> named_struct('start', x.start, 'end', x.end, 'k', x.k, 'n', x.n, 'squares', x.squares,
            'changes', aggregate(sequence(1, size(x.classes) - 1), 0, (s, i) -> s + int(x.classes[i] <> x.classes[i - 1])),
            'mean', aggregate(x.v, 0D, (s, z) -> s + z) / x.n,
            'high', size(filter(x.v, z -> 2 * z >= x.k)),
            'runs', 1 + aggregate(sequence(1, x.n - 1), 0, (s, i) -> s + int((2 * x.v[i] >= x.k) <> (2 * x.v[i - 1] >= x.k))),
            'v', x.v))""",
        """transform(__t, x -> named_struct('start', x.start, 'end', x.end, 'n', x.n, 'k', x.k,
            'share', x.changes / (x.end - x.start - 1D),
            'chi', greatest(x.k * x.squares / double(x.n) - x.n, 0D), 'high', double(x.high), 'low', double(x.n - x.high), 'runs', x.runs,
            'serial', coalesce(try_divide(aggregate(sequence(1, x.n - 1), 0D, (s, i) -> s + (x.v[i] - x.mean) * (x.v[i - 1] - x.mean)),
                aggregate(x.v, 0D, (s, z) -> s + (z - x.mean) * (z - x.mean))), 1D) * sqrt(x.n)))""",
        f"""transform(__t, x -> named_struct('start', x.start, 'end', x.end,
            'stratum', {" + ".join(f"int(x.end - x.start >= {s})" for s in STRATA[1:])},
            'random', (power(x.chi / (x.k - 1), 1/3D) - (1 - 2D / (9 * (x.k - 1)))) / sqrt(2D / (9 * (x.k - 1))) <= {Z_LIMIT}
                and abs(x.serial) <= {Z_LIMIT}
                and coalesce(abs(try_divide(x.runs - 1 - 2 * x.high * x.low / x.n,
                    sqrt(greatest(2 * x.high * x.low * (2 * x.high * x.low - x.n) / (double(x.n) * x.n * (x.n - 1D)), 0D)))) <= {Z_LIMIT}, false),
            'evidence', if(x.share > {CLASS_CHANGE}, (x.end - x.start - 1) * (x.share * ln(x.share / {CLASS_CHANGE})
                + if(x.share < 1, (1 - x.share) * ln((1 - x.share) / {1 - CLASS_CHANGE}), 0D)) / ln(10), 0D)))""",
        f"transform(__t, x -> named_struct('start', x.start, 'end', x.end, 'stratum', x.stratum, 'bin', if(x.random, least(int(x.evidence), {BINS}), -1)))",
    ]
    df = df.withColumn("__t", F.expr(steps[0]))
    for step in steps[1:]:
        df = df.withColumn("__t", F.expr(step))
    return df.withColumnRenamed("__t", "__tested").drop("__found")


def _limits(histogram: list[tuple[int, int, int]]) -> dict[int, int]:
    """Least bin of each stratum that Benjamini-Hochberg reports; the p-values of a bin count as its largest."""
    out = {}
    for stratum in range(len(STRATA)):
        bins = {b: n for s, b, n in histogram if s == stratum}
        m, above = sum(bins.values()), 0
        for b in range(BINS, -1, -1):
            above += bins.get(b, 0)
            if above and m * 10.0**-b <= FALSE_DISCOVERY * above:
                out[stratum] = b
    return out


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``secrets``: array<struct<start, kind, end>> in code points, ends exclusive, by start.

    ``kind`` counts from 0 in KINDS. Spans of the fixed forms always stay; a random token is added
    where no fixed form overlaps it. A NULL or empty text has no spans. Repeated rows get equal
    spans; a column already named ``secrets`` is replaced, others pass through. An empty table
    stays empty. Two passes: the first counts the p-values of all candidates by length and bin.
    """
    base = docs.drop("secrets").withColumn("__text", F.coalesce(F.col(f"`{text}`"), F.lit("")))
    counted = _tested(_matches(base.select("__text"), "__found", CANDIDATE)).select(F.explode("__tested").alias("t")).groupBy("t.stratum", "t.bin").count()
    limits = _limits([tuple(r) for r in counted.collect()])  # at most 4 x 62 counts
    out = _matches(base, "__assign", ASSIGN, 2)
    out = _matches(_matches(_matches(out, "__access", ACCESS), "__hex", HEX), "__found", CANDIDATE)
    out = _tested(out)
    fixed = F.expr(
        """array_sort(concat(
            transform(filter(__assign, x -> length(x.value) >= 8), x -> named_struct('start', x.start, 'kind', 0, 'end', x.end)),
            transform(filter(__access, x -> length(x.token) >= 16), x -> named_struct('start', x.start, 'kind', 1, 'end', x.end)),
            transform(__hex, x -> named_struct('start', x.start, 'kind', 2, 'end', x.end))))"""
    )
    passed = " or ".join(f"(x.stratum = {s} and x.bin >= {b})" for s, b in limits.items()) or "false"
    more = F.expr(
        f"""transform(filter(__tested, x -> ({passed}) and not exists(__fixed, y -> y.start < x.end and x.start < y.end)),
            x -> named_struct('start', x.start, 'kind', 3, 'end', x.end))"""
    )
    out = out.withColumn("__fixed", fixed).withColumn("secrets", F.array_sort(F.concat("__fixed", more)))
    return out.select(*(f"`{c}`" for c in docs.columns if c != "secrets"), "secrets")


def listed(spans: Column | str, kinds: tuple[str, ...] = KINDS) -> Column:
    """Spans as kind:start:end, comma-joined."""
    spans = F.col(spans) if isinstance(spans, str) else spans
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span found replaced by ``mark``; overlapping spans by one mark."""
    found = scan(docs, text)
    masked = F.expr(
        f"""aggregate(secrets, named_struct('at', 0, 'out', ''),
            (acc, x) -> named_struct('at', greatest(acc.at, x.end),
                'out', if(x.start >= acc.at, concat(acc.out, substr(`{text}`, acc.at + 1, x.start - acc.at), '{mark}'), acc.out)),
            acc -> concat(acc.out, substr(`{text}`, acc.at + 1)))"""
    )
    return found.withColumn(text, F.when(F.size("secrets") > 0, masked).otherwise(F.col(f"`{text}`"))).select(*(f"`{c}`" for c in docs.columns))
