"""Secrets in texts: three fixed patterns, and tokens that a battery of randomness tests takes for random.

DataFrame functions only; nothing here runs Python on the executors.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.shared import keep, quoted

# Fixed patterns, and the characters that a match, or its second group, needs at least.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "random")

#: Runs of encoded characters are candidates of the battery, which tells words from random letters by itself. A run may be
#: a path or a name that a token stands behind, so its parts in each of the alphabets are candidates too.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
PARTS = (r"[A-Za-z0-9+/]{20,}={0,2}", r"[A-Za-z0-9_-]{20,}={0,2}", r"[A-Za-z0-9]{20,}={0,2}")
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encodings in the order in which they are tried, and their characters.
ENCODINGS = (
    ("hex", r"^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("hex upper", r"^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("lower letters", r"^[a-z]+=*$", _LOWER),
    ("upper letters", r"^[A-Z]+=*$", _UPPER),
    ("letters", r"^[A-Za-z]+=*$", _UPPER + _LOWER),
    ("base32", r"^[A-Z2-7]+=*$", _UPPER + "234567"),
    ("lower", r"^[0-9a-z]+$", _DIGITS + _LOWER),
    ("upper", r"^[0-9A-Z]+$", _DIGITS + _UPPER),
    ("base62", r"^[0-9A-Za-z]+$", _UPPER + _LOWER + _DIGITS),
    ("base64", r"^[0-9A-Za-z+/]+=*$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64 url", r"^[0-9A-Za-z_-]+=*$", _UPPER + _LOWER + _DIGITS + "-_"),
)
#: Percentage of each letter from a to z in texts, the mean of English, German, French and Spanish.
LETTERS = (8.3, 1.4, 3.2, 4.3, 14.5, 1.6, 1.9, 3.0, 7.3, 0.3, 0.7, 4.3, 2.7, 8.0, 6.0, 2.2, 0.6, 6.6, 7.0, 7.0, 4.2, 1.2, 1.2,
           0.2, 0.9, 0.6)
#: Level of the false-discovery control, and the bins of -ln p that it counts in.
LEVEL, BINS_PER_UNIT, BINS = 0.05, 20, 1500
_BLOCK = 512


class Cuts(NamedTuple):
    """By length class, the first bin of -ln p that is rejected as not random."""

    by_class: dict[int, int]


def _running(sizes: Column) -> Column:
    """Running sums of an array of longs before each element. Arrays are extended in blocks, so that the work does
    not grow with the square of their size."""
    zero = F.lit(0).cast("long")

    def before(values: Column, start: Column) -> Column:
        empty = F.array().cast("array<bigint>")
        return F.aggregate(
            values, F.struct(empty.alias("out"), start.alias("at")),
            lambda acc, x: F.struct(F.concat(acc["out"], F.array(acc["at"])).alias("out"), (acc["at"] + x).alias("at")),
            lambda acc: acc["out"])

    blocks = F.sequence(F.lit(0), F.floor(F.greatest(F.size(sizes) - 1, F.lit(0)) / _BLOCK).cast("int"))
    parts = F.transform(blocks, lambda b: F.slice(sizes, b * _BLOCK + 1, _BLOCK))
    totals = F.transform(parts, lambda p: F.aggregate(p, zero, lambda a, x: a + x))
    return F.flatten(F.transform(
        F.arrays_zip(parts.alias("part"), before(totals, zero).alias("start")), lambda z: before(z["part"], z["start"])))


def _found(text: Column, pattern: str, kind: str, group: int = 0) -> Column:
    """Array of (start, end, kind, token) of all matches, leftmost and non-overlapping; the token is the group."""
    whole, token = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    size = lambda x: F.char_length(x).cast("long")
    between = F.transform(F.split(text, pattern, -1), size)
    sizes = F.transform(whole, size)
    steps = F.zip_with(F.slice(between, 1, F.size(sizes)), sizes, lambda a, b: a + b)
    ends = F.zip_with(_running(steps), steps, lambda a, b: a + b)
    spans = F.transform(
        F.arrays_zip(ends.alias("end"), sizes.alias("size"), token.alias("token")),
        lambda z: F.struct(
            (z["end"] - z["size"]).alias("start"), z["end"].alias("end"), F.lit(KINDS.index(kind)).alias("kind"),
            z["token"].alias("token")))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(
        "array<struct<start:bigint,end:bigint,kind:int,token:string>>"))


def base_spans(text: Column) -> Column:
    """Spans (start, end, kind, token) of the three fixed patterns in code points, by start, then kind.

    Runs of hex digits, and of capitals and digits after AKIA, end where the characters do, so asking for the least
    length in the pattern finds what dropping short matches leaves.
    """
    assign = F.filter(_found(text, ASSIGN, "assign", 2), lambda s: F.char_length(s["token"]) >= LEAST["assign"])
    access = _found(text, ACCESS[:-1] + "{%d,}" % (LEAST["access"] - 4), "access")
    return F.array_sort(F.concat(assign, access, _found(text, HEX[:-1] + "{%d,}" % LEAST["hex"], "hex")))


def _two_sided(z: Column) -> Column:
    """P(|Z| >= |z|) by the approximation 7.1.26 of Abramowitz and Stegun, at least 1e-30."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = reduce(lambda acc, a: (acc + a) * t, (1.061405429, -1.453152027, 1.421413741, -0.284496736, 0.254829592), F.lit(0.0))
    return F.greatest(poly * F.exp(-x * x), F.lit(1e-30))


def _add(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _letters(token: Column) -> Column:
    """How many deviations the letters of a token are nearer to those of words than uniform ones, at least 0."""
    logs = [math.log(x) for x in LETTERS]
    mean = sum(logs) / 26
    spread = math.sqrt(sum((x - mean) ** 2 for x in logs) / 26)
    table = F.array(*[F.lit((x - mean) / spread) for x in logs])
    letters = F.regexp_replace(F.lower(token), "[^a-z]", "")
    near = _add(F.transform(F.split(letters, ""), lambda c: F.element_at(table, F.position(c, F.lit(_LOWER)))))
    return F.when(F.char_length(letters) > 0, F.greatest(near / F.sqrt(F.char_length(letters)), F.lit(0.0))).otherwise(F.lit(0.0))


def measured(token: Column) -> Column:
    """(n, symbols, p): length without padding, size of the inferred alphabet, and the battery's p-value under the
    hypothesis that the characters are independent and uniform; null where no encoding fits.

    Three tests, combined by Bonferroni: chi-squared of the character counts (Wilson-Hilferty), runs above and below
    the middle of the alphabet (Wald-Wolfowitz), and lag-1 serial correlation of the characters' values. These miss many
    a word of 20 letters, so a token without digits has a fourth, of its letters' frequencies in words.
    """
    alphabet = F.coalesce(*[F.when(token.rlike(p), F.lit(chars)) for _, p, chars in ENCODINGS])
    digits = token.rlike("[0-9]")
    wordlike = F.when(digits, F.lit(0.0)).otherwise(_letters(token))
    digits_only = token.rlike("^[0-9]+$")
    bare = F.rtrim(token, F.lit("="))
    # One value per step of nested one-element arrays keeps each from being worked out again.
    values = F.transform(F.split(bare, ""), lambda c: (F.position(c, alphabet) - 1).cast("double"))

    def tests(x: Column) -> Column:
        n, k = F.size(x).cast("double"), F.char_length(alphabet).cast("double")
        counts = F.transform(F.array_distinct(x), lambda s: F.size(F.filter(x, lambda y: y == s)).cast("double"))
        chi, df = k / n * _add(F.transform(counts, lambda c: c * c)) - n, k - 1
        z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        z_chi = F.greatest(z_chi, F.lit(0.0))  # evener than chance speaks for no word
        half = F.transform(x, lambda v: (v >= k / 2).cast("double"))
        high = _add(half)
        low = n - high
        body, tail = F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1)
        runs = 1 + _add(F.zip_with(
            F.slice(half, 1, F.size(x) - 1), F.slice(half, 2, F.size(x) - 1), lambda a, b: (a != b).cast("double")))
        mean_runs = 2 * high * low / n + 1
        var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
        z_runs = F.when(var_runs > 0, (runs - mean_runs) / F.sqrt(var_runs)).otherwise(F.lit(12.0))
        mean = _add(x) / n
        spread = _add(F.transform(x, lambda v: (v - mean) * (v - mean)))
        serial = _add(F.zip_with(body, tail, lambda a, b: (a - mean) * (b - mean)))
        z_serial = F.when(spread > 0, (serial / spread + 1 / (n - 1)) * F.sqrt(n)).otherwise(F.lit(12.0))
        p = F.least(_two_sided(z_chi), _two_sided(z_runs), _two_sided(z_serial), _two_sided(wordlike))
        times = F.when(digits, F.lit(3)).otherwise(F.lit(4))
        return F.struct(F.size(x).alias("n"), k.cast("int").alias("symbols"), F.least(times * p, F.lit(1.0)).alias("p"))

    usable = alphabet.isNotNull() & ~digits_only & (F.char_length(bare) >= 20)
    return F.when(usable, F.element_at(F.transform(F.array(values), tests), 1))


def _with_parts(run: Column) -> Column:
    """The parts of a run of encoded characters in each alphabet; without marks between letters it is its only part."""
    token = run["token"]
    found = F.flatten(F.array(*[_found(token, p, "random") for p in PARTS]))
    moved = F.transform(found, lambda s: F.struct(
        (s["start"] + run["start"]).alias("start"), (s["end"] + run["start"]).alias("end"), s["kind"].alias("kind"),
        s["token"].alias("token")))
    return F.when(token.rlike("[+/_-]"), F.array_distinct(moved)).otherwise(F.array(run))


def candidates(text: Column) -> Column:
    """Spans of the battery's candidates, each with (n, symbols, p): all of 20 or more encoded characters."""
    runs = F.flatten(F.transform(_found(text, CANDIDATE, "random"), _with_parts))
    rows = F.transform(runs, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["token"].alias("token"),
        measured(s["token"]).alias("test")))
    return F.filter(rows, lambda s: s["test"].isNotNull())


def _class(n: Column) -> Column:
    return F.floor(F.log2(n.cast("double"))).cast("int")


def _bin(p: Column) -> Column:
    return F.least(F.floor(-F.log(p) * BINS_PER_UNIT), F.lit(BINS)).cast("int")


def cuts(tests: DataFrame, level: float = LEVEL) -> Cuts:
    """Benjamini-Hochberg within each length class over all candidates ``tests(n, p)``.

    Long tokens show a departure from randomness that short ones cannot, and would crowd their p-values out; so
    each class, doubling in length, is controlled by itself. Counts by bin of -ln p stand in for ranks (a bin counts
    with its largest p), so one small table of at most 64 classes and 1501 bins holds all of it.
    """
    counts = tests.select(_class(F.col("n")).alias("class"), _bin(F.col("p")).alias("bin")).groupBy("class", "bin").agg(
        F.count(F.lit(1)).alias("m"))
    falling = Window.partitionBy("class").orderBy(F.desc("bin"))
    ranked = counts.withColumns({
        "rank": F.sum("m").over(falling.rowsBetween(Window.unboundedPreceding, 0)),
        "all": F.sum("m").over(Window.partitionBy("class"))})
    passed = ranked.where(F.exp(-F.col("bin") / BINS_PER_UNIT) <= level * F.col("rank") / F.col("all"))
    rows = passed.groupBy("class").agg(F.min("bin").alias("bin")).collect()
    return Cuts({r["class"]: r["bin"] for r in rows})


def _kept(found: Column, base: Column, limits: Cuts) -> Column:
    """Candidates that are not rejected, touch no base span and lie in no other such candidate, as plain spans."""
    table = F.create_map(*[F.lit(x) for pair in sorted(limits.by_class.items()) for x in pair]) if limits.by_class else None

    def random(s: Column) -> Column:
        cut = F.coalesce(F.element_at(table, _class(s["test"]["n"])), F.lit(BINS + 1)) if table is not None else F.lit(BINS + 1)
        apart = ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return (_bin(s["test"]["p"]) < cut) & apart

    plain = F.transform(F.filter(found, random), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["token"].alias("token")))

    def outermost(spans: Column) -> Column:
        return F.filter(spans, lambda s: ~F.exists(spans, lambda o: (o["start"] <= s["start"]) & (s["end"] <= o["end"]) & (
            o["end"] - o["start"] > s["end"] - s["start"])))

    return F.element_at(F.transform(F.array(plain), outermost), 1)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, level: float = LEVEL) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans) of every whole text.

    A null text counts as empty. ``spans`` has the base spans and the random tokens that touch none of them as
    kind:start:end, by start, then kind in the order assign, access, hex, random. An empty table gives no rows;
    repeated rows give repeated results.
    """
    text = F.coalesce("text", F.lit(""))
    rows = keep(docs.select(
        F.col("doc_id").cast("long"), base_spans(text).alias("base"), candidates(text).alias("found")), "secrets")
    limits = cuts(rows.select(F.explode("found.test").alias("test")).select("test.n", "test.p"), level)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    extra = _kept(F.col("found"), F.col("base"), limits)
    return rows.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]], F.size(extra).cast("long").alias("n_random"),
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", extra))).alias("spans"))


def _hidden(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with each stretch of overlapping or touching spans replaced by ``mark``."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("long").alias("at"))
    piece = lambda a, b: F.substr(text, a.cast("int") + 1, (b - a).cast("int"))

    def step(acc: Column, s: Column) -> Column:
        fresh = (s["start"] > acc["at"]) | (F.size(acc["out"]) == 0)
        return F.struct(
            F.when(fresh, F.concat(acc["out"], F.array(piece(acc["at"], s["start"]), F.lit(mark)))).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"))

    done = F.aggregate(spans, start, step)
    return F.concat(F.array_join(done["out"], ""), F.substr(text, done["at"].cast("int") + 1, F.char_length(text)))


def redact(docs: DataFrame, level: float = LEVEL, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; other texts and all other columns unchanged.

    A null or empty text stays as it is, repeated rows stay repeated, an empty table stays empty.

    Two passes: one over the candidates for the false-discovery control, one that replaces.
    """
    text = F.coalesce("text", F.lit(""))
    tests = keep(docs.select(F.explode(candidates(text)["test"]).alias("test")).select("test.n", "test.p"), "tests")
    limits = cuts(tests, level)
    marked = docs.withColumn("secrets*", base_spans(text))
    marked = marked.withColumn("secrets*", F.array_sort(F.concat(
        F.col("`secrets*`"), _kept(candidates(text), F.col("`secrets*`"), limits))))
    return marked.withColumn("text", F.when(
        F.size("`secrets*`") > 0, _hidden(text, F.col("`secrets*`"), mark)).otherwise(F.col("text"))).select(*quoted(docs))
