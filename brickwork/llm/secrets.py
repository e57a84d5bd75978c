"""Secret spans: three known patterns and a battery of randomness tests, in SQL functions only.

Long tokens with letters and digits are candidates. Each is read in the narrowest encoding that
holds its characters, and tested for randomness in it: chi-squared uniformity over eight cells of the
alphabet, Wald-Wolfowitz runs about the middle of the alphabet, and lag-1 serial correlation; Fisher's
method joins the three p-values. Randomness is the null hypothesis. Benjamini-Hochberg over all the
corpus's candidates, apart for each octave of length, rejects those that are not random, at a level
that is higher for short tokens, which carry less evidence; those that it leaves are secrets. So the
level bounds how many random tokens are missed, not how many others are taken for random ones.

Defined results: a null text is empty; an empty one has no spans; spans that only the tests find and
that touch a pattern's span are not added; repeated rows and rows without doc_id are scanned each; further
columns are kept by `redact`, whatever their names, and ignored by `scan`; an empty table gives no rows. Of the corpus only the counts of p-values by bin, at most
MOST_OCTAVES x BINS numbers, come to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brickwork.llm import common as C

# The patterns of the three kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # as AKIA[A-Z0-9]+ of 16 characters: a shorter run holds no longer one
HEX = r"[0-9a-f]{32,}"  # as [0-9a-f]+ of 32
KINDS = ["assign", "access", "hex", "random"]
LEAST_VALUE = 8

CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}"
#: Encodings from narrow to wide: what their tokens match, and the alphabet in order.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = [
    ("^[0-9a-f]+$", DIGITS + LOWER[:6]),
    ("^[0-9A-F]+$", DIGITS + UPPER[:6]),
    ("^[A-Z2-7]+$", UPPER + "234567"),
    ("^[0-9a-z]+$", DIGITS + LOWER),
    ("^[0-9A-Z]+$", DIGITS + UPPER),
    ("^[0-9A-Za-z]+$", UPPER + LOWER + DIGITS),
    ("^[0-9A-Za-z+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("^[0-9A-Za-z_-]+$", UPPER + LOWER + DIGITS + "-_"),
    ("", UPPER + LOWER + DIGITS + "+/-_"),
]
CELLS = 8
RUN = 256
#: p-values are binned by their logarithm, so many bins to a power of ten.
FINE, BINS, MOST_OCTAVES = 20, 600, 32


@dataclass(frozen=True)
class SecretConfig:
    #: False-discovery level for tokens of 16 to 31 characters; it halves with each octave.
    level: float = 0.2
    mark: str = "[SECRET]"


NO_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, probe: str, pattern: str, kind: int, least: int = 0) -> Column:
    """The matches of a pattern, whose second group has least characters, as structs (start, kind, end) in code points.

    Only texts that match the probe are split. What lies before the matches and their lengths add up to their places.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if least else whole
    pairs = F.zip_with(whole, value, lambda m, v: F.struct(F.length(m).alias("n"), (F.length(v) >= least).alias("ok")))
    rows = F.filter(F.zip_with(pairs, F.split(text, pattern, -1), lambda x, before: F.struct(F.length(before).alias("before"), x.n.alias("n"), x.ok.alias("ok"))), lambda x: x.n.isNotNull())
    # an array grows by copying, so places are added up in runs of RUN matches, and over the runs' sums
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / RUN).cast("int")), lambda i: F.slice(rows, i * RUN + 1, RUN))
    begins = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    starts = F.aggregate(runs, begins, lambda acc, run: F.struct((acc.at + F.aggregate(run, F.lit(0), lambda a, x: a + x.before + x.n)).alias("at"), F.concat(acc.out, F.array(acc.at)).alias("out")), lambda acc: acc.out)

    def run_placed(run: Column, at: Column) -> Column:
        none = F.struct(at.alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int,ok:boolean>>").alias("out"))
        return F.aggregate(run, none, lambda acc, x: F.struct((acc.at + x.before + x.n).alias("at"), F.concat(acc.out, F.array(F.struct((acc.at + x.before).alias("start"), F.lit(kind).alias("kind"), (acc.at + x.before + x.n).alias("end"), x.ok.alias("ok")))).alias("out")), lambda acc: acc.out)

    placed = F.when(F.size(rows) > 0, F.flatten(F.zip_with(runs, starts, run_placed)))
    found = F.transform(F.filter(placed, lambda s: s.ok), lambda s: F.struct(s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end")))
    return F.when(text.rlike(probe), F.coalesce(found, F.array().cast(NO_SPANS))).otherwise(F.array().cast(NO_SPANS))


def _p_value(token: Column) -> Column:
    """The joint p-value of the battery for a token, under randomness in its encoding."""
    alphabet = None
    for pattern, letters in reversed(ENCODINGS):
        alphabet = F.lit(letters) if alphabet is None else F.when(token.rlike(pattern), F.lit(letters)).otherwise(alphabet)
    built = F.transform(F.array(F.struct(token.alias("t"), alphabet.alias("a"))), lambda x: F.struct(F.length(x.a).cast("double").alias("k"), F.length(x.t).cast("double").alias("n"), F.transform(F.split(x.t, ""), lambda c: (F.instr(x.a, c) - 1).cast("double")).alias("v")))

    def statistics(x: Column) -> Column:
        mean = F.aggregate(x.v, F.lit(0.0), lambda a, b: a + b) / x.n
        cells = F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), lambda g: F.struct(F.size(F.filter(x.v, lambda i: F.floor(i * CELLS / x.k) == g)).cast("double").alias("o"), (x.n * (F.ceil((g + 1) * x.k / CELLS) - F.ceil(g * x.k / CELLS)) / x.k).alias("e")))
        high = F.transform(x.v, lambda i: F.when(i >= x.k / 2, 1.0).otherwise(0.0))
        n1 = F.aggregate(high, F.lit(0.0), lambda a, b: a + b)
        runs = 1 + F.aggregate(F.zip_with(F.slice(high, 1, F.size(high) - 1), F.slice(high, 2, F.size(high)), lambda a, b: F.abs(a - b)), F.lit(0.0), lambda a, b: a + b)
        return F.struct(x.n.alias("n"), x.v.alias("v"), mean.alias("mean"), F.aggregate(cells, F.lit(0.0), lambda a, c: a + (c.o - c.e) * (c.o - c.e) / c.e).alias("chi"), n1.alias("n1"), (x.n - n1).alias("n2"), runs.alias("runs"))

    def scores(x: Column) -> Column:
        off = F.transform(x.v, lambda i: i - x["mean"])
        square = F.aggregate(off, F.lit(0.0), lambda a, b: a + b * b)
        lag = F.aggregate(F.zip_with(F.slice(off, 1, F.size(off) - 1), F.slice(off, 2, F.size(off)), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        df = CELLS - 1
        z_chi = (F.pow(x.chi / df, 1 / 3) - (1 - 2 / (9 * df))) / (2 / (9 * df)) ** 0.5
        expected = 2 * x.n1 * x.n2 / x.n + 1
        variance = F.greatest((expected - 1) * (expected - 2) / (x.n - 1), F.lit(0.25))
        z_runs = F.abs(x.runs - expected) / F.sqrt(variance)
        z_lag = F.abs(F.coalesce(F.try_divide(lag, square), F.lit(1.0)) + 1 / x.n) * F.sqrt(x.n)
        return F.struct(z_chi.alias("z_chi"), z_runs.alias("z_runs"), z_lag.alias("z_lag"))

    rows = F.transform(F.transform(built, statistics), scores)
    tails = F.transform(rows, lambda z: F.transform(F.array(z.z_chi, z.z_runs, z.z_lag), lambda s: F.abs(s) / 2**0.5))
    both = F.transform(tails, lambda a: F.transform(a, lambda u: F.greatest(_erfc(u), F.lit(1e-30))))
    # chi-squared counts one tail only: too even is no sign of text
    upper = F.zip_with(rows, both, lambda z, p: F.struct(F.when(z.z_chi >= 0, p[0] / 2).otherwise(1 - p[0] / 2).alias("a"), p[1].alias("b"), p[2].alias("c")))
    half = F.transform(upper, lambda p: -F.log(p.a) - F.log(p.b) - F.log(p.c))
    return F.get(F.transform(half, lambda h: F.least(F.exp(-h) * (1 + h + h * h / 2), F.lit(1.0))), F.lit(0))


def _erfc(u: Column) -> Column:
    t = 1 / (1 + F.lit(0.3275911) * u)
    return t * (F.lit(0.254829592) + t * (F.lit(-0.284496736) + t * (F.lit(1.421413741) + t * (F.lit(-1.453152027) + t * F.lit(1.061405429))))) * F.exp(-u * u)


def _found(rows: DataFrame) -> DataFrame:
    """rows (a struct `row` with text) with text, base (pattern spans) and tested (candidates with octave and p)."""
    t = F.col("text")
    found = rows.withColumn("text", F.coalesce(F.col("row.text"), F.lit("")))
    base = F.concat(_spans(t, "(?i)passw|secret|token|api_?key", ASSIGN, 0, LEAST_VALUE), _spans(t, "AKIA", ACCESS, 1), _spans(t, HEX, HEX, 2))
    found = found.withColumn("base", F.array_sort(base))
    token = lambda s: F.substring(t, s.start + 1, s.end - s.start)
    # a candidate is a whole run of its characters, which hold those of access and hex: their spans touch it if they lie in it
    assigned = lambda s: F.exists("base", lambda b: (b.kind == 0) & (b.start < s.end) & (s.start < b.end))
    free = F.filter(_spans(t, CANDIDATE, CANDIDATE, 3), lambda s: ~token(s).rlike(HEX) & ~token(s).rlike(ACCESS) & ~assigned(s))
    found = found.withColumn("free", free)
    tested = F.transform("free", lambda s: F.struct(s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end"), F.floor(F.log2((s.end - s.start).cast("double"))).cast("int").alias("octave"), _p_value(token(s)).alias("p")))
    return found.withColumn("tested", tested).drop("free")


def _bin(p: Column) -> Column:
    return F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * FINE), F.lit(BINS - 1)).cast("int")


def rejected(found: DataFrame, cfg: SecretConfig) -> dict[int, int]:
    """By octave of length, the first bin that Benjamini-Hochberg rejects as not random; a bin holds the more significant p, the higher it is."""
    counts: dict[int, dict[int, int]] = {}
    # one row for each octave and bin: bounded by MOST_OCTAVES x BINS
    for octave, b, n in found.select(F.explode("tested").alias("s")).groupBy(F.col("s.octave"), _bin(F.col("s.p"))).count().collect():
        counts.setdefault(octave, {})[b] = n
    out = {}
    for octave, bins in counts.items():
        total, level, seen = sum(bins.values()), cfg.level / 2 ** max(0, octave - 4), 0
        for b in sorted(bins, reverse=True):
            seen += bins[b]
            if 10 ** (-b / FINE) <= level * seen / total:
                out[octave] = b
    return out


def _all(found: DataFrame, cfg: SecretConfig) -> DataFrame:
    """found with spans, those of all kinds by start, then kind."""
    limits = rejected(found, cfg)
    limit_map = F.create_map(*[F.lit(x) for pair in sorted(limits.items()) for x in pair]) if limits else None

    def kept(s: Column) -> Column:
        return _bin(s.p) < (F.coalesce(F.try_element_at(limit_map, s.octave), F.lit(BINS)) if limit_map is not None else F.lit(BINS))

    added = F.transform(F.filter("tested", kept), lambda s: F.struct(s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end")))
    return found.withColumn("spans", F.array_sort(F.concat("base", added)))


def _shown(spans: str) -> Column:
    names = F.array(*[F.lit(x) for x in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")


def _number(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{KINDS[kind]}")


def scan(docs: DataFrame, cfg: SecretConfig | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row."""
    # written without texts, so that the battery runs once
    tested = C.written(_found(docs.select(F.struct("doc_id", "text").alias("row"))).select("row.doc_id", "base", "tested"), "tested")
    found = _all(tested, cfg or SecretConfig())
    counts = [_number(k) for k in range(3)]
    return found.select("doc_id", *counts, F.sha2(_shown("base"), 256).alias("base_sha256"), _shown("spans").alias("spans"))


def redact(docs: DataFrame, cfg: SecretConfig | None = None) -> DataFrame:
    """docs with each run of overlapping spans in text replaced by cfg.mark, and n_chars anew where there is such a column."""
    cfg = cfg or SecretConfig()
    tested = C.written(_found(docs.select(F.struct("*").alias("row"))).drop("text"), "tested")
    found = _all(tested, cfg).withColumn("text", F.col("row.text"))
    mark = cfg.mark.replace("'", "\\'")
    cleaned = F.expr(f"""aggregate(spans, named_struct('at', 0, 'out', ''), (acc, s) ->
      CASE WHEN s.start >= acc.at THEN named_struct('at', s.end, 'out', concat(acc.out, substring(text, acc.at + 1, s.start - acc.at), '{mark}'))
           ELSE named_struct('at', greatest(acc.at, s.end), 'out', acc.out) END,
      acc -> concat(acc.out, substring(text, acc.at + 1)))""")
    has = F.size("spans") > 0
    out = found.withColumn("cleaned", F.when(has, cleaned).otherwise(F.col("text")))
    kept = lambda c: F.col("row").getField(c)
    chars = F.when(has, F.length("cleaned").cast("long")).otherwise(kept("n_chars")) if "n_chars" in docs.columns else None
    return out.select(*[(F.col("cleaned") if c == "text" else chars if c == "n_chars" else kept(c)).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(C.table(spark, sf_dir, "documents"))
