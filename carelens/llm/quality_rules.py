"""Quality rules with adaptive cut-offs (native: DataFrame functions only).

Every document gets a few integer measures.  Per (lang, source) group and
measure a *mergeable quantile sketch* is kept: a histogram over logarithmic
integer buckets (64 exact values, then 64 sub-buckets per power of two, so a
quantile is off by 1/64 at most).  A sketch is a set of (bucket, count) rows:
merging is adding counts, so sketches are built with map-side combine, can be
stored per day, and do not depend on order or partitioning.  Groups with too
few documents use the merged sketch of their language, then of everything.

The cut-offs come from the sketch and not from fixed constants: a measure is
an outlier above ``q75 + spread * (q75 - q50) + slack`` (and, for the mean
word length, below ``q25 - spread * (q50 - q25) - slack``).  The documents are
then joined with their group's cut-offs and judged.

Defined results: NULL or blank text has no words and fails the base rule;
NULL lang / source are a group of their own; repeated rows are judged (and
counted) one by one; an empty table gives an empty result; other columns of
the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from carelens.llm.common import BLANKS, let, materialize, text_or_empty, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MANTISSA = 6  # bits: 64 sub-buckets per power of two


@dataclass(frozen=True)
class Rule:
    """``measure`` above (or also below) its group's typical range fails.
    ``slack`` is in the measure's own unit and keeps groups without any
    spread from rejecting the first document that differs."""

    measure: str
    slack: int
    two_sided: bool = False


# Unit: parts per 10,000, but for the mean word length (hundredths of a character).
RULES = (
    Rule("word_length", 100, two_sided=True),
    Rule("symbol_rate", 300),
    Rule("upper_rate", 3000),
    Rule("dup_line_rate", 2000),
    Rule("repeat_rate", 1000),
)
SPREAD = 4
MIN_GROUP = 50


def _repeat_words(ws: Column) -> Column:
    """Words inside a window of 8 words that occurs twice or more.

    Windows are compared by hash first; only texts with equal hashes compare
    the windows themselves (sorted, so repeats are neighbours)."""
    n = F.size(ws) - (WINDOW - 1)
    starts = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(ws, i, WINDOW)))

    def covered(sorted_windows: Column) -> Column:
        last = F.size(sorted_windows) - 1
        same = lambda i, j: sorted_windows[i]["w"] == sorted_windows[j]["w"]
        found = F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.when(
                F.when(i > 0, same(i, F.greatest(i - 1, F.lit(0)))).otherwise(False)
                | F.when(i < last, same(i, F.least(i + 1, last))).otherwise(False),
                sorted_windows[i]["p"],
            ),
        )
        at = F.sort_array(F.filter(found, lambda p: p.isNotNull()))
        start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(-WINDOW).cast("int").alias("last"))
        return F.aggregate(
            at, start,
            lambda a, p: F.struct(
                (a["total"] + F.least(F.lit(WINDOW), p - a["last"])).cast("long").alias("total"),
                p.alias("last")),
            lambda a: a["total"],
        )

    def exact(ws_: Column) -> Column:
        windows = F.transform(
            starts, lambda i: F.struct(F.concat_ws(" ", F.slice(ws_, i, WINDOW)).alias("w"), i.cast("int").alias("p")))
        return let(F.sort_array(windows), covered)

    none = F.lit(0).cast("long")
    repeated = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(n < 2, none).when(repeated, exact(ws)).otherwise(none)


def _rate(part: Column, whole: Column, unit: int = 10_000) -> Column:
    """floor(unit * part / whole), 0 for an empty whole."""
    return F.when(whole > 0, F.floor((part * unit) / F.greatest(whole, F.lit(1)))).otherwise(0).cast("long")


def measures(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """Base counts and rates of every document (no text is carried on)."""
    t = text_or_empty(text)
    d = docs.select(*keep, t.alias("_t"))
    lines = F.filter(F.split("_t", "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    counted = let(
        words(F.col("_t")),
        lambda ws: F.struct(F.size(ws).cast("long").alias("n_words"), _repeat_words(ws).alias("n_repeat_words")))
    line_counts = let(
        lines,
        lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                           (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    size = F.char_length("_t")

    def chars(of: str) -> Column:
        return (size - F.char_length(F.translate("_t", of, ""))).cast("long")

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    d = d.select(
        *keep, counted.alias("_w"), line_counts.alias("_l"),
        F.char_length(F.translate("_t", BLANKS, "")).cast("long").alias("word_chars"),
        chars(SYMBOLS).alias("n_symbols"), chars(upper).alias("n_upper"))
    d = d.select(*keep, "_w.n_words", "word_chars", "n_symbols", "_l.n_dup_lines", "_w.n_repeat_words", "_l.n_lines", "n_upper")
    c = F.col
    return d.select(
        "*",
        _rate(c("word_chars"), c("n_words"), 100).alias("word_length"),
        _rate(c("n_symbols"), c("word_chars")).alias("symbol_rate"),
        _rate(c("n_upper"), c("word_chars")).alias("upper_rate"),
        _rate(c("n_dup_lines"), c("n_lines")).alias("dup_line_rate"),
        _rate(c("n_repeat_words"), c("n_words")).alias("repeat_rate"),
        ((c("n_words") < 20) | (100 * c("n_repeat_words") > 30 * c("n_words"))).alias("base_failed"),
    )


def bucket(value: Column) -> Column:
    """Sketch bucket of a non-negative long (exact below 2^MANTISSA)."""
    shift = F.length(F.bin(value)) - MANTISSA
    return F.when(value < (1 << MANTISSA), value).otherwise(
        shift * (1 << MANTISSA) + F.floor(value / F.pow(F.lit(2.0), shift))).cast("long")


def bucket_low(b: Column) -> Column:
    """Smallest value of a bucket: what the sketch answers."""
    half = 1 << (MANTISSA - 1)
    shift = F.floor((b - half) / (1 << MANTISSA))
    return F.when(b < (1 << MANTISSA), b).otherwise(
        (b - shift * (1 << MANTISSA)) * F.pow(F.lit(2.0), shift)).cast("long")


def sketch(measured: DataFrame, by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """(by..., measure, bucket, n): the mergeable sketches."""
    pairs = F.array(*[F.struct(F.lit(r.measure).alias("measure"), F.col(r.measure).alias("value")) for r in RULES])
    one = measured.select(*by, F.explode(pairs).alias("p")).select(*by, "p.measure", bucket(F.col("p.value")).alias("bucket"))
    return one.groupBy(*by, "measure", "bucket").agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Sketches of coarser groups: counts of equal buckets add up."""
    return sketches.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, by: tuple[str, ...], qs: tuple[int, ...] = (25, 50, 75)) -> DataFrame:
    """(by..., measure, n_docs, q25, q50, q75): the value of the bucket that
    holds the row of rank ceil(q * n / 100).  Windows run over buckets, of
    which there are at most 64 per power of two."""
    w = W.partitionBy(*by, "measure")
    s = sketches.select(
        "*", F.sum("n").over(w).alias("n_docs"),
        F.sum("n").over(w.orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)).alias("upto"))
    return s.groupBy(*by, "measure").agg(
        F.max("n_docs").alias("n_docs"),
        *[F.min(F.when(F.col("upto") * 100 >= F.col("n_docs") * q, bucket_low(F.col("bucket")))).alias(f"q{q}") for q in qs])


def cutoffs(sketches: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """One row per group: n_docs and, per rule, low and high bounds."""
    q = quantiles(sketches, by)
    aggs = [F.max("n_docs").alias("n_docs")]
    for r in RULES:
        own = F.col("measure") == r.measure
        high = F.col("q75") + SPREAD * (F.col("q75") - F.col("q50")) + r.slack
        low = F.col("q25") - SPREAD * (F.col("q50") - F.col("q25")) - r.slack
        aggs.append(F.max(F.when(own, high)).alias(f"{r.measure}_high"))
        if r.two_sided:
            aggs.append(F.max(F.when(own, low)).alias(f"{r.measure}_low"))
    return q.groupBy(*by).agg(*aggs)


def quality_rules(spark: SparkSession, docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, lang, source, the base counts, the measures, ``base_failed``,
    ``level`` (whose cut-offs were used: 0 group, 1 language, 2 all) and
    ``kept``."""
    measured = materialize(spark, measures(docs, text), "quality-measures")
    judged = measured.where(~F.col("base_failed"))
    # Sketches describe documents that pass the base rule; they are small
    # and written once, as three levels are made from them.
    by = ("lang", "source")
    fine = materialize(spark, sketch(judged, by), "quality-sketches")
    bounds = [f"{r.measure}_high" for r in RULES] + [f"{r.measure}_low" for r in RULES if r.two_sided]
    groups = cutoffs(fine, by).alias("g")
    langs = cutoffs(merge(fine, ("lang",)), ("lang",)).alias("l")
    # The merged sketch of everything yields one row of cut-offs: literals.
    everything = cutoffs(merge(fine, ()).withColumn("_all", F.lit(1)), ("_all",)).first()
    of_all = {b: F.lit(everything[b] if everything else None).cast("long") for b in bounds}
    level = F.when(F.col("g.n_docs") >= MIN_GROUP, 0).when(F.col("l.n_docs") >= MIN_GROUP, 1).otherwise(2)
    table = (
        groups.join(langs, F.col("g.lang").eqNullSafe(F.col("l.lang")), "left")
        .select(F.col("g.lang").alias("_lang"), F.col("g.source").alias("_source"), level.alias("level"),
                *[F.when(level == 0, F.col(f"g.{b}")).when(level == 1, F.col(f"l.{b}")).otherwise(of_all[b]).alias(b)
                  for b in bounds]))
    j = measured.join(
        table, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    bad = F.lit(False)
    for r in RULES:
        bad = bad | F.coalesce(F.col(r.measure) > F.col(f"{r.measure}_high"), F.lit(False))
        if r.two_sided:
            bad = bad | F.coalesce(F.col(r.measure) < F.col(f"{r.measure}_low"), F.lit(False))
    return j.select(*measured.columns, "level", (~F.col("base_failed") & ~bad).alias("kept"))
