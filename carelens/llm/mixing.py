"""Mixing sources to target weights by weighted fair queueing.

Each source owns a share of the total budget (``targets``).  Its documents are
shuffled by a seeded hash of id and text (so that rows of one id, or of none,
are spread over the queue like any others) and queued, up to three times over; a copy's virtual
finish time is the source's cumulated words up to and including it, divided by
the source's target.  All copies are put in one global order by finish time
and the order is cut where the total budget is reached.  Every source so
advances at the pace of its target, and any prefix of the order is a mix of
the right proportions.

Both running sums are two-level: rows are dealt to many small ranges of the
order, the ranges' totals are summed up in a window of their own (one row per
range), and inside a range the sum runs over its rows only.  No task holds a
source or the whole order.

Defined results: NULL text has size 0; a NULL source is a source (the last
one); a NULL doc_id counts as an id; repeated rows are queued one by one, side by
side; documents of size 0 are never taken; an empty table, or one without words,
gives targets of 0; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from carelens.llm.common import materialize, n_words, text_or_empty

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
LEAST_RANGE = 500  # rows aimed at per range of the running sums, at least
SEED = "mix-1"


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """From (source, source_size): each source's ``target``.

    Sources in code point order, NULL last, weigh ``weights`` in turn.  A
    target stops at ``repeats`` times its source; what is over goes to the
    others by weight, until none is above.  That fixed point is the water
    level at which the targets use up the budget: with the sources sorted by
    cap / weight, the level is the remaining budget over the remaining weight
    at the first source that it does not fill.  Windows run over sources."""
    order = W.orderBy(F.col("source").isNull(), "source")
    w = F.array(*[F.lit(x) for x in weights])
    s = sources.withColumn("weight", w[(F.row_number().over(order) - 1) % len(weights)].cast("double"))
    s = s.withColumn("cap", (F.col("source_size") * repeats).cast("double"))
    everyone = W.partitionBy(F.lit(0))
    fill = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumn("left_size", F.sum("source_size").over(everyone).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    s = s.withColumn("left_weight", F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("own_level", F.col("left_size") / F.col("left_weight"))
    s = s.withColumn("level", F.max(F.when(F.col("own_level") * F.col("weight") <= F.col("cap"), F.col("own_level"))).over(everyone))
    full = F.col("level").isNull() | (F.col("cap") < F.col("level") * F.col("weight"))
    return s.select("source", "source_size", "weight", F.when(full, F.col("cap")).otherwise(F.col("level") * F.col("weight")).alias("target"))


def _shuffle_key(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.md5(text.cast("binary"))).cast("binary"))


def fair_queue(spark: SparkSession, docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: row_id, doc_id, source, size, source_size,
    target, copies (0 to 3) and taken (copies * size), and ``carry``."""
    sized = materialize(spark, docs.select(
        *carry,
        F.monotonically_increasing_id().alias("row_id"), "doc_id", "source",
        n_words(text_or_empty(text)).alias("size"), _shuffle_key(F.col("doc_id"), text_or_empty(text)).alias("key")), "mix-sizes")
    sources = materialize(spark, sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs")), "mix-sources")
    plan = targets(sources)
    n_rows, total = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    # About as many ranges as rows in a range: neither the ranges' totals nor
    # a range's rows become large.
    range_rows = max(LEAST_RANGE, 2 * math.isqrt(n_rows))

    # Place in the source's shuffled queue: the key's leading digits choose
    # the range, and a large source has more of them.
    q = sized.join(
        sources.select(
            F.col("source").alias("_source"), F.ceil(F.col("n_docs") / range_rows).alias("ranges")),
        F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    q = q.drop(*carry).withColumn("part", F.floor(
        F.conv(F.substring("key", 1, 8), 16, 10).cast("double") * F.col("ranges") / float(1 << 32)).cast("int"))
    # One row per (source, range), made from one row per source; no NULL keys in the join.
    named = [F.coalesce(F.col("source"), F.lit("")).alias("_s"), F.col("source").isNull().alias("_n")]
    heads = (
        q.groupBy("source", "part").agg(F.sum("size").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(
            W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .select(*named, "part", "before"))
    plan = plan.select(*named, "source_size", "target")
    per_part = heads.join(plan, ["_s", "_n"])
    inside = F.sum("size").over(
        W.partitionBy("_s", "_n", "part").orderBy("key", "doc_id", "size", "row_id").rowsBetween(W.unboundedPreceding, 0))
    queued = (
        q.select("*", *named).withColumn("inside", inside)
        .join(per_part, ["_s", "_n", "part"])
        .where((F.col("size") > 0) & (F.col("target") > 0)))
    copies = queued.select(
        "row_id", "size", "key", "doc_id", F.explode(F.sequence(F.lit(0), F.lit(MAX_REPEATS - 1))).alias("round"),
        "source_size", "before", "inside", "target")
    done = (F.col("round") * F.col("source_size") + F.col("before") + F.col("inside")).cast("double") / F.col("target")
    copies = materialize(spark, copies.select("row_id", "size", "key", "doc_id", "round", done.alias("finish")), "mix-queue")

    # Global order by finish time, cut at the budget.  Ranges of equal width
    # in finish time: within the budget every source moves at its own pace,
    # so the words are spread evenly over time.
    ranges = max(1, -(-n_rows * MAX_REPEATS // range_rows))
    steps = ranges * MAX_REPEATS
    step = F.least(F.floor(F.col("finish") * ranges), F.lit(steps)).cast("int")
    ordered = copies.withColumn("step", step)
    sums = ordered.groupBy("step").agg(F.sum("size").alias("n"))
    sums = sums.withColumn("before", F.coalesce(
        F.sum("n").over(W.orderBy("step").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    # A range either lies before the cut, after it, or holds it: only rows of
    # that one range need their own running sum.
    cut = sums.where((F.col("before") <= total) & (F.col("before") + F.col("n") > total)).first()
    cut_step, cut_before = (cut["step"], cut["before"]) if cut else (steps + 1, 0)
    upto = F.sum("size").over(
        W.partitionBy("step").orderBy("finish", "key", "doc_id", "size", "round", "row_id").rowsBetween(W.unboundedPreceding, 0))
    taken = ordered.where(F.col("step") < cut_step).select("row_id").unionByName(
        ordered.where(F.col("step") == cut_step).withColumn("upto", upto)
        .where(F.col("upto") + F.lit(cut_before) <= total).select("row_id"))
    counts = taken.groupBy("row_id").agg(F.count("*").cast("int").alias("copies"))
    sources_of = sized.select("*", *named).join(plan, ["_s", "_n"])
    return (
        sources_of.join(counts, "row_id", "left")
        .withColumn("copies", F.coalesce(F.col("copies"), F.lit(0)))
        .select(*carry, "row_id", "doc_id", "source", "size", "source_size", "target", "copies",
                (F.col("copies") * F.col("size")).cast("long").alias("taken")))
