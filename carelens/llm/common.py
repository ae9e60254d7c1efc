"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.session import ship_package
from carelens.sources.sinks import materialize

# The white space that separates words: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"

__all__ = ["BLANKS", "BLANK_RUN", "WORD_PATTERN", "let", "materialize", "n_words", "read_table", "running", "ship_package", "text_or_empty", "words"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row: inside ``body``
    it is a bound variable, so the optimizer cannot inline it again."""
    return F.transform(F.array(value), body)[0]


def text_or_empty(col: str | Column) -> Column:
    """The text, NULL as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")


def words(text: Column) -> Column:
    """The words (runs of non-blanks) of a text, in order; none for ''."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN, -1))


def n_words(text: Column) -> Column:
    """Number of words, without building them."""
    return F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long")


def running(values: Column, combine: Callable[[Column, Column], Column], block: int = 256) -> Column:
    """Exclusive running ``combine`` of a non-empty array of longs, starting
    from 0: element i covers the values before i.

    Arrays grow by copying, so one long loop would be quadratic; the values
    are cut into blocks, each block runs on its own from the running result
    of the blocks before it."""
    zero = F.lit(0).cast("long")

    def run(xs: Column, base: Column) -> Column:
        start = F.struct(base.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(
            xs, start,
            lambda acc, x: F.struct(combine(acc["at"], x).cast("long").alias("at"),
                                    F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"])

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int")),
        lambda b: F.slice(values, b * block + 1, F.lit(block)))
    return let(blocks, lambda bs: F.flatten(F.zip_with(
        bs, run(F.transform(bs, lambda b: F.aggregate(b, zero, lambda a, x: combine(a, x).cast("long"))), zero), run)))
