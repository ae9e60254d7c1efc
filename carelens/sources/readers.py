"""Readers for the six inputs: CSV, parquet and JDBC, plus the daily
snapshot filter, chunk union and preview.

Every reader returns the canonical schema (``schemas.SCHEMAS``): raw names
renamed at read, declared types, text dates parsed with a coerce-to-NULL
rule.  Nothing is inferred and nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.functions.expr import key_text, parse_ts
from carelens.sources.schemas import DEFAULT_TS_FORMATS, RAW_NAMES, SCHEMAS
from carelens.sources.sinks import scratch_path


def canonical_columns(df: DataFrame, source: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rename raw upstream names to canonical ones (P1).  Columns of the
    canonical schema that are absent come back as typed NULLs; ``keep``
    names extra columns (e.g. tie-break columns) to carry along."""
    renames = {k: v for k, v in RAW_NAMES[source].items() if k in df.columns}
    if renames:
        df = df.withColumnsRenamed(renames)
    cols: list[Column] = []
    for field in SCHEMAS[source].fields:
        if field.name in df.columns:
            cols.append(F.col(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    cols += [F.col(k) for k in keep if k not in SCHEMAS[source].fieldNames()]
    return df.select(*cols)


def coerce_types(
    df: DataFrame, source: str, ts_formats: Iterable[str] = DEFAULT_TS_FORMATS
) -> DataFrame:
    """Cast canonical columns to their declared types.  Text timestamps that
    do not parse and text numbers that are not numbers become NULL (P2);
    numbers read as keys become plain digits, by the type they are stored in
    (P3).  ``ts_formats`` are this source's date patterns: ``DAY_FIRST`` or
    ``MONTH_FIRST`` where the source writes such dates."""
    fmts = tuple(ts_formats)
    out = []
    for c in df.columns:
        field = next((f for f in SCHEMAS[source].fields if f.name == c), None)
        if field is None:
            out.append(F.col(c))
            continue
        have = df.schema[c].dataType
        want = field.dataType
        if have == want:
            out.append(F.col(c))
        elif isinstance(want, T.TimestampNTZType):
            if isinstance(have, T.StringType):
                out.append(parse_ts(F.col(c), fmts).alias(c))
            else:
                out.append(F.col(c).try_cast(want).alias(c))
        elif isinstance(want, T.StringType):
            out.append(key_text(F.col(c), have).alias(c))
        else:
            out.append(F.col(c).try_cast(want).alias(c))
    return df.select(*out)


def with_line_numbers(df: DataFrame, name: str = "line_no") -> DataFrame:
    """``df``, a plain scan of files, with the number of each row in upstream
    order: files by path, rows of a file as they stand in it.

    A row's place is that of its split (file path and block start) plus its
    place among the split's rows; one pass that reads no column counts the rows
    of every split.  So the numbers do not depend on which task reads a split,
    on re-execution, or on how finely files are split."""
    place = F.monotonically_increasing_id()  # rises within a task, so within each of its splits
    at = {"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"), "_place": place}
    splits = df.select(*[c.alias(n) for n, c in at.items()]).groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    # One row for each split of the input.
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("_file", "_block", (before - F.col("_first")).alias("_offset"))
    rows = df.select("*", *[c.alias(n) for n, c in at.items()])
    return rows.join(splits, ["_file", "_block"], "left").select(*df.columns, (F.col("_place") + F.col("_offset")).alias(name))


def read_csv(
    spark: SparkSession,
    path: str,
    source: str,
    limit: int | None = None,
    ts_formats: Iterable[str] = DEFAULT_TS_FORMATS,
    keep: Sequence[str] = (),
    line_numbers: str | None = None,
) -> DataFrame:
    """CSV scan (S4): header, every column read as text (no inference), then
    renamed and typed.  ``limit`` caps rows only when asked for (default:
    whole file).  ``line_numbers`` names a column that gives the rows' order in
    the file, for ``Sources.order``; a limit then means the first rows."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if line_numbers:
        raw = with_line_numbers(raw, line_numbers)
        keep = (*keep, line_numbers)
        if limit is not None:
            raw = raw.where(F.col(line_numbers) < limit)
    elif limit is not None:
        raw = raw.limit(limit)
    return coerce_types(canonical_columns(raw, source, keep), source, ts_formats)


@dataclass(frozen=True)
class Loaded:
    """A CSV input as loaded: its rows, the lines that were no rows (their
    text), and how many values of each column did not parse."""

    rows: DataFrame
    quarantine: DataFrame
    n_rows: int
    n_malformed: int
    lost: dict[str, int]


def load_csv(
    spark: SparkSession,
    path: str,
    source: str,
    ts_formats: Iterable[str] = DEFAULT_TS_FORMATS,
    names: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> Loaded:
    """CSV load with an account of what it lost, in one scan: lines with too
    many or too few fields go to a side table, and values that are there but
    become missing when they are typed (``errors='coerce'``) are counted by the
    pass that writes the typed rows.  ``names`` are the fields of files without
    a header."""
    columns = list(names) if names else spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, "_malformed")])
    raw = spark.read.schema(schema).option("header", names is None).option("columnNameOfCorruptRecord", "_malformed").csv(path)
    df = canonical_columns(raw, source, (*keep, "_malformed"))
    typed = [f.name for f in SCHEMAS[source].fields if not isinstance(f.dataType, T.StringType) and f.name in df.columns]
    both = coerce_types(df.select("*", *[F.col(c).cast("string").alias(f"_raw_{c}") for c in typed]), source, ts_formats)
    sound = F.col("_malformed").isNull()
    account, seen = [F.count_if(sound).alias("_rows"), F.count_if(~sound).alias("_bad")], Observation()
    account += [F.count_if(sound & (F.trim(f"_raw_{c}") != "") & F.col(c).isNull()).alias(c) for c in typed]
    out = both.observe(seen, *account).drop(*[f"_raw_{c}" for c in typed]).withColumn("_is_row", sound)
    table = scratch_path(spark, f"loaded-{source}")
    out.write.partitionBy("_is_row").parquet(table)
    back = spark.read.schema(out.schema).parquet(table)
    got = seen.get
    return Loaded(back.where("_is_row").drop("_malformed", "_is_row"), back.where("NOT _is_row").select(F.col("_malformed").alias("line")),
                  got["_rows"], got["_bad"], {c: got[c] for c in typed})


def read_parquet(
    spark: SparkSession,
    path: str,
    source: str,
    keep: Sequence[str] = (),
    ts_formats: Iterable[str] = DEFAULT_TS_FORMATS,
) -> DataFrame:
    df = spark.read.parquet(path)
    return coerce_types(canonical_columns(df, source, keep), source, ts_formats)


def jdbc_options(
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    fetchsize: int = 10_000,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``.

    A plain ``query`` is read by one task.  With ``partition_column`` the read
    is split into ``num_partitions`` range queries; Spark requires ``dbtable``
    for that, so a query is wrapped as a derived table.  URL and credentials
    come only from the arguments.
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table= or query=")
    opts: dict[str, str] = {"url": url, "fetchsize": str(fetchsize)}
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC reads need bounds and num_partitions")
        opts["dbtable"] = table if table is not None else f"({query}) src"
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    elif table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query  # type: ignore[assignment]
    opts.update(dict(properties or {}))
    return opts


def read_jdbc(spark: SparkSession, source: str, **kwargs) -> DataFrame:
    """JDBC scan of one input, renamed and typed like the file readers."""
    df = spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()
    return coerce_types(canonical_columns(df, source), source)


def daily_snapshot(df: DataFrame, date_col: str, day: str | date | datetime) -> DataFrame:
    """Rows whose ``date_col`` falls on ``day`` (S2).  Written as a half-open
    range so parquet/JDBC sources receive it as pushed filters."""
    if isinstance(day, str):
        day = date.fromisoformat(day[:10])
    if isinstance(day, datetime):
        day = day.date()
    start = datetime(day.year, day.month, day.day)
    end = start + timedelta(days=1)
    c = F.col(date_col)
    return df.where(
        (c >= F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz"))
        & (c < F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz"))
    )


# The date column each daily pull goes by.
DAILY_COLUMNS = {"contracts": "AMCPostingDate", "calls": "PostingDate", "spares": "CallBookDate"}


def daily_pull(sources: Mapping[str, DataFrame], day: str | date | datetime) -> dict[str, DataFrame]:
    """The day's rows of the three tables that are pulled daily."""
    return {name: daily_snapshot(sources[name], c, day) for name, c in DAILY_COLUMNS.items()}


def yearly_pieces(df: DataFrame, date_col: str, years: Iterable[int]) -> list[DataFrame]:
    """A table cut by calendar year into half-open ranges, which reach the
    scan as pushed filters; the first piece also has what is earlier or
    undated, the last what is later."""
    years = list(years)
    c, start = F.col(date_col), lambda y: F.lit(f"{y}-01-01 00:00:00").cast("timestamp_ntz")
    pieces = [df.where(c.isNull()), df.where(c < start(years[0]))]
    pieces += [df.where((c >= start(y)) & (c < start(y + 1))) for y in years]
    return [*pieces, df.where(c >= start(years[-1] + 1))]


def union_chunks(chunks: Iterable[DataFrame]) -> DataFrame:
    """Concatenate pieces of one table (S3/O4): a lazy ``unionByName``; no
    data moves until an action runs."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), list(chunks))


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows by key (S7/O3): a top-n, so each task keeps n rows."""
    return df.orderBy(*order_by).limit(n)
