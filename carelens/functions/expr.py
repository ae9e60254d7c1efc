"""Column expressions shared by every summary.

All of these are plain Catalyst expressions (no Python UDFs), so they stay
inside whole-stage codegen.  They pin down the missing-value, division and
day-count semantics the feature definitions rely on (see README, "Semantics").
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_MICROS = 86_400_000_000
EPOCH_NTZ = "1970-01-01 00:00:00"

# Text a missing key turns into; every source uses the same form so that keys agree.
NULL_KEY = "nan"

# Sums are taken exactly over whole parts and over fractions in units of
# 10**-FRACTION_DIGITS, so that they do not depend on row order, partitioning
# or re-execution.
FRACTION_DIGITS = 18
# Whole parts from here on are summed as doubles (no finite value is lost).
LARGE = 1e18
# Bits of each part of a whole number in exact sums.
PART_BITS = 20

INF = float("inf")
NAN = float("nan")

# These lookups must equal the reference's for identical results.
CATEGORY_CODES = {"AC": 1, "DW": 2, "MW": 3, "WM": 4}
CONVERSION_PRIORITY = {
    "AMC to AMC": 7,
    "EW to AMC": 6,
    "IW to AMC": 5,
    "IW to EW": 4,
    "OG to AMC": 3,
    "WTY to MTY": 2,
    "OG to EW": 1,
}


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------- keys


def key_text(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """Key to canonical text, missing stays NULL.

    One rule for every input and every stored type: integral numbers are
    plain digits without leading zeros or a fraction (``123``, ``123.0`` and
    ``0000123`` are the same key), other text is trimmed.  ``dtype`` is the
    column's type as stored, known at plan time."""
    c = col_(c)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("string")
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        # 1e8 would print as 1.0E8; go through a decimal for integral values.
        d = c.cast("double")
        whole = ~F.isnan(d) & (F.abs(d) < F.lit(1e37)) & (c == F.floor(c))
        text = F.when(whole, c.cast("decimal(38,0)").cast("string")).otherwise(c.cast("string"))
        return F.when(F.isnan(d), F.lit(None)).otherwise(text)
    text = F.trim(c.cast("string"))
    plain = F.regexp_replace(F.regexp_replace(text, r"\.0*$", ""), r"^0+(?=[0-9])", "")
    odd = (text.startswith("0") | text.contains(".")) & text.rlike(r"^[0-9]+(\.0*)?$")
    return F.when(odd, plain).otherwise(text)


def norm_key(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """``key_text`` with missing as ``'nan'``."""
    return F.coalesce(key_text(c, dtype), F.lit(NULL_KEY))


def strict_int_key(c: str | Column) -> Column:
    """Numeric key to digits (a fraction is cut).  Under ANSI mode a
    non-numeric value raises instead of silently turning into NULL."""
    return col_(c).cast("decimal(38,6)").cast("bigint").cast("string")


# --------------------------------------------------------------------------- time


def epoch_ntz() -> Column:
    return F.lit(EPOCH_NTZ).cast("timestamp_ntz")


def floor_days(later: str | Column, earlier: str | Column) -> Column:
    """Whole days from ``earlier`` to ``later``, floored (-26 h -> -2).
    NULL when either side is NULL.

    Zone-free timestamps subtract to an exact day-time interval; its day
    field is truncated toward zero, so one is taken off when the interval
    is below that whole number of days.
    """
    iv = col_(later) - col_(earlier)
    d = F.extract(F.lit("DAY"), iv)
    return F.when(iv < F.make_dt_interval(d), d - 1).otherwise(d).cast("bigint")


def day_index(ts: str | Column) -> Column:
    """Calendar day number of a timestamp (whole days since 1970-01-01)."""
    return floor_days(ts, epoch_ntz())


def desc_time_key(ts: str | Column) -> Column:
    """Sort key that orders later timestamps first (an interval, so no
    conversion through time zones)."""
    return epoch_ntz() - col_(ts)


def as_of_lit(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def age_days(ts: str | Column, as_of: str) -> Column:
    """Whole days from ``ts`` to the ``as_of`` timestamp."""
    return floor_days(as_of_lit(as_of), ts)


def parse_ts(c: str | Column, formats: Iterable[str] = ()) -> Column:
    """Text to zone-free timestamp; unparseable text becomes NULL.

    ISO forms are tried first, then each ``formats`` pattern in turn.
    """
    c = col_(c)
    tries = [c.try_cast("timestamp_ntz")]
    for fmt in formats:
        tries.append(F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz"))
    return F.coalesce(*tries)


# --------------------------------------------------------------------------- arithmetic


def ieee_div(a: str | Column, b: str | Column) -> Column:
    """a / b with IEEE results for a zero divisor: +-inf by the sign of a,
    NaN for 0/0 (ANSI mode would raise).  NULL when either side is NULL."""
    a = col_(a).cast("double")
    b = col_(b).cast("double")
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
        .when(
            b == 0,
            F.when(F.isnan(a) | (a == 0), F.lit(NAN))
            .when(a > 0, F.lit(INF))
            .otherwise(F.lit(-INF)),
        )
        .otherwise(a / b)
    )


def ne_missing(a: str | Column, b: str | Column | object) -> Column:
    """``a != b`` where a missing side counts as *different* (True)."""
    b = b if isinstance(b, Column) else F.lit(b)
    return F.coalesce(col_(a) != b, F.lit(True))


def code_map(c: str | Column, mapping: Mapping[str, int]) -> Column:
    """Dictionary lookup as a CASE; unmapped and missing give NULL."""
    c = col_(c)
    out = None
    for key, value in mapping.items():
        out = (F.when(c == key, F.lit(value)) if out is None else out.when(c == key, F.lit(value)))
    return out.cast("int")


def nan_to_null(c: str | Column) -> Column:
    c = col_(c)
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def fill_missing(c: str | Column, value, is_double: bool) -> Column:
    """Replace NULL (and NaN for doubles) with a constant; +-inf is kept."""
    c = col_(c)
    if is_double:
        return F.coalesce(nan_to_null(c), F.lit(float(value)))
    return F.coalesce(c, F.lit(value))


# --------------------------------------------------------------------------- aggregates


def _long_total(x: Column) -> Column:
    """Sum of long values within -2**60 and 2**60 as decimal(38,0), 0 of none:
    of their upper, middle and lower 20 bits as longs, which hold the sums of
    2**43 values, and cost a fraction of adding decimals row by row."""
    low = F.lit((1 << PART_BITS) - 1)
    parts = [F.shiftright(x, 2 * PART_BITS), F.shiftright(x, PART_BITS).bitwiseAND(low), x.bitwiseAND(low)]
    upper, middle, lower = [F.coalesce(F.sum(p), F.lit(0)).cast("decimal(38,0)") for p in parts]
    step = F.lit(1 << PART_BITS).cast("decimal(7,0)")
    return (((upper * step).cast("decimal(38,0)") + middle).cast("decimal(38,0)") * step).cast("decimal(38,0)") + lower


def exact_sum(c: str | Column, empty: float | None = 0.0) -> Column:
    """Sum of the values that are not NULL or NaN; ``empty`` (pandas: 0) when
    there are none.

    Whole parts below ``LARGE`` and fractions (in units of 10**-18) are summed
    as integers, which does not depend on order and cannot overflow; larger
    values and infinities are summed as doubles, as IEEE arithmetic has it (inf
    and -inf give NaN)."""
    x = nan_to_null(c)
    mid = F.abs(x) < F.lit(LARGE)
    whole = F.when(mid, x).cast("bigint")
    units = ((F.when(mid, x) - whole.cast("double")) * F.lit(10.0**FRACTION_DIGITS)).cast("bigint")
    total = (
        _long_total(whole).cast("double")
        + _long_total(units).cast("double") / F.lit(10.0**FRACTION_DIGITS)
        + F.coalesce(F.sum(F.when(~mid, x)), F.lit(0.0))
    )
    return F.when(F.count(x) > 0, total).otherwise(F.lit(empty).cast("double"))


def exact_mean(c: str | Column) -> Column:
    """Mean skipping NULL/NaN, from ``exact_sum``.  +-inf propagate as in
    IEEE (inf and -inf -> NaN).  NULL when nothing is left."""
    n = F.count(nan_to_null(c))
    return F.when(n > 0, exact_sum(c) / F.greatest(n, F.lit(1)))


def int_mean(c: str | Column) -> Column:
    """Mean of integer-valued input: the sum is exact, so ``avg`` is
    already order independent."""
    return F.avg(col_(c).cast("bigint"))


def first_by_order(value: str | Column, order: list[Column], name: str = "v") -> Column:
    """Value of the row that sorts first by ``order`` (ascending, NULLs
    first in each field): ``min`` over a struct, so it is partially
    aggregated and no group is ever collected."""
    return first_row_struct(value, order, name)[name]


def first_row_struct(value: str | Column, order: list[Column], name: str = "v") -> Column:
    """The ``min`` struct behind ``first_by_order``; keep it when a second
    aggregation level has to pick among first rows again (``min`` of mins)."""
    fields = [o.alias(f"o{i}") for i, o in enumerate(order)]
    return F.min(F.struct(*fields, col_(value).alias(name)))


def latest_first_order(ts: str | Column, tiebreak: list[str]) -> list[Column]:
    """Order for "row at the latest timestamp, first in file order among
    ties; rows without a timestamp only when nothing else is there"."""
    ts = col_(ts)
    return [ts.isNull(), desc_time_key(ts)] + [F.col(t) for t in tiebreak]
