"""The six inputs as views over the driver's TPC-H-like test tables.

``fixture_sources`` builds them with the DataFrame API; ``FIXTURE_SQL`` holds
the same definitions as DuckDB SQL so that oracle queries see identical
inputs.  The mapping is fixed by FIXTURES.md part 2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.sources.inputs import Sources
from carelens.sources.sinks import materialize

LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
ORDER = {
    "installs": LINE_ORDER,
    "spares": LINE_ORDER,
    "call_items": LINE_ORDER,
    "calls": ("event_id",),
    "contracts": ("o_orderkey",),
    "price_ratio": (),
}

# Fixed values of the fixture mapping (FIXTURES.md part 2), in natural order.
PART_TYPE_TO_CATEGORY = {"ECONOMY": "AC", "SMALL": "DW", "MEDIUM": "MW", "LARGE": "WM", "PROMO": "CT"}
RETURNFLAG_TO_WARRANTY = {"N": "OG", "R": "SW"}
PRIORITY_TO_AMC_TYPE = {
    "1-URGENT": "Super Warranty",
    "2-HIGH": "Extended Warranty",
    "3-MEDIUM": "Labour AMC",
    "4-NOT SPECIFIED": "Motor Warranty",
    "5-LOW": "AMC",
}
CONVERSION_LABELS = ["AMC to AMC", "EW to AMC", "IW to AMC", "IW to EW", "OG to AMC", "WTY to MTY", "OG to EW"]
MEDIA = ["Email", "Phone", "WhatsApp", "Web", None]
SERVICE_TYPES = ["Minor", "Major", "Install"]
MACHINE_STATUSES = ["OG", "OG", "AMC", "AMC", "SW", "EW", None]
RETURNFLAG_TO_ITEMTYPE = {"R": "ZACC", "A": "ZADD", "N": "ZOTH"}
LINESTATUS_TO_ITEMCATEGORY = {"F": "ZAMC", "O": "OG"}


def _case(c: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out


def _pick(index: Column, values: list) -> Column:
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (index + 1).cast("int"))


def _days(n: Column | int) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.make_dt_interval(n.cast("int"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _line_orders(spark: SparkSession, sf_dir: str, line_cols: list[str]) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(*line_cols)
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).drop("o_orderkey")


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their orders, joined and written once, for a run that
    reads all three inputs made of them."""
    cols = [*LINE_ORDER, "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"]
    return materialize(spark, _line_orders(spark, sf_dir, cols), "line-orders", compression="zstd")


def _machine_serial() -> Column:
    return F.concat_ws("-", F.col("o_custkey").cast("string"), (F.col("l_suppkey") % 5).cast("string"))


def installs_view(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    base = lines if lines is not None else _line_orders(spark, sf_dir, list(LINE_ORDER) + ["l_returnflag", "l_shipdate"])
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    j = base.join(part, base.l_partkey == part.p_partkey)
    ptype = F.substring_index(F.col("p_type"), " ", 1)
    return j.select(
        F.col("o_custkey").cast("string").alias("zzsoldto"),
        _machine_serial().alias("zzr3serNo"),
        _case(ptype, PART_TYPE_TO_CATEGORY).alias("zz0012"),
        _case(F.col("l_returnflag"), RETURNFLAG_TO_WARRANTY).alias("zz0010"),
        F.when(F.col("l_partkey") % 13 != 0, F.col("o_orderdate")).alias("zzpurchaseDate"),
        F.col("l_shipdate").alias("zzinstallDate"),
        F.lit(None).cast("timestamp_ntz").alias("zzstartDate"),
        (F.col("o_orderdate") + _days(730)).alias("zzendDate"),
        F.col("l_partkey").cast("string").alias("zzr3matId"),
        *LINE_ORDER,
    )


def calls_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    eid = F.col("event_id")
    status = (
        F.when(F.col("event_type").isin("purchase", "click"), "Closed")
        .when(F.col("event_type") == "error", "Cancelled")
        .otherwise("Open")
    )
    remarks = F.when(k % 5 == 1, F.lit("neg"))
    return e.select(
        F.col("user_id").cast("string").alias("CustomerCode"),
        F.when(eid % 13 != 0, F.concat_ws("-", F.col("user_id").cast("string"), (eid % 3).cast("string"))).alias(
            "ProductSerial"
        ),
        status.alias("Status"),
        F.when(eid % 2 == 0, "Customer").otherwise("Dealer").alias("Origin"),
        _pick(eid % 5, MEDIA).alias("Medium"),
        _pick(eid % 3, SERVICE_TYPES).alias("ServiceType"),
        _pick(eid % 7, MACHINE_STATUSES).alias("MachineStatus"),
        F.when(k >= 98, k).when(k % 4 == 0, F.lit(None)).otherwise(k % 6).cast("double").alias("Esclationlevel"),
        F.when(k % 9 != 0, F.floor("value") % 11).cast("double").alias("npSrating"),
        F.col("ts").alias("PostingDate"),
        (F.col("ts") + F.make_dt_interval((eid % 4).cast("int"), F.lit(6))).alias("SoftClosureDate"),
        F.when((F.col("user_id") % 10 != 0) & (status == "Closed"), F.col("ts") + _days(eid % 6)).alias("ClosedOn"),
        remarks.alias("NegativeResponseRemarks"),
        F.when(remarks.isNotNull() & (eid % 11 != 0), F.col("ts") + _days(1)).alias("NegativeReponseRemarksDate"),
        eid.alias("event_id"),
    )


def contracts_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    okey = F.col("o_orderkey")
    return o.select(
        F.col("o_custkey").cast("string").alias("CustomerCode"),
        F.concat_ws("-", F.col("o_custkey").cast("string"), (okey % 5).cast("string")).alias("SrNo"),
        okey.cast("string").alias("IcrNo"),
        _case(F.col("o_orderpriority"), PRIORITY_TO_AMC_TYPE).alias("AmcType"),
        F.col("o_orderdate").alias("AMCPostingDate"),
        F.col("o_orderdate").alias("ContStrtDat"),
        (F.col("o_orderdate") + _days(365)).alias("ContEndDat"),
        F.col("o_totalprice").alias("Price"),
        _pick(okey % 8, CONVERSION_LABELS + [None]).alias("WarConv"),
        okey.alias("o_orderkey"),
    )


def spares_view(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    base = lines if lines is not None else _line_orders(spark, sf_dir, list(LINE_ORDER) + ["l_linestatus", "l_shipdate"])
    return base.select(
        F.col("o_custkey").cast("string").alias("CustomerC"),
        _machine_serial().alias("Serial"),
        (F.col("l_partkey") % 10).cast("string").alias("ItemNo"),
        F.col("l_extendedprice").alias("NetValue"),
        _case(F.col("l_linestatus"), LINESTATUS_TO_ITEMCATEGORY).alias("ItemCategory"),
        F.col("l_shipdate").alias("CallBookDate"),
        *LINE_ORDER,
    )


def call_items_view(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    base = lines if lines is not None else _line_orders(spark, sf_dir, list(LINE_ORDER) + ["l_quantity", "l_returnflag", "l_shipdate"])
    pk = F.col("l_partkey")
    ln = F.col("l_linenumber")
    return base.select(
        F.col("o_custkey").cast("string").alias("CustomerCode"),
        _machine_serial().alias("ProductSerial"),
        F.col("l_shipdate").alias("PostingDate"),
        F.col("l_quantity").alias("Qty"),
        _case(F.col("l_returnflag"), RETURNFLAG_TO_ITEMTYPE).alias("itemtype"),
        F.when(ln % 2 == 0, (pk % 50).cast("string")).alias("Accessories"),
        F.when(ln % 3 != 0, F.concat(F.lit("A"), (pk % 20).cast("string"))).alias("Additive"),
        *LINE_ORDER,
    )


def price_ratio_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    return p.where(pk % 5 != 0).select(
        pk.cast("string").alias("Mat_ID1"),
        F.when(pk % 7 != 0, F.col("p_retailprice")).alias("Mat_ID1_price"),
        F.when((pk % 7 != 0) & (pk % 11 != 0), F.col("p_size") / 50).alias("Relative_ratio"),
    )


def fixture_sources(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> Sources:
    """The six inputs; three of them read ``lines`` (``joined_lines``), if
    given, and else join lines and orders anew each."""
    return Sources(
        installs=installs_view(spark, sf_dir, lines),
        calls=calls_view(spark, sf_dir),
        contracts=contracts_view(spark, sf_dir),
        spares=spares_view(spark, sf_dir, lines),
        call_items=call_items_view(spark, sf_dir, lines),
        price_ratio=price_ratio_view(spark, sf_dir),
        order=ORDER,
    )


# ----------------------------------------------------------------------------
# The same views for DuckDB (oracle side).  Tables are pre-registered views.

_SERIAL = "CAST(o_custkey AS VARCHAR) || '-' || CAST(l_suppkey % 5 AS VARCHAR)"

FIXTURE_SQL: dict[str, str] = {
    "installs": f"""
        SELECT CAST(o.o_custkey AS VARCHAR) AS zzsoldto,
               {_SERIAL} AS zzr3serNo,
               CASE split_part(p.p_type, ' ', 1) WHEN 'ECONOMY' THEN 'AC' WHEN 'SMALL' THEN 'DW'
                    WHEN 'MEDIUM' THEN 'MW' WHEN 'LARGE' THEN 'WM' WHEN 'PROMO' THEN 'CT' END AS zz0012,
               CASE l.l_returnflag WHEN 'N' THEN 'OG' WHEN 'R' THEN 'SW' END AS zz0010,
               CASE WHEN l.l_partkey % 13 <> 0 THEN o.o_orderdate END AS zzpurchaseDate,
               l.l_shipdate AS zzinstallDate,
               CAST(NULL AS TIMESTAMP) AS zzstartDate,
               o.o_orderdate + INTERVAL 730 DAY AS zzendDate,
               CAST(l.l_partkey AS VARCHAR) AS zzr3matId,
               l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
             JOIN part p ON l.l_partkey = p.p_partkey""",
    "calls": """
        SELECT CAST(user_id AS VARCHAR) AS CustomerCode,
               CASE WHEN event_id % 13 <> 0 THEN CAST(user_id AS VARCHAR) || '-' || CAST(event_id % 3 AS VARCHAR) END
                    AS ProductSerial,
               CASE WHEN event_type IN ('purchase', 'click') THEN 'Closed'
                    WHEN event_type = 'error' THEN 'Cancelled' ELSE 'Open' END AS Status,
               CASE WHEN event_id % 2 = 0 THEN 'Customer' ELSE 'Dealer' END AS Origin,
               CASE event_id % 5 WHEN 0 THEN 'Email' WHEN 1 THEN 'Phone' WHEN 2 THEN 'WhatsApp'
                    WHEN 3 THEN 'Web' END AS Medium,
               CASE event_id % 3 WHEN 0 THEN 'Minor' WHEN 1 THEN 'Major' ELSE 'Install' END AS ServiceType,
               CASE event_id % 7 WHEN 0 THEN 'OG' WHEN 1 THEN 'OG' WHEN 2 THEN 'AMC' WHEN 3 THEN 'AMC'
                    WHEN 4 THEN 'SW' WHEN 5 THEN 'EW' END AS MachineStatus,
               CAST(CASE WHEN k >= 98 THEN k WHEN k % 4 = 0 THEN NULL ELSE k % 6 END AS DOUBLE) AS Esclationlevel,
               CAST(CASE WHEN k % 9 <> 0 THEN CAST(floor(value) AS BIGINT) % 11 END AS DOUBLE) AS npSrating,
               ts AS PostingDate,
               ts + to_days(CAST(event_id % 4 AS INTEGER)) + INTERVAL 6 HOUR AS SoftClosureDate,
               CASE WHEN user_id % 10 <> 0 AND event_type IN ('purchase', 'click')
                    THEN ts + to_days(CAST(event_id % 6 AS INTEGER)) END AS ClosedOn,
               CASE WHEN k % 5 = 1 THEN 'neg' END AS NegativeResponseRemarks,
               CASE WHEN k % 5 = 1 AND event_id % 11 <> 0 THEN ts + INTERVAL 1 DAY END AS NegativeReponseRemarksDate,
               event_id
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e""",
    "contracts": """
        SELECT CAST(o_custkey AS VARCHAR) AS CustomerCode,
               CAST(o_custkey AS VARCHAR) || '-' || CAST(o_orderkey % 5 AS VARCHAR) AS SrNo,
               CAST(o_orderkey AS VARCHAR) AS IcrNo,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Super Warranty' WHEN '2-HIGH' THEN 'Extended Warranty'
                    WHEN '3-MEDIUM' THEN 'Labour AMC' WHEN '4-NOT SPECIFIED' THEN 'Motor Warranty'
                    WHEN '5-LOW' THEN 'AMC' END AS AmcType,
               o_orderdate AS AMCPostingDate,
               o_orderdate AS ContStrtDat,
               o_orderdate + INTERVAL 365 DAY AS ContEndDat,
               o_totalprice AS Price,
               CASE o_orderkey % 8 WHEN 0 THEN 'AMC to AMC' WHEN 1 THEN 'EW to AMC' WHEN 2 THEN 'IW to AMC'
                    WHEN 3 THEN 'IW to EW' WHEN 4 THEN 'OG to AMC' WHEN 5 THEN 'WTY to MTY'
                    WHEN 6 THEN 'OG to EW' END AS WarConv,
               o_orderkey
        FROM orders""",
    "spares": f"""
        SELECT CAST(o.o_custkey AS VARCHAR) AS CustomerC,
               {_SERIAL} AS Serial,
               CAST(l.l_partkey % 10 AS VARCHAR) AS ItemNo,
               l.l_extendedprice AS NetValue,
               CASE l.l_linestatus WHEN 'F' THEN 'ZAMC' WHEN 'O' THEN 'OG' END AS ItemCategory,
               l.l_shipdate AS CallBookDate,
               l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "call_items": f"""
        SELECT CAST(o.o_custkey AS VARCHAR) AS CustomerCode,
               {_SERIAL} AS ProductSerial,
               l.l_shipdate AS PostingDate,
               l.l_quantity AS Qty,
               CASE l.l_returnflag WHEN 'R' THEN 'ZACC' WHEN 'A' THEN 'ZADD' WHEN 'N' THEN 'ZOTH' END AS itemtype,
               CASE WHEN l.l_linenumber % 2 = 0 THEN CAST(l.l_partkey % 50 AS VARCHAR) END AS Accessories,
               CASE WHEN l.l_linenumber % 3 <> 0 THEN 'A' || CAST(l.l_partkey % 20 AS VARCHAR) END AS Additive,
               l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "price_ratio": """
        SELECT CAST(p_partkey AS VARCHAR) AS Mat_ID1,
               CASE WHEN p_partkey % 7 <> 0 THEN p_retailprice END AS Mat_ID1_price,
               CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 THEN p_size / 50 END AS Relative_ratio
        FROM part WHERE p_partkey % 5 <> 0""",
}


def fixture_cte(*extra: tuple[str, str]) -> str:
    """``WITH`` prefix defining the six input views (plus ``extra`` CTEs)."""
    parts = [f"{name} AS ({body})" for name, body in FIXTURE_SQL.items()]
    parts += [f"{name} AS ({body})" for name, body in extra]
    return "WITH " + ",\n".join(parts) + "\n"
