"""

Every query reads the driver's tables at ``sf_dir`` through the six input
views of ``carelens.sources.fixtures`` (so its work grows with the tables)
and runs over whole tables.  Feature queries return one row per customer
of the installed base; row-level operator queries return one row per input
row.  ``oracle_sql`` gives literal DuckDB statements for the same results.
"""

from __future__ import annotations

import dataclasses
import logging
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_queries as oq  # noqa: E402
from carelens.config import FeatureConfig  # noqa: E402
from carelens.functions import expr as X  # noqa: E402
from carelens.plans import features as FT  # noqa: E402
from carelens.plans import model as M  # noqa: E402
from carelens.sources import fixtures as FX  # noqa: E402
from carelens.sources import readers as R  # noqa: E402
from carelens.sources import schemas as SC  # noqa: E402
from carelens.sources import sinks as SK  # noqa: E402
from carelens.sources import versions as V  # noqa: E402
from carelens.streaming import state as ST  # noqa: E402

# The training-data operators and their pipeline are an optional part: without
# their folders, or something that they need, everything else here still works.
try:
    import corpus_pipeline  # noqa: E402
    from carelens.llm import queries as llm_queries  # noqa: E402
except ImportError as missing:
    logging.getLogger(__name__).warning("training-data queries are left out: %s", missing)
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
CFG = FeatureConfig(as_of="2024-02-01 12:00:00")

# Feature slices: query name -> catalogue columns it returns.
SLICES: dict[str, list[str]] = {
    "distinct_counts": ["No_of_unique_products_purchased", "no_of_unique_categories_purchased",
                        "unique_medium_count", "unique_icrno_count", "number_of_unique_essentials",
                        "number_of_unique_accessories"],
    "category_counts": ["no_of_ac_purchased", "no_of_wm_purchased", "no_of_mw_purchased"],
    "fill_all": ["no_of_days_since_first_purchase", "frequency_of_purchase"],
    "purchase_gaps": [f.name for f in FT.CATALOGUE if f.group == "gaps"],
    "last_purchase_by_category": ["age_of_last_wm_bought", "age_of_last_dw_bought", "age_of_last_ac_bought"],
    "status_counts": ["closed_status_count", "cancelled_status_count"],
    "origin_status_counts": ["customer_closed_status_count", "customer_cancelled_status_count"],
    "negative_remarks": ["negative_remarks_count", "days_since_latest_neg_remark"],
    "medium_counts": ["customer_closed_email_count", "customer_closed_phone_count", "customer_closed_wp_count"],
    "service_counts": [n for n in FT.FEATURE_NAMES if n.startswith(("closed_minor", "closed_major"))],
    "escalation": ["max_escalation", "count_of_99", "count_of_98"],
    "avg_rating": ["avg_nps"],
    "max_rating": ["max_nps"],
    "latest_rating": ["latest_nps_rating"],
    "nps_drop": ["latest_nps_rating", "max_nps", "latest_max_nps_diff"],
    "turnaround": ["AVG_TAT_SW", "AVG_TAT_AMC", "AVG_TAT_EW", "AVG_TAT_OG"],
    "closure_lags": ["days_since_last_closed_status", "soft_post_days_diff", "close_nr_days_diff"],
    "contract_type_counts": [n for n in FT.FEATURE_NAMES if n.startswith("unique_prod_ser_")],
    "contract_value": ["unique_icrno_count", "sum_amc_price", "avg_price_amc"],
    "contract_span": ["days_left_for_current_amc_to_be_ended", "days_out_of_warranty"],
    "loyalty_score": ["loyalty_score"],
    "price_sensitivity": ["price_sensitivity"],
    "repeat_parts": ["repeat_parts_for_customer"],
    "repeat_parts_in_contract": ["ItemNo_x", "ItemNo_y"],
    "first_consumption_lag": ["Days_between_AMC_start_data_and_1st_consumption_date"],
    "contract_profitability": ["AMC_perc", "avg_profitability"],
    "latest_item_qty": ["days_since_last_purchase_zacc", "days_since_last_purchase_zadd", "zacc_qty", "zadd_qty"],
    "item_coverage": [n for n in FT.FEATURE_NAMES if n.startswith(("number_of_productcats", "number_of_productser"))],
    "repurchase": ["number_of_products_for_which_repurchase_done",
                   "number_of_products_for_which_repurchase_done_accessories"],
    "avg_date_gap": ["avg_date_diff_essentials", "avg_date_diff_accessory"],
    "first_item_lag": ["difference_btw_first_ess_purchase_and_first_ifb_interaction",
                       "difference_btw_first_acc_purchase_and_first_ifb_interaction"],
    "ratio_columns": ["frequency_of_purchase", "avg_price_amc", "price_sensitivity", "AMC_perc"],
    # The 51 columns of the zero fill; #2, #3 and #6 are already 0 by the
    # earlier whole-table fill (``fill_all``).
    "impute_zero": [f.name for f in FT.CATALOGUE if f.fill == 0 and f.name not in (
        "no_of_days_since_first_purchase", "frequency_of_purchase", "no_of_wm_purchased")],
    "impute_sentinel": [f.name for f in FT.CATALOGUE if f.fill == FT.SENTINEL],
}


FILE_ORDER_COLUMNS = ["latest_nps_rating", *SLICES["purchase_gaps"]]


def _src(spark: SparkSession, sf_dir: str):
    return FX.fixture_sources(spark, sf_dir)


def _src_once(spark: SparkSession, sf_dir: str):
    """The inputs for a run that reads them all."""
    return FX.fixture_sources(spark, sf_dir, FX.joined_lines(spark, sf_dir))


def _slice(columns: list[str], src: Callable = _src) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return FT.feature_table(src(spark, sf_dir), CFG, columns)

    return run


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FT.build_features(_src_once(spark, sf_dir), CFG)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the full customer feature table at sf0.001."""
    return customer_features(spark, SMOKE_DIR)


# ----------------------------------------------------------------- row-level operator queries


def norm_keys(spark, sf_dir):
    """Call keys through the strict numeric path and the normaliser,
    the latter from text, a number, and number-like text with a fraction or
    leading zeros."""
    calls = FX.calls_view(spark, sf_dir)
    number = F.col("CustomerCode").cast("double")
    types = {"number": T.DoubleType(), "whole": T.LongType()}
    raw = calls.select(
        "event_id", "CustomerCode", "ProductSerial", (number * 100000).alias("number"), number.cast("long").alias("whole"),
        F.concat("CustomerCode", F.lit(".0")).alias("with_fraction"), F.concat(F.lit("000"), "CustomerCode").alias("with_zeros"))
    return raw.select(
        "event_id", X.strict_int_key("CustomerCode").alias("customer"), X.norm_key("ProductSerial").alias("serial"),
        *[X.norm_key(c, types.get(c)).alias(f"from_{c}") for c in ("number", "whole", "with_fraction", "with_zeros")])


KEY_FORMS = ("double", "long", "text_fraction", "text_zeros")
KEY_COLUMNS = ["No_of_unique_products_purchased", "closed_status_count", "sum_amc_price"]


def key_forms(spark, sf_dir):
    """P3 end to end: installs delivered with customer keys stored as double,
    long, ``123.0`` and ``000123`` and read by the library's readers join the
    other inputs alike."""
    src = _src(spark, sf_dir)
    src = src.with_frames(installs=SK.materialize(spark, src.installs, "installs"))  # read for each form
    key, out = F.col("zzsoldto"), None
    stored = {"double": key.cast("double"), "long": key.cast("long"), "text_fraction": F.concat(key, F.lit(".0")),
              "text_zeros": F.concat(F.lit("000"), key)}
    for form in KEY_FORMS:
        raw = src.installs.withColumn("zzsoldto", stored[form])
        if form.startswith("text"):
            path = SK.write_table(raw, SK.scratch_path(spark, f"installs-{form}"), fmt="csv", compression="gzip")
            installs = R.read_csv(spark, path, "installs", keep=FX.LINE_ORDER)
        else:
            path = SK.write_table(raw, SK.scratch_path(spark, f"installs-{form}"))
            installs = R.read_parquet(spark, path, "installs", keep=FX.LINE_ORDER)
        t = FT.feature_table(src.with_frames(installs=installs), CFG, KEY_COLUMNS).withColumn("form", F.lit(form))
        out = t if out is None else out.unionByName(t)
    return out


def category_code(spark, sf_dir):
    inst = FX.installs_view(spark, sf_dir)
    return inst.select(*FX.LINE_ORDER, "zz0012", X.code_map("zz0012", X.CATEGORY_CODES).alias("cat_num"))


def conversion_priority(spark, sf_dir):
    con = FX.contracts_view(spark, sf_dir)
    return con.select("o_orderkey", "WarConv", X.code_map("WarConv", X.CONVERSION_PRIORITY).alias("amc_prior"))


def coalesce_item(spark, sf_dir):
    it = FX.call_items_view(spark, sf_dir)
    return it.select(*FX.LINE_ORDER, F.coalesce("Accessories", "Additive").alias("ItemCode"))


def floor_days(spark, sf_dir):
    c = FX.calls_view(spark, sf_dir)
    return c.select(
        "event_id",
        X.floor_days("SoftClosureDate", "PostingDate").alias("soft_post_days"),
        X.floor_days("ClosedOn", "NegativeReponseRemarksDate").alias("close_nr_days"),
        X.floor_days("ClosedOn", "PostingDate").alias("turnaround_days"),
        X.floor_days("PostingDate", "SoftClosureDate").alias("negative_days"),
    )


def age_days(spark, sf_dir):
    k = FX.contracts_view(spark, sf_dir)
    return k.select("o_orderkey", X.age_days("ContEndDat", CFG.as_of).alias("days_since_end"),
                    X.age_days("ContStrtDat", CFG.as_of).alias("days_since_start"))


def rowwise_max_date(spark, sf_dir):
    """P10 row by row: the latest date that an install row names."""
    inst = FX.installs_view(spark, sf_dir)
    return inst.select(*FX.LINE_ORDER, F.greatest("zzpurchaseDate", "zzinstallDate", "zzendDate").alias("max_date"))


def rowwise_min_date(spark, sf_dir):
    inst = FX.installs_view(spark, sf_dir)
    return inst.select(*FX.LINE_ORDER, F.least("zzpurchaseDate", "zzinstallDate").alias("min_purchase_install"))


def neq_missing_passes(spark, sf_dir):
    inst = FX.installs_view(spark, sf_dir)
    return inst.where(X.ne_missing("zz0010", "OG")).select(*FX.LINE_ORDER, "zz0010", "zzendDate")


def fill_constant(spark, sf_dir):
    c = FX.calls_view(spark, sf_dir)
    return c.select("event_id", F.coalesce("Esclationlevel", F.lit(0.0)).alias("Esclationlevel"),
                    F.coalesce("npSrating", F.lit(0.0)).alias("npSrating"))


def drop_missing(spark, sf_dir):
    """spare rows left-joined to their machine's contract span; rows
    without a span are dropped (``dropna`` on the joined columns)."""
    from carelens.operators import contracts as C

    machine = C.per_machine(C.prepare(_src(spark, sf_dir), CFG))
    span = machine.select("customer", "serial", "min_start", "max_end")
    sp = FX.spares_view(spark, sf_dir)
    t = {f.name: f.dataType for f in sp.schema.fields}
    rows = sp.select(X.norm_key("CustomerC", t["CustomerC"]).alias("customer"),
                     X.norm_key("Serial", t["Serial"]).alias("serial"), *FX.LINE_ORDER)
    j = rows.join(span, ["customer", "serial"], "left").dropna(subset=["min_start", "max_end"])
    return j.select(*FX.LINE_ORDER, "min_start", "max_end")


def project_drop(spark, sf_dir):
    """The contract columns the part/contract comparisons use, renamed."""
    k = FX.contracts_view(spark, sf_dir)
    return k.select(F.col("CustomerCode").alias("customer"), F.col("SrNo").alias("Serial"),
                    "ContStrtDat", "ContEndDat", "Price", "o_orderkey")


def parse_dates(spark, sf_dir):
    """Order dates rendered as text by a source that writes the day first
    and by one that writes the month first (one in five unparseable), parsed
    back with each source's own formats; without formats nothing ambiguous is
    guessed."""
    o = FX.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    m = F.col("o_orderkey") % 5

    def text(day: str, dashed: str):
        return (
            F.when(m == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
            .when(m == 1, F.date_format("o_orderdate", day))
            .when(m == 2, F.date_format("o_orderdate", "yyyyMMdd"))
            .when(m == 3, F.date_format("o_orderdate", f"{dashed} HH:mm"))
            .otherwise(F.concat(F.lit("n/a "), F.col("o_orderkey").cast("string"))))

    first_day, first_month = text("dd/MM/yyyy", "dd-MM-yyyy"), text("MM/dd/yyyy", "MM-dd-yyyy")
    return o.select(
        "o_orderkey", X.parse_ts(first_day, (*SC.DAY_FIRST, *SC.DEFAULT_TS_FORMATS)).alias("day_first"),
        X.parse_ts(first_month, (*SC.MONTH_FIRST, *SC.DEFAULT_TS_FORMATS)).alias("month_first"),
        X.parse_ts(first_day, SC.DEFAULT_TS_FORMATS).alias("unguessed"))


def canonical_columns(spark, sf_dir):
    """Spare rows arriving with upstream names, renamed at read."""
    raw = FX.spares_view(spark, sf_dir).withColumnsRenamed(
        {v: k for k, v in R.RAW_NAMES["spares"].items()})
    return R.canonical_columns(raw, "spares", keep=FX.LINE_ORDER)


def csv_scan(spark, sf_dir):
    """Installs written as CSV with upstream names and text dates, then
    scanned back with the declared schema."""
    raw = FX.installs_view(spark, sf_dir).withColumnsRenamed(
        {v: k for k, v in R.RAW_NAMES["installs"].items()})
    path = SK.write_table(raw, SK.scratch_path(spark, "installs-csv"), fmt="csv")
    df = R.read_csv(spark, path, "installs", keep=FX.LINE_ORDER)
    return df.select(*[c for c in df.columns if c != "zzstartDate"]).select(
        "zzsoldto", "zzr3serNo", "zz0012", "zz0010", "zzpurchaseDate", "zzinstallDate", "zzendDate", "zzr3matId",
        *[F.col(c).cast("double" if c == "l_extendedprice" else "bigint").alias(c) for c in FX.LINE_ORDER])


def daily_snapshot(spark, sf_dir):
    """The calls of one day (the reference pulls "today")."""
    return R.daily_snapshot(FX.calls_view(spark, sf_dir), "PostingDate", "2024-01-15").select(
        "event_id", "CustomerCode", "Status", "PostingDate")


DAILY_DAY = "1996-01-15"


def daily_pull(spark, sf_dir):
    """S2 for all three tables that are pulled daily: rows of one day."""
    src = _src(spark, sf_dir).frames()
    out = None
    for name, df in R.daily_pull(src, DAILY_DAY).items():
        c = R.DAILY_COLUMNS[name]
        customer = "CustomerC" if name == "spares" else "CustomerCode"
        part = df.select(F.lit(name).alias("source"), F.col(customer).alias("customer"), F.col(c).alias("posted"))
        out = part if out is None else out.unionByName(part)
    return out


def union_chunks(spark, sf_dir):
    """Contracts fetched as yearly pieces (pushed date ranges, by the
    years the table has) and concatenated."""
    k = FX.contracts_view(spark, sf_dir)
    ends = k.agg(F.year(F.min("AMCPostingDate")), F.year(F.max("AMCPostingDate"))).first()
    years = range(ends[0], ends[1] + 1) if ends[0] is not None else range(2000, 2001)
    pieces = R.yearly_pieces(k, "AMCPostingDate", years)
    return R.union_chunks(pieces).select("o_orderkey", "CustomerCode", "SrNo", "AmcType", "Price")


def preview_head(spark, sf_dir):
    return R.preview(FX.calls_view(spark, sf_dir), ["event_id"], 5).select("event_id", "CustomerCode", "Status")


def features_roundtrip(spark, sf_dir):
    """The feature table published as CSV, in the second version of a
    table, and read back typed."""
    t = customer_features(spark, sf_dir)
    path = SK.scratch_path(spark, "features-csv")
    V.publish(spark.createDataFrame([], t.schema), path)
    V.publish(t, path, "csv")
    return V.read(spark, path)


CONTRACT_FIELDS = ["CustomerCode", "SrNo", "IcrNo", "AmcType", "AMCPostingDate", "ContStrtDat", "ContEndDat", "Price", "WarConv"]


def coerced_counts(spark, sf_dir):
    """Contracts as CSV lines of which some have a field too many,
    dates that are none, or prices that are no numbers; what the load lost, by
    column, and how many lines it set aside."""
    k, key = FX.contracts_view(spark, sf_dir), F.col("o_orderkey")
    spoilt = {"ContStrtDat": F.when(key % 5 == 0, F.lit("soon")).otherwise(F.col("ContStrtDat").cast("string")),
              "Price": F.when(key % 7 == 0, F.lit("12;50 EUR")).otherwise(F.col("Price").cast("string"))}
    fields = [F.coalesce(spoilt.get(c, F.col(c).cast("string")), F.lit("")) for c in CONTRACT_FIELDS]
    line = F.concat(F.concat_ws(",", *fields), F.when(key % 11 == 3, F.lit(",one more")).otherwise(F.lit("")))
    path = SK.scratch_path(spark, "contract-lines")
    k.select(line.alias("line")).write.text(path)
    got = R.load_csv(spark, path, "contracts", names=CONTRACT_FIELDS)
    rows = [("contracts", c, n) for c, n in got.lost.items()] + [("contracts", "(malformed)", got.n_malformed), ("contracts", "(rows)", got.n_rows)]
    rows += [("contracts", "(read back)", got.rows.count()), ("contracts", "(set aside)", got.quarantine.count())]
    return spark.createDataFrame(rows, "source string, name string, n long")


DAILY_FEATURES = [f.name for f in FT.CATALOGUE if f.group in (*ST.GROUPS, "warranty")]


def incremental_features(spark, sf_dir):
    """The daily tables merged batch by batch (whole days each, one batch
    delivered twice, layers compacted once) into feature state, and the
    features of those tables read from it."""
    src = _src(spark, sf_dir)
    state = ST.FeatureState(spark, SK.scratch_path(spark, "feature-state"), CFG)
    n = 3
    for batch in (0, 1, 1, 2):
        rows = {t: getattr(src, t).where(F.coalesce(F.pmod(X.day_index(F.col(c)), F.lit(n)), F.lit(0)) == batch) for t, c in R.DAILY_COLUMNS.items()}
        state.apply(f"days-{batch}", rows, src.order)
        if batch == 1:
            state.compact()
    return state.features(src, DAILY_FEATURES)


def file_order(spark, sf_dir):
    """Ties by the order of lines.  Calls and installs come as CSV
    files without a column that gives their order (written from the last row to
    the first); the readers number the lines."""
    src = _src(spark, sf_dir)
    frames, order = {}, {}
    for name, by in (("calls", ["event_id"]), ("installs", list(FX.LINE_ORDER))):
        df = getattr(src, name).orderBy(*[F.desc(c) for c in by])
        raw = df.drop(*by).withColumnsRenamed({v: k for k, v in R.RAW_NAMES[name].items()})
        path = SK.write_table(raw, SK.scratch_path(spark, f"{name}-lines"), fmt="csv", compression="gzip")
        frames[name] = R.read_csv(spark, path, name, line_numbers="line_no")
        order[name] = ("line_no",)
    src = dataclasses.replace(src, **frames, order={**src.order, **order})
    return FT.feature_table(src, CFG, FILE_ORDER_COLUMNS)


# ----------------------------------------------------------------- model


def _features(spark, sf_dir):
    """The feature table, built once and written."""
    return SK.materialize(spark, customer_features(spark, sf_dir), "features")


def standardize(spark, sf_dir):
    return M.standardize(_features(spark, sf_dir))


def elbow_k1(spark, sf_dir):
    return M.elbow_k1(M.standardize(_features(spark, sf_dir)))


def elbow(spark, sf_dir):
    return M.elbow(spark, _features(spark, sf_dir), ks=range(1, 7))


def clusters(spark, sf_dir):
    return M.clusters(spark, _features(spark, sf_dir))


def cluster_roundtrip(spark, sf_dir):
    out = clusters(spark, sf_dir)
    path = SK.write_table(out, SK.scratch_path(spark, "clusters-csv"), fmt="csv")
    return spark.read.schema(out.schema).option("header", True).csv(path)


def cluster_table(spark, sf_dir):
    """The labelled table as read back, without the label."""
    return cluster_roundtrip(spark, sf_dir).drop(M.LABEL)


def cluster_nearest(spark, sf_dir):
    """M4: whether each customer's label is its nearest centre, by the z-scores
    of ``standardize`` and the centres of the one fit that labelled it."""
    feats = _features(spark, sf_dir)
    fitted = M.fit_clusters(spark, feats)
    z = M.standardize(feats)
    at = F.array(*[F.col(c) for c in fitted.scaling.columns])
    apart = [F.aggregate(F.zip_with(at, F.lit(c), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, b: a + b)
             for c in fitted.centres.tolist()]
    d = z.select("customer", F.array(*apart).alias("d"))
    labelled = M.clusters(spark, feats, fitted=fitted).select("customer", M.LABEL)
    return d.join(labelled, "customer").select(
        "customer", (F.col("d")[F.col(M.LABEL)] <= F.array_min("d") * (1 + 1e-6)).alias("nearest"))


def cluster_checks(spark, sf_dir):
    """M3/M4 acceptance: labels in use, WCSS falling over k, the sweep's k = 1
    equal to the closed form, five clusters tighter than one, and mini-batches
    within 5 % of full batches."""
    feats = _features(spark, sf_dir)
    fitted = M.fit_clusters(spark, feats)
    full = M.fit_clusters(spark, feats, method="lloyd")
    labels = M.clusters(spark, feats, fitted=fitted).agg(F.count_distinct(M.LABEL).alias("labels"))
    wcss = {r["k"]: r["wcss"] for r in M.elbow(spark, feats, ks=range(1, 7)).collect()}
    one = M.elbow_k1(M.standardize(feats)).first()["wcss"]
    checks = {"wcss_falls": all(wcss[k + 1] < wcss[k] for k in range(1, 6)), "one_is_exact": abs(wcss[1] - one) <= 1e-8 * one,
              "five_beat_one": fitted.wcss < wcss[1], "near_full_batch": fitted.wcss <= 1.05 * full.wcss}
    return labels.select("labels", *[F.lit(v).alias(c) for c, v in checks.items()])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {"customer_features": customer_features}
    for name, cols in SLICES.items():
        q[name] = _slice(cols, _src_once if name.startswith("impute_") else _src)
    q.update(
        norm_keys=norm_keys,
        key_forms=key_forms,
        category_code=category_code,
        conversion_priority=conversion_priority,
        coalesce_item=coalesce_item,
        floor_days=floor_days,
        age_days=age_days,
        rowwise_max_date=rowwise_max_date,
        rowwise_min_date=rowwise_min_date,
        neq_missing_passes=neq_missing_passes,
        fill_constant=fill_constant,
        drop_missing=drop_missing,
        project_drop=project_drop,
        parse_dates=parse_dates,
        canonical_columns=canonical_columns,
        csv_scan=csv_scan,
        daily_snapshot=daily_snapshot,
        daily_pull=daily_pull,
        union_chunks=union_chunks,
        preview_head=preview_head,
        features_roundtrip=features_roundtrip,
        file_order=file_order,
        coerced_counts=coerced_counts,
        incremental_features=incremental_features,
        standardize=standardize,
        elbow_k1=elbow_k1,
        elbow=elbow,
        clusters=clusters,
        cluster_roundtrip=cluster_roundtrip,
        cluster_table=cluster_table,
        cluster_nearest=cluster_nearest,
        cluster_checks=cluster_checks,
    )
    if llm_queries is not None:
        q.update(llm_queries.QUERIES, pipeline=corpus_pipeline.run)
    return q


# ----------------------------------------------------------------- oracles


def _row_sql(select: str) -> str:
    return oq.with_views(select)


TB = ", ".join(FX.LINE_ORDER)


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {"customer_features": oq.with_views("SELECT * FROM features")}
    for name, cols in SLICES.items():
        o[name] = oq.feature_slice(cols)
    o["rowwise_max_date"] = _row_sql(
        f"SELECT {TB}, GREATEST(zzpurchaseDate, zzinstallDate, zzendDate) AS max_date FROM installs")
    as_int = "CAST(CAST(CAST(CustomerCode AS DOUBLE) AS BIGINT) AS VARCHAR)"
    o["norm_keys"] = _row_sql(
        f"SELECT event_id, {as_int} AS customer, COALESCE(trim(ProductSerial), 'nan') AS serial, "
        "CAST(CAST(CustomerCode AS BIGINT) * 100000 AS VARCHAR) AS from_number, "
        f"{as_int} AS from_whole, {as_int} AS from_with_fraction, {as_int} AS from_with_zeros FROM calls")
    key_cols = ", ".join(KEY_COLUMNS)
    o["key_forms"] = _row_sql(
        f"SELECT customer, {key_cols}, form FROM features, (VALUES {', '.join(f'({f!r})' for f in KEY_FORMS)}) AS f(form)")
    o["category_code"] = _row_sql(f"SELECT {TB}, zz0012, {oq.CAT_NUM} AS cat_num FROM installs")
    o["conversion_priority"] = _row_sql(f"SELECT o_orderkey, WarConv, {oq.PRIO} AS amc_prior FROM contracts")
    o["coalesce_item"] = _row_sql(f"SELECT {TB}, COALESCE(Accessories, Additive) AS ItemCode FROM call_items")
    o["floor_days"] = _row_sql(
        f"SELECT event_id, {oq.fd('SoftClosureDate', 'PostingDate')} AS soft_post_days, "
        f"{oq.fd('ClosedOn', 'NegativeReponseRemarksDate')} AS close_nr_days, "
        f"{oq.fd('ClosedOn', 'PostingDate')} AS turnaround_days, "
        f"{oq.fd('PostingDate', 'SoftClosureDate')} AS negative_days FROM calls")
    o["age_days"] = _row_sql(
        f"SELECT o_orderkey, {oq.age('ContEndDat')} AS days_since_end, {oq.age('ContStrtDat')} AS days_since_start "
        "FROM contracts")
    o["rowwise_min_date"] = _row_sql(
        f"SELECT {TB}, LEAST(zzpurchaseDate, zzinstallDate) AS min_purchase_install FROM installs")
    o["neq_missing_passes"] = _row_sql(
        f"SELECT {TB}, zz0010, zzendDate FROM installs WHERE zz0010 IS DISTINCT FROM 'OG'")
    o["fill_constant"] = _row_sql(
        "SELECT event_id, COALESCE(Esclationlevel, 0.0) AS Esclationlevel, COALESCE(npSrating, 0.0) AS npSrating "
        "FROM calls")
    o["drop_missing"] = _row_sql(
        f"SELECT s.{TB.replace(', ', ', s.')}, k.mn AS min_start, k.mx AS max_end FROM spares s "
        "JOIN k_span k ON s.CustomerC = k.customer AND s.Serial = k.serial "
        "WHERE k.mn IS NOT NULL AND k.mx IS NOT NULL")
    o["project_drop"] = _row_sql(
        "SELECT CustomerCode AS customer, SrNo AS Serial, ContStrtDat, ContEndDat, Price, o_orderkey FROM contracts")
    whole = "CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)"
    to_minute = "date_trunc('minute', o_orderdate)"
    both = f"CASE o_orderkey % 5 WHEN 0 THEN o_orderdate WHEN 1 THEN {whole} WHEN 2 THEN {whole} WHEN 3 THEN {to_minute} END"
    o["parse_dates"] = _row_sql(
        f"SELECT o_orderkey, {both} AS day_first, {both} AS month_first, "
        f"CASE o_orderkey % 5 WHEN 0 THEN o_orderdate WHEN 2 THEN {whole} END AS unguessed FROM orders")
    o["canonical_columns"] = _row_sql(
        f"SELECT CustomerC, Serial, ItemNo, NetValue, ItemCategory, CallBookDate, {TB} FROM spares")
    o["csv_scan"] = _row_sql(
        f"SELECT zzsoldto, zzr3serNo, zz0012, zz0010, zzpurchaseDate, zzinstallDate, zzendDate, zzr3matId, {TB} "
        "FROM installs")
    o["daily_snapshot"] = _row_sql(
        "SELECT event_id, CustomerCode, Status, PostingDate FROM calls "
        "WHERE PostingDate >= TIMESTAMP '2024-01-15' AND PostingDate < TIMESTAMP '2024-01-16'")
    day = f"TIMESTAMP '{DAILY_DAY}'"
    o["daily_pull"] = _row_sql(" UNION ALL ".join(
        f"SELECT '{t}' AS source, {k} AS customer, {c} AS posted FROM {t} WHERE {c} >= {day} AND {c} < {day} + INTERVAL 1 DAY"
        for t, k, c in (("contracts", "CustomerCode", "AMCPostingDate"), ("calls", "CustomerCode", "PostingDate"),
                        ("spares", "CustomerC", "CallBookDate"))))
    o["union_chunks"] = _row_sql("SELECT o_orderkey, CustomerCode, SrNo, AmcType, Price FROM contracts")
    o["preview_head"] = _row_sql(
        "SELECT event_id, CustomerCode, Status FROM calls ORDER BY event_id LIMIT 5")
    o["features_roundtrip"] = o["customer_features"]
    counted = {"AMCPostingDate": "count_if(k IS NULL)", "ContStrtDat": "count_if(sound AND k % 5 = 0)", "ContEndDat": "count_if(k IS NULL)", "Price": "count_if(sound AND k % 7 = 0)",
               "(malformed)": "count_if(NOT sound)", "(set aside)": "count_if(NOT sound)", "(rows)": "count_if(sound)", "(read back)": "count_if(sound)"}
    o["coerced_counts"] = _row_sql(" UNION ALL ".join(
        f"SELECT 'contracts' AS source, '{name}' AS name, CAST({n} AS BIGINT) AS n FROM (SELECT o_orderkey AS k, o_orderkey % 11 <> 3 AS sound FROM contracts)"
        for name, n in counted.items()))
    o["incremental_features"] = oq.feature_slice(DAILY_FEATURES)
    o["file_order"] = oq.feature_slice(FILE_ORDER_COLUMNS, last_line_first=True)
    o["standardize"] = oq.standardize_sql(oq.with_views("SELECT * FROM features"))
    o["elbow_k1"] = oq.elbow_k1_sql(oq.with_views("SELECT * FROM features"))
    o["cluster_table"] = o["customer_features"]
    o["cluster_nearest"] = oq.with_views("SELECT customer, TRUE AS nearest FROM features")
    o["cluster_checks"] = ("SELECT CAST(5 AS BIGINT) AS labels, TRUE AS wcss_falls, TRUE AS one_is_exact, TRUE AS five_beat_one, "
                           "TRUE AS near_full_batch")
    if llm_queries is not None:
        o.update(llm_queries.ORACLE_SQL)
        if corpus_pipeline.ORACLE_SQL is not None:
            o["pipeline"] = corpus_pipeline.ORACLE_SQL
    return o
