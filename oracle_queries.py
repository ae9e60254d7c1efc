"""DuckDB oracle SQL for the registered queries.

These statements follow the feature definitions literally: windows over a
whole customer, row-by-row fan-out joins, per-row filters.  The Spark plans
compute the same numbers differently (per-day splits, per-machine folds,
aggregate-level joins), so agreement checks those rewrites.

Fixed conventions shared with the Spark side: day counts are floored
microsecond differences; sums add whole parts and fractions (in units of
10**-18) as integers, larger values and infinities as doubles; NaN is missing.
"""

from __future__ import annotations

from carelens.plans.features import CATALOGUE, SENTINEL
from carelens.sources.fixtures import fixture_cte

AS_OF = "TIMESTAMP '2024-02-01 12:00:00'"
TB = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def fd(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000) AS BIGINT)"


def age(ts: str) -> str:
    return fd(AS_OF, ts)


def ieee(a: str, b: str) -> str:
    a, b = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    return (
        f"(CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL "
        f"WHEN {b} = 0 THEN (CASE WHEN isnan({a}) OR {a} = 0 THEN 'nan'::DOUBLE "
        f"WHEN {a} > 0 THEN 'inf'::DOUBLE ELSE '-inf'::DOUBLE END) ELSE {a} / {b} END)"
    )


def _total(x: str) -> str:
    x = f"(CASE WHEN NOT isnan(CAST({x} AS DOUBLE)) THEN CAST({x} AS DOUBLE) END)"
    mid = f"abs({x}) < 1e18"
    return (
        f"(CAST(COALESCE(SUM(CASE WHEN {mid} THEN CAST(trunc({x}) AS HUGEINT) END), 0) AS DOUBLE)"
        f" + CAST(COALESCE(SUM(CASE WHEN {mid} THEN CAST(trunc(({x} - trunc({x})) * 1e18) AS HUGEINT) END), 0) AS DOUBLE) / 1e18"
        f" + COALESCE(SUM(CASE WHEN NOT ({mid}) THEN {x} END), 0))"
    )


def dec_mean(x: str) -> str:
    """Mean over values that are neither NULL nor NaN."""
    n = f"count(CASE WHEN NOT isnan(CAST({x} AS DOUBLE)) THEN 1 END)"
    return f"(CASE WHEN {n} > 0 THEN {_total(x)} / {n} END)"


def dec_sum(x: str) -> str:
    return _total(x)


CAT_NUM = "CASE zz0012 WHEN 'AC' THEN 1 WHEN 'DW' THEN 2 WHEN 'MW' THEN 3 WHEN 'WM' THEN 4 END"
PRIO = (
    "CASE WarConv WHEN 'AMC to AMC' THEN 7 WHEN 'EW to AMC' THEN 6 WHEN 'IW to AMC' THEN 5 "
    "WHEN 'IW to EW' THEN 4 WHEN 'OG to AMC' THEN 3 WHEN 'WTY to MTY' THEN 2 WHEN 'OG to EW' THEN 1 END"
)

STEPS: list[tuple[str, str]] = [
    ("inst", f"""
        SELECT COALESCE(zzsoldto, 'nan') AS customer, COALESCE(zzr3serNo, 'nan') AS serial,
               zz0012 AS category, {CAT_NUM} AS cat_num, zz0010, zzpurchaseDate AS pdate,
               zzinstallDate, zzendDate, COALESCE(zzr3matId, 'nan') AS material, {TB}
        FROM installs"""),
    ("g_installs", f"""
        SELECT customer,
               COUNT(DISTINCT serial) AS No_of_unique_products_purchased,
               {age('MIN(pdate)')} AS no_of_days_since_first_purchase,
               COUNT(DISTINCT category) AS no_of_unique_categories_purchased,
               COUNT(*) FILTER (WHERE category = 'AC') AS no_of_ac_purchased,
               COUNT(*) FILTER (WHERE category = 'WM') AS no_of_wm_purchased,
               COUNT(*) FILTER (WHERE category = 'MW') AS no_of_mw_purchased,
               {age("MAX(pdate) FILTER (WHERE category = 'WM')")} AS age_of_last_wm_bought,
               {age("MAX(pdate) FILTER (WHERE category = 'DW')")} AS age_of_last_dw_bought,
               {age("MAX(pdate) FILTER (WHERE category = 'AC')")} AS age_of_last_ac_bought,
               MAX(zzendDate) FILTER (WHERE zz0010 IS DISTINCT FROM 'OG') AS zzenddate_max
        FROM inst GROUP BY customer"""),
    ("seq", f"""
        SELECT customer,
               cat_num - LAG(cat_num) OVER w AS cd,
               {fd('pdate', 'LAG(pdate) OVER w')} AS td
        FROM inst
        WINDOW w AS (PARTITION BY customer ORDER BY pdate ASC NULLS LAST, {TB})"""),
    ("g_gaps", """
        SELECT customer,
               AVG(td) FILTER (WHERE cd = 0) AS no_days_btw_same_cat_purchase_avg,
               MAX(td) FILTER (WHERE cd = 0) AS no_days_btw_same_cat_purchase_max,
               MIN(td) FILTER (WHERE cd = 0) AS no_days_btw_same_cat_purchase_min,
               AVG(td) FILTER (WHERE cd <> 0 OR cd IS NULL) AS no_days_btw_cross_cat_purchase_avg,
               MAX(td) FILTER (WHERE cd <> 0 OR cd IS NULL) AS no_days_btw_cross_cat_purchase_max,
               MIN(td) FILTER (WHERE cd <> 0 OR cd IS NULL) AS no_days_btw_cross_cat_purchase_min
        FROM seq GROUP BY customer"""),
    ("c", """
        SELECT CAST(CAST(CAST(CustomerCode AS DOUBLE) AS BIGINT) AS VARCHAR) AS customer,
               ProductSerial AS serial, Status, Origin, Medium, ServiceType, MachineStatus,
               COALESCE(Esclationlevel, 0) AS esc, COALESCE(npSrating, 0) AS nps,
               PostingDate, SoftClosureDate, ClosedOn, NegativeResponseRemarks, NegativeReponseRemarksDate,
               event_id
        FROM calls WHERE CustomerCode IS NOT NULL"""),
    ("g_calls", f"""
        SELECT customer,
               COUNT(*) FILTER (WHERE Status = 'Closed') AS closed_status_count,
               COUNT(*) FILTER (WHERE Status = 'Cancelled') AS cancelled_status_count,
               COUNT(*) FILTER (WHERE Origin = 'Customer' AND Status = 'Closed') AS customer_closed_status_count,
               COUNT(*) FILTER (WHERE Origin = 'Customer' AND Status = 'Cancelled') AS customer_cancelled_status_count,
               {age("MAX(ClosedOn) FILTER (WHERE Status = 'Closed')")} AS days_since_last_closed_status,
               COUNT(*) FILTER (WHERE NegativeResponseRemarks IS NOT NULL AND Status = 'Closed') AS negative_remarks_count,
               MAX(esc) FILTER (WHERE esc NOT IN (98, 99)) AS max_escalation,
               COUNT(*) FILTER (WHERE esc = 99) AS count_of_99,
               COUNT(*) FILTER (WHERE esc = 98) AS count_of_98,
               AVG(nps) AS avg_nps,
               COUNT(*) FILTER (WHERE Origin = 'Customer' AND Status = 'Closed' AND Medium = 'Email') AS customer_closed_email_count,
               COUNT(*) FILTER (WHERE Origin = 'Customer' AND Status = 'Closed' AND Medium = 'Phone') AS customer_closed_phone_count,
               COUNT(*) FILTER (WHERE Origin = 'Customer' AND Status = 'Closed' AND Medium = 'WhatsApp') AS customer_closed_wp_count,
               COUNT(*) FILTER (WHERE ServiceType = 'Minor' AND Status = 'Closed' AND MachineStatus = 'OG') AS closed_minor_og_count,
               COUNT(*) FILTER (WHERE ServiceType = 'Minor' AND Status = 'Closed' AND MachineStatus = 'AMC') AS closed_minor_amc_count,
               COUNT(*) FILTER (WHERE ServiceType = 'Minor' AND Status = 'Closed' AND MachineStatus = 'SW') AS closed_minor_sw_count,
               COUNT(*) FILTER (WHERE ServiceType = 'Minor' AND Status = 'Closed' AND MachineStatus = 'EW') AS closed_minor_ew_count,
               COUNT(*) FILTER (WHERE ServiceType = 'Major' AND Status = 'Closed' AND MachineStatus = 'SW') AS closed_major_sw_count,
               COUNT(*) FILTER (WHERE ServiceType = 'Major' AND Status = 'Closed' AND MachineStatus = 'AMC') AS closed_major_amc_count,
               COUNT(*) FILTER (WHERE ServiceType = 'Major' AND Status = 'Closed' AND MachineStatus = 'EW') AS closed_major_ew_count,
               COUNT(*) FILTER (WHERE ServiceType = 'Major' AND Status = 'Closed' AND MachineStatus = 'OG') AS closed_major_og_count,
               COUNT(DISTINCT Medium) AS unique_medium_count,
               MAX(nps) AS max_nps,
               {age("MAX(NegativeReponseRemarksDate) FILTER (WHERE NegativeResponseRemarks IS NOT NULL)")}
                   AS days_since_latest_neg_remark
        FROM c GROUP BY customer"""),
    ("c_last", """
        SELECT customer, MAX(ClosedOn) AS ClosedOn FROM c GROUP BY customer"""),
    ("c_first_at", """
        SELECT customer, ClosedOn, nps FROM (
            SELECT customer, ClosedOn, nps,
                   ROW_NUMBER() OVER (PARTITION BY customer, ClosedOn ORDER BY event_id) AS rn
            FROM c) WHERE rn = 1"""),
    ("g_latest", """
        SELECT l.customer, f.nps AS latest_nps_rating
        FROM c_last l LEFT JOIN c_first_at f
             ON f.customer = l.customer AND f.ClosedOn IS NOT DISTINCT FROM l.ClosedOn"""),
    ("c_machine", f"""
        SELECT customer, serial,
               AVG({fd('SoftClosureDate', 'PostingDate')}) AS soft,
               AVG({fd('ClosedOn', 'NegativeReponseRemarksDate')}) AS cnr,
               AVG({fd('ClosedOn', 'PostingDate')}) FILTER (WHERE MachineStatus = 'SW') AS sw,
               AVG({fd('ClosedOn', 'PostingDate')}) FILTER (WHERE MachineStatus = 'AMC') AS amc,
               AVG({fd('ClosedOn', 'PostingDate')}) FILTER (WHERE MachineStatus = 'EW') AS ew,
               AVG({fd('ClosedOn', 'PostingDate')}) FILTER (WHERE MachineStatus = 'OG') AS og
        FROM c WHERE serial IS NOT NULL GROUP BY customer, serial"""),
    ("g_machine_means", f"""
        SELECT customer,
               {dec_mean('soft')} AS soft_post_days_diff,
               {dec_mean('cnr')} AS close_nr_days_diff,
               {dec_mean('sw')} AS AVG_TAT_SW,
               {dec_mean('amc')} AS AVG_TAT_AMC,
               {dec_mean('ew')} AS AVG_TAT_EW,
               {dec_mean('og')} AS AVG_TAT_OG
        FROM c_machine GROUP BY customer"""),
    ("k", f"""
        SELECT COALESCE(CustomerCode, 'nan') AS customer, COALESCE(SrNo, 'nan') AS serial,
               COALESCE(IcrNo, 'nan') AS icr, AmcType, ContStrtDat, ContEndDat, Price, {PRIO} AS prio
        FROM contracts"""),
    ("g_contracts", f"""
        SELECT customer,
               COUNT(DISTINCT serial) FILTER (WHERE AmcType = 'Super Warranty') AS unique_prod_ser_superwarranty,
               COUNT(DISTINCT serial) FILTER (WHERE AmcType = 'Extended Warranty') AS unique_prod_ser_exwarranty,
               COUNT(DISTINCT serial) FILTER (WHERE AmcType = 'Labour AMC') AS unique_prod_ser_labamc,
               COUNT(DISTINCT serial) FILTER (WHERE AmcType = 'Motor Warranty') AS unique_prod_ser_mot,
               COUNT(DISTINCT serial) FILTER (WHERE AmcType = 'AMC') AS unique_prod_ser_amc,
               COUNT(DISTINCT icr) AS unique_icrno_count,
               {age('MAX(ContEndDat)')} AS days_left_for_current_amc_to_be_ended,
               {dec_sum('Price')} AS sum_amc_price,
               MAX(ContEndDat) AS con_end_date_max
        FROM k GROUP BY customer"""),
    ("g_loyalty", """
        SELECT customer, AVG(p) AS loyalty_score
        FROM (SELECT customer, serial, MAX(prio) AS p FROM k GROUP BY customer, serial) GROUP BY customer"""),
    ("sp", """
        SELECT COALESCE(CustomerC, 'nan') AS customer, COALESCE(Serial, 'nan') AS serial, ItemNo AS item,
               NetValue AS net, ItemCategory AS category, CallBookDate AS booked
        FROM spares"""),
    ("g_repeat_parts", """
        SELECT customer, COUNT(DISTINCT item) AS repeat_parts_for_customer FROM (
            SELECT customer, serial, item, COUNT(DISTINCT booked) AS n FROM sp
            WHERE item IS NOT NULL GROUP BY customer, serial, item)
        WHERE serial <> 'nan' AND n > 1 GROUP BY customer"""),
    ("k_span", """
        SELECT customer, serial, MIN(ContStrtDat) AS mn, MAX(ContEndDat) AS mx FROM k GROUP BY customer, serial"""),
    ("sp_inside", """
        SELECT sp.customer, sp.serial, sp.item, sp.booked, s.mn, s.mx
        FROM sp LEFT JOIN k_span s ON sp.customer = s.customer AND sp.serial = s.serial
        WHERE s.mn IS NOT NULL AND s.mx IS NOT NULL AND sp.booked > s.mn AND sp.booked < s.mx"""),
    ("g_repeat_in_contract", """
        SELECT customer, COUNT(DISTINCT item) AS repeat_parts_in_contract FROM (
            SELECT customer, serial, item, COUNT(DISTINCT booked) AS n FROM sp_inside
            WHERE item IS NOT NULL GROUP BY customer, serial, item)
        WHERE n > 1 GROUP BY customer"""),
    ("g_first_consumption", f"""
        SELECT s.customer, AVG({fd('s.mn', 'b.first_booked')}) AS Days_between_AMC_start_data_and_1st_consumption_date
        FROM k_span s LEFT JOIN (SELECT customer, serial, MIN(booked) AS first_booked FROM sp GROUP BY customer, serial) b
             ON s.customer = b.customer AND s.serial = b.serial
        GROUP BY s.customer"""),
    ("prof_fan", """
        SELECT sp.customer, sp.serial, sp.net, kk.Price
        FROM sp LEFT JOIN k kk ON sp.customer = kk.customer AND sp.serial = kk.serial
        WHERE sp.category = 'ZAMC'"""),
    ("prof_machine", f"""
        SELECT customer, serial, {ieee(dec_sum('net'), 'MAX(Price)')} AS profitability
        FROM prof_fan GROUP BY customer, serial"""),
    ("g_profitability", f"""
        SELECT customer,
               SUM(CASE WHEN profitability <= 1 THEN 1 ELSE 0 END) / COUNT(*) AS AMC_perc,
               {dec_mean('profitability')} AS avg_profitability
        FROM prof_machine GROUP BY customer"""),
    ("it", f"""
        SELECT COALESCE(CustomerCode, 'nan') AS customer, COALESCE(ProductSerial, 'nan') AS serial, itemtype,
               PostingDate AS posted, Qty AS qty, COALESCE(Accessories, Additive) AS item_code, {TB}
        FROM call_items WHERE itemtype IN ('ZACC', 'ZADD')"""),
    ("it_type", f"""
        SELECT customer, itemtype, {age('MAX(posted)')} AS days_since_last_purchase,
               COUNT(DISTINCT item_code) AS n_items
        FROM it GROUP BY customer, itemtype"""),
    ("it_latest", f"""
        SELECT customer, itemtype, qty AS latest_qty FROM (
            SELECT customer, itemtype, qty,
                   ROW_NUMBER() OVER (PARTITION BY customer, itemtype ORDER BY posted DESC NULLS LAST, {TB}) AS rn
            FROM it) WHERE rn = 1"""),
    ("it_dates", """
        SELECT DISTINCT customer, itemtype, posted FROM it WHERE posted IS NOT NULL"""),
    ("it_gaps", f"""
        SELECT customer, itemtype, COALESCE(AVG(gap), 0) AS mean_gap FROM (
            SELECT customer, itemtype,
                   {fd('posted', 'LAG(posted) OVER (PARTITION BY customer, itemtype ORDER BY posted)')} AS gap
            FROM it_dates) GROUP BY customer, itemtype"""),
    ("it_repurchase", """
        SELECT customer, itemtype, COUNT(*) AS repurchased FROM (
            SELECT customer, serial, itemtype, COUNT(DISTINCT posted) AS n FROM it GROUP BY customer, serial, itemtype)
        WHERE n > 1 GROUP BY customer, itemtype"""),
    ("it_fan", """
        SELECT i.customer, i.serial, i.itemtype, n.cat_num
        FROM it i LEFT JOIN inst n ON i.customer = n.customer AND i.serial = n.serial
        WHERE (n.pdate <> i.posted) IS NOT FALSE"""),
    ("it_cover", """
        SELECT customer, itemtype, COUNT(DISTINCT cat_num) AS cats_covered, COUNT(DISTINCT serial) AS machines_covered
        FROM it_fan GROUP BY customer, itemtype"""),
    ("inst_first", """
        SELECT customer, serial, MIN(LEAST(pdate, zzinstallDate)) AS first_interaction FROM inst GROUP BY customer, serial"""),
    ("it_first_lag", f"""
        SELECT f.customer, f.itemtype, AVG({fd('i.first_interaction', 'f.first_posted')}) AS first_contact_lag
        FROM (SELECT customer, serial, itemtype, MIN(posted) AS first_posted FROM it GROUP BY customer, serial, itemtype) f
             LEFT JOIN inst_first i ON f.customer = i.customer AND f.serial = i.serial
        GROUP BY f.customer, f.itemtype"""),
    ("it_all", """
        SELECT t.customer, t.itemtype, t.days_since_last_purchase, t.n_items, l.latest_qty,
               COALESCE(g.mean_gap, 0) AS mean_gap, r.repurchased, v.cats_covered, v.machines_covered,
               fl.first_contact_lag
        FROM it_type t
        LEFT JOIN it_latest l ON t.customer = l.customer AND t.itemtype = l.itemtype
        LEFT JOIN it_gaps g ON t.customer = g.customer AND t.itemtype = g.itemtype
        LEFT JOIN it_repurchase r ON t.customer = r.customer AND t.itemtype = r.itemtype
        LEFT JOIN it_cover v ON t.customer = v.customer AND t.itemtype = v.itemtype
        LEFT JOIN it_first_lag fl ON t.customer = fl.customer AND t.itemtype = fl.itemtype"""),
    ("g_items", """
        SELECT customer,
               MAX(days_since_last_purchase) FILTER (WHERE itemtype = 'ZACC') AS days_since_last_purchase_zacc,
               MAX(days_since_last_purchase) FILTER (WHERE itemtype = 'ZADD') AS days_since_last_purchase_zadd,
               MAX(latest_qty) FILTER (WHERE itemtype = 'ZACC') AS zacc_qty,
               MAX(latest_qty) FILTER (WHERE itemtype = 'ZADD') AS zadd_qty,
               MAX(cats_covered) FILTER (WHERE itemtype = 'ZADD') AS number_of_productcats_for_which_essentials_purchased,
               MAX(cats_covered) FILTER (WHERE itemtype = 'ZACC') AS number_of_productcats_for_which_accessories_purchased,
               MAX(machines_covered) FILTER (WHERE itemtype = 'ZADD') AS number_of_productser_for_which_essentials_purchased,
               MAX(machines_covered) FILTER (WHERE itemtype = 'ZACC') AS number_of_productser_for_which_accessories_purchased,
               MAX(repurchased) FILTER (WHERE itemtype = 'ZADD') AS number_of_products_for_which_repurchase_done,
               MAX(repurchased) FILTER (WHERE itemtype = 'ZACC') AS number_of_products_for_which_repurchase_done_accessories,
               MAX(mean_gap) FILTER (WHERE itemtype = 'ZADD') AS avg_date_diff_essentials,
               MAX(mean_gap) FILTER (WHERE itemtype = 'ZACC') AS avg_date_diff_accessory,
               MAX(n_items) FILTER (WHERE itemtype = 'ZADD') AS number_of_unique_essentials,
               MAX(n_items) FILTER (WHERE itemtype = 'ZACC') AS number_of_unique_accessories,
               MAX(first_contact_lag) FILTER (WHERE itemtype = 'ZADD')
                   AS difference_btw_first_ess_purchase_and_first_ifb_interaction,
               MAX(first_contact_lag) FILTER (WHERE itemtype = 'ZACC')
                   AS difference_btw_first_acc_purchase_and_first_ifb_interaction
        FROM it_all GROUP BY customer"""),
    ("price_rows", """
        SELECT n.customer,
               CASE WHEN p.Mat_ID1_price IS NULL AND p.Relative_ratio IS NULL THEN 1.0::DOUBLE ELSE p.Mat_ID1_price END AS price,
               CASE WHEN p.Mat_ID1_price IS NULL AND p.Relative_ratio IS NULL THEN 0.5::DOUBLE ELSE p.Relative_ratio END AS ratio
        FROM inst n LEFT JOIN price_ratio p ON n.material = COALESCE(p.Mat_ID1, 'nan')"""),
    ("g_price", f"""
        SELECT customer, {ieee(dec_sum('price * ratio'), dec_sum('price'))} AS price_sensitivity
        FROM price_rows GROUP BY customer"""),
    ("joined", """
        SELECT * FROM g_installs
        LEFT JOIN g_gaps USING (customer)
        LEFT JOIN g_calls USING (customer)
        LEFT JOIN g_latest USING (customer)
        LEFT JOIN g_machine_means USING (customer)
        LEFT JOIN g_contracts USING (customer)
        LEFT JOIN g_loyalty USING (customer)
        LEFT JOIN g_repeat_parts USING (customer)
        LEFT JOIN g_repeat_in_contract USING (customer)
        LEFT JOIN g_first_consumption USING (customer)
        LEFT JOIN g_profitability USING (customer)
        LEFT JOIN g_items USING (customer)
        LEFT JOIN g_price USING (customer)"""),
]

# Column expressions over ``joined`` that are not plain columns.
DERIVED = {
    "frequency_of_purchase": ieee("No_of_unique_products_purchased", "no_of_days_since_first_purchase"),
    "latest_max_nps_diff": "latest_nps_rating - max_nps",
    "avg_price_amc": ieee("sum_amc_price", "unique_icrno_count"),
    "days_out_of_warranty": age("GREATEST(zzenddate_max, con_end_date_max)"),
    "ItemNo_x": "repeat_parts_in_contract",
    "ItemNo_y": "repeat_parts_in_contract",
}


def _final_column(f) -> str:
    expr = DERIVED.get(f.name, f.name)
    sql_type = "BIGINT" if f.dtype == "bigint" else "DOUBLE"
    expr = f"CAST({expr} AS {sql_type})"
    if f.fill is not None:
        if sql_type == "DOUBLE":
            expr = f"COALESCE(CASE WHEN isnan({expr}) THEN NULL ELSE {expr} END, {float(f.fill)})"
        else:
            expr = f"COALESCE({expr}, {int(f.fill)})"
    return f"{expr} AS {f.name}"


FEATURES_SQL = "SELECT customer,\n" + ",\n".join(_final_column(f) for f in CATALOGUE) + "\nFROM joined"


def with_views(select: str, extra: list[tuple[str, str]] | None = None) -> str:
    return fixture_cte(*STEPS, ("features", FEATURES_SQL), *(extra or [])) + select


def feature_slice(columns: list[str], last_line_first: bool = False) -> str:
    """The columns of the feature table; ``last_line_first``: of inputs whose
    rows come in the opposite order."""
    sql = with_views("SELECT customer, " + ", ".join(columns) + " FROM features")
    if last_line_first:
        for step in ("PARTITION BY customer, ClosedOn ORDER BY event_id", f"PARTITION BY customer ORDER BY pdate ASC NULLS LAST, {TB}"):
            assert sql.count(step) == 1
            columns_of = "event_id" if step.endswith("event_id") else TB
            sql = sql.replace(step, step.removesuffix(columns_of) + ", ".join(f"{c} DESC" for c in columns_of.split(", ")))
    return sql


assert SENTINEL == 99999


# ----------------------------------------------------------------- model oracles


def _model_cols(columns: list[str] | None) -> list[str]:
    from carelens.plans.features import FEATURE_NAMES

    return sorted(c for c in (columns or FEATURE_NAMES) if c != "customer")


def standardize_sql(features_sql: str, columns: list[str] | None = None) -> str:
    """z-scores with sample std; NULL, NaN and zero-std results become 0."""
    cols = _model_cols(columns)
    stats = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_samp(CAST({c} AS DOUBLE)) AS s_{c}" for c in cols)
    zs = []
    for c in cols:
        z = f"(CAST(f.{c} AS DOUBLE) - st.m_{c}) / NULLIF(st.s_{c}, 0)"
        zs.append(f"COALESCE(CASE WHEN isnan({z}) THEN NULL ELSE {z} END, 0.0) AS {c}")
    return (
        f"SELECT f.customer, {', '.join(zs)} FROM ({features_sql}) f, "
        f"(SELECT {stats} FROM ({features_sql})) st"
    )


def elbow_k1_sql(features_sql: str, columns: list[str] | None = None) -> str:
    """WCSS of a single cluster over the z-scores."""
    cols = _model_cols(columns)
    z = standardize_sql(features_sql, columns)
    means = ", ".join(f"avg({c}) AS m_{c}" for c in cols)
    sq = " + ".join(f"power(z.{c} - mz.m_{c}, 2)" for c in cols)
    return f"SELECT 1 AS k, SUM({sq}) AS wcss FROM ({z}) z, (SELECT {means} FROM ({z})) mz"
