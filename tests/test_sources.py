"""Readers, snapshot filter, chunk union, preview, writers."""

import os
import tempfile
from datetime import datetime

import pytest

from carelens.sources import readers as R
from carelens.sources import schemas as SC
from carelens.sources import sinks as SK


def test_csv_reader_renames_types_and_coerces_dates(spark):
    d = tempfile.mkdtemp(prefix="carelens-csv-")
    path = os.path.join(d, "spu.csv")
    with open(path, "w") as f:
        f.write("CustomerCode,ProductSerial,MATERIAL,COGS,MACHSTAT,CallBookDate,extra\n")
        f.write("7,S1,P1,12.5,ZAMC,2024-01-05 10:00:00,x\n")
        f.write("8,,P2,not-a-number,OG,05/01/2024,y\n")
        f.write("9,S3,P3,3,OG,garbage,z\n")
    df = R.read_csv(spark, path, "spares", ts_formats=SC.DAY_FIRST)
    assert df.columns == ["CustomerC", "Serial", "ItemNo", "NetValue", "ItemCategory", "CallBookDate"]
    rows = df.orderBy("CustomerC").collect()
    assert rows[0]["NetValue"] == 12.5 and rows[0]["CallBookDate"] == datetime(2024, 1, 5, 10)
    assert rows[1]["Serial"] is None and rows[1]["NetValue"] is None
    assert rows[1]["CallBookDate"] == datetime(2024, 1, 5)
    assert rows[2]["CallBookDate"] is None
    assert R.read_csv(spark, path, "spares", limit=2).count() == 2


def test_canonical_columns_adds_missing_as_null(spark):
    df = spark.createDataFrame([("1", "S")], "zzsoldto string, zzr3ser_no string")
    out = R.canonical_columns(df, "installs")
    assert "zzr3serNo" in out.columns and "zzpurchaseDate" in out.columns
    assert out.first()["zzpurchaseDate"] is None


def test_daily_snapshot_is_a_pushed_range(spark):
    rows = [(1, datetime(2024, 1, 15, 0)), (2, datetime(2024, 1, 15, 23, 59)), (3, datetime(2024, 1, 16)),
            (4, datetime(2024, 1, 14, 23))]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    got = sorted(r["id"] for r in R.daily_snapshot(df, "ts", "2024-01-15").collect())
    assert got == [1, 2]


def test_daily_snapshot_pushdown_reaches_parquet(spark):
    from carelens.sources.fixtures import read_table

    e = read_table(spark, "/root/testdata/sf0.001", "events")
    plan = R.daily_snapshot(e, "ts", "2024-01-15")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_union_chunks_and_preview(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(2,)], "id int")
    u = R.union_chunks([a, b])
    assert sorted((r["id"], r["v"]) for r in u.collect()) == [(1, "x"), (2, None)]
    p = R.preview(spark.range(100).withColumnRenamed("id", "k"), ["k"], 5)
    assert [r["k"] for r in p.collect()] == [0, 1, 2, 3, 4]


def test_jdbc_options():
    o = R.jdbc_options("jdbc:x://h/db", query="SELECT 1", fetchsize=500)
    assert o["query"] == "SELECT 1" and o["fetchsize"] == "500" and "dbtable" not in o
    o = R.jdbc_options("jdbc:x://h/db", query="SELECT * FROM t", partition_column="id", lower_bound=0,
                       upper_bound=100, num_partitions=4, properties={"user": "u"})
    assert o["dbtable"] == "(SELECT * FROM t) src" and o["numPartitions"] == "4" and o["user"] == "u"
    with pytest.raises(ValueError):
        R.jdbc_options("jdbc:x://h/db")
    with pytest.raises(ValueError):
        R.jdbc_options("jdbc:x://h/db", table="t", partition_column="id")


def test_materialize_under_checkpoint_dir(spark):
    df = spark.range(10)
    out = SK.materialize(spark, df, "t")
    assert out.count() == 10
    assert SK.scratch_path(spark, "x").startswith(SK.checkpoint_root(spark))


def test_yearly_pieces_are_pushed_and_complete(spark):
    from carelens.sources.fixtures import contracts_view

    k = contracts_view(spark, "/root/testdata/sf0.001")
    pieces = R.yearly_pieces(k, "AMCPostingDate", range(1994, 1996))
    assert R.union_chunks(pieces).count() == k.count()
    plan = pieces[2]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_readers_guess_no_ambiguous_date(spark, tmp_path):


    path = str(tmp_path / "c")
    spark.createDataFrame([("1", "07/08/2024"), ("2", "07-08-2024 10:30"), ("3", "20240708"), ("4", "2024-07-08")],
                          "CustomerCode string, PostingDate string").write.option("header", True).csv(path)

    def read(*formats):
        rows = R.read_csv(spark, path, "calls", ts_formats=(*formats, *SC.DEFAULT_TS_FORMATS)).collect()
        return {r["CustomerCode"]: r["PostingDate"] for r in rows}

    plain, day, month = read(), read(*SC.DAY_FIRST), read(*SC.MONTH_FIRST)
    assert plain["1"] is None and plain["2"] is None and plain["3"] == plain["4"] == datetime(2024, 7, 8)
    assert day["1"] == datetime(2024, 8, 7) and day["2"] == datetime(2024, 8, 7, 10, 30)
    assert month["1"] == datetime(2024, 7, 8) and month["2"] == datetime(2024, 7, 8, 10, 30)


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    from carelens import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def csv_lines(folder, files):
    """Files of "k,v" lines; v counts lines over all files by path."""
    n = 0
    for name, rows in files:
        with open(os.path.join(folder, name), "w") as f:
            f.write("k,v,pad\n")
            for _ in range(rows):
                f.write(f"{n % 7},{n},{'x' * (n % 50)}\n")
                n += 1
    return n


@pytest.mark.parametrize("split", [300, 4000, 1 << 27])
def test_line_numbers_do_not_depend_on_splits(spark, tmp_path, split):
    n = csv_lines(tmp_path, [("a.csv", 1000), ("b.csv", 1), ("c.csv", 0), ("d.csv", 2500)])
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k, None) for k in names}
    for k in names:
        spark.conf.set(k, str(split))
    try:
        raw = spark.read.option("header", True).csv(str(tmp_path))
        df = R.with_line_numbers(raw, "line")
        assert df.columns == ["k", "v", "pad", "line"]
        assert split > 300 or raw.rdd.getNumPartitions() > 100
        rows = df.repartition(3, "k").collect()
        assert len(rows) == n and all(int(r["v"]) == r["line"] for r in rows)
        # A column less, a filter more: the same numbers.
        part = R.with_line_numbers(raw.select("v"), "line").where("line % 2 = 0").collect()
        assert len(part) == -(-n // 2) and all(int(r["v"]) == r["line"] for r in part)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_latest_rating_by_line_order_against_duckdb(spark, tmp_path):
    """A CSV without any order column: ties go to the first line, as DuckDB
    finds it in the same file by row number."""
    import duckdb

    from carelens.operators import calls
    from carelens.config import FeatureConfig
    from carelens.sources.inputs import Sources

    path = str(tmp_path / "calls.csv")
    with open(path, "w") as f:
        f.write("CustomerCode,ProductSerial,npSrating,ClosedOn\n")
        for i in range(3000):
            closed = "" if i % 11 == 0 else f"2024-01-{1 + i * 7 % 5:02d} 10:00:00"
            f.write(f"{i * 13 % 40},S{i % 3},{i * 31 % 97},{closed}\n")
    want = duckdb.sql(f"""
        WITH c AS (SELECT *, row_number() OVER () AS line FROM read_csv('{path}', header = true)),
        r AS (SELECT *, row_number() OVER (PARTITION BY CustomerCode ORDER BY ClosedOn DESC NULLS LAST, line) AS n FROM c)
        SELECT CAST(CustomerCode AS VARCHAR), CAST(npSrating AS DOUBLE) FROM r WHERE n = 1""").fetchall()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = R.read_csv(spark, path, "calls", line_numbers="line_no")
        src = Sources(**{n: df for n in ("installs", "calls", "contracts", "spares", "call_items", "price_ratio")}, order={"calls": ("line_no",)})
        got = calls.summary(calls.prepare(src, FeatureConfig()), src.tiebreak("calls"), FeatureConfig())
        assert sorted((r["customer"], r["latest_nps_rating"]) for r in got.collect()) == sorted(want)
        first = R.read_csv(spark, path, "calls", limit=5, line_numbers="line_no").collect()
        assert sorted(r["line_no"] for r in first) == [0, 1, 2, 3, 4]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128MB")


def test_load_csv_accounts_for_what_it_loses(spark, tmp_path):
    lines = ["CustomerCode,ProductSerial,MATERIAL,COGS,MACHSTAT,CallBookDate",
             "7,S1,P1,12.5,ZAMC,2024-01-05 10:00:00", "8,S2,P2,twelve,OG,soon", "9,S3,P3,,OG,", "10,S4", "11,S5,P5,1,OG,2024-01-06 00:00:00,more",
             "12,S6,P6,  ,OG,31/31/2024", "13,S7,P7,nan,OG,2024-01-07 00:00:00"]
    for name, part in (("a.csv", lines[:4]), ("b.csv", [lines[0], *lines[4:]])):
        (tmp_path / name).write_text("\n".join(part) + "\n")
    got = R.load_csv(spark, str(tmp_path), "spares")
    assert (got.n_rows, got.n_malformed) == (5, 2) and got.lost == {"NetValue": 1, "CallBookDate": 2}
    assert sorted(r["line"] for r in got.quarantine.collect()) == ["10,S4", "11,S5,P5,1,OG,2024-01-06 00:00:00,more"]
    rows = {r["CustomerC"]: r for r in got.rows.collect()}
    assert sorted(rows) == ["12", "13", "7", "8", "9"] and got.rows.columns == SC.SCHEMAS["spares"].fieldNames()
    assert rows["7"]["NetValue"] == 12.5 and rows["8"]["NetValue"] is None and rows["9"]["CallBookDate"] is None
    plain = R.read_csv(spark, str(tmp_path), "spares").where("CustomerC IN ('7', '8', '9', '12')")
    key = lambda df: sorted(map(str, df.collect()))
    assert key(got.rows.where("CustomerC <> '13'")) == key(plain)


def test_load_csv_scans_once(spark, tmp_path, monkeypatch):
    """The account is taken by the pass that writes: one job that reads."""
    from pyspark.sql import DataFrameWriter

    (tmp_path / "x.csv").write_text("7,S1,P1,1,OG,soon\n" * 50)
    plans = []
    real = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, *a, **k: (plans.append(w._df._jdf.queryExecution().executedPlan().toString()), real(w, *a, **k))[1])
    got = R.load_csv(spark, str(tmp_path / "x.csv"), "spares", names=["CustomerCode", "ProductSerial", "MATERIAL", "COGS", "MACHSTAT", "CallBookDate"])
    assert got.lost == {"NetValue": 0, "CallBookDate": 50} and got.n_rows == 50
    assert len(plans) == 1 and plans[0].count("FileScan csv") == 1 and "CollectMetrics" in plans[0]


def test_load_csv_of_an_empty_file(spark, tmp_path):
    (tmp_path / "x.csv").write_text("CustomerCode,ProductSerial,MATERIAL,COGS,MACHSTAT,CallBookDate\n")
    got = R.load_csv(spark, str(tmp_path / "x.csv"), "spares")
    assert (got.n_rows, got.n_malformed) == (0, 0) and got.rows.count() == 0 and got.quarantine.count() == 0


def test_lines_of_gzip_files_are_numbered(spark, tmp_path):
    """A delivery in compressed part files keeps the order of its lines."""
    from carelens.sources.readers import with_line_numbers
    from carelens.sources.sinks import write_table

    path = write_table(spark.range(0, 500, 1, 3).selectExpr("id"), str(tmp_path / "lines"), fmt="csv", compression="gzip")
    assert len(list((tmp_path / "lines").glob("part-*.csv.gz"))) == 3
    got = with_line_numbers(spark.read.option("header", True).csv(path), "n").collect()
    assert sorted((r["n"], int(r["id"])) for r in got) == [(i, i) for i in range(500)]
