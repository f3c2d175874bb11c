"""Every catalog query against its DuckDB statement (small scale), plus plan shapes."""

import contextlib
import io
import os

import duckdb
import pytest

import __spark_entry__ as E
from catalog import queries as catalog
from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["current_congestion", "count"] and sum(r["count"] for r in rows) > 0


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols, got = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    exp = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
    g = [tuple(r[i] for i in order) for r in got]
    o = [tuple(r[i] for i in oorder) for r in exp]
    assert rows_of(g) == rows_of(o)
    for j in range(len(cols)):  # same value types per column (e.g. DOUBLE, not DECIMAL)
        gv = [r[j] for r in g if r[j] is not None]
        ov = [r[j] for r in o if r[j] is not None]
        if gv and ov:
            assert type(gv[0]).__name__ == type(ov[0]).__name__, (sorted(cols)[j], gv[0], ov[0])


def test_every_query_has_sql_or_is_known_nonsql():
    missing = set(catalog.queries()) - set(catalog.oracle_sql())
    assert missing == {"feature_importance"}
    assert set(catalog.queries()) <= set(E.queries())


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_scan_pushdown_and_pruning(spark):
    p = plan(E.queries()["scan_parquet"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThanOrEqual(l_quantity,25.0)]" in p
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in p


def test_gold_plan_single_window_exchange_no_python(spark):
    p = plan(E.queries()["gold_features"](spark, SF))
    tree = p.split("\n\n")[0]
    # stored silver and a stored lookup: one broadcast by its bytes, one exchange, one Window
    assert tree.count("Window") == 1 and tree.count("BroadcastHashJoin") == 1
    assert tree.count("Exchange") - tree.count("BroadcastExchange") == 1
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_asof_plan_one_exchange_for_all_frames(spark):
    p = plan(E.queries()["asof_nearest"](spark, SF)).split("\n\n")[0]
    assert p.count("Exchange") - p.count("BroadcastExchange") == 1 and "BatchEvalPython" not in p


def test_serving_plan_has_no_window(spark):
    p = plan(E.queries()["serving_features"](spark, SF)).split("\n\n")[0]
    assert "Window" not in p and "SortMergeJoin" not in p


def test_operators_are_lazy(spark):
    """Building and explaining a plan over stored tables starts no job."""
    from catalog import tables as T
    from roadlake.operators.aggregates import describe_column, free_flow_lookup
    from roadlake.operators.asof import serving_features
    from roadlake.operators.joins import enrich_free_flow, lookup_inner
    from roadlake.operators.windows import change_detect
    from roadlake.plans.gold import build_gold
    s, lk, h, snaps, act = T.silver(spark, SF), T.lookup(spark, SF), T.holidays(spark), T.snapshots(spark, SF), T.active(spark, SF)
    raw = T.bronze(spark, SF)
    sc = spark.sparkContext
    sc.setJobGroup("lazy", "lazy")
    try:
        from roadlake.plans.silver import silver_clean
        frames = [silver_clean(raw, act, h), build_gold(s, lk, T.GOLD_PARAMS), enrich_free_flow(s, lk), lookup_inner(snaps.drop("borough"), lk),
                  serving_features(snaps, lk, h, tie="event_id", params=T.SERVING_PARAMS), free_flow_lookup(s, order="data_as_of_utc"),
                  describe_column(snaps, "speed_ratio"),
                  change_detect(snaps.selectExpr("*", "data_as_of ingest_ts", "event_id row_no"), value="speed")]
        for f in frames:
            plan(f)
        assert list(sc.statusTracker().getJobIdsForGroup("lazy")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_partition_pruning_on_written_silver(spark, scratch):
    from roadlake.operators.filters import filter_partition
    from catalog import tables as T
    from roadlake.sources.readers import scan_table
    from roadlake.sources.writers import write_silver
    root = os.path.join(scratch, "silver")
    write_silver(T.silver(spark, SF), root, "2024-01")
    p = plan(filter_partition(scan_table(spark, root), 2024, 1))
    assert "PartitionFilters: [isnotnull(year" in p and "(month" in p


@pytest.mark.parametrize("name", ["silver_clean", "gold_features", "serving_features", "json_roundtrip",
                                  "change_detect", "partition_keys", "active_links", "scan_recent_hours"])
def test_results_do_not_depend_on_session_zone(spark, name):
    key = "spark.sql.session.timeZone"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "UTC")
        a = rows_of([tuple(r) for r in E.queries()[name](spark, SF).collect()])
        spark.conf.set(key, "America/Los_Angeles")
        b = rows_of([tuple(r) for r in E.queries()[name](spark, SF).collect()])
    finally:
        spark.conf.set(key, old)
    assert a == b
