import datetime as dt
from decimal import Decimal

from hiremart import schemas
from hiremart.operators import bi, marts, stats

from conftest import rows

D = Decimal


def _wh(spark):
    fact = spark.createDataFrame([
        (1, 100, 1, dt.date(2025, 1, 5), D("100.00"), D("200.00"), "RUR"),
        (2, 100, 1, dt.date(2025, 1, 6), None, None, ""),
        (3, 200, None, dt.date(2025, 3, 1), D("50.00"), None, "USD"),
        (4, 300, None, dt.date(2025, 3, 2), None, D("70.00"), None),
        (5, 300, 2, dt.date(2025, 4, 2), None, None, "RUR"),
        (6, 999, 2, dt.date(2025, 4, 2), None, None, "RUR"),   # no role
    ], "vacancy_id bigint, employer_sk bigint, area_id bigint, published_date date, "
       "salary_from decimal(18,2), salary_to decimal(18,2), salary_currency string")
    bridge = spark.createDataFrame([(1, "9"), (1, "10"), (2, "9"), (3, "9"), (4, "9"), (5, "10"),
                                    (5, "77")], "vacancy_id bigint, role_id string")
    roles = spark.createDataFrame([("9", "nine"), ("10", "ten")], "role_id string, role_name string")
    areas = spark.createDataFrame([(1, "Moscow")], "area_id bigint, area_name string")
    emp = spark.createDataFrame([
        (100, 10, "A", True), (200, 20, "B", True), (300, 30, "C", True), (301, 30, "C-old", False),
    ], "employer_sk bigint, employer_id bigint, employer_name string, is_current boolean")
    return fact, bridge, roles, areas, emp


def test_primary_role_is_text_minimum(spark):
    fact, bridge, roles, areas, _ = _wh(spark)
    assert rows(marts.primary_role(bridge, roles)) == \
        [(1, "10"), (2, "9"), (3, "9"), (4, "9"), (5, "10")]


def test_mart_salary_and_star(spark):
    fact, bridge, roles, areas, _ = _wh(spark)
    s = marts.star(fact, bridge, roles, areas)
    assert s.count() == 5                       # vacancy 6 has no role; unknown area kept
    m1 = marts.mart_salary(s)
    r = m1.filter("industry_id = '9' AND currency = 'UNKNOWN' AND month = DATE'2025-03-01'").first()
    assert r["area_id"] is None and r["salary_min"] == D("70.000")
    jan = m1.filter("month = DATE'2025-01-01'").collect()
    assert {(x["industry_id"], x["currency"]) for x in jan} == {("10", "RUR"), ("9", "UNKNOWN")}
    assert m1.agg({"vacancies_cnt": "sum"}).first()[0] == 5


def test_mart_regions_share_and_currency_share(spark):
    fact, bridge, roles, areas, _ = _wh(spark)
    s = marts.star(fact, bridge, roles, areas)
    m2 = marts.mart_regions(s)
    for rid in ("9", "10"):
        assert abs(sum(r["share_in_industry"] for r in m2.filter(f"industry_id = '{rid}'").collect()) - 1) < 1e-12
    m5 = marts.mart_currency(s)
    null_area = m5.filter("industry_id = '9' AND area_id IS NULL").collect()
    assert sorted(r["currency_share"] for r in null_area) == [0.5, 0.5]


def test_mart_trends_lag_skips_gaps(spark):
    fact, bridge, roles, areas, _ = _wh(spark)
    m3 = marts.mart_trends(marts.star(fact, bridge, roles, areas))
    nine = rows(m3.filter("industry_id = '9'"), "month", "vacancies_cnt", "mom_abs", "mom_pct")
    assert nine == [(dt.date(2025, 1, 1), 1, None, None), (dt.date(2025, 3, 1), 2, 1, 1.0)]


def test_mart_top_employers_current_only_and_k(spark):
    fact, bridge, roles, areas, emp = _wh(spark)
    s = marts.star(fact, bridge, roles, areas)
    m4 = marts.mart_top_employers(s, emp, k=1)
    assert all(r["employer_name"] != "C-old" for r in m4.collect())
    plan = m4._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_top_k_tie_break_nulls_last(spark):
    agg = spark.createDataFrame([
        ("9", 1, "A", 1, "RUR", None, 1), ("9", 1, "B", 2, "RUR", D("5.000"), 1),
        ("9", 1, "C", 3, "RUR", D("5.000"), 1)],
        "industry_id string, area_id bigint, employer_name string, employer_sk bigint, currency string, "
        "salary_point decimal(22,3), x int")
    s = agg.selectExpr("industry_id", "'n' AS industry_name", "area_id", "'a' AS area_name",
                       "employer_sk", "currency", "salary_point")
    emp = spark.createDataFrame([(1, 1, "A", True), (2, 2, "B", True), (3, 3, "C", True)],
                                "employer_sk bigint, employer_id bigint, employer_name string, is_current boolean")
    top2 = marts.mart_top_employers(s, emp, k=2)
    assert rows(top2, "employer_name") == [("B",), ("C",)]


def test_bi_and_stats(spark):
    fact, bridge, roles, areas, _ = _wh(spark)
    s = marts.star(fact, bridge, roles, areas)
    share = bi.bi_currency_share(marts.mart_currency(s))
    by_role = {}
    for r in share.collect():
        by_role[r["industry_name"]] = by_role.get(r["industry_name"], 0) + r["contribution"]
    assert all(abs(v - 1) < 1e-12 for v in by_role.values())
    piv = bi.bi_currency_pivot(marts.mart_currency(s))
    assert set(piv.columns) == {"industry_name", "RUR", "UNKNOWN", "USD"}
    assert bi.bi_top_table(marts.mart_top_employers(s, _wh(spark)[4]), limit=2).count() == 2
    runs = spark.createDataFrame([("pg", "q1", 0.001), ("pg", "q1", 0.003), ("pg", "q2", 0.002)],
                                 "db string, q string, d double")
    ds = {(r["db"], r["q"]): r for r in stats.duration_stats(runs, ["db", "q"], "d").collect()}
    assert ds[("pg", "q1")]["avg_ms"] == 2.0 and ds[("pg", "q1")]["std_ms"] == 1.0
    assert ds[("pg", "q2")]["std_ms"] == 0.0
    mm = stats.mean_of_means(stats.duration_stats(runs, ["db", "q"], "d"), "db", "avg_ms").first()
    assert mm["mean_of_means"] == 2.0
    assert stats.count_by(spark.createDataFrame([("a",), (None,), (None,)], "x string"), "x").count() == 2


def test_mart_plans_have_no_cartesian_or_nested_loop(spark):
    fact, bridge, roles, areas, emp = _wh(spark)
    s = marts.star(fact, bridge, roles, areas)
    for df in (marts.mart_salary(s), marts.mart_regions(s), marts.mart_trends(s),
               marts.mart_top_employers(s, emp), marts.mart_currency(s)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_empty_warehouse_marts_are_empty(spark):
    e = lambda s: schemas.empty(spark, s)
    s = marts.star(e(schemas.FACT_VACANCY), e(schemas.BRIDGE_ROLE), e(schemas.DIM_ROLE), e(schemas.DIM_AREA))
    assert marts.mart_salary(s).count() == 0


def test_committed_star_scan_prunes_columns_and_aggregates_partially(spark, tmp_path):
    from hiremart import storage
    fact, bridge, roles, areas, emp = _wh(spark)
    path = str(tmp_path / "star")
    s = storage.materialize(marts.star(fact, bridge, roles, areas, emp), path)
    plan = marts.mart_trends(s)._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "ReadSchema: struct<month:date,industry_id:string,industry_name:string>" in scan
    assert "partial_count" in plan
