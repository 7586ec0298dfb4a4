import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from hiremart import schemas
from hiremart.operators import dims, facts, quality, scd2
from hiremart.operators.flatten import flatten_postings
from hiremart.operators.staging import stage_postings

from conftest import rows

T1 = dt.datetime(2025, 1, 1)
T2 = dt.datetime(2025, 1, 2)


def _stage(spark, docs):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "_pos int, j string")
    items = df.select(F.lit(0).alias("_page"), "_pos", F.from_json("j", schemas.POSTING_DOC).alias("item"))
    return stage_postings(flatten_postings(items).drop("_page", "_pos"))


def _emp(i, name, url="u", trusted=None):
    e = {"id": str(i), "name": name, "alternate_url": url}
    if trusted is not None:
        e["trusted"] = trusted
    return e


DOCS = [
    {"id": "1", "published_at": "2025-01-01T10:00:00+0300", "employer": _emp(10, "A", trusted=True),
     "area": {"id": "1", "name": "Moscow"}, "salary": {"from": 100, "to": 200, "currency": "RUR"},
     "professional_roles": [{"id": "9", "name": "nine"}, {"id": "10", "name": None}, {"id": ""}],
     "specializations": [{"id": "1.1"}, {"name": "no id"}]},
    {"id": "2", "published_at": "2025-01-03T10:00:00Z", "employer": _emp(10, "A2"),
     "area": {"id": "1", "name": "Moskva"}, "professional_roles": None},
    {"id": "3", "published_at": "2025-01-02T10:00:00-0500"},
]


def test_stage_and_dimensions(spark):
    st = _stage(spark, DOCS)
    s = st.filter("vacancy_id = 1").first()
    assert s["salary_from"] == Decimal("100.00") and s["trusted"] is True and s["area_id"] == 1
    dd = dims.dim_date(schemas.empty(spark, schemas.DIM_DATE), st)
    assert dd.count() == 3
    area = dims.dim_area(schemas.empty(spark, schemas.DIM_AREA), st)
    assert rows(area) == [(1, "Moskva")]       # latest publication wins
    role = dims.dim_role(schemas.empty(spark, schemas.DIM_ROLE), st)
    assert rows(role) == [("10", "UNKNOWN"), ("9", "nine")]
    br = facts.bridge_rows(st, "professional_roles", "role_id", T1)
    assert rows(br, "vacancy_id", "role_id") == [(1, "10"), (1, "9")]
    bs = facts.bridge_rows(st, "specializations", "sphere_id", T1)
    assert rows(bs, "vacancy_id", "sphere_id") == [(1, "1.1")]


def test_dim_date_empty_source_gives_no_rows(spark):
    empty = spark.createDataFrame([], "published_date date")
    assert dims.date_rows(empty, "published_date").count() == 0


def _staged(spark, data):
    return spark.createDataFrame(data, "employer_id bigint, employer_name string, "
                                       "alternate_url string, trusted boolean")


def _check_scd2_invariants(dim):
    from pyspark.sql import Window
    cur = dim.filter("is_current").groupBy("employer_id").count()
    assert cur.filter("count > 1").count() == 0
    assert dim.filter("valid_from >= valid_to").count() == 0
    assert dim.select("employer_sk").distinct().count() == dim.count()
    # versions of one key never overlap: each starts where the previous ended or later
    prev_to = F.lag("valid_to").over(Window.partitionBy("employer_id").orderBy("valid_from"))
    assert dim.withColumn("_p", prev_to).filter("_p IS NOT NULL AND valid_from < _p").count() == 0
    # only the latest version of a key may be current
    last = F.max("valid_from").over(Window.partitionBy("employer_id"))
    assert dim.withColumn("_l", last).filter("is_current AND valid_from < _l").count() == 0


def test_scd2_apply_equals_expire_then_insert_and_is_idempotent(spark):
    empty = schemas.empty(spark, schemas.DIM_EMPLOYER)
    v1 = scd2.scd2_apply(empty, _staged(spark, [(1, "a", "u", None), (2, "b", "u", True)]), T1)
    s2 = _staged(spark, [(1, "a", "u", None), (2, "b", "u", False), (3, "c", None, None)])
    applied = scd2.scd2_apply(v1, s2, T2)
    stepwise = scd2.scd2_insert(scd2.scd2_expire(v1, s2, T2), s2, T2)
    assert rows(applied) == rows(stepwise)
    assert rows(applied.filter("is_current"), "employer_id", "trusted") == [(1, None), (2, False), (3, None)]
    assert applied.filter("employer_id = 2 AND NOT is_current").first()["valid_to"] is not None
    _check_scd2_invariants(applied)
    again = scd2.scd2_apply(applied, s2, T2)
    assert rows(again) == rows(applied)


def test_scd2_tracked_subset_ignores_untracked(spark):
    empty = schemas.empty(spark, schemas.DIM_EMPLOYER)
    v1 = scd2.scd2_apply(empty, _staged(spark, [(1, "a", "u", True)]), T1)
    feed = _staged(spark, [(1, "a", "u", None)])
    out = scd2.scd2_apply(v1, feed, T2, tracked=["employer_name", "alternate_url"])
    assert out.count() == 1
    out2 = scd2.scd2_apply(v1, _staged(spark, [(1, "a", "v", None)]), T2,
                           tracked=["employer_name", "alternate_url"])
    assert out2.count() == 2
    _check_scd2_invariants(out2)


def test_fact_incremental_first_write_wins_and_quality(spark):
    st = _stage(spark, DOCS)
    dim = scd2.scd2_apply(schemas.empty(spark, schemas.DIM_EMPLOYER),
                          scd2.stage_employers_from_postings(st), T1)
    f1 = facts.fact_incremental(st, dim, schemas.empty(spark, schemas.FACT_VACANCY), T1)
    assert rows(f1, "vacancy_id") == [(1,), (2,)]          # vacancy 3 has no employer
    f2 = facts.fact_incremental(st, dim, f1, T2)
    assert f2.count() == 0
    ods = flatten_postings(spark.createDataFrame([(json.dumps(d),) for d in DOCS], "j string")
                           .select(F.lit(0).alias("_page"), F.lit(0).alias("_pos"),
                                   F.from_json("j", schemas.POSTING_DOC).alias("item")))
    rc = quality.dq_row_counts(ods, f1).first()
    assert (rc["ods_total"], rc["ods_eligible"], rc["dds_count"], rc["status"]) == (3, 2, 2, "PASS")
    assert quality.dq_null_keys(f1).first()["status"] == "PASS"
    dr = quality.dq_date_range(f1, lo="2025-01-02", as_of="2025-01-02").first()
    assert (dr["too_old"], dr["in_future"], dr["status"]) == (1, 1, "FAIL")


def test_fact_snapshot_first_run_of_day_wins(spark):
    ods = spark.createDataFrame([(1, "a", "X", 3, "s")],
                                "id bigint, name string, area_name string, open_vacancies int, site_url string")
    dim = scd2.scd2_apply(schemas.empty(spark, schemas.DIM_EMPLOYER),
                          scd2.stage_employers_from_feed(ods), T1)
    first = facts.fact_snapshot(ods, dim, schemas.empty(spark, schemas.FACT_EMPLOYER_SNAPSHOT), dt.date(2025, 1, 1), T1)
    assert first.count() == 1
    again = facts.fact_snapshot(ods, dim, first, dt.date(2025, 1, 1), T2)
    assert again.count() == 0
    next_day = facts.fact_snapshot(ods, dim, first, dt.date(2025, 1, 2), T2)
    assert next_day.count() == 1


def test_industry_dimensions(spark):
    ods = spark.createDataFrame([("1", "A", "11", "a1", "r"), ("1", "B", None, None, "r"),
                                 (None, "X", "12", "x", "r")],
                                "industry_id string, industry_name string, sphere_id string, "
                                "sphere_name string, raw string")
    assert rows(dims.dim_industry(schemas.empty(spark, schemas.DIM_INDUSTRY), ods)) == [("1", "B")]
    assert rows(dims.dim_sphere(schemas.empty(spark, schemas.DIM_SPHERE), ods)) == \
        [("11", "a1", "1"), ("12", "x", None)]


def test_scd2_invariants_on_driver_tables(spark):
    from pathlib import Path
    import pytest
    from hiremart.plans import fixture_runs as FR
    sf = "/root/testdata/sf0.001"
    if not Path(sf).exists():
        pytest.skip("driver tables not present")
    run1, run2 = FR.warehouse_states(spark, sf)
    for dim in (run1.dim_employer, run2.dim_employer, FR.employer_feed(spark, sf)[1]):
        _check_scd2_invariants(dim)
    assert run2.dim_employer.filter("NOT is_current").count() > 0      # run 2 versioned someone


def test_dq_foreign_keys_counts_orphans(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, fk int")
    parent = spark.createDataFrame([(10,), (11,)], "pk int")
    out = quality.dq_foreign_keys([("child.fk", child, "fk", parent, "pk")]).first()
    assert (out["relation"], out["orphans"], out["status"]) == ("child.fk", 1, "FAIL")
