"""Commit markers, run order, bucket counts, whole landed documents, surrogate keys."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from hiremart import schemas
from hiremart.operators import flatten, scd2
from hiremart.plans import warehouse
from hiremart.sources import landing
from hiremart.storage import AppendTable, KeyedTable, VersionedTable


def test_uncommitted_versions_and_runs_are_not_read(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "v"))
    t.refresh(spark.range(3))
    t.refresh(spark.range(5))
    (tmp_path / "v" / "version=2" / "_SUCCESS").unlink()
    assert t.versions() == [1] and t.read().count() == 3
    a = AppendTable(spark, str(tmp_path / "a"), spark.range(1).schema)
    a.append(spark.range(2), 0)
    a.append(spark.range(4), 1)
    (tmp_path / "a" / "_run=1" / "_SUCCESS").unlink()
    assert a.read().count() == 2
    with pytest.raises(ValueError, match="older"):
        a.append(spark.range(1), 3)
        a.refuse_older(2)


def test_another_bucket_count_is_refused(spark, tmp_path):
    rows = spark.range(20).withColumn("o", F.lit(1))
    KeyedTable(spark, str(tmp_path / "k"), ["id"], 4).upsert(rows, ["o"], ["id", "o"])
    KeyedTable(spark, str(tmp_path / "k"), ["id"], 4).upsert(rows, ["o"], ["id", "o"])
    with pytest.raises(ValueError, match="buckets"):
        KeyedTable(spark, str(tmp_path / "k"), ["id"], 8).upsert(rows, ["o"], ["id", "o"])


def test_raw_keeps_undeclared_fields_and_types(spark, tmp_path):
    doc = {"id": "7", "name": "x", "salary": {"from": 100, "gross": True}, "key_skills": [{"name": "a"}], "n": None}
    (tmp_path / "p.json").write_text(json.dumps({"page": 0, "items": [doc]}))
    items = landing.read_paged_items(spark, str(tmp_path / "p.json"), schemas.POSTING_PAGE)
    row = flatten.flatten_postings(items).first()
    assert json.loads(row["raw"]) == doc and row["id"] == 7
    assert items.first()["item"]["salary"]["from"] == "100"


def test_last_write_wins_across_fetches_landed_together(spark, tmp_path):
    doc = lambda name: {"id": "1", "name": name, "published_at": "2024-01-01T00:00:00Z"}
    pages = [{"fetch": 1, "page": 5, "items": [{"id": "2"}, doc("older")]}, {"fetch": 2, "page": 0, "items": [doc("newer")]},
             {"page": 9, "items": [doc("oldest")]}]
    for k, page in enumerate(pages):
        (tmp_path / f"{k}.json").write_text(json.dumps(page))
    items = landing.read_paged_items(spark, str(tmp_path), schemas.POSTING_PAGE)
    ods = warehouse.ods_upsert_postings(spark.createDataFrame([], schemas.ODS_POSTINGS), items)
    assert {r["id"]: r["name"] for r in ods.collect()} == {1: "newer", 2: None}


def test_dictionary_may_start_with_white_space(spark, tmp_path):
    (tmp_path / "d.json").write_text('\n\t[{"id": "1", "name": "a"}]')
    assert landing.read_dictionary(spark, str(tmp_path / "d.json"), schemas.INDUSTRY_DOC).count() == 1


def test_fallback_is_taken_only_without_details(spark):
    search = spark.createDataFrame([(0, 0, ("1",)), (0, 1, ("2",))], "_page int, _pos int, item struct<id:string>")
    none = search.limit(0)
    some = search.limit(1)
    assert landing.enrich_fallback(none, search).count() == 2
    assert landing.enrich_fallback(some, search).count() == 1


def test_steps_of_one_run_have_different_surrogate_keys(spark):
    now = dt.datetime(2024, 1, 1)
    staged = spark.createDataFrame([(1, "a", "u", True)], "employer_id long, employer_name string, alternate_url string, trusted boolean")
    dim = scd2.scd2_step(spark.createDataFrame([], schemas.DIM_EMPLOYER), staged, now)
    again = scd2.scd2_step(dim, staged.withColumn("alternate_url", F.lit("v")), now, step=1).collect()
    assert len({r["employer_sk"] for r in again}) == len(again) == 2


def test_declared_schemas_are_enforced_by_the_write(spark, tmp_path):
    from hiremart.storage import enforced
    schema, key = schemas.MARTS["currency"]
    rows = "industry_id string, industry_name string, area_id long, area_name string, currency string, vacancies_cnt long, currency_share double"
    good = spark.createDataFrame([("1", "a", None, None, "USD", 1, 0.5), ("1", "a", 2, None, "USD", 1, 0.5)], rows)
    assert enforced(good.withColumn("more", F.lit(1)), schema, key).schema.fieldNames() == schema.fieldNames()
    assert VersionedTable(spark, str(tmp_path / "m")).refresh(enforced(good, schema, key)) == 1
    for bad in (good.unionByName(good.limit(1)), good.withColumn("currency", F.lit(None).cast("string"))):
        with pytest.raises(Exception, match="several rows|is NULL"):
            VersionedTable(spark, str(tmp_path / "m")).refresh(enforced(bad, schema, key))
    with pytest.raises(ValueError, match="missing"):
        enforced(good.drop("vacancies_cnt"), schema, key)
    with pytest.raises(Exception, match="INVALID_COLUMN_OR_FIELD_DATA_TYPE"):
        enforced(good.withColumn("vacancies_cnt", F.lit("many")), schema, key)
    assert VersionedTable(spark, str(tmp_path / "m")).versions() == [1]


def test_snapshot_reads_only_its_own_day(spark, tmp_path):
    from hiremart.operators import facts
    from hiremart.plans.warehouse import Layout
    t = Layout(spark, str(tmp_path / "wh"), 4).appended["fact_employer_snapshot"]
    dim = spark.createDataFrame([(e * 10, e, "n", "u", True, None, None, True) for e in (1, 2, 3)], schemas.DIM_EMPLOYER)
    ods = lambda vacancies, ids=(1, 2): spark.createDataFrame(
        [(e, "n", "area", vacancies, "u", "{}") for e in ids], schemas.ODS_EMPLOYERS)
    load = lambda run, day, o: t.append(facts.fact_snapshot(o, dim, t.read_before(run), day, dt.datetime(2024, 1, 1)), run)
    load(0, "2024-01-01", ods(5))
    load(1, "2024-01-01", ods(9, (1, 2, 3)))         # a later run of the day: only the new employer
    load(2, "2024-01-02", ods(7))
    got = sorted((r["employer_id"], str(r["snapshot_date"]), r["open_vacancies"]) for r in t.read().collect())
    assert got == [(1, "2024-01-01", 5), (1, "2024-01-02", 7), (2, "2024-01-01", 5), (2, "2024-01-02", 7), (3, "2024-01-01", 9)]
    plan = t.read().where("snapshot_date = DATE'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_detail_records_and_fallback(spark):
    item = "_page int, _pos int, item struct<id:string,name:string,professional_roles:array<struct<id:string,name:string>>>"
    full = spark.createDataFrame([(0, 0, ("1", "a", [("7", "r")])), (0, 1, ("2", "b", None))], item)
    search = full.withColumn("item", F.col("item").dropFields("professional_roles"))
    got = landing.enriched_postings(search, full.where("item.id = '1'"))
    assert [(r["item"]["id"], len(r["item"]["professional_roles"])) for r in got.collect()] == [("1", 1)]
    none = landing.enriched_postings(search, full.where("item.id = '9'"))
    assert sorted((r["item"]["id"], r["item"]["professional_roles"]) for r in none.collect()) == [("1", None), ("2", None)]
