import json

import pytest
from pyspark.sql import functions as F

from hiremart import schemas
from hiremart.operators.flatten import (flatten_hierarchy, flatten_postings, parse_raw,
                                        rejected_postings)
from hiremart.sources import landing

from conftest import rows


def _items(spark, docs):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "_pos int, j string")
    return df.select(F.lit(0).alias("_page"), "_pos",
                     F.from_json("j", schemas.POSTING_DOC).alias("item"))


def test_flatten_postings_null_safe_and_rejects(spark):
    docs = [{"id": "1", "name": "a", "published_at": "2025-01-01T10:00:00Z"},
            {"id": "2", "area": {"id": "5", "name": "X"}, "employer": {"id": "7", "name": "E"}},
            {"name": "no id"}]
    items = _items(spark, docs)
    out = flatten_postings(items)
    assert rows(out, "id", "area_name", "employer_name") == [(1, None, None), (2, "X", "E")]
    assert rejected_postings(items).first()[0] == 1


def test_raw_round_trip(spark):
    items = _items(spark, [{"id": "3", "salary": {"from": "10", "currency": "RUR"},
                            "professional_roles": [{"id": "10", "name": "r"}]}])
    back = flatten_postings(items).select(parse_raw("raw", schemas.POSTING_DOC).alias("d"))
    d = back.first()["d"]
    assert d["id"] == "3" and d["salary"]["from"] == "10" and d["professional_roles"][0]["id"] == "10"


def test_parse_raw_strict_fails_on_malformed(spark):
    df = spark.createDataFrame([("{not json",)], "raw string")
    with pytest.raises(Exception):
        df.select(parse_raw("raw", schemas.POSTING_DOC)).collect()
    lenient = df.select(parse_raw("raw", schemas.POSTING_DOC, strict=False).alias("d")).first()["d"]
    assert lenient is None or lenient["id"] is None


def test_flatten_hierarchy_child_choice_and_childless(spark):
    docs = [{"id": "1", "name": "A", "industries": [], "spheres": [{"id": "11", "name": "a1"}]},
            {"id": "2", "name": "B"},
            {"id": "3", "name": "C", "areas": [{"id": None, "name": "c?"}]},
            {"name": "no id", "industries": [{"id": "41", "name": "d1"}]}]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "j string") \
        .select(F.from_json("j", schemas.INDUSTRY_DOC).alias("item"))
    out = flatten_hierarchy(df)
    assert rows(out, "industry_id", "sphere_id", "sphere_name") == [
        ("1", "11", "a1"), ("2", None, None), ("3", None, "c?"), (None, "41", "d1")]
    childless = out.filter("industry_id = '2'").first()
    assert json.loads(childless["raw"])["name"] == "B"


def test_paged_read_keeps_order_and_skips_empty_pages(spark, tmp_path):
    p = tmp_path / "pages"
    p.mkdir()
    (p / "a.json").write_text(
        json.dumps({"page": 0, "items": [{"id": "5"}, {"id": "3"}]}) + "\n"
        + json.dumps({"page": 1}) + "\n"
        + json.dumps({"page": 2, "items": [{"id": "5"}]}) + "\n")
    items = landing.read_paged_items(spark, str(p), schemas.POSTING_PAGE)
    assert [(r["_page"], r["_pos"], r["item"]["id"]) for r in items.orderBy("_page", "_pos").collect()] \
        == [(0, 0, "5"), (0, 1, "3"), (2, 0, "5")]


def test_enrich_cut_before_null_skip_and_fallback(spark):
    search = _items(spark, [{"id": None}, {"id": "1"}, {"id": "2"}, {"id": "3"}])
    details = _items(spark, [{"id": "1", "name": "d1"}, {"id": "3", "name": "d3"}])
    e = landing.enrich_details(search, details, max_items=3)
    # first 3 rows: null (skipped after the cut), 1 (detail), 2 (no detail: dropped)
    assert [r["item"]["name"] for r in e.collect()] == ["d1"]
    assert landing.enrich_fallback(e, search).count() == 1
    none = landing.enrich_details(search, spark.createDataFrame([], details.schema), max_items=3)
    fb = landing.enrich_fallback(none, landing.search_view(search))
    assert fb.count() == 4


def test_read_dictionary_array(spark, tmp_path):
    f = tmp_path / "dict.json"
    f.write_text(json.dumps([{"id": "1", "name": "A", "industries": [{"id": "2", "name": "b"}]}], indent=2))
    out = landing.read_dictionary(spark, str(f), schemas.INDUSTRY_DOC)
    assert out.first()["item"]["industries"][0]["id"] == "2"


def test_flatten_postings_naive_variant_keeps_wall_clock(spark):
    import datetime as dt
    items = _items(spark, [{"id": "1", "published_at": "2025-11-11T19:03:31-0500"}])
    aware = flatten_postings(items).select(F.col("published_at").cast("timestamp_ntz")).first()[0]
    naive = flatten_postings(items, naive=True).first()["published_at"]
    assert aware == dt.datetime(2025, 11, 12, 0, 3, 31)
    assert naive == dt.datetime(2025, 11, 11, 19, 3, 31)


def test_read_dictionary_non_array_gives_no_rows(spark, tmp_path):
    for i, payload in enumerate([{"id": "1", "name": "A"}, "oops"]):
        f = tmp_path / f"d{i}.json"
        f.write_text(json.dumps(payload))
        assert landing.read_dictionary(spark, str(f), schemas.INDUSTRY_DOC).count() == 0
