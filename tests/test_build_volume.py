"""What the warehouse build shuffles, spills and writes: rows travel once and narrow, with the same results."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from hiremart import schemas
from hiremart.operators import changes, mart_partials
from hiremart.operators.flatten import flatten_postings
from hiremart.plans import warehouse
from hiremart.plans.warehouse import Layout
from hiremart.session import TASK_BYTES, prepare_warehouse
from hiremart.sources import driver

from conftest import rows


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_typed_documents_are_not_written_as_text(spark, tmp_path):
    doc = [(0, 0, 0, {"id": "1", "name": "a", "published_at": "2024-01-02T10:00:00+0300", "area": {"id": "3", "name": "A"},
                      "professional_roles": [{"id": "7", "name": None}]}),
           (0, 0, 1, {"id": None, "name": "lost"}), (0, 0, 2, {"id": "2", "employer": {"id": "5", "name": "E"}})]
    schema = f"_fetch long, _page long, _pos long, item {schemas.POSTING_DOC.simpleString()}"
    items = spark.createDataFrame(doc, schema)
    L = Layout(spark, str(tmp_path / "wh"), 4)
    wh = warehouse.load_run(L, items, dt.datetime(2024, 2, 1), 0)
    written = spark.read.parquet(f"{L.work(0)}/batch")
    assert "raw" not in written.columns
    flat = flatten_postings(items, rejects=True)
    assert L.batch(0).columns == flat.columns and rows(L.batch(0)) == rows(flat)
    assert rows(wh.ods_postings.select("id", "raw")) == rows(flat.where("id IS NOT NULL").select("id", "raw"))
    # documents with their landed text are written with it
    whole = Layout(spark, str(tmp_path / "whole"), 4)
    warehouse.load_run(whole, items.withColumn("_raw", F.lit('{"id": "1", "more": 1}')), dt.datetime(2024, 2, 1), 0)
    assert {r[0] for r in whole.batch(0).select("raw").collect()} == {'{"id": "1", "more": 1}'}


def test_change_set_shuffles_no_lists(spark):
    kept = "vacancy_id long, named boolean, role_ids array<string>"
    old = spark.createDataFrame([(1, True, ['a"', "b,"]), (2, None, []), (3, True, None)], kept)
    new = spark.createDataFrame([(1, False, ["c"]), (2, True, ["", "d"]), (3, None, ["e"]), (4, True, None)], kept)
    got = changes.change_set(new, old.hint("merge"))
    assert rows(changes.side(got, "new")) == rows(new)
    assert rows(changes.side(got, "old")) == rows(old)
    assert [r[0] for r in got.where("old IS NULL").select("vacancy_id").collect()] == [4]
    assert "Exchange hashpartitioning" in executed(got) and "StructsToJson" in executed(got)


def test_partials_are_merged_by_one_shuffle(spark):
    state = spark.createDataFrame([(dt.date(2024, 1, 1), "7", 1, "RUR", 9, 2, 2, Decimal("30.000"), Decimal("10.000"), Decimal("20.000"))],
                                  schemas.MART_PARTIALS)
    moves = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), "7", 1, "RUR", 9, Decimal("40.000")), (-1, dt.date(2024, 1, 1), "7", 1, "RUR", 9, Decimal("10.000")),
         (1, dt.date(2024, 2, 1), "7", None, "RUR", 9, None)],
        "sign int, month date, industry_id string, area_id long, currency string, employer_sk long, salary_point decimal(22,3)")
    out = mart_partials.merge(state, moves)
    assert executed(out).count("Exchange hashpartitioning") == 1
    got = {r["month"].month: r for r in out.collect()}
    assert (got[1]["vacancies_cnt"], got[1]["salary_sum"], got[1]["salary_max"], got[1]["_open"]) == (2, Decimal("60.000"), Decimal("40.000"), True)
    assert (got[2]["vacancies_cnt"], got[2]["vacancies_with_salary_cnt"], got[2]["salary_sum"], got[2]["_open"]) == (1, 0, None, False)


def test_a_line_is_dealt_once_for_both_links(spark, tmp_path):
    d = str(tmp_path)
    put = lambda name, data, schema: spark.createDataFrame(data, schema).write.parquet(f"{d}/{name}.parquet")
    put("lineitem", [(1, 10, 20), (1, 10, 21), (1, 11, 20), (2, 99, 20), (3, 10, 99), (4, 99, 99), (5, None, None), (None, 10, 20)],
        "l_orderkey long, l_partkey long, l_suppkey long")
    put("part", [(10, "Brand#12"), (10, "Brand#12"), (11, None), (None, "Brand#1")], "p_partkey long, p_brand string")
    put("supplier", [(20, 1), (20, 1), (21, 2), (22, None)], "s_suppkey long, s_nationkey int")
    put("nation", [(1, "N"), (1, "N"), (2, None)], "n_nationkey int, n_name string")
    out = driver._link_arrays(spark, d)
    got = {r[0]: (r[1] and [tuple(x) for x in r[1]], r[2] and [tuple(x) for x in r[2]]) for r in out.collect()}
    assert got[1] == ([(None, None), ("12", "Brand#12")], [("1", "N"), ("2", None)])
    assert got[2] == (None, [("1", "N")]) and got[3] == ([("12", "Brand#12")], None)
    assert got.get(4, (None, None)) == got.get(5, (None, None)) == (None, None) and None not in got
    # one exchange by order, fed by the joins; two rows a line were a union of both before
    assert "Union" not in executed(out)


def test_tasks_of_the_warehouse_are_bounded(spark):
    before = {k: spark.conf.get(k, None) for k in TASK_BYTES}
    try:
        for k in TASK_BYTES:
            spark.conf.unset(k)
        prepare_warehouse(spark)
        assert {k: spark.conf.get(k) for k in TASK_BYTES} == TASK_BYTES
        own = dict.fromkeys(TASK_BYTES, "77m")
        for k, v in own.items():
            spark.conf.set(k, v)
        prepare_warehouse(spark)
        assert {k: spark.conf.get(k) for k in TASK_BYTES} == own
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_a_written_change_set_holds_what_changed(spark, tmp_path):
    loaded = "struct<employer_sk: long, area_id: long>"
    both = f"vacancy_id long, area_id long, name string, role_ids array<string>, loaded {loaded}"
    old = spark.createDataFrame([(1, 7, "a", ["x"], (5, 7)), (2, None, None, None, (6, 8)), (3, 7, "a", [], None), (5, 1, "z", ["q"], (1, 1))], both)
    new = spark.createDataFrame([(1, 7, "a", ["x"]), (2, 8, "b", []), (3, None, None, [None]), (4, 1, "d", None)],
                                "vacancy_id long, area_id long, name string, role_ids array<string>")
    changes.narrowed(changes.change_set(new, old)).write.parquet(str(tmp_path / "c"))
    written = spark.read.parquet(str(tmp_path / "c"))
    assert rows(changes.replaced(written)) == rows(old.where("vacancy_id <> 5"))
    assert rows(written.select("vacancy_id", changes.was(written, "loaded").alias("l")), "vacancy_id", "l")[3] == (4, None)
    same = written.where("vacancy_id = 1").select("old.*").first()
    assert (same["area_id"], same["name"], same["role_ids"], same["loaded"]["area_id"]) == (None, None, None, None)


def test_lists_travel_as_short_text(spark):
    lists = [["11", "23"], [], None, [None], ["a", None], ["a,b"], ["[x", "y"], [""], ["", ""], ["a", ""], ['"', "é"]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, ids array<string>")
    text = changes.with_text(df, ["ids"])
    assert rows(changes.with_lists(text, ["ids"]), "i", "ids") == rows(df, "i", "ids")
    assert text.where("i = 0").first()["ids"] == "11,23"


def test_only_opened_postings_are_written_beside_their_version(spark, tmp_path):
    doc = lambda i, e: (0, 0, i, {"id": str(i), "name": "n", "published_at": "2024-01-02T10:00:00Z",
                                  "employer": e and {"id": e, "name": "E" if e != "9" else None}, "professional_roles": [{"id": "7", "name": "R"}]})
    schema = f"_fetch long, _page long, _pos long, item {schemas.POSTING_DOC.simpleString()}"
    L = Layout(spark, str(tmp_path / "wh"), 4)
    first = spark.createDataFrame([doc(1, "5"), doc(2, "9"), doc(3, None)], schema)
    warehouse.load_run(L, first, dt.datetime(2024, 2, 1), 0)
    warehouse.load_run(L, spark.createDataFrame([doc(1, "5"), doc(3, None), doc(4, "5")], schema), dt.datetime(2024, 3, 1), 1)
    assert [r[0] for r in rows(spark.read.parquet(f"{L.work(1)}/opened"), "vacancy_id")] == [2, 4]
    got = rows(warehouse.committed_posting_rows(L, 1), "vacancy_id", "_touched", "_fact", "_waits", "_was_loaded", "_new_roles")
    assert got == [(1, True, False, False, True, []), (2, False, False, True, False, []), (3, True, False, False, False, []),
                   (4, True, True, False, False, ["7"])]
