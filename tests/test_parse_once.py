"""Typed documents are not parsed from text, employers by one parse of their member; files of a publish keep their size."""

import datetime as dt
from decimal import Decimal
from pathlib import Path

from hiremart import schemas
from hiremart.operators import scd2
from hiremart.operators.flatten import as_declared, flatten_postings, flatten_typed, typed_documents
from hiremart.operators.staging import EMPLOYER_COLS, stage_postings
from hiremart.plans import warehouse
from hiremart.plans.warehouse import Layout
from hiremart.storage import KeyedTable

from conftest import rows

TYPED = ("id string, name string, area struct<id:string,name:string>, "
         "employer struct<id:bigint,name:string,alternate_url:string,trusted:boolean>, published_at string, "
         "salary struct<from:decimal(18,2),to:decimal(18,2),currency:string,gross:boolean>, "
         "professional_roles array<struct<name:string,id:int>>, specializations array<struct<id:string,name:string>>")
NOW = dt.datetime(2024, 2, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def typed_items(spark, *docs):
    return spark.createDataFrame([(0, i, d) for i, d in enumerate(docs)], f"_page long, _pos int, item struct<{TYPED}>")


DOCS = [
    {"id": "1", "name": "a,\"b", "area": {"id": "3", "name": None}, "published_at": "2024-01-02T10:00:00+0300",
     "employer": {"id": 5, "name": "E", "alternate_url": "u", "trusted": True},
     "salary": {"from": Decimal("100.10"), "currency": "", "gross": False},
     "professional_roles": [{"id": 7, "name": "x"}, None, {"id": None, "name": "y"}], "specializations": []},
    {"id": "2", "employer": {"id": 6, "name": None}, "professional_roles": None, "specializations": [{"id": "", "name": "s"}]},
    {"id": None, "name": "lost"}]


def test_typed_documents_stage_as_their_text_does(spark, tmp_path):
    typed_documents(typed_items(spark, *DOCS)).write.parquet(str(tmp_path / "b"))
    written = spark.read.parquet(str(tmp_path / "b"))
    direct, text = stage_postings(flatten_typed(written, parsed=True)), stage_postings(flatten_typed(written))
    assert direct.dtypes == text.dtypes and rows(direct) == rows(text)
    assert "from_json" not in plan(direct) and "to_json" not in plan(direct)


def test_types_without_a_text_of_their_own_are_parsed_from_json(spark):
    item = spark.createDataFrame([], "item struct<id:double>").schema["item"].dataType
    assert as_declared(None, item["id"].dataType, schemas.POSTING_DOC["id"].dataType) is None
    documents = spark.createDataFrame([(1, None, (dt.date(2024, 1, 1),))], "id long, published_at timestamp, item struct<published_at:date>")
    wide = documents.selectExpr("id", "published_at", "named_struct('name', 'n', 'published_at', item.published_at, "
                                "'area', named_struct('name', 'A'), 'employer', named_struct('name', 'E')) AS item")
    assert "_doc" not in flatten_typed(wide, parsed=True).columns


def test_employers_are_staged_by_one_parse_of_their_member(spark):
    ods = flatten_postings(typed_items(spark, *DOCS))
    some, whole = stage_postings(ods, EMPLOYER_COLS), stage_postings(ods)
    assert some.columns == EMPLOYER_COLS and rows(some) == rows(whole.select(*EMPLOYER_COLS))
    assert rows(scd2.employer_rows(some)) == rows(scd2.employer_rows(whole))
    # the filters on what is parsed do not parse again, and no other member is parsed
    assert plan(scd2.employer_rows(some)).count("from_json(") == 1
    assert plan(scd2.employer_rows(whole)).count("from_json(") == 1
    assert "professional_roles" not in plan(scd2.employer_rows(some)).split("from_json(")[1].split("raw#")[0]


def _tables(wh):
    return {k: rows(v) for k, v in wh.tables().items()}


def test_a_run_writes_no_second_copy_of_typed_documents(spark, tmp_path):
    items = typed_items(spark, *DOCS)
    L = Layout(spark, str(tmp_path / "wh"), 2)
    got = warehouse.load_run(L, items, NOW, 0)
    assert not Path(f"{L.work(0)}/parsed").exists()
    assert _tables(got) == _tables(warehouse.build(spark, [(items, NOW)]))
    # repeated ids: the picked rows are written, the last write wins
    again, later = typed_items(spark, DOCS[1], {"id": "3", "name": "first"}, {"id": "3", "name": "second"}), dt.datetime(2024, 3, 1)
    got = warehouse.load_run(L, again, later, 1)
    assert Path(f"{L.work(1)}/parsed").exists()
    assert _tables(got) == _tables(warehouse.build(spark, [(items, NOW), (again, later)]))


def test_files_of_many_buckets_do_not_shrink(spark):
    tasks = lambda buckets, size, cores: KeyedTable(spark, "/nowhere", ["id"], buckets)._tasks(size, cores)
    mb = 1 << 20
    assert tasks(16, 3200 * mb, 12) == 200 and tasks(64, 3200 * mb, 12) == 50       # 1 MB a file either way
    assert tasks(2, 80 * mb, 4) == 10
    assert tasks(64, 50 * mb, 8) == 7 and tasks(64, 80 * mb, 8) == 8                # every core has a task first
    assert tasks(64, 1, 8) == tasks(16, 1, 8) == tasks(2, 0, 8) == 1
