import json

from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiremart import schemas, storage
from hiremart.operators.upsert import (composite_doc_key, insert_ignore, pick_per_key, pick_repeated, upsert)
from hiremart.session import scratch_path

from conftest import rows


def _t(spark, data):
    return spark.createDataFrame(data, "k int, v string, seq int")


def test_upsert_last_write_wins_and_idempotent(spark):
    target = spark.createDataFrame([(1, "old"), (2, "keep")], "k int, v string")
    batch = _t(spark, [(1, "a", 1), (1, "b", 2), (3, "c", 1)])
    once = upsert(target, batch, ["k"], ["seq"])
    assert rows(once) == [(1, "b"), (2, "keep"), (3, "c")]
    twice = upsert(once, batch, ["k"], ["seq"])
    assert rows(twice) == rows(once)
    assert rows(upsert(target, spark.createDataFrame([], batch.schema), ["k"], ["seq"])) == rows(target)


def test_upsert_null_safe_composite_key(spark):
    target = spark.createDataFrame([("1", None, "x"), ("1", "2", "y")], "a string, b string, v string")
    batch = spark.createDataFrame([("1", None, "z", 1)], "a string, b string, v string, seq int")
    assert rows(upsert(target, batch, ["a", "b"], ["seq"], null_safe=True)) == [("1", "2", "y"), ("1", None, "z")]
    # without null safety the NULL-keyed row is duplicated
    assert upsert(target, batch, ["a", "b"], ["seq"]).count() == 3


def test_insert_ignore_first_wins(spark):
    target = spark.createDataFrame([(1, "t")], "k int, v string")
    batch = _t(spark, [(1, "x", 1), (2, "late", 2), (2, "early", 1)])
    assert rows(insert_ignore(target, batch, ["k"], ["seq"])) == [(2, "early")]


def test_pick_per_key_hot_key(spark):
    hot = spark.range(0, 3000).select(F.lit(7).alias("k"), F.col("id").cast("int").alias("seq"),
                                      F.col("id").cast("string").alias("v"))
    out = pick_per_key(hot, ["k"], ["seq"])
    assert rows(out, "k", "seq") == [(7, 2999)]


def test_composite_doc_key(spark):
    df = spark.createDataFrame([("1", None, json.dumps({"id": "1", "name": "A"})),
                                ("1", "9", json.dumps({"id": "9", "name": "s"}))],
                               "industry_id string, sphere_id string, raw string")
    out = composite_doc_key(df, doc_schema=schemas.INDUSTRY_DOC)
    got = {r["_id"]: json.loads(r["raw"]) for r in out.collect()}
    assert set(got) == {"1:", "1:9"}
    assert "sphere_id" not in got["1:"] and got["1:"]["industry_id"] == "1"   # NULL fields omitted
    assert got["1:9"]["sphere_id"] == "9" and got["1:9"]["name"] == "s"


def test_versioned_table_atomic_refresh(spark):
    path = scratch_path(spark, "vt")
    t = storage.VersionedTable(spark, path)
    assert t.current_version() == 0
    t.refresh(spark.createDataFrame([(1,)], "x int"))
    t.refresh(spark.createDataFrame([(2,), (3,)], "x int"))
    assert t.current_version() == 2
    assert rows(t.read()) == [(2,), (3,)]
    assert rows(storage.full_refresh(spark.createDataFrame([(4,)], "x int"), path)) == [(4,)]


def test_keyed_table_rewrites_only_touched_buckets(spark):
    path = scratch_path(spark, "keyed")
    t = storage.KeyedTable(spark, path, ["k"], buckets=8)
    first = spark.range(0, 200).select(F.col("id").cast("int").alias("k"), F.lit("v1").alias("v"),
                                       F.lit(0).alias("seq"))
    t.upsert(first, ["seq"], ["k", "v"])
    files_before = set(spark.read.parquet(path).inputFiles())
    batch = spark.createDataFrame([(3, "v2", 1), (3, "v3", 2), (500, "new", 1)], "k int, v string, seq int")
    out = t.upsert(batch, ["seq"], ["k", "v"])
    assert out.count() == 201
    assert rows(out.filter("k IN (3, 500)")) == [(3, "v3"), (500, "new")]
    expected = rows(out)
    files_after = set(spark.read.parquet(path).inputFiles())
    untouched = files_before & files_after
    assert 0 < len(untouched) < len(files_before)        # other buckets were not rewritten
    again = t.upsert(batch, ["seq"], ["k", "v"])          # idempotent
    assert rows(again) == expected


def test_versioned_table_explicit_versions_and_reads(spark):
    path = scratch_path(spark, "vt2")
    t = storage.VersionedTable(spark, path)
    t.refresh(spark.createDataFrame([(1,)], "x int"), version=5)
    t.refresh(spark.createDataFrame([(2,)], "x int"), version=9)
    t.refresh(spark.createDataFrame([(3,)], "x int"), version=9)      # retry replaces version 9
    assert t.versions() == [5, 9]
    assert rows(t.read()) == [(3,)] and rows(t.read(version=8)) == [(1,)]
    assert t.read_or_empty(t.read().schema, version=4).count() == 0
    t.refresh(spark.createDataFrame([], "x int"), version=12)           # an empty version is a version
    assert t.current_version() == 12 and t.read().count() == 0


def test_append_table_runs(spark):
    t = storage.AppendTable(spark, scratch_path(spark, "at"), T.StructType([T.StructField("x", T.IntegerType())]))
    assert t.read().count() == 0
    t.append(spark.createDataFrame([(1,), (2,)], "x int"), run=0)
    t.append(spark.createDataFrame([(3,)], "x int"), run=1)
    t.append(spark.createDataFrame([(3,)], "x int"), run=1)             # retry: no duplicate
    assert rows(t.read()) == [(1,), (2,), (3,)]
    assert rows(t.read(upto=0)) == [(1,), (2,)] and rows(t.read_before(1)) == [(1,), (2,)]


def test_staged_bucket_is_published_by_several_tasks(spark, monkeypatch):
    """A large bucket is not one task's, nor sorted: the publishing tasks follow the staged bytes."""
    monkeypatch.setattr(storage, "STAGED_BYTES", 1, raising=False)
    table = storage.KeyedTable(spark, scratch_path(spark, "keyed"), ["k"], 1)
    first = spark.range(0, 400, 1, 4).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    table.upsert(first, [], ["k", "v"], unique=True, staged=scratch_path(spark, "staged"))
    assert len(table._raw().inputFiles()) > 1
    changed = first.where("k >= 200").withColumn("v", F.lit("b"))
    out = table.upsert(changed, [], ["k", "v"], unique=True, staged=scratch_path(spark, "staged"))
    assert rows(out.groupBy("v").count()) == [("a", 200), ("b", 200)] and out.distinct().count() == 400
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_staged_upsert_repeated_after_a_partial_publish(spark):
    """A first publish that wrote some buckets only is completed by the repeated run."""
    table = storage.KeyedTable(spark, scratch_path(spark, "keyed"), ["k"], 4)
    batch = spark.range(40).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    table.upsert(batch.where("k < 3"), [], ["k", "v"], unique=True)
    out = table.upsert(batch, [], ["k", "v"], unique=True, staged=scratch_path(spark, "staged"))
    assert sorted(r["k"] for r in out.collect()) == list(range(40))


def test_pick_per_key_carries_no_column_twice(spark):
    batch = spark.createDataFrame([(1, "b", 2, [1]), (1, "a", 2, [2]), (None, "c", 1, None)],
                                  "k int, v string, seq int, more array<int>")
    out = pick_per_key(batch, ["k"], ["seq", "v"])
    assert "max_by" not in out._jdf.queryExecution().executedPlan().toString()
    assert rows(out, "k", "v") == [(1, "b"), (None, "c")]
    assert rows(pick_per_key(batch, ["k"], ["seq", "v"], latest=False), "k", "v") == [(1, "a"), (None, "c")]
    maps = batch.withColumn("m", F.create_map("v", "seq"))        # a map has no order
    assert [r["m"] for r in pick_per_key(maps, ["k"], ["seq", "v"]).where("k = 1").collect()] == [{"b": 2}]


def test_empty_target_needs_no_join(spark):
    batch = _t(spark, [(1, "a", 1), (2, "b", 1)])
    out = upsert(schemas.empty(spark, batch.schema), batch, ["k"], ["seq"])
    assert out.schema.names == batch.schema.names and out.count() == 2
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert schemas.empty(spark, schemas.STAGE_KEPT).schema == schemas.STAGE_KEPT


def test_well_compressed_dimension_is_not_broadcast(spark):
    """A dimension of a million rows in a few MB of files does not go through the driver."""
    from hiremart.session import prepare_warehouse

    path = scratch_path(spark, "dimension")
    spark.range(600_000).select("id", F.lit("a label that compresses well").alias("label")).write.parquet(path)
    dim, facts = spark.read.parquet(path), spark.range(10_000_000).withColumn("f", F.rand())
    prepare_warehouse(spark)
    plan = facts.join(dim, "id", "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_pages_are_landed_compressed(spark):
    from hiremart.sources import landing

    path = scratch_path(spark, "pages")
    item = spark.createDataFrame([(1, [("7", "x")])], "page long, items array<struct<id: string, name: string>>")
    for _ in range(2):
        landing.write_pages(item, path, mode="append")
    assert all(f.endswith(".json.gz") for f in spark.read.text(path).inputFiles())
    assert landing.read_paged_items(spark, path, schemas.POSTING_PAGE).count() == 2


def test_only_repeated_keys_are_shuffled_with_their_rows(spark, monkeypatch):
    """Rows of keys that come once stay where they are read; the result is that of ``pick_per_key``."""
    batch = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 1, "d"), (None, 1, "e"), (3, None, "f")],
                                  "k int, seq int, v string")
    commit = lambda df: storage.materialize(df, scratch_path(spark, "repeated"))
    expected = rows(pick_per_key(batch, ["k"], ["seq", "v"]))
    assert rows(pick_repeated(batch, ["k"], ["seq", "v"], commit)) == expected and len(expected) == 4
    once = batch.where("k > 1")
    assert "Exchange" not in pick_repeated(once, ["k"], ["seq", "v"], commit)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr("hiremart.operators.upsert.FEW_KEYS", 1)
    assert rows(pick_repeated(batch, ["k"], ["seq", "v"], commit)) == expected


def test_staged_upsert_stages_only_the_kept_rows(spark):
    """Rows that the batch replaces are not written twice; a retry publishes the kept ones again."""
    for null_safe in (False, True):
        for few in (2, 18):         # kept rows looked up by their own keys, or by the batch's
            table = storage.KeyedTable(spark, scratch_path(spark, "keyed"), ["k"], 1, null_safe=null_safe)
            old = spark.range(20).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("a").alias("v"))
            table.upsert(old, [], ["k", "v"], unique=True, staged=scratch_path(spark, "staged"))
            batch, staged = old.where(f"k >= {few} OR k IS NULL").withColumn("v", F.lit("b")), scratch_path(spark, "staged")
            for _ in range(2):
                out = table.upsert(batch, [], ["k", "v"], unique=True, staged=staged)
                kept = [(k, "a") for k in range(1, few)] + ([] if null_safe else [(None, "a")])
                assert Counter(rows(spark.read.parquet(staged))) == Counter(kept)
                assert Counter(rows(out)) == Counter([*kept, *[(k, "b") for k in range(few, 20)], (None, "b")])


def test_link_arrays_are_dealt_once(spark, tmp_path):
    """Both arrays of a posting come of one shuffle of its lines; lines without a part or supplier give none."""
    from hiremart.sources import driver
    tables = {"lineitem": ([(1, 1, 1), (1, 2, 2), (1, 2, 1), (2, 9, 1), (3, 1, None), (None, 1, 1), (4, 3, 9)],
                           "l_orderkey long, l_partkey long, l_suppkey long"),
              "part": ([(1, "Brand#12"), (2, "Brand#11"), (2, "Brand#11"), (3, None)], "p_partkey long, p_brand string"),
              "supplier": ([(1, 7), (2, 5)], "s_suppkey long, s_nationkey int"),
              "nation": ([(7, "G"), (5, None)], "n_nationkey int, n_name string")}
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    out = driver._link_arrays(spark, str(tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
    got = {r[0]: (r[1] and [tuple(x) for x in r[1]], r[2] and [tuple(x) for x in r[2]]) for r in out.collect()}
    assert got == {1: ([("11", "Brand#11"), ("12", "Brand#12")], [("5", None), ("7", "G")]),
                   2: (None, [("7", "G")]), 3: ([("12", "Brand#12")], None), 4: ([(None, None)], None)}
