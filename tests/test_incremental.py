"""Runs maintained from their change sets equal full recomputes of the whole ODS, whatever the
batches move, drop or bring back; repeated after a failure at any write they change nothing."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiremart import schemas, storage
from hiremart.operators import changes, facts, mart_partials, marts, scd2
from hiremart.operators.staging import stage_postings
from hiremart.plans import warehouse
from hiremart.plans.warehouse import Layout

from conftest import rows

ITEMS = T.StructType([T.StructField("_fetch", T.LongType()), T.StructField("_page", T.LongType()),
                      T.StructField("_pos", T.LongType()), T.StructField("item", schemas.POSTING_DOC)])
FEED = "employer_id long, employer_name string, alternate_url string, trusted boolean"


def document(rng, i):
    area, employer = rng.randint(1, 4), rng.randint(1, 5)
    named = rng.choice([f"A{area}", f"A{area}b", None])
    roles = [{"id": r, "name": rng.choice([f"r{r}", f"R{r}", None])} for r in rng.sample(["1", "10", "2", "3", ""], rng.randint(0, 3))]
    return {"id": None if rng.random() < 0.05 else str(i), "name": f"job {i}",
            "published_at": rng.choice([None, *[f"2024-0{m}-{d:02}T10:00:00+0300" for m in (1, 2, 3) for d in (1, 9, 20)]]),
            "area": rng.choice([None, {"id": str(area), "name": named}]),
            "employer": rng.choice([None, {"id": str(employer), "name": rng.choice([None, f"E{employer}", f"E{employer}x"]),
                                           "alternate_url": rng.choice([None, "u", "v"]), "trusted": rng.choice(["true", "false", ""])}]),
            "salary": rng.choice([None, {"from": str(rng.randint(1, 6)), "to": rng.choice([None, "9"]), "currency": rng.choice(["USD", ""])}]),
            "professional_roles": rng.choice([None, roles]), "specializations": rng.choice([None, [{"id": str(area), "name": "s"}]])}


def items_of(spark, docs):
    return spark.createDataFrame([(0, 0, k, d) for k, d in enumerate(docs)], ITEMS)


def batches(seed, runs=3):
    rng = random.Random(seed)
    out = [[document(rng, i) for i in range(30)]]
    for _ in range(runs - 1):       # most documents come again changed, some new, some twice
        out.append([document(rng, rng.randrange(36)) for _ in range(14)])
    return out


def feed_of(spark, run):
    return spark.createDataFrame([(e, f"E{e}" if e % 2 else f"feed {run}", "u", None) for e in (1, 2, 3, 7 + run)], FEED)


def now_of(run):
    return dt.datetime(2024, 4, 1 + run)


def tables_of(wh):
    return {k: rows(v.drop("raw") if "raw" in v.columns else v) for k, v in wh.tables().items()}


@pytest.mark.parametrize("seed", [5])
def test_runs_from_change_sets_equal_full_recomputes(spark, tmp_path, seed):
    L = Layout(spark, str(tmp_path / "wh"), 4)
    full = warehouse.empty_warehouse(spark)
    for run, docs in enumerate(batches(seed)):
        items, now = items_of(spark, docs), now_of(run)
        warehouse.load_run(L, items, now, run)
        full = warehouse.cycle(full, items, now)
        full = replace(full, **{k: storage.materialize(v, str(tmp_path / f"full/{run}/{k}")) for k, v in full.tables().items()})
        assert tables_of(L.state(run)) == tables_of(full), run
        # the marts from partials equal the marts from the whole star
        star = marts.star(full.fact_vacancy, full.bridge_role, full.dim_role, full.dim_area, full.dim_employer)
        want = {"salary": marts.mart_salary(star), "regions": marts.mart_regions(star), "trends": marts.mart_trends(star),
                "top_employers": marts.mart_top_employers(star, k=2), "currency": marts.mart_currency(star)}
        got = mart_partials.all_marts(L.kept("mart_partials", L.end_of(run)), full.dim_role, full.dim_area, full.dim_employer, 2)
        assert {k: rows(v) for k, v in got.items()} == {k: rows(v.select(*got[k].columns)) for k, v in want.items()}
        # an employer feed moves some employers on before the next run
        feed, names = feed_of(spark, run), ["employer_name", "alternate_url"]
        L.commit_scd2(scd2.scd2_step(L.dim("dim_employer_current", L.version(run, 1)), feed, now, tracked=names, step=1),
                      run, Layout.EMPLOYERS)
        full = replace(full, dim_employer=storage.materialize(
            scd2.scd2_apply(full.dim_employer, feed, now, tracked=names, step=1), str(tmp_path / f"full/{run}/fed")))
        assert rows(L.dim_employer(L.end_of(run))) == rows(full.dim_employer)
    counted = L.appended["load_metrics"].read().agg(*[F.sum(c).alias(c) for c in schemas.LOAD_METRICS.fieldNames()]).first()
    stage = stage_postings(full.ods_postings)
    assert counted["ods_added"] == full.ods_postings.count() and counted["fact_rows"] == full.fact_vacancy.count()
    assert counted["eligible_added"] == stage.where("employer_id IS NOT NULL").count()
    assert counted["rejected"] == sum(d["id"] is None for docs in batches(seed) for d in docs)
    assert rows(L.appended["fact_days"].read().groupBy("published_date").agg(F.sum("fact_rows").alias("n"))) == rows(
        full.fact_vacancy.groupBy("published_date").agg(F.count(F.lit(1)).alias("n")))


def test_a_run_that_fails_at_any_write_can_be_repeated(spark, tmp_path, monkeypatch):
    first, second = batches(9, 2)
    sound = Layout(spark, str(tmp_path / "sound"), 4)
    for run, docs in enumerate((first, second)):
        warehouse.load_run(sound, items_of(spark, docs), now_of(run), run)
    want = tables_of(sound.state(1))
    L = Layout(spark, str(tmp_path / "wh"), 4)
    warehouse.load_run(L, items_of(spark, first), now_of(0), 0)
    append, upsert, refresh = storage.AppendTable.append, storage.KeyedTable.upsert, storage.VersionedTable.refresh
    for stop in ("append bridge_role", "upsert postings_parsed", "publish"):
        def failing(method, name):
            def run(self, *a, **k):
                if f"{name} {self.path.rsplit('/', 1)[-1]}" == stop:
                    raise OSError("lost")
                out = method(self, *a, **k)
                if stop == "publish" and name == "upsert" and self.path.endswith("postings_parsed"):
                    raise OSError("lost after the last write")
                return out
            return run
        for cls, method, name in ((storage.AppendTable, append, "append"), (storage.KeyedTable, upsert, "upsert"),
                                  (storage.VersionedTable, refresh, "refresh")):
            monkeypatch.setattr(cls, name, failing(method, name))
        with pytest.raises(OSError):
            warehouse.load_run(L, items_of(spark, second), now_of(1), 1)
        monkeypatch.undo()
    warehouse.load_run(L, items_of(spark, second), now_of(1), 1)
    assert tables_of(L.state(1)) == want
    assert rows(L.stage.read()) == rows(sound.stage.read())
    with pytest.raises(ValueError, match="other documents"):
        warehouse.load_run(L, items_of(spark, first), now_of(1), 1)
    with pytest.raises(ValueError, match="older"):
        warehouse.load_run(L, items_of(spark, second), now_of(0), 0)


def test_new_postings_are_loaded_without_reading_the_ods(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    L = Layout(spark, str(tmp_path / "wh"), 4)
    warehouse.load_run(L, items_of(spark, [document(rng, i) for i in range(20)]), now_of(0), 0)
    read = storage.KeyedTable.read
    monkeypatch.setattr(storage.KeyedTable, "read", lambda self: (_ for _ in ()).throw(AssertionError("whole ODS read"))
                        if self.path.endswith("postings_parsed") and not self.done else read(self))
    monkeypatch.setattr(storage.KeyedTable, "done", False, raising=False)
    upsert = storage.KeyedTable.upsert
    monkeypatch.setattr(storage.KeyedTable, "upsert", lambda self, *a, **k: (setattr(self, "done", True), upsert(self, *a, **k))[1])
    warehouse.load_run(L, items_of(spark, [document(rng, i) for i in range(100, 120)]), now_of(1), 1)
    assert L.appended["fact_vacancy"].added_by(1).count() > 0


def test_winners_of_single_keys(spark):
    schema = "k long, v string, published_at long, vacancy_id long, live boolean"
    posting = "vacancy_id long, k long, v string, published_at long"
    contribute = lambda df: df.where("k IS NOT NULL").select("k", "v", "published_at", "vacancy_id")
    state = spark.createDataFrame([(1, "a", 9, 1, True), (2, "b", 5, 2, True), (3, "c", 7, 3, True), (4, "d", 1, 4, False),
                                   (5, "e", 8, 8, True)], schema)
    old = spark.createDataFrame([(1, 1, "a", 9), (2, 2, "b", 5), (3, 3, "c", 7), (8, 5, "e", 8)], posting)
    new = spark.createDataFrame([(1, 9, "z", 9), (2, 2, "B", 5), (3, None, "c", 7), (6, 4, "D", 0), (8, 5, "late", 2)], posting)
    rest = lambda: spark.createDataFrame([(7, 1, "a2", 3), (9, 5, "e2", 4), (10, 2, "x", 99)], posting)
    got, fresh = changes.winners(state, changes.change_set(new, old), contribute, ["k"], ["published_at", "vacancy_id"], rest,
                                 lambda df: spark.createDataFrame(df.collect(), df.schema))
    assert rows(got) == [(1, "a2", 3, 7, True), (2, "B", 5, 2, True), (3, "c", 7, 3, False), (4, "D", 0, 6, True),
                         (5, "e2", 4, 9, True), (9, "z", 9, 1, True)]
    assert rows(fresh) == rows(got)


def test_fact_rows_need_a_current_employer(spark):
    stage = spark.createDataFrame([(1, None, None, None, 5, 7, None, None, None, None)],
                                  "vacancy_id long, name string, published_at timestamp, published_date date, area_id long, "
                                  "employer_id long, salary_from decimal(18,2), salary_to decimal(18,2), salary_currency string, "
                                  "salary_gross boolean")
    assert facts.fact_rows(stage, schemas.empty(spark, schemas.DIM_EMPLOYER), now_of(0)).count() == 0
