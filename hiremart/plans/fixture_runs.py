"""The scheduled runs replayed over the driver's test tables.

Run 1 happens at ``RUN_1_AT`` and fetches the postings published before it;
run 2 happens at ``RUN_2_AT`` and re-fetches everything.  Re-fetching makes
the insert-only fact keep run-1 rows (first write wins) while the SCD2
dimension versions employers whose latest posting changed their attributes.

Everything built here is committed once per (session, input folder) under a
fresh folder in the shared scratch root; later queries of the same session
read the committed tables instead of rebuilding them.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiremart import schemas, storage
from hiremart.functions.columns import parse_iso_timestamp
from hiremart.operators import mart_partials, marts, scd2
from hiremart.operators.flatten import flatten_employers, flatten_hierarchy, flatten_postings
from hiremart.operators.upsert import upsert
from hiremart.plans import warehouse
from hiremart.plans.copies import OdsCopies
from hiremart.session import prepare_warehouse, scratch_path
from hiremart.sources import driver

# Fixed parameters of the test fixture (never the wall clock).
RUN_1_AT = dt.datetime(1998, 8, 1, 0, 0, 0)
RUN_2_AT = dt.datetime(2001, 9, 1, 0, 0, 0)
FEED_AT = dt.datetime(2001, 9, 1, 0, 10, 0)      # the employer feed runs after the vacancy run
AS_OF_DATE = dt.date(2001, 9, 1)
EVENTS_SPLIT = dt.datetime(2024, 1, 15, 0, 0, 0)  # events upserted in two batches around it
RENEWED, RENEWED_EVERY, RAISED_EVERY = " (renewed)", 7, 3      # what the second run of the copies changes
# ODS hash buckets for the test tables (up to ~150 MB of documents at sf0.1:
# ~10 MB per bucket); a cluster sizes buckets at a few hundred MB each.
ODS_BUCKETS = 16


def fetched_at(items: DataFrame, at) -> DataFrame:
    """What a fetch at ``at`` returns: the documents published before it."""
    return items.filter(parse_iso_timestamp(F.col("item.published_at")) < F.lit(at).cast("timestamp"))


def runs(items: DataFrame):
    return [(fetched_at(items, RUN_1_AT), RUN_1_AT), (items, RUN_2_AT)]


# ----------------------------------------------------------- session cache ----
_CACHE: dict[tuple, object] = {}
_LOCK = threading.RLock()      # queries called from several threads build once


def _cached(spark: SparkSession, sf_dir: str, name: str, make):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _LOCK:
        if key not in _CACHE:
            _CACHE[key] = make()
        return _CACHE[key]


def _base(spark: SparkSession, sf_dir: str) -> str:
    return _cached(spark, sf_dir, "base", lambda: scratch_path(spark, "warehouse"))


# ------------------------------------------------------------------ builds ----
def landing_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fetched vacancy documents, written once to the build's landing folder."""
    return _cached(spark, sf_dir, "landing", lambda: storage.materialize(
        driver.posting_items(prepare_warehouse(spark), sf_dir), f"{_base(spark, sf_dir)}/landing/postings"))


def warehouse_states(spark: SparkSession, sf_dir: str) -> list[warehouse.Warehouse]:
    """The committed warehouse after run 1 and after run 2."""
    return _cached(spark, sf_dir, "states", lambda: warehouse.build_states(
        spark, runs(landing_items(spark, sf_dir)), base_path=f"{_base(spark, sf_dir)}/dds",
        ods_buckets=ODS_BUCKETS))


def layout_for(spark: SparkSession, sf_dir: str) -> warehouse.Layout:
    """The storage of the committed runs."""
    warehouse_states(spark, sf_dir)
    return warehouse.Layout(spark, f"{_base(spark, sf_dir)}/dds", ODS_BUCKETS)


def incremental_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five marts from the partials that the two runs updated."""
    L, wh = layout_for(spark, sf_dir), warehouse_for(spark, sf_dir)
    return mart_partials.all_marts(L.kept("mart_partials", L.end_of(1)), wh.dim_role, wh.dim_area, wh.dim_employer)


def warehouse_for(spark: SparkSession, sf_dir: str) -> warehouse.Warehouse:
    """The warehouse after both runs."""
    return warehouse_states(spark, sf_dir)[-1]


def star_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marts' shared input (M-d star join with the current employer version),
    committed once: every mart is then one pruned scan plus one aggregate."""
    def make():
        wh = warehouse_for(spark, sf_dir)
        return storage.materialize(
            marts.star(wh.fact_vacancy, wh.bridge_role, wh.dim_role, wh.dim_area, wh.dim_employer),
            f"{_base(spark, sf_dir)}/marts/star")
    return _cached(spark, sf_dir, "star", make)


def employer_feed(spark: SparkSession, sf_dir: str):
    """ODS employers (P2 + K4) and the dimension after the second SCD2 feed."""
    def make():
        wh = warehouse_for(spark, sf_dir)
        batch = flatten_employers(driver.employer_items(spark, sf_dir))
        ods = storage.materialize(
            upsert(schemas.empty(spark, schemas.ODS_EMPLOYERS), batch, ["id"], ["_page", "_pos"]),
            f"{_base(spark, sf_dir)}/employers/ods_employers")
        dim = storage.materialize(
            scd2.scd2_apply(wh.dim_employer, scd2.stage_employers_from_feed(ods), FEED_AT,
                            tracked=["employer_name", "alternate_url"]),
            f"{_base(spark, sf_dir)}/employers/dim_employer")
        return ods, dim
    return _cached(spark, sf_dir, "employers", make)


def dim_after_feed_same_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The employer dimension after the feed, which runs as step 1 of run 2 with its ``now``."""
    def make():
        ods, _ = employer_feed(spark, sf_dir)
        return storage.materialize(
            scd2.scd2_apply(warehouse_for(spark, sf_dir).dim_employer, scd2.stage_employers_from_feed(ods),
                            RUN_2_AT, tracked=["employer_name", "alternate_url"], step=1),
            f"{_base(spark, sf_dir)}/employers/dim_employer_same_run")
    return _cached(spark, sf_dir, "feed_same_run", make)


def renewed(items: DataFrame) -> DataFrame:
    """The documents of a later fetch: every seventh has a new name."""
    item = F.col("item")
    return items.withColumn("item", item.withField("name", F.when(
        F.pmod(item["id"].cast("bigint"), F.lit(RENEWED_EVERY)) == 0,
        F.concat(item["name"], F.lit(RENEWED))).otherwise(item["name"])))


def copies_for(spark: SparkSession, sf_dir: str) -> OdsCopies:
    """The copies of the ODS after two runs; the second renews postings, raises the counts of some
    employers and renames the dictionary entries without spheres."""
    def make():
        base = f"{_base(spark, sf_dir)}/copies"
        copies = OdsCopies(spark, base, ODS_BUCKETS)
        item, entries = F.col("item"), driver.industry_items(spark, sf_dir)
        bare = entries.withColumn("item", item.withField("industries", F.lit(None).cast(
            entries.schema["item"].dataType["industries"].dataType)))
        again = bare.withColumn("item", item.withField("name", F.concat(item["name"], F.lit(RENEWED))))
        employers = driver.employer_items(spark, sf_dir)
        raised = employers.where(F.pmod(item["id"].cast("bigint"), F.lit(RAISED_EVERY)) == 0).withColumn(
            "item", item.withField("open_vacancies", item["open_vacancies"] + 100))
        (first, _), (whole, _) = runs(landing_items(spark, sf_dir))
        for run, (postings, feed, dictionary) in enumerate([
                (first, employers, entries.unionByName(bare)), (renewed(whole), raised, again)]):
            for kind, batch in (("postings", flatten_postings(postings)), ("employers", flatten_employers(feed)),
                                ("industries", flatten_hierarchy(dictionary))):
                copies.load(kind, batch, f"{base}/work/{run}")
        return copies
    return _cached(spark, sf_dir, "copies", make)


def ods_industries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ODS industries: the flattened dictionary upserted on its null-safe composite key."""
    def make():
        rows = flatten_hierarchy(driver.industry_items(spark, sf_dir)).withColumn("_seq", F.lit(0))
        ods = upsert(schemas.empty(spark, schemas.ODS_INDUSTRIES), rows,
                     ["industry_id", "sphere_id"], ["_seq", "sphere_name", "industry_name"],
                     null_safe=True)
        return storage.materialize(ods, f"{_base(spark, sf_dir)}/industries/ods")
    return _cached(spark, sf_dir, "industries", make)
