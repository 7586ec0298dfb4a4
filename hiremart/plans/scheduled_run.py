"""The whole scheduled job in the reference's order, on the warehouse ``Layout``.

industries ODS → vacancies ODS and DDS → employers ODS → industries DDS →
employers DDS (second SCD2 feed, daily snapshot) → marts (atomic full
refresh) → data-quality checks.  ``run_scheduled`` takes the fetched
documents of one run as DataFrames (read them with
``hiremart.sources.landing``); the previous state is whatever the layout
holds; ``now`` and ``as_of`` are parameters.  Storage per table is described
in ``hiremart.plans.warehouse.Layout``: keyed ODS tables updated bucket by
bucket, insert-only tables receiving only the run's delta, versioned
dimensions and marts.  The marts are aggregates of partials that a run updates from
its own changes, and the quality checks read what the writes counted.  A run older
than any table is refused before anything is written; re-running a run is idempotent.

With ``details`` the fetched search rows are replaced by their detail records (S4) and,
if not one was found, loaded as they are (S5), in the job itself.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiremart import schemas, storage
from hiremart.operators import dims, facts, mart_partials, quality, scd2
from hiremart.operators.flatten import flatten_employers, flatten_hierarchy, last_write
from hiremart.plans.copies import OdsCopies
from hiremart.plans.warehouse import Layout, Warehouse, load_run
from hiremart.sources.landing import enriched_postings


@dataclass
class State:
    wh: Warehouse
    other: dict[str, DataFrame]
    marts: dict[str, DataFrame] = field(default_factory=dict)
    checks: DataFrame | None = None


def run_scheduled(spark: SparkSession, postings: DataFrame, employers: DataFrame,
                  industries: DataFrame, warehouse_path: str, run_id: int, now, as_of,
                  top_k: int = 20, ods_buckets: int = 64, details: DataFrame | None = None,
                  max_items: int | None = None, copies: bool = True) -> State:
    """One scheduled run over the fetched ``(_page, _pos, item)`` documents.

    ``ods_buckets`` is fixed for the lifetime of a warehouse (keys are placed
    by it); size it so one bucket of the ODS is a few hundred MB — e.g.
    ~4,000 for a 1 TB ODS, ~400,000 for 100 TB.  ``max_items`` cuts the search rows that
    ``details`` replace (default: all).  ``copies`` also keeps the naive and document forms
    of the three ODS tables (``OdsCopies``), from the batches as flattened for the typed ones.
    """
    L = Layout(spark, warehouse_path, ods_buckets)
    prev = L.end_of(run_id - 1)
    L.refuse_older(run_id)
    work = L.work(run_id)
    if details is not None:
        postings = enriched_postings(postings, details, max_items)

    # ---- ODS: industries (null-safe composite key)
    ind_batch, _ = storage.write_once(flatten_hierarchy(industries), f"{work}/industries")
    ods_ind = L.ods_industries.upsert(
        ind_batch, ["sphere_name", "industry_name", "raw"], list(schemas.ODS_INDUSTRIES.fieldNames()),
        staged=f"{work}/ods_industries")

    # ---- vacancies: ODS upsert + DDS load (dimensions, SCD2, fact, bridges)
    wh = load_run(L, postings, now, run_id)

    # ---- ODS: employers (documents without an id cannot be keyed; without a name cannot be versioned)
    emp_batch, emp_counts = storage.write_once(flatten_employers(employers, rejects=True), f"{work}/employers", {
        "fetched": F.count(F.lit(1)), "rejected": F.count_if(F.col("id").isNull()),
        "nameless": F.count_if(F.col("id").isNotNull() & F.col("name").isNull())})
    emp_batch = emp_batch.where("id IS NOT NULL")
    ods_emp = L.ods_employers.upsert(emp_batch, last_write(emp_batch), list(schemas.ODS_EMPLOYERS.fieldNames()),
                                     staged=f"{work}/ods_employers")

    # ---- the other stores' forms of the same three batches
    kept = {}
    if copies:
        stores = OdsCopies(spark, warehouse_path, ods_buckets)
        for kind, batch in (("postings", L.batch(run_id)), ("employers", emp_batch), ("industries", ind_batch)):
            kept[f"{kind}_naive"], kept[f"{kind}_documents"] = stores.load(kind, batch, work)

    # ---- DDS: industries
    dim_ind = L.commit_dim("dim_industry", dims.dim_industry(L.dim("dim_industry", prev), ods_ind),
                           run_id, Layout.EMPLOYERS)
    dim_sph = L.commit_dim("dim_sphere", dims.dim_sphere(L.dim("dim_sphere", prev), ods_ind),
                           run_id, Layout.EMPLOYERS)

    # ---- DDS: employers — second SCD2 feed, then the as-of day's snapshot
    dim_emp = L.commit_scd2(scd2.scd2_step(
        L.dim("dim_employer_current", L.version(run_id, Layout.VACANCIES)),
        scd2.stage_employers_from_feed(ods_emp), now,
        tracked=["employer_name", "alternate_url"], step=1), run_id, Layout.EMPLOYERS)
    snap_t = L.appended["fact_employer_snapshot"]
    snap = L.commit_delta("fact_employer_snapshot", facts.fact_snapshot(
        ods_emp, dim_emp, snap_t.read_before(run_id), as_of, now), run_id)
    wh = Warehouse(**{**wh.tables(), "dim_employer": dim_emp})

    # ---- marts: five atomic refreshes from the partials the load updated
    step = L.version(run_id, Layout.EMPLOYERS)
    built = mart_partials.all_marts(L.kept("mart_partials", L.end_of(run_id)), wh.dim_role, wh.dim_area, dim_emp, top_k)
    out_marts = {}
    for name, df in built.items():
        table = storage.VersionedTable(spark, f"{warehouse_path}/marts/{name}")
        table.refresh(storage.enforced(df, *schemas.MARTS[name]), step)
        out_marts[name] = table.read(step)

    # ---- data quality: what the writes counted, and this run's rows against their parents
    checks = quality.checks_of_loads(L.appended["load_metrics"].read(upto=run_id),
                                     L.appended["fact_days"].read(upto=run_id), as_of=as_of)
    fact_new = L.appended["fact_vacancy"].added_by(run_id)
    keys = quality.dq_foreign_keys([
        ("fact_vacancy.employer_sk", fact_new, "employer_sk", dim_emp, "employer_sk"),
        ("fact_vacancy.area_id", fact_new, "area_id", wh.dim_area, "area_id"),
        ("fact_vacancy.published_date", fact_new, "published_date", wh.dim_date, "date_key"),
        ("bridge_role.role_id", L.appended["bridge_role"].added_by(run_id), "role_id", wh.dim_role, "role_id"),
        ("dim_sphere.industry_id", dim_sph, "industry_id", dim_ind, "industry_id"),
        ("fact_employer_snapshot.employer_sk", snap_t.added_by(run_id), "employer_sk", dim_emp, "employer_sk"),
    ]).unionByName(quality.dq_unique(dim_emp, "employer_sk").withColumn("relation", F.lit("dim_employer.employer_sk")))
    checks = checks.unionByName(keys.select(
        F.col("relation").alias("check"), "status", F.to_json(F.struct("orphans")).alias("metrics"))).unionByName(
        spark.createDataFrame([("rejected_employers", "PASS", json.dumps(emp_counts))], checks.schema))
    checks = storage.materialize(checks, f"{work}/dq_checks")
    other = {"ods_employers": ods_emp, "ods_industries": ods_ind, "dim_industry": dim_ind,
             "dim_sphere": dim_sph, "fact_employer_snapshot": snap, **kept}
    return State(wh, other, out_marts, checks)
