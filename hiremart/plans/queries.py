"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver's tables (through ``hiremart.sources.driver``) or
tables the library itself derived and committed from them, and runs the
library's own operators over the whole input.  Timestamps are returned as
TIMESTAMP_NTZ (UTC wall clock) so results do not depend on a client's zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiremart import schemas, storage
from hiremart.functions.columns import currency_label, naive_timestamp, round_half_up, salary_point
from hiremart.operators import bi, dims, facts, flatten, marts, quality, scd2, stats
from hiremart.operators import upsert as up
from hiremart.operators.staging import EMPLOYER_COLS, stage_postings
from hiremart.plans import fixture_runs as FR
from hiremart.plans import warehouse
from hiremart.session import scratch_path
from hiremart.sources import driver, landing

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _ntz(c):
    return F.col(c).cast("timestamp_ntz") if isinstance(c, str) else c.cast("timestamp_ntz")


def _rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Floating means as shown: their last bits depend on the order of summation."""
    return df.withColumns({c: round_half_up(c, digits) for c in cols})


def _wh(spark, sf_dir):
    return FR.warehouse_for(spark, sf_dir)


def _star(spark, sf_dir):
    """The committed star (the marts' shared input)."""
    return FR.star_for(spark, sf_dir)


# ------------------------------------------------------------------ sources --
@register("src_paged_items")
def q_src_paged_items(spark, sf_dir):
    """Land the search pages as JSON files, read them back, flatten items in order."""
    path = scratch_path(spark, "landing-pages")
    pages = driver.posting_pages(spark, sf_dir, FR.landing_items(spark, sf_dir))
    landing.write_pages(pages, path)
    items = landing.read_paged_items(spark, path, schemas.POSTING_PAGE)
    return items.select(F.col("_page").alias("page"), F.col("_pos").alias("pos"),
                        F.col("item.id").cast("bigint").alias("vacancy_id"),
                        F.col("item.name").alias("name"))


@register("src_employer_pages")
def q_src_employer_pages(spark, sf_dir):
    """Land the employer list pages as JSON files, read them back in order."""
    path = scratch_path(spark, "landing-employers")
    landing.write_pages(driver.pages_of(driver.employer_items(spark, sf_dir)), path)
    items = landing.read_paged_items(spark, path, schemas.EMPLOYER_PAGE)
    return items.select(F.col("_page").alias("page"), F.col("_pos").alias("pos"),
                        F.col("item.id").cast("bigint").alias("employer_id"),
                        F.col("item.name").alias("name"))


@register("src_dictionary")
def q_src_dictionary(spark, sf_dir):
    """S3: land the industry dictionary as JSON array files, read them back and flatten them."""
    path = scratch_path(spark, "landing-dictionary")
    landing.write_dictionary(driver.industry_items(spark, sf_dir), path, files=8)
    items = landing.read_dictionary(spark, path, schemas.INDUSTRY_DOC)
    return flatten.flatten_hierarchy(items).drop("raw")


def _enriched(spark, sf_dir):
    items = FR.landing_items(spark, sf_dir)
    return landing.enrich_details(landing.search_view(items), items), items


@register("enrich_details")
def q_enrich_details(spark, sf_dir):
    """Every search row replaced by its detail record."""
    e, _ = _enriched(spark, sf_dir)
    return e.select(F.col("item.id").cast("bigint").alias("vacancy_id"),
                    F.coalesce(F.size("item.professional_roles"), F.lit(-1)).cast("int").alias("n_roles"),
                    F.coalesce(F.size("item.specializations"), F.lit(-1)).cast("int").alias("n_specs"))


@register("enrich_fallback")
def q_enrich_fallback(spark, sf_dir):
    """Enriched set if non-empty, else the search set."""
    e, items = _enriched(spark, sf_dir)
    out = landing.enrich_fallback(e, landing.search_view(items))
    return out.select(F.col("item.id").cast("bigint").alias("vacancy_id"),
                      F.col("item.name").alias("name"))


@register("enrich_fallback_taken")
def q_enrich_fallback_taken(spark, sf_dir):
    """S5 taken: no detail record belongs to a search row, so all search rows are loaded as
    they are; returns the facts of that load (no roles, hence no role links)."""
    items = FR.landing_items(spark, sf_dir)
    strangers = items.withColumn("item", F.col("item").withField("id", F.concat(F.lit("-"), F.col("item.id"))))
    layout = warehouse.Layout(spark, scratch_path(spark, "fallback"), FR.ODS_BUCKETS)
    wh = warehouse.load_run(layout, landing.enriched_postings(landing.search_view(items), strangers), FR.RUN_2_AT, 0)
    links = wh.bridge_role.groupBy("vacancy_id").agg(F.count(F.lit(1)).alias("n"))
    return wh.fact_vacancy.join(links, "vacancy_id", "left").select(
        "vacancy_id", "name", "published_date", F.coalesce("n", F.lit(0)).cast("long").alias("n_roles"))


@register("load_with_details")
def q_load_with_details(spark, sf_dir):
    """S4 in the load: search rows replaced by their detail records, then loaded; the role links
    that only the details give."""
    items = FR.landing_items(spark, sf_dir)
    layout = warehouse.Layout(spark, scratch_path(spark, "details"), FR.ODS_BUCKETS)
    wh = warehouse.load_run(layout, landing.enriched_postings(landing.search_view(items), items), FR.RUN_2_AT, 0)
    return wh.bridge_role.select("vacancy_id", "role_id")


@register("raw_lossless")
def q_raw_lossless(spark, sf_dir):
    """Documents with members the reader does not declare, landed as page files,
    read and flattened; the members are read back from the ODS ``raw`` text."""
    path = scratch_path(spark, "landing-whole")
    items = FR.landing_items(spark, sf_dir)
    it = F.col("item")
    wider = items.withColumn("item", (
        it.withField("premium", it.getField("salary").getField("gross"))
        .withField("responses", F.coalesce(F.size(it.getField("professional_roles")), F.lit(0)))
        .withField("contacts", F.struct(F.struct(it.getField("name").alias("label")).alias("person")))))
    landing.write_pages(driver.pages_of(wider), path)
    batch = flatten.flatten_postings(landing.read_paged_items(spark, path, schemas.POSTING_PAGE))
    ods = up.upsert(schemas.empty(spark, schemas.ODS_POSTINGS), batch, ["id"], flatten.last_write(batch))
    member = lambda p: F.get_json_object("raw", p)
    return ods.select(F.col("id").alias("vacancy_id"), member("$.premium").alias("premium"),
                      member("$.responses").cast("int").alias("responses"),
                      member("$.contacts.person.label").alias("label"),
                      member("$.salary.from").cast("decimal(18,2)").alias("salary_from"))


# -------------------------------------------------------------------- sinks --
def _events(spark, sf_dir):
    ev = driver.events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type", "value")
    early = ev.filter(F.col("ts") < F.lit(FR.EVENTS_SPLIT).cast("timestamp_ntz"))
    late = ev.filter(F.col("ts") >= F.lit(FR.EVENTS_SPLIT).cast("timestamp_ntz"))
    empty = schemas.empty(spark, ev.schema)
    return ev, early, late, empty


@register("upsert_lww")
def q_upsert_lww(spark, sf_dir):
    """K1: events keyed by user upserted in two batches; the latest (ts, id) wins."""
    _, early, late, empty = _events(spark, sf_dir)
    t1 = up.upsert(empty, early, ["user_id"], ["ts", "event_id"])
    return up.upsert(t1, late, ["user_id"], ["ts", "event_id"])


@register("upsert_document")
def q_upsert_document(spark, sf_dir):
    """K3: whole-document replace by ``_id`` over JSON documents of the events."""
    ev = driver.events(spark, sf_dir)
    docs = ev.select(F.col("user_id").cast("string").alias("_id"),
                     flatten.to_raw(F.struct("event_id", "event_type", "value", "props")).alias("raw"),
                     F.struct("ts", "event_id").alias("_seq"))
    target = spark.createDataFrame([], "_id string, raw string")
    out = up.upsert_document(target, docs, "_id", ["_seq"])
    return out.select("_id",
                      F.get_json_object("raw", "$.event_id").cast("bigint").alias("event_id"),
                      F.get_json_object("raw", "$.event_type").alias("event_type"))


@register("upsert_composite_key")
def q_upsert_composite_key(spark, sf_dir):
    """K5: the flattened dictionary upserted on the null-safe key (industry, sphere)."""
    return FR.ods_industries(spark, sf_dir).select("industry_id", "industry_name",
                                                     "sphere_id", "sphere_name")


@register("composite_doc_key")
def q_composite_doc_key(spark, sf_dir):
    """K6: document id ``industry:sphere`` with the ids embedded in the document."""
    docs = up.composite_doc_key(FR.ods_industries(spark, sf_dir),
                                doc_schema=schemas.INDUSTRY_DOC)
    return docs.select("_id", "industry_id", "sphere_id",
                       F.get_json_object("raw", "$.name").alias("doc_name"),
                       F.get_json_object("raw", "$._id").alias("doc_id"))


@register("full_refresh")
def q_full_refresh(spark, sf_dir):
    """K7: the salary mart refreshed twice into a versioned table, then read."""
    path = scratch_path(spark, "mart-salary")
    m1 = marts.mart_salary(_star(spark, sf_dir))
    storage.full_refresh(m1, path)
    return storage.full_refresh(m1, path)


@register("insert_ignore")
def q_insert_ignore(spark, sf_dir):
    """K8: events keyed by user inserted in two batches; the first (ts, id) wins."""
    _, early, late, empty = _events(spark, sf_dir)
    t1 = empty.unionByName(up.insert_ignore(empty, early, ["user_id"], ["ts", "event_id"]))
    return t1.unionByName(up.insert_ignore(t1, late, ["user_id"], ["ts", "event_id"]))


@register("upsert_scd1")
def q_upsert_scd1(spark, sf_dir):
    """K9: the SCD1 area dimension after both load cycles."""
    return _wh(spark, sf_dir).dim_area


# ------------------------------------------------------------------ flatten --
@register("flatten_postings")
def q_flatten_postings(spark, sf_dir):
    """The ODS postings after both runs."""
    o = _wh(spark, sf_dir).ods_postings
    return o.select("id", "name", "area_name", "employer_name",
                    _ntz("published_at").alias("published_at"))


@register("flatten_employers")
def q_flatten_employers(spark, sf_dir):
    """The ODS employers."""
    ods, _ = FR.employer_feed(spark, sf_dir)
    return ods.select("id", "name", "area_name", "open_vacancies", "site_url")


@register("flatten_hierarchy")
def q_flatten_hierarchy(spark, sf_dir):
    """The two-level dictionary flattened to (industry, sphere) rows."""
    return flatten.flatten_hierarchy(driver.industry_items(spark, sf_dir)).drop("raw")


@register("upsert_naive")
def q_upsert_naive(spark, sf_dir):
    """K2: the vacancy ODS in the form of a store without time zones — documents
    flattened with naive wall-clock publication times and upserted by id."""
    items = FR.landing_items(spark, sf_dir)
    batch = flatten.flatten_postings(items, naive=True)
    target = schemas.empty(spark, batch.drop("_page", "_pos").schema)
    out = up.upsert(target, batch, ["id"], ["_page", "_pos"])
    return out.select("id", "name", "area_name", "employer_name", "published_at")


@register("copies_postings_naive")
def q_copies_postings_naive(spark, sf_dir):
    """K2 over two runs: the naive copy of the vacancy ODS, documents of run 1 replaced in run 2."""
    return FR.copies_for(spark, sf_dir).naive["postings"].read().drop("raw")


@register("copies_postings_documents")
def q_copies_postings_documents(spark, sf_dir):
    """K3 over two runs: whole vacancy documents by id, those of run 1 replaced in run 2."""
    docs = FR.copies_for(spark, sf_dir).documents["postings"].read()
    return docs.select("_id", F.get_json_object("raw", "$.name").alias("name"),
                       F.get_json_object("raw", "$.employer.id").cast("bigint").alias("employer_id"))


@register("copies_employers_naive")
def q_copies_employers_naive(spark, sf_dir):
    """K4 over two runs: the relational copy of the employer ODS, some with a new count."""
    return FR.copies_for(spark, sf_dir).naive["employers"].read().drop("raw")


@register("copies_employers_documents")
def q_copies_employers_documents(spark, sf_dir):
    """K4 over two runs: whole employer documents by id, some replaced."""
    docs = FR.copies_for(spark, sf_dir).documents["employers"].read()
    return docs.select("_id", F.get_json_object("raw", "$.open_vacancies").cast("int").alias("open_vacancies"))


@register("copies_industries_naive")
def q_copies_industries_naive(spark, sf_dir):
    """K5 over two runs: entries without a sphere (a NULL key part) are replaced, not added again."""
    return FR.copies_for(spark, sf_dir).naive["industries"].read().drop("raw")


@register("copies_industries_documents")
def q_copies_industries_documents(spark, sf_dir):
    """K6 over two runs: dictionary documents by ``industry:sphere``, those without a sphere replaced."""
    docs = FR.copies_for(spark, sf_dir).documents["industries"].read()
    return docs.select("_id", "industry_id", "sphere_id", F.get_json_object("raw", "$._id").alias("doc_id"),
                       F.get_json_object("raw", "$.name").alias("doc_name"))


@register("src_pages_by_file_time")
def q_src_pages_by_file_time(spark, sf_dir):
    """Two fetches landed one after the other, neither numbered, read in one go and upserted:
    the file that landed later wins."""
    path = scratch_path(spark, "landing-by-time")
    items = FR.landing_items(spark, sf_dir)
    landing.write_pages(driver.pages_of(items), f"{path}/b")
    landing.write_pages(driver.pages_of(FR.renewed(items)), f"{path}/a")
    batch = flatten.flatten_postings(landing.read_paged_items(spark, f"{path}/*", schemas.POSTING_PAGE, by_file_time=True))
    ods = up.upsert(schemas.empty(spark, schemas.ODS_POSTINGS), batch, ["id"], flatten.last_write(batch))
    return ods.select("id", "name")


@register("naive_timestamp")
def q_naive_timestamp(spark, sf_dir):
    """Publication text → wall-clock timestamp with the offset dropped."""
    items = FR.landing_items(spark, sf_dir)
    return items.select(F.col("item.id").cast("bigint").alias("vacancy_id"),
                        naive_timestamp(F.col("item.published_at")).alias("published_naive"))


@register("json_roundtrip")
def q_json_roundtrip(spark, sf_dir):
    """P5: ODS ``raw`` parsed back with the declared schema."""
    st = stage_postings(_wh(spark, sf_dir).ods_postings)
    return st.select("vacancy_id", "employer_id", "area_id", "salary_from", "salary_to",
                     "salary_currency", "salary_gross", "trusted",
                     F.coalesce(F.size("professional_roles"), F.lit(-1)).cast("int").alias("n_roles"),
                     F.coalesce(F.size("specializations"), F.lit(-1)).cast("int").alias("n_specs"))


# ---------------------------------------------------------------------- DDS --
DIM_EMP_OUT = ["employer_id", "employer_name", "alternate_url", "trusted"]


def _dim_out(dim):
    return dim.select(*DIM_EMP_OUT, _ntz("valid_from").alias("valid_from"),
                      _ntz("valid_to").alias("valid_to"), "is_current")


@register("dim_date")
def q_dim_date(spark, sf_dir):
    """The date dimension after both runs."""
    return _wh(spark, sf_dir).dim_date


@register("dim_area")
def q_dim_area(spark, sf_dir):
    """The area dimension."""
    return _wh(spark, sf_dir).dim_area


def _run1_dim_and_stage2(spark, sf_dir):
    run1, run2 = FR.warehouse_states(spark, sf_dir)
    staged2 = scd2.stage_employers_from_postings(stage_postings(run2.ods_postings, EMPLOYER_COLS))
    return run1.dim_employer, staged2


@register("stage_employers")
def q_stage_employers(spark, sf_dir):
    """One staged employer per id from the whole ODS (latest posting wins)."""
    st = stage_postings(_wh(spark, sf_dir).ods_postings, EMPLOYER_COLS)
    return scd2.stage_employers_from_postings(st)


@register("scd2_expire")
def q_scd2_expire(spark, sf_dir):
    """Run-1 dimension with run-2 staging: changed current rows closed."""
    dim1, staged2 = _run1_dim_and_stage2(spark, sf_dir)
    return _dim_out(scd2.scd2_expire(dim1, staged2, FR.RUN_2_AT))


@register("scd2_insert")
def q_scd2_insert(spark, sf_dir):
    """Run-1 dimension with run-2 staging: keys without a current row opened."""
    dim1, staged2 = _run1_dim_and_stage2(spark, sf_dir)
    return _dim_out(scd2.scd2_insert(dim1, staged2, FR.RUN_2_AT))


@register("scd2_full")
def q_scd2_full(spark, sf_dir):
    """D3: the SCD2 employer dimension after both runs."""
    return _dim_out(_wh(spark, sf_dir).dim_employer)


@register("scd2_tracked_subset")
def q_scd2_tracked_subset(spark, sf_dir):
    """The dimension after the employer feed (tracks name and url only)."""
    _, dim = FR.employer_feed(spark, sf_dir)
    return _dim_out(dim)


@register("scd2_feed_same_run")
def q_scd2_feed_same_run(spark, sf_dir):
    """D8 with the vacancy step's own ``now``, as a scheduled run gives it: versions and,
    per version, how many rows carry its surrogate key (always one)."""
    dim = FR.dim_after_feed_same_run(spark, sf_dir)
    copies = dim.groupBy("employer_sk").agg(F.count(F.lit(1)).cast("long").alias("rows_of_key"))
    return dim.join(copies, "employer_sk").select(
        *DIM_EMP_OUT, _ntz("valid_from").alias("valid_from"), _ntz("valid_to").alias("valid_to"),
        "is_current", "rows_of_key")


@register("fact_incremental")
def q_fact_incremental(spark, sf_dir):
    """The vacancy fact after both runs (run-1 rows kept: first write wins)."""
    wh = _wh(spark, sf_dir)
    emp = wh.dim_employer.select("employer_sk", "employer_id", "valid_from")
    return (wh.fact_vacancy.join(emp, "employer_sk", "left")
            .select("vacancy_id", "name", "employer_id", _ntz("valid_from").alias("employer_version"),
                    "area_id", "published_date", "salary_from", "salary_to", "salary_currency",
                    "salary_gross", _ntz("created_at").alias("created_at")))


@register("bridge_explode")
def q_bridge_explode(spark, sf_dir):
    """Vacancy → sphere bridge."""
    return _wh(spark, sf_dir).bridge_sphere.select("vacancy_id", "sphere_id")


@register("dim_role")
def q_dim_role(spark, sf_dir):
    """Professional-role dimension."""
    return _wh(spark, sf_dir).dim_role


@register("bridge_role")
def q_bridge_role(spark, sf_dir):
    """Vacancy → role bridge."""
    return _wh(spark, sf_dir).bridge_role.select("vacancy_id", "role_id")


@register("fact_snapshot")
def q_fact_snapshot(spark, sf_dir):
    """Employer snapshot for the as-of day, loaded twice (second run adds nothing)."""
    ods, dim = FR.employer_feed(spark, sf_dir)
    empty = schemas.empty(spark, schemas.FACT_EMPLOYER_SNAPSHOT)
    first = facts.fact_snapshot(ods, dim, empty, FR.AS_OF_DATE, FR.FEED_AT)
    snap = storage.materialize(first, scratch_path(spark, "snapshot"))
    again = facts.fact_snapshot(ods, dim, snap, FR.AS_OF_DATE, FR.FEED_AT)
    return snap.unionByName(again).select("employer_id", "snapshot_date", "area_name",
                                          "open_vacancies", "site_url")


@register("dim_industry")
def q_dim_industry(spark, sf_dir):
    """Industry dimension from the dictionary."""
    return dims.dim_industry(schemas.empty(spark, schemas.DIM_INDUSTRY), FR.ods_industries(spark, sf_dir))


@register("dim_sphere")
def q_dim_sphere(spark, sf_dir):
    """Sphere dimension from the dictionary."""
    return dims.dim_sphere(schemas.empty(spark, schemas.DIM_SPHERE), FR.ods_industries(spark, sf_dir))


# ---------------------------------------------------------------------- DQ --
@register("dq_row_counts")
def q_dq_row_counts(spark, sf_dir):
    """Q-1: ODS total / eligible rows vs fact rows after both runs."""
    wh = _wh(spark, sf_dir)
    return quality.dq_row_counts(wh.ods_postings, wh.fact_vacancy)


@register("dq_null_keys")
def q_dq_null_keys(spark, sf_dir):
    """Q-2: fact rows with a NULL employer key or publication date."""
    return quality.dq_null_keys(_wh(spark, sf_dir).fact_vacancy)


@register("dq_date_range")
def q_dq_date_range(spark, sf_dir):
    """Q-3: fact publication dates before 2000-01-01 or after the as-of day."""
    return quality.dq_date_range(_wh(spark, sf_dir).fact_vacancy, lo="2000-01-01",
                                 as_of=FR.AS_OF_DATE)


@register("dq_foreign_keys")
def q_dq_foreign_keys(spark, sf_dir):
    """Orphan counts of the DDS foreign keys (fact → employer version, area,
    date; bridge → role), each a left-anti join."""
    wh = _wh(spark, sf_dir)
    return quality.dq_foreign_keys([
        ("fact_vacancy.employer_sk", wh.fact_vacancy, "employer_sk", wh.dim_employer, "employer_sk"),
        ("fact_vacancy.area_id", wh.fact_vacancy, "area_id", wh.dim_area, "area_id"),
        ("fact_vacancy.published_date", wh.fact_vacancy, "published_date", wh.dim_date, "date_key"),
        ("bridge_role.role_id", wh.bridge_role, "role_id", wh.dim_role, "role_id"),
    ])


@register("dq_observed")
def q_dq_observed(spark, sf_dir):
    """Q-1..Q-3 and rejects from what the two runs' writes counted (no table is scanned again)."""
    L = FR.layout_for(spark, sf_dir)
    return quality.checks_of_loads(L.appended["load_metrics"].read(), L.appended["fact_days"].read(),
                                   as_of=FR.AS_OF_DATE)


@register("batch_changes")
def q_batch_changes(spark, sf_dir):
    """Run 2's change set: every posting it wrote, whether the ODS had it, whether the run made it a
    fact, and how many role links were new."""
    L = FR.layout_for(spark, sf_dir)
    rows = warehouse.committed_posting_rows(L, 1).where("_touched").select(
        "vacancy_id", (F.col("loaded").isNotNull() & ~F.col("_was_loaded")).alias("new_fact"),
        F.size("_new_roles").cast("long").alias("new_roles"))
    had = spark.read.parquet(f"{L.work(1)}/changes").select("vacancy_id", F.col("old").isNotNull().alias("replaced"))
    return rows.join(had, "vacancy_id").select("vacancy_id", "replaced", "new_fact", "new_roles")


@register("mart_partials")
def q_mart_partials(spark, sf_dir):
    """The marts' partials after both runs, the employer version by its id and start."""
    L, wh = FR.layout_for(spark, sf_dir), _wh(spark, sf_dir)
    emp = wh.dim_employer.select("employer_sk", "employer_id", _ntz("valid_from").alias("employer_version"))
    return L.kept("mart_partials", L.end_of(1)).join(emp, "employer_sk").drop("employer_sk")


# -------------------------------------------------------------------- marts --
@register("primary_role")
def q_primary_role(spark, sf_dir):
    """M-a: primary (text-minimum) role per vacancy."""
    wh = _wh(spark, sf_dir)
    return marts.primary_role(wh.bridge_role, wh.dim_role)


@register("salary_point")
def q_salary_point(spark, sf_dir):
    """M-b: salary point of every fact row."""
    f = _wh(spark, sf_dir).fact_vacancy
    return f.select("vacancy_id", salary_point("salary_from", "salary_to").alias("salary_point"))


@register("currency_label")
def q_currency_label(spark, sf_dir):
    """M-c: currency label of every fact row."""
    f = _wh(spark, sf_dir).fact_vacancy
    return f.select("vacancy_id", currency_label("salary_currency").alias("currency"))


@register("star_join")
def q_star_join(spark, sf_dir):
    """M-d: the star join feeding every mart (computed here, not read back)."""
    wh = _wh(spark, sf_dir)
    return marts.star(wh.fact_vacancy, wh.bridge_role, wh.dim_role, wh.dim_area).drop("employer_sk")


@register("mart_salary")
def q_mart_salary(spark, sf_dir):
    """M1: salary by month × role × area × currency."""
    return marts.mart_salary(_star(spark, sf_dir))


@register("mart_regions")
def q_mart_regions(spark, sf_dir):
    """M2: regions by role with share of the role."""
    return marts.mart_regions(_star(spark, sf_dir))


@register("mart_trends")
def q_mart_trends(spark, sf_dir):
    """M3: monthly demand by role with change against the previous present month."""
    return marts.mart_trends(_star(spark, sf_dir))


@register("mart_top_employers")
def q_mart_top_employers(spark, sf_dir):
    """M4: top-20 current employers per role × area × currency."""
    return marts.mart_top_employers(_star(spark, sf_dir), k=20)


@register("mart_top_employers_k3")
def q_mart_top_employers_k3(spark, sf_dir):
    """M4 with k = 3."""
    return marts.mart_top_employers(_star(spark, sf_dir), k=3)


@register("mart_top_employers_after_feed")
def q_mart_top_employers_after_feed(spark, sf_dir):
    """M4 after the employer feed of the same run: facts of a version it closed no longer count."""
    wh = _wh(spark, sf_dir)
    star = marts.star(wh.fact_vacancy, wh.bridge_role, wh.dim_role, wh.dim_area,
                      FR.dim_after_feed_same_run(spark, sf_dir))
    return marts.mart_top_employers(star, k=20)


@register("mart_currency")
def q_mart_currency(spark, sf_dir):
    """M5: currency structure by role × area."""
    return marts.mart_currency(_star(spark, sf_dir))


# ----------------------------------------------------------------------- BI --
@register("mart_salary_from_partials")
def q_mart_salary_from_partials(spark, sf_dir):
    """M1 from the partials the runs updated, written under its declared schema and key."""
    return storage.enforced(FR.incremental_marts(spark, sf_dir)["salary"], *schemas.MARTS["salary"])


@register("mart_regions_from_partials")
def q_mart_regions_from_partials(spark, sf_dir):
    """M2 from the partials the runs updated, under its declared schema and key."""
    return storage.enforced(FR.incremental_marts(spark, sf_dir)["regions"], *schemas.MARTS["regions"])


@register("mart_trends_from_partials")
def q_mart_trends_from_partials(spark, sf_dir):
    """M3 from the partials the runs updated, under its declared schema and key."""
    return storage.enforced(FR.incremental_marts(spark, sf_dir)["trends"], *schemas.MARTS["trends"])


@register("mart_top_employers_from_partials")
def q_mart_top_employers_from_partials(spark, sf_dir):
    """M4 from the partials the runs updated, under its declared schema and key."""
    return storage.enforced(FR.incremental_marts(spark, sf_dir)["top_employers"], *schemas.MARTS["top_employers"])


@register("mart_currency_from_partials")
def q_mart_currency_from_partials(spark, sf_dir):
    """M5 from the partials the runs updated, under its declared schema and key."""
    return storage.enforced(FR.incremental_marts(spark, sf_dir)["currency"], *schemas.MARTS["currency"])


@register("bi_avg_salary")
def q_bi_avg_salary(spark, sf_dir):
    """Mean of the salary mart's means by role × currency ."""
    return bi.bi_avg_salary(q_mart_salary(spark, sf_dir))


@register("bi_currency_share")
def q_bi_currency_share(spark, sf_dir):
    """Vacancies by role × currency with each role's row contribution."""
    return bi.bi_currency_share(q_mart_currency(spark, sf_dir))


@register("bi_currency_pivot")
def q_bi_currency_pivot(spark, sf_dir):
    """C2 as a matrix: one row per role, one share column per currency."""
    return bi.bi_currency_pivot(q_mart_currency(spark, sf_dir))


@register("bi_heatmap")
def q_bi_heatmap(spark, sf_dir):
    """Vacancies by role × area from the regions mart."""
    return bi.bi_heatmap(q_mart_regions(spark, sf_dir))


@register("bi_trend_line")
def q_bi_trend_line(spark, sf_dir):
    """C4: monthly vacancies per role from the trends mart."""
    return bi.bi_trend_line(q_mart_trends(spark, sf_dir))


@register("bi_top_table")
def q_bi_top_table(spark, sf_dir):
    """The first 100 rows of the top-employers mart, largest counts first."""
    return bi.bi_top_table(q_mart_top_employers(spark, sf_dir))


# -------------------------------------------------------------- benchmark ----
@register("bench_counts")
def q_bench_counts(spark, sf_dir):
    """Row counts of the three ODS tables."""
    ods_emp, _ = FR.employer_feed(spark, sf_dir)
    return stats.row_counts({"vacancies": _wh(spark, sf_dir).ods_postings,
                             "employers": ods_emp,
                             "salary_industries": FR.ods_industries(spark, sf_dir)})


@register("bench_by_area")
def q_bench_by_area(spark, sf_dir):
    """Vacancies per area name (NULL is a group)."""
    return stats.count_by(_wh(spark, sf_dir).ods_postings, "area_name")


@register("bench_by_nested_path")
def q_bench_by_nested_path(spark, sf_dir):
    """Vacancies per employer name read from the raw document."""
    return stats.count_by_path(_wh(spark, sf_dir).ods_postings, "$.employer.name", "employer_name")


@register("bench_by_json_key")
def q_bench_by_json_key(spark, sf_dir):
    """B5 on a second document column: events per value of ``props.k``."""
    return stats.count_by_path(driver.events(spark, sf_dir), "$.k", "k", raw_col="props")


@register("duration_stats")
def q_duration_stats(spark, sf_dir):
    """min/avg/max/population-std of event values (as seconds) per event type."""
    return _rounded(stats.duration_stats(driver.events(spark, sf_dir), ["event_type"], "value"), 6, "avg_ms", "std_ms")


@register("mean_of_means")
def q_mean_of_means(spark, sf_dir):
    """Per event type, the mean over users of each user's mean value."""
    per_user = stats.duration_stats(driver.events(spark, sf_dir), ["event_type", "user_id"], "value")
    return _rounded(stats.mean_of_means(per_user, "event_type", "avg_ms"), 6, "mean_of_means")


# --------------------------------------------------------------- streaming ----
@register("stream_cycles")
def q_stream_cycles(spark, sf_dir):
    """The two load runs replayed as a Structured Streaming job: each fetch is
    landed as page files, then the ``availableNow`` stream picks up what was
    newly landed as one micro-batch and ``foreachBatch`` commits it as a load
    run; returns the fact."""
    from hiremart.streaming import microbatch

    root = scratch_path(spark, "stream")
    items = FR.landing_items(spark, sf_dir)
    runs = FR.runs(items)
    clock = dict(enumerate(at for _, at in runs))
    last = -1
    for fetched, _ in runs:
        landing.write_pages(driver.pages_of(fetched), f"{root}/landing", mode="append")
        last = microbatch.run_available(spark, f"{root}/landing", f"{root}/warehouse",
                                        f"{root}/checkpoint", clock=clock.__getitem__)
    wh = microbatch.read_committed(spark, f"{root}/warehouse", last)
    emp = wh.dim_employer.select("employer_sk", "employer_id", "valid_from")
    return (wh.fact_vacancy.join(emp, "employer_sk", "left")
            .select("vacancy_id", "name", "employer_id", _ntz("valid_from").alias("employer_version"),
                    "area_id", "published_date", "salary_from", "salary_to", "salary_currency",
                    "salary_gross", _ntz("created_at").alias("created_at")))


@register("stream_one_trigger")
def q_stream_one_trigger(spark, sf_dir):
    """Two fetches landed before one trigger: the later fetch wins although its pages come
    first.  The earlier one names every posting ``draft``, the later one (of the postings
    before run 1) has the names as they are; returns the ODS."""
    from hiremart.streaming import microbatch

    root = scratch_path(spark, "stream-once")
    items = FR.landing_items(spark, sf_dir)
    drafts = items.withColumn("item", F.col("item").withField("name", F.lit("draft"))).withColumn(
        "_page", F.col("_page") + F.lit(1_000_000))
    for fetch, fetched in ((1, drafts), (2, FR.fetched_at(items, FR.RUN_1_AT))):
        landing.write_pages(driver.pages_of(fetched).withColumn("fetch", F.lit(fetch).cast("long")),
                            f"{root}/landing", mode="append")
    last = microbatch.run_available(spark, f"{root}/landing", f"{root}/warehouse", f"{root}/checkpoint",
                                    clock=lambda _: FR.RUN_2_AT)
    ods = microbatch.read_committed(spark, f"{root}/warehouse", last).ods_postings
    return ods.select("id", "name", "employer_name")
