"""The warehouse state and one load cycle (ODS upsert → DDS), as lazy DataFrames.

A cycle mirrors one scheduled run: upsert the fetched postings into the ODS,
then load dimensions, the SCD2 employer dimension, the incremental fact and
the bridges.  ``cycle`` is the lazy form over the *whole* ODS, in the reference's task
order; ``load_run`` commits a run on a ``Layout`` and reaches the same tables from
the batch's change set alone (the form the scheduled job, the streaming job and
the registered queries use).
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiremart import schemas, storage
from hiremart.operators import changes, dims, facts, mart_partials, scd2
from hiremart.operators.flatten import flatten_postings, flatten_typed, last_write, typed_documents
from hiremart.operators.staging import stage_postings
from hiremart.operators.upsert import insert_ignore, pick_repeated, upsert
from hiremart.session import prepare_warehouse

ODS_POSTING_COLS = ["id", "name", "area_name", "employer_name", "published_at", "raw"]
#: columns of the parsed ODS (``stage_postings`` output)
STAGE_COLS = ["vacancy_id", "name", "published_at", "published_date", "area_id", "area_name",
              "employer_id", "employer_name", "alternate_url", "trusted", "salary_from",
              "salary_to", "salary_currency", "salary_gross", "professional_roles",
              "specializations"]


#: what a posting's facts and links are made of; ``named``: its employer has a name
LINK_COLS = ["vacancy_id", "name", "published_date", "area_id", "employer_id", "named", "salary_from", "salary_to",
             "salary_currency", "salary_gross", "role_ids", "sphere_ids"]
#: what is kept per posting between runs (``stage``): the dimension keys it gave, its fact's measures and
#: all ids ever linked to it
KEPT_COLS = ["vacancy_id", "published_date", "area_id", "employer_id", "named", "loaded", "role_ids", "sphere_ids"]


def _link_rows(parsed: DataFrame) -> DataFrame:
    """Parsed postings without names and urls: the part that is joined with what was kept."""
    return parsed.withColumns({"named": F.col("employer_name").isNotNull(),
                               "role_ids": changes.array_ids("professional_roles")}).select(*LINK_COLS)


def _sides(parsed: DataFrame, change: DataFrame) -> DataFrame:
    """The change set as the dimensions read it: every written row, and every replaced one by the
    keys it gave (names and order come from the written rows; roles linked by any earlier
    document count as given)."""
    types = {f.name: f.dataType for f in parsed.schema.fields}
    null = lambda c: F.lit(None).cast(types[c]).alias(c)
    role = types["professional_roles"].elementType
    old = changes.replaced(change).select(
        "vacancy_id", null("published_at"), "published_date", "area_id", null("area_name"), "employer_id",
        F.when(F.col("named"), F.lit("")).alias("employer_name"), null("alternate_url"), null("trusted"),
        F.transform("role_ids", lambda e: F.struct(e.alias("id"), F.lit(None).cast("string").alias("name")).cast(role))
        .alias("professional_roles"))
    new = parsed.select(*old.columns)
    row = lambda side: F.struct(*old.columns).alias(side)
    return (new.select("vacancy_id", row("new"))
            .unionByName(old.select("vacancy_id", row("old")), allowMissingColumns=True))


@dataclass(frozen=True)
class Warehouse:
    ods_postings: DataFrame
    dim_date: DataFrame
    dim_area: DataFrame
    dim_employer: DataFrame
    dim_role: DataFrame
    fact_vacancy: DataFrame
    bridge_role: DataFrame
    bridge_sphere: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def empty_warehouse(spark: SparkSession) -> Warehouse:
    e = lambda s: schemas.empty(spark, s)
    return Warehouse(
        ods_postings=e(schemas.ODS_POSTINGS), dim_date=e(schemas.DIM_DATE),
        dim_area=e(schemas.DIM_AREA), dim_employer=e(schemas.DIM_EMPLOYER),
        dim_role=e(schemas.DIM_ROLE), fact_vacancy=e(schemas.FACT_VACANCY),
        bridge_role=e(schemas.BRIDGE_ROLE), bridge_sphere=e(schemas.BRIDGE_SPHERE))


def ods_upsert_postings(ods: DataFrame, items: DataFrame) -> DataFrame:
    """K1: flatten fetched documents and upsert them into the ODS (last write wins)."""
    batch = flatten_postings(items)
    return upsert(ods.select(*ODS_POSTING_COLS), batch, ["id"], last_write(batch))


def dds_cycle(wh: Warehouse, now) -> Warehouse:
    """One ODS → DDS load over the whole ODS, as of ``now``."""
    stage = stage_postings(wh.ods_postings)
    dim_date = dims.dim_date(wh.dim_date, stage)
    dim_area = dims.dim_area(wh.dim_area, stage)
    dim_employer = scd2.scd2_apply(wh.dim_employer, scd2.stage_employers_from_postings(stage), now)
    fact = wh.fact_vacancy.unionByName(
        facts.fact_incremental(stage, dim_employer, wh.fact_vacancy, now))
    bridge_sphere = wh.bridge_sphere.unionByName(
        facts.bridge(wh.bridge_sphere, stage, "specializations", "sphere_id", now))
    dim_role = dims.dim_role(wh.dim_role, stage)
    bridge_role = wh.bridge_role.unionByName(
        facts.bridge(wh.bridge_role, stage, "professional_roles", "role_id", now))
    return replace(wh, dim_date=dim_date, dim_area=dim_area, dim_employer=dim_employer,
                   fact_vacancy=fact, bridge_sphere=bridge_sphere, dim_role=dim_role,
                   bridge_role=bridge_role)


def cycle(wh: Warehouse, items: DataFrame, now) -> Warehouse:
    """One scheduled run: ODS upsert of the fetched documents, then the DDS load."""
    return dds_cycle(replace(wh, ods_postings=ods_upsert_postings(wh.ods_postings, items)), now)


class Layout:
    """Where and how every warehouse table is stored under one root folder.

    Each table is written the cheapest way its semantics allow:

    * ``ods/*`` — ``KeyedTable``: an upsert rewrites only the hash buckets
      its batch touches;
    * ``dds/fact_vacancy``, ``dds/bridge_*``, ``dds/dim_date``,
      ``dds/fact_employer_snapshot`` — insert-only ``AppendTable``: a run
      writes just its delta into its own ``_run=<n>`` folder;
    * dimensions and the marts' shared star — ``VersionedTable`` with the
      version ``run * STEPS + step`` (step 1: vacancy load, step 2: employer
      feed), so a retried step replaces its own version and never the one it
      reads;
    * the SCD2 employer dimension is split: versions closed by a step are
      appended to ``dds/dim_employer_history`` (they never change again) and
      the current rows form a versioned ``dds/dim_employer_current``, so a
      step rewrites one row per employer, never the history.

    The state as of the end of any run stays readable (pruned reads), except
    for the ODS, which is kept current only.
    """

    STEPS = 4
    VACANCIES, EMPLOYERS = 1, 2

    def __init__(self, spark: SparkSession, root: str, ods_buckets: int = 64):
        r = root.rstrip("/")
        self.spark, self.root = prepare_warehouse(spark), r
        K, A, V = storage.KeyedTable, storage.AppendTable, storage.VersionedTable
        self.ods_postings = K(spark, f"{r}/ods/postings", ["id"], ods_buckets)
        self.ods_employers = K(spark, f"{r}/ods/employers", ["id"], ods_buckets)
        self.ods_industries = K(spark, f"{r}/ods/industries", ["industry_id", "sphere_id"],
                                ods_buckets, null_safe=True)
        # what is kept of every posting of the ODS, in step with it
        self.stage = K(spark, f"{r}/ods/postings_parsed", ["vacancy_id"], ods_buckets)
        self.appended = {
            "fact_vacancy": A(spark, f"{r}/dds/fact_vacancy", schemas.FACT_VACANCY),
            "bridge_role": A(spark, f"{r}/dds/bridge_role", schemas.BRIDGE_ROLE),
            "bridge_sphere": A(spark, f"{r}/dds/bridge_sphere", schemas.BRIDGE_SPHERE),
            "dim_date": A(spark, f"{r}/dds/dim_date", schemas.DIM_DATE),
            "fact_employer_snapshot": A(spark, f"{r}/dds/fact_employer_snapshot",
                                        schemas.FACT_EMPLOYER_SNAPSHOT, partition="snapshot_date"),
            # counted while loading: per run one row of counts, and its facts by day
            "load_metrics": A(spark, f"{r}/dq/load_metrics", schemas.LOAD_METRICS),
            "fact_days": A(spark, f"{r}/dq/fact_days", schemas.FACT_DAYS),
        }
        self.dim_schemas = {"dim_area": schemas.DIM_AREA, "dim_role": schemas.DIM_ROLE,
                            "dim_employer_current": schemas.DIM_EMPLOYER,
                            "dim_industry": schemas.DIM_INDUSTRY, "dim_sphere": schemas.DIM_SPHERE}
        # states kept between runs; ``dim_area`` and ``dim_role`` also hold the posting that named a key
        self.state_schemas = {"dim_area": schemas.AREA_STATE, "dim_role": schemas.ROLE_STATE,
                              "posting_employer": schemas.POSTING_EMPLOYER, "date_edge": schemas.DATE_EDGE,
                              "mart_partials": schemas.MART_PARTIALS}
        self.versioned = {name: V(spark, f"{r}/dds/{name}") for name in [
            *self.dim_schemas, *self.state_schemas, "pending_fact"]}
        # closed SCD2 versions, keyed by the version number of the step that closed them
        self.employer_history = A(spark, f"{r}/dds/dim_employer_history", schemas.DIM_EMPLOYER)

    def batch(self, run: int, parsed: bool = False) -> DataFrame:
        """The flattened documents that a run has loaded; with ``parsed`` beside them ``_doc``, their
        parsed document, where the batch holds typed ones."""
        batch = self.spark.read.parquet(f"{self.work(run)}/batch")
        return flatten_typed(batch, parsed) if "item" in batch.columns else batch

    def version(self, run: int, step: int) -> int:
        return run * self.STEPS + step

    def end_of(self, run: int) -> int:
        """The greatest version number a run can write."""
        return run * self.STEPS + self.STEPS - 1

    def dim(self, name: str, upto: int | None = None) -> DataFrame:
        """A dimension's greatest version ``<= upto`` (empty before the first)."""
        return self.versioned[name].read_or_empty(self.dim_schemas[name], upto)

    def kept(self, name: str, upto: int | None = None) -> DataFrame:
        """A kept state's greatest version ``<= upto`` (empty before the first)."""
        return self.versioned[name].read_or_empty(self.state_schemas[name], upto)

    def refuse_older(self, run: int) -> None:
        """Raises for a run older than what any table holds, before anything is written."""
        for t in self.appended.values():
            t.refuse_older(run)
        for t in self.versioned.values():
            last = t.current_version()
            if last > self.end_of(run):
                raise ValueError(f"{t.path}: run {run} is older than the committed version {last}")

    def fed_employers(self, prev: int) -> DataFrame:
        """Employers whose versions an employer feed closed after the last vacancy load up to ``prev``."""
        loads = [v for v in self.versioned["dim_employer_current"].versions()
                 if v <= prev and v % self.STEPS == self.VACANCIES]
        last = max(loads, default=-1)
        closed = self.employer_history._select(lambda v: last < v <= prev)
        return closed.select("employer_id").distinct()

    def commit_dim(self, name: str, df: DataFrame, run: int, step: int) -> DataFrame:
        v = self.versioned[name].refresh(df, self.version(run, step))
        return self.versioned[name].read(v)

    def dim_employer(self, upto: int | None = None) -> DataFrame:
        """The whole SCD2 dimension (closed history + current rows) as of a version."""
        return (self.employer_history.read(upto=upto)
                .unionByName(self.dim("dim_employer_current", upto)))

    def commit_scd2(self, rows: DataFrame, run: int, step: int) -> DataFrame:
        """Commit a ``scd2_step`` output: closed versions appended, current rows versioned."""
        v = self.version(run, step)
        rows = storage.materialize(rows, f"{self.work(run)}/scd2_step={step}")
        self.employer_history.append(rows.filter(~F.col("is_current")), v)
        self.versioned["dim_employer_current"].refresh(rows.filter(F.col("is_current")), v)
        return self.dim_employer(v)

    def commit_delta(self, name: str, delta: DataFrame, run: int, upto: int | None = None) -> DataFrame:
        t = self.appended[name]
        t.append(delta, run)
        return t.read(upto=run if upto is None else upto)

    def work(self, run: int) -> str:
        """Scratch folder of one run's intermediate tables."""
        return f"{self.root}/work/run={run}"

    def state(self, run: int) -> Warehouse:
        """The DDS as of the end of ``run`` (the ODS as it is now)."""
        return Warehouse(
            ods_postings=self.ods_postings.read(),
            dim_date=self.appended["dim_date"].read(upto=run),
            dim_area=self.dim("dim_area", self.end_of(run)),
            dim_employer=self.dim_employer(self.end_of(run)),
            dim_role=self.dim("dim_role", self.end_of(run)),
            fact_vacancy=self.appended["fact_vacancy"].read(upto=run),
            bridge_role=self.appended["bridge_role"].read(upto=run),
            bridge_sphere=self.appended["bridge_sphere"].read(upto=run))


def _same_documents(layout: Layout, items: DataFrame, run: int) -> DataFrame:
    """The run's flattened documents, written once; a repeated run must bring the documents it began with.

    Documents with their landed text are written flattened (the JSON is parsed once).  Those without
    are written as the typed columns they are, in a third of their text's bytes, beside what flattening
    parses of them; the text is made when it is read, and they need not be parsed from it.
    """
    path, spark, flat = f"{layout.work(run)}/batch", items.sparkSession, flatten_postings(items, rejects=True)
    digest = lambda df: tuple(df.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first())
    if storage.is_committed(spark, path):
        if digest(layout.batch(run).select(*flat.columns)) != digest(flat):
            raise ValueError(f"run {run} was begun with other documents; load these as a later run")
    else:
        storage.write_once(flat if "_raw" in items.columns else typed_documents(items), path)
    return layout.batch(run, parsed=True)


def _touched_rows(change: DataFrame) -> DataFrame:
    """The batch's postings with what earlier runs kept of them."""
    was = F.coalesce(changes.was(change, "role_ids"), F.array().cast("array<string>"))
    spheres = F.coalesce(changes.was(change, "sphere_ids"), F.array().cast("array<string>"))
    return change.select(
        *[F.col(f"new.{c}").alias(c) for c in LINK_COLS if c not in ("role_ids", "sphere_ids")],
        changes.was(change, "loaded").alias("loaded"),
        F.array_union(was, "new.role_ids").alias("role_ids"), F.array_union(spheres, "new.sphere_ids").alias("sphere_ids"),
        was.alias("_was_roles"), spheres.alias("_was_spheres"), F.lit(True).alias("_touched"))


def _posting_rows(layout: Layout, prev: int, change: DataFrame) -> DataFrame:
    """The postings a run may load as facts or link: the batch's, and the postings still waiting for
    their employer's first version (all ``OPENED``)."""
    touched, pending = _touched_rows(change), layout.versioned["pending_fact"]
    if pending._pick(prev) is None:
        return touched
    waiting = pending.read(prev).join(change.select("vacancy_id"), "vacancy_id", "left_anti")
    return touched.unionByName(waiting.select(
        *LINK_COLS, "loaded", F.col("role_ids").alias("_was_roles"), F.col("sphere_ids").alias("_was_spheres"),
        F.lit(False).alias("_touched")))


#: postings whose employer's version is looked up: those not yet facts that could be
OPENED = "loaded IS NULL AND employer_id IS NOT NULL AND published_date IS NOT NULL"


def _opened_rows(rows: DataFrame, dim_employer: DataFrame) -> DataFrame:
    """The ``OPENED`` of ``_posting_rows`` beside their employer's version."""
    lists = changes.id_lists(rows)
    return changes.with_lists(facts.with_version(
        changes.with_text(rows.where(OPENED).drop("loaded"), lists), dim_employer), lists)


def posting_rows(change: DataFrame, opened: DataFrame) -> DataFrame:
    """Every posting a run wrote, or had waiting, with what it is after the run: its fact's measures, its new
    links, whether it is a new fact or waits for its employer.

    ``opened`` are the run's written ``_opened_rows``; the others are read from the change set as they
    are, not written again.
    """
    rows = _touched_rows(change)
    loads = opened.withColumns({"loaded": F.lit(None).cast(rows.schema["loaded"].dataType), "_opened": F.lit(True)})
    stays = rows.where(f"NOT ({OPENED})").withColumns({
        "employer_sk": F.lit(None).cast("long"), "_versioned": F.lit(None).cast("boolean"), "_opened": F.lit(False)})
    is_fact = F.coalesce("_versioned", F.lit(False))
    return loads.unionByName(stays).select(
        *LINK_COLS, F.coalesce("loaded", F.when(is_fact, F.struct(*schemas.LOADED.fieldNames()))).alias("loaded"),
        F.array_except("role_ids", "_was_roles").alias("_new_roles"),
        F.array_except("sphere_ids", "_was_spheres").alias("_new_spheres"),
        F.col("loaded").isNotNull().alias("_was_loaded"), F.array_min("_was_roles").alias("_old_role"),
        "_touched", is_fact.alias("_fact"), (F.col("_opened") & ~is_fact).alias("_waits"))


def committed_posting_rows(layout: Layout, run: int) -> DataFrame:
    """``posting_rows`` of a run that was loaded."""
    return posting_rows(*[layout.spark.read.parquet(f"{layout.work(run)}/{t}") for t in ("changes", "opened")])


def load_run(layout: Layout, items: DataFrame, now, run: int) -> Warehouse:
    """One scheduled run's vacancy load on ``layout``, committed table by table.

    The fetched documents are written once, parsed once and upserted into the ODS (touched
    buckets only).  Their change set — each posting's links beside what was kept of the row it replaced — then
    drives everything: dimension keys whose latest posting changed, employers to
    version, new facts and links, moved mart groups.  The ODS is not scanned, except
    for single keys that lost their latest posting (``changes.winners``).  Tables equal
    those of ``cycle``, which reads the whole ODS.

    Every step reads the state of earlier runs and the run's own change set and writes
    its own run/version; the change set is written before anything it was compared with
    changes, so re-running a run after a failure anywhere is idempotent.
    """
    L, A, prev, step = layout, layout.appended, layout.end_of(run - 1), Layout.VACANCIES
    L.refuse_older(run)
    work, spark = L.work(run), items.sparkSession
    landed = _same_documents(L, items, run)
    batch = landed.where("id IS NOT NULL")
    latest = pick_repeated(batch, ["id"], last_write(batch), lambda df: storage.write_once(df, f"{work}/repeated")[0])
    ods = L.ods_postings.upsert(latest.select(*ODS_POSTING_COLS), [], ODS_POSTING_COLS, unique=True,
                                staged=f"{work}/ods_postings")

    # the latest document of each id, parsed; the change set: what links it, beside what was kept of the row it replaces
    parsed = stage_postings(latest).withColumn("sphere_ids", changes.array_ids("specializations")).drop("specializations")
    if latest is not batch or "_doc" not in batch.columns:      # else the batch holds them as they are
        parsed, _ = storage.write_once(parsed, f"{work}/parsed")
    held = L.stage.touched(parsed.select("vacancy_id"))
    replaced = (schemas.empty(spark, schemas.STAGE_KEPT) if held is None else held).select(*KEPT_COLS)
    change = changes.narrowed(changes.change_set(_link_rows(parsed), replaced))
    change, counted = storage.write_once(change, f"{work}/changes", {
        "ods_added": F.count_if(F.col("old").isNull()),
        "eligible_added": (F.count_if(F.col("new.employer_id").isNotNull())
                           - F.count_if(changes.was(change, "employer_id").isNotNull()))})
    sides = _sides(parsed, change)

    def rest() -> DataFrame:
        """The ODS without the postings of this batch, parsed."""
        return stage_postings(L.ods_postings.read()).join(parsed.select("vacancy_id"), "vacancy_id", "left_anti")

    def maintain(name, contribute, keys, order):
        state, fresh = changes.winners(L.kept(name, prev), sides, contribute, keys, order, rest,
                                       lambda df: storage.materialize(df, f"{work}/{name}-{next(numbers)}"))
        L.versioned[name].refresh(state, L.version(run, step))
        return L.kept(name, L.version(run, step)), fresh

    numbers = iter(range(1 << 30))
    newest = ["published_at", "vacancy_id"]
    # dimensions
    edges, _ = maintain("date_edge", dims.date_edges, ["edge"], ["rank", "vacancy_id"])
    dim_date = L.commit_delta("dim_date", insert_ignore(
        A["dim_date"].read_before(run), dims.date_rows(edges.where("live"), "published_date"), ["date_key"]), run)
    maintain("dim_area", dims.area_rows, ["area_id"], newest)
    maintain("dim_role", dims.role_rows, ["role_id"], [*newest, "role_name"])
    # employers: those the batch touched, and those an employer feed changed since the last load
    employers, fresh = maintain("posting_employer", scd2.employer_rows, ["employer_id"], newest)
    ids = fresh.select("employer_id").unionByName(L.fed_employers(prev)).distinct()
    staged = employers.where("live").join(ids, "employer_id", "left_semi")
    dim_employer = L.commit_scd2(scd2.scd2_step(L.dim("dim_employer_current", prev), staged, now), run, step)
    # facts: new postings and waiting ones whose employer has a version by now
    rows = _posting_rows(L, prev, change)
    opened = storage.materialize(_opened_rows(rows, dim_employer), f"{work}/opened")
    posting = posting_rows(change, opened)
    delta, seen = storage.observed(
        facts.as_facts(posting.where("_fact").withColumn("employer_sk", F.col("loaded.employer_sk")), now), [
            F.count(F.lit(1)).alias("fact_rows"),
            F.count_if(F.col("employer_sk").isNull() | F.col("published_date").isNull()).alias("null_keys")])
    fact = L.commit_delta("fact_vacancy", delta, run)
    facts_now = A["fact_vacancy"].added_by(run)
    counted |= seen()
    done = posting.where("_touched OR _fact")
    L.versioned["pending_fact"].refresh(posting.where("_waits").select(*LINK_COLS, "loaded"), L.version(run, step))
    bridge = lambda rows, ids, name: rows.select("vacancy_id", F.explode(ids).alias(name),
                                                 F.lit(now).cast("timestamp").alias("created_at"))
    bridge_sphere = L.commit_delta("bridge_sphere", bridge(done, "_new_spheres", "sphere_id"), run)
    # counted by the same write: facts that leave a mart group
    linked, moved = storage.observed(done.select("vacancy_id", "_new_roles", mart_partials.leaves().alias("_leaves")),
                                     [F.count_if("_leaves").alias("left")])
    bridge_role = L.commit_delta("bridge_role", bridge(linked, "_new_roles", "role_id"), run)
    dim_area, dim_role = (L.dim(n, L.version(run, step)) for n in ("dim_area", "dim_role"))
    # the marts' partials: this run's facts, and facts whose primary role changed
    partials = mart_partials.merge(L.kept("mart_partials", prev), mart_partials.movements(done))
    if moved()["left"]:       # a fact left a group: extremes may have left with it
        merged = storage.materialize(partials, f"{work}/mart_partials")
        partials, reopened = merged.where("NOT _open").drop("_open"), merged.where("_open")
        if not reopened.isEmpty():
            partials = partials.unionByName(mart_partials.reopened(reopened, fact, bridge_role, dim_role))
    L.versioned["mart_partials"].refresh(partials.select(*schemas.MART_PARTIALS.fieldNames()), L.version(run, step))
    # what the writes counted
    fetched = landed.agg(F.count(F.lit(1)).alias("fetched"), F.count_if(F.col("id").isNull()).alias("rejected"))
    A["load_metrics"].append(fetched.select("*", *[F.lit(int(v)).cast("long").alias(k) for k, v in counted.items()]), run)
    A["fact_days"].append(facts_now.groupBy("published_date").agg(F.count(F.lit(1)).alias("fact_rows")), run)
    # last, so that a repeated run still finds the rows it was compared with
    L.stage.upsert(done, [], KEPT_COLS, unique=True, staged=f"{work}/postings_parsed")
    return Warehouse(ods_postings=ods, dim_date=dim_date, dim_area=dim_area,
                     dim_employer=dim_employer, dim_role=dim_role, fact_vacancy=fact,
                     bridge_role=bridge_role, bridge_sphere=bridge_sphere)


def build_states(spark: SparkSession, runs, base_path: str | None = None,
                 ods_buckets: int = 64) -> list[Warehouse]:
    """Fold ``runs`` — ``[(fetched_items, now), …]`` — over an empty warehouse,
    returning the state after every run.

    With ``base_path`` every run is committed on a ``Layout`` rooted there (the
    way the scheduled job stores its tables); without it the states are lazy
    plans (fine for one run, exponential in plan size for many).
    """
    if base_path is None:
        wh, states = empty_warehouse(spark), []
        for items, now in runs:
            wh = cycle(wh, items, now)
            states.append(wh)
        return states
    layout = Layout(spark, base_path, ods_buckets)
    for i, (items, now) in enumerate(runs):
        load_run(layout, items, now, i)
    return [layout.state(i) for i in range(len(runs))]


def build(spark: SparkSession, runs, base_path: str | None = None) -> Warehouse:
    """The state after the last of ``runs`` (see ``build_states``)."""
    states = build_states(spark, runs, base_path)
    return states[-1] if states else empty_warehouse(spark)
