"""Table storage on a shared file system: plain Parquet folders written and
read with Spark's own writer/reader (partition folders, dynamic partition
overwrite, partition pruning) — no storage engine of our own.

* ``materialize`` writes a DataFrame as a Parquet table and returns a reader:
  it cuts lineage (a later failure re-reads files instead of recomputing the
  whole history) and is how one load step hands its output to the next.
* ``VersionedTable`` — one folder per version: the full-refresh sink (K7)
  with an atomic swap (readers see the greatest committed version, never an
  empty or partial table, unlike truncate-then-insert), and dimensions whose
  versions follow the load runs.
* ``AppendTable`` — one folder per load run: insert-only tables where a run
  writes only its delta.
* ``KeyedTable`` — hash-bucket folders: keyed upserts that rewrite only the
  buckets a batch touches.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from pyspark.errors import AnalysisException

from hiremart import schemas

#: Codec of every table written here: JSON documents take about half the room of Spark's default, and
#: a fifth less again at this level than at the codec's own.
CODEC = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}
#: A staged table is published by one task per this many bytes of it at least, and once every core has a
#: task per ``FILE_BYTES`` for each bucket: opening a file costs as much as compressing a megabyte.
STAGED_BYTES, FILE_BYTES = 8 << 20, 1 << 20
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_if_exists(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """Read a Parquet folder, or ``None`` if nothing was committed there yet.

    Only "no such path" / "no data files" count as absent; any other failure
    (permissions, a flaky store, corrupt footers) is raised, never mistaken for
    an empty table that a writer would then overwrite.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        df = reader.parquet(path)
        if schema is not None and not df.inputFiles():
            return None
        return df
    except AnalysisException as e:
        if (e.getCondition() or "") in _ABSENT:
            return None
        raise


def materialize(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> DataFrame:
    """Write ``df`` as Parquet at ``path`` and return a DataFrame reading it back."""
    w = df.write.mode(mode).options(**CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path) if not partition_by \
        else df.sparkSession.read.parquet(path)


class VersionedTable:
    """A Parquet table whose content is replaced atomically (K7 full refresh).

    Layout: ``<path>/version=<n>/part-*.parquet``, one folder per committed
    version.  A refresh writes the whole new content as a new version in one
    job; readers take the greatest version with a commit marker (or the greatest up
    to a given number) and read only its folder, so a running or failed write is
    never seen and old versions cost no I/O.  Writing an explicit version
    again replaces just that folder, which makes a retried load idempotent; a
    job never overwrites the version it reads.
    """

    COL = "version"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        """Committed versions: the direct children that hold a commit marker (no data job)."""
        return committed(self.spark, self.path, self.COL)

    def current_version(self) -> int:
        return max(self.versions(), default=0)

    def _pick(self, version: int | None) -> int | None:
        vs = self.versions()
        if version is None:
            return max(vs, default=None)
        return max((v for v in vs if v <= version), default=None)

    def read(self, version: int | None = None) -> DataFrame:
        """The greatest committed version (``<= version`` when given)."""
        v = self._pick(version)
        if v is None:
            raise FileNotFoundError(f"no committed version of {self.path}")
        return self.spark.read.parquet(f"{self.path}/{self.COL}={v}")

    def read_or_empty(self, schema, version: int | None = None) -> DataFrame:
        """Like ``read``, but an empty typed table before the first version."""
        if self._pick(version) is None:
            return schemas.empty(self.spark, schema)
        return self.read(version).select(*schema.fieldNames())

    def refresh(self, df: DataFrame, version: int | None = None) -> int:
        """Commit ``df`` as ``version`` (default: the next one); returns its number."""
        v = self.current_version() + 1 if version is None else int(version)
        df.write.mode("overwrite").options(**CODEC).parquet(f"{self.path}/{self.COL}={v}")
        return v


def enforced(df: DataFrame, schema: T.StructType, keys: list[str] | None = None) -> DataFrame:
    """``df`` as ``schema`` says (K10), checked while it is written: a missing or unfitting column
    fails the plan, a NULL in a NOT NULL column or a second row of a key fails the write.

    Key parts compare null-safely.  The key check shuffles by the key, so it is for
    tables of aggregated or per-key rows.
    """
    missing = [c for c in schema.fieldNames() if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    out = df.to(loose)
    rows = out if not keys else out.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    cols = []
    for i, f in enumerate(schema.fields):
        c = F.col(f.name)
        if not f.nullable:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"{f.name} is NULL")).cast(f.dataType)).otherwise(c)
        if keys and f.name == keys[0]:
            c = F.when(F.col("_rows") > 1, F.raise_error(F.lit(f"several rows of one key {keys}")).cast(f.dataType)).otherwise(c)
        cols.append(c.alias(f.name))
    return rows.select(*cols)


def full_refresh(df: DataFrame, path: str) -> DataFrame:
    """K7: replace the table at ``path`` with ``df`` atomically and return its reader."""
    t = VersionedTable(df.sparkSession, path)
    t.refresh(df)
    return t.read()


class KeyedTable:
    """A keyed Parquet table partitioned by ``pmod(xxhash64(keys), buckets)``.

    ``upsert`` rewrites only the buckets a batch touches: the touched bucket
    numbers (at most ``buckets`` small integers, never data rows) are resolved
    first, so the read of the old rows is pruned to those partitions at
    planning time; they are merged with the batch by the ``upsert`` operator
    and written back with *dynamic* partition overwrite, which replaces just
    the written buckets at job commit.  A small batch against a huge table
    therefore costs the size of its buckets, not of the table.  The table is
    updated in place: a DataFrame read before an upsert must be read again
    after it (``upsert`` returns a fresh reader); use ``VersionedTable`` where
    readers need snapshot isolation.
    """

    BUCKET = "_bucket"

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 64,
                 null_safe: bool = False):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.buckets, self.null_safe = list(keys), buckets, null_safe

    def _bucket(self):
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _raw(self) -> DataFrame | None:
        fs, path_of = _hadoop(self.spark, self.path)
        if not fs.globStatus(path_of(f"{self.path}/{self.BUCKET}=*")):
            return None
        return read_if_exists(self.spark, self.path)

    def read(self) -> DataFrame:
        df = self._raw()
        if df is None:
            raise FileNotFoundError(self.path)
        return df.drop(self.BUCKET)

    def _check_buckets(self) -> None:
        """The bucket count is stored beside the data; another one is refused, as it would
        place a key twice."""
        fs, path_of = _hadoop(self.spark, self.path)
        mine = path_of(f"{self.path}/_buckets_{self.buckets}")
        if fs.exists(mine):
            return
        if fs.exists(path_of(self.path)):
            for status in fs.listStatus(path_of(self.path)):
                if status.getPath().getName().startswith("_buckets_"):
                    raise ValueError(f"{self.path} has {status.getPath().getName()[9:]} buckets, not {self.buckets}")
        fs.create(mine).close()

    def touched(self, rows: DataFrame) -> DataFrame | None:
        """The table's rows in the buckets that the keys of ``rows`` fall in (a pruned read)."""
        old = self._raw()
        if old is None:
            return None
        touched = [r[0] for r in rows.select(self._bucket().alias(self.BUCKET)).distinct().collect()]
        return old.filter(F.col(self.BUCKET).isin(touched)).drop(self.BUCKET)

    def upsert(self, batch: DataFrame, order, columns: list[str], unique: bool = False,
               staged: str | None = None) -> DataFrame:
        """Apply ``batch`` (last write wins on ``order``); ``columns`` is the table schema.

        ``unique`` declares the batch already one row per key.  With ``staged`` the rows of the
        touched buckets that the batch does not replace are first written to that folder, and the
        buckets published from there and from the batch: whatever fails, these rows are in the
        table or the staged folder, and a retry with the same batch and folder publishes them again.
        """
        from hiremart.operators.upsert import pick_per_key
        from hiremart.operators.upsert import upsert as upsert_rows

        self._check_buckets()
        if staged is None:
            old = self.touched(batch)
            if old is None:
                new = (batch if unique else pick_per_key(batch, self.keys, order)).select(*columns)
            else:
                new = upsert_rows(old.select(*columns), batch, self.keys, order, null_safe=self.null_safe,
                                  unique=unique)
            return self._publish(new.withColumn(self.BUCKET, self._bucket()).repartition(self.BUCKET))
        new = (batch if unique else pick_per_key(batch, self.keys, order)).select(*columns)
        if not is_committed(self.spark, staged):
            old = self.touched(batch)
            kept = schemas.empty(self.spark, new.schema) if old is None else self._kept(
                old.select(*columns), batch.select(*self.keys), f"{staged}_keys")
            kept.write.mode("overwrite").options(**CODEC).parquet(staged)
        kept = self.spark.read.schema(new.schema).parquet(staged)
        if not kept.isEmpty():
            new = kept.unionByName(new)
        return self._publish(self._few_tasks(new).withColumn(self.BUCKET, self._bucket()))

    def _kept(self, old: DataFrame, batch_keys: DataFrame, work: str) -> DataFrame:
        """The ``old`` rows whose key is not in the batch.  The keys alone tell which; the rows are
        then looked up by the lesser side, the kept keys or the batch's, and not read if none is kept."""
        def beside(kind: str, keys: DataFrame, null_safe: bool, rows: DataFrame = old) -> DataFrame:
            right = keys.distinct().select(*[F.col(k).alias(f"_k_{k}") for k in self.keys])
            on = [rows[k].eqNullSafe(right[f"_k_{k}"]) if null_safe else rows[k] == right[f"_k_{k}"] for k in self.keys]
            return rows.join(right, on, kind)

        left = materialize(beside("left_anti", batch_keys, self.null_safe, old.select(*self.keys)), work)
        n = left.count()
        if n == 0:
            return schemas.empty(self.spark, old.schema)
        if 2 * n > old.count():
            return beside("left_anti", batch_keys, self.null_safe)
        return beside("left_semi", left, True)

    def _few_tasks(self, rows: DataFrame) -> DataFrame:
        """``rows`` read by one task per ``STAGED_BYTES`` of their files at least: each task writes a
        file into every bucket it meets, so the tasks follow the bytes, not the number of files."""
        jvm = self.spark.sparkContext._jvm
        folders = {f.rpartition("/")[0] for f in rows.inputFiles()}
        if not folders:
            return rows
        size = 0
        for at in folders:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(at))
            fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            size += fs.getContentSummary(path).getLength()
        return rows.coalesce(self._tasks(size, self.spark.sparkContext.defaultParallelism))

    def _tasks(self, size: int, cores: int) -> int:
        """Tasks that publish ``size`` bytes: each writes a file into every bucket, so what a file holds
        is a task's bytes over the buckets."""
        each = max(STAGED_BYTES, FILE_BYTES * self.buckets)
        return max(1, math.ceil(size / each), min(math.ceil(size / STAGED_BYTES), cores))

    def _publish(self, rows: DataFrame) -> DataFrame:
        """Replaces the buckets that ``rows`` hold.  A task keeps a file open per bucket (at most
        ``buckets``) instead of sorting its rows by bucket, which would spill with large ones."""
        conf, name = self.spark.conf, "spark.sql.maxConcurrentOutputFileWriters"
        before = conf.get(name)
        conf.set(name, str(self.buckets + 1))
        try:
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**CODEC)
             .partitionBy(self.BUCKET).parquet(self.path))
        finally:
            conf.set(name, before)
        return self.read()


class AppendTable:
    """An insert-only Parquet table: each load run adds only its new rows.

    Layout: ``<path>/_run=<n>/`` holds the rows added by run ``n``.  A run's
    delta is computed against the rows of earlier runs (``read_before``) and
    written to its own folder, replacing it on a retry — so a re-run appends
    nothing twice, and the table as of any run is a pruned read
    (``read(upto=n)``).  Cost per run is the size of its delta, not of the
    history.
    """

    COL = "_run"

    def __init__(self, spark: SparkSession, path: str, schema, partition: str | None = None):
        """``partition`` names a column that also partitions the rows within a run's folder."""
        self.spark, self.path, self.schema, self.partition = spark, path.rstrip("/"), schema, partition

    def runs(self) -> list[int]:
        """Committed runs: the direct children that hold a commit marker."""
        return committed(self.spark, self.path, self.COL)

    def _select(self, wanted) -> DataFrame:
        paths = [f"{self.path}/{self.COL}={r}" for r in self.runs() if wanted(r)]
        if not paths:
            return schemas.empty(self.spark, self.schema)
        reader = self.spark.read.schema(self.schema)
        if self.partition:
            reader = reader.option("basePath", self.path)
        return reader.parquet(*paths).select(*self.schema.fieldNames())

    def read(self, upto: int | None = None) -> DataFrame:
        """All rows, or the rows added by runs ``<= upto``."""
        return self._select(lambda r: upto is None or r <= upto)

    def read_before(self, run: int) -> DataFrame:
        """The rows added by runs ``< run`` (the state a run starts from)."""
        return self._select(lambda r: r < run)

    def added_by(self, run: int) -> DataFrame:
        """The rows that one run added."""
        return self._select(lambda r: r == run)

    def refuse_older(self, run: int) -> None:
        """Raises for a run below the greatest committed one: its delta would be taken
        against a state that never was."""
        last = max(self.runs(), default=run)
        if run < last:
            raise ValueError(f"{self.path}: run {run} is older than the committed run {last}")

    def append(self, delta: DataFrame, run: int) -> None:
        """Commit ``delta`` as run ``run``'s rows (replacing a failed attempt's)."""
        writer = delta.select(*self.schema.fieldNames()).write.mode("overwrite").options(**CODEC)
        if self.partition:
            writer = writer.partitionBy(self.partition).option("partitionOverwriteMode", "static")
        writer.parquet(f"{self.path}/{self.COL}={int(run)}")


def _hadoop(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path's class (driver-side listing only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def is_committed(spark: SparkSession, path: str) -> bool:
    """Whether the write of one folder was committed (Spark's ``_SUCCESS`` marker)."""
    fs, path_of = _hadoop(spark, path)
    return fs.exists(path_of(f"{path}/_SUCCESS"))


def write_once(df: DataFrame, path: str, metrics: dict | None = None) -> tuple[DataFrame, dict]:
    """Write a step's output unless an earlier attempt committed it; read it back.

    ``metrics`` are aggregates taken by the write itself (``DataFrame.observe``), or
    from the written rows where the write was an earlier attempt's.
    """
    spark, named = df.sparkSession, [c.alias(k) for k, c in (metrics or {}).items()]
    if is_committed(spark, path):
        out = spark.read.schema(df.schema).parquet(path)
        return out, (out.agg(*named).first().asDict() if named else {})
    seen = observed(df, named)
    seen[0].write.mode("overwrite").options(**CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen[1]()


def observed(df: DataFrame, named: list) -> tuple[DataFrame, object]:
    """``df`` watched by its own next action, and a function giving the metrics afterwards."""
    if not named:
        return df, dict
    watch = Observation()
    return df.observe(watch, *named), lambda: dict(watch.get)


def committed(spark: SparkSession, path: str, col: str) -> list[int]:
    """Numbers ``n`` of the direct children ``<col>=<n>`` whose write was committed
    (Spark's ``_SUCCESS`` marker); one listing, no data files."""
    fs, path_of = _hadoop(spark, path)
    if not fs.exists(path_of(path)):
        return []
    found = []
    for status in fs.listStatus(path_of(path)):
        m = re.fullmatch(rf"{re.escape(col)}=(\d+)", status.getPath().getName())
        if m and fs.exists(path_of(f"{path}/{m.group(0)}/_SUCCESS")):
            found.append(int(m.group(1)))
    return sorted(found)
