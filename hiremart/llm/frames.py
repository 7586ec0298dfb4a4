"""DataFrame helpers shared by the operators: written steps, checked broadcasts,
prefix sums that split hot groups, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hiremart.session import scratch_path

#: Broadcast only below this many rows (of a few longs each: tens of MB at most).
BROADCAST_ROWS = 1_000_000
#: Arrow batches of texts: few rows, so a batch of long texts stays small.
BATCH_ROWS = 500


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the Arrow operators (rows in a batch)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared scratch folder and read it back (cuts lineage;
    a lost executor re-reads files)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if it has at most ``rows``
    rows; beyond that as it is, and the join shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def running_total(df: DataFrame, group: list[str], share: Column, order: list[Column], value: str,
                  out: str, rows_per_bucket: int = 50_000) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows before this one in its group.

    ``share`` (0 to 1, ascending in the wanted order) cuts a group into buckets of
    about ``rows_per_bucket`` rows, so a group holding a third of all rows is summed
    by many tasks; the bucket totals (one row per bucket) give the offsets.  ``df``
    must be a written table: it is read twice.  Null groups are groups.
    """
    g = [F.col(c) for c in group]
    eq = lambda a, b: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in group]
    sizes = df.groupBy(*g).agg(F.count(F.lit(1)).alias("_n")).select(
        *g, F.greatest(F.ceil(F.col("_n") / rows_per_bucket), F.lit(1)).alias("_buckets"))
    cond = eq("d", "s")
    on = cond[0]
    for c in cond[1:]:
        on = on & c
    cut = (df.withColumn("_share", share).alias("d").join(sizes.alias("s"), on)
           .select("d.*", "s._buckets")
           .withColumn("_bucket", F.least((F.col("_share") * F.col("_buckets")).cast("long"),
                                          F.col("_buckets") - 1)))
    totals = (cut.groupBy(*group, "_bucket").agg(F.sum(value).alias("_sum"))
              .withColumn("_before", F.coalesce(F.sum("_sum").over(
                  Window.partitionBy(*group).orderBy("_bucket")
                  .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    inner = Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    cond = eq("d", "t") + [F.col("d._bucket") == F.col("t._bucket")]
    on = cond[0]
    for c in cond[1:]:
        on = on & c
    return (cut.withColumn("_within", F.coalesce(F.sum(value).over(inner), F.lit(0)))
            .alias("d").join(totals.alias("t"), on)
            .select("d.*", (F.col("t._before") + F.col("d._within")).alias(out))
            .drop("_share", "_buckets", "_bucket", "_within"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components: ``(node, root)`` for every node of ``edges(a, b)``
    that is not the smallest of its component, root = the smallest node.

    Alternating large-star / small-star rounds on the edge table; each round is
    written to the shared folder and a count with a checksum tells when nothing
    changes.  No node's neighbours are ever gathered into a list.
    """
    def mark(e):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        return tuple(r)

    e = keep(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
             .where("a <> b").distinct(), "edges")
    last = mark(e)
    while last[0]:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small_star = (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        e = keep(small_star, "edges")
        now = mark(e)
        if now == last:
            break
        last = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
