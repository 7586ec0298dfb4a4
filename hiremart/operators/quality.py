"""Data-quality checks (Q-1..Q-3).  Each returns a one-row DataFrame with the
metrics and a ``status`` of ``PASS``, ``FAIL`` or ``SKIP``;
``assert_passed`` turns a failed check into an exception."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremart.constants import DQ_MIN_DATE


class DataQualityError(RuntimeError):
    pass


def dq_row_counts(ods_postings: DataFrame, fact: DataFrame) -> DataFrame:
    """Q-1: ODS total and eligible rows (employer id present) vs fact rows.

    SKIP when nothing is eligible, FAIL when eligible ≠ fact count.  Computed
    in one aggregate over the tagged union of both inputs (no join).
    """
    eligible = F.get_json_object("raw", "$.employer.id").isNotNull()
    tagged = (ods_postings.select(F.lit(0).alias("_src"), eligible.alias("_ok"))
              .unionByName(fact.select(F.lit(1).alias("_src"), F.lit(True).alias("_ok"))))
    c = tagged.agg(F.count_if(F.col("_src") == 0).cast("long").alias("ods_total"),
                   F.count_if((F.col("_src") == 0) & F.col("_ok")).cast("long").alias("ods_eligible"),
                   F.count_if(F.col("_src") == 1).cast("long").alias("dds_count"))
    status = (F.when(F.col("ods_eligible") == 0, "SKIP")
              .when(F.col("ods_eligible") != F.col("dds_count"), "FAIL").otherwise("PASS"))
    return c.select(F.lit("row_counts").alias("check"), "ods_total", "ods_eligible",
                    "dds_count", status.alias("status"))


def dq_null_keys(fact: DataFrame, cols: Sequence[str] = ("employer_sk", "published_date")) -> DataFrame:
    """Q-2: rows with a NULL in any key column; FAIL when > 0."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    c = fact.agg(F.count_if(cond).cast("long").alias("invalid_count"))
    return c.select(F.lit("null_keys").alias("check"), "invalid_count",
                    F.when(F.col("invalid_count") > 0, "FAIL").otherwise("PASS").alias("status"))


def dq_date_range(fact: DataFrame, col: str = "published_date", lo=DQ_MIN_DATE,
                  as_of="2026-01-01") -> DataFrame:
    """Q-3: min/max date and counts before ``lo`` and after ``as_of``; FAIL if any."""
    d = F.col(col)
    c = fact.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"),
                 F.count_if(d < F.lit(lo).cast("date")).cast("long").alias("too_old"),
                 F.count_if(d > F.lit(as_of).cast("date")).cast("long").alias("in_future"))
    bad = (F.col("too_old") > 0) | (F.col("in_future") > 0)
    return c.select(F.lit("date_range").alias("check"), "min_date", "max_date", "too_old",
                    "in_future", F.when(bad, "FAIL").otherwise("PASS").alias("status"))


def checks_of_loads(load_metrics: DataFrame, fact_days: DataFrame, lo=DQ_MIN_DATE, as_of="2026-01-01") -> DataFrame:
    """Q-1, Q-2 and Q-3 from what the loads counted while writing: one row per check with its
    ``status`` and its ``metrics`` as JSON.  Neither the ODS nor the fact is read."""
    total = load_metrics.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (
        ("ods_added", "ods_total"), ("eligible_added", "ods_eligible"), ("fact_rows", "dds_count"),
        ("null_keys", "invalid_count"), ("rejected", "rejected"), ("fetched", "fetched"))])
    d, n = F.col("published_date"), F.col("fact_rows")
    days = fact_days.agg(
        F.min(d).alias("min_date"), F.max(d).alias("max_date"),
        F.coalesce(F.sum(F.when(d < F.lit(lo).cast("date"), n)), F.lit(0)).alias("too_old"),
        F.coalesce(F.sum(F.when(d > F.lit(as_of).cast("date"), n)), F.lit(0)).alias("in_future"))
    as_row = lambda df, name, status, *cols: df.select(
        F.lit(name).alias("check"), status.alias("status"), F.to_json(F.struct(*cols)).alias("metrics"))
    counts = (F.when(F.col("ods_eligible") == 0, "SKIP")
              .when(F.col("ods_eligible") != F.col("dds_count"), "FAIL").otherwise("PASS"))
    fails = lambda bad: F.when(bad, "FAIL").otherwise("PASS")
    return (as_row(total, "row_counts", counts, "ods_total", "ods_eligible", "dds_count")
            .unionByName(as_row(total, "null_keys", fails(F.col("invalid_count") > 0), "invalid_count"))
            .unionByName(as_row(days, "date_range", fails((F.col("too_old") > 0) | (F.col("in_future") > 0)),
                                "min_date", "max_date", "too_old", "in_future"))
            .unionByName(as_row(total, "rejected_postings", F.lit("PASS"), "fetched", "rejected")))


def dq_unique(df: DataFrame, key: str) -> DataFrame:
    """Keys that several rows carry, as one foreign-key style row; FAIL when > 0."""
    twice = df.groupBy(key).count().where("count > 1").agg(F.count(F.lit(1)).cast("long").alias("orphans"))
    return twice.select("orphans", F.when(F.col("orphans") > 0, "FAIL").otherwise("PASS").alias("status"))


def assert_passed(check: DataFrame) -> None:
    """Raise ``DataQualityError`` if the one-row check did not pass (one tiny action)."""
    row = check.first()
    if row is not None and row["status"] == "FAIL":
        raise DataQualityError(f"data-quality check failed: {row.asDict()}")


def dq_foreign_keys(relations) -> DataFrame:
    """Foreign-key orphans: one row per relation with the count of child rows
    whose non-NULL key has no parent row (a ``left_anti`` join each); FAIL
    when > 0.  ``relations``: ``[(name, child_df, child_key, parent_df, parent_key)]``.
    """
    out = None
    for name, child, ckey, parent, pkey in relations:
        keys = parent.select(F.col(pkey).alias("_k")).distinct()
        orphans = (child.select(F.col(ckey).alias("_k")).filter(F.col("_k").isNotNull())
                   .join(keys, "_k", "left_anti"))
        row = orphans.agg(F.count(F.lit(1)).cast("long").alias("orphans")).select(
            F.lit(name).alias("relation"), "orphans",
            F.when(F.col("orphans") > 0, "FAIL").otherwise("PASS").alias("status"))
        out = row if out is None else out.unionByName(row)
    return out
