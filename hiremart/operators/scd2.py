"""Type-2 slowly changing employer dimension (D3a-c, D3, D8).

History rows are never touched.  A current row whose tracked attributes
differ (NULL-safely) from the staged row is closed at ``now`` and a new
current version opened; a staged key without a current row gets its first
version.  Surrogate keys are ``xxhash64(business key, valid_from)``:
deterministic under task retries and free of any global ordering.
``now`` is a parameter, so re-running with the same staging changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hiremart.constants import END_OF_TIME
from hiremart.functions.columns import surrogate_key
from hiremart.operators.upsert import pick_per_key

DIM_COLS = ["employer_sk", "employer_id", "employer_name", "alternate_url", "trusted",
            "valid_from", "valid_to", "is_current"]
ATTRS = ["employer_name", "alternate_url", "trusted"]


def _ts(x) -> Column:
    return F.lit(x).cast("timestamp")


def employer_rows(stage: DataFrame) -> DataFrame:
    """The named employer of every posting, with the posting's publication and id."""
    return (stage.filter(F.col("employer_id").isNotNull() & F.col("employer_name").isNotNull())
            .select("employer_id", "employer_name", "alternate_url", "trusted",
                    "published_at", "vacancy_id"))


def stage_employers_from_postings(stage: DataFrame) -> DataFrame:
    """One staged row per employer id seen in the postings.

    Name falls back to the ODS column; an empty ``trusted`` is NULL.  When the
    postings disagree, the latest publication (then greatest vacancy id) wins.
    Rows without a name cannot become a version and are left out.
    """
    return (pick_per_key(employer_rows(stage), ["employer_id"], ["published_at", "vacancy_id"])
            .select("employer_id", "employer_name", "alternate_url", "trusted"))


def stage_employers_from_feed(ods_employers: DataFrame) -> DataFrame:
    """D8 staging: the employer feed's ``site_url`` is the url; ``trusted`` unknown."""
    rows = (ods_employers.filter(F.col("id").isNotNull() & F.col("name").isNotNull())
            .select(F.col("id").alias("employer_id"), F.col("name").alias("employer_name"),
                    F.col("site_url").alias("alternate_url"),
                    F.lit(None).cast("boolean").alias("trusted")))
    return pick_per_key(rows, ["employer_id"], ["employer_name", "alternate_url"])


def _changed(tracked: Sequence[str], cur: str = "_c", new: str = "_s") -> Column:
    cond = F.lit(False)
    for a in tracked:
        cond = cond | ~F.col(f"{cur}.{a}").eqNullSafe(F.col(f"{new}.{a}"))
    return cond


def scd2_expire(dim: DataFrame, staged: DataFrame, now, key: str = "employer_id",
                tracked: Sequence[str] = ATTRS) -> DataFrame:
    """Close current versions whose tracked attributes changed.

    Returns the whole dimension after the update.
    """
    history = dim.filter(~F.col("is_current"))
    cur = dim.filter(F.col("is_current")).alias("_c")
    s = staged.select(key, *tracked).alias("_s")
    j = cur.join(s, F.col(f"_c.{key}") == F.col(f"_s.{key}"), "left")
    hit = F.col(f"_s.{key}").isNotNull() & _changed(tracked)
    updated = j.select(*[F.col(f"_c.{c}").alias(c) for c in DIM_COLS if c not in ("valid_to", "is_current")],
                       F.when(hit, _ts(now)).otherwise(F.col("_c.valid_to")).alias("valid_to"),
                       F.when(hit, F.lit(False)).otherwise(F.col("_c.is_current")).alias("is_current"))
    return history.unionByName(updated.select(*DIM_COLS))


def _new_versions(rows: DataFrame, now) -> DataFrame:
    return rows.select(
        surrogate_key(F.col("employer_id"), _ts(now)).alias("employer_sk"),
        "employer_id", "employer_name", "alternate_url",
        F.col("trusted").cast("boolean").alias("trusted"),
        _ts(now).alias("valid_from"), _ts(END_OF_TIME).alias("valid_to"),
        F.lit(True).alias("is_current"))


def scd2_insert(dim: DataFrame, staged: DataFrame, now, key: str = "employer_id") -> DataFrame:
    """Open a version for every staged key without a current row.

    Returns the whole dimension after the insert.
    """
    current_keys = dim.filter(F.col("is_current")).select(key)
    fresh = staged.join(current_keys, key, "left_anti")
    return dim.unionByName(_new_versions(fresh, now).select(*DIM_COLS))


def scd2_step(current: DataFrame, staged: DataFrame, now, key: str = "employer_id",
              tracked: Sequence[str] = ATTRS, step: int = 0) -> DataFrame:
    """D3 / D8 on the *current* rows only: the versions one load writes.

    current ⟗ staged on the key; every joined row emits up to two versions in
    one pass: the current row (closed at ``now`` when a tracked attribute
    changed, else unchanged) and a new current version (when changed or the
    key is new).  The output holds every current version after the load plus
    the versions it closed; history rows closed earlier never take part, so
    the cost is bounded by the current dimension, not by its history.
    Steps that share one ``now`` must differ in ``step``: it is part of the
    surrogate key, so a version opened and closed within a run keeps its own.
    """
    cur = current.filter(F.col("is_current")).alias("_c")
    s = staged.select(key, *ATTRS).alias("_s")
    j = cur.join(s, F.col(f"_c.{key}") == F.col(f"_s.{key}"), "full_outer")
    has_cur, has_new = F.col(f"_c.{key}").isNotNull(), F.col(f"_s.{key}").isNotNull()
    changed = has_cur & has_new & _changed(tracked)
    old = F.struct(
        F.col("_c.employer_sk").alias("employer_sk"), F.col(f"_c.{key}").alias("employer_id"),
        *[F.col(f"_c.{a}").alias(a) for a in ATTRS],
        F.col("_c.valid_from").alias("valid_from"),
        F.when(changed, _ts(now)).otherwise(F.col("_c.valid_to")).alias("valid_to"),
        F.when(changed, F.lit(False)).otherwise(F.col("_c.is_current")).alias("is_current"))
    new = F.struct(
        surrogate_key(F.col(f"_s.{key}"), _ts(now), *([F.lit(step)] if step else [])).alias("employer_sk"),
        F.col(f"_s.{key}").alias("employer_id"),
        *[F.col(f"_s.{a}").alias(a) for a in ATTRS],
        _ts(now).alias("valid_from"), _ts(END_OF_TIME).alias("valid_to"),
        F.lit(True).alias("is_current"))
    versions = F.array(F.when(has_cur, old), F.when(changed | ~has_cur, new))
    out = (j.select(F.explode(F.filter(versions, lambda v: v.isNotNull())).alias("_v"))
           .select("_v.*"))
    return out.select(*DIM_COLS)


def scd2_apply(dim: DataFrame, staged: DataFrame, now, key: str = "employer_id",
               tracked: Sequence[str] = ATTRS, step: int = 0) -> DataFrame:
    """Expire + insert as one plan with a single join on the key.

    History rows pass through untouched; the current rows go through
    ``scd2_step``.
    """
    history = dim.filter(~F.col("is_current"))
    return history.unionByName(scd2_step(dim, staged, now, key, tracked, step))
