"""Type-1 dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremart.constants import UNKNOWN_LABEL
from hiremart.functions.columns import day_of_week_sun0, empty_to_null, iso_week
from hiremart.operators.upsert import insert_ignore, upsert_scd1

UNKNOWN_ROLE = UNKNOWN_LABEL


def date_rows(df: DataFrame, date_col: str) -> DataFrame:
    """Every day from the least to the greatest date of ``date_col`` with its parts.

    Day of week counts Sunday as 0; ``week`` is the ISO week.  An empty input
    (NULL bounds) gives no rows.  The calendar between two dates is small and
    bounded by the date range, not by the data volume.
    """
    bounds = df.agg(F.min(F.col(date_col).cast("date")).alias("lo"),
                    F.max(F.col(date_col).cast("date")).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(F.col("d").alias("date_key"),
                       F.year("d").cast("int").alias("year"),
                       F.month("d").cast("int").alias("month"),
                       F.dayofmonth("d").cast("int").alias("day"),
                       day_of_week_sun0("d").alias("day_of_week"),
                       iso_week("d").alias("week"))


def date_edges(stage: DataFrame) -> DataFrame:
    """Each posting as a candidate for the first and for the last publication day
    (``rank`` grows toward the edge)."""
    day = F.datediff("published_date", F.lit("1970-01-01"))
    edges = F.array(F.struct(F.lit("first").alias("edge"), (-day).alias("rank")),
                    F.struct(F.lit("last").alias("edge"), day.alias("rank")))
    return (stage.filter(F.col("published_date").isNotNull())
            .select("vacancy_id", "published_date", F.explode(edges).alias("_e"))
            .select("_e.edge", "published_date", "_e.rank", "vacancy_id"))


def dim_date(existing: DataFrame, df: DataFrame, date_col: str = "published_date") -> DataFrame:
    """Add the missing days of the source's date range (insert-ignore)."""
    new = insert_ignore(existing, date_rows(df, date_col), ["date_key"])
    return existing.unionByName(new)


def area_rows(stage: DataFrame) -> DataFrame:
    """Distinct ``(area_id, area_name)``; one name per id: the latest posting's."""
    return (stage.filter(F.col("area_id").isNotNull())
            .select("area_id", "area_name", "published_at", "vacancy_id"))


def dim_area(existing: DataFrame, stage: DataFrame) -> DataFrame:
    """SCD1 area dimension (latest publication, then greatest vacancy id wins)."""
    return upsert_scd1(existing, area_rows(stage), ["area_id"], ["published_at", "vacancy_id"])


def role_rows(stage: DataFrame) -> DataFrame:
    """Roles of every posting: non-empty id, NULL name → ``'UNKNOWN'``."""
    r = F.col("_r")
    exploded = stage.select("vacancy_id", "published_at",
                            F.explode("professional_roles").alias("_r"))
    return (exploded.filter(empty_to_null(r.getField("id")).isNotNull())
            .select(r.getField("id").alias("role_id"),
                    F.coalesce(r.getField("name"), F.lit(UNKNOWN_ROLE)).alias("role_name"),
                    "published_at", "vacancy_id"))


def dim_role(existing: DataFrame, stage: DataFrame) -> DataFrame:
    """SCD1 professional-role dimension."""
    return upsert_scd1(existing, role_rows(stage), ["role_id"],
                       ["published_at", "vacancy_id", "role_name"])


def dim_industry(existing: DataFrame, ods_industries: DataFrame) -> DataFrame:
    """SCD1 industry dimension from the flattened dictionary.

    The dictionary has no timestamps: one name per id, the greatest.
    """
    rows = (ods_industries.filter(F.col("industry_id").isNotNull())
            .select("industry_id", "industry_name").distinct())
    return upsert_scd1(existing, rows, ["industry_id"], ["industry_name"])


def dim_sphere(existing: DataFrame, ods_industries: DataFrame) -> DataFrame:
    """SCD1 sphere dimension; name **and** parent industry are updated."""
    rows = (ods_industries.filter(F.col("sphere_id").isNotNull())
            .select("sphere_id", "sphere_name", "industry_id").distinct())
    return upsert_scd1(existing, rows, ["sphere_id"], ["sphere_name", "industry_id"])
