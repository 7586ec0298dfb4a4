"""Facts and bridges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremart.functions.columns import empty_to_null
from hiremart.operators.upsert import insert_ignore

FACT_COLS = ["vacancy_id", "name", "employer_sk", "area_id", "published_date", "salary_from",
             "salary_to", "salary_currency", "salary_gross", "created_at"]


def with_version(stage: DataFrame, dim_employer: DataFrame) -> DataFrame:
    """Postings beside their employer's *current* version: ``employer_sk`` and ``_versioned``, both
    NULL without one."""
    cur = (dim_employer.filter(F.col("is_current"))
           .select("employer_id", "employer_sk", F.lit(True).alias("_versioned")))
    return stage.join(cur, "employer_id", "left")


def as_facts(versioned: DataFrame, now) -> DataFrame:
    """Postings with their ``employer_sk`` as rows of the fact."""
    return versioned.select("vacancy_id", "name", "employer_sk", "area_id", "published_date",
                            "salary_from", "salary_to", "salary_currency", "salary_gross",
                            F.lit(now).cast("timestamp").alias("created_at")).select(*FACT_COLS)


def fact_rows(stage: DataFrame, dim_employer: DataFrame, now) -> DataFrame:
    """The facts that postings give: each joined to its employer's *current* version;
    a posting without one, or without a publication date, gives none."""
    dated = stage.filter(F.col("published_date").isNotNull())
    return as_facts(with_version(dated, dim_employer).where("_versioned"), now)


def fact_incremental(stage: DataFrame, dim_employer: DataFrame, fact: DataFrame, now) -> DataFrame:
    """Vacancy facts to append — only vacancy ids not already in the fact.

    Returns the new rows (``fact_rows``); first write wins for a vacancy.
    """
    rows = fact_rows(stage, dim_employer, now)
    return rows.join(fact.select("vacancy_id"), "vacancy_id", "left_anti").select(*FACT_COLS)


def bridge_rows(stage: DataFrame, array_col: str, id_alias: str, now) -> DataFrame:
    """Explode a posting's ``[{id, …}]`` array into ``(vacancy_id, <id_alias>)`` pairs.

    Items whose id is missing or empty are skipped; a NULL or absent array
    gives no rows.
    """
    e = F.col("_e")
    return (stage.select("vacancy_id", F.explode(array_col).alias("_e"))
            .filter(empty_to_null(e.getField("id")).isNotNull())
            .select("vacancy_id", e.getField("id").cast("string").alias(id_alias),
                    F.lit(now).cast("timestamp").alias("created_at")))


def bridge(existing: DataFrame, stage: DataFrame, array_col: str, id_alias: str, now) -> DataFrame:
    """Bridge rows to append (insert-ignore on ``(vacancy_id, id)``)."""
    return insert_ignore(existing, bridge_rows(stage, array_col, id_alias, now),
                         ["vacancy_id", id_alias])


def fact_snapshot(ods_employers: DataFrame, dim_employer: DataFrame, fact: DataFrame,
                  as_of, now) -> DataFrame:
    """One snapshot row per employer and ``as_of`` day; the day's first run wins.

    Employers are joined to their current version; keys already snapshotted
    for ``as_of`` are skipped.  Returns the rows to append.
    """
    cur = dim_employer.filter(F.col("is_current")).select("employer_id", "employer_sk")
    day = F.lit(as_of).cast("date")
    rows = (ods_employers.select(F.col("id").alias("employer_id"), "area_name",
                                 "open_vacancies", "site_url")
            .join(cur, "employer_id")
            .select("employer_id", day.alias("snapshot_date"), "employer_sk", "area_name",
                    "open_vacancies", "site_url", F.lit(now).cast("timestamp").alias("created_at")))
    done = fact.filter(F.col("snapshot_date") == day).select("employer_id")
    return rows.join(done, "employer_id", "left_anti")
