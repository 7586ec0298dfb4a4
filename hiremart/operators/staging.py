"""Parse the ODS ``raw`` documents once into typed columns for the DDS loaders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiremart import schemas
from hiremart.functions.columns import text_to_bool, text_to_decimal
from hiremart.operators.flatten import parse_raw


#: what an employer's staged row is made of
EMPLOYER_COLS = ["vacancy_id", "published_at", "employer_id", "employer_name", "alternate_url", "trusted"]
#: output columns by the document's member that they are read from
_MEMBERS = {"area": ["area_id", "area_name"], "employer": EMPLOYER_COLS[2:],
            "salary": ["salary_from", "salary_to", "salary_currency", "salary_gross"],
            "professional_roles": ["professional_roles"], "specializations": ["specializations"]}


def stage_postings(ods_postings: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """ODS postings → one typed row per vacancy (the DDS input).

    Columns: ``vacancy_id, name, published_at, published_date, area_id,
    area_name, employer_id, employer_name, alternate_url, trusted,
    salary_from, salary_to, salary_currency, salary_gross,
    professional_roles, specializations``.  Names fall back to the ODS
    columns when the document lacks them.  With ``columns`` only these are given, and only the
    members that they need are parsed.  Rows that carry their parsed document as ``_doc`` are not
    parsed again.
    """
    doc = F.col("_doc")
    if "_doc" in ods_postings.columns:
        parsed = ods_postings
    else:
        members = [f for f in schemas.POSTING_DOC.fields
                   if columns is None or not set(_MEMBERS.get(f.name, ())).isdisjoint(columns)]
        # exploded from an array of one, so that a filter on what is parsed does not parse it once more
        text = parse_raw("raw", T.StructType(members or schemas.POSTING_DOC.fields))
        parsed = ods_postings.select("id", "name", "area_name", "employer_name", "published_at",
                                     F.explode(F.array(text)).alias("_doc"))
        if columns is not None:     # members that were not parsed
            parsed = parsed.withColumn("_doc", F.struct(*[
                doc.getField(f.name).alias(f.name) if f in members else F.lit(None).cast(f.dataType).alias(f.name)
                for f in schemas.POSTING_DOC.fields]))
    area, emp, sal = doc.getField("area"), doc.getField("employer"), doc.getField("salary")
    out = parsed.select(
        F.col("id").alias("vacancy_id"),
        F.col("name"),
        F.col("published_at"),
        F.to_date("published_at").alias("published_date"),
        area.getField("id").cast("bigint").alias("area_id"),
        F.coalesce(area.getField("name"), F.col("area_name")).alias("area_name"),
        emp.getField("id").cast("bigint").alias("employer_id"),
        F.coalesce(emp.getField("name"), F.col("employer_name")).alias("employer_name"),
        emp.getField("alternate_url").alias("alternate_url"),
        text_to_bool(emp.getField("trusted")).alias("trusted"),
        text_to_decimal(sal.getField("from")).alias("salary_from"),
        text_to_decimal(sal.getField("to")).alias("salary_to"),
        sal.getField("currency").alias("salary_currency"),
        text_to_bool(sal.getField("gross")).alias("salary_gross"),
        doc.getField("professional_roles").alias("professional_roles"),
        doc.getField("specializations").alias("specializations"),
    )
    return out if columns is None else out.select(*columns)
