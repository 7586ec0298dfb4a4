"""Declared schemas, one per landing / ODS / DDS / mart table.

Landing JSON is never schema-inferred.  Leaves of the landing documents are
declared as STRING and cast afterwards, which reproduces "JSON text get"
semantics: numbers and booleans come out as their text.
"""

from __future__ import annotations

from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

S = T.StringType()

# ---------------------------------------------------------------- landing ----
AREA = T.StructType([T.StructField("id", S), T.StructField("name", S)])
EMPLOYER_REF = T.StructType([
    T.StructField("id", S), T.StructField("name", S),
    T.StructField("alternate_url", S), T.StructField("trusted", S),
])
SALARY = T.StructType([
    T.StructField("from", S), T.StructField("to", S),
    T.StructField("currency", S), T.StructField("gross", S),
])
ID_NAME = T.StructType([T.StructField("id", S), T.StructField("name", S)])

#: one vacancy document (search item or detail record)
POSTING_DOC = T.StructType([
    T.StructField("id", S),
    T.StructField("name", S),
    T.StructField("area", AREA),
    T.StructField("employer", EMPLOYER_REF),
    T.StructField("published_at", S),
    T.StructField("salary", SALARY),
    T.StructField("professional_roles", T.ArrayType(ID_NAME)),
    T.StructField("specializations", T.ArrayType(ID_NAME)),
])

#: one search / list page: ``{"page": n, "items": [...]}``
POSTING_PAGE = T.StructType([
    T.StructField("fetch", T.LongType()),   # number of the fetch, growing; absent: 0
    T.StructField("page", T.LongType()),
    T.StructField("items", T.ArrayType(POSTING_DOC)),
])

EMPLOYER_DOC = T.StructType([
    T.StructField("id", S), T.StructField("name", S),
    T.StructField("area", AREA),
    T.StructField("open_vacancies", S),
    T.StructField("site_url", S),
])
EMPLOYER_PAGE = T.StructType([
    T.StructField("fetch", T.LongType()),
    T.StructField("page", T.LongType()),
    T.StructField("items", T.ArrayType(EMPLOYER_DOC)),
])

#: one dictionary entry: an industry with child arrays under one of three names
INDUSTRY_DOC = T.StructType([
    T.StructField("id", S), T.StructField("name", S),
    T.StructField("industries", T.ArrayType(ID_NAME)),
    T.StructField("spheres", T.ArrayType(ID_NAME)),
    T.StructField("areas", T.ArrayType(ID_NAME)),
])

# -------------------------------------------------------------------- ODS ----
ODS_POSTINGS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", S), T.StructField("area_name", S),
    T.StructField("employer_name", S),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("raw", S),
])
ODS_EMPLOYERS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", S), T.StructField("area_name", S),
    T.StructField("open_vacancies", T.IntegerType()),
    T.StructField("site_url", S), T.StructField("raw", S),
])
ODS_INDUSTRIES = T.StructType([
    T.StructField("industry_id", S), T.StructField("industry_name", S),
    T.StructField("sphere_id", S), T.StructField("sphere_name", S),
    T.StructField("raw", S),
])

# -------------------------------------------------------------------- DDS ----
DIM_DATE = T.StructType([
    T.StructField("date_key", T.DateType(), False),
    T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()), T.StructField("day_of_week", T.IntegerType()),
    T.StructField("week", T.IntegerType()),
])
DIM_AREA = T.StructType([T.StructField("area_id", T.LongType(), False),
                         T.StructField("area_name", S)])
DIM_EMPLOYER = T.StructType([
    T.StructField("employer_sk", T.LongType(), False),
    T.StructField("employer_id", T.LongType(), False),
    T.StructField("employer_name", S),
    T.StructField("alternate_url", S),
    T.StructField("trusted", T.BooleanType()),
    T.StructField("valid_from", T.TimestampType()),
    T.StructField("valid_to", T.TimestampType()),
    T.StructField("is_current", T.BooleanType()),
])
DIM_ROLE = T.StructType([T.StructField("role_id", S, False), T.StructField("role_name", S)])
DIM_INDUSTRY = T.StructType([T.StructField("industry_id", S, False),
                             T.StructField("industry_name", S)])
DIM_SPHERE = T.StructType([T.StructField("sphere_id", S, False),
                           T.StructField("sphere_name", S),
                           T.StructField("industry_id", S)])
SALARY_DEC = T.DecimalType(18, 2)
FACT_VACANCY = T.StructType([
    T.StructField("vacancy_id", T.LongType(), False),
    T.StructField("name", S),
    T.StructField("employer_sk", T.LongType()),
    T.StructField("area_id", T.LongType()),
    T.StructField("published_date", T.DateType()),
    T.StructField("salary_from", SALARY_DEC),
    T.StructField("salary_to", SALARY_DEC),
    T.StructField("salary_currency", S),
    T.StructField("salary_gross", T.BooleanType()),
    T.StructField("created_at", T.TimestampType()),
])
FACT_EMPLOYER_SNAPSHOT = T.StructType([
    T.StructField("employer_id", T.LongType(), False),
    T.StructField("snapshot_date", T.DateType(), False),
    T.StructField("employer_sk", T.LongType()),
    T.StructField("area_name", S),
    T.StructField("open_vacancies", T.IntegerType()),
    T.StructField("site_url", S),
    T.StructField("created_at", T.TimestampType()),
])
BRIDGE_ROLE = T.StructType([T.StructField("vacancy_id", T.LongType(), False),
                            T.StructField("role_id", S, False),
                            T.StructField("created_at", T.TimestampType())])
BRIDGE_SPHERE = T.StructType([T.StructField("vacancy_id", T.LongType(), False),
                              T.StructField("sphere_id", S, False),
                              T.StructField("created_at", T.TimestampType())])


# ------------------------------------------------- other stores' postings ----
ODS_POSTINGS_NAIVE = T.StructType([T.StructField("published_at", T.TimestampNTZType()) if f.name == "published_at" else f
                                   for f in ODS_POSTINGS.fields])
DOCUMENT = T.StructType([T.StructField("_id", S, False), T.StructField("raw", S)])

# ------------------------------------------------------------------ marts ----
_ROLE = [T.StructField("industry_id", S, False), T.StructField("industry_name", S, False)]
_AREA = [T.StructField("area_id", T.LongType()), T.StructField("area_name", S)]
_CNT = T.StructField("vacancies_cnt", T.LongType(), False)
_WITH = T.StructField("vacancies_with_salary_cnt", T.LongType(), False)
_AVG = T.StructField("salary_avg", T.DoubleType())
_CUR = T.StructField("currency", S, False)
_MONTH = T.StructField("month", T.DateType(), False)
#: per mart its columns and key; a NULL area is one value of the key
MARTS = {
    "salary": (T.StructType([_MONTH, *_ROLE, *_AREA, _CUR, _CNT, _WITH, T.StructField("salary_min", T.DecimalType(22, 3)),
                             _AVG, T.StructField("salary_max", T.DecimalType(22, 3))]),
               ["month", "industry_id", "area_id", "currency"]),
    "regions": (T.StructType([*_ROLE, *_AREA, _CNT, _WITH, T.StructField("share_in_industry", T.DoubleType()), _AVG]),
                ["industry_id", "area_id"]),
    "trends": (T.StructType([_MONTH, *_ROLE, _CNT, T.StructField("mom_abs", T.LongType()),
                             T.StructField("mom_pct", T.DoubleType())]), ["month", "industry_id"]),
    "top_employers": (T.StructType([*_ROLE, *_AREA, T.StructField("employer_id", T.LongType(), False),
                                    T.StructField("employer_name", S, False), _CUR, _CNT, _WITH, _AVG]),
                      ["industry_id", "area_id", "employer_id", "currency"]),
    "currency": (T.StructType([*_ROLE, *_AREA, _CUR, _CNT, T.StructField("currency_share", T.DoubleType())]),
                 ["industry_id", "area_id", "currency"]),
}

# ------------------------------------------- state kept between the runs ----
#: what the fact of a posting holds (first write wins), kept beside the posting
LOADED = T.StructType([T.StructField("employer_sk", T.LongType()), T.StructField("area_id", T.LongType()),
                       T.StructField("published_date", T.DateType()), T.StructField("salary_from", SALARY_DEC),
                       T.StructField("salary_to", SALARY_DEC), T.StructField("salary_currency", S)])
#: what the runs keep of one posting
STAGE_KEPT = T.StructType([
    T.StructField("vacancy_id", T.LongType()), T.StructField("published_date", T.DateType()),
    T.StructField("area_id", T.LongType()), T.StructField("employer_id", T.LongType()),
    T.StructField("named", T.BooleanType()), T.StructField("loaded", LOADED),
    T.StructField("role_ids", T.ArrayType(S)), T.StructField("sphere_ids", T.ArrayType(S))])
#: the posting that names a dimension key; ``live``: some posting still does
_WINNER = [T.StructField("published_at", T.TimestampType()), T.StructField("vacancy_id", T.LongType()),
           T.StructField("live", T.BooleanType())]
AREA_STATE = T.StructType([*DIM_AREA.fields, *_WINNER])
ROLE_STATE = T.StructType([*DIM_ROLE.fields, *_WINNER])
POSTING_EMPLOYER = T.StructType([T.StructField("employer_id", T.LongType()), T.StructField("employer_name", S),
                                 T.StructField("alternate_url", S), T.StructField("trusted", T.BooleanType()), *_WINNER])
#: first and last publication day of the ODS (``edge``: ``first`` / ``last``)
DATE_EDGE = T.StructType([T.StructField("edge", S), T.StructField("published_date", T.DateType()),
                          T.StructField("rank", T.IntegerType()), T.StructField("vacancy_id", T.LongType()),
                          T.StructField("live", T.BooleanType())])
MART_PARTIALS = T.StructType([
    T.StructField("month", T.DateType()), T.StructField("industry_id", S), T.StructField("area_id", T.LongType()),
    T.StructField("currency", S), T.StructField("employer_sk", T.LongType()),
    T.StructField("vacancies_cnt", T.LongType()), T.StructField("vacancies_with_salary_cnt", T.LongType()),
    T.StructField("salary_sum", T.DecimalType(38, 3)),
    T.StructField("salary_min", T.DecimalType(22, 3)), T.StructField("salary_max", T.DecimalType(22, 3))])
#: counted by the writes of a run: documents, postings, facts
LOAD_METRICS = T.StructType([T.StructField(c, T.LongType()) for c in (
    "fetched", "rejected", "ods_added", "eligible_added", "fact_rows", "null_keys")])
FACT_DAYS = T.StructType([T.StructField("published_date", T.DateType()), T.StructField("fact_rows", T.LongType())])


def empty(spark, schema: T.StructType):
    """An empty typed DataFrame: the state of a table that does not exist yet.

    Made from an empty Arrow table, so that Spark knows it to be empty: no Python worker runs
    for it, and joins and unions with it are left out of the plan.
    """
    return spark.createDataFrame(to_arrow_schema(schema).empty_table(), schema)
