"""Stand-in landing data built from the driver's TPC-H-shaped tables.

These functions only *shape* rows into the landing model (vacancy documents,
employer documents, the industry dictionary); they do none of the warehouse's
work.  Every later step runs through the library's operators and is correct
for any data of these schemas.

Mapping (one posting per order):

* posting id / name / date — ``o_orderkey`` / ``o_orderpriority`` / ``o_orderdate``
  published at 12:00 local time with a ``+0300``, ``-0500`` or ``Z`` offset;
* employer — the order's customer (absent for every 13th order key), with the
  posting-level ``trusted`` flag taken from the order status;
* area — the customer's nation (absent for every 11th order key);
* salary — ``o_totalprice`` and ``o_totalprice + c_acctbal`` as bounds, each
  absent for some keys, currency cycling over ``RUR``, ``USD``, ``''``, NULL;
* professional roles — the brands of the order's parts; specializations — the
  nations of the order's suppliers;
* employers feed — the customer table; industry dictionary — region → nation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiremart.constants import PAGE_SIZE

# Fixed values of the stand-in mapping.
CURRENCIES = ["RUR", "USD", "", None]          # by o_orderkey % 4
OFFSETS = ["+0300", "-0500", "Z"]              # by o_orderkey % 3
URL_PREFIX = "https://jobs.example.org/employer/"
#: Employers whose own site the feed names instead (every 7th key): the feed opens new versions of them.
MOVED_PREFIX, MOVED_EVERY = "https://sites.example.com/", 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _link_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order, as ``[{id, name}]`` (nested input): the distinct brands of its parts and the
    distinct nations of its suppliers.

    A line carries both links, so that it is dealt by order once, as it is: an aggregate on rows
    in no order of their key (as joins leave them) would only shuffle an array for each.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey").where("l_orderkey IS NOT NULL")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand").distinct().withColumn("_has_brand", F.lit(True))
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    sup, nat = sup.distinct(), nat.distinct().withColumn("_has_nation", F.lit(True))
    links = (li.join(part, li.l_partkey == part.p_partkey, "left").join(sup, li.l_suppkey == sup.s_suppkey, "left")
             .select("l_orderkey", "_has_brand", "p_brand", "s_nationkey").repartition("l_orderkey")
             .join(nat, F.col("s_nationkey") == F.col("n_nationkey"), "left"))
    brand = F.when(F.col("_has_brand"), F.struct("p_brand"))
    nation = F.when(F.col("_has_nation"), F.struct("s_nationkey", "n_name"))
    role = lambda e: F.struct(F.regexp_extract(e["p_brand"], r"#(\d+)", 1).alias("id"),
                              e["p_brand"].alias("name"))
    spec = lambda e: F.struct(e["s_nationkey"].cast("string").alias("id"), e["n_name"].alias("name"))
    some = lambda a, f: F.when(F.size(a) > 0, F.array_sort(F.transform(a, f)))
    return (links.groupBy("l_orderkey").agg(F.collect_set(brand).alias("_b"), F.collect_set(nation).alias("_n"))
            .select("l_orderkey", some("_b", role).alias("professional_roles"), some("_n", spec).alias("specializations")))


def posting_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vacancy documents ``(_page, _pos, item)``; ``item`` is a typed struct.

    ``(_page, _pos)`` is the arrival order of the search result.
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("o_orderkey")
    base = (o.join(c, o.o_custkey == c.c_custkey, "left")
            .join(_link_arrays(spark, sf_dir), k == F.col("l_orderkey"), "left")
            .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left"))
    dec = T.DecimalType(18, 2)
    currency = F.element_at(F.array(*[F.lit(x).cast("string") for x in CURRENCIES]),
                            (F.pmod(k, F.lit(4)) + 1).cast("int"))
    offset = F.element_at(F.array(*[F.lit(x) for x in OFFSETS]),
                          (F.pmod(k, F.lit(3)) + 1).cast("int"))
    area = F.when(F.pmod(k, F.lit(11)) == 0, F.lit(None)).otherwise(
        F.struct(F.col("c_nationkey").cast("string").alias("id"), F.col("n_name").alias("name")))
    employer = F.when((F.pmod(k, F.lit(13)) == 0) | F.col("c_custkey").isNull(), F.lit(None)).otherwise(
        F.struct(F.col("c_custkey").cast("string").alias("id"),
                 F.col("c_name").alias("name"),
                 F.concat(F.lit(URL_PREFIX), F.col("c_custkey").cast("string")).alias("alternate_url"),
                 (F.col("o_orderstatus") == "F").alias("trusted")))
    salary = F.struct(
        F.when(F.pmod(k, F.lit(5)) == 0, F.lit(None)).otherwise(F.col("o_totalprice").cast(dec)).alias("from"),
        F.when(F.pmod(k, F.lit(3)) == 0, F.lit(None)).otherwise(
            F.col("o_totalprice").cast(dec) + F.col("c_acctbal").cast(dec)).cast(dec).alias("to"),
        currency.alias("currency"),
        (F.col("o_orderpriority") == "1-URGENT").alias("gross"))
    published = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T12:00:00"), offset)
    item = F.struct(
        k.cast("string").alias("id"),
        F.col("o_orderpriority").alias("name"),
        area.alias("area"),
        employer.alias("employer"),
        published.alias("published_at"),
        salary.alias("salary"),
        F.col("professional_roles"),
        F.col("specializations"))
    return base.select(F.floor(k / PAGE_SIZE).alias("_page"),
                       F.pmod(k, F.lit(PAGE_SIZE)).cast("int").alias("_pos"),
                       item.alias("item"))


def posting_pages(spark: SparkSession, sf_dir: str, items: DataFrame | None = None) -> DataFrame:
    """Search pages ``{page, items[]}`` with at most PAGE_SIZE items each."""
    items = posting_items(spark, sf_dir) if items is None else items
    return pages_of(items)


def pages_of(items: DataFrame) -> DataFrame:
    """Group ``(_page, _pos, item)`` documents into page documents, items in order."""
    return (items.groupBy("_page")
            .agg(F.array_sort(F.collect_list(F.struct("_pos", "item"))).alias("_items"))
            .select(F.col("_page").alias("page"), F.col("_items.item").alias("items")))


def employer_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employer documents ``(_page, _pos, item)`` from the customer table."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    item = F.struct(
        k.cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.struct(F.col("c_nationkey").cast("string").alias("id"), F.col("n_name").alias("name")).alias("area"),
        F.pmod(F.abs(F.col("c_acctbal")).cast("long"), F.lit(100)).cast("int").alias("open_vacancies"),
        F.concat(F.when(F.pmod(k, F.lit(MOVED_EVERY)) == 0, F.lit(MOVED_PREFIX)).otherwise(F.lit(URL_PREFIX)),
                 k.cast("string")).alias("site_url"))
    return (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(F.floor(k / PAGE_SIZE).alias("_page"),
                    F.pmod(k, F.lit(PAGE_SIZE)).cast("int").alias("_pos"),
                    item.alias("item")))


def industry_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two-level dictionary: one document per region with its nations."""
    r = table(spark, sf_dir, "region")
    n = table(spark, sf_dir, "nation")
    children = (n.groupBy("n_regionkey")
                .agg(F.array_sort(F.collect_list(F.struct(
                    F.col("n_nationkey").cast("string").alias("id"),
                    F.col("n_name").alias("name")))).alias("industries")))
    return (r.join(children, r.r_regionkey == children.n_regionkey, "left")
            .select(F.struct(F.col("r_regionkey").cast("string").alias("id"),
                             F.col("r_name").alias("name"),
                             F.col("industries")).alias("item")))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
