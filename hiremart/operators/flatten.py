"""Landing → ODS projections (P1-P5): flatten documents, keep the raw JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiremart import schemas
from hiremart.constants import ARRIVAL, CHILD_ARRAYS
from hiremart.functions.columns import naive_timestamp, parse_iso_timestamp


def to_raw(doc) -> Column:
    """Serialise a document struct to its JSON text (P5)."""
    doc = F.col(doc) if isinstance(doc, str) else doc
    return F.to_json(doc)


def parse_raw(raw, schema: T.StructType, strict: bool = True) -> Column:
    """Parse JSON text with a declared schema (P5).

    ``strict`` fails the job on malformed JSON (FAILFAST), like a ``::jsonb``
    cast; otherwise malformed text gives NULL fields.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    opts = {"mode": "FAILFAST"} if strict else {"mode": "PERMISSIVE"}
    return F.from_json(raw, schema, opts)


def _document(items: DataFrame, it: Column) -> Column:
    """The whole document: its landed text where the source kept it, else the struct's JSON."""
    return F.coalesce(F.col("_raw"), to_raw(it)) if "_raw" in items.columns else to_raw(it)


def arrival(df: DataFrame) -> list[str]:
    """The arrival-order columns that ``df`` has (all fetches of one source carry the same)."""
    return [c for c in ARRIVAL if c in df.columns]


def last_write(df: DataFrame) -> list[str]:
    """A total order of flattened documents: arrival, equal places by the document's text."""
    return [*arrival(df), "raw"]


def _keep(df: DataFrame, keep: Sequence[str] | None) -> list[Column]:
    return [F.col(c) for c in (arrival(df) if keep is None else keep)]


def flatten_postings(items: DataFrame, item_col: str = "item",
                     keep: Sequence[str] | None = None, naive: bool = False,
                     rejects: bool = False) -> DataFrame:
    """Vacancy documents → ODS postings.

    ``id`` becomes BIGINT; nested names are read null-safely (a missing
    ``area`` or ``employer`` gives NULL); ``published_at`` is parsed as an
    instant; the whole document is kept as ``raw``.  A document without an id
    cannot be keyed and is dropped here (count it with ``rejected_postings``), or kept
    with a NULL id if ``rejects`` (the caller counts and drops it).
    ``keep`` names the columns carried through for the upsert (default: the arrival order).  With
    ``naive`` the publication time is the wall clock with the offset dropped
    (TIMESTAMP_NTZ), the form a store without time zones keeps (K2).
    """
    it = F.col(item_col)
    published = (naive_timestamp(it.getField("published_at")) if naive
                 else parse_iso_timestamp(it.getField("published_at")))
    rows = items if rejects else items.filter(it.getField("id").isNotNull())
    return (rows
            .select(it.getField("id").cast("bigint").alias("id"),
                    *_names(it),
                    published.alias("published_at"),
                    _document(items, it).alias("raw"),
                    *_keep(items, keep)))


def _names(it: Column) -> list[Column]:
    return [it.getField("name").cast("string").alias("name"),
            it.getField("area").getField("name").alias("area_name"),
            it.getField("employer").getField("name").alias("employer_name")]


def typed_documents(items: DataFrame) -> DataFrame:
    """Vacancy documents without landed text as they are, beside the key and time that flattening
    parses of them: the form to write them in (``flatten_typed`` reads it)."""
    flat = flatten_postings(items, keep=["item", *arrival(items)], rejects=True)
    return flat.select("id", "published_at", "item", *arrival(items))


def flatten_typed(documents: DataFrame, parsed: bool = False) -> DataFrame:
    """``typed_documents`` as ``flatten_postings`` gives them (with rejects); with ``parsed`` also as
    ``_doc``, what parsing their text as ``POSTING_DOC`` gives, where it follows from the types."""
    it = F.col("item")
    doc = as_declared(it, documents.schema["item"].dataType, schemas.POSTING_DOC) if parsed else None
    return documents.select("id", *_names(it), "published_at", to_raw(it).alias("raw"), *arrival(documents),
                            *([] if doc is None else [doc.alias("_doc")]))


#: types whose text in JSON is their text as a string
_TEXT_TYPES = (T.StringType, T.BooleanType, T.IntegralType, T.DecimalType)


def as_declared(value: Column, have: T.DataType, want: T.DataType) -> Column | None:
    """``value`` of type ``have`` as the declared type ``want`` of leaves that are text: what its JSON
    text parses to, without making the text.  ``None`` where that cannot be told from the types."""
    if have.simpleString() == want.simpleString():
        return value
    if isinstance(want, T.StringType):
        return value.cast("string") if isinstance(have, _TEXT_TYPES) else None
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        if as_declared(F.lit(None), have.elementType, want.elementType) is None:
            return None
        return F.transform(value, lambda e: F.when(
            e.isNotNull(), as_declared(e, have.elementType, want.elementType)))
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        fields = []
        for f in want.fields:
            c = F.lit(None).cast(f.dataType) if f.name not in have.fieldNames() else as_declared(
                value.getField(f.name), have[f.name].dataType, f.dataType)
            if c is None:
                return None
            fields.append(c.alias(f.name))
        return F.struct(*fields)
    return None


def rejected_postings(items: DataFrame, item_col: str = "item") -> DataFrame:
    """One-row count of documents that ``flatten_postings`` drops (no id)."""
    return items.agg(F.count_if(F.col(item_col).getField("id").isNull())
                     .cast("long").alias("rejected"))


def flatten_employers(items: DataFrame, item_col: str = "item",
                      keep: Sequence[str] | None = None, rejects: bool = False) -> DataFrame:
    """Employer documents → ODS employers (P2); those without an id are dropped, or kept if ``rejects``."""
    it = F.col(item_col)
    rows = items if rejects else items.filter(it.getField("id").isNotNull())
    return (rows
            .select(it.getField("id").cast("bigint").alias("id"),
                    it.getField("name").cast("string").alias("name"),
                    it.getField("area").getField("name").alias("area_name"),
                    it.getField("open_vacancies").cast("int").alias("open_vacancies"),
                    it.getField("site_url").cast("string").alias("site_url"),
                    _document(items, it).alias("raw"),
                    *_keep(items, keep)))


def flatten_hierarchy(items: DataFrame, item_col: str = "item",
                      child_cols: Sequence[str] = CHILD_ARRAYS) -> DataFrame:
    """Two-level dictionary → one row per (parent, child).

    The child array is the first *non-empty* one of ``child_cols`` that the
    document has; a parent without children is kept once with NULL child
    fields and its own JSON as ``raw``.  Ids become text; a missing id stays
    NULL (never the text ``'None'``).
    """
    it = F.col(item_col)
    fields = set(items.schema[item_col].dataType.fieldNames())
    candidates = [F.when(F.size(it.getField(c)) > 0, it.getField(c))
                  for c in child_cols if c in fields]
    children = F.coalesce(*candidates) if candidates else F.lit(None)
    exploded = items.select(it.alias("_parent"), F.explode_outer(children).alias("_child"))
    parent, child = F.col("_parent"), F.col("_child")
    return exploded.select(
        parent.getField("id").cast("string").alias("industry_id"),
        parent.getField("name").cast("string").alias("industry_name"),
        child.getField("id").cast("string").alias("sphere_id"),
        child.getField("name").cast("string").alias("sphere_name"),
        F.coalesce(F.to_json(child), F.to_json(parent)).alias("raw"))
