"""Keyed writes expressed as DataFrame plans (K1-K9).

``MERGE INTO`` is not available on plain Parquet tables, so every keyed write
is *pick one row per key in the batch* (an aggregate with map-side partial
aggregation, so a key holding a third of the batch is reduced on every mapper
before the shuffle) followed by an anti-join against the target and a union.
The result is the complete new state of the table; ``hiremart.storage``
commits it as a new version.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiremart.constants import DOC_ID_SEPARATOR
from hiremart.operators.flatten import parse_raw, to_raw


#: Up to so many repeated keys of a batch are looked up beside its rows instead of shuffling these.
FEW_KEYS = 100_000


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def pick_per_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str] | str,
                 latest: bool = True) -> DataFrame:
    """One row per key: the row with the greatest (``latest``) or least ``order``.

    ``order`` must be a total order within a key (add a unique column as the
    last tiebreak).  NULL keys form one group, so composite keys are null-safe.
    Implemented as ``max``/``min`` of one struct, the order columns first, so that no column
    is carried twice (``max_by``/``min_by`` where a column has no order, as a map) — an
    aggregate that Spark partially evaluates before the shuffle (skew-safe).
    """
    keys, order = _cols(keys), _cols(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    ordering, payload = F.struct(*order), F.struct(*[c for c in df.columns if c not in keys])
    if all(_orderable(df.schema[c].dataType) for c in rest):
        # a key's own columns may be part of the order; equal places are told apart by the rest
        row = F.struct(*order, *rest)
        pick = F.max(row) if latest else F.min(row)
    else:
        pick = F.max_by(payload, ordering) if latest else F.min_by(payload, ordering)
    out = df.groupBy(*keys).agg(pick.alias("_row"))
    return out.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])


def pick_repeated(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str] | str,
                  commit: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of ``pick_per_key`` for wide rows: only keys that come more than once are shuffled
    with their rows, the others' rows stay where they are read.

    The repeated keys are found by counting and written by ``commit``, which reads them back;
    with more than ``FEW_KEYS`` of them all rows are picked by one shuffle.
    """
    keys = _cols(keys)
    again = commit(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys))
    repeated = again.count()
    if repeated == 0:
        return df
    if repeated > FEW_KEYS:
        return pick_per_key(df, keys, order)
    few = F.broadcast(again.select(*[F.col(k).alias(f"_r_{k}") for k in keys]))
    on = [df[k].eqNullSafe(few[f"_r_{k}"]) for k in keys]
    return df.join(few, on, "left_anti").unionByName(pick_per_key(df.join(few, on, "left_semi"), keys, order))


def _orderable(t: T.DataType) -> bool:
    """Whether Spark can compare values of a type (not maps, nor what holds one)."""
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    return isinstance(t, T.AtomicType) and not isinstance(t, T.VariantType)


def _key_match(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool) -> Column:
    conds = [(left[k].eqNullSafe(right[k]) if null_safe else left[k] == right[k]) for k in keys]
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    return cond


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str] | str,
           order: Sequence[str] | str, null_safe: bool = False,
           unique: bool = False) -> DataFrame:
    """Keyed upsert, last write wins (K1, K2, K4, K5, K9).

    Within the batch the row latest in ``order`` wins; a batch row replaces
    every non-key column of the target row with the same key; target rows
    whose key is not in the batch are kept; nothing is deleted; an empty batch
    leaves the target unchanged.  ``null_safe`` matches NULL key parts (a
    composite key with a NULL member still identifies one row).
    Order columns of the batch that the target lacks are dropped from the output.
    ``unique`` declares the batch already one row per key (skips the pick).
    """
    keys = _cols(keys)
    latest = (batch if unique else pick_per_key(batch, keys, order, latest=True)).select(*target.columns)
    if null_safe:
        b = latest.select(*keys).alias("_b")
        t = target.alias("_t")
        kept = t.join(b, _key_match(t, b, keys, True), "left_anti")
    else:
        kept = target.join(latest.select(*keys), keys, "left_anti")
    return kept.unionByName(latest)


def upsert_scd1(target: DataFrame, batch: DataFrame, keys: Sequence[str] | str,
                order: Sequence[str] | str) -> DataFrame:
    """Insert-or-update of a type-1 dimension (K9): latest attributes win."""
    return upsert(target, batch, keys, order)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str] | str,
                  order: Sequence[str] | str | None = None) -> DataFrame:
    """Insert-ignore (K8): rows whose key already exists are skipped.

    Within the batch the first row in ``order`` wins (arrival order); without
    ``order`` any one row per key is kept.  Returns only the rows to append.
    """
    keys = _cols(keys)
    if order is None:
        first = batch.dropDuplicates(keys)
    else:
        first = pick_per_key(batch, keys, order, latest=False)
    return first.select(*target.columns).join(target.select(*keys), keys, "left_anti")


def upsert_document(target: DataFrame, batch: DataFrame, id_col: str = "_id",
                    order: Sequence[str] | str = "_seq") -> DataFrame:
    """Replace-or-insert whole documents by id (K3): ``(id, raw)`` rows."""
    return upsert(target, batch, [id_col], order)


def composite_doc_key(df: DataFrame, id_cols: Sequence[str] = ("industry_id", "sphere_id"),
                      doc_schema=None, raw_col: str = "raw") -> DataFrame:
    """Add the document id ``"a:b"`` (NULL parts as ``''``) and embed the ids (K6).

    Returns ``(_id, <id_cols>, raw)`` where ``raw`` is the original document
    with the id columns added; an empty-string member is stored as NULL.
    """
    id_cols = list(id_cols)
    key = F.concat_ws(DOC_ID_SEPARATOR, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in id_cols])
    ids = [F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in id_cols]
    if doc_schema is not None:
        parsed = parse_raw(raw_col, doc_schema)
        doc = F.struct(*[parsed.getField(f).alias(f) for f in doc_schema.fieldNames()
                         if f not in id_cols and f != "_id"],
                       key.alias("_id"), *ids)
        raw = to_raw(doc)
    else:
        raw = F.col(raw_col)
    return df.select(key.alias("_id"), *ids, raw.alias("raw"))
