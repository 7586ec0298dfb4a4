"""Change propagation: what one batch of upserted postings does to the DDS.

A *change set* pairs every posting a batch wrote with the parsed row it replaced.
Everything downstream is derived from it: which dimension keys got or lost their
latest posting (``winners``), which bridge rows are new, which postings may become
facts.  The whole ODS is read again only for keys whose latest posting moved away
or back in time, and then only for those keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiremart.functions.columns import empty_to_null


def change_set(new: DataFrame, old: DataFrame | None, key: str = "vacancy_id") -> DataFrame:
    """``(key, new, old)``: each written row (one per key) as a struct beside the row it
    replaces; ``old`` is NULL for a key the table did not hold."""
    written = F.struct(*new.columns).alias("new")
    if old is None:
        n = new.select(key, written)
        return n.withColumn("old", F.lit(None).cast(n.schema["new"].dataType))
    # joined flat and as text, made structs of arrays afterwards: the rows are shuffled on both sides
    lists, were = id_lists(new), id_lists(old)
    o = with_text(old, were).select(key, *[F.col(c).alias(f"_old_{c}") for c in old.columns if c != key],
                                    F.lit(True).alias("_had"))
    both = with_lists(with_text(new, lists).join(o, key, "left"), [*lists, *[f"_old_{c}" for c in were]])
    replaced = F.struct(*[F.col(c if c == key else f"_old_{c}").alias(c) for c in old.columns])
    return both.select(key, written, F.when(F.col("_had"), replaced).alias("old"))


def narrowed(change: DataFrame) -> DataFrame:
    """A change set as it is written: a field of the replaced row that equals the written row's is NULL
    there and marked in ``same``, so what a document keeps is not stored twice (``was`` reads it)."""
    shared = _shared(change)
    equal = F.struct(*[_at("old", p).eqNullSafe(_at("new", p[-1:])).alias("_".join(p)) for p in shared])
    left = _rebuilt(change.schema["old"].dataType, lambda p: F.when(
        ~_at("old", p).eqNullSafe(_at("new", p[-1:])), _at("old", p)) if p in shared else _at("old", p))
    had = F.col("old").isNotNull()
    return change.withColumns({"old": F.when(had, left), "same": F.when(had, equal)})


def was(written: DataFrame, name: str) -> Column:
    """A field of the replaced row of a ``narrowed`` change set (NULL without one)."""
    shared = _shared(written)
    field = lambda p: F.when(_at("same", ("_".join(p),)), _at("new", p[-1:])).otherwise(
        _at("old", p)) if p in shared else _at("old", p)
    t = written.schema["old"].dataType[name].dataType
    if (name,) in shared or not isinstance(t, T.StructType):
        return field((name,))
    return F.when(_at("old", (name,)).isNotNull(), _rebuilt(t, field, (name,)))


def replaced(written: DataFrame) -> DataFrame:
    """The replaced rows of a ``narrowed`` change set."""
    names = written.schema["old"].dataType.fieldNames()
    return written.where(F.col("old").isNotNull()).select(*[was(written, c).alias(c) for c in names])


def _shared(change: DataFrame) -> list[tuple[str, ...]]:
    """Paths of the fields of ``old``, its structs' fields too, that ``new`` has by name and type."""
    new = {f.name: f.dataType.simpleString() for f in change.schema["new"].dataType.fields}

    def paths(t: T.StructType, at: tuple[str, ...]):
        for f in t.fields:
            if new.get(f.name) == f.dataType.simpleString():
                yield (*at, f.name)
            elif isinstance(f.dataType, T.StructType):
                yield from paths(f.dataType, (*at, f.name))
    return list(paths(change.schema["old"].dataType, ()))


def _at(side: str, path: Sequence[str]) -> Column:
    c = F.col(side)
    for name in path:
        c = c.getField(name)
    return c


def _rebuilt(t: T.StructType, field: Callable[[tuple[str, ...]], Column], at: tuple[str, ...] = ()) -> Column:
    """A struct of type ``t`` whose fields are ``field(path)``; a NULL struct within ``old`` stays NULL."""
    def one(f: T.StructField) -> Column:
        p = (*at, f.name)
        if isinstance(f.dataType, T.StructType):
            return F.when(_at("old", p).isNotNull(), _rebuilt(f.dataType, field, p))
        return field(p)
    return F.struct(*[one(f).alias(f.name) for f in t.fields])


def id_lists(df: DataFrame) -> list[str]:
    """The columns of ``df`` that are lists of text."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.ArrayType) and f.dataType.elementType == T.StringType()]


def with_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with its lists of text as text, a tenth of the bytes in a shuffled row: the elements with
    commas between, as JSON where that could not be read back (``[`` tells them apart)."""
    def text(c: str) -> Column:
        joined = F.array_join(c, ",")
        other = F.exists(c, lambda e: e.isNull() | e.contains(",")) | (F.size(c) == 0) | joined.startswith("[")
        return F.when(other, F.to_json(c)).otherwise(joined)
    return df.withColumns({c: text(c) for c in columns})


def with_lists(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with the lists that ``with_text`` made text of."""
    return df.withColumns({c: F.when(F.col(c).startswith("["), F.from_json(c, "array<string>", {"mode": "FAILFAST"}))
                           .otherwise(F.split(c, ",")) for c in columns})


def side(changes: DataFrame, name: str) -> DataFrame:
    """The rows of one side (``new`` or ``old``) of a change set."""
    return changes.where(F.col(name).isNotNull()).select(f"{name}.*")


def array_ids(array: str | Column) -> Column:
    """The distinct non-empty ids of a ``[{id, …}]`` array (absent: none), as text."""
    a = F.col(array) if isinstance(array, str) else array
    ids = F.transform(a, lambda e: empty_to_null(e.getField("id")).cast("string"))
    return F.coalesce(F.array_distinct(F.filter(ids, lambda x: x.isNotNull())), F.array().cast("array<string>"))


def winners(state: DataFrame, changes: DataFrame, contribute: Callable[[DataFrame], DataFrame],
            keys: Sequence[str], order: Sequence[str], rest: Callable[[], DataFrame],
            commit: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Maintain the greatest contribution of every key under an upserted batch.

    ``contribute`` maps posting rows to ``(keys, payload, order)`` rows, ``order`` being total
    within a key and holding ``vacancy_id``.  ``state`` has one such row per key and
    ``live`` (false once no posting contributes to the key; its payload stays).  A key is
    affected if a changed posting contributes to it now or did before.  Its winner is
    the greatest of the batch's new contributions and the kept winner; only if the kept
    winner belonged to a changed posting and nothing in the batch reaches it, the key is
    searched anew among ``rest()``, the postings that the batch did not touch.

    Returns the new state and the affected keys' rows (both lazy; ``commit`` writes
    a step and reads it back).
    """
    keys, order = list(keys), list(order)
    columns = state.columns
    payload = [c for c in columns if c not in keys]
    candidate = contribute(side(changes, "new")).withColumn("live", F.lit(True)).select(*columns)
    affected = (candidate.select(*keys)
                .unionByName(contribute(side(changes, "old")).select(*keys)).distinct())
    # of the written ids only those of winners: a small state is broadcast, not the ids shuffled
    touched = (side(changes, "new").select("vacancy_id").join(state.select("vacancy_id"), "vacancy_id", "left_semi")
               .withColumn("_touched", F.lit(True)))
    kept = (state.join(affected, keys, "left_semi").join(touched, "vacancy_id", "left")
            .select(*columns, F.coalesce("_touched", F.lit(False)).alias("_stale")))

    def greatest(rows: DataFrame) -> DataFrame:
        # one struct, the order first: no column is carried twice
        rest = [c for c in payload if c not in order and c != "live"]
        row = F.max(F.struct("live", *order, (~F.col("_stale")).alias("_kept"), *rest)).alias("_w")
        return rows.groupBy(*keys).agg(row).select(*keys, *[f"_w.{c}" for c in payload], (~F.col("_w._kept")).alias("_stale"))

    picked = commit(greatest(kept.unionByName(candidate.withColumn("_stale", F.lit(False)))))
    won = picked.where(~F.col("_stale") | ~F.col("live")).drop("_stale")
    lost = picked.where(F.col("_stale") & F.col("live"))
    if lost.isEmpty():
        fresh = won
    else:       # only the keys whose winner moved away: searched among the postings left
        others = contribute(rest()).join(lost.select(*keys), keys, "left_semi").withColumn("live", F.lit(True))
        again = candidate.join(lost.select(*keys), keys, "left_semi").unionByName(others.select(*columns))
        gone = lost.withColumn("live", F.lit(False)).select(*columns)
        fresh = won.unionByName(commit(greatest(again.unionByName(gone).withColumn("_stale", F.lit(False)))
                                       .drop("_stale")))
    # the written picks hold every affected key that the state has
    return state.join(picked.select(*keys), keys, "left_anti").unionByName(fresh.select(*columns)), fresh.select(*columns)
