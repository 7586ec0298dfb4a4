"""Operator 1: mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key scaled by its quality weight; within a
source the keys are sorted and the sizes prefix-summed up to the token budget.
Whole epochs come first, the fractional epoch takes the documents with the
smallest keys and the boundary document up to the last word of the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hiremart.llm.frames import keep, running_total, small, word_count

#: Source weights, repeating in code point order of the sources.
WEIGHTS = (5, 2, 1)
#: Budget as a share of all sizes, and the most epochs of a source.
SHARE_NUM, SHARE_DEN, MAX_EPOCHS = 3, 2, 2


def uniform(*cols: str, seed: int = 17) -> Column:
    """A uniform draw in (0, 1) that depends only on the columns and the seed."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols])
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def label_weights(labels: DataFrame) -> DataFrame:
    """Quality weights of ``labels(doc_id, quality)``: 2 where any label says 1, 0.5 where all say 0."""
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("q")).select(
        "doc_id", F.when(F.col("q") == 1, F.lit(2.0)).when(F.col("q") == 0, F.lit(0.5)).alias("quality"))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_num: int = SHARE_NUM,
                   share_den: int = SHARE_DEN, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``source, source_size, n, target`` and, in whole words,
    ``epochs`` and ``rest`` (the target's floor is epochs * source_size + rest).

    The budget (``share_num/share_den`` of all sizes) is dealt by weight; sources are
    capped at ``max_epochs`` of their size and the excess dealt again until none is
    above.  Sorted by size/weight the capped sources are a prefix, so one running sum
    finds them.  The windows without partition run over one row per source (the
    configured corpora, not rows of data).
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]),
                     ((rank - 1) % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * max_epochs
    order = Window.orderBy((cap.cast("double") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # a source is capped if the budget left by those before it gives it its cap or more
    s = (per.withColumn("weight", w)
         .withColumn("total", F.sum("source_size").over(everything))
         .withColumn("left_num", F.expr(f"{share_num}L * total") - share_den * F.coalesce(F.sum(cap).over(before), F.lit(0)))
         .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
         .withColumn("capped", F.col("left_num") * F.col("weight") >= cap * share_den * F.col("left_weight"))
         .withColumn("free", F.min(F.when(~F.col("capped"), F.struct(
             (cap.cast("double") / F.col("weight")).alias("r"), F.col("left_num"), F.col("left_weight")))).over(everything)))
    num, den = F.col("free.left_num") * F.col("weight"), share_den * F.col("free.left_weight")
    floor = F.when(F.col("capped"), cap).otherwise(F.expr(f"free.left_num * weight div ({share_den} * free.left_weight)"))
    s = (s.withColumn("target", F.when(F.col("capped"), cap.cast("double")).otherwise(num.cast("double") / den.cast("double")))
         .withColumn("words", floor)
         .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0)).cast("long")))
    return s.select("source", "source_size", "target", "epochs",
                    (F.col("words") - F.col("epochs") * F.col("source_size")).cast("long").alias("rest"))


def mix(docs: DataFrame, quality: DataFrame | None = None, weights: tuple[int, ...] = WEIGHTS,
        share_num: int = SHARE_NUM, share_den: int = SHARE_DEN, max_epochs: int = MAX_EPOCHS,
        seed: int = 17) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for every row of ``docs(doc_id, text, source)``.

    ``quality(doc_id, quality)``, one positive weight per document (missing, null or not
    positive: 1), makes a document likelier to fall into the fractional epoch.  ``taken`` counts words with repeats and is at
    most ``max_epochs`` times the size; a source's taken words are its target's floor.
    The draw depends on doc_id, size and seed only, so reruns and retries agree;
    repeated rows draw the same key and are taken one after the other.  Null texts have
    size 0, null doc_ids and sources are values of their own; an empty table gives no rows.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        word_count(F.col("text")).alias("size"))
    sized = keep(sized.withColumn("u", uniform("doc_id", "size", seed=seed)), "sized")
    if quality is None:
        rated = sized.withColumn("quality", F.lit(1.0))
    else:
        q = quality.select("doc_id", F.col("quality").cast("double").alias("quality"))
        rated = sized.join(q, "doc_id", "left").withColumn(
            "quality", F.when(F.col("quality") > 0, F.col("quality")).otherwise(F.lit(1.0)))
    keyed = keep(rated.withColumn("key", -F.log(F.col("u")) / F.col("quality")), "keyed")
    targets = small(keep(source_targets(sized, weights, share_num, share_den, max_epochs), "targets"), 100_000)
    summed = running_total(keyed, ["source"], 1 - F.exp(-F.col("key")),
                           [F.col("key"), F.col("doc_id"), F.col("size")], "size", "before")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    return (summed.alias("d").join(targets.alias("t"), F.expr("d.source <=> t.source"))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"), "d.source"))


def apply_mix(docs: DataFrame, mixed: DataFrame, whole: bool = False) -> DataFrame:
    """The mixed corpus: a document as often as it is taken whole, and a source's
    boundary document once more with the first words of its last, partial taking.
    Documents taken 0 times (also those without words) go.  ``whole`` keeps the boundary
    document's last taking as it is in the source: a target is passed by less than a document.

    Rows of equal id, source and size share a key in ``mix()`` and are taken one after the
    other, so the sum of their takings is dealt to them in the order of their texts; null
    ids and sources are values of their own."""
    def named(id_, source):
        return [F.coalesce(id_, F.lit(0)).alias("_id"), id_.isNull().alias("_no_id"),
                F.coalesce(source, F.lit("")).alias("_source"), source.isNull().alias("_no_source")]

    same = ["_id", "_no_id", "_source", "_no_source", "_size"]
    taken = (mixed.select(*named(F.col("doc_id"), F.col("source")), F.col("size").alias("_size"), "taken").where("_size > 0")
             .groupBy(*same).agg(F.count(F.lit(1)).alias("_rows"), F.sum("taken").alias("_sum")).where("_sum > 0"))
    sized = docs.select(F.struct(*docs.columns).alias("_doc"),      # its columns may have any names
                        *named(F.col("doc_id").cast("long"), F.col("source").cast("string")), word_count(F.col("text")).alias("_size"))
    nth = F.row_number().over(Window.partitionBy(*same).orderBy(F.xxhash64("_doc.text"), "_doc.text"))
    rest = F.expr("_sum % (_rows * _size) - (_nth - 1L) * _size")
    full = (sized.where("_size > 0").withColumn("_nth", nth).join(taken, same)
            .withColumn("_taken", F.expr("_sum div (_rows * _size) * _size") + F.greatest(F.lit(0), F.least(F.col("_size"), rest)))
            .where("_taken > 0")
            .withColumn("_copy", F.expr("explode(sequence(1L, (_taken + _size - 1) div _size))")))
    columns = {c: F.col("_doc").getField(c) for c in docs.columns}
    if not whole:
        left = F.expr("least(_size, _taken - (_copy - 1) * _size)")
        cut = F.expr(r"array_join(slice(filter(split(_doc.text, '[\\x20\\x09-\\x0D]+'), w -> w <> ''), 1, "
                     r"int(_taken - (_copy - 1) * _size)), ' ')")
        columns["text"] = F.when(left < F.col("_size"), cut).otherwise(columns["text"])
    return full.select(*[v.alias(c) for c, v in columns.items()])
