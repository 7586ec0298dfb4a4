"""Operator 8 (DataFrame functions only): secret scans with corpus-wide ownership frequency.

Every whole text is searched for candidate secrets; each candidate value is hashed
and aggregated over the corpus by distinct repositories (documents) and owners
(sources).  Values that many owners hold are copied examples; a value of one owner
is a live-looking credential.  High-entropy tokens without a keyword count as spans
only when the corpus says that they are not widely copied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hiremart.llm.frames import keep, small

#: A value with this many distinct owners is a copied example.
EXAMPLE_OWNERS = 3
#: Fewest distinct characters of a keyword-less token.
BARE_DISTINCT = 12

KINDS = ("assign", "access", "hex", "bare")


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


#: The contract's patterns (fixed values); letters of ``assign`` in either case, spelt out
#: so that only A-Z and a-z match.  ``access`` and ``hex`` runs are maximal, so their least
#: length can stand in the pattern; a short ``assign`` match must still use up its text.
_KEYS = "|".join([*map(_any_case, ("password", "passwd", "secret", "token")), _any_case("api") + "_?" + _any_case("key")])
PATTERNS = {
    "assign": rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
    "bare": r"[A-Za-z0-9_-]{24,}",
}
LEAST_VALUE = 8


def _pattern(kind: str) -> Column:
    return F.lit(PATTERNS[kind])


def candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str, keyed: bool) -> DataFrame:
    """A written table, one row per row of ``docs``: row number, id, owner and, per kind,
    the matches with the length of the text before each (since the match before); ``keyed``: the text's hash."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    t = F.col("t")
    might = {"assign": t.contains("=") | t.contains(":"), "access": t.contains("AKIA")}
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(owner_col).cast("string").alias("owner"), text.alias("t"),
                       *([F.sha2(text.cast("binary"), 256).alias("text_sha256")] if keyed else []))
    none = F.array().cast("array<struct<gap:int,hit:string>>")
    for kind in KINDS:
        m = F.when(might.get(kind, F.lit(True)), F.regexp_extract_all("t", _pattern(kind), F.lit(0)))
        rows = rows.withColumn("m", F.coalesce(m, F.array().cast("array<string>")))
        gaps = F.split("t", PATTERNS[kind], -1)
        pairs = F.zip_with(F.transform(F.slice(gaps, 1, F.size("m")), F.length), "m",
                           lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
        rows = rows.withColumn(kind, F.when(F.size("m") > 0, pairs).otherwise(none))
    return keep(rows.drop("t", "m"), "secret_candidates")


def spans_of(found: DataFrame) -> DataFrame:
    """Every candidate of ``candidates()``: ``row, doc_id, owner, kind, k`` (the kind's place),
    ``start, end`` (code points) and the value's hash.  Positions are running sums over a
    text's matches, so a text with many matches costs no more than their number."""
    each = None
    for k, kind in enumerate(KINDS):
        part = found.where(F.size(kind) > 0).select(
            "row", "doc_id", "owner", F.lit(kind).alias("kind"), F.lit(k).alias("k"), F.posexplode(kind).alias("i", "c"))
        each = part if each is None else each.unionByName(part)
    w = Window.partitionBy("row", "k").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    each = (each.withColumn("end", F.sum(F.col("c.gap") + F.length("c.hit")).over(w).cast("long"))
            .withColumn("start", F.col("end") - F.length("c.hit")))
    value = F.when(F.col("k") == 0, F.regexp_extract("c.hit", PATTERNS["assign"], 2)).otherwise(F.col("c.hit"))
    each = each.withColumn("value", value).where(
        (F.col("k") != 0) | (F.length("value") >= LEAST_VALUE)).where(
        (F.col("k") != 3) | (F.col("value").rlike("[0-9]") & F.col("value").rlike("[a-z]") & F.col("value").rlike("[A-Z]")
                             & (F.size(F.array_distinct(F.split("value", ""))) >= BARE_DISTINCT)))
    # a keyword-less token that overlaps a base span adds nothing
    base_end = F.when(F.col("k") < 3, F.col("end"))
    base_start = F.when(F.col("k") < 3, F.col("start"))
    order = Window.partitionBy("row").orderBy("start", "k")
    each = (each.withColumn("_e", F.max(base_end).over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_s", F.min(base_start).over(order.rowsBetween(0, Window.unboundedFollowing)))
            .where("k < 3 OR (coalesce(_e, 0) <= start AND coalesce(_s, end) >= end)"))
    return each.select("row", "doc_id", "owner", "kind", "k", "start", "end", F.sha2("value", 256).alias("value_hash"))


def ownership(spans: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """Per value hash: distinct repositories and owners, and whether it is a copied example."""
    return (spans.groupBy("value_hash", "owner", "doc_id").agg(F.lit(1).alias("one"))
            .groupBy("value_hash", "owner").agg(F.count("one").alias("docs"))
            .groupBy("value_hash").agg(F.sum("docs").alias("repositories"), F.count(F.lit(1)).alias("owners"))
            .withColumn("example", F.col("owners") >= example_owners))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         example_owners: int = EXAMPLE_OWNERS, keyed: bool = True) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live,
    n_example`` and ``found``, the spans as structs ``start, k, end, kind, example``.

    ``spans``: base spans and the method's ``bare`` ones as ``kind:start:end`` by start,
    then kind as listed, comma-joined; code points, end exclusive.  ``n_live`` counts
    spans whose value one owner holds, ``n_example`` those of copied examples.  A null or
    empty text has none.  A null owner is one owner, a null id one repository; repeated
    rows each get their result and count as one repository.  ``keyed`` adds ``text_sha256``,
    by which ``redact()`` finds the text again.  Other columns are ignored.
    """
    found = candidates(docs, id_col, text_col, owner_col, keyed)
    key = ["text_sha256"] if keyed else []
    spans = keep(spans_of(found), "secret_spans")
    verdict = small(keep(ownership(spans, example_owners), "secret_owners"))
    judged = spans.join(verdict, "value_hash").where("k < 3 OR NOT example")
    one = F.struct("start", "k", "end", "kind", "example", (F.col("owners") == 1).alias("live"))
    per_row = judged.groupBy("row").agg(F.array_sort(F.collect_list(one)).alias("found"))
    rows = found.select("row", "doc_id", *key).join(per_row, "row", "left").withColumn(
        "found", F.coalesce("found", F.array().cast(
            "array<struct<start:bigint,k:int,end:bigint,kind:string,example:boolean,live:boolean>>")))
    text = "x -> concat(x.kind, ':', x.start, ':', x.end)"
    count = lambda cond: F.expr(f"cast(size(filter(found, x -> {cond})) AS long)")
    return rows.select(
        "doc_id", count("x.k = 0").alias("n_assign"), count("x.k = 1").alias("n_access"), count("x.k = 2").alias("n_hex"),
        F.expr(f"sha2(array_join(transform(filter(found, x -> x.k < 3), {text}), ','), 256)").alias("base_sha256"),
        F.expr(f"array_join(transform(found, {text}), ',')").alias("spans"),
        count("x.live").alias("n_live"), count("x.example").alias("n_example"), "found", *key)


def redact(docs: DataFrame, scanned: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark`` (overlapping spans by one mark).
    A text's spans depend on nothing but the text within one scan, so they are joined by its
    hash: null ids and ids of several texts do not matter.  Only texts with a span take part
    in the join's right side, all others pass unchanged."""
    cuts = scanned.where("size(found) > 0").dropDuplicates(["text_sha256"]).select(
        F.col("text_sha256").alias("_id"), F.explode("found").alias("x")).select("_id", "x.start", "x.end").distinct()
    w = Window.partitionBy("_id").orderBy("start", "end")
    seen = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    cuts = cuts.withColumn("first", F.when(F.coalesce(seen, F.lit(-1)) < F.col("start"), 1).otherwise(0))
    cuts = cuts.withColumn("island", F.sum("first").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    cuts = cuts.groupBy("_id", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cuts = keep(cuts.groupBy("_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_cuts")), "secret_cuts")
    pieces = F.expr("""transform(sequence(0, size(_cuts)), i -> substring(_doc.text,
        int(CASE WHEN i = 0 THEN 1 ELSE element_at(_cuts, i).end + 1 END),
        int(CASE WHEN i = size(_cuts) THEN length(_doc.text) ELSE _cuts[i].start END
            - CASE WHEN i = 0 THEN 0 ELSE element_at(_cuts, i).end END)))""")
    rows = docs.select(F.struct(*docs.columns).alias("_doc"))       # its columns may have any names
    hit = rows.join(small(cuts, 100_000), F.sha2(F.col("_doc.text").cast("string").cast("binary"), 256) == F.col("_id"), "left")
    text = F.when(F.col("_cuts").isNull(), F.col("_doc.text")).otherwise(F.array_join(pieces, mark))
    return hit.select(*[text.alias(c) if c == "text" else F.col("_doc").getField(c).alias(c) for c in docs.columns])
