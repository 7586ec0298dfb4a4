"""Operator 3: n-gram Jaccard join by grouped prefix join.

Texts become sets of 64-bit word-shingle hashes.  Equal sets collapse to one
representative; cheap leader rounds on minimum hashes link most near copies
first; then representatives with the same size and the same prefix (their
rarest shingles in one global order) collapse into groups, group pairs pass the
prefix, size, position and parity-bitmap filters (all exact bounds), and only
members not yet in one component are expanded and verified exactly.  Within a component no pair is emitted
twice, so thousands of near copies cost a star, not a square.

The global order puts shingles held by many unlinked sets last and orders the
rest by hash; any global order gives the same links, this one keeps common
passages out of the prefixes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hiremart.llm import textarrays as T
from hiremart.llm.frames import components, keep, prepare, small

#: Minimum-hash rounds that link near copies before the prefix join.
ROUNDS = 3
#: A shingle in the low hashes of more than this many unlinked sets goes last in the global order.
COMMON = 100

#: Broadcast the common shingles, and the lists of them, below this many in all (8 bytes each).
HELD = 4_000_000
#: Longs of the parity bitmap: bit h(t) of a set is the parity of its shingles t there, so the
#: set bits of x ^ y never exceed the size of the symmetric difference.
BITS = 8

_SALTS = [np.uint64(x) for x in (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A35)]


def _prefix_len(n, num: int, den: int):
    """Probe prefix: n - ceil(t n) + 1."""
    return n - (n * num + den - 1) // den + 1


def shingle_hashes(data: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes (signed 64 bit) of a chunk's lower-cased texts and the text of each;
    a text of fewer words is one shingle of all its words."""
    data = T.LOWER[data]
    s, e, doc = T.words(data, off)
    h = T.span_hashes(data, s, e)
    w = T.window_hashes(h, width)
    whole = doc[:len(w)] == doc[width - 1:] if len(w) else np.zeros(0, bool)
    start = T.bounds(doc, len(off) - 1)
    counts = np.diff(start)
    extra_h, extra_d = [], []
    for d in np.flatnonzero((counts > 0) & (counts < width)):
        extra_h.append(T.window_hashes(h[start[d]:start[d + 1]], int(counts[d]))[0])
        extra_d.append(d)
    hs = np.concatenate([w[whole], np.array(extra_h, np.uint64)]).view(np.int64)
    ds = np.concatenate([doc[:len(w)][whole], np.array(extra_d, np.int64)])
    if extra_d:
        order = np.argsort(ds, kind="stable")
        hs, ds = hs[order], ds[order]
    return hs, ds


#: Texts with more shingles than this also have a wide bitmap of about one bit a shingle.
WIDE = 1024


def _parity(x: np.ndarray, longs: int = BITS) -> np.ndarray:
    odd = np.bincount(x & (64 * longs - 1), minlength=64 * longs) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _close(a: str, b: str, num: int, den: int) -> str:
    """SQL: the bitmaps allow the symmetric difference that a linked pair has at most
    (true where a bitmap is null)."""
    apart = " + ".join(f"bit_count({a}.bits[{k}] ^ {b}.bits[{k}])" for k in range(BITS))
    return f"coalesce(({apart}) * {num + den}L <= ({a}.n + {b}.n) * {den - num}L, true)"


def _screen(pairs: DataFrame, reps: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs that the wide bitmaps allow (those without one pass); the wider bitmap is
    folded, as bit i and bit i + half meet at i when a bitmap is halved."""
    wide = reps.select("rep", "n", "wide").distinct()
    fold = "transform(sequence(0, size({0}) div 2 - 1), i -> {0}[i] ^ {0}[i + size({0}) div 2])"
    pick = "CASE WHEN size({0}) > size({1}) THEN " + fold + " ELSE {0} END"
    both = (pairs.join(wide.selectExpr("rep AS a", "n AS na", "wide AS wa"), "a")
            .join(wide.selectExpr("rep AS b", "n AS nb", "wide AS wb"), "b"))
    apart = (f"aggregate(zip_with({pick.format('wa', 'wb')}, {pick.format('wb', 'wa')}, "
             "(p, q) -> bit_count(p ^ q)), 0, (s, v) -> s + v)")
    ok = f"CASE WHEN size(wa) = 0 OR size(wb) = 0 THEN true ELSE {apart} * {num + den}L <= (na + nb) * {den - num}L END"
    return keep(both.where(ok).select("a", "b"), "screened")


def _sets(col: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text of a column, in order."""
    for _, _, data, off in T.chunks(col):
        h, d = shingle_hashes(data, off, width)
        cut = T.bounds(d, len(off) - 1)
        for k in range(len(off) - 1):
            yield np.unique(h[cut[k]:cut[k + 1]])


def describe_sets(docs: DataFrame, width: int, num: int, den: int, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: set size, 128-bit set digest, minimum hashes, the
    parity bitmap, and the lowest hashes (a prefix and a quarter of them, ascending)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                        ("mins", pa.list_(pa.int64())), ("low", pa.list_(pa.int64())),
                        ("bits", pa.list_(pa.int64())), ("wide", pa.list_(pa.int64()))])

    @T.tidy
    def run(batches):
        for b in batches:
            n, d1, d2, mins, low, lows, bits, wide = [], [], [], [], [], [], [], []
            for x in _sets(b.column(1), width):
                n.append(len(x))
                bits.append(_parity(x))
                wide.append(_parity(x, 1 << (len(x) // 64).bit_length()) if len(x) > WIDE else x[:0])
                a, c = np.frombuffer(hashlib.blake2b(x.tobytes(), digest_size=16).digest(), np.int64)
                d1.append(a)
                d2.append(c)
                if len(x):
                    u = x.view(np.uint64)
                    mins += [x[0], *(T.mix(u ^ s).min().view(np.int64) for s in _SALTS)]
                    keep_n = min(len(x), _prefix_len(len(x), num, den) * 5 // 4 + 2)
                    low.append(x[:keep_n])
                    lows.append(keep_n)
                else:
                    lows.append(0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 T.lists(np.array(mins, np.int64), [ROUNDS if k else 0 for k in n]),
                 T.lists(np.concatenate(low) if low else np.zeros(0, np.int64), lows),
                 T.lists(np.concatenate(bits) if bits else np.zeros(0, np.int64), [BITS] * len(n)),
                 T.lists(np.concatenate(wide) if wide else np.zeros(0, np.int64), [len(w) for w in wide])], schema=schema)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, n long, d1 long, d2 long, mins array<long>, low array<long>, bits array<long>, wide array<long>")


def _full_sets(docs: DataFrame, ids: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, tokens)``: the whole sets of the documents named in ``ids(id)``, made again from their texts."""
    schema = pa.schema([("id", pa.int64()), ("tokens", pa.list_(pa.int64()))])

    @T.tidy
    def run(batches):
        for b in batches:
            xs = list(_sets(b.column(1), width))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), T.lists(np.concatenate(xs) if xs else np.zeros(0, np.int64),
                                      [len(x) for x in xs])], schema=schema)

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(small(ids), "id", "left_semi").mapInArrow(run, "id long, tokens array<long>")


def _listed_prefixes(docs: DataFrame, ids: DataFrame, common: DataFrame, width: int, num: int, den: int,
                     id_col: str, text_col: str) -> DataFrame:
    """``(rep, n, prefix)`` of the documents named in ``ids(id)``: their shingles by hash, common ones
    last.  ``common`` goes to every worker; the caller has counted it."""
    listed = np.sort(common.toPandas()["tok"].to_numpy(np.int64))
    shared = docs.sparkSession.sparkContext.broadcast(listed)
    schema = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("prefix", pa.list_(pa.int64()))])

    @T.tidy
    def run(batches):
        last = shared.value
        for b in batches:
            n, prefix = [], [np.zeros(0, np.int64)]
            for x in _sets(b.column(1), width):
                late = last[np.minimum(np.searchsorted(last, x), len(last) - 1)] == x
                n.append(len(x))
                prefix.append(np.concatenate([x[~late], x[late]])[:_prefix_len(len(x), num, den)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()),
                                              T.lists(np.concatenate(prefix), [len(x) for x in prefix[1:]])], schema=schema)

    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).cast("string").alias("text"))
    return texts.join(small(ids.withColumnRenamed("id", "rep")), "rep", "left_semi").mapInArrow(
        run, "rep long, n long, prefix array<long>")


def verify_pairs(docs: DataFrame, pairs: DataFrame, width: int, num: int, den: int,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pairs ``(a, b)`` of a written table whose whole sets reach the threshold (a written table)."""
    ids = keep(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "pair_ids")
    sets = keep(_full_sets(docs, ids, width, id_col, text_col), "pair_sets")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    @T.tidy
    def run(batches):
        for b in batches:
            (xo, xv), (yo, yv) = ((c.offsets.to_numpy(), c.values.to_numpy()) for c in (b.column(2), b.column(3)))
            ok = []
            for k in range(b.num_rows):
                x, y = xv[xo[k]:xo[k + 1]], yv[yo[k]:yo[k + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(den * both >= num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], schema=schema).filter(pa.array(ok, pa.bool_()))

    joined = (pairs.join(sets.withColumnRenamed("id", "a").withColumnRenamed("tokens", "x"), "a")
              .join(sets.withColumnRenamed("id", "b").withColumnRenamed("tokens", "y"), "b")
              .select("a", "b", "x", "y"))
    return keep(joined.mapInArrow(run, "a long, b long"), "links")


def jaccard_components(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs``.

    Two documents link when ``den * |A & B| >= num * |A | B|``; ``component_id`` is
    the smallest id reachable by links.  Documents without words (or text) have
    size 0 and link with nothing.  Rows that repeat an id are one document (linked
    if any of its texts is); rows with a null id get a null component and link with
    nothing.  Other columns of ``docs`` are ignored.  An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    t = f"{num}L", f"{den}L"
    sets = keep(describe_sets(docs, width, num, den, id_col, text_col), "sets")
    key = ["n", "d1", "d2"]
    full = sets.where("n > 0 AND doc_id IS NOT NULL")
    named = keep(full.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("other")), "named")
    # a set's representative stays, other rows of that set go (other sets of their ids stay)
    copied = small(named.where("rep < other").drop("other"))
    reps = (full.join(copied, key, "left").where("rep IS NULL OR rep = doc_id").drop("rep")
            .withColumnRenamed("doc_id", "rep"))
    # an id with several sets links their representatives
    several = keep(full.groupBy("doc_id").agg(F.min(F.struct(*key)).alias("lo"), F.max(F.struct(*key)).alias("hi"))
                   .where("lo <> hi").select("doc_id"), "several_sets")
    if several.isEmpty():
        same_id = None
    else:
        of_id = (full.select("doc_id", *key).join(small(several), "doc_id", "left_semi")
                 .join(named.select(*key, "rep"), key).select("doc_id", "rep").distinct())
        same_id = keep(of_id.join(of_id.groupBy("doc_id").agg(F.min("rep").alias("a")), "doc_id")
                       .where("a <> rep").select("a", F.col("rep").alias("b")).distinct(), "same_id")

    # leader rounds: one row per representative and minimum hash, checked against the bucket's leader
    size_class = F.floor(F.log(F.col("n").cast("double")) / math.log(den / num)) if num < den else F.col("n")
    mins = reps.select("rep", "n", "bits", size_class.alias("c"), F.posexplode("mins").alias("k", "h"))
    leaders = (mins.groupBy("k", "h", "c").agg(F.min(F.struct("rep", "n", "bits")).alias("lead"), F.max("rep").alias("other"))
               .where("lead.rep < other").select("k", "h", "c", "lead.*"))
    near = (mins.alias("x").join(leaders.alias("y"), (F.expr(
        "x.k = y.k AND x.h = y.h AND x.c = y.c AND x.rep <> y.rep AND " + _close("x", "y", num, den))))
        .select(F.col("y.rep").alias("a"), F.col("x.rep").alias("b")).distinct())
    near = _screen(keep(near, "near_pairs"), reps, num, den)
    links = verify_pairs(docs, near, width, num, den, id_col, text_col)
    if same_id is not None:
        links = links.union(same_id)
    label = components(links).select(F.col("node").alias("rep"), F.col("root").alias("comp"))
    rows = reps.join(small(label), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))

    # shingles common among unlinked sets go last in the global order
    common = keep(rows.where("rep = comp").select(F.explode("low").alias("tok")).groupBy("tok").count()
                  .where(F.col("count") > COMMON).select("tok"), "common")
    plen = f"int(n - (n * {t[0]} + {t[1]} - 1L) div {t[1]} + 1)"
    if common.isEmpty():
        final = rows.select("rep", "n", "bits", "comp", F.expr(f"slice(low, 1, {plen})").alias("prefix"))
    else:
        held = keep(rows.select("rep", F.explode("low").alias("tok")).join(small(common), "tok")
                    .groupBy("rep").agg(F.array_sort(F.collect_set("tok")).alias("held")), "held")
        tokens_held = held.agg(F.sum(F.size("held"))).first()[0] or 0
        both = rows.join(F.broadcast(held) if tokens_held <= HELD else held, "rep", "left")
        both = both.withColumn("rare", F.expr("CASE WHEN held IS NULL THEN low ELSE array_except(low, held) END"))
        short = F.expr(f"held IS NOT NULL AND size(rare) < {plen} AND n > size(low)")
        done = both.where(~F.coalesce(short, F.lit(False))).select("rep", "n", "bits", "comp", F.expr(
            f"slice(CASE WHEN held IS NULL THEN low ELSE concat(rare, held) END, 1, {plen})").alias("prefix"))
        rest = keep(both.where(short).select("rep", "n", "bits", "comp"), "short")
        ids = rest.select(F.col("rep").alias("id")).distinct()
        if common.count() <= HELD:
            redone = (_listed_prefixes(docs, ids, common, width, num, den, id_col, text_col).distinct()
                      .join(small(rest), ["rep", "n"]).select("rep", "n", "bits", "comp", "prefix"))
        else:
            tokens = _full_sets(docs, ids, width, id_col, text_col)
            ranked = (tokens.select(F.col("id").alias("rep"), F.explode("tokens").alias("tok")).distinct()
                      .join(small(common.withColumn("last", F.lit(1))), "tok", "left")
                      .withColumn("k", F.row_number().over(
                          Window.partitionBy("rep").orderBy(F.coalesce("last", F.lit(0)), "tok"))))
            redone = (ranked.join(small(rest), "rep").where(F.expr(f"k <= {plen}"))
                      .groupBy("rep", "n", "bits", "comp").agg(F.array_sort(F.collect_list(F.struct("k", "tok"))).alias("p"))
                      .select("rep", "n", "bits", "comp", F.col("p.tok").alias("prefix")))
        final = done.unionByName(redone)

    # group by size and prefix; filter group pairs
    final = final.withColumn("k1", F.xxhash64("n", "prefix")).withColumn("k2", F.xxhash64(F.lit(7), "prefix", "n"))
    groups = keep(final.groupBy("n", "k1", "k2").agg(
        F.min("rep").alias("gid"), F.max("rep").alias("last"), F.first("bits").alias("bits"), F.first("prefix").alias("prefix"), F.min("comp").alias("c0"),
        F.max("comp").alias("c1")), "groups")
    entries = groups.select("gid", "n", F.expr("CASE WHEN gid = last THEN bits END AS bits"), "c0", "c1", F.posexplode("prefix").alias("pos", "tok"))
    live = keep(entries.groupBy("tok").agg(F.min("c0").alias("lo"), F.max("c1").alias("hi"))
                .where("lo < hi").select("tok"), "live")
    e = keep(entries.join(small(live), "tok"), "live_entries")
    pairs = (e.alias("x").join(e.alias("y"), F.expr(f"""
        x.tok = y.tok
        AND (x.n < y.n OR (x.n = y.n AND (x.gid < y.gid OR (x.gid = y.gid AND x.pos = 0 AND x.c0 < x.c1))))
        AND y.n * {t[0]} <= x.n * {t[1]}
        AND x.pos <= x.n - (2L * {t[0]} * x.n + {num + den}L - 1L) div {num + den}L
        AND least(x.n - x.pos, y.n - y.pos) * {num + den}L >= (x.n + y.n) * {t[0]}
        AND NOT (x.c0 = x.c1 AND y.c0 = y.c1 AND x.c0 = y.c0)
        AND {_close("x", "y", num, den)}"""))
        .select(F.col("x.gid").alias("g"), F.col("y.gid").alias("h")).distinct())
    pairs = keep(pairs, "group_pairs")
    if pairs.isEmpty():
        all_links = links
    else:
        hits = small(keep(pairs.select("g").union(pairs.select("h")).distinct(), "group_ids"))
        members = groups.select("n", "k1", "k2", F.col("gid").alias("g")).join(hits, "g", "left_semi")
        members = keep(final.join(members, ["n", "k1", "k2"]).select("g", "rep", "n", "bits", "comp"), "members")
        x = pairs.join(members, "g").withColumnRenamed("h", "other")
        cand = (x.alias("x").join(members.alias("y"), F.expr(
            "x.other = y.g AND x.comp <> y.comp AND " + _close("x", "y", num, den)))
            .select(F.expr("least(x.rep, y.rep) AS a"), F.expr("greatest(x.rep, y.rep) AS b")).distinct())
        cand = _screen(keep(cand, "candidates"), reps, num, den)
        all_links = links.union(verify_pairs(docs, cand, width, num, den, id_col, text_col))
        label = components(all_links).select(F.col("node").alias("rep"), F.col("root").alias("comp"))
    # every row to its representative, every representative to its component
    named = named.select(*key, "rep").join(small(label), "rep", "left").select(
        *key, F.coalesce("comp", "rep").alias("comp"))
    return (sets.select("doc_id", *key).join(named, key, "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("doc_id"))
                    .otherwise(F.when(F.col("doc_id").isNotNull(), F.col("comp"))).alias("component_id")))


def keep_one(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents whose id is their component's smallest, one row of each id
    (of rows repeating an id the one with the greatest text); rows with a null id stay."""
    kept = small(keep(found.where("doc_id = component_id").select("doc_id").distinct(), "kept"))
    twice = keep(docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
                 .where("n > 1").select("doc_id"), "repeated")
    left = docs.join(kept, "doc_id", "left_semi")
    if not twice.isEmpty():
        again = left.join(small(twice), "doc_id", "left_semi")
        pick = again.groupBy("doc_id").agg(F.max(F.struct("text", *[c for c in docs.columns if c not in ("doc_id", "text")])).alias("r"))
        left = left.join(small(twice), "doc_id", "left_anti").unionByName(pick.select("doc_id", "r.*"))
    return left.select(*docs.columns).union(docs.where("doc_id IS NULL"))
