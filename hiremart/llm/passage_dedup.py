"""Operator 9: substring dedup by paragraph MinHash banding.

Texts are cut into passages: lines, cut further at sentence ends, and overlong
sentences at places their words choose, so a passage copied into the middle of a
paragraph is cut the same way everywhere.  Passages whose MinHash bands collide are
candidates; exact Jaccard of their word shingles verifies them; connected components
that reach two documents are repeats, of which the first occurrence stays.

Copied runs of words need no sentence: of every WINDOW consecutive runs of COPY words the
one of least hash is an anchor, so a run of COPY + WINDOW - 1 words copied from anywhere to
anywhere has an anchor in common.  Anchors in two documents are live; those of a text that touch
are a run, and only the ends of runs are compared word by word: distinct contexts of an end anchor
are sorted, so the nearest ones of other documents hold the longest copy, whichever document it is in.
"""

from __future__ import annotations

import contextlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hiremart.llm import textarrays as T
from hiremart.llm.frames import components, keep, prepare, small

#: Word shingle, least similarity in percent, least words of a passage, words from which a
#: sentence is cut, one in how many words may end a cut.
SHINGLE, LEAST, MIN_WORDS, LONG_WORDS, CUT_ONE_IN = 5, 80, 10, 40, 16
#: A run of repeated passages (at most GAP code points between them) counts from this many words.
MIN_RUN, GAP = 16, 80
#: Bands of rows: a pair at similarity 0.8 collides in a band with probability 1 - (1 - 0.8^3)^8 = 0.997.
BANDS, ROWS = 8, 3
#: Words of an anchor, and how many consecutive runs of that many words hold at least one.
COPY, WINDOW = 16, 16
#: Contexts of run ends that a task compares.
CONTEXTS = 100_000
#: Longs of a passage's parity bitmap: bit h(t) is the parity of its shingles t there, so the set
#: bits of x ^ y never exceed the symmetric difference of two shingle sets.
BITS = 2
#: Further rounds that link a band's passages to one of them, drawn anew in each.
ROUNDS = 1

_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?"]] = True


def passages(data: np.ndarray, off: np.ndarray, min_words: int):
    """The passages of a chunk's texts: ``(text, first word, end word)`` of each, with the
    words' hashes, byte starts and ends.  Words are compared lower-cased (A-Z) and without
    a passage's place; shorter passages are left out."""
    low = T.LOWER[data]
    s, e, doc = T.words(data, off)
    h = T.span_hashes(low, s, e)
    n = len(h)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z, h, s, e
    lines = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == 10, out=lines[1:])
    new = np.ones(n, bool)
    ended = _END[data[e - 1]] & ~_END[data[np.maximum(e - 2, 0)]]      # one mark, not "!!"
    new[1:] = (doc[1:] != doc[:-1]) | (lines[s[1:]] != lines[s[:-1]]) | ended[:-1]
    # overlong sentences: cut after words chosen by their hash, but not within a word's repetition
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, n))
    long_ = np.repeat(size > LONG_WORDS, size)
    new[1:] |= long_[1:] & long_[:-1] & (T.mix(h[:-1]) % np.uint64(CUT_ONE_IN) == 0) & (h[1:] != h[:-1])
    start = np.flatnonzero(new)
    end = np.append(start[1:], n)
    ok = end - start >= min_words
    return doc[start[ok]], start[ok], end[ok], h, s, e


def anchors(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, place (word of the chunk) and text of each anchor; ``first`` has the place of
    every text's first word and the number of words."""
    n = len(h) - COPY + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(n)
    of = np.searchsorted(first, at, side="right") - 1
    g = _content(h, at, at + COPY)
    whole = at + COPY <= first[of + 1]
    key = np.full(n + WINDOW, np.uint64(0xFFFFFFFFFFFFFFFF))
    key[:n][whole] = ((g.view(np.uint64) & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64))[whole]
    # windows of a text: those that end in it, and the first; no window that starts with a whole run leaves its text
    begin = whole & ((at + COPY + WINDOW - 1 <= first[of + 1]) | (at == first[of]))
    width = 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        key[:-step] = np.minimum(key[:-step], key[step:])
        width += step
    place = (key[:n][begin] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    place = place[np.append(True, place[1:] != place[:-1])[:len(place)]]
    return g[place], place, of[place]


def shingles(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the passages' word shingles, flat, and how many each passage has."""
    w = T.window_hashes(h, SHINGLE)
    count = np.maximum(end - start - SHINGLE + 1, 0)
    at = np.repeat(start - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(int(count.sum()))
    return w[at], count


_BAND_SALT = T.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def band_keys(w: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The band keys of each passage (passages x BANDS, signed 64 bit)."""
    out = np.zeros((len(count), BANDS), np.uint64)
    if len(count):
        at = np.concatenate([[0], np.cumsum(count)[:-1]])
        for b in range(BANDS):
            key = np.full(len(count), np.uint64(b + 1))
            for r in range(ROWS):
                low = np.minimum.reduceat((w ^ _BAND_SALT[b * ROWS + r]) * np.uint64(0xFF51AFD7ED558CCD), at)
                key = T.mix(key * np.uint64(0xC4CEB9FE1A85EC53) + low)
            out[:, b] = key
    return out.view(np.int64)


def set_bitmaps(w: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each passage and the parity bitmap over them (passages x BITS)."""
    n, width = len(count), 64 * BITS
    of = np.repeat(np.arange(n), count)
    order = np.lexsort((w, of))
    w, of = w[order], of[order]
    first = np.ones(len(w), bool)
    first[1:] = (w[1:] != w[:-1]) | (of[1:] != of[:-1])
    w, of = w[first], of[first]
    odd = np.bincount(of * width + (w & np.uint64(width - 1)).astype(np.int64), minlength=n * width) & 1
    return np.bincount(of, minlength=n), np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(n, BITS)


def _close(least: int) -> str:
    """SQL: sizes and bitmaps of x and y allow the similarity (true for every linked pair)."""
    apart = " + ".join(f"bit_count(x.x{k} ^ y.x{k})" for k in range(BITS))
    return (f"100 * least(x.n, y.n) >= {least} * greatest(x.n, y.n)"
            f" AND ({apart}) * {100 + least}L <= (x.n + y.n) * {100 - least}L")


def cut_passages(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """One row per passage: ``doc_id, start, end`` (code points), ``word`` (its first), ``n_words``, ``h`` (hash of its
    words), ``n`` (distinct shingles), ``x0, x1`` (their parity bitmap) and its band keys; one row per text
    with anchors: ``doc_id, t`` (hash of the text), ``anchors`` and their places ``at``, the others null."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("word", pa.int64()), ("n_words", pa.int64()),
                        ("h", pa.int64()), ("n", pa.int64()), *[(f"x{k}", pa.int64()) for k in range(BITS)],
                        ("bands", pa.list_(pa.int64())), ("t", pa.int64()), ("anchors", pa.list_(pa.int64())), ("at", pa.list_(pa.int64()))])

    def run(batches):
        for b in batches:
            for i, j, data, off in T.chunks(b.column(1)):
                doc, first, last, h, s, e = passages(data, off, min_words)
                heads = np.searchsorted(s, off)
                a, at, of = anchors(h, heads)
                has, many = np.unique(of, return_counts=True)
                ids, none = b.column(0).slice(i, j - i), [pa.nulls(len(has), f.type) for f in schema]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(has)), *none[1:-3], b.column(2).slice(i, j - i).take(pa.array(has)),
                     T.lists(a, many), T.lists(at - heads[of], many)], schema=schema)
                w, count = shingles(h, first, last)
                size, bits = set_bitmaps(w, count)
                points = np.zeros(len(data) + 1, np.int64)
                np.cumsum((data & 0xC0) != 0x80, out=points[1:])
                base = points[off[:-1]][doc] if len(doc) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(doc)),
                     pa.array(points[s[first]] - base), pa.array(points[e[last - 1]] - base),
                     pa.array(first - heads[doc]), pa.array(last - first), pa.array(_content(h, first, last)),
                     pa.array(size.astype(np.int64)), *[pa.array(bits[:, k]) for k in range(BITS)],
                     T.lists(band_keys(w, count).ravel(), np.full(len(count), BANDS)),
                     *[pa.nulls(len(count), f.type) for f in list(schema)[-3:]]], schema=schema)

    return _texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, start long, end long, word long, n_words long, h long, n long, "
        + "".join(f"x{k} long, " for k in range(BITS)) + "bands array<long>, t long, anchors array<long>, at array<long>")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("t"))


def _content(h: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of each passage's word sequence."""
    sums, power = np.zeros(len(h) + 1, np.uint64), T._powers(T._R, len(h) + 1)
    np.cumsum(T.mix(h) * power[:len(h)], out=sums[1:])
    inv = T._powers(T._RINV, len(h) + 1)
    return T.mix((sums[last] - sums[first]) * inv[first] + (last - first).astype(np.uint64)).view(np.int64)


def _verify(docs: DataFrame, cut: DataFrame, pairs: DataFrame, min_words: int, least: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs ``(a, b)`` of passage hashes whose shingle sets reach the threshold (written)."""
    need = pairs.select(F.col("a").alias("h")).union(pairs.select("b")).distinct()
    need = keep(cut.join(small(keep(need, "passage_hashes")), "h", "left_semi").groupBy("h").agg(F.min("doc_id").alias("doc_id")), "passage_docs")
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("tokens", pa.list_(pa.int64()))])

    def sets(batches):
        for b in batches:
            for i, j, data, off in T.chunks(b.column(1)):
                doc, first, last, h, _, _ = passages(data, off, min_words)
                w, count = shingles(h, first, last)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i).take(pa.array(doc)), pa.array(_content(h, first, last)),
                                                  T.lists(w.view(np.int64), count)], schema=schema)

    def check(batches):
        out = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.unique(x.values.to_numpy()), np.unique(y.values.to_numpy())
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= least * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], schema=out).filter(pa.array(ok, pa.bool_()))

    ids = keep(need.select("doc_id").distinct(), "passage_ids")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    made = texts.join(small(ids), "doc_id", "left_semi").mapInArrow(sets, "doc_id long, h long, tokens array<long>")
    made = keep(made.join(small(need), ["doc_id", "h"], "left_semi").drop("doc_id").dropDuplicates(["h"]), "passage_sets")
    joined = (pairs.join(made.selectExpr("h AS a", "tokens AS x"), "a").join(made.selectExpr("h AS b", "tokens AS y"), "b")
              .select("a", "b", "x", "y"))
    return keep(joined.mapInArrow(check, "a long, b long"), "passage_links")


def _reach(batches):
    """Of the sorted distinct contexts of a partition, the words each shares with the nearest
    ones of another document, before and after it (the longest shared beginnings are there);
    the first and last of a partition are given out again to be paired at the seams."""
    out = pa.schema([("a", pa.int64()), ("left", pa.bool_()), ("around", pa.binary()), ("reach", pa.int64()), ("lo", pa.int64()),
                     ("hi", pa.int64()), ("edge", pa.bool_())])
    held = [b for b in batches if b.num_rows]
    for b in pa.Table.from_batches(held).combine_chunks().to_batches() if held else []:
        n = b.num_rows
        a, left = b.column("a").to_numpy(), b.column("left").to_numpy(zero_copy_only=False)
        lo, hi = b.column("lo").to_numpy(), b.column("hi").to_numpy()
        x = np.frombuffer(b"".join(b.column("around").to_pylist()), np.uint32).reshape(n, WINDOW)
        reach = np.where(lo < hi, (x != 0).sum(axis=1), 0)
        new = np.ones(n, bool)
        new[1:] = (a[1:] != a[:-1]) | (left[1:] != left[:-1]) | (lo[1:] != lo[:-1]) | (lo[1:] < hi[1:]) | (lo[:-1] < hi[:-1])
        start = np.flatnonzero(new)
        block = np.cumsum(new) - 1
        for other in (start[block] - 1, np.append(start, n)[block + 1]):
            at = np.clip(other, 0, n - 1)
            near = (at == other) & (a[at] == a) & (left[at] == left)
            reach = np.maximum(reach, np.where(near, _shared(x, x[at]), 0))
        for rows_at, edge in ((np.arange(n), False), (np.unique([0, n - 1]), True)):
            cut = b.take(pa.array(rows_at))
            yield pa.RecordBatch.from_arrays([cut.column(c) for c in ("a", "left", "around")] + [
                pa.array(reach[rows_at]), cut.column("lo"), cut.column("hi"), pa.array(np.full(len(rows_at), edge))], schema=out)


def _shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The words that each two contexts share from the anchor on (0: the text ends)."""
    return np.minimum.accumulate(((x == y) & (x != 0)).astype(np.int64), axis=1).sum(axis=1)


def copied_runs(docs: DataFrame, cut: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Runs of words copied between documents: the output columns but ``run_words``, and ``word``.

    An anchor of ``cut`` (rows of ``cut_passages()``) in two documents is live.  Live anchors of a text
    that overlap or touch are a run, cut where the first or last document of its anchors changes; its
    open ends are extended by the words that any other document has there too.
    """
    texts_in = cut.where("anchors IS NOT NULL").select("doc_id", "t", "anchors", "at")
    live = (texts_in.select("doc_id", F.explode("anchors").alias("a"))
            .groupBy("a").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi"))
    live = small(keep(live, "copied_anchors"))
    marks = (texts_in.dropDuplicates(["doc_id", "t"]).select("doc_id", "t", F.explode(F.arrays_zip("anchors", "at")).alias("m"))
             .select("doc_id", "t", F.col("m.at").alias("at"), F.col("m.anchors").alias("a")).join(live, "a"))
    w = Window.partitionBy("doc_id", "t").orderBy("at")
    marks = (marks.withColumn("opens", F.coalesce(F.col("at") > F.lag("at").over(w) + COPY, F.lit(True)))
             .withColumn("closes", F.coalesce(F.lead("at").over(w) > F.col("at") + COPY, F.lit(True)))
             .withColumn("_new", F.when(F.col("opens") | (F.lag("lo").over(w) != F.col("lo")) | (F.lag("hi").over(w) != F.col("hi")), 1)
                         .otherwise(0))
             .withColumn("seg", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new"))
    marks = keep(marks, "copied_marks")
    ends = keep(marks.where("opens OR closes").groupBy("a").agg(F.bool_or("opens").alias("l"), F.bool_or("closes").alias("r")), "copied_ends")
    wanted = marks.join(small(ends), "a").select("doc_id", "t", F.struct("at", "a", "l", "r", "opens", "closes").alias("m"))
    wanted = keep(wanted.groupBy("doc_id", "t").agg(F.collect_list("m").alias("ms")), "copied_wanted")
    texts = _texts(docs, id_col, text_col)
    schema = pa.schema([("doc_id", pa.int64()), ("t", pa.int64()), ("at", pa.int64()), ("a", pa.int64()), ("left", pa.bool_()),
                        ("mine", pa.bool_()), ("around", pa.binary())])

    def around(batches):
        """Hashes of the WINDOW words before or after each wanted anchor (0: the text ends), nearest first."""
        side = np.arange(WINDOW)
        for b in batches:
            for i, j, data, off in T.chunks(b.column(1)):
                s, e, _ = T.words(data, off)
                h, heads = T.span_hashes(T.LOWER[data], s, e), np.searchsorted(s, off)
                h = (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
                ms = b.column(3).slice(i, j - i)
                of = pc.list_parent_indices(ms).to_numpy()
                flat = ms.flatten()
                col = {c: flat.field(flat.type.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("at", "a", "l", "r", "opens", "closes")}
                for left, want, mine in ((True, "l", "opens"), (False, "r", "closes")):
                    pick = np.flatnonzero(col[want])
                    at, text = col["at"][pick], of[pick]
                    place = (at + heads[text])[:, None] + (-1 - side if left else COPY + side)
                    inside = (place >= heads[text][:, None]) & (place < heads[text + 1][:, None])
                    hashes = np.where(inside, h[np.clip(place, 0, len(h) - 1)], np.uint32(0)).astype(np.uint32)
                    ends_at = pa.py_buffer(np.arange(len(pick) + 1, dtype=np.int32) * np.int32(4 * WINDOW))
                    yield pa.RecordBatch.from_arrays(
                        [b.column(c).slice(i, j - i).take(pa.array(text)) for c in (0, 2)]
                        + [pa.array(at), pa.array(col["a"][pick]), pa.array(np.full(len(pick), left)), pa.array(col[mine][pick]),
                           pa.Array.from_buffers(pa.binary(), len(pick), [None, ends_at, pa.py_buffer(np.ascontiguousarray(hashes))])],
                        schema=schema)

    found = keep(texts.join(small(wanted, 10_000), ["doc_id", "t"]).select("doc_id", "text", "t", "ms").mapInArrow(
        around, "doc_id long, t long, at long, a long, left boolean, mine boolean, around binary"), "copied_around")
    key = ["a", "left", "around"]
    contexts = keep(found.groupBy(*key).agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")), "copied_contexts")
    parts = max(1, -(-contexts.count() // CONTEXTS))
    reached = keep(contexts.repartitionByRange(parts, *key).sortWithinPartitions(*key).mapInArrow(
        _reach, "a long, left boolean, around binary, reach long, lo long, hi long, edge boolean"), "copied_reach")
    edges = reached.where("edge").select(*key, "lo", "hi").repartition(1).sortWithinPartitions(*key)
    seams = edges.mapInArrow(_reach, "a long, left boolean, around binary, reach long, lo long, hi long, edge boolean")
    reached = reached.union(seams).where("NOT edge").groupBy(*key).agg(F.max("reach").alias("reach")).where("reach > 0")
    longer = keep(found.where("mine").select("doc_id", "t", "at", *key).distinct().join(reached, key)
                  .groupBy("doc_id", "t", "at").agg(F.max(F.when(F.col("left"), F.col("reach"))).alias("before"),
                                                    F.max(F.when(~F.col("left"), F.col("reach"))).alias("after")), "copied_longer")
    runs = (marks.join(small(longer), ["doc_id", "t", "at"], "left").groupBy("doc_id", "t", "seg", "lo", "hi").agg(
        F.min(F.expr("at - coalesce(before, 0)")).alias("word"), F.max(F.expr(f"at + {COPY} + coalesce(after, 0)")).alias("last"),
        F.min("a").alias("a")).withColumn("component_id", F.xxhash64("a", "lo", "hi")))
    runs = keep(runs.select("doc_id", "t", "word", "last", "component_id", "lo"), "copied_runs")
    n_docs = runs.select("component_id", "doc_id").distinct().groupBy("component_id").agg(
        F.greatest(F.count(F.lit(1)), F.lit(2)).cast("long").alias("n_docs"))
    n_docs = small(keep(n_docs, "copied_sizes"))
    rows = runs.join(n_docs, "component_id").withColumn("removed", F.col("doc_id") != F.col("lo"))
    held = ["word", "last", "component_id", "n_docs", "lo", "removed"]
    per = keep(rows.groupBy("doc_id", "t").agg(F.collect_list(F.struct(*held)).alias("runs")), "copied_per_text")
    kinds = [("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("word", pa.int64()), ("n_words", pa.int64()),
             ("component_id", pa.int64()), ("n_docs", pa.int64()), ("first_doc_id", pa.int64()), ("removed", pa.bool_())]

    def place(batches):
        for b in batches:
            for i, j, data, off in T.chunks(b.column(1)):
                s, e, _ = T.words(data, off)
                heads, points = np.searchsorted(s, off), np.zeros(len(data) + 1, np.int64)
                np.cumsum((data & 0xC0) != 0x80, out=points[1:])
                lists = b.column(2).slice(i, j - i)
                of = pc.list_parent_indices(lists).to_numpy()
                flat = lists.flatten()
                col = {c: flat.field(flat.type.get_field_index(c)) for c in held}
                first, last = col["word"].to_numpy(), col["last"].to_numpy()
                base = points[off[:-1]][of]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i).take(pa.array(of)), pa.array(points[s[first + heads[of]]] - base),
                     pa.array(points[e[last + heads[of] - 1]] - base), col["word"], pa.array(last - first),
                     col["component_id"], col["n_docs"], col["lo"], col["removed"]], schema=pa.schema(kinds))

    return keep(texts.join(small(per, 10_000), ["doc_id", "t"]).select("doc_id", "text", "runs").mapInArrow(
        place, ", ".join(f"{c} {'boolean' if c == 'removed' else 'long'}" for c, _ in kinds)).distinct(), "copies")


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, least: int = LEAST, min_run: int = MIN_RUN,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per passage or copied run that repeats across documents: ``doc_id, start, end`` (code points,
    end exclusive), ``n_words, component_id, n_docs, first_doc_id, removed, run_words``.

    Passages of ``min_words`` words or more link when their 5-word shingles' Jaccard
    similarity is ``least`` percent or more; ``component_id`` names a component of links,
    ``n_docs`` its documents.  All occurrences but the first (smallest doc_id, then
    start) are ``removed``.  A run of COPY + WINDOW - 1 words or more that is copied word by word
    from any place of a document to any other document, with or without sentence ends, is covered by rows
    of their own besides the passages in it (rows may overlap; shorter runs are rows if they hold an
    anchor): one for each stretch whose anchors have the same first and last document, ``removed``
    outside the first.
    Repeated passages and runs that follow each other or overlap in a document form a
    run of ``run_words`` words, each word counted once; runs of fewer than ``min_run`` words (common phrases and
    notices) are not returned.  Repeats within one document only are not returned.  Null or
    empty texts have no passages, rows with a null id are left out, rows repeating an id
    are one document (equal rows count once); other columns are ignored; an empty table
    gives no rows.
    """
    with _shuffles_cleaned(prepare(docs.sparkSession)):
        return _repeated(docs, min_words, least, min_run, id_col, text_col)


@contextlib.contextmanager
def _shuffles_cleaned(spark: SparkSession):
    """Every step is written, so its shuffle files go when it ends, not when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _repeated(docs: DataFrame, min_words: int, least: int, min_run: int, id_col: str, text_col: str) -> DataFrame:
    every = keep(cut_passages(docs, min_words, id_col, text_col).where("doc_id IS NOT NULL"), "passages")
    cut = every.where("anchors IS NULL").drop("t", "anchors", "at")
    copies = copied_runs(docs, every, id_col, text_col)
    sizes = ["n", *[f"x{k}" for k in range(BITS)]]
    bands = cut.select("h", F.explode("bands").alias("band"))
    live = keep(bands.groupBy("band").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo < hi").drop("hi"), "live_bands")
    members = keep(cut.select("h", *sizes, F.explode("bands").alias("band")).join(small(live), "band").distinct(), "band_members")
    star = keep(members.where("h <> lo").select(F.col("lo").alias("a"), F.col("h").alias("b")).distinct(), "band_stars")
    links, tried = _verify(docs, cut, star, min_words, least, id_col, text_col), star
    label = keep(components(links), "passage_roots")
    # colliding passages that the stars did not bring together: rounds of other stars, then all pairs left
    for k in range(ROUNDS + 1):
        m = members.join(small(label), F.col("h") == F.col("node"), "left").select(
            "band", "h", *sizes, F.coalesce("root", "h").alias("root"))
        m = keep(m, "rooted_members")
        split = keep(m.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("band"), "split_bands")
        m = m.join(small(split), "band", "left_semi")
        if k < ROUNDS:
            lead = F.min(F.struct(F.xxhash64("h", F.lit(k)), "h", "root", *sizes)).alias("lead")
            others = m.groupBy("band").agg(lead).select("band", *[f"lead.{c}" for c in ("h", "root", *sizes)])
            apart = "x.root <> y.root"
        else:
            others, apart = m, "x.h < y.h AND x.root <> y.root"
        rest = (m.alias("x").join(others.alias("y"), F.expr(f"x.band = y.band AND {apart} AND {_close(least)}"))
                .select(F.expr("least(x.h, y.h) AS a"), F.expr("greatest(x.h, y.h) AS b")).distinct())
        rest = keep(rest.join(tried, ["a", "b"], "left_anti"), "band_rest")
        if not rest.isEmpty():
            tried = tried.union(rest)
            links = links.union(_verify(docs, cut, rest, min_words, least, id_col, text_col))
            label = keep(components(links), "passage_roots")
    rows = (cut.drop("bands", *sizes).join(small(label), F.col("h") == F.col("node"), "left")
            .withColumn("component_id", F.coalesce("root", "h")).drop("node", "root", "h").distinct())
    spread = keep(rows.groupBy("component_id").agg(
        F.min(F.struct("doc_id", "start")).alias("first"), F.max("doc_id").alias("last")).where("first.doc_id < last").drop("last"), "repeats")
    docs_in = (rows.join(small(spread.select("component_id")), "component_id", "left_semi").select("component_id", "doc_id").distinct()
               .groupBy("component_id").agg(F.count(F.lit(1)).alias("n_docs")))
    found = keep(spread.join(docs_in, "component_id"), "repeat_sizes")
    hits = rows.join(small(found), "component_id").select(
        "doc_id", "start", "end", "word", "n_words", "component_id", "n_docs", F.col("first.doc_id").alias("first_doc_id"),
        ((F.col("doc_id") != F.col("first.doc_id")) | (F.col("start") != F.col("first.start"))).alias("removed"))
    hits = hits.unionByName(copies)
    w = Window.partitionBy("doc_id").orderBy("start", "end")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    last = F.col("word") + F.col("n_words")
    fresh = last - F.greatest(F.col("word"), F.coalesce(F.max(last).over(before), F.lit(0)))
    hits = (hits.withColumn("_new", F.when(F.col("start") - F.coalesce(F.max("end").over(before), F.lit(-1 << 40)) > GAP, 1).otherwise(0))
            .withColumn("_fresh", F.greatest(fresh, F.lit(0)))
            .withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("run_words", F.sum("_fresh").over(Window.partitionBy("doc_id", "_run")))
            .where(F.col("run_words") >= min_run))
    return hits.select("doc_id", "start", "end", "n_words", "component_id", "n_docs", "first_doc_id", "removed", "run_words")
