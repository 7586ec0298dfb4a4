"""Operator 11: SimHash near-duplicates by a Gray-order hierarchical index.

Distinct fingerprints are range-partitioned and sorted by Gray rank into blocks of
equal size, so neighbours share most bits.  A node of the index factors the bits
that all fingerprints below it share into one masked pattern; a child keeps only
the bits its parent has not.  A search adds up the differences on the way down
and drops a node, with everything below it, once they exceed the radius.

Two levels of the same index do the join: the upper nodes (one pattern per block,
at most ``MOST_BLOCKS``) tell which blocks a fingerprint must visit; each visited
block is then searched by its own index.  A visit goes only to the own and to later
blocks, so a pair is met once, and a block with many visitors is searched by
several tasks.  Distinct fingerprints have at most 2080 neighbours within two bits,
and every task answers with a spanning forest of the links it finds, so no group
ever comes out as all its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hiremart.llm import textarrays as T
from hiremart.llm.frames import components, keep, prepare

#: Fingerprints of a block; beyond ``MOST_BLOCKS`` blocks they grow instead, so the upper
#: nodes (16 bytes each) stay below 1 MB on every worker.
BLOCK = 1 << 14
MOST_BLOCKS = 1 << 15
#: Neighbours that travel in one row, and visitors of a block searched by one task.
GROUP = 64
VISITORS = 1 << 18
#: Children of a node, and (query, node) pairs held at once by a search.
FANOUT = 8
FRONTIER = 1 << 20
#: Shingles whose bits are counted at once.
_SLICE = 1 << 16
_U = np.uint64
_ALL = _U(0xFFFFFFFFFFFFFFFF)


def _shingle_hashes(data: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of every shingle, repeats included, of a chunk's lower-cased
    texts, and the first hash of each text (n + 1 entries)."""
    data = T.LOWER[data]
    s, e, doc = T.words(data, off)
    # the words of all texts, each followed by one space
    size = e - s + 1
    to = np.zeros(len(s) + 1, np.int64)
    np.cumsum(size, out=to[1:])
    joined = np.full(int(to[-1]), 0x20, np.uint8)
    inside = np.ones(len(joined), bool)
    inside[to[1:] - 1] = False
    joined[inside] = data[~T.SEPARATOR[data]]
    count = np.diff(T.bounds(doc, len(off) - 1))
    shingles = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    start = np.zeros(len(shingles) + 1, np.int64)
    np.cumsum(shingles, out=start[1:])
    text = np.repeat(np.arange(len(shingles)), shingles)
    first = np.repeat(np.cumsum(count) - count, shingles) + np.arange(len(text)) - start[text]
    last = first + np.minimum(count, width)[text]
    buffer, a, b = joined.tobytes(), to[first].tolist(), (to[last] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(buffer[i:j], 42) for i, j in zip(a, b)), np.uint64, len(a)), start


def _fingerprints(hashes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Per text: bit k is set if it is set in over half of its hashes."""
    n = len(start) - 1
    ones = np.zeros((n, 64), np.int64)
    for lo in range(0, len(hashes), _SLICE):
        part = hashes[lo:lo + _SLICE]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        i, j = np.searchsorted(start, lo, side="right") - 1, np.searchsorted(start, lo + len(part))
        texts = np.arange(i, j)[start[i + 1:j + 1] > start[i:j]]
        ones[texts] += np.add.reduceat(bits, np.maximum(start[texts] - lo, 0), axis=0, dtype=np.int32)
    most = ones * 2 > np.diff(start)[:, None]
    return np.packbits(most, axis=1, bitorder="little").view(np.uint64).ravel()


def simhash(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)``: the 64-bit fingerprint (a signed long) of every row's whole text.

    A text without words, or null, has fingerprint zero; one of fewer words than a
    shingle is one shingle.  Other columns are ignored.
    """
    prepare(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for b in batches:
            got = [_fingerprints(*_shingle_hashes(data, off, width)) for _, _, data, off in T.chunks(b.column(1))]
            fp = np.concatenate(got) if got else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], schema=schema)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, fp long")


def gray_rank(fp: Column) -> Column:
    """Place of a code in the Gray sequence, ascending as a signed long."""
    for k in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, k))
    return fp.bitwiseXOR(F.lit(-2**63).cast("long"))     # unsigned order


class GrayIndex:
    """Masked patterns (``mask``, ``value``) in Gray order, factored level by level."""

    def __init__(self, value: np.ndarray, mask: np.ndarray | None = None):
        value = value.astype(np.uint64)
        mask = np.full(len(value), _ALL) if mask is None else mask.astype(np.uint64)
        levels = [(value & mask, mask)]
        while len(levels[-1][0]) > FANOUT:
            v, m = levels[-1]
            at = np.arange(0, len(v), FANOUT)
            shared = np.bitwise_and.reduceat(m, at)
            shared &= ~(np.bitwise_or.reduceat(v, at) ^ np.bitwise_and.reduceat(v | ~m, at))
            levels.append((v[at] & shared, shared))
        # a child keeps what its parent's pattern does not hold
        self.levels = []
        for k, (v, m) in enumerate(levels):
            rest = m if k + 1 == len(levels) else m & ~levels[k + 1][1][np.arange(len(m)) // FANOUT]
            self.levels.append((v & rest, rest))

    def search(self, queries: np.ndarray, radius: int):
        """Yields ``(query numbers, pattern numbers)`` of patterns within ``radius`` bits
        (counted on the pattern's mask), holding a bounded number of pairs at once."""
        queries = queries.astype(np.uint64)
        if not len(self.levels[0][0]):
            return
        top = len(self.levels) - 1
        step = max(1, FRONTIER // FANOUT)
        for lo in range(0, len(queries), step):
            n, width = min(step, len(queries) - lo), len(self.levels[top][0])
            stack = [(top, np.repeat(np.arange(lo, lo + n), width), np.tile(np.arange(width), n), None)]
            while stack:
                level, q, node, apart = stack.pop()
                v, m = self.levels[level]
                d = np.bitwise_count((queries[q] ^ v[node]) & m[node])
                if apart is not None:
                    d += apart
                near = d <= radius
                q, node, d = q[near], node[near], d[near]
                if level == 0:
                    if len(q):
                        yield q, node
                    continue
                size, cut = len(self.levels[level - 1][0]), max(1, FRONTIER // FANOUT)
                for i in range(0, len(q), cut):
                    child = (node[i:i + cut, None] * FANOUT + np.arange(FANOUT)).ravel()
                    there = child < size
                    stack.append((level - 1, np.repeat(q[i:i + cut], FANOUT)[there], child[there],
                                  np.repeat(d[i:i + cut], FANOUT)[there]))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star forest ``(node, root)`` with the same components as the links ``a``-``b``."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    away = root != np.arange(len(names))
    return names[away], names[root[away]]


def _groups(found: DataFrame, blocks: int) -> DataFrame:
    """``(block, fps, all, any)``: the distinct fingerprints range-partitioned by Gray rank, up to
    ``GROUP`` neighbours in a row, with the bits that all or any of them have (a written table)."""
    ranked = found.select("fp").distinct().withColumn("rank", gray_rank(F.col("fp")))
    cut = ranked.repartitionByRange(blocks, "rank").sortWithinPartitions("rank")
    schema = pa.schema([("block", pa.int32()), ("fps", pa.list_(pa.int64())), ("all", pa.int64()), ("any", pa.int64())])

    def run(batches):
        for b in batches:
            if b.num_rows:
                block, fp = b.column(0), b.column(1).to_numpy()
                at = np.arange(0, len(fp), GROUP)
                yield pa.RecordBatch.from_arrays(
                    [block.take(pa.array(at)), T.lists(fp, np.diff([*at, len(fp)])), pa.array(np.bitwise_and.reduceat(fp, at)),
                     pa.array(np.bitwise_or.reduceat(fp, at))], schema=schema)

    rows = cut.select(F.spark_partition_id().cast("int").alias("block"), "fp")
    return keep(rows.mapInArrow(run, "block int, fps array<long>, all long, any long"), "gray_blocks")


def near_links(found: DataFrame, radius: int = 2) -> DataFrame:
    """``(a, b)``: links among the fingerprints ``found(fp)`` (a written table) that connect
    exactly those reachable by steps of at most ``radius`` differing bits (a written table)."""
    spark = found.sparkSession
    n = found.select("fp").distinct().count()
    if not n:
        return keep(spark.createDataFrame([], "a long, b long"), "gray_links")
    groups = _groups(found, min(MOST_BLOCKS, -(-n // BLOCK)))
    # the upper nodes: one pattern per block, bounded by MOST_BLOCKS
    nodes = (groups.groupBy("block").agg(F.expr("bit_and(all)").alias("all"), F.expr("bit_or(any)").alias("any"))
             .orderBy("block").toPandas())
    number = nodes["block"].to_numpy(np.int64)
    both, any_ = (nodes[c].to_numpy(np.int64).view(np.uint64) for c in ("all", "any"))
    upper = spark.sparkContext.broadcast((number, both, ~(both ^ any_)))
    visit_schema = pa.schema([("block", pa.int32()), ("fps", pa.list_(pa.int64()))])

    def visit(batches):
        numbers, value, mask = upper.value
        index = GrayIndex(value, mask)
        for b in batches:
            size = np.diff(b.column(1).offsets.to_numpy())
            group, fp = np.repeat(np.arange(len(size)), size), b.column(1).flatten().to_numpy()
            own = b.column(0).to_numpy()[group]
            for q, k in index.search(fp.view(np.uint64), radius):
                later = numbers[k] > own[q]
                q, k = q[later], k[later]
                order = np.lexsort((q, k, group[q]))
                q, k = q[order], k[order]
                at = np.flatnonzero((np.diff(k, prepend=-1) != 0) | (np.diff(group[q], prepend=-1) != 0))
                yield pa.RecordBatch.from_arrays([pa.array(numbers[k[at]].astype(np.int32)),
                                                  T.lists(fp[q], np.diff([*at, len(q)]))], schema=visit_schema)

    visits = keep(groups.select("block", "fps").mapInArrow(visit, "block int, fps array<long>"), "gray_visits")
    guests = groups.select("block", "fps").unionByName(visits)
    # tasks: one per block and VISITORS of its visitors (at most MOST_BLOCKS rows reach the driver)
    count = {r["block"]: r["n"] for r in guests.groupBy("block").agg(F.sum(F.size("fps")).alias("n")).collect()}
    parts = list(_parts(sorted(count.items())))
    plan = F.broadcast(spark.createDataFrame(parts, "block int, first int, parts int"))
    tasks = parts[-1][1] + parts[-1][2]
    leaves = groups.join(plan, "block").select(
        F.explode(F.expr("sequence(first, first + parts - 1)")).alias("task"), F.lit(0).alias("kind"), "fps")
    guests = guests.join(plan, "block").select(
        (F.col("first") + F.pmod(F.xxhash64(F.col("fps")[0]), F.col("parts")).cast("int")).alias("task"),
        F.lit(1).alias("kind"), "fps")
    dealt = (leaves.unionByName(guests).withColumn("rank", gray_rank(F.col("fps")[0]))
             .repartitionById(tasks, F.col("task")).sortWithinPartitions("task", "kind", "rank"))
    link_schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(batches):
        held: list[np.ndarray] = []
        index, leaves, at = None, None, None
        for b in batches:
            task, kind, off = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).offsets.to_numpy()
            fp = b.column(2).values.to_numpy()
            cuts = np.flatnonzero((np.diff(task) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(task)]):
                if lo == hi:
                    continue
                if at != task[lo]:
                    at, held, index = task[lo], [], None
                part = fp[off[lo]:off[hi]]
                if kind[lo] == 0:
                    held.append(part.copy())
                    continue
                if index is None:
                    leaves = np.concatenate(held)
                    index = GrayIndex(leaves.view(np.uint64))
                for q, k in index.search(part.view(np.uint64), radius):
                    node, root = forest(part[q], leaves[k])
                    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], schema=link_schema)

    links = dealt.select("task", "kind", "fps").mapInArrow(search, "a long, b long")
    return keep(links.distinct(), "gray_links")


def _parts(count):
    """``(block, first task, tasks)`` of blocks in order, a task for every ``VISITORS`` visitors."""
    first = 0
    for block, n in count:
        size = -(-n // VISITORS)
        yield block, first, size
        first += size


def simhash_components(docs: DataFrame, width: int = 3, radius: int = 2, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    Two documents link when their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the smallest id reachable, the own included.  Rows that repeat
    an id are one document and link as any of them does.  Rows with a null id have a
    fingerprint, a null component and no links.  Texts without words have fingerprint
    zero and link like others.  Other columns are ignored; an empty table gives no rows.
    """
    found = keep(simhash(docs, width, id_col, text_col), "simhash")
    named = found.where("doc_id IS NOT NULL")
    same_id = (named.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a < b"))
    several = named.join(same_id.select("doc_id", "a"), "doc_id").where("fp <> a").select("a", F.col("fp").alias("b"))
    links = near_links(keep(named.select("fp").distinct(), "fingerprints"), radius)
    label = components(links.unionByName(several)).select(F.col("node").alias("fp"), "root")
    least = named.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    rooted = keep(least.join(label, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_fp = rooted.join(lowest, "root").select("fp", "component_id")
    return (found.join(by_fp, "fp", "left")
            .select("doc_id", F.format_string("%016x", "fp").alias("fingerprint"),
                    F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))
