"""Operator 4: document fingerprints by invertible Bloom lookup sketches.

A text's paragraphs (lines, cut at sentence ends, long ones also where their bytes choose)
are hashed into cells that hold a count, a sum of digests and a sum of check values.  Two versions' cells subtract;
peeling cells that hold one digest recovers the digests in which they differ, and a
difference too large for the cells is retried with twice as many.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hiremart.llm import textarrays as T
from hiremart.llm.frames import keep, prepare

#: Cells of the stored sketch (three sub-tables), bytes of text in a range of the neighbour pass.
CELLS, RANGE_BYTES = 12, 24 << 20
#: Ranges at most (beyond, ranges grow; rows stream through a task, so memory does not).
MOST_RANGES = 1 << 16
#: A paragraph of more bytes is also cut at places its bytes choose, one in every ``PICK`` positions.
LONG, PICK, APART = 96, 64, 16

_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?"]] = True
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_CHECK = np.uint64(0x165667B19E3779F9)


def chosen_cuts(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Positions where long paragraphs ``[s, e)`` are cut: the least hash of eight bytes in every
    run of ``PICK`` positions, so equal stretches are cut alike wherever they stand.

    A hash that came within the last ``APART`` positions is not taken again, but for every
    ``PICK``-th position of its paragraph: a text of one repeated letter has few cuts, not one a byte.
    """
    lens = e - s
    off = np.zeros(len(s) + 1, np.int64)
    np.cumsum(lens, out=off[1:])
    own = np.repeat(np.arange(len(s)), lens)
    within = np.arange(off[-1]) - off[own]
    bytes_ = data[s[own] + within]
    h = np.zeros(len(bytes_), np.uint64)
    for k in range(8):
        h[:len(h) - k] |= bytes_[k:].astype(np.uint64) << np.uint64(8 * k)
    h = T.mix(h)
    h[within > lens[own] - 8] = np.iinfo(np.uint64).max      # eight bytes that would leave the paragraph
    low = h.copy()                                           # least of the PICK positions from here
    step = 1
    while step < PICK:
        np.minimum(low[:-step], low[step:].copy(), out=low[:-step])
        step *= 2
    low[within > lens[own] - 7 - PICK] = 0                   # runs that would leave it choose nothing
    top = low                                                # greatest of those that hold this position
    step = 1
    while step < PICK:
        top = np.concatenate([top[:step], np.maximum(top[step:], top[:-step])])
        step *= 2
    at = np.flatnonzero((h == top) & (within > 0))
    again = np.zeros(len(at), bool)
    for k in range(1, APART):
        again |= (within[at] >= k) & (h[np.maximum(at - k, 0)] == h[at])
    at = at[~again | (within[at] % PICK == 0)]
    return s[own[at]] + within[at]


def paragraph_keys(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit key of every paragraph of a chunk's texts and the text of each.  The n-th
    equal paragraph of a text has a key of its own, so a text's keys are a set."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    blank = T.SEPARATOR[data]
    stop = np.zeros(len(data), bool)
    stop[:-1] = _END[data[:-1]] & blank[1:]
    sep = (data == 10) | stop
    sep[1:] |= stop[:-1]
    s, e, doc = T.runs(sep, off)
    long = e - s > LONG
    if long.any():
        cuts = chosen_cuts(data, s[long], e[long])
        of = np.searchsorted(s, cuts, side="right") - 1
        ends = np.concatenate([e, cuts])
        s, doc = np.concatenate([s, cuts]), np.concatenate([doc, doc[of]])
        order = np.argsort(s, kind="stable")
        s, doc, e = s[order], doc[order], np.sort(ends)
    h = T.span_hashes(data, s, e)
    order = np.lexsort((h, doc))
    hs, ds = h[order], doc[order]
    new = np.ones(len(hs), bool)
    new[1:] = (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])
    at = np.arange(len(hs))
    nth = at - np.maximum.accumulate(np.where(new, at, 0))
    return T.mix(hs + nth.astype(np.uint64) * _STEP), ds


def _cells(keys: np.ndarray, cells: int) -> np.ndarray:
    third = np.uint64(cells // 3)
    return np.stack([(T.mix(keys ^ np.uint64(0x51_7C_C1_B7 * (j + 1) + cells)) % third + np.uint64(j) * third).astype(np.int64)
                     for j in range(3)])


def _check(keys: np.ndarray) -> np.ndarray:
    return T.mix(keys ^ _CHECK) >> np.uint64(32)


def sketches(keys: np.ndarray, owner: np.ndarray, n: int, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, digest sums and check sums of ``n`` sketches of ``cells`` cells."""
    count, total, check = np.zeros(n * cells, np.int64), np.zeros(n * cells, np.uint64), np.zeros(n * cells, np.uint64)
    c = _check(keys)
    for at in _cells(keys, cells) + owner * cells:
        count += np.bincount(at, minlength=n * cells)
        np.add.at(total, at, keys)
        np.add.at(check, at, c)
    return count.reshape(n, cells), total.reshape(n, cells), check.reshape(n, cells)


def peel(count: np.ndarray, total: np.ndarray, check: np.ndarray):
    """Peels subtracted sketches: the rows that came out empty, and of every recovered
    digest its row, key and sign (+1: only in the first version)."""
    n, cells = count.shape
    count, total, check = count.ravel().copy(), total.ravel().copy(), check.ravel().copy()
    rows, keys, signs = [], [], []
    live = np.flatnonzero(np.abs(count) == 1)
    for _ in range(4 * cells + 8):
        sign = count[live]
        one = np.abs(sign) == 1
        live, sign = live[one], sign[one].astype(np.uint64)
        key = total[live] * sign
        pure = _check(key) == check[live] * sign
        live, sign, key = live[pure], sign[pure], key[pure]
        if not len(live):
            break
        row = live // cells
        first = np.unique(np.stack([row.astype(np.uint64), key]), axis=1, return_index=True)[1]
        row, key, sign = row[first], key[first], sign[first]
        rows.append(row)
        keys.append(key)
        signs.append(sign.astype(np.int64))
        c, touched = _check(key), []
        for at in _cells(key, cells) + row * cells:
            np.subtract.at(count, at, sign.astype(np.int64))
            np.subtract.at(total, at, key * sign)
            np.subtract.at(check, at, c * sign)
            touched.append(at)
        live = np.unique(np.concatenate(touched))
    done = ~((count != 0) | (total != 0) | (check != 0)).reshape(n, cells).any(1)
    cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return done, cat(rows, np.int64), cat(keys, np.uint64), cat(signs, np.int64)


def differences(ka, oa, kb, ob, n: int, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """For ``n`` pairs of texts (keys and owner of each side): digests recovered as only in
    the first and only in the second, retried with twice the cells until all are peeled."""
    only_a, only_b = np.zeros(n, np.int64), np.zeros(n, np.int64)
    todo = np.arange(n)
    while len(todo):
        place = np.full(n, -1)
        place[todo] = np.arange(len(todo))
        use_a, use_b = place[oa] >= 0, place[ob] >= 0
        x = sketches(ka[use_a], place[oa[use_a]], len(todo), cells)
        y = sketches(kb[use_b], place[ob[use_b]], len(todo), cells)
        done, rows, _, signs = peel(*(p - q for p, q in zip(x, y)))
        a = np.bincount(rows[signs > 0], minlength=len(todo))
        b = np.bincount(rows[signs < 0], minlength=len(todo))
        only_a[todo[done]], only_b[todo[done]] = a[done], b[done]
        todo, cells = todo[~done], cells * 2
    return only_a, only_b


def likeness(ka, oa, kb, ob, n: int) -> np.ndarray:
    """Shared paragraphs over all paragraphs of both (Jaccard); two empty texts: 1."""
    a, _ = np.bincount(oa, minlength=n), None
    only_a, only_b = differences(ka, oa, kb, ob, n)
    every = a + only_b
    return np.where(every == 0, 1.0, (a - only_a) / np.maximum(every, 1))


def serialize(keys, owner, n: int) -> list[str]:
    """The stored sketch of each text: its cells (count, digest sum, check sum) in base64."""
    count, total, check = sketches(keys, owner, n, CELLS)
    cell = np.zeros((n, CELLS), [("n", "<i4"), ("d", "<u8"), ("c", "<u4")])
    cell["n"], cell["d"], cell["c"] = count, total, check & np.uint64(0xFFFFFFFF)
    return [base64.b64encode(row.tobytes()).decode() for row in cell]


def _flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=off[1:])
    return np.frombuffer(b"".join(texts), np.uint8), off


def edited_text(text: str, following: str) -> str:
    """The last half of ``text`` replaced by the first code points of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _rows(queue: list[tuple]) -> list[tuple]:
    """Results of every row ``(id, text)`` of a sorted run that has a row after it."""
    texts = [row[1] for row in queue]
    n = len(texts) - 1
    edits = [edited_text(a, b).encode("utf-8", "replace") for a, b in zip(texts, texts[1:])]
    keys, owner = paragraph_keys(*_flat([t.encode("utf-8", "replace") for t in texts]))
    ek, eo = paragraph_keys(*_flat(edits))
    own, nxt = owner < n, owner > 0
    ka, oa, kn, on = keys[own], owner[own], keys[nxt], owner[nxt] - 1
    return list(zip([row[0] for row in queue[:-1]], [len(t) for t in texts[:-1]],
                    [hashlib.sha256(e).hexdigest() for e in edits], serialize(ka, oa, n), serialize(ek, eo, n),
                    likeness(ka, oa, ek, eo, n).tolist(), likeness(ka, oa, kn, on, n).tolist()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``; the next document is the one with the next smaller id (after
    the last the first; a lone row is its own next).

    The rows are dealt once, by Spark's range partitioner over the id (falling), the text's
    hash and the row's place, so an id that a third of all rows repeat is split too.  A task
    yields all but its last row; heads and tails of the ranges are paired afterwards.  A null
    text is empty; null ids come last; rows repeating an id follow each other by the text's hash.
    Other columns are ignored; an empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"]
    ranges = min(MOST_RANGES, max(1, -(-(size or 0) // range_bytes)))
    order = [F.col("id").desc_nulls_last(), F.col("h"), F.col("place")]
    dealt = (rows.select("id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("place"))
             .repartitionByRange(ranges, *order).sortWithinPartitions(*order))
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                        ("near_edited", pa.float64()), ("near_next", pa.float64())])

    names = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
            "near_edited double, near_next double"
    edge = pa.schema([*schema, ("part", pa.int64()), ("head", pa.bool_()), ("text", pa.string())])

    def batch(found, kind=schema):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), kind)], schema=kind)

    def run(batches):
        part, queue, held = TaskContext.get().partitionId(), [], 0
        bound = lambda row, head: (row[0], *[None] * 6, part, head, row[1])
        for b in batches:
            for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not queue:
                    yield batch([bound(row, True)], edge)
                queue.append(row)
                held += len(row[1])
                if held > T.CHUNK // 2 and len(queue) > 1:
                    yield batch([(*r, None, None, None) for r in _rows(queue)], edge)
                    queue, held = queue[-1:], len(queue[-1][1])
        if len(queue) > 1:
            yield batch([(*r, None, None, None) for r in _rows(queue)], edge)
        if queue:
            yield batch([bound(queue[-1], False)], edge)

    made = keep(dealt.select("id", "text").mapInArrow(run, names + ", part long, head boolean, text string"), "fingerprints")

    # one head and one tail a range: a tail's next row is the head of the next range that has rows (after the last: the first)
    heads = made.where("head").select("part", F.col("doc_id").alias("next_id"), F.col("text").alias("next_text"))
    by_part = Window.orderBy("part")
    after = heads.select("part", F.coalesce(F.lead("part").over(by_part), F.first("part").over(by_part)).alias("next"))
    pairs = (made.where("NOT head").select("part", F.col("doc_id").alias("id"), "text").join(after, "part")
             .join(heads.withColumnRenamed("part", "next"), "next").select("id", "text", "next_id", "next_text"))

    def seams(batches):
        for b in batches:
            for i, text, j, following in zip(*(c.to_pylist() for c in b.columns)):
                yield batch(_rows([(i, text), (j, following)]))

    return made.where("head IS NULL").select(*schema.names).unionByName(pairs.mapInArrow(seams, names))
