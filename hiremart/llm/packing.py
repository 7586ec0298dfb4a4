"""Operator 10: best-fit packing by non-negative least squares over length patterns.

Tokenized documents are cut into pieces of at most ``capacity`` tokens.  Only the
histogram of piece lengths (at most ``capacity`` entries, whatever the corpus) goes
to the driver: patterns of a few lengths that fill a sequence are enumerated on
coarse lengths, non-negative least squares fits their repeat counts to the
histogram, the counts are rounded down, and the residual pieces are packed best
fit, first into the room that the patterns leave.  The plan is a list of runs
"pieces number a..b of length L open sequence s at offset o", against which every
piece finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremart.llm import textarrays as T
from hiremart.llm.frames import keep, prepare, running_total

CAPACITY = 4096
#: Coarse units of a sequence, and most documents in an enumerated pattern.
UNITS, PATTERN_DOCS = 128, 4
#: Words whose ids a worker remembers (their ids: at most eight times as many): about 40 MB.
WORD_CACHE = 600_000
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """The default place of a vocabulary file (the installed public package)."""
    import public_tokenizers
    return public_tokenizers.path(name)


#: Marks behind a word, and the bytes of words that may be letters below U+0180 only.
_MARKS, _LETTERS = np.zeros(256, bool), np.zeros(256, bool)
_MARKS[list(b".,;:!?#*$%&|<>()\"-")] = True
_LETTERS[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = True
_WHOLE = np.uint64(0x9AE16A3B2F90404F)


class Memory:
    """Ids by 64-bit keys: ``pool`` holds all ids, ``at`` and ``size`` a key's part of it
    (size -1: a core that is no word of letters)."""

    def __init__(self):
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where ascending ``keys`` are or belong, and which are known."""
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        there = place < len(self.keys)
        known[there] = self.keys[place[there]] == keys[there]
        return place, known

    def add(self, keys: np.ndarray, ids: list[bytes | None]) -> None:
        """Adds ascending keys that are not known."""
        size = np.fromiter((-4 if x is None else len(x) for x in ids), np.int64, len(ids)) // 4
        used = np.maximum(size, 0)
        at = len(self.pool) + np.cumsum(used) - used
        self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(x for x in ids if x), "<u4")])
        into, _ = self.place(keys)
        self.at, self.size = np.insert(self.at, into, at), np.insert(self.size, into, size)
        self.keys = np.insert(self.keys, into, keys)


class WordTokenizer:
    """Ids of whole texts: the distinct words of a chunk are encoded once and remembered within
    the bounds of ``WORD_CACHE``; words are told apart by 64-bit hashes, nothing runs per word.

    Exact for tokenizers that drop white space and never merge across it: the ids of a text
    are those of its words between U+0020 and U+0009..U+000D, in order.  ``end`` names the
    mark that the vocabulary puts on a pre-token's last piece; where it has one and lower-cases,
    the letters of a word (below U+0180, where lower case keeps composed characters composed)
    and the marks behind them are encoded and remembered apart.
    """

    def __init__(self, path: str, end: str = "</w>"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.memory = Memory()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, k in vocabulary.items():
            self.ends[k] = token.endswith(end)
        self.apart = bool(self.ends.any()) and self._ids(["AB", "ab"])[0] == self._ids(["ab"])[0]

    def _ids(self, texts: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(texts), 10_000):
            some = self.tokenizer.encode_batch(texts[i:i + 10_000], add_special_tokens=False)
            out += [np.array(e.ids, "<u4").tobytes() for e in some]
        return out

    def _encode_cores(self, cores: list[str]) -> list[bytes]:
        """Ids of words of letters only, each a single pre-token: encoded in one text and cut
        behind every end mark."""
        ids = np.array(self.tokenizer.encode(" ".join(cores), add_special_tokens=False).ids, "<u4")
        cut = np.flatnonzero(self.ends[ids]) + 1
        if len(cut) != len(cores) or cut[-1] != len(ids):
            return self._ids(cores)
        raw, at = ids.tobytes(), [0, *(4 * cut).tolist()]
        return [raw[x:y] for x, y in zip(at, at[1:])]

    def _learn(self, data: np.ndarray, s: np.ndarray, e: np.ndarray, keys: np.ndarray, core: np.ndarray) -> None:
        """Encodes new distinct items, the spans ``s``-``e``: lower-cased cores and whole words or marks."""
        raw = data.tobytes()
        texts = [raw[i:j].decode("utf-8", "replace") for i, j in zip(s.tolist(), e.tolist())]
        ids: list[bytes | None] = [None] * len(texts)
        cores = [(k, t.lower()) for k, t in enumerate(texts) if core[k] and t.isalpha() and max(t) < "\u0180" and "\u0130" not in t]
        for i in range(0, len(cores), 1000):
            some = cores[i:i + 1000]
            for (k, _), x in zip(some, self._encode_cores([t for _, t in some])):
                ids[k] = x
        whole = np.flatnonzero(~core).tolist()
        for k, x in zip(whole, self._ids([texts[k] for k in whole])):
            ids[k] = x
        self.memory.add(keys, ids)

    def _known(self, data: np.ndarray, s: np.ndarray, e: np.ndarray, keys: np.ndarray, core: bool) -> tuple[np.ndarray, np.ndarray]:
        """Each span's place and size in the pool, new spans learned."""
        keys, first, item = np.unique(keys, return_index=True, return_inverse=True)
        place, known = self.memory.place(keys)
        if not known.all():
            new = first[~known]
            self._learn(data, s[new], e[new], keys[~known], np.full(len(new), core))
            place, _ = self.memory.place(keys)
        return self.memory.at[place][item], self.memory.size[place][item]

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a chunk's texts, one after the other, and where each text's begin (n + 1 entries)."""
        if len(self.memory.keys) > WORD_CACHE or len(self.memory.pool) > 8 * WORD_CACHE:
            self.memory = Memory()
        s, e, doc = T.words(data, off)
        middle = e.copy()
        at, size = np.zeros((len(s), 2), np.int64), np.zeros((len(s), 2), np.int64)
        core = np.zeros(len(s), bool)
        if self.apart and len(s):
            ends = np.arange(len(s))        # words whose marks are not yet all found
            while len(ends := ends[(middle[ends] > s[ends]) & _MARKS[data[middle[ends] - 1]]]):
                middle[ends] -= 1
            other = np.concatenate([[0], np.cumsum(~_LETTERS[data])])
            core = (middle > s) & (other[middle] == other[s])
            lower = T.LOWER[data]
            k = np.flatnonzero(core)
            at[k, 0], size[k, 0] = self._known(lower, s[k], middle[k], T.span_hashes(lower, s[k], middle[k]), True)
            core &= size[:, 0] >= 0
            k = np.flatnonzero(core & (middle < e))
            if len(k):
                at[k, 1], size[k, 1] = self._known(data, middle[k], e[k], T.span_hashes(data, middle[k], e[k]) ^ _WHOLE, False)
        k = np.flatnonzero(~core)
        if len(k):
            at[k, 0], size[k, 0] = self._known(data, s[k], e[k], T.span_hashes(data, s[k], e[k]) ^ _WHOLE, False)
        at, size = at.ravel(), size.ravel()
        total = np.cumsum(size)
        ids = self.memory.pool[np.repeat(at - (total - size), size) + np.arange(total[-1] if len(total) else 0)]
        ends = np.concatenate([[0], total])[::2]
        return ids, ends[T.bounds(doc, len(off) - 1)]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer (and its memory) per worker process."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64())])

    @T.tidy
    def run(batches):
        words, last, step = word_tokenizer(path), np.array([end_id], "<u4").tobytes(), 4 * capacity
        for b in batches:
            rows, docs = [], b.column(0).to_pylist()
            for first, _, data, off in T.chunks(b.column(1)):
                ids, ends = words.encode(data, off)
                raw, ends = ids.astype("<u4", copy=False).tobytes(), (4 * ends).tolist()
                for k, (i, j) in enumerate(zip(ends, ends[1:])):
                    doc = docs[first + k]
                    for p, at in enumerate(range(i, j + 4, step)):
                        part = raw[at:min(at + step, j)]
                        crc, size = zlib.crc32(part), len(part)
                        if at + step > j:       # the last piece ends with the end mark
                            crc, size = zlib.crc32(last, crc), size + 4
                        rows.append((doc, p, p * capacity, size // 4, crc))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema) \
                if rows else T.empty_batch(schema)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """Least squares with x >= 0 (active set: Lawson and Hanson)."""
    n = a.shape[1]
    x, on = np.zeros(n), np.zeros(n, bool)
    tol = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(rounds):
        grad = a.T @ (b - a @ x)
        grad[on] = -np.inf
        j = int(np.argmax(grad))
        if grad[j] <= tol:
            break
        on[j] = True
        while True:
            z = np.zeros(n)
            z[on] = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            bad = on & (z <= 0)
            if not bad.any():
                break
            step = np.min(x[bad] / np.maximum(x[bad] - z[bad], 1e-300))
            x = x + step * (z - x)
            on &= x > 1e-12
            x[~on] = 0
            if not on.any():
                z = x
                break
        x = z
    return x


def _patterns(units: int, docs: int, present: list[int]) -> list[tuple[int, ...]]:
    """Non-increasing tuples of at most ``docs`` present lengths that sum to ``units``."""
    found, have = [], sorted(present, reverse=True)

    def grow(left: int, most: int, part: tuple[int, ...]):
        if left == 0:
            found.append(part)
        elif len(part) < docs:
            slots = docs - len(part)
            for u in have:
                if u <= min(left, most):
                    if u * slots < left:
                        break
                    grow(left - u, u, part + (u,))

    grow(units, units, ())
    return found


def plan(histogram: dict[int, int], capacity: int = CAPACITY, units: int = UNITS,
         docs: int = PATTERN_DOCS) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, first rank, end rank, first sequence, offset)`` that place every piece.

    The size of the plan depends on the number of different lengths (at most
    ``capacity``), not on the number of pieces.
    """
    unit = max(1, capacity // units)
    units = capacity // unit
    left = {n: c for n, c in histogram.items() if c > 0}
    coarse: dict[int, int] = {}
    for n, c in left.items():
        coarse[-(-n // unit)] = coarse.get(-(-n // unit), 0) + c
    # short pieces are left for the residual step, where they fill the room that rounding leaves
    present = [u for u in coarse if 1 < u <= units]
    done: list[tuple[tuple[int, ...], int]] = []        # (lengths in a sequence, sequences)
    if present:
        shapes = _patterns(units, docs, present)
        if shapes:
            rows = {u: k for k, u in enumerate(present)}
            a, h = np.zeros((len(present), len(shapes))), np.array([coarse[u] for u in present], float)
            for j, shape in enumerate(shapes):
                for u in shape:
                    a[rows[u], j] += 1
            weight = np.array([u / units for u in present])[:, None]
            counts = np.floor(nnls(a * weight, h * weight[:, 0]) + 1e-6).astype(np.int64)
            by_unit = {u: sorted((n for n in left if -(-n // unit) == u), reverse=True) for u in present}
            for j in np.argsort(-counts, kind="stable"):
                need = int(counts[j])
                while need > 0:
                    take, picked, used = need, [], {}
                    for u in shapes[j]:                 # the longest length left of each coarse length
                        n = next((n for n in by_unit[u] if left[n] > used.get(n, 0)), None)
                        if n is None:
                            take = 0
                            break
                        used[n] = used.get(n, 0) + 1
                        picked.append(n)
                    if not take:
                        break
                    take = min([need, *(left[n] // k for n, k in used.items())])
                    for n, k in used.items():
                        left[n] -= take * k
                    done.append((tuple(picked), take))
                    need -= take
    # residual pieces, longest first, each into the sequences with the least room that fits
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for shape, count in done:
        room.setdefault(capacity - sum(shape), []).append((shape, count))
    rooms = sorted(room)

    def add(space: int, shape: tuple[int, ...], count: int) -> None:
        if space not in room:
            room[space] = []
            bisect.insort(rooms, space)
        room[space].append((shape, count))

    for n in sorted((n for n, c in left.items() if c > 0), reverse=True):
        need = left[n]
        while need:
            at = bisect.bisect_left(rooms, n)
            if at == len(rooms):
                fit = capacity // n
                full, rest = divmod(need, fit)
                if full:
                    add(capacity - fit * n, (n,) * fit, full)
                if rest:
                    add(capacity - rest * n, (n,) * rest, 1)
                break
            space = rooms[at]
            shape, count = room[space].pop()
            if not room[space]:
                del room[space], rooms[at]
            fit = space // n                            # as many of this length as fit
            full = min(count, need // fit)
            if full:
                add(space - fit * n, shape + (n,) * fit, full)
                need, count = need - full * fit, count - full
            if count and 0 < need < fit:
                add(space - need * n, shape + (n,) * need, 1)
                need, count = 0, count - 1
            if count:
                add(space, shape, count)
    # number the sequences and the pieces of each length
    runs, rank, sequence = [], dict.fromkeys(histogram, 0), 0
    for space in rooms:
        for shape, count in room[space]:
            offset = 0
            for n in shape:
                runs.append((n, rank[n], rank[n] + count, sequence, offset))
                rank[n] += count
                offset += n
            sequence += count
    return runs


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of every row of ``docs``: ``doc_id, piece, start, length,
    ids_crc32, sequence_id, offset``.

    A null or empty text is the end id alone.  Repeated rows are packed as often as they
    occur; a null id is passed on; other columns are ignored; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    cut = keep(pieces(docs, path or tokenizer_path(), capacity, end_id, id_col, text_col), "pieces")
    cut = cut.withColumn("_one", F.lit(1).cast("long"))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("_one").alias("n")).collect()}
    runs = sorted(plan(histogram, capacity))
    share = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(1 << 20)) / float(1 << 20)
    ranked = running_total(cut, ["length"], share, [F.col("_share"), F.col("doc_id"), F.col("piece")], "_one", "rank")
    lengths = np.array([r[0] for r in runs], np.int64)
    first, end, seq, offset = (np.array([r[k] for r in runs], np.int64) for k in (1, 2, 3, 4))
    starts = {int(n): (int(a), int(b)) for n in np.unique(lengths)
              for a, b in [np.searchsorted(lengths, [n, n + 1])]}
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches):
        for b in batches:
            n, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            at = np.zeros(len(n), np.int64)
            for x in np.unique(n):
                lo, hi = starts[int(x)]
                here = n == x
                at[here] = lo + np.searchsorted(first[lo:hi], rank[here], side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in range(5)], pa.array(seq[at] + rank - first[at]), pa.array(offset[at])], schema=schema)

    return ranked.select(*names, "rank").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
