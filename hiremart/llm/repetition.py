"""Operator 7: quality rules by repetition coverage.

Rolling hashes of several n-gram lengths find, within each whole text, the words
inside n-grams that occur twice or more; their characters and the characters of
repeated lines, as shares of all word characters, give the verdict.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremart.llm import textarrays as T
from hiremart.llm.frames import prepare

#: Most of a text's word characters, in percent, inside n-grams of n words found twice or more.
NGRAM_LIMITS = ((5, 30), (8, 25), (10, 20))
#: Most of its word characters, in percent, in lines equal to an earlier line.
LINE_LIMIT = 30
#: Base rules: least words; most percent of words in repeated 3-word windows.
MIN_WORDS, REPEAT_LIMIT = 50, 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between consecutive positions ``at``."""
    c = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=c[1:])
    return c[at[1:]] - c[at[:-1]]


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur twice or more; is it not the first occurrence."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = k[1:] == k[:-1]
    twice, later = np.empty(len(k), bool), np.empty(len(k), bool)
    twice[order], later[order] = same[1:] | same[:-1], same[:-1]
    return twice, later


def _covered(h: np.ndarray, doc: np.ndarray, salt: np.ndarray, n: int) -> np.ndarray:
    """Words inside an n-word window that its text holds twice or more."""
    w = T.window_hashes(h, n)
    cover = np.zeros(len(h) + 1, np.int64)
    if len(w):
        at = np.flatnonzero(doc[:len(w)] == doc[n - 1:])
        hit = at[_repeated(T.mix(w[at] ^ salt[doc[at]]))[0]]
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + n, -1)
    return np.cumsum(cover)[:-1] > 0


def measure(data: np.ndarray, off: np.ndarray, ngrams: tuple[int, ...]) -> dict[str, np.ndarray]:
    """The measures of every text of a chunk (see ``repetition_rules``)."""
    n = len(off) - 1
    s, e, doc = T.words(data, off)
    starts = (data & 0xC0) != 0x80          # first bytes of code points
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum(starts, out=points[1:])
    length = points[e] - points[s]
    h = T.span_hashes(data, s, e)
    salt = T.mix(np.arange(n, dtype=np.uint64) + np.uint64(1))
    at = T.bounds(doc, n)
    out = {"n_words": np.diff(at), "word_chars": _sums(length, at), "n_symbols": _sums(_SYMBOL[data], off)}
    out["n_repeat_words"] = _sums(_covered(h, doc, salt, 3), at)
    for k in ngrams:
        out[f"dup_{k}"] = _sums(length * _covered(h, doc, salt, k), at)
    # lines: runs between line feeds that hold a word
    ls, le, ld = T.words(data, off, _NEWLINE)
    count = np.zeros(len(data) + 1, np.int64)
    flags = np.zeros(len(data), np.int64)
    flags[s] = 1
    np.cumsum(flags, out=count[1:])
    flags[s] = length
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum(flags, out=chars[1:])
    worded = count[le] > count[ls]
    ls, le, ld = ls[worded], le[worded], ld[worded]
    later = _repeated(T.mix(T.span_hashes(data, ls, le) ^ salt[ld]))[1]
    la = T.bounds(ld, n)
    out["n_dup_lines"] = _sums(later.astype(np.int64), la)
    out["dup_line_chars"] = _sums((chars[le] - chars[ls]) * later, la)
    return out


def repetition_rules(docs: DataFrame, ngram_limits=NGRAM_LIMITS, line_limit: int = LINE_LIMIT,
                     min_words: int = MIN_WORDS, repeat_limit: int = REPEAT_LIMIT, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept`` and the characters covered: ``dup_<n>`` for
    each n-gram length and ``dup_line_chars``.

    ``base_failed``: fewer than ``min_words`` words or over ``repeat_limit`` percent of
    them in repeated 3-word windows.  ``kept``: not base_failed and every covered
    share at most its limit.  A null or empty text has all measures 0 and fails;
    repeated rows get equal results; ids (null too) are passed on; other columns are
    ignored.  Memory in a task is about 100 bytes per byte of a 2 MB chunk or of the
    longest text.
    """
    prepare(docs.sparkSession)
    sizes = tuple(n for n, _ in ngram_limits)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *[f"dup_{n}" for n in sizes],
             "dup_line_chars"]
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in names]])

    def run(batches):
        for b in batches:
            for i, j, data, off in T.chunks(b.column(1)):
                got = measure(data, off, sizes)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), *[pa.array(got[c].astype(np.int64)) for c in names]], schema=schema)

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, " + ", ".join(f"{c} long" for c in names))
    failed = f"n_words < {min_words} OR 100 * n_repeat_words > {repeat_limit} * n_words"
    fine = " AND ".join(f"100 * {c} <= {x} * word_chars" for c, x in
                        [*[(f"dup_{n}", x) for n, x in ngram_limits], ("dup_line_chars", line_limit)])
    return rows.withColumn("base_failed", F.expr(failed)).withColumn("kept", F.expr(f"NOT ({failed}) AND {fine}"))


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reference_measures(text: str | None, ngrams=tuple(n for n, _ in NGRAM_LIMITS)) -> dict[str, int]:
    """The same measures of one text, plainly, for tests."""
    text = text or ""
    w = _WORD.findall(text)
    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text)}

    def cover(n):
        seen: dict[tuple, list[int]] = {}
        for i in range(len(w) - n + 1):
            seen.setdefault(tuple(w[i:i + n]), []).append(i)
        return {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(n)}

    out["n_repeat_words"] = len(cover(3))
    out |= {f"dup_{n}": sum(len(w[i]) for i in cover(n)) for n in ngrams}
    lines, dup, chars = set(), 0, 0
    for line in text.split("\n"):
        if words := _WORD.findall(line):
            dup, chars = dup + (line in lines), chars + (line in lines) * sum(map(len, words))
            lines.add(line)
    return out | {"n_dup_lines": dup, "dup_line_chars": chars}
