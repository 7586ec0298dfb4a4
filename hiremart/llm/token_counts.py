"""Operator 2: edit-aware token counts.

A document's text is cut into leaves at places where no pre-token can span (a white
space after a non-space); a segment tree per document sums the leaves' token counts.
An edit re-encodes only the leaves it touches, plus a neighbour where the edit reaches
a leaf's border, and updates the sums above them.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremart.llm.frames import prepare

#: Chunks (white space and the word after it) in a leaf.
LEAF_CHUNKS = 32
TOKENIZER = "byte_bpe_50k.tiktoken"
#: Fixed value: the pre-tokens of that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_CHUNK = re.compile(r"\s*\S+|\s+")
#: White space beyond U+0020 and U+0009..U+000D: a cut next to it is not taken for safe.
_RARE = re.compile("[\x1c-\x1f\x85\xa0  -​    　﻿]")
_SAFE = re.compile(r"(?<=[^\s\x1c-\x1f​﻿])(?=[\x20\x09-\x0D])")


def chunks(text: str) -> list[str]:
    """The text cut at every safe place; token counts of the chunks add up to the text's."""
    if _RARE.search(text):
        return [c for c in _SAFE.split(text) if c]
    return _CHUNK.findall(text)


class Counter:
    """Token counts of texts by the ranks of a byte-level vocabulary."""

    def __init__(self, path: str):
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def counts(self, parts: list[str]) -> np.ndarray:
        return np.fromiter((len(self.encode(p)) for p in parts), np.int64, len(parts))


class Tree:
    """Leaf lengths (code points) and a binary tree of token sums over the leaves."""

    def __init__(self, sizes: np.ndarray, tokens: np.ndarray | None = None, sums: np.ndarray | None = None):
        self.sizes = np.array(sizes, np.int64)
        width = 1 << max(0, len(self.sizes) - 1).bit_length()
        if sums is None:
            sums = np.zeros(2 * width, np.int64)
            sums[width:width + len(self.sizes)] = tokens
            level = width
            while level > 1:
                sums[level // 2:level] = sums[level:2 * level].reshape(-1, 2).sum(1)
                level //= 2
        self.width, self.sums = width, np.array(sums, np.int64)

    @classmethod
    def of(cls, text: str, counter: Counter, leaf: int = LEAF_CHUNKS) -> "Tree":
        parts = chunks(text)
        if not parts:
            return cls(np.zeros(1, np.int64), np.zeros(1, np.int64))
        leaves = ["".join(parts[i:i + leaf]) for i in range(0, len(parts), leaf)]
        return cls(np.fromiter(map(len, leaves), np.int64, len(leaves)), counter.counts(leaves))

    @property
    def total(self) -> int:
        return int(self.sums[1]) if len(self.sums) > 1 else 0

    def _set(self, leaf: int, tokens: int) -> None:
        node = self.width + leaf
        change = tokens - self.sums[node]
        while change and node:
            self.sums[node] += change
            node //= 2

    def edit(self, text: str, start: int, length: int, new: str, counter: Counter) -> tuple[str, int]:
        """Replaces ``length`` code points at ``start`` by ``new``; the new text and the
        number of code points that were encoded again."""
        start = min(max(start, 0), len(text))
        end = min(start + max(length, 0), len(text))
        ends = np.cumsum(self.sizes)
        first = int(np.searchsorted(ends, start, side="left"))      # a leaf that ends at the edit is touched too
        last = int(np.searchsorted(ends, end, side="right"))        # as is one that starts where it ends
        first, last = min(first, len(ends) - 1), min(last, len(ends) - 1)
        lo, hi = int(ends[first] - self.sizes[first]), int(ends[last])
        region = text[lo:start] + new + text[end:hi]
        self._set(first, int(counter.counts([region])[0]))
        self.sizes[first] = len(region)
        for leaf in range(first + 1, last + 1):
            self._set(leaf, 0)
            self.sizes[leaf] = 0
        return text[:lo] + region + text[hi:], len(region)


def _path(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def token_trees(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                carry: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, text, sizes, sums`` and the carried columns (name to SQL type) for every row:
    the leaf lengths and the tree of token sums (``sums[1]`` is the text's count).
    A null text is empty; repeated rows and null ids are passed on."""
    prepare(docs.sparkSession)
    place, carry = _path(path), carry or {}

    def run(batches):
        counter = Counter(place)
        for b in batches:
            trees = [Tree.of(t or "", counter) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([t.sizes for t in trees], pa.list_(pa.int64())),
                 pa.array([t.sums for t in trees], pa.list_(pa.int64()))], names=[*b.schema.names, "sizes", "sums"])

    kinds = "".join(f", `{c}` {kind}" for c, kind in carry.items())
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *carry).mapInArrow(
        run, f"doc_id long, text string{kinds}, sizes array<long>, sums array<long>")


EDITS = "array<struct<start:long,length:long,text:string>>"


def apply_edits(trees: DataFrame, path: str | None = None) -> DataFrame:
    """Applies the column ``edits`` (one after the other, each on the text the one before
    left) to the rows of ``token_trees``: ``doc_id, n_tokens, edited_tokens, n_chars,
    edited_chars, reencoded_chars``.  Null edits are none; positions beyond the text
    are its end."""
    place = _path(path)
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_tokens", "edited_tokens", "n_chars", "edited_chars", "reencoded_chars")])

    def run(batches):
        counter = Counter(place)
        for b in batches:
            rows = []
            for doc, text, edits, sizes, sums in zip(*(c.to_pylist() for c in b.columns)):
                text, tree, again = text or "", Tree(np.array(sizes), sums=np.array(sums)), 0
                before, chars = tree.total, len(text)
                for e in edits or []:
                    text, n = tree.edit(text, e["start"] or 0, e["length"] or 0, e["text"] or "", counter)
                    again += n
                rows.append((doc, before, tree.total, chars, len(text), again))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

    return trees.select("doc_id", "text", "edits", "sizes", "sums").mapInArrow(run, ", ".join(f"{c} long" for c in schema.names))


def edits_of(text_col: str = "text"):
    """Stand-in edits of a text: at a third of it a 64th is replaced by its first 32nd, and a
    line feed is put in at two thirds."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    n = F.length(t)
    return F.array(F.struct(F.floor(n / 3).cast("long").alias("start"), F.floor(n / 64).cast("long").alias("length"),
                            F.substring(t, F.lit(1), F.floor(n / 32).cast("int")).alias("text")),
                   F.struct(F.floor(2 * n / 3).cast("long").alias("start"), F.lit(0).cast("long").alias("length"),
                            F.lit("\n").alias("text"))).cast(EDITS)
