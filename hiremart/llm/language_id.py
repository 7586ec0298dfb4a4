"""Operator 5: language identification by a byte convolutional network.

Filters of several widths over byte embeddings, max pooling over a fixed-length
window and a softmax, trained in numpy on a bounded sample of labelled windows.
Whole texts are cut into windows; a text's language is that of the greatest mean
probability, each window weighted by its bytes.  For prediction each filter is
folded into tables over byte pairs, so a position costs a few table rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

from hiremart.llm import textarrays as T
from hiremart.llm.frames import prepare

#: Bytes in a window, filter widths, filters of each width, embedding size.
WINDOW, WIDTHS, FILTERS, EMBED = 256, (2, 3, 4), 16, 8
#: The training sample's bounds: documents of a language, windows of a document.
DOCS_PER_LANG, WINDOWS_PER_DOC = 400, 4
EPOCHS, BATCH, RATE = 10, 64, 0.01


def sample_windows(docs: DataFrame, usable: Column, docs_per_lang: int = DOCS_PER_LANG,
                   windows_per_doc: int = WINDOWS_PER_DOC, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang") -> list[tuple[str, bytes]]:
    """A bounded training sample: the ``docs_per_lang`` documents of each language with the
    least hashed ids, ``windows_per_doc`` windows of each, evenly spaced."""
    step = 3 * WINDOW // 4       # code points; at most WINDOW bytes are used of each
    rows = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col), F.lit(5)).alias("h"),
        F.col(id_col).alias("id"),
        F.transform(F.sequence(F.lit(0), F.lit(windows_per_doc - 1)), lambda k: F.substring(
            F.col(text_col), (F.floor(F.greatest(F.length(text_col) - step, F.lit(0)) * k / max(1, windows_per_doc - 1)) + 1)
            .cast("int"), F.lit(WINDOW))).alias("parts"))
    best = rows.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "id")))
    got = best.where(F.col("r") <= docs_per_lang).select("lang", "h", "id", "parts").collect()
    out = []
    for r in sorted(got, key=lambda r: (r["lang"], r["h"], str(r["id"]))):
        out += [(r["lang"], p.encode("utf-8")[:WINDOW]) for p in dict.fromkeys(r["parts"]) if p.strip()]
    return out


class ByteCNN:
    """The network; ``fit`` trains it, ``probabilities`` applies it to windows of bytes."""

    def __init__(self, langs: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.langs, self.rng = langs, rng
        self.p = {"embed": rng.normal(0, 0.5, (256, EMBED))}
        self.p["embed"][0] = 0
        for w in WIDTHS:
            self.p[f"w{w}"] = rng.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS))
            self.p[f"b{w}"] = np.zeros(FILTERS)
        self.p["out"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs)))
        self.p["bias"] = np.zeros(len(langs))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _step(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy of a batch of windows."""
        p, n = self.p, len(x)
        e = p["embed"][x]                                               # n, window, embed
        feats, args, patches = [], [], []
        for w in WIDTHS:
            view = np.lib.stride_tricks.sliding_window_view(e, w, axis=1).transpose(0, 1, 3, 2)
            flat = np.ascontiguousarray(view).reshape(n, -1, w * EMBED)
            z = flat @ p[f"w{w}"] + p[f"b{w}"]
            at = z.argmax(1)                                            # n, filters
            feats.append(np.take_along_axis(z, at[:, None], 1)[:, 0])
            args.append(at)
            patches.append(flat[np.arange(n)[:, None], at])             # n, filters, w * embed
        f = np.concatenate(feats, 1)
        act = np.maximum(f, 0)
        logits = act @ p["out"] + p["bias"]
        prob = np.exp(logits - logits.max(1, keepdims=True))
        prob /= prob.sum(1, keepdims=True)
        prob[np.arange(n), y] -= 1
        d = prob / n
        g = {"out": act.T @ d, "bias": d.sum(0), "embed": np.zeros_like(p["embed"])}
        df = (d @ p["out"].T) * (f > 0)
        for k, w in enumerate(WIDTHS):
            dz = df[:, k * FILTERS:(k + 1) * FILTERS]
            g[f"w{w}"] = np.einsum("nfp,nf->pf", patches[k], dz)
            g[f"b{w}"] = dz.sum(0)
            de = dz[:, :, None] * p[f"w{w}"].T[None]                    # n, filters, w * embed
            at = args[k][:, :, None] + np.arange(w)
            np.add.at(g["embed"], x[np.arange(n)[:, None, None], at], de.reshape(n, FILTERS, w, EMBED))
        g["embed"][0] = 0
        return g

    def fit(self, windows: list[tuple[str, bytes]], epochs: int = EPOCHS) -> "ByteCNN":
        place = {lang: k for k, lang in enumerate(self.langs)}
        x = np.zeros((len(windows), WINDOW), np.uint8)
        for k, (_, b) in enumerate(windows):
            x[k, :len(b)] = np.frombuffer(b, np.uint8)
        x, y = T.LOWER[x], np.array([place[lang] for lang, _ in windows])
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(u) for k, u in self.p.items()}
        t = 0
        for _ in range(epochs):
            order = self.rng.permutation(len(x))
            for i in range(0, len(order), BATCH):
                at = order[i:i + BATCH]
                xb = x[at].copy()
                short = self.rng.random(len(at)) < 0.4                  # short texts too
                cut = self.rng.integers(12, WINDOW, len(at))
                xb[short[:, None] & (np.arange(WINDOW) >= cut[:, None])] = 0
                t += 1
                for k, g in self._step(xb, y[at]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.p[k] = (self.p[k] - RATE * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)
        return self

    def tables(self) -> dict[str, np.ndarray]:
        """Each filter over its bytes, as sums of rows of byte and byte-pair tables."""
        e, out = self.p["embed"], {}
        for w in WIDTHS:
            rows = [e @ self.p[f"w{w}"][k * EMBED:(k + 1) * EMBED] for k in range(w)]
            rows[0] = rows[0] + self.p[f"b{w}"]
            for k in range(0, w, 2):
                out[f"{w},{k}"] = (rows[k][:, None] + rows[k + 1][None]).reshape(65536, FILTERS) if k + 1 < w else rows[k]
        return {k: np.ascontiguousarray(v, np.float32) for k, v in out.items()} | {
            "out": self.p["out"], "bias": self.p["bias"]}


def probabilities(tables: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Softmax of every window of the byte matrix ``x`` (lower-cased, zero padded)."""
    out = []
    for i in range(0, len(x), 256):
        b = x[i:i + 256].astype(np.int32)
        pair = (b[:, :-1] << 8) | b[:, 1:]
        feats = []
        for w in WIDTHS:
            z, n = None, b.shape[1] - w + 1
            for k in range(0, w, 2):
                part = np.take(tables[f"{w},{k}"], (pair if k + 1 < w else b)[:, k:k + n], axis=0)
                z = part if z is None else np.add(z, part, out=z)
            feats.append(z.max(1))
        logits = np.maximum(np.concatenate(feats, 1), 0) @ tables["out"] + tables["bias"]
        p = np.exp(logits - logits.max(1, keepdims=True))
        out.append(p / p.sum(1, keepdims=True))
    return np.concatenate(out) if out else np.zeros((0, len(tables["bias"])))


def text_probabilities(tables, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Mean probability of each text of a chunk over all its windows, weighted by bytes."""
    size = np.diff(off)
    count = -(-size // WINDOW)
    first = np.concatenate([[0], np.cumsum(count)])
    x = np.zeros(int(first[-1]) * WINDOW, np.uint8)
    x[np.arange(len(data)) + np.repeat(first[:-1] * WINDOW - off[:-1], size)] = T.LOWER[data]
    prob = probabilities(tables, x.reshape(-1, WINDOW))
    owner = np.repeat(np.arange(len(size)), count)
    weight = np.minimum(size[owner] - (np.arange(len(owner)) - first[owner]) * WINDOW, WINDOW).astype(float)
    total = np.zeros((len(size), prob.shape[1]))
    np.add.at(total, owner, prob * weight[:, None])
    return total / np.maximum(size, 1)[:, None]


def has_letter(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Does each text hold a letter (of any script)?"""
    ascii_ = np.zeros(256, bool)
    ascii_[65:91] = ascii_[97:123] = True
    c = np.concatenate([[0], np.cumsum(ascii_[data])])
    out = c[off[1:]] > c[off[:-1]]
    for k in np.flatnonzero(~out & (off[1:] > off[:-1])):
        out[k] = any(map(str.isalpha, data[off[k]:off[k + 1]].tobytes().decode("utf-8", "replace")))
    return out


def learn(docs: DataFrame, usable: Column, **options) -> tuple[list[str], dict[str, np.ndarray]] | None:
    """The languages and tables learned from the usable documents, or None without labelled text.
    The sample (bounded by its parameters) is the only data that reaches the driver."""
    windows = sample_windows(docs, usable, **options)
    langs = sorted({lang for lang, _ in windows})
    return (langs, ByteCNN(langs).fit(windows).tables()) if langs else None


def _judge(model, col: pa.Array) -> tuple[list[str], np.ndarray]:
    """The language and score of every text of a column."""
    if model is None:
        return ["und"] * len(col), np.zeros(len(col))
    langs, scores = [], [np.zeros(0)]
    for _, _, data, off in T.chunks(col):
        prob = text_probabilities(model[1], data, off)
        letter, best = has_letter(data, off), prob.argmax(1)
        langs += [model[0][k] if ok else "und" for k, ok in zip(best, letter)]
        scores.append(np.where(letter, np.clip(prob.max(1), 0, 1), 0.0))
    return langs, np.concatenate(scores)


def identify(docs: DataFrame, model, extra: list[str] = [], id_col: str = "doc_id",  # noqa: B006
             text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row of ``docs`` (and the columns ``extra``).

    ``und`` with score 0 where the text is null or has no letter, or nothing was
    learned.  Only the text is looked at.  Repeated rows get equal results; null ids
    are passed on; an empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)     # a few MB of tables, whatever the corpus
    kinds = dict(docs.dtypes)

    @T.tidy
    def run(batches):
        for b in batches:
            lang, score = _judge(shared.value, b.column(b.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names=[*b.schema.names[:-1], "lang_pred", "score"])

    cols = [F.col(id_col).cast("long").alias("doc_id"), *extra]
    out = ", ".join(["doc_id long", *[f"`{c}` {kinds[c]}" for c in extra], "lang_pred string", "score double"])
    return docs.select(*cols, F.col(text_col).cast("string").alias("_text")).mapInArrow(run, out)


def identify_rows(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """``row, lang_pred, score``: as ``identify``, with the whole input row as one struct, so
    that its columns may have any names and the text is carried once."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    at = docs.columns.index(text_col)

    @T.tidy
    def run(batches):
        for b in batches:
            lang, score = _judge(shared.value, b.column(0).flatten()[at].cast(pa.large_string()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names=["row", "lang_pred", "score"])

    more = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return rows.mapInArrow(run, StructType([*rows.schema.fields, *more]))


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text is divisible by 5 (a null id: as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0
