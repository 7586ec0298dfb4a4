"""SimHash components, centroid clusters and whitening against brute force, with nulls, empty and
long texts, repeated rows, empty tables and extra columns of clashing names."""

import hashlib
import math
import random
import re
from fractions import Fraction

import numpy as np
import pytest
import xxhash

from hiremart.llm import laesa, simhash, whitening

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, fp string, block string, kind string, root string"
VECTORS = "vec_id long, embedding array<float>, x string, cluster string, y string, n string, component string"


# ------------------------------------------------------------------ simhash --
def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(v >> k & 1 for v in h) > len(h))


def classes(keys, linked):
    root = list(range(len(keys)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(keys)):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(keys))]


def components(ids, fps, radius=2):
    real = [i for i, d in enumerate(ids) if d is not None]
    link = lambda a, b: ids[real[a]] == ids[real[b]] or (fps[real[a]] ^ fps[real[b]]).bit_count() <= radius
    of = classes(real, link)
    least = {}
    for k, i in enumerate(real):
        least[of[k]] = min(least.get(of[k], ids[i]), ids[i])
    found = {i: least[of[k]] for k, i in enumerate(real)}
    return sorted(((ids[i], format(fps[i], "016x"), found.get(i)) for i in range(len(ids))), key=str)


def prose(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "Gamma", "delta", "eps", "été"]) + str(rng.randint(0, 40)) for _ in range(n))


@pytest.mark.parametrize("block,visitors,frontier", [(1 << 14, 1 << 18, 1 << 20), (7, 5, 64)])
def test_simhash_components_match_brute_force(spark, monkeypatch, block, visitors, frontier):
    for name, value in (("BLOCK", block), ("VISITORS", visitors), ("FRONTIER", frontier)):
        monkeypatch.setattr(simhash, name, value)
    rng = random.Random(2)
    texts = [None, "", " \n\t", "one", "ONE", "two  words", "two\nwords", "a b c", "A\x0bB\x0cC", "a b c d", "퟿ x"]
    texts += [prose(rng, 4000)]
    for n in (30, 200, 900):
        base = prose(rng, n).split()
        for _ in range(15):
            copy = list(base)
            copy[rng.randrange(n)] = "new" + str(rng.randint(0, 99))
            texts.append(" ".join(copy))
        texts += [" ".join(base)] * 4
    ids = [3 * i + 1 for i in range(len(texts))]
    ids[20], ids[25], ids[-1], ids[-2], ids[40] = ids[60], None, -5, None, ids[3]     # repeated and null ids
    rows = [(d, t, "f", "b", "k", "r") for d, t in zip(ids, texts)]
    out = simhash.simhash_components(spark.createDataFrame(rows, DOCS).repartition(3))
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in out.collect()), key=str)
    assert got == components(ids, [fingerprint(t) for t in texts])
    assert simhash.simhash_components(spark.createDataFrame([], DOCS)).count() == 0


def test_simhash_links_dense_and_scattered_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 40)
    monkeypatch.setattr(simhash, "VISITORS", 100)
    rng = random.Random(4)
    centres = [0, (1 << 64) - 1, 1 << 63, *[rng.getrandbits(64) for _ in range(6)]]
    fps = list(dict.fromkeys([c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for c in centres for _ in range(60)]))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()
    want = classes(fps, lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    at = {f: i for i, f in enumerate(signed)}
    edges = {tuple(sorted((at[r["a"]], at[r["b"]]), reverse=True)) for r in links}
    assert classes(fps, lambda i, j: (i, j) in edges) == want
    assert all(want[i] == want[j] for i, j in edges)


def test_gray_index_finds_all_neighbours():
    rng = np.random.default_rng(0)
    values = np.unique(np.concatenate([rng.integers(0, 2**63, 300, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)]))
    queries = np.concatenate([values[:50] ^ np.uint64(5), values[50:80]])
    index = simhash.GrayIndex(values)
    found = {(int(i), int(j)) for q, k in index.search(queries, 2) for i, j in zip(q, k)}
    assert found == {(i, j) for i, q in enumerate(queries) for j, v in enumerate(values) if int(q ^ v).bit_count() <= 2}
    assert list(simhash.GrayIndex(np.zeros(0, np.uint64)).search(queries, 2)) == []


# ----------------------------------------------------------- the embeddings --
def odd_vectors(rng, dims, n):
    good = [[rng.choice([-1, 0, 0.5, 3]) + rng.gauss(0, 0.2) for _ in range(dims)] for _ in range(n)]
    bad = [None, [], [1.0] * (dims - 1), [None] + [0.0] * (dims - 1), [math.nan] + [0.0] * (dims - 1), [math.inf] * dims]
    return good, bad


def vector_frame(spark, vectors, ids):
    return spark.createDataFrame([(i, v, "x", "c", "y", "n", "k") for i, v in zip(ids, vectors)], VECTORS).repartition(3)


def test_centroid_clusters_match_brute_force(spark):
    rng = random.Random(6)
    good, bad = odd_vectors(rng, 64, 130)
    good += [good[0]] * 40 + [[x + 1 / 256 for x in good[0]]]        # copies and ties
    ids = [*range(len(good)), *range(1000, 1000 + len(bad))]
    ids[7], ids[9], ids[11] = None, 12, 12
    x = np.floor(256 * np.array(good, np.float32).astype(float)).astype(np.int64)
    named = [i for i in range(len(good)) if ids[i] is not None]
    order = sorted(named, key=lambda i: (hashlib.sha256(f"2:{ids[i]}".encode()).hexdigest(), x[i].tolist()))[:40]
    c = x[order].copy()
    for k in range(6):
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        own = d.argmin(axis=1)
        if k < 5:
            for j in set(own.tolist()):
                c[j] = x[own == j].sum(axis=0) // (own == j).sum()
    d = d.min(axis=1)
    sha = [hashlib.sha256(",".join(map(str, v.tolist())).encode()).hexdigest() for v in c]
    want = sorted(((ids[i], int(own[i]), int(d[i]), int(d[own == own[i]].sum()), int(d.sum()), sha[own[i]])
                   for i in range(len(good))), key=str)
    table = vector_frame(spark, good + bad, ids)
    got = laesa.centroid_clusters(table)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert laesa.centroid_clusters(table.where("vec_id >= 1000")).count() == 0
    assert laesa.centroid_clusters(table.limit(0)).columns == got.columns
    few = laesa.centroid_clusters(table.where("vec_id < 5")).collect()      # fewer vectors than centroids
    assert [r["distance"] for r in few] == [0] * 5


def test_pivot_bounds_lose_no_centroid():
    rng = np.random.default_rng(3)
    for size in (3, 1 << 20, laesa.LARGEST):
        x, c = rng.integers(-size, size, (500, 64)), rng.integers(-size, size, (40, 64))
        c[7] = c[3]
        pivots = c[:12]
        far = np.sqrt(((x[:, None] - pivots[None]) ** 2).sum(axis=2))
        own, d = laesa.nearest(x, far, c, pivots)
        exact = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        assert (own == exact.argmin(axis=1)).all() and (d == exact.min(axis=1)).all()


def test_whitening_matches_brute_force(spark):
    rng = random.Random(8)
    good, bad = odd_vectors(rng, 10, 60)
    good += [good[0]] * 30
    ids = [*range(len(good)), *range(1000, 1000 + len(bad))]
    ids[7], ids[9] = None, 12
    table = vector_frame(spark, good + bad, ids)
    x = np.floor(64 * np.array(good, np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - fit.mean(axis=0)
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    out = whitening.whiten(table, components=6).collect()
    assert len(out) == 6 * len(good) and {r["n"] for r in out} == {n}
    rows = {}
    for r in out:
        rows.setdefault((r["vec_id"], r["deviation"]), {})[r["component"]] = r
    deviation = ((n * x - s) ** 2).sum(axis=1)
    w = (x - fit.mean(axis=0)) @ v[:, :6] / np.sqrt(e[:6])
    sign = [math.copysign(1, rows[0, deviation[0]][k + 1]["whitened"] * w[0, k]) for k in range(6)]
    for i in range(len(good)):
        r = rows[ids[i], deviation[i]]
        for k in range(6):
            assert abs(r[k + 1]["whitened"] - sign[k] * w[i, k]) < 1e-9
            assert abs(r[k + 1]["explained"] - e[k] / e.sum()) < 1e-12 and r[k + 1]["identity_error"] < 1e-9
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.where("vec_id >= 1000")).count() == 0
    assert whitening.whiten(table.where("vec_id = 1")).count() == 0         # one distinct vector: no variance
    flat = vector_frame(spark, [[1.0, 2.0], [1.0, 5.0], [1.0, 8.0]], [1, 2, 3])
    assert sorted((r["vec_id"], r["component"], round(abs(r["whitened"]), 9)) for r in whitening.whiten(flat).collect()) == [
        (1, 1, 1.224744871), (2, 1, 0.0), (3, 1, 1.224744871)]


def test_characteristic_polynomial_and_roots(spark):
    # eigenvalues with multiplicities, zero among them: exact coefficients, exact counts
    basis = np.array([[1, 1, 1, 1], [1, -1, 1, -1], [1, 1, -1, -1], [1, -1, -1, 1]], object)
    m = basis @ np.diag([0, 7, 7, 10**15]).astype(object) @ basis.T
    p = whitening.characteristic_polynomial(spark, m)
    assert p == [0, -784 * 4 * 10**15, 784 + 56 * 4 * 10**15, -(4 * 10**15 + 56), 1]
    found = whitening.greatest_roots(p, 4)
    assert [k for _, k in found] == [1, 2]
    for (r, _), want in zip(found, (4 * 10**15, 28)):
        assert abs(r / want - 1) < Fraction(1, 2**100)
    values, vectors = whitening.components_of(spark, m, 4)
    assert len(values) == 3 and np.abs(vectors.T @ vectors - np.eye(3)).max() < 1e-14
    assert np.abs(m.astype(float) @ vectors - vectors * [float(v) for v in values]).max() < 1e3 * 1e-2
    assert [whitening.roots_above(p, x, 0) for x in (0, 27, 28, 29, 4 * 10**15)] == [3, 3, 1, 1, 0]


def test_exact_gram_of_large_entries():
    y = np.array([[2**31, -2**31, 5], [2**31 - 1, 3, -7]], np.int64)
    assert (whitening._gram(y) == y.astype(object).T @ y.astype(object)).all()


def test_packing_ids_equal_the_tokenizers_own(monkeypatch):
    import pyarrow as pa

    from hiremart.llm import packing, textarrays
    rng = random.Random(3)
    odd = ["\u0130stanbul", "\xd7", "a\xd7b", "\xb5m", "e\u0301t\xe9", "\xc9T\xc9!!", "--", "...", "a.b", "x-y-", "3rd", "\u4e2d\u6587", "\ufeffx",
           "\xdf\u017f", "don't", "(a)", "\u0149x", "<|endoftext|>", "a" * 5000, "\U0001f600,", "\xa0", "\u2003y", "A\u030a"]
    texts = [None, "", " ", *odd, *[" ".join(rng.choice(odd + ["The", "the,", "THE!", "word"]) for _ in range(60)) for _ in range(20)]]
    words = packing.WordTokenizer(packing.tokenizer_path())
    for room in (600_000, 5):           # remembered, and forgotten before every chunk
        monkeypatch.setattr(packing, "WORD_CACHE", room)
        for first, end, data, off in textarrays.chunks(pa.array(texts), 4000):
            ids, at = words.encode(data, off)
            for k in range(end - first):
                want = words.tokenizer.encode(texts[first + k] or "", add_special_tokens=False).ids
                assert ids[at[k]:at[k + 1]].tolist() == want, texts[first + k]


# ------------------------------------------- earlier operators, mended cases --
def test_ngram_join_links_through_an_id_with_several_texts(spark):
    from hiremart.llm import ngram_join
    rng = random.Random(5)
    a, b, c = (prose(rng, 60) for _ in range(3))
    near_b = b + " more"
    cases = [([5, 5, 3, 9], [a, b, a, near_b], {3: 3, 5: 3, 9: 3}), ([7, 7, 8], [a, b, c], {7: 7, 8: 8}),
             ([4, 6, 4, 6], [a, b, c, near_b], {4: 4, 6: 6}), ([2, 1, 2, 1], [a, a, b, c], {1: 1, 2: 1})]
    for ids, texts, want in cases:
        rows = [(d, t, "f", "b", "k", "r") for d, t in zip(ids, texts)]
        got = ngram_join.jaccard_components(spark.createDataFrame(rows, DOCS), 4, 85, 100).collect()
        assert len(got) == len(ids) and {(r["doc_id"], r["component_id"]) for r in got} == set(want.items())


def test_stages_take_tables_with_their_own_column_names(spark, tmp_path):
    import corpus_pipeline
    from hiremart.llm import language_id, mixing, secret_scan
    names = "doc_id long, text string, lang string, source string, score double, lang_pred string, _text string, _id string, _size long, row string, _doc string, x map<string,int>"
    texts = ["the cat and the dog were here " * 5, "der Hund und die Katze waren hier " * 5, "password = abcdefgh12 here", None, "12"]
    docs = spark.createDataFrame([(k, t, "en" if k % 2 == 0 else "de", "s", 0.5, "q", "t", "i", 3, "r", "d", {"a": 1})
                                  for k, t in enumerate(texts)], names)
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.language(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} <= {0, 1, 2}
    model = language_id.learn(docs, language_id.F.lit(True))
    one = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(docs, model).collect()}
    assert one == {r["row"]["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify_rows(docs, model).collect()}
    clean = secret_scan.redact(docs, secret_scan.scan(docs))
    assert clean.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in clean.collect()}[2] == "[secret] here"
    assert all(r["x"] == {"a": 1} and r["_size"] == 3 for r in clean.collect())
    for whole in (True, False):
        mixed = mixing.apply_mix(docs, mixing.mix(docs), whole=whole)
        assert mixed.columns == docs.columns and all(r["text"].startswith(texts[r["doc_id"]].split()[0]) for r in mixed.collect())
