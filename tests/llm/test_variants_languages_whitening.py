"""Spelling variants and whitening against brute force, language identification on held-out rows."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlake.llm import language_id, queries, spelling, whitening
from tests.llm.conftest import SF


# --- spelling variants -------------------------------------------------------

def brute_words(rows, least=7):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= 2}


def one_edit(u, v):
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    if len(u) > len(v):
        u, v = v, u
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def brute_variants(words, ratio=10):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= ratio * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, n, len(near[w]), form.get(w), words.get(form.get(w)), root(w)) for w, n in words.items())


def variants(docs, **more):
    rows = spelling.group_variants(docs, **more).select("word", "n", "n_near", "form", "form_n", "root").collect()
    return sorted(map(tuple, rows), key=lambda r: r[0])


def test_variants_equal_brute_force_on_documents(documents):
    docs = documents.where("doc_id < 60")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert variants(docs) == brute_variants(brute_words(rows))


@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_variants_of_crowded_initial_states(spark, limit):
    rng = random.Random(3)
    words = {"aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "äaaaaaaa", "aaaaaaaä", "×aaaaaaa"}
    words |= {"common" + "".join(p) for p in itertools.product("abc", repeat=4)}
    words |= {"".join(p) + "ending" for p in itertools.product("xyz", repeat=3)}
    words |= {"common" + "".join(rng.choices("abcd", k=rng.choice([3, 4, 5]))) for _ in range(60)}
    rows = [(i, " ".join([w] * rng.choice([2, 3, 30, 400]))) for i, w in enumerate(sorted(words))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert variants(docs, limit=limit) == brute_variants(brute_words(rows))


def test_initial_states_hold_at_most_the_limit(spark):
    words = spark.createDataFrame([("prefix" + "".join(p), 2) for p in itertools.product("abcde", repeat=4)], "word string, n long")
    sizes = spelling.initial_states(words, 10).groupBy("key").agg(F.count("*").alias("c"), F.max(F.col("high") - F.col("low")).alias("w"))
    assert sizes.where("c > 10 AND w > 1").count() == 0


def test_acceptor_is_minimal_and_exact():
    fsa = spelling.Acceptors()
    words = sorted({"tap", "taps", "top", "tops", "", "s"})
    start = fsa.add(words)
    found, open_ = [], [(start, "")]
    while open_:
        q, s = open_.pop()
        found += [s] if fsa.final[q] else []
        open_ += [(to, s + c) for c, to in fsa.moves[q].items()]
    assert sorted(found) == words
    assert len(fsa.final) == 5  # start, t., ta|to, tap|top, end


def test_variants_odd_rows(spark, odd, empty):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert variants(odd) == brute_variants(brute_words(rows))
    assert variants(empty) == []
    long = "z" * 30_000
    docs = spark.createDataFrame([(None, f"{long} {long}x"), (None, f"{long} {long}x"), (1, None), (2, "")], "doc_id long, text string")
    got = variants(docs)
    assert [(len(r[0]), r[2]) for r in got] == [(len(w), n) for w, _, n, *_ in brute_variants(brute_words([tuple(r) for r in docs.collect()]))]


# --- language identification -------------------------------------------------

def test_codewords_are_apart():
    for k in (2, 3, 4, 6, 9, 20):
        code = language_id.codewords(k)
        assert len({tuple(r) for r in code}) == k
        assert (np.abs(code.sum(axis=0)) < k).all()
        apart = min((code[a] != code[b]).sum() for a in range(k) for b in range(a))
        assert apart >= (2 ** (k - 2) if k <= language_id.EXHAUSTIVE else 5)


def test_one_wrong_bit_is_corrected():
    code = language_id.codewords(4)
    model = language_id.Decoder(list("abcd"), code, np.zeros((1, 7)), np.full(code.shape, 1 / 7))
    for k in range(4):
        for b in range(7):
            heard = code[k] * 2
            heard[b] *= -1
            model.margins = lambda x, m=heard: m[None, :]
            assert model.decode(np.zeros((1, 1)))[0][0] == k


def test_held_out_accuracy(spark, documents):
    got = queries.op12_language_id(spark, SF).join(documents.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == documents.count()
    crc = got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)
    assert (got.held_out == crc).all()
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() >= 0.97
    assert got.score.between(0, 1).all()


def test_held_out_labels_are_never_learnt(documents):
    changed = documents.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    a, b = (language_id.identify(d).select("doc_id", "lang_pred", "score") for d in (documents, changed.withColumn("source", F.lit("q"))))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_profile_of_a_long_text_is_that_of_its_pieces(monkeypatch):
    text = "Ein langer Satz, der mehrere Stücke füllt! " * 50
    whole = language_id.ngram_profile(text)
    monkeypatch.setattr(language_id, "CHUNK", 64)
    assert np.corrcoef(whole, language_id.ngram_profile(text))[0, 1] > 0.99
    assert language_id.ngram_profile("12 ²  ***") is None
    assert language_id.ngram_profile("") is None


def test_languages_odd_rows(spark, odd, empty):
    rows = odd.withColumn("lang", F.when(F.col("doc_id").isin(1, 7, 8, 12), "en").when(F.col("doc_id").isin(10, 11), "de"))
    clash = rows.withColumns({"held_out": F.lit("u"), "score": F.lit("v"), "doc": F.lit(1), "lang_pred": F.lit(2)})
    got = language_id.identify(clash).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got}
    for i in (4, 5, 6):
        assert (by[i]["lang_pred"], by[i]["score"], by[i]["ambiguous"]) == ("und", 0.0, False)
    assert all(r["held_out"] is (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert by[None]["held_out"] is False and by[None]["lang_pred"] in ("en", "de")
    assert language_id.identify(empty).count() == 0
    unknown = language_id.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in unknown} == {("und", 0.0)}
    single = language_id.identify(odd).where("doc_id = 1").first()
    assert (single["lang_pred"], single["score"], single["next_lang"]) == ("en", 1.0, None)


def test_repeated_id_is_learnt_once(spark):
    rows = [(1, "the same thing again", "en")] * 50 + [(3, "noch ein anderer Satz", "de"), (4, "une autre phrase", "fr"), (7, "ein Satz", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    x, languages, _ = language_id.training_profiles(docs)
    assert len(x) == len(languages) <= 4
    assert language_id.identify(docs).count() == len(rows)


# --- whitening ---------------------------------------------------------------

def brute_whitening(vectors, components=4):
    x = np.floor(256 * np.array(vectors, dtype=float))
    fit = np.unique(x, axis=0)
    n = len(fit)
    centred = fit - fit.mean(axis=0)
    values, u = np.linalg.eigh(centred.T @ centred / n)
    values, u = values[::-1][:components], u[:, ::-1][:, :components]
    total = [[int(v) for v in row] for row in fit]
    sums = [sum(c) for c in zip(*total)]
    deviation = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return n, deviation, (x - fit.mean(axis=0)) @ u / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def check_whitening(got, vectors, components=4):
    n, deviation, z, explained = brute_whitening(vectors, components)
    got = got.sort_values(["vec_id", "component"])
    k = z.shape[1]
    assert len(got) == len(vectors) * k and (got.n == n).all()
    assert got.deviation.tolist() == [d for d in deviation for _ in range(k)]
    mine = got.whitened.to_numpy().reshape(-1, k)
    assert np.allclose(mine * np.sign((mine * z).sum(axis=0)), z, atol=1e-8)
    assert np.allclose(got.explained.to_numpy()[:k], explained, rtol=1e-10)
    assert got.identity_error.nunique() == 1 and 0 <= got.identity_error.iloc[0] <= 1e-4


def test_whitening_equals_eigh(spark):
    got = queries.op13_embedding_whitening(spark, SF).toPandas()
    table = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").toPandas()
    check_whitening(got, np.array(table.embedding.tolist()))


def test_singular_values_to_relative_accuracy():
    # q e-products of a bidiagonal whose squared singular values are known: B'B of a triangle of ones
    n = 24
    diagonal, above = np.full(n, 1.0), np.full(n - 1, -1.0)
    exact = np.sort([4 * math.sin((2 * k - 1) * math.pi / (4 * n + 2)) ** 2 for k in range(1, n + 1)])[::-1]
    assert np.allclose(whitening.squared_singular_values(diagonal, above), exact, rtol=1e-13)
    graded = np.array([10.0 ** (-4 * k) for k in range(12)])
    got = whitening.squared_singular_values(graded, graded[1:] * 0)
    assert np.allclose(got, graded ** 2, rtol=1e-14)


@pytest.mark.parametrize("kind", ["plain", "graded", "rank", "identity", "orthogonal", "one_large", "zero"])
@pytest.mark.parametrize("d", [1, 2, 5, 40])
def test_directions_of_a_triangle(kind, d):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((d, d))
    a = {"plain": a, "graded": a * np.logspace(0, -12, d), "rank": a * (np.arange(d) < (d + 1) // 2), "identity": np.eye(d),
         "orthogonal": np.linalg.qr(a)[0], "one_large": np.outer(a[:, 0], a[0]) + 1e-9 * a, "zero": a * 0}[kind]
    r = np.linalg.qr(a, mode="r")
    values, vectors, none = whitening.leading_directions(r, 4)
    assert np.allclose(np.sqrt(values), np.linalg.svd(r)[1], rtol=1e-10, atol=1e-13)
    assert np.allclose(vectors.T @ vectors, np.eye(vectors.shape[1]), atol=1e-12)
    assert np.allclose(r.T @ r @ vectors, vectors * values[:vectors.shape[1]], atol=1e-12 * max(values[0], 1e-3))
    rank = {"rank": (d + 1) // 2, "zero": 0}.get(kind, d)
    assert none.tolist() == [k >= rank for k in range(min(d, 4))]


def test_triangles_join_in_a_tree(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-99, 99, (300, 6))
    vectors = spark.createDataFrame([(r,) for r in x.tolist()], "x array<bigint>").repartition(23)
    mean = x.mean(axis=0)
    r = whitening.triangle_of(vectors, mean, fan_in=3)
    assert np.allclose(r.T @ r, (x - mean).T @ (x - mean))


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = rng.standard_normal((40, 5)).astype(np.float32)
    rows = [(i, v) for i, v in enumerate(good.tolist())] + [(100 + i, good[0].tolist()) for i in range(30)] + [(200, good[1].tolist())] * 2
    kept = [v for _, v in rows]
    rows += [(300, None), (301, [1.0, None, 1.0, 1.0, 1.0]), (302, [float("nan")] * 5), (303, [float("inf")] + [0.0] * 4), (304, []), (305, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"x": F.lit("c"), "n": F.lit("d"), "component": F.lit("e")})
    got = whitening.whiten(table).toPandas()
    got["order"] = range(len(got))
    assert set(got.vec_id) == {i for i, _ in rows} - {300, 301, 302, 303, 304, 305}
    assert (got[got.vec_id == 200].groupby("component").whitened.nunique() == 1).all()
    check_whitening(got[got.vec_id != 200], kept[:-2])
    assert whitening.whiten(table.where("false")).count() == 0
    assert whitening.whiten(table.where("vec_id >= 300 AND vec_id <= 304")).count() == 0
    same = whitening.whiten(table.where("vec_id BETWEEN 100 AND 129 OR vec_id = 0")).toPandas()
    assert (same.n == 1).all() and same.whitened.isna().all() and same.explained.isna().all() and (same.deviation == 0).all()
    narrow = spark.createDataFrame([(None, [0.25]), (2, [0.5]), (3, [1.0])], "vec_id long, embedding array<double>")
    assert sorted(r["component"] for r in whitening.whiten(narrow).collect()) == [1, 1, 1]
    huge = spark.createDataFrame([(1, [1e30, 1.0]), (2, [-1e30, 2.0]), (3, [0.0, 3.0])], "vec_id long, embedding array<double>")
    assert {r["deviation"] for r in whitening.whiten(huge).where("vec_id < 3").collect()} == {None}


def test_mixing_trains_from_counts_without_python_numbers(spark):
    import tracemalloc

    import numpy as np

    from adlake.llm import mixing
    from adlake.llm.linear import multinomial
    n = 1500
    text = [f"{'the cat and the' if k % 2 else 'der hund und die'} {k * 7919} words" for k in range(n)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(text)], "doc_id long, text string")
    labelled = spark.createDataFrame([(k, "en" if k % 2 else "de") for k in range(n)], "doc_id long, domain string")
    tracemalloc.start()
    mix = mixing.train(docs, labelled, ["de", "en"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    x = np.array([np.append(mixing.text_features(t), 1) for t in text])
    assert np.allclose(mix.weights, multinomial(x, np.arange(n) % 2, 2))
    assert peak < 4 * x.nbytes
