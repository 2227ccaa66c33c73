"""SimHash near-dedup, bottom-k fingerprints and language-model scores against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import xxhash
from pyspark.sql import functions as F

import pytest

from adlake.llm import components, fingerprints, lm_scoring, queries, simhash


def _simhash(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(pairs, vertices):
    root = {v: v for v in vertices}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {v: find(v) for v in vertices}


def test_near_duplicates_match_brute_force(documents):
    rows = documents.select("doc_id", "text").collect()
    fp = {r.doc_id: _simhash(r.text) for r in rows}
    ids = sorted(fp)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if (fp[a] ^ fp[b]).bit_count() <= 2]
    want = {k: (f"{fp[k]:016x}", c) for k, c in _groups(pairs, ids).items()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(documents).collect()}
    assert got == want


def test_links_lose_nothing_in_dense_buckets(spark):
    rng = random.Random(3)
    base, fps = rng.getrandbits(64), set()
    while len(fps) < 300:  # one large family of near copies beside random ones
        x = base
        for _ in range(rng.randint(0, 4)):
            x ^= 1 << rng.randrange(64)
        fps.add(x if len(fps) % 10 else rng.getrandbits(64))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 2}
    for limit in (256, 3):  # with and without refined keys
        got = simhash.links(df, bucket_limit=limit).collect()
        assert {(r.u, r.v) for r in got} == want and len(got) == len(want)
    want3 = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 3}
    assert {(r.u, r.v) for r in simhash.links(df, max_distance=3, bucket_limit=5).collect()} == want3


def test_near_duplicates_odd_rows(odd, empty):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].component_id == by[2][0].component_id == by[12][0].component_id == 1
    assert {by[k][0].component_id for k in (4, 5, 6)} == {4} and by[4][0].fingerprint == "0" * 16
    assert len(by[7]) == 2 and by[9][0].component_id == 8 and by[None][0].component_id is None
    assert simhash.near_duplicates(empty).collect() == []
    kept = simhash.keep_one_per_group(odd, simhash.near_duplicates(odd))
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(7) == 1 and 2 not in ids and 1 in ids and None in ids and 5 not in ids


def test_components_of_a_long_path_and_a_star(spark):
    n = 400
    edges = [(i, i + 1) for i in range(n)] + [(10_000, 10_000 + i) for i in range(1, 200)] + [(5, 5), (None, 3)]
    got = components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    roots = {}
    for r in got:
        roots.setdefault(r.root, set()).add(r.vertex)
    assert sorted(map(len, roots.values())) == [200, n + 1]


def _next(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    return [(a[0], a[1] or "", order[(i + 1) % len(order)][1] or "") for i, a in enumerate(order)]


def _sketch(text, k=64):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_fingerprint_edits_match_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: r for r in fingerprints.fingerprint_edits(documents).collect()}
    errors = []
    for doc_id, text, after in _next(rows):
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for near, other in ((r.near_edited, edited), (r.near_next, after)):
            a, b = _sketch(text), _sketch(other)
            errors.append(abs(near - (len(a & b) / len(a | b) if a | b else 1.0)))
    assert max(errors) < 0.35 and sum(errors) / len(errors) < 0.03


def test_successors_over_several_levels(spark):
    keys = sorted({random.Random(1).randrange(-10 ** 12, 10 ** 12) for _ in range(50)} | set(range(300)))
    got = fingerprints.successors(spark.createDataFrame([(k,) for k in keys + keys[:5]], "k long"), width=20, direct=15).collect()
    assert {r.k: r.next_k for r in got} == dict(zip(keys, keys[1:] + keys[:1])) and len(got) == len(keys)


def test_fingerprint_edits_odd_rows(odd, empty, spark):
    got = fingerprints.fingerprint_edits(odd).collect()
    assert len(got) == odd.count()
    want = {(i, len(t), hashlib.sha256((t[:len(t) - len(t) // 2] + a[:len(t) // 2]).encode()).hexdigest()) for i, t, a in _next([(r.doc_id, r.text) for r in odd.collect()])}
    assert {(r.doc_id, r.n_chars, r.edited_sha256) for r in got} == want
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[2].fingerprint == by[12].fingerprint and by[4].fingerprint == "" and by[4].near_next == 1.0
    assert fingerprints.fingerprint_edits(empty).collect() == []
    one = fingerprints.fingerprint_edits(odd.where("doc_id = 8")).collect()[0]
    assert one.near_next == 1.0


def test_sketches_merge_and_estimate(spark):
    whole = [f"w{i}" for i in range(3000)]
    df = spark.createDataFrame([(whole, whole[:1500], whole[1496:])], "a array<string>, b array<string>, c array<string>")
    df = df.select(*[fingerprints.sketch(c, 128).alias(c) for c in "abc"])
    r = df.select(
        (fingerprints.merge(F.col("b"), F.col("c"), 128) == F.col("a")).alias("same"), fingerprints.distinct_count(F.col("a"), 128).alias("n"),
        fingerprints.containment(F.col("b"), F.col("a"), 128).alias("inside"), fingerprints.resemblance(F.col("b"), F.col("a"), 128).alias("alike")).first()
    assert r.same and abs(r.n - 2996) < 900 and r.inside > 0.7 and abs(r.alike - 0.5) < 0.15


def _backoff(docs, order, least=2, alpha=0.4, ident=zlib.crc32):
    ids = {}
    for key, text in docs:
        ids.setdefault(key, []).append([ident(w) for w in (text or "").encode().lower().split()])
    count = Counter(tuple(x[i:i + n]) for many in ids.values() for x in many for n in range(1, order + 1) for i in range(len(x) - n + 1))
    total = sum(c for g, c in count.items() if len(g) == 1)

    def score(gram):
        if len(gram) == 1:
            return count[gram] / total
        return count[gram] / count[gram[:-1]] if count[gram] >= least else alpha * score(gram[1:])
    out = {}
    for key, many in ids.items():
        s = sum(math.log(score(tuple(x[max(0, i - order + 1):i + 1])) * alpha ** max(0, order - 1 - i)) for x in many for i in range(len(x)))
        out[key] = (sum(map(len, many)), s)
    return out


def test_backoff_scores_match_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    for order in (2, 3):
        want = _backoff(rows, order)
        for r in lm_scoring.score(documents, order=order, min_count=2).collect():
            n, s = want[r.doc_id]
            assert r.n_tokens == n and abs(r.log_score - s) < 1e-4 * max(1, abs(s))


def test_backoff_scores_odd_rows(odd, empty):
    for order, least in ((2, 2), (1, 1), (2, 1), (3, 1), (4, 1)):
        got = lm_scoring.score(odd, order=order, min_count=least).collect()
        want = _backoff([(r.doc_id, r.text) for r in odd.collect()], order, least)
        assert len(got) == odd.count()
        for r in got:
            n, s = want[r.doc_id]
            assert r.n_tokens == n and abs(r.log_score - s) < 1e-3 * max(1, abs(s)) and (r.per_token is None) == (n == 0)
        assert lm_scoring.score(empty, order=order, min_count=least).collect() == []


@pytest.mark.parametrize("often", [3, 40, 1000])
def test_backoff_in_many_parts_and_frequent_ngrams(spark, monkeypatch, often):
    common = " ".join(["the same pair of words"] * 30)
    rows = [(f"d{i % 37}", f"{common if i % 3 else ''} w{i % 7} x{i % 11} y{i % 5} " * (i % 4)) for i in range(60)] + [(None, common), ("one", "x1"), ("two", "x1 the")]
    monkeypatch.setattr(lm_scoring, "PART_GRAMS", 500)
    monkeypatch.setattr(lm_scoring, "PACKED_GRAMS", 300)
    monkeypatch.setattr(lm_scoring, "FREQUENT", often)
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    want = _backoff(rows, 3, least=1, ident=bytes)
    got = lm_scoring.score(df).collect()
    assert len(got) == len(rows)
    for r in got:
        n, s = want[r.doc_id]
        assert r.n_tokens == n and abs(r.log_score - s) < 1e-6 * max(1, abs(s))


def test_backoff_query_counts_every_ngram(spark, documents):
    want = _backoff([(r.doc_id, r.text) for r in documents.collect()], 3, least=1, ident=bytes)
    got = queries.op10_stupid_backoff(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == documents.count()
    for r in got:
        n, s = want[r.doc_id]
        assert r.n_tokens == n and abs(r.log_score - s) < 1e-4 * max(1, abs(s))


def test_backoff_tells_words_apart_that_share_a_crc(spark, odd):
    assert zlib.crc32(b"plumless") == zlib.crc32(b"buckeroo")
    twins = [(100, "plumless one two"), (101, "buckeroo one three"), (102, "plumless"), (103, "Buckeroo one two two one"), (104, "one two")]
    rows = twins + [(r.doc_id, r.text) for r in odd.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for order, least in ((1, 1), (2, 1), (3, 1), (4, 1), (2, 2), (3, 2)):
        want = _backoff(rows, order, least, ident=bytes)
        for r in lm_scoring.score(df, order=order, min_count=least).collect():
            n, s = want[r.doc_id]
            assert r.n_tokens == n and abs(r.log_score - s) < 1e-5 * max(1, abs(s))


def test_an_id_in_several_groups_loses_no_group(spark):
    """Id 5 repeats: its first text belongs to the group of id 3, its second and third begin groups of their own."""
    a, b, c = ("alpha one two three four five six seven", "beta uno dos tres cuatro cinco seis siete", "gamma un deux trois quatre cinq six sept")
    rows = [(3, a, 1), (5, a, 2), (5, b, 3), (5, b, 4), (5, c, 5), (7, b, 6), (8, "delta eins zwei drei vier fuenf sechs", 7), (None, c, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = simhash.keep_one_per_group(docs, simhash.near_duplicates(docs))
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted([(3, a), (5, b), (5, c), (8, rows[6][1])])
