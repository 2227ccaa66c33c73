"""Tokenizers, rules, classifiers, mixing, extraction and URL verdicts against libraries, brute force or held-out rows."""

import base64
import hashlib
import json
import re
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from adlake.llm import byte_bpe, html_extract, mixing, quality_classifier, quality_rules, queries, token_counts, url_filter

RANKS, WORDS = P.path(queries.RANKS), P.path(queries.WORD_TOKENIZER)


def test_bpe_equals_the_library(documents, odd, empty):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for docs in (documents, odd):
        texts = Counter((r.doc_id, r.text or "") for r in docs.collect())
        got = queries.bpe_digests(docs, keep_ids=True).collect()
        want = Counter()
        for (i, t), n in texts.items():
            ids = own.encode_ordinary(t)
            want[(i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest(), tuple(ids))] += n
        assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.token_ids)) for r in got) == want
    assert queries.bpe_digests(empty).collect() == []
    one, two = byte_bpe.round_trip(odd, RANKS, P.PATTERN), byte_bpe.decode(byte_bpe.encode(odd, RANKS, P.PATTERN), RANKS, P.PATTERN)
    row = lambda r: (str(r.doc_id), r.token_ids, r.decoded)
    assert one.columns == two.columns and sorted(map(row, one.collect())) == sorted(map(row, two.collect()))


def test_perfect_hash_is_minimal_and_null_lists_decode_to_null():
    keys = [f"key{i}".encode() for i in range(3000)]
    index = byte_bpe.PerfectHash(keys)
    assert sorted(index.key_at.tolist()) == list(range(3000))
    assert index.find(keys).tolist() == list(range(3000)) and index.find([b"other"]).tolist() == [-1]
    codec = byte_bpe.ByteBpe(open(RANKS, "rb").read(), P.PATTERN)
    assert codec.decode(pa.array([None, [], [1, 2]], pa.list_(pa.int32()))).to_pylist() == [None, b"", codec.tokens[1] + codec.tokens[2]]


def test_token_counts_equal_the_library(documents, odd, empty):
    tok = Tokenizer.from_file(WORDS)
    count = lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    for docs in (documents, odd):
        want = Counter((r.doc_id, len((r.text or "").encode()), count(r.text or ""), count(r.text or "") > 300) for r in docs.collect())
        assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs, WORDS, 300).collect()) == want
    assert token_counts.count_tokens(empty, WORDS).collect() == []


def test_every_prefix_count_is_exact():
    tok, own = Tokenizer.from_file(WORDS), token_counts.PrefixCounter(open(WORDS, encoding="utf-8").read())
    for text in ("It's we'RE 'r 'll aaaaaaa unbelievable!!! 12 3é", "x<|endoftext|>y <|startoftext|", "日本 é́ ﬁne", ""):
        norm = "".join(p for p, _ in own._pieces(text))
        table = own.prefix_counts(text).tolist()
        assert table == [len(tok.encode(norm[:k], add_special_tokens=False).ids) for k in range(len(norm) + 1)]
        for budget in range(table[-1] + 1):
            assert own.fit(text, budget) == max(k for k, c in enumerate(table) if c <= budget)


def test_truncation_from_stored_tables(odd):
    tables = token_counts.prefix_tables(odd, WORDS)
    stored = {r.doc_id: r.prefix_counts for r in tables.collect()}
    for r in token_counts.truncate(tables, 10).collect():
        assert r.fit_chars == max(k for k, c in enumerate(stored[r.doc_id]) if c <= 10)


def _base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_rule_statistics_match_brute_force(spark, documents, odd, empty, labels):
    for docs, known in ((documents, spark.read.parquet("/root/testdata/sf0.001/labels.parquet")), (odd, labels)):
        want = Counter((r.doc_id, *_base(r.text or "")) for r in docs.collect())
        got = quality_rules.judge(docs, known).collect()
        assert Counter(tuple(r[:6]) for r in got) == want
        assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.kept and r.base_failed) for r in got)
        kept = quality_rules.keep(docs, known)
        assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)
    assert quality_rules.judge(empty, labels).collect() == []
    assert all(r.kept != r.base_failed for r in quality_rules.judge(odd, labels.where("false")).collect())


def test_forest_rejects_junk_and_keeps_good(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    for judged, least in ((quality_rules.judge(docs, labels), 0.8), (quality_classifier.judge(docs, labels), 0.8)):
        rows = judged.join(labels, "doc_id").collect()
        good = [r.kept for r in rows if r.quality and not r.toxic and r["kept"] is not None]
        assert np.mean(good) > 0.93 and np.mean([not r.kept for r in rows if not r.quality]) > least


def test_forests_reject_stuttered_words(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    stuttered = (1847, 2667, 4974, 7628, 7695)  # labelled bad, no symbols, no marks, ordinary capitals
    rows = quality_rules.judge(docs.join(labels, "doc_id", "left_semi"), labels).join(labels, "doc_id").collect()
    by = {r.doc_id: r for r in rows}
    assert not any(by[i].kept or by[i].base_failed for i in stuttered)
    assert np.mean([r.kept for r in rows if r.quality and not r.base_failed]) >= 0.998
    assert np.mean([not r.kept for r in rows if not r.quality]) > 0.99


def test_every_rule_statistic_has_a_feature():
    row = dict(zip([*quality_rules.BASE, *quality_rules.EXTRA], quality_rules.statistics("aa aa bb! Cc\n#x yy\n#x yy\n zz zz")))
    assert (row["n_lines"], row["n_stutter"]) == (4, 2)
    for name in (*quality_rules.BASE, "n_stutter"):
        other = row | {name: row[name] + 3}
        one, two = (quality_rules.features(np.array([list(r.values())])) for r in (row, other))
        assert (one != two).any(), name
    assert sorted(k for g in quality_rules.GROUPS for k in g) == list(range(one.shape[1]))


def test_classifier_odd_rows(odd, empty, labels):
    got = quality_classifier.judge(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.p_good <= 1 for r in got if r.p_good is not None)
    assert all(r.kept for r in quality_classifier.judge(odd, labels.where("false")).collect())
    assert quality_classifier.judge(empty, labels).collect() == []
    assert quality_classifier.keep(odd.select("doc_id", "text"), labels).columns == ["doc_id", "text"]


def test_mixing_meets_targets(spark, odd, empty, labels):
    docs, known = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    targets = {"en": 0.4, "fr": 0.2, "de": 0.3, "es": 0.1}
    rows = mixing.rates(docs, queries.domain_labels(docs, known), targets).collect()
    total = sum(r.n_tokens for r in rows)
    for name, share in targets.items():
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{name}"] for r in rows) / total - share) < 1e-4
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
    right = [max(targets, key=lambda d: r[f"p_{d}"]) == lang for r, lang in zip(rows, [x.lang for x in docs.collect()])]
    assert len(rows) == docs.count() and np.mean(right) > 0.95
    assert len(mixing.rates(odd, queries.domain_labels(odd, labels)).collect()) == odd.count()
    assert mixing.rates(empty, queries.domain_labels(empty, labels)).collect() == []
    assert mixing.apply(odd, queries.domain_labels(odd, labels)).columns == odd.columns


def test_mixing_reaches_targets_with_soft_posteriors(spark, odd, labels):
    rng = np.random.default_rng(0)
    names = ["a", "b", "c", "d"]
    for alpha in (0.5, 1.0):
        p, t = rng.dirichlet([alpha] * 4, 5000), rng.integers(1, 2000, 5000)
        df = spark.createDataFrame([(int(n), [float(v) for v in x]) for n, x in zip(t, p)], "_t long, _p array<double>").coalesce(2).cache()
        mix = mixing.fit(df, mixing.Mix(names, None), {"a": 0.1, "b": 0.1, "c": 0.1, "d": 0.7})
        r = np.array([x[0] for x in df.select(mix.rate("_p")).collect()])
        assert np.abs((r * t) @ p / t.sum() - [0.1, 0.1, 0.1, 0.7]).max() < 1e-5 and mix.residual < 1e-6
    one = mixing.rates(odd, queries.domain_labels(odd, labels), {"en": 0.5, "fr": 0.5}).collect()  # no row is French
    total = sum(r.n_tokens for r in one)
    miss = max(abs(sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in one) / total - 0.5) for d in ("en", "fr"))
    assert len({r.residual for r in one}) == 1 and abs(one[0].residual - miss) < 1e-4


def test_html_extraction(spark):
    crf = html_extract.train(html_extract.labelled_pages())
    right = n = 0
    for page in html_extract.labelled_pages(40, seed=99):  # held out
        cut = html_extract.blocks(page)
        right += sum(b.main == bool(y) for b, y in zip(cut, crf.viterbi(html_extract.features(cut))))
        n += len(cut)
    assert right / n > 0.97
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    import html
    for r in html_extract.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]+>", " ", article)).split()) and r.n_chars == len(r.text)
    odd = spark.createDataFrame([(1, None, None), (1, "u", ""), (2, "u", "<<p>&nosuch; <a href='x>"), (3, "u", "<article><p>a<p>b"), (None, "u", "<p>" * 3000)],
                                "page_id long, url string, html string")
    assert len(html_extract.extract(odd).collect()) == 5 and html_extract.extract(odd.where("false")).collect() == []


def test_html_blocks_lose_no_text():
    for tag in ("svg", "math", "object", "canvas", "video", "audio", "select"):
        for own in (f"<{tag}/>", f"<{tag} src=x/>", f"<{tag}>"):
            assert [b.text for b in html_extract.blocks(f"<article><p>one {own} two</p><p>three</p></article>")] == ["one two", "three"], own
    cut = lambda page: " ".join(b.text for b in html_extract.blocks(page))
    assert cut("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>") == "so x=2 holds"
    assert cut("<p>a<svg><text>b</text></svg>c <select><option>d<option>e</select> f</p>") == "a b c d e f"
    assert cut("<p>a <b title=it's>bold</b> c</p><p>don't</p><p>e</p>") == "a bold c don't e"
    assert cut("""<p>a <b title="x>'y" alt = '>"'>b</b> <i "q>c</i> <a href='z>d</a></p>""") == "a b c d"
    assert cut("<title>t</title><script>a < '</b>'</script ><style-guide>one</style-guide><iframe src=x>y</iframe><p>two<noscript>n") == "one two"
    crf = html_extract.train(html_extract.labelled_pages())
    page = "<nav><a href=/a>home</a></nav><article><p>" + "long winter road " * 9 + "<svg/> and <math><mi>n</mi></math> more.</p><p>" + "the open field " * 9 + "ends.</p></article>"
    cut = html_extract.blocks(page)
    assert [b.text for b, y in zip(cut, crf.viterbi(html_extract.features(cut))) if y] == [("long winter road " * 9 + "and n more.").strip(), "the open field " * 9 + "ends."]


def _rule(host, path):
    fits = [(len(r), r, v) for r, v in url_filter.RULES
            for h, p in [(r.partition("/")[0], "/" + r.partition("/")[2])] if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_url_rules_and_verdicts(spark):
    urls = [None, "", "no scheme", "http://NET/x", "http://a.example.net/en/1?q#f", "https://example.net/EN/", "http://b.example.com/de/", "http://x.org/fr/9",
            "http://notnet/", "http://net", "http://q.net?x://y/", "://net/", "http://casino-win.example.com/en/1", "http://weather.example.com/en/676"]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls + urls[:2])], "page_id long, url string, host string")
    got = url_filter.judge(df, url_filter.labelled_urls(spark)).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        rest = (urls + urls[:2])[r.page_id] or ""
        rest = rest.split("://", 1)[1] if "://" in rest else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        rule, verdict = _rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or ("block" if r.score > 0.5 else "allow"))
    by = {r.page_id: r.verdict for r in got}
    assert by[12] == "block" and by[13] == "allow"
    assert url_filter.judge(df.where("false"), url_filter.labelled_urls(spark)).collect() == []


def test_pipeline_stages(spark, odd, empty, labels, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, "/root/testdata/sf0.001")
        assert after.columns == docs.columns, name
        docs = after
    assert 0 < docs.count() < before
    for t, rows in (("documents", empty), ("labels", labels)):
        rows.write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    odd.write.mode("overwrite").parquet(str(tmp_path / "odd"))
    out = spark.read.parquet(str(tmp_path / "odd"))
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, str(tmp_path))
    assert out.columns[:2] == ["doc_id", "n_tokens"]


def test_rules_count_every_labelled_row(spark):
    """Thresholds follow from all labelled rows, however many: 40 of 20,000 good ones may lie above."""
    rng = np.random.default_rng(3)
    kinds, scores = np.arange(60_000) % 3 == 0, rng.uniform(0.3, 0.9, 60_000)
    rows = spark.createDataFrame([(bool(k), True, [float(s), 0.5, 0.5]) for s, k in zip(scores, kinds)], "good boolean, passed boolean, scores array<double>")
    found = quality_rules.calibrate(rows, 3, 0.002)
    assert found.tolist() == [np.sort(scores[kinds])[-41], 0.5, 0.5]
    assert quality_rules.calibrate(rows.where("good"), 3, 0.002).tolist() == [1, 1, 1]
    assert "max_labelled" not in quality_rules.fit.__code__.co_varnames
