"""Pages in unseen layouts, and tables whose columns clash with the operators' own or whose rows lack ids."""

import itertools
import math
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from adlake.llm import fingerprints, html_extract, mixing, simhash, url_filter


@pytest.fixture(scope="module")
def crf():
    return html_extract.train(html_extract.labelled_pages())


SENTENCES = (
    "The council met on Tuesday evening to discuss the new bridge across the river, which residents have awaited for years.",
    "Engineers presented three designs, of which the cheapest would take eighteen months to build.", "“We cannot wait any longer,” said a speaker.",
    "A vote is expected in spring, after a second round of public hearings in the town hall.")
ARTICLE = "<h1>Bridge plans move ahead</h1>" + "".join(f"<p>{s}</p>" for s in SENTENCES * 2) + \
    "<h2>What comes next</h2><ul><li>Hearings in March</li><li>A vote in April</li></ul><p>More soon.</p>"
COMMENTS = '<div class="comments"><h3>Comments</h3><div class="comment"><p>I agree with every word of this, thanks a lot for it.</p></div></div>'


@pytest.mark.parametrize("comments", ["", COMMENTS])
def test_article_is_found_whatever_its_wrapper_is_called(crf, comments):
    want = " ".join(b.text for b in html_extract.blocks(ARTICLE))
    for name in ("content", "post-content", "entry-content", "article-body", "body-copy", "text", "main", "story", "story-col", "page", "container",
                 "mw-parser-output", None):
        wrapper = f'<div class="{name}">' if name else "<div>"
        page = ('<html><head><title>x</title></head><body><div class="topbar"><a href="/">Home</a> <a href="/n">News</a></div><nav><ul><li><a href=/a>A</a></li>'
                f'<li><a href=/b>Sport</a></li></ul></nav>{wrapper}{ARTICLE}</div>{comments}<div class="sidebar"><h4>Related</h4><ul><li><a href=/z>Other</a></li></ul></div>'
                "<footer>&copy; 2020 Paper. All rights reserved.</footer></body></html>")
        assert html_extract.main_text(page, crf) == want, name


def test_recall_on_layouts_of_another_seed(crf):
    right = found = wanted = 0
    for page in html_extract.labelled_pages(150, seed=99):
        cut = html_extract.blocks(page)
        for b, y in zip(cut, crf.viterbi(html_extract.features(cut))):
            right, found, wanted = right + (b.main and y == 1), found + y, wanted + b.main
    assert right / wanted > 0.95 and right / found > 0.95


def test_page_without_elements_is_its_text(crf):
    assert html_extract.main_text("plain  text &amp; no <!-- note --> markup", crf) == "plain text & no markup"
    assert html_extract.main_text("", crf) == ""


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(5)
    for n in (1, 2, 5, 9):
        model = html_extract.Crf(rng.normal(size=(html_extract.DIMENSION, 2)), rng.normal(size=2), rng.normal(size=(2, 2)))
        ids = [sorted(rng.choice(html_extract.DIMENSION, 4, replace=False).tolist()) for _ in range(n)]
        s = model.scores(ids)

        def score(path):
            return model.start[path[0]] + sum(s[i, c] for i, c in enumerate(path)) + sum(model.move[a, b] for a, b in zip(path, path[1:]))

        assert model.viterbi(ids) == list(max(itertools.product((0, 1), repeat=n), key=score))


def _clashing(spark):
    rows = [(i, f"alpha beta gamma delta number {i} of many words in a row", i) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, x int")
    own = ("_t", "_p", "_n", "_i", "head", "nth", "fp", "group", "_head", "_nth", "a.b")
    return df.select("doc_id", "text", *[F.col("x").alias(c) for c in own], F.struct(F.col("x").alias("with blank")).alias("s"))


def test_columns_named_like_the_operators_own_survive(spark):
    docs = _clashing(spark)
    labelled = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("fr").alias("domain"))
    mixed = mixing.apply(docs, labelled, {"en": 0.5, "fr": 0.5})
    assert mixed.schema.names == docs.schema.names
    assert all(r["_n"] == r["fp"] == r["a.b"] == r["s"][0] == r["doc_id"] for r in mixed.collect())
    kept = simhash.keep_one_per_group(docs, simhash.near_duplicates(docs))
    assert kept.schema.names == docs.schema.names and kept.count() >= 1
    assert all(r["head"] == r["nth"] == r["group"] == r["doc_id"] for r in kept.collect())


def test_rows_without_id_are_deduplicated(spark):
    a = " ".join(f"word{i * 7 % 101}" for i in range(150))
    b, c = " ".join(f"term{i * 5 % 97}" for i in range(150)), " ".join(f"item{i * 3 % 89}" for i in range(150))
    docs = spark.createDataFrame([(None, a), (None, a), (None, a.upper()), (None, b), (5, b), (6, b), (None, ""), (None, None), (7, c), (7, c)], "doc_id long, text string")
    groups = simhash.near_duplicates(docs)
    kept = sorted((r.doc_id or 0, (r.text or "").lower()) for r in simhash.keep_one_per_group(docs, groups).collect())
    assert kept == sorted([(0, ""), (0, a), (5, b), (7, c)])
    assert groups.where("doc_id IS NULL AND component_id IS NULL").select("group_fingerprint").distinct().count() == 2
    none = docs.where("doc_id IS NULL")
    assert simhash.keep_one_per_group(none, simhash.near_duplicates(none)).count() == 3


def test_fingerprints_take_k_and_rows_without_id_spread(spark):
    texts = [" ".join(f"w{(i * j) % 211}" for j in range(60)) for i in range(1, 41)]
    docs = spark.createDataFrame([(None if i < 25 else i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = fingerprints.fingerprint_edits(docs, k=16).collect()
    assert len(got) == 40 and all(len(r.fingerprint) == len(r.edited_fingerprint) == 16 * 16 for r in got)
    follow = {r.text: r.next_text for r in fingerprints.with_next(docs, sketched=False, width=4).collect()}
    at, seen = texts[30], set()
    while at not in seen:
        seen.add(at)
        at = follow[at]
    assert len(seen) == 40 and all(follow[texts[i]] == texts[i + 1] for i in range(25, 39)) and follow[texts[39]] in texts[:25]
    with pytest.raises(ValueError, match="integers"):
        fingerprints.fingerprint_edits(docs.select(F.col("doc_id").cast("string"), "text"))


def _url_score(weights, url):
    """The model's probability, counted anew: hashed grams of host and path, logistic of their scaled sum."""
    host, path = re.match(r"[^:]*://([^/?#]*)([^?#]*)", url).groups()
    found = {0}
    for side, text in (("h", f"^{host.lower()}$"), ("p", path)):
        for n in url_filter.GRAMS:
            for i in range(len(text) - n + 1):
                h = xxhash.xxh64_intdigest(side + text[i:i + n], 42)
                found.add(1 + (h - (h >> 63 << 64)) % (url_filter.DIMENSION - 1))
    return 1 / (1 + math.exp(-sum(weights[i] for i in found) / math.sqrt(len(found))))


def test_url_scores_on_hosts_the_table_does_not_have(spark):
    labelled = url_filter.labelled_urls(spark)
    blocked = ["casino-win", "free-bets", "cheap-pills", "ads-track", "hot-cams", "poker-bonus", "cheap-viagra", "adult-porn", "payday-cash"]
    ordinary = ["mountain-weather", "the-village-school", "northern-herald", "chess-lessons", "physicsreview", "old-bridge", "riverside-cafe", "parents-association"]
    urls = [f"https://www.{h}.example.org/en/{k}" for k, h in enumerate(blocked + ordinary)]
    known = {u.split("://")[1].split("/")[0] for u, _ in url_filter.LABELLED_URLS}
    assert not known & {u.split("://")[1].split("/")[0] for u in urls}
    weights = url_filter.fit(labelled)
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = sorted(url_filter.judge(pages, labelled, rules=()).collect())
    assert all(abs(r.score - _url_score(weights, urls[r.page_id])) < 1e-12 for r in got)
    judged = [r.verdict for r in got]
    assert judged[:len(blocked)].count("block") >= 8 and judged[len(blocked):].count("allow") >= 7, judged


def test_url_labelled_both_ways_and_a_bounded_sample(spark):
    both = spark.createDataFrame([("http://a.example.org/", "block"), ("http://a.example.org/", "allow"), (None, "block"), ("http://b", "other")], "url string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.example.org/")], "page_id long, url string")
    assert abs(url_filter.judge(pages, both, rules=()).collect()[0].score - 0.5) < 0.2
    assert url_filter.fit(both.where("verdict = 'other'")) == [0.0] * url_filter.DIMENSION
    assert url_filter.fit(url_filter.labelled_urls(spark), max_labelled=3) != url_filter.fit(url_filter.labelled_urls(spark), max_labelled=5)
