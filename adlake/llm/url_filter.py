"""URL filter: host/path rules first, then logistic regression on hashed character n-grams.

Everything here is DataFrame and SQL expressions. The model is fitted inside one expression:
a fold of stochastic gradient steps over the labelled URL table, which is small (a sample of
``max_labelled`` rows of a longer one). Only the weight vector (``DIMENSION`` doubles) comes to the driver;
it goes back into the plan as a literal, so scoring is one projection without join or shuffle.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIMENSION = 2048
MAX_LABELLED = 2000
EPOCHS = 15
RATE, SHRINK = 0.8, 0.0005
GRAMS = (3, 4)

#: Longest rule wins; a rule is a host, then a path prefix.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

#: Labelled URL table: hosts joined from words of gambling, pill, advertising, spam, loan, adult and piracy sites, and of others.
_BLOCKED_WORDS = (
    "casino bets poker slots jackpot lottery gambling roulette pills pharmacy viagra meds diet ads adserver track click banner popup spam links bulk adult "
    "porn sex xxx cams escort loans payday cash win prizes free bonus cheap crack warez torrent replica betting tracker pill dating hot").split()
_ALLOWED_WORDS = (
    "weather mother father brother northern southern education nation station library fashion garden kitchen museum history science university college "
    "school music theatre cinema travel mountain river forest ocean island bridge street village city county parliament council justice health hospital "
    "doctor nursing research chemistry physics biology mathematics engineering software python linux database network security archive journal review "
    "gazette herald tribune times daily weekly morning evening sports football cricket cycling running swimming chess recipes bakery coffee wine farm "
    "books poetry letters language grammar dictionary translation culture tradition religion church temple heritage painting gallery photo design "
    "furniture table gardening flowers animals birds fishing boating railway airport transport climate energy solar water fire market bakers tailor "
    "studio workshop festival concert orchestra guitar piano family children parents teacher student lesson exam career office company industry trade "
    "finance insurance economy policy government election court lawyer police army navy harbour shipping cargo hotel camping hiking winter summer spring "
    "autumn north south east west world global local regional national public private open free-software mobile cloud server web data digital").split()
_PREFIXES, _ENDINGS, _PATHS = ("", "www.", "m.", "blog.", "news.", "shop."), ("com", "org", "net"), ("/", "", "/en/12", "/news/2021.html", "/fr/7/", "/about", "/de/31", "/es/450")


def _composed(words: list[str], verdict: str, joined: int) -> list[tuple[str, str]]:
    """Each word alone and joined with ``joined`` others further on, below changing prefixes, endings and paths."""
    hosts = [*words, *(f"{w}-{words[(k + 11 * j) % len(words)]}" for j in range(1, joined + 1) for k, w in enumerate(words))]
    return [(f"{('http', 'https')[k % 2]}://{_PREFIXES[k % 6]}{host}.example.{_ENDINGS[k % 3]}{_PATHS[(k // 6 + k) % 8]}", verdict) for k, host in enumerate(hosts)]


#: There are fewer unwanted words, so each is joined twice.
LABELLED_URLS = (*_composed(_BLOCKED_WORDS, "block", 2), *_composed(_ALLOWED_WORDS, "allow", 1))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled URL table (url, verdict)."""
    rows = F.from_json(F.lit(json.dumps([{"url": u, "verdict": v} for u, v in LABELLED_URLS])), "array<struct<url:string,verdict:string>>")
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.*")


def split_url(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``; both empty for null or without ``://``."""
    rest = F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")
    found = F.coalesce(F.instr(F.col(url_col), "://") > 0, F.lit(False))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return urls.withColumns({
        "host": F.when(found, F.translate(raw, _UPPER, _LOWER)).otherwise(F.lit("")),
        "path": F.when(found, path).otherwise(F.lit(""))})


def buckets() -> Column:
    """Distinct hashed n-grams of the columns host and path; bucket 0 is the constant term."""
    parts = []
    for side, text in (("h", "concat('^', host, '$')"), ("p", "path")):
        for n in GRAMS:
            parts.append(
                f"transform(if(length({text}) >= {n}, sequence(1, length({text}) - {n - 1}), cast(array() as array<int>)), "
                f"i -> cast(1 + pmod(xxhash64(concat('{side}', substring({text}, i, {n}))), {DIMENSION - 1}) as int))")
    return F.expr(f"array_distinct(concat(array(0), {', '.join(parts)}))")


def fit(labelled: DataFrame, max_labelled: int = MAX_LABELLED) -> list[float]:
    """Weights of the model; ``labelled`` has (url, verdict block/allow). Other verdicts and null urls are ignored.

    Of a longer table ``max_labelled`` rows, chosen by a hash of the url, are learnt. Repeated rows
    count once; a url labelled both ways counts once as each. Without usable rows all weights are
    zero and every url is allowed.
    """
    rows = split_url(labelled.select("url", "verdict").where("url IS NOT NULL AND verdict IN ('block', 'allow')").distinct())
    dense = rows.select(
        F.xxhash64("url").alias("order"), "url", F.when(F.col("verdict") == "block", 1.0).otherwise(0.0).alias("y"), buckets().alias("b")
    ).orderBy("order", "url", "y").limit(max_labelled).select(
        "order", "y", "b", F.expr(
            f"transform(sequence(0, {DIMENSION - 1}), d -> if(array_contains(b, d), 1 / sqrt(size(b)), 0D))").alias("x"))
    packed = dense.agg(F.array_sort(F.collect_list(F.struct("order", "y", "x", "b"))).alias("rows"))
    logit = "aggregate(r.b, 0D, (s, i) -> s + w[i]) / sqrt(size(r.b))"
    step = (f"transform(array(r.y - 1 / (1 + exp(-{logit}))), e -> "
            f"zip_with(w, r.x, (a, b) -> a + {RATE}D * (e * b - {SHRINK}D * a)))[0]")
    fold = f"aggregate(flatten(array_repeat(rows, {EPOCHS})), array_repeat(0D, {DIMENSION}), (w, r) -> {step})"
    return packed.select(F.expr(fold).alias("w")).first()["w"]


def rule_columns(rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null where none fits; needs host and path."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, judged in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the last CASE set wins
        host, slash, rest = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + rest)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(judged)).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, labelled: DataFrame, rules: tuple[tuple[str, str], ...] = RULES,
          id_col: str = "page_id", url_col: str = "url", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of ``pages``.

    ``verdict`` is the rule's, else ``block`` where the model's probability ``score`` exceeds one
    half. Null urls and urls without ``://`` have empty host and path and are judged by the model
    on the empty name. Repeated rows stay repeated; an empty table gives no rows; other columns
    are ignored, also those named host, path, rule or verdict.
    """
    weights = F.from_json(F.lit(json.dumps(fit(labelled, max_labelled))), "array<double>")
    name, verdict = rule_columns(rules)
    rows = split_url(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")))
    scored = rows.withColumn("b", buckets()).withColumn("w", weights).withColumn(
        "score", F.expr("1 / (1 + exp(-aggregate(b, 0D, (s, i) -> s + w[i]) / sqrt(size(b))))"))
    return scored.select(
        "page_id", "host", "path", name.alias("rule"),
        F.coalesce(verdict, F.when(F.col("score") > 0.5, "block").otherwise("allow")).alias("verdict"), "score")
