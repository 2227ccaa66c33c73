"""External metric sheets: CSV parsing, channel codes, currency text, combine.

Sheets arrive as CSV text (one file per branch and metric). Everything is a
Spark read plus column expressions: records are cut where a line ends outside
quotes, cells by one pass of a pattern; the combine step is a set of full outer
joins on (date, channel) after picking the last row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Sheet channel codes (lower-cased, trimmed) and their channel keys.
CHANNEL_CODES = {
    "1_meta": "META",
    "meta": "META",
    "2_google_search": "GOOGLE_ADS",
    "google_search": "GOOGLE_ADS",
    "3_google_display": "GOOGLE_ADS",
    "22_google_demand_gen": "GOOGLE_DEMAND_GEN",
    "7_tiktok": "TIKTOK_ADS",
    "tiktok": "TIKTOK_ADS",
    "4_youtube": "YOUTUBE",
    "youtube": "YOUTUBE",
    "10_coupons": "COUPON",
    "14_affiliate": "AFFILIATE",
    "15_email": "EMAIL",
    "102_ambassadors": "INFLUENCER",
    "58_marketing_fee": "OTHER",
    "12_organic_seo": "ORGANIC_SEO",
    "114_ota": "OTA",
}


def strip(text: Column) -> Column:
    """Text without ASCII white space at its ends, line breaks included."""
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def channel_key_of(code: Column) -> Column:
    """Channel key of a sheet code (case and surrounding spaces ignored), else OTHER."""
    m = F.create_map(*[x for kv in CHANNEL_CODES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.coalesce(m[F.lower(strip(F.coalesce(code, F.lit(""))))], F.lit("OTHER"))


def parse_currency(text: Column) -> Column:
    """``$91,952.10`` -> 91952.10; blank or unparsable -> NULL (as double)."""
    t = strip(text)
    return F.when(t != "", F.regexp_replace(t, r"[,$%]", "").try_cast("double"))


class SheetHeader(ValueError):
    """A sheet's first record doesn't begin with DATE."""


# A quoted cell ends at a single quote; what follows up to the comma belongs to it. A quote inside a bare cell is text.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_CELL = rf'(?:{_QUOTED}"[^,]*+|(?!")[^,]*+)'
_OPENS = rf"(?s)^(?:{_CELL},)*+{_QUOTED}$"
_STAYS = r'(?s)^[^"]*+(?:""[^"]*+)*+$'
_REOPENS = rf'(?s)^[^"]*+(?:""[^"]*+)*+"[^,]*+,(?:{_CELL},)*+{_QUOTED}$'


def _inside_after(order: W, opens: Column, stays: Column, entry: Column) -> Column:
    """Whether a quoted cell is open behind each row of ``order``, if ``entry`` says so before its first row.

    A row maps "open before" to "open behind": ``opens`` if it was not, ``stays`` if it was. Rows that
    map both alike forget the past, rows that swap count by their parity since the last of those.
    """
    swaps = F.sum(F.when(opens & ~stays, 1).otherwise(0)).over(order)
    fixed = F.last(F.when(opens == stays, F.struct(opens.cast("int").alias("v"), swaps.alias("at"))), ignorenulls=True).over(order)
    return F.when(fixed.isNull(), (entry.cast("int") + swaps) % 2).otherwise((fixed["v"] + swaps - fixed["at"]) % 2) == 1


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, first, __idx, partition columns): the CSV records of all files below ``path``.

    A record ends at a line break outside quotes. Files are read in blocks by line, wherever a
    block begins. In a file where no line leaves a quote open each line is a record: one aggregate a
    file finds these, and their lines are not shuffled. In the others each line says what it does to
    an open and to a closed quote, these maps are composed within blocks and then over the blocks of
    a file, and only lines of records with several lines are shuffled together. ``first`` marks a
    file's first record; ``__idx`` sorts records by file name and place. Line breaks inside a cell
    come back as line feeds.
    """
    raw = spark.read.text(path)
    extra = [c for c in raw.columns if c != "value"]  # e.g. a branch_id partition folder
    lines = raw.select("value", *extra, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_name").alias("__name"),
                       F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__line"))
    opens = F.col("value").contains('"') & F.col("value").rlike(_OPENS)
    files = lines.groupBy("__file").agg(F.max(opens).alias("__quoted"), F.min(F.when(F.col("__block") == 0, F.col("__line"))).alias("__head"))
    lines = lines.join(F.broadcast(files), "__file")  # a row a file
    place = lambda start: F.struct("__name", "__file", start["__block"].alias("block"), start["__line"].alias("line")).alias("__idx")
    plain = lines.where(~F.col("__quoted")).withColumn("__start", F.struct("__block", "__line")).select(
        *extra, F.col("value").alias("record"), F.coalesce(F.col("__line") == F.col("__head"), F.lit(False)).alias("first"), place(F.col("__start")))
    return plain.unionByName(_quoted_records(lines.where("__quoted").drop("__quoted", "__head"), extra).select(
        *extra, "record", F.col("__first").alias("first"), place(F.col("__start"))))


def _quoted_records(lines: DataFrame, extra: list[str]) -> DataFrame:
    """(record, __first, __start, __file, __name, ``extra``) of lines among which quoted cells may go on over line breaks."""
    lines = lines.withColumn("__opens", F.col("value").rlike(_OPENS)).withColumn(
        "__stays", F.col("value").rlike(_STAYS) | F.col("value").rlike(_REOPENS))
    block = ["__file", "__block"]
    by_line, by_block = W.partitionBy(*block).orderBy("__line"), W.partitionBy("__file").orderBy("__block")
    # each line's end and beginning, once for a block that begins outside quotes and once for one inside
    for k, entry in ((0, F.lit(False)), (1, F.lit(True))):
        lines = lines.withColumn(f"__in{k}", _inside_after(by_line, F.col("__opens"), F.col("__stays"), entry))
        lines = lines.withColumn(f"__starts{k}", ~F.coalesce(F.lag(f"__in{k}").over(by_line), entry))
    lines = lines.withColumn("__first", (F.row_number().over(by_line) == 1) & (F.col("__block") == 0)).drop("__opens", "__stays")
    blocks = lines.groupBy(*block).agg(*[f.alias(f"{n}{k}") for k in (0, 1) for n, f in (
        ("__o", F.max_by(f"__in{k}", "__line")), ("__began", F.max(F.when(F.col(f"__starts{k}"), F.struct("__block", "__line")))))])
    # the state each block begins in, and the last record that an earlier block began: it goes on there
    blocks = blocks.withColumn("__out", _inside_after(by_block, F.col("__o0"), F.col("__o1"), F.lit(False)))
    blocks = blocks.withColumn("__entry", F.coalesce(F.lag("__out").over(by_block), F.lit(False)))
    blocks = blocks.withColumn("__began", F.when(F.col("__entry"), F.col("__began1")).otherwise(F.col("__began0")))
    blocks = blocks.select(*block, "__entry", F.last("__began", ignorenulls=True).over(by_block.rowsBetween(W.unboundedPreceding, -1)).alias("__carried"))
    lines = lines.join(blocks, block)
    starts, inside = (F.when(F.col("__entry"), F.col(f"{n}1")).otherwise(F.col(f"{n}0")) for n in ("__starts", "__in"))
    lines = lines.withColumns({"__starts": starts, "__in": inside})
    own = F.last(F.when(F.col("__starts"), F.struct("__block", "__line")), ignorenulls=True).over(by_line)
    lines = lines.withColumn("__start", F.coalesce(own, "__carried"))
    shown = [*extra, "__file", "__name", "__start"]
    single = lines.where(F.col("__starts") & ~F.col("__in")).select(*shown, "__first", F.col("value").alias("record"))
    parts = lines.where(~F.col("__starts") | F.col("__in"))
    several = parts.groupBy(*shown).agg(F.max("__first").alias("__first"), F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("__block", "__line", "value"))), lambda x: x["value"]), "\n").alias("record"))
    return single.unionByName(several)


def csv_cells(record: Column) -> Column:
    """The cells of a record, unquoted; a blank record has none."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(rf"(?s),({_QUOTED}\"?[^,]*+|[^,]*+)"), 1)
    inner = rf"(?s)^\"([^\"]*+(?:\"\"[^\"]*+)*+)\"?(.*)$"

    def plain(cell: Column) -> Column:
        return F.when(cell.startswith('"'), F.concat(F.replace(F.regexp_extract(cell, inner, 1), F.lit('""'), F.lit('"')), F.regexp_extract(cell, inner, 2))).otherwise(cell)

    return F.when(record == "", F.array().cast("array<string>")).when(~record.contains('"'), F.split(record, ",", -1)).otherwise(F.transform(cells, plain))


def _read_rows(spark: SparkSession, path: str, ncols: int) -> DataFrame:
    """Cells c0.. of every record as text, with their number, place and whether it is the file's first record."""
    records = csv_records(spark, path)
    extra = [c for c in records.columns if c not in ("record", "first", "__idx")]
    # a one-element generator: filters on cells don't repeat the cutting
    return records.select("*", F.explode(F.array(csv_cells(F.col("record")))).alias("cells")).select(
        *extra, "__idx", "first", F.size("cells").alias("__n"), *[F.try_element_at("cells", F.lit(i + 1)).alias(f"c{i}") for i in range(ncols)])


# An ISO date, or one with a time behind any one separator.
_ISO_DATE = r"^\d{4}-\d{2}-\d{2}(.\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"


def _parse_date(c: Column) -> Column:
    """The date of ISO text (`` 0:00:00`` is ignored); anything else, also ``M/d/yyyy``, is no date."""
    s = F.replace(strip(c), F.lit(" 0:00:00"), F.lit(""))
    return F.when(s.rlike(_ISO_DATE), F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd")).when(s.rlike(r"^\d{8}$"), F.try_to_date(s, "yyyyMMdd"))


def sheet_rows(raw: DataFrame, ncols: int) -> DataFrame:
    """Records behind the header; those that are short or lack a date or channel are dropped.

    A file whose first record doesn't begin with DATE fails the job that reads it (``SheetHeader``).
    A file without any line gives no rows.
    """
    named = F.upper(strip(F.coalesce("c0", F.lit("")))) == "DATE"
    fail = F.raise_error(F.concat(F.lit("SheetHeader: the first cell is not DATE in "), F.col("__idx.__file")))
    date = F.when(F.col("first") & ~named, fail.cast("date")).when(~F.col("first"), _parse_date(F.col("c0")))
    # one condition, date first: no part of it can pass over the header's check; a one-element generator parses a date once
    kept = F.when(F.col("date").isNull(), F.lit(False)).otherwise((F.col("__n") >= ncols) & (strip(F.coalesce("c1", F.lit(""))) != ""))
    return raw.select("*", F.explode(F.array(date)).alias("date")).filter(kept).drop("first")


def read_metric_sheet(spark: SparkSession, path: str) -> DataFrame:
    """(date, channel_code, value, __idx) from a DATE, channel, metric sheet."""
    raw = _read_rows(spark, path, 3)
    extra = [c for c in raw.columns if c not in ("__idx", "__n", "first", "c0", "c1", "c2")]
    rows = sheet_rows(raw, 3)
    return rows.select(*extra, "date", strip(F.col("c1")).alias("channel_code"), parse_currency(F.col("c2")).alias("value"),
                       "__idx")


def read_cr_sheet(spark: SparkSession, path: str) -> DataFrame:
    """(date, channel_code, transactions, plan_views, cr_pct, __idx) from the CR sheet."""
    raw = _read_rows(spark, path, 5)
    extra = [c for c in raw.columns if c not in ("__idx", "__n", "first", "c0", "c1", "c2", "c3", "c4")]
    rows = sheet_rows(raw, 5)
    return rows.select(*extra, "date", strip(F.col("c1")).alias("channel_code"),
                       parse_currency(F.col("c2")).alias("transactions"),
                       parse_currency(F.col("c3")).alias("plan_views"),
                       parse_currency(F.col("c4")).alias("cr_pct"), "__idx")


def _per_key(df: DataFrame, keys, value_cols, combine: str) -> DataFrame:
    k = df.withColumn("channel_key", channel_key_of(F.col("channel_code")))
    if combine == "sum":
        return k.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in value_cols])
    # last row wins: two codes of one channel overwrite, they do not add
    return k.groupBy(*keys).agg(*[F.max_by(F.col(c), F.col("__idx")).alias(c) for c in value_cols])


def combine_metric_sheets(spend: DataFrame, impressions: DataFrame, clicks: DataFrame, cr: DataFrame,
                          branch_id: str | None = None, combine: str = "last") -> DataFrame:
    """Outer-join the four sheets on (branch, date, channel key) into external-ads rows.

    Sheets of all branches are combined at once when they carry a
    ``branch_id`` column (one folder per branch); otherwise ``branch_id``
    names the single branch.
    """
    if branch_id is not None:
        spend, impressions, clicks, cr = [d.withColumn("branch_id", F.lit(branch_id))
                                          for d in (spend, impressions, clicks, cr)]
    keys = ["branch_id", "date", "channel_key"]
    s = _per_key(spend.withColumnRenamed("value", "spend_usd"), keys, ["spend_usd"], combine)
    i = _per_key(impressions.withColumnRenamed("value", "impressions"), keys, ["impressions"], combine)
    c = _per_key(clicks.withColumnRenamed("value", "clicks"), keys, ["clicks"], combine)
    r = _per_key(cr, keys, ["transactions", "plan_views", "cr_pct"], combine)
    out = s.join(i, keys, "full").join(c, keys, "full").join(r, keys, "full")
    return out.select("date", "branch_id", "channel_key", "spend_usd",
                      F.col("impressions").cast("bigint").alias("impressions"),
                      F.col("clicks").cast("bigint").alias("clicks"), "transactions", "plan_views", "cr_pct")
