"""Creatives: asset and text extraction from creative JSON, creative raw rows,
creative snapshot and asset staging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlake.functions.columns import content_hash, load_ts, parsed
from adlake.operators.dedup import latest_by
from adlake.session import Window
from adlake.sources.fixtures import CREATIVE_JSON


def _e(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _asset(kind: str, url, thumb, image_hash, video) -> Column:
    return F.struct(F.lit(kind).alias("asset_type"), _e(url).alias("asset_url"), _e(thumb).alias("thumbnail_url"),
                    _e(image_hash).alias("image_hash"), _e(video).alias("video_id"))


def creative_asset_array(cr: Column) -> Column:
    """Ordered, de-duplicated asset list of a parsed creative (first of each 5-tuple).

    Top thumbnail/hash image, link image, child attachments, video, then the
    asset feed's images and videos. A missing link_data or video_data counts
    as empty, so an IMAGE and a VIDEO asset carrying only the thumbnail are
    always emitted.
    """
    thumb, h = _e(cr.thumbnail_url), _e(cr.image_hash)
    ld = cr.object_story_spec.link_data
    vd = cr.object_story_spec.video_data
    fs = cr.asset_feed_spec
    top = F.when((thumb != "") | (h != ""), F.array(_asset("IMAGE", thumb, thumb, h, F.lit(""))))
    link = F.array(_asset("IMAGE", ld.picture, thumb, ld.image_hash, F.lit("")))
    kids = F.transform(F.coalesce(ld.child_attachments, F.array()),
                       lambda c: F.when(_e(c.video_id) != "", _asset("VIDEO", c.picture, c.picture, F.lit(""), c.video_id))
                       .otherwise(_asset("IMAGE", c.picture, c.picture, c.image_hash, F.lit(""))))
    video = F.array(_asset("VIDEO", vd.image_url, thumb, vd.image_hash, vd.video_id))
    imgs = F.transform(F.coalesce(fs.images, F.array()), lambda i: _asset("IMAGE", i.url, thumb, i.hash, F.lit("")))
    vids = F.transform(F.coalesce(fs.videos, F.array()), lambda v: _asset("VIDEO", F.lit(""), thumb, F.lit(""), v.video_id))
    empty = F.array().cast("array<struct<asset_type:string,asset_url:string,thumbnail_url:string,"
                           "image_hash:string,video_id:string>>")
    return F.array_distinct(F.concat(F.coalesce(top, empty), link, kids, video, imgs, vids))


def extract_creative_assets(df: DataFrame, json_col: str, keep: Sequence[str]) -> DataFrame:
    """One row per asset with its 1-based position."""
    p = parsed(df.select(*keep, json_col), json_col, CREATIVE_JSON, "__cr")
    out = p.select(*keep, F.posexplode(creative_asset_array(F.col("__cr"))).alias("__pos", "__a"))
    return out.select(*keep, (F.col("__pos") + 1).alias("asset_pos"), "__a.*")


def creative_text_array(cr: Column) -> Column:
    """Ordered, de-duplicated (type, trimmed text) pairs; blank texts skipped."""
    def t(kind, c):
        # strip surrounding whitespace (not only spaces)
        return F.struct(F.lit(kind).alias("text_type"),
                        F.regexp_replace(c, r"^\s+|\s+$", "").alias("text_content"))
    ld, vd, fs = cr.object_story_spec.link_data, cr.object_story_spec.video_data, cr.asset_feed_spec
    parts = [F.array(t("BODY", cr.body), t("BODY", ld.message), t("HEADLINE", ld["name"]),
                     t("DESCRIPTION", ld.description), t("CTA", ld.call_to_action["type"]),
                     t("BODY", vd.message), t("HEADLINE", vd.title)),
             F.transform(F.coalesce(fs.bodies, F.array()), lambda b: t("BODY", b.text)),
             F.transform(F.coalesce(fs.titles, F.array()), lambda b: t("HEADLINE", b.text)),
             F.transform(F.coalesce(fs.descriptions, F.array()), lambda b: t("DESCRIPTION", b.text)),
             F.transform(F.coalesce(fs.call_to_action_types, F.array()), lambda b: t("CTA", b))]
    allx = F.filter(F.concat(*parts), lambda x: x.text_content.isNotNull() & (x.text_content != ""))
    return F.array_distinct(allx)


def extract_creative_texts(df: DataFrame, json_col: str, keep: Sequence[str]) -> DataFrame:
    p = parsed(df.select(*keep, json_col), json_col, CREATIVE_JSON, "__cr")
    out = p.select(*keep, F.posexplode(creative_text_array(F.col("__cr"))).alias("__pos", "__t"))
    return out.select(*keep, (F.col("__pos") + 1).alias("text_pos"), "__t.*")


def norm_meta_creative(insights: DataFrame, max_ads: int | None, ingestion_id: str, now, extract_ts,
                       order_col: str = "ingest_seq") -> DataFrame:
    """One creative row per ad (first ``max_ads`` ads per account, the fetch cap);
    text fields blanked by policy, ids default to ``''``, assets as JSON.

    The cap is a per-account top-k (Spark limits it map-side, so a large
    account never sorts whole in one task); ``None`` keeps every ad."""
    d = insights.filter(F.coalesce(F.col("ad_id"), F.lit("")) != "")
    if max_ads is not None:
        rk = F.row_number().over(W.partitionBy("account_id").orderBy(order_col))
        d = d.withColumn("__rk", rk).filter(F.col("__rk") <= max_ads)
    d, cr = parsed(d, "creative_json", CREATIVE_JSON, "__cr"), F.col("__cr")
    blank = F.lit("")
    return d.select(
        F.lit(ingestion_id).alias("ingestion_id"), F.lit(now).cast("timestamp").alias("ingestion_ts"),
        F.lit(extract_ts).cast("timestamp").alias("source_extract_ts"), "collected_date", "account_id", "ad_id",
        _e(cr.id).alias("creative_id"), _e(cr["name"]).alias("creative_name"), blank.alias("ad_type"),
        _e(cr.object_type).alias("object_type"), _e(cr.status).alias("status"), blank.alias("body_text"),
        blank.alias("headline"), blank.alias("description_text"), blank.alias("call_to_action"),
        _e(cr.thumbnail_url).alias("thumbnail_url"), blank.alias("permanent_image_url"),
        _e(cr.image_hash).alias("image_hash"), blank.alias("video_id"),
        F.to_json(creative_asset_array(cr)).alias("assets_json"), F.col("creative_json").alias("source_payload"))


ASSET_JSON = "array<struct<asset_type:string,asset_url:string,url:string,thumbnail_url:string,image_hash:string,video_id:string,width:string,height:string,duration:string>>"


def _nonblank(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "")


def _snapshot_rows(df: DataFrame, channel: str, account: str, name_cols: dict, hash_cols, w: Window, now) -> DataFrame:
    cols = {k: (F.col(v) if isinstance(v, str) else v) for k, v in name_cols.items()}
    return df.filter(w.contains("collected_date")).select(
        F.lit(channel).alias("channel_key"), F.col(account).alias("account_id_norm"), "ad_id", "creative_id",
        *[cols[k].cast("string").alias(k) for k in ("creative_name", "body_text", "headline", "description_text",
                                                    "call_to_action", "thumbnail_url")],
        content_hash(*hash_cols).alias("content_hash"),
        F.col("collected_date").cast("timestamp").alias("valid_from_ts"), load_ts(now).alias("load_ts"))


SNAPSHOT_KEY = ("channel_key", "account_id_norm", "ad_id", "creative_id", "valid_from_ts")


def stg_creative_snapshot(meta: DataFrame | None, w: Window, now=None, google: DataFrame | None = None,
                          tiktok: DataFrame | None = None, naver: DataFrame | None = None,
                          tiebreak: Sequence[str] = ("content_hash",), dealt: Sequence[str] = ()) -> DataFrame:
    """Creative snapshots of the four channels with channel-specific content
    hashes; validity from midnight of the collected date; latest row per
    (channel, account, ad, creative, valid_from), ties broken by content hash. With
    ``dealt`` rows are dealt by these columns of the key once, for a history of them
    that follows: it then needs no further shuffle. Hashes travel as bytes."""
    none = F.lit(None)
    parts = []
    if meta is not None:
        parts.append(_snapshot_rows(meta, "META", "account_id",
                                    {c: c for c in ("creative_name", "body_text", "headline", "description_text",
                                                    "call_to_action", "thumbnail_url")},
                                    ["creative_name", "body_text", "headline", "description_text", "call_to_action",
                                     "thumbnail_url"], w, now))
    if google is not None:
        parts.append(_snapshot_rows(google, "GOOGLE_ADS", "customer_id",
                                    {"creative_name": "creative_name", "body_text": "description_1",
                                     "headline": "headline_1", "description_text": "description_2",
                                     "call_to_action": "call_to_action", "thumbnail_url": none},
                                    ["creative_name", "headline_1", "headline_2", "headline_3", "description_1",
                                     "description_2", "call_to_action"], w, now))
    if tiktok is not None:
        t = tiktok if "call_to_action" in tiktok.columns else tiktok.withColumn("call_to_action", none.cast("string"))
        parts.append(_snapshot_rows(t, "TIKTOK_ADS", "advertiser_id",
                                    {"creative_name": "creative_name", "body_text": "body_text", "headline": none,
                                     "description_text": none, "call_to_action": "call_to_action",
                                     "thumbnail_url": "thumbnail_url"},
                                    ["creative_name", "body_text", "call_to_action", "thumbnail_url", "video_url"],
                                    w, now))
    if naver is not None:
        parts.append(_snapshot_rows(naver, "NAVER_ADS", "account_id",
                                    {"creative_name": "creative_name", "body_text": "body_text",
                                     "headline": "headline", "description_text": none, "call_to_action": none,
                                     "thumbnail_url": "thumbnail_url"},
                                    ["creative_name", "body_text", "headline", "thumbnail_url"], w, now))
    u = parts[0]
    for p_ in parts[1:]:
        u = u.unionByName(p_)
    u = u.filter(_nonblank(F.col("creative_id")) & _nonblank(F.col("ad_id"))).withColumn("content_hash", F.unhex("content_hash"))
    out = latest_by(u.repartition(*dealt) if dealt else u, SNAPSHOT_KEY, ["load_ts"], list(tiebreak), hashed=True)
    return out.withColumn("content_hash", F.lower(F.hex("content_hash")))


ASSET_TIEBREAK = ("asset_url", "video_id", "thumbnail_url", "image_hash")


_ASSET = ("struct<asset_type:string,asset_seq:int,asset_url:string,thumbnail_url:string,image_hash:string,video_id:string,"
          "width:bigint,height:bigint,duration_sec:bigint,__src:int>")


def _one(kind, seq, url=None, thumb=None, image_hash=None, video=None, width=None, height=None, duration=None, src=0) -> Column:
    """One asset; columns by name or expression, None for none."""
    vals = [F.lit(kind) if isinstance(kind, str) else kind, F.lit(seq) if isinstance(seq, int) else seq,
            *[F.col(x) if isinstance(x, str) else F.lit(None) if x is None else x for x in (url, thumb, image_hash, video, width, height, duration)], F.lit(src)]
    names = ("asset_type", "asset_seq", "asset_url", "thumbnail_url", "image_hash", "video_id", "width", "height", "duration_sec", "__src")
    return F.struct(*[v.alias(n) for v, n in zip(vals, names)]).cast(_ASSET)


def _asset_rows(df: DataFrame, channel: str, account: str, assets: Column, w: Window, now) -> DataFrame:
    """A row an element of ``assets``, which is built once a row of ``df``."""
    return df.filter(w.contains("collected_date")).select(
        F.lit(channel).alias("channel_key"), F.col(account).alias("account_id_norm"), "ad_id", "creative_id",
        F.col("collected_date").cast("timestamp").alias("valid_from_ts"), load_ts(now).alias("load_ts"),
        F.explode(assets).alias("__a")).select(
        "channel_key", "account_id_norm", "ad_id", "creative_id", *[F.col(f"__a.{c}").alias(c) for c in (
            "asset_type", "asset_seq", "asset_url", "thumbnail_url", "image_hash", "video_id", "width", "height", "duration_sec")],
        "valid_from_ts", "load_ts", F.col("__a.__src").alias("__src"))


def stg_creative_asset(meta: DataFrame | None, w: Window, now=None, google: DataFrame | None = None,
                       tiktok: DataFrame | None = None) -> DataFrame:
    """Creative assets: Meta JSON assets (1-based position) plus fallback IMAGE #1 /
    VIDEO #2 rows, Google image urls and video ids (positions), TikTok image #1
    and video #2. A row is kept if it has any url, video, thumbnail or hash;
    on a key tie a Meta JSON asset wins over the fallback row. Each channel is
    read once: all assets of a creative come out of one array."""
    none = F.array().cast(f"array<{_ASSET}>")
    parts = []
    if meta is not None:
        js = F.transform(F.from_json("assets_json", ASSET_JSON), lambda a, i: _one(
            F.upper(F.coalesce(F.when(a.asset_type != "", a.asset_type), F.lit("IMAGE"))), i + 1, F.coalesce(a.asset_url, a.url),
            F.coalesce(a.thumbnail_url, F.col("thumbnail_url")), a.image_hash, a.video_id, a.width.try_cast("bigint"), a.height.try_cast("bigint"),
            a.duration.try_cast("bigint"), src=1))
        parts.append(_asset_rows(meta, "META", "account_id", F.concat(F.coalesce(js, none), F.array(
            _one("IMAGE", 1, "permanent_image_url", "thumbnail_url", "image_hash"), _one("VIDEO", 2, thumb="thumbnail_url", video="video_id"))), w, now))
    if google is not None:
        parts.append(_asset_rows(google, "GOOGLE_ADS", "customer_id", F.concat(
            F.coalesce(F.transform("image_urls", lambda v, i: _one("IMAGE", i + 1, v)), none),
            F.coalesce(F.transform("youtube_video_ids", lambda v, i: _one("VIDEO", i + 1, video=v)), none)), w, now))
    if tiktok is not None:
        parts.append(_asset_rows(tiktok, "TIKTOK_ADS", "advertiser_id", F.array(
            _one("IMAGE", 1, "image_url", "thumbnail_url"), _one("VIDEO", 2, "video_url", "thumbnail_url", video="video_id")), w, now))
    u = parts[0]
    for p_ in parts[1:]:
        u = u.unionByName(p_)
    keep = (_nonblank(F.col("creative_id")) & _nonblank(F.col("ad_id"))
            & (_nonblank(F.col("asset_url")) | _nonblank(F.col("video_id")) | _nonblank(F.col("thumbnail_url"))
               | _nonblank(F.col("image_hash"))))
    out = latest_by(u.filter(keep), ["channel_key", "account_id_norm", "ad_id", "creative_id", "asset_type",
                                     "asset_seq", "valid_from_ts"], ["load_ts", "__src"], list(ASSET_TIEBREAK))
    return out.drop("__src")
