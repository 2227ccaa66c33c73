"""What the adapter views land and how reads of them are laid out."""

from adlake.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_no_views_are_landed_for_base_tables_alone(spark, monkeypatch):
    """Queries that read driver tables as they are (an empty list of views) land nothing."""
    landed = []
    real = fx._land
    monkeypatch.setattr(fx, "_land", lambda spark, sf, name, df: landed.append(name) or real(spark, sf, name, df))
    fx._REGISTERED.clear()
    fx.register(spark, SF_SMALL, [])
    assert spark.table("events").count() and not landed
    fx.google_action_payloads(spark, SF_SMALL)
    fx.google_conv_dim_payloads(spark, SF_SMALL)
    assert not landed
    fx.register(spark, SF_SMALL, ["fx_web"])
    assert landed == ["fx_web"]


def test_shuffles_begin_with_partitions_in_proportion_to_the_input(spark, monkeypatch):
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(fx, "TASK_BYTES", 1000)
    fx.size_shuffles(spark, SF_SMALL)
    assert int(spark.conf.get(fx._INITIAL)) > own
    monkeypatch.undo()
    fx.size_shuffles(spark, SF_SMALL)
    assert spark.conf.get(fx._INITIAL, None) is None


def test_creatives_are_read_from_the_tables_without_landing(spark, monkeypatch, tmp_path):
    """The landed views hold all columns of all channels; creatives want a few of them."""
    import datetime as dt
    from adlake.plans.catalog_normalize import q_norm_naver_creative, q_scd2_creative_from_staging, q_stg_creative_snapshot
    day = dt.datetime(1998, 5, 6)
    rows = {
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                     "l_tax double, l_shipdate timestamp",
                     [(*k, 1.0, 2.0, 0.1, 0.0, day) for k in ((1, 11, 5, 2), (1, 14, 6, 3), (2, 99, 5, 2), (3, 15, 6, 3), (3, 15, 6, 3))]),
        "part": ("p_partkey long, p_name string", [(11, "red"), (14, "hot"), (15, "ring")]),
        "documents": ("doc_id long, text string, lang string, source string, n_chars long", [(3, "some text", "en", "s", 9)])}
    for t in fx.BASE_TABLES:
        schema, data = rows.get(t, ("none int", []))
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{t}.parquet"))
    landed = []
    real = fx._land
    monkeypatch.setattr(fx, "_land", lambda spark, sf, name, df: landed.append(name) or real(spark, sf, name, df))
    fx._REGISTERED.clear()
    got = {(r.channel_key, r.account_id_norm, r.ad_id, r.body_text, str(r.valid_from_date)) for r in q_stg_creative_snapshot(spark, str(tmp_path)).collect()}
    want = {("META", "s", "3", "", "2024-01-04"), ("GOOGLE_ADS", "5", "11", None, "1998-05-06"), ("GOOGLE_ADS", "5", "99", None, "1998-05-06"),
            ("TIKTOK_ADS", "5", "11", "Text 11", "2001-12-31"), ("NAVER_ADS", "6", "14", None, "2001-12-31"), ("NAVER_ADS", "6", "15", "ring", "2001-12-31")}
    assert got == want
    assert q_scd2_creative_from_staging(spark, str(tmp_path)).count() == len(want)
    naver = sorted((r.ad_id, r.campaign_id, r.ad_group_id) for r in q_norm_naver_creative(spark, str(tmp_path)).collect())
    assert naver == [("14", "14", None), ("15", "15", "15"), ("15", "15", "15")]
    assert not landed
    fx._REGISTERED.clear()
