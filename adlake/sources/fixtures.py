"""Adapter views that shape the driver tables into warehouse inputs.

The driver tables (``lineitem``, ``orders``, ``events``, ...) are not ad or
order payloads, so each warehouse input is derived from them by a small SQL
view that runs unchanged in Spark and DuckDB. Spark-only adapters then add the
landed-payload details the SQL cannot express portably (timestamps from load
sequence numbers, money as text, JSON payloads).

These views are test and benchmark inputs, not warehouse logic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()

FACT_SIZED = {"lineitem", "orders", "events", "documents", "pages", "conversations"}

# name -> (SQL, dependencies). Valid in both Spark SQL and DuckDB.
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {}


def _view(name: str, deps: tuple[str, ...], sql: str) -> None:
    VIEWS[name] = (sql.strip(), deps)


_view("fx_perf", ("lineitem", "part"), """
SELECT CASE l_linenumber % 4 WHEN 0 THEN 'META' WHEN 1 THEN 'GOOGLE_ADS'
            WHEN 2 THEN 'TIKTOK_ADS' ELSE 'NAVER_ADS' END            AS channel_key,
       'act_' || CAST(l_suppkey AS STRING)                            AS account_id,
       CAST(l_partkey % 40 AS STRING)                                 AS campaign_id,
       CASE WHEN l_partkey % 7 = 0 THEN NULL
            ELSE CAST(l_partkey % 200 AS STRING) END                  AS ad_group_id,
       CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE p_name END          AS ad_group_name,
       CAST(l_partkey % 500 AS STRING)                                AS ad_id,
       CAST(l_shipdate AS DATE)                                       AS stat_date,
       CAST(l_quantity * 100 AS BIGINT)                               AS impressions,
       CASE WHEN l_tax = 0 THEN CAST(0 AS BIGINT)
            ELSE CAST(l_quantity AS BIGINT) END                       AS clicks,
       CAST(ROUND(l_extendedprice * 100) AS BIGINT) * 10000           AS cost_micros,
       l_discount                                                     AS conversions,
       l_orderkey * 10 + l_linenumber                                 AS load_seq,
       l_partkey AS tie1, l_suppkey AS tie2
FROM lineitem JOIN part ON l_partkey = p_partkey
""")

# Wide landed ad-performance rows for all four channels.
_view("fx_ads_raw", ("lineitem", "part"), """
SELECT CASE l_linenumber % 4 WHEN 0 THEN 'META' WHEN 1 THEN 'GOOGLE_ADS'
            WHEN 2 THEN 'TIKTOK_ADS' ELSE 'NAVER_ADS' END            AS channel_key,
       CAST(l_suppkey AS STRING)                                      AS account_id_norm,
       CAST(l_partkey % 40 AS STRING)                                 AS campaign_id,
       CASE WHEN l_orderkey % 9 = 0 THEN NULL
            ELSE 'Campaign ' || CAST(l_partkey % 40 AS STRING)
                 || CASE WHEN l_orderkey % 4 = 0 THEN ' v2' ELSE '' END END AS campaign_name,
       CASE WHEN l_partkey % 7 = 0 THEN NULL
            ELSE CAST(l_partkey % 200 AS STRING) END                  AS ad_group_id,
       CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE p_name END          AS ad_group_name,
       CAST(l_partkey % 500 AS STRING)                                AS ad_id,
       CASE WHEN l_orderkey % 5 = 0 THEN NULL
            ELSE 'Ad ' || CAST(l_partkey % 500 AS STRING) END         AS ad_name,
       CASE WHEN l_orderkey % 13 = 0 THEN 'PAUSED' ELSE 'ACTIVE' END  AS status,
       CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE 'CONVERSIONS' END  AS campaign_type,
       CAST(l_shipdate AS DATE)                                       AS stat_date,
       CAST(l_quantity * 100 AS BIGINT)                               AS impressions,
       CASE WHEN l_tax = 0 THEN CAST(0 AS BIGINT)
            ELSE CAST(l_quantity AS BIGINT) END                       AS clicks,
       CAST(ROUND(l_extendedprice * 100) AS BIGINT) * 10000           AS cost_micros,
       l_discount                                                     AS conversions,
       CAST(ROUND(l_extendedprice * 100) AS BIGINT)
         * CAST(ROUND(l_tax * 100) AS BIGINT) * 100                   AS conv_value_micros,
       l_orderkey % 11 = 0                                            AS spend_blank,
       l_orderkey * 10 + l_linenumber                                 AS load_seq,
       l_partkey AS tie1, l_suppkey AS tie2,
       CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS tie3,
       CAST(ROUND(l_discount * 100) AS BIGINT) * 100 + CAST(ROUND(l_tax * 100) AS BIGINT) AS tie4,
       CAST(l_shipdate AS DATE) AS tie5
FROM lineitem JOIN part ON l_partkey = p_partkey
""")

_view("fx_actions", ("events",), """
SELECT event_id, CAST(user_id % 20 AS STRING) AS account_id_norm,
       CAST(user_id % 40 AS STRING) AS campaign_id, CAST(ts AS DATE) AS stat_date,
       CASE WHEN event_id % 11 = 0 THEN NULL
            WHEN event_id % 13 = 0 THEN '[]'
            ELSE '[{"action_type":"' || event_type || '","value":"'
                 || CAST(event_id % 5 AS STRING) || '"},{"action_type":"link_click","value":"bad"}]'
       END AS actions_json
FROM events
""")

# Meta action payloads: counts and values arrays per ad-day row.
_view("fx_meta_actions_raw", ("events",), """
SELECT 'act_' || CAST(user_id % 20 AS STRING) AS account_id,
       CAST(user_id % 40 AS STRING) AS campaign_id,
       CAST(user_id % 7 AS STRING) AS ad_group_id,
       CAST(user_id % 11 AS STRING) AS ad_id,
       CAST(ts AS DATE) AS stat_date,
       CASE WHEN event_id % 11 = 0 THEN NULL
            WHEN event_id % 13 = 0 THEN '[]'
            ELSE '[{"action_type":"' || event_type || '","value":"'
                 || CAST(event_id % 5 AS STRING) || '"},{"action_type":"link_click","value":"bad"},'
                 || '{"action_type":"","value":"3"}]'
       END AS actions_json,
       CASE WHEN event_id % 7 = 0 THEN 'not json'
            ELSE '[{"action_type":"' || event_type || '","value":"'
                 || CAST(event_id % 9 AS STRING) || '.25"}]'
       END AS action_values_json,
       event_id AS load_seq
FROM events
""")

_view("fx_google_actions_raw", ("events",), """
SELECT CAST(user_id % 20 AS STRING) AS customer_id,
       CAST(user_id % 40 AS STRING) AS campaign_id,
       CAST(ts AS DATE) AS stat_date,
       CASE event_id % 4 WHEN 0 THEN 'purchase' WHEN 1 THEN event_type
            WHEN 2 THEN '' ELSE 'lead' END AS action_type_raw,
       CAST(event_id % 6 AS STRING) AS action_count,
       CAST(CAST(ROUND(value * 100) AS BIGINT) AS STRING) AS action_value_cents,
       event_id AS load_seq
FROM events
""")

_view("fx_action_map", (), """
SELECT * FROM (VALUES
  ('META', 'purchase', 'purchase', TRUE), ('META', 'click', 'link_click', TRUE),
  ('META', 'view', '', TRUE), ('META', 'signup', 'lead', FALSE),
  ('META', 'link_click', 'link_click', TRUE),
  ('GOOGLE_ADS', 'purchase', 'purchase', TRUE), ('GOOGLE_ADS', 'lead', 'lead', TRUE),
  ('GOOGLE_ADS', 'click', NULL, TRUE)
) AS t(channel_key, action_type_raw, action_type_std, is_enabled)
""")

_view("fx_web", ("events",), """
SELECT CAST(ts AS DATE) AS event_date, 'P' || CAST(user_id % 5 AS STRING) AS property_id,
       CASE event_id % 3 WHEN 0 THEN 'google' WHEN 1 THEN 'direct' ELSE 'meta' END AS source,
       CASE event_id % 2 WHEN 0 THEN 'cpc' ELSE 'organic' END AS medium,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'c' || CAST(user_id % 4 AS STRING) END AS campaign,
       event_type AS event_name, user_id AS user_pseudo_id,
       CAST(user_id AS STRING) || '-' || CAST(event_id % 24 AS STRING) AS session_id,
       event_id AS load_seq
FROM events
""")

_view("fx_orders", ("lineitem", "orders"), """
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'FEVER' ELSE 'SALES' END AS order_source,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'SRC' || CAST(o_custkey % 4 AS STRING) END AS source_system,
       CAST(o_orderkey AS STRING) AS order_id, CAST(l_linenumber AS STRING) AS order_line_id,
       CAST(o_orderdate AS DATE) AS order_date,
       CASE WHEN o_custkey % 10 = 0 THEN NULL WHEN o_custkey % 10 = 1 THEN '  '
            ELSE ' User' || CAST(o_custkey AS STRING) || '@Example.com ' END AS customer_email,
       CASE WHEN o_custkey % 6 = 0 THEN NULL
            ELSE '+82 (10) ' || CAST(1000000 + o_custkey AS STRING) END AS customer_phone,
       CAST(l_partkey % 50 AS STRING) AS product_id,
       CASE WHEN o_orderkey % 3 = 0 THEN 'venue' || CAST(o_custkey % 6 AS STRING) END AS venue_name,
       CAST(l_quantity AS BIGINT) AS quantity,
       CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS gross_cents,
       CAST(ROUND(l_extendedprice * l_discount * 100) AS BIGINT) AS discount_cents,
       CASE WHEN o_custkey % 2 = 0 THEN 'USD' ELSE 'KRW' END AS currency,
       o_orderkey * 10 + l_linenumber AS load_seq, l_partkey AS tie1, l_suppkey AS tie2,
       CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS tie3,
       CAST(ROUND(l_discount * 100) AS BIGINT) * 100 + CAST(ROUND(l_tax * 100) AS BIGINT) AS tie4,
       CAST(l_shipdate AS DATE) AS tie5
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")

_view("fx_survey", ("labels", "documents"), """
SELECT d.source AS survey_source, CAST(l.doc_id AS STRING) AS response_id,
       CASE WHEN l.doc_id % 2 = 0 THEN 'S1' ELSE 'S2' END AS survey_id, 'q_nps' AS question_id,
       CAST(l.quality * 8 + l.toxic AS DOUBLE) AS answer_score,
       CAST(l.doc_id % 28 AS INT) AS day_offset,
       CAST('2024-01-01' AS DATE) + CAST(l.doc_id % 28 AS INT) AS response_date,
       CASE WHEN l.doc_id % 5 = 0 THEN NULL ELSE 'User' || CAST(l.doc_id % 40 AS STRING) || '@example.com' END AS customer_email,
       CASE WHEN l.doc_id % 3 = 0 THEN NULL ELSE '010-' || CAST(5000 + l.doc_id % 40 AS STRING) END AS customer_phone,
       l.doc_id AS load_seq
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
""")

# Creative snapshots from documents: copies of a text are unchanged content.
_view("fx_creative", ("documents",), """
SELECT 'META' AS channel_key, source AS account_id_norm,
       CAST(doc_id % 97 AS STRING) AS creative_id, CAST(doc_id % 89 AS STRING) AS ad_id,
       'Creative ' || CAST(doc_id % 97 AS STRING) AS creative_name,
       CAST('2024-01-01' AS DATE) + CAST(doc_id % 30 AS INT) AS valid_date,
       text, lang, n_chars, doc_id,
       CASE WHEN doc_id % 2 = 0 THEN 'IMAGE' ELSE 'VIDEO' END AS asset_type,
       CAST(1 + doc_id % 3 AS INT) AS asset_seq,
       CASE WHEN doc_id % 11 = 0 THEN '' ELSE 'https://cdn/' || lang || '/' || CAST(n_chars % 5 AS STRING) END AS asset_url,
       CASE WHEN doc_id % 2 = 1 THEN 'v' || CAST(n_chars % 3 AS STRING) END AS video_id,
       'h' || CAST(n_chars % 4 AS STRING) AS image_hash,
       'https://thumb/' || source AS thumbnail_url,
       CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'https://thumb/' || source END AS c_thumb,
       CASE WHEN doc_id % 3 = 0 THEN 'h' || CAST(n_chars % 4 AS STRING) ELSE '' END AS c_hash,
       doc_id % 5 <> 0 AS has_spec,
       'https://pic/' || lang AS link_pic, 'lh' || CAST(doc_id % 2 AS STRING) AS link_hash,
       'Headline ' || lang AS link_name, CASE WHEN doc_id % 6 = 0 THEN 'Desc ' || lang END AS link_desc,
       CASE WHEN doc_id % 4 = 1 THEN 'LEARN_MORE' WHEN doc_id % 4 = 2 THEN 'SHOP_NOW' END AS cta_type,
       doc_id % 7 = 0 AS has_c1, 'https://c1/' || lang AS c1_pic,
       doc_id % 2 = 1 AS has_c2, 'https://c2/' || lang AS c2_pic, 'v' || CAST(doc_id % 3 AS STRING) AS c2_vid,
       doc_id % 2 = 1 AS has_video, 'https://vimg/' || lang AS v_img, 'v' || CAST(n_chars % 3 AS STRING) AS v_id,
       'Title ' || lang AS v_title,
       doc_id % 3 = 1 AS has_feed, 'https://pic/' || lang AS f1_url, 'lh' || CAST(doc_id % 2 AS STRING) AS f1_hash,
       'https://feed/' || CAST(doc_id % 4 AS STRING) AS f2_url, 'fh' || CAST(doc_id % 4 AS STRING) AS f2_hash,
       'v' || CAST(n_chars % 3 AS STRING) AS fv_id, '  Body ' || lang || '  ' AS f_body,
       doc_id AS load_seq
FROM documents
""")

# Wide audience insight rows (one per order): channel, campaign, day, codes.
_view("fx_breakdown_wide", ("orders", "customer"), """
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'META' ELSE 'GOOGLE_ADS' END AS channel_key,
       CAST(c_nationkey AS STRING) AS account_id_norm,
       CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE CAST(o_custkey % 30 AS STRING) END AS campaign_id,
       'Campaign ' || CAST(o_custkey % 30 AS STRING) AS campaign_name,
       CAST('2024-01-01' AS DATE) + CAST(o_orderkey % 60 AS INT) AS stat_date,
       CASE c_mktsegment WHEN 'MACHINERY' THEN '18_24' WHEN 'BUILDING' THEN '25_34'
            WHEN 'AUTOMOBILE' THEN '35_44' WHEN 'HOUSEHOLD' THEN '65_UP' ELSE 'UNDETERMINED' END AS age_code,
       CASE o_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' ELSE ' ' END AS gender,
       CASE o_custkey % 5 WHEN 0 THEN '2840' WHEN 1 THEN '2124' WHEN 2 THEN 'others'
            WHEN 3 THEN '9999' ELSE '2410' END AS country,
       CASE o_orderkey % 4 WHEN 0 THEN '21137' WHEN 1 THEN '1012873' WHEN 2 THEN '' ELSE ' 20009' END AS region,
       o_custkey % 100 AS impressions, o_custkey % 7 AS clicks,
       CAST(ROUND(o_totalprice * 100) AS BIGINT) * 10000 AS cost_micros,
       CAST(o_orderkey % 3 AS DOUBLE) AS conversions,
       (o_orderkey % 5) * 1000000 AS conversion_value_micros,
       CASE WHEN o_orderkey % 2 = 0 THEN '7d_click' END AS attribution_setting,
       o_orderkey AS load_seq
FROM orders JOIN customer ON o_custkey = c_custkey
""")

_view("fx_geo_meta", (), """
SELECT * FROM (VALUES
  ('2840', 'COUNTRY', 'US', 'United States', 'United States'),
  ('2124', 'COUNTRY', 'CA', 'Canada', 'Canada'),
  ('2410', 'COUNTRY', 'KR', 'South Korea', 'South Korea'),
  ('21137', 'STATE', 'US', 'United States', 'California'),
  ('1012873', 'CITY', 'CA', 'Canada', 'Toronto, canada'),
  ('20009', 'REGION', 'KR', 'South Korea', 'Seoul')
) AS t(geo_target_constant_id, target_type, country_code, country_name, target_name)
""")

# Ingest source configuration, one source per supplier.
_view("fx_source_config", ("supplier",), """
SELECT 'src_' || CAST(s_suppkey AS STRING) AS source_id,
       'VENUE_0' || CAST(s_suppkey % 7 + 1 AS STRING) AS branch_id,
       CASE s_suppkey % 4 WHEN 0 THEN 'META' WHEN 1 THEN 'GOOGLE_ADS' WHEN 2 THEN 'TIKTOK_ADS' ELSE 'NAVER_ADS' END
         AS channel_key,
       CASE s_suppkey % 4 WHEN 0 THEN 'meta' WHEN 1 THEN 'google' WHEN 2 THEN 'tiktok' ELSE 'naver' END AS provider_key,
       CASE s_suppkey % 5 WHEN 1 THEN 'PENDING_SETUP' WHEN 2 THEN 'PAUSED' ELSE 'ACTIVE' END AS status,
       CASE WHEN s_suppkey % 2 = 0 THEN 'tier1' ELSE 'tier2' END AS tier,
       CAST(s_suppkey % 10 AS INT) AS priority,
       CASE s_suppkey % 6 WHEN 0 THEN 'SECRET_MANAGER' WHEN 1 THEN 'env' WHEN 2 THEN NULL ELSE 'secret_manager' END
         AS credential_mode,
       CASE WHEN s_suppkey % 11 = 0 THEN NULL WHEN s_suppkey % 13 = 0 THEN ' ' ELSE CAST(s_suppkey AS STRING) END
         AS account_id_norm,
       CASE WHEN s_suppkey % 3 = 0 THEN 'sm://' || CAST(s_suppkey AS STRING) WHEN s_suppkey % 3 = 1 THEN '' END
         AS secret_ref,
       s_suppkey % 2 = 0 AS run_warehouse_after_ingest
FROM supplier
""")

# Warehouse job log (one root or child job per event).
_view("fx_job_log", ("events",), """
SELECT 'job_' || CAST(event_id AS STRING) AS job_id,
       CASE WHEN user_id % 2 = 0 THEN 'US' ELSE 'asia-northeast3' END AS region,
       'user' || CAST(user_id % 7 AS STRING) || '@example.com' AS user_email,
       ts AS creation_time,
       CASE WHEN event_id % 19 = 0 THEN 'LOAD' ELSE 'QUERY' END AS job_type,
       CASE WHEN event_id % 13 = 0 THEN 'RUNNING' ELSE 'DONE' END AS state,
       CASE WHEN event_id % 11 = 0 THEN 'job_' || CAST(event_id - 1 AS STRING) END AS parent_job_id,
       CAST(ROUND(value * 1000000000) AS BIGINT) AS total_bytes_billed,
       CASE event_type WHEN 'click' THEN 'CALL `proj.ops.sp_load_all`()'
            WHEN 'view' THEN 'CALL `proj.ops.sp_load_stg`()'
            WHEN 'signup' THEN 'BEGIN TRANSACTION; DELETE FROM `proj.raw_ads.meta_ads_performance_raw` WHERE TRUE'
            WHEN 'purchase' THEN 'SELECT 1' ELSE 'DECLARE x INT64' END AS query,
       CASE event_type WHEN 'purchase' THEN 'SELECT'
            WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'SCRIPT' END ELSE 'SCRIPT' END AS statement_type
FROM events
""")

# The dashboard's query log (estimated and actual bytes per semantic query).
_view("fx_query_log", ("events",), """
SELECT event_id AS id, 'user' || CAST(user_id % 5 AS STRING) AS user_id,
       CASE event_id % 3 WHEN 0 THEN ts - INTERVAL 20 DAY WHEN 1 THEN ts ELSE ts + INTERVAL 20 DAY END AS created_at,
       CASE WHEN event_type = 'error' THEN 'error'
            WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'blocked' ELSE 'ok' END AS status,
       CAST(ROUND(value * 1000000) AS BIGINT) AS estimated_bytes,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(ROUND(value * 900000) AS BIGINT) END AS actual_bytes,
       CASE WHEN event_id % 7 = 0 THEN 'last 90 days' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS date_from,
       CASE WHEN event_id % 7 = 0 THEN NULL
            ELSE CAST(CAST(ts AS DATE) + CAST(event_id % 100 AS INT) AS STRING) END AS date_to
FROM events
""")

# Google asset performance rows (ad-group assets and PMax asset-group assets).
_view("fx_asset_raw", ("lineitem",), """
SELECT CAST(l_suppkey AS STRING) AS customer_id, CAST(l_partkey % 40 AS STRING) AS campaign_id,
       CASE l_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'search' WHEN 2 THEN 'DISPLAY'
            WHEN 3 THEN 'PERFORMANCE_MAX' ELSE NULL END AS campaign_channel_type,
       CASE WHEN l_orderkey % 5 = 0 THEN '{"campaign":{"advertising_channel_type":"VIDEO"}}' ELSE '{}' END
         AS source_payload,
       l_linenumber % 3 = 0 AS is_pmax,
       CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_partkey % 200 AS STRING) END AS ad_group_id,
       CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_partkey % 500 AS STRING) END AS ad_id,
       CASE WHEN l_linenumber % 3 = 0 THEN 'AG' || CAST(l_partkey % 50 AS STRING) END AS asset_group_id,
       CASE WHEN l_orderkey % 41 = 0 THEN '' ELSE CAST(l_partkey % 300 AS STRING) END AS asset_id,
       CASE l_partkey % 6 WHEN 0 THEN 'MARKETING_IMAGE' WHEN 1 THEN 'headline' WHEN 2 THEN 'DESCRIPTION'
            WHEN 3 THEN 'YOUTUBE_VIDEO' WHEN 4 THEN 'SQUARE_MARKETING_IMAGE' ELSE 'LOGO' END AS field_type,
       CASE WHEN l_tax > 0.04 THEN 'GOOD' ELSE 'LOW' END AS performance_label,
       CAST(l_shipdate AS DATE) AS stat_date,
       CAST(l_quantity * 10 AS BIGINT) AS impressions, CAST(l_quantity AS BIGINT) % 7 AS clicks,
       CAST(ROUND(l_extendedprice * 100) AS BIGINT) * 100 AS cost_micros,
       CAST(l_linenumber % 4 AS DOUBLE) AS conversions,
       CAST(ROUND(l_extendedprice * 100) AS BIGINT) * 300 AS conversions_value_micros,
       CASE WHEN l_linenumber % 3 = 0 THEN 'asset_group_asset' ELSE 'ad_group_ad_asset_view' END AS source_view,
       l_orderkey * 10 + l_linenumber AS load_seq,
       l_partkey AS tie1, l_suppkey AS tie2,
       CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS tie3,
       CAST(ROUND(l_discount * 100) AS BIGINT) * 100 + CAST(ROUND(l_tax * 100) AS BIGINT) AS tie4,
       CAST(l_shipdate AS DATE) AS tie5
FROM lineitem
""")

# Warehouse run events: a RUNNING event with the load window, then the outcome.
_view("fx_run_log", ("events",), """
SELECT 'run_' || CAST(CAST(FLOOR(event_id / 2) AS BIGINT) AS STRING) AS run_id,
       CASE WHEN user_id % 10 = 0 THEN 'other' ELSE 'all' END AS source_name,
       'warehouse_v2' AS pipeline_name, ts AS event_ts,
       CASE WHEN event_id % 2 = 0 THEN 'RUNNING' WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       CASE WHEN event_id % 2 = 1 AND event_type = 'error' THEN 'boom ' || CAST(event_id AS STRING) END AS error_message,
       CASE WHEN event_id % 2 = 0 THEN
         '{"start_date":"' || CAST(CAST(ts AS DATE) - CAST(user_id % 3 AS INT) AS STRING)
         || '","end_date":"' || CAST(CAST(ts AS DATE) AS STRING) || '"}' END AS metadata
FROM events
""")

# Naver campaign and ad-group entity lists (one row per entity).
_view("fx_naver_entities", ("fx_ads_raw",), """
SELECT 'campaign' AS kind, account_id_norm AS customer_id, campaign_id, CAST(NULL AS STRING) AS ad_group_id,
       'Campaign ' || campaign_id AS name
FROM fx_ads_raw WHERE channel_key = 'NAVER_ADS' GROUP BY account_id_norm, campaign_id
UNION ALL
SELECT 'adgroup', account_id_norm, MIN(campaign_id), ad_group_id, MIN(ad_group_name)
FROM fx_ads_raw WHERE channel_key = 'NAVER_ADS' AND ad_group_id IS NOT NULL GROUP BY account_id_norm, ad_group_id
""")

_view("fx_account_map", ("supplier",), """
SELECT CAST(s_suppkey AS STRING) AS account_id_norm,
       'VENUE_0' || CAST(s_suppkey % 7 + 1 AS STRING) AS branch_id,
       CAST('1995-01-01' AS DATE) AS effective_start_date,
       CASE WHEN s_suppkey % 3 = 0 THEN CAST('1998-06-30' AS DATE) END AS effective_end_date,
       s_suppkey % 5 <> 0 AS is_active, 1 AS updated_seq
FROM supplier
UNION ALL
SELECT CAST(s_suppkey AS STRING), 'VENUE_09', CAST('1998-01-01' AS DATE), CAST(NULL AS DATE), TRUE, 2
FROM supplier WHERE s_suppkey % 3 = 0
""")

# The account map per ad channel (the warehouse keys it by channel too).
_view("fx_channel_account_map", ("fx_account_map",), """
SELECT 'META' AS channel_key, m.* FROM fx_account_map m
UNION ALL SELECT 'GOOGLE_ADS', m.* FROM fx_account_map m
UNION ALL SELECT 'TIKTOK_ADS', m.* FROM fx_account_map m
UNION ALL SELECT 'NAVER_ADS', m.* FROM fx_account_map m WHERE m.account_id_norm <> '7'
""")

_view("fx_rules", (), """
SELECT * FROM (VALUES ('R1','VENUE_02','plate',10,TRUE,1), ('R2','VENUE_01','RED',11,TRUE,1),
  ('R3','VENUE_03','ring',11,TRUE,1), ('R4','VENUE_04','bolt',5,FALSE,1), ('R5','VENUE_05','hot',11,TRUE,2),
  ('R6','VENUE_06','red ring',11,TRUE,1)
) AS t(rule_id, branch_id, match_keyword, priority, is_active, updated_seq)
""")

_view("fx_dim_branch", ("nation",), """
SELECT 'VENUE_' || lpad(CAST(n_nationkey + 1 AS STRING), 2, '0') AS branch_id,
       n_name AS branch_name,
       CASE n_regionkey WHEN 0 THEN 'KRW' WHEN 1 THEN 'USD' WHEN 2 THEN 'JPY' WHEN 3 THEN 'EUR' END AS currency
FROM nation
""")

# Landed external sheet rows (branch x channel code x day).
_view("fx_external", ("orders", "customer"), """
SELECT CAST(o_orderdate AS DATE) AS date,
       'VENUE_' || lpad(CAST(c_nationkey % 9 + 1 AS STRING), 2, '0') AS branch_id,
       CASE o_orderkey % 6 WHEN 0 THEN '1_Meta' WHEN 1 THEN ' 2_Google_Search '
            WHEN 2 THEN '7_TikTok' WHEN 3 THEN 'YOUTUBE' WHEN 4 THEN '15_email' ELSE 'zz_unknown' END AS channel_code,
       CASE o_orderkey % 6 WHEN 0 THEN 'META' WHEN 1 THEN 'GOOGLE_ADS'
            WHEN 2 THEN 'TIKTOK_ADS' WHEN 3 THEN 'YOUTUBE' WHEN 4 THEN 'EMAIL' ELSE 'OTHER' END AS channel_key,
       CAST(ROUND(o_totalprice * 100) AS BIGINT) * 10000 AS spend_usd_micros,
       o_custkey % 1000 AS impressions,
       CASE WHEN o_orderkey % 8 = 0 THEN 0 ELSE o_custkey % 37 END AS clicks,
       o_orderkey % 3 AS transactions,
       o_orderkey % 5 AS plan_views,
       o_orderkey AS order_key
FROM orders JOIN customer ON o_custkey = c_custkey
""")

_view("fx_property_map", (), """
SELECT * FROM (VALUES
  ('P0', 'VENUE_01', CAST('2023-01-01' AS DATE), CAST(NULL AS DATE), TRUE, 1),
  ('P1', 'VENUE_02', CAST('2023-01-01' AS DATE), CAST('2024-01-15' AS DATE), TRUE, 1),
  ('P1', 'VENUE_03', CAST('2024-01-10' AS DATE), CAST(NULL AS DATE), TRUE, 2),
  ('P2', 'VENUE_04', CAST('2023-01-01' AS DATE), CAST(NULL AS DATE), FALSE, 1),
  ('P3', 'VENUE_05', CAST('2024-01-20' AS DATE), CAST(NULL AS DATE), TRUE, 1),
  ('P3', 'VENUE_06', CAST('2024-01-20' AS DATE), CAST(NULL AS DATE), TRUE, 3)
) AS t(property_id, branch_id, effective_start_date, effective_end_date, is_active, updated_seq)
""")

_view("fx_sales_map", (), """
SELECT * FROM (VALUES
  ('SRC0', 'VENUE_01', CAST('1990-01-01' AS DATE), CAST(NULL AS DATE), TRUE, 1),
  ('SRC1', 'VENUE_02', CAST('1990-01-01' AS DATE), CAST('1997-12-31' AS DATE), TRUE, 1),
  ('SRC1', 'VENUE_03', CAST('1997-06-01' AS DATE), CAST(NULL AS DATE), TRUE, 2),
  ('SRC2', 'VENUE_04', CAST('1990-01-01' AS DATE), CAST(NULL AS DATE), FALSE, 1)
) AS t(source_system, branch_id, effective_start_date, effective_end_date, is_active, updated_seq)
""")

_view("fx_fever_map", (), """
SELECT * FROM (VALUES
  ('1', NULL, 'VENUE_05', CAST('1990-01-01' AS DATE), CAST(NULL AS DATE), TRUE, 1),
  ('2', NULL, 'VENUE_06', CAST('1990-01-01' AS DATE), CAST(NULL AS DATE), TRUE, 1),
  (NULL, 'venue1', 'VENUE_07', CAST('1990-01-01' AS DATE), CAST(NULL AS DATE), TRUE, 1),
  (NULL, 'venue2', 'VENUE_08', CAST('1990-01-01' AS DATE), CAST('1998-12-31' AS DATE), TRUE, 1),
  ('3', 'venue3', 'VENUE_09', CAST('1990-01-01' AS DATE), CAST(NULL AS DATE), TRUE, 1),
  ('3', NULL, 'VENUE_10', CAST('1996-01-01' AS DATE), CAST(NULL AS DATE), TRUE, 2)
) AS t(event_id, venue_name, branch_id, effective_start_date, effective_end_date, is_active, updated_seq)
""")

_view("fx_survey_map", (), """
SELECT * FROM (VALUES
  ('src1', 'S1', 'VENUE_01', CAST('2023-01-01' AS DATE), CAST(NULL AS DATE), TRUE, 1),
  ('src1', NULL, 'VENUE_02', CAST('2023-01-01' AS DATE), CAST(NULL AS DATE), TRUE, 1),
  ('src2', NULL, 'VENUE_03', CAST('2023-01-01' AS DATE), CAST(NULL AS DATE), TRUE, 1),
  ('src3', 'S2', 'VENUE_04', CAST('2024-01-10' AS DATE), CAST(NULL AS DATE), TRUE, 1),
  ('src4', 'S1', 'VENUE_05', CAST('2023-01-01' AS DATE), CAST(NULL AS DATE), FALSE, 1)
) AS t(survey_source, survey_id, branch_id, effective_start_date, effective_end_date, is_active, updated_seq)
""")


def _deps_closure(names) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen or n in BASE_TABLES:
            return
        for d in VIEWS[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


_REGISTERED: dict = {}

# Fact-sized adapter views are landed once per session as Parquet in the
# shared checkpoint folder (like an ingest writes raw tables), partitioned by
# channel where readers filter on it; later reads prune partitions and columns.
LANDED = {"fx_ads_raw": "channel_key", "fx_orders": "order_source", "fx_web": None,
          "fx_meta_actions_raw": None, "fx_google_actions_raw": None, "fx_external": None,
          "fx_breakdown_wide": "channel_key", "fx_asset_raw": None, "fx_job_log": None,
          "fx_query_log": None, "fx_run_log": None, "fx_creative": None}


def _land(spark: SparkSession, sf_dir: str, name: str, df: DataFrame) -> DataFrame:
    import hashlib
    import uuid
    from adlake.session import checkpoint_dir
    tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
    path = f"{checkpoint_dir(spark).rstrip('/')}/landed-{tag}-{uuid.uuid4().hex[:8]}/{name}"
    part = LANDED[name]
    w = df.write.mode("overwrite")
    if part:
        w = w.partitionBy(part)
    w.parquet(path)
    return spark.read.parquet(path)


#: Input bytes (compressed) that one reduce task is planned for.
TASK_BYTES = 8 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def size_shuffles(spark: SparkSession, sf_dir: str) -> None:
    """Let shuffles begin with as many partitions as the input needs, so that a task's share doesn't grow with it.

    Adaptive execution joins partitions that turn out small; it doesn't divide large ones of a
    grouping or window. Inputs that fit the session's shuffle partitions leave it as it was.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([f"{sf_dir}/{t}.parquet" for t in BASE_TABLES])
    needed = -(-(files.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES)
    if needed > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(_INITIAL, str(needed))
    else:
        spark.conf.unset(_INITIAL)


def register(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Register the driver tables and (a closure of) the adapter views.

    Registration is remembered per session: the tables are re-read only when
    the data folder changes.
    """
    key = id(spark)
    state = _REGISTERED.get(key)
    if state is None or state["sf"] != sf_dir or not spark.catalog.tableExists(BASE_TABLES[0]):
        size_shuffles(spark, sf_dir)
        par = spark.sparkContext.defaultParallelism
        for t in BASE_TABLES:
            df = spark.read.parquet(f"{sf_dir}/{t}.parquet")
            # An unsplittable file (one row group) scans in one task; spread
            # the fact-sized inputs so the work before the first shuffle is
            # parallel. Inputs that already arrive in enough splits are kept.
            if t in FACT_SIZED and df.rdd.getNumPartitions() < par:
                df = df.repartition(par)
            df.createOrReplaceTempView(t)
        state = {"sf": sf_dir, "views": set()}
        _REGISTERED[key] = state
    for n in _deps_closure(list(VIEWS) if names is None else names):
        if n not in state["views"]:
            df = spark.sql(VIEWS[n][0])
            if n in LANDED:
                df = _land(spark, sf_dir, n, df)
            df.createOrReplaceTempView(n)
            state["views"].add(n)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register(spark, sf_dir, [name])
    return spark.table(name)


def oracle(body: str, names) -> str:
    """DuckDB text: adapter views as CTEs in front of ``body``."""
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n][0]}\n)" for n in _deps_closure(names))
    b = body.strip()
    if not ctes:
        return b
    if b[:4].upper() == "WITH":
        return f"WITH {ctes},\n{b[4:].lstrip()}"
    return f"WITH {ctes}\n{b}"


def straight(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows of a view straight from the driver tables, never landed.

    For readers of few of its columns: only these are read and computed, filters reach the tables
    and a join moves the rows that pass them. A landed view writes all columns of all rows first.
    """
    register(spark, sf_dir, [])
    return spark.sql(oracle(f"SELECT * FROM {name}", [name]))


# ---------------------------------------------------------------- Spark adapters
def _ts(seq_col: str = "load_seq"):
    """Landed-row timestamps from a load sequence number (one second apart)."""
    return F.timestamp_seconds(F.col(seq_col) + F.lit(1_600_000_000))


def with_load_times(df: DataFrame, seq_col: str = "load_seq") -> DataFrame:
    """Add ``ingestion_ts`` and ``source_extract_ts`` (NULL for every 17th row)."""
    return (df.withColumn("ingestion_ts", _ts(seq_col))
              .withColumn("source_extract_ts", F.when(F.col(seq_col) % 17 != 0, _ts(seq_col))))


def _micros_text(c: str):
    return (F.col(c).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(20,6)").cast("string")


def ads_perf_raws(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Per-channel performance tables (Meta, Google, TikTok, Naver)."""
    raw = with_load_times(straight(spark, sf_dir, "fx_ads_raw"))
    common = ["campaign_id", "campaign_name", "ad_group_id", "ad_group_name", "ad_id", "ad_name",
              "status", "stat_date", "impressions", "clicks", "ingestion_ts", "source_extract_ts",
              "tie1", "tie2", "tie3", "tie4", "tie5", "load_seq"]
    meta = raw.filter(F.col("channel_key") == "META").select(
        F.concat(F.lit("act_"), F.col("account_id_norm")).alias("account_id"), *common, "campaign_type",
        F.when(F.col("tie1") % 3 != 0, F.concat(F.lit("Account "), F.col("account_id_norm"))).alias("account_name"),
        _micros_text("cost_micros").alias("spend"))
    google = raw.filter(F.col("channel_key") == "GOOGLE_ADS").select(
        F.col("account_id_norm").alias("customer_id"), *common, "cost_micros",
        "conversions", (F.col("conv_value_micros").cast("decimal(38,9)") / F.lit(1_000_000))
        .cast("decimal(38,9)").alias("conversions_value"))
    tiktok = raw.filter(F.col("channel_key") == "TIKTOK_ADS").select(
        F.col("account_id_norm").alias("advertiser_id"), *[c for c in common if c != "ad_group_name"],
        (F.col("cost_micros").cast("decimal(38,9)") / F.lit(1_000_000)).cast("decimal(38,9)").alias("spend"),
        "conversions", (F.col("conv_value_micros").cast("decimal(38,9)") / F.lit(1_000_000))
        .cast("decimal(38,9)").alias("conversions_value"))
    naver = raw.filter(F.col("channel_key") == "NAVER_ADS").select(
        F.col("account_id_norm").alias("account_id"),
        *[c if c != "ad_id" else F.lit(None).cast("string").alias("ad_id") for c in common],
        F.when(F.col("spend_blank"), F.lit("")).otherwise(_micros_text("cost_micros")).alias("spend"))
    return {"meta": meta, "google": google, "tiktok": tiktok, "naver": naver}


def governance(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Governance maps with ``updated_at`` timestamps from their sequence."""
    register(spark, sf_dir, ["fx_channel_account_map", "fx_rules", "fx_dim_branch", "fx_property_map",
                             "fx_sales_map", "fx_fever_map", "fx_survey_map", "fx_action_map"])

    def upd(name):
        return spark.table(name).withColumn("updated_at", _ts("updated_seq"))

    return {
        "account_map": upd("fx_channel_account_map"),
        "rules": upd("fx_rules"),
        "dim_branch": spark.table("fx_dim_branch"),
        "property_map": upd("fx_property_map"),
        "sales_map": upd("fx_sales_map"),
        "fever_map": upd("fx_fever_map"),
        "survey_map": upd("fx_survey_map"),
        "action_map": spark.table("fx_action_map"),
    }


def meta_action_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_load_times(straight(spark, sf_dir, "fx_meta_actions_raw"))


def google_action_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = with_load_times(straight(spark, sf_dir, "fx_google_actions_raw"))
    return g.withColumn("action_value", (F.col("action_value_cents").cast("decimal(20,0)") / F.lit(100))
                        .cast("decimal(20,2)").cast("string")).drop("action_value_cents")


def external_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return straight(spark, sf_dir, "fx_external")


def ga4_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_load_times(straight(spark, sf_dir, "fx_web"))


def _orders(spark, sf_dir):
    o = with_load_times(straight(spark, sf_dir, "fx_orders"))
    return (o.withColumn("order_ts", F.col("order_date").cast("timestamp"))
             .withColumn("gross_amount_micros", F.col("gross_cents") * F.lit(10_000))
             .withColumn("discount_amount_micros", F.col("discount_cents") * F.lit(10_000))
             .withColumn("net_amount_micros", (F.col("gross_cents") - F.col("discount_cents")) * F.lit(10_000))
             .withColumn("payment_status", F.lit("PAID")))


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed SALES order lines."""
    return _orders(spark, sf_dir).filter(F.col("order_source") == "SALES").drop(
        "order_source", "venue_name", "gross_cents", "discount_cents")


def fever_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed FEVER ticket orders; every 4th ticket has no event id."""
    o = _orders(spark, sf_dir).filter(F.col("order_source") == "FEVER")
    return o.select(F.col("order_id").alias("fever_order_id"), F.col("order_line_id").alias("ticket_id"),
                    F.when(F.col("load_seq") % 4 != 0, F.col("product_id")).alias("event_id"),
                    "venue_name", "customer_email", "order_ts", "order_date", "quantity", "gross_amount_micros",
                    "discount_amount_micros", "net_amount_micros", "currency", "payment_status",
                    "ingestion_ts", "source_extract_ts", "load_seq", "tie1", "tie2", "tie3", "tie4", "tie5")


def survey_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = with_load_times(view(spark, sf_dir, "fx_survey"))
    return (s.withColumn("response_ts", F.col("response_date").cast("timestamp"))
             .withColumn("answer_type", F.lit("SCORE"))
             .withColumn("answer_text", F.lit(None).cast("string")))


def creative_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged creative rows: content hash over the whole text, midnight validity."""
    c = view(spark, sf_dir, "fx_creative")
    return (c.withColumn("content_hash", F.sha2(F.concat_ws("|", F.col("creative_name"), F.col("text")), 256))
             .withColumn("valid_from_ts", F.col("valid_date").cast("timestamp"))
             .withColumns({"body_text": F.col("f_body"), "headline": F.col("link_name"), "description_text": F.col("link_desc"),
                           "call_to_action": F.col("cta_type"), "width": F.col("n_chars").cast("bigint"),
                           "height": (F.col("n_chars") % 7).cast("bigint"),
                           "duration_sec": F.when(F.col("doc_id") % 2 == 1, (F.col("n_chars") % 60).cast("bigint"))})
             .withColumn("load_ts", _ts("load_seq")))


def breakdown_wide(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Landed wide insight rows: Meta (age, gender, country, region) and
    Google (age_range, gender, geo_target_country, geo_target_region)."""
    b = with_load_times(view(spark, sf_dir, "fx_breakdown_wide"))
    meta_age = F.when(F.col("age_code") == "65_UP", F.lit("65+")).when(
        F.col("age_code") != "UNDETERMINED", F.regexp_replace("age_code", "_", "-")).otherwise(F.lit("unknown"))
    common = ["campaign_id", "campaign_name", "stat_date", "impressions", "clicks", "ingestion_ts",
              "source_extract_ts", "load_seq"]
    meta = b.filter(F.col("channel_key") == "META").select(
        F.concat(F.lit("act_"), F.col("account_id_norm")).alias("account_id"), *common,
        F.col("cost_micros").alias("spend_micros"), "attribution_setting",
        meta_age.alias("age"), "gender", "country", "region")
    google = b.filter(F.col("channel_key") == "GOOGLE_ADS").select(
        F.col("account_id_norm").alias("customer_id"), *common, "cost_micros", "conversions",
        "conversion_value_micros", F.concat(F.lit("AGE_RANGE_"), F.col("age_code")).alias("age_range"),
        "gender", F.col("country").alias("geo_target_country"), F.col("region").alias("geo_target_region"))
    return {"meta": meta, "google": google}


def breakdown_payloads(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Landed breakdown answers: Meta insights as JSON, Google rows as JSON with the key they were asked for."""
    w = breakdown_wide(spark, sf_dir)
    meta = w["meta"].select(F.to_json(F.struct(
        "account_id", "campaign_id", "campaign_name", _date_txt("stat_date").alias("date_start"), "age", "gender", "country", "region", "attribution_setting",
        F.col("impressions").cast("string").alias("impressions"), F.concat(F.col("clicks").cast("string"), F.lit(".2")).alias("clicks"),
        _micros_text("spend_micros").alias("spend"))).alias("payload"))
    row = F.struct(
        F.struct(F.col("campaign_id").alias("id"), F.col("campaign_name").alias("name")).alias("campaign"),
        F.struct(_date_txt("stat_date").alias("date"), F.col("geo_target_region")).alias("segments"),
        F.struct(F.struct(F.col("age_range").alias("type")).alias("age_range"), F.struct(F.trim("gender").alias("type")).alias("gender")).alias("ad_group_criterion"),
        F.struct(F.col("geo_target_country").alias("country_criterion_id")).alias("user_location_view"),
        F.struct("impressions", "clicks", "cost_micros", "conversions", (F.col("conversion_value_micros") / F.lit(1e6)).alias("conversions_value")).alias("metrics"))
    keys = F.array(*[F.lit(k) for k in ("age_range", "gender", "geo_target_country", "geo_target_region")])
    google = w["google"].select("customer_id", F.to_json(row).alias("payload")).select("customer_id", F.explode(keys).alias("breakdown_key"), "payload")
    return {"meta": meta, "google": google}


# ---------------------------------------------------------------- landed payloads
def _date_txt(c):
    return F.date_format(F.col(c), "yyyy-MM-dd")


def meta_insight_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = view(spark, sf_dir, "fx_ads_raw").filter(F.col("channel_key") == "META")
    ins = F.struct(
        F.concat(F.lit("act_"), F.col("account_id_norm")).alias("account_id"),
        F.concat(F.lit("Account "), F.col("account_id_norm")).alias("account_name"),
        "campaign_id", "campaign_name", F.col("ad_group_id").alias("adset_id"),
        F.col("ad_group_name").alias("adset_name"), "ad_id", "ad_name", _date_txt("stat_date").alias("date_start"),
        F.lit("7d_click").alias("attribution_setting"),
        F.when(F.col("load_seq") % 9 == 0, F.lit("")).otherwise(F.col("impressions").cast("string")).alias("impressions"),
        F.when(F.col("tie1") % 2 == 0, F.concat(F.col("clicks").cast("string"), F.lit(".7")))
         .otherwise(F.col("clicks").cast("string")).alias("clicks"),
        F.col("clicks").cast("string").alias("inline_link_clicks"),
        _micros_text("cost_micros").alias("spend"),
        F.array(F.struct(F.lit("link_click").alias("action_type"), F.col("clicks").cast("string").alias("value")))
         .alias("actions"))
    return r.select(F.to_json(ins).alias("payload"))


def google_perf_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = view(spark, sf_dir, "fx_ads_raw").filter(F.col("channel_key") == "GOOGLE_ADS")
    row = F.struct(
        F.struct(F.col("campaign_id").alias("id"), F.col("campaign_name").alias("name")).alias("campaign"),
        F.when(F.col("ad_group_id").isNotNull(),
               F.struct(F.col("ad_group_id").alias("id"), F.col("ad_group_name").alias("name"))).alias("ad_group"),
        F.struct(F.struct(F.col("ad_id").alias("id"), F.col("ad_name").alias("name")).alias("ad")).alias("ad_group_ad"),
        F.struct(_date_txt("stat_date").alias("date")).alias("segments"),
        F.struct("impressions", "clicks", "cost_micros", "conversions",
                 (F.col("conv_value_micros") / F.lit(1e6)).alias("conversions_value")).alias("metrics"))
    return r.select(F.col("account_id_norm").alias("customer_id"), F.to_json(row).alias("payload"))


def google_action_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, [])
    e = spark.table("events")
    res = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("customers/1/assets/"), (F.col("event_id") % 6).cast("string"))) \
           .otherwise(F.concat(F.lit("customers/"), (F.col("user_id") % 20).cast("string"), F.lit("/conversionActions/"),
                               (F.col("event_id") % 6).cast("string")))
    name = (F.when(F.col("event_id") % 4 == 0, F.lit("Website Purchase!!")).when(F.col("event_id") % 4 == 1, F.lit("Lead — Form"))
             .when(F.col("event_id") % 4 == 2, F.lit("")))
    cat = F.when(F.col("event_id") % 3 == 0, F.lit("PURCHASE")).when(F.col("event_id") % 3 == 1, F.lit("DEFAULT"))
    val = F.concat(F.round(F.col("value") * 100).cast("bigint").cast("string"), F.lit("."),
                   F.lpad((F.col("event_id") % 10000000).cast("string"), 7, "0"))
    row = F.struct(
        F.struct((F.col("user_id") % 40).cast("string").alias("id"),
                 F.concat(F.lit("Campaign "), (F.col("user_id") % 40).cast("string")).alias("name")).alias("campaign"),
        F.struct(F.when(F.col("event_id") % 17 == 0, F.lit("")).otherwise(F.date_format(F.col("ts"), "yyyy-MM-dd"))
                 .alias("date"), res.alias("conversion_action"), name.alias("conversion_action_name"),
                 cat.alias("conversion_action_category")).alias("segments"),
        F.struct(((F.col("event_id") % 5) - 1).cast("double").alias("all_conversions"),
                 val.alias("all_conversions_value")).alias("metrics"))
    return e.select((F.col("user_id") % 20).cast("string").alias("customer_id"), F.to_json(row).alias("payload"))


def google_conv_dim_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, [])
    e = spark.table("events")
    k = (F.col("event_id") % 13).cast("string")
    ca = F.struct(
        F.when(F.col("event_id") % 29 == 0, F.lit("")).otherwise(
            F.concat(F.lit("customers/"), (F.col("user_id") % 20).cast("string"), F.lit("/conversionActions/"), k))
         .alias("resource_name"),
        F.when(F.col("event_id") % 31 == 0, F.lit("")).otherwise(k).alias("id"),
        F.concat(F.lit("Action "), k, F.lit(" v"), (F.col("event_id") % 3).cast("string")).alias("name"),
        F.lit("PURCHASE").alias("category"), F.lit("WEBPAGE").alias("type"),
        F.when(F.col("event_id") % 2 == 0, F.lit("ENABLED")).otherwise(F.lit("REMOVED")).alias("status"),
        (F.col("event_id") % 2 == 0).alias("primary_for_goal"),
        (F.col("event_id") % 3 == 0).alias("include_in_conversions_metric"))
    return e.select((F.col("user_id") % 20).cast("string").alias("customer_id"), F.col("event_id").alias("ingest_seq"),
                    F.to_json(F.struct(ca.alias("conversion_action"))).alias("payload"))


def tiktok_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = view(spark, sf_dir, "fx_ads_raw").filter(F.col("channel_key") == "TIKTOK_ADS")
    m = F.struct(
        "campaign_id", F.col("ad_group_id").alias("adgroup_id"),
        F.concat(F.col("impressions").cast("string"), F.lit(".0")).alias("impressions"),
        F.when(F.col("load_seq") % 7 != 0, F.col("clicks").cast("string")).alias("clicks"),
        _micros_text("cost_micros").alias("spend"),
        F.round(F.col("conversions") * 100).cast("bigint").cast("string").alias("conversion"),
        _micros_text("conv_value_micros").alias("value"))
    d = F.struct("ad_id", F.concat(_date_txt("stat_date"), F.lit(" 00:00:00")).alias("stat_time_day"))
    return r.select(F.col("account_id_norm").alias("advertiser_id"),
                    F.to_json(F.struct(d.alias("dimensions"), m.alias("metrics"))).alias("payload"))


def naver_payloads(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    register(spark, sf_dir, ["fx_naver_entities"])
    r = view(spark, sf_dir, "fx_ads_raw").filter(F.col("channel_key") == "NAVER_ADS")
    s = F.col("load_seq")
    stat = F.struct(
        F.when(s % 3 != 0, F.col("ad_group_id")).alias("adgroupId"),
        F.when(s % 3 == 0, F.col("ad_group_id")).alias("nccAdgroupId"),
        F.when(s % 4 != 0, F.col("campaign_id")).alias("campaignId"),
        F.when(s % 5 != 0, F.col("ad_group_name")).alias("adgroupName"),
        F.when(s % 6 != 0, _date_txt("stat_date")).alias("date"),
        F.when(s % 2 == 0, F.col("impressions").cast("string")).alias("impressions"),
        F.when(s % 2 == 1, F.col("impressions").cast("string")).alias("impCnt"),
        F.when(s % 2 == 0, F.col("clicks").cast("string")).alias("clicks"),
        F.when(s % 2 == 1, F.col("clicks").cast("string")).alias("clkCnt"),
        F.when(s % 2 == 0, _micros_text("cost_micros")).alias("cost"),
        F.when(s % 2 == 1, _micros_text("cost_micros")).alias("salesAmt"))
    stats = r.select(F.col("account_id_norm").alias("customer_id"), F.to_json(stat).alias("payload"))
    ent = spark.table("fx_naver_entities")
    camps = ent.filter(F.col("kind") == "campaign").select(
        "customer_id", F.lit(1).alias("ingest_seq"), F.to_json(F.struct(F.col("campaign_id").alias("nccCampaignId"), "name")).alias("payload"))
    return {"stats": stats, "campaigns": camps, "adgroups": _adgroup_lists(ent)}


def _adgroup_lists(ent: DataFrame) -> DataFrame:
    return ent.filter(F.col("kind") == "adgroup").select(
        "customer_id", F.lit(1).alias("ingest_seq"), F.to_json(F.struct(F.col("ad_group_id").alias("nccAdgroupId"),
                                          F.col("campaign_id").alias("nccCampaignId"), "name")).alias("payload"))


def naver_adgroup_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ad-group lists of :func:`naver_payloads`, for readers that want no stats."""
    return _adgroup_lists(straight(spark, sf_dir, "fx_naver_entities"))


CREATIVE_JSON = ("struct<id:string,name:string,object_type:string,status:string,body:string,thumbnail_url:string,"
                 "image_hash:string,object_story_spec:struct<link_data:struct<picture:string,image_hash:string,"
                 "message:string,name:string,description:string,call_to_action:struct<type:string>,"
                 "child_attachments:array<struct<picture:string,image_hash:string,video_id:string>>>,"
                 "video_data:struct<image_url:string,image_hash:string,video_id:string,message:string,title:string>>,"
                 "asset_feed_spec:struct<images:array<struct<url:string,hash:string>>,"
                 "videos:array<struct<video_id:string>>,bodies:array<struct<text:string>>,"
                 "titles:array<struct<text:string>>,descriptions:array<struct<text:string>>,"
                 "call_to_action_types:array<string>>>")


def creative_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed Meta insight + creative JSON per ad (creative fields from documents)."""
    c = straight(spark, sf_dir, "fx_creative")
    col = F.col
    nz = lambda x: F.when(x != "", x)  # noqa: E731 - absent rather than empty
    children = F.filter(F.array(
        F.when(col("has_c1"), F.struct(col("c1_pic").alias("picture"), F.lit("c1h").alias("image_hash"),
                                       F.lit(None).cast("string").alias("video_id"))),
        F.when(col("has_c2"), F.struct(col("c2_pic").alias("picture"), F.lit(None).cast("string").alias("image_hash"),
                                       col("c2_vid").alias("video_id")))), lambda x: x.isNotNull())
    link = F.struct(col("link_pic").alias("picture"), col("link_hash").alias("image_hash"), col("text").alias("message"),
                    col("link_name").alias("name"), col("link_desc").alias("description"),
                    F.when(col("cta_type").isNotNull(), F.struct(col("cta_type").alias("type"))).alias("call_to_action"),
                    children.alias("child_attachments"))
    video = F.when(col("has_video"), F.struct(col("v_img").alias("image_url"), F.lit(None).cast("string").alias("image_hash"),
                                              col("v_id").alias("video_id"), F.lit(None).cast("string").alias("message"),
                                              col("v_title").alias("title")))
    spec = F.when(col("has_spec"), F.struct(link.alias("link_data"), video.alias("video_data")))
    feed = F.when(col("has_feed"), F.struct(
        F.array(F.struct(col("f1_url").alias("url"), col("f1_hash").alias("hash")),
                F.struct(col("f2_url").alias("url"), col("f2_hash").alias("hash"))).alias("images"),
        F.array(F.struct(col("fv_id").alias("video_id"))).alias("videos"),
        F.array(F.struct(col("f_body").alias("text"))).alias("bodies"),
        F.array(F.struct(col("v_title").alias("text"))).alias("titles"),
        F.array(F.struct(col("link_desc").alias("text"))).alias("descriptions"),
        F.array(F.lit("SHOP_NOW"), F.lit("LEARN_MORE")).alias("call_to_action_types")))
    creative = F.struct(col("creative_id").alias("id"), col("creative_name").alias("name"),
                        F.lit("SHARE").alias("object_type"), F.lit("ACTIVE").alias("status"),
                        F.lit(None).cast("string").alias("body"), nz(col("c_thumb")).alias("thumbnail_url"),
                        nz(col("c_hash")).alias("image_hash"), spec.alias("object_story_spec"),
                        feed.alias("asset_feed_spec"))
    return c.select(F.col("account_id_norm").alias("account_id"), "ad_id", "doc_id",
                    F.col("valid_date").alias("collected_date"), F.to_json(creative).alias("creative_json"))


def google_creative_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = straight(spark, sf_dir, "fx_asset_raw")
    k = F.col("load_seq")
    ad = F.struct(F.col("ad_id").alias("id"), F.concat(F.lit("Ad "), F.col("ad_id")).alias("name"),
                  F.when(k % 2 == 0, F.lit("IMAGE_AD")).otherwise(F.lit("VIDEO_AD")).alias("type"),
                  F.array(F.concat(F.lit("https://land/"), F.col("campaign_id"))).alias("final_urls"),
                  F.when(k % 2 == 0, F.struct(F.concat(F.lit("https://img/"), F.col("asset_id")).alias("image_url")))
                   .alias("image_ad"),
                  F.when(k % 2 == 1, F.struct(F.struct(F.concat(F.lit("customers/1/assets/"), F.col("asset_id"))
                                                       .alias("asset")).alias("video"))).alias("video_ad"))
    row = F.struct(F.struct(F.col("campaign_id").alias("id")).alias("campaign"),
                   F.struct(F.col("ad_group_id").alias("id")).alias("ad_group"),
                   F.struct(F.when(k % 5 != 0, F.date_format("stat_date", "yyyy-MM-dd")).alias("date")).alias("segments"),
                   F.struct(F.lit("GOOD").alias("ad_strength"), F.lit("ENABLED").alias("status"),
                            F.when(F.col("ad_id").isNotNull(), ad).alias("ad")).alias("ad_group_ad"))
    return r.select("customer_id", F.to_json(row).alias("payload"))


def google_asset_payloads(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    r = view(spark, sf_dir, "fx_asset_raw")
    res = F.when(F.col("asset_id") != "", F.concat(F.lit("customers/"), F.col("customer_id"), F.lit("/assets/"),
                                                   F.col("asset_id")))
    v = F.struct(res.alias("asset"), F.upper("field_type").alias("field_type"), F.col("performance_label"))
    m = F.struct("impressions", "clicks", "cost_micros", "conversions",
                 (F.col("conversions_value_micros") / F.lit(1e6)).alias("conversions_value"))
    common = [F.struct(F.col("campaign_id").alias("id"),
                       F.upper(F.coalesce("campaign_channel_type", F.lit("UNKNOWN"))).alias("advertising_channel_type"))
              .alias("campaign"), F.struct(F.date_format("stat_date", "yyyy-MM-dd").alias("date")).alias("segments"),
              m.alias("metrics")]
    ad = r.filter(~F.col("is_pmax")).select("customer_id", F.to_json(F.struct(
        *common, F.struct(F.col("ad_group_id").alias("id")).alias("ad_group"),
        F.struct(F.struct(F.col("ad_id").alias("id")).alias("ad")).alias("ad_group_ad"),
        v.alias("ad_group_ad_asset_view"))).alias("payload"))
    pmax = r.filter(F.col("is_pmax")).select("customer_id", F.to_json(F.struct(
        *common, F.struct(F.col("asset_group_id").alias("id")).alias("asset_group"),
        v.alias("asset_group_asset"))).alias("payload"))
    return {"ad": ad, "pmax": pmax}


def tiktok_ad_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = straight(spark, sf_dir, "fx_ads_raw").filter(F.col("channel_key") == "TIKTOK_ADS")
    ad = F.struct("ad_id", "campaign_id", F.col("ad_group_id").alias("adgroup_id"), "ad_name",
                  F.when(F.col("load_seq") % 2 == 0, F.lit("SINGLE_VIDEO")).otherwise(F.lit("SINGLE_IMAGE")).alias("ad_format"),
                  F.concat(F.lit("Text "), F.col("ad_id")).alias("ad_text"),
                  F.when(F.col("load_seq") % 2 == 0, F.concat(F.lit("vid"), F.col("ad_id"))).alias("video_id"),
                  F.concat(F.lit("https://img/"), F.col("ad_id")).alias("image_url"))
    return r.select(F.col("account_id_norm").alias("advertiser_id"), F.to_json(ad).alias("payload"))


def naver_ad_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = straight(spark, sf_dir, "fx_ads_raw").filter(F.col("channel_key") == "NAVER_ADS")
    s = F.col("load_seq")
    ad = F.struct(F.when(s % 2 == 0, F.col("ad_id")).alias("nccAdId"), F.when(s % 2 == 1, F.col("ad_id")).alias("adId"),
                  F.when(s % 3 != 0, F.col("campaign_id")).alias("nccCampaignId"),
                  F.col("ad_group_id").alias("nccAdgroupId"), F.col("ad_name").alias("adName"),
                  F.lit("TEXT_45").alias("type"),
                  F.struct(F.concat(F.lit("Head "), F.col("ad_id")).alias("headline"),
                           F.col("ad_group_name").alias("description"),
                           F.struct(F.concat(F.lit("https://n/"), F.col("ad_id")).alias("url")).alias("image")).alias("ad"))
    return r.select(F.col("account_id_norm").alias("customer_id"), F.to_json(ad).alias("payload"))
