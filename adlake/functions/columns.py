"""Scalar column rules of the warehouse.

Each function takes and returns ``Column`` objects built from
``pyspark.sql.functions`` only, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "col", "blank_key", "is_blank", "nonblank", "safe_ratio", "email_hash",
    "phone_hash", "customer_key", "ANONYMOUS_CUSTOMER_KEY", "strip_account_prefix",
    "money_text_to_micros", "decimal_to_micros", "micros_to_double", "int_via_float",
    "first_nonblank", "load_ts", "content_hash", "normalize_action_type",
    "sum0", "last_non_null", "latest_value", "parsed",
]

MICROS = 1_000_000


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_key(c: str | Column) -> Column:
    """Key part compared as ``IFNULL(x, '')``: NULL equals NULL and ``''``."""
    return F.coalesce(col(c), F.lit(""))


def is_blank(c: str | Column) -> Column:
    x = col(c)
    return x.isNull() | (F.trim(x) == "")


def nonblank(c: str | Column) -> Column:
    """``NULLIF(TRIM(x), '')`` keeping the untrimmed value."""
    x = col(c)
    return F.when(F.trim(x) != "", x)


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``SAFE_DIVIDE(num, NULLIF(den, 0))`` as a double; NULL on zero/NULL."""
    n = col(num).cast("double")
    d = col(den).cast("double")
    return F.when(d != 0, n / d)


def email_hash(c: str | Column) -> Column:
    """NULL if blank, else hex SHA-256 of the lower-cased, trimmed address."""
    x = col(c)
    return F.when(~is_blank(x), F.sha2(F.lower(F.trim(x)), 256))


def phone_hash(c: str | Column) -> Column:
    """NULL if blank, else hex SHA-256 of the digits and ``+`` signs."""
    x = col(c)
    return F.when(~is_blank(x), F.sha2(F.regexp_replace(x, r"[^0-9+]", ""), 256))


def ANONYMOUS_CUSTOMER_KEY() -> Column:
    """Key of a customer with no contact at all: SHA-256 of a bare pipe."""
    return F.sha2(F.lit("|"), 256)


def customer_key(email_h: str | Column, phone_h: str | Column) -> Column:
    """SHA-256 of ``email_hash|phone_hash``; NULL when both hashes are NULL."""
    e, p = col(email_h), col(phone_h)
    return F.when(
        e.isNotNull() | p.isNotNull(),
        F.sha2(F.concat(F.coalesce(e, F.lit("")), F.lit("|"), F.coalesce(p, F.lit(""))), 256),
    )


def strip_account_prefix(c: str | Column) -> Column:
    """Meta account ids arrive as ``act_<n>``; the warehouse keeps ``<n>``."""
    return F.regexp_replace(col(c), r"^act_", "")


def decimal_to_micros(c: str | Column) -> Column:
    """Money as exact integer micros (LongType): fast, codegen-friendly sums."""
    d = col(c).try_cast("decimal(38,9)")  # blank text is no amount
    return F.round(d * F.lit(MICROS), 0).cast("bigint")


def money_text_to_micros(c: str | Column) -> Column:
    """``SAFE_CAST(text AS NUMERIC)`` then to micros; bad text gives NULL."""
    dec = F.trim(col(c)).try_cast("decimal(38,9)")
    return F.round(dec * F.lit(MICROS), 0).cast("bigint")


def micros_to_double(c: str | Column) -> Column:
    return col(c).cast("double") / F.lit(float(MICROS))


def int_via_float(c: str | Column) -> Column:
    """Text or number to integer through a float, truncating; bad input NULL."""
    x = col(c)
    d = x.try_cast("double")
    return F.when(d.isNotNull() & ~F.isnan(d), d.cast("bigint"))


def first_nonblank(*cols: str | Column) -> Column:
    """First argument that is neither NULL nor blank."""
    return F.coalesce(*[nonblank(c) for c in cols])


def load_ts(now: str | Column | None = None) -> Column:
    """``COALESCE(source_extract_ts, ingestion_ts, now)``; ``now`` is a parameter."""
    parts = [F.col("source_extract_ts"), F.col("ingestion_ts")]
    if now is not None:
        parts.append(F.lit(now).cast("timestamp") if isinstance(now, str) else now)
    return F.coalesce(*parts)


def content_hash(*cols: str | Column) -> Column:
    """Hex SHA-256 of the given fields joined by ``|`` with NULL as ``''``."""
    return F.sha2(F.concat_ws("|", *[blank_key(c) for c in cols]), 256)


def normalize_action_type(c: str | Column) -> Column:
    """Lower-case, non-alphanumerics to ``_``, squeeze, trim ``_``; blank NULL.

    Unicode letters and digits are kept.
    """
    x = F.lower(col(c))
    x = F.regexp_replace(x, r"[^\p{L}\p{N}]+", "_")
    x = F.regexp_replace(x, r"^_+|_+$", "")
    return F.when(x != "", x)


def sum0(c: str | Column) -> Column:
    """``SUM(IFNULL(x, 0))``: NULL inputs add nothing, an all-NULL group is 0."""
    return F.sum(F.coalesce(col(c), F.lit(0)))


def last_non_null(value: str | Column, *order: str | Column) -> Column:
    """``ARRAY_AGG(v IGNORE NULLS ORDER BY order DESC LIMIT 1)[SAFE_OFFSET(0)]``.

    Rows whose value is NULL get a NULL ordering key, which ``max_by`` skips.
    """
    v = col(value)
    key = F.struct(*[col(o) for o in order]) if len(order) > 1 else col(order[0])
    return F.max_by(v, F.when(v.isNotNull(), key))


def latest_value(value: str | Column, *order: str | Column) -> Column:
    """``ARRAY_AGG(v ORDER BY order DESC LIMIT 1)[OFFSET(0)]`` (NULL kept)."""
    key = F.struct(*[col(o) for o in order]) if len(order) > 1 else col(order[0])
    return F.max_by(col(value), key)


def parsed(df: DataFrame, json_col: str, schema: str, name: str) -> DataFrame:
    """``df`` with ``json_col`` parsed into the struct column ``name``, once a row.

    The struct passes through a one-element generator, so later projections read its fields
    instead of copying the parse into every expression. Unreadable text gives a null struct.
    """
    return df.select("*", F.explode(F.array(F.from_json(json_col, schema))).alias(name))
