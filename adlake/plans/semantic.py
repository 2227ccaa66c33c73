"""A small metrics layer: cubes of measures and dimensions compiled to Spark plans.

A query is a plain dict ``{measures, dimensions, timeDimensions, filters,
order, limit, offset}`` naming members as ``Cube.member``. The driver only
resolves member names against the registry; the work (filter, join, group,
post-filter, order, limit) is one DataFrame plan, so Catalyst pushes the
report-date range down to the mart's scan.

Output columns are named ``Cube__member`` (``Cube__member__granularity`` for
time dimensions).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, NumericType, TimestampNTZType, TimestampType

from adlake.functions.columns import micros_to_double, safe_ratio
from adlake.session import Window
from adlake.sources import io

MAX_ROWS = 10_000
GRANULARITIES = ("day", "week", "month", "year")


class ContractError(ValueError):
    """The query touches a fact cube without a report-date range."""

    def __init__(self, code: str, message: str):
        super().__init__(message)
        self.code = code


@dataclass
class Measure:
    kind: str                      # "sum" | "avg" | "number" (post-aggregate)
    expr: Callable[[], Column]     # input column (sum/avg) or aggregate expression (number)


@dataclass
class Cube:
    name: str
    dimensions: dict[str, Callable[[], Column]]
    measures: dict[str, Measure] = field(default_factory=dict)
    joins: dict[str, tuple[str, str]] = field(default_factory=dict)   # cube -> (local dim, remote dim)
    time_dimension: str | None = None
    required_time: bool = False


def _c(name):
    return lambda: F.col(name)


def _lit(v):
    return lambda: F.lit(v)


# The registry: cube definitions (members map to mart columns).
def default_registry() -> dict[str, Cube]:
    # Money is summed as exact integer micros, then converted.
    money = lambda c: Measure("number", lambda: micros_to_double(F.sum(c)))
    return {
        "AdsCampaign": Cube(
            "AdsCampaign",
            dimensions={"reportDate": _c("report_date"), "branchId": _c("branch_id"),
                        "channelKey": _c("channel_key"), "campaignId": _c("campaign_id"),
                        "campaignName": _c("campaign_name"), "sourceTier": _c("source_tier")},
            measures={
                "spend": money("spend_native_micros"),
                "impressions": Measure("sum", _c("impressions")),
                "clicks": Measure("sum", _c("clicks")),
                "ctr": Measure("number", lambda: safe_ratio(F.sum("clicks"), F.sum("impressions")) * 100),
                "cpc": Measure("number", lambda: safe_ratio(micros_to_double(F.sum("spend_native_micros")),
                                                            F.sum("clicks"))),
                "roas": Measure("number", lambda: safe_ratio(F.sum("conversion_value_native_micros"),
                                                             F.sum("spend_native_micros"))),
            },
            joins={"Branch": ("branchId", "branchId"), "Channel": ("channelKey", "channelKey")},
            time_dimension="reportDate", required_time=True),
        "Orders": Cube(
            "Orders",
            dimensions={"reportDate": _c("report_date"), "branchId": _c("branch_id"),
                        "currencyCode": _c("currency_code"), "sourceTier": _lit("demo")},
            measures={"orders": Measure("sum", _c("orders")),
                      "netRevenue": money("net_revenue_native_micros"),
                      "grossRevenue": money("gross_revenue_native_micros")},
            joins={"Branch": ("branchId", "branchId")}, time_dimension="reportDate", required_time=True),
        "Surveys": Cube(
            "Surveys",
            dimensions={"reportDate": _c("report_date"), "branchId": _c("branch_id"), "sourceTier": _lit("demo")},
            measures={"responseCount": Measure("sum", _c("response_count")),
                      "avgScore": Measure("avg", _c("avg_answer_score"))},
            joins={"Branch": ("branchId", "branchId")}, time_dimension="reportDate", required_time=True),
        "Branch": Cube("Branch", dimensions={"branchId": _c("branch_id"), "branchName": _c("branch_name"),
                                             "countryCode": _c("country_code"), "currency": _c("currency")}),
        "Channel": Cube("Channel", dimensions={"channelKey": _c("channel_key"), "channelName": _c("channel_name")}),
    }


# Display names of channel keys in the channel dimension.
CHANNEL_NAMES = {
    "META": "Meta",
    "GOOGLE_ADS": "Google Ads",
    "GOOGLE_DEMAND_GEN": "Google Demand Gen",
    "TIKTOK_ADS": "TikTok",
    "NAVER_ADS": "네이버 검색광고",
    "YOUTUBE": "YouTube",
    "AFFILIATE": "제휴",
    "EMAIL": "이메일",
    "INFLUENCER": "인플루언서",
    "COUPON": "쿠폰",
    "ORGANIC_SEO": "Organic SEO",
    "OTA": "OTA",
    "OTHER": "기타",
}
AD_CHANNELS = ["META", "GOOGLE_ADS", "TIKTOK_ADS", "NAVER_ADS"]


def channel_cube_source(channel_map: DataFrame) -> DataFrame:
    """Active mapped channels with display names, plus the four ad channels."""
    spark = channel_map.sparkSession
    names = F.create_map(*[x for kv in CHANNEL_NAMES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    mapped = channel_map.filter(F.col("is_active") == F.lit(True)).select(
        "channel_key", F.coalesce(names[F.col("channel_key")], F.col("channel_key")).alias("channel_name"))
    fixed = spark.createDataFrame([(k, CHANNEL_NAMES[k]) for k in AD_CHANNELS], "channel_key string, channel_name string")
    return mapped.unionByName(fixed).distinct()


# ------------------------------------------------------------------ stored marts
#: Partition column of stored marts: the first day of the report date's month.
MART_PARTITION = "report_month"


def refresh_mart(spark: SparkSession, cube: str, mart: DataFrame, path: str, w: Window) -> None:
    """Replace the stored mart's months of a refresh window with ``mart``, all or nothing.

    The window must cover whole months, since a month is replaced as one; the mart's plan is
    restricted to it, so its facts are read for the window only. Rows without a report date have
    no place in a stored mart and are dropped, as every report-date range drops them.
    """
    last = w.end + _dt.timedelta(days=1)
    if w.start.day != 1 or last.day != 1:
        raise ValueError(f"a refresh window covers whole months, not {w.start} to {w.end}")
    spec = io.TableSpec(f"mart-{cube}", MART_PARTITION, cluster_by=("report_date",), require_partition_filter=False)
    months = Window(w.start, w.end.replace(day=1))
    rows = mart.filter(w.contains("report_date")).withColumn(MART_PARTITION, F.trunc("report_date", "month"))
    io.write_window(spark, rows, path, spec, months)


def stored_mart(spark: SparkSession, path: str) -> DataFrame:
    """A mart kept by :func:`refresh_mart`, as a cube's source: a query's report-date range prunes its partitions."""
    io.recover(spark, path)
    return spark.read.parquet(path)


# ------------------------------------------------------------------ contract
def _members(q: dict) -> list[str]:
    out = list(q.get("measures") or []) + list(q.get("dimensions") or []) + list(q.get("segments") or [])
    out += [td.get("dimension") for td in q.get("timeDimensions") or [] if isinstance(td, dict)]

    def walk(fs):
        for f in fs or []:
            if isinstance(f, dict):
                if isinstance(f.get("member"), str):
                    out.append(f["member"])
                walk(f.get("and"))
                walk(f.get("or"))
    walk(q.get("filters"))
    return [m for m in out if isinstance(m, str)]


def _has_range(r) -> bool:
    if isinstance(r, str):
        return r.strip() != ""
    return isinstance(r, (list, tuple)) and len(r) == 2 and all(isinstance(v, str) and v.strip() for v in r)


def validate(q: dict, registry: dict[str, Cube]) -> None:
    """A query touching a fact cube must carry that cube's reportDate range."""
    members = _members(q)
    for cube in registry.values():
        if not cube.required_time or not any(m.startswith(f"{cube.name}.") for m in members):
            continue
        td = f"{cube.name}.{cube.time_dimension}"
        if not any(isinstance(t, dict) and t.get("dimension") == td and _has_range(t.get("dateRange"))
                   for t in q.get("timeDimensions") or []):
            code = {"AdsCampaign": "ads_campaign", "Orders": "orders", "Surveys": "surveys"}.get(cube.name, cube.name)
            raise ContractError(f"{code}_report_date_required",
                                f"{cube.name} queries require {td} dateRange for partition pruning.")


def date_range(r, today: _dt.date) -> tuple[_dt.date, _dt.date]:
    """A [from, to] pair, or "last N days": N complete days ending yesterday."""
    if isinstance(r, (list, tuple)):
        return _dt.date.fromisoformat(r[0][:10]), _dt.date.fromisoformat(r[1][:10])
    t = r.strip().lower()
    for n in (7, 30, 90):
        if t == f"last {n} days":
            return today - _dt.timedelta(days=n), today - _dt.timedelta(days=1)
    if t == "today":
        return today, today
    if t == "yesterday":
        y = today - _dt.timedelta(days=1)
        return y, y
    raise ValueError(f"unsupported date range {r!r}")


def granularity(col: Column, unit: str) -> Column:
    """Truncate a date to day, week (Monday), month or year."""
    if unit not in GRANULARITIES:
        raise ValueError(f"unsupported granularity {unit!r}")
    return F.to_date(F.date_trunc(unit, col))


# ------------------------------------------------------------------ compile
def _split(member: str):
    cube, _, name = member.partition(".")
    return cube, name


def _out(member: str, gran: str | None = None) -> str:
    return member.replace(".", "__") + (f"__{gran}" if gran else "")


#: Filter operators: how they compare, and whether values are needed.
COMPARISONS = {"gt": "__gt__", "gte": "__ge__", "lt": "__lt__", "lte": "__le__",
               "afterDate": "__gt__", "afterOrOnDate": "__ge__", "beforeDate": "__lt__", "beforeOrOnDate": "__le__"}
DATE_OPERATORS = ("afterDate", "afterOrOnDate", "beforeDate", "beforeOrOnDate", "inDateRange", "notInDateRange")


class FilterError(ValueError):
    """A filter tree that has no meaning as a row filter followed by a group filter."""


def _dates(member: str, op: str, values: list) -> list[Column]:
    try:
        return [F.lit(_dt.date.fromisoformat(str(v)[:10])) for v in values]
    except ValueError as e:
        raise FilterError(f"{op} on {member} takes ISO dates, not {values}") from e


def _leaf(f: dict, x: Column, kind: DataType, numeric: bool) -> Column:
    """One condition on ``x``. No values: ``equals`` and ``contains`` admit nothing, their negations everything."""
    member, op, values = f["member"], f.get("operator", "equals"), list(f.get("values") or [])
    dated = isinstance(kind, (DateType, TimestampType, TimestampNTZType))
    if op in ("set", "notSet"):
        return x.isNotNull() if op == "set" else x.isNull()
    if op in DATE_OPERATORS and not dated:
        raise FilterError(f"{op} needs a time dimension, {member} is none")
    if op in COMPARISONS:
        if len(values) != 1:
            raise FilterError(f"{op} on {member} takes one value, not {len(values)}")
        if dated:
            return getattr(x.cast("date"), COMPARISONS[op])(_dates(member, op, values)[0])
        try:
            return getattr(x.try_cast("double"), COMPARISONS[op])(F.lit(float(values[0])))
        except ValueError as e:
            raise FilterError(f"{op} on {member} takes a number, not {values[0]!r}") from e
    if op in ("inDateRange", "notInDateRange"):
        if len(values) not in (1, 2):
            raise FilterError(f"{op} on {member} takes one date or a pair")
        lo, hi = (_dates(member, op, values) * 2)[:2]
        inside = x.cast("date").between(lo, hi)
        return inside if op == "inDateRange" else x.isNull() | ~inside
    if op in ("equals", "notEquals"):
        wanted = _dates(member, op, values) if dated else [float(v) for v in values] if numeric else [str(v) for v in values]
        hit = (x.cast("date") if dated else x.cast("double") if numeric else x).isin(wanted) if wanted else F.lit(False)
    elif op in ("contains", "notContains"):
        text = F.lower(x.cast("string"))
        hit = reduce(or_, [F.contains(text, F.lit(str(v).lower())) for v in values], F.lit(False))
    else:
        raise FilterError(f"unsupported filter operator {op!r}")
    return hit if op in ("equals", "contains") else x.isNull() | ~hit


def split_filters(filters: list, row: Callable[[str], tuple[Column, DataType]], group: Callable[[str], Column],
                  measures: set) -> tuple[Column | None, Column | None]:
    """A filter list as (condition on rows, condition on groups), either None if there is none.

    Conditions on dimensions go to the rows, those on measures to the groups. ``and`` is divided
    between the two at any depth; an ``or`` must lie on one side, since neither stage alone can
    decide it. Empty groups put no condition.
    """
    def both(parts: list, how) -> Column | None:
        parts = [p for p in parts if p is not None]
        return reduce(how, parts) if parts else None

    def walk(f: dict) -> tuple[Column | None, Column | None]:
        if "and" in f or "or" in f:
            rows, groups = [], []
            if f.get("and"):
                r, g = zip(*map(walk, f["and"]))
                rows, groups = [both(r, and_)], [both(g, and_)]
            if f.get("or"):
                r, g = zip(*map(walk, f["or"]))
                if any(x is not None for x in r) and any(x is not None for x in g):
                    raise FilterError(f"or cannot mix dimensions and measures: {', '.join(_filter_members(f['or']))}")
                rows.append(both(r, or_))
                groups.append(both(g, or_))
            return both(rows, and_), both(groups, and_)
        if not isinstance(f.get("member"), str):
            raise FilterError(f"a filter needs a member, and, or or: {f}")
        if f["member"] in measures:
            return None, _leaf(f, group(f["member"]), DoubleType(), True)
        x, kind = row(f["member"])
        return _leaf(f, x, kind, isinstance(kind, NumericType)), None

    return walk({"and": list(filters)}) if filters else (None, None)


def _filter_members(filters: list) -> list[str]:
    """Members named anywhere in a filter tree."""
    out = []
    for f in filters:
        if isinstance(f, dict):
            out += [f["member"]] if f.get("member") else []
            out += _filter_members((f.get("and") or []) + (f.get("or") or []))
    return out


def semantic_query(q: dict, sources: dict[str, DataFrame], today: _dt.date,
                   registry: dict[str, Cube] | None = None) -> DataFrame:
    """Compile a metrics query into one DataFrame plan."""
    reg = registry or default_registry()
    validate(q, reg)
    for part in ("segments", "timezone"):
        if q.get(part):
            raise ValueError(f"{part} are not supported")
    if q.get("limit") and int(q["limit"]) > MAX_ROWS:
        raise ValueError(f"limit {q['limit']} is above {MAX_ROWS}")
    measures = list(q.get("measures") or [])
    dims = list(q.get("dimensions") or [])
    tds = [t for t in q.get("timeDimensions") or [] if isinstance(t, dict)]
    members = measures + dims + [t["dimension"] for t in tds]
    base_name = _split(measures[0])[0] if measures else _split(members[0])[0]
    base = reg[base_name]
    df = sources[base_name]
    # Report-date range first: it reaches the mart's scan as a partition filter.
    for t in tds:
        cube, name = _split(t["dimension"])
        if t.get("dateRange") and cube == base_name:
            lo, hi = date_range(t["dateRange"], today)
            if MART_PARTITION in df.columns and name == base.time_dimension:  # a stored mart: whole months first
                df = df.filter(F.col(MART_PARTITION).between(F.lit(lo.replace(day=1)), F.lit(hi.replace(day=1))))
            df = df.filter(reg[cube].dimensions[name]().between(F.lit(lo), F.lit(hi)))
    # Many-to-one joins for dimension members of joined cubes.
    filtered = _filter_members(q.get("filters") or [])
    joined = {_split(m)[0] for m in members + filtered if "." in m} - {base_name}
    hidden = [m for m in dict.fromkeys(filtered) if m not in measures and "." in m and _split(m)[0] == base_name
              and _split(m)[1] in base.measures]  # filtered on, not asked for
    for cube_name in sorted(joined):
        if cube_name not in base.joins:
            raise ValueError(f"{base_name} has no join to {cube_name}")
        local, remote = base.joins[cube_name]
        rc = reg[cube_name]
        rdf = sources[cube_name].select(*[rc.dimensions[d]().alias(f"__{cube_name}__{d}") for d in rc.dimensions])
        df = df.join(rdf, base.dimensions[local]() == F.col(f"__{cube_name}__{remote}"), "left")

    def dim_col(member: str) -> Column:
        cube, name = _split(member)
        return reg[cube].dimensions[name]() if cube == base_name else F.col(f"__{cube}__{name}")

    def typed(member: str) -> tuple[Column, DataType]:
        cube, name = _split(member)
        if name not in reg[cube].dimensions:
            raise FilterError(f"unknown member {member}")
        return dim_col(member), df.select(dim_col(member)).schema[0].dataType

    on_rows, on_groups = split_filters(q.get("filters") or [], typed, lambda m: F.col(_out(m)), set(measures) | set(hidden))
    if on_rows is not None:
        df = df.filter(on_rows)
    keys = [dim_col(m).alias(_out(m)) for m in dims]
    keys += [granularity(dim_col(t["dimension"]), t["granularity"]).alias(_out(t["dimension"], t["granularity"]))
             for t in tds if t.get("granularity")]
    if measures or hidden:
        aggs = []
        for m in measures + hidden:
            cube, name = _split(m)
            ms = reg[cube].measures[name]
            e = (F.sum(ms.expr()) if ms.kind == "sum" else F.avg(ms.expr()) if ms.kind == "avg" else ms.expr())
            aggs.append(e.alias(_out(m)))
        out = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    else:
        out = df.select(*keys).distinct()
    if on_groups is not None:
        out = out.filter(on_groups)
    out = out.drop(*[_out(m) for m in hidden])
    order = q.get("order")
    if order:
        items = order.items() if isinstance(order, dict) else order
        cols = []
        for member, direction in items:
            grain = next((t["granularity"] for t in tds if t["dimension"] == member and t.get("granularity")), None)
            name = _out(member, grain) if grain and member not in dims else _out(member)
            if name not in out.columns:
                raise ValueError(f"order by {member}, which the query does not select")
            c = F.col(name)
            cols.append(c.desc_nulls_last() if str(direction).lower() == "desc" else c.asc_nulls_last())
        out = out.orderBy(*cols)
    offset = int(q.get("offset") or 0)
    if offset:
        out = out.offset(offset)
    return out.limit(int(q["limit"])) if q.get("limit") else out


def numeric_columns(df: DataFrame, cols) -> DataFrame:
    """Numeric text measures to numbers; text that is not a number stays as text.

    Each listed column ``c`` becomes a double ``c`` (NULL when not numeric) and
    keeps its original text as ``c__text`` when it did not parse.
    """
    out = df
    for c in cols:
        txt = F.col(c).cast("string")
        num = F.trim(txt).try_cast("double")
        out = out.withColumn(f"{c}__text", F.when(num.isNull(), txt)).withColumn(c, num)
    return out
