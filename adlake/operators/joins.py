"""Join shapes: size-checked broadcast, effective-dated lookups, keyword rules."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Largest lookup side (rows) we broadcast. Governance maps, rule lists and
# dimension tables are far below it; anything bigger takes a shuffle join.
BROADCAST_MAX_ROWS = 200_000

OPEN_END = _dt.date(9999, 12, 31)


def fits(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True when ``df`` has ``<= max_rows`` rows now.

    Reads at most ``max_rows + 1`` rows (a limited job that stops early for a
    big input). Use it on small base tables (governance maps, rule lists,
    dimensions), not on derived fact-sized plans. The answer holds for the plan
    being built and is not kept: tables change within a session.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` when ``df`` provably fits the bound, else ``df`` as is.

    Beyond the bound Catalyst plans a shuffle join and AQE may still switch
    to a broadcast from the measured runtime size.
    """
    return F.broadcast(df) if fits(df, max_rows) else df


#: Days are counted from far enough back that every SQL date is a number from 0 below 2 ** LEVELS.
DAY_ZERO, LEVELS = 1 << 20, 22


def day_number(c: Column) -> Column:
    return F.unix_date(c) + F.lit(DAY_ZERO)


def dyadic_ranges(first: Column, last: Column) -> Column:
    """The days ``first`` to ``last`` (day numbers) as an array of ranges (level, place).

    A range of level L covers the 2 ** L days from place * 2 ** L on. The ranges don't overlap and
    there are two a level at most, so an interval of n days has O(log n) of them.
    """
    def of_level(n: Column) -> Column:
        size = F.pow(F.lit(2), n).cast("long")
        low, high = F.ceil(first / size).cast("int"), F.floor((last + 1) / size).cast("int")
        pick = lambda c, place: F.when((low < high) & (c % 2 == 1), F.struct(n.alias("level"), place.alias("place")))
        return F.array(pick(low, low), pick(high, high - 1))

    levels = F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), of_level)
    return F.filter(F.flatten(levels), lambda x: x.isNotNull())


def covering_ranges(day: Column) -> Column:
    """All (level, place) whose range holds a day: one a level."""
    return F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda n: F.struct(
        n.alias("level"), F.floor(day / F.pow(F.lit(2), n)).cast("int").alias("place")))


def resolve_effective_segments(mapping: DataFrame, keys: Sequence[str], value_cols: Sequence[str],
                               start_col: str = "effective_start_date",
                               end_col: str = "effective_end_date",
                               priority: Sequence[str | Column] = ("effective_start_date",),
                               active_col: str | None = "is_active") -> DataFrame:
    """Turn an effective-dated map with overlaps into non-overlapping segments.

    A NULL end is open, a NULL start matches no date. Where mappings overlap,
    the one with the greatest ``priority`` (e.g. newest start, then newest
    update; ties: the greatest values) wins. The result has ``keys``,
    ``seg_start``, ``seg_end`` (inclusive) and ``value_cols``; each date of
    each key falls into at most one segment, so a fact joined to it needs no
    post-join deduplication (no shuffle of the fact side).

    Segments begin where a mapping begins or has ended. The best mapping of
    each such day comes from a dyadic index: every mapping is cut into
    O(log days) aligned ranges, a range keeps its best mapping only, and a day
    looks its 22 ranges up by equality. So n mappings of one key cost
    O(n log days) rows, spread by range, and no two mappings are compared.

    The work is on the small map side only.
    """
    m = mapping
    if active_col:
        m = m.filter(F.col(active_col) == F.lit(True))
    best = F.struct(F.struct(*[F.col(p) if isinstance(p, str) else p for p in priority]).alias("p"),
                    F.struct(*[F.col(v) for v in value_cols]).alias("v"))
    m = m.filter(F.col(start_col).isNotNull()).select(
        *keys, F.col(start_col).alias("__s"), F.coalesce(F.col(end_col), F.lit(OPEN_END)).alias("__e"), best.alias("__b"))
    days = F.filter(F.array(F.col("__s"), F.when(F.col("__e") < F.lit(OPEN_END), F.date_add("__e", 1))), lambda d: d.isNotNull())
    nothing = F.lit(None).cast(m.schema["__b"].dataType)
    entries = F.transform(dyadic_ranges(day_number(F.col("__s")), day_number(F.col("__e"))), lambda r: F.struct(
        r["level"].alias("level"), r["place"].alias("place"), F.lit(None).cast("date").alias("day"), F.col("__b").alias("best")))
    probes = F.flatten(F.transform(days, lambda d: F.transform(covering_ranges(day_number(d)), lambda r: F.struct(
        r["level"].alias("level"), r["place"].alias("place"), d.alias("day"), nothing.alias("best")))))
    rows = m.select(*keys, F.inline(F.concat(entries, probes)))
    of_range = F.max("best").over(W.partitionBy(*keys, "level", "place"))
    found = rows.withColumn("best", of_range).filter(F.col("day").isNotNull()).groupBy(*keys, "day").agg(F.max("best").alias("best"))
    follows = F.lead("day").over(W.partitionBy(*keys).orderBy("day"))  # a key has no more rows than there are days
    segs = found.withColumn("seg_end", F.coalesce(F.date_sub(follows, 1), F.lit(OPEN_END))).filter(F.col("best").isNotNull())
    return segs.select(*keys, F.col("day").alias("seg_start"), "seg_end", *[F.col(f"best.v.{v}").alias(v) for v in value_cols])


@dataclass(frozen=True)
class Segments:
    """Resolved segments of a map, with whether its size was checked to be broadcast. Build once, hand to every lookup."""

    rows: DataFrame
    small: bool


def build_segments(mapping: DataFrame, *args, **kwargs) -> Segments:
    """:func:`resolve_effective_segments` of a map whose size is looked at once.

    A map within the bound is resolved in one partition, which needs no shuffle at all.
    """
    small = fits(mapping)
    return Segments(resolve_effective_segments(mapping.coalesce(1) if small else mapping, *args, **kwargs), small)


def effective_lookup(facts: DataFrame, segments: DataFrame, fact_keys: Sequence[Column],
                     seg_keys: Sequence[str], date_col: str | Column,
                     value_cols: Sequence[str], small: bool = False) -> DataFrame:
    """Left-join each fact row to the segment covering its date (0 or 1 match).

    With ``small`` (the caller proved the map's size, and segments are at most
    twice the map rows) the segments are broadcast and the range condition is
    evaluated in the broadcast hash join; otherwise a sort-merge join on the
    equi keys (AQE may still broadcast from the measured size).
    """
    seg = segments.select(*[F.col(k).alias(f"__m_{k}") for k in seg_keys],
                          F.col("seg_start").alias("__m_s"), F.col("seg_end").alias("__m_e"),
                          *[F.col(v).alias(f"__m_{v}") for v in value_cols])
    if small:
        seg = F.broadcast(seg)
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    cond = [fk == F.col(f"__m_{sk}") for fk, sk in zip(fact_keys, seg_keys)]
    cond.append(d.between(F.col("__m_s"), F.col("__m_e")))
    joined = facts.join(seg, on=cond, how="left")
    out = joined
    for v in value_cols:
        out = out.withColumn(f"__lk_{v}", F.col(f"__m_{v}"))
    out = out.drop(*[c for c in seg.columns])
    for v in value_cols:
        out = out.withColumnRenamed(f"__lk_{v}", v)
    return out


#: Rules up to which matching is one CASE expression; beyond, names are joined to a gram index of the rules. Both rank alike.
RULE_CASE_MAX = 64
#: Length of the grams that keywords are indexed by.
GRAM = 3


def keyword_rank(rules: DataFrame, text: Column, order: Sequence[Column], value_col: str = "branch_id",
                 keyword_col: str = "match_keyword", active_col: str | None = "is_active"):
    """Best keyword rule for ``text`` as a projection, or ``None`` if too many rules.

    The (size-checked, at most ``RULE_CASE_MAX`` rows) active rules are ranked
    by ``order`` and compiled into one ``CASE WHEN instr(lower(text), kw) > 0``
    chain: the first rule that matches is the best one. Returns
    ``(rank_column, value_for_rank_function)``; rank is NULL when no rule
    matches. No join and no shuffle; the CASE stays in whole-stage codegen.
    """
    r = rules
    if active_col:
        r = r.filter(F.col(active_col) == F.lit(True))
    r = r.filter(F.col(keyword_col).isNotNull() & (F.col(keyword_col) != ""))
    if not fits(r, RULE_CASE_MAX):
        return None
    ranked_df = r.orderBy(*order).select(F.lower(F.col(keyword_col)).alias("kw"), F.col(value_col).alias("v"))
    ranked = ranked_df.collect()   # bounded: at most RULE_CASE_MAX rows (checked above)
    if not ranked:
        return F.lit(None).cast("int"), (lambda rank: F.lit(None).cast("string"))
    lt = F.lower(F.coalesce(text, F.lit("")))
    rank = None
    for i, row in enumerate(ranked, start=1):
        cond = F.instr(lt, F.lit(row["kw"])) > 0
        rank = F.when(cond, F.lit(i)) if rank is None else rank.when(cond, F.lit(i))
    values = F.array(*[F.lit(row["v"]) for row in ranked])
    return rank, (lambda rk: F.when(rk.isNotNull(), F.element_at(values, F.coalesce(rk, F.lit(1)))))


def keyword_rule_match(names: DataFrame, name_col: str, rules: DataFrame,
                       value_cols: Sequence[str] = ("branch_id",),
                       keyword_col: str = "match_keyword",
                       priority: Sequence[Column] | None = None,
                       active_col: str | None = "is_active") -> DataFrame:
    """Best rule per distinct name: ``lower(name)`` contains ``lower(keyword)``.

    Ranking is priority ascending (NULL first), longer keyword first, newest
    update, then rule id. The join runs on *distinct* names only, over a gram
    index: each keyword is filed under one of its 3-character grams, the one
    that fewest names contain (a shorter keyword under itself), each name looks
    up its own distinct grams by equality, and only the keywords met there are
    tested with ``contains``. A name has as many grams as characters, however
    many rules there are, and no name is compared with every rule.
    Returns ``name_col`` plus ``value_cols`` (names with no rule are absent).
    """
    r = rules
    if active_col:
        r = r.filter(F.col(active_col) == F.lit(True))
    r = r.filter(F.col(keyword_col).isNotNull() & (F.col(keyword_col) != ""))
    if priority is None:
        priority = [F.col("priority").isNull().alias("pn"), (-F.col("priority")).alias("p0"), F.length(keyword_col).alias("p1"),
                    F.col("updated_at").alias("p2"), (F.col("rule_id")).alias("p3")]
    packed = F.struct(*[F.col(v) for v in value_cols])
    # rules of one keyword: only the best can win
    r = r.groupBy(F.lower(F.col(keyword_col)).alias("__kw")).agg(F.max(F.struct(F.struct(*priority).alias("p"), packed.alias("v"))).alias("__b"))
    n = names.select(F.col(name_col)).distinct().withColumn("__lname", F.lower(F.coalesce(F.col(name_col), F.lit(""))))
    sizes = [x["n"] for x in r.select(F.least(F.length("__kw"), F.lit(GRAM)).alias("n")).distinct().collect()]  # at most GRAM values
    looked_up = F.array_distinct(F.flatten(F.array(*[grams(F.col("__lname"), size) for size in sorted(sizes)])) if sizes
                                 else F.array().cast("array<string>"))
    of_name = n.select(name_col, "__lname", F.explode(looked_up).alias("__g"))
    of_rule = r.select("__kw", F.explode(F.array_distinct(grams(F.col("__kw"), F.least(F.length("__kw"), F.lit(GRAM))))).alias("__g"))
    spread = of_name.groupBy("__g").agg(F.count(F.lit(1)).alias("__n"))
    filed = of_rule.join(spread, "__g").groupBy("__kw").agg(  # a keyword with a gram no name has is lost here only if it can't match
        F.min(F.struct("__n", "__g")).alias("__key")).select("__kw", F.col("__key.__g").alias("__g"))
    cand = of_name.join(filed.join(r, "__kw"), "__g").filter(F.contains(F.col("__lname"), F.col("__kw")))
    best = cand.groupBy(name_col).agg(F.max("__b").alias("__b"))
    return best.select(name_col, *[F.col(f"__b.v.{v}").alias(v) for v in value_cols])


def grams(text: Column, size: int | Column) -> Column:
    """All substrings of ``text`` with ``size`` characters, in place order; none if it is shorter."""
    size = F.lit(size) if isinstance(size, int) else size
    count = F.length(text) - size + 1
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.substring(text, i, size))).otherwise(
        F.array().cast("array<string>"))


def best_effective_lookup(facts: DataFrame, lookups, date_col: str | Column,
                          value_cols: Sequence[str], priority_cols: Sequence[str],
                          default: dict | None = None) -> DataFrame:
    """Resolve one value set per fact row from several effective-dated lookups.

    ``lookups`` is a list of ``(segments, fact_key_columns, segment_key_names)``
    (segments from :func:`build_segments`, carrying
    ``priority_cols`` among their value columns). Each lookup matches a fact
    row at most once; the match with the greatest priority wins and earlier
    lookups win ties. This expresses OR-joins and wildcard keys as equi-joins,
    each a broadcast (or shuffle) hash join, with no fact-side deduplication.
    """
    carried = list(value_cols) + [p for p in priority_cols if p not in value_cols]
    out = facts
    for i, (seg, fkeys, skeys) in enumerate(lookups):
        seg_i = seg.rows.select(*skeys, "seg_start", "seg_end", F.lit(True).alias(f"__l{i}_hit"),
                           *[F.col(v).alias(f"__l{i}_{v}") for v in carried])
        out = effective_lookup(out, seg_i, fkeys, list(skeys), date_col,
                               [f"__l{i}_hit"] + [f"__l{i}_{v}" for v in carried], seg.small)
    win = F.lit(None).cast("int")
    best = None
    for i in range(len(lookups)):
        hit = F.col(f"__l{i}_hit").isNotNull()
        pri = F.struct(*[F.col(f"__l{i}_{p}").alias(p) for p in priority_cols])
        cond = hit if best is None else hit & (best.isNull() | (pri > best))
        win = F.when(cond, F.lit(i)).otherwise(win)
        best = F.when(cond, pri) if best is None else F.when(cond, pri).otherwise(best)
    out = out.withColumn("__win", win)
    for v in carried:
        expr = F.lit(None)
        for i in range(len(lookups)):
            expr = F.when(F.col("__win") == i, F.col(f"__l{i}_{v}")).otherwise(expr)
        if default and v in default:
            expr = F.coalesce(expr, F.lit(default[v]))
        out = out.withColumn(v, expr)
    drop = ["__win"] + [f"__l{i}_{v}" for i in range(len(lookups)) for v in ["hit"] + carried]
    return out.drop(*drop)
