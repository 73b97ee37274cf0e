"""Feature specifications and their fusion: all features over one table, key and filter become one aggregate."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import lookup_left


@dataclass(frozen=True)
class FeatureSpec:
    """``expr`` is an aggregate over ``source`` per ``key`` (family ``agg``), a column of a lookup (``lookup``) or an expression over the ids' own columns (``own``)."""

    name: str
    family: str
    source: str
    key: str
    expr: str
    where: str = "true"


#: Lengths in days of the windows that end with the last day of a table, and of the half-life of what is weighed by age.
WINDOWS, HALF_LIFE = (30, 90), 30


def is_value(c: str, value: str) -> str:
    """SQL for 1 where the text column holds the value, 0 elsewhere, null for null."""
    quoted = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"cast(`{c}` = '{quoted}' as int)"


def value_names(prefix: str, values: list[str]) -> dict[str, str]:
    """value -> a feature name of its own."""
    out: dict[str, str] = {}
    for i, v in enumerate(values):
        name = f"{prefix}_{re.sub(r'[^0-9A-Za-z]+', '_', v)}"
        out[v] = f"{name}_{i}" if name in out.values() else name
    return out


#: Numbers of a table whose ratios are made, the first ones.
RATIO_COLUMNS = 6


def ratios(name: str, family: str, key: str, numbers: list[str]) -> list[FeatureSpec]:
    """The ratio of every two numbers: of their sums over a history, of the values themselves elsewhere; null where the second is zero."""
    total = (lambda c: f"sum(cast(`{c}` as double))") if family == "agg" else (lambda c: f"cast(`{c}` as double)")
    return [FeatureSpec(f"{name}_ratio_{x}_{y}", family, name, key, f"{total(x)} / nullif({total(y)}, 0D)") for x, y in combinations(numbers[:RATIO_COLUMNS], 2)]


def over_time(name: str, key: str, at: str, last: object, numbers: list[str]) -> list[FeatureSpec]:
    """How a history runs over the column ``at``: mean gap in days between its rows, days since its end, the slope of each number a day, and counts and sums in which a row
    weighs half as much for each HALF_LIFE of its age. All are mergeable sums in the table's one aggregate; none needs the rows in order.
    """
    day = f"unix_date(cast(`{at}` as date))"
    age = f"date_diff(date'{last}', cast(`{at}` as date))"
    weight = f"pow(0.5D, {age} / {HALF_LIFE}D)"
    out = [
        FeatureSpec(f"{name}_gap_{at}", "agg", name, key, f"(max({day}) - min({day})) / nullif(count(`{at}`) - 1, 0)"),
        FeatureSpec(f"{name}_recency_{at}", "agg", name, key, f"min({age})"),
        FeatureSpec(f"{name}_decayed_count_{at}", "agg", name, key, f"coalesce(sum({weight}), 0D)"),
    ]
    for x in numbers:
        out.append(FeatureSpec(f"{name}_slope_{x}_{at}", "agg", name, key, f"regr_slope(cast(`{x}` as double), cast({day} as double))"))
        out.append(FeatureSpec(f"{name}_decayed_{x}_{at}", "agg", name, key, f"coalesce(sum(cast(`{x}` as double) * {weight}), 0D)"))
    return out


def grammar(name: str, df: DataFrame, key: str, skip: tuple[str, ...] = (), values: Mapping[str, list[str]] = {}, last: Mapping[str, object] = {}) -> list[FeatureSpec]:
    """The aggregate family for a history table: count, and by type sums, means, spread, ends, distinct values; days since 1970 for dates, shares for booleans.

    ``values`` (``profile.common_values``) adds the share of each value of a text column, ``last`` (``profile.last_days``) counts, sums and shares
    of the windows that end with a column's last day, and what ``over_time`` says. All stay in one aggregate; distinct values are estimates, which need no row per column.
    """
    numbers = [c for c, kind in df.dtypes if c != key and c not in skip and (kind in ("double", "float") or kind.startswith("decimal"))]
    out = [FeatureSpec(f"{name}_count", "agg", name, key, "count(1)")]
    for c, kind in df.dtypes:
        if c == key or c in skip:
            continue
        if kind in ("double", "float") or kind.startswith("decimal"):
            out += [FeatureSpec(f"{name}_{f}_{c}", "agg", name, key, f"{f}(`{c}`)") for f in ("sum", "avg", "min", "max", "stddev_pop")]
        elif kind == "boolean":
            out += [FeatureSpec(f"{name}_{f}_{c}", "agg", name, key, f"{f}(cast(`{c}` as int))") for f in ("sum", "avg")]
        elif kind == "date" or kind.startswith("timestamp"):
            out += [FeatureSpec(f"{name}_{f}_{c}", "agg", name, key, f"{f}(unix_date(cast(`{c}` as date)))") for f in ("min", "max", "stddev_pop")]
        elif kind in ("int", "bigint"):
            out += [FeatureSpec(f"{name}_{f}_{c}", "agg", name, key, f"{f}(cast(`{c}` as double))") for f in ("sum", "avg", "min", "max", "stddev_pop")]
        if kind in ("string", "int", "bigint", "date"):
            out.append(FeatureSpec(f"{name}_distinct_{c}", "agg", name, key, f"approx_count_distinct(`{c}`)"))
        out += [FeatureSpec(n, "agg", name, key, f"avg({is_value(c, v)})") for v, n in value_names(f"{name}_share_{c}", values.get(c, [])).items()]
        if c in last:
            for days in WINDOWS:
                within = f"cast(`{c}` as date) > date_sub(date'{last[c]}', {days})"
                out.append(FeatureSpec(f"{name}_count_{days}d_{c}", "agg", name, key, f"count_if({within})"))
                out.append(FeatureSpec(f"{name}_share_{days}d_{c}", "agg", name, key, f"count_if({within}) / count(1)"))
                out += [FeatureSpec(f"{name}_sum_{x}_{days}d_{c}", "agg", name, key, f"coalesce(sum(`{x}`) filter (where {within}), 0)") for x in numbers]
            out += over_time(name, key, c, last[c], numbers)
    return out + ratios(name, "agg", key, numbers)


def column_specs(name: str, family: str, df: DataFrame, key: str, skip: tuple[str, ...] = (), values: Mapping[str, list[str]] = {}) -> list[FeatureSpec]:
    """Columns of a lookup, or of the ids themselves: numbers as they are, booleans as 0 and 1, dates as days since 1970, text as one 0/1 column per common value."""
    out = []
    for c, kind in df.dtypes:
        if c == key or c in skip:
            continue
        if kind in ("int", "bigint", "double", "float") or kind.startswith("decimal"):
            out.append(FeatureSpec(f"{name}_{c}", family, name, key, f"`{c}`"))
        elif kind == "boolean":
            out.append(FeatureSpec(f"{name}_{c}", family, name, key, f"cast(`{c}` as int)"))
        elif kind == "date" or kind.startswith("timestamp"):
            out.append(FeatureSpec(f"{name}_{c}", family, name, key, f"unix_date(cast(`{c}` as date))"))
        else:
            out += [FeatureSpec(n, family, name, key, is_value(c, v)) for v, n in value_names(f"{name}_{c}", values.get(c, [])).items()]
    return out + ratios(name, family, key, [c for c, kind in df.dtypes if c != key and c not in skip and (kind in ("double", "float") or kind.startswith("decimal"))])


def compile_features(ids: DataFrame, id_col: str, tables: dict[str, DataFrame], specs: list[FeatureSpec]) -> DataFrame:
    """``ids`` with a column per spec: one aggregate per (table, key, filter) and one check and join per (lookup, key); every id stays once."""
    out = ids
    groups: dict[tuple[str, str, str], list[FeatureSpec]] = {}
    for s in specs:
        if s.family == "agg":
            groups.setdefault((s.source, s.key, s.where), []).append(s)
    for (source, key, where), some in groups.items():
        made = tables[source].where(where).groupBy(F.col(f"`{key}`").alias(id_col)).agg(*(F.expr(s.expr).alias(s.name) for s in some))
        out = lookup_left(out, made, [id_col])
    lookups: dict[tuple[str, str], list[FeatureSpec]] = {}
    for s in specs:
        if s.family == "lookup":
            lookups.setdefault((s.source, s.key), []).append(s)
    for (source, key), some in lookups.items():
        right = tables[source].select(F.col(f"`{key}`"), *(F.expr(s.expr).alias(s.name) for s in some))
        out = lookup_left(out, right, [key], unique=True)
    own = {s.name: F.expr(s.expr) for s in specs if s.family == "own"}
    return out.withColumns(own) if own else out


def recency(at: Column, until: Column) -> Column:
    return F.date_diff(until.cast("date"), at.cast("date"))
