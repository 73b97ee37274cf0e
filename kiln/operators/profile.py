"""Facts about tables: columns, keys, inclusions and fan-out, and the joins that follow from them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column_profile(df: DataFrame) -> DataFrame:
    """A row per column: rows, nulls, distinct values, least and largest as text. All in one aggregate, then turned."""
    aggs = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        aggs.append(F.struct(F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("n_rows"), F.count_if(col.isNull()).alias("n_null"), F.count_distinct(col).alias("n_distinct"), F.min(col).cast("string").alias("min_value"), F.max(col).cast("string").alias("max_value")))
    return df.agg(F.array(*aggs).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def key_check(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: rows, distinct keys, null keys, and whether the key identifies rows. Grouping, not a set in memory, finds repeats."""
    null = F.greatest(*(F.col(c).isNull().cast("int") for c in key)) if len(key) > 1 else F.col(key[0]).isNull().cast("int")
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.max(null).alias("null"))
    facts = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_keys"), F.coalesce(F.sum(F.when(F.col("null") == 1, F.col("n"))), F.lit(0)).alias("n_null"))
    return facts.select(F.lit(",".join(key)).alias("key"), "n_rows", "n_keys", "n_null", ((F.col("n_rows") == F.col("n_keys")) & (F.col("n_null") == 0)).alias("is_key"))


def inclusion(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row: child rows with a key, and those whose key the parent lacks."""
    keyed = child.where(F.col(child_key).isNotNull()).select(F.col(child_key).alias("k"))
    known = parent.select(F.col(parent_key).alias("p")).distinct().withColumn("hit", F.lit(1))
    return keyed.join(known, F.col("k") == F.col("p"), "left").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("hit").isNull()).alias("n_orphans"))


def fan_out(child: DataFrame, key: str) -> DataFrame:
    """One row: keys, mean and largest number of rows of a key."""
    counts = child.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.count(F.lit(1)).alias("n_keys"), F.avg("n").alias("mean_rows"), F.max("n").alias("max_rows"))


def common_values(df: DataFrame, most: int = 12) -> dict[str, list[str]]:
    """The values of each text column that has at most about ``most`` of them, in order. Sizes come first, so no long list is gathered."""
    text = [c for c, kind in df.dtypes if kind == "string"]
    if not text:
        return {}
    sizes = df.agg(*(F.approx_count_distinct(F.col(f"`{c}`")).alias(c) for c in text)).first()
    short = [c for c in text if 1 < sizes[c] <= most]
    return df.agg(*(F.sort_array(F.collect_set(F.col(f"`{c}`"))).alias(c) for c in short)).first().asDict() if short else {}


def last_days(df: DataFrame) -> dict[str, object]:
    """The last day in each date or timestamp column that has one."""
    days = [c for c, kind in df.dtypes if kind == "date" or kind.startswith("timestamp")]
    return {c: d for c, d in df.agg(*(F.max(F.col(f"`{c}`").cast("date")).alias(c) for c in days)).first().asDict().items() if d} if days else {}


#: Values that a sketch keeps are 2**SKETCH_BITS at most (8 bytes each); what it says of distinct values is within SLACK but for one case in some hundred thousand.
SKETCH_BITS, SLACK = 12, 0.08
#: Types whose columns can be keys.
KEY_TYPES = ("int", "bigint", "string", "date")
#: Text that is longer in some row is prose, not a key.
KEY_CHARS = 200
#: Columns of a key, at most; columns of a table that are tried in combination.
MAX_KEY, MAX_KEY_COLUMNS = 2, 24

Names = tuple[str, ...]


@dataclass(frozen=True)
class Sketch:
    """Facts about a column or a combination of columns: rows, rows without nulls, estimated distinct values, longest value, and a theta sketch."""

    n_rows: int
    n_some: int
    n_distinct: float
    longest: int
    theta: bytes

    @property
    def may_be_key(self) -> bool:
        return self.n_rows > 0 and self.n_some == self.n_rows and self.longest <= KEY_CHARS and self.n_distinct >= (1 - SLACK) * self.n_rows


def key_value(columns: Iterable[str], kinds: Mapping[str, str]) -> Column:
    """Columns as one value that is equal in another table for equal columns there; null if one is null. Whole numbers of any width are alike."""
    parts = [F.col(f"`{c}`").cast("bigint" if kinds[c] in ("int", "bigint", "smallint", "tinyint") else "string") for c in columns]
    if len(parts) == 1:
        return parts[0]
    text = [F.concat(F.length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")) for p in parts]
    return F.concat(*text)


def sketches(df: DataFrame, keys: list[Names]) -> dict[Names, Sketch]:
    """A sketch of each column or combination, all in one aggregate over the table; sketches merge before the shuffle and have a fixed size."""
    if not keys:
        return {}
    kinds = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, key in enumerate(keys):
        value = key_value(key, kinds)
        aggs += [F.count(value).alias(f"s{i}"), F.max(F.length(value.cast("string"))).alias(f"l{i}"), F.theta_sketch_agg(value, SKETCH_BITS).alias(f"t{i}")]
    made = df.agg(*aggs).withColumns({f"d{i}": F.theta_sketch_estimate(f"t{i}") for i in range(len(keys))}).first()
    return {k: Sketch(made["n"], made[f"s{i}"], float(made[f"d{i}"] or 0), made[f"l{i}"] or 0, bytes(made[f"t{i}"])) for i, k in enumerate(keys)}


def sketch_table(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, column_name, n_rows, n_some, n_distinct (estimated) of all columns that could be keys: one job a table."""
    rows = []
    for name, df in tables.items():
        made = sketches(df, [(c,) for c, kind in df.dtypes if kind in KEY_TYPES])
        rows += [(name, c, s.n_rows, s.n_some, s.n_distinct) for (c,), s in made.items()]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "table_name string, column_name string, n_rows long, n_some long, n_distinct double")  # a row a column


def _checked_keys(tables: dict[str, DataFrame], asked: list[tuple[str, Names]]) -> list[tuple[str, Names]]:
    """Those that identify rows, by exact counts, all in one job."""
    if not asked:
        return []
    each = [key_check(tables[t].select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(key))), [f"k{i}" for i in range(len(key))]).select(F.lit(n).alias("n"), "is_key") for n, (t, key) in enumerate(asked)]
    good = {r.n for r in reduce(DataFrame.union, each).collect() if r.is_key}  # a row a candidate
    return [x for n, x in enumerate(asked) if n in good]


def find_keys(tables: dict[str, DataFrame], max_width: int = MAX_KEY) -> tuple[dict[str, list[Names]], dict[tuple[str, Names], Sketch]]:
    """The minimal keys of each table, of at most ``max_width`` columns, and the sketches that were made on the way.

    Level by level: what contains a key is left out, then what by its parts or its sketch can't have a value for each row; the others are counted.
    Only columns without nulls take part, at most MAX_KEY_COLUMNS of a table beyond single ones (those with the most values).
    """
    keys: dict[str, list[Names]] = {t: [] for t in tables}
    seen: dict[tuple[str, Names], Sketch] = {}
    for width in range(1, max_width + 1):
        asked: list[tuple[str, Names]] = []
        for t, df in tables.items():
            columns = [c for c, kind in df.dtypes if kind in KEY_TYPES]
            if width == 1:
                tried = [(c,) for c in columns]
            else:
                some = [c for c in columns if (s := seen[t, (c,)]).n_some == s.n_rows and s.longest <= KEY_CHARS and s.n_distinct > 1.5]
                some = sorted(sorted(some, key=lambda c, t=t: -seen[t, (c,)].n_distinct)[:MAX_KEY_COLUMNS], key=columns.index)
                tried = [k for k in combinations(some, width) if not any(set(x) <= set(k) for x in keys[t]) and _room(t, k, seen)]
            made = sketches(df, tried)
            seen |= {(t, k): s for k, s in made.items()}
            asked += [(t, k) for k, s in made.items() if s.may_be_key]
        for t, k in _checked_keys(tables, asked):
            keys[t].append(k)
    return keys, seen


def _room(table: str, key: Names, seen: dict[tuple[str, Names], Sketch]) -> bool:
    """False where even all combinations of the columns' values are fewer than the rows."""
    n, most = 0, 1.0
    for c in key:
        s = seen[table, (c,)]
        n, most = s.n_rows, most * s.n_distinct * (1 + SLACK)
    return most >= n


Link = tuple[str, str | Names, str, str | Names]


def join_graph(tables: dict[str, DataFrame], least_share: float = 1.0, hints: set[tuple[str, str, str, str]] = frozenset(), max_width: int = MAX_KEY) -> list[Link]:
    """(child, child column, parent, parent key) for columns of one type whose values a parent's key holds; tuples of columns where the key has several.

    Names must share their end after the first underscore (``o_custkey``, ``c_custkey``) or be equal, since dense integers include one another by chance.
    ``hints`` are such tuples that a description names; their names may differ, their values are checked all the same.
    Sketches of all columns, one job a table, leave few candidates: a value kept by the child's sketch that the parent's would have kept too, but
    hasn't, proves a value without partner. What remains is counted, all keys of a level in one job and all inclusions in one.
    """
    tail = lambda c: c.partition("_")[2] or c
    number = lambda kind: kind in ("int", "bigint")
    kinds = {t: dict(df.dtypes) for t, df in tables.items()}
    keys, seen = find_keys(tables, max_width)
    alike = lambda t, c, p, k: number(kinds[t][c]) == number(kinds[p][k]) and (kinds[t][c] == kinds[p][k] or number(kinds[t][c]))
    tried: list[tuple[str, Names, str, Names]] = []
    for t, df in tables.items():
        for parent, some in keys.items():
            for key in some if parent != t else ():
                for child in _matches(df, key, lambda c, k, t=t, p=parent: alike(t, c, p, k) and (tail(c) == tail(k) or (len(key) == 1 and (t, c, p, k) in hints))):  # noqa: B023
                    tried.append((t, child, parent, key))
    wanted: dict[str, list[Names]] = {}
    for t, child, _, _ in tried:
        if (t, child) not in seen:
            wanted.setdefault(t, []).append(child)
    for t, some in wanted.items():
        seen |= {(t, k): s for k, s in sketches(tables[t], list(dict.fromkeys(some))).items()}
    tried = _not_refuted(tables, tried, seen, least_share)
    each = []
    for n, (t, child, parent, key) in enumerate(tried):
        a, b = tables[t].select(key_value(child, kinds[t]).alias("c")), tables[parent].select(key_value(key, kinds[parent]).alias("k"))
        each.append(inclusion(a, "c", b, "k").withColumn("n", F.lit(n)))
    counts = {r.n: r for r in reduce(DataFrame.union, each).collect()} if each else {}  # a row a candidate
    found = [x for n, x in enumerate(tried) if counts[n].n_rows and 1 - counts[n].n_orphans / counts[n].n_rows >= least_share]
    one = lambda names: names[0] if len(names) == 1 else names
    return [(t, one(c), p, one(k)) for t, c, p, k in found]


def _matches(df: DataFrame, key: Names, fits) -> list[Names]:
    """Every choice of different columns of ``df``, one for each of ``key`` that it fits."""
    found: list[Names] = [()]
    for k in key:
        found = [(*some, c) for some in found for c, kind in df.dtypes if kind in KEY_TYPES and c not in some and fits(c, k)]
    return found


def _not_refuted(tables: dict[str, DataFrame], tried: list[tuple[str, Names, str, Names]], seen: dict[tuple[str, Names], Sketch], least_share: float) -> list[tuple[str, Names, str, Names]]:
    """Links whose sketches leave room for the share of values that must be held: of whole inclusion, one kept value without partner is disproof."""
    if not tried:
        return []
    spark = next(iter(tables.values())).sparkSession
    rows = [(n, seen[t, c].theta, seen[p, k].theta) for n, (t, c, p, k) in enumerate(tried)]  # sketches of fixed size, two a candidate
    made = spark.createDataFrame(rows, "n int, a binary, b binary").select("n", F.theta_sketch_estimate(F.theta_difference("a", "b")).alias("alone"), F.theta_sketch_estimate("a").alias("all"))
    # Shares are of rows and sketches know values, so a share below 1 refutes nothing but a child without any common value.
    left = {r.n for r in made.collect() if (r.alone == 0 if least_share >= 1 else r.alone < r.all or r.all == 0)}
    return [x for n, x in enumerate(tried) if n in left]
