"""I-Match document fingerprints, in DataFrame operations only.

A term's document frequency is counted over the whole corpus. The lexicon keeps the terms whose inverse document
frequency lies in a band. 16 randomised lexicons come in levels: by a hash of term and subset, level l of a subset keeps one term in 2**l, and the
levels of a subset are nested. A document is printed at the level at which a subset keeps about one of its terms (``LOAD`` to twice as many), and at the next one: so
a replaced part of any text, short or long, changes some subsets and leaves others. Per subset, the distinct kept terms are sorted and hashed; the
fingerprint is the level and the hashes of both levels, 16 hex digits each (or dashes where no term is kept), joined by points. The likeness of two
fingerprints is the share of equal hashes among the subsets that kept a term in either, at the levels that both have; none in common is 0.

The lexicon's size is bounded at any corpus size: a term in it lies in at least the share ``MIN_SHARE`` of
documents, so there are at most (mean distinct terms of a document) / MIN_SHARE of them. It is broadcast only while that bound
holds in fact (``MAX_BROADCAST_TERMS``); otherwise Spark chooses the join.

Defined results: null text counts as empty. A text without any term of the lexicon is fingerprinted by the hash of the text
itself, so equal texts have equal fingerprints and others don't. Rows are ordered by doc_id (an integer; null last), then a hash of the text.
An empty table gives no rows; a single document is its own next. Further columns are not read.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import drop, shared_dir, stored, table

MIN_SHARE = 0.002
MAX_SHARE = 0.10
#: Subsets, at most 16; terms that a subset of the first level keeps on average, at least; the highest level.
SUBSETS, LOAD, MAX_LEVEL = 16, 0.75, 14
MAX_BROADCAST_TERMS = 2_000_000
NO_TERM = "-" * 16
#: Rows that an order range holds on average.
ROWS_A_RANGE = 2000
#: Cells that quantiles cut the order of ids into, at most; the ranges of a cell are equal parts of it, as many as its rows ask for.
MAX_CELLS = 4096
#: Numbers of rows that a range has room for in ``pos``.
RANGE_SPAN = 1 << 32


def exploded_terms(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without ``text``, a row per distinct lower-case word of it (letters and digits, two at least) with its hash ``t``; a row with null ``t`` for texts without words."""
    words = F.array_distinct(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"))
    each = df.withColumn("term", F.explode_outer(words)).drop(text)
    return each.withColumn("t", F.when(F.length("term") > 1, F.xxhash64("term"))).drop("term")


def lexicon(docs: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE, text: str = "text") -> DataFrame:
    """term hashes (``t``) whose document frequency is in the band; ``docs`` counts as all documents."""
    counted = exploded_terms(docs.select(F.col(text).alias("text"))).where(F.col("t").isNotNull()).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    n = docs.agg(F.count(F.lit(1)).alias("n"))
    # The one-row table of the count is the small side of this join.
    return counted.join(F.broadcast(n)).where((F.col("df") >= F.greatest(F.lit(2.0), F.col("n") * min_share)) & (F.col("df") <= F.greatest(F.lit(2.0), F.col("n") * max_share))).select("t")


def bounded(small: DataFrame, limit: int = MAX_BROADCAST_TERMS) -> DataFrame:
    return F.broadcast(small) if small.count() <= limit else small


def term_levels() -> Column:
    """For term ``t`` the highest level at which each subset keeps it, four bits a subset."""
    # The lowest bits of a hash that are zero, up to 15 of them: nested levels, each half of the one before.
    zeros = lambda h: sum((F.when(F.pmod(h, F.lit(1 << i)) == 0, F.lit(1)).otherwise(F.lit(0)) for i in range(1, 16)), F.lit(0))
    each = F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda k: F.call_function("shiftleft", once(F.xxhash64("t", k), zeros).cast("long"), 4 * k))
    return F.aggregate(each, F.lit(0).cast("long"), lambda acc, x: acc.bitwiseOR(x))


def top_level(levels: Column) -> Column:
    return F.array_max(F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda k: nibble(levels, k)))


def nibble(levels: Column, k: Column) -> Column:
    return F.call_function("shiftright", levels, 4 * k).bitwiseAND(F.lit(15)).cast("int")


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once a row, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def fingerprint(kept: Column, text_hash: Column) -> Column:
    """Of the sorted marks (t, levels, top) of the document's lexicon terms, or of the text's hash where there is none."""
    subsets = F.array(*(F.lit(k) for k in range(SUBSETS)))

    def one(marks: Column, level: Column, k: Column) -> Column:
        own = F.filter(marks, lambda m: nibble(m["levels"], k) >= level)
        return once(F.transform(own, lambda m: m["t"]), lambda o: F.when(F.size(o) > 0, F.lpad(F.lower(F.hex(F.xxhash64(o, k, level))), 16, "0")).otherwise(F.lit(NO_TERM)))

    def at(level: Column) -> Column:
        # Few terms reach the level in any subset: the subsets look at those alone.
        both = F.transform(F.array(level, level + 1), lambda l: once(F.filter(kept, lambda m: m["top"] >= l), lambda marks: F.transform(subsets, lambda k: one(marks, l, k))))
        return F.concat_ws(".", F.lower(F.hex(level)), F.array_join(F.flatten(both), "."))

    alone = F.concat(F.lit("x."), F.sha2(text_hash.cast("string"), 256))
    level = F.least(F.lit(MAX_LEVEL), F.floor(F.log2(F.size(kept) / LOAD))).cast("int")
    return F.when(F.size(kept) > 0, once(level, at)).otherwise(alone)


def likeness(a: Column, b: Column) -> Column:
    parts = lambda x, start: F.slice(x, start, SUBSETS)

    def alike(x: Column, y: Column) -> Column:
        pairs = F.filter(F.zip_with(x, y, lambda u, v: F.struct(u.alias("u"), v.alias("v"))), lambda p: (p["u"] != NO_TERM) | (p["v"] != NO_TERM))
        return once(pairs, lambda s: F.when(F.size(s) > 0, F.size(F.filter(s, lambda p: p["u"] == p["v"])) / F.size(s)).otherwise(0.0))

    def compared(both: Column) -> Column:
        x, y = both["x"], both["y"]
        apart = F.conv(y[0], 16, 10).cast("int") - F.conv(x[0], 16, 10).cast("int")
        first, second = 2, 2 + SUBSETS
        return (
            F.when(apart == 0, alike(F.slice(x, first, 2 * SUBSETS), F.slice(y, first, 2 * SUBSETS)))
            .when(apart == 1, alike(parts(x, second), parts(y, first)))
            .when(apart == -1, alike(parts(x, first), parts(y, second)))
            .otherwise(0.0)
        )

    split = once(F.struct(F.split(a, r"\.").alias("x"), F.split(b, r"\.").alias("y")), compared)
    return F.when(a == b, 1.0).when(a.startswith("x") | b.startswith("x"), 0.0).otherwise(split)


def fingerprints(texts: DataFrame, lex: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` (which must tell rows apart) and ``fingerprint`` of each row of ``texts``."""
    body = F.coalesce(F.col(text), F.lit(""))
    each = exploded_terms(texts.select(*keys, F.xxhash64(body).alias("text_hash"), body.alias("text")).withColumn("text", F.concat("text", F.lit(" ."))))
    marks = lex.withColumn("levels", term_levels()).select("t", F.struct("t", "levels", top_level(F.col("levels")).alias("top")).alias("mark"))
    # Every text ends in an empty word, whose null term the zero stands for: it finds a mark below all levels, so texts without lexicon terms stay.
    marks = marks.union(lex.sparkSession.range(1).select("id", F.struct(F.col("id").alias("t"), F.col("id").alias("levels"), F.lit(-1).alias("top"))))
    kept = each.withColumn("t", F.coalesce("t", F.lit(0))).join(bounded(marks), "t")
    gathered = kept.groupBy(*keys, "text_hash").agg(F.sort_array(F.filter(F.collect_list("mark"), lambda m: m["top"] >= 0)).alias("kept"))
    return gathered.select(*keys, fingerprint(F.col("kept"), F.col("text_hash")).alias("fingerprint"))


def cuts_upto(value: Column, cuts: list[int], block: int = 64) -> Column:
    """How many of the sorted ``cuts`` are at most ``value``: whole blocks of them first, then those of one block."""
    blocks = [cuts[i : i + block] for i in range(0, len(cuts), block)]
    passed = F.size(F.filter(F.array(*(F.lit(b[-1]) for b in blocks)), lambda c: c <= value))
    inner = F.try_element_at(F.array(*(F.array(*map(F.lit, b)) for b in blocks)), passed + 1)
    return passed * block + F.coalesce(F.when(passed < len(blocks), F.size(F.filter(inner, lambda c: c <= value))), F.lit(len(cuts) - len(blocks) * block))


def order_cells(docs: DataFrame) -> tuple[list[tuple[int, int, int]], int]:
    """(low, high, ranges) of cells of doc_id, from low on and below high, in order; and the ranges for null ids.

    Cells come from quantiles. An id that fills several of them is a cell of its own, so that the hash of the text can cut it.
    """
    n = docs.count()
    many = max(1, min(MAX_CELLS, n // ROWS_A_RANGE))
    at = ",".join(str(k / many) for k in range(1, many)) or "0.5"
    facts = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("doc_id").alias("some"), F.expr(f"percentile_approx(doc_id, array({at}), 10000)").alias("q")).first()
    ranges_of = lambda rows: max(1, -(-rows // ROWS_A_RANGE))
    nulls = ranges_of(n - facts.some)
    if not facts.some:
        return [], nulls
    a_cell = -(-facts.some // many)
    times = Counter(facts.q) if many > 1 else Counter()
    hot = {v for v, k in times.items() if k > 1}
    edges = sorted({facts.low, facts.high + 1, *(v for v in times if facts.low < v), *(v + 1 for v in hot)})
    return [(a, b, ranges_of(a_cell * times[a] if a in hot else a_cell)) for a, b in zip(edges, edges[1:], strict=False)], nulls


def in_ranges(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty), its hash, and ``range``, a number that grows along the order; about ``ROWS_A_RANGE`` rows share one."""
    cells, nulls = order_cells(docs)
    body = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", body.alias("text"), F.xxhash64(body).alias("text_hash"))
    by_hash = lambda many: F.least(F.floor((F.col("text_hash") / 2.0**64 + 0.5) * many), many - 1).cast("long")
    total = sum(k for *_, k in cells)
    of_nulls = total + by_hash(F.lit(nulls))
    if not cells:
        return rows.withColumn("range", of_nulls)
    bases, left = [], total
    for *_, k in cells:
        left -= k
        bases.append(left)
    # A row per cell, at most 2 * MAX_CELLS.
    table_ = docs.sparkSession.createDataFrame([(i, float(b), float(b - a), k, base, b - a == 1) for i, ((a, b, k), base) in enumerate(zip(cells, bases, strict=True))], "cell int, above double, width double, ranges long, base long, one boolean")
    cell = cuts_upto(F.col("doc_id"), [a for a, *_ in cells[1:]]) if len(cells) > 1 else F.lit(0)
    placed = rows.withColumn("at", F.when(F.col("doc_id").isNotNull(), cell)).join(F.broadcast(table_), F.col("at") == F.col("cell"), "left")
    by_id = F.least(F.greatest(F.floor((F.col("above") - 1 - F.col("doc_id")) / F.col("width") * F.col("ranges")), F.lit(0)), F.col("ranges") - 1).cast("long")
    known = F.col("base") + F.when(F.col("one"), by_hash(F.col("ranges"))).otherwise(by_id)
    return placed.select("doc_id", "text", "text_hash", F.when(F.col("doc_id").isNull(), of_nulls).otherwise(known).alias("range"))


def with_next(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """range, doc_id, text, pos and the text and pos of the next document in descending doc_id (after the last: the first).

    Ranges are ordered apart; the first row of each serves the last row of the range before.
    """
    ranged = in_ranges(docs)
    # The first row of a range has its largest id, then the least hash of a text.
    tops = ranged.groupBy(F.col("range").alias("t_range")).agg(F.max(F.struct("doc_id", F.bitwise_not("text_hash").alias("turned"))).alias("top"))
    tops = bounded(stored(tops.select("t_range", "top.doc_id", F.bitwise_not("top.turned").alias("top_hash")).withColumnRenamed("doc_id", "top_id"), "tops", folder))
    # Two numbers a range; beyond the limit of a broadcast Spark shuffles texts for this join.
    met = ranged.join(tops, (F.col("range") == F.col("t_range")) & F.col("doc_id").eqNullSafe(F.col("top_id")) & (F.col("text_hash") == F.col("top_hash")))
    heads = stored(met.groupBy("range").agg(F.min("text").alias("head_text")), "heads", folder)
    # The range that follows: within blocks of ranges, and from the last of a block to the first of the next that has any.
    block = F.shiftright("range", 12)
    firsts = heads.groupBy(block.alias("block")).agg(F.min("range").alias("first"))
    chain = W.orderBy("block")
    firsts = firsts.select(F.col("block").alias("b"), F.coalesce(F.lead("first").over(chain), F.min("first").over(W.partitionBy())).alias("then"))
    inner = F.lead("range").over(W.partitionBy("block").orderBy("range"))
    nexts = heads.select("range", block.alias("block")).withColumn("after", inner).join(firsts, F.col("block") == F.col("b")).select(F.col("range").alias("n_range"), F.coalesce("after", "then").alias("next_range"))
    follow = nexts.join(heads.withColumnRenamed("range", "h_range"), F.col("next_range") == F.col("h_range")).select("n_range", "head_text", (F.col("next_range") * RANGE_SPAN + 1).alias("head_pos"))
    order = W.partitionBy("range").orderBy(F.col("doc_id").desc_nulls_last(), "text_hash", "text")
    rows = ranged.select("range", "doc_id", "text", (F.col("range") * RANGE_SPAN + F.row_number().over(order)).alias("pos"), F.lead("text").over(order).alias("follower"))
    joined = rows.join(follow, F.col("range") == F.col("n_range"))
    return joined.select(
        "range", "doc_id", "text", "pos", F.coalesce("follower", "head_text").alias("next_text"),
        F.when(F.col("follower").isNull(), F.col("head_pos")).otherwise(F.col("pos") + 1).alias("next_pos"),
    )


def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = shared_dir(spark)
    lex = stored(lexicon(docs), "lexicon", folder)
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 3) as int))"), F.expr("substring(next_text, 1, cast(floor(length(text) / 3) as int))"))
    both = with_next(docs, folder).withColumn("edited", edited)
    facts = F.struct("doc_id", F.length("text").cast("long").alias("n_chars"), F.unhex(F.sha2(F.encode("edited", "UTF-8"), 256)).alias("edited_sha256"), "next_pos")
    # Rows lie by range from the order on, and range leads both groupings, so neither shuffles.
    each = both.select("range", "pos", facts.alias("facts"), F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("text")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))).alias("v"))
    prints = fingerprints(each.select("range", "pos", "facts", "v.which", "v.text"), lex, ["range", "pos", "facts", "which"])
    paired = prints.groupBy("range", "pos", "facts").agg(F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("fingerprint"), F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("edited_fingerprint"))
    paired = stored(paired, "prints", folder)
    drop(spark, folder, "lexicon", "tops", "heads")
    following = paired.select(F.col("pos").alias("f_pos"), F.col("fingerprint").alias("next_fingerprint"))
    done = paired.join(following, F.col("facts.next_pos") == F.col("f_pos"))
    return done.select(
        "facts.doc_id", "facts.n_chars", F.lower(F.hex("facts.edited_sha256")).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
