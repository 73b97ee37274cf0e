"""Secret scans by corpus-wide ownership frequency, in DataFrame operations only.

Base patterns find assignments, access keys and hex runs. Beside them, opaque tokens (long, mixed letters and digits)
are candidates. Every distinct value is hashed and counted over the corpus by owners, repositories and unlike texts, with
the counts combined before each shuffle. Copies of a text are one holder, so a document that was copied to a second source
makes no second owner: where one owner holds every class of copies with the value, the value has one owner. Otherwise each
class counts for its least owner. Repositories likewise. A value is an example where any of the three counts is above its
limit; one that few hold and that looks random is live-looking. Opaque tokens become spans only where their value is
live-looking; base spans always stay. Every span carries its verdict and counts.

Copies are equal texts, and texts whose sketches (``SKETCH`` least hashes of word shingles) agree in at least ``ALIKE``, an
estimate of their Jaccard similarity. Texts with an equal band of the sketch are compared with two of them, never in pairs.

Defined results: null text counts as empty; null owner or repository counts as one more owner or repository; equal rows get
equal results; an empty table gives no rows; input columns travel in one struct, so only the added names may not clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import check_names
from .common import NON_WORD, drop, shared_dir, stored, table
from .components import components
from .spans import no_spans, regex_spans, span_text

ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
#: The same matches as HEX with 24 characters or more: greedy runs that are shorter can't hold longer ones.
LONG_HEX = "[0-9a-f]{24,}"
OPAQUE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+(?![A-Za-z0-9+/_=-])"
KINDS = ("assign", "access", "hex", "opaque")
#: A value of at most so many owners may be live.
LIVE_OWNERS = 1
#: Of at most so many repositories, and in at most so many unlike texts.
LIVE_REPOS, LIVE_TEXTS = 3, 10
#: Words of a shingle, hashes of a sketch, hashes of a band, share of equal hashes from which on texts are copies.
SHINGLE, SKETCH, BAND, ALIKE = 5, 64, 4, 0.7


def base_spans(text: Column) -> Column:
    assign = F.filter(regex_spans(text, ASSIGN, 0, "assign", 1), lambda s: F.length(s["value"]) >= 6)
    access = F.filter(regex_spans(text, ACCESS, 1, "access"), lambda s: F.length(s["value"]) >= 20)
    return F.when(text.rlike(ASSIGN), assign).otherwise(no_spans()), F.when(text.contains("AKIA"), access).otherwise(no_spans()), F.when(text.rlike(LONG_HEX), regex_spans(text, LONG_HEX, 2, "hex")).otherwise(no_spans())


def looks_random(value: Column) -> Column:
    """Letters of both cases and digits, or at least eight digits between letters; at least ten distinct characters."""
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    mixed = value.rlike("[A-Za-z]") & (digits >= 3)
    return mixed & (F.size(F.array_distinct(F.split(value, ""))) >= 10)


def apart(span: Column, others: Column) -> Column:
    return ~F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def sketch(text: Column) -> Column:
    """The least hash of the text's shingles for each of ``SKETCH`` seeds; a text shorter than a shingle is one shingle."""
    words = F.filter(F.split(text, f"{NON_WORD}+"), lambda w: w != "")
    cut = lambda w: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w) - SHINGLE + 1)), lambda i: F.xxhash64(F.slice(w, i, SHINGLE))))
    # One array for all elements and seeds: a value bound by a lambda is made once, an expression within one each time.
    least = lambda h: F.transform(F.sequence(F.lit(1), F.lit(SKETCH)), lambda j: F.array_min(F.transform(h, lambda x: F.xxhash64(x, j))))
    return F.transform(F.transform(F.array(words), cut), least)[0]


def copies(texts: DataFrame) -> DataFrame | None:
    """(node, root) for those of ``texts(text, sketch)`` that are near copies of others; None where no two are.

    Members of a band meet its first and last text in an order of the band's own, so a pair that meets unlike hubs in one band meets others in the next.
    """
    bands = F.transform(F.sequence(F.lit(0), F.lit(SKETCH // BAND - 1)), lambda b: F.xxhash64(b, F.slice("sketch", b * BAND + 1, BAND)))
    entries = texts.select("text", "sketch", F.explode(bands).alias("band"))
    ends = F.struct(F.xxhash64("text", "band"), "text", "sketch")
    hubs = entries.groupBy("band").agg(F.array(F.min(ends), F.max(ends)).alias("hubs"), F.count(F.lit(1)).alias("n")).where("n > 1")
    like = lambda hub: (F.col("text") != hub["text"]) & (F.size(F.filter(F.zip_with("sketch", hub["sketch"], lambda a, b: a == b), lambda same: same)) >= ALIKE * SKETCH)
    met = entries.join(hubs, "band").select(F.col("text").alias("a"), F.explode(F.transform(F.filter("hubs", like), lambda hub: hub["text"])).alias("b"))
    folder = shared_dir(texts.sparkSession)
    links = stored(met.distinct(), "links", folder)
    roots = None if links.isEmpty() else components(links, folder, "copies")
    drop(texts.sparkSession, folder, "links")
    return roots


def holders(values: DataFrame, who: str, name: str) -> DataFrame:
    """hash, ``name`` and texts: how many of ``who`` hold a value when a class of copies counts once, and how many classes there are."""
    held = values.select("hash", "text", who).distinct()
    most = held.groupBy("hash", who).agg(F.count(F.lit(1)).alias("n")).groupBy("hash").agg(F.max("n").alias("most"))
    homes = held.groupBy("hash", "text").agg(F.min(who).alias("home")).groupBy("hash", "home").agg(F.count(F.lit(1)).alias("n"))
    homes = homes.groupBy("hash").agg(F.count(F.lit(1)).alias("homes"), F.sum("n").alias("texts"))
    return most.join(homes, "hash").select("hash", F.when(F.col("most") == F.col("texts"), 1).otherwise(F.col("homes")).cast("long").alias(name), "texts")


def scan(docs: DataFrame, text: str = "text", owner: str = "source", repository: str = "source") -> DataFrame:
    """A row per row of ``docs`` (its columns but ``text``) with ``secret_base`` and ``secret_spans`` (arrays of spans, the latter with ``live``, ``owners``, ``repos`` and ``texts``), ``n_live`` and ``n_example`` (of all spans, values held by few or by many). Columns with one of the four names raise ValueError."""
    names = [c for c in docs.columns if c != text]
    check_names(docs, names, ["secret_base", "secret_spans", "n_live", "n_example"])
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.struct(F.col(f"`{owner}`").alias("o")).alias("owner"), F.struct(F.col(f"`{repository}`").alias("r")).alias("repo"), body.alias("body"))
    assign, access, hexes = base_spans(F.col("body"))
    opaque = F.when(F.col("body").rlike(OPAQUE), F.filter(regex_spans(F.col("body"), OPAQUE, 3, "opaque"), lambda s: looks_random(s["value"]))).otherwise(no_spans())
    found = rows.select("row", "owner", "repo", "body", F.concat(assign, access, hexes).alias("base"), opaque.alias("opaque"))
    some = (F.size("base") > 0) | (F.size("opaque") > 0)
    found = found.select("row", "owner", "repo", "base", F.when(some, F.xxhash64("body")).alias("text"), F.when(some, sketch(F.col("body"))).alias("sketch"), F.filter("opaque", lambda s: apart(s, F.col("base"))).alias("opaque"), F.monotonically_increasing_id().alias("rid"))
    found = stored(found, "found")  # rid is fixed from here on
    held = found.where((F.size("base") > 0) | (F.size("opaque") > 0))
    values = held.select("rid", "owner", "repo", "text", F.explode(F.concat("base", "opaque")).alias("span")).withColumn("hash", F.sha2(F.col("span.value"), 256))
    # Only texts with a value that other texts hold too are asked for copies.
    shared = values.select("hash", "text").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    asked = values.join(shared, "hash", "left_semi").select("text").distinct()
    roots = copies(held.select("text", "sketch").dropDuplicates(["text"]).join(asked, "text", "left_semi"))
    # Distinct holders first, so a value in any number of rows reaches the final count once a holder.
    holding = values.select("hash", "text", "owner", "repo").distinct()
    if roots is not None:
        holding = holding.join(roots, F.col("text") == F.col("node"), "left").select("hash", F.coalesce("root", "text").alias("text"), "owner", "repo")
    few = (F.col("owners") <= LIVE_OWNERS) & (F.col("repos") <= LIVE_REPOS) & (F.col("texts") <= LIVE_TEXTS)
    spread = holders(holding, "owner", "owners").join(holders(holding, "repo", "repos").drop("texts"), "hash").withColumn("few", few)
    judged = values.drop("text").join(spread, "hash")
    live = F.col("few") & looks_random(F.col("span.value"))
    marked = F.struct("span.*", live.alias("live"), "owners", "repos", "texts")
    per_row = judged.groupBy("rid").agg(
        F.collect_list(F.when((F.col("span.kind") != "opaque") | live, marked)).alias("spans"),
        F.count_if((F.col("span.kind") != "opaque") & live | (F.col("span.kind") == "opaque") & live).alias("n_live"),
        F.count_if(~F.col("few")).alias("n_example"),
    )
    joined = found.join(per_row, "rid", "left")
    return joined.select(
        *(F.col("row").getField(c).alias(c) for c in names),
        F.col("base").alias("secret_base"), F.coalesce("spans", F.array().cast(per_row.schema["spans"].dataType)).alias("secret_spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_example", F.lit(0)).alias("n_example"),
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", F.concat_ws("/", "source", "lang").alias("repository"))
    found = scan(docs, repository="repository")
    count = lambda kind: F.size(F.filter("secret_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS[:3]), F.sha2(span_text(F.col("secret_base")), 256).alias("base_sha256"), span_text(F.col("secret_spans")).alias("spans"), "n_live", "n_example")
