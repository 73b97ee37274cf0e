"""Queries over the given tables, one per operator of the engine; ``oracles`` has the SQL for each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import encoders, metrics
from ..functions.columns import fill_missing, noise, order_hash
from ..operators import evaluate, joins, profile, select
from ..operators.features import FeatureSpec, compile_features, grammar, over_time, recency
from ..operators.ordered import running_before


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def r6(c, name: str):
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name)


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """Labels with their documents: n_words, n_chars, lang, and the split of ids by five."""
    docs = t(spark, d, "documents").select("doc_id", "lang", "source", "n_chars", (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).cast("long").alias("n_words"))
    split = (F.col("doc_id") % 5 == 0).cast("int").alias("is_test")
    return t(spark, d, "labels").join(docs, "doc_id").select("doc_id", "quality", "toxic", "lang", "source", "n_chars", "n_words", split)


def customer_features(spark: SparkSession, d: str) -> DataFrame:
    ids = t(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey", "c_acctbal", (F.col("c_mktsegment") == "BUILDING").cast("int").alias("target"))
    tables = {"orders": t(spark, d, "orders"), "nation": t(spark, d, "nation")}
    specs = [
        FeatureSpec("n_orders", "agg", "orders", "o_custkey", "count(1)"),
        FeatureSpec("total", "agg", "orders", "o_custkey", "sum(o_totalprice)"),
        FeatureSpec("mean_price", "agg", "orders", "o_custkey", "avg(o_totalprice)"),
        FeatureSpec("share_f", "agg", "orders", "o_custkey", "avg(cast(o_orderstatus = 'F' as int))"),
    ]
    return compile_features(ids, "id", tables, specs)


FEATURES = ["n_orders", "total", "mean_price", "share_f", "c_acctbal"]


def flagship_feature_auc(spark, d):
    scores = select.feature_scores(customer_features(spark, d), FEATURES, "target")
    return scores.select("feature", r6("auc", "auc"), r6(metrics.gini(F.col("auc")), "gini"))


def scan_profile(spark, d):
    return profile.column_profile(t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))


def key_candidates(spark, d):
    checks = [("orders", ["o_orderkey"]), ("lineitem", ["l_orderkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]), ("conversations", ["conv_id", "turn"]), ("customer", ["c_custkey"])]
    out = None
    for name, key in checks:
        one = profile.key_check(t(spark, d, name).select(*key), key).withColumn("table_name", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


FKS = [("nation", "n_regionkey", "region", "r_regionkey"), ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"), ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("labels", "doc_id", "documents", "doc_id"), ("events", "user_id", "customer", "c_custkey")]


def fk_inclusion(spark, d):
    out = None
    for child, ck, parent, pk in FKS:
        one = profile.inclusion(t(spark, d, child), ck, t(spark, d, parent), pk).select(F.lit(f"{child}.{ck}").alias("child"), F.lit(f"{parent}.{pk}").alias("parent"), "n_rows", "n_orphans")
        out = one if out is None else out.unionByName(one)
    return out


def fk_fanout(spark, d):
    a = profile.fan_out(t(spark, d, "orders"), "o_custkey").withColumn("edge", F.lit("orders.o_custkey"))
    b = profile.fan_out(t(spark, d, "lineitem"), "l_orderkey").withColumn("edge", F.lit("lineitem.l_orderkey"))
    return a.unionByName(b).select("edge", "n_keys", r6("mean_rows", "mean_rows"), "max_rows")


def holdout_split(spark, d):
    return t(spark, d, "labels").select("doc_id", "quality", (F.col("doc_id") % 5 == 0).cast("int").alias("is_test"))


def stratified_folds(spark, d):
    return metrics.stratified_folds(t(spark, d, "labels").select("doc_id", "quality"), "doc_id", "quality", 5)


def class_weights(spark, d):
    return metrics.class_weights(t(spark, d, "labels"), "quality").select("quality", "n", r6("weight", "weight"))


def lookup_left(spark, d):
    return joins.lookup_left(t(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")), t(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), ["c_custkey"])


def lookup_nullsafe(spark, d):
    orders = t(spark, d, "orders")
    left = orders.select("o_orderkey", F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey") % 50).alias("k"))
    right = orders.groupBy(F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey") % 50).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return joins.lookup_left(left, right, ["k"])


def label_join_1to1(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "lang")
    return joins.lookup_left(docs, t(spark, d, "labels").select("doc_id", "quality"), ["doc_id"], unique=True).withColumn("unmatched", F.col("quality").isNull())


def ids_without_history(spark, d):
    return t(spark, d, "customer").select("c_custkey").join(t(spark, d, "events").select(F.col("user_id").alias("c_custkey")), "c_custkey", "left_anti")


def ids_with_history(spark, d):
    return t(spark, d, "customer").select("c_custkey").join(t(spark, d, "events").select(F.col("user_id").alias("c_custkey")), "c_custkey", "left_semi")


def asof_last_event(spark, d):
    events = t(spark, d, "events").select("event_id", "user_id", "ts", "value", "event_type")
    buys = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return joins.asof_last(buys, events.where("event_type = 'click'").select("user_id", "ts", "event_id", "value").withColumnRenamed("event_id", "click_id"), ["user_id"], "ts", ["click_id", "value"]).select("event_id", "user_id", "last_click_id", "last_value")


def range_bin_join(spark, d):
    bins = spark.createDataFrame([("small", 0, 10), ("middle", 10, 30), ("large", 30, 1000)], "bin string, low int, high int")
    return joins.range_lookup(t(spark, d, "part").select("p_partkey", "p_size"), "p_size", bins, "low", "high").select("p_partkey", "p_size", "bin")


def agg_basic(spark, d):
    o = t(spark, d, "orders")
    a = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), r6(F.sum("o_totalprice"), "total"), r6(F.avg("o_totalprice"), "mean"), F.min("o_totalprice").alias("least"), F.max("o_totalprice").alias("most"))
    return joins.lookup_left(t(spark, d, "customer").select("c_custkey"), a, ["c_custkey"])


def agg_dispersion(spark, d):
    g = t(spark, d, "lineitem").groupBy("l_suppkey").agg(F.stddev_pop("l_quantity").alias("s"), F.avg("l_quantity").alias("m"))
    return g.select("l_suppkey", r6("s", "sd"), r6(F.col("s") / F.col("m"), "cv"))


def agg_distinct(spark, d):
    return t(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_orderkey").alias("orders"))


def agg_share_where(spark, d):
    return t(spark, d, "orders").groupBy("o_custkey").agg(r6(F.avg((F.col("o_orderstatus") == "F").cast("int")), "share_f"), F.count_if(F.col("o_totalprice") > 100000).alias("n_large"))


KINDS = ["click", "error", "purchase", "signup", "view"]


def agg_pivot_counts(spark, d):
    p = t(spark, d, "events").groupBy("user_id").pivot("event_type", KINDS).agg(F.count(F.lit(1)))
    return p.select("user_id", *(F.coalesce(k, F.lit(0)).alias(k) for k in KINDS))


def agg_two_hop(spark, d):
    per_order = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("qty"))
    per_customer = t(spark, d, "orders").select("o_orderkey", "o_custkey").join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy(F.col("o_custkey").alias("c_custkey"))
    made = per_customer.agg(F.sum(F.coalesce("lines", F.lit(0))).cast("long").alias("lines"), r6(F.avg("qty"), "mean_qty"))
    return joins.lookup_left(t(spark, d, "customer").select("c_custkey"), made, ["c_custkey"])


def agg_mode(spark, d):
    counts = t(spark, d, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("o_custkey").agg(F.min(F.struct((-F.col("n")).alias("n"), "o_orderpriority")).alias("b"))
    return best.select("o_custkey", F.col("b.o_orderpriority").alias("mode"), (-F.col("b.n")).alias("n"))


def agg_rfm(spark, d):
    o = t(spark, d, "orders")
    until = o.agg(F.max("o_orderdate").alias("until"))
    g = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last"), F.min("o_orderdate").alias("first"), F.count(F.lit(1)).alias("frequency"), F.sum("o_totalprice").alias("m"))
    return g.join(F.broadcast(until)).select("o_custkey", recency(F.col("last"), F.col("until")).cast("long").alias("recency"), recency(F.col("first"), F.col("last")).cast("long").alias("span"), "frequency", r6("m", "monetary"))


def agg_grouping_sets(spark, d):
    j = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return j.groupingSets([["c_mktsegment", "o_orderstatus"], ["c_mktsegment"], []], "c_mktsegment", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("o_totalprice"), "total"))


def agg_rollup(spark, d):
    return t(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("l_quantity"), "qty"))


def agg_cube(spark, d):
    return t(spark, d, "documents").cube("lang", "source").agg(F.count(F.lit(1)).alias("n"))


def agg_time_bucket(spark, d):
    return t(spark, d, "events").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("value"), "total")).select(F.col("w.start").cast("date").alias("day"), "event_type", "n", "total")


def agg_sessions(spark, d):
    events = t(spark, d, "events")
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    new = events.withColumn("new", F.coalesce((F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(F.lag("ts").over(w).cast("timestamp")) > 6 * 3600).cast("int"), F.lit(1)))
    numbered = new.withColumn("session", F.sum("new").over(w))
    return numbered.groupBy("user_id", "session").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("start"), F.max("ts").alias("end"))


def win_rank_in_group(spark, d):
    w = W.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"))
    return t(spark, d, "orders").select("o_orderkey", F.rank().over(w).cast("long").alias("rank"), F.dense_rank().over(w).cast("long").alias("dense"))


def win_gap(spark, d):
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    seconds = lambda c: F.unix_seconds(c.cast("timestamp"))
    return t(spark, d, "events").select("event_id", (seconds(F.col("ts")) - seconds(F.lag("ts").over(w))).alias("gap_s"))


def win_trailing_7d(spark, d):
    e = t(spark, d, "events").withColumn("s", F.unix_seconds(F.col("ts").cast("timestamp")))
    w = W.partitionBy("user_id").orderBy("s").rangeBetween(-7 * 86400, 0)
    return e.select("event_id", F.count(F.lit(1)).over(w).alias("n"), r6(F.sum("value").over(w), "total"))


def win_expanding_prior(spark, d):
    w = W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(W.unboundedPreceding, -1)
    return t(spark, d, "events").select("event_id", F.count(F.lit(1)).over(w).alias("n_before"), r6(F.sum("value").over(w), "total_before"))


def win_zscore(spark, d):
    p = t(spark, d, "part").select("p_partkey", "p_brand", "p_retailprice")
    means = p.groupBy("p_brand").agg(F.avg("p_retailprice").alias("m"), F.stddev_pop("p_retailprice").alias("s"))
    return p.join(means, "p_brand").select("p_partkey", r6((F.col("p_retailprice") - F.col("m")) / F.nullif("s", F.lit(0.0)), "z"))


def placed(df: DataFrame, group: str, order: str) -> DataFrame:
    """``df`` with the rows of its group (``__all``), of its value (``__n``) and of smaller values (``__n_before``); groups are ordered in ranges."""
    counts = df.groupBy(group, order).agg(F.count(F.lit(1)).alias("__n"))
    totals = counts.groupBy(group).agg(F.sum("__n").alias("__all")).withColumnRenamed(group, "__g")
    counts = running_before(counts, order, ["__n"], [group]).withColumnsRenamed({group: "__group", order: "__value"})
    rows = df.join(counts, F.col(group).eqNullSafe(F.col("__group")) & F.col(order).eqNullSafe(F.col("__value")))
    return rows.join(totals, F.col(group).eqNullSafe(F.col("__g"))).drop("__group", "__value", "__g")


def win_percent_rank(spark, d):
    rows = placed(t(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal"), "c_nationkey", "c_acctbal")
    pr = F.when(F.col("__all") > 1, F.col("__n_before") / (F.col("__all") - 1)).otherwise(0.0)
    return rows.select("c_custkey", r6(pr, "pr"), r6((F.col("__n_before") + F.col("__n")) / F.col("__all"), "cd"))


def bin_quantile(spark, d):
    rows = placed(t(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), "c_mktsegment", "c_acctbal")
    ties = W.partitionBy("c_mktsegment", "c_acctbal").orderBy("c_custkey")
    at = F.col("__n_before") + F.row_number().over(ties) - 1
    short, longer = F.floor(F.col("__all") / 10), F.col("__all") % 10  # the first ``longer`` deciles have a row more
    early = longer * (short + 1)
    decile = F.when(at < early, F.floor(at / (short + 1))).otherwise(longer + F.floor((at - early) / F.greatest(short, F.lit(1))))
    return rows.select("c_custkey", (decile + 1).cast("long").alias("decile"))


def bin_width(spark, d):
    return t(spark, d, "lineitem").groupBy(F.floor(F.col("l_extendedprice") / 1000).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"), r6(F.avg("l_discount"), "mean_discount"))


def sc_date_parts(spark, d):
    c = F.col("o_orderdate")
    return t(spark, d, "orders").select("o_orderkey", F.year(c).cast("long").alias("y"), F.month(c).cast("long").alias("m"), (F.dayofweek(c) - 1).cast("long").alias("dow"), F.quarter(c).cast("long").alias("q"))


def sc_ratio_log(spark, d):
    return t(spark, d, "orders").select("o_orderkey", r6(F.try_divide("o_totalprice", F.col("o_custkey") % 5), "ratio"), r6(F.log1p("o_totalprice"), "log_price"))


def sc_text_stats(spark, d):
    x = F.col("text")
    return t(spark, d, "documents").select("doc_id", F.length(x).cast("long").alias("chars"), F.octet_length(x).cast("long").alias("bytes"), F.size(F.split(x, " ")).cast("long").alias("tokens"), F.size(F.array_distinct(F.split(x, " "))).cast("long").alias("distinct_tokens"), F.length(F.regexp_replace(x, "[^0-9]", "")).cast("long").alias("digits"))


def sc_json(spark, d):
    return t(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


def sc_cross(spark, d):
    c = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.groupBy(F.concat_ws("|", "n_name", "c_mktsegment").alias("crossed")).agg(F.count(F.lit(1)).alias("n"), r6(F.avg("c_acctbal"), "mean_balance"))


def sc_fill_cast(spark, d):
    o = t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), F.max("o_orderpriority").alias("top"), F.max("o_totalprice").alias("most"))
    return fill_missing(joins.lookup_left(t(spark, d, "customer").select("c_custkey"), o, ["c_custkey"]), ["n", "top", "most"])


def arr_norm_centroid(spark, d):
    e = t(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    means = e.select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("m")).groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("c"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    away = F.sqrt(F.aggregate(F.zip_with("v", "c", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x))
    return e.join(means, "label").select("vec_id", r6(norm, "norm"), r6(away, "distance"))


def enc_frequency(spark, d):
    c = t(spark, d, "customer")
    return c.join(encoders.frequency(c, "c_mktsegment"), "c_mktsegment").select("c_custkey", r6("share", "share"))


def enc_target_smoothed(spark, d):
    rows = labelled(spark, d)
    return rows.join(encoders.smoothed_target(rows.where("is_test = 0"), "lang", "quality"), "lang", "left").select("doc_id", r6("encoded", "encoded"))


def enc_target_oof(spark, d):
    rows = labelled(spark, d).withColumn("fold", F.col("doc_id") % 4)
    codes = encoders.out_of_fold_target(rows, "lang", "quality", "fold")
    return rows.join(codes, ["lang", "fold"]).select("doc_id", r6("encoded", "encoded"))


def enc_woe(spark, d):
    return metrics.woe(labelled(spark, d), "lang", "quality").select("lang", "pos", "neg", r6("woe", "woe"))


def enc_rare(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "lang")
    return docs.join(encoders.rare(docs, "lang", 120), "lang").groupBy("grouped").agg(F.count(F.lit(1)).alias("n"))


def ev_auc(spark, d):
    return select.feature_scores(labelled(spark, d), ["n_chars", "n_words", "is_test"], "quality").select("feature", r6("auc", "auc"))


def ev_gini(spark, d):
    return metrics.auc(labelled(spark, d), "n_chars", "toxic").select(r6(metrics.gini(F.col("auc")), "gini"))


def ev_auc_cv(spark, d):
    rows = metrics.stratified_folds(labelled(spark, d).select("doc_id", "quality", "n_chars"), "doc_id", "quality", 5)
    return metrics.auc_by(rows, "n_chars", "quality", ["fold"]).agg(r6(F.avg("auc"), "mean_auc"), r6(F.stddev_pop("auc"), "sd_auc"))


def binned(spark, d):
    return labelled(spark, d).withColumn("bin", metrics.width_bin(F.col("n_chars"), 500, 10))


def ev_iv(spark, d):
    return metrics.information_value(binned(spark, d), "bin", "quality").select(r6("iv", "iv"))


def ev_psi(spark, d):
    return metrics.psi(binned(spark, d), "bin", "is_test").select(r6("psi", "psi"))


def ev_mutual_info(spark, d):
    return metrics.mutual_information(binned(spark, d), "bin", "quality").select(r6("mi", "mi"))


def ev_corr_matrix(spark, d):
    return select.correlations(fill_missing(customer_features(spark, d), FEATURES), FEATURES).select("feature_a", "feature_b", r6("corr", "corr"))


def ev_top_features(spark, d):
    scores = select.feature_scores(customer_features(spark, d), FEATURES, "target").select("feature", r6(F.abs(F.col("auc") - 0.5), "importance"))
    return select.top_features(scores)


def ev_best_set(spark, d):
    rows = labelled(spark, d).withColumn("fold", F.col("doc_id") % 5)
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("set_id"), F.col(f).cast("double").alias("x")) for f in ("n_chars", "n_words"))))
    scores = metrics.auc_by(rows.select("fold", "quality", each.alias("e")).select("fold", "quality", "e.*"), "x", "quality", ["set_id", "fold"])
    means = scores.groupBy("set_id").agg(F.round(F.avg("auc"), 6).alias("mean_auc"))
    return means.agg(F.max_by("set_id", F.struct("mean_auc", "set_id")).alias("set_id"), F.max("mean_auc").alias("mean_auc"))


SET_BINS = {"chars": "b_chars", "words": "b_words", "lang": "lang"}


def coded(spark, d) -> DataFrame:
    """Labelled documents with out-of-fold codes of three binned features."""
    bins = {"b_chars": metrics.width_bin(F.col("n_chars"), 500, 10), "b_words": metrics.width_bin(F.col("n_words"), 100, 10), "fold": F.col("doc_id") % 5}
    return select.woe_codes(labelled(spark, d).withColumns(bins), SET_BINS, "quality", "fold")


def ev_sets_cv(spark, d):
    names = list(SET_BINS)
    sets = {n: [n] for n in names} | {f"{a}+{b}": [a, b] for i, a in enumerate(names) for b in names[i + 1 :]}
    return select.set_scores(coded(spark, d), sets, "quality", "fold").select("set_id", r6("mean_auc", "mean_auc"))


def ev_forward_set(spark, d):
    steps = select.grow(coded(spark, d), list(SET_BINS), "quality", "fold", limit=2)
    rows = [(i, f, auc) for i, (f, auc) in enumerate(steps, 1)]
    return spark.createDataFrame(rows, "step long, feature string, mean_auc double").select("step", "feature", r6("mean_auc", "mean_auc"))


def agg_grammar(spark, d):
    """What the search makes of orders by itself: counts, sums, shares of each status and priority, windows up to the last day."""
    orders = t(spark, d, "orders").drop("o_orderkey")
    specs = grammar("orders", orders, "o_custkey", (), profile.common_values(orders), profile.last_days(orders))
    specs = [s for s in specs if s.name.startswith(("orders_count", "orders_sum", "orders_share", "orders_min", "orders_max"))]
    made = compile_features(orders.select(F.col("o_custkey").alias("id")).distinct(), "id", {"orders": orders}, specs)
    return made.select("id", *(F.round(F.col(s.name).cast("double"), 2 if "_sum_" in s.name else 6).alias(s.name) for s in specs))


def agg_over_time(spark, d):
    """How each customer's orders run over time: gaps, recency, slopes and sums that fade with age, in one aggregate."""
    orders = t(spark, d, "orders").drop("o_orderkey")
    specs = over_time("orders", "o_custkey", "o_orderdate", profile.last_days(orders)["o_orderdate"], ["o_totalprice"])
    made = compile_features(orders.select(F.col("o_custkey").alias("id")).distinct(), "id", {"orders": orders}, specs)
    return made.select("id", *(F.round(F.col(s.name).cast("double"), 4).alias(s.name) for s in specs))


def found_keys(spark, d):
    """Keys of one or two columns, found by sketches and confirmed by counts."""
    keys, _ = profile.find_keys({n: t(spark, d, n) for n in ("orders", "lineitem", "customer", "conversations", "labels")})
    rows = [(n, ",".join(k)) for n, some in keys.items() for k in some]  # a row a key
    return spark.createDataFrame(rows, "table_name string, key string")


def found_links(spark, d):
    """Joins that sketches leave and counts confirm, among tables with meaningful key names."""
    graph = profile.join_graph({n: t(spark, d, n) for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")})
    return spark.createDataFrame([(a, b if isinstance(b, str) else ",".join(b), c, k if isinstance(k, str) else ",".join(k)) for a, b, c, k in graph], "child string, child_key string, parent string, parent_key string")


def set_train_test_union(spark, d):
    rows = labelled(spark, d)
    train, test = rows.where("is_test = 0").select("doc_id", "quality", "n_chars"), rows.where("is_test = 1").select("doc_id", "n_chars")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")), allowMissingColumns=True)


def set_id_overlap(spark, d):
    rows = t(spark, d, "labels")
    return rows.where("doc_id % 5 = 0").select("doc_id").intersect(rows.where("doc_id % 5 <> 0").select("doc_id")).agg(F.count(F.lit(1)).alias("n_shared"))


def set_missing_ids(spark, d):
    return t(spark, d, "documents").select("doc_id").exceptAll(t(spark, d, "labels").select("doc_id")).agg(F.count(F.lit(1)).alias("n_missing"))


def contract_violations(spark, d):
    from ..operators.contract import violations

    rows = labelled(spark, d)
    train, test = rows.where("is_test = 0"), rows.where("is_test = 1")
    inputs = {"train": train.select("doc_id", "quality"), "test": test.select("doc_id")}
    empty = F.lit(None).cast("double").alias("blank")
    outputs = {"train": train.select("doc_id", "quality", "n_chars", empty), "test": test.where("doc_id % 10 = 0").select("doc_id", "n_chars")}
    return violations(spark, inputs, outputs, id_col="doc_id")


def matrix(spark, d, test: int) -> DataFrame:
    rows = labelled(spark, d)
    codes = encoders.smoothed_target(rows.where("is_test = 0"), "lang", "quality").select("lang", r6("encoded", "lang_quality"))
    made = rows.where(F.col("is_test") == test).join(codes, "lang", "left")
    return made.select("doc_id", *(["quality"] if not test else []), "n_chars", "n_words", "lang_quality")


def matrix_train(spark, d):
    return matrix(spark, d, 0)


def matrix_test(spark, d):
    return matrix(spark, d, 1)


def baseline_noise(spark, d):
    return t(spark, d, "customer").select("c_custkey", *(r6(noise(F.col("c_custkey"), 42 + i), f"ft_{i + 1}") for i in range(5)))


def gbt_cv_score(spark, d):
    return evaluate.cv_scores(labelled(spark, d), "doc_id", ["n_chars", "n_words", "lang"], "quality")


def enc_target_ordered(spark, d):
    """Documents' languages as mean quality of the rows before them in a hash order; test rows get the mean over all training rows."""
    rows = labelled(spark, d).withColumn("o", order_hash(F.col("doc_id"), 42))
    return encoders.ordered_target(rows, "lang", "quality", "o", {"code": F.col("is_test") == 0}, 0.5).select("doc_id", "lang", r6("code", "code"))


def score_report(spark, d):
    labels = t(spark, d, "labels").select("doc_id", "quality")
    got = evaluate.score(matrix_train(spark, d), matrix_test(spark, d), labels, "doc_id", "quality")
    row = (got.roc_auc, got.gini, *(got.details[k] for k in ("cv_mean_auc", "cv_std_auc", "n_features", "train_rows", "test_rows")))
    return spark.createDataFrame([row], "roc_auc double, gini double, cv_mean_auc double, cv_std_auc double, n_features int, train_rows long, test_rows long")


def stream_daily_counts(spark, d):
    """The streaming job over the stored table's files: what is there is processed once."""
    from ..streaming import events as ev

    stream = spark.readStream.schema(ev.EVENTS).option("pathGlobFilter", "events*.parquet").parquet(d)
    out = ev.run_once(ev.daily_counts(stream))
    return out.select(F.col("day").cast("date").alias("day"), "event_type", "n", r6("total", "total"))


def _events(spark, d):
    from ..streaming import events as ev

    return spark.readStream.schema(ev.EVENTS).option("pathGlobFilter", "events*.parquet").parquet(d)


def stream_sessions(spark, d):
    """Runs of a user's events without a pause of six hours, by session windows over the stream."""
    from ..streaming import events as ev

    out = ev.run_once(ev.sessions(_events(spark, d), "6 hours"))
    return out.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


def stream_last_event(spark, d):
    """Each event with its user's event before it, from keyed state; those of the last day still wait for late ones."""
    from ..streaming import events as ev

    return ev.run_once(ev.last_event_features(_events(spark, d)), "append").select("event_id", "user_id", "gap_s", "last_type", r6("last_value", "last_value"), "n_before")


def stream_click_purchase(spark, d):
    """Purchases at most an hour after a click of the same user, by a join of two streams."""
    from ..streaming import events as ev

    out = ev.run_once(ev.within_after(_events(spark, d).where("event_type = 'click'"), _events(spark, d).where("event_type = 'purchase'")), "append")
    return out.select("user_id", "first_id", "second_id", F.round("wait_s", 3).alias("wait_s"))


NAMES = [
    "flagship_feature_auc", "scan_profile", "key_candidates", "fk_inclusion", "fk_fanout", "holdout_split", "stratified_folds", "class_weights",
    "lookup_left", "lookup_nullsafe", "label_join_1to1", "ids_without_history", "ids_with_history", "asof_last_event", "range_bin_join",
    "agg_basic", "agg_dispersion", "agg_distinct", "agg_share_where", "agg_pivot_counts", "agg_two_hop", "agg_mode", "agg_rfm",
    "agg_grouping_sets", "agg_rollup", "agg_cube", "agg_time_bucket", "agg_sessions", "win_rank_in_group", "win_gap", "win_trailing_7d",
    "win_expanding_prior", "win_zscore", "win_percent_rank", "bin_quantile", "bin_width", "sc_date_parts", "sc_ratio_log", "sc_text_stats",
    "sc_json", "sc_cross", "sc_fill_cast", "arr_norm_centroid", "enc_frequency", "enc_target_smoothed", "enc_target_oof", "enc_target_ordered", "enc_woe", "enc_rare",
    "ev_auc", "ev_gini", "ev_auc_cv", "ev_iv", "ev_psi", "ev_mutual_info", "ev_corr_matrix", "ev_top_features", "ev_best_set", "ev_sets_cv", "ev_forward_set", "agg_grammar",
    "set_train_test_union", "set_id_overlap", "set_missing_ids", "contract_violations", "matrix_train", "matrix_test", "baseline_noise",
    "gbt_cv_score", "score_report", "stream_daily_counts", "stream_sessions", "stream_last_event", "stream_click_purchase", "agg_over_time", "found_keys", "found_links",
]
QUERIES = {n: globals()[n] for n in NAMES}
