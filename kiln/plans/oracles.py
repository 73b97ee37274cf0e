"""The same queries as SQL for another engine over the same tables."""

from __future__ import annotations

from .queries import FKS

LABELLED = """labelled AS (
  SELECT l.doc_id, l.quality, l.toxic, d.lang, d.source, d.n_chars,
         (length(d.text) - length(replace(d.text, ' ', '')))::BIGINT AS n_words, (l.doc_id % 5 = 0)::INT AS is_test
  FROM labels l JOIN documents d USING (doc_id))"""

CUSTOMER = """feats AS (
  SELECT c_custkey AS id, c_acctbal, (c_mktsegment = 'BUILDING')::INT AS target, n_orders, total, mean_price, share_f
  FROM customer LEFT JOIN (
    SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS total, avg(o_totalprice) AS mean_price, avg((o_orderstatus = 'F')::INT) AS share_f
    FROM orders GROUP BY 1) ON o_custkey = c_custkey),
filled AS (
  SELECT target, coalesce(n_orders, -999)::DOUBLE AS n_orders, coalesce(total, -999) AS total, coalesce(mean_price, -999) AS mean_price,
         coalesce(share_f, -999) AS share_f, coalesce(c_acctbal, -999) AS c_acctbal FROM feats),
long AS (
  SELECT feature, value, target AS y FROM filled UNPIVOT (value FOR feature IN (n_orders, total, mean_price, share_f, c_acctbal)))"""


def auc(table: str, x: str, y: str, by: str = "") -> str:
    """Mann-Whitney with mean ranks."""
    part = f"PARTITION BY {by}" if by else ""
    comma = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    both = f"PARTITION BY {by + ', ' if by else ''}{x}"
    return f"""SELECT {comma}(sum(CASE WHEN {y} = 1 THEN r END) - sum({y}) * (sum({y}) + 1) / 2.0::DOUBLE) / (sum({y})::DOUBLE * sum(1 - {y})) AS auc
  FROM (SELECT {comma}{y}, rank() OVER ({part} ORDER BY {x}) + (count(*) OVER ({both}) - 1) / 2.0::DOUBLE AS r FROM {table}) {group}"""


FOLDS = """c AS (SELECT {y}, min(doc_id) AS first_id, count(*) AS m FROM {t} GROUP BY 1),
k AS (SELECT {y} AS cls, m, coalesce(sum(m) OVER (ORDER BY first_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s FROM c),
pos AS (SELECT cls, ((s + i) % 5) AS f FROM k, range(0, 1000000) r(i) WHERE i < m),
a AS (SELECT cls, f, sum(count(*)) OVER (PARTITION BY cls ORDER BY f) AS upto FROM pos GROUP BY 1, 2),
n AS (SELECT *, row_number() OVER (PARTITION BY {y} ORDER BY doc_id) AS rn FROM {t}),
folded AS (SELECT n.*, (SELECT count(*) FROM a WHERE a.cls = n.{y} AND a.upto < n.rn)::BIGINT AS fold FROM n)"""

#: 52 bits of md5 over seed and id.
HASH = "('0x' || substr(md5('{seed}|' || coalesce({id}::VARCHAR, '')), 1, 13))::BIGINT"
PROFILE = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS n_null, count(DISTINCT {c}) AS n_distinct, min({c})::VARCHAR AS min_value, max({c})::VARCHAR AS max_value FROM orders"
    for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
)
KEYS = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{','.join(k)}' AS key, count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT {','.join(k)} FROM {n})) AS n_keys, count(*) FILTER ({' OR '.join(c + ' IS NULL' for c in k)}) AS n_null, count(*) = (SELECT count(*) FROM (SELECT DISTINCT {','.join(k)} FROM {n})) AND count(*) FILTER ({' OR '.join(c + ' IS NULL' for c in k)}) = 0 AS is_key FROM {n}"
    for n, k in (("orders", ["o_orderkey"]), ("lineitem", ["l_orderkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]), ("conversations", ["conv_id", "turn"]), ("customer", ["c_custkey"]))
)
INCLUSION = " UNION ALL ".join(
    f"SELECT '{c}.{ck}' AS child, '{p}.{pk}' AS parent, count(*) AS n_rows, count(*) FILTER ({ck} NOT IN (SELECT {pk} FROM {p})) AS n_orphans FROM {c} WHERE {ck} IS NOT NULL"
    for c, ck, p, pk in FKS
)
WOE = """w AS (
  SELECT {b}, pos, neg, (pos + 0.5::DOUBLE) / (sum(pos) OVER () + 0.5::DOUBLE) AS p, (neg + 0.5::DOUBLE) / (sum(neg) OVER () + 0.5::DOUBLE) AS q
  FROM (SELECT {b}, sum({y})::BIGINT AS pos, sum(1 - {y})::BIGINT AS neg FROM {t} GROUP BY 1))"""
BINNED = LABELLED + ", binned AS (SELECT *, least(floor(n_chars / 500.0::DOUBLE), 10)::BIGINT AS bin FROM labelled)"
PAIRS = [(a, b) for i, a in enumerate(["n_orders", "total", "mean_price", "share_f", "c_acctbal"]) for b in ["n_orders", "total", "mean_price", "share_f", "c_acctbal"][i + 1 :]]

_BINS = LABELLED + """, rows AS (
  SELECT doc_id % 5 AS fold, quality AS y, least(floor(n_chars / 500.0::DOUBLE), 10)::BIGINT::VARCHAR AS chars, least(floor(n_words / 100.0::DOUBLE), 10)::BIGINT::VARCHAR AS words, lang FROM labelled),
folds AS (SELECT fold, sum(y) AS fp, sum(1 - y) AS fn FROM rows GROUP BY 1),
al AS (SELECT sum(y) AS ap, sum(1 - y) AS an FROM rows)"""


def _codes(x: str) -> str:
    """Log ratio of class shares in a bin, from the other folds."""
    return f"""c_{x} AS (
  SELECT b.{x}, b.fold, ln(((o.op - b.p + 0.5::DOUBLE) / (ap - fp + 0.5::DOUBLE)) / ((o.q - b.n + 0.5::DOUBLE) / (an - fn + 0.5::DOUBLE))) AS w_{x}
  FROM (SELECT {x}, fold, sum(y) AS p, sum(1 - y) AS n FROM rows GROUP BY 1, 2) b
  JOIN (SELECT {x}, sum(y) AS op, sum(1 - y) AS q FROM rows GROUP BY 1) o USING ({x}) JOIN folds USING (fold), al)"""


_SETS = {"chars": "w_chars", "words": "w_words", "lang": "w_lang", "chars+words": "w_chars + w_words", "chars+lang": "w_chars + w_lang", "words+lang": "w_words + w_lang"}
SETS = (
    f"WITH {_BINS}, " + ", ".join(_codes(x) for x in ("chars", "words", "lang"))
    + ", coded AS (SELECT fold, y, w_chars, w_words, w_lang FROM rows JOIN c_chars USING (chars, fold) JOIN c_words USING (words, fold) JOIN c_lang USING (lang, fold)), long AS ("
    + " UNION ALL ".join(f"SELECT '{s}' AS set_id, fold, y, round({e}, 9) AS x FROM coded" for s, e in _SETS.items())
    + f"), s AS ({auc('long', 'x', 'y', 'set_id, fold')}), m AS (SELECT set_id, avg(auc) AS mean_auc FROM s GROUP BY 1)"
)
_LAST = "(o_orderdate::DATE > (SELECT max(o_orderdate)::DATE FROM orders) - {n})"
GRAMMAR = ", ".join(
    [f"(count(*) FILTER {_LAST.format(n=n)})::DOUBLE AS orders_count_{n}d_o_orderdate, round((count(*) FILTER {_LAST.format(n=n)})::DOUBLE / count(*), 6) AS orders_share_{n}d_o_orderdate, round(coalesce(sum(o_totalprice) FILTER {_LAST.format(n=n)}, 0), 2) AS orders_sum_o_totalprice_{n}d_o_orderdate" for n in (30, 90)]
    + [f"round(avg((o_orderstatus = '{v}')::INT), 6) AS orders_share_o_orderstatus_{v}" for v in "FOP"]
    + [f"round(avg((o_orderpriority = '{v}')::INT), 6) AS orders_share_o_orderpriority_{n}" for v, n in (("1-URGENT", "1_URGENT"), ("2-HIGH", "2_HIGH"), ("3-MEDIUM", "3_MEDIUM"), ("4-NOT SPECIFIED", "4_NOT_SPECIFIED"), ("5-LOW", "5_LOW"))]
    + [f"date_diff('day', DATE '1970-01-01', {f}(o_orderdate)::DATE)::DOUBLE AS orders_{f}_o_orderdate, {f}(o_totalprice) AS orders_{f}_o_totalprice" for f in ("min", "max")]
)

ORACLE_SQL = {
    "flagship_feature_auc": f"WITH {CUSTOMER}, s AS ({auc('long', 'value', 'y', 'feature')}) SELECT feature, round(auc, 6) AS auc, round(2 * auc - 1, 6) AS gini FROM s",
    "scan_profile": PROFILE,
    "key_candidates": KEYS,
    "fk_inclusion": INCLUSION,
    "fk_fanout": "SELECT 'orders.o_custkey' AS edge, count(*) AS n_keys, round(avg(n), 6) AS mean_rows, max(n) AS max_rows FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey) UNION ALL SELECT 'lineitem.l_orderkey', count(*), round(avg(n), 6), max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)",
    "holdout_split": "SELECT doc_id, quality, (doc_id % 5 = 0)::INT AS is_test FROM labels",
    "stratified_folds": f"WITH {FOLDS.format(t='labels', y='quality')} SELECT doc_id, quality, fold FROM folded",
    "class_weights": "SELECT quality, count(*) AS n, round(max(count(*)) OVER () / count(*)::DOUBLE, 6) AS weight FROM labels GROUP BY quality",
    "lookup_left": "SELECT o_orderkey, o_custkey AS c_custkey, c_mktsegment, c_acctbal FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
    "lookup_nullsafe": "WITH l AS (SELECT o_orderkey, CASE WHEN o_custkey % 7 <> 0 THEN o_custkey % 50 END AS k FROM orders), r AS (SELECT k, count(*) AS n FROM l GROUP BY 1) SELECT o_orderkey, l.k, n FROM l LEFT JOIN r ON l.k IS NOT DISTINCT FROM r.k",
    "label_join_1to1": "SELECT doc_id, lang, quality, quality IS NULL AS unmatched FROM documents LEFT JOIN labels USING (doc_id)",
    "ids_without_history": "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)",
    "ids_with_history": "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT user_id FROM events)",
    "asof_last_event": """
SELECT event_id, user_id, click_id AS last_click_id, value AS last_value FROM (
  SELECT p.event_id, p.user_id, c.event_id AS click_id, c.value, row_number() OVER (PARTITION BY p.event_id ORDER BY c.ts DESC NULLS LAST, c.event_id DESC) AS rn
  FROM (SELECT * FROM events WHERE event_type = 'purchase') p
  LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON c.user_id = p.user_id AND c.ts < p.ts) WHERE rn = 1""",
    "range_bin_join": "SELECT p_partkey, p_size, bin FROM part LEFT JOIN (VALUES ('small', 0, 10), ('middle', 10, 30), ('large', 30, 1000)) b(bin, low, high) ON p_size >= low AND p_size < high",
    "agg_basic": "SELECT c_custkey, n, total, mean, least, most FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 6) AS total, round(avg(o_totalprice), 6) AS mean, min(o_totalprice) AS least, max(o_totalprice) AS most FROM orders GROUP BY 1) ON o_custkey = c_custkey",
    "agg_dispersion": "SELECT l_suppkey, round(stddev_pop(l_quantity), 6) AS sd, round(stddev_pop(l_quantity) / avg(l_quantity), 6) AS cv FROM lineitem GROUP BY 1",
    "agg_distinct": "SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1",
    "agg_share_where": "SELECT o_custkey, round(avg((o_orderstatus = 'F')::INT), 6) AS share_f, count(*) FILTER (o_totalprice > 100000) AS n_large FROM orders GROUP BY 1",
    "agg_pivot_counts": "SELECT user_id, " + ", ".join(f"count(*) FILTER (event_type = '{k}') AS {k}" for k in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY 1",
    "agg_two_hop": "SELECT c_custkey, lines, mean_qty FROM customer LEFT JOIN (SELECT o_custkey, sum(coalesce(lines, 0))::BIGINT AS lines, round(avg(qty), 6) AS mean_qty FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS qty FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1) ON o_custkey = c_custkey",
    "agg_mode": "SELECT o_custkey, o_orderpriority AS mode, n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS rn FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)) WHERE rn = 1",
    "agg_rfm": "SELECT o_custkey, date_diff('day', max(o_orderdate)::DATE, (SELECT max(o_orderdate)::DATE FROM orders)) AS recency, date_diff('day', min(o_orderdate)::DATE, max(o_orderdate)::DATE) AS span, count(*) AS frequency, round(sum(o_totalprice), 6) AS monetary FROM orders GROUP BY 1",
    "agg_grouping_sets": "SELECT c_mktsegment, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 6) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY GROUPING SETS ((c_mktsegment, o_orderstatus), (c_mktsegment), ())",
    "agg_rollup": "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 6) AS qty FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)",
    "agg_cube": "SELECT lang, source, count(*) AS n FROM documents GROUP BY CUBE (lang, source)",
    "agg_time_bucket": "SELECT ts::DATE AS day, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2",
    "agg_sessions": """
WITH g AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
s AS (SELECT *, sum(CASE WHEN before IS NULL OR floor(epoch(ts)) - floor(epoch(before)) > 6 * 3600 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g)
SELECT user_id, session::BIGINT AS session, count(*) AS n, min(ts) AS start, max(ts) AS end FROM s GROUP BY 1, 2""",
    "win_rank_in_group": "SELECT o_orderkey, rank() OVER w AS rank, dense_rank() OVER w AS dense FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC)",
    "win_gap": "SELECT event_id, (floor(epoch(ts)) - floor(epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))))::BIGINT AS gap_s FROM events",
    "win_trailing_7d": "SELECT event_id, count(*) OVER w AS n, round(sum(value) OVER w, 6) AS total FROM (SELECT *, floor(epoch(ts))::BIGINT AS s FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY s RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW)",
    "win_expanding_prior": "SELECT event_id, count(*) OVER w AS n_before, round(sum(value) OVER w, 6) AS total_before FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
    "win_zscore": "SELECT p_partkey, round((p_retailprice - avg(p_retailprice) OVER w) / nullif(stddev_pop(p_retailprice) OVER w, 0), 6) AS z FROM part WINDOW w AS (PARTITION BY p_brand)",
    "win_percent_rank": "SELECT c_custkey, round(percent_rank() OVER w, 6) AS pr, round(cume_dist() OVER w, 6) AS cd FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal)",
    "bin_quantile": "SELECT c_custkey, ntile(10) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) AS decile FROM customer",
    "bin_width": "SELECT floor(l_extendedprice / 1000)::BIGINT AS bin, count(*) AS n, round(avg(l_discount), 6) AS mean_discount FROM lineitem GROUP BY 1",
    "sc_date_parts": "SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, dayofweek(o_orderdate) AS dow, quarter(o_orderdate) AS q FROM orders",
    "sc_ratio_log": "SELECT o_orderkey, round(CASE WHEN o_custkey % 5 <> 0 THEN o_totalprice / (o_custkey % 5) END, 6) AS ratio, round(ln(1 + o_totalprice), 6) AS log_price FROM orders",
    "sc_text_stats": "SELECT doc_id, length(text) AS chars, strlen(text) AS bytes, len(string_split(text, ' ')) AS tokens, len(list_distinct(string_split(text, ' '))) AS distinct_tokens, length(regexp_replace(text, '[^0-9]', '', 'g')) AS digits FROM documents",
    "sc_json": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "sc_cross": "SELECT n_name || '|' || c_mktsegment AS crossed, count(*) AS n, round(avg(c_acctbal), 6) AS mean_balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
    "sc_fill_cast": "SELECT c_custkey, coalesce(n::DOUBLE, -999) AS n, coalesce(top, '-999') AS top, coalesce(most, -999) AS most FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_orderpriority) AS top, max(o_totalprice) AS most FROM orders GROUP BY 1) ON o_custkey = c_custkey",
    "arr_norm_centroid": """
WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT label, i, avg(x) AS m FROM x GROUP BY 1, 2)
SELECT vec_id, round(sqrt(sum(x * x)), 6) AS norm, round(sqrt(sum((x - m) * (x - m))), 6) AS distance FROM x JOIN m USING (label, i) GROUP BY vec_id""",
    "enc_frequency": "SELECT c_custkey, round(count(*) OVER (PARTITION BY c_mktsegment) / count(*) OVER ()::DOUBLE, 6) AS share FROM customer",
    "enc_target_smoothed": f"WITH {LABELLED}, e AS (SELECT lang, (sum(quality) + 10 * (SELECT avg(quality) FROM labelled WHERE is_test = 0)) / (count(*) + 10) AS encoded FROM labelled WHERE is_test = 0 GROUP BY 1) SELECT doc_id, round(encoded, 6) AS encoded FROM labelled LEFT JOIN e USING (lang)",
    "enc_target_oof": f"""WITH {LABELLED}, f AS (SELECT lang, doc_id % 4 AS fold, sum(quality)::DOUBLE AS s, count(*) AS n FROM labelled GROUP BY 1, 2),
e AS (SELECT lang, fold, (sum(s) OVER c - s + 10 * (sum(s) OVER () - sum(s) OVER f) / (sum(n) OVER () - sum(n) OVER f)) / (sum(n) OVER c - n + 10) AS encoded FROM f WINDOW c AS (PARTITION BY lang), f AS (PARTITION BY fold))
SELECT doc_id, round(encoded, 6) AS encoded FROM labelled JOIN e ON e.lang = labelled.lang AND e.fold = labelled.doc_id % 4""",
    "enc_target_ordered": f"""WITH {LABELLED}, h AS (SELECT *, {HASH.format(seed="42", id="doc_id")} AS o, (is_test = 0)::INT AS use FROM labelled),
r AS (SELECT *, coalesce(sum(use * quality) OVER before, 0) AS s, coalesce(sum(use) OVER before, 0) AS n, sum(use * quality) OVER whole AS s_all, sum(use) OVER whole AS n_all
  FROM h WINDOW before AS (PARTITION BY lang ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), whole AS (PARTITION BY lang))
SELECT doc_id, lang, round(CASE WHEN use = 1 THEN (s + 0.5::DOUBLE) / (n + 1) ELSE (s_all + 0.5::DOUBLE) / (n_all + 1) END, 6) AS code FROM r""",
    "baseline_noise": "SELECT c_custkey, " + ", ".join(f"round(sqrt(-2 * ln(({HASH.format(seed=f'{42 + i}|0', id='c_custkey')} + 0.5::DOUBLE) / 4503599627370496::DOUBLE)) * cos(({HASH.format(seed=f'{42 + i}|1', id='c_custkey')} + 0.5::DOUBLE) / 4503599627370496::DOUBLE * 2 * 3.141592653589793::DOUBLE), 6) AS ft_{i + 1}" for i in range(5)) + " FROM customer",
    "enc_woe": f"WITH {LABELLED}, {WOE.format(b='lang', y='quality', t='labelled')} SELECT lang, pos, neg, round(ln(p / q), 6) AS woe FROM w",
    "enc_rare": "SELECT CASE WHEN n >= 120 THEN lang ELSE 'other' END AS grouped, sum(n)::BIGINT AS n FROM (SELECT lang, count(*) AS n FROM documents GROUP BY 1) GROUP BY 1",
    "ev_auc": f"WITH {LABELLED}, s AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, auc FROM ({auc('labelled', c, 'quality')})" for c in ("n_chars", "n_words", "is_test")) + ") SELECT feature, round(auc, 6) AS auc FROM s",
    "ev_gini": f"WITH {LABELLED} SELECT round(2 * auc - 1, 6) AS gini FROM ({auc('labelled', 'n_chars', 'toxic')})",
    "ev_auc_cv": f"WITH {LABELLED}, {FOLDS.format(t='labelled', y='quality')}, s AS ({auc('folded', 'n_chars', 'quality', 'fold')}) SELECT round(avg(auc), 6) AS mean_auc, round(stddev_pop(auc), 6) AS sd_auc FROM s",
    "ev_iv": f"WITH {BINNED}, {WOE.format(b='bin', y='quality', t='binned')} SELECT round(sum((p - q) * ln(p / q)), 6) AS iv FROM w",
    "ev_psi": f"WITH {BINNED}, {WOE.format(b='bin', y='is_test', t='binned')} SELECT round(sum((p - q) * ln(p / q)), 6) AS psi FROM w",
    "ev_mutual_info": f"WITH {BINNED}, j AS (SELECT bin, quality, count(*)::DOUBLE AS n FROM binned GROUP BY 1, 2), k AS (SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY bin) AS b, sum(n) OVER (PARTITION BY quality) AS y FROM j) SELECT round(sum(n / t * ln(n * t / (b * y))), 6) AS mi FROM k",
    "ev_corr_matrix": f"WITH {CUSTOMER} " + " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS corr FROM filled" for a, b in PAIRS),
    "ev_top_features": f"WITH {CUSTOMER}, s AS ({auc('long', 'value', 'y', 'feature')}) SELECT feature, round(abs(auc - 0.5::DOUBLE), 6) AS importance FROM s ORDER BY importance DESC, feature LIMIT 20",
    "ev_best_set": f"WITH {LABELLED}, l AS (SELECT doc_id % 5 AS fold, quality, set_id, x FROM (SELECT doc_id, quality, n_chars::DOUBLE AS n_chars, n_words::DOUBLE AS n_words FROM labelled) UNPIVOT (x FOR set_id IN (n_chars, n_words))), s AS ({auc('l', 'x', 'quality', 'set_id, fold')}), m AS (SELECT set_id, round(avg(auc), 6) AS mean_auc FROM s GROUP BY 1) SELECT set_id, mean_auc FROM m ORDER BY mean_auc DESC, set_id DESC LIMIT 1",
    "set_train_test_union": f"WITH {LABELLED} SELECT doc_id, CASE WHEN is_test = 0 THEN quality END AS quality, n_chars, CASE WHEN is_test = 0 THEN 'train' ELSE 'test' END AS part FROM labelled",
    "ev_sets_cv": f"{SETS} SELECT set_id, round(mean_auc, 6) AS mean_auc FROM m",
    "ev_forward_set": f"""{SETS}, one AS (SELECT set_id AS feature, mean_auc FROM m WHERE instr(set_id, '+') = 0 ORDER BY round(mean_auc, 9) DESC, 1 LIMIT 1),
two AS (SELECT replace(replace(set_id, feature, ''), '+', '') AS feature, m.mean_auc, one.mean_auc AS before FROM m, one WHERE instr(set_id, '+') > 0 AND instr(set_id, feature) > 0 ORDER BY round(m.mean_auc, 9) DESC, 1 LIMIT 1)
SELECT 1::BIGINT AS step, feature, round(mean_auc, 6) AS mean_auc FROM one UNION ALL SELECT 2, feature, round(mean_auc, 6) FROM two WHERE mean_auc - before >= 0.001""",
    "agg_grammar": f"SELECT o_custkey AS id, count(*)::DOUBLE AS orders_count, round(sum(o_totalprice), 2) AS orders_sum_o_totalprice, {GRAMMAR} FROM orders GROUP BY 1",
    "set_id_overlap": "SELECT count(*) AS n_shared FROM (SELECT doc_id FROM labels WHERE doc_id % 5 = 0 INTERSECT SELECT doc_id FROM labels WHERE doc_id % 5 <> 0)",
    "set_missing_ids": "SELECT count(*) AS n_missing FROM (SELECT doc_id FROM documents EXCEPT ALL SELECT doc_id FROM labels)",
    "contract_violations": f"""WITH {LABELLED}
SELECT 'empty_feature' AS rule, 'blank' AS column_name, 'train' AS detail UNION ALL
SELECT 'feature_names_differ', NULL, '[''n_chars'', ''blank''] [''n_chars'']' UNION ALL
SELECT 'id_missing', 'doc_id', 'test ' || count(*) FROM labelled WHERE is_test = 1 AND doc_id % 10 <> 0 HAVING count(*) > 0""",
    **{
        f"matrix_{k}": f"WITH {LABELLED}, e AS (SELECT lang, round((sum(quality) + 10 * (SELECT avg(quality) FROM labelled WHERE is_test = 0)) / (count(*) + 10), 6) AS lang_quality FROM labelled WHERE is_test = 0 GROUP BY 1) SELECT doc_id, {'quality, ' if k == 'train' else ''}n_chars, n_words, lang_quality FROM labelled LEFT JOIN e USING (lang) WHERE is_test = {int(k == 'test')}"
        for k in ("train", "test")
    },
    "stream_daily_counts": "SELECT ts::DATE AS day, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2",
    "stream_sessions": """
WITH g AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
s AS (SELECT *, sum(CASE WHEN before IS NULL OR ts - before >= INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, session""",
    "stream_last_event": """
SELECT event_id, user_id, (floor(epoch(ts)) - floor(epoch(lag(ts) OVER w)))::BIGINT AS gap_s, lag(event_type) OVER w AS last_type, round(lag(value) OVER w, 6) AS last_value, (lag(ts) OVER w IS NOT NULL)::BIGINT AS n_before
FROM events WHERE ts <= date_trunc('millisecond', (SELECT max(ts) FROM events)) - INTERVAL 1 DAY WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "stream_click_purchase": """
SELECT a.user_id, a.event_id AS first_id, b.event_id AS second_id, round((epoch_us(b.ts) - epoch_us(a.ts)) / 1000000::DOUBLE, 3) AS wait_s
FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'click' AND b.event_type = 'purchase' AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 3600 SECOND""",
    "agg_over_time": """
WITH o AS (SELECT o_custkey AS id, o_totalprice AS x, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) AS day, date_diff('day', o_orderdate::DATE, (SELECT max(o_orderdate)::DATE FROM orders)) AS age FROM orders)
SELECT id, round((max(day) - min(day))::DOUBLE / nullif(count(*) - 1, 0), 4) AS orders_gap_o_orderdate, min(age)::DOUBLE AS orders_recency_o_orderdate, round(sum(pow(0.5::DOUBLE, age / 30::DOUBLE)), 4) AS orders_decayed_count_o_orderdate,
       CASE WHEN max(day) > min(day) THEN round(regr_slope(x, day::DOUBLE), 4) END AS orders_slope_o_totalprice_o_orderdate, round(sum(x * pow(0.5::DOUBLE, age / 30::DOUBLE)), 4) AS orders_decayed_o_totalprice_o_orderdate
FROM o GROUP BY id""",
    "found_keys": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, '{','.join(k)}' AS key FROM (SELECT count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT {','.join(k)} FROM {n})) AS m FROM {n}) WHERE n = m"
        for n, k in (("orders", ["o_orderkey"]), ("lineitem", ["l_orderkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]), ("customer", ["c_custkey"]), ("customer", ["c_name"]), ("conversations", ["conv_id", "turn"]), ("labels", ["doc_id"]))
    ),
    "found_links": " UNION ALL ".join(
        f"SELECT '{c}' AS child, '{ck}' AS child_key, '{p}' AS parent, '{pk}' AS parent_key FROM (SELECT count(*) AS n FROM {c} WHERE {ck} NOT IN (SELECT {pk} FROM {p})) WHERE n = 0"
        for c, ck, p, pk in (("nation", "n_regionkey", "region", "r_regionkey"), ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"), ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"))
    ),
}
