"""DuckDB SQL oracles, one per checkable query key (same column names).

Each statement recomputes the key's result from the base tables with plain
SQL: the text fixtures are re-rendered with the same formatting rules, rule
checks are CASE expressions, model outputs of the exact (unbagged)
configurations are per-group class shares. Of bagged forests and of an
unordered LIMIT the statements give what does not depend on chance.
"""

from __future__ import annotations

# Plain decimal literal (same rule as functions.numeric.PLAIN_DECIMAL).
_RE = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _num(x: str) -> str:
    """strict_double over a text expression."""
    return f"(CASE WHEN regexp_matches(trim({x}), '{_RE}') THEN CAST(trim({x}) AS DOUBLE) END)"


def _fixed2(x: str) -> str:
    cents = f"CAST(ROUND({x} * 100) AS BIGINT)"
    return f"(CAST({cents} // 100 AS VARCHAR) || '.' || lpad(CAST({cents} % 100 AS VARCHAR), 2, '0'))"


ORDERS_HEADER = "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority,o_note"
ORDERS_TEXT = f"""orders_text AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
         o_orderstatus,
         CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN 'n/a'
              ELSE {_fixed2('o_totalprice')} END AS o_totalprice,
         strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
         CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE o_orderpriority END AS o_orderpriority,
         CASE WHEN o_orderkey % 5 = 0 THEN 'rush' ELSE '' END AS o_note,
         o_orderkey AS k
  FROM orders),
header_rows AS (SELECT 1 AS i FROM (SELECT count(*) AS n FROM orders) WHERE n > 0)"""
BAND = "CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'rest' END"
ORDERS_LINE = ("o_orderkey || ',' || o_custkey || ',' || o_orderstatus || ',' || o_totalprice || ',' || "
               "o_orderdate || ',' || o_orderpriority || ',' || o_note")
ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, o_note"
VALID_PRIORITY = "('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')"

LINEITEM_RAW = """lineitem_raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line_id,
         l_orderkey, l_linenumber,
         CASE WHEN l_orderkey % 7 = 0 THEN '' ELSE CAST(l_quantity AS VARCHAR) END AS l_quantity,
         l_extendedprice, l_discount, l_tax,
         CASE WHEN l_orderkey % 11 = 0 THEN '' ELSE l_returnflag END AS l_returnflag,
         l_linestatus, l_shipdate
  FROM lineitem)"""
LI_Q = f"CASE WHEN {_num('l_quantity')} BETWEEN 5 AND 45 THEN {_num('l_quantity')} END"
LI_D = "CASE WHEN l_discount BETWEEN 0.01 AND 0.08 THEN l_discount END"
LI_RF = "CASE WHEN l_returnflag IN ('A', 'N') THEN l_returnflag END"
LI_LS = "CASE WHEN l_linestatus IN ('F', 'O') THEN l_linestatus END"
LI_TAX = "CASE WHEN l_tax BETWEEN 0.0 AND 0.06 THEN l_tax END"
LI_EP = "CASE WHEN l_extendedprice BETWEEN 1000 AND 100000 THEN l_extendedprice END"
LI_SD = "CASE WHEN trim(CAST(l_shipdate AS VARCHAR)) <> '' THEN CAST(l_shipdate AS VARCHAR) END"


def _mode(expr: str, source: str) -> str:
    """Most frequent non-NULL value, ties -> lowest."""
    return (f"(SELECT v FROM (SELECT {expr} AS v, count(*) AS n FROM {source} WHERE {expr} IS NOT NULL "
            f"GROUP BY 1) ORDER BY n DESC, v LIMIT 1)")


def _rank(expr: str, source: str, name: str) -> str:
    """Index by descending frequency, ties alphabetical (StringIndexer)."""
    return (f"{name} AS (SELECT v, CAST(ROW_NUMBER() OVER (ORDER BY n DESC, v) - 1 AS INTEGER) AS idx "
            f"FROM (SELECT {expr} AS v, count(*) AS n FROM {source} WHERE {expr} IS NOT NULL GROUP BY 1))")


def _binary_tree(p: str, source: str, group: str, label: str) -> str:
    """CTEs for one unbagged tree over a single binary category: leaves are the
    two groups, or -- when both groups predict the same class -- one pooled
    leaf (Spark merges such siblings). Gives ``{p}_lab`` (v, idx) and
    ``{p}_pred`` (g, gn, p1, prediction, predictedLabel)."""
    return f"""{_rank(label, source, p + '_lab')},
{p}_groups AS (
  SELECT {group} AS g, count(*) FILTER (WHERE l.idx = 1) AS c1, count(*) FILTER (WHERE l.idx = 0) AS c0,
         count(*) AS n
  FROM {source} JOIN {p}_lab l ON {label} = l.v GROUP BY 1),
{p}_pool AS (
  SELECT sum(c1) AS c1, sum(c0) AS c0, sum(n) AS n,
         count(DISTINCT CASE WHEN c1 > c0 THEN 1 ELSE 0 END) = 1 AS merged FROM {p}_groups),
{p}_leaf AS (
  SELECT g.g, g.n AS gn,
         CASE WHEN m.merged THEN m.c1 ELSE g.c1 END AS c1, CASE WHEN m.merged THEN m.c0 ELSE g.c0 END AS c0,
         CASE WHEN m.merged THEN m.n ELSE g.n END AS n
  FROM {p}_groups g, {p}_pool m),
{p}_pred AS (
  SELECT f.g, f.gn, CAST(f.c1 AS DOUBLE) / f.n AS p1,
         CAST(CASE WHEN f.c1 > f.c0 THEN 1 ELSE 0 END AS DOUBLE) AS prediction, d.v AS predictedLabel
  FROM {p}_leaf f JOIN {p}_lab d ON d.idx = CASE WHEN f.c1 > f.c0 THEN 1 ELSE 0 END)"""


LI_FILL = f"""li_typed AS (SELECT {_num('l_quantity')} AS q, l_discount AS d,
                    NULLIF(trim(l_returnflag), '') AS rf, NULLIF(trim(l_linestatus), '') AS ls
             FROM lineitem_raw),
fill AS (SELECT (SELECT avg(q) FROM li_typed) AS q, (SELECT avg(d) FROM li_typed) AS d,
                {_mode('rf', 'li_typed')} AS rf, {_mode('ls', 'li_typed')} AS ls)"""

# lineitem labelled for the exact tree: label by quantity vs. a per-status limit.
LI_LABELLED = """li_lab AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line_id,
         l_orderkey, l_linenumber, l_linestatus,
         CASE WHEN l_quantity > CASE WHEN l_linestatus = 'F' THEN 20 ELSE 30 END
              THEN 'big' ELSE 'small' END AS size_band
  FROM lineitem)"""
LI_TREE = LI_LABELLED + ",\n" + _binary_tree("lt", "li_lab", "l_linestatus", "size_band") + """,
li_scored AS (
  SELECT li_lab.*, p.prediction, round(p.p1, 9) AS probability, p.predictedLabel
  FROM li_lab JOIN lt_pred p ON li_lab.l_linestatus = p.g)"""

# orders exact flow: train on all text rows (finished or not), categorical priority only.
EXACT_PRIORITY = "('1-URGENT', '4-NOT SPECIFIED')"
ORDERS_TREE = ORDERS_TEXT + """,
o_train AS (SELECT """ + BAND + """ AS status_band,
                   CASE WHEN o_orderpriority IN """ + EXACT_PRIORITY + """ THEN o_orderpriority END AS pri
            FROM orders_text),
o_mode AS (SELECT """ + _mode("pri", "o_train") + """ AS m),
o_train_f AS (SELECT status_band, coalesce(pri, (SELECT m FROM o_mode)) AS pri FROM o_train),
""" + _binary_tree("o", "o_train_f", "pri", "status_band") + """,
o_result AS (
  SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus, t.o_totalprice, t.o_orderdate,
         t.o_orderpriority, t.o_note, p.prediction, p.predictedLabel, round(p.p1, 9) AS probability
  FROM orders_text t
  JOIN o_pred p ON p.g = coalesce(CASE WHEN t.o_orderpriority IN """ + EXACT_PRIORITY + """
                                       THEN t.o_orderpriority END, (SELECT m FROM o_mode)))"""

# orders feature pipeline (F8/F9): price filled with the training mean, priority with the mode.
ORDERS_FEATS = ORDERS_TEXT + f""",
f_train AS (SELECT o_orderkey, {BAND} AS status_band, {_num('o_totalprice')} AS p,
                   NULLIF(trim(o_orderpriority), '') AS pri
            FROM orders_text),
f_fill AS (SELECT avg(p) AS mean_p, {_mode('pri', 'f_train')} AS mode_pri FROM f_train),
f_filled AS (SELECT o_orderkey, status_band, coalesce(p, mean_p) AS p, coalesce(pri, mode_pri) AS pri
             FROM f_train, f_fill),
f_mm AS (SELECT min(p) AS mn, max(p) AS mx FROM f_filled),
{_rank('pri', 'f_filled', 'f_pri')},
{_rank('status_band', 'f_filled', 'f_lab')}"""

EVENTS_BAND = ("CASE WHEN value > CASE WHEN event_type IN ('click', 'view') THEN 20 ELSE 80 END "
               "THEN 'high' ELSE 'low' END")
EVENTS_TEXT = f"""events_text AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
         CAST(user_id AS VARCHAR) AS user_id, event_type, {_fixed2('value')} AS value, props,
         {EVENTS_BAND} AS value_band
  FROM events)"""
EXACT_TYPES = "('click', 'purchase')"
EVENTS_TREE = EVENTS_TEXT + """,
e_train AS (SELECT CASE WHEN event_type IN """ + EXACT_TYPES + """ THEN event_type END AS et, value_band
            FROM events_text),
e_mode AS (SELECT """ + _mode("et", "e_train") + """ AS m),
e_train_f AS (SELECT coalesce(et, (SELECT m FROM e_mode)) AS et, value_band FROM e_train),
""" + _binary_tree("e", "e_train_f", "et", "value_band")


def _entries(id_expr: str, value_expr: str, slot: str, source: str) -> str:
    return (f"SELECT {id_expr}, CAST({slot} AS INTEGER) AS slot, round({value_expr}, 9) AS value "
            f"FROM {source}")


def _one_hot_slots(columns: str, source: str, index: str, vocabulary: str, first: int) -> str:
    """A row for every slot of a one-hot block that starts at slot ``first``."""
    return (f"SELECT {columns}, CAST({first} + v.idx AS INTEGER) AS slot, "
            f"CAST(CASE WHEN v.idx = {index} THEN 1 ELSE 0 END AS DOUBLE) AS value FROM {source}, {vocabulary} v")


SQL: dict[str, str] = {}

# ------------------------------------------------------------------ sources
SQL["src_text_scan"] = f"""WITH {ORDERS_TEXT}
SELECT DISTINCT {ORDERS_LINE} AS value FROM orders_text
UNION ALL SELECT '{ORDERS_HEADER}' AS value FROM header_rows"""

SQL["src_split_fields"] = f"""WITH {ORDERS_TEXT}
SELECT DISTINCT o_orderkey AS f_first, 7 AS n_fields, o_note AS f_last FROM orders_text
UNION ALL SELECT 'o_orderkey', 7, 'o_note' FROM header_rows"""

SQL["src_header_names"] = f"""SELECT CAST(i AS INTEGER) AS position, split('{ORDERS_HEADER}', ',')[i + 1] AS name
FROM (SELECT unnest(range(7)) AS i FROM (SELECT count(*) FROM orders))"""

SQL["src_drop_repeated_headers"] = f"""WITH {ORDERS_TEXT}
SELECT {ORDERS_LINE} AS value FROM orders_text"""

SQL["src_all_string_table"] = f"""WITH {ORDERS_TEXT}
SELECT {ORDERS_COLS} FROM orders_text"""

SQL["src_typed_table"] = f"""WITH {ORDERS_TEXT}
SELECT o_orderkey, o_custkey, o_orderstatus, {_num('o_totalprice')} AS o_totalprice, o_orderdate,
       o_orderpriority, o_note FROM orders_text"""

SQL["src_positional_cast"] = f"""WITH {ORDERS_TEXT}
SELECT {_num('o_orderkey')} AS o_orderkey, {_num('o_custkey')} AS o_custkey, o_orderstatus,
       {_num('o_totalprice')} AS o_totalprice, o_orderdate, o_orderpriority, o_note FROM orders_text"""

SQL["src_contract_schema"] = f"""WITH {ORDERS_TEXT}
SELECT o_orderkey, {_num('o_totalprice')} AS o_totalprice, o_orderpriority FROM orders_text"""

SQL["src_csv_inferred"] = f"""WITH {ORDERS_TEXT}
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
       o_orderstatus, NULLIF(o_totalprice, '') AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       NULLIF(o_orderpriority, '') AS o_orderpriority, NULLIF(o_note, '') AS o_note FROM orders_text"""

SQL["fn_strict_numeric"] = f"""WITH {ORDERS_TEXT},
spelled AS (
  SELECT o_orderkey,
         CASE WHEN k % 17 = 0 THEN 'nan' WHEN k % 19 = 0 THEN 'inf'
              WHEN k % 23 = 0 THEN o_totalprice || 'd'
              WHEN k % 29 = 0 THEN replace(o_totalprice, '.', '_')
              WHEN k % 3 = 0 THEN ' ' || o_totalprice || ' '
              ELSE o_totalprice END AS text
  FROM orders_text)
SELECT o_orderkey, text, {_num('text')} AS number FROM spelled"""

SQL["fn_source_file_name"] = """SELECT 'half=' || CAST(o_orderkey % 2 AS VARCHAR) AS folder, 'part' AS prefix,
       'csv' AS extension, true AS ends_path, count(*) AS n_lines FROM orders GROUP BY 1"""

# -------------------------------------------------------------- projections
SQL["proj_required_columns"] = f"""WITH {LINEITEM_RAW}
SELECT line_id, l_quantity, l_discount, l_returnflag, l_linestatus FROM lineitem_raw"""

SQL["proj_all_but_plus"] = f"""WITH {LINEITEM_RAW}
SELECT line_id, l_orderkey, l_linenumber, l_extendedprice, l_tax, l_returnflag, l_linestatus, l_shipdate,
       l_extendedprice * (1 - l_discount) AS disc_price FROM lineitem_raw"""

SQL["proj_rename_columns"] = """SELECT l_orderkey, l_linenumber, l_extendedprice AS price_usd, l_tax AS tax_rate
FROM lineitem"""

# ------------------------------------------------------------- data quality
SQL["dq_missing_columns"] = """SELECT count(*) AS n_rows, 1 AS n_missing, 'o_orderpriority' AS missing,
       CASE WHEN count(*) = 0 THEN 1 ELSE 2 END AS status FROM orders"""

SQL["dq_batch_status"] = """SELECT 'full' AS input, count(*) AS n_rows, 7 AS n_columns, 0 AS n_missing,
       CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS status FROM orders
UNION ALL SELECT 'empty', CAST(0 AS BIGINT), 7, 0, 1
UNION ALL SELECT 'short', count(*), 6, 1, CASE WHEN count(*) = 0 THEN 1 ELSE 2 END FROM orders"""

SQL["dq_range_to_null"] = f"""WITH {LINEITEM_RAW}
SELECT l_orderkey, l_linenumber, {LI_Q} AS l_quantity, {LI_D} AS l_discount FROM lineitem_raw"""

SQL["dq_enum_to_null"] = f"""WITH {LINEITEM_RAW}
SELECT l_orderkey, l_linenumber, {LI_RF} AS l_returnflag, {LI_LS} AS l_linestatus FROM lineitem_raw"""

SQL["dq_validate_row"] = f"""WITH {LINEITEM_RAW}
SELECT line_id, {LI_Q} AS l_quantity, {LI_D} AS l_discount, {LI_RF} AS l_returnflag,
       {LI_LS} AS l_linestatus FROM lineitem_raw"""

SQL["dq_fill_nulls"] = f"""WITH {LINEITEM_RAW}, {LI_FILL}
SELECT line_id, round(coalesce({LI_Q}, fill.q), 7) AS l_quantity, round(coalesce({LI_D}, fill.d), 7) AS l_discount,
       coalesce({LI_RF}, fill.rf) AS l_returnflag, coalesce({LI_LS}, fill.ls) AS l_linestatus
FROM lineitem_raw, fill"""

SQL["dq_check_and_fill"] = f"""WITH {ORDERS_TEXT},
tr AS (SELECT {_num('o_totalprice')} AS p, NULLIF(trim(o_orderpriority), '') AS pri
       FROM orders_text),
fill AS (SELECT avg(p) AS p, {_mode('pri', 'tr')} AS pri FROM tr)
SELECT o_orderkey,
       round(coalesce(CASE WHEN {_num('o_totalprice')} BETWEEN 10000 AND 400000 THEN {_num('o_totalprice')} END,
                      fill.p), 7) AS o_totalprice,
       coalesce(CASE WHEN o_orderpriority IN {VALID_PRIORITY} THEN o_orderpriority END, fill.pri) AS o_orderpriority
FROM orders_text, fill"""

SQL["dq_extended_rules"] = f"""WITH {LINEITEM_RAW}
SELECT line_id, {LI_Q} AS l_quantity, {LI_D} AS l_discount, {LI_RF} AS l_returnflag, {LI_LS} AS l_linestatus,
       {LI_TAX} AS l_tax, {LI_EP} AS l_extendedprice, {LI_SD} AS l_shipdate FROM lineitem_raw"""

SQL["dq_exception_fields"] = f"""WITH {LINEITEM_RAW},
c AS (SELECT count(*) FILTER (WHERE ({LI_Q}) IS NULL) AS q, count(*) FILTER (WHERE ({LI_D}) IS NULL) AS d,
             count(*) FILTER (WHERE ({LI_RF}) IS NULL) AS rf, count(*) FILTER (WHERE ({LI_LS}) IS NULL) AS ls,
             count(*) FILTER (WHERE ({LI_TAX}) IS NULL) AS tx, count(*) FILTER (WHERE ({LI_EP}) IS NULL) AS ep,
             count(*) FILTER (WHERE ({LI_SD}) IS NULL) AS sd FROM lineitem_raw)
SELECT field, n_bad FROM (
  SELECT 'l_quantity' AS field, q AS n_bad FROM c UNION ALL SELECT 'l_discount', d FROM c
  UNION ALL SELECT 'l_returnflag', rf FROM c UNION ALL SELECT 'l_linestatus', ls FROM c
  UNION ALL SELECT 'l_tax', tx FROM c UNION ALL SELECT 'l_extendedprice', ep FROM c
  UNION ALL SELECT 'l_shipdate', sd FROM c) WHERE n_bad > 0"""

# --------------------------------------------------------------- statistics
SQL["agg_batch_profile"] = "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem"

SQL["agg_describe"] = " UNION ALL ".join(
    f"SELECT '{c}' AS field, count({c}) AS count, round(avg({c}), 7) AS mean, "
    f"round(stddev_samp({c}), 7) AS stddev, min({c}) AS min, max({c}) AS max FROM lineitem"
    for c in ("l_quantity", "l_discount", "l_tax"))

SQL["agg_numeric_mean"] = "SELECT round(avg(value), 7) AS value, round(avg(user_id), 7) AS user_id FROM events"

SQL["agg_value_counts"] = """SELECT 'lang' AS field, lang AS value, count(*) AS n FROM documents
WHERE lang IS NOT NULL GROUP BY lang
UNION ALL SELECT 'source', source, count(*) FROM documents WHERE source IS NOT NULL GROUP BY source"""

SQL["agg_mode"] = """SELECT field, value, n FROM (
  SELECT field, value, n, ROW_NUMBER() OVER (PARTITION BY field ORDER BY n DESC, value) AS rn FROM (
    SELECT 'lang' AS field, lang AS value, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang
    UNION ALL SELECT 'source', source, count(*) FROM documents WHERE source IS NOT NULL GROUP BY source))
WHERE rn = 1"""

SQL["agg_fill_values"] = f"""WITH {LINEITEM_RAW}, {LI_FILL}
SELECT 'l_quantity' AS field, round(q, 7) AS num_value, CAST(NULL AS VARCHAR) AS cat_value FROM fill
UNION ALL SELECT 'l_discount', round(d, 7), NULL FROM fill
UNION ALL SELECT 'l_returnflag', NULL, rf FROM fill
UNION ALL SELECT 'l_linestatus', NULL, ls FROM fill"""

SQL["fit_minmax"] = " UNION ALL ".join(
    f"SELECT '{c}' AS field, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))

# ----------------------------------------------------------------- features
SQL["fit_string_index"] = f"""WITH {ORDERS_TEXT},
t AS (SELECT NULLIF(trim(o_orderpriority), '') AS pri, NULLIF(trim(o_orderstatus), '') AS st FROM orders_text),
{_rank('pri', 't', 'r1')}, {_rank('st', 't', 'r2')}
SELECT 'o_orderpriority' AS field, v AS value, idx FROM r1
UNION ALL SELECT 'o_orderstatus', v, idx FROM r2"""

SQL["feat_label_encode_fit"] = f"""WITH {_rank('o_orderpriority', 'orders', 'r1')}, {_rank('o_orderstatus', 'orders', 'r2')}
SELECT o_orderkey, CAST(r1.idx AS DOUBLE) AS o_orderpriority_t, CAST(r2.idx AS DOUBLE) AS o_orderstatus_t
FROM orders JOIN r1 ON o_orderpriority = r1.v JOIN r2 ON o_orderstatus = r2.v"""

SQL["feat_large_vocabulary"] = f"""WITH tr AS (SELECT CAST(l_partkey AS VARCHAR) AS p, CAST(l_orderkey AS VARCHAR) AS o FROM lineitem WHERE l_orderkey % 2 = 0),
{_rank('p', 'tr', 'r1')}, {_rank('o', 'tr', 'r2')}
SELECT l_partkey, l_orderkey, l_linenumber, CAST(coalesce(r1.idx, (SELECT count(*) FROM r1)) AS DOUBLE) AS l_partkey_t,
       CAST(coalesce(r2.idx, (SELECT count(*) FROM r2)) AS DOUBLE) AS l_orderkey_t
FROM lineitem LEFT JOIN r1 ON CAST(l_partkey AS VARCHAR) = r1.v LEFT JOIN r2 ON CAST(l_orderkey AS VARCHAR) = r2.v"""

SQL["feat_label_encode_apply"] = f"""WITH tr AS (SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O')),
{_rank('o_orderpriority', 'tr', 'r1')}, {_rank('o_orderstatus', 'tr', 'r2')}
SELECT o_orderkey,
       CAST(coalesce(r1.idx, (SELECT count(*) FROM r1)) AS DOUBLE) AS o_orderpriority_t,
       CAST(coalesce(r2.idx, (SELECT count(*) FROM r2)) AS DOUBLE) AS o_orderstatus_t
FROM orders LEFT JOIN r1 ON o_orderpriority = r1.v LEFT JOIN r2 ON o_orderstatus = r2.v"""

SQL["feat_label_index"] = f"""WITH {LI_LABELLED}, {_rank('size_band', 'li_lab', 'r')}
SELECT l_orderkey, l_linenumber, CAST(idx AS DOUBLE) AS label FROM li_lab JOIN r ON size_band = v"""

SQL["feat_assemble_numeric"] = (
    _entries("o_orderkey", "o_totalprice", "0", "orders") + " UNION ALL " +
    _entries("o_orderkey", "CAST(o_custkey AS DOUBLE)", "1", "orders"))

SQL["feat_minmax_scale"] = f"""WITH mm AS (SELECT min(o_totalprice) AS p0, max(o_totalprice) AS p1,
                   CAST(min(o_custkey) AS DOUBLE) AS c0, CAST(max(o_custkey) AS DOUBLE) AS c1 FROM orders),
s AS (SELECT o_orderkey, (o_totalprice - p0) * (1.0 / (p1 - p0)) AS a,
             (o_custkey - c0) * (1.0 / (c1 - c0)) AS b FROM orders, mm)
{_entries('o_orderkey', 'a', '0', 's')} UNION ALL {_entries('o_orderkey', 'b', '1', 's')}"""

SQL["feat_one_hot"] = f"""WITH {_rank('o_orderpriority', 'orders', 'r1')}, {_rank('o_orderstatus', 'orders', 'r2')}
SELECT o_orderkey, 'o_orderpriority' AS field, idx AS slot, CAST(1.0 AS DOUBLE) AS value,
       (SELECT CAST(count(*) AS INTEGER) FROM r1) AS size FROM orders JOIN r1 ON o_orderpriority = v
UNION ALL SELECT o_orderkey, 'o_orderstatus', idx, CAST(1.0 AS DOUBLE), (SELECT CAST(count(*) AS INTEGER) FROM r2)
FROM orders JOIN r2 ON o_orderstatus = v"""

SQL["feat_assemble_all"] = f"""WITH mm AS (SELECT min(o_totalprice) AS p0, max(o_totalprice) AS p1 FROM orders),
{_rank('o_orderpriority', 'orders', 'r1')},
s AS (SELECT o_orderkey, (o_totalprice - p0) * (1.0 / (p1 - p0)) AS a FROM orders, mm)
{_entries('o_orderkey', 'a', '0', 's')}
UNION ALL {_one_hot_slots('o_orderkey', '(SELECT * FROM orders JOIN r1 ON o_orderpriority = v) o', 'o.idx', 'r1', 1)}"""

SQL["feat_pipeline_fit"] = f"""WITH {ORDERS_FEATS},
s AS (SELECT f.o_orderkey, (f.p - mn) * (1.0 / (mx - mn)) AS a, CAST(l.idx AS DOUBLE) AS label, r.idx AS pidx
      FROM f_filled f, f_mm JOIN f_pri r ON f.pri = r.v JOIN f_lab l ON f.status_band = l.v)
SELECT o_orderkey, label, 0 AS slot, round(a, 9) AS value FROM s
UNION ALL {_one_hot_slots('o_orderkey, label', 's', 's.pidx', 'f_pri', 1)}"""

SQL["feat_pipeline_apply"] = f"""WITH {ORDERS_FEATS},
sc AS (SELECT o_orderkey,
              coalesce(CASE WHEN {_num('o_totalprice')} BETWEEN 10000 AND 400000 THEN {_num('o_totalprice')} END,
                       mean_p) AS p,
              coalesce(CASE WHEN o_orderpriority IN {VALID_PRIORITY} THEN o_orderpriority END, mode_pri) AS pri
       FROM orders_text, f_fill),
s AS (SELECT sc.o_orderkey, (sc.p - mn) * (1.0 / (mx - mn)) AS a, r.idx AS pidx
      FROM sc, f_mm JOIN f_pri r ON sc.pri = r.v)
SELECT o_orderkey, 0 AS slot, round(a, 9) AS value FROM s
UNION ALL {_one_hot_slots('o_orderkey', 's', 's.pidx', 'f_pri', 1)}"""

SQL["feat_labeled_rows"] = f"""WITH {LI_LABELLED}, {_rank('size_band', 'li_lab', 'r')}, {_rank('l_linestatus', 'li_lab', 's')}
{_one_hot_slots('l_orderkey, l_linenumber, label',
                '(SELECT l_orderkey, l_linenumber, CAST(r.idx AS DOUBLE) AS label, s.idx FROM li_lab '
                'JOIN r ON size_band = r.v JOIN s ON l_linestatus = s.v) x', 'x.idx', 's', 0)}"""

# -------------------------------------------------------------------- model
SQL["ml_forest_train"] = f"""WITH {LI_TREE}
SELECT g AS l_linestatus, gn AS n, round(p1, 9) AS probability, prediction FROM lt_pred"""

SQL["ml_forest_score"] = f"""WITH {LI_TREE}
SELECT l_orderkey, l_linenumber, prediction, predictedLabel, probability FROM li_scored"""

SQL["ml_forest_configs"] = """SELECT CAST(seed AS INTEGER) AS seed, 100 AS n_trees, 8 AS max_depth, 'onethird' AS subset,
       'gini' AS impurity, CAST(2 + count(DISTINCT l_returnflag) + count(DISTINCT l_linestatus) AS INTEGER) AS n_features,
       2 AS n_classes, true AS within_depth, count(*) AS n_rows, count(*) AS n_consistent
FROM lineitem, (VALUES (10), (20)) s(seed) GROUP BY seed"""

SQL["ml_probability"] = f"""WITH {LI_TREE}
SELECT l_orderkey, l_linenumber, probability FROM li_scored"""

SQL["ml_label_decode"] = f"""WITH {LI_TREE}
SELECT l_orderkey, l_linenumber, predictedLabel FROM li_scored"""

SQL["eval_confusion_matrix"] = f"""WITH {LI_TREE}
SELECT CAST(l.idx AS DOUBLE) AS label, s.prediction, count(*) AS n
FROM li_scored s JOIN lt_lab l ON s.size_band = l.v GROUP BY 1, 2"""

# A9 on held-out rows: the tree is fitted on the others.
LI_HELD_OUT = LI_LABELLED + """,
li_split AS (SELECT *, CAST('0x' || md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR))[1:8] AS BIGINT) % 1000 < 200 AS held
             FROM li_lab),
li_learnt AS (SELECT * FROM li_split WHERE NOT held),
""" + _binary_tree("ho", "li_learnt", "l_linestatus", "size_band") + """,
ho_scored AS (SELECT l.idx AS label, CAST(p.prediction AS INTEGER) AS prediction, p.p1
              FROM li_split s JOIN ho_pred p ON s.l_linestatus = p.g JOIN ho_lab l ON s.size_band = l.v WHERE s.held)"""
SQL["eval_ranking"] = f"""WITH {LI_HELD_OUT},
b AS (SELECT least(floor(p1 * 10000), 9999) AS bin, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg FROM ho_scored GROUP BY 1),
c AS (SELECT *, sum(pos) OVER (ORDER BY bin DESC) AS tp, sum(neg) OVER (ORDER BY bin DESC) AS fp FROM b)
SELECT CAST(sum(pos) AS BIGINT) AS n_positive, CAST(sum(neg) AS BIGINT) AS n_negative,
       round(sum(neg * (tp - pos / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 9) AS roc_auc,
       round(sum(CAST(pos AS DOUBLE) * tp / (tp + fp)) / sum(pos), 9) AS average_precision FROM c"""
SQL["eval_per_class"] = f"""WITH {LI_HELD_OUT},
k AS (SELECT DISTINCT label AS class FROM ho_scored UNION SELECT DISTINCT prediction FROM ho_scored),
c AS (SELECT class, count(*) FILTER (label = class) AS n_rows, count(*) FILTER (prediction = class) AS n_predicted,
             count(*) FILTER (label = class AND prediction = class) AS n_right FROM k, ho_scored GROUP BY class)
SELECT CAST(class AS DOUBLE) AS class, n_rows, n_predicted, n_right,
       round(CASE WHEN n_predicted > 0 THEN CAST(n_right AS DOUBLE) / n_predicted END, 9) AS "precision",
       round(CASE WHEN n_rows > 0 THEN CAST(n_right AS DOUBLE) / n_rows END, 9) AS recall,
       round(2.0 * n_right / (n_rows + n_predicted), 9) AS f1 FROM c"""

SQL["ml_model_roundtrip"] = f"""WITH {LI_TREE}
SELECT l_orderkey, l_linenumber, prediction, probability FROM li_scored"""

# --------------------------------------------------------------------- flow
SQL["flow_score_batch"] = f"""WITH {ORDERS_TREE}
SELECT {ORDERS_COLS}, prediction, predictedLabel, probability FROM o_result"""

SQL["join_project_result"] = SQL["flow_score_batch"]

SQL["flow_append_prediction"] = SQL["flow_score_batch"]

SQL["flow_forest_score"] = f"""WITH {ORDERS_TEXT}
SELECT {ORDERS_COLS}, true AS well_formed FROM orders_text"""

SQL["limit_preview"] = """SELECT least(count(*), 5) AS n_shown, least(count(*), 5) AS n_in_batch FROM orders"""

SQL["join_left_outer_result"] = f"""WITH {LINEITEM_RAW}, {LI_TREE},
li_res AS (SELECT DISTINCT l.*, p.prediction, p.predictedLabel, round(p.p1, 9) AS probability
           FROM lineitem_raw l JOIN lt_pred p ON l.l_linestatus = p.g)
SELECT l.line_id, l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax,
       l.l_returnflag, l.l_linestatus, l.l_shipdate, r.prediction, r.predictedLabel, r.probability
FROM lineitem_raw l LEFT JOIN li_res r
  ON l.line_id IS NOT DISTINCT FROM r.line_id
  AND l.l_orderkey IS NOT DISTINCT FROM r.l_orderkey
  AND l.l_linenumber IS NOT DISTINCT FROM r.l_linenumber
  AND l.l_quantity IS NOT DISTINCT FROM r.l_quantity
  AND l.l_extendedprice IS NOT DISTINCT FROM r.l_extendedprice
  AND l.l_discount IS NOT DISTINCT FROM r.l_discount
  AND l.l_tax IS NOT DISTINCT FROM r.l_tax
  AND l.l_returnflag IS NOT DISTINCT FROM r.l_returnflag
  AND l.l_linestatus IS NOT DISTINCT FROM r.l_linestatus
  AND l.l_shipdate IS NOT DISTINCT FROM r.l_shipdate"""

# -------------------------------------------------------------------- sinks
_EV_COLS = "event_id, ts, user_id, event_type, value, props, value_band"

SQL["sink_delimited_text"] = f"""WITH {EVENTS_TEXT}
SELECT concat_ws(',', {_EV_COLS}) AS value FROM events_text"""

SQL["sink_json"] = f"""WITH {EVENTS_TEXT}
SELECT {_EV_COLS} FROM events_text"""

SQL["sink_csv_header"] = SQL["sink_json"]

SQL["sink_parquet_time_cell"] = f"""WITH {EVENTS_TEXT}
SELECT ts, user_id, value_band FROM events_text"""

SQL["sink_time_cell_judgement"] = f"""WITH {EVENTS_TEXT}
SELECT ts[1:13] AS hour, event_type,
       CASE WHEN count(*) FILTER (value_band = 'low') > 0 THEN 'low' ELSE 'high' END AS value_band
FROM events_text GROUP BY ts[1:13], event_type"""

SQL["sink_single_file"] = """SELECT 'event_type' AS field, event_type AS value, count(*) AS n, 1 AS n_files
FROM events WHERE event_type IS NOT NULL GROUP BY event_type"""

SQL["sink_per_source_file"] = """SELECT event_type AS source, CAST(event_id AS VARCHAR) AS event_id,
       CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS event_type
FROM events"""

# ---------------------------------------------------------------- streaming
SQL["stream_landing_files"] = "SELECT DISTINCT event_type AS kind FROM events UNION SELECT 'none'"

SQL["stream_score_files"] = f"""WITH {EVENTS_TREE}
SELECT t.event_id, t.event_type, p.prediction, p.predictedLabel, round(p.p1, 9) AS probability
FROM events_text t
JOIN e_pred p ON p.g = coalesce(CASE WHEN t.event_type IN {EXACT_TYPES} THEN t.event_type END,
                                (SELECT m FROM e_mode))
WHERE t.event_type <> 'view'"""

SQL["stream_repeated_headers"] = """SELECT event_type AS kind, CAST(count(*) AS BIGINT) AS n_counted,
       CAST(count(*) AS BIGINT) AS n_handed_on FROM events GROUP BY event_type
UNION ALL SELECT 'none', CAST(0 AS BIGINT), CAST(0 AS BIGINT)"""

SQL["stream_batch_metrics"] = """SELECT event_type AS kind, CASE WHEN event_type = 'view' THEN 2 ELSE 0 END AS status,
       CAST(count(*) AS BIGINT) AS n_rows FROM events GROUP BY event_type
UNION ALL SELECT 'none', 1, CAST(0 AS BIGINT)"""

SQL["stream_quarantine"] = """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
       2 AS status FROM events WHERE event_type = 'view'"""

SQL["stream_archive_source"] = """SELECT event_type AS kind, count(*) AS n_rows FROM events GROUP BY event_type"""


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
