"""The same results in plain SQL over the given tables."""

from __future__ import annotations

from checks import fixtures as fx

ORACLE: dict[str, str] = {}

NEW, OLD = f"new AS ({fx.NEW_ORDERS})", "old AS (SELECT * FROM orders)"
BOTH = f"WITH {NEW}, {OLD} "
DELTA = "delta AS (SELECT * FROM new WHERE o_orderdate >= TIMESTAMP '2000-01-01' OR o_orderdate IS NULL)"
COMMON = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
OLD_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

# -- sources ----------------------------------------------------------------

ORACLE["read_pages"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, CAST(o_totalprice AS VARCHAR) AS price,
       '{"id":' || o_custkey || '}' AS who
FROM orders WHERE o_orderstatus <> 'P'
UNION ALL
SELECT CAST(-o_orderkey - 1 AS VARCHAR), NULL, NULL, NULL FROM orders WHERE o_orderstatus <> 'P'
"""
ORACLE["read_page_files"] = ORACLE["read_pages"].replace("""'{"id":' || o_custkey || '}'""", """'{"id":"' || o_custkey || '"}'""")
ORACLE["quarantine_pages"] = """
SELECT o_orderpriority AS table_name, o_orderkey AS skip,
       CASE o_orderstatus WHEN 'P' THEN 'unreadable' ELSE 'absent' END AS reason
FROM orders WHERE o_orderstatus IN ('P', 'F')
"""
ORACLE["expected_pages"] = """
SELECT table_name, unnest(range(0, total + 1, 100)) AS skip, CAST(100 AS BIGINT) AS top
FROM (SELECT CAST(l_suppkey AS VARCHAR) AS table_name, count(*) AS total FROM lineitem GROUP BY 1)
"""
ORACLE["reconcile_counts"] = """
WITH counted AS (
  SELECT 'T' || o_custkey AS table_name, count(*) AS total,
         count(*) FILTER (WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')) AS landed
  FROM orders GROUP BY 1)
SELECT table_name, CASE WHEN landed > 0 THEN total END AS reported, landed,
       landed > 0 AND total = landed AS complete
FROM counted
"""
ORACLE["version_roundtrip"] = BOTH + f"""
SELECT *, 'current' AS seen_as FROM new
UNION ALL SELECT {OLD_COLUMNS}, NULL, 'first' FROM old
"""
_DECLARED = """
SELECT c_name AS "table", 'Id' AS "column", 'Int64' AS edm_type FROM customer
UNION ALL
SELECT c_name, 'c' || c_nationkey,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Boolean' WHEN 'FURNITURE' THEN 'DateTime'
            WHEN 'MACHINERY' THEN 'Decimal' WHEN 'HOUSEHOLD' THEN 'Guid' ELSE 'Stream' END
FROM customer
"""
ORACLE["declared_types"] = _DECLARED
ORACLE["map_declared_types"] = f"""
SELECT *, CASE edm_type WHEN 'Boolean' THEN 'logical' WHEN 'DateTime' THEN 'timestamp' WHEN 'Decimal' THEN 'numeric'
                        WHEN 'Int64' THEN 'numeric' WHEN 'Guid' THEN 'character' END AS class
FROM ({_DECLARED})
"""
ORACLE["apply_declared_types"] = """
SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal,
       c_mktsegment = 'BUILDING' AS c_mktsegment
FROM customer
"""
ORACLE["snapshot_all"] = """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment,
       'customer' AS table_name, '20020102_030405' AS label FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'supplier', '20020102_030405' FROM supplier
"""

# -- projections and filters --------------------------------------------------

ORACLE["incremental_filter"] = f"WITH {NEW}, {DELTA} SELECT * FROM delta"
ORACLE["select_keys"] = "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem"
ORACLE["common_columns"] = BOTH + f"SELECT {OLD_COLUMNS} FROM new UNION ALL SELECT {OLD_COLUMNS} FROM old"
ORACLE["cast_all_to_string"] = "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM lineitem"
ORACLE["normalize_column_names"] = """
SELECT c_custkey AS cust_key, c_name AS strassen_name, c_nationkey AS number_nation, c_acctbal AS percent_balance,
       c_mktsegment AS who_region
FROM customer
"""
ORACLE["rename_by_synonyms"] = """
SELECT c_custkey AS customer_key, c_name, c_nationkey, c_acctbal AS account_balance, c_mktsegment FROM customer
"""
ORACLE["drop_empty_rows"] = "SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING'"
ORACLE["drop_empty_columns"] = """
SELECT CAST(COLUMNS(*) AS VARCHAR) FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL FROM customer WHERE c_mktsegment = 'BUILDING'
"""

# -- joins --------------------------------------------------------------------

_UPSERT = f"""
WITH {NEW}, {OLD}, {DELTA}, merged AS (
  SELECT * FROM delta
  UNION
  SELECT {OLD_COLUMNS}, NULL FROM old
  WHERE NOT EXISTS (SELECT 1 FROM delta WHERE delta.o_orderkey IS NOT DISTINCT FROM old.o_orderkey))
SELECT * FROM merged
"""
ORACLE["upsert"] = _UPSERT
ORACLE["upsert_with_deletes"] = _UPSERT + "WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)"
ORACLE["reconcile_deletes"] = "SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)"
ORACLE["count_deleted"] = """
SELECT count(*) AS n_deleted FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
"""
_ADDED = "SELECT * FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.o_orderkey IS NOT DISTINCT FROM new.o_orderkey)"
_DELETED = "SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE old.o_orderkey IS NOT DISTINCT FROM new.o_orderkey)"
ORACLE["rows_added"] = BOTH + _ADDED
ORACLE["rows_deleted"] = BOTH + _DELETED
_MET = "new JOIN old ON new.o_orderkey IS NOT DISTINCT FROM old.o_orderkey"
_DIFFERS = " OR ".join(f"new.{c} IS DISTINCT FROM old.{c}" for c in COMMON)
ORACLE["changed_keys"] = BOTH + f"""
SELECT o_orderkey, 'added' AS status FROM ({_ADDED})
UNION ALL SELECT o_orderkey, 'deleted' FROM ({_DELETED})
UNION ALL SELECT new.o_orderkey, 'edited' FROM {_MET} WHERE {_DIFFERS}
"""
_CELLS = " UNION ALL ".join(
    f"SELECT new.o_orderkey AS o_orderkey, '{c}' AS name, CAST(new.{c} AS VARCHAR) AS new, CAST(old.{c} AS VARCHAR) AS old "
    f"FROM {_MET} WHERE new.{c} IS DISTINCT FROM old.{c}"
    for c in COMMON
)
ORACLE["cells_edited"] = BOTH + _CELLS


_NESTED = {
    "list": "to_json([late, urgent])", "pair": "to_json({'a': late, 'b': urgent})",
    "deep": "to_json([{'s': o_orderstatus, 'd': late}])",
}
_PARTS = "CASE WHEN o_orderdate IS NOT NULL THEN o_custkey END AS late, CASE WHEN o_orderpriority IS NOT NULL THEN o_custkey END AS urgent"
ORACLE["cells_edited_nested"] = f"""
WITH new AS (SELECT *, {_PARTS} FROM ({fx.NEW_ORDERS})), old AS (SELECT *, {_PARTS} FROM ({fx.SAME_ORDERS})), cells AS (
""" + " UNION ALL ".join(
    f"SELECT a.o_orderkey, '{n}' AS name, a.t AS new, b.t AS old FROM (SELECT o_orderkey, CAST({e} AS VARCHAR) AS t FROM new) a "
    f"JOIN (SELECT o_orderkey, CAST({e} AS VARCHAR) AS t FROM old) b USING (o_orderkey)" for n, e in _NESTED.items()
) + ") SELECT * FROM cells WHERE new <> old"


def _profile(table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS var_name, '{kind}' AS var_class, count(DISTINCT {c}) AS n_unique, "
        f"coalesce(bool_or({c} IS NULL), false) AS has_null FROM {table}"
        for c, kind in columns.items()
    )


def _shown(table: str, column: str, null_tail: bool = False) -> str:
    tail = f" || CASE WHEN bool_or({column} IS NULL) THEN ', NA' ELSE '' END" if null_tail else ""
    text = f"CAST({column} AS VARCHAR)"
    return f"(SELECT string_agg(DISTINCT {text}, ', ' ORDER BY {text}){tail} FROM {table})"


_LINEITEM = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}
_SETS = " ".join(f"WHEN '{c}' THEN {_shown('lineitem', c)}" for c in _LINEITEM)
ORACLE["profile_with_sets"] = f"""
SELECT *, CASE WHEN n_unique <= 30 THEN CASE var_name {_SETS} END END AS values
FROM ({_profile("lineitem", _LINEITEM)})
"""
_KIND = (
    "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' "
    "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END"
)


def _schema(sql: str) -> str:
    """Column names and classes from the engine's own description of a query."""
    return f"(SELECT column_name AS var_name, {_KIND} AS kind FROM (DESCRIBE {sql}))"


def _schema_diff(old: str, new: str) -> str:
    return f"SELECT var_name, o.kind AS old_var_class, n.kind AS new_var_class FROM {_schema(old)} o FULL JOIN {_schema(new)} n USING (var_name)"


ORACLE["schema_diff"] = _schema_diff(fx.OLD_CUSTOMER, fx.NEW_CUSTOMER)

# -- aggregations -------------------------------------------------------------

ORACLE["max_date_watermark"] = f"WITH {NEW} SELECT CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS latest_date FROM new"
_NEW_CLASSES = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string", "o_clerk": "string",
}
ORACLE["profile_columns"] = f"WITH {NEW} " + _profile("new", _NEW_CLASSES)
ORACLE["profile_texts"] = _profile(
    "documents", {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
)
_NEW_SETS = " UNION ALL ".join(
    f"SELECT '{c}' AS var_name, count(DISTINCT {c}) AS n_unique, {_shown('new', c)} AS values, "
    f"coalesce(bool_or({c} IS NULL), false) AS has_null FROM new"
    for c in _NEW_CLASSES
)
ORACLE["category_sets"] = f"WITH {NEW} SELECT * FROM ({_NEW_SETS}) WHERE n_unique <= 30"
ORACLE["change_counts"] = BOTH + f"""
SELECT (SELECT count(*) FROM ({_ADDED})) AS n_added,
       (SELECT count(DISTINCT o_orderkey) FROM ({_CELLS})) AS n_edited,
       (SELECT count(*) FROM ({_DELETED})) AS n_deleted
"""

_RUNGS = [
    ("logical", "regexp_full_match(t, 'T|F|TRUE|FALSE|true|false')"),
    ("integer", "regexp_full_match(t, '-?(0|[1-9][0-9]*)')"),
    ("double", "regexp_full_match(t, '-?(0|[1-9][0-9]*)([.][0-9]*)?')"),
    ("number", "regexp_full_match(t, '-?((0|[1-9][0-9]*)([.][0-9]*)?|[0-9]{1,3}(,[0-9]{3})+)')"),
    ("time", "regexp_full_match(t, '[0-9]{1,2}:[0-9]{2}')"),
    ("date", "regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}')"),
    ("datetime", "regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}(T[0-9:]{8})?')"),
]


def _guess(table: str, column: str) -> str:
    rungs = " ".join(f"WHEN coalesce(bool_and({test}), true) THEN '{name}'" for name, test in _RUNGS)
    value = f"SELECT CASE WHEN trim(CAST({column} AS VARCHAR)) IN ('', 'NA') THEN NULL ELSE trim(CAST({column} AS VARCHAR)) END AS t"
    return f"SELECT '{column}' AS \"column\", CASE {rungs} ELSE 'character' END AS class FROM ({value} FROM {table})"


_LADDER = "o_orderkey flag whole price grouped clock day moment code words nothing mixed".split()
ORACLE["infer_types"] = f"WITH ladder AS ({fx.LADDER}) " + " UNION ALL ".join(_guess("ladder", c) for c in _LADDER)
_ENDS = " UNION ALL ".join(_guess(part, c) for part in ("head", "tail") for c in _LADDER + ["drifting"])
ORACLE["infer_types_sampled"] = f"""
WITH ladder AS (SELECT *, CASE WHEN o_orderkey < 1000 THEN whole ELSE price END AS drifting FROM ({fx.LADDER})),
     head AS (SELECT * FROM ladder ORDER BY o_orderkey LIMIT 1000),
     tail AS (SELECT * FROM ladder ORDER BY o_orderkey DESC LIMIT 1000)
SELECT "column", CASE WHEN min(class) = max(class) THEN min(class) ELSE 'character' END AS class
FROM ({_ENDS}) GROUP BY 1
"""
ORACLE["demote_midnight_timestamps"] = """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
       strftime(o_orderdate + to_hours(o_custkey), '%Y-%m-%d %H:%M:%S') AS stamp
FROM orders
"""
ORACLE["dedup_all"] = "SELECT DISTINCT * FROM documents"
ORACLE["dedup_keys"] = "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem"

# -- windows ------------------------------------------------------------------


def _islands(ids: str) -> str:
    return f"""SELECT min(id) AS "start", max(id) AS "end"
FROM (SELECT id, id - row_number() OVER (ORDER BY id) AS run FROM (SELECT DISTINCT id FROM ({ids}) WHERE id IS NOT NULL))
GROUP BY run"""


_ORDER_IDS = "SELECT l_orderkey AS id FROM lineitem"
ORACLE["id_islands"] = _islands(_ORDER_IDS)
ORACLE["id_islands_sparse"] = _islands(
    "SELECT doc_id * 65535 AS id FROM labels UNION ALL SELECT doc_id * 65535 + 1 FROM labels"
)
ORACLE["id_range_chunks"] = f"""
WITH cut AS (SELECT "end" AS stop, unnest(range("start", "end" + 1, 7)) AS s FROM ({_islands(_ORDER_IDS)}))
SELECT s AS "start", least(stop, s + 6) AS "end",
       'l_orderkey >= ' || s || ' AND l_orderkey <= ' || least(stop, s + 6) AS predicate
FROM cut
"""


def _newest(source: str, ts: str, tie: str, n: int = 1, where: str = "true") -> str:
    return f"""SELECT * EXCLUDE (rank_) FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY {ts} DESC, {tie} DESC) AS rank_
  FROM ({source}) WHERE {where}) WHERE rank_ <= {n}"""


ORACLE["latest_version"] = _newest(fx.VERSIONS, "version_ts", "version_id")
ORACLE["version_as_of"] = _newest(fx.VERSIONS, "version_ts", "version_id", 1, "version_ts <= TIMESTAMP '1997-12-31 23:59:59'")
ORACLE["tables_without_version"] = f"""
SELECT table_name FROM ({fx.VERSIONS}) GROUP BY 1 HAVING min(version_ts) > TIMESTAMP '1995-12-31 23:59:59'
"""
ORACLE["retain_latest_n"] = _newest(fx.VERSIONS, "version_ts", "version_id", 3)

# -- ordered samples ----------------------------------------------------------

ORACLE["sample_first"] = "SELECT * FROM events ORDER BY event_id LIMIT 1000"
ORACLE["sample_last"] = "SELECT * FROM events ORDER BY event_id DESC LIMIT 1000"
ORACLE["sample_random"] = "SELECT * FROM events ORDER BY md5('7:' || event_id), event_id LIMIT 1000"
ORACLE["sample_first_many"] = "SELECT * FROM lineitem ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 5000"
ORACLE["sample_random_many"] = "SELECT * FROM events ORDER BY md5('11:' || event_id), event_id LIMIT 5000"
ORACLE["first_by"] = "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25"

# -- sets ---------------------------------------------------------------------

ORACLE["union_by_name"] = BOTH + f"SELECT * FROM new UNION ALL SELECT {OLD_COLUMNS}, NULL FROM old"
ORACLE["rows_except"] = """
SELECT * FROM lineitem EXCEPT SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN 'X' ELSE l_linestatus END AS l_linestatus) FROM lineitem
"""
_OLD_C, _NEW_C = f"old AS ({fx.OLD_CUSTOMER})", f"new AS ({fx.NEW_CUSTOMER})"
_MEMBERS = f"""WITH {_OLD_C}, {_NEW_C},
members AS (
  SELECT var_name, value, bool_or(side = 0) AS in_old, bool_or(side = 1) AS in_new FROM (
    SELECT 'c_nationkey' AS var_name, CAST(c_nationkey AS VARCHAR) AS value, 0 AS side FROM old
    UNION ALL SELECT 'c_nationkey', c_nationkey, 1 FROM new
    UNION ALL SELECT 'c_mktsegment', c_mktsegment, 0 FROM old
    UNION ALL SELECT 'c_mktsegment', c_mktsegment, 1 FROM new) GROUP BY ALL),
marked AS (SELECT var_name, coalesce(value, 'NA') AS value, value IS NULL AS last, in_old, in_new FROM members),
sets AS (
  SELECT var_name,
    coalesce(string_agg(value, ', ' ORDER BY last, value) FILTER (WHERE in_old), '') AS old_set,
    coalesce(string_agg(value, ', ' ORDER BY last, value) FILTER (WHERE in_new), '') AS new_set,
    coalesce(string_agg(value, ', ' ORDER BY last, value) FILTER (WHERE in_old AND in_new), '') AS same,
    coalesce(string_agg(value, ', ' ORDER BY last, value) FILTER (WHERE in_old AND NOT in_new), '') AS in_old_not_new,
    coalesce(string_agg(value, ', ' ORDER BY last, value) FILTER (WHERE in_new AND NOT in_old), '') AS in_new_not_old
  FROM marked GROUP BY 1)
"""
ORACLE["value_set_compare"] = _MEMBERS + "SELECT var_name, same, in_old_not_new, in_new_not_old FROM sets"
_NEW_CATEGORIES = "SELECT * FROM sets WHERE var_name = 'c_mktsegment' AND in_new_not_old <> ''"

# -- scalar functions ---------------------------------------------------------

_SPACE = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(160)"


def _dirty(form: str) -> str:
    names = [("CustKey", "key"), ("Full Name", "name"), (" % Balance", "balance"), ("# Nation", "nation")]
    picked = ", ".join(form.replace("?", f"trim(CAST(\"{a}\" AS VARCHAR), {_SPACE})") + f" AS {b}" for a, b in names)
    return f"SELECT {picked} FROM ({fx.DIRTY_CUSTOMER})"


ORACLE["trim_all"] = _dirty("?")
ORACLE["blank_to_null"] = _dirty("nullif(?, '')")
ORACLE["latin_ascii"] = """
SELECT doc_id, strip_accents(replace(text, 'ß', 'ss')) AS text, lang, source, n_chars FROM documents
"""
ORACLE["apply_types"] = f"""
SELECT o_orderkey, flag = 'T' AS flag, CAST(whole AS BIGINT) AS whole, CAST(trim(price) AS DOUBLE) AS price,
       CAST(replace(grouped, ',', '') AS DOUBLE) AS grouped, clock, day, CAST(moment AS TIMESTAMP) AS moment, code,
       nullif(words, 'NA') AS words, CAST(NULL AS VARCHAR) AS nothing, CAST(mixed AS DOUBLE) AS mixed
FROM ({fx.LADDER})
"""
ORACLE["date_prefix"] = f"SELECT o_orderkey, day AS from_moment, CAST(NULL AS VARCHAR) AS from_words FROM ({fx.LADDER})"
ORACLE["version_label"] = """
SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS label, strftime(ts, '%Y%m%d_%H%M%S') AS snapshot FROM events
"""
ORACLE["render_set"] = f"""WITH {NEW}
SELECT o_orderkey, o_orderstatus || ', ' || coalesce(o_orderpriority, 'NA') || ', ' || o_clerk AS shown FROM new
"""
ORACLE["strip_affix"] = """
SELECT p_partkey, regexp_replace(p_brand, '^Brand#', '') AS brand, regexp_replace(p_name, ' ring$', '') AS name,
       replace(p_type, 'A', '') AS type
FROM part
"""
ORACLE["match_pattern"] = "SELECT * FROM part WHERE regexp_matches(p_name, '^(small|red) .*t$')"

# -- reshape ------------------------------------------------------------------

ORACLE["to_long"] = f"WITH {NEW} " + " UNION ALL ".join(
    f"SELECT o_orderkey, '{c}' AS name, CAST({c} AS VARCHAR) AS value FROM new" for c in [*COMMON, "o_clerk"]
)
ORACLE["to_wide"] = f"WITH {NEW} SELECT o_orderkey, o_orderstatus, o_orderpriority, o_clerk FROM new"
ORACLE["to_wide_lists"] = "SELECT l_orderkey, " + ", ".join(
    f"coalesce(string_agg(l_linenumber, ', ' ORDER BY l_linenumber) FILTER (WHERE l_returnflag = '{f}'), '') AS \"{f}\""
    for f in "ANR"
) + " FROM lineitem GROUP BY 1"

# -- drift --------------------------------------------------------------------

ORACLE["new_columns"] = f"SELECT var_name FROM ({ORACLE['schema_diff']}) WHERE old_var_class IS NULL"
ORACLE["lost_columns"] = f"SELECT var_name FROM ({ORACLE['schema_diff']}) WHERE new_var_class IS NULL"
ORACLE["class_changes"] = f"SELECT * FROM ({ORACLE['schema_diff']}) WHERE old_var_class <> new_var_class"
ORACLE["new_categories"] = _MEMBERS + _NEW_CATEGORIES
ORACLE["needs_full_reload"] = f"""
SELECT bool_or(old_var_class IS NULL OR coalesce(old_var_class <> new_var_class, false)) AS needs_full_reload
FROM ({ORACLE['schema_diff']})
"""

# -- state --------------------------------------------------------------------

_STATE = f"""
SELECT table_name, updated, file_name, CAST(coalesce(latest_date, DATE '1900-01-01') AS VARCHAR) AS latest_date,
       date_field, has_version
FROM ({_newest(fx.STATE_LOG, 'logged_at', 'entry')})
"""
ORACLE["current_state"] = _STATE
ORACLE["advance_state"] = f"""
SELECT 'T' || c_custkey AS table_name, TIMESTAMP '2002-03-01' AS updated,
       coalesce(s.file_name, 'T' || c_custkey) AS file_name,
       CAST(CAST(DATE '2002-01-01' + c_nationkey AS DATE) AS VARCHAR) AS latest_date, c_mktsegment AS date_field,
       true AS has_version
FROM customer LEFT JOIN ({_STATE}) s ON s.table_name = 'T' || c_custkey
"""
ORACLE["reset_state"] = f"""
WITH hit AS (SELECT 'T' || c_custkey AS table_name FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT table_name,
       CASE WHEN table_name IN (FROM hit) THEN TIMESTAMP '1900-01-01' ELSE updated END AS updated, file_name,
       CASE WHEN table_name IN (FROM hit) THEN '1900-01-01' ELSE latest_date END AS latest_date,
       CASE WHEN table_name IN (FROM hit) THEN 'Changed' ELSE date_field END AS date_field,
       table_name NOT IN (FROM hit) AS has_version
FROM ({_STATE})
"""
ORACLE["rebuild_state"] = f"""
WITH s AS ({_STATE}), v AS ({_newest(fx.STATE_LOG, 'logged_at', 'entry', 1, "logged_at <= TIMESTAMP '1996-06-30 23:59:59'")})
SELECT s.table_name, coalesce(v.updated, s.updated) AS updated, s.file_name,
       CASE WHEN v.table_name IS NOT NULL THEN CAST(v.latest_date AS VARCHAR) ELSE s.latest_date END AS latest_date,
       coalesce(v.date_field, s.date_field) AS date_field, s.has_version
FROM s LEFT JOIN v ON v.table_name = s.table_name
"""

# -- whole plans --------------------------------------------------------------

ORACLE["clean_table"] = f"""
SELECT DISTINCT CAST(key AS BIGINT) AS cust_key, replace(nullif(name, ''), 'ß', 'ss') AS full_name,
       CAST(nullif(balance, 'NA') AS DOUBLE) AS percent_balance,
       CASE WHEN nation IN ('T', 'TRUE') THEN true WHEN nation IN ('F', 'FALSE') THEN false END AS number_nation
FROM ({_dirty('?')})
WHERE key IS NOT NULL
"""
ORACLE["clean_documents"] = f"""
SELECT DISTINCT doc_id, nullif(nullif(strip_accents(replace(trim(text, {_SPACE}), 'ß', 'ss')), ''), 'NA') AS text, lang, source, n_chars
FROM documents
"""
_TEXT = "CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, " \
    "CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority"
ORACLE["refresh_table"] = f"""
WITH {NEW}, {OLD},
     delta AS (SELECT * FROM new WHERE o_orderdate >= (SELECT max(o_orderdate) FROM old) OR o_orderdate IS NULL)
SELECT {_TEXT} FROM delta
UNION SELECT {_TEXT} FROM old
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM delta) AND o_orderkey IN (SELECT o_orderkey FROM new)
"""
ORACLE["refresh_with_drift"] = f"WITH {NEW} SELECT {_TEXT}, o_clerk FROM new"
ORACLE["refresh_all"] = """
SELECT 'customer' AS table_name, (SELECT count(*) FROM customer) AS n, '1900-01-01' AS latest_date, 'None' AS date_field
UNION ALL SELECT 'orders', count(*), CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR), 'o_orderdate' FROM orders
UNION ALL SELECT 'events', count(*), CAST(CAST(max(ts) AS DATE) AS VARCHAR), 'ts' FROM events
"""
_COUNTS = ORACLE["change_counts"].removeprefix(BOTH)
ORACLE["append_change_log"] = BOTH + f"""
SELECT CAST(COLUMNS(*) AS VARCHAR) FROM (
  SELECT o_orderkey, name, new, old, NULL AS table_name, NULL AS n_added, NULL AS n_edited, NULL AS n_deleted FROM ({_CELLS})
  UNION ALL SELECT o_orderkey, 'added', o_orderstatus, NULL, NULL, NULL, NULL, NULL FROM ({_ADDED})
  UNION ALL SELECT o_orderkey, 'deleted', o_orderstatus, NULL, NULL, NULL, NULL, NULL FROM ({_DELETED})
  UNION ALL SELECT NULL, NULL, NULL, NULL, 'orders', n_added, n_edited, n_deleted FROM ({_COUNTS}))
"""
ORACLE["tables_with_changes"] = f"""
SELECT table_name, n_added, n_edited, n_deleted FROM ({_newest(fx.CHANGE_COUNTS, 'run_ts', 'entry')})
WHERE n_added + n_edited + n_deleted > 0
"""
ORACLE["diff_versions"] = BOTH + f"""
, counts AS ({_COUNTS})
SELECT 'counts' AS element, 'n_added' AS item, CAST(n_added AS VARCHAR) AS detail FROM counts
UNION ALL SELECT 'counts', 'n_edited', CAST(n_edited AS VARCHAR) FROM counts
UNION ALL SELECT 'counts', 'n_deleted', CAST(n_deleted AS VARCHAR) FROM counts
UNION ALL SELECT 'added', CAST(o_orderkey AS VARCHAR), o_clerk FROM ({_ADDED})
UNION ALL SELECT 'deleted', CAST(o_orderkey AS VARCHAR), o_orderstatus FROM ({_DELETED})
UNION ALL SELECT 'edited', o_orderkey || ' ' || name, coalesce(old, 'NA') || ' to ' || coalesce(new, 'NA') FROM ({_CELLS})
UNION ALL SELECT 'new_columns', 'o_clerk', NULL
UNION ALL SELECT 'new_categories', 'o_orderstatus', 'X' WHERE EXISTS (SELECT 1 FROM new WHERE o_orderstatus = 'X')
UNION ALL SELECT 'new_categories', 'o_orderpriority', 'NA' WHERE EXISTS (SELECT 1 FROM new WHERE o_orderpriority IS NULL)
"""
_CUSTOMER_DRIFT = _schema_diff(fx.OLD_CUSTOMER, fx.NEW_CUSTOMER)
_ORDER_DRIFT = _schema_diff("SELECT * FROM orders", fx.NEW_ORDERS)


def _summary(table: str, drift: str) -> str:
    return f"""
SELECT '{table}' AS table_name, 'new_columns' AS element, var_name AS item, NULL AS detail FROM ({drift}) WHERE old_var_class IS NULL
UNION ALL SELECT '{table}', 'lost_columns', var_name, NULL FROM ({drift}) WHERE new_var_class IS NULL
UNION ALL SELECT '{table}', 'class_changes', var_name, old_var_class || ' ' || new_var_class FROM ({drift}) WHERE old_var_class <> new_var_class
"""


ORACLE["latest_change_summary"] = f"""
WITH a AS ({fx.OLD_CUSTOMER}), b AS ({fx.NEW_CUSTOMER}), new AS ({fx.NEW_ORDERS}), old AS (SELECT * FROM orders), counts AS ({_COUNTS})
SELECT 'customer' AS table_name, 'counts' AS element, CAST(count(*) AS VARCHAR) AS item, '0 0' AS detail
FROM a JOIN b USING (c_custkey) WHERE a.c_mktsegment IS DISTINCT FROM b.c_mktsegment OR CAST(a.c_nationkey AS VARCHAR) IS DISTINCT FROM b.c_nationkey
UNION ALL SELECT 'orders', 'counts', CAST(n_edited AS VARCHAR), n_added || ' ' || n_deleted FROM counts
UNION ALL {_summary('customer', _CUSTOMER_DRIFT)} UNION ALL {_summary('orders', _ORDER_DRIFT)}
UNION ALL SELECT 'customer', 'new_categories', 'c_mktsegment',
    (SELECT string_agg(v, ', ' ORDER BY v = 'NA', v) FROM (SELECT DISTINCT coalesce(c_mktsegment, 'NA') AS v FROM b
     WHERE coalesce(c_mktsegment, 'NA') NOT IN (SELECT coalesce(c_mktsegment, 'NA') FROM a)))
UNION ALL SELECT 'orders', 'new_categories', 'o_orderstatus', 'X' WHERE EXISTS (SELECT 1 FROM new WHERE o_orderstatus = 'X')
UNION ALL SELECT 'orders', 'new_categories', 'o_orderpriority', 'NA' WHERE EXISTS (SELECT 1 FROM new WHERE o_orderpriority IS NULL)
"""
_WIDE_DRIFT = _schema_diff("SELECT * FROM orders", f"SELECT * EXCLUDE (o_totalprice) REPLACE (CAST(o_custkey AS VARCHAR) AS o_custkey) FROM ({fx.NEW_ORDERS})")
ORACLE["diff_versions_drift"] = BOTH + f"""
SELECT 'counts' AS element, 'n_added' AS item, CAST(count(*) AS VARCHAR) AS detail FROM ({_ADDED})
UNION ALL SELECT 'counts', 'n_edited', '0'
UNION ALL SELECT 'counts', 'n_deleted', CAST(count(*) AS VARCHAR) FROM ({_DELETED})
UNION ALL SELECT 'added', CAST(o_orderkey AS VARCHAR), o_clerk FROM ({_ADDED})
UNION ALL SELECT 'deleted', CAST(o_orderkey AS VARCHAR), o_orderstatus FROM ({_DELETED})
UNION ALL SELECT 'new_columns', var_name, NULL FROM ({_WIDE_DRIFT}) WHERE old_var_class IS NULL
UNION ALL SELECT 'lost_columns', var_name, NULL FROM ({_WIDE_DRIFT}) WHERE new_var_class IS NULL
UNION ALL SELECT 'class_changes', var_name, new_var_class FROM ({_WIDE_DRIFT}) WHERE old_var_class <> new_var_class
UNION ALL SELECT 'new_categories', 'o_orderstatus', 'X' WHERE EXISTS (SELECT 1 FROM new WHERE o_orderstatus = 'X')
UNION ALL SELECT 'new_categories', 'o_orderpriority', 'NA' WHERE EXISTS (SELECT 1 FROM new WHERE o_orderpriority IS NULL)
"""
ORACLE["diff_versions_repeated_keys"] = """
WITH n AS (SELECT l_orderkey, l_linenumber, count(*) AS n, max(l_returnflag) AS flag FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_linenumber, NULL AS name, NULL AS new, NULL AS old, NULL AS n_added, NULL AS n_edited, NULL AS n_deleted, 'repeated' AS part FROM n WHERE n > 1
UNION ALL SELECT l_orderkey, l_linenumber, 'l_returnflag', 'X', 'R', NULL, NULL, NULL, 'edited' FROM n WHERE n = 1 AND flag = 'R'
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, 0, count(*) FILTER (n = 1 AND flag = 'R'), 0, 'counts' FROM n
"""
ORACLE["plan_extraction"] = f"""
SELECT 'orders' AS table_name, 'id_filter' AS method, NULL AS skip, NULL AS top, predicate FROM ({ORACLE['id_range_chunks']})
UNION ALL SELECT 'lineitem', 'skip_top', unnest(range(0, (SELECT count(*) FROM lineitem) + 1, 500)), 500, NULL
"""
ORACLE["read_page_files_empty"] = """
SELECT count(*) FILTER (o_orderkey IS NULL) AS n, unnest(['files', 'column']) AS reader FROM orders
"""
ORACLE["unfit_columns"] = f"""
WITH ladder AS ({fx.LADDER})
SELECT 'whole' AS unfit WHERE EXISTS (SELECT 1 FROM ladder WHERE flag = 'T' AND NOT regexp_full_match('1.5', '-?[0-9]+'))
UNION ALL SELECT 'day' WHERE EXISTS (SELECT 1 FROM ladder WHERE NOT regexp_full_match(clock, '[0-9]{{4}}-.*'))
"""
ORACLE["refresh_pages_incremental"] = f"""
WITH {NEW}, {OLD}, delta AS (SELECT * FROM new WHERE o_orderdate >= (SELECT max(o_orderdate) FROM old) OR o_orderdate IS NULL)
SELECT {_TEXT} FROM delta UNION SELECT {_TEXT} FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM delta)
"""
ORACLE["refresh_pages_drift"] = f"""
WITH {NEW}, {OLD} SELECT {_TEXT}, NULL AS o_clerk, 'reload wanted True' AS step FROM old
UNION ALL SELECT {_TEXT}, o_clerk, 'reloaded True' FROM new
"""
ORACLE["refresh_pages_deletes"] = ORACLE["refresh_table"]
ORACLE["refresh_pages_incomplete"] = f"""
SELECT {_TEXT}, false AS complete, NULL AS skip, NULL AS reason FROM orders
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, CAST(o_custkey AS VARCHAR), CASE WHEN o_custkey % 11 = 5 THEN 'absent' ELSE 'unreadable' END
FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey % 11 = 5 OR o_custkey % 7 = 3
"""
ORACLE["revert"] = """
SELECT CAST(COLUMNS(*) AS VARCHAR), NULL AS left_out FROM orders
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'supplier'
"""
ORACLE["refresh_pages_retry"] = f"""
SELECT {_TEXT}, 'complete False True, failed 0, dated None' AS told, CAST(CAST((SELECT max(o_orderdate) FROM orders) AS DATE) AS VARCHAR) AS latest_date FROM orders
"""
ORACLE["profile_after_refresh"] = f"""
WITH t AS ({ORACLE['refresh_table']}), long AS (SELECT * FROM t UNPIVOT INCLUDE NULLS (value FOR var_name IN (COLUMNS(*)))),
n AS (SELECT var_name, count(DISTINCT value) AS n, bool_or(value IS NULL) AS gone, list(DISTINCT value) FILTER (value IS NOT NULL) AS held FROM long GROUP BY var_name)
SELECT var_name, 'string' AS var_class, CASE WHEN n <= 30 THEN n END AS n_unique, CASE WHEN n <= 30 THEN gone END AS has_null,
    CASE WHEN n <= 30 THEN coalesce(array_to_string(list_sort(held), ', '), '') END AS values
FROM n
"""
ORACLE["diff_versions_buckets"] = ORACLE["diff_versions_repeated_keys"]
ORACLE["refresh_all_tables"] = """
SELECT CAST(COLUMNS(*) AS VARCHAR) FROM (
  SELECT *, 'missing' AS failed FROM customer
  UNION ALL BY NAME SELECT *, 'missing' AS failed FROM supplier
  UNION ALL BY NAME SELECT *, 'missing' AS failed FROM orders)
"""
ORACLE["read_planned_ranges"] = ORACLE["read_planned_pages"] = "SELECT * FROM lineitem"
ORACLE["revert_by_log"] = ORACLE["refresh_table"]
