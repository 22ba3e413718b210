"""DuckDB oracles: the expected result of each registered query, computed
straight from the driver tables (never by parsing report text).

Each string runs on DuckDB with the driver tables registered as views.
Column names equal those of the Spark query; integers are BIGINT, dates DATE,
all report fields VARCHAR.
"""

from __future__ import annotations

from ..functions.text import UNICODE_WHITESPACE
from ..spec import ST1, ST49
from .render import ST49_WIDTHS

# the Unicode whitespace set, as DuckDB text
WS = "(" + " || ".join(
    f"chr({c})" for c in [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                           0x202F, 0x205F, 0x3000]
) + ")"

ORDER_ROWS = """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
       c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment, n.n_name,
       CAST(o.o_orderdate AS DATE) AS d
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

DAYS = "SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1"


def _money(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(18,2)) AS VARCHAR)"


ST1_PATH = "'WELLS' || strftime(d, '%m%d%Y') || '.TXT'"
ST49_PATH = "'SPUD' || strftime(d, '%m%d%Y') || '.txt'"
STATUS_BY_DAY = (
    "CASE WHEN dayofmonth(d) = 13 THEN 'date_parse' WHEN dayofmonth(d) = 17 THEN 'missing_section' ELSE 'ok' END"
)
OK_DAY = "dayofmonth(d) NOT IN (13, 17)"

ST1_VALUES = {
    "well_name": "c_name || ' ' || o_orderpriority",
    "licence_number": "lpad(CAST(o_orderkey AS VARCHAR), 7, '0')",
    "mineral_rights": "CASE o_orderstatus WHEN 'F' THEN 'FREEHOLD' WHEN 'O' THEN 'CROWN' ELSE 'BOTH' END",
    "ground_elevation": _money("o_totalprice") + " || 'M'",
    "unique_identifier": "'100/' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') || '/00'",
    "surface_coordinates": "'N ' || CAST(c_nationkey AS VARCHAR)",
    "aer_field_centre": "c_mktsegment",
    "projected_depth": _money("c_acctbal") + " || 'M'",
    "aer_classification": "CASE o_orderstatus WHEN 'F' THEN 'DEV (NC)' WHEN 'O' THEN 'XPL (C)' ELSE 'DEV (C)' END",
    "field": "n_name",
    "terminating_zone": "CASE WHEN o_orderpriority LIKE '5%' THEN '' ELSE c_mktsegment || ' FM' END",
    "drilling_operation": "CASE WHEN o_orderstatus = 'O' THEN 'VERTICAL' ELSE 'HORIZONTAL' END",
    "well_purpose": "'NEW'",
    "well_type": "'PRODUCTION'",
    "substance": "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'GAS' ELSE 'CRUDE OIL' END",
    "licensee": "upper(c_name) || CASE WHEN o_orderpriority LIKE '1%' THEN ' \"PIPE|LINE\" LTD.' ELSE ' LTD.' END",
    "surface_location": "CAST(c_nationkey AS VARCHAR) || '-' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') || 'W4'",
}


def _st1_field(name: str) -> str:
    # an empty terminating zone leaves the trimmed line shorter than the end of
    # the 'field' slice, so that slice reads ''
    if name == "field":
        return f"CASE WHEN o_orderpriority LIKE '5%' THEN '' ELSE {ST1_VALUES['field']} END"
    return ST1_VALUES[name]


ST1_LINES = [
    f"rpad({ST1_VALUES['well_name']}, 37, ' ') || rpad({ST1_VALUES['licence_number']}, 10, ' ') || "
    f"rpad({ST1_VALUES['mineral_rights']}, 21, ' ') || {ST1_VALUES['ground_elevation']}",
    f"rpad({ST1_VALUES['unique_identifier']}, 37, ' ') || rpad({ST1_VALUES['surface_coordinates']}, 10, ' ') || "
    f"rpad({ST1_VALUES['aer_field_centre']}, 21, ' ') || {ST1_VALUES['projected_depth']}",
    f"rtrim(rpad({ST1_VALUES['aer_classification']}, 37, ' ') || rpad({ST1_VALUES['field']}, 31, ' ') || "
    f"{ST1_VALUES['terminating_zone']})",
    f"rpad({ST1_VALUES['drilling_operation']}, 37, ' ') || rpad({ST1_VALUES['well_purpose']}, 10, ' ') || "
    f"rpad({ST1_VALUES['well_type']}, 21, ' ') || {ST1_VALUES['substance']}",
    f"rpad({ST1_VALUES['licensee']}, 68, ' ') || {ST1_VALUES['surface_location']}",
]

ST49_VALUES = {
    "well_id": "'00/' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') || '/0'",
    "well_name": "c_name || ' HZ ' || o_orderstatus",
    "licence": "lpad(CAST(o_orderkey AS VARCHAR), 7, '0')",
    "contractor_ba_id": "'A' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0')",
    "contractor_name": "n_name || ' DRILLING CORP.'",
    "rig_number": "CAST(c_nationkey AS VARCHAR)",
    "activity_date": (
        "strftime(o_orderdate + to_hours(o_orderkey % 24) - CASE WHEN o_orderstatus = 'P' THEN INTERVAL 1 DAY "
        "ELSE INTERVAL 0 DAY END, '%d %b %Y %I:%M:%S %p')"
    ),
    "field_centre": "c_mktsegment",
    "ba_id": "'B' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0')",
    "licensee": "c_name || ' Ltd.'",
    "new_projected_total_depth": f"CASE WHEN o_orderpriority LIKE '1%' THEN {_money('c_acctbal')} ELSE '' END",
    "activity_type": (
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Drill To LD' WHEN '2-HIGH' THEN 'Set Surface' "
        "WHEN '3-MEDIUM' THEN 'Resumption' ELSE 'Drill To TD' END"
    ),
}

ST49_LINE = " || ".join(
    [f"rpad({ST49_VALUES[n]}, {w}, ' ') || '  '" for n, w in zip(ST49.ruler_fields, ST49_WIDTHS)]
    + [ST49_VALUES["activity_type"]]
)

RANK = "row_number() OVER (PARTITION BY d ORDER BY o_orderkey) - 1"


def st1_records() -> str:
    fields = ",\n  ".join(f"{_st1_field(c)} AS {c}" for c in ST1.field_names)
    return f"""
SELECT {ST1_PATH} AS path, {RANK} AS record_no, strftime(d, '%Y-%m-%d') AS date,
  {fields}
FROM ({ORDER_ROWS}) r WHERE {OK_DAY}
"""


def st49_records() -> str:
    fields = ",\n  ".join(f"{ST49_VALUES[c]} AS {c}" for c in ST49.field_names)
    return f"""
SELECT {ST49_PATH} AS path, {RANK} AS record_no, strftime(d, '%Y-%m-%d') AS date,
  {fields}
FROM ({ORDER_ROWS}) r WHERE {OK_DAY}
"""


def record_chunks() -> str:
    lines = ",\n  ".join(f"{l} AS line{i}" for i, l in enumerate(ST1_LINES))
    return f"""
SELECT {ST1_PATH} AS path, {RANK} AS record_no, {lines}
FROM ({ORDER_ROWS}) r WHERE {OK_DAY}
"""


def section_block() -> str:
    return f"""
WITH c AS ({record_chunks()})
SELECT path, record_no * 5 + j AS line_index,
       CASE j WHEN 0 THEN line0 WHEN 1 THEN line1 WHEN 2 THEN line2 WHEN 3 THEN line3 ELSE line4 END AS line
FROM c, (SELECT unnest(range(5)) AS j) k
"""


def ruler_block() -> str:
    return f"""
SELECT {ST49_PATH} AS path, {RANK} AS record_no, {ST49_LINE} AS line
FROM ({ORDER_ROWS}) r WHERE {OK_DAY}
"""


def report_lines() -> str:
    return f"""
WITH raw AS (
  SELECT 'doc/' || CAST(doc_id AS VARCHAR) AS path,
         unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents),
t AS (SELECT path, i, trim(line, {WS}) AS line FROM raw)
SELECT path, row_number() OVER (PARTITION BY path ORDER BY i) - 1 AS line_no, line FROM t WHERE line <> ''
"""


def _slice_sql(a: int, b) -> str:
    if b is None:
        return (f"CASE WHEN strlen(line) >= {a} THEN coalesce(trim(try(decode(array_slice(encode(line), {a + 1}, "
                f"strlen(line)))), {WS}), '') ELSE '' END")
    return (f"CASE WHEN strlen(line) >= {b} THEN coalesce(trim(try(decode(array_slice(encode(line), {a + 1}, {b}))), "
            f"{WS}), '') ELSE '' END")


def byte_slice() -> str:
    return f"""
WITH rl AS ({report_lines()})
SELECT path, line_no, {_slice_sql(0, 37)} AS f0, {_slice_sql(37, 47)} AS f1, {_slice_sql(47, 68)} AS f2,
       {_slice_sql(68, None)} AS f3
FROM rl
"""


def _class(chars: str) -> str:
    return "".join(f"\\x{{{ord(c):x}}}" for c in chars)


def ruler_boundaries() -> str:
    ws = _class(UNICODE_WHITESPACE)
    return f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents),
t AS (
  SELECT doc_id, line_no, strlen(line) AS bytes,
         unnest(regexp_extract_all(line, '[{ws}]+|[^{ws}]+')) AS tok,
         generate_subscripts(regexp_extract_all(line, '[{ws}]+|[^{ws}]+'), 1) AS i
  FROM lines),
c AS (
  SELECT *, coalesce(sum(strlen(tok)) OVER (PARTITION BY doc_id, line_no ORDER BY i
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
  FROM t),
runs AS (
  SELECT doc_id, line_no, s AS start_pos, s + strlen(tok) AS end_pos FROM c WHERE NOT regexp_matches(tok, '^[{ws}]')
  UNION ALL  -- a line that ends in white space, or is empty, ends in an empty run
  SELECT doc_id, line_no, strlen(line), strlen(line) FROM lines WHERE line = '' OR regexp_matches(line, '[{ws}]$'))
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no,
       CAST(row_number() OVER (PARTITION BY doc_id, line_no ORDER BY start_pos) - 1 AS BIGINT) AS idx,
       CAST(start_pos AS BIGINT) AS start_pos, CAST(end_pos AS BIGINT) AS end_pos
FROM runs
"""


def _file_dates(path: str) -> str:
    return f"""
SELECT {path} AS path,
       CASE WHEN dayofmonth(d) = 13 THEN NULL ELSE d END AS report_date,
       CASE WHEN dayofmonth(d) = 13 THEN 'Failed to parse date: 31 February ' || CAST(year(d) AS VARCHAR) END AS error
FROM ({DAYS}) x
"""


def st1_date() -> str:
    return _file_dates(ST1_PATH)


def st49_date() -> str:
    return _file_dates(ST49_PATH)


def error_summary() -> str:
    parts = []
    for rt in ("st1", "st49"):
        parts.append(f"""
SELECT '{rt}' AS report_type, {STATUS_BY_DAY} AS status, count(*) AS files,
       CAST(sum(CASE WHEN {OK_DAY} THEN n ELSE 0 END) AS BIGINT) AS records
FROM ({DAYS}) x GROUP BY 1, 2""")
    return " UNION ALL ".join(parts)


RANGE_START = "1996-01-01"
RANGE_END = "1997-12-31"


def date_range_filter() -> str:
    return f"""
SELECT {ST1_PATH} AS path,
       CASE WHEN dayofmonth(d) = 13 THEN NULL ELSE d END AS report_date,
       CASE WHEN dayofmonth(d) = 13 THEN 'date_parse'
            WHEN d NOT BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}' THEN 'out_of_range'
            WHEN dayofmonth(d) = 17 THEN 'missing_section' ELSE 'ok' END AS status,
       CASE WHEN {OK_DAY} AND d BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}' THEN n ELSE 0 END AS records
FROM ({DAYS}) x
"""


def custom_spec() -> str:
    return """
SELECT 'EVENTS' || strftime(CAST(ts AS DATE), '%Y%m%d') || '.LOG' AS path,
       row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id) - 1 AS record_no,
       strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date,
       CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
       CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS value,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, props
FROM events
"""


def _stored(records_sql: str, columns) -> str:
    cols = ", ".join(f"NULLIF({c}, '') AS {c}" for c in columns)
    return f"SELECT {cols} FROM ({records_sql}) x"


def st1_stored() -> str:
    """Rows of an ST1 table: the records without path/record_no, '' stored as NULL."""
    return _stored(st1_records(), ST1.columns)


def st49_stored() -> str:
    return _stored(st49_records(), ST49.columns)


def table_count() -> str:
    return f"SELECT count(*) AS n FROM ({st1_stored()}) t"


def table_head() -> str:
    return f"SELECT * FROM ({st1_stored()}) t ORDER BY date, licence_number LIMIT 10"


def ledger_append() -> str:
    return f"SELECT DISTINCT strftime(d, '%Y%m%d') || '_WELLS' AS report, 'loaded' AS status FROM ({DAYS}) x WHERE {OK_DAY}"


def ledger_read() -> str:
    return """
SELECT DISTINCT '/data/csv/' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '_WELLS.csv' AS csv_file
FROM documents WHERE lang NOT IN ('de', 'es')
"""


def load_candidates() -> str:
    return """
WITH l AS (
  SELECT 'file:/data/csv/' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '_' ||
         CASE WHEN length(source) = 4 THEN 'WELLS' ELSE 'SPUD' END ||
         CASE lang WHEN 'de' THEN '.CSV' WHEN 'es' THEN '.txt' ELSE '.csv' END AS path, lang
  FROM documents)
SELECT DISTINCT path FROM l
WHERE path LIKE '%WELLS%' AND path LIKE '%.csv'
  AND NOT EXISTS (SELECT 1 FROM l e WHERE e.lang = 'en' AND e.path = l.path)
"""


def quarantine() -> str:
    return f"""
SELECT * FROM (
  SELECT {ST1_PATH} AS path,
         CASE WHEN dayofmonth(d) = 13 THEN 'date_parse'
              WHEN d NOT BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}' THEN 'out_of_range'
              WHEN dayofmonth(d) = 17 THEN 'missing_section' ELSE 'ok' END AS status,
         CASE WHEN dayofmonth(d) = 13 THEN 'Failed to parse date: 31 February ' || CAST(year(d) AS VARCHAR)
              WHEN d NOT BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}' THEN 'Date outside of range'
              WHEN dayofmonth(d) = 17 THEN 'Missing required section: WELL LICENCES ISSUED' END AS error
  FROM ({DAYS}) x) q
WHERE status <> 'ok'
"""


def stale_unreferenced() -> str:
    return f"""
SELECT 'v1' AS version, strftime(date_trunc('month', CAST(date AS DATE)), '%Y-%m-%d') AS report_month, count(*) AS rows
FROM ({st49_stored()}) t GROUP BY 1, 2
"""


def report_order() -> str:
    return f"""
SELECT NULLIF(date, '') AS date, NULLIF(licence_number, '') AS licence_number, NULLIF(well_name, '') AS well_name,
       row_number() OVER (PARTITION BY date ORDER BY record_no) AS place
FROM ({st1_records()}) t
"""


PERTURBED = """
a AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN NULL ELSE o_orderpriority END
           AS o_orderpriority
  FROM orders),
b0 AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END
           AS o_totalprice,
         o_orderdate,
         CASE WHEN (o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O')
                OR (o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F') THEN NULL ELSE o_orderpriority END
           AS o_orderpriority
  FROM orders WHERE NOT (o_orderpriority = '2-HIGH' AND o_orderstatus = 'O')),
b AS (SELECT * FROM b0 UNION ALL SELECT * FROM b0 WHERE o_orderstatus = 'P')
"""


def except_rows() -> str:
    return f"WITH {PERTURBED} SELECT * FROM a EXCEPT SELECT * FROM b"


def sym_diff() -> str:
    return f"""
WITH {PERTURBED}
SELECT *, 'left_only' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) l
UNION ALL
SELECT *, 'right_only' AS side FROM (SELECT * FROM b EXCEPT SELECT * FROM a) r
"""


def utf8_gate() -> str:
    # Latin-1 bytes of a text are valid UTF-8 exactly when it has no U+0080..U+00FF character
    return r"SELECT doc_id, NOT regexp_matches(text, '[\x{80}-\x{FF}]') AS valid_utf8 FROM documents"


def utf8_lossy() -> str:
    return "SELECT doc_id, CAST(doc_id % 3 AS BIGINT) AS replaced, text FROM documents"


def stream_ledger() -> str:
    return f"SELECT {ST1_PATH} AS file, CASE WHEN {OK_DAY} THEN 'loaded' ELSE 'skipped' END AS status FROM ({DAYS}) x"


def rows_loaded() -> str:
    ok = f"SELECT strftime(d, '%Y%m%d') || '_WELLS' AS report, CAST(n AS BIGINT) AS rows, 'loaded' AS status FROM ({DAYS}) x WHERE {OK_DAY}"
    bad = f"SELECT strftime(d, '%Y%m%d') || '_WELLS_short' AS report, 0 AS rows, 'skipped' AS status FROM ({DAYS}) x WHERE dayofmonth(d) = 5"
    return f"{ok} UNION ALL {bad}"


def crash_replay() -> str:
    cols = ", ".join(ST1.columns)
    return f"""
WITH s AS ({st1_stored()})
SELECT {cols}, count(*) * CASE WHEN date LIKE '1992%' THEN 2 ELSE 1 END AS copies FROM s GROUP BY {cols}
"""


def pruned_range() -> str:
    in_days = """CAST(date AS DATE) IN (SELECT CAST(o_orderdate AS DATE) FROM orders
      WHERE o_orderpriority = '2-HIGH' AND quarter(o_orderdate) = 2 AND year(o_orderdate) = 1995)"""
    in_range = f"CAST(date AS DATE) BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'"
    parts = [("csv_range", in_range), ("csv_days", in_days), ("table_range", in_range), ("table_days", in_days)]
    return f"WITH s AS ({st1_stored()})" + " UNION ALL ".join(f" SELECT *, '{k}' AS part FROM s WHERE {w}" for k, w in parts)


def reconcile_fingerprint() -> str:
    return f"""
WITH days AS (SELECT count(DISTINCT date) AS days_read FROM ({st1_stored()}) s WHERE dayofmonth(CAST(date AS DATE)) IN (5, 6, 7))
SELECT r.*, d.days_read FROM ({reconcile(st1_stored(), 'licensee')}) r, days d
"""


def archive_records() -> str:
    mmdd = "strftime(d, '%m%d')"
    nested = f"CASE WHEN dayofmonth(d) = 28 THEN 'WELLS' || {mmdd} || '.zip!' ELSE '' END"
    path = f"'WELLS' || {mmdd} || '_' || strftime(d, '%Y') || '.zip!' || {nested} || 'WELLS' || {mmdd} || '.TXT'"
    return f"SELECT {path} AS path, s.* EXCLUDE (path, d) FROM (SELECT *, CAST(date AS DATE) AS d FROM ({st1_records()})) s"


def date_range_saved() -> str:
    return f"SELECT *, 1 AS texts FROM ({st1_records()}) WHERE CAST(date AS DATE) BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'"


def custom_islands() -> str:
    return """
SELECT 'CONV' || CAST(conv_id % 5 AS VARCHAR) || '.TXT' AS path,
       dense_rank() OVER (PARTITION BY conv_id % 5 ORDER BY conv_id) - 1 AS record_no,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS part_no,
       lpad(CAST(conv_id AS VARCHAR), 10, '0') AS conv_id, CAST(turn AS VARCHAR) AS turn, role, md5(text) AS text_md5
FROM conversations
"""


def csv_glob_view() -> str:
    return f"SELECT * FROM ({st1_stored()}) t WHERE date >= '1996' AND date < '1998'"


def reconcile(stored: str, column: str) -> str:
    return f"""
WITH c AS ({stored}),
k AS (SELECT * REPLACE (CASE WHEN dayofmonth(CAST(date AS DATE)) = 5 THEN 'x' || {column} ELSE {column} END AS {column})
      FROM c WHERE dayofmonth(CAST(date AS DATE)) <> 6),
t AS (SELECT * FROM k UNION ALL SELECT * FROM k WHERE dayofmonth(CAST(date AS DATE)) = 7),
u AS (SELECT *, 1 AS a, 0 AS b FROM c UNION ALL SELECT *, 0, 1 FROM t),
g AS (SELECT * EXCLUDE (a, b), sum(a) AS a, sum(b) AS b FROM u GROUP BY ALL)
SELECT * EXCLUDE (a, b), CASE WHEN a > b THEN 'left_only' ELSE 'right_only' END AS side, CAST(abs(a - b) AS BIGINT) AS copies
FROM g WHERE a <> b
"""


def folder_status() -> str:
    ok = f"CASE WHEN {OK_DAY} THEN n ELSE 0 END"
    return f"""
SELECT {ST1_PATH} AS path, {STATUS_BY_DAY} AS status, false AS recoverable, CAST({ok} AS BIGINT) AS records FROM ({DAYS}) x
UNION ALL SELECT {ST49_PATH}, 'date_parse', false, 0 FROM ({DAYS}) x
UNION ALL SELECT {ST49_PATH} || '.dat', 'file_format', true, 0 FROM ({DAYS}) x
"""


def ingest_file() -> str:
    first = "(SELECT strftime(min(CAST(o_orderdate AS DATE)), '%Y-%m-%d') FROM orders)"
    return f"SELECT * REPLACE ('ALL.TXT' AS path) FROM ({st1_records()}) r WHERE date = {first}"


URL_BASE = "https://reports.example.invalid/well-lic/"

CALENDAR = """
b AS (SELECT min(CAST(o_orderdate AS DATE)) AS s, max(CAST(o_orderdate AS DATE)) AS e FROM orders),
cal AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS report_date FROM b)
"""


def download_plan() -> str:
    return f"""
WITH {CALENDAR}
SELECT report_date, '{URL_BASE}WELLS' || strftime(report_date, '%m%d') || '.TXT' AS url,
       'WELLS' || strftime(report_date, '%m%d%Y') || '.TXT' AS target
FROM cal
"""


def fetch_reports() -> str:
    return f"""
WITH {CALENDAR},
days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT report_date, 'WELLS' || strftime(report_date, '%m%d%Y') || '.TXT' AS target,
       CASE WHEN d IS NULL THEN 'failed' ELSE 'ok' END AS status
FROM cal LEFT JOIN days ON d = report_date
"""


def archive_members() -> str:
    return r"""
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
n AS (
  SELECT CASE WHEN dayofmonth(d) = 29 THEN 'WELLS_ARCHIVE.zip'
              ELSE 'WELLS' || strftime(d, '%m%d') || '_' || strftime(d, '%Y') || '.zip' END AS archive,
         CASE WHEN dayofmonth(d) = 30 THEN 'README'
              WHEN dayofmonth(d) = 31 THEN '../evil.TXT'
              WHEN dayofmonth(d) = 28 THEN 'WELLS' || strftime(d, '%m%d') || '.zip'
              WHEN dayofmonth(d) = 27 THEN 'docs/'
              WHEN dayofmonth(d) % 5 = 0 THEN 'WELLS' || strftime(d, '%m%d') || '.txt'
              ELSE 'WELLS' || strftime(d, '%m%d') || '.TXT' END AS member
  FROM days),
p AS (
  SELECT archive, member,
         TRY_CAST(right(regexp_replace(archive, '\.[^.]*$', ''), 4) AS INTEGER) AS year,
         regexp_extract(member, '([^/]*)$', 1) AS mname
  FROM n),
q AS (
  SELECT *, CASE WHEN mname LIKE '%.%' THEN regexp_extract(mname, '^(.*)\.[^.]*$', 1) ELSE mname END AS mstem,
            CASE WHEN mname LIKE '%.%' THEN regexp_extract(mname, '\.([^.]*)$', 1) END AS mext
  FROM p),
r AS (
  SELECT archive, member, year, mstem, mext,
         CASE WHEN year IS NULL THEN 'error'
              WHEN member LIKE '%/' THEN 'directory'
              WHEN member LIKE '/%' OR member LIKE '%../%' OR member LIKE '..%' THEN 'unsafe'
              WHEN mext IS NULL OR mstem = '' THEN 'skipped'
              WHEN mext = 'zip' THEN 'nested'
              WHEN mext IN ('TXT', 'txt') THEN 'extracted'
              ELSE 'skipped' END AS status
  FROM q)
SELECT archive, member, year,
       CASE WHEN status = 'extracted' THEN mstem || CAST(year AS VARCHAR) || '.' || mext END AS out_name, status
FROM r
"""


def archive_expand() -> str:
    return """
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
k AS (SELECT d, strftime(d, '%m%d') AS mmdd, CAST(year(d) AS INTEGER) AS y, 'WELLS' || strftime(d, '%m%d') || '_' || strftime(d, '%Y') || '.zip' AS outer_zip FROM days)
SELECT CASE WHEN dayofmonth(d) = 28 THEN outer_zip || '!WELLS' || mmdd || '.zip' ELSE outer_zip END AS archive,
       'WELLS' || mmdd || '.TXT' AS member, y AS year, 'WELLS' || mmdd || CAST(y AS VARCHAR) || '.TXT' AS out_name,
       'extracted' AS status
FROM k
UNION ALL SELECT outer_zip, 'README', y, NULL, 'skipped' FROM k WHERE dayofmonth(d) = 30
UNION ALL SELECT outer_zip, 'docs/', y, NULL, 'directory' FROM k WHERE dayofmonth(d) = 30
UNION ALL SELECT outer_zip, '../evil.TXT', y, NULL, 'unsafe' FROM k WHERE dayofmonth(d) = 31
"""


def report_routing() -> str:
    return r"""
WITH n AS (
  SELECT doc_id,
         lpad(CAST(doc_id AS VARCHAR), 6, '0') ||
           CASE lang WHEN 'en' THEN '.TXT' WHEN 'fr' THEN '.txt' WHEN 'de' THEN '.csv' ELSE '' END AS name,
         CASE WHEN length(source) = 4 THEN 'ST1' WHEN source IN ('src10', 'src11', 'src12') THEN 'st49'
              WHEN source = 'src13' THEN 'Bogus' ELSE 'St49' END AS requested
  FROM documents),
t AS (
  SELECT *, CASE lower(trim(requested)) WHEN 'st1' THEN 'st1' WHEN 'st49' THEN 'st49' END AS report_type FROM n),
s AS (
  SELECT *, CASE report_type WHEN 'st1' THEN 'WELLS' WHEN 'st49' THEN 'SPUD' END AS prefix,
            CASE report_type WHEN 'st1' THEN 'TXT' WHEN 'st49' THEN 'txt' END AS extension
  FROM t),
v AS (SELECT *, coalesce(ends_with(lower(name), lower(extension)), false) AS valid_extension FROM s)
SELECT doc_id, name, requested, report_type, prefix, extension, valid_extension,
       CASE WHEN report_type IS NULL THEN 'Invalid report type: ' || requested
            WHEN NOT valid_extension THEN 'Invalid file extension. Expected: ' || extension || ', Got: ' ||
              CASE WHEN name LIKE '%.%' THEN regexp_extract(name, '\.([^.]*)$', 1) ELSE 'none' END
       END AS message
FROM v
"""
