"""Common table expressions that state the star-schema graph in plain SQL."""

DISPLAY = "trim(split_part(rtrim({0}, '.#()/'), '/', -1), '`')"


def display(column):
    return DISPLAY.format(column)


REPO = "'repo-' || CAST(o_custkey % 5 AS VARCHAR)"

PARTS = """parts AS (
  SELECT p_partkey AS part_id,
    CASE WHEN p_partkey % 10 = 0 THEN 'local ' || CAST(p_partkey AS VARCHAR)
    ELSE 'scip-go gomod github.com/org/' || replace(p_brand, '#', '-') || ' v' || CAST(p_size AS VARCHAR)
      || ' `github.com/org/' || lower(p_type) || '`/' || replace(p_name, ' ', '_') || '#' END AS symbol
  FROM part)"""

_PATH = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'publisher' WHEN '2' THEN 'consumer'
      WHEN '3' THEN 'internal' WHEN '4' THEN 'pkg' ELSE 'handlers' END
    || '/order_' || CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderkey % 50 = 0 THEN '.pb.go' ELSE '.go' END"""

DOCS = f"""docs AS (
  SELECT {REPO} AS source, o_orderkey AS doc_id, {_PATH} AS relative_path,
    CASE o_orderstatus WHEN 'F' THEN 'go' WHEN 'O' THEN 'typescript' ELSE 'python' END AS language
  FROM orders)"""

TEXT_DOCS = f"""docs AS (
  SELECT {REPO} AS source, o_orderkey AS doc_id,
    CASE WHEN t.lang IS NOT NULL THEN t.lang || '/doc_' || CAST(o_orderkey AS VARCHAR) || '.txt' ELSE {_PATH} END
      AS relative_path
  FROM orders LEFT JOIN documents t ON t.doc_id = o_orderkey)"""

_EDGES = """edges AS (
  SELECT DISTINCT d.source, d.doc_id, l_linenumber, p.part_id, p.symbol,
    l_orderkey * 10 + l_linenumber AS chunk_id,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 1 WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 17
      WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 8 WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 4
      WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 2 WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 0
      END AS role
  FROM lineitem JOIN docs d ON d.doc_id = l_orderkey JOIN parts p ON p.part_id = l_partkey)"""

_TABLES = """chunks AS (
  SELECT DISTINCT source, chunk_id, doc_id, CAST(l_linenumber - 1 AS INTEGER) AS chunk_index,
    CAST((l_linenumber - 1) * 20 AS INTEGER) AS start_line, CAST((l_linenumber - 1) * 20 + 19 AS INTEGER) AS end_line
  FROM edges),
symbols AS (SELECT source, symbol, min(part_id) AS symbol_id FROM edges GROUP BY source, symbol),
mentions AS (
  SELECT DISTINCT e.source, e.chunk_id, s.symbol_id, CAST(e.role AS INTEGER) AS role
  FROM edges e JOIN symbols s ON s.source = e.source AND s.symbol = e.symbol),
ranges AS (
  SELECT m.source, m.symbol_id, c.doc_id, c.start_line + 2 AS start_line, 0 AS start_char,
    CAST(c.start_line + 2 + m.symbol_id % 15 AS INTEGER) AS end_line, 1 AS end_char
  FROM mentions m JOIN chunks c ON c.source = m.source AND c.chunk_id = m.chunk_id
  WHERE m.role = 1 AND c.chunk_index % 2 = 0),
rels AS (
  SELECT a.source, a.symbol_id, a.symbol, b.symbol AS target, a.symbol_id % 2 = 0 AS is_reference,
    a.symbol_id % 3 = 0 AS is_implementation
  FROM symbols a JOIN symbols b ON b.source = a.source AND b.symbol_id = a.symbol_id - 1)"""

RAW = f"WITH {DOCS}, {PARTS}, {_EDGES}, {_TABLES}"
RAW_TEXT = f"WITH {TEXT_DOCS}, {PARTS}, {_EDGES}, {_TABLES}"

KEY = ("CASE WHEN {0} LIKE 'scip-go gomod %' THEN 'scip-go gomod * * ' || substr({0}, position('`' IN {0})) "
       "ELSE {1} || '|' || {0} END")

_MERGED = f"""keyed AS (SELECT *, {KEY.format('symbol', 'source')} AS nkey FROM symbols),
canon AS (
  SELECT nkey, source AS csource, symbol_id AS cid, symbol AS csymbol FROM (
    SELECT *, row_number() OVER (PARTITION BY nkey ORDER BY source, symbol_id) AS rn FROM keyed) WHERE rn = 1),
smap AS (SELECT k.source, k.symbol_id, c.csource, c.cid FROM keyed k JOIN canon c ON c.nkey = k.nkey),
msym AS (
  SELECT csource AS symbol_source, cid AS symbol_id,
    CASE WHEN csymbol LIKE 'scip-go gomod %' THEN csymbol ELSE csource || '/' || csymbol END AS symbol FROM canon),
mdocs AS (SELECT source, doc_id, source || '/' || relative_path AS relative_path, language FROM docs),
mment AS (
  SELECT DISTINCT m.source, m.chunk_id, p.csource AS symbol_source, p.cid AS symbol_id, m.role
  FROM mentions m JOIN smap p ON p.source = m.source AND p.symbol_id = m.symbol_id),
mrange AS (
  SELECT r.source, p.csource AS symbol_source, p.cid AS symbol_id, r.doc_id, r.start_line, r.start_char, r.end_line,
    r.end_char
  FROM ranges r JOIN smap p ON p.source = r.source AND p.symbol_id = r.symbol_id),
sites AS (
  SELECT m.source, m.symbol_source, m.symbol_id, s.symbol, m.role, d.relative_path AS file, c.start_line, c.end_line
  FROM mment m JOIN chunks c ON c.source = m.source AND c.chunk_id = m.chunk_id
  JOIN mdocs d ON d.source = c.source AND d.doc_id = c.doc_id
  JOIN msym s ON s.symbol_source = m.symbol_source AND s.symbol_id = m.symbol_id),
rsites AS (
  SELECT r.source, r.symbol_source, r.symbol_id, s.symbol, d.relative_path AS file, r.start_line, r.end_line,
    r.start_char, r.end_char
  FROM mrange r JOIN mdocs d ON d.source = r.source AND d.doc_id = r.doc_id
  JOIN msym s ON s.symbol_source = r.symbol_source AND s.symbol_id = r.symbol_id)"""

MERGED = f"{RAW}, {_MERGED}"


# The merged graph with one document per customer, which holds all lines of all orders: files with many symbols.
WIDE = f"""{MERGED}, wdocs AS (
  SELECT DISTINCT {REPO} AS source, o_custkey AS doc_id, {REPO} || '/customer_' || CAST(o_custkey AS VARCHAR) || '.go' AS relative_path
  FROM orders),
wsites AS (
  SELECT m.source, m.symbol_source, m.symbol_id, s.symbol, m.role, d.relative_path AS file, c.start_line, c.end_line
  FROM mment m JOIN chunks c ON c.source = m.source AND c.chunk_id = m.chunk_id
  JOIN orders o ON o.o_orderkey = c.doc_id JOIN wdocs d ON d.doc_id = o.o_custkey
  JOIN msym s ON s.symbol_source = m.symbol_source AND s.symbol_id = m.symbol_id)"""


def values(column, items):
    rows = ", ".join(f"('{item}', '{item}')" for item in items)
    return f"asked(query_id, {column}) AS (VALUES {rows})"


BATCH_NAMES = "asked AS (SELECT DISTINCT replace(p_name, ' ', '_') AS query_id, replace(p_name, ' ', '_') AS name FROM part)"


def matched(symbols="msym", cap=50, pattern="'%' || q.name || '%'", exact_first=False):
    """Matched symbols per query with their rank by length, and whether the name is exact."""
    exact = f"({display('s.symbol')} = q.name)"
    first = f"CASE WHEN {exact} THEN 0 ELSE 1 END, " if exact_first else ""
    keep = "" if cap is None else f"WHERE length_rank <= {cap}"
    return f"""pairs AS (
  SELECT q.query_id, q.name, s.*, {display('s.symbol')} AS display_name, {exact} AS is_exact,
    dense_rank() OVER (PARTITION BY q.query_id ORDER BY {first}length(s.symbol), s.symbol) AS length_rank
  FROM asked q JOIN {symbols} s ON s.symbol ILIKE {pattern}),
matched AS (SELECT * FROM pairs {keep})"""
