"""Queries over the source corpus derived from `part`, with the SQL that expects their results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborflow.operators import calls, control, data, names, notices, reach, report, tree
from arborflow.operators.events import element_events, run_id
from arborflow.operators.syntax import FLOW_ROLES, extract
from arborflow.plans.corpus import TEMPLATES, load_sources
from arborflow.plans.graph import build_graph
from oracle.golden import EDGES, NODES

STAMP = "2026-01-01T00:00:00.000000Z"


# ---------------------------------------------------------------- Spark side

def discover_filter(spark: SparkSession, folder: str) -> DataFrame:
    return report.discover(load_sources(spark, folder))


def discovery_report(spark: SparkSession, folder: str) -> DataFrame:
    return report.discovery_report(load_sources(spark, folder))


def ast_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return tree.ast_nodes(extract(load_sources(spark, folder), stored=False))


def ast_edges(spark: SparkSession, folder: str) -> DataFrame:
    return tree.ast_edges(extract(load_sources(spark, folder), stored=False))


def scope_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return tree.scope_nodes(extract(load_sources(spark, folder), stored=False))


def parse_errors(spark: SparkSession, folder: str) -> DataFrame:
    return extract(load_sources(spark, folder), stored=False).errors


def cfg_edges(spark: SparkSession, folder: str) -> DataFrame:
    return control.cfg_edges(control.flow_edges(extract(load_sources(spark, folder))))


def def_use(spark: SparkSession, folder: str) -> DataFrame:
    return names.def_use(extract(load_sources(spark, folder), stored=False, roles=["def", "use"])).drop("file")


def _reach(spark: SparkSession, folder: str):
    syntax = extract(load_sources(spark, folder), roles=FLOW_ROLES)
    flow = syntax.keep(control.flow_edges(syntax), "flow")
    return syntax, *reach.reaching_definitions(syntax, flow)


def reaching_defs(spark: SparkSession, folder: str) -> DataFrame:
    return _reach(spark, folder)[1].select("file_id", "variable", "use_id", "def_id")


def dfg_edges(spark: SparkSession, folder: str) -> DataFrame:
    syntax, pairs, unresolved = _reach(spark, folder)
    return data.dfg_edges(pairs, data.outside_uses(syntax, unresolved))


def external_nodes(spark: SparkSession, folder: str) -> DataFrame:
    syntax, _, unresolved = _reach(spark, folder)
    outside = data.dfg_externals(data.outside_uses(syntax, unresolved))
    return outside.unionByName(calls.call_externals(calls.resolve_calls(syntax)))


def call_resolve(spark: SparkSession, folder: str) -> DataFrame:
    return calls.call_edges(calls.resolve_calls(extract(load_sources(spark, folder))))


def warnings(spark: SparkSession, folder: str) -> DataFrame:
    return notices.warnings(extract(load_sources(spark, folder)))


def _as_text(counts: str):
    return F.array_join(
        F.transform(F.array_sort(F.map_entries(counts)), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ","
    ).alias(counts)


def kind_counts(spark: SparkSession, folder: str) -> DataFrame:
    graph = build_graph(load_sources(spark, folder))
    both = report.kind_counts(graph.nodes, "node_counts").join(report.kind_counts(graph.edges, "edge_counts"), "file_id", "full_outer")
    return both.select("file_id", _as_text("node_counts"), _as_text("edge_counts"))


def corpus_totals(spark: SparkSession, folder: str) -> DataFrame:
    files = load_sources(spark, folder)
    graph = build_graph(files)
    return report.corpus_totals(graph.nodes, graph.edges, graph.warnings, files)


def totals_by_kind(spark: SparkSession, folder: str) -> DataFrame:
    graph = build_graph(load_sources(spark, folder))
    return report.totals_by_kind(graph.nodes, graph.edges)


def required_kinds(spark: SparkSession, folder: str) -> DataFrame:
    return report.required_kinds(build_graph(load_sources(spark, folder)).edges)


def event_build(spark: SparkSession, folder: str) -> DataFrame:
    """Upserts of every syntax node, deletes of every syntax edge."""
    files = load_sources(spark, folder)
    syntax = extract(files)
    common = files.select(
        "file_id", "repo_id", F.sha2("content", 256).alias("content_hash"), F.lit(STAMP).alias("event_time"),
        run_id(F.lit("check"), F.col("file_id")).alias("run_id"),
    )
    common = syntax.dealt(common)
    return element_events(tree.ast_nodes(syntax).join(common, "file_id"), "node", "upsert").unionByName(
        element_events(tree.ast_edges(syntax).select("id", "file_id").join(common, "file_id"), "edge", "delete")
    )


QUERIES = {f.__name__: f for f in (
    discover_filter, discovery_report, ast_nodes, ast_edges, scope_nodes, parse_errors, cfg_edges, def_use, reaching_defs,
    dfg_edges, external_nodes, call_resolve, warnings, kind_counts, totals_by_kind, corpus_totals, required_kinds,
    event_build,
)}


# ---------------------------------------------------------------- SQL side

def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _number(text: str) -> str:
    base, _, plus = text.partition("+")
    return f"{base},{1 if plus else 0}"


def _node_values() -> str:
    rows = []
    for t, text in NODES.items():
        for pos, line in enumerate(text.strip().split("\n")):
            path, kind, l1, c1, l2, c2, name, value = line.split("|")
            rows.append(f"({t},{pos},{_quote(path)},{_quote(kind)},{l1},{_number(c1)},{l2},{_number(c2)},{_quote(name)},{_quote(value)})")
    return ",\n".join(rows)


def _edge_values() -> str:
    rows = []
    for t, text in EDGES.items():
        for line in text.strip().split("\n"):
            kind, source, target, label, resolved = line.split("|")
            rows.append(f"({t},{_quote(kind)},{_quote(source)},{_quote(target)},{_quote(label)},{resolved})")
    return ",\n".join(rows)


_CONTENT = "CASE t " + " ".join(f"WHEN {i} THEN replace({_quote(s)}, '{{K}}', k)" for i, s in enumerate(TEMPLATES)) + " END"

PY = f"""
part_keys AS (
  SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS k, CAST(p_partkey % 5 AS INTEGER) AS t,
    'corpus/' || lower(p_type) AS repo_id,
    'pkg' || (p_size % 5) || '/'
      || CASE p_partkey % 7 WHEN 0 THEN 'tests/' WHEN 1 THEN 'build/' WHEN 2 THEN 'generated/' ELSE '' END
      || 'mod_' || p_partkey || CASE p_partkey % 11 WHEN 0 THEN '_pb2' WHEN 1 THEN '_test' ELSE '' END || '.py' AS fpath
  FROM part),
py AS (SELECT *, sha256(concat_ws(chr(31), repo_id, fpath)) AS file_id, {_CONTENT} AS content,
    sha256({_CONTENT}) AS content_hash FROM part_keys)"""

GOLDEN = f"""
gn(t, pos, path, type, line, col, colk, eline, ecol, ecolk, name, val) AS (VALUES
{_node_values()}),
ge(t, kind, source, target, label, resolved) AS (VALUES
{_edge_values()}),
places AS (
  SELECT t, path, type FROM gn
  UNION SELECT t, path || '.__entry__', 'ScopeEntry' FROM gn WHERE type IN ('Module','FunctionDef','AsyncFunctionDef','ClassDef')
  UNION SELECT t, path || '.__exit__', 'ScopeExit' FROM gn WHERE type IN ('Module','FunctionDef','AsyncFunctionDef','ClassDef')
  UNION SELECT t, source, 'ExternalSymbol' FROM ge WHERE source LIKE '%.__external__.%'
  UNION SELECT t, target, 'ExternalSymbol' FROM ge WHERE target LIKE '%.__external__.%'),
tree AS (
  SELECT c.t, p.path AS source, c.path AS target, list_extract(regexp_extract_all(c.path, '[^.]+$'), 1) AS label
  FROM gn c JOIN gn p ON p.t = c.t AND p.path = regexp_replace(c.path, '\\.[^.]*$', '') AND c.path <> '$'),
all_edges AS (
  SELECT t, 'AST' AS kind, source, target, label, true AS resolved FROM tree
  UNION ALL SELECT * FROM ge)"""

NODE_ROW = """
  SELECT sha256(concat_ws(chr(31), file_id, path, type)) AS id, 'AST' AS kind, type AS ast_type, file_id,
    path AS structural_path, line, CAST(col + colk * length(k) AS INTEGER) AS "column", eline AS end_line,
    CAST(ecol + ecolk * length(k) AS INTEGER) AS end_column, name, replace(val, '{K}', k) AS value
  FROM py JOIN gn USING (t)"""


def _made(where: str, kind: str, name: str) -> str:
    return f"""
  SELECT sha256(concat_ws(chr(31), file_id, path, type)) AS id, '{kind}' AS kind, type AS ast_type, file_id,
    path AS structural_path, 0 AS line, 0 AS "column", 0 AS end_line, 0 AS end_column, {name} AS name, '' AS value
  FROM py JOIN places USING (t) WHERE {where}"""


SCOPE_ROW = _made("type IN ('ScopeEntry','ScopeExit')", "SYNTHETIC", "CASE type WHEN 'ScopeEntry' THEN 'ENTRY' ELSE 'EXIT' END")
EXTERNAL_ROW = _made("type = 'ExternalSymbol'", "EXTERNAL", "regexp_replace(path, '^.*\\.__external__\\.(dfg|call):', '')")


def _edge_rows(where: str) -> str:
    return f"""
  SELECT sha256(concat_ws(chr(31), kind, source_id, target_id, label)) AS id, kind, source_id, target_id, file_id,
    label AS discriminator, CASE kind WHEN 'DFG' THEN label ELSE '' END AS variable, resolved
  FROM (SELECT file_id, e.kind, e.label, e.resolved,
      sha256(concat_ws(chr(31), file_id, e.source, s.type)) AS source_id,
      sha256(concat_ws(chr(31), file_id, e.target, d.type)) AS target_id
    FROM py JOIN all_edges e USING (t)
    JOIN places s ON s.t = e.t AND s.path = e.source JOIN places d ON d.t = e.t AND d.path = e.target) AS x
  WHERE {where}"""


_HEAD = f"WITH {PY},{GOLDEN}"
_ALL_NODES = f"nodes AS ({NODE_ROW} UNION ALL {SCOPE_ROW} UNION ALL {EXTERNAL_ROW})"
_ALL_EDGES = f"edges AS ({_edge_rows('true')})"

_LINES = "length(content) - length(replace(content, chr(10), ''))"

SQL = {
    "discover_filter": f"""WITH {PY}
SELECT repo_id, fpath AS path, file_id,
  p_partkey % 7 NOT IN (0, 1, 2) AND p_partkey % 11 NOT IN (0, 1) AS included FROM py""",
    "discovery_report": f"""WITH {PY}
SELECT repo_id, 'https://github.com/' || repo_id || '.git' AS repo_url, '' AS commit_sha,
  count(*) AS raw_python_files, count(*) FILTER (inc) AS processed_python_files,
  count(*) FILTER (NOT inc) AS excluded_python_files, CAST(coalesce(sum({_LINES}) FILTER (inc), 0) AS BIGINT) AS total_lines,
  count(*) FILTER (inc AND t <> 3) AS parseable_files,
  round(count(*) FILTER (inc AND t <> 3) / count(*) FILTER (inc), 4) AS parse_success_rate,
  coalesce(bool_or(t IN (1, 2, 4)) FILTER (inc), false) AS has_branch,
  coalesce(bool_or(t IN (2, 4)) FILTER (inc), false) AS has_loop,
  coalesce(bool_or(t IN (2, 4)) FILTER (inc), false) AS has_call
FROM (SELECT *, p_partkey % 7 NOT IN (0, 1, 2) AND p_partkey % 11 NOT IN (0, 1) AS inc FROM py) GROUP BY repo_id""",
    "ast_nodes": _HEAD + NODE_ROW,
    "ast_edges": _HEAD + _edge_rows("kind = 'AST'"),
    "scope_nodes": _HEAD + SCOPE_ROW,
    "external_nodes": _HEAD + EXTERNAL_ROW,
    "cfg_edges": _HEAD + _edge_rows("kind = 'CFG'"),
    "dfg_edges": _HEAD + _edge_rows("kind = 'DFG'"),
    "call_resolve": _HEAD + _edge_rows("kind = 'CALL'"),
    "reaching_defs": f"""{_HEAD}, {_ALL_EDGES}
SELECT file_id, variable, target_id AS use_id, source_id AS def_id FROM edges WHERE kind = 'DFG' AND resolved""",
    "def_use": f"""{_HEAD},
occ AS (
  SELECT n.t, n.pos, n.path, n.type, 'use' AS role, n.name AS variable FROM gn n JOIN gn c ON c.t = n.t AND c.path = n.path || '.ctx' AND c.type = 'Load' WHERE n.type = 'Name'
  UNION ALL SELECT n.t, n.pos, n.path, n.type, 'def', n.name FROM gn n JOIN gn c ON c.t = n.t AND c.path = n.path || '.ctx' AND c.type <> 'Load' WHERE n.type = 'Name'
  UNION ALL SELECT t, pos, path, type, 'def', name FROM gn WHERE type IN ('FunctionDef','AsyncFunctionDef','ClassDef')
  UNION ALL SELECT t, pos, path, type, 'def', CASE name WHEN 'os.path' THEN 'os' WHEN 'dumps' THEN 'encode' END FROM gn WHERE type = 'alias'),
stmts AS (SELECT * FROM gn WHERE type IN ('Assign','AugAssign','If','Return','For','While','Continue','Break','Import','ImportFrom',
  'FunctionDef','AsyncFunctionDef','ClassDef','Expr','Try','TryStar','With','Match','Raise','Delete')),
walls AS (SELECT * FROM gn WHERE type IN ('FunctionDef','AsyncFunctionDef','ClassDef','Lambda')),
owned AS (
  SELECT o.*, s.pos AS stmt FROM occ o JOIN stmts s ON s.t = o.t AND (s.path = o.path OR starts_with(o.path, s.path || '.'))
  WHERE NOT EXISTS (SELECT 1 FROM walls b WHERE b.t = o.t AND b.path <> o.path AND starts_with(o.path, b.path || '.')
    AND (b.path = s.path OR starts_with(b.path, s.path || '.')))),
placed AS (SELECT *, lag(stmt) OVER (PARTITION BY t, pos, role ORDER BY stmt) AS outer_stmt FROM owned)
SELECT file_id, CAST(stmt AS INTEGER) AS stmt, CAST(outer_stmt AS INTEGER) AS "outer", role, variable,
  sha256(concat_ws(chr(31), file_id, path, type)) AS node_id
FROM py JOIN placed USING (t)""",
    "warnings": f"""WITH {PY}
SELECT file_id, ord, txt AS text FROM py JOIN (VALUES
  (4, 1, 'match guards are conservative at line 20'), (4, 2, 'exception flow is conservative at line 7')) w(t, ord, txt) USING (t)""",
    "parse_errors": f"""WITH {PY}
SELECT file_id, 'SyntaxError' AS exception_type, 'expected '':'' (' || regexp_replace(fpath, '^.*/', '') || ', line 2)' AS message,
  2 AS line, CAST(12 + length(k) AS INTEGER) AS "column",
  'File "' || fpath || '", line 2' || chr(10) || '    if total > ' || k || chr(10) || '    ' || repeat(' ', 11 + length(k)) || '^' || chr(10) || 'SyntaxError: expected '':''' AS traceback
FROM py WHERE t = 3""",
    "kind_counts": f"""{_HEAD}, {_ALL_NODES}, {_ALL_EDGES},
nc AS (SELECT file_id, string_agg(kind || '=' || n, ',' ORDER BY kind) AS node_counts FROM (SELECT file_id, kind, count(*) AS n FROM nodes GROUP BY ALL) GROUP BY file_id),
ec AS (SELECT file_id, string_agg(kind || '=' || n, ',' ORDER BY kind) AS edge_counts FROM (SELECT file_id, kind, count(*) AS n FROM edges GROUP BY ALL) GROUP BY file_id)
SELECT file_id, node_counts, edge_counts FROM nc FULL JOIN ec USING (file_id)""",
    "corpus_totals": f"""{_HEAD}, {_ALL_NODES}, {_ALL_EDGES},
n AS (SELECT count(*) AS nodes, count(DISTINCT id) AS distinct_nodes FROM nodes),
e AS (SELECT count(*) AS edges, count(DISTINCT id) AS distinct_edges FROM edges)
SELECT (SELECT count(*) FROM part) AS files, nodes, distinct_nodes, edges, distinct_edges,
  2 * (SELECT count(*) FROM py WHERE t = 4) AS warnings,
  nodes = distinct_nodes AS all_node_ids_unique, edges = distinct_edges AS all_edge_ids_unique FROM n, e""",
    "totals_by_kind": f"""{_HEAD}, {_ALL_NODES}, {_ALL_EDGES}
SELECT 'node' AS element_type, kind, count(*) AS elements, count(DISTINCT file_id) AS files FROM nodes GROUP BY kind
UNION ALL SELECT 'edge', kind, count(*), count(DISTINCT file_id) FROM edges GROUP BY kind""",
    "required_kinds": f"""{_HEAD}, {_ALL_EDGES}, have AS (SELECT file_id, list(DISTINCT kind) AS kinds FROM edges GROUP BY file_id)
SELECT file_id, array_to_string(list_filter(['AST','CALL','CFG','DFG'], lambda x: NOT list_contains(kinds, x)), ',') AS missing,
  len(kinds) = 4 AS complete FROM have""",
    "event_build": f"""{_HEAD}, {_ALL_EDGES},
common AS (SELECT *, left(sha256(concat_ws(chr(31), 'check', file_id)), 32) AS run_id FROM py),
n AS ({NODE_ROW}),
up AS (SELECT n.*, repo_id, content_hash, run_id FROM n JOIN common USING (file_id)),
down AS (SELECT id, file_id, repo_id, content_hash, run_id FROM edges JOIN common USING (file_id) WHERE kind = 'AST')
SELECT 'cpg.nodes.v1' AS topic, id AS key, CAST(to_json({{'content_hash': content_hash,
  'event_id': sha256(concat_ws(chr(31), 'node', 'upsert', id, content_hash)), 'event_time': '{STAMP}', 'file_id': file_id,
  'node': {{'ast_type': ast_type, 'column': "column", 'end_column': end_column, 'end_line': end_line, 'file_id': file_id, 'id': id,
    'kind': kind, 'line': line, 'name': name, 'structural_path': structural_path, 'value': value}},
  'op': 'upsert', 'repo_id': repo_id, 'run_id': run_id, 'schema_version': '1.0'}}) AS VARCHAR) AS value, 2 AS phase FROM up
UNION ALL
SELECT 'cpg.edges.v1', id, CAST(to_json({{'content_hash': content_hash, 'edge': {{'id': id}},
  'event_id': sha256(concat_ws(chr(31), 'edge', 'delete', id, content_hash)), 'event_time': '{STAMP}', 'file_id': file_id,
  'op': 'delete', 'repo_id': repo_id, 'run_id': run_id, 'schema_version': '1.0'}}) AS VARCHAR), 0 FROM down""",
}
