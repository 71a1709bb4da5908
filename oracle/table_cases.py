"""Queries over the driver's tables, with the SQL that expects their results."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborflow.functions import ids, paths, text
from arborflow.operators import checks, contracts, delta, merge, report, snapshots
from arborflow.operators.events import documents, parse_events
from arborflow.schemas import METADATA_EVENT
from arborflow.operators.graph_rows import EDGE_COLUMNS, NODE_COLUMNS
from arborflow.session import keep, work_root
from arborflow.sources.files import sources_from_table
from arborflow.sources.logs import append_log
from arborflow.streaming.jobs import graph_stream, metadata_stream, read_documents, read_graph


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


# ---------------------------------------------------------------- identity, text, paths

def stable_ids(spark, folder):
    docs = _table(spark, folder, "documents")
    file = ids.file_id("source", _text("doc_", F.col("doc_id"), ".txt"))
    node = ids.node_id("file_id", F.lit("$"), "lang")
    return docs.select("doc_id", "lang", file.alias("file_id")).withColumn("node_id", node).select(
        "doc_id", "file_id", "node_id",
        ids.edge_id(F.lit("AST"), "file_id", "node_id", F.lit("")).alias("edge_id"),
        ids.element_event_id(F.lit("node"), F.lit("upsert"), "node_id", "file_id").alias("node_event_id"),
        ids.metadata_event_id("file_id", "node_id", F.lit("ok")).alias("metadata_event_id"),
        ids.error_id("file_id", "node_id", F.lit("SyntaxError"), F.when(F.col("doc_id") % 2 == 0, F.lit(1)), F.lit(0)).alias("error_id"),
    )


SQL_IDS = """
WITH f AS (SELECT doc_id, lang, sha256(concat_ws(chr(31), source, 'doc_' || doc_id || '.txt')) AS file_id FROM documents),
n AS (SELECT *, sha256(file_id || chr(31) || '$' || chr(31) || lang) AS node_id FROM f)
SELECT doc_id, file_id, node_id, sha256('AST' || chr(31) || file_id || chr(31) || node_id || chr(31)) AS edge_id,
  sha256(concat_ws(chr(31), 'node', 'upsert', node_id, file_id)) AS node_event_id,
  sha256(concat_ws(chr(31), 'metadata', file_id, node_id, 'ok')) AS metadata_event_id,
  sha256(concat_ws(chr(31), file_id, node_id, 'SyntaxError', CASE WHEN doc_id % 2 = 0 THEN '1' ELSE 'None' END, '0')) AS error_id
FROM n"""


def content_fingerprint(spark, folder):
    docs = _table(spark, folder, "documents")
    files = sources_from_table(docs, F.col("source"), _text(F.col("doc_id"), ".py"), F.col("text"))
    return files.select(
        "file_id", text.content_hash(F.col("content")).alias("content_hash"),
        text.size_bytes(F.col("content")).cast("long").alias("size_bytes"),
        text.line_count(text.lenient_text(F.col("content"))).cast("long").alias("line_count"),
        text.clip(text.lenient_text(F.col("content")), 200).alias("head"),
    )


_BREAK = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]"
SQL_FINGERPRINT = f"""
SELECT sha256(concat_ws(chr(31), source, doc_id || '.py')) AS file_id, sha256(text) AS content_hash,
  CAST(octet_length(encode(text)) AS BIGINT) AS size_bytes,
  CAST(len(regexp_extract_all(text, '{_BREAK}')) + CASE WHEN text <> '' AND NOT regexp_matches(text, '({_BREAK})\\z') THEN 1 ELSE 0 END AS BIGINT) AS line_count,
  substring(text, 1, 200) AS head
FROM documents"""


def _clone_url():
    rest, shape = F.regexp_replace("url", r"^https?://", ""), F.col("page_id") % 5
    return (
        F.when(shape == 0, _text("https://github.com/", rest, ".git"))
        .when(shape == 1, _text("git@github.com:", rest, ".git"))
        .when(shape == 2, _text("https://github.com\\", F.replace(rest, F.lit("/"), F.lit("\\"))))
        .when(shape == 3, F.lit("https://github.com/"))
        .otherwise(F.col("url"))
    )


def repo_id_from_url(spark, folder):
    pages = _table(spark, folder, "pages").select("page_id", _clone_url().alias("clone_url"))
    return pages.select("page_id", paths.repo_id_from_url(F.col("clone_url"), _text("page", F.col("page_id"))).alias("repo_id"))


SQL_REPO = """
WITH p AS (SELECT page_id, regexp_replace(url, '^https?://', '') AS rest, url FROM pages),
u AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'https://github.com/' || rest || '.git' WHEN 1 THEN 'git@github.com:' || rest || '.git'
  WHEN 2 THEN 'https://github.com' || chr(92) || replace(rest, '/', chr(92)) WHEN 3 THEN 'https://github.com/' ELSE url END AS c FROM p),
m AS (SELECT page_id, replace(CASE WHEN ends_with(c, '.git') THEN left(c, length(c) - 4) ELSE c END, chr(92), '/') AS c FROM u)
SELECT page_id, CASE WHEN strpos(c, 'github.com') > 0 AND ltrim(substr(c, strpos(c, 'github.com') + 10), '/: ') <> ''
  THEN ltrim(substr(c, strpos(c, 'github.com') + 10), '/: ') ELSE 'page' || page_id END AS repo_id FROM m"""


def path_guard(spark, folder):
    rest, shape = F.regexp_replace("url", r"^https?://", ""), F.col("page_id") % 6
    asked = (
        F.when(shape == 0, _text("./", rest, "/./x.py")).when(shape == 1, _text("../", rest, ".py"))
        .when(shape == 2, _text(rest, "//../y.py")).when(shape == 3, _text("a/../../", rest, ".py"))
        .when(shape == 4, _text("/", rest, ".py")).otherwise(rest)
    )
    pages = _table(spark, folder, "pages").select("page_id", asked.alias("asked"))
    return pages.select(
        "page_id", paths.normalize_path(F.col("asked")).alias("path"), paths.inside_root(F.col("asked")).alias("inside")
    )


SQL_PATHS = """
WITH p AS (SELECT page_id, rtrim(regexp_replace(url, '^https?://', ''), '/') AS r, regexp_replace(url, '^https?://', '') AS raw FROM pages)
SELECT page_id, CASE page_id % 6 WHEN 0 THEN r || '/x.py' WHEN 1 THEN '../' || raw2 WHEN 2 THEN regexp_replace(r, '[^/]+$', '') || 'y.py'
    WHEN 3 THEN '../' || raw2 WHEN 4 THEN raw2 ELSE r END AS path,
  page_id % 6 IN (0, 2) AS inside
FROM (SELECT *, raw || '.py' AS raw2 FROM p) AS q"""


# ---------------------------------------------------------------- change detection

def _changes(spark, folder):
    """Documents as files; the state knows all but every seventh and has every fifth with another hash."""
    docs = _table(spark, folder, "documents")
    files = sources_from_table(docs, F.col("source"), F.col("doc_id").cast("string"), F.col("text"))
    stored = docs.where("doc_id % 7 <> 0").select(
        ids.file_id("source", F.col("doc_id").cast("string")).alias("file_id"),
        F.when(F.col("doc_id") % 5 == 0, "old").otherwise(F.sha2(F.col("text").cast("binary"), 256)).alias("content_hash"),
    )
    return files, stored


def change_detect(spark, folder):
    return delta.detect_changes(*_changes(spark, folder)).select("file_id", "content_hash", "status")


def forced_changes(spark, folder):
    return delta.detect_changes(*_changes(spark, folder), force=True).groupBy("status").agg(F.count("*").alias("files"))


def run_summary(spark, folder):
    found = delta.detect_changes(*_changes(spark, folder))
    status = F.when(F.col("status") == "skipped", "skipped").when(F.octet_length("content") > 4000, "error").otherwise("processed")
    return report.run_summary(found.select(status.alias("status")))


_DOC_STATUS = "CASE WHEN doc_id % 7 <> 0 AND doc_id % 5 <> 0 THEN 'skipped' ELSE 'pending' END"
SQL_CHANGES = f"""
SELECT sha256(concat_ws(chr(31), source, CAST(doc_id AS VARCHAR))) AS file_id, sha256(text) AS content_hash, {_DOC_STATUS} AS status FROM documents"""
SQL_SUMMARY = f"""
SELECT count(*) FILTER (s <> 'skipped' AND octet_length(encode(text)) <= 4000) AS processed, count(*) FILTER (s = 'skipped') AS skipped,
  count(*) FILTER (s <> 'skipped' AND octet_length(encode(text)) > 4000) AS errors FROM (SELECT *, {_DOC_STATUS} AS s FROM documents) AS d"""


def stale_elements(spark, folder):
    """Orders as files, their lines as elements; lines of every third number are gone, pending orders are not processed."""
    lines = _table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("file_id"),
        F.when(F.col("l_linenumber") % 2 == 0, "node").otherwise("edge").alias("element_type"),
        _text(F.col("l_partkey"), "-", F.col("l_suppkey"), "-", F.col("l_linenumber")).alias("element_id"), "l_linenumber",
    )
    processed = _table(spark, folder, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").cast("string").alias("file_id"))
    current = lines.where("l_linenumber % 3 <> 0").drop("l_linenumber")
    return delta.stale_elements(lines.drop("l_linenumber"), current, processed)


SQL_STALE = """
WITH l AS (SELECT CAST(l_orderkey AS VARCHAR) AS file_id, CASE WHEN l_linenumber % 2 = 0 THEN 'node' ELSE 'edge' END AS element_type,
  l_partkey || '-' || l_suppkey || '-' || l_linenumber AS element_id, l_linenumber FROM lineitem)
SELECT file_id, element_type, element_id FROM l
WHERE file_id IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus <> 'P')
  AND (file_id, element_type, element_id) NOT IN (SELECT (file_id, element_type, element_id) FROM l WHERE l_linenumber % 3 <> 0)"""


# ---------------------------------------------------------------- contracts and logs

_FAULTS = 12


def _event_texts(spark, folder) -> DataFrame:
    """Metadata event texts built from events, one in twelve of each fault."""
    hex_ = F.sha2(F.col("event_id").cast("string"), 256)
    fault = F.col("event_id") % _FAULTS

    def body(version='"1.0"', file=hex_, op="upsert", repo="r", extra="", payload=None, run='"run_id":"x",'):
        inner = _text('{"_id":"', hex_, '","path":"', F.col("event_type"), '.py","content_hash":"', hex_,
                      '","parse_status":"ok","processed_at":"t","schema_version":"1.0","size_bytes":', F.col("user_id"),
                      ',"node_counts":{"AST":', F.col("user_id"), '},"warnings":["', F.col("event_type"), '"]}')
        return _text('{"schema_version":', version, ',"event_time":"t","repo_id":"', repo, '","file_id":"', file, '",', run,
                     '"content_hash":"', hex_, '","event_id":"', hex_, '","op":"', op, '"', extra, ',"metadata":',
                     inner if payload is None else payload, "}")

    value = (
        F.when(fault == 0, body(version='"2.0"')).when(fault == 1, body(file=_text("Z", F.substring(hex_, 2, 63))))
        .when(fault == 2, body(file=F.substring(hex_, 1, 63))).when(fault == 3, body(op="delete"))
        .when(fault == 4, body(run="")).when(fault == 5, body(extra=',"more":1')).when(fault == 6, body(repo=""))
        .when(fault == 7, body(payload=_text('"', hex_, '"'))).when(fault == 8, F.substring(body(), 1, 100))
        .when(fault == 9, body(payload=F.lit('{"path":"p"}'))).when(fault == 10, body(version="1.0")).otherwise(body())
    )
    return _table(spark, folder, "events").select(
        "event_id", F.lit("cpg.source-metadata.v1").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"), hex_.alias("key"), value.alias("value"),
    )


def contract_validate(spark, folder):
    checked = contracts.validate_contract(_event_texts(spark, folder), contracts.CONTRACTS["metadata"])
    return checked.select("event_id", F.array_join("violations", "|").alias("violations"))


SQL_CONTRACT = """
SELECT event_id, CASE event_id % 12 WHEN 0 THEN 'schema_version:const' WHEN 1 THEN 'file_id:pattern' WHEN 2 THEN 'file_id:pattern'
  WHEN 3 THEN 'op:const' WHEN 4 THEN 'run_id:required' WHEN 5 THEN 'more:unexpected' WHEN 6 THEN 'repo_id:min_length'
  WHEN 7 THEN 'metadata:type' WHEN 8 THEN 'not an object'
  WHEN 9 THEN 'metadata._id:required|metadata.content_hash:required|metadata.parse_status:required|metadata.processed_at:required|metadata.schema_version:required'
  WHEN 10 THEN 'schema_version:const' ELSE '' END AS violations FROM events"""


def json_parse(spark, folder):
    kept, _ = documents(parse_events(_event_texts(spark, folder), METADATA_EVENT))
    return kept.select(
        "_id", "path", "size_bytes", F.element_at("node_counts", "AST").alias("ast"), F.array_join("warnings", ",").alias("warnings"),
        "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp",
    )


def rejected_records(spark, folder):
    _, bad = documents(parse_events(_event_texts(spark, folder), METADATA_EVENT))
    return bad.select("offset", "key", "reason")


_STAMP = "regexp_replace(regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0+$', ''), '\\.$', '')"
_DOC = f"""SELECT sha256(CAST(event_id AS VARCHAR)) AS _id, event_type || '.py' AS path, CAST(user_id AS INTEGER) AS size_bytes,
  CAST(user_id AS INTEGER) AS ast, event_type AS warnings, 'cpg.source-metadata.v1' AS kafka_topic,
  CAST(user_id % 4 AS INTEGER) AS kafka_partition, event_id AS kafka_offset, {_STAMP} AS kafka_timestamp
FROM events WHERE event_id % 12 NOT IN (7, 8, 9)"""
SQL_REJECTED = """
SELECT event_id AS "offset", sha256(CAST(event_id AS VARCHAR)) AS key, 'no document id' AS reason FROM events WHERE event_id % 12 IN (7, 8, 9)"""


def latest_by_key(spark, folder):
    log = _table(spark, folder, "events").select(
        F.col("user_id").alias("key"), "ts", "event_id", F.when(F.col("event_type") == "error", "delete").otherwise("upsert").alias("op"), "value"
    )
    return merge.latest_by_key(log, ["key"], ["ts", "event_id"]).select("key", "event_id", "op", "value")


SQL_LATEST = """
SELECT user_id AS key, arg_max(event_id, (ts, event_id)) AS event_id,
  arg_max(CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END, (ts, event_id)) AS op, arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY user_id"""


def log_end_offset(spark, folder):
    log = _table(spark, folder, "events").select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 4).alias("partition"), F.col("event_id").alias("offset")
    )
    return snapshots.log_end_offset(log)


SQL_END = """
SELECT topic, CAST(sum(e) AS BIGINT) AS end_offset FROM (
  SELECT event_type AS topic, user_id % 4 AS p, max(event_id) + 1 AS e FROM events GROUP BY ALL) AS x GROUP BY topic"""


# ---------------------------------------------------------------- graph state: order lines as edges, parts and orders as nodes

def _line_edges(spark, folder) -> DataFrame:
    lines = _table(spark, folder, "lineitem")
    return lines.groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").agg(F.max("l_returnflag").alias("kind")).select(
        _text("e", F.col("l_orderkey"), "-", F.col("l_linenumber"), "-", F.col("l_partkey"), "-", F.col("l_suppkey")).alias("id"), "kind",
        _text("o", F.col("l_orderkey")).alias("source_id"), _text("p", F.col("l_partkey")).alias("target_id"),
        _text("s", F.col("l_suppkey")).alias("file_id"), "l_linenumber",
    )


def _part_nodes(spark, folder) -> DataFrame:
    return _table(spark, folder, "part").select(
        _text("p", F.col("p_partkey")).alias("id"), F.col("p_type").alias("kind"), F.col("p_name").alias("name"),
        F.col("p_size").alias("line"), _text("s", F.col("p_partkey") % 50).alias("file_id"), "p_partkey",
    )


SQL_GRAPH = """
WITH edges AS (SELECT 'e' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id, max(l_returnflag) AS kind,
    'o' || l_orderkey AS source_id, 'p' || l_partkey AS target_id, 's' || l_suppkey AS file_id, l_linenumber
  FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey),
nodes AS (SELECT 'p' || p_partkey AS id, p_type AS kind, p_name AS name, p_size AS line, 's' || (p_partkey % 50) AS file_id, p_partkey FROM part)"""


def graph_merge(spark, folder):
    """State: parts below 60% of the keys by modulus; upserts overlap it, with some columns absent."""
    nodes = _part_nodes(spark, folder)
    state = nodes.where("p_partkey % 5 < 3").select("id", "kind", "name", "line")
    new = nodes.where("p_partkey % 5 > 1").select(
        "id", F.when(F.col("p_partkey") % 2 == 0, "NEW").alias("kind"), (F.col("line") + 100).alias("line")
    )
    return merge.merge_nodes(state, new)


SQL_MERGE = SQL_GRAPH + """
SELECT id, coalesce(CASE WHEN p_partkey % 5 > 1 AND p_partkey % 2 = 0 THEN 'NEW' END, CASE WHEN p_partkey % 5 < 3 THEN kind END) AS kind,
  CASE WHEN p_partkey % 5 < 3 THEN name END AS name, CASE WHEN p_partkey % 5 > 1 THEN line + 100 ELSE line END AS line FROM nodes"""


def placeholder_nodes(spark, folder):
    known = _part_nodes(spark, folder).where("p_partkey % 10 <> 0")
    nodes, _ = merge.merge_edges(
        known.select("id", "kind"), _line_edges(spark, folder).limit(0).drop("l_linenumber"), _line_edges(spark, folder).drop("l_linenumber")
    )
    return nodes


SQL_PLACEHOLDER = SQL_GRAPH + """
SELECT id, kind FROM nodes WHERE p_partkey % 10 <> 0
UNION ALL SELECT id, 'PLACEHOLDER' FROM (SELECT source_id AS id FROM edges UNION SELECT target_id FROM edges) AS x
WHERE id NOT IN (SELECT id FROM nodes WHERE p_partkey % 10 <> 0)"""


def detach_delete(spark, folder):
    nodes, edges = _part_nodes(spark, folder), _line_edges(spark, folder)
    _, left = merge.delete_elements(
        nodes.select("id", "kind"), edges.drop("l_linenumber"), nodes.where("p_partkey % 4 = 0"), edges.where("l_linenumber = 2")
    )
    return left


SQL_DETACH = SQL_GRAPH + """
SELECT id, kind, source_id, target_id, file_id FROM edges WHERE l_linenumber <> 2
  AND target_id NOT IN (SELECT id FROM nodes WHERE p_partkey % 4 = 0)"""


def _graph_events(spark, folder) -> DataFrame:
    """Lines as edge upserts or deletes, after parts as node upserts or deletes, some ids twice."""
    edges, nodes = _line_edges(spark, folder), _part_nodes(spark, folder)
    node, edge = (
        "struct<id: string, kind: string, ast_type: string, file_id: string, structural_path: string, line: int, column: int, "
        "end_line: int, end_column: int, name: string, value: string>",
        "struct<id: string, kind: string, source_id: string, target_id: string, file_id: string, discriminator: string, "
        "variable: string, resolved: boolean>",
    )
    zero, blank = F.lit(0), F.lit("")
    node_rows = nodes.select(
        F.lit("node").alias("element_type"), "id", F.explode(F.array(
            F.struct(F.lit("upsert").alias("op"), F.lit(1).alias("at")),
            F.struct(F.when(F.col("p_partkey") % 6 == 0, "delete").otherwise("upsert").alias("op"), F.lit(2).alias("at")),
        )).alias("x"),
        F.struct("id", "kind", F.lit("Part").alias("ast_type"), "file_id", blank.alias("structural_path"), "line", zero.alias("column"),
                 zero.alias("end_line"), zero.alias("end_column"), "name", blank.alias("value")).cast(node).alias("node"),
    ).select("element_type", "id", "x.op", "x.at", "node")
    edge_rows = edges.select(
        F.lit("edge").alias("element_type"), "id", F.when(F.col("l_linenumber") == 3, "delete").otherwise("upsert").alias("op"), F.lit(3).alias("at"),
        F.struct("id", "kind", "source_id", "target_id", "file_id", blank.alias("discriminator"), blank.alias("variable"),
                 F.lit(True).alias("resolved")).cast(edge).alias("edge"),
    )
    return node_rows.unionByName(edge_rows, allowMissingColumns=True)


def _applied(spark, folder):
    """The batch on a state that already holds every part and the lines numbered 3 and 4."""
    events = _graph_events(spark, folder)
    state_nodes = events.where("element_type = 'node' AND at = 1").select("node.*").select(NODE_COLUMNS)
    state_edges = events.where("element_type = 'edge'").join(
        _line_edges(spark, folder).where("l_linenumber IN (3, 4)").select("id"), "id", "left_semi"
    ).select("edge.*").select(EDGE_COLUMNS)
    batch = events.where("element_type = 'node' OR NOT edge.id RLIKE '^e[0-9]+-4-'")
    return merge.apply_graph_events(state_nodes, state_edges, batch)


def graph_fold_nodes(spark, folder):
    return _applied(spark, folder)[0].select("id", "kind", "name", "line", "file_id")


def graph_fold_edges(spark, folder):
    return _applied(spark, folder)[1].select("id", "kind", "source_id", "target_id", "file_id")


_KEPT = "(l_linenumber <> 3 AND l_linenumber <> 4)"
SQL_FOLD_NODES = SQL_GRAPH + f"""
SELECT id, kind, name, line, file_id FROM nodes WHERE p_partkey % 6 <> 0
UNION ALL SELECT id, 'PLACEHOLDER', NULL, NULL, NULL FROM (
  SELECT source_id AS id FROM edges WHERE {_KEPT} OR l_linenumber IN (3, 4)
  UNION SELECT target_id FROM edges WHERE {_KEPT}) AS x
WHERE id NOT IN (SELECT id FROM nodes WHERE p_partkey % 6 <> 0)"""
SQL_FOLD_EDGES = SQL_GRAPH + f"""
SELECT id, kind, source_id, target_id, file_id FROM edges
WHERE {_KEPT} OR (l_linenumber = 4 AND target_id NOT IN (SELECT id FROM nodes WHERE p_partkey % 6 = 0))"""


def graph_snapshot(spark, folder):
    return snapshots.graph_snapshot(_part_nodes(spark, folder), _line_edges(spark, folder), "s7")


SQL_SNAPSHOT = SQL_GRAPH + """
SELECT (SELECT count(*) FROM nodes) AS nodes, (SELECT count(DISTINCT id) FROM nodes) AS unique_nodes,
  (SELECT count(*) FROM nodes WHERE file_id = 's7') AS file_nodes, (SELECT count(*) FROM edges) AS edges,
  (SELECT count(DISTINCT id) FROM edges) AS unique_edges, (SELECT count(*) FROM edges WHERE file_id = 's7') AS file_edges"""


def edges_by_kind(spark, folder):
    return snapshots.edges_by_kind(_line_edges(spark, folder))


# ---------------------------------------------------------------- documents

def table_digest(spark, folder):
    return snapshots.table_digest(_table(spark, folder, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus"])


_WORDS = ", ".join(f"coalesce(sum(CAST(CAST('0x' || substr(h, {1 + 8 * i}, 8) AS UBIGINT) AS HUGEINT)), 0) AS w{i}" for i in range(8))


def _digest(relation: str, columns: list[str]) -> str:
    parts = " || ".join(f"coalesce(length({c}) || ':' || {c}, '-')" for c in columns)
    words = ", ".join(f"CAST(w{i} AS VARCHAR)" for i in range(8))
    return f"""SELECT n AS rows, sha256(concat_ws('-', CAST(n AS VARCHAR), {words})) AS digest FROM (
  SELECT count(*) AS n, {_WORDS} FROM (SELECT sha256({parts}) AS h FROM {relation}) AS r) AS s"""


def unique_check(spark, folder):
    return snapshots.unique_check(_table(spark, folder, "lineitem"), "l_orderkey")


def _doc_state(spark, folder) -> DataFrame:
    return _table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("_id"), F.col("source").alias("repo_id"), _text("doc_", F.col("doc_id"), ".py").alias("path"),
        F.sha2(F.col("text").cast("binary"), 256).alias("content_hash"), (F.col("doc_id") * 2).alias("kafka_offset"),
        F.lit("").alias("kafka_timestamp"),
    )


SQL_DOCS = "(SELECT CAST(doc_id AS VARCHAR) AS _id, source AS repo_id, 'doc_' || doc_id || '.py' AS path, sha256(text) AS content_hash, doc_id * 2 AS kafka_offset, doc_id FROM documents)"


def document_snapshot(spark, folder):
    return snapshots.document_snapshot(_doc_state(spark, folder), "src0", "0")


SQL_DOC_SNAPSHOT = f"""
SELECT documents, distinct_files, other_documents, doc_content_hash, doc_offset, digest AS others_digest FROM (
  SELECT count(*) AS documents, count(DISTINCT _id) AS distinct_files, count(*) FILTER (_id <> '0') AS other_documents,
    max(content_hash) FILTER (_id = '0') AS doc_content_hash, max(kafka_offset) FILTER (_id = '0') AS doc_offset
  FROM {SQL_DOCS} AS d WHERE repo_id = 'src0') AS a,
  ({_digest("(SELECT * FROM " + SQL_DOCS + " AS d WHERE repo_id = 'src0' AND _id <> '0') AS o", ["_id", "content_hash", "CAST(kafka_offset AS VARCHAR)"])}) AS b"""


def document_preview(spark, folder):
    return snapshots.document_preview(_doc_state(spark, folder))


def document_upsert(spark, folder):
    """Every second document rewritten at a later offset, some new, some late with an older offset."""
    state = _doc_state(spark, folder)
    id_ = F.col("_id").cast("long")
    later = state.where(id_ % 2 == 0).withColumns({"kafka_offset": F.col("kafka_offset") + 1_000_000, "path": F.lit("moved.py")})
    late = state.where(id_ % 3 == 0).withColumns({"kafka_offset": F.lit(-1).cast("long"), "path": F.lit("late.py")})
    new = state.where(id_ % 5 == 0).withColumn("_id", _text("new", F.col("_id")))
    return merge.upsert_documents(state, later.unionByName(late).unionByName(new)).select("_id", "path", "content_hash", "kafka_offset")


SQL_UPSERT = f"""
SELECT _id, CASE WHEN doc_id % 2 = 0 THEN 'moved.py' ELSE path END AS path, content_hash,
  CASE WHEN doc_id % 2 = 0 THEN kafka_offset + 1000000 ELSE kafka_offset END AS kafka_offset FROM {SQL_DOCS} AS d
UNION ALL SELECT 'new' || _id, path, content_hash, kafka_offset FROM {SQL_DOCS} AS d WHERE doc_id % 5 = 0"""


# ---------------------------------------------------------------- replay checks

def _stage_rows(spark, folder) -> DataFrame:
    """Four stages measured on the documents; document 0 changes between the first and the second."""
    docs = _doc_state(spark, folder)
    snap = snapshots.document_snapshot(docs.withColumn("repo_id", F.lit("all")), "all", "0")
    lines = _table(spark, folder, "documents").agg(F.sum("n_chars").alias("chars"))
    stages = F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(i).alias("i")) for i, n in enumerate(contracts.STAGES)
    ])).alias("s")
    first = F.col("i") == 0
    hash_ = F.when(first, F.col("doc_content_hash")).otherwise(F.sha2("doc_content_hash", 256))
    size = F.col("documents") + F.when(first, 0).otherwise(7)
    one = F.when(first, 7).otherwise(29).cast("long")
    return snap.join(lines).select("*", stages).select("*", "s.*").select(
        "name", F.lit("t").alias("captured_at"), hash_.alias("source_hash"), F.col("chars").cast("int").alias("source_lines"),
        F.lit("doc_0.py").alias("path"), one.alias("nodes"), (one - 1).alias("edges"),
        F.lit(0).cast("long").alias("deleted_nodes"), F.when(F.col("i") == 1, 1).otherwise(0).cast("long").alias("deleted_edges"),
        size.alias("graph_nodes"), size.alias("graph_unique_nodes"), (size * 2).alias("graph_edges"), (size * 2).alias("graph_unique_edges"),
        one.alias("file_nodes"), (one - 1).alias("file_edges"), F.create_map(F.lit("AST"), size, F.lit("CFG"), size).alias("edge_kinds"),
        "documents", "distinct_files", hash_.alias("doc_content_hash"), (F.col("doc_offset") + F.col("i") * 2).alias("doc_offset"),
        # in the last stage another document was rewritten: one check must fail
        F.when(F.col("i") == 3, F.lit("other")).otherwise(F.col("others_digest")).alias("others_digest"),
        (F.col("doc_offset") + F.col("i") * 2 + 2).alias("log_end_offset"), (F.col("doc_offset") + F.col("i") * 2 + 2).alias("checkpoint_offset"),
    )


def replay_checks(spark, folder):
    stages = keep(_stage_rows(spark, folder), "stages")
    expected = _table(spark, folder, "documents").count()
    return checks.replay_checks(stages, "doc_0.py", expected, 6, 1)


SQL_CHECKS = """
SELECT n.name, n.name NOT IN ('unchanged_files_were_not_rewritten', 'dead_letters_empty') AND d.c > 0 AS passed FROM (VALUES
  ('only_requested_file_processed'), ('source_hash_changed'), ('document_hash_matches'), ('graph_counts_match_extract'),
  ('modified_graph_changed'), ('modified_emitted_stale_deletes'), ('forced_replay_has_no_stale_elements'),
  ('unchanged_replay_keeps_graph_counts'), ('restart_replay_keeps_graph_counts'), ('graph_ids_are_unique'), ('one_document_per_file'),
  ('unchanged_files_were_not_rewritten'), ('document_offsets_advance'), ('stream_consumed_each_stage'),
  ('checkpoint_resumed_after_restart'), ('dead_letters_empty')) AS n(name), (SELECT count(*) AS c FROM documents) AS d"""


def stage_report(spark, folder):
    return checks.stage_report(_stage_rows(spark, folder))


SQL_REPORT = """
WITH d AS (SELECT count(*) AS c, max(sha256(text)) FILTER (doc_id = 0) AS h FROM documents)
SELECT s.name, left(CASE WHEN i = 0 THEN h ELSE sha256(h) END, 12) AS hash, CAST(CASE WHEN i = 0 THEN 7 ELSE 29 END AS BIGINT) AS file_nodes,
  CAST(CASE WHEN i = 0 THEN 6 ELSE 28 END AS BIGINT) AS file_edges, CAST(c + CASE WHEN i = 0 THEN 0 ELSE 7 END AS BIGINT) AS graph_nodes,
  CAST(2 * (c + CASE WHEN i = 0 THEN 0 ELSE 7 END) AS BIGINT) AS graph_edges, c AS documents, CAST(i * 2 AS BIGINT) AS doc_offset,
  CAST(i * 2 + 2 AS BIGINT) AS checkpoint_offset
FROM d, (VALUES ('baseline', 0), ('modified', 1), ('forced_unchanged', 2), ('restart_replay', 3)) AS s(name, i)"""


# ---------------------------------------------------------------- streams, compared by their final state

def _log_folder(log: DataFrame, codec: str = "none") -> str:
    folder = f"{work_root(log.sparkSession)}/arborflow/{uuid.uuid4().hex}"
    append_log(log, f"{folder}/log", codec)
    return folder


def document_stream(spark, folder):
    """The metadata log streamed into document state: documents keyed by event type and user."""
    log = _event_texts(spark, folder)
    work = _log_folder(log)
    query = metadata_stream(
        spark, {"format": "json", "path": f"{work}/log", "maxFilesPerTrigger": "4"}, f"{work}/sink", f"{work}/checkpoint",
        {"availableNow": True}, name=f"documents-{work[-8:]}",
    )
    query.awaitTermination()
    docs = read_documents(spark, f"{work}/sink")
    return docs.select(
        "_id", "path", "size_bytes", F.element_at("node_counts", "AST").alias("ast"), F.array_join("warnings", ",").alias("warnings"),
        "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp",
    )


def element_stream(spark, folder):
    """Lines streamed as edge events, every fifth malformed, into graph state; placeholders stand for both ends."""
    edges = _line_edges(spark, folder)
    hexed = [F.sha2(c, 256).alias(c) for c in ("id", "source_id", "target_id")]
    bad = F.col("l_linenumber") == 5
    rows = edges.select(*hexed, "kind", F.sha2("file_id", 256).alias("file_id"), "l_linenumber")
    value = F.to_json(F.struct(
        F.when(bad, "0.9").otherwise("1.0").alias("schema_version"), F.lit("t").alias("event_time"), F.lit("r").alias("repo_id"), "file_id",
        F.lit("x").alias("run_id"), F.col("file_id").alias("content_hash"), F.col("id").alias("event_id"), F.lit("upsert").alias("op"),
        F.struct("id", "kind", "source_id", "target_id", "file_id", F.lit("").alias("discriminator"), F.lit("").alias("variable"),
                 F.lit(True).alias("resolved")).alias("edge"),
    ))
    log = rows.select(
        F.lit("cpg.edges.v1").alias("topic"), F.lit(0).alias("partition"), F.col("l_linenumber").cast("long").alias("offset"),
        F.lit("2026-01-01 00:00:00").cast("timestamp").alias("timestamp"), F.col("id").alias("key"), value.alias("value"),
    )
    work = _log_folder(log, "gzip")
    query = graph_stream(
        spark, {"format": "json", "path": f"{work}/log"}, f"{work}/sink", f"{work}/checkpoint", {"availableNow": True}, name=f"graph-{work[-8:]}"
    )
    query.awaitTermination()
    nodes, kept = read_graph(spark, f"{work}/sink")
    return kept.select("id", "kind", "source_id", "target_id").unionByName(
        nodes.select("id", "kind"), allowMissingColumns=True
    )


SQL_DOC_STREAM = _DOC
SQL_ELEMENTS = SQL_GRAPH + """,
good AS (SELECT sha256(id) AS id, kind, sha256(source_id) AS source_id, sha256(target_id) AS target_id FROM edges WHERE l_linenumber <> 5)
SELECT id, kind, source_id, target_id FROM good
UNION ALL SELECT id, 'PLACEHOLDER', NULL, NULL FROM (SELECT source_id AS id FROM good UNION SELECT target_id FROM good) AS x"""


_CASES = {
    stable_ids: SQL_IDS, content_fingerprint: SQL_FINGERPRINT, repo_id_from_url: SQL_REPO, path_guard: SQL_PATHS,
    change_detect: SQL_CHANGES, forced_changes: "SELECT 'pending' AS status, count(*) AS files FROM documents",
    run_summary: SQL_SUMMARY, stale_elements: SQL_STALE, contract_validate: SQL_CONTRACT, json_parse: _DOC,
    rejected_records: SQL_REJECTED, latest_by_key: SQL_LATEST, log_end_offset: SQL_END, graph_merge: SQL_MERGE,
    placeholder_nodes: SQL_PLACEHOLDER, detach_delete: SQL_DETACH, graph_fold_nodes: SQL_FOLD_NODES,
    graph_fold_edges: SQL_FOLD_EDGES, graph_snapshot: SQL_SNAPSHOT,
    edges_by_kind: SQL_GRAPH + " SELECT kind, count(*) AS count FROM edges GROUP BY kind",
    table_digest: _digest("orders", ["CAST(o_orderkey AS VARCHAR)", "CAST(o_custkey AS VARCHAR)", "o_orderstatus"]),
    unique_check: "SELECT count(*) AS rows, count(DISTINCT l_orderkey) AS distinct_rows, count(*) = count(DISTINCT l_orderkey) AS is_unique FROM lineitem",
    document_snapshot: SQL_DOC_SNAPSHOT,
    document_preview: f"SELECT _id, path, content_hash, kafka_offset FROM {SQL_DOCS} AS d ORDER BY _id LIMIT 5",
    document_upsert: SQL_UPSERT, replay_checks: SQL_CHECKS, stage_report: SQL_REPORT,
    document_stream: SQL_DOC_STREAM, element_stream: SQL_ELEMENTS,
}
QUERIES = {f.__name__: f for f in _CASES}
SQL = {f.__name__: sql for f, sql in _CASES.items()}
