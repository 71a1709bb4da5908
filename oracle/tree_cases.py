"""Trees, undecodable files, single files, sinks and contracts over the driver's tables, with the SQL that expects their results."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborflow.functions.paths import is_excluded
from arborflow.functions.text import lenient_text, line_count, size_bytes
from arborflow.operators import contracts
from arborflow.operators.events import documents, event_time, parse_events, run_id
from arborflow.operators.syntax import extract
from arborflow.plans.corpus import load_sources
from arborflow.schemas import METADATA_EVENT
from arborflow.session import ship, work_root
from arborflow.sources import sinks
from arborflow.sources.files import one_file, open_root, read_sources, sources_from_table
from oracle.source_cases import PY
from oracle.table_cases import SQL_REJECTED, _event_texts, _table


def _work(spark: SparkSession) -> str:
    return f"{work_root(spark)}/arborflow/{uuid.uuid4().hex}"


def _tree(root: str):
    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = open_root(root)
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                system.create_dir(f"{base}/{path}".rpartition("/")[0], recursive=True)
                with system.open_output_stream(f"{base}/{path}", compression=None) as out:
                    out.write(bytes(content))
            yield frame[["path"]]

    return write


def tree_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus written out as a tree, with an empty file in a hidden-looking package for every tenth part, and read back."""
    ship(spark)
    corpus = load_sources(spark, folder).select("path", "content")
    number = F.regexp_extract("path", "mod_([0-9]+)", 1)
    empty = corpus.where(number.cast("long") % 10 == 0).select(
        F.concat(F.lit("_x/.p"), number, F.lit("/__init__.py")).alias("path"), F.lit("").cast("binary").alias("content"))
    other = corpus.where(number.cast("long") % 10 == 1).select(F.concat("path", F.lit(".txt")).alias("path"), "content")
    root = f"{_work(spark)}/tree"
    corpus.union(empty).union(other).mapInPandas(_tree(root), "path string").write.format("noop").mode("overwrite").save()
    files = read_sources(spark, root, "owner/tree")
    return files.select("path", "file_id", size_bytes(F.col("content")).cast("long").alias("bytes"), F.sha2("content", 256).alias("content_hash"))


SQL_TREE = f"""WITH {PY}
SELECT path, sha256(concat_ws(chr(31), 'owner/tree', path)) AS file_id, CAST(strlen(text) AS BIGINT) AS bytes, sha256(text) AS content_hash
FROM (SELECT fpath AS path, content AS text FROM py UNION ALL SELECT '_x/.p' || p_partkey || '/__init__.py', '' FROM py WHERE p_partkey % 10 = 0)"""


def undecodable_files(spark: SparkSession, folder: str) -> DataFrame:
    """A file per document, every third with bytes that are no UTF-8: how it is measured, and how the strict parse ends."""
    key = F.col("doc_id").cast("string")
    tail = F.when(F.col("doc_id") % 3 == 0, F.unhex(F.lit("FF0AE282"))).otherwise(F.encode(F.lit("é"), "UTF-8"))
    body = F.concat(F.encode(F.concat(F.lit("a = "), key, F.lit("  # ")), "UTF-8"), tail)
    docs = _table(spark, folder, "documents").select("doc_id", body.alias("body"))
    files = sources_from_table(docs, F.lit("owner/docs"), F.concat(F.lit("d"), key, F.lit(".py")), F.col("body"))
    failed = extract(files, stored=False).errors.select("file_id", "exception_type", F.col("message").alias("reason"))
    text = lenient_text(F.col("content"))
    measured = files.select(
        "file_id", F.sha2(text, 256).alias("text_hash"), line_count(text).cast("long").alias("lines"),
        size_bytes(F.col("content")).cast("long").alias("bytes"))
    return measured.join(failed, "file_id", "left")


SQL_UNDECODABLE = """
WITH d AS (SELECT *, 'a = ' || doc_id || '  # ' AS head, doc_id % 3 = 0 AS bad FROM documents)
SELECT sha256(concat_ws(chr(31), 'owner/docs', 'd' || doc_id || '.py')) AS file_id,
  sha256(head || CASE WHEN bad THEN chr(65533) || chr(10) || chr(65533) ELSE chr(233) END) AS text_hash,
  CAST(CASE WHEN bad THEN 2 ELSE 1 END AS BIGINT) AS lines, CAST(length(head) + CASE WHEN bad THEN 4 ELSE 2 END AS BIGINT) AS bytes,
  CASE WHEN bad THEN 'UnicodeDecodeError' END AS exception_type,
  CASE WHEN bad THEN '''utf-8'' codec can''t decode byte 0xff in position ' || length(head) || ': invalid start byte' END AS reason FROM d"""


def single_file(spark: SparkSession, folder: str) -> DataFrame:
    """The first path that the scope rules leave out, asked for by a path with detours."""
    files = load_sources(spark, folder)
    path = files.where(is_excluded(F.col("path"))).agg(F.min("path")).first()[0]
    return one_file(files, f"./x/../{path}").select("repo_id", "path", "file_id", F.sha2("content", 256).alias("content_hash"))


SQL_SINGLE = f"""WITH {PY}
SELECT repo_id, fpath AS path, file_id, content_hash FROM py
WHERE fpath = (SELECT min(fpath) FROM py WHERE p_partkey % 7 IN (0, 1, 2) OR p_partkey % 11 IN (0, 1))"""


def event_times(spark: SparkSession, folder: str) -> DataFrame:
    """The time text and run id an event of each row would carry."""
    run = run_id(F.col("event_type"), F.col("user_id").cast("string"))
    return _table(spark, folder, "events").select("event_id", event_time(F.col("ts")).alias("event_time"), run.alias("run_id"))


SQL_TIMES = """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time,
  left(sha256(concat_ws(chr(31), event_type, CAST(user_id AS VARCHAR))), 32) AS run_id FROM events"""


def jsonl_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as records of two topics, with keys that need escaping, sent in two runs: the lines a reader of the sink finds."""
    records = _table(spark, folder, "customer").select(
        F.concat(F.lit("topic-"), F.col("c_custkey") % 2).alias("topic"),
        F.concat(F.lit('say "'), "c_name", F.lit('" \\ '), "c_custkey").alias("key"),
        F.to_json(F.struct("c_custkey", "c_mktsegment")).alias("value"), (F.col("c_custkey") % 4 >= 2).alias("later"))
    target = f"{_work(spark)}/jsonl"
    sinks.write_jsonl(records.where("NOT later"), target)
    sinks.write_jsonl(records.where("later"), target)
    return spark.read.schema("line string, topic string").text(target).select("topic", "line")


SQL_JSONL = """
SELECT 'topic-' || (c_custkey % 2) AS topic, '{"key":"say \\"' || c_name || '\\" \\\\ ' || c_custkey || '","value":{"c_custkey":' || c_custkey
  || ',"c_mktsegment":"' || c_mktsegment || '"}}' AS line FROM customer"""


def dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected records as a later reader of the dead-letter folder finds them."""
    _, bad = documents(parse_events(_event_texts(spark, folder), METADATA_EVENT))
    target = f"{_work(spark)}/dead_letters"
    sinks.write_dead_letters(bad, target)
    return spark.read.schema("offset long, key string, reason string").json(target)


def contract_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as node, edge and error events, most of them broken in one way: what each contract says."""
    # a file of keys alone is one small split, whose rows are many records
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    orders = _table(spark, folder, "orders").select("o_orderkey").repartition(tasks)
    n, key = F.col("o_orderkey") % 7, F.sha2(F.col("o_orderkey").cast("string"), 256)
    ident = F.when(n == 1, F.lit("short")).when(n != 2, key).alias("id")

    def checked(kind: str, op: str, *payload: Column) -> DataFrame:
        value = F.to_json(F.struct(
            F.when(n == 3, "2.0").otherwise("1.0").alias("schema_version"), F.lit("t").alias("event_time"), F.lit("r").alias("repo_id"),
            key.alias("file_id"), F.when(n == 4, "").otherwise("x").alias("run_id"), key.alias("content_hash"), key.alias("event_id"),
            F.when(n == 5, "merge").otherwise(op).alias("op"), F.struct(ident, *payload).alias(kind)))
        log = orders.select("o_orderkey", value.alias("value"))
        found = contracts.validate_contract(log, contracts.CONTRACTS[kind])
        return found.select(F.lit(kind).alias("contract"), "o_orderkey", F.array_join("violations", "|").alias("violations"))

    error = [
        F.lit("parse").alias("stage"), F.lit("SyntaxError").alias("exception_type"), F.when(n != 6, F.lit("m")).alias("message"),
        F.lit(True).alias("recoverable"),
    ]
    nodes, edges = checked("node", "upsert", F.lit("AST").alias("kind")), checked("edge", "delete")
    return nodes.unionByName(edges).unionByName(checked("error", "error", *error))


SQL_KINDS = """
SELECT contract, o_orderkey, CASE o_orderkey % 7
  WHEN 1 THEN CASE WHEN contract = 'error' THEN '' ELSE contract || '.id:pattern' END
  WHEN 2 THEN contract || '.id:required' WHEN 3 THEN 'schema_version:const' WHEN 4 THEN 'run_id:min_length'
  WHEN 5 THEN CASE WHEN contract = 'error' THEN 'op:const' ELSE 'op:enum' END
  WHEN 6 THEN CASE WHEN contract = 'error' THEN 'error.message:required' ELSE '' END ELSE '' END AS violations
FROM orders, (VALUES ('node'), ('edge'), ('error')) AS c(contract)"""


_CASES = {
    tree_roundtrip: SQL_TREE, undecodable_files: SQL_UNDECODABLE, single_file: SQL_SINGLE, event_times: SQL_TIMES,
    jsonl_lines: SQL_JSONL, dead_letters: SQL_REJECTED, contract_kinds: SQL_KINDS,
}
QUERIES = {f.__name__: f for f in _CASES}
SQL = {f.__name__: sql for f, sql in _CASES.items()}
