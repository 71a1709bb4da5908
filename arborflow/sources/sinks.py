"""Where events go."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from arborflow.operators.contracts import REPORT, validate_contract
from arborflow.schemas import LOG
from arborflow.sources.storage import AlreadyCommitted, commit_text, listed, read_text, remove, write_text_once


def write_jsonl(records: DataFrame, folder: str) -> None:
    """Append {"key", "value"} lines, one folder per topic. Where a reader must not see half a run, `publish`."""
    _lines(records).write.mode("append").partitionBy("topic").text(folder)


def _lines(records: DataFrame) -> DataFrame:
    key = F.to_json(F.array("key"))
    line = F.concat(F.lit('{"key":'), F.substring(key, F.lit(2), F.length(key) - 2), F.lit(',"value":'), "value", F.lit("}"))
    return records.select("topic", line.alias("line"))


def publish(records: DataFrame, folder: str) -> int:
    """Publish (topic, key, value) records as one run: all of them or none; the run's number.

    The lines go to a folder of their own, then a commit file names it. Readers take what commit files name, so
    a run that dies in between leaves nothing visible. Runs that end at the same time get one number each.
    """
    spark, run = records.sparkSession, uuid.uuid4().hex
    _lines(records).write.partitionBy("topic").text(f"{folder}/runs/run={run}")
    while True:
        number = max(_published(spark, folder), default=-1) + 1
        try:
            stamp = datetime.now(timezone.utc).isoformat(timespec="microseconds")
            commit_text(spark, f"{folder}/commits/run={number}", json.dumps({"run": run, "at": stamp}))
            return number
        except AlreadyCommitted:
            continue


def _published(spark: SparkSession, folder: str) -> dict[int, dict]:
    names = [n for n, _ in listed(spark, f"{folder}/commits") if n.startswith("run=") and "." not in n]
    return {int(n.partition("=")[2]): json.loads(read_text(spark, f"{folder}/commits/{n}")) for n in names}


def read_published(spark: SparkSession, folder: str, after: int = -1) -> DataFrame:
    """Records of all committed runs with a number above `after`, as LOG rows.

    A run's records share its number as offset and its commit as time: a run sends a key once per topic. Rows
    so read feed `parse_events`, `documents` and the graph fold like those of any other log.
    """
    runs = {n: c for n, c in _published(spark, folder).items() if n > after}
    if not runs:
        return spark.createDataFrame([], LOG)
    known = spark.createDataFrame([(c["run"], n, c["at"]) for n, c in runs.items()], "run string, offset bigint, at string")  # one row a run
    lines = spark.read.schema("value string, topic string").option("basePath", f"{folder}/runs").text([f"{folder}/runs/run={c['run']}" for c in runs.values()])
    lines = lines.withColumn("run", F.regexp_extract("_metadata.file_path", "/run=([0-9a-f]+)/", 1))
    return lines.join(F.broadcast(known), "run").select(
        "topic", F.lit(0).alias("partition"), "offset", F.col("at").cast("timestamp").alias("timestamp"),
        F.get_json_object("value", "$.key").alias("key"), F.get_json_object("value", "$.value").alias("value"))


def clean_published(spark: SparkSession, folder: str, hours: float = 24.0) -> list[str]:
    """Maintenance: remove runs that never committed, once nobody has touched them for `hours`."""
    known = {f"run={c['run']}" for c in _published(spark, folder).values()}
    gone = [n for n, age in listed(spark, f"{folder}/runs") if n not in known and age >= hours]
    for name in gone:
        remove(spark, f"{folder}/runs/{name}")
    return gone


def write_kafka(records: DataFrame, options: dict[str, str]) -> None:
    """Send key, value and topic to Kafka; needs the Spark Kafka connector on the classpath."""
    writer = records.select("topic", F.col("key").cast("binary"), F.col("value").cast("binary")).write.format("kafka")
    try:
        writer.options(**options).save()
    except Exception as exc:
        if "kafka" in str(exc).lower() and "find" in str(exc).lower():
            raise RuntimeError("the Spark Kafka connector is not on the classpath") from exc
        raise


def collect_records(records: DataFrame, limit: int = 100_000) -> list[Row]:
    """In-memory sink for tests and small runs; raises ValueError, rather than fill the driver, beyond `limit` records."""
    rows = records.select("topic", "key", "value").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} records: use a sink that stays distributed")
    return rows


def write_dead_letters(rejected: DataFrame, folder: str) -> None:
    """Append rejected records with their log position and the reason."""
    rejected.select("topic", "partition", "offset", "key", "value", "reason").write.mode("append").json(folder)


def write_checks(checks: DataFrame, stages: DataFrame, folder: str, captured_at: str, dead_letter_end: int) -> str:
    """Publish the replay report if every check holds and the report meets its contract; else raise.

    Sixteen checks and four stages: the report is small by construction.
    """
    passed = {r["name"]: r["passed"] for r in checks.collect()}
    failed = sorted(n for n, ok in passed.items() if not ok)
    if failed:
        raise AssertionError("replay checks failed: " + ", ".join(failed))
    report = {
        "schema_version": "2.0",
        "captured_at": captured_at,
        "stages": {r["name"]: json.loads(r["doc"]) for r in stages.select("name", F.to_json(F.struct("*")).alias("doc")).collect()},
        "dead_letter_end_offset": dead_letter_end,
        "assertions": passed,
    }
    text = json.dumps(report, indent=2, sort_keys=True, ensure_ascii=False)
    spark = checks.sparkSession
    problems = validate_contract(spark.range(1).select(F.lit(text).alias("value")), REPORT, closed=False).first().violations
    if problems:
        raise AssertionError("replay report breaks its contract: " + ", ".join(problems))
    path = f"{folder}/replay-report.json"
    write_text_once(spark, path, text + "\n")
    return path
