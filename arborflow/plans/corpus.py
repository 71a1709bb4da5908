"""Source corpora derived from a table: one small Python file per row.

Used to check and time the engine on tables that hold no source code. The text of a file
depends on its row's key, so ids, hashes and positions differ from file to file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborflow.functions.ids import file_id

# `{K}` is replaced by the row's key.
TEMPLATES = [
    "limit = {K}\n",
    "def scale(base):\n    if base < {K}:\n        return base + {K}\n    return base\n",
    """import os.path
from json import dumps as encode


def tally(rows, start=0):
    count = start
    for row in rows:
        if not row:
            continue
        count += len(row)
    else:
        count = helper(count)
    return count


async def helper(n):
    while n > {K}:
        n = n - 1
        if n == 7:
            break
    return os.path.join(encode(n))
""",
    "total = 1\nif total > {K}\n    total = 0\n",
    """class Box:
    size = {K}

    @wrap
    def pick(items, *rest, key=None):
        while items:
            try:
                item = items.pop()
                if item is None:
                    break
            except KeyError:
                continue
            else:
                rest = rest, item
            finally:
                key = rest
        else:
            del key
        with rest as fh:
            match key:
                case 0:
                    return fh
                case _:
                    rest = [v for v in fh if (w := v)]
        try:
            raise size({K})
            rest = w
        except* OSError:
            key = lambda v: rest
        return sorted(rest, key=key)
""",
]


def _text(template: str) -> Column:
    parts = template.split("{K}")
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        pieces += ([F.col("k")] if i else []) + [F.lit(part)]
    return F.concat(*pieces)


def sources_from_parts(part: DataFrame) -> DataFrame:
    """files(repo_id, repo_url, commit_sha, path, content, file_id, template) from part rows."""
    key = F.col("p_partkey")
    template = key % len(TEMPLATES)
    text = _text(TEMPLATES[0])
    for i, source in enumerate(TEMPLATES[1:], 1):
        text = F.when(F.col("template") == i, _text(source)).otherwise(text)
    folder = F.when(key % 7 == 0, "tests/").when(key % 7 == 1, "build/").when(key % 7 == 2, "generated/").otherwise("")
    suffix = F.when(key % 11 == 0, "_pb2").when(key % 11 == 1, "_test").otherwise("")
    repo = F.concat(F.lit("corpus/"), F.lower("p_type"))
    return (
        part.select("p_partkey", "p_type", "p_size", key.cast("string").alias("k"), template.alias("template"))
        .select(
            repo.alias("repo_id"),
            F.concat(F.lit("https://github.com/"), repo, F.lit(".git")).alias("repo_url"),
            F.lit("").alias("commit_sha"),
            F.concat(F.lit("pkg"), F.col("p_size") % 5, F.lit("/"), folder, F.lit("mod_"), F.col("k"), suffix, F.lit(".py")).alias("path"),
            F.encode(text, "UTF-8").alias("content"),
            "template",
        )
        .withColumn("file_id", file_id("repo_id", "path"))
    )


def load_sources(spark: SparkSession, folder: str) -> DataFrame:
    """The part table as a corpus, spread over the cores: a row is small but fans out when parsed."""
    part = spark.read.parquet(f"{folder}/part.parquet").select("p_partkey", "p_type", "p_size")
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return sources_from_parts(part.repartition(tasks, "p_partkey"))
