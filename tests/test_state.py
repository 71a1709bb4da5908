"""Faults of state, sources and digests that were found on small inputs."""

import os

import pytest
from pyspark.sql import functions as F

from arborflow.operators.snapshots import table_digest
from arborflow.plans.incremental import incremental_run
from arborflow.session import ship
from arborflow.sources.files import OPEN_BYTES, read_sources
from arborflow.sources import sinks
from arborflow.sources import state as state_module
from arborflow.sources.state import ConcurrentRun, State, clean_state, compact_state, empty_state, load_state, save_state
from arborflow.sources.storage import write_version
from test_incremental import files_of


def test_digest_tells_null_from_text(spark):
    def digest(rows):
        return table_digest(spark.createDataFrame(rows, "a string, b string"), ["a", "b"]).first().digest

    assert len({digest([("1", None)]), digest([("1", "None")]), digest([("1", "-")]), digest([("1", "")]), digest([("1-", None)])}) == 5


def test_links_are_not_followed(spark, tmp_path):
    (tmp_path / "pkg").mkdir()
    (tmp_path / "pkg" / "a.py").write_text("x = 1\n")
    os.symlink(tmp_path / "pkg", tmp_path / "pkg" / "again")
    assert [r.path for r in read_sources(spark, str(tmp_path), "o/r").collect()] == ["pkg/a.py"]


def test_reading_tasks_follow_bytes(spark, tmp_path):
    texts = {f"d{i % 5}/m{i}.py": "#" * (i * 700) + "\n" for i in range(40)} | {"_x/__init__.py": "", "big.py": "#" * 400_000}
    for path, text in texts.items():
        (tmp_path / path).parent.mkdir(exist_ok=True)
        (tmp_path / path).write_text(text)
    os.symlink(tmp_path / "big.py", tmp_path / "linked.py")
    os.symlink(tmp_path / "none.py", tmp_path / "broken.py")
    (tmp_path / "folder.py").mkdir()
    want = texts | {"linked.py": texts["big.py"]}
    for task_bytes in (200_000, 1 << 30):
        files = read_sources(spark, f"file:{tmp_path}", "o/r", task_bytes=task_bytes)
        rows = files.withColumn("task", F.spark_partition_id()).collect()
        assert {r.path: bytes(r.content).decode() for r in rows} == want and len(rows) == len(want)
        held = {}
        for r in rows:
            held.setdefault(r.task, []).append(len(r.content) + OPEN_BYTES)
        # a task ends with the file that reaches its share
        assert all(sum(sizes) - max(sizes) <= task_bytes for sizes in held.values())
        assert len(held) <= sum(map(sum, held.values())) // task_bytes + 1
    (tmp_path / "bare").mkdir()
    assert read_sources(spark, str(tmp_path / "bare"), "o/r").count() == 0


def test_memory_sink_is_bounded(spark):
    records = spark.range(5).select(F.lit("t").alias("topic"), F.col("id").cast("string").alias("key"), F.lit("v").alias("value"))
    assert sorted(r.key for r in sinks.collect_records(records, limit=5)) == list("01234")
    with pytest.raises(ValueError):
        sinks.collect_records(records, limit=4)


def test_compaction_reads_only_what_is_named(spark, tmp_path):
    folder = str(tmp_path / "state")
    for version in range(3):
        elements = spark.createDataFrame([("f", "node", f"n{version}", version)], "file_id string, element_type string, element_id string, version int")
        names = spark.createDataFrame([("f", "r", "h", "t", version)], "file_id string, repo_id string, content_hash string, updated_at string, version int")
        save_state(State(names, elements, version), elements, folder)
    compact_state(spark, folder)
    state = load_state(spark, folder)
    assert state.elements.count() == 1 and state.current_elements().first().element_id == "n2"


def test_missing_files_of_other_repositories_stay(spark, tmp_path):
    other = files_of(spark, {"b.py": "y = 2\n"}).selectExpr("'other' repo_id", "repo_url", "commit_sha", "path", "content", "'other-file' file_id")
    first = incremental_run(other, empty_state(spark))
    second = incremental_run(files_of(spark, {"a.py": "x = 1\n"}), first.state, delete_missing=True)
    assert second.events.where("get_json_object(value, '$.op') = 'delete'").count() == 0
    assert second.state.file_state.where("repo_id = 'other'").count() == 1


def test_shipped_package_is_a_zip(spark):
    ship(spark)
    ship(spark)
    assert any(name.startswith("arborflow") and name.endswith(".zip") for name in map(os.path.basename, spark.sparkContext.listFiles))


def _one_version(spark, version, name):
    elements = spark.createDataFrame([("f", "node", name, version)], "file_id string, element_type string, element_id string, version int")
    names = spark.createDataFrame([("f", "r", "h", "t", version)], "file_id string, repo_id string, content_hash string, updated_at string, version int")
    return State(names, elements, version), elements


def test_of_two_writers_one_fails(spark, tmp_path):
    folder = str(tmp_path / "state")
    save_state(*_one_version(spark, 0, "first"), folder)
    base = load_state(spark, folder)
    assert base.version == 0
    save_state(*_one_version(spark, 1, "winner"), folder)
    with pytest.raises(ConcurrentRun):  # had started from version 0 too
        save_state(*_one_version(spark, 1, "late"), folder)
    # both got past the first look, and one made the commit file before the other
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(state_module, "committed", lambda *_: {0: "version=0"})
        with pytest.raises(ConcurrentRun):
            save_state(*_one_version(spark, 1, "later"), folder)
    with pytest.raises(ConcurrentRun):
        save_state(*_one_version(spark, 5, "gap"), folder)
    assert [r.element_id for r in load_state(spark, folder).current_elements().collect()] == ["winner"]
    # the tries that failed and the version no file names go, what is young stays
    assert clean_state(spark, folder) == []
    gone = clean_state(spark, folder, hours=0)
    assert len([g for g in gone if g.startswith("elements/version=1/")]) == 1 and any(g.startswith("elements/version=0/") for g in gone)
    assert [r.element_id for r in load_state(spark, folder).current_elements().collect()] == ["winner"]
    save_state(*_one_version(spark, 2, "next"), folder)
    assert load_state(spark, folder).version == 2


def test_state_of_the_former_layout_is_read(spark, tmp_path):
    folder = str(tmp_path / "state")
    state, elements = _one_version(spark, 0, "old")
    write_version(elements, f"{folder}/elements", "version", 0)
    write_version(state.file_state, f"{folder}/file_state", "version", 0)
    assert [r.element_id for r in load_state(spark, folder).current_elements().collect()] == ["old"]
    compact_state(spark, folder)
    assert load_state(spark, folder).version == 1
    assert set(clean_state(spark, folder, hours=0)) == {"elements/version=0", "file_state/version=0"}
    assert [r.element_id for r in load_state(spark, folder).current_elements().collect()] == ["old"]


def test_published_runs_are_seen_whole_or_not_at_all(spark, tmp_path):
    folder = str(tmp_path / "out")
    rows = spark.createDataFrame([("t", "k\"1", '{"a":1}'), ("u", "k2", '{"b":"x"}')], "topic string, key string, value string")
    assert sinks.read_published(spark, folder).isEmpty()
    assert sinks.publish(rows, folder) == 0 and sinks.publish(rows.where("topic = 'u'"), folder) == 1
    rows.select("topic", "value").write.partitionBy("topic").text(f"{folder}/runs/run=0123abcd")  # ended before its commit
    got = sorted((r.topic, r.offset, r.key, r.value) for r in sinks.read_published(spark, folder).collect())
    assert got == [("t", 0, 'k"1', '{"a":1}'), ("u", 0, "k2", '{"b":"x"}'), ("u", 1, "k2", '{"b":"x"}')]
    assert [r.offset for r in sinks.read_published(spark, folder, after=0).collect()] == [1]
    assert sinks.clean_published(spark, folder) == [] and sinks.clean_published(spark, folder, hours=0) == ["run=0123abcd"]
    assert sinks.read_published(spark, folder).count() == 3
