import json

import pytest
from pyspark.sql import functions as F
from test_graph import as_files

from arborflow.operators import contracts, merge, report
from arborflow.operators.events import parse_events
from arborflow.plans.incremental import incremental_run
from arborflow.schemas import METADATA_EVENT, TOPIC_EDGES, TOPIC_ERRORS, TOPIC_METADATA, TOPIC_NODES
from arborflow.sources.files import in_scope, read_sources
from arborflow.sources.sinks import collect_records, write_jsonl
from arborflow.sources.state import compact_state, empty_state, load_state

OLD = "def f(x):\n    y = x + 1\n    return y\n"
NEW = "def f(x):\n    return x\n"


def files_of(spark, sources):
    blank = F.lit("")
    return as_files(spark, sources).withColumns({"repo_url": blank, "commit_sha": blank})


def tally(records):
    out = {}
    for r in records:
        value = json.loads(r.value)
        out[r.topic, value["op"]] = out.get((r.topic, value["op"]), 0) + 1
    return out


def test_delta_skip_and_force(spark, tmp_path):
    folder = str(tmp_path / "state")
    first = incremental_run(files_of(spark, {"app.py": OLD, "tests/t.py": OLD}), empty_state(spark))
    assert tally(collect_records(first.events)) == {
        (TOPIC_NODES, "upsert"): 19, (TOPIC_EDGES, "upsert"): 21, (TOPIC_METADATA, "upsert"): 1}
    first.commit(folder)

    again = incremental_run(files_of(spark, {"app.py": OLD}), load_state(spark, folder))
    assert collect_records(again.events) == []
    assert [r.status for r in again.results.collect()] == ["skipped"]
    forced = incremental_run(files_of(spark, {"app.py": OLD}), load_state(spark, folder), force=True)
    assert tally(collect_records(forced.events)) == tally(collect_records(first.events))
    ids = lambda run: sorted(json.loads(r.value)["event_id"] for r in run.events.collect())
    assert ids(forced) == ids(first)

    second = incremental_run(files_of(spark, {"app.py": NEW}), load_state(spark, folder), only_path="./app.py")
    assert tally(collect_records(second.events)) == {
        (TOPIC_NODES, "upsert"): 11, (TOPIC_EDGES, "upsert"): 11, (TOPIC_METADATA, "upsert"): 1,
        (TOPIC_NODES, "delete"): 11, (TOPIC_EDGES, "delete"): 16}
    row = second.results.first()
    assert (row.status, row.nodes, row.edges, row.deleted_nodes, row.deleted_edges) == ("processed", 11, 11, 11, 16)
    second.commit(folder)
    state = load_state(spark, folder)
    assert state.current_elements().count() == 22
    compact_state(spark, folder)
    assert load_state(spark, folder).current_elements().count() == 22

    gone = incremental_run(files_of(spark, {"other.py": "x = 1\n"}), load_state(spark, folder), delete_missing=True)
    deletes = {k: v for k, v in tally(collect_records(gone.events)).items() if k[1] == "delete"}
    assert deletes == {(TOPIC_NODES, "delete"): 11, (TOPIC_EDGES, "delete"): 11}
    assert gone.state.file_state.count() == 1
    with pytest.raises(ValueError):
        incremental_run(files_of(spark, {"app.py": NEW}), state, only_path="../app.py")
    with pytest.raises(ValueError):
        incremental_run(files_of(spark, {"app.py": NEW}), state, only_path="none.py")


def test_errors_keep_state(spark, tmp_path):
    sources = {"broken.py": "def broken(:\n    return 1\n", "bytes.py": b"x = '\xff'\n", "ok.py": "x = 1\n"}
    run = incremental_run(files_of(spark, sources), empty_state(spark))
    records = collect_records(run.events)
    assert tally(records)[TOPIC_ERRORS, "error"] == 2 and tally(records)[TOPIC_METADATA, "upsert"] == 3
    assert run.state.file_state.count() == 1
    by_path = {r.path: r for r in run.results.collect()}
    assert {p: r.status for p, r in by_path.items()} == {"broken.py": "error", "bytes.py": "error", "ok.py": "processed"}
    errors = [json.loads(r.value)["error"] for r in records if r.topic == TOPIC_ERRORS]
    assert {e["exception_type"] for e in errors} == {"SyntaxError", "UnicodeDecodeError"}
    assert {e["line"] for e in errors} == {0, 1}
    kinds = {TOPIC_NODES: "node", TOPIC_EDGES: "edge", TOPIC_METADATA: "metadata", TOPIC_ERRORS: "error"}
    for topic, kind in kinds.items():
        log = run.events.where(F.col("topic") == topic)
        checked = contracts.validate_contract(log, contracts.CONTRACTS[kind])
        assert checked.where(F.size("violations") > 0).count() == 0
    write_jsonl(run.events, str(tmp_path / "log"))
    lines = spark.read.text(str(tmp_path / "log")).collect()
    assert len(lines) == len(records)
    assert {tuple(json.loads(r.value)) for r in lines} == {("key", "value")}
    docs = parse_events(run.events.where(F.col("topic") == TOPIC_METADATA), METADATA_EVENT).select("event.metadata.*")
    ok = docs.where("path = 'ok.py'").first()
    assert (ok.node_counts, ok.edge_counts, ok.line_count, ok.size_bytes) == (
        {"AST": 5, "SYNTHETIC": 2}, {"AST": 4, "CFG": 2}, 1, 6)
    assert report.run_summary(run.results).first().asDict() == {"processed": 1, "skipped": 0, "errors": 2}


def test_discovery_on_a_tree(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("arborflow.sources.files.LIST_BUDGET", 1)
    for path, text in {"app.py": "for i in f(1):\n    if i:\n        pass\n", "a b+%20/x_pb2.py": "V = 1\n", "tests/t.py": "",
                       "notes.txt": "no", "_p/__init__.py": ""}.items():
        (tmp_path / path).parent.mkdir(exist_ok=True)
        (tmp_path / path).write_text(text)
    files = read_sources(spark, str(tmp_path), "fixture/sample")
    assert sorted(r.path for r in files.collect()) == ["_p/__init__.py", "a b+%20/x_pb2.py", "app.py", "tests/t.py"]
    assert sorted(r.path for r in in_scope(files).collect()) == ["_p/__init__.py", "app.py"]
    got = report.discovery_report(files).first().asDict()
    assert got == {
        "repo_id": "fixture/sample", "repo_url": "", "commit_sha": "", "raw_python_files": 4, "processed_python_files": 2, "excluded_python_files": 2,
        "total_lines": 3, "parseable_files": 2, "parse_success_rate": 1.0, "has_branch": True, "has_loop": True, "has_call": True}
