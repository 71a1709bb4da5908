import ast

import pytest

from bruteforce import analyze
from programs import program
from pyspark.sql import functions as F

from arborflow.functions.ids import file_id
from arborflow.operators import calls, control, data, reach, report, tree
from arborflow.operators.syntax import FLOW_ROLES, Syntax, extract
from arborflow.plans.graph import build_graph


def as_files(spark, sources):
    rows = [("t/r", path, bytearray(text.encode() if isinstance(text, str) else text)) for path, text in sources.items()]
    files = spark.createDataFrame(rows, "repo_id string, path string, content binary")
    return files.withColumn("file_id", file_id("repo_id", "path"))


def compare(spark, sources):
    files = as_files(spark, sources)
    ids = {r.path: r.file_id for r in files.select("path", "file_id").collect()}
    graph = build_graph(files)
    nodes, edges, warnings = {}, {}, {}
    for r in graph.nodes.collect():
        assert r.id not in nodes
        nodes[r.id] = (r.kind, r.ast_type, r.structural_path, r.line, r.column, r.end_line, r.end_column, r.name, r.value)
    for r in graph.edges.collect():
        assert r.id not in edges
        edges[r.id] = (r.kind, r.source_id, r.target_id, r.discriminator, r.variable, r.resolved)
    for r in graph.warnings.orderBy("file_id", "ord").collect():
        warnings.setdefault(r.file_id, []).append(r.text)
    want_nodes, want_edges = {}, {}
    for path, text in sources.items():
        n, e, w = analyze(text, ids[path])
        want_nodes |= n
        want_edges |= e
        assert warnings.get(ids[path], []) == w, text
        missing = {v for k, v in e.items() if k not in edges}
        assert not missing, (text, missing)
    extra = {k: v for k, v in edges.items() if k not in want_edges}
    if extra:
        owner = graph.edges.where(F.col("id") == next(iter(extra))).first().file_id
        raise AssertionError(([s for p, s in sources.items() if ids[p] == owner][0], list(extra.values())[:3]))
    assert edges == want_edges
    assert nodes == want_nodes


def test_random_programs(spark):
    sources = {}
    for seed in range(120):
        text = program(seed)
        try:
            ast.parse(text)
        except SyntaxError:
            continue
        sources[f"p{seed}.py"] = text
    assert len(sources) > 100
    compare(spark, sources)


def test_empty_and_tiny(spark):
    compare(spark, {
        "empty.py": "",
        "comment.py": "# only\n",
        "stray.py": "while x:\n    x = f(x)\nbreak\nif x:\n    continue\n",
        "star.py": "try:\n    break\nexcept* E:\n    for a in b:\n        a = a\n    match a:\n        case 1:\n            pass\n",
        "dead.py": "def f(a):\n    return a\n    while a:\n        a = b\n    if a:\n        return 1\n        b = a\n    print(b)\n",
    })


def test_joins_refuse_rows_that_are_parsed_again(spark):
    syntax = extract(as_files(spark, {"a.py": "x = 1\n"}), stored=False)
    with pytest.raises(ValueError, match="stored"):
        control.flow_edges(syntax)


def test_rows_of_other_roles_never_leave_the_parse(spark):
    files = as_files(spark, {"a.py": "import os.path as p\nfor x in p(y):\n    def f(a, *b: x): return a\n", "b.py": "x = (\n"})
    whole, some = (extract(files, stored=False, roles=r).parsed for r in (None, ["def", "use"]))
    assert {r.role for r in some.where("error IS NULL").select("role").collect()} == {"def", "use"}
    want = whole.where("role IN ('def', 'use') OR error IS NOT NULL")
    assert sorted(map(str, some.collect())) == sorted(map(str, want.collect())) and some.count() < whole.count()


def test_deep_source_is_processed(spark):
    text = "x = " + "+".join(["a"] * 1500) + "\n"
    graph = build_graph(as_files(spark, {"deep.py": text, "deeper.py": "x = " + "(" * 300 + "a" + ")" * 300 + "\n"}))
    assert graph.nodes.where("ast_type = 'BinOp'").count() == 1499
    assert [r.exception_type for r in graph.errors.collect()] == ["SyntaxError"]


def test_tables_of_a_graph_move_no_rows(spark):
    files = as_files(spark, {f"f{k}.py": "def f(a):\n    while a:\n        a = a - 1\n    return a\n" for k in range(3)})
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        syntax = extract(files)
        flow = syntax.keep(control.flow_edges(syntax), "flow")
        counts = control.cfg_edges(flow).unionByName(calls.call_edges(calls.resolve_calls(syntax))).groupBy("file_id").count()
        plans = [d._jdf.queryExecution().executedPlan().toString() for d in (control.flow_edges(syntax), counts)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert [p.count("Exchange") for p in plans] == [0, 0]
    assert "id" not in syntax.parsed.columns and {r["count"] for r in counts.collect()} == {7}


def test_search_for_definitions_moves_and_broadcasts_nothing(spark, monkeypatch):
    """Neither joins nor unions of stored tables, whose compressed files look small enough to be broadcast."""
    text = "def f(a, b):\n    while a:\n        for b in a:\n            a = b\n        a = a - b\n    return a, c\n"
    plans, keep = [], Syntax.keep

    def told(self, df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(self, df, name)

    monkeypatch.setattr(Syntax, "keep", told)
    syntax = extract(as_files(spark, {f"f{k}.py": text for k in range(3)}), roles=FLOW_ROLES)
    flow = syntax.keep(control.flow_edges(syntax), "flow")
    pairs, unresolved = reach.reaching_definitions(syntax, flow)
    plans += [d._jdf.queryExecution().executedPlan().toString() for d in (pairs, data.outside_uses(syntax, unresolved))]
    assert len(plans) > 10 and not [p for p in plans if "Exchange" in p]
    # 12 where the uses stand, and two uses of b that the while owns and so asks at its start
    assert {r["count"] for r in pairs.groupBy("file_id").count().collect()} == {14}
    assert unresolved.count() == 3


def test_statements_and_names_are_enough_for_flow(spark):
    """With FLOW_ROLES only rows that no flow is made from stay in the parse."""
    sources = {f"p{seed}.py": program(seed) for seed in range(6)}
    files = as_files(spark, sources)
    found, sizes = [], []
    for roles in (None, FLOW_ROLES):
        syntax = extract(files, roles=roles)
        flow = syntax.keep(control.flow_edges(syntax), "flow")
        pairs, unresolved = reach.reaching_definitions(syntax, flow)
        uses = data.outside_uses(syntax, unresolved)
        rows = [control.cfg_edges(flow), data.dfg_edges(pairs, uses), calls.call_edges(calls.resolve_calls(syntax))]
        found.append([sorted(map(str, r.collect())) for r in rows])
        sizes.append(syntax.parsed.count())
    assert found[0] == found[1] and sizes[1] < sizes[0]


def test_what_is_joined_by_file_is_looked_up_not_broadcast(spark):
    """The plan takes the rows for their compressed file, so it would broadcast the nodes to the files."""
    files = as_files(spark, {f"f{k}.py": "x = 1\n" for k in range(3)})
    syntax = extract(files)
    joined = tree.ast_nodes(syntax).join(syntax.dealt(files.select("file_id", "repo_id")), "file_id")
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 15


def test_totals_tell_ids_apart_that_differ_in_case(spark):
    ids = ["ab" * 32, "AB" * 32, "ab" * 32, None, "x"]
    nodes = spark.createDataFrame([(i,) for i in ids], "id string")
    got = report.corpus_totals(nodes, nodes.limit(0), nodes.limit(0), nodes).first()
    assert (got.nodes, got.distinct_nodes, got.edges, got.distinct_edges) == (5, 3, 0, 0)
