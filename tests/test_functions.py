import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arborflow.functions import ids, paths, text

quick = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))


def column(spark, values, type_, make):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {type_}")
    return [r.o for r in df.select("i", make(F.col("v")).alias("o")).orderBy("i").collect()]


def test_published_ids(spark):
    row = spark.range(1).select(
        ids.file_id(F.lit("huggingface/optimum"), F.lit("optimum/version.py")).alias("f"),
        ids.node_id(F.lit("f" * 64), F.lit("$"), F.lit("Module")).alias("n"),
        ids.edge_id(F.lit("AST"), F.lit("a"), F.lit("b"), F.lit("")).alias("e"),
        ids.stable_hash(F.lit("a"), F.lit(None), F.lit(3)).alias("s"),
    ).first()
    assert row.f == "867c06c1f6e594bef9a16137312503a0870399626a16dded522ce7a24143b1a7"
    assert row.n == "eda62d69bf8e27184f38d95324578182b4feb1a92b327b26b4bfd62dd5b08ed7"
    assert row.e == hashlib.sha256(b"AST\x1fa\x1fb\x1f").hexdigest()
    assert row.s == hashlib.sha256(b"a\x1fNone\x1f3").hexdigest()


@quick
@given(st.lists(st.text(max_size=12), min_size=60, max_size=60))
def test_stable_hash_random(spark, values):
    got = column(spark, values, "string", lambda c: ids.stable_hash(c, F.lit("x")))
    assert got == [hashlib.sha256(f"{v}\x1fx".encode()).hexdigest() for v in values]


@quick
@given(st.lists(st.text(alphabet="a\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029\x1f é", max_size=10), min_size=100, max_size=100))
def test_line_count_random(spark, values):
    assert column(spark, values, "string", text.line_count) == [len(v.splitlines()) for v in values]


@quick
@given(st.lists(st.one_of(st.binary(max_size=8), st.text(max_size=3).map(lambda t: t.encode()[:-1])), min_size=150, max_size=150))
def test_lenient_text_random(spark, values):
    got = column(spark, [bytearray(v) for v in values], "binary", text.lenient_text)
    assert got == [v.decode("utf-8", errors="replace") for v in values]


def test_line_count_cases(spark):
    cases = {"a\nb\n": 2, "a\r\nb": 2, "": 0, "a\u2028b\x0c": 2, "\n": 1, "\r\n": 1, "\n\r": 2}
    assert column(spark, list(cases), "string", text.line_count) == list(cases.values())


def test_scope_rules(spark):
    cases = {
        "a/Build/x.py": True, "tests.py": False, "setup.py": True, "a/setup.py": True, "TEST_x.py": True,
        "x_test.py": True, "x_pb2_grpc.py": True, "generated/x.py": True, "generated.py": False,
        "mytests/x.py": False, "a/tests/b/x.py": True, "a/.git/x.py": True, "a.py": False, "x_pb2.py": True,
    }
    assert column(spark, list(cases), "string", paths.is_excluded) == list(cases.values())


def test_repo_names(spark):
    cases = {
        "https://github.com/o/r.git": "o/r", "git@github.com:o/r.git": "o/r", "https://x.org/o/r": "folder",
        "": "folder", "https://github.com/": "folder", "https://github.com\\o\\r": "o/r",
        "https://github.com/a/github.com/b": "a/github.com/b",
    }
    assert column(spark, list(cases), "string", lambda c: paths.repo_id_from_url(c, F.lit("folder"))) == list(cases.values())


def test_path_guard(spark):
    cases = {"a/./b/../c.py": ("a/c.py", True), "../a.py": ("../a.py", False), "a/../../b.py": ("../b.py", False),
             "a//b.py": ("a/b.py", True), "a.txt": ("a.txt", False), "/etc/x.py": ("etc/x.py", False), ".py": (".py", False),
             "../../x/../y.py": ("../../y.py", False)}
    assert column(spark, list(cases), "string", paths.normalize_path) == [c[0] for c in cases.values()]
    assert column(spark, list(cases), "string", paths.inside_root) == [c[1] for c in cases.values()]
