"""Parse step: source text to one flat row per syntax node.

This is the only Python worker of the engine. It calls the standard library parser and
writes down what the tree says about each node (where it stands, what encloses it, which
name it binds or reads). Every graph is derived from these rows with joins and windows.
"""

from __future__ import annotations

import ast
import traceback
import warnings
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborflow.functions.ids import node_id
from arborflow.session import keep_dealt, ship

SCOPES = ["Module", "FunctionDef", "AsyncFunctionDef", "ClassDef"]
FUNCTIONS = ["FunctionDef", "AsyncFunctionDef"]
LOOPS = ["For", "AsyncFor", "While"]
BRANCHES = ["If", "Match"]
BLOCK_FIELDS = ("body", "orelse", "finalbody")

# file: number of the file in this parse, a short join key for tables derived from it.
# pos/end_pos: pre-order position of the node and of the last node below it.
# parent_len, owner_len, scope_len: lengths of the prefixes of `path` that are those nodes' paths.
# owner/region/idx: for a statement, whose block it stands in, which block, and where.
# owners: enclosing statements of the same scope, outermost first, a statement itself last.
# role/symbol: def, use, param or call, and the name concerned.
SYNTAX = (
    "file_id string, file bigint, pos int, end_pos int, depth int, ast_type string, path string, field string, "
    "parent_type string, parent_len int, line int, column int, end_line int, end_column int, name string, value string, "
    "scope_pos int, scope_len int, is_stmt boolean, owner_pos int, owner_type string, owner_len int, region string, "
    "idx int, block_len int, blocks array<string>, loop int, starred boolean, owners array<int>, role string, symbol string, "
    "error struct<exception_type: string, message: string, line: int, column: int, traceback: string>"
)
_NAMES = [part.split(" ")[0] for part in SYNTAX.split(", error ")[0].split(", ")] + ["error"]
_TYPES = {
    "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(),
    "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()),
}
_ARROW = pa.schema(
    [(p.split(" ")[0], _TYPES[p.split(" ")[1]]) for p in SYNTAX.split(", error ")[0].split(", ")]
    + [("error", pa.struct([
        ("exception_type", pa.string()), ("message", pa.string()), ("line", pa.int32()),
        ("column", pa.int32()), ("traceback", pa.string()),
    ]))]
)
#: Roles of the rows that control flow, data flow and calls are made from; stmt stands for every statement and scope.
FLOW_ROLES = ["stmt", "def", "use", "param", "call"]
FLUSH_ROWS = 20_000
#: Source text of a bucket of stored tables; it fans out to some hundred times as much.
BUCKET_BYTES = 1 << 20


class _Kind:
    """What the walk asks of a class of nodes, once for all of them."""

    def __init__(self, cls: type):
        self.name, self.fields = cls.__name__, cls._fields
        self.is_stmt, self.is_scope = issubclass(cls, ast.stmt), cls.__name__ in SCOPES
        self.placed = "lineno" in cls._attributes or "lineno" in cls._fields
        self.labels = [f for f in ("name", "id", "arg", "module") if f in cls._fields]
        self.is_constant = issubclass(cls, ast.Constant)
        self.literal = self.name if issubclass(cls, ast.operator) else ""
        self.bare = self.is_scope or self.name == "Lambda"
        self.passes = self.name in ("ExceptHandler", "match_case")
        self.parted = self.name in ("Try", "TryStar", "Match")
        self.loops = self.name in LOOPS
        self.named = self.name in ("Name", "Call", "alias", "FunctionDef", "AsyncFunctionDef", "ClassDef", "arg")


@lru_cache(maxsize=None)  # as many as the grammar has
def _kind(cls: type) -> _Kind:
    return _Kind(cls)


def _label(node: ast.AST, fields: list[str]) -> str:
    for field in fields:
        text = getattr(node, field, None)
        if isinstance(text, str):
            return text[:200]
    return ""


def _callee(func: ast.AST) -> str:
    attrs: list[str] = []
    while isinstance(func, ast.Attribute):
        attrs.append(func.attr)
        func = func.value
    if isinstance(func, ast.Name):
        attrs.append(func.id)
    return ".".join(reversed(attrs)) or "<dynamic-call>"


def _symbol(node: ast.AST, kind: str, parent_type: str, grandparent_type: str) -> tuple[str | None, str | None]:
    if kind == "Name":
        return ("use" if isinstance(node.ctx, ast.Load) else "def"), node.id
    if kind == "Call":
        return "call", _callee(node.func)
    if kind == "alias":
        return "def", node.asname or (node.name if parent_type == "ImportFrom" else node.name.split(".")[0])
    if kind in ("FunctionDef", "AsyncFunctionDef", "ClassDef"):
        return "def", node.name
    if kind == "arg" and grandparent_type in FUNCTIONS:
        return "param", node.arg
    return None, None


_NO_BLOCK = (None,) * 6


def _walk(file: str, number: int, tree: ast.AST, types: frozenset[str] | None, roles: frozenset[str] | None) -> list[list]:
    """Rows of one tree in pre-order, with an explicit stack so that depth is not limited; only those of `types` and `roles` are made."""
    blocks_too = roles is not None and "stmt" in roles
    rows: list[list] = []
    above: list[int] = []
    # node, path, field, parent type, parent pos, parent len, depth, grandparent type,
    # scope pos, scope len, owners, loop, starred, block info
    stack: list[tuple] = [(tree, "$", "", None, -1, 0, 0, "", -1, 0, [], -1, False, None)]
    while stack:
        node, path, field, parent, up, parent_len, depth, elder, scope_pos, scope_len, owners, loop, starred, block = stack.pop()
        pos, kind, length = len(above), _kind(type(node)), len(path)
        above.append(up)
        name, is_stmt, is_scope = kind.name, kind.is_stmt, kind.is_scope
        chain = owners + [pos] if is_stmt else owners
        role, symbol = _symbol(node, name, parent, elder) if kind.named else (None, None)
        if (types is None or name in types) and (roles is None or role in roles or blocks_too and (is_stmt or is_scope)):
            if kind.placed:
                place = getattr(node, "lineno", 0), getattr(node, "col_offset", 0), getattr(node, "end_lineno", 0) or 0, getattr(node, "end_col_offset", 0) or 0
            else:
                place = 0, 0, 0, 0
            blocks = None
            if is_stmt or is_scope:
                blocks = [f for f in BLOCK_FIELDS if isinstance(own := getattr(node, f, None), list) and own]
            rows.append([
                file, number, pos, pos, depth, name, path, field, parent, parent_len, *place,
                _label(node, kind.labels) if kind.labels else "", repr(node.value)[:200] if kind.is_constant else kind.literal,
                scope_pos, scope_len, is_stmt, *(block or _NO_BLOCK), blocks, loop, starred,
                chain if is_stmt or role == "def" or role == "use" else None, role, symbol, None,
            ])
        if not kind.fields:
            continue
        inner_pos, inner_len = (pos, length) if is_scope else (scope_pos, scope_len)
        if kind.bare:
            chain = []
        inner_starred = False if is_scope else starred or name == "TryStar"
        inner_loop = -1 if is_scope else loop
        elder = parent or ""
        children = []
        for step in kind.fields:
            value = getattr(node, step, None)
            if isinstance(value, list):
                as_block = step in BLOCK_FIELDS
                child_loop = pos if as_block and kind.loops and step == "body" else inner_loop
                for i, child in enumerate(value):
                    if not isinstance(child, ast.AST):
                        continue
                    place = f"{step}[{i}]"
                    if as_block and kind.passes:
                        info = (block[0], block[1], block[2], block[3], i, len(value))
                    elif as_block:
                        info = (pos, name, length, step, i, len(value))
                    elif kind.parted:
                        info = (pos, name, length, place, None, None)
                    else:
                        info = None
                    children.append((
                        child, f"{path}.{place}", place, name, pos, length, depth + 1, elder, inner_pos, inner_len, chain, child_loop,
                        inner_starred, info,
                    ))
            elif isinstance(value, ast.AST):
                children.append((
                    value, f"{path}.{step}", step, name, pos, length, depth + 1, elder, inner_pos, inner_len, chain, inner_loop,
                    inner_starred, None,
                ))
        children.reverse()
        stack += children
    ends = list(range(len(above)))
    for pos in range(len(above) - 1, 0, -1):
        if ends[pos] > ends[above[pos]]:
            ends[above[pos]] = ends[pos]
    for row in rows:
        row[3] = ends[row[2]]
    return rows


def _failure(file: str, exc: Exception) -> tuple:
    """Error row of a file; only syntax errors have a place, the others stand at 0, 0."""
    placed = isinstance(exc, SyntaxError)
    detail = {
        "exception_type": type(exc).__name__,
        "message": str(exc),
        "line": placed and exc.lineno or 0,
        "column": placed and exc.offset or 0,
        "traceback": "".join(traceback.format_exception_only(exc)).strip(),
    }
    return (file, *[None] * (len(_NAMES) - 2), detail)


def _clean(text):
    """Replace lone surrogates, which Arrow text cannot hold."""
    return text.encode("utf-8", "replace").decode("utf-8") if isinstance(text, str) else text


def _parser(lenient: bool, types: frozenset[str] | None, roles: frozenset[str] | None = None):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        warnings.simplefilter("ignore")
        pending: list[tuple] = []
        number = TaskContext.get().partitionId() << 40

        def flush() -> pa.RecordBatch:
            columns = list(zip(*pending))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW
            )

        for batch in batches:
            for file, path, content in zip(*(batch.column(i) for i in range(3))):
                file = file.as_py()
                number += 1
                try:
                    source = content.as_py().decode("utf-8", errors="replace" if lenient else "strict")
                    tree = ast.parse(source, filename=path.as_py(), type_comments=True)
                    pending.extend(_walk(file, number, tree, types, roles))
                except Exception as exc:  # any failure of one file is that file's error row
                    detail = _failure(file, exc)
                    pending.append((*detail[:-1], {k: _clean(v) for k, v in detail[-1].items()}))
                if len(pending) >= FLUSH_ROWS:
                    yield flush()
                    pending.clear()
        if pending:
            yield flush()

    return parse


def parse_files(files: DataFrame, lenient: bool = False, types: list[str] | None = None, roles: list[str] | None = None) -> DataFrame:
    """One row per syntax node (only of `types` and `roles`, when given) or one error row per failed file.

    `files` needs file_id, path and content. Filter it before: predicates do not move below the parse.
    """
    chosen = [frozenset(x) if x is not None else None for x in (types, roles)]
    ship(files.sparkSession)
    return files.select("file_id", "path", "content").mapInArrow(_parser(lenient, *chosen), SYNTAX)


def within(df: DataFrame) -> DataFrame:
    """`df` as the right side of a join by file: looked up bucket by bucket, with nothing sorted and nothing broadcast.

    A plan knows the size of stored tables as that of their compressed files, so it would broadcast what is far larger. The rows
    of a bucket follow BUCKET_BYTES or its largest file.
    """
    return df.hint("shuffle_hash")


def together(*tables: DataFrame) -> DataFrame:
    """The rows of all tables by column name, a column that a table lacks being null; what is dealt by file_id alike stays so.

    Spark sees that a union is dealt only if each of its tables names the key anew: else it compares columns that differ in what
    else is known of them, takes the rows for scattered and shuffles them again.
    """
    named = [t.withColumn("file_id", F.col("file_id").alias("file_id")) for t in tables]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


class Syntax:
    """Parsed corpus: `rows` are the syntax nodes, `errors` the files that failed."""

    def __init__(self, parsed: DataFrame, parts: int | None = None):
        self.parsed, self.parts = parsed, parts
        # ids are long and cheap to make, so they are made where they are read
        parent = F.substring("path", F.lit(1), F.col("parent_len"))
        self.rows = parsed.where("error IS NULL").drop("error").withColumns({
            "id": node_id("file_id", "path", "ast_type"),
            "parent_id": F.when(F.col("pos") > 0, node_id("file_id", parent, "parent_type")),
        })
        self.errors = parsed.where("error IS NOT NULL").select("file_id", "error.*")

    @property
    def joinable(self) -> DataFrame:
        """Rows whose `file` numbers may be joined on: they were written once.

        A second parse may meet the files in another order and number them otherwise.
        """
        if self.parts is None:
            raise ValueError("joins need stored rows: extract(files)")
        return self.rows

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Store a table derived from the rows, dealt by file as they are."""
        return keep_dealt(df, name, "file_id", self.parts)

    def dealt(self, df: DataFrame) -> DataFrame:
        """`df` dealt by its file_id as the stored tables are, so that only `df` moves when they are joined."""
        return within(df.repartition(self.parts, "file_id"))

    @property
    def statements(self) -> DataFrame:
        return self.joinable.where("is_stmt")

    @property
    def scopes(self) -> DataFrame:
        return self.rows.where(F.col("ast_type").isin(SCOPES))


def extract(files: DataFrame, stored: bool = True, roles: list[str] | None = None) -> Syntax:
    """Parse once; `stored` keeps the rows as a table so that several graphs can be built from them.

    With `roles`, rows of others never leave the parse; stmt stands for every statement and scope.

    Stored rows are dealt by file_id before the parse, while they are small, and so are all tables made from them:
    what joins, groups or orders by file moves no row. The number of buckets follows the size of the texts.
    """
    if not stored:
        return Syntax(parse_files(files, roles=roles))
    size = files.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    parts = max(files.sparkSession.sparkContext.defaultParallelism, -(-size // BUCKET_BYTES))
    parsed = parse_files(files.select("file_id", "path", "content").repartition(parts, "file_id"), roles=roles)
    return Syntax(keep_dealt(parsed, "syntax", "file_id", parts), parts)
