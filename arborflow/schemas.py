"""Fixed record layouts; nothing is inferred from data."""

from __future__ import annotations

SCHEMA_VERSION = "1.0"

# The five logs and the edge categories.
TOPIC_NODES = "cpg.nodes.v1"
TOPIC_EDGES = "cpg.edges.v1"
TOPIC_METADATA = "cpg.source-metadata.v1"
TOPIC_ERRORS = "cpg.parser-errors.v1"
TOPIC_DEAD_LETTERS = "cpg.dead-letters.v1"
EDGE_KINDS = ["AST", "CFG", "DFG", "CALL"]

NODE = (
    "id string, kind string, ast_type string, file_id string, structural_path string, "
    "line int, column int, end_line int, end_column int, name string, value string"
)
EDGE = (
    "id string, kind string, source_id string, target_id string, file_id string, "
    "discriminator string, variable string, resolved boolean"
)
ENVELOPE = (
    "schema_version string, event_time string, repo_id string, file_id string, run_id string, "
    "content_hash string, event_id string, op string"
)
METADATA = (
    "_id string, repo_id string, repo_url string, path string, content_hash string, size_bytes int, line_count int, "
    "commit_sha string, parse_status string, node_counts map<string,int>, edge_counts map<string,int>, "
    "warnings array<string>, error_message string, processed_at string, run_id string, schema_version string"
)
ERROR = (
    "id string, stage string, exception_type string, message string, line int, column int, "
    "recoverable boolean, traceback string"
)


def _struct(body: str) -> str:
    return "struct<" + ", ".join(f"{n}: {t}" for n, t in fields(body)) + ">"


def fields(body: str) -> list[tuple[str, str]]:
    """(name, type) pairs of one of the layouts above."""
    depth, start, parts = 0, 0, []
    for i, ch in enumerate(body):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            parts.append(body[start:i])
            start = i + 1
    parts.append(body[start:])
    return [tuple(p.strip().split(" ", 1)) for p in parts]


NODE_EVENT = f"{ENVELOPE}, node {_struct(NODE)}"
EDGE_EVENT = f"{ENVELOPE}, edge {_struct(EDGE)}"
METADATA_EVENT = f"{ENVELOPE}, metadata {_struct(METADATA)}"
ERROR_EVENT = f"{ENVELOPE}, error {_struct(ERROR)}"

# A log record as a topic reader sees it.
LOG = "topic string, partition int, offset bigint, timestamp timestamp, key string, value string"
