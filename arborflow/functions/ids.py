"""Stable identifiers as column expressions (JVM-side sha256)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\u001f"


def _col(part: Column | str) -> Column:
    return F.col(part) if isinstance(part, str) else part


def stable_hash(*parts: Column | str) -> Column:
    """sha256 hex over the parts joined by U+001F; a NULL part hashes as the text None."""
    texts = [F.coalesce(_col(p).cast("string"), F.lit("None")) for p in parts]
    return F.sha2(F.concat_ws(SEPARATOR, *texts), 256)


def file_id(repo_id: Column | str, path: Column | str) -> Column:
    return stable_hash(repo_id, path)


def node_id(file: Column | str, structural_path: Column | str, node_type: Column | str) -> Column:
    return stable_hash(file, structural_path, node_type)


def edge_id(kind: Column | str, source: Column | str, target: Column | str, discriminator: Column | str) -> Column:
    return stable_hash(kind, source, target, discriminator)


def element_event_id(element_type: Column | str, op: Column | str, element: Column | str, content_hash: Column | str) -> Column:
    return stable_hash(element_type, op, element, content_hash)


def metadata_event_id(file: Column | str, content_hash: Column | str, status: Column | str) -> Column:
    return stable_hash(F.lit("metadata"), file, content_hash, status)


def error_id(file: Column | str, content_hash: Column | str, exception_type: Column | str, line: Column | str, column: Column | str) -> Column:
    return stable_hash(file, content_hash, exception_type, line, column)
