"""Shared shapes of node and edge rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborflow.functions.ids import edge_id, node_id
from arborflow.schemas import EDGE, NODE, fields

NODE_COLUMNS = [n for n, _ in fields(NODE)]
EDGE_COLUMNS = [n for n, _ in fields(EDGE)]


def edges(df: DataFrame, kind: str, source: Column, target: Column, discriminator: Column,
          variable: Column | None = None, resolved: Column | None = None) -> DataFrame:
    """Project to EDGE; endpoints are node ids."""
    return df.select(
        edge_id(F.lit(kind), source, target, discriminator).alias("id"),
        F.lit(kind).alias("kind"),
        source.alias("source_id"),
        target.alias("target_id"),
        F.col("file_id"),
        discriminator.alias("discriminator"),
        (F.lit("") if variable is None else variable).alias("variable"),
        (F.lit(True) if resolved is None else resolved).alias("resolved"),
    )


def made_nodes(df: DataFrame, kind: Column | str, ast_type: Column, path: Column, name: Column) -> DataFrame:
    """Project to NODE for nodes that have no place in the source text."""
    zero = F.lit(0)
    return df.select(
        node_id("file_id", path, ast_type).alias("id"),
        (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"),
        ast_type.alias("ast_type"),
        F.col("file_id"),
        path.alias("structural_path"),
        zero.alias("line"), zero.alias("column"), zero.alias("end_line"), zero.alias("end_column"),
        name.alias("name"),
        F.lit("").alias("value"),
    )


def entry_id(scope_path: Column) -> Column:
    return node_id("file_id", F.concat(scope_path, F.lit(".__entry__")), F.lit("ScopeEntry"))


def exit_id(scope_path: Column) -> Column:
    return node_id("file_id", F.concat(scope_path, F.lit(".__exit__")), F.lit("ScopeExit"))


def external_path(scope_path: Column, discriminator: Column) -> Column:
    return F.concat(scope_path, F.lit(".__external__."), discriminator)
