"""Incremental code-graph analytics on Spark."""

from arborflow.operators.report import discover, discovery_report
from arborflow.operators.syntax import extract
from arborflow.plans.graph import Graph, build_graph
from arborflow.plans.incremental import Run, incremental_run

__all__ = ["Graph", "Run", "build_graph", "discover", "discovery_report", "extract", "incremental_run"]
