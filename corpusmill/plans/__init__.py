"""Queries over the driver tables, each with its DuckDB SQL where SQL can express it."""

from corpusmill.plans import arrays, audit, corpus, history, profiler, reports, runlog, streams  # noqa: F401
from corpusmill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
