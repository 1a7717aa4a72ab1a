"""Queries by name, each with the SQL that it is compared with (None where SQL can't express it)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lemmata.sources.views import Views, oracle_prefix

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The module that each query is in.
MODULE: dict[str, str] = {}


def query(name: str, views: str = "", sql: str | None = None):
    """Register ``fn(v)``, v giving tables and derived views as DataFrames; ``views`` are those that ``sql`` names."""

    def add(fn: Callable[[Views], DataFrame]):
        MODULE[name] = fn.__module__.rpartition(".")[2]
        QUERIES[name] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle_prefix(views.split()) + sql
        return fn

    return add
