"""Registered queries and their oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.views import Inputs, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Inputs(spark, folder))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return build

    return add
