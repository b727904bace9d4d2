"""Registry of queries and their SQL twins. The twins name the views of sources.retail freely."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillweave.sources.retail import DUCK, Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Further views for twins: name to body.
SHARED: dict[str, str] = {}


def spelled_out(sql: str) -> str:
    """sql with the views it needs in front, each after those that it needs itself."""
    bodies, order = DUCK | SHARED, []

    def visit(text: str) -> None:
        for name in bodies:
            if name not in order and re.search(rf"\b{name}\b", text) and text is not bodies[name]:
                visit(bodies[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return ("WITH " + ", ".join(f"{n} AS ({bodies[n]})" for n in order) + "\n" if order else "") + sql


def query(name: str, sql: str | None = None):
    def add(build: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Views(spark, sf_dir))
        if sql is not None:
            SQL[name] = spelled_out(sql)
        return build

    return add
