"""Registry of queries and of the shared SQL views their checks are written against."""

from __future__ import annotations

import re
import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_CHECKS: dict[str, tuple[str, tuple[str, ...]]] = {}
_VIEWS: dict[str, tuple[list[str], str]] = {}


def view(name: str, body: str, *needs: str) -> None:
    _VIEWS[name] = (list(needs), textwrap.dedent(body).strip())


def copy_views(prefix: str, names: list[str]) -> None:
    """The views again under prefixed names, reading each other's copies."""
    words = re.compile(rf"\b({'|'.join(names)})\b")
    for name in names:
        if f"{prefix}{name}" not in _VIEWS:
            needs, body = _VIEWS[name]
            _VIEWS[prefix + name] = ([prefix + n if n in names else n for n in needs], words.sub(rf"{prefix}\1", body))


def _ordered(names, seen):
    for name in names:
        if name not in seen:
            _ordered(_VIEWS[name][0], seen)
            seen.append(name)
    return seen


def sql(body: str, *needs: str) -> str:
    """``body`` behind the WITH clause of the views it needs."""
    parts = [f"{n} AS (\n{textwrap.indent(_VIEWS[n][1], '  ')}\n)" for n in _ordered(needs, [])]
    text = textwrap.dedent(body).strip()
    if not parts:
        return text
    return "WITH " + ",\n".join(parts) + "\n" + text


def query(name: str, body: str | None = None, *needs: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if body is not None:
            _CHECKS[name] = (body, needs)
        return fn

    return register


def checks() -> dict[str, str]:
    """The SQL of every query that has one, with the views it needs."""
    return {name: sql(body, *needs) for name, (body, needs) in _CHECKS.items()}
