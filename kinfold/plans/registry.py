"""All queries of the library by name, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from . import linkage


def queries() -> dict[str, Callable]:
    return dict(linkage.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(linkage.ORACLES)
