"""One place where each report is named, next to the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Report = Callable[[SparkSession, str], DataFrame]

REPORTS: dict[str, Report] = {}
CHECKS: dict[str, str] = {}


def report(name: str, check: str | None = None) -> Callable[[Report], Report]:
    """Register a report and, where SQL can state it, the SQL to check it against."""

    def register(func: Report) -> Report:
        if name in REPORTS:
            raise ValueError(f"report {name} is registered twice")
        REPORTS[name] = func
        if check is not None:
            CHECKS[name] = check
        return func

    return register


def with_(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def avg2(total: str, count: str) -> str:
    """A money total over a count, rounded half up to cents in whole numbers (total >= 0)."""
    cents = f"CAST(({total}) * 100 AS HUGEINT)"
    return f"CAST((2 * {cents} + {count}) // (2 * {count}) AS DOUBLE) / 100"


def pct2(part: str, whole: str) -> str:
    """A percentage rounded half up to two decimals in whole numbers (part >= 0)."""
    return f"CAST((20000 * CAST({part} AS HUGEINT) + {whole}) // (2 * {whole}) AS DOUBLE) / 100"


def mln2(total: str) -> str:
    """A money total in millions, rounded half up to two decimals (total >= 0)."""
    return f"CAST((CAST(({total}) * 100 AS HUGEINT) + 500000) // 1000000 AS DOUBLE) / 100"
