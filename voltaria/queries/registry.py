"""Named queries: a Spark callable and, where SQL can express it, the reference statement for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under its name."""

    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


# Sums and means in task order differ in their last bits. Rounding hides that unless a value lies on a
# rounding cut, which averages of short decimals often do; this share of a unit moves the cuts off them.
_OFF_CUT = 0.118034
DIGITS = 7


def settle(column: Column | str, digits: int = DIGITS) -> Column:
    """A double rounded so that two engines agree on it; -0.0 becomes 0.0."""
    value = F.col(column) if isinstance(column, str) else column
    unit = F.lit(10.0**digits)
    return F.rint(value * unit + F.lit(_OFF_CUT)) / unit + F.lit(0.0)


def rounded(df: DataFrame, digits: int = DIGITS, **special: int) -> DataFrame:
    """:func:`settle` every double column; standard deviations keep fewer digits."""

    def places(name: str) -> int:
        return special.get(name, min(digits, 6) if "std" in name else digits)

    return df.withColumns({c: settle(c, places(c)) for c, kind in df.dtypes if kind == "double"})


def R(expr: str, digits: int = DIGITS) -> str:
    """The same rounding in SQL."""
    return f"(round(({expr}) * 1e{digits} + {_OFF_CUT}::DOUBLE) / 1e{digits} + 0.0::DOUBLE)"
