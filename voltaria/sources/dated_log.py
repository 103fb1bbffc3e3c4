"""Logs by date whose appends may be repeated, and whose newest rows are found without reading every date.

::

    data/batch=<id>/date=<day>/       the rows of one append
    manifest/batch=<id>/              its rows per date, from the footers of the files it wrote

An append has an id that the caller chooses (a run, an episode range) and owns the folders of that id: done again, it leaves no
second copy. Readers follow the manifest, so an append counts once its manifest is written, and half an append never does.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaria.session import remove_path
from voltaria.sources.metric_log import conform, newest

_MANIFEST = "date date, rows long"


@dataclass(frozen=True)
class DatedLog:
    """A log table with a column ``timestamp`` under one folder."""

    path: str
    schema: T.StructType

    def append(self, df: DataFrame, batch: str, now: datetime | None = None) -> None:
        """Add rows under an id; rows that this id added before are replaced."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
            raise ValueError(f"not an id of letters, digits, dots and dashes: {batch!r}")
        spark, own, said = df.sparkSession, f"{self.path}/data/batch={batch}", f"{self.path}/manifest/batch={batch}"
        remove_path(spark, said)
        dated = conform(df, self.schema, now).withColumn("date", F.to_date("timestamp"))
        dated.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(own)
        counts = spark.read.schema(self._stored()).parquet(own).groupBy("date").agg(F.count(F.lit(1)).alias("rows"))
        counts.coalesce(1).write.parquet(said)

    def manifest(self, spark: SparkSession) -> DataFrame:
        """``batch, date, rows`` of all finished appends."""
        return spark.read.schema(f"{_MANIFEST}, batch string").parquet(f"{self.path}/manifest").select("batch", "date", "rows")

    def read(self, spark: SparkSession, dates: list[date] | None = None) -> DataFrame:
        """The rows of some dates, or of all."""
        return self._rows(spark, [r for r in self.manifest(spark).collect() if dates is None or r.date in set(dates)])

    def newest(self, spark: SparkSession, equals: dict[str, str] | None = None, limit: int = 500, unique: tuple[str, ...] = ()) -> DataFrame:
        """The newest ``limit`` rows that match every equality, newest first; ``unique`` columns break ties.

        Dates are walked from the newest until they hold enough rows: by the manifest's counts alone if nothing is
        to match, else by a count over the next dates, twice as many each time. Only these dates are read.
        """
        by_date: dict[date, list] = {}
        for r in self.manifest(spark).collect():  # a row a date and append, as many as there are folders to list
            by_date.setdefault(r.date, []).append(r)
        taken, found, step = [], 0, 1
        days = sorted(by_date, reverse=True)
        while days and found < limit:
            part = [r for d in days[:step] for r in by_date[d]]
            days, step = days[step:], 2 * step if equals else 1
            taken += part
            found += self._matching(spark, part, equals) if equals else sum(r.rows for r in part)
        return newest(self._rows(spark, taken), equals, limit, unique)

    def _matching(self, spark: SparkSession, part: list, equals: dict[str, str]) -> int:
        rows = self._rows(spark, part)
        for name, value in equals.items():
            rows = rows.where(F.col(name) == F.lit(value))
        return rows.count()

    def _rows(self, spark: SparkSession, part: list) -> DataFrame:
        paths = sorted(f"{self.path}/data/batch={r.batch}/date={r.date.isoformat()}" for r in part)
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self._stored()).option("basePath", f"{self.path}/data").parquet(*paths).select(*self.schema.names)

    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("date", T.DateType())])
