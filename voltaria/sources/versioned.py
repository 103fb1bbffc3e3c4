"""Tables whose parts are replaced whole, one version per batch, so that a repeated batch changes nothing.

::

    data/batch=<id>/part=<name>/   the rows of the parts that a batch wrote
    index/batch=<id>/              the batch that holds the newest version of every part, after that batch

A batch writes its data, then its index. Run again, it starts from the index before its own and overwrites its own
folders. Readers follow the newest index; parts that a batch does not touch are neither read nor written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from voltaria.session import file_names, remove_path


class VersionedTable:
    """A table of such parts; ``part`` names a small number of them (days, hash buckets), as text."""

    def __init__(self, root: str) -> None:
        self.root = root

    def batches(self, spark: SparkSession) -> list[int]:
        """Finished batches whose index is still there."""
        names = file_names(spark, f"{self.root}/index")
        held = [int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")]
        return sorted(b for b in held if "_SUCCESS" in file_names(spark, f"{self.root}/index/batch={b}"))

    def index(self, spark: SparkSession, before: int | None = None) -> dict[str, int]:
        """Part and batch of its newest version, after the last batch (below ``before``)."""
        held = [b for b in self.batches(spark) if before is None or b < before]
        if not held:
            return {}
        rows = spark.read.schema("part string, version long").parquet(f"{self.root}/index/batch={held[-1]}")
        return {r["part"]: r["version"] for r in rows.collect()}

    def read(self, spark: SparkSession, schema: T.StructType, parts: list[str] | None = None, before: int | None = None) -> DataFrame:
        """The newest versions of some parts or of all, with the column ``part``."""
        known = self.index(spark, before)
        paths = [f"{self.root}/data/batch={v}/part={p}" for p, v in sorted(known.items()) if parts is None or p in set(parts)]
        full = T.StructType([f for f in schema.fields if f.name != "part"]).add("part", "string")
        if not paths:
            return spark.createDataFrame([], full)
        return spark.read.schema(full).option("basePath", f"{self.root}/data").parquet(*paths).select(*full.names)

    def write(self, df: DataFrame, batch_id: int) -> list[str]:
        """Replace the parts that occur in ``df`` (all rows of a part must be there); returns them."""
        spark, own = df.sparkSession, f"{self.root}/data/batch={batch_id}"
        df.hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(own)
        touched = sorted(n.removeprefix("part=") for n in file_names(spark, own) if n.startswith("part="))
        earlier = self.index(spark, batch_id)
        rows = sorted((earlier | {p: batch_id for p in touched}).items())
        spark.createDataFrame(rows, "part string, version long").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/index/batch={batch_id}")
        self._expire(spark, batch_id, earlier)
        return touched

    def _expire(self, spark: SparkSession, batch_id: int, earlier: dict[str, int]) -> None:
        """Remove what neither this batch's index nor the one before it names; the latter is needed if the batch is repeated."""
        old = [b for b in self.batches(spark) if b < batch_id][:-1]
        for b in old:
            for part, version in self.index(spark, b + 1).items():
                if earlier.get(part) != version:
                    remove_path(spark, f"{self.root}/data/batch={version}/part={part}")
            remove_path(spark, f"{self.root}/index/batch={b}")
