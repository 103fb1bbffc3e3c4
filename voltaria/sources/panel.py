"""Panel, graph and dimension sources: wide matrices become long tables right after the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaria.functions.scalar import finite, timestamp_from_parts
from voltaria.schemas import DISTRICTS, TIME_PARTS
from voltaria.session import broadcast_if_small

EXPECTED_STEPS = 8641
EXPECTED_DISTRICTS = 248
STEP_SECONDS = 300
_ID_NAMES = ("", "id", "node", "node_id", "index", "num")


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).csv(path).columns


def _read_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with every column as text, named by its header; one header line is read, no data is scanned."""
    names = _header(spark, path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).option("header", True).csv(path)


def with_file_position(scan: DataFrame, name: str = "row") -> DataFrame:
    """Add the 0-based row number in file order to a fresh file scan.

    Rows are numbered inside their file block (bounded by the split size); the blocks before it add
    their row counts, one row per block.
    """
    tagged = scan.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    blocks = tagged.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select("_file", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("_file", "_block").orderBy("_id"))
    return (
        tagged.join(bases, ["_file", "_block"])
        .withColumn(name, (F.col("_base") + inside - 1).cast("long"))
        .drop("_file", "_block", "_id", "_base")
    )


def time_index(parts: DataFrame) -> DataFrame:
    """``ts`` from the six integer calendar columns."""
    return parts.withColumn("ts", timestamp_from_parts(*[F.col(c) for c in ("year", "month", "day", "hour", "minute", "second")]))


def read_time_index(spark: SparkSession, path: str) -> DataFrame:
    """``(row, ts)`` in file order; columns are found by name, so their order does not matter."""
    scan = _read_text(spark, path)
    numbered = with_file_position(scan)
    typed = numbered.select("row", *[F.col(f.name).try_cast("int").alias(f.name) for f in TIME_PARTS])
    return time_index(typed).select("row", "ts")


def read_wide_series(spark: SparkSession, path: str, index: DataFrame | None = None) -> DataFrame:
    """``(row, ts, one double column per node)``.

    Unnamed columns are dropped. The file's own ``timestamp`` column wins; else the index is attached
    by row number, unless the row counts differ, in which case ``ts`` stays null.
    """
    scan = _read_text(spark, path)
    nodes = [c for c in scan.columns if c != "timestamp" and not _unnamed(c)]
    numbered = with_file_position(scan)
    values = [finite(F.col(f"`{c}`").try_cast("double")).alias(c) for c in nodes]
    if "timestamp" in scan.columns:
        return numbered.select("row", F.try_to_timestamp("timestamp").cast("timestamp_ntz").alias("ts"), *values)
    if index is None:
        return numbered.select("row", F.lit(None).cast("timestamp_ntz").alias("ts"), *values)
    same = index.agg(F.count(F.lit(1))).scalar() == scan.agg(F.count(F.lit(1))).scalar()
    return numbered.join(index, "row", "left").select("row", F.when(same, F.col("ts")).alias("ts"), *values)


def _unnamed(name: str) -> bool:
    return name == "" or name.lower().startswith(("unnamed", "_c"))


def to_long(wide: DataFrame, value: str = "value", keys: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Wide to ``(keys..., station_id, value)``: one row per key and node column."""
    nodes = [c for c in wide.columns if c not in (*keys, "row", "ts")]
    return wide.unpivot(list(keys), nodes, "station_id", value)


def read_cells(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """Header names, and ``(row, cells)`` with the cells of each line as one array of text, in file order.

    A line is one column until it is split, so neither schema, plan nor generated code grows with the number of columns.
    Quotes around a cell are dropped; commas inside them are not supported.
    """
    first = spark.read.text(path).first()
    names = [n.strip().strip('"') for n in first[0].split(",")] if first else []
    scan = spark.read.schema("line string").option("header", True).option("sep", "\u0001").option("quote", "").csv(path)
    return names, with_file_position(scan).select("row", F.split("line", ",", -1).alias("cells"))


def _nodes(spark: SparkSession, names: list[str], dropped: tuple[str, ...]) -> DataFrame:
    """``(position, number, name)`` of the node columns of a header: place in the line, number among the nodes."""
    kept = [(i, c) for i, c in enumerate(names) if not _unnamed(c) and c.lower() not in dropped]
    rows = [(i, n, c) for n, (i, c) in enumerate(kept)]
    return broadcast_if_small(spark.createDataFrame(rows, "position int, number long, name string"))


def _number(cell: str) -> Column:
    return finite(F.trim(F.col(cell), F.lit('"')).try_cast("double"))


def read_long_series(spark: SparkSession, path: str, index: DataFrame | None = None) -> DataFrame:
    """A wide series file as ``(row, ts, station_id, value)``, whatever the number of its columns.

    Times are found as by :func:`read_wide_series`.
    """
    names, lines = read_cells(spark, path)
    if "timestamp" in names:
        own = F.trim(F.get("cells", F.lit(names.index("timestamp"))), F.lit('"'))
        lines = lines.withColumn("ts", F.try_to_timestamp(own).cast("timestamp_ntz"))
    elif index is None:
        lines = lines.withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    else:
        same = index.agg(F.count(F.lit(1))).scalar() == lines.agg(F.count(F.lit(1))).scalar()
        lines = lines.join(index, "row", "left").withColumn("ts", F.when(same, F.col("ts")))
    cells = lines.select("row", "ts", F.posexplode("cells").alias("position", "cell"))
    named = cells.join(_nodes(spark, names, ("timestamp",)), "position")
    return named.select("row", "ts", F.col("name").alias("station_id"), _number("cell").alias("value"))


def _matrix(spark: SparkSession, path: str, value: str, positive: bool = False) -> DataFrame:
    """A square matrix file as ``(src, dst, value)``; row i belongs to the i-th node column. ``positive`` leaves
    the other entries out before anything is joined."""
    names, lines = read_cells(spark, path)
    nodes = _nodes(spark, names, _ID_NAMES)
    cells = lines.select("row", F.posexplode("cells").alias("position", "cell")).select("row", "position", _number("cell").alias(value))
    if positive:
        cells = cells.where(F.col(value) > 0)
    sources = nodes.select(F.col("number").alias("row"), F.col("name").alias("src"))
    targets = nodes.select("position", F.col("name").alias("dst"))
    return cells.join(targets, "position").join(sources, "row", "left").select("src", "dst", value)


def read_edges(spark: SparkSession, adjacency: str, distance: str) -> DataFrame:
    """Edge list ``(src, dst, dist)`` of the linked node pairs; distance 0 means unknown."""
    linked = _matrix(spark, adjacency, "adj", positive=True).select("src", "dst")
    return linked.join(_matrix(spark, distance, "dist"), ["src", "dst"], "left")


def read_districts(spark: SparkSession, path: str) -> DataFrame:
    """District dimension; columns are matched by name and coerced."""
    scan = _read_text(spark, path)
    have = set(scan.columns)

    def column(field: T.StructField) -> Column:
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        raw = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            return F.trim(raw).alias(field.name)
        number = finite(raw.try_cast("double"))
        return (number.try_cast("int") if isinstance(field.dataType, T.IntegerType) else number).alias(field.name)

    return scan.select(*[column(f) for f in DISTRICTS])


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """Station dimension as text; its columns are not fixed by any schema."""
    return _read_text(spark, path)


def write_by_date(df: DataFrame, path: str, ts: str = "ts", mode: str = "append") -> None:
    """Parquet partitioned by day.

    Rebalanced by day first: small days are not spread over one file per task, and adaptive execution
    splits a day that holds a large share of the rows.
    """
    dated = df.withColumn("date", F.to_date(ts))
    dated.hint("rebalance", "date").write.mode(mode).partitionBy("date").parquet(path)
