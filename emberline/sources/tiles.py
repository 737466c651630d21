"""Land cover as a table of class cells, one folder for each tile, so that a query on bounds reads the tiles it touches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cells along a tile's side.
SIDE = 512


def write_cells(cells: DataFrame, path: str) -> None:
    """cells: (r, c, class). A mosaic: where tiles give a cell twice the larger class stays; class 0 is no data."""
    tiled = cells.groupBy("r", "c").agg(F.max("class").alias("class"))
    tiled = tiled.withColumns({"tile_r": F.floor(F.col("r") / SIDE), "tile_c": F.floor(F.col("c") / SIDE)})
    tiled.repartition("tile_r", "tile_c").sortWithinPartitions("r", "c").write.partitionBy("tile_r", "tile_c").option("compression", "zstd").parquet(path)


def read_cells(spark: SparkSession, path: str, bounds: tuple[int, int, int, int] | None = None) -> DataFrame:
    """(r, c, class), of the rows and columns first .. last of bounds (r0, c0, r1, c1) if given."""
    cells = spark.read.parquet(path)
    if bounds:
        r0, c0, r1, c1 = bounds
        cells = cells.filter(F.col("tile_r").between(r0 // SIDE, r1 // SIDE) & F.col("tile_c").between(c0 // SIDE, c1 // SIDE))
        cells = cells.filter(F.col("r").between(r0, r1) & F.col("c").between(c0, c1))
    return cells.select("r", "c", "class")
