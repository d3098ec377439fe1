"""Log files as a line table ``(file, line_no, value)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Every line of every file below ``path``.  ``line_no`` increases with
    the position in the file (file splits are read in offset order)."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path)
    return df.select(F.col("_metadata.file_path").alias("file"),
                     F.monotonically_increasing_id().alias("line_no"), "value")
