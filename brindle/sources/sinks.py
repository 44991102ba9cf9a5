"""Writers of lines, dictionaries and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def write_lines(
    lines: DataFrame, path: str, column: str = "line", codec: str | None = None, by: Sequence[str] = ()
) -> None:
    """One text line per row, in as many files as there are partitions; `by` names nested folders.

    A `codec` such as gzip makes files that cannot be split again, so they should not be few and large.
    """
    rows = lines.select(F.col(column).alias("value"), *by)
    writer = rows.write.partitionBy(*by) if by else rows.write
    writer.text(path, compression=codec)


def write_class_names(codes: DataFrame, path: str) -> None:
    """Class names ordered by code, one per line, as one file: the line number is the code."""
    codes.select("label", "code").repartition(1).sortWithinPartitions("code").select(
        F.col("label").alias("value")
    ).write.text(path)


def write_table(df: DataFrame, path: str, kind: str = "parquet", by: Sequence[str] = ()) -> None:
    """Parquet, or CSV with a header; `by` names the columns of the folder layout."""
    writer = df.write.partitionBy(*by) if by else df.write
    if kind == "csv":
        writer.csv(path, header=True, quote='"', escape='"')
    else:
        writer.parquet(path)


def write_logs(logs: DataFrame, path: str) -> None:
    """Parsed log records in folders by date, so that reports over some days read only these."""
    write_table(logs.withColumn("date", F.to_date("date_time")), path, by=["date"])


def anchors_line(anchors: Sequence[tuple[float, float]]) -> str:
    return ", ".join(f"{int(w)},{int(h)}" for w, h in anchors)


def write_anchors(spark, anchors: Sequence[tuple[float, float]], path: str) -> None:
    """`w,h, w,h, ...` on one line."""
    spark.createDataFrame([(anchors_line(anchors),)], "value string").coalesce(1).write.text(path)


def write_crops(crops: DataFrame, folder: str, path: str) -> None:
    """Manifest of crop files: CSV with the column `image_path`."""
    target = F.concat(F.lit(folder.rstrip("/") + "/"), "crop")
    crops.select(F.replace(target, F.lit("\\"), F.lit("/")).alias("image_path")).write.csv(path, header=True)
