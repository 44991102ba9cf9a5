"""Readers of box annotations in several formats, all giving one row per box.

The `parse_*` functions work on a table with one document or line per row in `value`, so that a
folder of many small files, read with `wholetext`, or a table of documents is parsed in parallel.

Lists are exploded with `explode_outer` and the empty ones dropped afterwards: for the plain form
Spark infers a filter on the list and parses every document once more to evaluate it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brindle.functions.boxes import CORNERS, compact_category, numbered_name, truncate
from brindle.session import materialize

ANNOTATION_SCHEMA = (
    "image string, xmin double, ymin double, xmax double, ymax double, label string"
)
DETECTION_SCHEMA = (
    "image string, image_path string, xmin int, ymin int, xmax int, ymax int, label int, "
    "confidence double, x_size int, y_size int"
)
ASSET_SCHEMA = (
    "asset struct<format:string,id:string,name:string,path:string,"
    "size:struct<width:int,height:int>,state:int,type:int>,"
    "regions array<struct<id:string,type:string,tags:array<string>,"
    "boundingBox:struct<height:double,width:double,left:double,top:double>,"
    "points:array<struct<x:double,y:double>>>>,"
    "version string"
)
COCO_SCHEMA = "annotations array<struct<image_id:bigint,category_id:int,bbox:array<double>>>"
VOC_SCHEMA = (
    "object array<struct<name:string,difficult:int,"
    "bndbox:struct<xmin:int,ymin:int,xmax:int,ymax:int>>>"
)


CORRUPT = "_corrupt_record"


def read_annotations(
    spark: SparkSession, path: str, schema: str = ANNOTATION_SCHEMA, rejects: bool = False, multiline: bool = False
) -> DataFrame:
    """A CSV table with a header, in the form that `write_table(kind="csv")` writes.

    With `rejects`, the column `_corrupt_record` has the text of rows whose fields do not fit the
    schema. `multiline` allows line breaks inside quotes; such files are read whole, one per task.
    """
    if rejects:
        schema = f"{schema}, {CORRUPT} string"
    return spark.read.csv(
        path, schema=schema, header=True, enforceSchema=False, multiLine=multiline, quote='"', escape='"',
        mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
    )


def split_rejects(read: DataFrame, name: str = "annotations") -> tuple[DataFrame, DataFrame]:
    """The good rows, and one row `n_read, n_ok, n_bad`, of what `read_annotations` has read with rejects.

    The rows are written once, as the text of a rejected row is only known where all fields are read.
    """
    table = materialize(read, name)
    bad = F.col(CORRUPT).isNotNull()
    counts = table.agg(
        F.count(F.lit(1)).alias("n_read"), F.count_if(~bad).alias("n_ok"), F.count_if(bad).alias("n_bad")
    )
    return table.where(~bad).drop(CORRUPT), counts


def read_documents(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Whole files of a folder tree: `value, path`."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*" + suffix)
        .text(path, wholetext=True)
        .select("value", F.col("_metadata.file_path").alias("path"))
    )


def parse_assets(documents: DataFrame) -> DataFrame:
    """Annotation assets: one row per region, the corners from left, top, width and height."""
    return (
        documents.select(F.from_json("value", ASSET_SCHEMA).alias("d"))
        .select("d.asset", F.explode_outer("d.regions").alias("region"))
        .where(F.col("region").isNotNull())
        .withColumn("box", F.col("region.boundingBox"))
        .select(
            F.col("asset.name").alias("image"),
            F.col("asset.path").alias("image_path"),
            F.col("box.left").alias("xmin"),
            F.col("box.top").alias("ymin"),
            (F.col("box.left") + F.col("box.width")).alias("xmax"),
            (F.col("box.top") + F.col("box.height")).alias("ymax"),
            F.get("region.tags", F.lit(0)).alias("label"),
            F.col("asset.size.width").alias("x_size"),
            F.col("asset.size.height").alias("y_size"),
        )
    )


def parse_coco(documents: DataFrame, folder: str) -> DataFrame:
    """Documents with an `annotations` array: whole-number corners and consecutive class codes."""
    return (
        documents.select(F.explode_outer(F.from_json("value", COCO_SCHEMA)["annotations"]).alias("a"))
        .where(F.col("a").isNotNull())
        .select("a.*")
        .select(
            numbered_name(folder, F.col("image_id")).alias("image"),
            truncate(F.col("bbox")[0]).alias("xmin"),
            truncate(F.col("bbox")[1]).alias("ymin"),
            truncate(F.col("bbox")[2]).alias("w"),
            truncate(F.col("bbox")[3]).alias("h"),
            compact_category(F.col("category_id")).alias("code"),
        )
        .select(
            "image",
            "xmin",
            "ymin",
            (F.col("xmin") + F.col("w")).alias("xmax"),
            (F.col("ymin") + F.col("h")).alias("ymax"),
            "code",
        )
    )


def parse_voc(documents: DataFrame, classes: Sequence[str], keep: Sequence[str] = ("path",)) -> DataFrame:
    """XML documents: objects of known classes that are not difficult, with the class index.

    An object that does not say whether it is difficult is not.
    """
    codes = F.create_map(*[F.lit(v) for i, c in enumerate(classes) for v in (c, i)])
    return (
        documents.select(*keep, F.explode_outer(F.from_xml("value", VOC_SCHEMA)["object"]).alias("o"))
        .where(F.col("o.name").isin(*classes) & (F.coalesce("o.difficult", F.lit(0)) != 1))
        .select(*keep, "o.bndbox.*", F.element_at(codes, F.col("o.name")).alias("code"))
    )


# Fixed value: a tag whose value stands on the next line.
def _captures(tag: str) -> Column:
    return F.regexp_extract_all("value", F.lit(rf"(?d)(?:{tag}>\n)(.*)(?:\n</)"), F.lit(1))


def parse_relative_xml(
    documents: DataFrame, keep: Sequence[str] = ("image",), swapped: bool = True
) -> DataFrame:
    """XML with corner coordinates as shares of the image, values on lines of their own.

    Values alternate between the lower and the upper corner. In the files this format comes from
    the `x` tags hold vertical shares; `swapped=False` reads them as horizontal. `documents` must
    carry `x_size, y_size`.
    """
    across, down = ("y", "x") if swapped else ("x", "y")
    found = documents.select(
        *keep,
        "x_size",
        "y_size",
        _captures(across).alias("xs"),
        _captures(down).alias("ys"),
        _captures("label").alias("codes"),
        _captures("labelname").alias("names"),
    )
    each = found.select("*", F.posexplode_outer("names").alias("_i", "_name")).where("_name is not null")

    def at(column: str, upper: int, size: str) -> Column:
        return F.get(column, F.col("_i") * 2 + upper).cast("double") * F.col(size)

    return each.select(
        *keep,
        at("xs", 0, "x_size").alias("xmin"),
        at("ys", 0, "y_size").alias("ymin"),
        at("xs", 1, "x_size").alias("xmax"),
        at("ys", 1, "y_size").alias("ymax"),
        F.col("_name").alias("label"),
        F.get("codes", F.col("_i")).alias("code"),
    )


def parse_training_lines(lines: DataFrame) -> DataFrame:
    """`path x1,y1,x2,y2,c ...` lines: one row per box; an image may span several lines.

    A field that is no whole number is null; `records.complete` drops such rows and
    `records.complete_counts` counts them.
    """
    parts = F.split(F.trim("value"), " ")
    return (
        lines.select(parts.alias("p"))
        .select(
            F.col("p")[0].alias("image"),
            F.explode_outer(F.slice("p", F.lit(2), F.size("p") - 1)).alias("b"),
        )
        .where(F.col("b").isNotNull())
        .select("image", F.split("b", ",").alias("v"))
        .select(
            "image",
            *[F.get("v", F.lit(i)).try_cast("int").alias(c) for i, c in enumerate((*CORNERS, "code"))],
        )
    )
