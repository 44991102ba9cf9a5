"""Leaving rows out of documents without moving the texts of the others."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from brindle.session import materialize

# A map of hashed keys has 2 to this power bits, in at most 2 ** 20 rows of 64: it can be broadcast
# whatever the input. Where keys outgrow it, more rows take the exact way.
MAP_BITS = 26


def text_mark(text: Column) -> Column:
    """64 bits that tell the texts of one id apart; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _hashed(*keys: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - MAP_BITS)


def key_map(table: DataFrame, *keys: str) -> DataFrame:
    """`word, bits`: a written map of the hashes of all keys of `table`."""
    place = _hashed(*keys)
    marks = table.select(F.shiftright(place, 6).alias("word"), place.bitwiseAND(F.lit(63)).cast("int").alias("at"))
    marks = marks.select("word", F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at")).alias("bit"))
    return materialize(marks.groupBy("word").agg(F.bit_or("bit").alias("bits")), "key-map")


def maybe_in(rows: DataFrame, table: DataFrame, *keys: str) -> DataFrame:
    """`rows` with `maybe`: false only where `table` has no row of these keys.

    The map is joined by broadcast, so the rows are not exchanged.
    """
    words = F.broadcast(key_map(table, *keys))
    placed = rows.withColumn("place", _hashed(*keys))
    bit = F.call_function("shiftright", F.col("bits"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    joined = placed.join(words, F.shiftright(placed["place"], 6) == words["word"], "left")
    maybe = F.coalesce(bit.bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return joined.select(*rows.columns, maybe.alias("maybe"))


def without(docs: DataFrame, gone: DataFrame, mark: Callable[[Column], Column] = text_mark) -> DataFrame:
    """Rows of `docs(doc_id, text, ...)` but those with the id and text of the written table
    `gone(doc_id, mark)`, whose `mark` is that of the text.

    Only rows that the map of `gone` does not rule out are exchanged, the others stay in their tasks.
    Rows without id stay, and so does another text of the same id. All columns are kept, whatever
    their names.
    """
    ids = docs["doc_id"].cast("long").alias("doc_id")
    rows = maybe_in(
        docs.select(F.struct("*").alias("row"), ids, mark(docs["text"]).alias("mark")), gone, "doc_id", "mark"
    )
    left = rows.where("maybe").join(gone, ["doc_id", "mark"], "left_anti")
    return rows.where("not maybe").select("row.*").unionByName(left.select("row.*"))
