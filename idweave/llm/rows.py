"""Identity of rows, and meeting texts with what was found out about them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A bitmap of ids has two to this power bits (8 MB), however many ids there are.
ID_BITS = 26


def numbered(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, part, text`` and the columns named by ``carry``. Ids are unique as a rule, and ``part`` is 0; rows that share
    an id are told apart by the order of their texts."""
    carry = tuple(c for c in carry if c not in ("doc_id", "part", "text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)
    ids = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.where("n > 1 and doc_id is not null").isEmpty():
        return rows.withColumn("part", F.lit(0)).select("doc_id", "part", "text", *carry)
    part = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.asc_nulls_first("text"))) - 1
    return rows.withColumn("part", part).select("doc_id", "part", "text", *carry)


def marked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` with ``_near``: true for every id in the column ``doc_id`` of ``ids``, and for few others.

    A look-up in a bitmap of fixed size, so that most texts need not be shuffled to meet what is joined to
    them. Its pieces (4 kB each, 2048 at most) are few enough to send to all executors."""
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << ID_BITS)) + 1  # positions count from 1
    pieces = ids.select(place.alias("_at")).groupBy(F.bitmap_bucket_number("_at").alias("_bucket"))
    pieces = pieces.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_bits"))
    looked = rows.withColumn("_at", place).withColumn("_bucket", F.bitmap_bucket_number("_at"))
    looked = looked.join(F.broadcast(pieces), "_bucket", "left")
    bit = F.bitmap_bit_position("_at")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(bitmap_bit_position(_at) div 8 + 1 as int), 1)")), 16, 10).cast("int")
    near = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    return looked.select(*rows.columns, near.alias("_near"))


def meet(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (of ``numbered``) beside the columns of ``found``, a stored table with at most one row for each
    ``doc_id, part``; null where there is none. Only rows that ``found`` may hold are shuffled."""
    near = marked(rows, found)
    rest = [c for c in found.columns if c not in ("doc_id", "part")]
    types = dict(found.dtypes)
    far = near.where("not _near").drop("_near").withColumns({c: F.lit(None).cast(types[c]) for c in rest})
    return near.where("_near").drop("_near").join(found, ["doc_id", "part"], "left").unionByName(far)
