"""Rows whose key cannot be in another table are left out before a join moves them.

A bitmap of hashed keys, of fixed size, is built by a grouped aggregate and
broadcast (8 MB at most). A row whose key is among the others always passes;
one whose key is not may pass by a chance of about keys / ``BITS``, and meets
nothing in the join that follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.session import stage

BITS, _BUCKET = 1 << 26, 1 << 15


def _bit(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(BITS))


def key_bitmap(keys: DataFrame, key: str) -> DataFrame:
    """(_part, _bits): the bits of the hashed keys, staged."""
    bits = keys.where(F.col(key).isNotNull()).select(_bit(key).alias("b")).groupBy(F.floor(F.col("b") / F.lit(_BUCKET)).cast("int").alias("_part")).agg(
        F.bitmap_construct_agg(F.col("b") % F.lit(_BUCKET)).alias("_bits"))
    return keys.sparkSession.read.schema("_part int, _bits binary").parquet(stage(bits, "bitmap"))


def sift(df: DataFrame, bitmap: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose key may be in the bitmap; a null key is in none."""
    columns = df.columns
    x = df.where(F.col(key).isNotNull()).withColumn("_b", _bit(key)).withColumn("_part", F.floor(F.col("_b") / F.lit(_BUCKET)).cast("int"))
    x = x.join(F.broadcast(bitmap), "_part")
    byte = F.conv(F.hex(F.expr(f"substring(_bits, cast(_b % {_BUCKET} div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return x.where(byte.bitwiseAND(F.expr("shiftleft(1, cast(_b % 8 as int))")) != 0).select(*columns)
