"""Sharding by jump consistent hashing (Lamping and Veach).

A key walks a fixed sequence of ever larger shard numbers; its shard among n
is the last one below n. The sequence depends on the key alone, so adding a
shard moves a key only if its next jump lands on the new shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of

#: Jumps tried. A key makes about ln(n) of them; the chance that one of 2**50
#: keys needs 200 at 2**30 shards is below 1e-40, and it raises an error then.
MAX_JUMPS = 200


def jump_shard(key: Column, shards: int) -> Column:
    """The shard of ``key`` in 0 .. shards - 1. A null key is a key of its own."""
    if not 1 <= shards <= 2**30:
        raise ValueError("1 to 2**30 shards")

    def step(at: Column, i: Column) -> Column:
        draw = F.shiftrightunsigned(F.xxhash64(key, i), 32) + 1          # 1 .. 2**32, uniform
        far = F.floor((at["next"] + 1) * F.lit(2**32) / draw).cast("long")
        return F.when(at["next"] < shards, F.struct(at["next"].alias("shard"), far.alias("next"))).otherwise(at)

    start = F.struct(F.lit(-1).cast("long").alias("shard"), F.lit(0).cast("long").alias("next"))
    end = lambda at: F.when(at["next"] >= shards, at["shard"]).otherwise(
        F.raise_error(F.lit("jump_shard: out of jumps")).cast("long"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, MAX_JUMPS))), start, step, end).cast("int")


def shard_rows(rows: DataFrame, key: str, shards: int, cells: int = 256) -> DataFrame:
    """Adds ``shard`` and ``slot``, a gapless number from 0 within the shard.

    Slots follow (cell, hash, every column), where a cell is a hash class of
    the key. A window covers one cell of a shard only; the cells' counts (at
    most shards x cells rows, hence the broadcast) give their first slots.
    Rows equal in every column have interchangeable slots. An empty table
    gives an empty result.
    """
    hashed = F.xxhash64(F.col(key), F.lit(-1))
    dealt = rows.withColumns({"shard": jump_shard(F.col(key), shards), "_hash": hashed, "_cell": F.pmod(hashed, F.lit(cells)).cast("int")})
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    first = (dealt.select("shard", "_cell").groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("_n"))
             .select("shard", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
    within = Window.partitionBy("shard", "_cell").orderBy("_hash", *rows.columns)
    return (dealt.join(F.broadcast(first), ["shard", "_cell"])
            .withColumn("slot", (F.col("_first") + F.row_number().over(within) - 1).cast("long"))
            .drop("_hash", "_cell", "_first"))


def shard_documents(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's shard among ``shards`` and among one more.

    Returns doc_id, size (UTF-8 bytes plus 8), text_crc32, law ('key'), shard,
    slot, grown_shard. A null text has size 8 and the checksum of no bytes; a
    null id is a key of its own; rows with one id share a shard; other columns
    of ``docs`` are not read. Texts are measured before the only shuffle.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text_of(text_col)) + 8).cast("long").alias("size"),
        F.crc32(text_of(text_col).cast("binary")).alias("text_crc32"))
    return (shard_rows(rows, "doc_id", shards)
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                    jump_shard(F.col("doc_id"), shards + 1).alias("grown_shard")))
