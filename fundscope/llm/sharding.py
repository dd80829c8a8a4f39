"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Native: DataFrame functions only. Every record is hashed by its id into one of
``SLOTS`` virtual slots; the number of slots never changes. A small table says which
shard holds which slot. Growing or rebalancing writes a new version of that table
and moves whole slots, never single records. Bytes and rows are summed per slot
before anything else is shuffled; the map has at most ``MAX_SLOTS`` rows, a fixed
bound, so it is broadcast.

Laws: the first version and ``grown_map`` depend on the slot and the number of shards
only, so a record's shard follows from its id and the shard count, and one more shard
takes slots only into itself. ``rebalanced_map`` edits the map by the measured bytes.

Cases: a null id is hashed as the empty string (all such rows share a slot). A null
text has no bytes (size 1). Repeated rows go to the same shard and get positions of
their own. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 4096
MAX_SLOTS = 65_536
CELLS = 16          # parts of a slot, so that a hot slot is numbered in several tasks
MAP_SCHEMA = "version int, vslot int, shard int"


def virtual_slot(key: Column, slots: int = SLOTS) -> Column:
    """First 32 bits of the key's MD5, modulo the number of slots."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"),
                  F.lit(slots)).cast("int")


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1: equal ranges of slots."""
    if not 1 <= shards <= slots <= MAX_SLOTS:
        raise ValueError("need 1 <= shards <= slots <= MAX_SLOTS")
    return spark.range(slots).select(
        F.lit(1).alias("version"), F.col("id").cast("int").alias("vslot"),
        F.floor(F.col("id") * shards / slots).cast("int").alias("shard"))


def grown_map(current: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """The next version with one shard more: every old shard gives its surplus slots.

    A shard keeps ceil(slots / (shards + 1)) of its slots, chosen by the slot's hash;
    the others go to the new shard. No slot moves between old shards.
    """
    quota = -(-slots // (shards + 1))
    nth = F.row_number().over(Window.partitionBy("shard").orderBy(
        F.md5(F.col("vslot").cast("string")), "vslot"))
    return current.select(
        (F.col("version") + 1).alias("version"), "vslot",
        F.when(nth > quota, F.lit(shards)).otherwise(F.col("shard")).cast("int").alias("shard"))


def rebalanced_map(current: DataFrame, slot_bytes: DataFrame, shards: int) -> DataFrame:
    """The next version, edited so that shards hold about equal bytes.

    ``slot_bytes`` has ``vslot`` and ``bytes``. From the fullest shard the largest slot
    that narrows the gap moves to the emptiest one, until no move helps. Works on the
    map alone (at most ``MAX_SLOTS`` rows, fetched to the driver), never on records.
    """
    rows = (current.join(slot_bytes.select("vslot", "bytes"), "vslot", "left")
            .select("version", "vslot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes"))
            .orderBy("vslot").collect())
    held: dict[int, list[tuple[int, int]]] = {s: [] for s in range(shards)}
    for r in rows:
        held.setdefault(r.shard, []).append((r.bytes, r.vslot))
    load = {s: sum(b for b, _ in v) for s, v in held.items()}
    for _ in range(len(rows)):
        top = max(load, key=lambda s: (load[s], -s))
        low = min(load, key=lambda s: (load[s], s))
        gap = load[top] - load[low]
        fits = [x for x in held[top] if 0 < x[0] < gap]
        if not fits:
            break
        # the move that leaves the two shards closest
        move = min(fits, key=lambda x: (abs(gap - 2 * x[0]), x[1]))
        held[top].remove(move)
        held[low].append(move)
        load[top] -= move[0]
        load[low] += move[0]
    version = (rows[0].version if rows else 0) + 1
    return current.sparkSession.createDataFrame(
        [(version, v, s) for s, own in held.items() for _, v in own], MAP_SCHEMA)


def write_map(slot_map: DataFrame, path: str) -> None:
    """Add a version to the stored maps; older versions stay readable."""
    slot_map.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version, or the newest."""
    maps = spark.read.schema("vslot int, shard int, version int").parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.where(F.col("version") == version).select("version", "vslot", "shard")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, vslot``: all that sharding needs; texts stay behind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"),
                       (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       virtual_slot(F.col(id_col), slots).alias("vslot"))


def cell_totals(records: DataFrame) -> DataFrame:
    """Rows and bytes of each part of a slot (at most slots x CELLS rows)."""
    return (records.groupBy("vslot", F.pmod("text_crc32", F.lit(CELLS)).alias("cell"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")))


def assign(records: DataFrame, totals: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``records`` with ``shard``, ``slot`` (position in the shard, from 0) and the slot's bytes.

    Positions are ordered by virtual slot, cell, id, size and checksum. Running sums over the
    totals (bounded rows) give where each cell begins; rows are numbered within cells.
    """
    slot_map = slot_map.select("vslot", "shard")
    begins = (totals.join(F.broadcast(slot_map), "vslot")
              .select("vslot", "cell", "shard",
                      (F.sum("rows").over(Window.partitionBy("shard").orderBy("vslot", "cell"))
                       - F.col("rows")).alias("begin"),
                      F.sum("bytes").over(Window.partitionBy("shard", "vslot")).alias("vslot_bytes")))
    nth = F.row_number().over(Window.partitionBy("vslot", "cell")
                              .orderBy("doc_id", "size", "text_crc32"))
    numbered = (records.withColumn("cell", F.pmod("text_crc32", F.lit(CELLS)))
                .withColumn("nth", nth))
    # slots x CELLS rows at most: a fixed bound
    return (numbered.join(F.broadcast(begins), ["vslot", "cell"])
            .withColumn("slot", F.col("begin") + F.col("nth") - 1)
            .drop("cell", "nth", "begin"))
