"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.  DataFrame functions only.

A key's hash names one of ``cells`` places on a ring; each shard owns ``vnodes`` places.  Keys belong to
the first virtual node at or after their place.  A shard that has reached its bound takes no more: keys
left over go on clockwise to the next virtual node whose shard has room, one wave at a time.

What decides is the count of keys in each cell, so the walk needs no rows: the driver gets at most
``cells`` counts and makes at most ``cells + shards`` pieces, each a range of ranks within a cell, with
the shard and the first slot there.  Every row then finds its piece by its rank in its cell.  Cells with more
than one row in ``HOT`` are ranked in buckets: by a hash of the whole row, and where one row is repeated so often,
by the task that read it, too; a bucket's first rank is a running sum over the buckets before it.

With ``slack=0`` the bounds are the floor and ceiling of the mean and add up to the rows, so counts
differ by one at most (law ``rows``); with ``slack > 0`` a bound is ``ceil((1 + slack) * mean)`` and fewer
keys move when a shard is added.

Defined results: a null text has size 1 and CRC-32 0; null doc_ids share one key; repeated rows take
slots of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize

CELLS = 1 << 14
VNODES = 128
#: A cell, or one and the same row, is hot if it has more than one row in so many; how many buckets it is dealt to.
HOT, BUCKETS = 1000, 64


def cell_of(key: Column, cells: int = CELLS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(cells)).cast("int")


def ring(spark: SparkSession, shards: int, vnodes: int = VNODES, cells: int = CELLS) -> list[tuple[int, int, int]]:
    """(place, shard, virtual node), clockwise; shards x vnodes rows, whatever the data."""
    nodes = spark.range(shards * vnodes).select((F.col("id") / vnodes).cast("int").alias("shard"), F.pmod("id", F.lit(vnodes)).cast("int").alias("vnode"))
    place = cell_of(F.concat_ws("-", F.lit("shard"), "shard", "vnode"), cells)
    return sorted((r.place, r.shard, r.vnode) for r in nodes.select(place.alias("place"), "shard", "vnode").collect())


def bounds(n: int, shards: int, slack: float = 0.0) -> list[int]:
    if slack > 0:
        return [math.ceil((1 + slack) * n / shards)] * shards
    return [n // shards + (s < n % shards) for s in range(shards)]


def walk(counts: dict[int, int], nodes: list[tuple[int, int, int]], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, end rank, shard, first slot): where each cell's keys go."""
    room, filled, pieces = list(room), [0] * len(room), []
    places = [p for p, _, _ in nodes]
    left = [[cell, 0, n, bisect.bisect_left(places, cell) % len(nodes)] for cell, n in sorted(counts.items()) if n]
    while left:
        after = []
        for cell, first, end, at in left:
            while not room[nodes[at][1]]:
                at = (at + 1) % len(nodes)
            shard = nodes[at][1]
            took = min(end - first, room[shard])
            pieces.append((cell, first, first + took, shard, filled[shard]))
            room[shard] -= took
            filled[shard] += took
            if first + took < end:
                after.append([cell, first + took, end, (at + 1) % len(nodes)])
        left = after
    return pieces


def _ranked(rows: DataFrame, hot: list[int]) -> DataFrame:
    """Rows with their rank in their cell, by doc_id and text, or by bucket in the hot ones."""
    by = ["doc_id", "text_crc32", "size"]
    rank = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*by)).cast("long") - 1
    if not hot:
        return rows.withColumn("rank", rank("cell"))
    # written, so that the task that read a row stays the same
    split = materialize(rows.withColumns({"h": F.xxhash64(*by), "task": F.spark_partition_id()}), "shard-rows")
    own, total = split.where(F.col("cell").isin(hot)), split.count()
    same = own.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * HOT > total).select(F.col("h").alias("often"))
    # HOT rows at most
    own = own.join(F.broadcast(same), F.col("h") == F.col("often"), "left")
    often = F.col("often").isNotNull()
    own = own.withColumns({"a": F.pmod("h", F.lit(BUCKETS)), "b": F.coalesce("often", F.lit(0)), "c": F.when(often, F.pmod("task", F.lit(BUCKETS)) + 1).otherwise(F.lit(0))})
    keys = ["cell", "a", "b", "c"]
    sizes = own.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("cell").orderBy("a", "b", "c")) - F.col("n")).drop("n")
    # HOT cells at most, and as many rows that are often there, each in its buckets
    dealt = own.withColumn("in_bucket", rank(*keys)).join(F.broadcast(before), keys)
    cold = split.where(~F.col("cell").isin(hot)).select(*by, "cell").withColumn("rank", rank("cell"))
    return cold.unionByName(dealt.select(*by, "cell", (F.col("before") + F.col("in_bucket")).alias("rank")))


def assign(docs: DataFrame, shards: int = 8, vnodes: int = VNODES, cells: int = CELLS, slack: float = 0.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    doc_id = F.col(f"`{id_col}`")
    counts = {r.cell: r.n for r in docs.groupBy(cell_of(doc_id, cells).alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()}
    pieces = walk(counts, ring(spark, shards, vnodes, cells), bounds(sum(counts.values()), shards, slack))
    by_cell: dict[int, list] = {}
    for cell, first, end, shard, slot in pieces:
        by_cell.setdefault(cell, []).append({"f": first, "e": end, "s": shard, "o": slot - first})
    plan = spark.range(1).select(
        F.inline(F.from_json(F.lit(json.dumps([{"c": c, "p": p} for c, p in by_cell.items()])), "array<struct<c:int,p:array<struct<f:long,e:long,s:int,o:long>>>>"))
    )
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(doc_id.alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), cell_of(doc_id, cells).alias("cell"))
    ranked = _ranked(rows, [c for c, n in counts.items() if n * HOT > sum(counts.values())])
    # at most `cells` rows, as the driver made them
    placed = ranked.join(F.broadcast(plan), ranked["cell"] == plan["c"])
    piece = F.element_at(F.filter("p", lambda x: (x["f"] <= F.col("rank")) & (F.col("rank") < x["e"])), 1)
    return placed.withColumn("piece", piece).select(
        "doc_id", "size", "text_crc32", F.lit("rows" if slack == 0 else "bounded").alias("law"),
        F.col("piece.s").alias("shard"), (F.col("piece.o") + F.col("rank")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
