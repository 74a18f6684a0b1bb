"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Each shard has many points on the ring; the arc before a point is that point's. A key goes to the point of its arc; once a
shard is full, its further keys go on clockwise to the next point of a shard with room. The order is fixed, so that the
result is the same every time: step by step, the rows of every arc that are still without a place ask the next point, and a
shard takes them in order of the arcs. With `load` 1 the capacities add up to the rows, so that shards differ by one row at
most; with more, fewer keys move when a shard is added.

Only the rows in each part of an arc are counted, and who takes how many of which arc is worked out from those counts: a
table as large as the ring, whatever the data. A row's place follows from its rank within its arc. No text is shuffled.

Defined cases: a null key is a key of its own; repeated keys meet in one arc, spread over its parts by the other columns of the
order, and rows alike in all of these are interchangeable; an empty table gives no rows."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

DIGITS, PARTS = 15, 8


def points(shards: int, virtual: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of all points on the ring in order, and the shard of each."""
    at = [(int(hashlib.md5(f"shard-{s}-point-{v}".encode()).hexdigest()[:DIGITS], 16), s)
          for s in range(shards) for v in range(virtual)]
    places, owners = zip(*sorted(at))
    return np.array(places, np.int64), np.array(owners)


def capacities(rows: int, shards: int, load: float) -> np.ndarray:
    """What each shard may hold: even shares at a load of 1, otherwise the share times the load."""
    if load <= 1:
        return rows // shards + (np.arange(shards) < rows % shards)
    return np.full(shards, -int(-load * rows // shards))


def fill(counts: np.ndarray, owners: np.ndarray, room: np.ndarray) -> pd.DataFrame:
    """Who takes which rows of each arc: arc, first and end of the ranks, shard, and the slot of the first."""
    left, taken, size = counts.astype(np.int64).copy(), np.zeros(len(counts), np.int64), len(counts)
    room, used, out, step = room.astype(np.int64).copy(), np.zeros(len(room), np.int64), [], 0
    while left.any():
        owner = np.roll(owners, -step)
        arcs = np.flatnonzero((left > 0) & (room[owner] > 0))
        arcs = arcs[np.argsort(owner[arcs], kind="stable")]
        asked, of = left[arcs], owner[arcs]
        before = np.cumsum(asked) - asked
        if len(arcs):
            heads = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            before = before - np.repeat(before[heads], np.diff(np.r_[heads, len(of)]))
        got = np.clip(room[of] - before, 0, asked)
        on = got > 0
        out.append(pd.DataFrame({"arc": arcs[on], "low": taken[arcs[on]], "high": taken[arcs[on]] + got[on], "shard": of[on],
                                 "slot_low": used[of[on]] + before[on]}))
        left[arcs] -= got
        taken[arcs] += got
        total = np.bincount(of, got, len(room)).astype(np.int64)
        room, used, step = room - total, used + total, (step + 1) % size
    return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("arc", "low", "high", "shard", "slot_low")})


def place(rows: DataFrame, key: Column, order: Sequence[str], spread: Column, shards: int, virtual: int = 256,
          load: float = 1.0) -> DataFrame:
    """The rows with `shard` and `slot`, gapless from 0 in each shard; columns that had these names are replaced. `order` are the columns that order equal keys;
    `spread` a number that spreads them over the parts of their arc."""
    places, owners = points(shards, virtual)

    @F.pandas_udf("int")
    def arc(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(places, at.to_numpy()) % len(places), dtype="int32")

    digest = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null")).cast("binary")), 1, DIGITS)
    keyed = (rows.select(F.struct("*").alias("_row"), F.conv(digest, 16, 10).cast("long").alias("_at"),
                         F.pmod(spread, F.lit(PARTS)).cast("int").alias("_part")).withColumn("_arc", arc("_at")))
    # At most one row for each part of an arc: bounded by the ring.
    sizes = keyed.groupBy("_arc", "_part").count().toPandas().astype("int64").sort_values(["_arc", "_part"])
    counts = np.bincount(sizes["_arc"], sizes["count"], len(places)).astype(np.int64)
    sizes["_before"] = sizes.groupby("_arc")["count"].cumsum() - sizes["count"]
    taken = fill(counts, owners, capacities(int(counts.sum()), shards, load))
    spark = rows.sparkSession
    before = spark.createDataFrame(sizes[["_arc", "_part", "_before"]], "_arc int, _part int, _before long")
    taken = spark.createDataFrame(taken, "arc int, low long, high long, shard int, slot_low long")
    ranked = keyed.withColumn("_in", F.row_number().over(Window.partitionBy("_arc", "_part").orderBy("_at", *(f"_row.{c}" for c in order))) - 1)
    rank = F.col("_before") + F.col("_in")
    return (ranked.join(F.broadcast(before), ["_arc", "_part"])
            .join(F.broadcast(taken), (F.col("_arc") == F.col("arc")) & (rank >= F.col("low")) & (rank < F.col("high")))
            .select(*(f"_row.{c}" for c in rows.columns if c not in ("shard", "slot")), "shard", (F.col("slot_low") + rank - F.col("low")).alias("slot")))
