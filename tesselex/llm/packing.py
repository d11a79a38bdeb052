"""Filling containers of fixed capacity by the sum of squares.

Each item goes where sum over gaps g of N(g)^2 becomes smallest, N(g) being the number of open containers with gap g.
Rows are spread over shards by a hash of their key, each large enough that the few containers a shard leaves open do not
matter, and every shard is packed on its own: no state is shared and no shard grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that one shard is meant to hold: about 30 s of packing and a few MB.
SHARD_ROWS = 100_000
_OUT = "item_id long, parte int, tamanho int, recipiente string, livre int"


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Container of each size, in the order given, and how many containers there are. Sizes are 1..capacity; ties go to the smaller gap."""
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)
    bins, where = 0, np.empty(len(sizes), np.int64)
    for i, s in enumerate(sizes.tolist()):
        if s == capacity:
            where[i] = bins
            bins += 1
            continue
        # gap g -> g - s changes the sum by 2 (N(g-s) - N(g) + 1); a full container leaves the sum, a new one enters at capacity - s
        gaps = np.flatnonzero(count[s:]) + s
        best, at = 2 * int(count[capacity - s]) + 1, capacity
        if len(gaps):
            change = 2 * (count[gaps - s] - count[gaps] + 1)
            if gaps[0] == s:
                change[0] = 1 - 2 * int(count[s])
            k = int(np.argmin(change))
            if change[k] <= best:
                at = int(gaps[k])
        if at == capacity:
            b = bins
            bins += 1
        else:
            b = open_by_gap[at].pop()
            count[at] -= 1
        left = at - s
        where[i] = b
        if left:
            open_by_gap[left].append(b)
            count[left] += 1
    return where, bins


def pack_orders(sizes: np.ndarray, keys: np.ndarray) -> list[np.ndarray]:
    """The orders that are tried: largest first, and one mixed by a multiplicative hash of the key. Which is better depends on the sizes."""
    mixed = (keys.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return [np.lexsort((keys, -sizes)), np.argsort(mixed, kind="stable")]


def pack(items: DataFrame, key: str, size: str, capacity: int, rows: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per placed part: item_id, parte (0-based), tamanho, recipiente, livre (unused room of that container).

    An item over `capacity` is cut into full parts and a rest; nothing else is divided. Items of null, zero or negative
    size and of null key get no row. Repeated keys are separate items. `rows` is an upper estimate that only sets the
    number of shards. An empty input gives an empty result.
    """
    shards = max(1, -(-rows // shard_rows))
    part = items.select(F.col(key).cast("long").alias("item_id"), F.col(size).cast("long").alias("n")).where("item_id is not null and n > 0")
    part = part.withColumn("shard", F.pmod(F.xxhash64("item_id", "n"), F.lit(shards)).cast("int"))

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["item_id", "n"], kind="stable")
        n, ids = pdf.n.to_numpy(np.int64), pdf.item_id.to_numpy(np.int64)
        parts = -(-n // capacity)
        item = np.repeat(np.arange(len(n)), parts)
        first = np.cumsum(parts) - parts
        no = np.arange(len(item)) - first[item]
        sizes = np.where(no < parts[item] - 1, capacity, n[item] - (parts[item] - 1) * capacity)
        best: tuple[int, np.ndarray] | None = None
        for order in pack_orders(sizes, item):
            where = np.empty(len(item), np.int64)
            where[order], bins = sum_of_squares(sizes[order], capacity)
            if best is None or bins < best[0]:
                best = bins, where
        bins, where = best
        used = np.bincount(where, weights=sizes, minlength=bins).astype(np.int64)
        name = f"{int(pdf.shard.iloc[0])}-" if len(pdf) else ""
        return pd.DataFrame(
            {
                "item_id": ids[item], "parte": no.astype(np.int32), "tamanho": sizes.astype(np.int32),
                "recipiente": [name + str(b) for b in where.tolist()], "livre": (capacity - used[where]).astype(np.int32)
            }
        )

    # a shard is little data and much work, so shards are spread by number, not gathered by size
    return part.repartition(2 * shards, "shard").groupBy("shard").applyInPandas(shard, _OUT)
