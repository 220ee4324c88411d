"""Connected components of a link table, for links of any number.

Every task first turns the links it reads into stars around the smallest node
of what they connect.  Then the large-star and small-star steps alternate, each
pointing every node at the smallest node it knows, until the links form stars.
A step is a grouped minimum (partially aggregated, so a node with very many
links is no hot key) and a join on the node, which Spark splits where it is
skewed.  Each round is written to shared storage, which cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.llm.spans import tidy
from martlens.llm.store import Workspace

BLOCK_LINKS = 500_000   # links a task turns into stars at once


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node it reaches) that connect what (u, v) connect."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    x, y = at[:len(u)], at[len(u):]
    root = np.arange(len(ids))
    while len(x):
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while len(np.flatnonzero(root[root] != root)):
            root = root[root]
        x, y = root[x], root[y]
        x, y = x[x != y], y[x != y]
    far = np.flatnonzero(root != np.arange(len(ids)))
    return ids[far], ids[root[far]]


def _starred(links: DataFrame) -> DataFrame:
    """The links (u, v) that tasks read, as stars of each block."""
    def settle(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        u, v = _stars(*(np.concatenate(x) for x in zip(*held, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for b in batches:
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
            count += b.num_rows
            if count >= BLOCK_LINKS:
                yield settle(held)
                held, count = [], 0
        if count:
            yield settle(held)

    return links.mapInArrow(run, "u long, v long")


def _both(links: DataFrame, first: tuple[str, str], second: tuple[str, str], names: tuple[str, str] = ("u", "v")) -> DataFrame:
    """Two rows of every link: its columns ``first``, and its columns ``second``."""
    return links.select(F.inline(F.array(*[F.struct(*[F.col(c).alias(n) for c, n in zip(pair, names, strict=True)])
                                           for pair in (first, second)])))


def _pointed(links: DataFrame) -> DataFrame:
    """(u, v) to (u, v, m) with m the smallest of u and its neighbours v."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    return links.join(least, "u").withColumn("m", F.least("u", "m"))


def _are_stars(links: DataFrame) -> bool:
    """Does every node of links (u, v), v < u, have one link to a smaller node
    or links to larger ones only?"""
    ends = links.select(F.inline(F.array(F.struct(F.col("u").alias("id"), F.lit(1).alias("down"), F.lit(0).alias("up")),
                                         F.struct(F.col("v").alias("id"), F.lit(0).alias("down"), F.lit(1).alias("up")))))
    return ends.groupBy("id").agg(F.sum("down").alias("down"), F.max("up").alias("up")) \
        .agg(F.max(F.expr("down + up > 1 AND down > 0")).alias("odd")).first()["odd"] is not True


def components(links: DataFrame, ws: Workspace, name: str, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable, for every id with a link."""
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v")
    now = ws.save(_starred(pairs).distinct(), f"{name}-0")
    for turn in range(1, 64):
        if _are_stars(now):
            return _both(now, ("u", "v"), ("v", "v"), ("id", "component")).distinct()
        large = _pointed(_both(now, ("u", "v"), ("v", "u"))).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = ws.save(_both(_pointed(large), ("v", "m"), ("u", "m")).filter("u <> v").distinct(), f"{name}-{turn}")
        if turn > 1:
            ws.drop(f"{name}-{turn - 2}")
    raise RuntimeError("the components did not settle")
