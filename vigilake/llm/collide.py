"""Nearest neighbours by collision counting.

Every hash function is one random projection, and the vectors of a shard are kept as one sorted array per
function. A query opens a window around its own projection in each array; a vector collides once for each
window it lies in. Virtual rehashing widens all windows step by step for growing radii; a query starts at the
radius at which the one before it was done and goes down or up from there. Vectors whose
collisions reach the threshold are verified with the exact measure. A query is done in a shard once its
k-th nearest verified vector is within the current radius: a nearer one would have passed the threshold at
this radius, but for the chance that `miss_z` standard deviations leave.

Vectors are on the unit sphere here, so distance and cosine order alike. Shards have a bounded number of
vectors and query blocks a bounded number of queries; a task handles one pair of them. Equal vectors of a
shard are one entry with its smallest ids, so copies cost nothing.

Defined cases: null, zero and non-finite vectors (or such components) take no part; vectors of another length
than the most usual one take no part either; ties go to the smaller id; rows of one id with different vectors
are separate candidates, and none of them is found for a query of that id; with fewer candidates than k all
are found; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilake.session import materialise


class Shard:
    """The sorted projection arrays of some vectors, searched by windows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, functions: int, seed: int, miss_z: float = 1.5, start: float = 0.3, growth: float = 1.1):
        self.k, self.start, self.growth = k, start, growth
        # one entry per distinct vector with its k + 1 smallest ids: a query may have to leave itself out
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        first = np.concatenate([[True], (vectors[1:] != vectors[:-1]).any(axis=1)]) if len(ids) else np.zeros(0, bool)
        lead = np.flatnonzero(first)
        self.vectors = vectors[lead]
        self.ids = [ids[a : min(b, a + k + 1)] for a, b in zip(lead, np.append(lead[1:], len(ids)))]
        self.unit = self.vectors / np.linalg.norm(self.vectors, axis=1, keepdims=True)
        self.lines = np.random.default_rng(seed).standard_normal((vectors.shape[1], functions))
        where = self.unit @ self.lines
        order = np.argsort(where, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(where.T, order, axis=1).copy()
        # where each vector stands in each array
        self.place = np.empty(order.shape, np.uint16 if len(lead) < 1 << 16 else np.uint32)
        np.put_along_axis(self.place, order, np.arange(len(lead), dtype=self.place.dtype)[None, :], axis=1)
        # a vector at distance r lies within r of the query's projection with probability p; the threshold is that mean less some deviations
        p = 0.6826894921370859
        self.threshold = int(np.floor(functions * p - miss_z * np.sqrt(functions * p * (1 - p))))

    def radii(self) -> list[float]:
        out = [self.start]
        while out[-1] < 2.0:
            out.append(out[-1] * self.growth)
        return out

    def windows(self, here: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """(left ends, right ends) of the windows around the projections `here`, by array and query."""
        left = np.stack([np.searchsorted(line, x) for line, x in zip(self.sorted, (here - radius).T)])
        right = np.stack([np.searchsorted(line, x, "right") for line, x in zip(self.sorted, (here + radius).T)])
        return left, right

    def collisions(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """In how many of the windows each vector lies."""
        low, size = left.astype(self.place.dtype)[:, None], (right - left).astype(self.place.dtype)[:, None]
        # places left of the window wrap around and are beyond its size too
        inside = (self.place - low < size).view(np.uint8)
        return np.add.reduce(inside, axis=0, dtype=np.uint8 if len(inside) < 256 else np.int32)

    def search(self, queries: np.ndarray, query_ids: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """(query id, id, cosine) of the nearest entries found, at most k a query."""
        n = len(self.vectors)
        unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        here, radii = unit @ self.lines, self.radii()
        bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # of all queries, for the radii that one of them came to
        step = 0  # where the query before was done: the next one is done near it
        for q, query_id in enumerate(query_ids.tolist()):
            cosines = np.full(n, -2.0)
            checked = np.zeros(n, bool)
            passed: dict[int, np.ndarray] = {}

            def done(i: int) -> bool:
                """Whether the query is done at the i-th radius; windows only grow, so it is then done at all later ones."""
                if i not in bounds:
                    bounds[i] = self.windows(here, radii[i])
                lefts, rights = bounds[i]
                passed[i] = near = self.collisions(lefts[:, q], rights[:, q]) >= self.threshold
                found = np.flatnonzero(near & ~checked)
                checked[found] = True
                cosines[found] = self.unit[found] @ unit[q]
                if near.sum() <= self.k:
                    return False
                # one entry may be the query's own, so the next one has to be near too
                seen = cosines[near]
                worst = np.partition(seen, len(seen) - self.k - 1)[len(seen) - self.k - 1]
                return 2 - 2 * worst <= radii[i] ** 2

            # the smallest radius at which it is done, or the last one
            if done(step):
                while step and done(step - 1):
                    step -= 1
            else:
                while step < len(radii) - 1:
                    step += 1
                    if done(step):
                        break
            cosines[~passed[step]] = -2.0  # what only a wider window has shown
            if passed[step].sum() <= self.k:  # fewer entries than asked for
                cosines = self.unit @ unit[q]
            yield from ((query_id, i, s) for i, s in self._best(cosines, queries[q], query_id))

    def _best(self, cosines: np.ndarray, query: np.ndarray, query_id: int) -> list[tuple[int, float]]:
        top = min(len(cosines), self.k + 1)
        edge = np.partition(cosines, len(cosines) - top)[len(cosines) - top]
        out = []
        for i in np.flatnonzero(cosines >= edge - 1e-12):
            score = cosine(query, self.vectors[i])
            out += [(int(x), score) for x in self.ids[i] if x != query_id]
        return sorted(out, key=lambda x: (-x[1], x[0]))[: self.k]


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.dot(a, b) / (np.sqrt(np.dot(a, a)) * np.sqrt(np.dot(b, b))))


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    rows = rows.filter("forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)")
    return rows


def nearest(
    df: DataFrame, queries: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = 5, functions: int = 160,
    shard: int = 16_384, block: int = 2_048, seed: int = 11,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows found for each row of `df` that `queries` selects."""
    rows = materialise(usable(df, vec_id, vector), "vectors")
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if lengths:
        rows = rows.filter(F.size("v") == lengths[0]["n"])
    n = rows.count()
    asked = rows.filter(queries).distinct()
    shards, blocks = max(1, -(-n // shard)), max(1, -(-asked.count() // block))
    place = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int")
    part = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int")
    # every shard meets every block of queries, and a task has one of each
    data = rows.select(place.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "v")
    ask = asked.select(part.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "vec_id", "v")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            index = Shard(left["vec_id"].to_numpy(), np.stack(left["v"].to_numpy()), k, functions, seed)
            out = list(index.search(np.stack(right["v"].to_numpy()), right["vec_id"].to_numpy()))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    found = data.groupBy("shard", "block").cogroup(ask.groupBy("shard", "block")).applyInPandas(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
