"""Clustering round centroids in whole numbers, each nearest centroid found by equal-average equal-variance search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestry.session import stage

DIMENSIONS = 64
SCALE = 1024
# Components up to this size keep squared distances of 64 of them within 64 bits.
LARGEST = 1 << 27
# Vectors that a task compares at once.
ROWS = 8192


@dataclass(frozen=True)
class Search:
    """Centroids in the order of their component sums, ready to be scanned from any vector's own sum outward."""

    centroids: np.ndarray  # whole numbers, one row each, in order of their numbers
    order: np.ndarray  # numbers in ascending order of sums
    sums: np.ndarray  # ascending
    spreads: np.ndarray  # sqrt(sum of squared deviations from the mean), in that order

    @classmethod
    def of(cls, centroids: np.ndarray) -> Search:
        sums = centroids.sum(1)
        order = np.argsort(sums, kind="stable")
        return cls(centroids, order, sums[order], spread(centroids)[order])

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number, squared distance) of the nearest centroid of every vector, and how many distances were computed in full.

        Ties go to the smaller number. Squared distance is at least
        (difference of sums)^2 / k plus (difference of spreads)^2 for k components.
        Centroids come in order of the first term, taken from either side of the
        vector's place, so the first one whose own first term exceeds the best
        distance ends the scan of that vector; the second term drops single ones.
        What is left is compared in whole numbers. Bounds are rounded down far
        enough that rounding never drops the nearest.
        """
        n, k = vectors.shape
        sums, spreads = vectors.sum(1), spread(vectors)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, -1)
        computed = 0
        live = np.arange(n)
        while len(live):
            far = np.inf
            below = np.where(left[live] >= 0, sums[live] - self.sums[left[live]], far)
            above = np.where(right[live] < len(self.sums), self.sums[np.minimum(right[live], len(self.sums) - 1)] - sums[live], far)
            go_left = below <= above
            gap = np.where(go_left, below, above)
            mean_bound = gap * gap / k
            open_ones = mean_bound * (1 - 1e-9) <= best[live]
            open_ones &= gap < far
            live, go_left, mean_bound = live[open_ones], go_left[open_ones], mean_bound[open_ones]
            at = np.where(go_left, left[live], right[live])
            left[live] -= go_left
            right[live] += ~go_left
            bound = mean_bound + (spreads[live] - self.spreads[at]) ** 2
            full = bound * (1 - 1e-9) - 1 <= best[live]
            rows, chosen = live[full], self.order[at[full]]
            computed += len(rows)
            differences = vectors[rows] - self.centroids[chosen]
            distances = np.einsum("ij,ij->i", differences, differences)
            better = (distances < best[rows]) | ((distances == best[rows]) & (chosen < number[rows]))
            best[rows[better]], number[rows[better]] = distances[better], chosen[better]
        return number, best, computed


def spread(vectors: np.ndarray) -> np.ndarray:
    values = vectors.astype(np.float64)
    return np.sqrt(((values - values.mean(1, keepdims=True)) ** 2).sum(1))


def whole_components(column: Column, scale: int = SCALE) -> Column:
    return F.transform(column, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(column: Column, dimensions: int) -> Column:
    finite = F.forall(column, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce((F.size(column) == dimensions) & finite, F.lit(False))


def kept_vectors(embeddings: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and whole-number components `x` of the vectors that take part."""
    return embeddings.where(usable(F.col("embedding"), dimensions)).select("vec_id", whole_components(F.col("embedding"), scale).alias("x"))


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors of the smallest salted hash of their ids; rows of one id come in the order of their components."""
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "x").orderBy("key", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64)


def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            rows = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            if np.abs(rows).max(initial=0) > LARGEST:
                raise ValueError(f"a scaled component is beyond {LARGEST}: squared distances would not fit in 64 bits")
            yield part, rows


def summer(search: Search):
    """Batches of vectors to one row for each centroid that a task meets: its number, vectors and component sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dimensions = search.centroids.shape
        sums, counts = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for _, rows in matrices(batches):
            number, _, _ = search.nearest(rows)
            order = np.argsort(number, kind="stable")
            met, starts = np.unique(number[order], return_index=True)
            sums[met] += np.add.reduceat(rows[order], starts, axis=0)
            counts += np.bincount(number, minlength=k)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(counts[met]), pa.array(list(sums[met]), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    return run


def assigner(search: Search):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in matrices(batches):
            number, distance, _ = search.nearest(rows)
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return run


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid that has vectors at the floor of their mean, the others where they were.

    Tasks add up before the shuffle; what comes to the driver is one number for
    each centroid and component.
    """
    sums = vectors.select("x").mapInArrow(summer(Search.of(centroids)), "cluster int, n long, sums array<long>")
    per = sums.select("cluster", "n", F.posexplode("sums").alias("at", "part")).groupBy("cluster", "at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    out = centroids.copy()
    for row in per.collect():
        out[row["cluster"], row["at"]] = int(row["total"]) // row["n"]
    return out


def cluster(embeddings: DataFrame, k: int = 8, rounds: int = 10, salt: str = "3:", dimensions: int = DIMENSIONS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every usable vector after the given rounds, and the centroids.

    Vectors of another length, or with a null or non-finite component, and null
    vectors take no part. A null vec_id hashes as the empty text and is kept;
    repeated rows are vectors each. With fewer than k vectors there are fewer
    centroids, with none the result is empty. A component that is too large for
    exact 64-bit distances (2^27 after scaling) is an error, not a wrong number.
    The driver and the tasks hold k centroids; vectors are written once and read
    in each round.
    """
    vectors = stage(kept_vectors(embeddings, dimensions, scale), "vectors")
    centroids = first_centroids(vectors, k, salt)
    if not len(centroids):
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), np.zeros((0, dimensions), np.int64)
    for _ in range(rounds):
        after = moved(vectors, centroids)
        if np.array_equal(after, centroids):
            break  # every further round gives the same
        centroids = after
    kind = dict(vectors.dtypes)["vec_id"]
    return vectors.mapInArrow(assigner(Search.of(centroids)), f"vec_id {kind}, cluster int, distance long"), centroids


def cluster_digest(embeddings: DataFrame) -> DataFrame:
    """Cluster and distance of every vector, the inertia of its cluster and of all, and its centroid's digest."""
    assigned, centroids = cluster(embeddings)
    assigned = stage(assigned, "assigned")
    inertia = {r["cluster"]: r["inertia"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}  # one row for each centroid
    total = sum(inertia.values())
    digests = [hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest() for row in centroids]
    of = assigned.sparkSession.createDataFrame([(c, n, total, digests[c]) for c, n in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
