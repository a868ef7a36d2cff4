"""Centroid clustering of integer vectors by plain Lloyd rounds.

Vectors are scaled and floored to whole numbers, so every sum, distance and centroid is exact and no order of adding can change a
result. A round broadcasts the centroids; ``mapInPandas`` takes whole-number squared differences to one centroid after another in NumPy,
the first least one wins (ties: lowest number), and each partition sends one row of counts and sums per centroid to a ``groupBy``. A
centroid becomes the floor of sum / count; one without vectors stays. What reaches the driver is ``k`` rows a round, whatever the table's
size, and vectors are never shuffled.

The first centroids are the ``k`` vectors whose seeded digest of the id is least, in order of digest, then of the vector.

Defined cases: a vector that is null, has another length than ``dim``, or holds a null, NaN or infinite component takes no part and has no
row; repeated rows and ids are vectors of their own; a null id has no digest, so its vector is clustered but starts no centroid; with fewer
than ``k`` vectors to start from there are fewer centroids, without any the result is empty. A component beyond +-2^27 after scaling is an
error, since its distances would not fit a long. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytogrid.llm.common import col, materialize

CLUSTERS, ROUNDS, SCALE, SEED = 8, 10, 1024, 3
#: Components as whole numbers are at most this large: (2^28)^2 in 64 dimensions is 2^62.
LARGEST = 1 << 27


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """(id, v): the vectors that take part, as whole numbers floor(scale * x). The id is text, since pandas has no null among whole numbers."""
    x = df.select(col(id_col).cast("string").alias("id"), F.transform(col(vector_col), lambda c: c.cast("double")).alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    fits = F.forall("x", lambda c: F.abs(c * scale) <= LARGEST)
    v = F.when(fits, F.transform("x", lambda c: F.floor(c * scale).cast("int"))).otherwise(F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling")))
    return x.where((F.size("x") == dim) & finite).select("id", v.alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), "id"), 256)
    rows = vectors.where("id is not null").orderBy(digest, "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row of whole numbers: the first of the nearest centroids, and the squared distance to it."""
    distance = np.stack([np.square(x - c).sum(1) for c in centroids])
    label = distance.argmin(0)
    return label, distance[label, np.arange(len(x))]


def _rows(frame: pd.DataFrame) -> np.ndarray:
    return np.stack(frame["v"].to_numpy()).astype(np.int64)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    k, dim = centroids.shape
    sent = vectors.sparkSession.sparkContext.broadcast(centroids)

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for frame in frames:
            if len(frame):
                x = _rows(frame)
                label, _ = nearest(x, sent.value)
                n += np.bincount(label, minlength=k)
                for i in np.unique(label):
                    total[i] += x[label == i].sum(0)
        met = np.flatnonzero(n)
        if len(met):
            yield pd.DataFrame({"cluster": met.astype(np.int32), "n": n[met], "total": list(total[met])})

    parts = vectors.select("v").mapInPandas(gather, "cluster int, n long, total array<long>")
    sums = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("total", F.lit(i))) for i in range(dim)]).alias("total"))
    out = centroids.copy()
    for r in sums.collect():
        out[r["cluster"]] = [t // r["n"] for t in r["total"]]
    sent.unpersist()
    return out


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = 64, k: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """Per vector: id, cluster, distance (squared), cluster_inertia, inertia, centroid (the final one, whole numbers)."""
    vectors = materialize(whole_vectors(df, id_col, vector_col, dim, scale))
    centroids = first_centroids(vectors, k, seed)
    kind = df.select(col(id_col)).schema[0].dataType
    if not len(centroids):
        return vectors.where("false").select(F.col("id").cast(kind).alias(id_col), F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.col("v").cast("array<long>").alias("centroid"))
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    sent = df.sparkSession.sparkContext.broadcast(centroids)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                label, distance = nearest(_rows(frame), sent.value)
                yield pd.DataFrame({"id": frame["id"], "cluster": label.astype(np.int32), "distance": distance})

    placed = materialize(vectors.mapInPandas(assign, "id string, cluster int, distance long"))
    inertia = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    of = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("cluster"))
    return placed.select(
        F.col("id").cast(kind).alias(id_col),
        "cluster",
        "distance",
        of([int(inertia.get(i, 0)) for i in range(len(centroids))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        of([[int(x) for x in c] for c in centroids]).cast("array<long>").alias("centroid"),
    )
