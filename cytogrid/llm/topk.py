"""Exact top-k inner-product search by pivot-table elimination.

Method: every vector's distances to a fixed set of pivots are computed once. For a query q and a candidate x the largest
|d(q, p) - d(x, p)| over the pivots p bounds their distance from below, and so their inner product (|q|^2 + |x|^2 - d^2) / 2 from
above. A vector's home is its nearest pivot. For each home and pivot the table keeps the interval of its vectors' distances, which bounds all of
them at once. A query is first answered within the block of its own home, which gives it a k-th score; it is then sent only to blocks of
homes whose bound reaches that score. There, rows stand in small tiles of like distances; tiles are taken in order of their bound,
then their rows by their own bounds, and only rows whose bound reaches the k-th score so far are evaluated, until none is left: exact.

Scale: a home with many rows is dealt into blocks of bounded size, by hash; each pair of a row block and a query block is one task with
bounded memory, whatever values the vectors have. A task returns k rows per query; the best of these are ranked per query. The
table of homes has PIVOTS x PIVOTS intervals however many vectors there are. How much is eliminated lies in the data: vectors in groups skip nearly
all of the rest, vectors spread evenly over many dimensions hardly any (``evaluated`` tells).

Defined cases: a vector that is null or holds null or non-finite components takes no part, nor does a row without an id; an
empty vector has score 0 with all; rows that repeat an id are vectors of their own, as queries and as candidates; ties go to the smaller id; a shorter
vector counts as padded with zeros; sums beyond 53 bits are added up exactly; fewer candidates than k give fewer rows; an empty
table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from cytogrid.llm.common import col, materialize

#: Pivots, and the rows they are chosen from (far apart from one another).
PIVOTS, PIVOT_SAMPLE = 48, 2_048
ROW_BLOCK, QUERY_BLOCK = 16_384, 2_048
#: Rows and queries that are bounded together inside a task.
ROW_TILE, QUERY_TILE = 256, 64
SEED = 5


def quantized(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component; null where the vector takes no part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(fine, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(column: pa.Array | pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Lists as rows of float64, padded with zeros to the longest, or to ``width``."""
    lists = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column
    if not len(lists):
        return np.zeros((0, width))
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(lists.offsets.to_numpy())
    width = max(int(sizes.max(initial=0)), width)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _pad(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, width - a.shape[1]))) if a.shape[1] < width else a


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    width = max(a.shape[1], b.shape[1])
    a, b = _pad(a, width), _pad(b, width)
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0))


def choose_pivots(sample: np.ndarray, many: int) -> np.ndarray:
    """``many`` rows of ``sample`` (all different), each in turn the one farthest from those before it."""
    if len(sample) <= many:
        return sample
    chosen = [int((sample * sample).sum(1).argmax())]
    near = _distances(sample, sample[chosen])[:, 0]
    while len(chosen) < many:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def with_pivots(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vectors`` (rid, id, v, asks) with ``d``, the distances to the pivots, ``home``, the nearest one, and ``norm``, the squared length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), pivots.shape[1])
            d = _distances(v, pivots)
            made = [pa.FixedSizeListArray.from_arrays(pa.array(d.ravel()), len(pivots)).cast(pa.list_(pa.float64())), pa.array(d.argmin(1).astype(np.int32)), pa.array((v * v).sum(1))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "d", "home", "norm"])

    return vectors.mapInArrow(run, StructType([*vectors.schema.fields, StructField("d", ArrayType(DoubleType())), StructField("home", IntegerType()), StructField("norm", DoubleType())]))


def home_table(made: DataFrame, pivots: int) -> tuple[list[dict[str, int]], np.ndarray, np.ndarray, np.ndarray]:
    """Per home that has vectors: its numbers of vectors and queries; the ends of its vectors' distances to each pivot; and their greatest squared length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full((pivots, pivots), np.inf), np.full((pivots, pivots), -np.inf)
        norm, n, asked = np.full(pivots, -np.inf), np.zeros(pivots, np.int64), np.zeros(pivots, np.int64)
        for batch in batches:
            home, d = batch.column("home").to_numpy(), _matrix(batch.column("d"))
            np.minimum.at(low, home, d)
            np.maximum.at(high, home, d)
            np.maximum.at(norm, home, batch.column("norm").to_numpy())
            n += np.bincount(home, minlength=pivots)
            asked += np.bincount(home[batch.column("asks").to_numpy(zero_copy_only=False)], minlength=pivots)
        h, p = np.nonzero(np.repeat(n[:, None] > 0, pivots, 1))
        yield pa.RecordBatch.from_arrays([pa.array(h.astype(np.int32)), pa.array(p.astype(np.int32)), *(pa.array(x[h]) for x in (n, asked, norm)), pa.array(low[h, p]), pa.array(high[h, p])], names=["home", "p", "n", "asked", "norm", "low", "high"])

    parts = made.select("home", "d", "norm", "asks").mapInArrow(run, "home int, p int, n long, asked long, norm double, low double, high double")
    got = parts.groupBy("home", "p").agg(*[f(c).alias(c) for f, c in ((F.sum, "n"), (F.sum, "asked"), (F.max, "norm"), (F.min, "low"), (F.max, "high"))]).collect()  # pivots x pivots rows at most
    got.sort(key=lambda r: (r["home"], r["p"]))
    grid = lambda c: np.array([r[c] for r in got], np.float64).reshape(-1, pivots)
    homes = [{"home": r["home"], "n": r["n"], "asked": r["asked"]} for r in got if not r["p"]]
    return homes, grid("low"), grid("high"), grid("norm")[:, 0]


def _gap(near: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least distance (queries x groups) between a query with distances ``near`` and any vector whose distances lie in [low, high]."""
    out = np.zeros((len(near), len(low)))
    for p in range(near.shape[1]):
        q = near[:, p, None]
        np.maximum(out, np.maximum(low[None, :, p] - q, q - high[None, :, p]), out=out)
    # what rounding may have added to a distance is given back before squaring
    return np.maximum(out - 1e-6 * (1 + out), 0)


def _bound(q2: np.ndarray, x2: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Greatest inner product at squared lengths ``q2`` and (at most) ``x2`` and that distance."""
    sums = q2[:, None] + x2[None, :]
    return (sums - gap * gap) / 2 + 1e-9 * sums + 1e-3


#: Stands for no score; below every other.
NONE = np.iinfo(np.int64).min


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products (int64) of whole numbers in float64; those beyond 64 bits stop at its ends."""
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1]) >= 1 << 53:
        wide = [[sum(int(a) * int(b) for a, b in zip(r, s, strict=True)) for s in x] for r in q]
        return np.array([[max(NONE + 1, min(-NONE - 1, w)) for w in r] for r in wide], np.int64).reshape(len(q), len(x))
    return (q @ x.T).astype(np.int64)


def best_of_block(qrid: np.ndarray, q: np.ndarray, dq: np.ndarray, least: np.ndarray, xrid: np.ndarray, xid: np.ndarray, x: np.ndarray, dx: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (query, row, score) of the k best candidates in this block of each query, and how many rows were evaluated for each.

    Places in the block are returned. ``least``: a score that a query's k best are known to reach.
    """
    q2, x2 = (q * q).sum(1), (x * x).sum(1)
    # rows of like distances side by side: by home, then by distance to it
    home = dx.argmin(1)
    order = np.lexsort((dx[np.arange(len(x)), home], home)) if dx.shape[1] else np.arange(len(x))
    tiles = [order[a : a + ROW_TILE] for a in range(0, len(order), ROW_TILE)]
    low, high = np.stack([dx[t].min(0) for t in tiles]), np.stack([dx[t].max(0) for t in tiles])
    longest = np.array([x2[t].max() for t in tiles])
    q_home = dq.argmin(1) if dq.shape[1] else np.zeros(len(q), np.int64)
    found: list[np.ndarray] = []
    evaluated = np.zeros(len(q), np.int64)
    asked = np.lexsort((dq[np.arange(len(q)), q_home], q_home)) if dq.shape[1] else np.arange(len(q))
    for at in range(0, len(q), QUERY_TILE):
        mine = asked[at : at + QUERY_TILE]
        bound = _bound(q2[mine], longest, _gap(dq[mine], low, high))
        kth = least[mine].copy()
        score = np.full((len(mine), k), NONE)
        place = np.full((len(mine), k), -1)
        for t in np.argsort(-bound.max(0), kind="stable"):
            open_q = np.nonzero(bound[:, t] >= kth)[0]
            if not len(open_q):
                continue
            rows = tiles[t]
            own = _bound(q2[mine[open_q]], x2[rows], _gap(dq[mine[open_q]], dx[rows], dx[rows]))
            open_ = (own >= kth[open_q][:, None]) & (qrid[mine[open_q]][:, None] != xrid[rows][None, :])
            some = np.nonzero(open_.any(0))[0]
            if not len(some):
                continue
            got = _exact(q[mine[open_q]], x[rows[some]])
            evaluated[mine[open_q]] += len(some)
            got[~open_[:, some]] = NONE
            # of equal scores the smaller id comes first
            all_s, all_p = np.concatenate((score[open_q], got), 1), np.concatenate((place[open_q], np.broadcast_to(rows[some], got.shape)), 1)
            ids = np.where(all_p >= 0, xid[np.maximum(all_p, 0)], np.iinfo(np.int64).max)
            by = np.lexsort((ids, ~all_s), axis=1)[:, :k]
            score[open_q], place[open_q] = np.take_along_axis(all_s, by, 1), np.take_along_axis(all_p, by, 1)
            last = score[open_q, -1]
            kth[open_q] = np.maximum(kth[open_q], np.where(last == NONE, -np.inf, last))
        r, c = np.nonzero(score != NONE)
        found.append(np.stack((mine[r], place[r, c], score[r, c]), 1))
    return (np.concatenate(found) if found else np.zeros((0, 3), np.int64)), evaluated


def _search(left: DataFrame, right: DataFrame, k: int) -> DataFrame:
    """Best rows (rid, xrid, id, score) per query of ``left`` (rid, v, d, least) among ``right`` (rid, id, v, d) of the same qb and xb, and its count of evaluated rows."""

    def run(ql: pa.Table, xr: pa.Table) -> pa.Table:
        if not ql.num_rows or not xr.num_rows:
            found, evaluated, qrid, xrid, xid = np.zeros((0, 3), np.int64), *(np.zeros(0, np.int64) for _ in range(4))
        else:
            q, x = _matrix(ql.column("v")), _matrix(xr.column("v"))
            width = max(q.shape[1], x.shape[1])
            qrid, xrid, xid = ql.column("rid").to_numpy(), xr.column("rid").to_numpy(), xr.column("id").to_numpy()
            found, evaluated = best_of_block(qrid, _pad(q, width), _matrix(ql.column("d")), ql.column("least").to_numpy(), xrid, xid, _pad(x, width), _matrix(xr.column("d")), k)
        # one more row per query, of no candidate, tells how many were evaluated
        none, n = np.zeros(len(qrid), np.int64), len(found)
        valid = np.concatenate((np.ones(n, bool), np.zeros(len(qrid), bool)))
        column = lambda a: pa.array(np.concatenate((a, none)), mask=~valid)
        return pa.table({"rid": np.concatenate((qrid[found[:, 0]], qrid)), "xrid": column(xrid[found[:, 1]]), "id": column(xid[found[:, 1]]), "score": column(found[:, 2]), "evaluated": np.concatenate((np.zeros(n, np.int64), evaluated))})

    return left.groupBy("qb", "xb").cogroup(right.groupBy("qb", "xb")).applyInArrow(run, "rid long, xrid long, id long, score long, evaluated long")


def top_k(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, pivots: int = PIVOTS, row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, id, score, evaluated) of the k best rows for each row for which ``queries`` (an expression over the id, named ``id``) holds.

    ``evaluated`` is the number of rows whose inner product with the query was computed.
    """
    v = vectors.select(col(id_col).cast("long").alias("id"), quantized(col(vector_col), scale).alias("v")).where("id is not null and v is not null")
    v = materialize(v.select(F.monotonically_increasing_id().alias("rid"), "id", "v", F.coalesce(queries, F.lit(False)).alias("asks")))
    # a fixed number of rows
    sample = [r["v"] for r in v.orderBy(F.xxhash64(F.lit("pivot"), "id"), "rid").limit(PIVOT_SAMPLE).select("v").collect()]
    width = max(map(len, sample), default=0)
    chosen = choose_pivots(np.unique(np.array([[*p, *[0] * (width - len(p))] for p in sample], np.float64).reshape(len(sample), width), axis=0), pivots)
    if not len(chosen):
        chosen = np.zeros((1, width))
    many = len(chosen)
    made = materialize(with_pivots(v, chosen))
    homes, low, high, norm = home_table(made, many)

    def dealt(count: str, most: int) -> tuple[Column, Column, dict[int, tuple[int, int]]]:
        """(first block, number of blocks) of a row's home: small homes share a block, large ones are cut up."""
        at, room, where = -1, 0, {}
        for h in homes:
            if h[count] > room:
                parts = max(1, -(-h[count] // most))
                where[h["home"]], room = (at + 1, parts), 0 if parts > 1 else most - h[count]
                at += parts
            else:
                where[h["home"]], room = (max(at, 0), 1), room - h[count]
        both = F.element_at(F.create_map(*[x for h, (a, b) in where.items() for x in (F.lit(h), F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")))]), F.col("home")) if where else F.struct(F.lit(0).alias("a"), F.lit(1).alias("b"))
        return both["a"], both["b"], where

    (xa, xn, where), (qa, qn, _) = dealt("n", row_block), dealt("asked", query_block)
    part = lambda key, n: F.pmod(F.xxhash64(F.lit(key), "rid"), n).cast("int")
    rows = made.select("rid", "id", "v", "d", (xa + part("x", xn)).alias("xb"))
    asking = materialize(made.where("asks").select("rid", "id", "v", "d", "norm", "home", (qa + part("q", qn)).alias("qb"), (xa + part("x", xn)).alias("xb")))

    def met(left: DataFrame) -> DataFrame:
        # named anew, since rows and queries come from the same columns
        anew = lambda *names: left.select(*[F.col(c).alias(c) for c in names])
        pairs, left = anew("qb", "xb").distinct(), anew(*left.columns)
        return _search(left, rows.join(pairs, "xb").select("rid", "id", "v", "d", "qb", "xb"), k)

    best = Window.partitionBy("rid").orderBy(F.desc("score"), "id", "xrid")
    top = lambda df: df.where("xrid is not null").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    near = materialize(met(asking.select("rid", "v", "d", F.lit(float("-inf")).alias("least"), "qb", "xb")))
    # the k-th score at home, if there are k
    kth = near.where("xrid is not null").groupBy("rid").agg(F.count("*").alias("n"), F.min("score").alias("s")).select("rid", F.when(F.col("n") >= k, F.col("s")).alias("s"))

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The blocks, beside its own, that a query has to see."""
        for batch in batches:
            d, least = _matrix(batch.column("d")), batch.column("least").to_numpy()
            open_ = _bound(batch.column("norm").to_numpy(), norm, _gap(d, low, high)) >= least[:, None]
            lists = []
            for i, own in enumerate(batch.column("xb").to_pylist()):
                spans = [where[homes[h]["home"]] for h in np.nonzero(open_[i])[0]]
                lists.append(sorted({b for a, n in spans for b in range(a, a + n)} - {own}))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("rid", "v", "d", "least", "qb")), pa.array(lists, pa.list_(pa.int32()))], names=["rid", "v", "d", "least", "qb", "xbs"])

    asked = asking.join(kth, "rid", "left").select("rid", "v", "d", F.coalesce(F.col("s").cast("double"), F.lit(float("-inf"))).alias("least"), "qb", "norm", "xb")
    sent = materialize(asked.mapInArrow(others, "rid long, v array<bigint>, d array<double>, least double, qb int, xbs array<int>"))
    far = met(sent.select("rid", "v", "d", "least", "qb", F.explode("xbs").alias("xb")))
    both = materialize(near.unionByName(far))
    evaluated = both.groupBy("rid").agg(F.sum("evaluated").alias("evaluated"))
    out = top(both.drop("evaluated")).join(evaluated, "rid").join(asking.select("rid", F.col("id").alias("query_id")), "rid")
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score", "evaluated")
