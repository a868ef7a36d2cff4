"""Results at borders, in empty and in crowded places, which small tables seldom meet."""

from __future__ import annotations

import math
import os
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cytogrid.operators import markers, normalize, spatial
from cytogrid.plans.registry import oracle_sql, queries

RINGS = "ord int, region string, ring array<struct<x:double,y:double>>"


def vectors(spark, folder, rows):
    """``rows`` (vec_id, first components, label) as the table of vectors in ``folder``, filled up to four components."""
    data = [(i, [float(x) for x in v] + [0.5] * (4 - len(v)), label) for i, v, label in rows]
    spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def by_sql(folder, name):
    c = duckdb.connect()
    for t in os.listdir(folder):
        c.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{t}/*.parquet'")
    cur = c.execute(oracle_sql()[name])
    order = sorted(range(len(cur.description)), key=lambda i: cur.description[i][0])
    return sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=repr)


def by_spark(spark, folder, name):
    df = queries()[name](spark, folder)
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_points_on_borders_are_in_one_polygon(spark, tmp_path):
    tiles = [(0, "left", [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]), (1, "right", [(10.0, 0.0), (20.0, 0.0), (20.0, 10.0), (10.0, 10.0)])]
    cells = spark.createDataFrame([("a", 0.0, 5.0), ("b", 10.0, 5.0), ("c", 20.0, 5.0), ("d", 5.0, 0.0), ("e", 5.0, 10.0), ("f", 5.0, 5.0)], "cell_id string, x double, y double")
    of = lambda **k: {r["cell_id"]: r["region"] for r in spatial.regions_of(cells, spark.createDataFrame(tiles, RINGS), **k).collect()}
    assert of(strict=False) == {"a": "left", "b": "right", "c": "Unlabeled", "d": "left", "e": "Unlabeled", "f": "left"}
    assert of() == {c: "left" if c == "f" else "Unlabeled" for c in "abcdef"}
    rows = [(i, (x, y), 0) for i, (x, y) in enumerate([(-0.15, 0.01), (0.05, 0.01), (0.01, -0.15), (0.01, 0.05), (0.15, 0.0), (0.3, 0.0), (0.2, 0.2), (-0.05, -0.05)])]
    folder = vectors(spark, tmp_path, rows)
    assert by_spark(spark, folder, "region_point_in_polygon") == by_sql(folder, "region_point_in_polygon")


def test_diamonds_by_their_distance(spark, tmp_path):
    # a difference whose parts add up to 11 but for the last bit of their sum: the first diamond does not hold the second point
    rows = [(1, (-0.03501017764210701, -0.020754314959049225), 3), (4, (-0.04084469750523567, -0.015589104034006596), 7), (7, (-0.0400, -0.0160), 8)]
    folder = vectors(spark, tmp_path, rows)
    assert by_spark(spark, folder, "region_by_many_polygons") == by_sql(folder, "region_by_many_polygons") == [("v1", "c3"), ("v4", "c7"), ("v7", "c3")]


def test_features_of_a_cell_far_from_all_others(spark, tmp_path):
    rows = [(3 * i, (0.01 * (i % 4), 0.013 * (i // 4), 0.2 + 0.01 * i), i % 2) for i in range(12)] + [(36, (90.0, 90.0, 0.3), 1)]
    folder = vectors(spark, tmp_path, rows)
    by_name = lambda rows: [tuple(None if x != x else x for x in r) for r in rows]
    got, want = by_name(by_spark(spark, folder, "neighbour_mean_expr")), by_name(by_sql(folder, "neighbour_mean_expr"))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any(r[3] is None for r in got)


def test_queries_travel_once_for_each_bin(spark):
    import numpy as np

    from cytogrid.operators import embed

    x = np.random.default_rng(3).normal(size=(400, 16))
    rows = spark.createDataFrame([(f"r{i}", v.tolist()) for i, v in enumerate(x)], "id string, v array<double>")
    _, visits, _ = embed.indexed(rows, rows, 5, 64, binned=True)
    assert visits.count() <= len(x)


def brute(points, step, bins):
    """Ordered pairs of (sample, cell_id, x, y, label) by (sample, bin, label, label)."""
    n = {}
    for s, c, x, y, i in points:
        for t, o, u, v, j in points:
            d = ((u - x) * (u - x) + (v - y) * (v - y)) ** 0.5
            if s == t and c != o and d <= step * bins and d // step < bins:
                n[s, int(d // step), i, j] = n.get((s, int(d // step), i, j), 0) + 1
    return n


def test_label_pairs_of_blocks_equal_all_pairs(spark, monkeypatch):
    rng = random.Random(5)
    # steps of 4, so that many distances lie on a bin's border; crowded on the left, one cell far off and one without coordinates
    points = [("s", f"c{i}", 4.0 * int(rng.gauss(0, 9) if i % 3 else rng.gauss(60, 30)), 4.0 * int(rng.gauss(0, 9)), rng.choice(["a", "b", "c", None])) for i in range(420)]
    points += [("s", "far", 1e6, -1e6, "a"), ("t", "u1", 0.0, 0.0, "b"), ("t", "u2", 12.0, 16.0, "a"), ("t", "alone", 1e3, 0.0, "a")]
    odd = [("s", "none", None, 1.0, "a"), ("s", "nan", float("nan"), 1.0, "a"), ("s", "endless", float("inf"), 1.0, "a")]
    df = spark.createDataFrame(points + odd, "sample string, cell_id string, x double, y double, label string")
    want = brute(points, 20.0, 5)
    for block in (16384, 40):
        monkeypatch.setattr(spatial, "BLOCK", block)
        got = {(r["sample"], r["bin"], r["i"], r["j"]): r["n"] for r in spatial.label_pairs(df, "label", 20.0, 5).collect()}
        assert got == want
    assert want["t", 1, "a", "b"] == 1  # 20 apart belongs to the second bin


def test_pairs_of_as_many_labels_as_points():
    rng = random.Random(6)
    kind = pa.list_(pa.struct([("l", pa.string()), ("x", pa.list_(pa.float64())), ("y", pa.list_(pa.float64())), ("w", pa.list_(pa.int64()))]))
    at = [(f"l{i}", rng.uniform(0, 90), rng.uniform(0, 90), 1 + i % 3) for i in range(1000)]
    block = lambda rows: spatial._tiles(pa.array([[{"l": n, "x": [x], "y": [y], "w": [w]} for n, x, y, w in rows]], kind)[0])
    x, y, w = (np.array([p[c] for p in at]) for c in (1, 2, 3))
    bins = np.floor(np.sqrt((x[:, None] - x) ** 2 + (y[:, None] - y) ** 2) / 20).astype(int)
    for b in (None, at[:900]):
        assert 5 * 1000 * (900 if b else 1000) > spatial.DENSE
        names, n = spatial._pairs_by_bin(block(at), block(b) if b else None, 20.0, 5)
        m = len(b or at)
        got = np.bincount(names, n, 5 * 1000 * m).reshape(5, 1000, m)
        want = [(w[:, None] * w[:m]) * (bins[:, :m] == k) for k in range(5)]
        assert (got == np.array(want)).all()


def test_co_occurrence_of_crowded_places_makes_no_pairs(spark):
    # 4 * 10^10 pairs as rows would not end
    n = 100_000
    i = spark.range(2 * n)
    x, label = F.when(F.col("id") < n, 0.0).otherwise(30.0), F.when(F.col("id") < n, "a").otherwise("b")
    points = i.select(F.lit("s").alias("sample"), F.col("id").cast("string").alias("cell_id"), x.alias("x"), F.lit(0.0).alias("y"), label.alias("label"))
    got = {(r["bin"], r["i"], r["j"]): r["n"] for r in spatial.label_pairs(points, "label", 20.0, 5).collect()}
    assert got == {(0, "a", "a"): n * (n - 1), (0, "b", "b"): n * (n - 1), (1, "a", "b"): n * n, (1, "b", "a"): n * n}
    assert {(r["bin"], r["i"], r["j"]): r["ratio"] for r in spatial.co_occurrence(points, "label", 20.0, 5).collect()} == {(0, "a", "a"): 2.0, (0, "b", "b"): 2.0, (1, "a", "b"): 2.0, (1, "b", "a"): 2.0}


def test_co_occurrence_equals_its_sql_where_places_repeat(spark, tmp_path):
    rows = [(i, (0.004 * (i * 7 % 23), 0.003 * (i * 5 % 31), 0.1), i % 4) for i in range(400)]
    folder = vectors(spark, tmp_path, rows)
    for name in ("cooccurrence_ratio", "region_cooccurrence"):
        got = by_spark(spark, folder, name)
        assert got == by_sql(folder, name) and len(got) > 50


def test_values_are_computed_once_for_dots(spark):
    seen = spark.sparkContext.accumulator(0)

    def told(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = [("s", f"c{i % 7}", f"g{i % 3}", i) for i in range(42) if i % 7 != 2] + [("s", "unlabelled", "lone", 5), ("s", "empty", "g0", 0), ("s", None, "g0", 3)]
    counts = spark.createDataFrame(rows, "sample string, cell_id string, gene string, count long")
    cells = spark.createDataFrame([("s", f"c{i}", r, f"k{i % (r + 2)}") for i in range(7) for r in (0, 1)], "sample string, cell_id string, res int, cluster string")
    per_million = normalize.log_normalise(counts.mapInPandas(told, counts.schema), 1e6)
    got = sorted((r["cell_id"], r["gene"], r["count"], r["value"]) for r in per_million.collect())
    assert seen.value == len(rows)
    totals = {c: sum(r[3] for r in rows if r[1] == c) for c in {r[1] for r in rows}}
    want = sorted((c, g, n, math.log1p(n * 1e6 / totals[c])) for _, c, g, n in rows if c and totals[c])
    assert [r[:3] for r in got] == [r[:3] for r in want] and [r[3] for r in got] == pytest.approx([r[3] for r in want], rel=1e-12)

    values = [("s", c, g, v) for c, g, _, v in want]
    df = spark.createDataFrame(values, "sample string, cell_id string, gene string, value double")
    seen.value = 0
    dots = {(r["res"], r["gene"], r["cluster"]): (r["mean"], r["fraction"]) for r in markers.dot_stats(df.mapInPandas(told, df.schema), cells, F.col("cluster"), "cluster", ["res"]).collect()}
    assert seen.value == len(values)
    of = {(res, k): [f"c{i}" for i in range(7) if f"k{i % (res + 2)}" == k] for res in (0, 1) for k in [f"k{j}" for j in range(res + 2)]}
    assert set(dots) == {(res, g, k) for res, k in of for g in ("g0", "g1", "g2", "lone")}
    for (res, g, k), (mean, fraction) in dots.items():
        met = [v for _, c, h, v in values if h == g and c in of[res, k]]
        assert mean == pytest.approx(sum(met) / len(of[res, k])) and fraction == pytest.approx(sum(v > 0 for v in met) / len(of[res, k]))


def test_layout_reads_neighbours_once(spark):
    """What finds the neighbours runs once for all rounds, not once for each end of an edge and each use of a distance."""
    from cytogrid.operators import graph

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    near = [(f"n{i:02d}", f"n{(i + j) % 40:02d}", float(j)) for i in range(40) for j in (1, 2, 3)]
    knn = spark.createDataFrame(near, "src string, dst string, d double").mapInArrow(counted, "src string, dst string, d double")
    assert graph.layout(graph.fuzzy_union(knn), rounds=2).count() == 40
    assert seen.value == len(near)


@pytest.mark.parametrize("far", [0.0, 1e6])
def test_nearest_by_single_precision_candidates(far):
    """Distances, ties and copies as by brute force, whatever the tiles, a bound, an offset of all vectors, and rows that are not finite."""
    from cytogrid.operators import embed

    rng = np.random.default_rng(9)
    x = np.concatenate([rng.integers(0, 3, (300, 3)).astype(float), rng.normal(size=(300, 3)), np.zeros((80, 3)), [[np.nan, 0, 0], [np.inf, 0, 0]]]) + far
    ids = np.array([f"r{i:03d}" for i in rng.permutation(len(x))])
    table = pa.table({"id": pa.array(ids), "v": pa.array(x.tolist())})
    want, kth = [], {}
    for i in range(len(x)):
        with np.errstate(invalid="ignore"):
            d = np.round(np.sqrt(((x[i] - x) ** 2).sum(1)), 9)
        best = sorted((d[j], ids[j]) for j in range(len(x)) if j != i and np.isfinite(d[j]))[:7]
        want += [(ids[i], n, dist) for dist, n in best]
        kth[ids[i]] = best[-1][0] if best else 1.0
    for rows, columns, pairs in ((256, 2048, 1 << 16), (7, 50, 11)):
        embed.ROWS, embed.COLUMNS, embed.PAIRS, kept = rows, columns, pairs, (embed.ROWS, embed.COLUMNS, embed.PAIRS)
        try:
            for q in (table, table.append_column("kth", pa.array([kth[i] for i in ids]))):
                got = embed._near(7)(q, table)
                assert sorted(zip(*(got.column(c).to_pylist() for c in ("src", "d", "dst")), strict=True)) == sorted((s, d, t) for s, t, d in want)
        finally:
            embed.ROWS, embed.COLUMNS, embed.PAIRS = kept
