"""Operators on literal tables with answers worked out by hand or by numpy."""

from __future__ import annotations

import json
import math
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cytogrid.functions import text
from cytogrid.operators import annotate, branches, contract, de, embed, graph, markers, nbinom, normalize, pseudobulk, qc, signatures, spatial, subset
from cytogrid.plans import schema, workflow
from cytogrid.sources import images, readers

COUNTS = [("s", "a", "g1", 4), ("s", "a", "MT-1", 1), ("s", "b", "g1", 2), ("s", "b", "g2", 2), ("s", "c", "MT-1", 5), ("s", "c", "MT-2", 5), ("s", "d", "g2", 9), ("s", "e", "g1", 1), ("s", "f", "g3", 3), ("s", "f", "g1", 3)]


@pytest.fixture(scope="module")
def counts(spark):
    return spark.createDataFrame(COUNTS, "sample string, cell_id string, gene string, count long").cache()


def test_contract_gate(spark, counts):
    cells = spark.createDataFrame([("s", c, 1.0, 2.0, "r") for c in "abcdef"], "sample string, cell_id string, x double, y double, region_annotation string")
    assert contract.hard_checks(counts, cells).select(contract.passed()).first()[0]
    bad = cells.unionByName(cells.limit(1)).unionByName(spark.createDataFrame([("s", "z", float("nan"), 1.0, None)], cells.schema))
    row = contract.hard_checks(counts, bad).first()
    assert row["n_duplicate_ids"] == 1 and row["n_bad_coordinates"] == 1
    with pytest.raises(ValueError, match="checks"):
        contract.require(contract.hard_checks(counts, bad), contract.passed(), "the checks failed")
    labels = spark.createDataFrame([(x,) for x in ("T", " ", "NaN", "Unannotated", None)], "l string")
    assert labels.where(contract.is_label(F.col("l"))).count() == 1


def test_filter_chain_order(spark, counts):
    t = spark.createDataFrame([("s", 2.0, None, 2.0, 1.0, 60.0)], "sample string, min_counts double, max_counts double, min_cells double, min_genes double, max_pct_mt double")
    out = {(r["cell_id"], r["gene"]) for r in qc.filter_chain(counts, t, ("MT-",)).collect()}
    # e goes by its total, then MT-2 and g3 by their cells, then c by its percent mito
    assert out == {("a", "g1"), ("a", "MT-1"), ("b", "g1"), ("b", "g2"), ("d", "g2"), ("f", "g1")}


def test_normalise(counts):
    got = {(r["cell_id"], r["gene"]): r["value"] for r in normalize.log_normalise(counts).collect()}
    totals = {"a": 5, "b": 4, "c": 10, "d": 9, "e": 1, "f": 6}
    target = float(np.median(list(totals.values())))
    for _, c, g, n in COUNTS:
        assert got[c, g] == pytest.approx(np.log1p(n * target / totals[c]))


def test_total_join(spark):
    cells, lab = spark.createDataFrame([("1",), ("2",)], "id string"), spark.createDataFrame([("1", "x")], "id string, l string")
    with pytest.raises(ValueError, match="1 of 2"):
        annotate.total_join(cells, lab, ["id"], "l")
    assert annotate.with_default(cells, lab, ["id"], "l", "none").where("l = 'none'").count() == 1


def test_rank_sum_against_full_ranks(spark):
    rng = np.random.default_rng(0)
    x = rng.poisson(0.7, (40, 5)).astype(float)
    group = rng.integers(0, 3, 40)
    vals = spark.createDataFrame([("s", f"c{i}", f"g{j}", float(x[i, j])) for i in range(40) for j in range(5) if x[i, j]], "sample string, cell_id string, gene string, value double")
    cells = spark.createDataFrame([("s", f"c{i}", f"t{group[i]}") for i in range(40)], "sample string, cell_id string, t string")
    got = {(r["t"], r["gene"]): r["rank_sum"] for r in markers.rank_sum(vals, cells, "t").collect()}
    for j in range(5):
        order = np.argsort(x[:, j], kind="stable")
        rank = np.empty(40)
        rank[order] = np.arange(1, 41)
        for v in np.unique(x[:, j]):
            rank[x[:, j] == v] = rank[x[:, j] == v].mean()
        for t in range(3):
            assert got[f"t{t}", f"g{j}"] == pytest.approx(rank[group == t].sum())


def test_adjust(spark):
    p = [0.01, 0.02, 0.03, 0.5, None]
    got = [r["padj"] for r in markers.adjust(spark.createDataFrame([("a", i, v) for i, v in enumerate(p)], "b string, i int, p double"), "p", ["b"]).orderBy("i").collect()]
    assert got[:4] == pytest.approx([0.04, 0.04, 0.04, 0.5]) and got[4] is None


def test_pseudobulk_keeps_counts(spark, counts):
    cells = spark.createDataFrame([("s", c, "r1" if c < "d" else "r2") for c in "abcdef"], "sample string, cell_id string, region_annotation string")
    out = pseudobulk.aggregate(counts, cells, ["sample", "region_annotation"], 1, 1)
    assert out.agg(F.sum("count")).first()[0] == sum(r[3] for r in COUNTS)
    assert pseudobulk.aggregate(counts, cells, ["sample", "region_annotation"], 4, 1).count() == 0


def test_nb_finds_the_shift(spark):
    rng = np.random.default_rng(1)
    rows = [(f"b{k}", "A" if k < 4 else "B", f"g{j}", int(rng.poisson(200 * (4 if j == 0 and k < 4 else 1)))) for k in range(8) for j in range(12)]
    b = spark.createDataFrame(rows, "bulk string, lv string, gene string, count long")
    got = {r["gene"]: r for r in nbinom.nb_tests(b, pseudobulk.size_factors(b, "bulk"), "bulk", "lv", ["A", "B"]).collect()}
    assert got["g0"]["log2fc"] == pytest.approx(2, abs=0.3) and got["g0"]["stat"] > 5 and got["g0"]["lr"] > 20
    assert all(abs(got[f"g{j}"]["log2fc"]) < 0.4 for j in range(1, 12))


def test_signatures(spark):
    v = spark.createDataFrame([("s", "c", f"g{i:02d}", float(30 - i)) for i in range(20)], "sample string, cell_id string, gene string, value double")
    net = spark.createDataFrame([("top", "g00"), ("top", "g01"), ("low", "g19")], "source string, target string")
    got = {r["source"]: r["score"] for r in signatures.aucell(v, net, 100).collect()}
    assert got == {"top": pytest.approx(1.0)}
    assert signatures.entries(spark.createDataFrame([("a", None), (" ", "b ")], "x string, y string")).orderBy("gene").collect() == [("x", "a"), ("y", "b")]


def test_spatial_knn_brute_force(spark):
    rng = np.random.default_rng(2)
    p = np.concatenate([rng.normal(0, 1, (60, 2)), rng.normal(50, 5, (6, 2))])
    d = spark.createDataFrame([("s", f"p{i:02d}", float(a), float(b)) for i, (a, b) in enumerate(p)], "sample string, cell_id string, x double, y double")
    got = {(r["src"], r["dst"]) for r in spatial.knn(d, 4).collect()}
    dist = np.linalg.norm(p[:, None] - p[None], axis=2)
    np.fill_diagonal(dist, np.inf)
    assert got == {(f"p{i:02d}", f"p{j:02d}") for i in range(len(p)) for j in np.argsort(dist[i])[:4]}


def test_points_on_edges_are_outside(spark):
    ring = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    polys = spark.createDataFrame([(0, "one", ring), (1, "two", [(x + 1, y + 1) for x, y in ring])], "ord int, region string, ring array<struct<x:double,y:double>>")
    pts = spark.createDataFrame([("in", 0.5, 0.5), ("both", 1.5, 1.5), ("edge", 2.0, 0.5), ("out", 9.0, 9.0)], "cell_id string, x double, y double")
    first = {r["cell_id"]: r["region"] for r in spatial.regions_of(pts, polys).collect()}
    assert first == {"in": "one", "both": "one", "edge": "Unlabeled", "out": "Unlabeled"}
    assert {r["cell_id"]: r["region"] for r in spatial.regions_of(pts, polys, last=True).collect()}["both"] == "two"


def test_enrichment_moments(spark):
    rng = np.random.default_rng(3)
    edges = sorted({tuple(sorted(rng.choice(20, 2, replace=False).tolist())) for _ in range(40)})
    lab = rng.integers(0, 2, 20)
    e = spark.createDataFrame([("s", f"n{a}", f"n{b}") for a, b in edges], "sample string, u string, v string")
    cells = spark.createDataFrame([("s", f"n{i}", f"L{x}") for i, x in enumerate(lab)], "sample string, cell_id string, l string")
    got = {(r["i"], r["j"]): r for r in spatial.enrichment(e, cells, "l").collect()}
    a, b = np.array(edges).T
    draws = np.array([(lambda x: [((x[a] == 0) & (x[b] == 0)).sum(), (x[a] != x[b]).sum()])(rng.permutation(lab)) for _ in range(20000)])
    for k, pair in enumerate([("L0", "L0"), ("L0", "L1")]):
        assert got[pair]["expected"] == pytest.approx(draws[:, k].mean(), rel=0.03) and got[pair]["sd"] == pytest.approx(draws[:, k].std(), rel=0.05)


def vectors(spark, x, labels=None):
    return spark.createDataFrame([(f"v{i:03d}", [float(a) for a in r], f"L{0 if labels is None else labels[i]}") for i, r in enumerate(x)], "id string, v array<double>, label string")


def test_pca_against_numpy(spark):
    x = np.random.default_rng(4).normal(0, [5, 3, 1, 0.5], (80, 4))
    mean, comp, ratio = embed.pca(vectors(spark, x), 3)
    u, s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    assert mean == pytest.approx(x.mean(0)) and ratio == pytest.approx((s**2 / (s**2).sum())[:3])
    assert np.abs((comp * vt[:3]).sum(1)) == pytest.approx(np.ones(3))
    p = embed.project(vectors(spark, x), mean, comp, "id").count()
    assert p == 80


@pytest.mark.parametrize(("cells", "genes", "k"), [(60, 7, 3), (40, 5000, 4), (6, 30, 10)])
def test_sparse_pca_against_numpy(spark, cells, genes, k):
    """More columns than any matrix of column products should have, and fewer rows than components."""
    rng = np.random.default_rng(10)
    x = rng.poisson(2, (cells, genes)) * (rng.uniform(size=(cells, genes)) < 0.1) * (1.0 + 4 * (np.arange(genes) < 5))
    x[:, 0] = rng.poisson(30, cells) + 1  # no cell without a value
    values = spark.createDataFrame([("s", f"c{i:02d}", f"g{j:05d}", float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)], "sample string, cell_id string, gene string, value double")
    panel = spark.createDataFrame([(f"g{j:05d}",) for j in range(genes)], "gene string")
    rows = embed.panel_rows(values, panel)
    mean, comp, ratio = embed.pca(rows, k, genes)
    u, s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    most = min(k, len(s) - (cells <= genes), genes)
    assert mean == pytest.approx(x.mean(0)) and ratio[:most] == pytest.approx((s**2 / (s**2).sum())[:most], rel=1e-6)
    assert np.abs((comp[:most] * vt[:most]).sum(1)) == pytest.approx(np.ones(most), abs=1e-5)
    got = np.array([r["pcs"] for r in embed.project(rows, mean, comp, "cell_id").orderBy("cell_id").collect()])
    assert got == pytest.approx((x - x.mean(0)) @ comp.T, abs=1e-8)


@pytest.mark.parametrize("entries", [1, 3, 7, 1000])
def test_slices_of_sparse_rows(entries, monkeypatch):
    monkeypatch.setattr(embed, "ENTRIES", entries)
    at = [[0, 2], [], [1], [0, 1, 2, 3], [], [3]]
    b = pa.RecordBatch.from_arrays([pa.array(at, pa.list_(pa.int32())), pa.array([[float(10 * i + c) for c in r] for i, r in enumerate(at)], pa.list_(pa.float64()))], names=["at", "v"])
    got, first = [], 0
    for row, col, v, many in embed._slices(b):
        got += list(zip((row + first).tolist(), col.tolist(), v.tolist(), strict=True))
        first += many
    assert first == len(at) and got == [(i, c, 10.0 * i + c) for i, r in enumerate(at) for c in r]


def test_transfer_by_genes(spark):
    rng = np.random.default_rng(11)
    kind = np.arange(60) % 3
    x = rng.poisson(1 + 8 * (np.arange(120)[None, :] % 3 == kind[:, None]))
    long = [(("q" if i < 20 else "r"), f"c{i}", f"g{j}", float(x[i, j])) for i in range(60) for j in range(120) if x[i, j]]
    v = spark.createDataFrame(long, "sample string, cell_id string, gene string, value double")
    labels = spark.createDataFrame([("r", f"c{i}", f"t{kind[i]}") for i in range(20, 60)], "sample string, cell_id string, label string")
    got = {r["id"]: r["label"] for r in embed.transfer_by_genes(v.where("sample = 'q'"), v.where("sample = 'r'"), labels, 5, 5).collect()}
    assert got == {f"q|c{i}": f"t{kind[i]}" for i in range(20)}
    with pytest.raises(ValueError, match="shared genes"):
        embed.transfer_by_genes(v.where("sample = 'q'"), v.where("sample = 'r' AND gene < 'g2'"), labels)


def test_silhouette_against_numpy(spark):
    rng = np.random.default_rng(5)
    lab = rng.integers(0, 3, 50)
    x = rng.normal(0, 1, (50, 3)) + lab[:, None]
    got = {r["id"]: r["silhouette"] for r in embed.silhouettes(vectors(spark, x, lab)).collect()}
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    for i in range(50):
        a = d[i][lab == lab[i]].sum() / ((lab == lab[i]).sum() - 1)
        b = min(d[i][lab == o].mean() for o in set(lab.tolist()) - {lab[i]})
        assert got[f"v{i:03d}"] == pytest.approx((b - a) / max(a, b), abs=1e-6)


def test_harmony_brings_batches_together(spark):
    rng = np.random.default_rng(6)
    kind, batch = rng.integers(0, 3, 240), rng.integers(0, 2, 240)
    x = np.eye(5)[kind] * 6 + rng.normal(0, 0.3, (240, 5)) + batch[:, None] * np.array([0, 0, 0, 2.0, 1.0])
    rows = vectors(spark, x).select("id", "v", F.concat(F.lit("b"), F.element_at(F.array(*[F.lit(int(b)) for b in batch]), F.substring("id", 2, 3).cast("int") + 1).cast("string")).alias("batch"))
    y = np.array([r["v"] for r in embed.harmonise(rows, 6).orderBy("id").collect()])
    gap = lambda z: np.mean([np.linalg.norm(z[(kind == k) & (batch == 0)].mean(0) - z[(kind == k) & (batch == 1)].mean(0)) for k in range(3)])
    assert gap(y) < 0.7 * gap(x)


def test_communities(spark):
    edges = [(f"{c}{i}", f"{c}{j}", 1.0) for c in "abc" for i in range(6) for j in range(i)] + [("a0", "b0", 1.0), ("b1", "c1", 1.0)]
    e = spark.createDataFrame([(min(u, v), max(u, v), w) for u, v, w in edges], "u string, v string, w double")
    got = {r["node"]: r["cluster"] for r in graph.communities(e).collect()}
    q = graph.modularity(e, graph.communities(e).select("node", F.col("cluster").alias("c"))).first()[0]
    assert q > 0.5 and len({got[f"a{i}"] for i in range(6)}) == 1
    assert graph.layout(e, rounds=2).count() == 18


def connected(nodes, edges):
    nodes, seen = set(nodes), set()
    todo = [min(nodes)]
    while todo:
        a = todo.pop()
        seen.add(a)
        todo += [v if u == a else u for u, v in edges if a in (u, v) and {u, v} <= nodes and (v if u == a else u) not in seen]
    return seen == nodes


@pytest.mark.parametrize("block", [200_000, 60])
def test_leiden_ladder(spark, block):
    """At each resolution and with one block or many: no node would move, no two communities gain by merging, and each is connected."""
    rng = np.random.default_rng(8)
    e = {(f"{min(a, b):02d}", f"{max(a, b):02d}"): float(rng.integers(1, 4)) for a, b in rng.integers(0, 40, (160, 2)).tolist() if a != b}
    steps = [0.5, 1.0, 2.0]
    found = graph.ladder(spark.createDataFrame([(*k, w) for k, w in e.items()], "u string, v string, w double"), steps, block=block).collect()
    k = {n: sum(w for x, w in e.items() if n in x) for n in {x for uv in e for x in uv}}
    m2, sizes = sum(k.values()), []
    for i, gamma in enumerate(steps):
        c = {r["node"]: r["cluster"] for r in found if r["res"] == i}
        assert set(c) == set(k)
        to = {(n, a): sum(w for (u, v), w in e.items() if n in (u, v) and c[v if u == n else u] == a) for n in c for a in set(c.values())}
        tot = {a: sum(k[n] for n in c if c[n] == a) for a in set(c.values())}
        link = {(a, b): sum(to[n, b] for n in c if c[n] == a) for a in tot for b in tot if a < b}
        assert all(w <= gamma * tot[a] * tot[b] / m2 + 1e-6 for (a, b), w in link.items())
        assert all(connected([n for n in c if c[n] == a], e) for a in tot)
        stay = {n: to[n, c[n]] - gamma * k[n] * (tot[c[n]] - k[n]) / m2 for n in c}
        assert min(stay.values()) >= -1e-6
        sizes.append(len(tot))
    assert sizes == sorted(sizes)


def test_leiden_rounds_of_several_blocks(spark, monkeypatch):
    """A pass that another follows does not bring levels of several blocks to rest; the last one starts blocks from its communities and does. Few rounds in all."""
    rng = np.random.default_rng(28)
    near = {(i, int(j)) for i in range(300) for j in (i + rng.integers(1, 40, 6)) % 300 if i != j}
    e = spark.createDataFrame([(f"{min(p):03d}", f"{max(p):03d}", 1.0) for p in {tuple(sorted(p)) for p in near}], "u string, v string, w double")
    steps, settled = [], graph.settle
    monkeypatch.setattr(graph, "settle", lambda df: steps.append("would" in df.columns) or settled(df))
    found = graph.ladder(e, [1.0], block=400)
    assert graph.modularity(e, found.select("node", F.col("cluster").alias("c"))).first()[0] > 0.5
    assert sum(steps) <= 40


def test_first_pass_of_several_blocks_makes_no_parts(spark, monkeypatch):
    """Communities are the next level's nodes in a pass that another follows; the last pass parts them, so each is connected in the end."""
    rng = np.random.default_rng(29)
    e = {tuple(sorted((i, int(j)))): 1.0 for i in range(120) for j in (i + rng.integers(1, 12, 5)) % 120 if i != j}
    log, levels, parts = [], graph._levels, graph._parts
    monkeypatch.setattr(graph, "_levels", lambda *a: log.append("pass") or levels(*a))
    monkeypatch.setattr(graph, "_parts", lambda *a: log.append("parts") or parts(*a))
    monkeypatch.setattr(graph, "PACKED", 50)
    found = graph.ladder(spark.createDataFrame([(*k, w) for k, w in e.items()], "u int, v int, w double"), [1.0], block=300).collect()
    assert log[:3] == ["pass", "pass", "parts"]
    c = {r["node"]: r["cluster"] for r in found}
    assert len(c) == 120 and all(connected([n for n in c if c[n] == a], e) for a in set(c.values()))


def test_badly_connected_community_is_split(spark):
    """A node that held two groups together and moved away leaves no community in two pieces."""
    rng = np.random.default_rng(3)
    groups = [[f"g{g}n{i}" for i in range(8)] for g in range(6)]
    e = {(u, v): 1.0 for g in groups for i, v in enumerate(g) for u in g[:i] if rng.random() < 0.8}
    for g, h in zip(groups, groups[1:], strict=False):
        e[g[0], h[0]] = 0.5
    e |= {("bridge", g[1]): 2.0 for g in groups[:3]}
    d = spark.createDataFrame([(min(uv), max(uv), w) for uv, w in e.items()], "u string, v string, w double")
    c = {r["node"]: r["cluster"] for r in graph.communities(d, 0.4).collect()}
    assert all(connected([n for n in c if c[n] == a], e) for a in set(c.values()))
    assert graph.communities(d.limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 37, 120, 199, 200, 500])
def test_sketch_draws_in_turn(spark, n):
    rng = np.random.default_rng(9)
    x = np.where(np.arange(200)[:, None] < 80, 0.05, rng.uniform(0, 0.5, (200, 3)))
    rows = vectors(spark, x)
    ids = [r["id"] for r in rows.orderBy("id").collect()]
    seen, turns = {}, []
    for i, v in zip(ids, x, strict=True):
        b = tuple(np.floor(v / 0.1).astype(int))
        seen[b] = seen.get(b, 0) + 1
        turns.append((seen[b], i))
    assert {r["id"] for r in embed.sketch(rows, n, 0.1).where("kept").collect()} == {i for _, i in sorted(turns)[:n]}


def test_text_functions(spark):
    one = spark.range(1)
    row = one.select(text.cell_key(F.lit("cellid_000000123-1")).alias("a"), text.cell_key(F.lit("x7")).alias("b"), text.cell_key_loose(F.lit("CELLID_000")).alias("c"), text.ladder(F.lit(0.8), F.lit(1.2), F.lit(0.2)).alias("d"), text.shown(F.lit(None).cast("double")).alias("e"), text.nearest_scale(F.lit(3.1), 0.3).alias("f"), text.sample_of_file(F.lit("/x/adata_s1_annotated.h5ad")).alias("g"), text.resolution_of(F.lit("s1_0.5"), F.lit("s1")).alias("h")).first()
    assert tuple(row) == ("123", "x7", "0", [0.8, 1.0, 1.2], "NA", pytest.approx(1 / 0.3), "s1", "0.5")


def test_readers(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("# note\nsample\tpatient\ns1\t007\ns2\t\n")
    assert [tuple(r) for r in readers.sheet(spark, str(tmp_path / "s.tsv")).collect()] == [("s1", "007"), ("s2", "")]
    (tmp_path / "n.tsv").write_text("barcode\tk\tspatial_niche\n7\ta\tb\n")
    assert readers.niche_labels(spark, str(tmp_path / "n.tsv")).first() == ("7", "b")
    (tmp_path / "l.tsv").write_text("T\tB\ng1\tg2\ng3\t\n")
    assert readers.gene_lists(spark, str(tmp_path / "l.tsv")).count() == 3
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    feature = lambda p: {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring]}, "properties": p}
    (tmp_path / "p.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature({"classification": {"name": "DCIS"}}), feature({"name": "x"})]}, indent=1))
    assert [(r["ord"], r["region"], len(r["ring"])) for r in readers.polygons(spark, str(tmp_path / "p.geojson")).orderBy("ord").collect()] == [(0, "DCIS", 4), (1, "Unlabeled", 4)]
    m = readers.affine_matrix(["2,0,1", "0 4 2", "0 0 1"])
    assert readers.inverse(m)[0][0] == 0.5
    with pytest.raises(ValueError, match="9"):
        readers.affine_matrix(["1 2 3"])
    with pytest.raises(ValueError, match="no column"):
        readers.column(spark.range(1), "barcode")
    assert readers.first_that_has(spark, None, str(tmp_path / "none*"), str(tmp_path / "*.tsv")).endswith("*.tsv")
    assert not readers.has_content(spark.createDataFrame([("c", " ")], "k string, v string"), "k")
    ok = spark.createDataFrame([(1,)], "n int")
    assert readers.write_report(ok, F.col("n") == 1, str(tmp_path / "r")) and not readers.write_report(ok, F.col("n") == 2, str(tmp_path / "q"))
    assert not (tmp_path / "q").exists()


def test_workflow(spark, counts, tmp_path):
    with pytest.raises(ValueError, match="unknown keys"):
        workflow.Config.of({"contract": "x", "out": "y", "colour": 1})
    with pytest.raises(ValueError, match="goes together"):
        workflow.Config.of({"contract": "x", "out": "y", "external_labels": "z"})
    cells = spark.createDataFrame([("s", c, float(i), float(i % 2), "r1" if i < 3 else "r2", "t1" if i % 2 else "t2") for i, c in enumerate("abcdef")], "sample string, cell_id string, x double, y double, region_annotation string, cell_type string")
    counts.write.parquet(str(tmp_path / "in/counts"))
    cells.write.parquet(str(tmp_path / "in/cells"))
    counts.select("gene").distinct().write.parquet(str(tmp_path / "in/genes"))
    c = workflow.Config.of({"contract": str(tmp_path / "in"), "out": str(tmp_path / "out"), "min_counts": 1.0, "min_genes": 1.0, "min_cells": 1.0, "neighbours": 2, "pseudobulk_min_cells": 1, "pseudobulk_min_counts": 1})
    status = workflow.run(spark, c, "run_preprocessing")
    assert set(status.values()) == {"done"} and list(status)[0] == "validation"
    assert spark.read.parquet(str(tmp_path / "out/filtered")).count() == len(COUNTS)
    assert workflow.needed("run_exploration") == ["validation", "filtered", "normalised", "dotplot"]


def test_workflow_of_a_study(spark, tmp_path):
    """Two samples, two kinds of cells, two conditions: every step ends, says why it is left out, or blocks what reads it."""
    rng = np.random.default_rng(12)
    n, genes = 60, 40
    kind = np.arange(2 * n) % 2
    region = np.where(np.arange(2 * n) // 2 % 2 == 0, "r1", "r2")
    x = rng.poisson(2 + 10 * (np.arange(genes)[None, :] % 2 == kind[:, None]) + 8 * ((np.arange(genes) < 4)[None, :] & (region == "r1")[:, None]))
    name = [("s1" if i < n else "s2", f"c{i:03d}") for i in range(2 * n)]
    spark.createDataFrame([(*name[i], f"g{j:02d}", int(x[i, j])) for i in range(2 * n) for j in range(genes) if x[i, j]], "sample string, cell_id string, gene string, count long").write.parquet(str(tmp_path / "in/counts"))
    at = rng.uniform(0, 100, (2 * n, 2))
    spark.createDataFrame([(*name[i], float(at[i, 0]), float(at[i, 1]), str(region[i]), f"t{kind[i]}") for i in range(2 * n)], "sample string, cell_id string, x double, y double, region_annotation string, cell_type string").write.parquet(str(tmp_path / "in/cells"))
    spark.createDataFrame([(f"g{j:02d}",) for j in range(genes)], "gene string").write.parquet(str(tmp_path / "in/genes"))
    (tmp_path / "lists.tsv").write_text("even\todd\ng00\tg01\ng02\tg03\n")
    raw = {"contract": str(tmp_path / "in"), "out": str(tmp_path / "out"), "components": 4, "graph_neighbours": 8, "resolutions": [0.5], "pseudobulk_min_counts": 1, "gene_lists": str(tmp_path / "lists.tsv"), "compartments": {"first": ["t0"], "none": ["t9"]}}
    # what is left out here beside the blocking steps has a query of its own against SQL
    raw["skip"] = ["variable_genes", "qc_report", "niche_pcs", "integrated", "region_enrichment", "co_occurrence", "composition", "majority", "dotplot", "markers"]
    got = workflow.run(spark, workflow.Config.of(raw))
    odd = {k: v for k, v in got.items() if v != "done"}
    skipped = "skipped: by configuration"
    assert odd.pop("subclusters").startswith("failed: ValueError: 0 cells of t9")
    assert {odd.pop(f"subcluster_{x}") for x in ("silhouettes", "metrics", "markers", "composition", "counts")} == {"blocked: subclusters"} and odd.pop("subcluster_tree") == "skipped: one resolution"
    assert odd == {**dict.fromkeys(raw["skip"], skipped), "niches": "blocked: niche_pcs", "integrated_clusters": "blocked: integrated", "cluster_tree": "skipped: one resolution", "transferred": "skipped: no reference"}
    read = lambda t: spark.read.parquet(str(tmp_path / "out" / t))
    assert read("status").count() == len(got)
    of = {(f"{s}|{c}"): int(k) for (s, c), k in zip(name, kind, strict=True)}
    met = {(r["cluster"], of[r["id"]]) for r in read("clusters").collect()}
    assert len({k for k, _ in met}) == len(met) >= 2  # no cluster mixes the kinds
    raised = {r["gene"] for r in read("de").where("contrast = 'r1_vs_r2' AND padj < 0.05 AND log2fc > 0.5").collect()}
    assert {"g00", "g01", "g02", "g03"} <= raised and len(raised) < 8
    assert {r["source"] for r in read("signatures").collect()} == {"even", "odd"}
    with pytest.raises(ValueError, match="compartments.a: 0 items"):
        workflow.Config.of({**raw, "compartments": {"a": []}})


def test_reanalysis_and_niches(spark, tmp_path):
    rng = np.random.default_rng(13)
    kind = np.arange(60) // 2 % 2
    x = rng.poisson(1 + 12 * (np.arange(30)[None, :] % 2 == kind[:, None]))
    name = [(f"s{i % 2}", f"c{i:02d}") for i in range(60)]
    counts = spark.createDataFrame([(*name[i], f"g{j:02d}", int(x[i, j])) for i in range(60) for j in range(30) if x[i, j]], "sample string, cell_id string, gene string, count long")
    # the kinds lie side by side, far apart
    cells = spark.createDataFrame([(*name[i], float(i % 10 + 100 * kind[i]), float(i // 10), "t") for i in range(60)], "sample string, cell_id string, x double, y double, cell_type string")
    c = workflow.Config(contract="", out="", components=3, graph_neighbours=6, resolutions=(0.3,), batch_groups=2)
    t = {"cells": cells, "normalised": normalize.log_normalise(counts), "neighbours": spatial.knn(cells, 4)}
    t["niche_pcs"] = workflow._niche_pcs(t, c)
    of = {f"{s}|{i}": int(k) for (s, i), k in zip(name, kind, strict=True)}
    met = {(r["niche"], of[f"{r['sample']}|{r['cell_id']}"]) for r in workflow._niches(t, c).collect()}
    assert len({k for k, _ in met}) == len(met) >= 2
    got = subset.reanalyse(counts, cells, "cell_type", ["t"], [0.3], 3, 6)
    assert {r["branch"] for r in got["pcs"].select("branch").distinct().collect()} == {"plain", "corrected"}
    assert got["clusters"].groupBy("branch").count().where("count = 60").count() == 2 and got["qc"].count() == 60


def test_compartment_tables(spark, tmp_path):
    """Two kinds of cells in one compartment, both branches: the tables tell the kinds apart at the lower resolution."""
    rng = np.random.default_rng(14)
    kind = np.arange(60) // 2 % 2
    x = rng.poisson(1 + 12 * (np.arange(30)[None, :] % 2 == kind[:, None]))
    name = [(f"s{i % 2}", f"c{i:02d}") for i in range(60)]
    cols = "sample string, cell_id string, gene string, count long"
    spark.createDataFrame([(*name[i], f"g{j:02d}", int(x[i, j])) for i in range(60) for j in range(30) if x[i, j]], cols).write.parquet(str(tmp_path / "in/counts"))
    cells = [(*name[i], float(i), 0.0, "r", "t" if i % 3 else "u") for i in range(60)]
    spark.createDataFrame(cells, "sample string, cell_id string, x double, y double, region_annotation string, cell_type string").write.parquet(str(tmp_path / "in/cells"))
    spark.createDataFrame([(f"g{j:02d}",) for j in range(30)], "gene string").write.parquet(str(tmp_path / "in/genes"))
    raw = {"contract": str(tmp_path / "in"), "out": str(tmp_path / "out"), "components": 3, "graph_neighbours": 6, "resolutions": [0.2, 0.4], "marker_genes": 5, "compartments": {"both": ["t", "u"]}}
    got = workflow.run(spark, workflow.Config.of(raw), "subcluster_all")
    assert set(got.values()) == {"done"}
    read = lambda t: spark.read.parquet(str(tmp_path / "out" / t)).where("branch IN ('plain', 'corrected')")
    of = {f"{s}|{c}": int(k) for (s, c), k in zip(name, kind, strict=True)}
    kinds = {(r["branch"], r["resolution"], r["cluster"]): of[r["id"]] for r in read("subclusters").collect()}
    sils = read("subcluster_silhouettes").where("resolution = 0.2").collect()
    assert len(sils) == 120 and min(r["silhouette"] for r in sils) > 0
    pcs = {(r["branch"], r["id"]): r["v"] for r in read("subcluster_pcs").collect()}
    one = sils[0]
    v = np.array([pcs[one["branch"], r["id"]] for r in sils if r["branch"] == one["branch"]])
    v = (v - v.mean(0)) / v.std(0)
    lab = np.array([r["cluster"] for r in sils if r["branch"] == one["branch"]])
    d = np.linalg.norm(v - v[0], axis=1)
    a, b = d[lab == lab[0]].sum() / ((lab == lab[0]).sum() - 1), min(d[lab == c].mean() for c in set(lab) - {lab[0]})
    assert one["silhouette"] == pytest.approx((b - a) / max(a, b))
    top = read("subcluster_markers").where("resolution = 0.2").collect()
    assert len(top) == 5 * len({k for k in kinds if k[1] == 0.2})
    assert all(int(r["gene"][1:]) % 2 == kinds[r["branch"], 0.2, r["cluster"]] and r["mean"] > 0 for r in top)
    parts = read("subcluster_composition").where("resolution = 0.2")
    assert {r["kind"] for r in parts.select("kind").distinct().collect()} == {"sample", "cell_type"}  # one region says nothing
    assert all(abs(r["p"] - 100) < 1e-9 for r in parts.groupBy("branch", "cluster", "kind").agg(F.sum("pct_of_cluster").alias("p")).collect())
    assert all(abs(r["p"] - 100) < 1e-9 for r in parts.groupBy("branch", "kind", "value").agg(F.sum("pct_of_value").alias("p")).collect())
    metric = read("subcluster_metrics").where("resolution = 0.2 AND metric = 'total_counts' AND point IN (0, 1)").collect()
    for r in metric:
        mine = [x[i].sum() for i in range(60) if kind[i] == kinds[r["branch"], 0.2, r["cluster"]]]
        assert min(mine) <= r["value"] <= max(mine)
    assert read("subcluster_counts").groupBy("branch").agg(F.sum("n_cells").alias("n")).where("n = 60").count() == 2
    flow = read("subcluster_tree").groupBy("branch").agg(F.sum("n").alias("n")).collect()
    assert [r["n"] for r in flow] == [60, 60]


def test_silhouettes_of_one_cluster(spark):
    pcs = spark.createDataFrame([(str(i), [float(i), 1.0]) for i in range(4)], "id string, v array<double>")
    clusters = spark.createDataFrame([(str(i), r, "a" if r < 1 else "ab"[i // 2]) for i in range(4) for r in (0.5, 1.0)], "id string, resolution double, cluster string")
    got = branches.silhouettes(pcs, clusters).collect()
    assert {r["resolution"] for r in got} == {1.0} and len(got) == 4 and all(r["silhouette"] > 0 for r in got)
    assert branches.silhouettes(pcs, clusters.where("resolution = 0.5")).collect() == []


def test_sketched_clusters(spark):
    """Three groups, one of them rare: the sketch meets all, and the rest takes the cluster of its group."""
    rng = np.random.default_rng(15)
    group = np.repeat([0, 1, 2], [300, 280, 20])
    v = rng.normal(0, 0.4, (600, 4)) + 6 * np.eye(4)[group]
    pcs = spark.createDataFrame([(f"p{i:03d}", [float(a) for a in v[i]]) for i in range(600)], "id string, v array<double>")
    got = subset.sketched(pcs, 0.1, 0.05, 10).collect()
    assert len(got) == 600 == len({r["id"] for r in got}) and sum(r["drawn"] for r in got) == 100
    met = {(r["cluster"], int(group[int(r["id"][1:])])) for r in got}
    assert {g for _, g in met} == {0, 1, 2} and len({c for c, _ in met}) == len(met)
    assert all(r["share"] == 1.0 for r in got if r["drawn"]) and all(0 < r["share"] <= 1 for r in got)
    # all points in one place: one box, whatever its side
    same = spark.createDataFrame([(str(i), [1.0, 2.0, 3.0]) for i in range(5)], "id string, v array<double>")
    assert embed.box_size(same, 3) == 1.0
    assert embed.box_size(pcs.limit(0), 3) == 1.0


def test_uncorrected_batches(spark, monkeypatch):
    pcs = spark.createDataFrame([("a", "x", [1.0]), ("b", "y", [2.0])], "id string, batch string, v array<double>")

    def singular(*_):
        raise np.linalg.LinAlgError("Singular matrix")

    monkeypatch.setattr(embed, "harmonise", singular)
    got = subset.integrated(pcs).orderBy("id").collect()
    assert [tuple(r) for r in got] == [("a", "x", [1.0], "uncorrected: Singular matrix"), ("b", "y", [2.0], "uncorrected: Singular matrix")]
    monkeypatch.setattr(embed, "harmonise", lambda rows, groups: rows.withColumn("v", F.array(F.lit(float("nan")))))
    assert {r["status"] for r in subset.integrated(pcs).collect()} == {"uncorrected: not finite"}


def test_scale_and_per_sample_files(spark, tmp_path):
    fields = readers.image_scale("s", 2, (100, 50), (400, 200), 0.25)
    assert fields["scale"] == 4 and fields["scaled_pixel_um"] == 1
    readers.write_json(spark, fields, str(tmp_path / "m"))
    assert readers.scale_factors(spark, str(tmp_path / "m"))["full_width"] == 200
    (tmp_path / "l.json").write_text("[1]")
    with pytest.raises(ValueError, match="object"):
        readers.scale_factors(spark, str(tmp_path / "l.json"))
    df = spark.createDataFrame([("a", "1", "x"), ("b", "2", "y")], "sample string, barcode string, niche string")
    readers.write_per_sample(df, str(tmp_path / "n"))
    assert sorted(p.name for p in (tmp_path / "n").glob("sample=*")) == ["sample=a", "sample=b"]
    with pytest.raises(ValueError, match="no columns"):
        subset.one_sample(df, ["z"], F.col("sample"))


def test_delaunay(spark):
    rng = np.random.default_rng(8)
    p = rng.uniform(0, 10, (50, 2))
    d = spark.createDataFrame([("s", f"p{i:02d}", float(a), float(b)) for i, (a, b) in enumerate(p)], "sample string, cell_id string, x double, y double")
    got = {(r["u"], r["v"]) for r in spatial.delaunay(d, k=6).collect()}
    step = np.sqrt(np.prod(p.max(0) - p.min(0)) / len(p))
    want = set()
    for i in range(len(p)):
        rest = [j for j in range(len(p)) if j != i]
        lo, hi = p.min(0) - step - p[i], p.max(0) + step - p[i]
        hit, _ = spatial.voronoi_neighbours((lo[0], lo[1], hi[0], hi[1]), (p[rest] - p[i])[:, 0].tolist(), (p[rest] - p[i])[:, 1].tolist())
        want |= {tuple(sorted((f"p{i:02d}", f"p{rest[m]:02d}"))) for m in hit}
    assert got == want
    # a point on the grid midway between two joined points is nearest to both, so few edges cross: planar bound
    assert len(got) <= 3 * len(p) - 6


def test_delaunay_searches_all_points_once(spark, monkeypatch):
    """Cells along the hull look in the circles around their corners; all points are not searched anew for them. Copies at a place and points without coordinates do no harm."""
    rng = np.random.default_rng(18)
    p = np.vstack([rng.normal(0, 1, (120, 2)), rng.normal(9, 0.5, (40, 2)), [[30.0, -5.0]]])
    names = [f"p{i:03d}" for i in range(len(p))]
    rows = [("s", n, float(a), float(b)) for n, (a, b) in zip(names, p, strict=True)]
    rows += [("s", f"q{i:02d}", float(p[7][0]), float(p[7][1])) for i in range(30)] + [("s", "none", None, None), ("t", "alone", 1.0, 1.0)]
    searched, knn = [], spatial.knn
    monkeypatch.setattr(spatial, "knn", lambda *a, **b: searched.append(a) or knn(*a, **b))
    got = {(r["u"], r["v"]) for r in spatial.delaunay(spark.createDataFrame(rows, "sample string, cell_id string, x double, y double"), k=6, share=5).collect()}
    assert len(searched) == 1
    step = np.sqrt(np.prod(p.max(0) - p.min(0)) / (len(rows) - 1))
    want = set()
    for i in range(len(p)):
        rest = sorted((j for j in range(len(p)) if j != i), key=lambda j: ((p[j] - p[i]) ** 2).sum())  # noqa: B023
        lo, hi = p.min(0) - step - p[i], p.max(0) + step - p[i]
        hit, _ = spatial.voronoi_neighbours((lo[0], lo[1], hi[0], hi[1]), (p[rest] - p[i])[:, 0].tolist(), (p[rest] - p[i])[:, 1].tolist())
        want |= {tuple(sorted((n, names[rest[m]]))) for m in hit for n in ([names[i]] if i != 7 else ["p007", *[f"q{c:02d}" for c in range(30)]])}
    assert got == want


def test_counts_are_dealt_by_their_number(spark, monkeypatch):
    """Lines beyond what the session's partitions hold get more partitions, and a cell's stay together: no further exchange by cell."""
    from cytogrid.plans import views

    d = "/root/testdata/sf0.001"
    few = views.counts(spark, d)
    monkeypatch.setattr(views, "LINES", 100, raising=False)
    many = views.counts(spark, d)
    assert many.rdd.getNumPartitions() == -(-views.table(spark, d, "lineitem").count() // 100)
    assert many.exceptAll(few).isEmpty() and few.exceptAll(many).isEmpty()
    assert normalize.log_normalise(many, 1e6).rdd.getNumPartitions() == many.rdd.getNumPartitions()


def test_rank_sums_read_entries_once(spark):
    """Ranks go by how often each group holds a value, so the entries are not joined with their ranks."""
    entry = F.udf(lambda v: seen_by.add(1) or v, "double")
    seen_by = spark.sparkContext.accumulator(0)
    rows = [("s", f"c{i:02d}", "g", float(1 + i % 7)) for i in range(40)]
    values = spark.createDataFrame(rows, "sample string, cell_id string, gene string, value double").withColumn("value", entry.asNondeterministic()("value"))
    cells = spark.createDataFrame([("s", f"c{i:02d}", "ab"[i % 3 == 0]) for i in range(50)], "sample string, cell_id string, grp string")
    got = {r["grp"]: r["rank_sum"] for r in markers.rank_sum(values, cells, "grp").collect()}
    assert seen_by.value == 40
    v = np.array([1 + i % 7 if i < 40 else 0 for i in range(50)])
    rank = np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])
    b = np.arange(50) % 3 == 0
    assert got == {"a": rank[~b].sum(), "b": rank[b].sum()}


def test_chi_squared_tail():
    # from tables of the distribution
    for x, df, p in ((3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (9.487729, 4, 0.05), (11.070498, 5, 0.05), (16.811894, 6, 0.01)):
        assert de.chi2_tail(x, df) == pytest.approx(p, rel=1e-5)


def test_gene_of_one_level(spark):
    """Zeros count: a gene absent from one level has a ratio, z-scores and a test there."""
    rng = np.random.default_rng(9)
    rows = [(f"{lv}{k}", lv, f"g{g}", int(rng.poisson(60))) for lv in "ABC" for k in range(4) for g in range(30)]
    rows += [(f"A{k}", "A", "only", 40 + k) for k in range(4)]
    b = pseudobulk.completed(spark.createDataFrame(rows, "bulk string, lv string, gene string, count long"), ["bulk", "lv"]).cache()
    assert b.count() == 12 * 31 and b.where("gene = 'only'").agg({"count": "sum"}).first()[0] == 166
    factors = pseudobulk.size_factors(b, "bulk")
    norm = pseudobulk.log_normalised(b, factors, "bulk")
    ratios = {(r["gene"], r["contrast"]): r["log2fc"] for r in de.mean_ratios(norm, "lv").collect()}
    assert ratios[("only", "A_vs_B")] > 5 and ratios[("only", "B_vs_C")] is None
    assert pseudobulk.gene_zscores(norm, "bulk").where("gene = 'only'").count() == 12
    t = {(r["gene"], r["contrast"]): r for r in nbinom.nb_tests(b, factors, "bulk", "lv", ["A", "B", "C"]).collect()}
    assert t[("only", "A_vs_B")]["log2fc"] > 5 and t[("only", "A_vs_rest")]["lr_p"] < 1e-6
    assert np.mean([t[(f"g{g}", "A_vs_rest")]["lr_p"] < 0.05 for g in range(30)]) < 0.3


def test_channel_roles(spark):
    want = {
        "DAPI": "nuclear", "Nuclei": "nuclear", "HOECHST 33342": "nuclear", "18S": "rna", "Interior": "rna", "membrane RNA": "rna", "ATP1A1/CD45/E-Cadherin": "membrane", "E-cad": "membrane", "Boundary 2": "membrane",
        "AlphaSMA/Vimentin": "cytoplasm", "F-actin": "cytoplasm", "Cytoplasm": "cytoplasm", "Cyto": None, "PolyT": None, "": None, None: None,
    }
    got = spark.createDataFrame([(k,) for k in want], "name string").select("name", text.channel_role(F.col("name")).alias("role"))
    assert {r["name"]: r["role"] for r in got.collect()} == want


def plane(spark, xy, sample="s"):
    return spark.createDataFrame([(sample, f"c{i:05d}", float(x), float(y)) for i, (x, y) in enumerate(xy)], "sample string, cell_id string, x double, y double")


def odd_planes(rng):
    even = rng.uniform(0, 1, (500, 2))
    yield even
    yield np.concatenate([even, [[1000, 1000]]])
    yield np.concatenate([rng.normal(0, 1, (400, 2)), rng.normal(0, 300, (100, 2))])
    yield np.concatenate([rng.integers(0, 5, (300, 2)), np.zeros((300, 2)), rng.normal(0, 1e-7, (100, 2))])
    yield np.stack([np.arange(120) % 50, np.zeros(120)], 1)
    yield np.array([[1.0, 1.0], [2.0, 2.0], [2.0, 2.0]])


@pytest.mark.parametrize("case", range(6))
def test_neighbours_in_odd_planes(spark, case):
    xy, k = list(odd_planes(np.random.default_rng(1)))[case], 5
    got = {}
    lone = spark.createDataFrame([("t", "alone", 0.0, 0.0), ("t", "nowhere", None, 1.0)], "sample string, cell_id string, x double, y double")
    for r in sorted(spatial.knn(plane(spark, xy).unionByName(lone), k).collect(), key=lambda r: r["rank"]):
        assert (r["dx"] ** 2 + r["dy"] ** 2) ** 0.5 == pytest.approx(r["d"])
        got.setdefault(r["src"], []).append((round(r["d"], 9), r["dst"]))
    for i, p in enumerate(xy):
        d = np.sqrt(((xy - p) ** 2).sum(1))
        assert got[f"c{i:05d}"] == [(round(x, 9), n) for x, n in sorted((float(d[j]), f"c{j:05d}") for j in range(len(xy)) if j != i)[:k]]
    assert len(got) == len(xy)


def met_pairs(points, k, most=24):
    """Pairs of places that the search joins."""
    tree, _, near = spatial.search(points.select("sample", F.col("cell_id").alias("src"), "x", "y"), k, most)
    leaf = ["sample", "depth", "cx", "cy"]
    n = tree.groupBy(*leaf).agg(F.count("*").alias("n"))
    return n.agg(F.sum(F.col("n") * F.col("n"))).first()[0] + (near.join(n, leaf).agg(F.sum("n")).first()[0] or 0)


def test_an_outlier_costs_no_more_pairs(spark):
    even = np.random.default_rng(2).uniform(0, 1, (3000, 2))
    usual = met_pairs(plane(spark, even), 6)
    assert usual < 150 * 3000
    assert met_pairs(plane(spark, np.concatenate([even, [[1000, 1000]]])), 6) < 2 * usual
    # places, not points, are paired
    assert met_pairs(plane(spark, np.zeros((3000, 2))), 6) == 1


def strictly_within(x, y, ring):
    edges = list(zip(ring, ring[1:] + ring[:1], strict=True))
    on = any((bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by) for (ax, ay), (bx, by) in edges)
    return not on and sum((ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay) for (ax, ay), (bx, by) in edges) % 2 == 1


@pytest.mark.parametrize("last", [False, True])
def test_regions_of_many_polygons(spark, last):
    """Polygons of all sizes and odd shapes in two samples, points on corners and edges too, against one test after another."""
    rng = random.Random(4)
    shapes = []
    for k in range(120):
        cx, cy, r = rng.uniform(-50, 50), rng.uniform(-50, 50), rng.choice([0.01, 0.5, 4, 30])
        ring = [(round(cx + rng.uniform(-r, r), 2), round(cy + rng.uniform(-r, r), 2)) for _ in range(rng.randrange(3, 9))]
        shapes.append((f"s{k % 2}", k, f"r{k}", ring + ring[:1] if k % 3 else ring))
    shapes += [("s0", 200, "square", [(0.0, 0.0), (16.0, 0.0), (16.0, 16.0), (0.0, 16.0)]), ("s0", 201, "flat", [(0.0, 0.0), (5.0, 0.0)]), ("s2", 202, "other", [(-99.0, -99.0), (99.0, -99.0), (0.0, 99.0)])]
    points = [(f"s{rng.randrange(2)}", round(rng.uniform(-60, 60), 2), round(rng.uniform(-60, 60), 2)) for _ in range(500)] + [(s, *p) for s, _, _, ring in shapes[:40] for p in ring] + [("s0", 8.0, 0.0), ("s0", 8.0, 8.0), ("s3", 0.0, 0.0), ("s0", None, 1.0), ("s0", 8.0, 8.0)]
    cells = spark.createDataFrame([(s, f"c{i}", x, y, "was") for i, (s, x, y) in enumerate(points)], "sample string, cell_id string, x double, y double, region string")
    polygons = spark.createDataFrame(shapes, "sample string, ord int, region string, ring array<struct<x:double,y:double>>")
    got = {r["cell_id"]: r["region"] for r in spatial.regions_of(cells, polygons, last).collect()}
    assert len(got) == len(points)
    for i, (s, x, y) in enumerate(points):
        hits = [r for t, _, r, ring in shapes if t == s and x is not None and strictly_within(x, y, ring[:-1] if ring[0] == ring[-1] else ring)]
        assert got[f"c{i}"] == (hits[-1 if last else 0] if hits else "Unlabeled")
    inner = spatial.cover(polygons.where("region = 'square'")).where("edges IS NULL").count()
    assert inner >= 14 * 14


def nb_counts(seed=0, genes=150, per=6, shift=15):
    """Counts with dispersions 0.05 + 2 / mean; the first genes are four times as frequent in level B."""
    rng = np.random.default_rng(seed)
    level, size = np.repeat([0, 1, 2], per), rng.uniform(0.5, 2, 3 * per)
    mean = rng.lognormal(5, 1.5, genes)
    disp = (0.05 + 2 / mean) * rng.lognormal(0, 0.4, genes)
    mu = mean[:, None] * size * np.where((np.arange(genes) < shift)[:, None] & (level == 1), 4, 1)
    return rng.negative_binomial(1 / disp[:, None], 1 / (1 + disp[:, None] * mu)), level, size


def as_bulks(spark, y, level, size):
    b = spark.createDataFrame([(f"b{i:02d}", "ABC"[level[i]], f"g{g:03d}", int(v)) for g, row in enumerate(y) for i, v in enumerate(row)], "bulk string, lv string, gene string, count long")
    return b, spark.createDataFrame([(f"b{i:02d}", float(s)) for i, s in enumerate(size)], "bulk string, size_factor double")


def plain_ll(y, mu, alpha):
    r = 1 / alpha
    return sum(math.lgamma(v + r) - math.lgamma(r) + v * math.log(m / (r + m)) + r * math.log(r / (r + m)) for v, m in zip(y, mu, strict=True))


def test_dispersion_is_the_likeliest():
    """The adjusted likelihood of one gene after another on a fine grid, with mean and determinant spelled out."""
    y, level, size = nb_counts(3, 12)
    d = nbinom.Design(("A", "B", "C"), level, size)
    got = nbinom.gene_dispersions(y.astype(float), d)
    for g in range(12):
        m = [np.mean([y[g, i] / size[i] for i in range(18) if level[i] == k]) for k in range(3)]
        mu = [max(m[level[i]] * size[i], 0.5) for i in range(18)]
        x = np.column_stack([np.ones(18), level == 1, level == 2])

        def cr(alpha, g=g, mu=mu):
            w = np.array(mu) / (1 + alpha * np.array(mu))
            return plain_ll(y[g], mu, alpha) - 0.5 * np.linalg.slogdet(x.T @ (w[:, None] * x))[1]

        best = max(cr(a) for a in np.exp(np.linspace(np.log(1e-8), np.log(18), 1500)))
        assert cr(float(got[g])) >= best - 1e-6
    for v in (0.0, 1.0, 7.0, 1000.0):
        for r in (1e-3, 0.5, 30.0, 1e4):
            assert nbinom.log_gamma_ratio(np.array([v]), np.array([r]))[0] == pytest.approx(math.lgamma(v + r) - math.lgamma(r), rel=1e-9, abs=1e-9)


def test_levels_are_fitted_and_tested(spark):
    y, level, size = nb_counts(1)
    b, f = as_bulks(spark, y, level, size)
    rows = nbinom.nb_tests(b, f, "bulk", "lv", ["A", "B", "C"]).collect()
    t = {(r["gene"], r["contrast"]): r for r in rows}
    assert {c for _, c in t} == {"A_vs_B", "A_vs_C", "B_vs_C", "A_vs_rest", "B_vs_rest", "C_vs_rest"} and len(rows) == 6 * 150
    for c, sign in (("A_vs_B", -1), ("B_vs_rest", 1)):
        own = [t[f"g{g:03d}", c] for g in range(15)]
        assert np.mean([r["log2fc"] for r in own]) == pytest.approx(2 * sign, abs=0.25) and sum(r["padj"] is not None and r["padj"] < 0.05 for r in own) >= 13
    rest = [t[f"g{g:03d}", c]["p"] for g in range(15, 150) for c in ("A_vs_B", "A_vs_C", "C_vs_rest")]
    assert 0.01 < np.mean([p is not None and p < 0.05 for p in rest]) < 0.11
    # a gene's levels maximise the likelihood under its dispersion, and lr compares them with one level
    for g in (0, 40, 90):
        r = t[f"g{g:03d}", "A_vs_C"]
        one = lambda i, e: plain_ll([y[g, k] for k in i], [math.exp(e) * size[k] for k in i], r["dispersion"])  # noqa: B023, E731
        fit = {}
        for k in (0, 1, 2):
            i = [j for j in range(18) if level[j] == k]
            fit[k] = max(np.linspace(-3, 12, 6001), key=lambda e: one(i, e))  # noqa: B023
        assert r["log2fc"] == pytest.approx((fit[0] - fit[2]) / math.log(2), abs=0.01)
        null = max(one(range(18), e) for e in np.linspace(-3, 12, 6001))
        assert r["lr"] == pytest.approx(2 * (sum(one([j for j in range(18) if level[j] == k], fit[k]) for k in fit) - null), rel=0.01, abs=0.01)


def test_trend_and_prior_are_recovered(spark):
    y, level, size = nb_counts(5, 1500)
    b, f = as_bulks(spark, y[:, :], level, size)
    names, designs = nbinom._designs(b, f, "bulk", "lv", ["A", "B", "C"])
    raw = nbinom.settle(nbinom.dispersions(b, names, designs[:1], "bulk"))
    (a0, a1), (prior, spread) = nbinom.trends(raw, 1)[0], nbinom.priors(raw, designs[:1], nbinom.trends(raw, 1))[0]
    assert a0 == pytest.approx(0.055, abs=0.02) and a1 == pytest.approx(2.2, abs=0.7) and 0.2 <= prior <= spread


def test_outlying_counts(spark):
    """One wild count: replaced with seven replicates or more, and no p-value with fewer."""
    for per, tested in ((8, True), (4, False)):
        y, level, size = nb_counts(2, 60, per, 0)
        y = np.maximum(y, 20)
        y[5, 0] = 400 * y[5].max()
        b, f = as_bulks(spark, y, level, size)
        r = {(r["gene"], r["contrast"]): r for r in nbinom.nb_tests(b, f, "bulk", "lv", ["A", "B", "C"]).collect()}["g005", "A_vs_B"]
        assert (r["p"] is not None) == tested and (not tested or abs(r["log2fc"]) < 2)


def test_filter_leaves_out_what_cannot_be_found():
    rng = np.random.default_rng(7)
    mean = np.concatenate([rng.uniform(0, 5, 600), rng.uniform(50, 500, 400)])
    p = np.concatenate([rng.uniform(0, 1, 600), rng.uniform(0, 1, 340), rng.uniform(0, 2e-3, 60)])
    plain, got = nbinom.benjamini_hochberg(p), nbinom.filtered(p, mean)
    assert np.isnan(got[:600]).mean() > 0.2 and not np.isnan(got[mean > 50]).any() and (got[~np.isnan(got)] < 0.1).sum() > (plain < 0.1).sum()
    assert np.isnan(nbinom.filtered(np.array([np.nan, np.nan]), np.ones(2))).all() and nbinom.filtered(np.array([0.01, np.nan]), np.ones(2))[0] == 0.01
    want = sorted((v * len(p) / (i + 1), i) for i, v in enumerate(sorted(p)))
    assert plain.min() == pytest.approx(min(1, want[0][0]))


@pytest.mark.parametrize("x", [(2, 10, 7.559), (5, 20, 4.103), (1, 8, 11.259), (4, 96, 3.52)])
def test_f_quantile(x):
    assert nbinom.f_quantile(0.99, x[0], x[1]) == pytest.approx(x[2], rel=2e-3)


def test_no_trend_falls_back(spark):
    b, f = as_bulks(spark, np.full((12, 18), 50), np.repeat([0, 1, 2], 6), np.ones(18))
    got = nbinom.stabilised(b, f, "bulk", "lv", ["A", "B", "C"]).select("value").distinct().collect()
    assert len(got) == 1 and got[0][0] > 0
    assert nbinom.nb_tests(b, f, "bulk", "lv", ["A", "B", "C"]).where("padj < 0.5").count() == 0


def test_planted_profiles_are_grouped(spark):
    rng = np.random.default_rng(4)
    shapes = {"up": [0, 1, 2, 3], "down": [3, 2, 1, 0], "peak": [0, 3, 2, 1]}
    rows = [(f"{s}{g:02d}", f"{lv}{k}", lv, float(10 + 2 * v + rng.normal(0, 0.3))) for s, p in shapes.items() for g in range(20) for lv, v in zip("ABCD", p, strict=True) for k in range(3)]
    rows += [("flat", f"{lv}{k}", lv, 1.0) for lv in "ABCD" for k in range(3)] + [(f"odd{g}", f"{lv}{k}", lv, float(v)) for g in range(3) for lv, v in zip("ABCD", [1, 0, 3, 2], strict=True) for k in range(3)]
    v = spark.createDataFrame(rows, "gene string, bulk string, lv string, value double")
    got = {r["gene"]: r["group"] for r in de.pattern_groups(v, v, "lv", cut=0.6).collect()}
    assert sorted(set(got.values())) == [1, 2, 3] and len(got) == 60
    for s in shapes:
        assert len({got[f"{s}{g:02d}"] for g in range(20)}) == 1
    few = v.where("gene IN ('up00', 'up01', 'down00')")
    assert de.pattern_groups(v, few, "lv").count() == 0
    together = de.pattern_groups(v, v, "lv", cut=2.0, least=1).select("group").distinct().count()
    assert together == 1


def grouped_vectors(rng, groups, per, dim=12):
    return np.concatenate([rng.normal(0, 1, dim) * 20 + rng.normal(0, 1, (per, dim)) for _ in range(groups)] + [np.zeros((9, dim))])


def test_indexed_neighbours(spark):
    """Equal to comparing all, ties and repeated rows included, with under half of the pairs looked at where vectors are grouped."""
    rng = np.random.default_rng(11)
    x = grouped_vectors(rng, 10, 60)
    rows = vectors(spark, x)
    got = {}
    for r in sorted(embed.knn(rows, rows, 5, block=64).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["src"], []).append((r["d"], r["dst"]))
    plain = {}
    for r in sorted(embed.knn(rows, rows, 5).collect(), key=lambda r: r["rank"]):
        plain.setdefault(r["src"], []).append((r["d"], r["dst"]))
    assert got == plain and len(got) == len(x)
    _, visits, kept = embed.indexed(rows, rows, 5, 64)
    size = kept.groupBy("part").agg(F.count("*").alias("n"))
    seen = kept.join(size, "part").agg(F.sum("n")).first()[0] + (visits.join(size, "part").agg(F.sum("n")).first()[0] or 0)
    assert seen < 0.5 * len(x) ** 2
    few = vectors(spark, x[:3])
    assert embed.knn(few, rows.limit(0), 2, block=1).count() == 0 and embed.knn(few, few, 9, block=1).count() == 6


def test_sums_by_tree(spark, monkeypatch):
    """Totals over many tasks, in rows of a few numbers and stages of a few tasks."""
    monkeypatch.setattr(embed, "CHUNK", 7)
    monkeypatch.setattr(embed, "MERGED", 3)
    rows = spark.range(0, 100, 1, 11).select(F.array(*[(F.col("id") * i % 13).cast("double") for i in range(30)]).alias("v"))
    got = embed.summed(rows, lambda b: embed.matrix(b.column(0)).sum(0), 30)
    assert got.tolist() == [float(sum(n * i % 13 for n in range(100))) for i in range(30)]
    assert embed.summed(rows.limit(0), lambda b: embed.matrix(b.column(0)).sum(0), 30).tolist() == [0.0] * 30


def trustworthiness(x, y, k):
    """How far down the neighbours in y rank in x: 1 is best."""
    n = len(x)
    far = lambda z: ((z[:, None] - z[None]) ** 2).sum(2) + np.diag(np.full(n, np.inf))
    rank = np.argsort(np.argsort(far(x), 1), 1) + 1
    near = np.argsort(far(y), 1)[:, :k]
    return 1 - 2 / (n * k * (2 * n - 3 * k - 1)) * sum(max(0, rank[i, j] - k) for i in range(n) for j in near[i])


@pytest.mark.parametrize("block", [20_000, 60])
def test_umap_is_trustworthy(spark, block):
    rng = np.random.default_rng(13)
    x = np.concatenate([rng.normal(0, 4, 20) + rng.normal(0, 1, (30, 20)) for _ in range(9)])
    rows = vectors(spark, x)
    edges = embed.settle(graph.smooth_union(embed.knn(rows, rows, 10)))
    got = {r["node"]: (r["x"], r["y"]) for r in graph.umap(edges, block=block).collect()}
    y = np.array([got[r["id"]] for r in rows.orderBy("id").collect()])
    order = np.array([r["v"] for r in rows.orderBy("id").collect()])
    flat = (order - order.mean(0)) @ np.linalg.svd(order - order.mean(0), full_matrices=False)[2][:2].T
    assert np.isfinite(y).all() and trustworthiness(order, y, 10) > max(0.9, trustworthiness(order, flat, 10))


def test_local_scale_weights(spark):
    """Each node's weights add up to log2 k, the nearest counts 1, and both directions join."""
    rng = np.random.default_rng(14)
    knn = [(f"n{i:02d}", f"n{j:02d}", float(x)) for i in range(30) for j, x in zip(rng.choice([j for j in range(30) if j != i], 8, replace=False), np.sort(rng.uniform(1, 4, 8)), strict=True)]
    one = {}
    for s in {k[0] for k in knn}:
        d = np.array([x for a, _, x in knn if a == s])
        low, high = 1e-6, 1e3
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (low, mid) if np.exp(-(d - d.min()) / mid).sum() > 3 else (mid, high)
        one |= {(s, t): float(np.exp(-(x - d.min()) / low)) for a, t, x in knn if a == s}
    got = {(r["u"], r["v"]): r["w"] for r in graph.smooth_union(spark.createDataFrame(knn, "src string, dst string, d double")).collect()}
    assert set(got) == {(min(e), max(e)) for e in one}
    for (u, v), w in got.items():
        a, b = one.get((u, v), 0.0), one.get((v, u), 0.0)
        assert w == pytest.approx(a + b - a * b, abs=1e-6)


def test_warp_by_hand(spark):
    from cytogrid.operators import image

    px = spark.createDataFrame([(0, 0, "r", 0.0), (1, 0, "r", 100.0), (0, 1, "r", 50.0), (1, 1, "r", 200.0), (0, 0, "g", 10.0)], "x long, y long, channel string, value double")
    got = {(r["x"], r["y"], r["channel"]): r["value"] for r in image.warp(px, [[0.5, 0, 0], [0, 0.5, 0], [0, 0, 1]], 4, 3).collect()}
    assert len(got) == 24 and got[0, 0, "r"] == 0 and got[1, 0, "r"] == 50 and got[1, 1, "r"] == 87 and got[2, 2, "r"] == 200
    assert got[3, 0, "r"] == 177 and got[0, 0, "g"] == 10 and got[2, 0, "g"] == 255


def test_schema_names_faults_by_key_path():
    s = {
        "type": "object", "required": ["name"], "needs": {"a": ["b"]}, "when": [({"mode": "deep"}, {"required": ["depth"]})],
        "keys": {"name": {"type": "string", "pattern": "^[a-z]+$"}, "a": {"type": "integer", "minimum": 1, "maximum": 9}, "b": {"type": ["number", "null"], "above": 0}, "mode": {"enum": ["flat", "deep"], "default": "flat"}, "depth": {"type": "integer"},
                 "inner": {"type": "object", "default": {}, "keys": {"list": {"type": "array", "least": 2, "unique": True, "items": {"type": "string"}}, "on": {"type": "boolean", "default": True}}}},
    }
    assert schema.checked({"name": "x"}, s) == {"name": "x", "mode": "flat", "inner": {"on": True}}
    assert schema.faults(["x"], s) == ["configuration: ['x'] is not object"]
    got = schema.faults({"name": "X1", "a": 0, "b": 0, "mode": "deep", "inner": {"list": ["p", 3, "p"], "off": 1}}, s)
    assert [g.split(":")[0] for g in got] == ["name", "a", "b", "inner", "inner.list", "inner.list[1]", "depth"]
    assert schema.faults({"name": "x", "a": 12}, s) == ["a: 12 is above 9", "a: goes together with b"] and schema.faults({"name": "", "a": True, "b": 1}, s)[0] == "name: is required"
    assert schema.faults({"name": "x", "inner": {"list": ["p"]}}, s) == ["inner.list: 1 items, at least 2 are needed"]


def test_configuration_files(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"contract": "in", "out": "o", "resolutions": [0.5, 2], "compartments": {"a": ["t"]}}))
    c = workflow.Config.read(spark, str(tmp_path / "c.json"))
    assert c.resolutions == (0.5, 2) and c.compartments == {"a": ("t",)} and c.neighbours == 6
    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text("contract: in\nout: o\nresolutions: [0.5, -1]\nneighbours: many\nmode: cloud\nreference: r\n")
    with pytest.raises(ValueError) as e:
        workflow.Config.read(spark, str(tmp_path / "c.yaml"))
    assert all(x in str(e.value) for x in ("resolutions[1]: -1 is not above 0", "neighbours: 'many' is not integer", "mode: 'cloud' is none of", "reference: goes together with reference_label"))


def png(a, kinds):
    """A PNG file of lines x width x channels, each line under one of the format's filters."""
    h, w, c = a.shape
    raw = np.ascontiguousarray(a.astype(">u2") if a.dtype == np.uint16 else a).view(np.uint8).reshape(h, -1).astype(int)
    step, out = raw.shape[1] // w, b""
    for y in range(h):
        k, line = kinds[y % len(kinds)], raw[y]
        up = raw[y - 1] if y else np.zeros_like(line)
        left, corner = np.concatenate([np.zeros(step, int), line[:-step]]), np.concatenate([np.zeros(step, int), up[:-step]])
        p = left + up - corner
        paeth = np.where((abs(p - left) <= abs(p - up)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - up) <= abs(p - corner), up, corner))
        out += bytes([k]) + ((line - [0, left, up, (left + up) // 2, paeth][k]) % 256).astype(np.uint8).tobytes()
    chunk = lambda n, b: struct.pack(">I", len(b)) + n + b + struct.pack(">I", zlib.crc32(n + b))
    packed = zlib.compress(out)
    head = struct.pack(">IIBBBBB", w, h, 16 if a.dtype == np.uint16 else 8, {1: 0, 3: 2, 2: 4, 4: 6}[c], 0, 0, 0)
    return images.PNG + chunk(b"IHDR", head) + chunk(b"tEXt", b"x") + chunk(b"IDAT", packed[:50]) + chunk(b"IDAT", packed[50:]) + chunk(b"IEND", b"")


def test_images_are_read_back(spark, tmp_path, monkeypatch):
    rng, want = np.random.default_rng(3), {}
    for c, kind in ((1, np.uint8), (2, np.uint8), (3, np.uint8), (4, np.uint16), (1, np.uint16)):
        a = rng.integers(0, np.iinfo(kind).max + 1, (13, 7, c)).astype(kind)
        a[4:9] = a[4]
        want[f"{c}{a.dtype}.png"] = a
        (tmp_path / f"{c}{a.dtype}.png").write_bytes(png(a, [4, 3, 2, 1, 0, 4]))
        assert [y for y, _ in images.png_bands(png(a, [0]), 7 * c * 4)] == [0, 4, 8, 12]
    for name, a in (("flat.npy", rng.normal(0, 1, (5, 6))), ("deep.npy", rng.integers(0, 9, (3, 5, 6)).astype(np.uint16))):
        np.save(tmp_path / name, a)
        want[name] = np.moveaxis(a, 0, 2) if a.ndim == 3 else a[:, :, None]
    got = {n: np.full(a.shape, np.nan) for n, a in want.items()}
    for r in images.pixels(spark, str(tmp_path)).collect():
        got[r["path"].rsplit("/", 1)[1]][r["y"], r["x"], r["channel"]] = r["value"]
    assert all((got[n] == a).all() for n, a in want.items())
    (tmp_path / "bad.png").write_bytes(png(want["1uint8.png"], [0])[:60])
    with pytest.raises(Exception, match="bad.png"):
        images.pixels(spark, str(tmp_path / "bad.png")).count()


def test_files_are_found_at_any_depth(spark, tmp_path):
    (tmp_path / "a/b/c").mkdir(parents=True)
    for f in ("a/x.csv", "a/b/y.csv", "a/b/c/z.txt"):
        (tmp_path / f).write_text("1")
    names = lambda *p: [f.rsplit("/", 1)[1] for f in readers.files_of(spark, *p)]
    assert names(None, f"{tmp_path}/nowhere/**/*.csv", f"{tmp_path}/a/**/*.csv") == ["y.csv", "x.csv"] and names(f"{tmp_path}/a/*.csv") == ["x.csv"]
    assert readers.first_that_has(spark, f"{tmp_path}/**/*.bam", f"{tmp_path}/**/z.*") == f"{tmp_path}/**/z.*" and names(f"{tmp_path}/q") == []


def test_labels_come_from_a_reference(spark, tmp_path):
    rng = np.random.default_rng(5)
    kind = np.arange(40) % 2
    x = rng.poisson(1 + 20 * (np.arange(30)[None, :] % 2 == kind[:, None]))
    def folder(name, sample):
        spark.createDataFrame([(sample, f"c{i:02d}", f"g{j:02d}", int(x[i, j])) for i in range(40) for j in range(30) if x[i, j]], "sample string, cell_id string, gene string, count long").write.parquet(str(tmp_path / name / "counts"))
        spark.createDataFrame([(sample, f"c{i:02d}", float(i), 0.0, "r", f"t{kind[i]}") for i in range(40)], "sample string, cell_id string, x double, y double, region_annotation string, cell_type string").write.parquet(str(tmp_path / name / "cells"))
        spark.createDataFrame([(f"g{j:02d}",) for j in range(30)], "gene string").write.parquet(str(tmp_path / name / "genes"))
        return str(tmp_path / name)
    c = workflow.Config.of({"contract": folder("in", "s"), "out": str(tmp_path / "out"), "reference": folder("ref", "r"), "reference_label": "cell_type", "reference_genes": 20, "components": 4, "graph_neighbours": 5})
    assert set(workflow.run(spark, c, "label_transfer").values()) == {"done"}
    got = {r["id"]: r["label"] for r in spark.read.parquet(str(tmp_path / "out/transferred")).collect()}
    assert got == {f"s|c{i:02d}": f"t{kind[i]}" for i in range(40)}
