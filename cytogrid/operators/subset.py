"""Parts of a sample: groups that are large and mixed enough to test, compartments, and their analysis anew."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytogrid.operators import contract, embed, graph, normalize, qc
from cytogrid.operators.durable import settle


def mixed_groups(cells: DataFrame, by: Sequence[str], label: str, least: int, kinds: int = 2, skip: tuple[str, ...] = ("Unannotated",)) -> DataFrame:
    """Cells with a label outside ``skip``, of the groups that have ``least`` such cells and ``kinds`` labels or more."""
    said = cells.where(F.col(label).isNotNull() & ~F.col(label).isin(*skip))
    ok = said.groupBy(*by).agg(F.count("*").alias("n"), F.count_distinct(label).alias("k")).where((F.col("n") >= least) & (F.col("k") >= kinds))
    return said.join(ok.select(*by), list(by), "left_semi")


def by_region(cells: DataFrame, label: str, region: str = "region_annotation", least: int = 30) -> DataFrame:
    """Cells for tests within regions: each named region of a sample takes the sample's place, as "<sample>|<region>"."""
    named = cells.where(contract.is_label(F.col(region)) & ~F.col(region).isin("Unlabeled", "Bubble"))
    return mixed_groups(named, ["sample", region], label, least).withColumn("sample", F.concat_ws("|", "sample", region))


def compartment(cells: DataFrame, label: str, names: Sequence[str], least: int = 50) -> DataFrame:
    """Cells whose label is one of ``names``, letter by letter; raises where they are fewer than ``least``."""
    out = cells.where(F.col(label).cast("string").isin(*names))
    n = out.count()
    if n < least:
        raise ValueError(f"{n} cells of {', '.join(names)}; at least {least} are needed")
    return out


def pseudo_genes(cells: DataFrame, scores: Sequence[str]) -> DataFrame:
    """Score columns as rows (sample, cell_id, gene, value), so that what draws genes draws scores; nulls are left out."""
    return cells.unpivot(["sample", "cell_id"], [F.col(s).cast("double").alias(s) for s in scores], "gene", "value").where("value IS NOT NULL")


def dense_size(counts: DataFrame, terms: int = 1, most: float = 80.0) -> DataFrame:
    """Per sample: gigabytes that a dense neighbour-augmented matrix of 2 + ``terms`` parts in single precision would take, and whether above ``most``."""
    n = counts.groupBy("sample").agg(F.count_distinct("cell_id").alias("n_cells"), F.count_distinct("gene").alias("n_genes"))
    n = n.withColumn("gigabytes", F.col("n_cells").cast("double") * F.col("n_genes") * (2 + terms) * 4 / 1e9)
    return n.withColumn("too_large", F.col("gigabytes") > most)


def one_sample(cells: DataFrame, columns: Sequence[str], sample: Column, name: str | None = None) -> DataFrame:
    """An annotation table (sample, barcode, columns) of someone else's cells (cell_id and others). ``name`` renames a single column.

    Raises where a column is missing. ``sample`` may be a constant, a column or a part of the file's name.
    """
    if missing := [c for c in columns if c not in cells.columns]:
        raise ValueError(f"no columns {', '.join(missing)}; there are {', '.join(cells.columns)}")
    if name is not None and len(columns) != 1:
        raise ValueError("only a single column can be renamed")
    return cells.select(sample.cast("string").alias("sample"), F.col("cell_id").cast("string").alias("barcode"), *[F.col(c).alias(name or c) for c in columns])


def clusterings(pcs: DataFrame, resolutions: Sequence[float], k: int = 15) -> DataFrame:
    """(id, resolution, res_idx, cluster): one neighbour graph of ``pcs`` (id, v), clustered at each resolution."""
    if not resolutions:
        raise ValueError("no resolution is given")
    steps = sorted(float(r) for r in resolutions)
    found = graph.ladder(settle(graph.fuzzy_union(embed.knn(pcs, pcs, k))), steps)
    return found.select(F.col("node").alias("id"), F.get(F.array(*[F.lit(r) for r in steps]), "res").alias("resolution"), F.col("res").alias("res_idx"), "cluster")


def pcs_of(counts: DataFrame, k: int) -> DataFrame:
    """(id, batch, v) of all cells: normalised counts in their leading components; id is "sample|cell"."""
    values = settle(normalize.log_normalise(counts).select("sample", "cell_id", "gene", "value"))
    got = embed.panel_pcs(values, values.select("gene").distinct(), k)
    return got.select(F.concat_ws("|", "sample", "cell_id").alias("id"), F.col("sample").alias("batch"), F.col("pcs").alias("v"))


def integrated(pcs: DataFrame, groups: int = 8) -> DataFrame:
    """``pcs`` (id, batch, v) with the batches brought together, and status: "corrected", "one batch" where there is nothing to correct,
    or "uncorrected: ..." with the vectors as they were where the regressions have no solution or the result is not finite."""
    if pcs.select("batch").distinct().limit(2).count() < 2:
        return pcs.withColumn("status", F.lit("one batch"))
    try:
        fixed = embed.harmonise(pcs, groups)
    except np.linalg.LinAlgError as e:
        return pcs.withColumn("status", F.lit(f"uncorrected: {e}"))
    if not fixed.where(F.exists("v", lambda x: F.isnan(x) | (F.abs(x) == float("inf")))).isEmpty():
        return pcs.withColumn("status", F.lit("uncorrected: not finite"))
    return fixed.withColumn("status", F.lit("corrected"))


def sketched(pcs: DataFrame, share: float = 0.1, resolution: float = 0.5, k: int = 15, least: int = 100) -> DataFrame:
    """(id, cluster, share, drawn): an evenly spread sketch of ``pcs`` (id, v) is clustered, and every other cell takes the most frequent cluster of its
    k nearest in the sketch, with its share among them.

    The sketch has ``share`` of the cells, at least ``least``; its boxes are the narrowest that it can all meet. Only the sketch meets itself in a graph.
    """
    n = max(least, int(pcs.count() * share))
    drawn = settle(embed.sketch(pcs.select("id", "v"), n, embed.box_size(pcs, n)).where("kept").select("id", "v"))
    own = settle(clusterings(drawn, [resolution], k).select("id", "cluster"))
    rest = settle(pcs.select("id", "v").join(drawn.select("id"), "id", "left_anti"))
    taken = embed.transfer_labels(rest, settle(drawn.join(own, "id")), k, "cluster")
    return own.select("id", "cluster", F.lit(1.0).alias("share"), F.lit(True).alias("drawn")).unionByName(taken.select("id", F.col("label").alias("cluster"), "share", F.lit(False).alias("drawn")))


def reanalyse(counts: DataFrame, cells: DataFrame, label: str, names: Sequence[str], resolutions: Sequence[float], pcs: int = 30, k: int = 15, mito: tuple[str, ...] = ("MT-", "mt-"), least: int = 50) -> dict[str, DataFrame]:
    """A compartment on its own: its qc metrics, its components without and with batch correction, and the clusterings of each.

    Returns qc (of its cells), pcs (branch, id, batch, v) and clusters (branch, id, resolution, res_idx, cluster); branches are "plain" and "corrected",
    the second only where there are several batches.
    """
    part = settle(counts.join(compartment(cells, label, names, least).select("sample", "cell_id"), ["sample", "cell_id"], "left_semi"))
    plain = settle(pcs_of(part, pcs))
    fixed = settle(integrated(plain))
    branches = {"plain": plain}
    if not fixed.where("status = 'corrected'").isEmpty():
        branches["corrected"] = fixed.drop("status")
    named = {b: t.select(F.lit(b).alias("branch"), "*") for b, t in branches.items()}
    found = {b: clusterings(t.select("id", "v"), resolutions, k).select(F.lit(b).alias("branch"), "*") for b, t in branches.items()}
    return {"qc": qc.cell_metrics(part, mito), "pcs": reduce(DataFrame.unionByName, named.values()), "clusters": reduce(DataFrame.unionByName, found.values())}

