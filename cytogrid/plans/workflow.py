"""Configuration and the named targets: which tables a run makes, from a contract folder to its results.

A configuration is a mapping, or a YAML or JSON file of one; unknown keys, wrong values and contradictions stop a run before any job, each named by its key. A target is a list of steps;
each step reads tables by name and gives one or several, and per-sample work is a grouping column, not a job. What a configuration has no input for is skipped and
says why; what reads a step that did not end well is blocked by it, and the rest goes on.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, fields
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytogrid.operators import annotate, branches, compose, contract, de, embed, markers, nbinom, normalize, pseudobulk, qc, signatures, spatial, subset
from cytogrid.operators.durable import settle
from cytogrid.plans import schema
from cytogrid.sources import readers

#: What tells the clusterings of compartments apart.
BRANCH = ("compartment", "branch", "resolution")
MODES = ("decoupled", "visium_hd", "xenium", "atera", "merscope")


@dataclass(frozen=True)
class Config:
    contract: str
    out: str
    mode: str = "decoupled"
    mito_prefixes: tuple[str, ...] = ("MT-", "mt-")
    min_counts: float | None = 10.0
    max_counts: float | None = None
    min_genes: float | None = 5.0
    min_cells: float | None = 3.0
    max_pct_mt: float | None = None
    cell_type: str = "cell_type"
    condition: str = "region_annotation"
    external_labels: str | None = None
    external_label_column: str | None = None
    neighbours: int = 6
    pseudobulk_min_cells: int = 10
    pseudobulk_min_counts: int = 1000
    min_replicates: int = 2
    components: int = 30
    graph_neighbours: int = 15
    resolutions: tuple[float, ...] = (0.5, 1.0)
    integrated_resolution: float = 0.5
    batch_groups: int = 8
    distance_step: float = 20.0
    distance_bins: int = 5
    gene_lists: str | None = None
    reference: str | None = None
    reference_label: str | None = None
    reference_genes: int = 100
    compartments: dict[str, tuple[str, ...]] = field(default_factory=dict)
    compartment_least: int = 50
    marker_genes: int = 10
    sketch_share: float = 0.1
    skip: tuple[str, ...] = field(default=())

    @classmethod
    def of(cls, raw: dict) -> Config:
        good = schema.checked(raw, SCHEMA)
        if bad := sorted(set(good.get("skip", ())) - set(STEPS)):
            raise ValueError(f"skip: no such steps: {', '.join(bad)}")
        lists = lambda v: tuple(v) if isinstance(v, list) else {k: tuple(x) for k, x in v.items()} if isinstance(v, dict) else v
        return cls(**{k: lists(v) for k, v in good.items()})

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Config:
        return cls.of(schema.read(spark, path))


def _schema() -> dict:
    """The schema of Config: kinds and defaults come from its fields, ranges and what goes together from here."""
    text, count, share, whole = {"type": ["string", "null"]}, {"type": "integer", "minimum": 1}, {"type": ["number", "null"], "minimum": 0}, {"type": "string", "pattern": r"\S"}
    names = {"type": "array", "items": {"type": "string"}, "unique": True}
    keys = {
        "contract": whole, "out": whole, "mode": {"type": "string", "enum": MODES}, "mito_prefixes": names, "cell_type": whole, "condition": whole, "skip": names, "gene_lists": text,
        "min_counts": share, "max_counts": share, "min_genes": share, "min_cells": share, "max_pct_mt": {**share, "maximum": 100}, "external_labels": text, "external_label_column": text,
        "resolutions": {"type": "array", "items": {"type": "number", "above": 0}, "least": 1, "unique": True}, "integrated_resolution": {"type": "number", "above": 0}, "distance_step": {"type": "number", "above": 0},
        "sketch_share": {"type": "number", "above": 0, "maximum": 1},
        "compartments": {"type": "object", "others": {**names, "least": 1}}, "reference": text, "reference_label": text,
    }
    keys |= {f.name: count for f in fields(Config) if f.name not in keys}
    return {"type": "object", "keys": keys, "required": ["contract", "out"], "needs": {"external_labels": ["external_label_column"], "external_label_column": ["external_labels"], "reference": ["reference_label"], "reference_label": ["reference"]}}


SCHEMA = _schema()


def _gate(t: dict[str, DataFrame], c: Config) -> DataFrame:
    checks = contract.hard_checks(t["counts"], t["cells"])
    contract.require(checks, contract.passed(), "the contract's checks failed")
    return checks


def _filtered(t: dict[str, DataFrame], c: Config) -> DataFrame:
    if c.external_labels:
        labels = t["cells"].where(contract.is_label(F.col(c.external_label_column)))
        return qc.annotated_only(t["counts"], labels)
    limits = {k: getattr(c, k) for k in ("min_counts", "max_counts", "min_cells", "min_genes", "max_pct_mt")}
    rows = t["cells"].select("sample").distinct().withColumns({k: F.lit(v).cast("double") for k, v in limits.items()})
    return qc.filter_chain(t["counts"], rows, c.mito_prefixes)


def _enrichment(t: dict[str, DataFrame], c: Config) -> DataFrame:
    cells = subset.mixed_groups(t["cells"], ["sample"], c.cell_type, 50)
    return spatial.enrichment(spatial.undirected(spatial.knn(cells, c.neighbours)), cells, c.cell_type)


def _region_enrichment(t: dict[str, DataFrame], c: Config) -> DataFrame:
    cells = settle(subset.by_region(t["cells"], c.cell_type, c.condition))
    return spatial.enrichment(spatial.undirected(spatial.knn(cells, c.neighbours)), cells, c.cell_type)


def _niche_pcs(t: dict[str, DataFrame], c: Config) -> DataFrame:
    """Cells in the components of their own and their neighbours' expression, batches brought together."""
    wide = settle(spatial.neighbour_features(t["normalised"], t["neighbours"]))
    parts = ("own", "neighbour_mean", "gradient")
    long = wide.unpivot(["sample", "cell_id", "gene"], list(parts), "part", "value").where("value <> 0").select("sample", "cell_id", F.concat_ws("|", "part", "gene").alias("gene"), "value")
    pcs = embed.panel_pcs(settle(long), long.select("gene").distinct(), c.components)
    return subset.integrated(settle(pcs.select(F.concat_ws("|", "sample", "cell_id").alias("id"), F.col("sample").alias("batch"), F.col("pcs").alias("v"))), c.batch_groups)


def _niches(t: dict[str, DataFrame], c: Config) -> DataFrame:
    """(sample, cell_id, resolution, niche, niche_raw): clusters of niche_pcs, smoothed over the cells' neighbours."""
    found = settle(subset.clusterings(t["niche_pcs"].select("id", "v"), c.resolutions, c.graph_neighbours))
    cells = t["cells"].select("sample", "cell_id", F.concat_ws("|", "sample", "cell_id").alias("id"))
    out = []
    for r in sorted(c.resolutions):
        labels = settle(cells.join(found.where(F.col("resolution") == float(r)).select("id", F.col("cluster").alias("niche")), "id").drop("id"))
        out.append(spatial.refine(labels, t["neighbours"], "niche").withColumn("resolution", F.lit(float(r))))
    return reduce(DataFrame.unionByName, out)


def _de(t: dict[str, DataFrame], c: Config) -> DataFrame:
    """Tests of the conditions that have enough pseudobulks, with p-values adjusted within each contrast."""
    by = ["sample", c.condition]
    kept = settle(pseudobulk.expressed(pseudobulk.replicate_gate(t["pseudobulk"], by, c.condition, c.min_replicates)))
    levels = sorted(r[0] for r in kept.select(c.condition).distinct().collect())  # the names of conditions
    if len(levels) < 2:
        raise ValueError(f"{len(levels)} conditions with {c.min_replicates} pseudobulks; two are needed")
    b = settle(pseudobulk.completed(kept, by).withColumn("bulk", F.concat_ws("|", *by)))
    return nbinom.nb_tests(b, pseudobulk.size_factors(b, "bulk"), "bulk", c.condition, levels)


def _pattern_groups(t: dict[str, DataFrame], c: Config) -> DataFrame:
    """Genes whose conditions differ as a whole, grouped by their profile over the conditions."""
    by = ["sample", c.condition]
    kept = settle(pseudobulk.expressed(pseudobulk.replicate_gate(t["pseudobulk"], by, c.condition, c.min_replicates)))
    b = settle(pseudobulk.completed(kept, by).withColumn("bulk", F.concat_ws("|", *by)))
    levels = sorted(r[0] for r in kept.select(c.condition).distinct().collect())  # the names of conditions
    values = nbinom.stabilised(b, pseudobulk.size_factors(b, "bulk"), "bulk", c.condition, levels)
    return de.pattern_groups(values, t["de"].where("lr_padj < 0.05 AND NOT endswith(contrast, '_vs_rest')"), c.condition)


def _transferred(t: dict[str, DataFrame], c: Config) -> DataFrame:
    """(id, label, share): labels of a reference contract's cells taken over by the nearest cells here."""
    ref = readers.read_contract(t["normalised"].sparkSession, str(c.reference))
    labels = ref["cells"].select("sample", "cell_id", F.col(str(c.reference_label)).alias("label")).where(contract.is_label(F.col("label")))
    return embed.transfer_by_genes(t["normalised"], normalize.log_normalise(ref["counts"], 1e4), labels, c.components, c.graph_neighbours, c.reference_genes)


def _signatures(t: dict[str, DataFrame], c: Config) -> DataFrame:
    genes = t["normalised"].select("gene").distinct()
    lists = signatures.present(readers.gene_lists(t["normalised"].sparkSession, str(c.gene_lists)), genes)
    return signatures.aucell(t["normalised"], lists.select(F.col("entry").alias("source"), F.col("gene").alias("target")), genes.count())


def _subclusters(t: dict[str, DataFrame], c: Config) -> dict[str, DataFrame]:
    """Every compartment from its own counts: subclusters (compartment, branch, id, resolution, res_idx, cluster), subcluster_pcs (compartment, branch, id, batch, v)
    and subcluster_qc (compartment, sample, cell_id, metrics)."""
    out: dict[str, list[DataFrame]] = {"subclusters": [], "subcluster_pcs": [], "subcluster_qc": []}
    for name, labels in sorted(c.compartments.items()):
        got = subset.reanalyse(t["filtered"], t["cells"], c.cell_type, labels, c.resolutions, c.components, c.graph_neighbours, c.mito_prefixes, c.compartment_least)
        part = t["filtered"].join(subset.compartment(t["cells"], c.cell_type, labels, c.compartment_least).select("sample", "cell_id"), ["sample", "cell_id"], "left_semi")
        for key, df in zip(out, (got["clusters"], got["pcs"], branches.cell_qc(part, c.mito_prefixes)), strict=True):
            out[key].append(df.select(F.lit(name).alias("compartment"), "*"))
    return {key: reduce(DataFrame.unionByName, dfs) for key, dfs in out.items()}


def _placed(t: dict[str, DataFrame], *columns: str) -> DataFrame:
    """subclusters with their cells' sample, cell_id and ``columns``."""
    return t["subclusters"].join(t["cells"].select(F.concat_ws("|", "sample", "cell_id").alias("id"), "sample", "cell_id", *columns), "id")


def _subcluster_silhouettes(t: dict[str, DataFrame], c: Config) -> DataFrame:
    """(compartment, branch, id, resolution, cluster, silhouette)"""
    out = []
    for name, branch in sorted((r[0], r[1]) for r in t["subclusters"].select("compartment", "branch").distinct().collect()):  # names of the configuration
        own = (F.col("compartment") == name) & (F.col("branch") == branch)
        out.append(branches.silhouettes(t["subcluster_pcs"].where(own), t["subclusters"].where(own)).select(F.lit(name).alias("compartment"), F.lit(branch).alias("branch"), "*"))
    return reduce(DataFrame.unionByName, out)


def _subcluster_tree(t: dict[str, DataFrame], c: Config) -> DataFrame:
    """(compartment, branch, res_idx, from, to, n, share)"""
    return compose.cluster_tree(t["subclusters"], "id", ("compartment", "branch"))


def _subcluster_metrics(t: dict[str, DataFrame], c: Config) -> DataFrame:
    rows = _placed(t).join(t["subcluster_qc"], ["compartment", "sample", "cell_id"])
    return branches.metric_distribution(rows, BRANCH, "cluster")


def _subcluster_markers(t: dict[str, DataFrame], c: Config) -> DataFrame:
    """(compartment, branch, resolution, cluster, gene, rank, score, ..., mean, fraction, scaled): best genes of each cluster, of clusterings that have several."""
    rows = settle(_placed(t))
    several = rows.groupBy(*BRANCH).agg(F.count_distinct("cluster").alias("k")).where("k > 1").select(*BRANCH)
    rows = rows.join(F.broadcast(several), list(BRANCH), "left_semi")
    top = settle(markers.top_markers(markers.rank_sum(t["normalised"], rows, "cluster", BRANCH), "cluster", c.marker_genes, BRANCH))
    values = t["normalised"].join(F.broadcast(top.select("gene").distinct()), "gene", "left_semi")
    dots = markers.dot_stats(values, rows, F.col("cluster"), "cluster", BRANCH)
    return top.join(dots, [*BRANCH, "cluster", "gene"])


def _subcluster_composition(t: dict[str, DataFrame], c: Config) -> DataFrame:
    return branches.compositions(_placed(t, c.condition, c.cell_type), BRANCH, "cluster", ("sample", c.condition, c.cell_type))


def _subcluster_counts(t: dict[str, DataFrame], c: Config) -> DataFrame:
    return branches.middle_counts(_placed(t, c.condition, c.cell_type), ("compartment", "branch"), "cluster", ("sample", c.condition, c.cell_type))


#: name -> step(tables so far, config); in an order in which each finds what it reads.
STEPS: dict[str, Callable[[dict[str, DataFrame], Config], DataFrame | dict[str, DataFrame]]] = {
    "validation": _gate,
    "qc_metrics": lambda t, c: qc.cell_metrics(t["counts"], c.mito_prefixes),
    "qc_report": lambda t, c: qc.report(t["qc_metrics"], ("total_counts", "n_genes_by_counts", "pct_counts_mt")),
    "filtered": _filtered,
    "normalised": lambda t, c: normalize.log_normalise(t["filtered"]),
    "variable_genes": lambda t, c: normalize.highly_variable(t["normalised"], t["cells"].agg(F.count("*").alias("n_cells"))),
    "pcs": lambda t, c: subset.pcs_of(t["filtered"], c.components),
    "clusters": lambda t, c: subset.clusterings(t["pcs"].select("id", "v"), c.resolutions, c.graph_neighbours),
    "cluster_tree": lambda t, c: compose.cluster_tree(t["clusters"], "id"),
    "integrated": lambda t, c: subset.integrated(t["pcs"], c.batch_groups),
    "integrated_clusters": lambda t, c: subset.clusterings(t["integrated"].select("id", "v"), [c.integrated_resolution], c.graph_neighbours),
    "sketch_clusters": lambda t, c: subset.sketched(t["pcs"], c.sketch_share, c.integrated_resolution, c.graph_neighbours),
    "neighbours": lambda t, c: spatial.knn(t["cells"], c.neighbours),
    "enrichment": _enrichment,
    "region_enrichment": _region_enrichment,
    "co_occurrence": lambda t, c: spatial.co_occurrence(t["cells"], c.cell_type, c.distance_step, c.distance_bins),
    "region_co_occurrence": lambda t, c: spatial.co_occurrence(settle(subset.by_region(t["cells"], c.cell_type, c.condition)), c.cell_type, c.distance_step, c.distance_bins),
    "niche_pcs": _niche_pcs,
    "niches": _niches,
    "composition": lambda t, c: compose.row_percent(compose.crosstab(t["cells"], "sample", c.cell_type), "sample"),
    "markers": lambda t, c: markers.top_markers(markers.rank_sum(t["normalised"], t["cells"], c.cell_type), c.cell_type, 10),
    "dotplot": lambda t, c: markers.dot_stats(t["normalised"], t["cells"], F.col(c.cell_type)),
    "signatures": _signatures,
    "transferred": _transferred,
    "majority": lambda t, c: annotate.majority_vote(t["cells"], c.condition, c.cell_type),
    "pseudobulk": lambda t, c: pseudobulk.aggregate(t["filtered"], pseudobulk.regions_only(t["cells"], c.condition), ["sample", c.condition], c.pseudobulk_min_cells, c.pseudobulk_min_counts),
    "de": _de,
    "de_summary": lambda t, c: de.summary(t["de"], "contrast"),
    "pattern_groups": _pattern_groups,
    "subclusters": _subclusters,
    "subcluster_silhouettes": _subcluster_silhouettes,
    "subcluster_tree": _subcluster_tree,
    "subcluster_metrics": _subcluster_metrics,
    "subcluster_markers": _subcluster_markers,
    "subcluster_composition": _subcluster_composition,
    "subcluster_counts": _subcluster_counts,
}
#: What a step reads of other steps.
READS = {
    "qc_report": ("qc_metrics",),
    "filtered": ("validation",),
    "normalised": ("filtered",),
    "variable_genes": ("normalised",),
    "pcs": ("filtered",),
    "clusters": ("pcs",),
    "cluster_tree": ("clusters",),
    "integrated": ("pcs",),
    "integrated_clusters": ("integrated",),
    "niche_pcs": ("normalised", "neighbours"),
    "niches": ("niche_pcs", "neighbours"),
    "markers": ("normalised",),
    "dotplot": ("normalised",),
    "signatures": ("normalised",),
    "transferred": ("normalised",),
    "pseudobulk": ("filtered",),
    "de": ("pseudobulk",),
    "de_summary": ("de",),
    "pattern_groups": ("pseudobulk", "de"),
    "subclusters": ("filtered",),
    "sketch_clusters": ("pcs",),
    "subcluster_silhouettes": ("subclusters",),
    "subcluster_tree": ("subclusters",),
    "subcluster_metrics": ("subclusters",),
    "subcluster_markers": ("subclusters", "normalised"),
    "subcluster_composition": ("subclusters",),
    "subcluster_counts": ("subclusters",),
}
#: Steps that need something of the configuration.
NEEDS: dict[str, tuple[str, Callable[[Config], bool]]] = {
    "signatures": ("no gene lists", lambda c: c.gene_lists is not None),
    "transferred": ("no reference", lambda c: c.reference is not None),
    "subclusters": ("no compartments", lambda c: bool(c.compartments)),
    "cluster_tree": ("one resolution", lambda c: len(c.resolutions) > 1),
    "subcluster_tree": ("one resolution", lambda c: len(c.resolutions) > 1),
}
TARGETS = {
    "run_preprocessing": ("validation", "qc_metrics", "qc_report", "filtered", "normalised", "variable_genes", "pcs", "clusters", "cluster_tree"),
    "run_postprocessing": ("integrated", "integrated_clusters", "sketch_clusters", "enrichment", "region_enrichment", "co_occurrence", "region_co_occurrence", "niches", "composition", "markers", "majority", "de", "de_summary", "pattern_groups"),
    "run_exploration": ("dotplot",),
    "explore_genes": ("dotplot", "signatures"),
    "label_transfer": ("transferred",),
    "subcluster_all": ("subclusters", "subcluster_silhouettes", "subcluster_tree", "subcluster_metrics", "subcluster_markers", "subcluster_composition", "subcluster_counts"),
    "qc_sweep_all": ("qc_metrics", "qc_report"),
}
TARGETS["all"] = tuple(STEPS)


def needed(target: str) -> list[str]:
    """The steps of a target and those that they read, in order."""
    want, stack = set(), list(TARGETS[target])
    while stack:
        s = stack.pop()
        if s not in want:
            want.add(s)
            stack += READS.get(s, ())
    return [s for s in STEPS if s in want]


def run(spark: SparkSession, config: Config, target: str = "all") -> dict[str, str]:
    """Make a target's tables under config.out, and "status" (step, status, reason): done, skipped, blocked by a step that it reads, or failed.

    Returns step -> status, with the reason behind a colon. A failed gate stops what follows.
    """
    t = readers.read_contract(spark, config.contract)
    status: dict[str, tuple[str, str]] = {}
    for name in needed(target):
        lacking = next((r for r in READS.get(name, ()) if status[r][0] != "done"), None)
        if name in config.skip:
            status[name] = ("skipped", "by configuration")
        elif name in NEEDS and not NEEDS[name][1](config):
            status[name] = ("skipped", NEEDS[name][0])
        elif lacking is not None:
            status[name] = ("blocked", lacking)
        else:
            try:
                made = STEPS[name](t, config)
                for key, df in (made if isinstance(made, dict) else {name: made}).items():
                    df.write.mode("overwrite").parquet(f"{config.out}/{key}")
                    t[key] = spark.read.parquet(f"{config.out}/{key}")
                status[name] = ("done", "")
            except Exception as e:  # one step's failure is its own; those that read it are blocked
                status[name] = ("failed", f"{type(e).__name__}: {str(e)[:200]}")
                if name == "validation":
                    break
    spark.createDataFrame([(k, *v) for k, v in status.items()], "step string, status string, reason string").coalesce(1).write.mode("overwrite").parquet(f"{config.out}/status")
    return {k: f"{a}: {b}" if b else a for k, (a, b) in status.items()}
