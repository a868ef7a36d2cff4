"""Differential expression over pseudobulks: contrasts, Welch tests, classes, unique markers and patterns; negative-binomial tests are in nbinom."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytogrid.operators.durable import settle

#: Stands for the mean of a level in which a gene was not counted at all.
ZERO_MEAN = 0.5


def contrasts(levels: DataFrame, level: str) -> DataFrame:
    """All unordered pairs of levels (a before b)."""
    a, b = levels.select(F.col(level).alias("a")).distinct(), levels.select(F.col(level).alias("b")).distinct()
    return a.join(b, F.col("a") < F.col("b")).withColumn("contrast", F.concat_ws("_vs_", "a", "b"))


def mean_ratios(norm: DataFrame, level: str) -> DataFrame:
    """(gene, a, b, contrast, log2fc) from mean normalised counts of two levels; a mean of 0 counts as ZERO_MEAN, and two of them as no ratio."""
    m = norm.groupBy("gene", level).agg(F.avg("norm").alias("m"))
    pairs = contrasts(norm, level)
    x = F.broadcast(pairs).join(m.select(F.col(level).alias("a"), "gene", F.col("m").alias("ma")), "a").join(m.select(F.col(level).alias("b"), "gene", F.col("m").alias("mb")), ["b", "gene"])
    floor = lambda m: F.when(F.col(m) > 0, F.col(m)).otherwise(F.lit(ZERO_MEAN))
    return x.select("gene", "a", "b", "contrast", F.when((F.col("ma") > 0) | (F.col("mb") > 0), F.log2(floor("ma") / floor("mb"))).alias("log2fc"))


#: Coefficients of a rational approximation of erfc, right to 1.5e-7.
ERFC = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def normal_tails(z: Column) -> Column:
    """P(|N| > |z|) by a polynomial, in built-in functions."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    return F.exp(-x * x) * sum((c * F.pow(t, F.lit(float(k + 1))) for k, c in enumerate(ERFC)), F.lit(0.0))


def welch(values: DataFrame, level: str, value: str = "value") -> DataFrame:
    """(gene, a, b, contrast, stat, p) of every pair of levels: Welch's statistic of the pseudobulks' values, its p from the normal tails; null without spread or with one pseudobulk."""
    m = values.groupBy("gene", level).agg(F.avg(value).alias("m"), F.var_samp(value).alias("v"), F.count("*").alias("n"))
    side = lambda x: m.select("gene", F.col(level).alias(x), *[F.col(c).alias(f"{c}{x}") for c in "mvn"])
    met = side("a").join(side("b"), "gene").where("a < b")
    z = F.try_divide(F.col("ma") - F.col("mb"), F.sqrt(F.col("va") / F.col("na") + F.col("vb") / F.col("nb")))
    return met.select("gene", "a", "b", F.concat_ws("_vs_", "a", "b").alias("contrast"), z.alias("stat"), normal_tails(z).alias("p"))


def classes(stats: DataFrame, padj: float = 0.05, lfc: float = 0.25) -> DataFrame:
    """Rows with p and fold change, their class (Up, Down, NS) and -log10 of the adjusted p."""
    c = F.when(F.col("padj") >= padj, "NS").when(F.col("log2fc") > lfc, "Up").when(F.col("log2fc") < -lfc, "Down").otherwise("NS")
    return stats.where("padj is not null and log2fc is not null").withColumn("class", c).withColumn("neg_log10", -F.log10(F.greatest("padj", F.lit(1e-300))))


def summary(stats: DataFrame, by: str, padj: float = 0.05, lfc: float = 0.25) -> DataFrame:
    sig = F.col("padj") < padj
    return stats.groupBy(by).agg(
        F.count("padj").alias("n_tested"), F.count_if(sig).alias("n_significant"), F.count_if(sig & (F.col("log2fc") > lfc)).alias("n_up"), F.count_if(sig & (F.col("log2fc") < -lfc)).alias("n_down")
    )


def labels_up_down(classed: DataFrame, by: str, n: int = 10) -> DataFrame:
    """The ``n`` largest rises and falls of each group, with side and rank."""
    up = Window.partitionBy(by).orderBy(F.desc("log2fc"), "gene")
    down = Window.partitionBy(by).orderBy("log2fc", "gene")
    pick = lambda cls, w: classed.where(F.col("class") == cls).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).withColumn("side", F.lit(cls))
    return pick("Up", up).unionByName(pick("Down", down))


def heatmap_genes(stats: DataFrame, by: str, n: int, padj: float = 0.05, compat: bool = False) -> DataFrame:
    """Significant genes for a heatmap: the ``n`` largest rises and falls. ``compat``: of the falls the least negative ones,
    as a table sorted by falling fold change gives them first."""
    sig = stats.where(F.col("padj") < padj)
    up = Window.partitionBy(by).orderBy(F.desc("log2fc"), "gene")
    down = Window.partitionBy(by).orderBy(F.desc("log2fc") if compat else F.asc("log2fc"), "gene")
    pick = lambda cond, w, side: sig.where(cond).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).withColumn("side", F.lit(side))
    return pick("log2fc > 0", up, "up").unionByName(pick("log2fc < 0", down, "down"))


def unique_markers(stats: DataFrame, level: str, padj: float = 0.05, lfc: float = 0.25) -> DataFrame:
    """(level, gene) raised in that level and in no other."""
    up = stats.where((F.col("padj") < padj) & (F.col("log2fc") > lfc)).select(level, "gene").distinct()
    other = up.withColumnRenamed(level, "__o")
    return up.join(other, (up["gene"] == other["gene"]) & (up[level] != other["__o"]), "left_anti")


def ragged(markers: DataFrame, level: str, levels: list[str]) -> DataFrame:
    """One column per level, genes in order of name, nulls below the shorter lists."""
    r = markers.withColumn("row", F.row_number().over(Window.partitionBy(level).orderBy("gene")))
    return r.groupBy("row").pivot(level, levels).agg(F.first("gene"))


def chi2_tail(x: float, df: int) -> float:
    """P(chi-squared with ``df`` degrees > x), by the finite sums that whole degrees have."""
    x = max(x, 0.0)
    odd = df % 2
    term = math.sqrt(2 * x / math.pi) * math.exp(-x / 2) if odd else math.exp(-x / 2)
    total = math.erfc(math.sqrt(x / 2)) if odd else term
    for k in range(1, (df + 1) // 2):
        if not odd:
            term *= x / (2 * k)
            total += term
        else:
            total += term
            term *= x / (2 * k + 1)
    return min(1.0, total)


def patterns(z: DataFrame, level: str, least: int = 10) -> DataFrame:
    """(gene, pattern, group): genes grouped by the order of their levels' mean z-scores, groups of ``least`` genes or more, numbered from 1."""
    m = z.groupBy("gene", level).agg(F.round(F.avg("z"), 6).alias("m"))
    p = m.groupBy("gene").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("m")).alias("m"), F.col(level).alias("l")))), lambda s: s["l"]), ">").alias("pattern"))
    enough = p.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    # a row per pattern
    number = enough.select("pattern", F.dense_rank().over(Window.orderBy(F.desc("n"), "pattern")).alias("group"))
    return p.join(F.broadcast(number), "pattern").select("gene", "pattern", "group")


def pattern_groups(values: DataFrame, genes: DataFrame, level: str, cut: float = 0.7, least: int = 15, enough: int = 10, rounds: int = 100) -> DataFrame:
    """(gene, group): the given genes by how they rise and fall over the levels, groups of ``least`` genes or more, numbered from 1 by falling size.

    A gene's profile is the order of its levels' mean values; the distance of two genes is 1 less Kendall's correlation (ties counted) of their profiles. Divisive clustering: a group in which two
    profiles are farther apart than ``cut`` is split. The profile farthest on average from the rest founds a splinter, and those nearer on average to the splinter than to what is left
    go over until none is. Genes of one order are one weighted row, all groups are split in one set of rounds, and since a correlation is a product of scaled signs, the mean distance to a set is
    that to its sum. The widest pair of a group is looked for between its distinct profiles. Fewer than ``enough`` genes give no groups; genes without any order are left out.
    """
    m = values.join(genes.select("gene").distinct(), "gene", "left_semi").groupBy("gene", level).agg(F.round(F.avg("value"), 9).alias("m"))
    rows = m.groupBy("gene").agg(F.array_sort(F.collect_list(F.struct(F.col(level).alias("l"), "m"))).alias("p")).select("gene", F.col("p.m").alias("m"))
    signs = F.flatten(F.transform("m", lambda x, i: F.transform(F.slice("m", i + 2, F.size("m")), lambda y: F.signum(x - y))))
    rows = rows.withColumn("s", signs).withColumn("ties", F.sqrt(F.aggregate("s", F.lit(0.0), lambda a, x: a + x * x))).where("ties > 0")
    rows = settle(rows.select("gene", F.concat_ws(",", F.transform("s", lambda x: x.cast("int").cast("string"))).alias("profile"), F.transform("s", lambda x: x / F.col("ties")).alias("u")))
    if rows.count() < enough:
        return rows.select("gene", F.lit(0).alias("group")).where("false")
    now = settle(rows.groupBy("profile").agg(F.count("*").cast("double").alias("n"), F.first("u").alias("u")).withColumn("group", F.lit("")))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    size = len(now.first()["u"])
    total = lambda by: by.agg(F.sum("n").alias("all"), F.array(*[F.sum(F.col("n") * F.get("u", F.lit(i))) for i in range(size)]).alias("sum"))
    for _ in range(rounds):
        a = now.select("group", "u")
        wide = a.join(a.select("group", F.col("u").alias("w")), "group").groupBy("group").agg(F.max(1 - dot(F.col("u"), F.col("w"))).alias("d")).where(F.col("d") > cut + 1e-9)
        split = settle(now.join(wide.select("group"), "group"))
        if split.isEmpty():
            break
        # the mean distance to genes of other profiles
        away = (F.col("all") - dot(F.col("u"), F.col("sum"))) / (F.col("all") - F.col("n"))
        founder = split.join(total(split.groupBy("group")), "group").groupBy("group").agg(F.max_by("profile", F.struct(F.round(away, 9), "profile")).alias("f"))
        part = settle(split.join(founder, "group").select("group", "profile", "n", "u", (F.col("profile") == F.col("f")).alias("out")))
        for _ in range(rounds):
            t = total(part.groupBy("group", "out"))
            inner, outer = (t.where(F.col("out") == o).select("group", F.col("all").alias(f"all{k}"), F.col("sum").alias(f"sum{k}")) for o, k in ((False, "i"), (True, "o")))
            met = part.join(inner, "group").join(outer, "group")
            left = F.try_divide(F.col("alli") - dot(F.col("u"), F.col("sumi")), F.col("alli") - F.col("n"))
            gone = (1 - dot(F.col("u"), F.col("sumo")) / F.col("allo")) < left - 1e-9
            step = settle(met.select("group", "profile", "n", "u", "out", (~F.col("out") & (F.col("alli") > F.col("n")) & gone).alias("goes")))
            if step.where("goes").isEmpty():
                break
            part = step.select("group", "profile", "n", "u", (F.col("out") | F.col("goes")).alias("out"))
        else:
            raise RuntimeError(f"profiles still move after {rounds} rounds")
        named = part.select("profile", "n", "u", F.concat("group", F.when(F.col("out"), "1").otherwise("0")).alias("group"))
        now = settle(now.join(wide.select("group"), "group", "left_anti").select("profile", "n", "u", "group").unionByName(named))
    else:
        raise RuntimeError(f"groups are still wide after {rounds} rounds")
    found = rows.select("gene", "profile").join(now.select("profile", F.col("group").alias("g")), "profile")
    kept = found.groupBy("g").agg(F.count("*").alias("n"), F.min("gene").alias("first")).where(F.col("n") >= least)
    # a row per group
    number = kept.select("g", F.row_number().over(Window.orderBy(F.desc("n"), "first")).alias("group"))
    return found.join(number, "g").select("gene", "group")
