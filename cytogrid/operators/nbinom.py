"""Negative-binomial tests of pseudobulks with dispersions by likelihood.

Per gene: a dispersion that maximises the Cox-Reid adjusted profile likelihood; over all genes a trend a0 + a1 / mean, fitted as a gamma regression that
leaves outliers out; per gene again the maximum of likelihood times a log-normal prior around the trend, unless the gene lies far above it. With that,
the levels' means are fitted, contrasts get Wald tests and the factor a likelihood-ratio test. Counts with a large Cook's distance are replaced where a level has
enough pseudobulks, and the gene is fitted again; otherwise its p-value is null. Adjusted p-values come after a filter on the mean that the
rejections themselves choose; they are null below it.

A gene is a row with its counts in order of pseudobulk, and many genes are worked on at once in each Arrow batch. Designs are one factor: all levels, and
each level against the rest, refitted with two levels; they are rows too, so the trends of all designs are found in one set of aggregates. What reaches the driver are
the pseudobulks' names, levels and size factors, and a few numbers per design.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytogrid.operators.de import chi2_tail
from cytogrid.operators.durable import settle

#: Fixed values of the method: least dispersion and mean, Cook's quantile, replicates for a Cook's distance and for a replacement.
LEAST_DISPERSION, LEAST_MEAN, COOKS, FOR_COOKS, FOR_REPLACEMENT = 1e-8, 0.5, 0.99, 3, 7
#: Trimmed shares and the scales that make a trimmed variance that of a normal sample, up to 3, up to 23 and more values.
TRIMS = ((3, 1 / 3, 2.04), (23, 1 / 4, 1.86), (math.inf, 1 / 8, 1.51))


@dataclass(frozen=True)
class Design:
    """Pseudobulks in order: their size factors, and the number of each one's level among ``names``."""

    names: tuple[str, ...]
    level: np.ndarray
    size: np.ndarray

    @property
    def hot(self) -> np.ndarray:
        """Levels by pseudobulks, 1 where it belongs."""
        return (self.level == np.arange(len(self.names))[:, None]).astype(float)

    @property
    def least(self) -> float:
        return math.log(LEAST_DISPERSION)

    @property
    def most(self) -> float:
        return math.log(max(10.0, len(self.level)))


def log_gamma_ratio(y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """log of gamma(y + r) / gamma(r), by Stirling's series eight steps up; exact to rounding also where r is huge."""
    up = r + 8
    tail = lambda x: 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7)
    return (y + up - 0.5) * np.log1p(y / up) + y * np.log(up) - y + tail(y + up) - tail(up) - sum(np.log1p(y / (r + j)) for j in range(8))


def log_likelihood(y: np.ndarray, mu: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """Per gene, without what depends on the counts alone."""
    r = 1 / alpha[:, None]
    return (log_gamma_ratio(y, r) + y * np.log(mu) - y * np.log(r + mu) - r * np.log1p(mu / r)).sum(1)


def adjusted(y: np.ndarray, mu: np.ndarray, d: Design, log_alpha: np.ndarray) -> np.ndarray:
    """The profile likelihood less half the log of the information's determinant."""
    alpha = np.exp(log_alpha)
    w = mu / (1 + alpha[:, None] * mu)
    return log_likelihood(y, mu, alpha) - 0.5 * np.log(w @ d.hot.T).sum(1)


def highest(f, low: float, high: float, genes: int) -> np.ndarray:
    """Where f (genes -> genes) is largest: the best of a grid, then golden sections around it."""
    grid = np.linspace(low, high, 24)
    best = np.argmax(np.stack([f(np.full(genes, x)) for x in grid]), 0)
    a, b, ratio = grid[np.maximum(best - 1, 0)], grid[np.minimum(best + 1, 23)], (math.sqrt(5) - 1) / 2
    c, e = b - ratio * (b - a), a + ratio * (b - a)
    fc, fe = f(c), f(e)
    for _ in range(32):
        left = fc > fe
        a, b = np.where(left, a, c), np.where(left, e, b)
        c, e, known = b - ratio * (b - a), a + ratio * (b - a), np.where(left, fc, fe)
        new = f(np.where(left, c, e))
        fc, fe = np.where(left, new, known), np.where(left, known, new)
    return (a + b) / 2


def level_means(y: np.ndarray, d: Design) -> np.ndarray:
    """Expected counts from the mean normalised count of each level."""
    return np.maximum((y / d.size) @ d.hot.T / d.hot.sum(1) @ d.hot * d.size, LEAST_MEAN)


def gene_dispersions(y: np.ndarray, d: Design) -> np.ndarray:
    mu = level_means(y, d)
    return np.exp(highest(lambda x: adjusted(y, mu, d, x), d.least, d.most, len(y)))


def shrunk(y: np.ndarray, d: Design, raw: np.ndarray, fit: np.ndarray, prior: float, spread: float) -> np.ndarray:
    """The maximum of likelihood and prior; a gene over two standard deviations above the trend keeps its own."""
    mu, at = level_means(y, d), np.log(fit)
    own = np.exp(highest(lambda x: adjusted(y, mu, d, x) - (x - at) ** 2 / (2 * prior), d.least, d.most, len(y)))
    return np.where(np.log(raw) > at + 2 * math.sqrt(spread), raw, own)


def fitted(y: np.ndarray, d: Design, alpha: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log means of the levels ``hot``, expected counts), each level by its own Newton steps. A level without any count stands as if it had half of one."""
    a, floor = alpha[:, None], np.log(LEAST_MEAN / (hot @ d.size))
    eta = np.maximum(np.log(np.maximum((y / d.size) @ hot.T / hot.sum(1), 1e-12)), floor)
    for _ in range(50):
        mu = np.exp(eta @ hot) * d.size
        step = ((y - mu) / (1 + a * mu)) @ hot.T / ((mu / (1 + a * mu)) @ hot.T)
        eta = np.maximum(eta + np.clip(step, -2, 2), floor)
        if np.abs(step[eta > floor]).max(initial=0) < 1e-9:
            break
    return eta, np.exp(eta @ hot) * d.size


def trimmed(x: np.ndarray, share: float) -> np.ndarray:
    """Mean of each row without that share of the values at either end."""
    cut = int(x.shape[1] * share)
    return np.sort(x, 1)[:, cut : x.shape[1] - cut].mean(1)


def cooks(y: np.ndarray, mu: np.ndarray, d: Design, alpha: np.ndarray) -> np.ndarray:
    """Cook's distance of each count, with a variance that a single count cannot move."""
    norm, spread = y / d.size, []
    counted = [np.flatnonzero(r) for r in d.hot if r.sum() >= FOR_COOKS] or [np.arange(len(d.size))]
    for own in counted:
        _, share, scale = next(t for t in TRIMS if len(own) <= t[0])
        spread.append(scale * trimmed((norm[:, own] - trimmed(norm[:, own], share)[:, None]) ** 2, share))
    m = np.maximum(norm.mean(1), 1e-12)
    robust = np.maximum((np.max(spread, 0) - m) / m**2, 0.04)[:, None]
    w = np.maximum(mu, LEAST_MEAN) / (1 + alpha[:, None] * np.maximum(mu, LEAST_MEAN))
    hat = np.minimum(w / (w @ d.hot.T @ d.hot), 1 - 1e-9)
    return (y - mu) ** 2 / (mu + robust * mu**2) / len(d.names) * hat / (1 - hat) ** 2


def f_quantile(q: float, a: int, b: int) -> float:
    """Quantile of the F distribution with ``a`` and ``b`` degrees, by bisection over the integral of its density."""
    x = (np.arange(20_000) + 0.5) / 20_000
    # x = a f / (a f + b) is beta distributed; the ends are stretched so that the density stays bounded
    t = x**2 * (3 - 2 * x)
    density = np.exp((a / 2 - 1) * np.log(t) + (b / 2 - 1) * np.log1p(-t)) * 6 * x * (1 - x)
    below = np.cumsum(density) / density.sum()
    at = t[min(int(np.searchsorted(below, q)), len(t) - 1)]
    return b * at / (a * (1 - at))


def trigamma(x: float) -> float:
    low = 0.0
    while x < 10:
        low, x = low + 1 / x**2, x + 1
    return low + 1 / x + 1 / (2 * x**2) + 1 / (6 * x**3) - 1 / (30 * x**5) + 1 / (42 * x**7)


def two_sided(z: np.ndarray) -> np.ndarray:
    return np.array([math.erfc(abs(v) / math.sqrt(2)) for v in z])


def tests(y: np.ndarray, d: Design, raw: np.ndarray, trend: tuple[float, float], prior: float, spread: float) -> dict[str, np.ndarray]:
    """Per gene: base_mean, alpha, eta and variance of each level, lr, and outlier: whether a count lies too far out to test the gene."""
    a0, a1 = trend
    y, fit = y.copy(), lambda t: a0 + a1 / np.maximum((t / d.size).mean(1), 1e-12)

    def fit_all(t: np.ndarray, own: np.ndarray) -> tuple:
        alpha = shrunk(t, d, own, fit(t), prior, spread)
        return alpha, *fitted(t, d, alpha, d.hot)

    alpha, eta, mu = fit_all(y, raw)
    n = d.hot.sum(1)[d.level]
    p = len(d.names)
    outlier = np.zeros(len(y), bool)
    if len(d.level) > p:
        far = cooks(y, mu, d, alpha) > f_quantile(COOKS, p, len(d.level) - p)
        outlier = (far & (n >= FOR_COOKS) & (n < FOR_REPLACEMENT)).any(1)
        swap = far & (n >= FOR_REPLACEMENT)
        again = np.flatnonzero(swap.any(1))
        if len(again):
            usual = np.floor(trimmed(y[again] / d.size, 0.2)[:, None] * d.size)
            y[again] = np.where(swap[again], usual, y[again])
            again = again[y[again].sum(1) > 0]
            alpha[again], eta[again], mu[again] = fit_all(y[again], gene_dispersions(y[again], d))
    seen = np.maximum(mu, LEAST_MEAN)
    _, flat = fitted(y, d, alpha, np.ones((1, len(d.size))))
    lr = np.maximum(2 * (log_likelihood(y, mu, alpha) - log_likelihood(y, flat, alpha)), 0)
    return {"base_mean": (y / d.size).mean(1), "alpha": alpha, "eta": eta, "variance": 1 / ((seen / (1 + alpha[:, None] * seen)) @ d.hot.T), "lr": lr, "lr_p": np.array([chi2_tail(x, p - 1) for x in lr]), "outlier": outlier}


def benjamini_hochberg(p: np.ndarray) -> np.ndarray:
    order = np.argsort(-p, kind="stable")
    rank = np.arange(len(p), 0, -1)
    out = np.empty(len(p))
    out[order] = np.minimum(1, np.minimum.accumulate(p[order] * len(p) / rank))
    return out


def smooth(x: np.ndarray, y: np.ndarray, share: float = 0.2, rounds: int = 3) -> np.ndarray:
    """Locally weighted regression lines through (x, y), weighted down where they miss."""
    k, robust, out = max(2, int(share * len(x) + 1e-9)), np.ones(len(x)), np.zeros(len(x))
    for _ in range(rounds + 1):
        for i, at in enumerate(x):
            h = max(np.sort(np.abs(x - at))[k - 1], 1e-12)
            w = np.clip(1 - (np.abs(x - at) / h) ** 3, 0, None) ** 3 * robust
            w /= max(w.sum(), 1e-300)
            m = (w * x).sum()
            v = (w * (x - m) ** 2).sum()
            out[i] = (w * y).sum() + (((w * (x - m) * y).sum() / v) * (at - m) if v > 1e-12 else 0)
        miss = np.abs(y - out)
        scale = 6 * np.median(miss)
        if scale < 1e-9 * max(1, np.abs(y).max()):
            break
        robust = np.clip(1 - (miss / scale) ** 2, 0, None) ** 2
    return out


def filtered(p: np.ndarray, mean: np.ndarray, alpha: float = 0.1) -> np.ndarray:
    """Adjusted p-values of the genes above that mean which lets through about the most rejections; NaN below it and where p is."""
    out = np.full(len(p), np.nan)
    if not len(p) or np.isnan(p).all():
        return out
    low = float((mean == 0).mean())
    share = np.linspace(low, 0.95 if low < 0.95 else 1.0, 50)
    cuts = np.quantile(mean, share)
    kept = [np.flatnonzero((mean >= c) & ~np.isnan(p)) for c in cuts]
    found = np.array([(benjamini_hochberg(p[i]) < alpha).sum() if len(i) else 0 for i in kept], float)
    at = 0
    if found.max() > 10:
        line = smooth(share, found)
        miss = (found - line)[found > 0]
        above = np.flatnonzero(found > line.max() - math.sqrt((miss**2).mean()))
        at = int(above[0]) if len(above) else 0
    out[kept[at]] = benjamini_hochberg(p[kept[at]])
    return out


def _designs(bulks: DataFrame, factors: DataFrame, bulk: str, level: str, levels: list[str]) -> tuple[list[str], list[Design]]:
    """The pseudobulks in order, and the designs: all levels, then each against the rest."""
    of = bulks.where(F.col(level).isin(levels)).select(bulk, level).distinct().join(factors, bulk).orderBy(bulk).collect()  # a row per pseudobulk
    size, at = np.array([r["size_factor"] for r in of]), np.array([levels.index(r[level]) for r in of])
    rest = [Design(("rest", a), (at == i).astype(int), size) for i, a in enumerate(levels)] if len(levels) > 2 else []
    return [r[bulk] for r in of], [Design(tuple(levels), at, size), *rest]


def dispersions(bulks: DataFrame, names: list[str], designs: list[Design], bulk: str) -> DataFrame:
    """(design, gene, y, base_mean, raw): counts in order of ``names`` and the gene's own dispersion in each design; genes without counts are left out."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(bulk).alias("b"), F.col("count").cast("double").alias("c"))))
    wide = bulks.where(F.col(bulk).isin(names)).groupBy("gene").agg(pairs.alias("p"), F.sum("count").alias("n")).where("n > 0").select("gene", F.col("p.c").alias("y"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            y = np.stack(f["y"].to_numpy())
            for i, d in enumerate(designs):
                yield pd.DataFrame({"design": np.int32(i), "gene": f["gene"], "y": f["y"], "base_mean": (y / d.size).mean(1), "raw": gene_dispersions(y, d)})

    return wide.mapInPandas(run, "design int, gene string, y array<double>, base_mean double, raw double")


def trends(raw: DataFrame, designs: int) -> list[tuple[float, float]]:
    """(a0, a1) of each design: dispersion a0 + a1 / mean by gamma regression, fitted again without the genes that lie far off until it stays.

    Where that gives no positive numbers, (mean dispersion, 0). Each step is one aggregate over the genes of all designs.
    """
    rows = raw.where((F.col("raw") >= 100 * LEAST_DISPERSION) & (F.col("base_mean") > 0)).select("design", "raw", (1 / F.col("base_mean")).alias("x"))
    means = {r["design"]: r["m"] for r in rows.groupBy("design").agg(F.avg("raw").alias("m")).collect()}
    now = {i: (0.1, 1.0) for i in means}
    done: dict[int, tuple[float, float]] = {i: (LEAST_DISPERSION, 0.0) for i in range(designs) if i not in means}

    def at(c: dict[int, tuple[float, float]]) -> Column:
        part = lambda k: F.get(F.array(*[F.lit(float(c.get(i, (1.0, 0.0))[k])) for i in range(designs)]), F.col("design"))
        return F.greatest(part(0) + part(1) * F.col("x"), F.lit(1e-12))

    for _ in range(20):
        if not now:
            break
        inner, still = dict(now), set(now)
        good = rows.where(F.col("design").isin(*now) & (F.col("raw") / at(now)).between(1e-4, 15))
        for _ in range(25):
            w = 1 / F.pow(at(inner), 2)
            s = good.where(F.col("design").isin(*still)).groupBy("design").agg(*[F.sum(w * e).alias(n) for n, e in (("w", F.lit(1.0)), ("x", F.col("x")), ("xx", F.col("x") * F.col("x")), ("y", F.col("raw")), ("xy", F.col("x") * F.col("raw")))]).collect()
            still = set()
            for r in s:
                i, det = r["design"], r["w"] * r["xx"] - r["x"] ** 2
                new = ((r["y"] * r["xx"] - r["x"] * r["xy"]) / det, (r["w"] * r["xy"] - r["x"] * r["y"]) / det) if det > 1e-12 * r["w"] * r["xx"] else (-1.0, -1.0)
                if min(new) > 0 and max(abs(b / a - 1) for a, b in zip(inner[i], new, strict=True) if a > 0) > 1e-8:
                    still.add(i)
                inner[i] = new
            if not still:
                break
        for i in list(now):
            if min(inner[i]) <= 0:
                done[i] = (means[i], 0.0)
            elif sum(math.log(b / a) ** 2 for a, b in zip(now[i], inner[i], strict=True)) < 1e-6:
                done[i] = inner[i]
            now[i] = inner[i]
            if i in done:
                del now[i]
    return [(done | now)[i] for i in range(designs)]


def priors(raw: DataFrame, designs: list[Design], trend: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """(variance of the prior, spread around the trend) of each design, both of log dispersions; the spread by the median deviation."""
    a0, a1 = (F.get(F.array(*[F.lit(float(t[k])) for t in trend]), F.col("design")) for k in (0, 1))
    off = raw.where((F.col("raw") >= 100 * LEAST_DISPERSION) & (F.col("base_mean") > 0)).select("design", (F.log("raw") - F.log(a0 + a1 / F.col("base_mean"))).alias("r"))
    mid = off.groupBy("design").agg(F.median("r").alias("m"))
    mad = off.join(mid, "design").groupBy("design").agg(F.median(F.abs(F.col("r") - F.col("m"))).alias("d"))
    spread = {r["design"]: (1.4826 * r["d"]) ** 2 for r in mad.collect()}
    free = [max(len(d.level) - len(d.names), 1) for d in designs]
    return [(max(spread.get(i, 0.0) - trigamma(n / 2), 0.25), spread.get(i, 0.0)) for i, n in enumerate(free)]


COLUMNS = "gene string, contrast string, base_mean double, dispersion double, log2fc double, lfc_se double, stat double, p double, lr double, lr_p double"


def nb_tests(bulks: DataFrame, factors: DataFrame, bulk: str, level: str, levels: list[str], alpha: float = 0.1) -> DataFrame:
    """COLUMNS, padj and lr_padj: every pair of ``levels``, and for three levels or more each level against the rest in a design of its own.

    ``bulks`` has every gene in every pseudobulk, zeros too. lr tests the whole factor of the contrast's design. p is null for genes with an outlying count, padj also where
    the filter leaves the gene out; ``alpha`` is the level of the filter. Genes without counts have no rows.
    """
    names, designs = _designs(bulks, factors, bulk, level, levels)
    raw = settle(dispersions(bulks, names, designs, bulk))
    trend = trends(raw, len(designs))
    prior = priors(raw, designs, trend)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i, f in frame.groupby("design"):
                d = designs[i]
                t = tests(np.stack(f["y"].to_numpy()), d, f["raw"].to_numpy(), trend[i], *prior[i])
                for a, b in [(a, b) for a in range(len(d.names)) for b in range(a + 1, len(d.names))]:
                    a, b = (b, a) if i else (a, b)
                    change, se = t["eta"][:, a] - t["eta"][:, b], np.sqrt(t["variance"][:, a] + t["variance"][:, b])
                    p = np.where(t["outlier"], np.nan, two_sided(change / se))
                    lr_p = np.where(t["outlier"], np.nan, t["lr_p"])
                    yield pd.DataFrame({"gene": f["gene"], "contrast": f"{d.names[a]}_vs_{d.names[b]}", "base_mean": t["base_mean"], "dispersion": t["alpha"], "log2fc": change / math.log(2), "lfc_se": se / math.log(2), "stat": change / se, "p": p, "lr": t["lr"], "lr_p": lr_p})

    def adjust(f: pd.DataFrame) -> pd.DataFrame:
        mean = f["base_mean"].to_numpy(float)
        return f.assign(padj=filtered(f["p"].to_numpy(float), mean, alpha), lr_padj=filtered(f["lr_p"].to_numpy(float), mean, alpha))

    # a contrast has a row per gene of the panel
    out = settle(raw.mapInPandas(run, COLUMNS)).groupBy("contrast").applyInPandas(adjust, f"{COLUMNS}, padj double, lr_padj double")
    return out.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if t == "double" else c for c, t in out.dtypes])


def vst(norm: Column, a0: float, a1: float) -> Column:
    """The variance-stabilising transform of normalised counts under dispersions a0 + a1 / mean, in log2; log2(norm + 1) where a0 is not positive."""
    if a0 <= 0:
        return F.log2(norm + 1)
    return F.log2((1 + a1 + 2 * a0 * norm + 2 * F.sqrt(a0 * norm * (1 + a1 + a0 * norm))) / (4 * a0))


def stabilised(bulks: DataFrame, factors: DataFrame, bulk: str, level: str, levels: list[str]) -> DataFrame:
    """``bulks`` of the levels with norm = count / size factor and value = its ``vst`` under the trend of the design with all levels."""
    names, designs = _designs(bulks, factors, bulk, level, levels)
    raw = settle(dispersions(bulks, names, designs[:1], bulk))
    a0, a1 = trends(raw, 1)[0]
    norm = F.col("count") / F.col("size_factor")
    # a row per pseudobulk
    return bulks.where(F.col(bulk).isin(names)).join(F.broadcast(factors), bulk).withColumn("norm", norm).withColumn("value", vst(norm, a0, a1))
