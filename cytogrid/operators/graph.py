"""Graph clustering and layout as rounds of joins and aggregates over an edge table (u, v, w), each edge once."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytogrid.operators.durable import settle


def fuzzy_union(knn: DataFrame) -> DataFrame:
    """Weights of a neighbour graph (src, dst, d): exp(-d / mean d of the source), joined both ways as a + b - ab."""
    # a window over the graph's own order by source, not a join with itself, so that neighbours are searched once
    scale = F.avg("d").over(Window.partitionBy("src"))
    w = knn.withColumn("w", F.exp(-F.coalesce(F.try_divide(F.col("d"), scale), F.lit(0.0))))
    both = w.groupBy(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).agg(F.sum("w").alias("s"), F.product("w").alias("p"), F.count("*").alias("n"))
    return both.select("u", "v", F.when(F.col("n") == 1, F.col("s")).otherwise(F.col("s") - F.col("p")).alias("w"))


def smooth_union(knn: DataFrame, rounds: int = 64) -> DataFrame:
    """Weights of a neighbour graph (src, dst, d) by local scale: exp(-(d - rho) / sigma), joined both ways as a + b - ab.

    rho is a node's least positive distance, and sigma is found by bisection such that its k weights add up to log2 k; sigma is at least a thousandth of the mean distance.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            n = f["d"].map(len).to_numpy()
            d = np.full((len(f), n.max()), np.inf)
            for i, row in enumerate(f["d"]):
                d[i, : n[i]] = row
            rho = np.where(d > 0, d, np.inf).min(1)
            off = np.maximum(d - np.where(np.isfinite(rho), rho, 0)[:, None], 0)
            low, high, at, want = np.zeros(len(f)), np.full(len(f), np.inf), np.ones(len(f)), np.log2(n)
            for _ in range(rounds):
                above = np.exp(-off / at[:, None]).sum(1) > want
                low, high = np.where(above, low, at), np.where(above, at, high)
                at = np.where(np.isinf(high), at * 2, (low + high) / 2)
            mean = np.where(np.isfinite(d), d, 0).sum(1) / n
            w = np.exp(-off / np.maximum(at, 1e-3 * mean + 1e-300)[:, None])
            yield pd.DataFrame({"src": f["src"], "dst": f["dst"], "w": [w[i, : n[i]] for i in range(len(f))]})

    lists = knn.groupBy("src").agg(F.array_sort(F.collect_list(F.struct("d", "dst"))).alias("near")).select("src", F.col("near.dst").alias("dst"), F.col("near.d").alias("d"))
    w = lists.mapInPandas(run, "src string, dst array<string>, w array<double>").select("src", F.explode(F.arrays_zip("dst", "w")).alias("e")).select("src", "e.dst", "e.w")
    both = w.groupBy(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).agg(F.sum("w").alias("s"), F.product("w").alias("p"), F.count("*").alias("n"))
    return both.select("u", "v", F.when(F.col("n") == 1, F.col("s")).otherwise(F.col("s") - F.col("p")).alias("w"))


def spectral(edges: DataFrame, steps: int = 6, each: int = 5, seed: int = 0) -> DataFrame:
    """(node, x, y): the graph's slowest two modes but the constant one, about, from ``steps`` times ``each`` rounds of averaging over neighbours.

    Between the steps the two are made free of the constant mode and of each other; that takes six sums. Coordinates are scaled to at most 10, with a little noise.
    """
    sym = settle(_both_ways(edges).where("u <> v"))
    unit = lambda s: F.pmod(F.xxhash64("node", F.lit(s)), F.lit(1 << 20)) / float(1 << 20) - 0.5
    t = F.sqrt("deg")
    now = settle(sym.groupBy(F.col("u").alias("node")).agg(F.sum("w").alias("deg")).select("node", t.alias("t"), unit(seed + 1).alias("x"), unit(seed + 2).alias("y")))
    for _ in range(steps):
        for _ in range(each):
            of = now.select(F.col("node").alias("v"), F.col("t").alias("tv"), F.col("x").alias("vx"), F.col("y").alias("vy"))
            mean = sym.join(of, "v").groupBy(F.col("u").alias("node")).agg(*[F.sum(F.col("w") / F.col("tv") * F.col(f"v{c}")).alias(f"s{c}") for c in "xy"])
            now = now.join(mean, "node").select("node", "t", *[((F.col(c) + F.col(f"s{c}") / F.col("t")) / 2).alias(c) for c in "xy"])
        now = settle(now)
        m = now.agg(*[F.sum(F.col(a) * F.col(b)).alias(a + b) for a, b in ("tt", "tx", "ty", "xx", "xy", "yy")]).first()
        if not m["tt"]:
            break
        px, py = m["tx"] / m["tt"], m["ty"] / m["tt"]
        xx, xy = m["xx"] - m["tx"] * px, m["xy"] - m["tx"] * py
        q = xy / xx if xx > 0 else 0.0
        yy = m["yy"] - m["ty"] * py - q * xy
        x, y = F.col("x") - px * F.col("t"), F.col("y") - py * F.col("t")
        now = now.select("node", "t", (x / max(xx, 1e-300) ** 0.5).alias("x"), ((y - q * x) / max(yy, 1e-300) ** 0.5).alias("y"))
    most = now.agg(F.max(F.greatest(F.abs(F.col("x") / F.col("t")), F.abs(F.col("y") / F.col("t"))))).first()[0] or 1.0
    return settle(now.select("node", *[(10 / most * F.col(c) / F.col("t") + 1e-3 * unit(seed + s)).alias(c) for c, s in (("x", 3), ("y", 4))]))


#: The curve 1 / (1 + a d^2b) that belongs to a least distance of 0.5.
CURVE = (0.5830300205483709, 1.334166992455648)


def _epochs(pos: np.ndarray, u: np.ndarray, v: np.ndarray, away: np.ndarray, share: np.ndarray, pool: np.ndarray, rates: list[float], repel: int, rng: np.random.Generator) -> np.ndarray:
    """Positions after one epoch for each rate: edges drawn by their share pull their first end, and for each some of the pool push it.

    ``v`` is the place of the other end in ``pos``, -1 where that belongs to another block and stands at ``away``.
    """
    a, b = CURVE
    for rate in rates:
        drawn = np.flatnonzero(rng.random(len(u)) < share)
        i, j = u[drawn], v[drawn]
        to = pos[i] - np.where((j >= 0)[:, None], pos[j], away[drawn])
        d2 = np.maximum((to * to).sum(1), 1e-12)
        pull = -2 * a * b * d2 ** (b - 1) / (1 + a * d2**b)
        delta = np.zeros_like(pos)
        np.add.at(delta, i, np.clip(pull[:, None] * to, -4, 4))
        i = np.repeat(i, repel)
        to = pos[i] - pool[rng.integers(0, len(pool), len(i))]
        d2 = (to * to).sum(1)
        push = np.where(d2 > 0, 2 * b / ((0.001 + d2) * (1 + a * d2**b)), 0)
        np.add.at(delta, i, np.clip(push[:, None] * to, -4, 4))
        pos = pos + rate * delta
    return pos


def umap(edges: DataFrame, epochs: int = 500, each: int = 25, repel: int = 5, seed: int = 0, block: int = 20_000, pool: int = 4_096) -> DataFrame:
    """(node, x, y): two-dimensional coordinates whose near neighbours are those of the graph (u, v, w), from a ``spectral`` start.

    In an epoch an edge is drawn with its weight's share of the largest and pulls its ends together, and ``repel`` nodes drawn for it push them away. Nodes are dealt to blocks of
    about ``block``; a block runs ``each`` epochs against the last known places of the others, and then all meet again. Nodes that push come from ``pool`` nodes drawn anew each time.
    """
    sym = settle(_both_ways(edges).where("u <> v"))
    top = sym.agg(F.max("w")).first()[0]
    now = spectral(edges, seed=seed)
    if not top:
        return now
    blocks = max(1, now.count() // block)
    of = lambda c: F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(blocks)).cast("int").alias("block")
    for r in range(-(-epochs // each)):
        met = np.array([(p["x"], p["y"]) for p in now.orderBy(F.xxhash64("node", F.lit(seed + r)), "node").limit(pool).collect()])
        rates = [1 - e / epochs for e in range(r * each, min(epochs, (r + 1) * each))]

        def run(key: tuple, own: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
            own, near = own.sort_values("node", ignore_index=True), near.sort_values(["u", "v"])
            place = {n: i for i, n in enumerate(own["node"])}
            u, v = (np.array([place.get(n, -1) for n in near[c]], np.int64) for c in "uv")
            rng = np.random.default_rng([seed, r, int(key[0])])  # noqa: B023
            pos = _epochs(own[["x", "y"]].to_numpy(), u, v, near[["vx", "vy"]].to_numpy(), near["w"].to_numpy() / top, met, rates, repel, rng)  # noqa: B023
            return pd.DataFrame({"node": own["node"], "x": pos[:, 0], "y": pos[:, 1]})

        far = sym.join(now.select(F.col("node").alias("v"), F.col("x").alias("vx"), F.col("y").alias("vy")), "v").select(of("u"), "u", "v", "w", "vx", "vy")
        now = settle(now.select(of("node"), "node", "x", "y").groupBy("block").cogroup(_renamed(far).groupBy("block")).applyInPandas(run, "node string, x double, y double"))
    return now


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v", "w").unionByName(edges.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v"), "w"))


def modularity(edges: DataFrame, labels: DataFrame, gamma: float = 1.0) -> DataFrame:
    """One row: q of the partition ``labels`` (node, c)."""
    a, b = labels.select(F.col("node").alias("u"), F.col("c").alias("cu")), labels.select(F.col("node").alias("v"), F.col("c").alias("cv"))
    e = edges.join(a, "u").join(b, "v")
    inside = e.where("cu = cv").groupBy(F.col("cu").alias("c")).agg(F.sum("w").alias("l"))
    ends = e.select(F.col("cu").alias("c"), "w").unionByName(e.select(F.col("cv").alias("c"), "w")).groupBy("c").agg(F.sum("w").alias("k"))
    m = edges.agg(F.sum("w").cast("double").alias("m"))
    t = ends.join(inside, "c", "left").na.fill(0, ["l"]).join(F.broadcast(m))
    return t.agg(F.sum(F.col("l") / F.col("m") - gamma * F.pow(F.col("k") / (2 * F.col("m")), 2)).alias("q"))


def _local_moves(g: float, nodes: pd.DataFrame, links: pd.DataFrame, fresh: int) -> tuple[np.ndarray, np.ndarray]:
    """Communities of a block's nodes after moves one at a time, each to where modularity gains most, until none gains; and which would move at first.

    ``g`` is the resolution over twice the weight of all edges. Only nodes with ``turn`` move; those of other blocks stay as they are. New communities are numbered down from
    ``fresh``. All nodes are looked at once, in numpy; from then on only those that would move, and the neighbours of those that did.
    """
    names, strength = nodes["node"].to_numpy(), nodes["k"].to_numpy()
    u, v = np.searchsorted(names, links["u"].to_numpy()), np.minimum(np.searchsorted(names, links["v"].to_numpy()), len(names) - 1)
    inside = names[v] == links["v"].to_numpy() if len(links) else np.zeros(0, bool)
    ids, codes = np.unique(np.concatenate([nodes["c"].to_numpy(), links["cv"].to_numpy()]), return_inverse=True)
    own, to = codes[: len(names)], codes[len(names) :]
    whole = np.zeros(len(ids))
    whole[codes] = np.concatenate([nodes["total"].to_numpy(), links["total"].to_numpy()])
    weights = links["w"].to_numpy()
    pairs, of = np.unique(u * len(ids) + to, return_inverse=True)
    met, pu, pc = np.bincount(of, weights, len(pairs)), pairs // len(ids), pairs % len(ids)
    mine = own[pu] == pc
    at_home, best = np.zeros(len(names)), np.full(len(names), -np.inf)
    at_home[pu[mine]] = met[mine]
    np.maximum.at(best, pu[~mine], (met - g * strength[pu] * whole[pc])[~mine])
    others = whole[own] - strength
    stay = at_home - g * strength * others + 1e-9 * strength
    alone = np.where(others > 1e-9 * strength, 0.0, -np.inf)
    gain = np.maximum(best, alone) - stay
    would = gain > 0

    ends = np.searchsorted(u, np.arange(len(names) + 1)).tolist()
    near, w, far, k = np.where(inside, v, -1).tolist(), weights.tolist(), to.tolist(), strength.tolist()
    c, total, turn, known = own.tolist(), whole.tolist(), nodes["turn"].tolist(), ids.tolist()

    def best_of(i: int) -> int:
        """The community that node ``i`` would rather be in; -1: one of its own, as no community has."""
        weight: dict[int, float] = {}
        for e in range(ends[i], ends[i + 1]):
            j = near[e]
            at = c[j] if j >= 0 else far[e]
            weight[at] = weight.get(at, 0.0) + w[e]
        ki = k[i]
        left = total[c[i]] - ki
        best, most = c[i], weight.get(c[i], 0.0) - g * ki * left + 1e-9 * ki
        for at, x in sorted(weight.items()):
            gain = x - g * ki * total[at]
            if at != c[i] and gain > most:
                best, most = at, gain
        return -1 if best == c[i] and left > 1e-9 * ki and most < 0 else best

    # sums in another order may differ in their last bits
    for i in np.flatnonzero(would & (gain < 1e-6 * strength)).tolist():
        would[i] = best_of(i) != c[i]
    queued = (would & nodes["turn"].to_numpy()).tolist()
    waiting = deque(i for i, x in enumerate(queued) if x)
    while waiting:
        i = waiting.popleft()
        queued[i] = False
        best = best_of(i)
        if best < 0:
            best = len(total)
            total.append(0.0)
            known.append(fresh - best)
        if best != c[i]:
            total[c[i]] -= k[i]
            total[best] += k[i]
            c[i] = best
            for e in range(ends[i], ends[i + 1]):
                j = near[e]
                if j >= 0 and turn[j] and not queued[j] and c[j] != best:
                    queued[j] = True
                    waiting.append(j)
    return np.array(known)[c], would


def _refined(g: float, nodes: pd.DataFrame, links: pd.DataFrame) -> list[int]:
    """For nodes of some communities, the part of its community that each is in, named by one of its nodes.

    Parts start as single nodes. A node that is still alone and well connected to the rest of its community joins the part where modularity
    gains most, among parts that are well connected to the rest themselves: joined to it by at least the weight expected by chance.
    """
    names, k = nodes["node"].tolist(), nodes["k"].tolist()
    tied, whole = nodes["tied"].tolist(), nodes["total"].tolist()
    place = {n: i for i, n in enumerate(names)}
    near: list[list] = [[] for _ in names]
    for u, v, w in zip(links["u"], links["v"], links["w"], strict=True):
        near[place[u]].append((place[v], w))
    part, size = list(range(len(names))), [1] * len(names)
    strength, outward = k.copy(), tied.copy()
    fits = lambda p: outward[p] >= g * strength[p] * (whole[p] - strength[p]) - 1e-9 * strength[p]
    for i in range(len(names)):
        if size[i] != 1 or part[i] != i or not fits(i):
            continue
        weight: dict[int, float] = {}
        for j, w in near[i]:
            weight[part[j]] = weight.get(part[j], 0.0) + w
        gains = [(w - g * k[i] * strength[p], -p) for p, w in weight.items() if p != i and fits(p)]
        gain, to = max(gains, default=(0.0, 0))
        if gain > 0:
            part[i], size[i] = -to, 0
            size[-to] += 1
            strength[-to] += k[i]
            outward[-to] += tied[i] - 2 * weight[-to]
    return [names[p] for p in part]


def ladder(edges: DataFrame, gammas: Sequence[float], passes: int = 2, rounds: int = 200, seed: int = 0, block: int = 1_000_000) -> DataFrame:
    """(res, node, cluster) for each resolution ``gammas[res]``: Leiden communities of the same graph, all resolutions in one set of rounds.

    A level moves nodes to their best neighbouring community until none would move; splits each community into well-connected parts; and makes the
    parts the nodes of the next level, which starts from the communities. It ends when no community has two nodes. Clusters are numbered by falling size.

    Each of ``passes`` over all levels starts from the communities that the last one found.

    Nodes are dealt by the community they start a level in to blocks of about ``block`` edges. A block moves its nodes one at a time against the last known communities of the others;
    from two blocks on a half to a sixteenth of the nodes have their turn in a round, since nodes that move at once can swap for ever, and the last ones meet in one block. Parts are made
    within blocks of whole communities; one with more edges than a block is dealt over several, anew in each level. A pass that another follows leaves a level of several blocks
    after ``BRIEF`` or ``BRIEFER`` rounds, at rest or not: the last pass starts from its communities, which are near rest then, and brings every level to rest. ``rounds`` without rest are an error.
    """
    named = settle(edges.select("u", "v", F.col("w").cast("double").alias("w")))
    m2 = 2 * (named.agg(F.sum("w")).first()[0] or 0.0)
    if not m2:
        return named.select(F.lit(0).alias("res"), F.col("u").alias("node"), F.lit("0").alias("cluster")).where("false")
    ids = _numbered(named)
    level = settle(named.join(ids.select(F.col("node").alias("u"), F.col("id").alias("iu")), "u").join(ids.select(F.col("node").alias("v"), F.col("id").alias("iv")), "v").select(F.col("iu").alias("u"), F.col("iv").alias("v"), "w"))
    each = F.explode(F.array(*[F.lit(i) for i in range(len(gammas))])).alias("res")
    sym = _both_ways(level)
    # a loop counts twice in a node's strength
    strength = sym.groupBy(F.col("u").alias("node")).agg(F.sum(F.when(F.col("u") == F.col("v"), 2 * F.col("w")).otherwise(F.col("w"))).alias("k"))
    links = settle(sym.where("u <> v").groupBy("u", "v").agg(F.sum("w").alias("w")).select(each, "u", "v", "w"))
    nodes = settle(strength.select(each, "node", "k", F.col("node").alias("c")))
    g = [x / m2 for x in gammas]
    for turn in range(passes):
        of = settle(_levels(nodes, links, g, rounds, seed + turn * rounds, block, turn + 1 < passes))
        if turn + 1 < passes:
            nodes = settle(nodes.drop("c").join(of, ["res", "node"]))
    of = of.join(ids.withColumnRenamed("node", "name"), F.col("node") == F.col("id")).select("res", F.col("name").alias("node"), "c")
    # a row per cluster
    number = of.groupBy("res", "c").agg(F.count("*").alias("n"), F.min("node").alias("least"))
    number = number.withColumn("cluster", (F.row_number().over(Window.partitionBy("res").orderBy(F.desc("n"), "least")) - 1).cast("string"))
    return of.join(number.select("res", "c", "cluster"), ["res", "c"]).select("res", "node", "cluster")


def _numbered(edges: DataFrame) -> DataFrame:
    """(node, id): numbers from 0 for the ends of edges, by a hash without collisions among them."""
    ends = settle(edges.select(F.col("u").alias("node")).unionByName(edges.select(F.col("v").alias("node"))).distinct())
    n = ends.count()
    for s in range(100):
        ids = settle(ends.select("node", F.shiftrightunsigned(F.xxhash64("node", F.lit(s)), 2).alias("id")))
        if ids.select("id").distinct().count() == n:
            return ids
    raise RuntimeError("no hash tells the nodes apart")


#: Rounds of the first level and of a later one, of several blocks in a pass that another follows; rounds from which a level is only looked at between those of the last few nodes.
BRIEF, BRIEFER, CALM = 4, 2, 16


def _levels(nodes: DataFrame, links: DataFrame, g: list[float], rounds: int, seed: int, block: int, brief: bool = False) -> DataFrame:
    """(res, node, c): one pass of Leiden over (res, node, k, c), from level to level.

    A pass that another follows, on a graph of several blocks, makes whole communities the nodes of the next level: the last pass parts them where they are not well connected.
    """
    maps: list[DataFrame] = []
    coarse = False
    for depth in range(rounds):
        blocks = max(1, links.count() // len(g) // block)
        nodes = _moved(nodes, links, g, blocks, rounds, seed + depth, block, (BRIEFER if depth else BRIEF) if brief else 0)
        coarse = coarse or brief and blocks > 1
        parts = settle(nodes.withColumn("part", F.col("c")) if coarse else _parts(nodes, links, g, blocks, block, seed + depth))
        n = parts.groupBy("res").agg(F.count("*").alias("nodes"), F.count_distinct("c").alias("communities")).collect()
        maps.append(parts.select("res", "node", "part"))
        if all(r["nodes"] == r["communities"] for r in n):
            break
        u, v = (parts.select("res", F.col("node").alias(x), F.col("part").alias(f"p{x}")) for x in "uv")
        links = settle(links.join(u, ["res", "u"]).join(v, ["res", "v"]).where("pu <> pv").groupBy("res", F.col("pu").alias("u"), F.col("pv").alias("v")).agg(F.sum("w").alias("w")))
        nodes = settle(parts.groupBy("res", F.col("part").alias("node")).agg(F.sum("k").alias("k"), F.first("c").alias("c")))
    else:
        raise RuntimeError(f"communities still merge after {rounds} levels")
    of = maps[0].select("res", "node", F.col("part").alias("c"))
    for m in maps[1:]:
        of = of.join(m.select("res", F.col("node").alias("c"), F.col("part").alias("up")), ["res", "c"]).select("res", "node", F.col("up").alias("c"))
    return of


def _renamed(df: DataFrame) -> DataFrame:
    """The same columns as new ones, for a table that meets another from the same source."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


#: Links in a row of a block's lists.
PACKED = 65_536


def _packed(links: DataFrame, block: int) -> DataFrame:
    """``links`` (res, u, v, w, home) in lists (res, home, u, v, w) of about PACKED, so that a round moves a few long rows and not one for each link."""
    slot = F.pmod(F.xxhash64("u"), F.lit(-(-block // PACKED))).alias("slot")
    return links.groupBy("res", "home", slot).agg(F.collect_list(F.struct("u", "v", "w")).alias("e")).select("res", "home", *[F.col(f"e.{c}").alias(c) for c in "uvw"])


def _moved(nodes: DataFrame, links: DataFrame, g: list[float], blocks: int, rounds: int, seed: int, block: int, brief: int = 0) -> DataFrame:
    """``nodes`` (res, node, k, c) with the communities that moves of nodes come to rest in; those after ``brief`` rounds, if that is not 0.

    Blocks that move side by side bring most nodes to rest but would take very many rounds for the last ones. Once the nodes that would move have few enough edges for one
    block, these (and where it holds them, their neighbours) move there one at a time, so modularity only rises, until no node of all would move. In between all nodes
    move in their blocks, which shows too whether any would; should that not end by round CALM, they are only looked at from then on.

    A block's links and the names of the nodes it meets stay the same in all rounds; only where these nodes are is told anew, once for each block that meets them.
    """
    nodes, degree = nodes.withColumn("home", F.lit(0)), None
    mine = nodes.select("res", "node", F.col("home").alias("block"), F.lit(True).alias("own"))
    if blocks > 1:
        # a node's block is that of its community
        degree = settle(links.groupBy("res", F.col("u").alias("node")).agg(F.count("*").alias("n")))
        size = nodes.join(degree, ["res", "node"], "left").groupBy("res", "c").agg(F.expr(f"coalesce(sum(n), 0) div {block} + 1").alias("pieces"))
        home = F.pmod(F.xxhash64("c", F.pmod(F.xxhash64("node", F.lit(seed)), "pieces")), F.lit(blocks)).cast("int")
        nodes = settle(nodes.drop("home").join(size, ["res", "c"]).select("res", "node", "k", "c", home.alias("home")))
        links = settle(links.join(nodes.select("res", F.col("node").alias("u"), "home"), ["res", "u"]))
        packed = settle(_packed(links, block))
        mine = nodes.select("res", "node", F.col("home").alias("block"), F.lit(True).alias("own"))
        met = links.select("res", F.col("v").alias("node"), F.col("home").alias("block")).distinct()
        met = met.join(nodes.select("res", "node", "home"), ["res", "node"]).where("home <> block").select("res", "node", "block", F.lit(False).alias("own"))
        mine = settle(mine.unionByName(met))
    else:
        links = links.withColumn("home", F.lit(0))
        packed = _packed(links, block)
    few, look, settling = None, False, False
    for r in range(rounds):
        first = -1 - ((seed * rounds + r) << 44)

        def run(key: tuple, met: pd.DataFrame, lists: pd.DataFrame) -> pd.DataFrame:
            met = met.sort_values("node", ignore_index=True)
            own = met[met["own"]].reset_index(drop=True)
            u, v, w = (np.concatenate(lists[x].tolist()) if len(lists) else np.array([], t) for x, t in (("u", np.int64), ("v", np.int64), ("w", float)))
            order = np.lexsort((v, u))
            at = np.searchsorted(met["node"].to_numpy(), v[order])
            near = pd.DataFrame({"u": u[order], "v": v[order], "w": w[order], "cv": met["c"].to_numpy()[at], "total": met["total"].to_numpy()[at]})
            c, would = _local_moves(g[int(key[0])], own, near, first - (int(key[1]) << 28))  # noqa: B023
            return pd.DataFrame({"res": own["res"], "node": own["node"], "k": own["k"], "c": c, "home": own["home"], "would": would})

        now = nodes.join(nodes.groupBy("res", "c").agg(F.sum("k").alias("total")), ["res", "c"])
        share = 1 if blocks == 1 or settling else 2 if brief else 2 << r % 4
        turn = F.lit(not look) if look or few is not None else F.pmod(F.xxhash64("node", F.lit(seed + 1 + r)), F.lit(share)) == 0
        meets, lists = mine, packed
        if few is not None:
            some = links.join(few.withColumnRenamed("node", "u"), ["res", "u"]).withColumn("home", F.lit(0))
            around = some.select("res", F.col("v").alias("node")).distinct().join(few, ["res", "node"], "left_anti")
            meets = few.withColumn("own", F.lit(True)).unionByName(around.withColumn("own", F.lit(False))).withColumn("block", F.lit(0))
            lists = _packed(some, block)
        known = now.join(_renamed(meets), ["res", "node"]).select("res", "block", "node", "k", "c", "home", "total", turn.alias("turn"), "own")
        lists = _renamed(lists).withColumnRenamed("home", "block")
        step = settle(known.groupBy("res", "block").cogroup(lists.groupBy("res", "block")).applyInPandas(run, "res int, node long, k double, c long, home int, would boolean"))
        if few is not None:
            new = step.select("res", "node", F.col("c").alias("new"))
            nodes, few, look = settle(nodes.join(new, ["res", "node"], "left").select("res", "node", "k", F.coalesce("new", "c").alias("c"), "home")), None, r >= CALM
            continue
        nodes = step.drop("would")
        # a single block has come to rest by itself
        if blocks == 1 or r + 1 == brief:
            return nodes.drop("home")
        would = step.where("would").select("res", "node")
        of_res = would.join(degree, ["res", "node"]).groupBy("res").agg(F.sum("n").alias("n"), F.count("*").alias("nodes"))
        most = of_res.agg(F.max("n").alias("n"), F.max(F.col("n") * F.col("n") / F.col("nodes")).alias("around")).first()
        if not most["n"]:
            return nodes.drop("home")
        looked, look = look or r < CALM, most["n"] <= block
        settling |= look
        if looked and look:
            about = links.join(would.withColumnRenamed("node", "u"), ["res", "u"]).select("res", F.col("v").alias("node"))
            few, look = settle((would.unionByName(about) if most["around"] <= block else would).distinct()), False
    raise RuntimeError(f"nodes still move after {rounds} rounds")


def _parts(nodes: DataFrame, links: DataFrame, g: list[float], blocks: int, block: int, seed: int) -> DataFrame:
    """``nodes`` with the well-connected part of its community that each is in."""
    of = lambda x: nodes.select("res", F.col("node").alias(x), F.col("c").alias(f"c{x}"))
    inner = links.join(of("u"), ["res", "u"]).join(of("v"), ["res", "v"]).where("cu = cv").select("res", F.col("cu").alias("c"), "u", "v", "w")
    tied = inner.groupBy("res", F.col("u").alias("node")).agg(F.sum("w").alias("tied"), F.count("*").alias("n"))
    now = nodes.join(tied, ["res", "node"], "left").na.fill(0, ["tied", "n"])
    size = now.groupBy("res", "c").agg(F.sum("k").alias("total"), F.expr(f"sum(n) div {block} + 1").alias("pieces"))
    piece = lambda x: F.pmod(F.xxhash64("c", F.pmod(F.xxhash64(x, F.lit(seed)), "pieces")), F.lit(blocks)).cast("int")
    slot = lambda x: F.pmod(F.xxhash64(x, F.lit(seed)), "pieces")
    now = now.join(size, ["res", "c"]).withColumn("block", piece("node"))
    met = inner.join(size.drop("total"), ["res", "c"]).where(slot("u") == slot("v")).withColumn("block", piece("u"))

    def run(key: tuple, own: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("node", ignore_index=True)
        return pd.DataFrame({"res": own["res"], "node": own["node"], "k": own["k"], "c": own["c"], "part": _refined(g[int(key[0])], own, near)})

    left = now.select("res", "block", "node", "k", "c", "tied", "total").groupBy("res", "block")
    return left.cogroup(_renamed(met.select("res", "block", "u", "v", "w")).groupBy("res", "block")).applyInPandas(run, "res int, node long, k double, c long, part long")


def communities(edges: DataFrame, gamma: float = 1.0, rounds: int = 200, seed: int = 0) -> DataFrame:
    """(node, cluster) at one resolution; see ``ladder``."""
    return ladder(edges, [gamma], rounds=rounds, seed=seed).drop("res")


def layout(edges: DataFrame, rounds: int = 12, repel: int = 4, seed: int = 0) -> DataFrame:
    """(node, x, y): a two-dimensional layout in which edges attract and hashed pairs of nodes repel; a drawing aid, not a metric.

    The step shrinks to nothing over ``rounds``. In each, nodes are dealt anew to buckets of about 64 and each meets the ``repel`` nearest in hash order there.
    """
    edges = settle(edges)
    nodes = edges.select(F.col("u").alias("node")).unionByName(edges.select(F.col("v").alias("node"))).distinct()
    unit = lambda s: F.pmod(F.xxhash64("node", F.lit(s)), F.lit(1 << 20)) / float(1 << 20) * 20 - 10
    now = settle(nodes.select("node", unit(seed + 1).alias("x"), unit(seed + 2).alias("y")))
    buckets = max(1, now.count() // 64)
    sym = settle(_both_ways(edges))
    offsets = [i for i in range(-(repel // 2), repel - repel // 2 + 1) if i]
    for r in range(rounds):
        rate = 0.5 * (1 - r / rounds)
        q = now.select(F.col("node").alias("v"), F.col("x").alias("vx"), F.col("y").alias("vy"))
        dx, dy = F.col("vx") - F.col("x"), F.col("vy") - F.col("y")
        d2 = dx * dx + dy * dy
        pull = sym.withColumnRenamed("u", "node").join(now, "node").join(q, "v").select("node", (F.col("w") * dx / (1 + d2)).alias("fx"), (F.col("w") * dy / (1 + d2)).alias("fy"))
        order = F.xxhash64("node", F.lit(seed + 3 + r))
        w = Window.partitionBy(F.pmod(order, F.lit(buckets))).orderBy(order, "node")
        met = now.select("node", "x", "y", F.array(*[F.lead(F.struct("x", "y"), i).over(w) for i in offsets]).alias("met")).select("node", "x", "y", F.explode("met").alias("o"))
        met = met.where("o IS NOT NULL").select("node", "x", "y", F.col("o.x").alias("vx"), F.col("o.y").alias("vy"))
        push = met.select("node", (-dx / ((0.01 + d2) * (1 + d2))).alias("fx"), (-dy / ((0.01 + d2) * (1 + d2))).alias("fy"))
        cap = lambda c: F.greatest(F.lit(-4.0), F.least(F.lit(4.0), F.sum(c)))
        force = pull.unionByName(push).groupBy("node").agg(cap("fx").alias("fx"), cap("fy").alias("fy"))
        now = settle(now.join(force, "node", "left").na.fill(0.0, ["fx", "fy"]).select("node", (F.col("x") + rate * F.col("fx")).alias("x"), (F.col("y") + rate * F.col("fy")).alias("y")))
    return now
