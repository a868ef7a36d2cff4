"""Spatial operators: layouts, regions, neighbour graphs, enrichment, co-occurrence and niche refinement.

Range joins are equi-joins on grid cells: a point meets the 3 x 3 cells around it, never all points. Nearest neighbours are searched by the leaves of a
quadtree that counts split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cytogrid.operators.durable import settle


def stagger(cells: DataFrame, order: list[str] | None = None, gap: float = 1.5) -> DataFrame:
    """Samples side by side: x from each sample's least x, shifted by its number times ``gap`` times the largest aligned x; y stays."""
    spans = cells.groupBy("sample").agg(F.min("x").alias("x0"), (F.max("x") - F.min("x")).alias("w"))
    number = F.row_number().over(Window.orderBy("sample")) - 1
    if order:
        number = F.element_at(F.create_map(*[F.lit(v) for i, s in enumerate(order) for v in (s, i)]), F.col("sample"))
    # a row per sample
    spans = spans.withColumn("no", number).withColumn("widest", F.max("w").over(Window.partitionBy()))
    met = cells.join(F.broadcast(spans), "sample")
    return met.withColumn("x_staggered", F.col("x") - F.col("x0") + F.col("no") * gap * F.col("widest")).drop("x0", "w", "no", "widest")


def affine(x: Column, y: Column, m: list[list[float]]) -> tuple[Column, Column]:
    """A 3 x 3 affine matrix applied to a point."""
    return m[0][0] * x + m[0][1] * y + m[0][2], m[1][0] * x + m[1][1] * y + m[1][2]


def scale_rings(polygons: DataFrame, m: list[list[float]]) -> DataFrame:
    """``polygons`` (ord, region, ring: array of struct x, y) with their rings transformed."""

    def moved(p: Column) -> Column:
        x, y = affine(p["x"], p["y"], m)
        return F.struct(x.alias("x"), y.alias("y"))

    return polygons.withColumn("ring", F.transform("ring", moved))


def _edges(ring: Column) -> Column:
    """A ring's edges (x1, y1, x2, y2); an open ring is closed."""
    closed = F.when(F.element_at(ring, 1) == F.element_at(ring, -1), ring).otherwise(F.concat(ring, F.slice(ring, 1, 1)))
    pairs = F.arrays_zip(F.slice(closed, F.lit(1), F.size(closed) - 1).alias("a"), F.slice(closed, F.lit(2), F.size(closed) - 1).alias("b"))
    return F.transform(pairs, lambda e: F.struct(e["a"]["x"].alias("x1"), e["a"]["y"].alias("y1"), e["b"]["x"].alias("x2"), e["b"]["y"].alias("y2")))


def _crosses(s: Column, x: Column, y: Column) -> Column:
    """Whether a ray from (x, y) towards larger x crosses the edge."""
    at = s["x1"] + F.try_divide((y - s["y1"]) * (s["x2"] - s["x1"]), s["y2"] - s["y1"])
    return F.when((s["y1"] > y) != (s["y2"] > y), x < at).otherwise(F.lit(False))


def _odd(edges: Column, x: Column, y: Column) -> Column:
    return F.size(F.filter(edges, lambda s: _crosses(s, x, y))) % 2 == 1


#: Cells that a polygon's longer side is at most divided into.
CELLS = 16


def cover(polygons: DataFrame) -> DataFrame:
    """``polygons`` (sample, ord, region, ring) as grid cells (sample, level, gx, gy, ord, region, edges) of size 2^level, about ``CELLS`` along the longer side.

    A cell that no edge touches is inside or outside as a whole: its edges are null, and those outside are left out. The others carry the edges that can count for a point in
    them: those that reach the cell's rows and do not end left of it.
    """
    p = polygons.withColumn("edges", _edges(F.col("ring"))).drop("ring")
    for c, lo, hi in (("x", "lx", "hx"), ("y", "ly", "hy")):
        p = p.withColumn(lo, F.array_min(f"edges.{c}1")).withColumn(hi, F.array_max(f"edges.{c}1"))
    side = F.greatest(F.col("hx") - F.col("lx"), F.col("hy") - F.col("ly"))
    p = p.where((F.col("hx") > F.col("lx")) & (F.col("hy") > F.col("ly"))).withColumn("level", F.ceil(F.log2(side / CELLS)).cast("int")).withColumn("size", F.pow(F.lit(2.0), F.col("level")))
    span = lambda c: F.explode(F.sequence(F.floor(F.col(f"l{c}") / F.col("size")), F.floor(F.col(f"h{c}") / F.col("size"))))
    p = p.withColumn("gx", span("x")).withColumn("gy", span("y"))
    size, x0, y0 = F.col("size"), F.col("gx") * F.col("size"), F.col("gy") * F.col("size")
    x1, y1 = x0 + size, y0 + size

    def touched(s: Column) -> Column:
        near = (F.least(s["x1"], s["x2"]) <= x1) & (F.greatest(s["x1"], s["x2"]) >= x0) & (F.least(s["y1"], s["y2"]) <= y1) & (F.greatest(s["y1"], s["y2"]) >= y0)
        turn = [(s["x2"] - s["x1"]) * (y - s["y1"]) - (s["y2"] - s["y1"]) * (x - s["x1"]) for x in (x0, x1) for y in (y0, y1)]
        return near & (F.least(*turn) <= 0) & (F.greatest(*turn) >= 0)

    counts = lambda s: (F.least(s["y1"], s["y2"]) <= y1) & (F.greatest(s["y1"], s["y2"]) >= y0) & (F.greatest(s["x1"], s["x2"]) >= x0)
    border = F.exists("edges", touched)
    p = p.withColumn("border", border).where(F.col("border") | _odd(F.col("edges"), x0 + size / 2, y0 + size / 2))
    shape = [c for c in polygons.columns if c == "shape"]
    return p.select("sample", "level", "gx", "gy", "ord", "region", *shape, F.when(F.col("border"), F.filter("edges", counts)).alias("edges"))


def regions_of(cells: DataFrame, polygons: DataFrame, last: bool = False, default: str = "Unlabeled", strict: bool = True, inside: Callable[[Column, Column, Column], Column] | None = None) -> DataFrame:
    """``cells`` with region: the first (or last) polygon, in order of ord, that a point lies strictly within.

    ``polygons``: ord, region, ring (array of struct x, y), and sample where each belongs to one; without it they hold for every cell. Points meet polygons by
    equal (sample, grid cell) of the polygons' ``cover``, and edges are looked at, by crossing parity, boundary points excluded, in border cells only. Points at one place
    are looked up once; cells without coordinates get the default. Without ``strict`` the parity alone decides, so a point on a border belongs to the polygon on its
    right: of polygons that tile the plane, to one. With ``inside`` the polygons have a column shape, the rings need only hold the shapes, and
    inside(x, y, shape) says whether a point is in one.
    """
    keyed = "sample" in polygons.columns
    key = F.col("sample") if keyed else F.lit("")
    found = settle(cover(polygons.select(key.alias("sample"), "ord", "region", "ring", *(["shape"] if inside else []))))
    # a list of a few sizes per sample
    levels = found.groupBy("sample").agg(F.collect_set("level").alias("levels"))
    spots = cells.select(key.alias("sample"), "x", "y").where("x IS NOT NULL AND y IS NOT NULL").distinct()
    size = F.pow(F.lit(2.0), F.col("level"))
    at = spots.join(levels, "sample").select("sample", "x", "y", F.explode("levels").alias("level")).withColumn("gx", F.floor(F.col("x") / size)).withColumn("gy", F.floor(F.col("y") / size))
    x, y = F.col("x"), F.col("y")

    def touches(s: Column) -> Column:
        cross = (s["x2"] - s["x1"]) * (y - s["y1"]) - (s["y2"] - s["y1"]) * (x - s["x1"])
        return (cross == 0) & x.between(F.least(s["x1"], s["x2"]), F.greatest(s["x1"], s["x2"])) & y.between(F.least(s["y1"], s["y2"]), F.greatest(s["y1"], s["y2"]))

    odd = _odd(F.col("edges"), x, y)
    within = inside(x, y, F.col("shape")) if inside else F.col("edges").isNull() | (odd & ~F.exists("edges", touches) if strict else odd)
    pick = F.max_by if last else F.min_by
    hits = at.join(found, ["sample", "level", "gx", "gy"]).where(within).groupBy("sample", "x", "y").agg(pick("region", "ord").alias("__region"))
    if not keyed:
        hits = hits.drop("sample")
    met = cells.drop("region").join(hits, ["sample", "x", "y"] if keyed else ["x", "y"], "left")
    return met.select(*[c for c in cells.columns if c != "region"], F.coalesce("__region", F.lit(default)).alias("region"))


def _near(points: DataFrame, others: DataFrame, h: float) -> DataFrame:
    """Pairs (src, dst, d) of points of a sample in adjacent grid cells of size h."""
    gx, gy = F.floor(F.col("x") / h), F.floor(F.col("y") / h)
    a = points.select("sample", F.col("cell_id").alias("src"), F.col("x").alias("ax"), F.col("y").alias("ay"), gx.alias("gx"), gy.alias("gy"))
    around = F.explode(F.flatten(F.transform(F.array(*[F.lit(v) for v in (-1, 0, 1)]), lambda i: F.transform(F.array(*[F.lit(v) for v in (-1, 0, 1)]), lambda j: F.struct((gx + i).alias("gx"), (gy + j).alias("gy"))))))
    b = others.select("sample", F.col("cell_id").alias("dst"), F.col("x").alias("bx"), F.col("y").alias("by"), around.alias("g")).select("sample", "dst", "bx", "by", "g.gx", "g.gy")
    d = F.sqrt(F.pow(F.col("ax") - F.col("bx"), 2) + F.pow(F.col("ay") - F.col("by"), 2))
    return a.join(b, ["sample", "gx", "gy"]).where("src <> dst").select("sample", "src", "dst", d.alias("d"), (F.col("bx") - F.col("ax")).alias("dx"), (F.col("by") - F.col("ay")).alias("dy"))


#: Levels of the tree, and how many are counted at a time.
DEPTH, STRIDE = 30, 6


def quadtree(spots: DataFrame, most: int) -> DataFrame:
    """``spots`` (sample, x, y, ...: distinct places) with the leaf (depth, cx, cy) of a quadtree whose leaves hold at most ``most`` places.

    The root is a square around the sample. Counts are taken ``STRIDE`` levels at a time, over the places in cells that still hold too many; a place's leaf is its first
    cell that does not. At the last level a leaf may hold more, as its places are then 2^-30 of the sample apart.
    """
    box = spots.groupBy("sample").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("side"))
    place = lambda c: F.least(F.floor(F.coalesce(F.try_divide(F.col(c) - F.col(f"{c}0"), F.col("side")), F.lit(0.0)) * (1 << DEPTH)), F.lit((1 << DEPTH) - 1))
    left = settle(spots.join(box, "sample").withColumn("ix", place("x")).withColumn("iy", place("y")))
    done = None
    for top in range(0, DEPTH, STRIDE):
        low = min(top + STRIDE, DEPTH)
        at = [F.shiftright(c, DEPTH - low).alias(f"j{c[1]}") for c in ("ix", "iy")]
        fine = left.groupBy("sample", *at).agg(F.count("*").alias("n"))
        level = F.explode(F.sequence(F.lit(top), F.lit(low))).alias("depth")
        over = lambda c: F.expr(f"shiftright(j{c}, {low} - depth)").alias(f"c{c}")  # noqa: B023, E731
        chain = fine.select("sample", "jx", "jy", "n", level).select("*", over("x"), over("y"))
        held = chain.groupBy("sample", "depth", "cx", "cy").agg(F.sum("n").alias("all"))
        fits = (F.col("all") <= most) | (F.col("depth") == DEPTH)
        leaf = chain.join(held, ["sample", "depth", "cx", "cy"]).where(fits).groupBy("sample", "jx", "jy").agg(F.min_by(F.struct("depth", "cx", "cy"), "depth").alias("leaf"))
        met = settle(left.select("*", *at).join(leaf, ["sample", "jx", "jy"], "left").drop("jx", "jy"))
        found = met.where("leaf IS NOT NULL").select("*", "leaf.depth", "leaf.cx", "leaf.cy").drop("leaf")
        done = found if done is None else done.unionByName(found)
        left = met.where("leaf IS NULL").drop("leaf")
        if low == DEPTH or left.isEmpty():
            return done.drop("ix", "iy")


def _reached(near: DataFrame, leaves: DataFrame) -> DataFrame:
    """Pairs of ``near`` leaves, each with a box (x1, y1, x2, y2), and the leaves (bdepth, bx, by and their bounds) that the box may touch.

    The box touches at most four cells of its own size; a leaf lies below one of these or is one of the cells above them.
    """
    key = ["sample", "l", "gx", "gy"]
    side = F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    own = F.greatest(F.lit(0), F.least(F.coalesce(F.floor(F.log2(F.try_divide(F.col("side"), side))), F.lit(DEPTH)), F.lit(DEPTH))).cast("int")
    a = near.withColumn("l", own)
    cell = lambda v, o: F.greatest(F.lit(0), F.least(F.floor(F.coalesce(F.try_divide(F.col(v) - F.col(o), F.col("side")), F.lit(0.0)) * F.pow(F.lit(2.0), F.col("l"))), F.expr("shiftleft(1L, l)") - 1))
    a = a.withColumn("gx", F.explode(F.sequence(cell("x1", "x0"), cell("x2", "x0")))).withColumn("gy", F.explode(F.sequence(cell("y1", "y0"), cell("y2", "y0"))))
    b = leaves.select("sample", F.col("depth").alias("bdepth"), F.col("cx").alias("bx"), F.col("cy").alias("by"), "lx", "ly", "hx", "hy", "held")
    below = b.withColumn("l", F.explode(F.sequence(F.lit(0), "bdepth"))).withColumn("gx", F.expr("shiftright(bx, bdepth - l)")).withColumn("gy", F.expr("shiftright(by, bdepth - l)"))
    above = a.where("l > 0").withColumn("up", F.explode(F.sequence(F.lit(0), F.col("l") - 1))).withColumn("gx", F.expr("shiftright(gx, l - up)")).withColumn("gy", F.expr("shiftright(gy, l - up)")).withColumn("l", F.col("up")).drop("up")
    whole = b.withColumn("l", F.col("bdepth")).withColumn("gx", F.col("bx")).withColumn("gy", F.col("by"))
    met = a.join(below, key).unionByName(above.distinct().join(whole, key))
    touch = (F.col("lx") <= F.col("x2")) & (F.col("hx") >= F.col("x1")) & (F.col("ly") <= F.col("y2")) & (F.col("hy") >= F.col("y1"))
    return met.where(touch).drop(*key[1:]).distinct()


def _nearest(met: DataFrame, k: int) -> DataFrame:
    """Of places that meet others (px, py, ids): the k + 1 nearest names each, with rank and distance."""
    d = F.sqrt(F.pow(F.col("x") - F.col("px"), 2) + F.pow(F.col("y") - F.col("py"), 2))
    each = met.select(*[c for c in met.columns if c != "ids"], d.alias("d"), F.explode("ids").alias("dst"))
    best = Window.partitionBy("sample", "x", "y").orderBy("d", "dst")
    return each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1)


def search(points: DataFrame, k: int, most: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What ``knn`` joins: the places (with ids) in their leaves, the nearest of each within its leaf, and each place's other leaves (depth, cx, cy)."""
    # the least names, kept few on the way by a rank that stops at k + 1
    first = F.row_number().over(Window.partitionBy("sample", "x", "y").orderBy("src"))
    spots = points.withColumn("r", first).where(F.col("r") <= k + 1).groupBy("sample", "x", "y").agg(F.collect_list("src").alias("ids"))
    tree = settle(quadtree(spots, most))
    leaf = ["sample", "depth", "cx", "cy"]
    leaves = settle(tree.groupBy(*leaf, "x0", "y0", "side").agg(F.sum(F.size("ids")).alias("held"), F.min("x").alias("lx"), F.min("y").alias("ly"), F.max("x").alias("hx"), F.max("y").alias("hy")))
    other = tree.select(*leaf, F.col("x").alias("px"), F.col("y").alias("py"), "ids")
    own = settle(_nearest(tree.select(*leaf, "x", "y").join(other, leaf), k))
    # leaves with too few: distances to the farthest corners of the leaves below their parent, until these hold enough
    few = leaves.where(F.col("held") <= k).withColumn("up", F.greatest(F.col("depth") - 1, F.lit(0)))
    a = few.select("sample", "depth", "cx", "cy", F.col("lx").alias("ax"), F.col("ly").alias("ay"), F.col("hx").alias("zx"), F.col("hy").alias("zy"), F.col("up").alias("l"), F.expr("shiftright(cx, depth - up)").alias("gx"), F.expr("shiftright(cy, depth - up)").alias("gy"))
    b = leaves.select("sample", F.explode(F.sequence(F.lit(0), "depth")).alias("l"), "*").select("sample", "l", F.expr("shiftright(cx, depth - l)").alias("gx"), F.expr("shiftright(cy, depth - l)").alias("gy"), "lx", "ly", "hx", "hy", "held")
    far = lambda lo, hi, p, q: F.greatest(F.col(hi) - F.col(p), F.col(q) - F.col(lo))
    span = F.sqrt(F.pow(far("lx", "hx", "ax", "zx"), 2) + F.pow(far("ly", "hy", "ay", "zy"), 2))
    rising = Window.partitionBy(*leaf).orderBy("span").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    enough = a.join(b, ["sample", "l", "gx", "gy"]).withColumn("span", span).withColumn("sum", F.sum("held").over(rising)).where(F.col("sum") > k).groupBy(*leaf).agg(F.min("span").alias("span"))
    kth = own.groupBy(*leaf, "x", "y").agg(F.max(F.when(F.col("rank") == k + 1, F.col("d"))).alias("kth"))
    # a sample with no more than k points is searched whole
    reach = kth.join(enough, leaf, "left").join(leaves.select(*leaf, "side"), leaf).select(*leaf, "x", "y", (F.coalesce("kth", "span", 2 * F.col("side")) * (1 + 1e-9)).alias("reach"))
    reach = settle(reach)
    wide = leaves.join(reach.groupBy(*leaf).agg(F.max("reach").alias("reach")), leaf)
    boxes = wide.select(*leaf, "x0", "y0", "side", *[(F.col(c) + sign * F.col("reach")).alias(n) for c, sign, n in (("lx", -1, "x1"), ("ly", -1, "y1"), ("hx", 1, "x2"), ("hy", 1, "y2"))])
    pairs = _reached(boxes, leaves).where("depth <> bdepth OR cx <> bx OR cy <> by").select(*leaf, "bdepth", "bx", "by", "lx", "ly", "hx", "hy")
    gap = lambda c: F.greatest(F.col(f"l{c}") - F.col(c), F.col(c) - F.col(f"h{c}"), F.lit(0.0))
    near = reach.join(pairs, leaf).where(F.sqrt(F.pow(gap("x"), 2) + F.pow(gap("y"), 2)) <= F.col("reach")).select("sample", "x", "y", F.col("bdepth").alias("depth"), F.col("bx").alias("cx"), F.col("by").alias("cy"))
    return tree, own, near


def knn(points: DataFrame, k: int, most: int | None = None) -> DataFrame:
    """Exact k nearest neighbours in the plane per sample: (sample, src, dst, rank, d, dx, dy); ties by dst.

    Points at one place are one row with their k + 1 least names, as no more of them can be among anyone's neighbours. Places are dealt to
    the leaves of a quadtree split by counts, at most ``most`` places each, so crowded and empty regions cost the same. The k-th distance
    within a place's own leaf bounds the search: only leaves that this circle touches are joined. Where a leaf holds too few, the nearest
    leaves of its parent that hold enough give the bound. Points without coordinates have no neighbours.
    """
    points = points.select("sample", F.col("cell_id").alias("src"), "x", "y").where("x IS NOT NULL AND y IS NOT NULL")
    tree, own, near = search(points, k, most or max(4 * k, 24))
    best = Window.partitionBy("sample", "x", "y").orderBy("d", "dst")
    other = tree.select("sample", "depth", "cx", "cy", F.col("x").alias("px"), F.col("y").alias("py"), "ids")
    rest = _nearest(near.join(other, ["sample", "depth", "cx", "cy"]).drop("depth", "cx", "cy"), k)
    both = own.select("sample", "x", "y", "px", "py", "d", "dst").unionByName(rest.select("sample", "x", "y", "px", "py", "d", "dst"))
    found = both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1)
    lists = found.groupBy("sample", "x", "y").agg(F.array_sort(F.collect_list(F.struct("rank", "dst", "d", (F.col("px") - F.col("x")).alias("dx"), (F.col("py") - F.col("y")).alias("dy")))).alias("near"))
    met = points.join(lists, ["sample", "x", "y"]).select("sample", "src", F.posexplode(F.slice(F.filter("near", lambda n: n["dst"] != F.col("src")), 1, k)).alias("at", "n"))
    return met.select("sample", "src", "n.dst", (F.col("at") + 1).alias("rank"), "n.d", "n.dx", "n.dy")


def pairs_within(points: DataFrame, radius: float) -> DataFrame:
    """Ordered pairs of a sample's points at most ``radius`` apart."""
    return _near(points, points, radius).where(F.col("d") <= radius)


def undirected(edges: DataFrame) -> DataFrame:
    """Each neighbour pair once: (sample, u, v)."""
    return edges.select("sample", F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).distinct()


def enrichment(edges: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Neighbourhood enrichment per sample and label pair (i <= j): observed joins, and mean, SD and z under permutation of labels.

    ``edges``: sample, u, v, once each; ``labels``: sample, cell_id and the label. The permutation moments are exact (join-count
    statistics), so nothing is sampled.
    """
    lab = labels.select("sample", "cell_id", F.col(label).alias("l"))
    deg = edges.select("sample", F.col("u").alias("x")).unionByName(edges.select("sample", F.col("v").alias("x"))).groupBy("sample", "x").agg(F.count("*").alias("d"))
    p = deg.groupBy("sample").agg(F.sum(F.col("d") * (F.col("d") - 1)).cast("double").alias("P"))
    m = edges.groupBy("sample").agg(F.count("*").cast("double").alias("m"))
    sizes = lab.groupBy("sample", "l").agg(F.count("*").cast("double").alias("n"))
    total = sizes.groupBy("sample").agg(F.sum("n").alias("N"))
    met = edges.join(lab.select("sample", F.col("cell_id").alias("u"), F.col("l").alias("a")), ["sample", "u"]).join(lab.select("sample", F.col("cell_id").alias("v"), F.col("l").alias("b")), ["sample", "v"])
    seen = met.groupBy("sample", F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j")).agg(F.count("*").alias("observed"))
    i, j = sizes.select("sample", F.col("l").alias("i"), F.col("n").alias("ni")), sizes.select("sample", F.col("l").alias("j"), F.col("n").alias("nj"))
    full = i.join(j, "sample").where("i <= j").join(seen, ["sample", "i", "j"], "left").na.fill(0, ["observed"]).join(p, "sample").join(m, "sample").join(total, "sample")
    n, ni, nj, mm, pp = (F.col(c) for c in ("N", "ni", "nj", "m", "P"))
    n2, n3, n4 = n * (n - 1), n * (n - 1) * (n - 2), n * (n - 1) * (n - 2) * (n - 3)
    q = mm * (mm - 1) - pp
    f = lambda x, r: x if r == 1 else f(x, r - 1) * (x - (r - 1))
    same, e_same = F.col("i") == F.col("j"), mm * f(ni, 2) / n2
    e_diff = 2 * mm * ni * nj / n2
    mean = F.when(same, e_same).otherwise(e_diff)
    square = F.when(same, e_same + F.try_divide(pp * f(ni, 3), n3) + F.try_divide(q * f(ni, 4), n4)).otherwise(e_diff + F.try_divide(pp * ni * nj * (ni + nj - 2), n3) + F.try_divide(4 * q * f(ni, 2) * f(nj, 2), n4))
    out = full.where("N >= 4").select("sample", "i", "j", "observed", mean.alias("expected"), F.sqrt(F.greatest(square - mean * mean, F.lit(0.0))).alias("sd"))
    return out.withColumn("z", F.try_divide(F.col("observed") - F.col("expected"), F.col("sd")))


#: Places in a block of points that meet another block, points in a tile within a block, tiles' pairs looked at together, and cells of a dense table of label pairs.
BLOCK, TILE, TOGETHER, DENSE = 16384, 16, 256, 1 << 22


def _tiles(row):
    """A block (array of label, x, y, w) as its labels and tiles of ``TILE`` near points: coordinates, label numbers, weights and boxes.

    The last tile is filled up with points at infinity of weight 0, which no box counts.
    """
    import numpy as np

    labels, x, y, w = row.values.flatten()
    code = np.repeat(np.arange(len(labels)), x.value_lengths().to_numpy(zero_copy_only=False))
    x, y, w = (c.flatten().to_numpy(zero_copy_only=False) for c in (x, y, w))
    m = -(-len(x) // TILE)
    strip = -(-m // int(np.ceil(np.sqrt(m)))) * TILE
    order = np.argsort(x, kind="stable")
    order = order[np.lexsort((y[order], np.arange(len(x)) // strip))]
    order = np.concatenate([order, np.full(m * TILE - len(x), order[-1])])
    code, x, y, w = (c[order].reshape(m, TILE) for c in (code, x, y, w))
    boxes = x.min(1), x.max(1), y.min(1), y.max(1)
    fill = np.arange(m * TILE).reshape(m, TILE) >= row.values.field(1).value_lengths().to_numpy(zero_copy_only=False).sum()
    x[fill], y[fill], w[fill] = np.inf, np.inf, 0
    return labels, code, x, y, w, boxes


def _pairs_by_bin(a, b, step: float, bins: int):
    """Ordered pairs of points of tiles ``a`` and tiles ``b`` (None: of ``a`` itself) by (bin, label in a, label in b), as numbers of such triples and sums of weights.

    Tiles all of whose pairs fall into one bin are counted by their labels; only pairs of tiles on a border between bins are looked at point by point.
    """
    import numpy as np

    own, b = b is None, a if b is None else b
    (la, ca, xa, ya, wa, box_a), (lb, cb, xb, yb, wb, box_b) = a, b
    size = bins * len(la) * len(lb)
    dense = size <= DENSE
    plain = max(wa.max(), wb.max()) == 1
    total, found = np.zeros(size if dense else 0, np.int64), []
    held = [np.bincount((np.arange(len(c))[:, None] * len(n) + c).ravel(), w.ravel(), len(c) * len(n)).reshape(len(c), len(n)) for c, w, n in ((ca, wa, la), (cb, wb, lb))] if dense else None

    def look(r, c):
        dx, dy = xa[r][:, :, None] - xb[c][:, None, :], ya[r][:, :, None] - yb[c][:, None, :]
        d = np.sqrt(dx * dx + dy * dy)
        at = d / step
        ok = (at < bins) & (d <= step * bins)
        triple = (at[ok].astype(np.int64) * len(la) + np.broadcast_to(ca[r][:, :, None], ok.shape)[ok]) * len(lb) + np.broadcast_to(cb[c][:, None, :], ok.shape)[ok]
        weight = None if plain else (wa[r][:, :, None] * wb[c][:, None, :])[ok]
        if dense:
            return np.bincount(triple, weight, size).astype(np.int64)
        names, where = np.unique(triple, return_inverse=True)
        return names, np.bincount(where, weight, len(names)).astype(np.int64)

    def add(got):
        if dense:
            np.add(total, got, out=total)
            return
        found.append(got)
        if len(found) == TOGETHER:
            names, where = np.unique(np.concatenate([n for n, _ in found]), return_inverse=True)
            found[:] = [(names, np.bincount(where, np.concatenate([v for _, v in found]), len(names)).astype(np.int64))]

    with np.errstate(over="ignore", invalid="ignore"):
        rows = max(1, (1 << 18) // len(xb))
        for top in range(0, len(xa), rows):
            gap, far = [], []
            for lo, hi in ((0, 1), (2, 3)):
                p, q = box_a[lo][top : top + rows, None] - box_b[hi], box_b[lo] - box_a[hi][top : top + rows, None]
                gap.append(np.maximum(np.maximum(p, q), 0))
                far.append(np.maximum(-p, -q))
            near, last = (np.floor(np.sqrt(u * u + v * v) * e / step) for (u, v), e in ((gap, 1 - 1e-9), (far, 1 + 1e-9)))
            met = near < bins
            if dense:
                whole = met & (near == last)
                for k in np.unique(near[whole]):
                    n = held[0][top : top + rows].T @ ((whole & (near == k)) @ held[1])
                    total.reshape(bins, len(la), len(lb))[int(k)] += np.rint(n).astype(np.int64)
                met &= ~whole
            r, c = np.nonzero(met)
            r += top
            if own:  # both ways at once; a tile and itself once
                r, c = r[r <= c], c[r <= c]
            for i in range(0, len(r), TOGETHER):
                u, v = r[i : i + TOGETHER], c[i : i + TOGETHER]
                if not own:
                    add(look(u, v))
                    continue
                same = u == v
                if same.any():
                    add(look(u[same], v[same]))
                if not same.all():
                    got = look(u[~same], v[~same])
                    add(got)
                    if dense:
                        add(got.reshape(bins, len(la), len(la)).transpose(0, 2, 1).ravel())
                    else:
                        k, ij = np.divmod(got[0], len(la) ** 2)
                        add((k * len(la) ** 2 + ij % len(la) * len(la) + ij // len(la), got[1]))
    if dense:
        names = np.nonzero(total)[0]
        return names, total[names]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([n for n, _ in found]), np.concatenate([v for _, v in found])


def _meet(step: float, bins: int, schema: StructType):
    """Rows (sample, side, points) as label pairs by bin: a block of side 0 meets the next row, of side 1, and one of side 2 meets itself."""

    def of(batches):
        import numpy as np
        import pyarrow as pa

        def told(sample, a, b):
            names, n = _pairs_by_bin(a, b, step, bins)
            other = a if b is None else b
            k, ij = np.divmod(names, len(a[0]) * len(other[0]))
            i, j = np.divmod(ij, len(other[0]))
            named = sample.take(pa.array(np.zeros(len(n), np.int64)))
            left, right = a[0].take(pa.array(i)), other[0].take(pa.array(j))
            for u, v in [(left, right)] if b is None else [(left, right), (right, left)]:
                yield pa.RecordBatch.from_arrays([named, pa.array(k), u, v, pa.array(n)], names=schema.fieldNames())

        first = None
        for batch in batches:
            sample, side, points = (batch.column(batch.schema.names.index(c)) for c in ("sample", "side", "points"))
            for row in range(batch.num_rows):
                block = _tiles(points[row])
                if side[row].as_py() == 2:
                    yield from told(sample.slice(row, 1), block, None)
                elif side[row].as_py() == 0:
                    first = block
                else:
                    yield from told(sample.slice(row, 1), first, block)

    return of


def label_pairs(points: DataFrame, label: str, step: float, bins: int) -> DataFrame:
    """(sample, bin, i, j, n): ordered pairs of a sample's cells by their labels and ``step`` of distance, below ``bins`` steps.

    Cells of one label at one place are one row with a weight. Places are dealt to the leaves of a quadtree, and leaves in reach of each other meet as two rows of
    points (see ``_pairs_by_bin``), dealt to partitions by the points they hold, so a task's work stays the same on larger samples. A cell does not meet itself.
    Cells without finite coordinates meet none.
    """
    kind = {f.name: f.dataType for f in points.schema}
    finite = lambda c: f"abs({c}) < double('infinity')"
    cells = points.select("sample", "cell_id", F.col(label).alias("l"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).where(f"{finite('x')} AND {finite('y')} AND sample IS NOT NULL")
    places = cells.groupBy("sample", "x", "y", "l").agg(F.count("*").alias("w"))
    leaf = ["sample", "depth", "cx", "cy"]
    tree = settle(quadtree(places, BLOCK))
    of_label = tree.groupBy(*leaf, "x0", "y0", "side", "l").agg(F.collect_list(F.struct("x", "y", "w")).alias("p"), F.count("*").alias("n"), *[f(c).alias(f"{a}{c}") for a, f in (("l", F.min), ("h", F.max)) for c in "xy"])
    held = [F.sum("n").alias("held"), *[f(c).alias(c) for c, f in (("lx", F.min), ("ly", F.min), ("hx", F.max), ("hy", F.max))]]
    blocks = settle(of_label.groupBy(*leaf, "x0", "y0", "side").agg(*held, F.collect_list(F.struct("l", F.col("p.x").alias("x"), F.col("p.y").alias("y"), F.col("p.w").alias("w"))).alias("points")))
    reach = step * bins * (1 + 1e-9)
    near = blocks.select(*leaf, "x0", "y0", "side", F.col("held").alias("own"), (F.col("lx") - reach).alias("x1"), (F.col("ly") - reach).alias("y1"), (F.col("hx") + reach).alias("x2"), (F.col("hy") + reach).alias("y2"))
    pairs = _reached(near, blocks.drop("points")).where("(depth, cx, cy) <= (bdepth, bx, by)")
    # what a pair costs: its pairs of points, and each point's unpacking
    cost = F.col("own") * F.col("held") + 1000 * (F.col("own") + F.col("held"))
    pairs = settle(pairs.select(*leaf, "bdepth", "bx", "by", cost.cast("double").alias("cost"), F.monotonically_increasing_id().alias("job")))
    n, cost = pairs.agg(F.count("*"), F.sum("cost")).first()
    parts = max(1, min(n, max(pairs.sparkSession.sparkContext.defaultParallelism, int((cost or 0) / (BLOCK * BLOCK / 2)))))
    # dearest first, dealt in turn: a row per pair of blocks
    dealt = pairs.withColumn("part", (F.row_number().over(Window.orderBy(F.desc("cost"), "job")) - 1) % parts)
    itself = F.expr("depth = bdepth AND cx = bx AND cy = by")
    second = F.struct(F.lit(1).alias("side"), F.col("bdepth").alias("depth"), F.col("bx").alias("cx"), F.col("by").alias("cy"))
    sides = F.when(itself, F.array(F.struct(F.lit(2).alias("side"), "depth", "cx", "cy"))).otherwise(F.array(F.struct(F.lit(0).alias("side"), "depth", "cx", "cy"), second))
    asked = dealt.select("sample", "job", "part", F.explode(sides).alias("o")).select("sample", "job", "part", "o.*")
    out = StructType([StructField("sample", kind["sample"]), StructField("bin", LongType()), StructField("i", kind[label]), StructField("j", kind[label]), StructField("n", LongType())])
    rows = asked.join(blocks.select(*leaf, "points"), leaf).repartitionById(parts, "part").sortWithinPartitions("job", "side").select("sample", "side", "points")
    met = rows.mapInArrow(_meet(step, bins, out), out)
    # a cell and itself, whatever its rows
    d = F.sqrt(F.pow(F.col("a.x") - F.col("b.x"), 2) + F.pow(F.col("a.y") - F.col("b.y"), 2))
    alike = cells.groupBy("sample", "cell_id", "l").agg(F.collect_list(F.struct("x", "y")).alias("p")).select("sample", "l", "p", F.explode("p").alias("a")).select("sample", "l", "a", F.explode("p").alias("b"))
    alike = alike.select("sample", F.floor(d / step).alias("bin"), F.col("l").alias("i"), F.col("l").alias("j"), F.lit(-1).cast("long").alias("n")).where((F.col("bin") < bins) & (d <= step * bins))
    return met.unionByName(alike).groupBy("sample", "bin", "i", "j").agg(F.sum("n").alias("n")).where("n > 0")


def co_occurrence(points: DataFrame, label: str, step: float, bins: int) -> DataFrame:
    """(sample, bin, i, j, ratio): share of j among i's neighbours at a distance, over j's share at that distance."""
    n = label_pairs(points, label, step, bins)
    w = lambda *c: F.sum("n").over(Window.partitionBy("sample", "bin", *c))
    return n.select("sample", "bin", "i", "j", ((F.col("n") / w("i")) / (w("j") / w())).alias("ratio"))


def square(pairs: DataFrame, value: str, labels: list[str], by: str = "sample", symmetric: bool = True) -> DataFrame:
    """Rows (sample, i, j, value) as matrices: a row per (sample, i) and a column for each of ``labels``; ``symmetric``: pairs given once count both ways."""
    both = pairs.select(by, "i", "j", value)
    if symmetric:
        both = both.unionByName(both.where("i <> j").select(by, F.col("j").alias("i"), F.col("i").alias("j"), value))
    return both.groupBy(by, "i").pivot("j", labels).agg(F.first(value))


def mean_over_distance(ratios: DataFrame) -> DataFrame:
    """Co-occurrence averaged over the distance bins, with the least and largest of all for a shared scale."""
    m = ratios.groupBy("sample", "i", "j").agg(F.avg("ratio").alias("mean_ratio"))
    return m.join(F.broadcast(m.agg(F.min("mean_ratio").alias("scale_min"), F.max("mean_ratio").alias("scale_max"))))


def refine_step(labels: DataFrame, edges: DataFrame, label: str, share: float = 0.5) -> DataFrame:
    """One round of majority refinement: a cell adopts its neighbours' most frequent label if that holds more than ``share`` of them."""
    lab = labels.select("sample", "cell_id", F.col(label).alias("l"))
    n = edges.select("sample", "src", "dst").join(lab.select("sample", F.col("cell_id").alias("dst"), "l"), ["sample", "dst"]).groupBy("sample", "src", "l").agg(F.count("*").alias("n"))
    w = Window.partitionBy("sample", "src")
    top = n.withColumn("all", F.sum("n").over(w)).withColumn("r", F.row_number().over(w.orderBy(F.desc("n"), "l"))).where((F.col("r") == 1) & (F.col("n") > share * F.col("all")))
    met = lab.join(top.select("sample", F.col("src").alias("cell_id"), F.col("l").alias("new")), ["sample", "cell_id"], "left")
    return met.select("sample", "cell_id", F.col("l").alias(f"{label}_raw"), F.coalesce("new", "l").alias(label))


def refine(labels: DataFrame, edges: DataFrame, label: str, settled: float = 0.005, most: int = 50) -> DataFrame:
    """Rounds of refine_step until fewer than ``settled`` of the cells change; the first labels stay as <label>_raw."""
    first = labels.select("sample", "cell_id", F.col(label).alias("__raw"))
    now = labels.select("sample", "cell_id", label)
    for _ in range(most):
        step = settle(refine_step(now, edges, label))
        c = step.agg(F.count_if(F.col(label) != F.col(f"{label}_raw")).alias("c"), F.count("*").alias("n")).first()
        now = step.select("sample", "cell_id", label)
        if not c["n"] or c["c"] / c["n"] < settled:
            break
    return now.join(first.withColumnRenamed("__raw", f"{label}_raw"), ["sample", "cell_id"])


def neighbour_features(values: DataFrame, edges: DataFrame, lam: float = 0.8) -> DataFrame:
    """Per (cell, gene): own value, neighbour mean and gradient magnitude, weighted by sqrt of 1 - lam, 2 lam / 3 and lam / 3.

    Weights fall as exp(-(d / sigma)^2) with sigma the sample's median neighbour distance, and sum to 1 over a cell's neighbours; the
    gradient is the modulus of the sum weighted by e^(i angle). Sparse: entries with neither own nor neighbour value are absent. A cell so far
    from all others that its weights vanish has no mean: NaN, as 0 / 0 is.
    """
    sigma = edges.groupBy("sample").agg(F.percentile("d", 0.5).alias("sigma"))
    w = edges.join(F.broadcast(sigma), "sample").withColumn("w", F.exp(-F.pow(F.try_divide("d", "sigma"), 2)))
    all_of = F.sum("w").over(Window.partitionBy("sample", "src"))
    w = w.withColumn("w", F.when(all_of == 0, float("nan")).otherwise(F.try_divide(F.col("w"), all_of))).withColumn("a", F.atan2("dy", "dx"))
    x = values.select("sample", F.col("cell_id").alias("dst"), "gene", "value")
    field = w.join(x, ["sample", "dst"]).groupBy("sample", F.col("src").alias("cell_id"), "gene").agg(
        F.sum(F.col("w") * F.col("value")).alias("mean"), F.sum(F.col("w") * F.col("value") * F.cos("a")).alias("re"), F.sum(F.col("w") * F.col("value") * F.sin("a")).alias("im")
    )
    out = values.select("sample", "cell_id", "gene", "value").join(field, ["sample", "cell_id", "gene"], "full")
    # fill() would take NaN for null
    out = out.select("sample", "cell_id", "gene", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("value", "mean", "re", "im")])
    part = lambda c, s: (F.lit(s**0.5) * c)
    return out.select("sample", "cell_id", "gene", part(F.col("value"), 1 - lam).alias("own"), part(F.col("mean"), lam * 2 / 3).alias("neighbour_mean"), part(F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im")), lam / 3).alias("gradient"))


def voronoi_cell(box: tuple[float, float, float, float], dx: list[float], dy: list[float]) -> list[tuple[float, float, int]]:
    """Corners (x, y, m) of the Voronoi cell of (0, 0) within a box, among the points at (dx, dy); the side that begins at a corner was made by point m (-1: the box).

    The cell is the box cut by the bisector of each point in turn.
    """
    lx, ly, hx, hy = box
    cell = [(lx, ly, -1), (hx, ly, -1), (hx, hy, -1), (lx, hy, -1)]
    for n, (a, b) in enumerate(zip(dx, dy, strict=True)):
        half = (a * a + b * b) / 2
        if half == 0:
            continue
        side = [a * x + b * y - half for x, y, _ in cell]
        if max(side) <= 0:
            continue
        cut = []
        for i, (x, y, m) in enumerate(cell):
            j = (i + 1) % len(cell)
            u, v, s, t = cell[j][0], cell[j][1], side[i], side[j]
            if s <= 0:
                cut.append((x, y, m))
            if (s <= 0) != (t <= 0):
                f = s / (s - t)
                # leaving the kept side, the new side begins; coming back, the old one goes on
                cut.append((x + f * (u - x), y + f * (v - y), n if s <= 0 else m))
        cell = cut
        if not cell:
            break
    return cell


def voronoi_neighbours(box: tuple[float, float, float, float], dx: list[float], dy: list[float]) -> tuple[list[int], float]:
    """Which of the points at (dx, dy) share an edge of the Voronoi cell of (0, 0) within a box, and the cell's radius."""
    cell = voronoi_cell(box, dx, dy)
    return sorted({m for _, _, m in cell if m >= 0}), max(((x * x + y * y) ** 0.5 for x, y, _ in cell), default=0.0)


_NEAR = "array<struct<d:double,dst:string,dx:double,dy:double>>"
_CELL = f"sample string, src string, x double, y double, lx double, ly double, hx double, hy double, seen double, sides {_NEAR}, discs array<struct<wx:double,wy:double,r:double>>"


def _cut(batches):
    """Rows of a cell with ``near``, points that may cut it: the row with the points that do as ``sides``, and its ``discs``.

    A point cuts a cell only within the circle around one of its corners through its middle. Points nearer than ``seen`` are all known, so circles that lie within that are left out.
    """
    import pyarrow as pa

    for b in batches:
        c = {name: b.column(i).to_pylist() for i, name in enumerate(b.schema.names)}
        out: dict[str, list] = {"sides": [], "discs": []}
        for x, y, lx, ly, hx, hy, seen, near in zip(*(c[n] for n in ("x", "y", "lx", "ly", "hx", "hy", "seen", "near")), strict=True):
            near = sorted(near, key=lambda p: (p["d"], p["dst"]))
            cell = voronoi_cell((lx - x, ly - y, hx - x, hy - y), [p["dx"] for p in near], [p["dy"] for p in near])
            out["sides"].append([near[m] for m in sorted({m for _, _, m in cell if m >= 0})])
            reach = [(u, v, (u * u + v * v) ** 0.5) for u, v, _ in cell]
            out["discs"].append([{"wx": x + u, "wy": y + v, "r": r * (1 + 1e-9)} for u, v, r in reach if seen is not None and 2 * r > seen])
        kept = [b.column(b.schema.names.index(n)) for n in ("sample", "src", "x", "y", "lx", "ly", "hx", "hy", "seen")]
        near_type = pa.list_(pa.struct([("d", pa.float64()), ("dst", pa.string()), ("dx", pa.float64()), ("dy", pa.float64())]))
        disc_type = pa.list_(pa.struct([("wx", pa.float64()), ("wy", pa.float64()), ("r", pa.float64())]))
        yield pa.RecordBatch.from_arrays([*kept, pa.array(out["sides"], near_type), pa.array(out["discs"], disc_type)], names=["sample", "src", "x", "y", "lx", "ly", "hx", "hy", "seen", "sides", "discs"])


def _cut_by(cells: DataFrame, places: DataFrame, most: int = 32) -> DataFrame:
    """``cells`` (see ``_CELL``) cut by the points of ``places`` (sample, cell_id, x, y) too.

    A cell meets the leaves of a quadtree that its discs touch. What cuts it among its own points and a leaf's stays a candidate, since a neighbour among all is one among fewer.
    """
    leaf = ["sample", "depth", "cx", "cy"]
    tree = settle(quadtree(places.select("sample", "x", "y", F.col("cell_id").alias("dst")), most))
    held = F.collect_list(F.struct("dst", "x", "y")).alias("points")
    leaves = settle(tree.groupBy(*leaf, "x0", "y0", "side").agg(F.count("*").alias("held"), F.min("x").alias("lx"), F.min("y").alias("ly"), F.max("x").alias("hx"), F.max("y").alias("hy"), held))
    root = F.broadcast(leaves.select("sample", "x0", "y0", "side").distinct())  # a row per sample
    discs = cells.select("sample", "src", F.explode("discs").alias("o")).select("sample", "src", "o.*").join(root, "sample")
    discs = discs.select("*", *[(F.col(f"w{c[0]}") + sign * F.col("r")).alias(c) for c, sign in (("x1", -1), ("y1", -1), ("x2", 1), ("y2", 1))])
    gap = lambda c: F.greatest(F.col(f"l{c}") - F.col(f"w{c}"), F.col(f"w{c}") - F.col(f"h{c}"), F.lit(0.0))
    met = _reached(discs, leaves).where(F.pow(gap("x"), 2) + F.pow(gap("y"), 2) <= F.pow("r", 2)).select("sample", "src", F.col("bdepth").alias("depth"), F.col("bx").alias("cx"), F.col("by").alias("cy")).distinct()
    known = cells.select("sample", "src", "x", "y", "lx", "ly", "hx", "hy", "seen", "sides")
    dx, dy = (lambda p: p["x"] - F.col("x")), (lambda p: p["y"] - F.col("y"))
    near = F.transform("points", lambda p: F.struct(F.sqrt(F.pow(dx(p), 2) + F.pow(dy(p), 2)).alias("d"), p["dst"].alias("dst"), dx(p).alias("dx"), dy(p).alias("dy")))
    other = F.filter(F.concat("sides", F.filter(near, lambda p: F.exists("discs", lambda o: F.pow(F.col("x") + p["dx"] - o["wx"], 2) + F.pow(F.col("y") + p["dy"] - o["wy"], 2) <= F.pow(o["r"], 2)))), lambda p: p["d"] > 0)
    each = met.join(known.join(cells.select("sample", "src", "discs"), ["sample", "src"]), ["sample", "src"]).join(leaves.select(*leaf, "points"), leaf)
    each = each.select("sample", "src", "x", "y", "lx", "ly", "hx", "hy", "seen", other.alias("near")).mapInArrow(_cut, _CELL)
    more = each.groupBy("sample", "src").agg(F.array_distinct(F.flatten(F.collect_list("sides"))).alias("more"))
    return known.join(more, ["sample", "src"], "left").select(*known.columns[:-1], F.coalesce("more", "sides").alias("near")).mapInArrow(_cut, _CELL)


def delaunay(points: DataFrame, k: int = 16, margin: float = 1.0, share: int = 64) -> DataFrame:
    """Delaunay edges (sample, u, v) within each sample's bounding box, widened by ``margin`` mean spacings.

    Two points are joined if their Voronoi cells share a side within the box. A cell that its k nearest neighbours settle (none farther
    could cut it) is done. The others, as those along the hull, look for what cuts them in the circles around their corners: first among one point in ``share``, or in its
    powers, so that few of all points are left in the circles. Points at one place are one, by the least name, to others; each of them has that one's edges. Points without
    coordinates have none. Long edges along the hull whose side lies outside the box are left out.
    """
    n = F.count("*")
    step = margin * F.sqrt((F.max("x") - F.min("x")) * (F.max("y") - F.min("y")) / n)
    box = points.groupBy("sample").agg((F.min("x") - step).alias("lx"), (F.min("y") - step).alias("ly"), (F.max("x") + step).alias("hx"), (F.max("y") + step).alias("hy"))
    points = points.select("sample", "cell_id", "x", "y").where("x IS NOT NULL AND y IS NOT NULL")
    places = settle(points.groupBy("sample", "x", "y").agg(F.min("cell_id").alias("cell_id")))
    sizes = places.groupBy("sample").agg(F.count("*").alias("places"))
    near = knn(places, k).groupBy("sample", F.col("src").alias("cell_id")).agg(F.collect_list(F.struct("d", "dst", "dx", "dy")).alias("near"))
    # where all are known, none is left to look for
    seen = F.when(F.size("near") < F.col("places") - 1, F.array_max(F.transform("near", lambda p: p["d"]))).alias("seen")
    cells = places.join(near, ["sample", "cell_id"]).join(F.broadcast(box), "sample").join(F.broadcast(sizes), "sample")
    cells = settle(cells.select("sample", F.col("cell_id").alias("src"), "x", "y", "lx", "ly", "hx", "hy", seen, "near").mapInArrow(_cut, _CELL))
    left, all_of, depth = settle(cells.where("size(discs) > 0")), places.count(), 0
    while all_of // share ** (depth + 1) >= share:
        depth += 1
    for some in range(depth, -1, -1):
        left = settle(_cut_by(left, places.where(F.pmod(F.xxhash64("cell_id"), F.lit(share**some)) == 0)))
    sides = cells.where("size(discs) = 0").unionByName(left).select("sample", "x", "y", F.explode("sides.dst").alias("dst"))
    return undirected(points.join(sides, ["sample", "x", "y"]).select("sample", F.col("cell_id").alias("src"), "dst"))


def keypoint_residuals(keypoints: DataFrame, m: list[list[float]], pixel_size: float) -> DataFrame:
    """One row: mean and largest distance of transformed from fixed keypoints, in pixels and in micrometres."""
    x, y = affine(F.col("alignmentX"), F.col("alignmentY"), m)
    d = F.sqrt(F.pow(x - F.col("fixedX"), 2) + F.pow(y - F.col("fixedY"), 2))
    return keypoints.agg(F.avg(d).alias("mean_px"), F.max(d).alias("max_px"), (F.avg(d) * pixel_size).alias("mean_um"), (F.max(d) * pixel_size).alias("max_um"))
