"""Mixing sources to target weights by systematic sampling.

Each source's target is its weight's share of all words, stopped at ``most_copies`` times the source's words, with the
excess shared anew by weight until no target is above that. Within a source every document has the same expected number of
copies; these are prefix-summed in order of size, one random offset is added, and a document is emitted once per integer
boundary that its interval crosses. In size order, the words taken are within about one document of the target. The offset is
seeded by the source's name, so reruns agree.

Scale: a source may hold most rows, so ranks are never made by one window over it. Rows are counted by (source, size, split), with as
many splits as the number of rows asks for; the counts are prefix-summed in bounded steps (classes of sizes, sizes, splits), and
a row's rank is that offset plus its rank among the few rows of its cell. Sources are ordered by one sort of their own table, one row
per source, and sent to the tasks only if few.

Defined cases: null text has size 0; null source is a source of its own, last in order; sources without words get target 0; rows of
equal size come in order of a digest of the id, then of the id, then of the text, so ties fall the same way in each run; repeated rows are documents of their own,
each with its own copies (rows of one id stay in one cell, which is streamed); ids may have any type; a text counts as a whole however long;
an empty table gives an empty result; further columns are ignored by ``mix`` and kept by ``mixed_documents``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytogrid.llm.common import col, materialize, n_words, row_key, rows_again

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Splits of equal sizes at least, and one per so many rows.
LEAST_SPLITS, ROWS_PER_SPLIT = 64, 50_000
#: Sources that are sent to all tasks at most.
MOST_BROADCAST = 10_000


def source_targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """``totals`` (source, source_size) with each source's ``target``.

    The capped sources are the first ones in order of size per weight; the level of the others follows from what these leave.
    """
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    rising = Window.orderBy(F.col("source_size") / F.col("w"), F.col("ord")).rowsBetween(Window.unboundedPreceding, -1)
    t = totals.withColumn("ord", F.row_number().over(in_order))
    t = t.withColumn("w", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.pmod(F.col("ord") - 1, F.lit(len(weights))) + 1).cast("int")))
    t = t.withColumn("all_size", F.sum("source_size").over(everything)).withColumn("all_w", F.sum("w").over(everything))
    before = lambda c: F.coalesce(F.sum(c).over(rising), F.lit(0))
    t = t.withColumn("level", (F.col("all_size") - most_copies * before("source_size")) / (F.col("all_w") - before("w")).cast("double"))
    free = F.col("level") * F.col("w") <= most_copies * F.col("source_size")
    rank = F.struct(F.col("source_size") / F.col("w"), F.col("ord"))
    t = t.withColumn("level", F.min_by(F.col("level"), F.when(free, rank)).over(everything))
    return t.select("source", "source_size", F.least(F.coalesce(F.col("level") * F.col("w"), F.lit(0.0)), (most_copies * F.col("source_size")).cast("double")).alias("target"))


def _digest(text: Column) -> Column:
    """A number from 0 to 2^32 - 1."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def offset_of(source: Column) -> Column:
    """The source's seeded random offset, in [0, 1)."""
    return _digest(F.concat(F.coalesce(source, F.lit("")), F.lit(":0"))).cast("double") / F.lit(4294967296.0)


def _copies(rank: Column, rate: Column, offset: Column) -> Column:
    return (F.floor(rank * rate + offset) - F.floor((rank - 1) * rate + offset)).cast("long")


def _drawn(docs: DataFrame, carried: Column, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], most_copies: int, least_splits: int) -> DataFrame:
    """Per row: ``carried``, source, size, source_size, target and copies."""
    text, key = col(text_col), F.coalesce(col(id_col).cast("string"), F.lit(""))
    # a null source is grouped under "n", others under "s..."; joins then need no null-safe keys
    source = col(source_col).cast("string")
    sized = materialize(docs.select(carried.alias("carried"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")).alias("skey"), source.alias("source"), n_words(text).alias("size"), _digest(key).alias("digest"), col(id_col).alias("id"), F.xxhash64(text).alias("th")))
    splits = max(least_splits, sized.count() // ROWS_PER_SPLIT)
    # ranges of digests, so that the order is (digest, id, text) for any number of splits
    sized = sized.withColumn("split", F.shiftright(F.col("digest") * splits, 32))
    cells = materialize(sized.groupBy("skey", "size", "split").agg(F.count("*").alias("n"), F.first("source").alias("source")))
    totals = cells.groupBy("skey").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.first("source").alias("source"))
    targets = source_targets(totals.drop("skey"), weights, most_copies).withColumn("skey", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    targets = materialize(targets.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))))
    earlier = lambda *key: Window.partitionBy(*key[:-1]).orderBy(key[-1]).rowsBetween(Window.unboundedPreceding, -1)
    # sizes are prefix-summed within classes of like sizes, and the few classes within the source
    sizes = cells.groupBy("skey", "size").agg(F.sum("n").alias("n")).withColumn("cls", F.floor(F.log2(F.col("size") + 1) * 8).cast("int"))
    classes = sizes.groupBy("skey", "cls").agg(F.sum("n").alias("n")).withColumn("over", F.coalesce(F.sum("n").over(earlier("skey", "cls")), F.lit(0))).select("skey", "cls", "over")
    sizes = sizes.withColumn("above", F.coalesce(F.sum("n").over(earlier("skey", "cls", "size")), F.lit(0)))
    by_size = sizes.join(classes, ["skey", "cls"]).select("skey", "size", (F.col("above") + F.col("over")).alias("above"))
    within = cells.withColumn("beside", F.coalesce(F.sum("n").over(earlier("skey", "size", "split")), F.lit(0))).select("skey", "size", "split", "beside")
    first = within.join(by_size, ["skey", "size"]).select("skey", "size", "split", (F.col("above") + F.col("beside")).alias("first"))
    ranked = sized.withColumn("place", F.row_number().over(Window.partitionBy("skey", "size", "split").orderBy("digest", "id", "th"))).join(first, ["skey", "size", "split"])
    few = targets.select("skey", "source_size", "target", "rate")
    ranked = ranked.join(F.broadcast(few) if few.count() <= MOST_BROADCAST else few, "skey")
    copies = _copies(F.col("first") + F.col("place"), F.col("rate"), offset_of(F.col("source")))
    return ranked.select("carried", "source", "size", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES, least_splits: int = LEAST_SPLITS) -> DataFrame:
    """Per row: id, size (words), source, source_size, target and copies (how often the mix emits it)."""
    out = _drawn(docs, col(id_col), id_col, text_col, source_col, weights, most_copies, least_splits)
    return out.select(F.col("carried").alias(id_col), "source", "size", "source_size", "target", "copies")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES, least_splits: int = LEAST_SPLITS) -> DataFrame:
    """The rows of ``docs`` as the mix emits them, all columns; each row appears as often as the mix takes it.

    Rows alike in id, text and source share what these rows take, as evenly as can be.
    """
    keys = ["key", "th", "skey"]
    source = F.coalesce(F.concat(F.lit("s"), col(source_col).cast("string")), F.lit("n")).alias("skey")
    drawn = _drawn(docs, F.struct(*row_key(docs, id_col, text_col), source), id_col, text_col, source_col, weights, most_copies, least_splits)
    taken = drawn.groupBy("carried.key", "carried.th", "carried.skey").agg(F.sum("copies").alias("taken"), F.count("*").alias("rows")).where("taken > 0")
    met = docs.select(F.struct("*").alias("row"), *row_key(docs, id_col, text_col), source).join(taken, keys)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("taken"))
    copies = F.expr("taken div rows").cast("int") + F.when(nth <= F.col("taken") % F.col("rows"), 1).otherwise(0)
    emitted = met.select("row", copies.alias("copies")).where("copies > 0")
    return rows_again(emitted.select("row", F.explode(F.sequence(F.lit(1), "copies"))))
