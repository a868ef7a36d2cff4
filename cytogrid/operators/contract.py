"""The input contract: hard and soft checks of a counts/cells pair, label cleaning and label overlap.

Every check is a conditional aggregate, so one pass over each table decides all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labels that mean "no label", lower case (fixed values of the data format).
BLANK_LABELS = ("nan", "unannotated")


def is_label(label: Column) -> Column:
    """Whether a label says something: not null, not blank, not one of BLANK_LABELS."""
    clean = F.lower(F.trim(label))
    return F.coalesce((clean != "") & ~clean.isin(*BLANK_LABELS), F.lit(False))


def hard_checks(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """One row of counts that must be zero (n_*) or positive (cells, genes)."""
    of_counts = counts.agg(
        F.count_distinct("gene").alias("genes"),
        F.count_if((F.col("count") < 0) | F.col("count").isNull()).alias("n_negative"),
        F.count_if(F.isnan(F.col("count").cast("double")) | (F.col("count").cast("double") == float("inf"))).alias("n_not_finite"),
        F.count_if(F.col("count").cast("double") != F.floor(F.col("count").cast("double"))).alias("n_not_integer"),
        (F.count("*") - F.count_distinct("sample", "cell_id", "gene")).alias("n_duplicate_entries"),
    )
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    of_cells = cells.agg(
        F.count("*").alias("cells"),
        (F.count("*") - F.count_distinct("sample", "cell_id")).alias("n_duplicate_ids"),
        F.count_if(~(finite("x") & finite("y"))).alias("n_bad_coordinates"),
        F.count_if(F.col("sample").isNull()).alias("n_no_sample"),
    )
    return of_cells.join(of_counts)


def passed() -> Column:
    """Over a hard_checks row."""
    zero = ("n_negative", "n_not_finite", "n_not_integer", "n_duplicate_entries", "n_duplicate_ids", "n_bad_coordinates", "n_no_sample")
    ok = (F.col("cells") > 0) & (F.col("genes") > 0)
    for c in zero:
        ok = ok & (F.col(c) == 0)
    return ok


def soft_checks(cells: DataFrame, genes: DataFrame, mito_prefixes: tuple[str, ...]) -> DataFrame:
    """One row: ``warnings``, the names of the soft checks that fail."""
    c = cells.agg(F.count_if(is_label(F.col("region_annotation"))).alias("labelled"), F.count_if(F.col("cell_id").isNull()).alias("idless"))
    mito = F.lit(False)
    for p in mito_prefixes:
        mito = mito | F.col("gene").startswith(p)
    g = genes.agg(F.count_if(mito).alias("mito"))
    return c.join(g).select(F.array_compact(F.array(F.when(F.col("labelled") == 0, "no_region"), F.when(F.col("idless") > 0, "cell_id_missing"), F.when(F.col("mito") == 0, "no_mito"))).alias("warnings"))


def label_overlap(ids: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """One row: annotated (labels that say something), matched (of these, with an id in ``ids``), fraction."""
    a = labels.where(is_label(F.col(label_col))).select(id_col).distinct().withColumn("a", F.lit(1))
    met = a.join(ids.select(id_col).distinct().withColumn("b", F.lit(1)), id_col, "left")
    return met.agg(F.count("a").alias("annotated"), F.count("b").alias("matched")).withColumn("fraction", F.round(F.try_divide("matched", "annotated"), 6))


def require(df: DataFrame, condition: Column, message: str) -> None:
    """Raise unless ``condition`` holds on the first row of ``df`` (a row of aggregates)."""
    row = df.select(condition.alias("ok")).first()
    if not row or not row["ok"]:
        raise ValueError(message)


def plain_types(df: DataFrame, flags: tuple[str, ...] = ()) -> DataFrame:
    """Contract types: flags without null (false), whole numbers as long, other numbers as double; idempotent."""
    out = {}
    for name, kind in df.dtypes:
        c = F.col(name)
        if name in flags or kind == "boolean":
            out[name] = F.coalesce(c.cast("boolean"), F.lit(False))
        elif kind in ("tinyint", "smallint", "int", "bigint"):
            out[name] = c.cast("long")
        elif kind == "float" or kind.startswith("decimal"):
            out[name] = c.cast("double")
    return df.withColumns(out) if out else df
