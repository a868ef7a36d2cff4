"""Sources and sinks: sheets, gene lists, wide counts, polygons, matrices and the contract's tables.

Ids are always text: nothing infers types. Readers are plans over spark.read; only small parameter files reach the driver.
"""

from __future__ import annotations

import fnmatch
import json
from collections.abc import Iterable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CONTRACT = {
    "counts": "sample string, cell_id string, gene string, count long",
    "cells": "sample string, cell_id string, x double, y double, region_annotation string",
    "genes": "gene string",
}


def column(df: DataFrame, name: str) -> Column:
    """A column by name, any letter case; an error names those there are."""
    hit = [c for c in df.columns if c.lower() == name.lower()]
    if not hit:
        raise ValueError(f"no column {name!r}; there are {', '.join(df.columns)}")
    return F.col(f"`{hit[0]}`")


def sheet(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A sample sheet or metadata table: all text, "#" lines skipped, missing as ""."""
    df = spark.read.option("sep", sep).option("comment", "#").option("header", True).csv(path)
    return df.na.fill("")


def indexed(spark: SparkSession, path: str, index: str = "cell_id", sep: str = "\t") -> DataFrame:
    """A table whose first column is an id, under whatever name; missing stays null."""
    df = spark.read.option("sep", sep).option("comment", "#").option("header", True).csv(path)
    return df.withColumnRenamed(df.columns[0], index)


def niche_labels(spark: SparkSession, path: str) -> DataFrame:
    """(cell_id, spatial_niche): that column, or else the first after the id."""
    df = indexed(spark, path)
    name = "spatial_niche" if "spatial_niche" in df.columns else df.columns[1]
    return df.select("cell_id", F.col(f"`{name}`").alias("spatial_niche"))


def gene_lists(spark: SparkSession, path: str) -> DataFrame:
    """A ragged table of lists as rows (entry, gene)."""
    from cytogrid.operators.signatures import entries

    return entries(spark.read.option("sep", "\t").option("comment", "#").option("header", True).csv(path))


def has_content(df: DataFrame, *but: str) -> bool:
    """Whether any row has something beside the columns ``but``."""
    cols = [c for c in df.columns if c not in but]
    return bool(cols) and not df.where(F.coalesce(*[F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) for c in cols]).isNotNull()).isEmpty()


def wide_counts(wide: DataFrame, meta: DataFrame, sample: str, id_col: str, drop_blank: bool = True) -> DataFrame:
    """Cell x gene columns as long counts of the cells that the metadata has; control genes ("blank...", any case) go. Raises if none is left."""
    genes = [c for c in wide.columns if c != id_col and not (drop_blank and c.lower().startswith("blank"))]
    long = wide.unpivot([F.col(id_col).cast("string").alias("cell_id")], [F.col(f"`{g}`").cast("long").alias(g) for g in genes], "gene", "count").where("count <> 0")
    out = long.join(meta.select(F.col(id_col).cast("string").alias("cell_id")).distinct(), "cell_id", "left_semi").select(F.lit(sample).alias("sample"), "cell_id", "gene", "count")
    if out.isEmpty():
        raise ValueError("no cell of the counts is in the metadata")
    return out


def polygons(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON features as (ord, region, ring): outer rings in file order, named by their classification or "Unlabeled"."""
    text = spark.read.text(path, wholetext=True)
    kind = "struct<features:array<struct<geometry:struct<type:string,coordinates:array<array<array<double>>>>,properties:struct<name:string,classification:string>>>>"
    f = text.select(F.from_json("value", kind).alias("j")).select(F.posexplode("j.features").alias("ord", "f"))
    name = F.coalesce(F.get_json_object("f.properties.classification", "$.name"), F.lit("Unlabeled"))
    ring = F.transform(F.element_at("f.geometry.coordinates", 1), lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    return f.select("ord", name.alias("region"), ring.alias("ring"))


def affine_matrix(lines: Iterable[str]) -> list[list[float]]:
    """Nine numbers, by commas or white space, as a 3 x 3 matrix; its last row must be 0 0 1."""
    v = [float(x) for line in lines for x in line.replace(",", " ").split()]
    if len(v) != 9:
        raise ValueError(f"{len(v)} numbers; an affine matrix has 9")
    m = [v[i : i + 3] for i in (0, 3, 6)]
    if m[2] != [0.0, 0.0, 1.0]:
        raise ValueError("the last row of an affine matrix is 0 0 1")
    return m


def inverse(m: list[list[float]]) -> list[list[float]]:
    (a, b, c), (d, e, f), _ = m
    det = a * e - b * d
    return [[e / det, -b / det, (b * f - c * e) / det], [-d / det, a / det, (c * d - a * f) / det], [0.0, 0.0, 1.0]]


def first_that_has(spark: SparkSession, *paths: str | None) -> str | None:
    """The first path that has files: external input before own output. Globs are allowed; "folder/**/pattern" looks at every depth below the folder."""
    for p in paths:
        if p and _found(spark, p):
            return p
    return None


def _found(spark: SparkSession, path: str) -> list[str]:
    """Paths that match, in order of name."""
    folder, deep, pattern = path.partition("/**/")
    top = spark._jvm.org.apache.hadoop.fs.Path(folder if deep else path)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    here = [s.getPath() for s in files.globStatus(top) or ()]
    if not deep:
        return sorted(str(x) for x in here)
    out = []
    for at in here:
        each = files.listFiles(at, True)
        while each.hasNext():
            x = each.next().getPath()
            if fnmatch.fnmatch(x.getName(), pattern):
                out.append(str(x))
    return sorted(out)


def files_of(spark: SparkSession, *paths: str | None) -> list[str]:
    """The files of the first path that has any, none where no path has."""
    return next((f for p in paths if p and (f := _found(spark, p))), [])


def bin_cells(bins: DataFrame, positions: DataFrame) -> DataFrame:
    """Cell centroids (cell_id, x, y) from a bin-to-cell map (bin, cell_id) and bin positions (bin, row, col); unassigned bins are dropped."""
    real = bins.where(F.col("cell_id").isNotNull() & ~F.lower(F.col("cell_id")).isin("0", "nan"))
    return real.join(positions, "bin").groupBy("cell_id").agg(F.avg("col").alias("x"), F.avg("row").alias("y"))


def vendor_labels(df: DataFrame, id_col: str, label_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("string").alias("cell_id"), F.coalesce(F.nullif(F.trim(label_col), F.lit("")), F.lit("Unannotated")).alias("label"))


def read_contract(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The contract's tables with their declared types; further columns of cells are kept."""
    counts = spark.read.schema(CONTRACT["counts"]).parquet(f"{folder}/counts")
    cells = spark.read.parquet(f"{folder}/cells")
    cells = cells.withColumns({"sample": F.col("sample").cast("string"), "cell_id": F.col("cell_id").cast("string")})
    return {"counts": counts, "cells": cells, "genes": spark.read.schema(CONTRACT["genes"]).parquet(f"{folder}/genes")}


def write_stage(df: DataFrame, path: str) -> None:
    """A stage's table, a folder per sample."""
    df.write.mode("overwrite").partitionBy("sample").parquet(path)


def write_table(df: DataFrame, path: str, header: dict[str, str] | None = None) -> None:
    """A TSV with its provenance, and when it was written, in a JSON beside it."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)
    if header is not None:
        note = {"written": datetime.now(UTC).isoformat(timespec="seconds"), **header}
        df.sparkSession.createDataFrame([(json.dumps(note, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.meta")


def write_per_sample(df: DataFrame, path: str) -> None:
    """A folder of TSV files per sample."""
    df.write.mode("overwrite").partitionBy("sample").option("sep", "\t").option("header", True).csv(path)


def scale_factors(spark: SparkSession, path: str) -> dict[str, float]:
    """The numbers of a scale-factor JSON by name; raises where it is not one object of numbers."""
    text = spark.read.text(path, wholetext=True).first()
    got = json.loads(text["value"]) if text else None
    if not isinstance(got, dict):
        raise ValueError(f"{path} is not a JSON object")
    return {k: float(v) for k, v in got.items() if isinstance(v, int | float) and not isinstance(v, bool)}


def image_scale(sample: str, level: int, small: tuple[int, int], full: tuple[int, int], pixel_um: float) -> dict[str, str | int | float]:
    """How a reduced image (height, width) relates to the full one and to micrometres."""
    if small[0] <= 0 or full[0] <= 0:
        raise ValueError("an image has a height above 0")
    factor = full[0] / small[0]
    return {"sample": sample, "level": level, "height": small[0], "width": small[1], "full_height": full[0], "full_width": full[1], "scale": factor, "pixel_um": pixel_um, "scaled_pixel_um": factor * pixel_um}


def write_json(spark: SparkSession, fields: dict[str, str | int | float], path: str) -> None:
    spark.createDataFrame([(json.dumps(fields),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_report(checks: DataFrame, passed: Column, path: str) -> bool:
    """The validation report, written only if it passed; its absence stops later stages."""
    row = checks.select(passed.alias("ok")).first()
    if not row["ok"]:
        return False
    checks.write.mode("overwrite").json(path)
    return True


def annotation_template(spark: SparkSession, columns: list[str], clusters: int = 50) -> DataFrame:
    """A blank table of clusters by "<sample>_<resolution>" columns."""
    return spark.range(clusters).select(F.col("id").cast("string").alias("cluster"), *[F.lit("").alias(c) for c in columns])


def palette_of(groups: DataFrame, group: str, colour: str) -> DataFrame:
    """The most frequent colour of each group, ties by text, in order of group."""
    n = groups.groupBy(group, colour).agg(F.count("*").alias("n"))
    return n.groupBy(group).agg(F.min_by(F.col(colour), F.struct((-F.col("n")).alias("n"), F.col(colour))).alias(colour))
