"""Scalar functions of the data formats: ids, names, labels, numbers. All are column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Roles in order of precedence, and the words in channel names that give them (fixed values of the data format).
CHANNEL_ROLES = (
    ("nuclear", ("dapi", "nucl", "hoechst")),
    ("rna", ("18s", "rna", "interior")),
    ("membrane", ("boundary", "membrane", "atp1a1", "cadherin", "e-cad", "ecad", "cd45")),
    ("cytoplasm", ("alphasma", "sma", "vimentin", "actin", "cytoplasm")),
)



def cell_key(cell_id: Column) -> Column:
    """A cell id without "cellid_", a trailing "-1" and leading zeros, if a whole number is left; else unchanged."""
    bare = F.regexp_replace(F.regexp_replace(cell_id, "-1$", ""), "^cellid_", "")
    return F.coalesce(F.when(bare.rlike("^[0-9]+$"), bare.try_cast("bigint").cast("string")), cell_id)


def cell_key_loose(cell_id: Column) -> Column:
    """The same with any letter case, on text alone: zeros stripped, "0" if none is left."""
    bare = F.regexp_replace(F.regexp_replace(cell_id, "(?i)^cellid_", ""), "-1$", "")
    stripped = F.regexp_replace(bare, "^0+", "")
    return F.when(stripped == "", "0").otherwise(stripped)


def file_safe(name: Column, strict: bool = False) -> Column:
    """A name for files: "/" and " " become "_"; ``strict``: anything but letters, digits and "_", runs joined, none at the end."""
    if not strict:
        return F.translate(name, "/ ", "__")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(name, "[^A-Za-z0-9_]", "_"), "_+", "_"), "_+$", "")


def sample_of_file(path: Column, pattern: str | None = None) -> Column:
    """Sample name from a file path: a pattern's first group, or the stem without "adata_" and "_annotated"."""
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    return F.regexp_extract(stem, pattern, 1) if pattern else F.regexp_replace(F.regexp_replace(stem, "^adata_", ""), "_annotated$", "")


def resolution_of(column: Column, sample: Column) -> Column:
    """The rest of "<sample>_<resolution>" if the column belongs to the sample, else null."""
    head = F.concat(sample, F.lit("_"))
    return F.when(F.startswith(column, head), F.substring(column, F.length(head) + 1, F.length(column)))


def annotation_name(column: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(column, "^cell_type_", "")))


def channel_role(name: Column) -> Column:
    """The first role one of whose words is in the name, in any letter case; null where none is."""
    low = F.lower(name)
    return F.coalesce(*[F.when(F.greatest(*[low.contains(w) for w in words]), role) for role, words in CHANNEL_ROLES])


def class_name(classification: Column, key: str = "$.name", default: str = "Unlabeled") -> Column:
    """The name in a classification's JSON text, or the default."""
    return F.coalesce(F.get_json_object(classification, key), F.lit(default))


#: Region names that stand for another (fixed values of the data format): necrotic areas are air bubbles.
REGION_NAMES = {"Necrosis": "Bubble"}


def remap(label: Column, names: dict[str, str] = REGION_NAMES) -> Column:
    """The label, or what stands for it in ``names``."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), label), label) if names else label


def unique_names(df: DataFrame, name: str, order: str) -> DataFrame:
    """Repeated names get "-1", "-2", ... in order, the first stays."""
    n = F.row_number().over(Window.partitionBy(name).orderBy(order)) - 1
    return df.withColumn(name, F.when(n > 0, F.concat_ws("-", name, n.cast("string"))).otherwise(F.col(name)))


def ladder(low: Column, high: Column, step: Column) -> Column:
    """Inclusive ladder of resolutions."""
    return F.transform(F.sequence(F.lit(0), F.round((high - low) / step).cast("int")), lambda i: F.round(low + i * step, 10))


def whole(text: Column) -> Column:
    """Text as a whole number by way of a float; null where it is none."""
    v = text.try_cast("double")
    return F.when(F.isnan(v), None).otherwise(v).try_cast("bigint")


def shown(value: Column, digits: int = 3) -> Column:
    """A number for a report: rounded, "NA" where there is none."""
    return F.coalesce(F.when(~F.isnan(value), F.round(value, digits).cast("string")), F.lit("NA"))


def half_even(value: Column) -> Column:
    return F.bround(value, 0)


def nearest_scale(ratio: Column, scale: float) -> Column:
    """Which of scale, 1 and 1 / scale a ratio of spans is nearest to."""
    options = F.transform(F.array(F.lit(scale), F.lit(1.0), F.lit(1 / scale)), lambda s: F.struct(F.abs(ratio - s).alias("d"), s.alias("s")))
    return F.array_min(options)["s"]
