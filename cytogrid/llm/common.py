"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space; the same everywhere in this subpackage.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``; where that is unset, a temporary one in local mode and an error elsewhere."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="cytogrid-checkpoint-")
        spark.sparkContext.setCheckpointDir(shared)
    return shared.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared folder. A reliable checkpoint survives lost executors and cuts the lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The same as Parquet, which takes a fraction of the room of a checkpoint's rows."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def blank_if_null(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def bind(value: Column, f) -> Column:
    """f(value), with the value computed once for each row or element."""
    return F.element_at(F.transform(F.array(value), f), 1)


def col(name: str) -> Column:
    """The column of just that name, also where it holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_key(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """Columns ``key`` (of the id, also of none) and ``th`` (the text's hash): rows alike in both are one document read twice."""
    return [F.coalesce(F.concat(F.lit("s"), col(id_col).cast("string")), F.lit("n")).alias("key"), F.xxhash64(col(text_col).cast("string")).alias("th")]


def keyed_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each row as one struct, ``row``, beside its ``row_key``, so that no private column can clash with the row's own; ``rows_again`` undoes it."""
    return docs.select(F.struct("*").alias("row"), *row_key(docs, id_col, text_col))


def rows_again(df: DataFrame) -> DataFrame:
    return df.select("row.*")
