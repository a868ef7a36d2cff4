"""Quality rules judged per document and per host.

Every document is held against a few rules. Failures are summed by host (the domain a document comes from), a host's failure
rate is shrunk by a beta prior fitted to all hosts' rates (method of moments), and a host whose shrunk rate is over the limit
rejects its documents. Documents that fail a base rule are rejected whatever their host.

Scale: the counts are taken within each row, so no words are shuffled; only (host, counts) go through a partial aggregate, so a
host with most rows costs one row per task. The host table joins back by its key.

Defined cases: null and empty texts have no words and fail; a null host is a host of its own; a text is measured as a whole however long; repeated
rows are judged alike, each as a row of its host; a host right at the limit is kept; an empty table gives an empty result; further columns
are ignored by ``judge`` and kept by ``passing_documents``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytogrid.llm.common import SPACE, WORD, blank_if_null, col, materialize, row_key, rows_again

MIN_WORDS = 50
#: Percent of words in repeated 3-word windows.
MOST_REPEATED = 50
WINDOW = 3
#: Percent of symbols to words, and of lines that repeat, for the rules that count against the host only.
MOST_SYMBOLS = 50
MOST_DUP_LINES = 30
#: A host is rejected if its shrunk failure rate is over this.
HOST_LIMIT = 0.5
#: Hosts whose verdicts are sent to all tasks at most.
MOST_BROADCAST = 10_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def repeated_words(hashes: Column, window: int = WINDOW) -> Column:
    """Words in windows (given by their hashes, in order) that are found twice or more."""
    marked = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    in_order = F.sort_array(marked)

    def twice(x: Column, k: Column, all_: Column) -> Column:
        return (F.get(all_, k - 1)["h"] == x["h"]) | (F.get(all_, k + 1)["h"] == x["h"])

    # the filter's lambda sees the sorted array as one element, so it is sorted once
    kept = F.flatten(F.transform(F.array(in_order), lambda a: F.filter(a, lambda x, k: F.coalesce(twice(x, k, a), F.lit(False)))))
    places = F.array_sort(F.transform(kept, lambda x: x["i"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last"))
    return F.aggregate(
        places,
        start,
        lambda s, i: F.struct((s["n"] + F.least(i - s["last"], F.lit(window))).alias("n"), i.alias("last")),
        lambda s: s["n"],
    )


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def measures(docs: DataFrame, *keep: str, text_col: str = "text") -> DataFrame:
    """``keep`` columns with MEASURES (long); ``keep`` has none of these names."""
    text = F.col("__text")
    t = docs.select(*keep, blank_if_null(col(text_col)).alias("__text"))
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(WORD))
    t = t.select(*keep, "__text", words_of(text).alias("__words"), lines.alias("__lines"))
    w = F.col("__words")
    n = F.size(w)
    hashes = F.when(n < WINDOW, F.array().cast("array<bigint>")).otherwise(F.transform(F.slice(w, 1, F.greatest(n - (WINDOW - 1), F.lit(1))), lambda a, i: F.xxhash64(a, F.get(w, i + 1), F.get(w, i + 2))))
    t = t.select(
        *keep,
        n.cast("long").alias("n_words"),
        F.length(F.regexp_replace("__text", SPACE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("__text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        hashes.alias("__hashes"),
    )
    h = F.col("__hashes")
    repeats = F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(repeated_words(h))
    return t.withColumn("n_repeat_words", repeats.cast("long")).drop("__hashes")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def host_failed() -> Column:
    return base_failed() | (100 * F.col("n_symbols") > MOST_SYMBOLS * F.col("n_words")) | (100 * F.col("n_dup_lines") > MOST_DUP_LINES * F.col("n_lines"))


def host_verdicts(measured: DataFrame, host: str, limit: float = HOST_LIMIT) -> DataFrame:
    """(``host``, host_rate, host_ok) from ``failed``: failure rates shrunk by a beta prior that all hosts' rates give."""
    hosts = measured.groupBy(host).agg(F.count("*").alias("n"), F.count_if(F.col("failed")).alias("f"))
    rates = hosts.agg(F.avg(F.col("f") / F.col("n")).alias("m"), F.var_pop(F.col("f") / F.col("n")).alias("v"))
    # a + b of the prior; with no spread between hosts it is held at a large number
    strength = F.when(F.col("v") > 0, F.greatest(F.lit(1.0), F.least(F.col("m") * (1 - F.col("m")) / F.col("v") - 1, F.lit(1000.0)))).otherwise(F.lit(1000.0))
    prior = rates.select("m", strength.alias("ab"))
    # one row of two numbers
    rated = hosts.crossJoin(F.broadcast(prior)).select(host, ((F.col("f") + F.col("m") * F.col("ab")) / (F.col("n") + F.col("ab"))).alias("host_rate"))
    return rated.withColumn("host_ok", F.col("host_rate") <= limit)


def judge(docs: DataFrame, *keep: str, text_col: str = "text", host_col: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """``keep`` columns with the measures, base_failed, host_rate and kept."""
    judged = _judged(docs, F.struct(*[col(k).alias(k) for k in keep]), text_col, host_col, limit)
    return judged.select(*[F.col("row").getField(k).alias(k) for k in keep], *MEASURES, "base_failed", "host_rate", "kept")


def _judged(docs: DataFrame, row: Column, text_col: str, host_col: str, limit: float) -> DataFrame:
    """Per row: ``row``, the measures, base_failed, host_rate and kept."""
    host = F.coalesce(F.concat(F.lit("s"), col(host_col).cast("string")), F.lit("n"))
    measured = measures(docs.select(row.alias("row"), host.alias("host"), col(text_col).cast("string").alias("text")), "row", "host")
    measured = materialize(measured.withColumn("base_failed", base_failed()).withColumn("failed", host_failed()))
    # a table of its own, so that both sides of the join are plain shuffles, of which a hot host's can be split; sent to all tasks if few
    verdicts = materialize(host_verdicts(measured, "host", limit))
    verdicts = F.broadcast(verdicts) if verdicts.count() <= MOST_BROADCAST else verdicts
    return measured.join(verdicts, "host").withColumn("kept", ~F.col("base_failed") & F.col("host_ok"))


def passing_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """The rows of ``docs``, all columns, that are kept; each row is judged by its own text and host."""
    host = F.coalesce(F.concat(F.lit("s"), col(host_col).cast("string")), F.lit("n"))
    keys = ["key", "th", "host"]
    judged = _judged(docs, F.struct(*row_key(docs, id_col, text_col), host.alias("host")), text_col, host_col, limit)
    # one text of one host has one verdict, so rows that share all keys stay or go together
    kept = judged.where("kept").select("row.*").distinct()
    return rows_again(docs.select(F.struct("*").alias("row"), *row_key(docs, id_col, text_col), host.alias("host")).join(kept, keys, "left_semi"))
