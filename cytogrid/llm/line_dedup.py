"""Line dedup by content-defined chunks of lines.

Method: each line is hashed, and a rolling hash over the last few line hashes decides whether a chunk ends after a line, so
boundaries depend on content alone and fall on the same lines again wherever a passage is moved to. A chunk also ends where a passage does:
between two lines that stand side by side less often in the corpus than one of them does with its other neighbour. A line of fifty
words or more is a passage in itself and always a chunk of its own. Chunks of several lines, and such long lines, that
occur anywhere else in the corpus are removed but for the first occurrence (least id, then least line), after their bytes have been
compared. A chunk of one short line stands for the pairs that it forms with the neighbours it repeats with: it is removed where such a
pair occurred before.

Scale: chunk records are hashes and positions, and so are the pairs of lines that are counted. Only chunks whose 128-bit key and length
repeat have their text read again; these are compared by min(text) = max(text) within the key, which combines within each task
first, so a passage that millions of documents share ships one copy per task. A key whose texts differ is left in place whole. A
document's lines are chunked from their hashes; its text is shuffled by its id for the comparison and for the result. Nothing runs in Python.

Defined cases: null text stays null; the empty text has no chunk; rows repeated with the same id and text are one document
and get the same result; a null id is an id like others; texts without repeats are unchanged byte for byte; of equal passages in one document the first
stays; a text counts as a whole however long; an empty table gives an empty result; further columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytogrid.llm.common import SPACE, WORD, bind, col, stored

#: Lines in the rolling window, and one boundary per so many lines on average.
ROLLING_LINES = 2
LINES_PER_CHUNK = 3
LONG_LINE_WORDS = 50
SALTS = 32
#: The rolling hash is the last lines' codes as digits to this base, multiplied and shifted; both leave the order of lines in it.
BASE, FACTOR, MODULUS, SHIFT = 31, 40_503, 1 << 26, 1 << 10
_KEY = ["h1", "h2", "len"]


def _is_long(line: Column, words: int) -> Column:
    space, word = SPACE[:-1], WORD[:-1]
    return (F.length(line) >= 2 * words - 1) & line.rlike(rf"^{space}*+(?:{word}++{space}++){{{words - 1}}}{word}")


def line_notes(text: Column, long_words: int = LONG_LINE_WORDS) -> Column:
    """Per line its two hashes, its code for the rolling hash, its length, and whether it is long or has a word."""
    noted = lambda s: F.struct(F.xxhash64(s).alias("a"), F.xxhash64(F.lit("line"), s).alias("b"), F.conv(F.substring(F.md5(s), 1, 5), 16, 10).cast("int").alias("c"), F.length(s).alias("len"), _is_long(s, long_words).alias("long"), s.rlike(WORD).alias("words"))
    return F.transform(F.split(text, "\n", -1), noted)


def line_chunks(notes: Column, met: Column, rolling: int = ROLLING_LINES, per_chunk: int = LINES_PER_CHUNK) -> Column:
    """Array of struct(start, stop, first, last, h1, h2, len) of the chunks that can be removed, numbered from 0, stop exclusive.

    ``met``: how often each line stands beside the next one in the corpus. The key is of the lines first..last - 1: the
    chunk itself, or the pair that stands for a short line.
    """

    def chunks(n: Column) -> Column:
        """From the notes, bound once as a lambda's argument."""
        code = lambda i: F.coalesce(F.get(n, i)["c"], F.lit(0)).cast("long")
        beside = lambda i: F.coalesce(F.get(met, i), F.lit(0).cast("long"))

        def ends(i: Column) -> Column:
            """Whether a chunk ends before line i (1..size)."""
            h = F.lit(0).cast("long")
            for k in range(rolling, 0, -1):
                h = h * BASE + code(i - k)
            rolled = F.floor(h * FACTOR % MODULUS / SHIFT).cast("long") % per_chunk == 0
            passage = beside(i - 1) < F.greatest(beside(i - 2), beside(i))
            return (i == F.size(n)) | F.get(n, i - 1)["long"] | F.get(n, i)["long"] | passage | rolled

        def keyed(start: Column, stop: Column, first: Column, last: Column) -> Column:
            lines = F.slice(n, first + 1, last - first)
            length = F.aggregate(lines, last - first - 1, lambda t, x: t + x["len"])
            key = lambda part: F.xxhash64(F.transform(lines, lambda x: x[part]))
            return F.struct(*[c.cast("int").alias(name) for c, name in ((start, "start"), (stop, "stop"), (first, "first"), (last, "last"))], key("a").alias("h1"), key("b").alias("h2"), length.cast("int").alias("len"))

        def of_chunk(e: Column, i: Column, stops: Column) -> Column:
            start = F.coalesce(F.get(stops, i - 1), F.lit(0))
            whole = F.exists(F.slice(n, start + 1, e - start), lambda x: x["words"])
            none = F.array().cast("array<struct<start:int,stop:int,first:int,last:int,h1:bigint,h2:bigint,len:int>>")
            left = F.when(beside(start - 1) >= 2, F.array(keyed(start, e, start - 1, e))).otherwise(none)
            right = F.when(beside(start) >= 2, F.array(keyed(start, e, start, e + 1))).otherwise(none)
            several = (e - start >= 2) | F.get(n, start)["long"]
            return F.when(~whole, none).when(several, F.array(keyed(start, e, start, e))).otherwise(F.concat(left, right))

        stops = F.filter(F.sequence(F.lit(1), F.size(n)), ends)
        return bind(stops, lambda found: F.flatten(F.transform(found, lambda e, i: of_chunk(e, i, found))))

    return bind(notes, chunks)


def noted_documents(docs: DataFrame) -> DataFrame:
    """``docs`` (id, text) as id, th (the text's hash), n (its lines' notes) and met (see ``line_chunks``)."""
    noted = stored(docs.where("text is not null").select("id", F.xxhash64("text").alias("th"), line_notes(F.col("text")).alias("n")))
    pair = F.transform(F.slice("n", 2, F.greatest(F.size("n") - 1, F.lit(0))), lambda x, i: F.xxhash64(F.get(F.col("n"), i)["a"], x["a"]))
    pairs = noted.select("id", "th", F.posexplode(pair).alias("at", "pair"))
    # a table of its own, so that both sides of the join are plain shuffles, of which a very common pair's can be split
    often = stored(pairs.groupBy("pair").count().where("count > 1"))
    one = F.struct("at", F.coalesce("count", F.lit(1).cast("long")).alias("count"))
    found = pairs.join(often, "pair", "left").groupBy(F.col("id").alias("fid"), F.col("th").alias("fth")).agg(F.array_sort(F.collect_set(one)).alias("m"))
    joined = noted.join(found, noted["id"].eqNullSafe(found["fid"]) & (noted["th"] == found["fth"]), "left")
    return joined.select("id", "th", "n", F.transform(F.coalesce("m", F.array()), lambda x: x["count"]).alias("met"))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """Per (id, th), the list ``r`` of its chunks whose key repeats: struct(start, stop, first, last, h1, h2, len, leads); from id, text."""
    chunks = noted_documents(docs).select("id", "th", F.explode(line_chunks(F.col("n"), F.col("met"))).alias("c"))
    c = stored(chunks.select("id", "th", "c.*"))
    # of a pair the place is where the pair stands, whichever of its lines it stands for
    place = F.struct("id", "first", "th")
    # rows repeated whole are one document
    groups = stored(c.groupBy(*_KEY).agg(F.min(place).alias("least"), F.max(place).alias("most")).where("least <> most").select(*_KEY, "least"))
    met = c.join(groups, _KEY)
    one = F.struct("start", "stop", "first", "last", *_KEY, (place == F.col("least")).alias("leads"))
    return met.groupBy("id", "th").agg(F.array_sort(F.collect_set(one)).alias("r"))


def _deduped(rows: DataFrame) -> DataFrame:
    """``rows`` (row, id, text) with text replaced, n_lines and n_removed."""
    known = stored(repeated_chunks(rows.select("id", "text")))
    named = known.withColumnsRenamed({"id": "kid", "th": "kth"})
    d = rows.withColumn("h", F.xxhash64("text"))
    same = d["id"].eqNullSafe(named["kid"]) & (d["h"] == named["kth"])
    lines = F.split("text", "\n", -1)
    body = F.array_join(F.slice(lines, F.col("c.first") + 1, F.col("c.last") - F.col("c.first")), "\n")
    texts = d.join(named, same).select("text", F.explode("r").alias("c")).select("c.h1", "c.h2", "c.len", body.alias("body"))
    differing = texts.groupBy(*_KEY).agg(F.min("body").alias("a"), F.max("body").alias("b")).where("a <> b").select(*_KEY)
    differing = stored(differing)
    out = d.join(named, same, "left").drop("kid", "kth").withColumn("spared", F.lit(None).cast("array<int>"))
    if not differing.isEmpty():
        # texts that share a key but differ, by all odds none, are spared
        # a chunk in very many documents is one key: it is met in SALTS parts
        salted = differing.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        spared = known.select("id", "th", F.explode("r").alias("c")).select("id", "th", "c.start", *[f"c.{k}" for k in _KEY], F.pmod(F.xxhash64("id", "th"), F.lit(SALTS)).cast("int").alias("salt"))
        spared = spared.join(salted, [*_KEY, "salt"], "left_semi")
        spared = spared.groupBy(F.col("id").alias("sid"), F.col("th").alias("sth")).agg(F.collect_set("start").alias("spared"))
        out = out.drop("spared")
        out = out.join(spared, out["id"].eqNullSafe(spared["sid"]) & (out["h"] == spared["sth"]), "left")
    gone = F.filter(F.coalesce("r", F.array()), lambda x: ~x["leads"] & ~F.coalesce(F.array_contains("spared", x["start"]), F.lit(False)))
    gone = F.array_sort(F.array_distinct(F.transform(gone, lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop")))))
    out = out.select("row", "id", "text", F.when(F.col("r").isNotNull(), gone).alias("gone"))
    # chunks do not overlap: what stays are the lines between them
    before = lambda g, i: F.coalesce(F.get(g, i - 1)["stop"], F.lit(0))
    ends = F.concat("gone", F.array(F.struct(F.size(lines).alias("start"), F.size(lines).alias("stop"))))
    kept = bind(lines, lambda x: bind(ends, lambda g: F.flatten(F.transform(g, lambda e, i: F.slice(x, before(g, i) + 1, e["start"] - before(g, i))))))
    text = F.when(F.size("gone") > 0, F.array_join(kept, "\n")).otherwise(F.col("text"))
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long")
    removed = F.coalesce(F.aggregate("gone", F.lit(0), lambda t, x: t + x["stop"] - x["start"]), F.lit(0))
    return out.select("row", "id", text.alias("text"), n.alias("n_lines"), removed.cast("long").alias("n_removed"))


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, text without repeated chunks, n_lines and n_removed, numbers of lines (long)."""
    out = _deduped(docs.select(F.lit(None).cast("int").alias("row"), col(id_col).alias("id"), col(text_col).cast("string").alias("text")))
    return out.select(F.col("id").alias(id_col), F.col("text").alias(text_col), "n_lines", "n_removed")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs``, all columns, with repeated chunks gone from the text; where lines went, ``length_col`` follows the text."""
    others = [c for c in docs.columns if c != text_col]
    out = _deduped(docs.select(F.struct(*[col(c) for c in others]).alias("row"), col(id_col).alias("id"), col(text_col).cast("string").alias("text")))
    own = lambda c: F.col("row").getField(c)
    long = F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
    return out.select(*[F.col("text").alias(c) if c == text_col else F.coalesce(long, own(c)).alias(c) if c == length_col else own(c).alias(c) for c in docs.columns])
