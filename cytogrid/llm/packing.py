"""Best-fit packing of documents into fixed-length token sequences.

Method: best-fit decreasing over all pieces at once. In order of falling length, a segment tree over remaining capacities finds the
tightest open sequence in logarithmic time; equally long pieces that go the same way are placed as one run.

Scale: tokenising is a narrow map; only piece records (no text, no token ids) are shuffled. What goes where depends only on how many
pieces there are of each length, a table of as many rows as a sequence has tokens, so all corpora are packed globally whatever
their size. The runs, whose number the lengths bound as well, are sent to the tasks; a piece finds its own by its rank among
equally long pieces, which is counted per partition and prefix-summed.

Defined cases: null text is the empty text, whose only token is the end token; repeated rows are packed once per row; of equally long
pieces the one read first comes first; a text of any length is cut into pieces; an empty table gives an empty result; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytogrid.llm.common import col, materialize

SEQUENCE_TOKENS = 1024
END_TOKEN = 2

_SPECIAL = "<|endoftext|>"
#: The one place where a piece of the byte-level vocabulary can reach over a space: a space before white space or the end.
_LOOSE_SPACE = re.compile(r" (?:\s|$)")


class WordIds(dict):
    """Token ids, as little-endian 32-bit bytes, of " " + word; a bounded cache in front of the vocabulary."""

    def __init__(self, encode, most: int = 400_000):
        super().__init__()
        self._encode, self._most = encode, most

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self._encode(" " + word)).tobytes()
        if len(word) < 24:
            if len(self) >= self._most:
                self.clear()
            self[word] = ids
        return ids


def load_encoder(json_path: str):
    """A function text -> token ids as bytes, equal to the vocabulary file's own tokenizer without special tokens added.

    The same vocabulary is kept beside it as ranks, which encode a word several times faster; a test holds the two
    against each other. Words between plain spaces are encoded one by one, since no piece crosses such a space.
    """
    import public_tokenizers
    import tiktoken

    ranks_path = re.sub(r"\.json$", ".tiktoken", json_path)
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={_SPECIAL: 50256})
    words = WordIds(enc.encode_ordinary)

    def encode(text: str) -> bytes:
        if _SPECIAL in text or _LOOSE_SPACE.search(text):
            return array("I", enc.encode(text, allowed_special="all")).tobytes()
        first, *rest = text.split(" ")
        return array("I", enc.encode_ordinary(first)).tobytes() + b"".join([words[w] for w in rest])

    return encode


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: full ones, after a first one that may be shorter."""
    head = n % most
    starts = ([0] if head else []) + list(range(head, n, most))
    return [(s, (head if head and s == 0 else most)) for s in starts]


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE_TOKENS) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32."""
    end = array("I", [END_TOKEN]).tobytes()
    out = docs.select(col(id_col)).schema
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")):
        out = out.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_encoder(tokenizer)
        for batch in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "") + end
                for k, (s, n) in enumerate(cut(len(ids) // 4, sequence)):
                    rows.append(i)
                    piece.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(ids[4 * s : 4 * (s + n)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=[id_col, "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text")).mapInArrow(run, out)


class CapacityTree:
    """Segment tree over remaining capacities 0..most; a leaf has the open sequences with just that much left, as runs of numbers."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[tuple[int, int]]] = [[] for _ in range(most + 1)]

    def _add(self, capacity: int, by: int) -> None:
        i = self.size + capacity
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, capacity: int, first: int, many: int) -> None:
        self.open[capacity].append((first, many))
        self._add(capacity, many)

    def tightest(self, need: int) -> int | None:
        """The least capacity, of at least ``need``, that an open sequence has."""
        i, count = self.size + need, self.count
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if count[2 * i] else 2 * i + 1
        return i - self.size

    def take(self, capacity: int, most: int) -> tuple[int, int]:
        """Take out (first, many) sequences of that capacity, ``most`` of them at most."""
        first, many = self.open[capacity].pop()
        if many > most:
            self.open[capacity].append((first + most, many - most))
            many = most
        self._add(capacity, -many)
        return first, many


#: A run of equally long pieces: (length, rank of the first among all of that length, number, first sequence, pieces per sequence, offset of the first).
Run = tuple[int, int, int, int, int, int]


def best_fit_decreasing(counts: dict[int, int], most: int) -> list[Run]:
    """Best-fit decreasing of all pieces, given how many there are of each length.

    Equally long pieces go the same way one after the other: into the tightest sequence until it has no room for one more, and so on
    through all sequences of that capacity. Such a run is one step, so the work depends on the lengths' number, not on the pieces'.
    """
    tree, made, out = CapacityTree(most), 0, []
    for n in sorted(counts, reverse=True):
        rank, left = 0, counts[n]
        while left:
            capacity = tree.tightest(n) if n < most else None
            each = (most if capacity is None else capacity) // n
            whole = max(1, left // each)
            if capacity is None:
                capacity, first, many = most, made, whole
                made += whole
            else:
                first, many = tree.take(capacity, whole)
            each = min(each, left)
            out.append((n, rank, many * each, first, each, most - capacity))
            rank += many * each
            left -= many * each
            if capacity > each * n:
                tree.put(capacity - each * n, first, many)
    return out


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE_TOKENS) -> DataFrame:
    """One row per piece of every document, with its sequence_id and its offset there (see the module)."""
    # the written table's partitions and their rows' order stay, so a piece's rank among equally long ones is the same each time it is taken
    placed = materialize(pieces(docs, tokenizer, id_col, text_col, sequence).select(F.struct("*").alias("p"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    rows = placed.select("p", "part", "at", F.col("p.length").alias("length"))
    cells = materialize(rows.groupBy("length", "part").count())
    counts = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # as many rows as a sequence has tokens
    runs = np.array(best_fit_decreasing(counts, sequence), np.int64).reshape(-1, 6)
    # rising by length, then by rank, as one number per run
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = cells.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("at")) - 1
    ranked = rows.withColumn("within", within).join(firsts, ["length", "part"]).select("p.*", (F.col("before") + F.col("within")).alias("rank"))
    out = ranked.drop("rank").schema.add("sequence_id", "long").add("offset", "long")
    starts = np.searchsorted(runs[:, 0], np.arange(sequence + 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            order = np.argsort(length, kind="stable")
            mine = np.zeros(len(length), np.int64)
            for n, a, b in zip(*_groups(length[order]), strict=True):
                lo, hi = starts[n], starts[n + 1]
                mine[order[a:b]] = lo + np.searchsorted(runs[lo:hi, 1], rank[order[a:b]], side="right") - 1
            r = runs[mine]
            k = rank - r[:, 1]
            made = [pa.array(r[:, 3] + k // r[:, 4]), pa.array(r[:, 5] + k % r[:, 4] * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=out.names)

    return ranked.toDF("id", *ranked.columns[1:]).mapInArrow(run, out)


def _groups(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value, start, stop) of each run of equal values."""
    cut = np.nonzero(np.diff(ordered))[0] + 1
    start = np.concatenate(([0], cut)) if len(ordered) else cut
    return ordered[start], start, np.concatenate((cut, [len(ordered)])) if len(ordered) else cut
