"""Periodic runs: stretches of a text's words that repeat with a period, found in n log n steps whatever the text.

A run is a stretch of consecutive words with smallest period q and a length of at least ``max(least, 2 q)`` that no neighbouring word
extends keeping period q. Each run holds, under the order of the words or under its reverse, a Lyndon word of length q; the longest Lyndon
word from each place ends at the next smaller suffix, found by a stack scanned right to left. Two suffixes are compared by their longest
common extension: word by word at first, then by binary search over a rolling hash, and the words so found equal are then compared
directly, so a collision cannot decide anything. An extension is kept by its distance and grows with the scan, so periodic stretches are
not searched again. Each Lyndon word is a candidate period; all candidates of a slice are extended both ways at once, and each run is
compared word by word before it counts.

Scale: rows are never shuffled. A task takes its texts in slices of about ``SLICE`` words (a longer text alone), numbers the words of a
slice and works on whole numbers; memory follows the slice.

Defined cases: null and empty texts and texts without words have no run and an empty ``collapsed``; ties and repeated rows are judged each
by itself; a text counts whole however long; an empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cytogrid.llm.common import WORD, col

LEAST = 12
#: Words worked on at a time; a longer text is a slice of its own.
SLICE = 200_000
#: Words compared one by one before the rolling hash is asked.
NEAR = 8
MASK = (1 << 64) - 1


class Sequence:
    """Numbered words of one or more texts, each followed by a separator that equals nothing; ``ends`` are the places of the separators."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray):
        self.ids, self.ends = ids, ends
        self.starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
        base = np.full(len(ids), 0x9E3779B97F4A7C15, np.uint64)
        base[:1] = 1
        self.power = np.cumprod(base, dtype=np.uint64)
        value = (ids.astype(np.uint64) + np.uint64(1 << 40)) * np.uint64(0xD6E8FEB86659FD93)
        value ^= value >> np.uint64(32)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * self.power, dtype=np.uint64)))

    def alike(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ``n`` words from i and from j > i have the same hash."""
        s = self.sums
        return (s[i + n] - s[i]) * self.power[j - i] == s[j + n] - s[j]

    def reach(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words are alike from (i, j) on, or before (i, j) if ``back``; at most ``most``."""
        low, high = np.zeros(len(i), np.int64), most.copy()
        while (low < high).any():
            n = (low + high + 1) // 2
            ok = self.alike(i - n, j - n, n) if back else self.alike(i, j, n)
            low, high = np.where(ok, n, low), np.where(ok, high, n - 1)
        return low


def lyndon_ends(seq: Sequence, reverse: bool) -> np.ndarray:
    """Per place, where the longest Lyndon word that starts there ends, with words in order of number or in the reverse order; a text's end is least in both."""
    top = int(seq.ids.max(initial=0))
    a = (np.where(seq.ids < 0, seq.ids, top - seq.ids) if reverse else seq.ids).tolist()
    n = len(a)
    ends = list(range(1, n + 1))
    known: dict[int, tuple[int, int]] = {}
    sums: list[int] = []
    power: list[int] = []
    stop = n

    def common(i: int, j: int) -> int:
        """Words alike from i and from j on; the first ones are."""
        d = j - i
        low, high = known.get(d, (n, n))
        if i == low - 1:
            known[d] = (i, high)
            return high - i
        same = 1
        while same < NEAR:
            if a[i + same] != a[j + same]:
                return same
            same += 1
        if not sums:
            sums.extend(seq.sums.tolist())
            power.extend(seq.power.tolist())
        most = stop - j
        left, right, shift = same, most, power[d]
        while left < right:
            mid = (left + right + 1) // 2
            if ((sums[i + mid] - sums[i]) * shift - (sums[j + mid] - sums[j])) & MASK:
                right = mid - 1
            else:
                left = mid
        # what lies before the stretch already known is compared word by word
        check = min(left, low - i)
        differ = np.flatnonzero(seq.ids[i : i + check] != seq.ids[j : j + check])
        if len(differ):
            left = int(differ[0])
        known[d] = (i, i + left)
        return left

    for i in range(n - 1, -1, -1):
        x = a[i]
        if x < 0:
            stop = i
            known.clear()
            continue
        j = i + 1
        while True:
            y = a[j]
            if x < y:
                j = ends[j]
            elif x > y:
                break
            else:
                same = common(i, j)
                if a[i + same] > a[j + same]:
                    break
                j = ends[j]
        ends[i] = j
    return np.array(ends, np.int64)


def _directly(ids: np.ndarray, i: int, j: int, step: int) -> int:
    n = 0
    while 0 <= i < j < len(ids) and ids[i] == ids[j]:
        i, j, n = i + step, j + step, n + 1
    return n


def runs(seq: Sequence, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of at least ``least`` words, by start, then period."""
    ids, n = seq.ids, len(seq.ids)
    place = np.arange(n)
    found = [np.stack((place, lyndon_ends(seq, r))) for r in (False, True)]
    both = np.concatenate([f[:, ids >= 0] for f in found], axis=1)
    # around a Lyndon word of a run as many words are alike as its length, or as are wanting to the least length
    want = max(1, -(-least // 4))
    padded = np.concatenate((np.full(want, -1 - n), ids, np.full(want + 1, -2 - n)))
    near = [np.ones(both.shape[1], bool) for _ in range(2)]
    for t in range(want):
        near[0] &= padded[both[0] + want + t] == padded[both[1] + want + t]
        near[1] &= padded[both[0] + want - 1 - t] == padded[both[1] + want - 1 - t]
    i, j = np.unique(both[:, near[0] | near[1]], axis=1)
    text = np.searchsorted(seq.ends, i)
    right = seq.reach(i, j, seq.ends[text] - j, back=False)
    left = seq.reach(i, j, i - seq.starts[text], back=True)

    def kept(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        start, end, period = i - left, j + right, j - i
        enough = end - start >= np.maximum(least, 2 * period)
        return np.unique(np.stack((start, period, end))[:, enough], axis=1)

    out = kept(left, right)
    if not all(_holds(seq, *r) for r in out.T.tolist()):
        out = kept(np.array([_directly(ids, a - 1, b - 1, -1) for a, b in zip(i, j, strict=True)], np.int64), np.array([_directly(ids, a, b, 1) for a, b in zip(i, j, strict=True)], np.int64))
    return out[0], out[2], out[1]


def _holds(seq: Sequence, start: int, period: int, end: int) -> bool:
    """Whether the words from start to end have that period and neither neighbour goes on with it."""
    ids = seq.ids
    inside = bool((ids[start : end - period] == ids[start + period : end]).all())
    return inside and ids[end] != ids[end - period] and (start == 0 or ids[start - 1] != ids[start + period - 1])


def _collapse(words: list[list[str]], least: int) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], list[str]]:
    """Per text its runs (start, length, period), and its words without the repetitions."""
    number: dict[str, int] = {}
    flat: list[int] = []
    ends = []
    for k, w in enumerate(words):
        flat += [number.setdefault(x, len(number)) for x in w]
        ends.append(len(flat))
        flat.append(-1 - k)
    seq = Sequence(np.array(flat, np.int64), np.array(ends, np.int64))
    start, end, period = runs(seq, least)
    edge = np.zeros(len(flat) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, end, -1)
    gone = np.cumsum(edge) > 0
    cut = np.searchsorted(start, np.concatenate((seq.starts, [len(flat)])))
    parts, left = [], []
    for k, w in enumerate(words):
        own = slice(cut[k], cut[k + 1])
        at = seq.starts[k]
        parts.append((start[own] - at, (end - start)[own], period[own]))
        left.append(" ".join(w) if own.start == own.stop else " ".join([x for x, g in zip(w, gone[at : seq.ends[k]].tolist(), strict=True) if not g]))
    return parts, left


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """Per row: id, runs (start, length, period; by start, then period) and collapsed.

    ``collapsed`` has the words, joined by one space, without those that any run holds after its first period.
    """
    split = re.compile(WORD)

    def slices(texts: pa.Array) -> Iterator[list[list[str]]]:
        part, n = [], 0
        for t in texts:
            w = split.findall(t.as_py() or "")
            if part and n + len(w) > SLICE:
                yield part
                part, n = [], 0
            part.append(w)
            n += len(w) + 1
        if part:
            yield part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(1)):
                got, left = _collapse(part, least)
                offsets = np.concatenate(([0], np.cumsum([len(g[0]) for g in got]))).astype(np.int32)
                fields = [pa.array(np.concatenate([g[f] for g in got]), pa.int64()) for f in range(3)]
                found = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), found, pa.array(left, pa.string())], names=[id_col, "runs", "collapsed"])
                at += len(part)

    added = StructType.fromDDL("runs array<struct<start:long,length:long,period:long>>, collapsed string")
    schema = StructType([*docs.select(col(id_col)).schema, *added])
    return docs.select(col(id_col).alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text")).mapInArrow(run, schema)
