"""Language identification of mixed-language text.

Method: a word's script narrows the candidate languages to those seen in that script; each candidate scores the word by its letter
trigrams; Viterbi over the words with a penalty for switching labels spans of the text. The document's language is the one with most
letters in its spans, the score that share.

Model: per language, counts of letter trigrams hashed into a fixed number of buckets and of letters per script, learned by a
partial aggregate over at most TRAIN_DOCS training documents per language (drawn by hash); its size is languages x buckets
whatever the corpus. Scoring is a narrow map over whole texts: letters are scored as arrays, SLICE characters at a time, and Viterbi runs over the
words of the documents of a slice side by side. A longer text is cut between words into slices of its own; the values of its labels are carried
from slice to slice, and only its back pointers, a bit per word and language, are kept.

Defined cases: text null or without a letter gives ``und`` and score 0; with nothing to learn from, every text is ``und``; rows whose
language is null are predicted but not learned from; every word of a text of any length is a step of its own; equal scores go to the language
first in order of name; repeated rows get equal results; an empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytogrid.llm.common import col

TRAIN_DOCS = 4_000
BUCKETS = 1 << 15
SWITCH_PENALTY = 12.0
UNKNOWN = "und"
#: Characters scored at once; bounds a task's arrays.
SLICE = 500_000
#: Share of its own letters a language must have in a script to be a candidate there.
CANDIDATE_SHARE = 0.002

#: Script ranges (first, last code point) by script number; letters elsewhere are script 0.
SCRIPTS = (
    (1, 0x0041, 0x024F),  # Latin
    (1, 0x1E00, 0x1EFF),
    (2, 0x0370, 0x03FF),  # Greek
    (2, 0x1F00, 0x1FFF),
    (3, 0x0400, 0x052F),  # Cyrillic
    (4, 0x0530, 0x058F),  # Armenian
    (5, 0x0590, 0x05FF),  # Hebrew
    (6, 0x0600, 0x077F),  # Arabic
    (7, 0x0900, 0x097F),  # Devanagari
    (8, 0x0980, 0x0DFF),  # other Indic
    (9, 0x0E00, 0x0E7F),  # Thai
    (10, 0x10A0, 0x10FF),  # Georgian
    (11, 0x1100, 0x11FF),  # Hangul
    (11, 0xAC00, 0xD7AF),
    (12, 0x3040, 0x30FF),  # kana
    (13, 0x3400, 0x9FFF),  # Han
)
N_SCRIPTS = 14


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Whether a code point is a letter, and its script."""
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    script = np.zeros(0x110000, np.uint8)
    for number, first, last in SCRIPTS:
        script[first : last + 1] = number
    return letter, script


class Letters:
    """The letters of some texts: trigram bucket of each, and where words start and end."""

    def __init__(self, texts: list[str]):
        letter, script = _tables()
        low = [t.lower() for t in texts]
        sizes = np.fromiter(map(len, low), np.int64, len(low)) + 1
        cp = np.frombuffer(("\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
        is_letter = letter[cp]
        edge = np.diff(np.concatenate(([False], is_letter, [False])).astype(np.int8))
        start, stop = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
        held = np.where(is_letter, cp, 0).astype(np.uint32)
        before, after = np.concatenate(([0], held[:-1])).astype(np.uint32), np.concatenate((held[1:], [0])).astype(np.uint32)
        mixed = before * np.uint32(0x9E3779B1) ^ held * np.uint32(0x85EBCA77) ^ after * np.uint32(0xC2B2AE3D)
        mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        self.bucket = (mixed >> np.uint32(32 - BUCKETS.bit_length() + 1))[is_letter]
        self.n = stop - start
        self.first = np.cumsum(self.n) - self.n
        self.script = script[cp[start]] if len(start) else np.zeros(0, np.uint8)
        self.doc = np.searchsorted(np.cumsum(sizes), start, side="right")


def _slices(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE:
            yield at, texts[at : i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def learn(train: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", most_docs: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log probabilities by bucket, candidates by script) from a bounded number of ``train`` rows per language."""
    counts = {r[0]: r[1] for r in train.where(col(lang_col).isNotNull()).groupBy(col(lang_col)).count().collect()}  # one row per language
    if not counts:
        return [], np.zeros((BUCKETS, 0), np.float32), np.zeros((N_SCRIPTS, 0), bool)
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, most_docs / n))])
    drawn = train.where(col(lang_col).isNotNull() & (F.pmod(F.xxhash64(F.lit("train"), col(id_col)), F.lit(1 << 20)) < F.element_at(share, col(lang_col)) * (1 << 20)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for lang in set(langs):
                total = sums.setdefault(lang, np.zeros(BUCKETS + N_SCRIPTS, np.int64))
                for _, part in _slices([t for t, x in zip(texts, langs, strict=True) if x == lang]):
                    got = Letters(part)
                    total[:BUCKETS] += np.bincount(got.bucket, minlength=BUCKETS)
                    total[BUCKETS:] += np.bincount(got.script, weights=got.n, minlength=N_SCRIPTS).astype(np.int64)
        for lang, total in sums.items():
            at = np.nonzero(total)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], names=["lang", "bucket", "n"])

    summed = drawn.select(col(lang_col).alias("lang"), col(text_col).cast("string").alias("text")).mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = summed.toArrow()  # languages x (buckets + scripts) rows at most
    names = sorted(set(got.column("lang").to_pylist()))
    number = {x: i for i, x in enumerate(names)}
    c = np.zeros((BUCKETS + N_SCRIPTS, len(names)))
    c[got.column("bucket").to_numpy(), [number[x] for x in got.column("lang").to_pylist()]] = got.column("n").to_numpy()
    grams, scripts = c[:BUCKETS], c[BUCKETS:]
    logp = np.log((grams + 0.3) / (grams.sum(0) + 0.3 * BUCKETS)).astype(np.float32)
    allowed = scripts >= np.maximum(1, CANDIDATE_SHARE * scripts.sum(0))
    allowed[~allowed.any(1)] = True
    return names, logp, allowed


def spans(score: np.ndarray, doc: np.ndarray, n_docs: int, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Viterbi label of each step; rows of ``score`` are steps, in order within their ``doc``. All documents advance together."""
    steps = np.bincount(doc, minlength=n_docs)
    order = np.argsort(-steps, kind="stable")
    first = (np.cumsum(steps) - steps)[order]
    steps = steps[order]
    most = int(steps.max(initial=0))
    active = np.searchsorted(-steps, -np.arange(most), side="left")  # documents with more than t steps
    stay = np.zeros(score.shape, bool)
    top = np.zeros(len(score), np.uint16)
    value = np.zeros((n_docs, score.shape[1]), np.float32)
    for t in range(most):
        a = active[t]
        row = first[:a] + t
        if t:
            v = value[:a]
            best = v.argmax(1)
            jump = v[np.arange(a), best][:, None] - penalty
            keep = v >= jump
            stay[row], top[row] = keep, best
            v = np.where(keep, v, jump) + score[row]
            # only differences count; sums over very many words would lose them to rounding
            value[:a] = v - v.max(1, keepdims=True)
        else:
            value[:a] = score[row]
    label = np.zeros(len(score), np.int64)
    now = value.argmax(1)
    for t in range(most - 1, -1, -1):
        a = active[t]
        row = first[:a] + t
        label[row] = now[:a]
        if t:
            now[:a] = np.where(stay[row, now[:a]], now[:a], top[row])
    return label


def _cut(text: str, most: int) -> Iterator[str]:
    """``text`` in parts of about ``most`` characters, cut before characters that are no letters."""
    at = 0
    while at < len(text):
        end = min(len(text), at + most)
        while end < len(text) and text[end].isalpha():
            end += 1
        yield text[at:end]
        at = end


def _word_scores(got: Letters, logp: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Words x languages; very low where the language is no candidate in the word's script."""
    s = np.add.reduceat(logp[got.bucket], got.first, axis=0)
    s[~allowed[got.script]] = -1e4
    return s


def _label_long(text: str, logp: np.ndarray, allowed: np.ndarray, penalty: float, most: int) -> tuple[np.ndarray, int]:
    """Letters per language and number of spans of one long text."""
    kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    value: np.ndarray | None = None
    for part in _cut(text, most):
        got = Letters([part])
        if not len(got.n):
            continue
        score = _word_scores(got, logp, allowed)
        stay, top = np.ones(score.shape, bool), np.zeros(len(score), np.uint16)
        for t, row in enumerate(score):
            if value is None:
                value = row.copy()
                continue
            best = int(value.argmax())
            jump = value[best] - penalty
            stay[t], top[t] = value >= jump, best
            value = np.maximum(value, jump) + row
            value -= value.max()
        kept.append((np.packbits(stay, axis=1), top, got.n))
    share, turns = np.zeros(logp.shape[1], np.int64), 0
    if value is None:
        return share, 0
    now = int(value.argmax())
    for stay, top, n in reversed(kept):
        for t in range(len(n) - 1, -1, -1):
            share[now] += n[t]
            if not stay[t, now >> 3] >> (7 - (now & 7)) & 1:
                turns += int(top[t]) != now
                now = int(top[t])
    return share, turns + 1


def label_texts(texts: list[str | None], names: list[str], logp: np.ndarray, allowed: np.ndarray, penalty: float = SWITCH_PENALTY, most: int = SLICE) -> tuple[list[str], list[float], list[int]]:
    """Per text: its language, the share of letters in that language's spans, and the number of language spans."""
    share, turns = np.zeros((len(texts), len(names)), np.int64), np.zeros(len(texts), np.int64)
    if not names:
        return [UNKNOWN] * len(texts), [0.0] * len(texts), turns.tolist()
    short = [t if t and len(t) <= most else "" for t in texts]
    for at, part in _slices(short):
        got = Letters(part)
        if not len(got.n):
            continue
        label = spans(_word_scores(got, logp, allowed), got.doc, len(part), penalty)
        here = np.bincount(got.doc * len(names) + label, weights=got.n, minlength=len(part) * len(names))
        share[at : at + len(part)] = here.reshape(len(part), -1)
        fresh = np.concatenate(([True], (label[1:] != label[:-1]) | (got.doc[1:] != got.doc[:-1])))
        turns[at : at + len(part)] = np.bincount(got.doc[fresh], minlength=len(part))
    for i, t in enumerate(texts):
        if t and len(t) > most:
            share[i], turns[i] = _label_long(t, logp, allowed, penalty, most)
    total, best = share.sum(1), share.argmax(1)
    return (
        [names[b] if t else UNKNOWN for b, t in zip(best, total, strict=True)],
        [float(share[i, best[i]] / total[i]) if total[i] else 0.0 for i in range(len(texts))],
        turns.tolist(),
    )


def identify(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_docs: int = TRAIN_DOCS) -> DataFrame:
    """Per row: id, lang_pred, score, n_spans; learned from the rows for which ``learn_from`` holds."""
    names, logp, allowed = learn(docs.where(learn_from), lang_col, text_col, id_col, most_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, n = label_texts(batch.column(1).to_pylist(), names, logp, allowed)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(n, pa.int64())], names=[id_col, "lang_pred", "score", "n_spans"])

    out = docs.select(col(id_col)).schema.add("lang_pred", "string").add("score", "double").add("n_spans", "long")
    return docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text")).mapInArrow(run, out)
