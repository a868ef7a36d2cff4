"""Quality classifier: a byte-level convolutional network in numpy.

Network: one layer of learned filters over windows of WIDTH bytes (each filter is a table of byte weights per window place),
evaluated at every byte of the text. Responses are max-pooled over overlapping chunks that cover the whole text; per filter the
largest and the mean of its chunks' maxima feed one logistic unit.

Training: on the whole texts of at most about TRAIN_DOCS labelled documents, half of each class as far as there are, drawn by hash;
gradients reach the filters through the windows that won the pooling. It runs in one task on this bounded sample; the
model (a fixed number of weights) is sent to the tasks that score. Class weights restore the labels' own shares.

Scale: scoring is a narrow map over whole texts, in slices of bounded size.

Defined cases: null text is the empty text, which is scored like any other (padding bytes); a text counts as a whole however long; labels that are
neither 0 nor 1, of no id or of no document are ignored; a document with several labels learns from the least, one with several rows
from the least text; without documents of both classes the score is the share of class 1 among them (0.5 without any); 0.5 counts as
class 1; repeated rows get equal results; an empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytogrid.llm.common import col, materialize

WIDTH, FILTERS = 8, 12
#: Chunks of two blocks of STRIDE bytes.
STRIDE = 256
TRAIN_DOCS = 2_000
EPOCHS, BATCH, RATE = 8, 32, 0.02
#: Bytes convolved at once.
SLICE = 1 << 18


class Net:
    """table: (WIDTH, 256, FILTERS); bias: FILTERS; out: 2 * FILTERS weights and an offset."""

    def __init__(self, table: np.ndarray, bias: np.ndarray, out: np.ndarray):
        self.table, self.bias, self.out = table, bias, out
        # two window places at a time: one look-up per pair of bytes
        self.pairs = [(table[j][:, None, :] + table[j + 1][None, :, :]).reshape(65536, -1).astype(np.float32) for j in range(0, WIDTH, 2)]

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Filter responses at each place of ``data`` (uint8) that has a whole window after it."""
        pair = data[:-1].astype(np.int32) * 256 + data[1:]
        n = len(data) - WIDTH + 1
        z = self.pairs[0][pair[:n]]
        for k, p in enumerate(self.pairs[1:], 1):
            z += p[pair[2 * k : 2 * k + n]]
        return z

    def pooled(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The texts side by side (bytes), where each one's blocks of STRIDE bytes start, and per block and filter the largest response and its place.

        The last block has room for the window of the last byte; windows that begin after it could reach into the next text and are left out.
        """
        blocks = np.array([-(-(len(t) + WIDTH - 1) // STRIDE) for t in texts])
        start = np.concatenate(([0], np.cumsum(blocks)))
        data, last = np.zeros(start[-1] * STRIDE + WIDTH - 1, np.uint8), start[1:] - 1
        for t, at in zip(texts, start, strict=False):
            data[at * STRIDE : at * STRIDE + len(t)] = np.frombuffer(t, np.uint8)
        top, won = np.empty((start[-1], FILTERS), np.float32), np.empty((start[-1], FILTERS), np.int64)
        for a in range(0, len(top), SLICE // STRIDE):
            e = min(len(top), a + SLICE // STRIDE)
            z = self.responses(data[a * STRIDE : e * STRIDE + WIDTH - 1]).reshape(e - a, STRIDE, FILTERS)
            z[last[(last >= a) & (last < e)] - a, STRIDE - WIDTH + 1 :] = -np.inf
            won[a:e] = z.argmax(1)
            top[a:e] = np.take_along_axis(z, won[a:e, None, :], 1)[:, 0]
        return data, start, np.maximum(top + self.bias, 0), won

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability of class 1 of each text."""
        feature = np.zeros((len(texts), 2 * FILTERS), np.float32)
        for i, group in _groups(texts):
            _, start, top, _ = self.pooled(group)
            for k in range(len(group)):
                feature[i + k] = _feature(top[start[k] : start[k + 1]])[0]
        return 1 / (1 + np.exp(-(feature @ self.out[:-1] + self.out[-1]).astype(np.float64)))


def _feature(top: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one text's blocks: the largest and the mean of its chunks' maxima, each chunk's winning block, and the winning chunk.

    A chunk is two neighbouring blocks, so chunks overlap; a text of one block is one chunk.
    """
    later = np.zeros((max(1, len(top) - 1), FILTERS), np.int64)
    chunks = top
    if len(top) > 1:
        later = (top[1:] > top[:-1]).astype(np.int64)
        chunks = np.maximum(top[:-1], top[1:])
    return np.concatenate((chunks.max(0), chunks.mean(0))), np.arange(len(chunks))[:, None] + later, chunks.argmax(0)


def _groups(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t) + STRIDE
        if size >= 4 * SLICE:
            yield at, texts[at : i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def gradients(net: Net, texts: list[bytes], label: np.ndarray, weight: np.ndarray) -> tuple[list[np.ndarray], float]:
    """Gradients of the mean weighted log loss by table, bias and out, and the loss itself."""
    data, start, top, won = net.pooled(texts)
    parts = [_feature(top[a:b]) for a, b in zip(start[:-1], start[1:], strict=True)]
    feature = np.stack([p[0] for p in parts])
    p = 1 / (1 + np.exp(-(feature @ net.out[:-1] + net.out[-1]).astype(np.float64)))
    loss = -np.mean(weight * np.where(label == 1, np.log(np.maximum(p, 1e-12)), np.log(np.maximum(1 - p, 1e-12))))
    err = ((p - label) * weight / len(texts)).astype(np.float32)
    back = err[:, None] * net.out[:-1][None, :]
    g_top, f = np.zeros_like(top), np.arange(FILTERS)
    for k, (_, block, peak) in enumerate(parts):
        mine = g_top[start[k] : start[k + 1]]
        np.add.at(mine, (block, f[None, :]), back[k, FILTERS:] / len(block))
        mine[block[peak, f], f] += back[k, :FILTERS]
    g_top *= top > 0
    place = np.arange(len(top))[:, None] * STRIDE + won
    g_table = np.stack([_by_byte(data[place + j], g_top) for j in range(WIDTH)])
    return [g_table, g_top.sum(0), np.concatenate((feature.T @ err, [err.sum()])).astype(np.float32)], float(loss)


def _by_byte(byte: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Sums of ``g`` (rows x filters) by byte and filter."""
    at = byte.astype(np.int64) * FILTERS + np.arange(FILTERS)[None, :]
    return np.bincount(at.ravel(), weights=g.ravel(), minlength=256 * FILTERS).reshape(256, FILTERS).astype(np.float32)


def train(texts: list[bytes], label: np.ndarray, weight: np.ndarray, seed: int = 7) -> Net:
    """Fit the network by Adam on whole texts."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32)
    bias, out = np.full(FILTERS, 0.1, np.float32), np.concatenate((rng.normal(0, 0.3, 2 * FILTERS), [0])).astype(np.float32)
    params = [table, bias, out]
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(texts))
        rate = RATE * (1 - 0.9 * epoch / EPOCHS)
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            found, _ = gradients(Net(table, bias, out), [texts[i] for i in pick], label[pick], weight[pick])
            step += 1
            for q, g, (m, v) in zip(params, found, moment, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Net(table, bias, out)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_docs: int = TRAIN_DOCS) -> Net | float:
    """The network, or a constant score where the labels do not have both classes."""
    known = labels.where(col(label_col).isin(0, 1) & col(id_col).isNotNull()).groupBy(col(id_col).alias("id")).agg(F.min(col(label_col)).cast("int").alias("y"))
    texts = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    known = materialize(known.join(texts.select("id"), "id", "left_semi"))
    n = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}  # two classes
    if len(n) < 2:
        return float(next(iter(n))) if n else 0.5
    half = most_docs // 2
    share = F.when(F.col("y") == 0, min(1.0, half / n[0])).otherwise(min(1.0, half / n[1]))
    drawn = known.where(F.pmod(F.xxhash64(F.lit("train"), "id"), F.lit(1 << 20)) < share * (1 << 20))
    # about most_docs rows of two numbers; the limit only bounds what is sent
    sample = texts.join(F.broadcast(drawn.limit(2 * most_docs)), "id").groupBy("id", "y").agg(F.min("text").alias("text")).select("y", "text")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((y, t) for b in batches for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        y = np.array([r[0] for r in rows], np.float32)
        ones = n[1] / (n[0] + n[1])
        seen = max(1e-6, min(1 - 1e-6, float(y.mean()) if len(y) else 0.5))
        weight = np.where(y == 1, ones / seen, (1 - ones) / (1 - seen)).astype(np.float32)
        net = train([r[1] for r in rows], y, weight)
        flat = np.concatenate((net.table.ravel(), net.bias, net.out)).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([flat.tolist()], pa.list_(pa.float64()))], names=["w"])

    flat = np.array(sample.repartition(1).mapInArrow(learn, "w array<double>").first()["w"], np.float32)
    size = WIDTH * 256 * FILTERS
    return Net(flat[:size].reshape(WIDTH, 256, FILTERS), flat[size : size + FILTERS], flat[size + FILTERS :])


def classify(docs: DataFrame, labels: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_docs: int = TRAIN_DOCS) -> DataFrame:
    """Per row: id and score; learned from the labels of ids for which ``learn_from`` holds."""
    model = fit(docs, labels.where(learn_from), id_col, text_col, label_col, most_docs)
    weights = None if isinstance(model, float) else (model.table, model.bias, model.out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = None if weights is None else Net(*weights)
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            score = np.full(len(texts), model) if net is None else net.score(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=[id_col, "score"])

    return docs.select(col(id_col).alias("id"), col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(run, docs.select(col(id_col)).schema.add("score", "double"))
