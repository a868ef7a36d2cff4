"""SimHash near-duplicates by anchor-point covering.

Fingerprint: 64 bits; a bit is set if it is set in over half of the hashes of a text's word shingles.

Method: the 64 bits are split into blocks with tolerances t_i whose sum of (t_i + 1) exceeds the threshold, so two linked
fingerprints agree up to t_i bits in some block i. In each block a covering code gives the anchors: a Hamming code on
2^r - 1 of its bits and the free code on the rest, so every value has one anchor within the covering radius (1, or 0 where
the bits are not coded). A fingerprint has its home at that anchor and lies within covering radius plus t_i of the home of whatever it links to;
it is replicated to every such anchor below its own, so the two of a link meet at the lesser home. Rows are compared per anchor.

Scale: only distinct fingerprints are compared, so groups of exact copies cost one row. Up to WIDE_FROM fingerprints there are three blocks
(about 18 replicas a fingerprint, 2^17 anchors or more); beyond, two wide ones (about 94 replicas, 2^27 anchors), so that anchors do not fill up
as the corpus grows. An anchor with more rows than a task should hold is dealt out as pairs of
chunks, which keeps the comparison complete. A task emits a spanning forest of the links it finds, never all pairs.
Components are found by distributed star contraction. For removing copies, the pairs of a component are held against the texts' sets of shingles.

Defined cases: null and empty texts have no words and fingerprint zero, which links like any other; repeated rows each get
a result row; a null id never names a component unless all of its ids are null; a text counts as a whole however long; an empty table gives an empty
result; further columns are ignored, or kept where rows are, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytogrid.llm.common import col, keyed_rows, materialize, row_key, rows_again
from cytogrid.llm.components import components

BITS = 4
SEED = 42
#: Rows at an anchor that one task compares.
ANCHOR_ROWS = 4096
#: Crowded anchors that are broadcast at most.
MOST_BROADCAST = 50_000


@dataclass(frozen=True)
class Block:
    """Bits offset..offset+width-1, met with up to ``tolerance`` differing bits; ``parity`` bits of its Hamming code (0: free code)."""

    offset: int
    width: int
    tolerance: int
    parity: int

    @property
    def radius(self) -> int:
        return 1 if self.parity else 0

    def column(self, bit: int) -> int:
        """Column of the parity-check matrix; 0 for the free bits."""
        return bit + 1 if bit < (1 << self.parity) - 1 else 0

    def patterns(self, weight: int) -> list[list[int]]:
        """By syndrome, the differences of at most ``weight`` bits that lead to an anchor."""
        by: dict[int, list[int]] = defaultdict(list)
        for w in range(weight + 1):
            for bits in combinations(range(self.width), w):
                s = 0
                for b in bits:
                    s ^= self.column(b)
                by[s].append(sum(1 << b for b in bits))
        return [by[s] for s in range(1 << self.parity)]

    def value(self, fp: Column) -> Column:
        return F.shiftrightunsigned(fp, self.offset).bitwiseAND(F.lit((1 << self.width) - 1))

    def syndrome(self, value: Column) -> Column:
        out = F.lit(0)
        for j in range(self.parity):
            mask = sum(1 << b for b in range(self.width) if self.column(b) >> j & 1)
            out = out + (F.bit_count(value.bitwiseAND(F.lit(mask))) % 2) * (1 << j)
        return out + 1


#: Tolerances 1, 1, 0: (1 + 1) + (1 + 1) + (0 + 1) = 5 > 4 bits.
BLOCKS_4 = (Block(0, 22, 1, 4), Block(22, 22, 1, 4), Block(44, 20, 0, 3))
#: Tolerances 2, 1: (2 + 1) + (1 + 1) = 5 > 4 bits.
WIDE_BLOCKS_4 = (Block(0, 32, 2, 5), Block(32, 32, 1, 5))
#: Distinct fingerprints from which on a replica is cheaper than the rows that it would meet at an anchor of the narrow blocks.
WIDE_FROM = 1 << 30


def blocks_for(fingerprints: int) -> tuple[Block, ...]:
    """Blocks for that many distinct fingerprints; all find the same links."""
    return BLOCKS_4 if fingerprints < WIDE_FROM else WIDE_BLOCKS_4


def _table(rows: list[list[int]]) -> Column:
    return F.array(*[F.array(*[F.lit(x).cast("long") for x in r]) for r in rows])


def hashes_of(words: list[bytes], shingle: int, seed: int = SEED) -> np.ndarray:
    """XXH64 (uint64) of each shingle of ``words``, in order; of the whole sequence if it is shorter; none without words."""
    import xxhash

    if not words:
        return np.zeros(0, np.uint64)
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    starts, stop = starts[:n].tolist(), ends[min(shingle, len(words)) - 1 :].tolist()
    return np.fromiter((h(joined[a:b], seed) for a, b in zip(starts, stop, strict=True)), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """Each of the 64 bits that is set in over half of ``hashes``."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_of(text: bytes | None, shingle: int, seed: int = SEED) -> int:
    """Unsigned 64-bit fingerprint of a text's UTF-8 bytes."""
    return majority(hashes_of((text or b"").lower().split(), shingle, seed))


def _mapped(docs: DataFrame, id_col: str, text_col: str, names: list[str], of_text) -> DataFrame:
    """Per row its id and the ``names`` columns (long), the unsigned numbers that ``of_text`` gives for the text's bytes."""
    out = docs.select(col(id_col)).schema
    for name in names:
        out = out.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([of_text(t.as_py()) for t in batch.column(1)], np.uint64).reshape(-1, len(names)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.ascontiguousarray(c)) for c in made.T)], names=[id_col, *names])

    return docs.select(col(id_col).alias("id"), col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(run, out)


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id and the fingerprint, fp, as a signed long."""
    return _mapped(docs, id_col, text_col, ["fp"], lambda text: [fingerprint_of(text, shingle)])


def _forest(ids: np.ndarray, fp: np.ndarray, checks: list[np.ndarray], group: np.ndarray, home: np.ndarray, bits: int, check_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, over ids, of the links among rows of which one is at home; fingerprints are uint64.

    Rows are sorted by group, those at home first, so that only these need to look at the rows behind them.
    """
    nodes, node = np.unique(ids, return_inverse=True)
    label = np.arange(len(nodes))
    left, right = [], []

    def join(u: np.ndarray, v: np.ndarray) -> None:
        while len(u):
            hi, lo = np.maximum(label[u], label[v]), np.minimum(label[u], label[v])
            fresh = hi != lo
            u, v, hi, lo = u[fresh], v[fresh], hi[fresh], lo[fresh]
            if not len(u):
                break
            # each root is hung below one smaller root: these edges make a forest
            hung, first = np.unique(hi, return_index=True)
            left.append(nodes[u[first]])
            right.append(nodes[v[first]])
            label[hung] = lo[first]
            while not np.array_equal(label, label[label]):
                label[:] = label[label]

    stop = np.cumsum(np.bincount(group))[group] if len(group) else np.zeros(0, np.int64)
    at, k = np.nonzero(home)[0], 1
    while True:
        at = at[at + k < stop[at]]
        if not len(at):
            break
        b = at + k
        near = np.nonzero(np.bitwise_count(fp[at] ^ fp[b]) <= bits)[0]
        u, v = node[at[near]], node[b[near]]
        if checks and len(near):
            apart = sum(np.bitwise_count(c[at[near]] ^ c[b[near]]).astype(np.int32) for c in checks)
            u, v = u[apart <= check_bits], v[apart <= check_bits]
        join(u, v)
        k += 1
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def links(distinct: DataFrame, bits: int = BITS, checks: tuple[str, ...] = (), check_bits: int = 0, kind: str | None = None, blocks: tuple[Block, ...] = BLOCKS_4, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """Edges (u, v) between nodes that join the same nodes as all links do.

    ``distinct`` has node (long), fp and the ``checks`` columns. A link has ``bits`` or fewer differing bits between fp, and
    ``check_bits`` or fewer between all check columns together. A node may have several rows; only
    those of the same ``kind`` (an integer column) meet.
    """
    if sum(b.tolerance + 1 for b in blocks) <= bits:
        raise ValueError("the blocks' tolerances do not cover the threshold")
    fp, first = F.col("fp"), (F.col(kind) * len(blocks) if kind else F.lit(0)).cast("int")
    rows = []
    for i, b in enumerate(blocks):
        value = b.value(fp)
        at = b.syndrome(value)
        home = value.bitwiseXOR(F.element_at(F.element_at(_table(b.patterns(b.radius)), at), 1))
        # of two home anchors the lesser is where the two fingerprints meet, so no replica goes to a greater one
        rows.append(
            F.filter(
                F.transform(
                    F.element_at(_table(b.patterns(b.radius + b.tolerance)), at),
                    (lambda i, value, home: lambda e: F.struct((first + i).alias("block"), value.bitwiseXOR(e).alias("anchor"), (value.bitwiseXOR(e) == home).alias("home")))(i, value, home),
                ),
                (lambda home: lambda x: x["anchor"] <= home)(home),
            )
        )
    carried = ["node", "fp", *checks]
    placed = distinct.select(*carried, F.explode(F.concat(*rows)).alias("p")).select(*carried, "p.block", "p.anchor", "p.home")
    hot = placed.groupBy("block", "anchor").count().where(F.col("count") > anchor_rows).select("block", "anchor", F.ceil(F.col("count") / anchor_rows).alias("chunks"))
    hot = materialize(hot)
    # one row per anchor_rows placed rows at most; sent to all tasks only if few
    hot = F.broadcast(hot) if hot.count() <= MOST_BROADCAST else hot
    mine = F.pmod(F.xxhash64("node"), F.col("chunks"))
    pairs = F.when(F.col("chunks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda j: F.least(mine, j) * F.col("chunks") + F.greatest(mine, j))
    )
    dealt = placed.join(hot, ["block", "anchor"], "left").select(*carried, "home", "block", "anchor", F.explode(pairs).alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def found(t: pa.Table) -> pa.RecordBatch:
            bits_of = lambda c: t.column(c).to_numpy().view(np.uint64)
            home = t.column("home").to_numpy(zero_copy_only=False)
            key = np.stack([t.column(c).to_numpy().astype(np.int64) for c in ("block", "anchor", "part")])
            group = np.concatenate(([0], np.cumsum((key[:, 1:] != key[:, :-1]).any(0)))) if t.num_rows else np.zeros(0, np.int64)
            u, v = _forest(t.column("node").to_numpy(), bits_of("fp"), [bits_of(c) for c in checks], group, home, bits, check_bits)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        # several anchors at a time; the last anchor of a batch waits for the rest of its rows
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            if t.num_rows < 100_000:
                rest = t
                continue
            last = [t.column(c)[-1] for c in ("block", "anchor", "part")]
            cut = t.num_rows - 1
            while cut and [t.column(c)[cut - 1] for c in ("block", "anchor", "part")] == last:
                cut -= 1
            rest = t.slice(cut)
            if cut:
                yield found(t.slice(0, cut).combine_chunks())
        if rest is not None:
            yield found(rest.combine_chunks())

    return dealt.repartition("block", "anchor", "part").sortWithinPartitions("block", "anchor", "part", F.desc("home")).mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, fingerprint (16 lower-case hex digits) and component_id, the least id that it reaches by links."""
    fps = materialize(fingerprints(docs, shingle, id_col, text_col).toDF("id", "fp"))
    distinct = materialize(fps.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(distinct.select(F.col("fp").alias("node"), "fp"), bits, blocks=blocks_for(distinct.count())))
    linked = materialize(distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    # tables of their own, so that both sides of each join are plain shuffles, of which a large component's or a common fingerprint's can be split
    named = materialize(linked.groupBy("root").agg(F.min("least").alias("component_id")))
    by_fp = materialize(linked.join(named, "root").select("fp", "component_id"))
    return fps.join(by_fp, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: For removing near copies: shingles of five words, and the similarity (share of all distinct shingles) that makes a link.
COPY_SHINGLE, COPY_SIMILARITY = 5, 0.8
#: Independent fingerprints of a text's words; a link is missed only where all of them differ in more bits than allowed.
COPY_PRINTS = 3
#: Longs of a minwise sketch (one bit of each of 64 minima), and the differing bits at which a link is tried: a similarity of 0.8 has about 26.
SKETCH_LONGS, SKETCH_BITS = 4, 36
_SKETCH = [f"sketch{i}" for i in range(SKETCH_LONGS)]
_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 31, 64 * SKETCH_LONGS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def sketch_of(hashes: np.ndarray) -> list[int]:
    """One bit of the least of ``hashes`` in each of 64 * SKETCH_LONGS orders: two texts differ in half of the share they do not have in common."""
    if not len(hashes):
        return [0] * SKETCH_LONGS
    short, least = (hashes >> np.uint64(32)).astype(np.uint32), np.full(len(_FACTORS), (1 << 32) - 1, np.uint32)
    for at in range(0, len(short), 256):
        np.minimum(least, (short[at : at + 256, None] * _FACTORS).min(0), out=least)
    mixed = (least ^ (least >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return np.packbits((mixed >> np.uint32(31)).astype(np.uint8), bitorder="little").view("<u8").tolist()


def copy_marks(text: bytes | None, shingle: int = COPY_SHINGLE) -> list[int]:
    """COPY_PRINTS fingerprints of the single words, and the sketch of the shingles.

    A changed word is one of its text's words but part of five shingles, so fingerprints of words meet at anchors where those of shingles do not.
    """
    words = (text or b"").lower().split()
    one, out = hashes_of(words, 1), []
    for _ in range(COPY_PRINTS):
        out.append(majority(one))
        one = (one ^ (one >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        one ^= one >> np.uint64(32)
    return [*out, *sketch_of(hashes_of(words, shingle))]


#: Documents of a group that a task compares with as many others, and so many distinct shingles of theirs at most. A group of more than
#: the first number is dealt out in up to COPY_CHUNKS parts for the sake of speed, and in more only where the last two bounds ask for it.
COPY_FEW, COPY_CHUNKS, COPY_MANY, COPY_SHINGLES = 512, 8, 4096, 2_000_000


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """``texts`` (node, root, text) with, in place of the text, ``s``, the distinct hashes of its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(hashes_of((t.as_py() or b"").lower().split(), shingle)).view(np.int64) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(sets, pa.list_(pa.int64()))], names=["node", "root", "s"])

    return texts.select("node", "root", F.col("text").cast("binary")).mapInArrow(run, "node long, root long, s array<long>")


def _joined(node: np.ndarray, chunk: np.ndarray, values: np.ndarray, offsets: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges from nodes to the least one that they reach by similar sets; row i has ``values`` from offsets[i] to offsets[i + 1].

    Each pair is held against the sets unless its rows are joined already. Rows of two chunks are compared across these only.
    """
    nodes, label = np.unique(node, return_inverse=True)
    kinds, at = np.unique(values, return_inverse=True)
    size, across = np.diff(offsets), len(chunk) and chunk.min() != chunk.max()
    held = np.zeros(len(kinds), bool)
    for i in range(len(node) - 1):
        j = np.nonzero(label[i + 1 :] != label[i])[0] + i + 1
        if across:
            j = j[chunk[j] != chunk[i]]
        # sets whose sizes differ too much cannot be similar
        j = j[np.minimum(size[j], size[i]) >= similarity * np.maximum(size[j], size[i])]
        if not len(j):
            continue
        held[at[offsets[i] : offsets[i + 1]]] = True
        alike = []
        ends = np.cumsum(size[j])
        for some in np.split(j, np.searchsorted(ends, np.arange(COPY_SHINGLES, ends[-1], COPY_SHINGLES))):
            stop = np.cumsum(size[some])
            own = at[np.arange(stop[-1] if len(some) else 0) + np.repeat(offsets[some] - stop + size[some], size[some])]
            shared = np.diff(np.concatenate(([0], np.cumsum(held[own])))[np.concatenate(([0], stop))])
            alike.append(some[shared >= similarity * (size[i] + size[some] - shared)])
        held[at[offsets[i] : offsets[i + 1]]] = False
        met = np.unique(label[np.concatenate(([i], *alike)).astype(np.int64)])
        if len(met) > 1:
            label[np.isin(label, met)] = met[0]
    least = nodes[label]
    return node[least != node], least[least != node]


def similar_links(texts: DataFrame, similarity: float, shingle: int, few: int = COPY_FEW) -> DataFrame:
    """Edges (u, v) that join the same nodes as all pairs of one group that have that similarity or more.

    ``texts`` has node, root (the group's name) and text. Each is sent as its set of shingles to the tasks that compare its group: one, or
    for a large group one per pair of chunks.
    """
    sets = materialize(shingle_sets(texts.select("node", "root", "text"), shingle))
    count, shingles = F.count("*"), F.sum(F.size("s"))
    chunks = F.greatest(F.least(F.ceil(count / few), F.lit(COPY_CHUNKS)), F.ceil(count / COPY_MANY), F.ceil(shingles / COPY_SHINGLES))
    large = materialize(sets.groupBy("root").agg(chunks.cast("long").alias("chunks")).where("chunks > 1"))
    large = F.broadcast(large) if large.count() <= MOST_BROADCAST else large
    mine = F.when(F.col("chunks").isNull(), F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64("node"), F.col("chunks")))
    parts = F.when(F.col("chunks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda k: F.least("chunk", k) * F.col("chunks") + F.greatest("chunk", k))
    )
    dealt = sets.join(large, "root", "left").withColumn("chunk", mine).select("root", F.explode(parts).alias("part"), "node", "chunk", "s")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(t: pa.Table) -> pa.RecordBatch:
            t = t.combine_chunks()
            root, part, node, chunk = (t.column(c).to_numpy() for c in ("root", "part", "node", "chunk"))
            s = t.column("s").combine_chunks()
            s = s.chunk(0) if isinstance(s, pa.ChunkedArray) else s
            offsets, values = s.offsets.to_numpy().astype(np.int64), s.values.to_numpy()
            cuts = np.concatenate(([0], np.nonzero((root[1:] != root[:-1]) | (part[1:] != part[:-1]))[0] + 1, [len(root)]))
            u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                own = _joined(node[a:b], chunk[a:b], values[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], similarity)
                u.append(own[0])
                v.append(own[1])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])

        # the last group of a batch waits for the rest of its rows
        rest: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            root, part = t.column("root").to_numpy(), t.column("part").to_numpy()
            cut = int(np.nonzero((root != root[-1]) | (part != part[-1]))[0].max(initial=-1)) + 1
            if rest and (cut or (rest[-1].column("root")[-1].as_py(), rest[-1].column("part")[-1].as_py()) != (root[-1], part[-1])):
                yield found(pa.concat_tables([*rest, t.slice(0, cut)]))
                rest = []
            elif cut:
                yield found(t.slice(0, cut))
            rest.append(t.slice(cut))
        if rest:
            yield found(pa.concat_tables(rest))

    return dealt.repartition("root", "part").sortWithinPartitions("root", "part").mapInArrow(run, "u long, v long")


def distinct_documents(docs: DataFrame, bits: int = BITS, shingle: int = COPY_SHINGLE, similarity: float = COPY_SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without those that nearly copy another: of each group one row stays.

    Pairs that meet by any fingerprint and agree in the sketch put their documents into one group; within a group all pairs are held
    against their sets of shingles, and those similar enough are links. Of linked rows the one with the least id stays (a null id comes
    last; of equal ids, the least hash of the text); of rows alike in id and text, any one.
    """
    prints = [f"fp{i}" for i in range(COPY_PRINTS)]
    marks = [*prints, *_SKETCH]
    known = F.struct(col(id_col).isNull().alias("none"), col(id_col).alias("id"), *row_key(docs, id_col, text_col)[::-1])
    made = _mapped(docs.select(known.alias("doc"), col(text_col).cast("string").alias("text")), "doc", "text", marks, lambda text: copy_marks(text, shingle))
    distinct = materialize(made.groupBy(*marks).agg(F.min("doc").alias("doc")).withColumn("node", F.monotonically_increasing_id()))
    near = links(distinct.select("node", *_SKETCH, F.posexplode(F.array(*prints)).alias("kind", "fp")), bits, tuple(_SKETCH), SKETCH_BITS, "kind", blocks_for(distinct.count()))
    tried = materialize(near.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    # the forest may lack a link that is similar enough, but never parts its two nodes: all pairs of a candidates' component are tested
    grouped = materialize(components(tried).join(distinct.select("node", "doc.key", "doc.th"), "node"))
    texts = docs.select(*row_key(docs, id_col, text_col), col(text_col).cast("string").alias("text")).join(grouped, ["key", "th"])
    linked = materialize(components(similar_links(texts, similarity, shingle)).join(distinct.select("node", "doc"), "node"))
    gone = linked.join(_least(linked), "node", "left_anti").select("node")
    kept = distinct.join(gone, "node", "left_anti").select("doc.key", "doc.th")
    rows = keyed_rows(docs, id_col, text_col).join(kept, ["key", "th"])
    nth = F.row_number().over(Window.partitionBy("key", "th").orderBy("key"))
    return rows_again(rows.withColumn("nth", nth).where("nth = 1"))


def _least(linked: DataFrame) -> DataFrame:
    """The node of the least document of each root."""
    return linked.groupBy("root").agg(F.min_by("node", "doc").alias("node")).select("node")
