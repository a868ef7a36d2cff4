"""The pipeline's stages and their chain over a small table with planted cases."""

from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline
from cytogrid.llm import packing, queries


def words(n: int, seed: int) -> list[str]:
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 8))) for _ in range(n)]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    clean = {i: " ".join(words(120 + i, i)) for i in range(40)}
    near = words(400, 900)
    changed = near.copy()
    changed[100], changed[300] = "other", "words"
    block = "\n".join(" ".join(words(9, 700 + k)) for k in range(12))
    special = {100: "too short", 101: "spam spam " * 60, 102: clean[3], 103: " ".join(near), 104: " ".join(changed), 105: " ".join(words(90, 801)) + "\n" + block, 106: " ".join(words(90, 802)) + "\n" + block, 107: None, 108: ""}
    rows = [(i, t, "en", f"src{i % 4}" if i % 7 else None, len(t or "")) for i, t in {**clean, **special}.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path_factory.mktemp("pipeline"))
    docs.write.parquet(f"{folder}/documents.parquet")
    return clean, folder


def ids(df) -> set:
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages(spark, made, tmp_path):
    clean, folder = made
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "pack_sequences":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        after[name] = docs
    assert ids(after["quality_rules"]) == {*clean, 102, 103, 104, 105, 106}
    text = {r["doc_id"]: r["text"] for r in after["line_dedup"].collect()}
    assert all(text[i] == t for i, t in clean.items()) and text[102] == ""
    assert len(text[106]) < len(text[105])
    kept = ids(after["near_dedup"])
    assert {*clean, 103, 105} <= kept and 104 not in kept
    pieces = after["pack_sequences"].collect()
    whole = packing.pieces(before, queries.tokenizer_path()).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, pieces)) == sorted(map(key, whole))


def test_chain_gives_the_same(spark, made):
    _, folder = made
    a, b = (sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, folder).collect()) for _ in range(2))
    assert a == b and a


def test_chain_on_an_empty_table(spark, made, tmp_path):
    _, folder = made
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)
