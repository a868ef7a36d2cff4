"""Lloyd clustering, reply trees and periodic runs against brute force, with the cases that their docstrings define."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cytogrid.llm import chat, lloyd, periods, queries

DATA = os.environ.get("CYTOGRID_TEST_DATA", "/root/testdata/sf0.001")
CLASH = ("id", "v", "x", "n", "total", "cluster", "tree", "node", "parent", "score", "stretch", "t", "s", "nth", "runs", "collapsed", "text2", "a.b", "up", "there", "place")
HOSTILE = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant\nno", "\\", "\\-", "\\n", "<\\-|im_end|>", "a\\<|", "<<SYS>><</SYS>>", "<<|x|>", "[INST\\]", "", "<", "[", "é\U0001f600<s>"]


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def clashing(df):
    for c in CLASH:
        if c not in df.columns:
            df = df.withColumn(c, F.lit("clash"))
    return df


# clustering


def plain_lloyd(rows, dim: int, k: int, rounds: int, scale: int, seed: int):
    """(id, cluster, distance, centroid) with Python's own whole numbers."""
    import math

    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((sha(f"{seed}:{i}"), v) for i, v in kept if i is not None)[:k]
    centroids = [v for _, v in first]
    place = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        of = [place(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            own = [v for (_, v), o in zip(kept, of, strict=True) if o == j]
            if own:
                centroids[j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    return [(i, place(v)[1], place(v)[0], centroids[place(v)[1]]) for i, v in kept] if centroids else []


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)


@pytest.mark.parametrize("k", [1, 3, 8])
def test_clusters(spark, k):
    rng = random.Random(k)
    rows = [(i, [rng.choice([-2.0, 0.5, 1.0]) + i % 2 for _ in range(4)]) for i in range(40)]
    rows += [rows[3], rows[3], (3, [9.0, 9.0, 9.0, 9.0]), (None, [0.1, 0.2, 0.3, 0.4]), (2**60 + 1, [0.0, -0.0001, 0.0, 1.0])]
    rows += [(50, None), (51, []), (52, [1.0, 2.0, None, 4.0]), (53, [float("nan")] * 4), (54, [1.0, float("inf"), 0.0, 0.0]), (55, [1.0] * 5)]
    want = plain_lloyd(rows, 4, k, 4, 16, 3)
    got = lloyd.cluster(clashing(vectors(spark, rows)), dim=4, k=k, rounds=4, scale=16).collect()
    assert sorted(((r["vec_id"], r["cluster"], r["distance"], r["centroid"]) for r in got), key=repr) == sorted(want, key=repr)
    assert {r["inertia"] for r in got} == {sum(w[2] for w in want)}
    assert {(r["cluster"], r["cluster_inertia"]) for r in got} == {(c, sum(w[2] for w in want if w[1] == c)) for c in {w[1] for w in want}}


def test_empty_centroid_stays_and_ties_go_low(spark):
    rows = [(i, [1.0, 1.0]) for i in range(5)] + [(9, [5.0, 5.0])]
    got = lloyd.cluster(vectors(spark, rows), dim=2, k=6, rounds=3, scale=1).collect()
    want = plain_lloyd(rows, 2, 6, 3, 1, 3)
    assert sorted((r["vec_id"], r["cluster"]) for r in got) == sorted(w[:2] for w in want)
    assert len({r["cluster"] for r in got}) == 2


def test_no_vectors_and_too_large_ones(spark):
    for rows in ([], [(1, None)], [(None, [1.0, 2.0])]):
        assert lloyd.cluster(vectors(spark, rows), dim=2).collect() == []
    with pytest.raises(Exception, match="beyond"):
        lloyd.cluster(vectors(spark, [(1, [1e30, 0.0])]), dim=2).collect()


# conversations


def test_escape_is_reversible(spark):
    rng = random.Random(5)
    texts = HOSTILE + ["".join(rng.choice(["<", "|", "\\", "-", "n", "s>", "/s>", "[", "INST]", "/", "SYS>>", "\n", "é", "im_end|>"]) for _ in range(rng.randrange(12))) for _ in range(300)]
    d = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"), chat.escape_role(F.col("t")).alias("r"))
    for r in d.collect():
        assert chat.unescape(r["e"]) == r["t"] == chat.unescape(r["r"])
        assert not any(c in r["e"] or c in r["r"] for c in chat.CONTROL) and "\n" not in r["r"]


def plain_rows(rows):
    """Digest columns straight from the messages."""
    out = []
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out.append((c, len(own), sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)), len(said), sha(said)))
    return sorted(out, key=repr)


def test_conversations_are_read_back(spark, tmp_path):
    rows = [(1, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(HOSTILE)] + [(2, 0, None, None), (2, None, "assistant", "late"), (3, 5, "ro\nle\\n", "x"), (3, 2, "assistant", None), (None, 0, "user", "no id")]
    rows += [(4, k, ("user", "assistant")[k % 2], f"t{k}") for k in range(700)] + [(5, 1, "assistant", "same")] * 3 + [(5, 1, "assistant", None), (5, 1, "user", "same"), (5, 1, None, "z"), (5, 1, "", "a")]
    at = str(tmp_path)
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(f"{at}/conversations.parquet")
    got = sorted(((r["conv_id"], r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in queries.op12_chat_format(spark, at).collect()), key=repr)
    assert got == plain_rows([*rows, (-1, 0, "user", queries.HOSTILE), (-1, 1, "assistant", queries.HOSTILE)])


def plain_paths(nodes, top: int):
    """(tree, path of nodes, mean score) of the best leaves, walked one by one."""
    of = {(t, n): (p, s) for t, n, p, s in nodes}
    leaves = [(t, n) for t, n in of if not any(t == t2 and p2 == n for t2, _, p2, _ in nodes)]
    found = {}
    for t, leaf in leaves:
        walk, at = [], leaf
        while (t, at) in of and at not in walk:
            walk.append(at)
            at = of[t, at][0]
        if at in walk:
            continue
        found.setdefault(t, []).append((-sum(of[t, n][1] for n in walk) / len(walk), leaf, walk[::-1]))
    return {(t, tuple(w)) for t, f in found.items() for _, _, w in sorted(f)[:top]}


@pytest.mark.parametrize("top", [1, 2, 50])
def test_best_paths_of_trees(spark, top):
    rng = random.Random(top)
    nodes = []
    for t in range(12):
        for n in range(rng.randrange(1, 25)):
            parent = None if not n else f"{rng.randrange(n):03d}" if rng.random() < 0.9 else "gone"
            nodes.append((f"t{t}", f"{n:03d}", parent, float(rng.randrange(8))))
    nodes += [("ring", "a", "b", 1.0), ("ring", "b", "a", 1.0), ("ring", "c", "a", 1.0), ("ring", "d", None, 0.0), ("self", "a", "a", 1.0)]
    nodes += [("deep", f"{n:04d}", f"{n - 1:04d}" if n else None, 1.0) for n in range(300)]
    got = chat.paths(spark.createDataFrame(nodes, "tree string, node string, parent string, score double").repartition(3), top).collect()
    found = {}
    for r in got:
        found.setdefault((r["tree"], r["leaf"]), {})[r["place"]] = r["node"]
    assert all(sorted(p) == list(range(len(p))) for p in found.values())
    assert {(t, tuple(p[i] for i in range(len(p)))) for (t, _), p in found.items()} == plain_paths(nodes, top)


def test_formatted_tree(spark):
    rows = [("q", "1", None, "user", "hi", 0.0), ("q", "2", "1", "assistant", "worse", 1.0), ("q", "3", "1", "assistant", "better <s>", 2.0), ("q", "3", "1", "assistant", "zz again", 2.0), (None, None, None, "assistant", "alone", None)]
    d = clashing(spark.createDataFrame(rows, "thread string, msg string, reply_to string, role string, text string, votes double"))
    got = {r["tree"]: r for r in chat.conversations(chat.messages(d, "thread", "msg", "reply_to", "role", "text", F.col("votes"))).collect()}
    assert got["sq"]["formatted"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nbetter <\\-s><|im_end|>\n" and got["sq"]["rank"] == 1
    assert [got["sq"]["formatted"][s["start"] : s["end"]] for s in got["sq"]["loss"]] == ["better <\\-s>"]
    assert chat.parse(got["n"]["formatted"]) == [("assistant", "alone")] and got["n"]["n_turns"] == 1
    assert chat.conversations(chat.messages(d.limit(0), "thread", "msg", "reply_to", "role", "text", F.col("votes"))).count() == 0


def test_conversation_columns_may_clash(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    plain, clash = (chat.conversations(chat.linear(x), chat.linear_keys(x)).collect() for x in (d, clashing(d)))
    assert plain == chat.conversations(chat.linear(d)).collect()
    assert plain == clash and plain[0]["n_turns"] == 2
    assert chat.conversations(chat.linear(d.limit(0))).count() == 0


# runs


def plain_runs(w: list[str], least: int):
    """(start, length, period) of every run, one period after another."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            s = w[start : i + q]
            if len(s) >= max(least, 2 * q) and not any(s[p:] == s[:-p] for p in range(1, q)):
                out.append((start, len(s), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(w, found):
    gone = {i for start, n, q in found for i in range(start + q, start + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def check_slice(texts, least):
    got, left = periods._collapse(texts, least)
    for w, g, kept in zip(texts, got, left, strict=True):
        found = plain_runs(w, least)
        assert list(zip(*(x.tolist() for x in g), strict=True)) == found
        assert kept == plain_collapse(w, found)


@pytest.mark.parametrize("least", [2, 4, 12])
def test_runs_against_every_period(least):
    rng = random.Random(least)
    for _ in range(150):
        texts = []
        for _ in range(rng.randrange(1, 5)):
            w = [rng.choice("abcd"[: rng.randrange(1, 5)]) for _ in range(rng.randrange(60))]
            if w and rng.random() < 0.5:
                a, p = rng.randrange(len(w)), rng.randrange(1, 10)
                w = [w[i] if i < a + p else w[a + (i - a) % p] for i in range(len(w))]
            texts.append(w)
        check_slice(texts, least)


def test_runs_of_words_made_to_collide(monkeypatch):
    """Fibonacci and Thue-Morse words, also where every hash is the same."""
    fib = [["a"], ["a", "b"]]
    while len(fib[-1]) < 150:
        fib.append(fib[-1] + fib[-2])
    texts = [fib[-1], [str(bin(i).count("1") % 2) for i in range(200)], ["x"] * 120, [str(i % 7) for i in range(100)] * 2]
    check_slice(texts, 12)
    monkeypatch.setattr(periods.Sequence, "alike", lambda self, i, j, n: i * 0 == 0)
    check_slice(texts, 12)
    check_slice([list("abcabdabcabd" * 4), list("aabaabaaab" * 6)], 4)


def test_runs_in_slices(spark, monkeypatch):
    texts = [None, "", " \n ", "a " * 30, "x y z", " ".join(f"w{i}" for i in range(50)), "p q r " * 20 + " end", "a " * 30]
    d = spark.createDataFrame([(i, t) for i, t in enumerate([*texts])] + [(None, "a b " * 9)], "doc_id long, text string").coalesce(1)
    want = periods.find(d).collect()
    for r in want:
        w = re.findall(periods.WORD, (([*texts][r["doc_id"]] if r["doc_id"] is not None else "a b " * 9) or ""))
        found = plain_runs(w, 12)
        assert [tuple(x) for x in r["runs"]] == found and r["collapsed"] == plain_collapse(w, found)
    assert sorted(map(repr, periods.find(clashing(d)).collect())) == sorted(map(repr, want))
    assert periods.find(d.limit(0)).count() == 0


def test_long_texts_are_near_linear():
    for w in (["a"] * 60_000, ["a", "b", "a"] * 20_000, [str(i % 1000) for i in range(60_000)]):
        got, left = periods._collapse([w], 12)
        assert len(got[0][0]) == 1 and len(left[0].split()) == int(got[0][2][0])


def planted(doc_id, text):
    w = re.findall(periods.WORD, text or "")
    if doc_id is None:
        return w
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_runs_of_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = queries.op13_word_runs(spark, DATA).collect()
    assert len(got) == len(texts) and any(r["n_runs"] for r in got)
    for r in got:
        w = planted(r["doc_id"], texts[r["doc_id"]])
        if len(w) > 1500:
            continue
        found = plain_runs(w, 12)
        best = min(((-n, s, q) for s, n, q in found), default=None)
        shown = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(found), *shown)
        assert r["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in found)) and r["collapsed_sha256"] == sha(plain_collapse(w, found))
