"""The operators' queries against their SQL on the smallest test tables and on a table of edge cases."""

from __future__ import annotations

import os

import duckdb
import pytest

from cytogrid.llm.queries import QUERIES, SQL

DATA = os.environ.get("CYTOGRID_TEST_DATA", "/root/testdata/sf0.001")
LONG = " ".join(f"w{i}" for i in range(60))
DOCS = [(1, None, "s"), (2, "", "s"), (3, " \n\t\n", None), (4, LONG + "\nx", "s"), (5, "y\n" + LONG, "t"), (6, "a b\nc\nd e f\n\ng\nh", "t"), (7, "a b\nc\nd e f\n\ng\nh", "s"), (8, LONG + " " + LONG, "s"), (9, "é # | <b>\r\né # | <b>\r\n" * 40, None)]
PAGES = [
    (1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.org/es/x?q=/y"), (5, "https://example.org/en/1234"), (6, "https://example.org/en"), (7, "http://org"), (8, "http://notexample.com/de/"),
    (9, "x://y//a//b/c/d/e#f"), (10, "http://b.com/fr/deadbeef01234567/12"), *((20 + i, f"http://h.net/{'ab'[i % 2]}/p{i}/q") for i in range(60)), *((100 + i, f"http://m.com/{('de', 'fr', 'es')[i % 3]}/{i}") for i in range(30)),
]


def rows(cur_or_df, names=None):
    found = cur_or_df.collect() if names is None else cur_or_df.fetchall()
    cols = cur_or_df.columns if names is None else names
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted([tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in found], key=repr)


def compare(spark, folder: str, name: str) -> None:
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        path = f"{folder}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    cur = con.execute(SQL[name])
    df = QUERIES[name](spark, folder)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df) == rows(cur, names)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_on_test_tables(spark, name):
    compare(spark, DATA, name)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("edge"))
    spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in DOCS], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(*p, "h") for p in PAGES], "page_id long, url string, html string").write.parquet(f"{at}/pages.parquet")
    vectors = [(i, [0.1 * (i % 7), -0.5, float(i)]) for i in range(45)] + [(100, None), (120, [1.0, None, 2.0]), (140, [1.0, float("nan"), 2.0]), (160, [1.0, float("inf"), 0.0])]
    spark.createDataFrame([(*v, 0) for v in vectors], "vec_id long, embedding array<float>, label int").write.parquet(f"{at}/embeddings.parquet")
    turns = [(1, 0, None, None), (1, 1, "assistant", "a\\<|x|> </s>[/INST]"), (2, 3, "assistant", "b"), (2, 1, "us\ner", "<<SYS>>"), (None, 0, "user", "")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{at}/conversations.parquet")
    return at


@pytest.mark.parametrize("name", sorted(SQL))
def test_on_edge_cases(spark, folder, name):
    compare(spark, folder, name)


def test_clusters_of_odd_vectors(spark, tmp_path):
    vectors = [(i, [0.01 * ((i * j) % 9) - 0.03 for j in range(64)]) for i in range(30)] + [(3, [0.5] * 64), (None, [0.25] * 64), (40, None), (41, [1.0]), (42, [None] * 64), (43, [float("nan")] * 64), (44, [float("-inf")] * 64)]
    spark.createDataFrame([(*v, 0) for v in vectors], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    compare(spark, str(tmp_path), "op11_lloyd_clusters")
