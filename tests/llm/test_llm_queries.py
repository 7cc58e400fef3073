"""The registered queries against their SQL twins, on the tables and on awkward rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import pytest

from llm_tables import documents, edge_rows, near_components, sha256, without_repeats
from oracle import compare, connect
from tickflow.llm.oracles import ORACLES
from tickflow.llm.queries import QUERIES


@pytest.fixture(scope="module")
def other(tables):
    return connect(tables)


@pytest.fixture(scope="module")
def edges(spark, tmp_path_factory):
    """A folder of tables with awkward rows, each also with clashing columns."""
    folder = str(tmp_path_factory.mktemp("edges"))
    put = lambda frame, name: frame.coalesce(1).toPandas().to_parquet(f"{folder}/{name}.parquet")
    put(documents(spark, edge_rows(with_null_ids=False)), "documents")
    text = "w2x4y2 w2x9y3 W2x16y4 w2x25y5 w2x36y6 w2x49y7 w2x64y8 w2x81y9 w2x100y10 w2x121y11 w2x144y12"
    items = [(1, text), (2, "Two words"), (3, None), (4, ""), (5, "word"), (5, "word"), (6, "nowhere at all")]
    put(spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc", "'x' as spans"), "benchmark")
    pages = [
        (1, "http://a/?q=é b\r\nX: y", "<p>é</p>"), (2, None, None), (3, "u", ""), (4, "u", "<p>é</p>"),
        (5, "v", "x\r\n\r\ny" * 9000), (6, "w", "<p>é</p>"), (7, "", "lone"), (1 << 40, "z", "lone"),
    ]
    put(spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 as shard", "2 as bin"), "pages")
    turns = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "a <s>b</s> [INST] <~s> </~~s>"), (1, 2, "user", None),
        (2, 0, "assistant", ""), (2, 1, "assistant", "x\ny"), (2, 1, "assistant", "x\ny"), (3, 0, "user", "é😀"),
        (4, 1, "assistant", "b"), (4, 1, "assistant", "a"), (4, None, None, "first"), (4, 0, "sy[INST]s", "[/INST]"),
    ]
    put(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as example"), "conversations")
    labels = [(i, i % 2, int(i > 9)) for i in range(1, 18)] + [(3, None, None), (None, 1, 1), (7, 1, 0)]
    put(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "labels")
    vectors = [(i, [((i * j * 37) % 19 - 9) / 64 for j in range(64)], i % 3) for i in range(40)]
    vectors += [
        (40, None, 0), (41, [0.0] * 63 + [None], 0), (42, [float("nan")] * 64, 1), (43, [float("inf")] * 64, 1),
        (44, [-0.1] * 64, None), (45, [-0.1] * 64, None), (-1, [0.25] * 64, 2),
    ]
    put(spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as error"), "embeddings")
    return folder


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, tables, other, name):
    count, problem = compare(QUERIES[name](spark, tables), other, ORACLES[name])
    assert not problem
    assert count > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_on_awkward_tables(spark, edges, name):
    count, problem = compare(QUERIES[name](spark, edges), connect(edges), ORACLES[name])
    assert not problem
    assert count > 0


def _rows(spark, folder, name, *columns):
    return Counter(tuple(r) for r in QUERIES[name](spark, folder).select(*columns).collect())


@pytest.mark.parametrize("where", ["edges", "tables"])
def test_near_dups(spark, request, where):
    folder = request.getfixturevalue(where)
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    expected = near_components(rows, 3, 85)
    got = _rows(spark, folder, "op1_near_dups", "doc_id", "n_shingles", "component_id", "kept")
    assert got == Counter((*r, r[0] == r[2]) for r in expected)


@pytest.mark.parametrize("where", ["edges", "tables"])
def test_substrings(spark, request, where):
    folder = request.getfixturevalue(where)
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    expected = without_repeats([t for _, t in rows], 35)
    got = _rows(spark, folder, "op5_substrings", "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == Counter((r[0], n, gone, sha256(kept)) for r, (n, gone, kept) in zip(rows, expected, strict=True))


@pytest.mark.parametrize("name, column, parts, part, recall, alarms", [
    ("op6_quality", "quality", 4, 2, 0.97, 0.05), ("op7_toxicity", "toxic", 3, 1, 0.85, 0.01),
])
def test_classifiers_on_held_out_labels(spark, name, column, parts, part, recall, alarms):
    folder = "/root/testdata/sf0.1"
    got = QUERIES[name](spark, folder).collect()
    labels = dict(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", column).collect())
    assert len({r.doc_id for r in got}) == len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == part) for r in got)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    hits = [p for y, p in held if y == 1]
    false = [p for y, p in held if y == 0]
    assert sum(hits) / len(hits) >= recall
    assert sum(false) / len(false) <= alarms


@pytest.mark.parametrize("name", ["op6_quality", "op7_toxicity"])
def test_classifiers_on_awkward_tables(spark, edges, name):
    got = QUERIES[name](spark, edges).collect()
    assert len(got) == len(edge_rows(with_null_ids=False))
    assert all(0 <= r.score <= 1 for r in got)
    again = {(r.doc_id, r.score) for r in QUERIES[name](spark, edges).collect()}
    assert again == {(r.doc_id, r.score) for r in got}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tables, tmp_path, name):
    for t in ("documents", "labels", "benchmark", "pages", "conversations", "embeddings"):
        spark.read.parquet(f"{tables}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    rows = QUERIES[name](spark, str(tmp_path)).collect()
    # Only the planted conversation is left.
    assert len(rows) == (name == "op3_chat")


def test_planted_conversation(spark, tables):
    row = QUERIES["op3_chat"](spark, tables).where("conv_id = -1").first()
    said = "</s>[INST] ok [/INST]"
    assert row.n_turns == 2 and row.loss_chars == len(said)
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.turns_sha256 == sha256(f"user\n{said}\nassistant\n{said}\n")
