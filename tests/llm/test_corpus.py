"""The registered corpus queries on the driver's tables, and the pipeline by its stages."""

import collections
import glob
import os
import zlib

import duckdb
import pytest

import corpus_pipeline
from lamina.llm import queries
from tests.conftest import SMALL
from tests.support import by_name


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_equals_sql(spark, key):
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    df = queries.QUERIES[key](spark, SMALL)
    expected = connection.sql(queries.ORACLE[key])
    assert sorted(df.columns) == sorted(expected.columns)
    assert by_name(df.columns, df.collect()) == by_name(expected.columns, expected.fetchall())


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    scored = queries.QUERIES["op8_quality_attention"](spark, SMALL).collect()
    assert len(scored) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    told = [r.predicted == labels[r.doc_id] for r in scored if labels.get(r.doc_id) is not None]
    assert sum(told) >= 0.9 * len(told)
    found = queries.QUERIES["op9_language_backoff"](spark, SMALL).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    right = [r.lang_pred == docs[r.doc_id] for r in found if r.held_out]
    assert sum(right) >= 0.95 * len(right)


def test_pipeline_stages(spark, folder):
    docs = before = spark.read.parquet(f"{SMALL}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        out.write.parquet(f"{folder}/{k}")
        out = spark.read.parquet(f"{folder}/{k}")
        if name != "sharding":
            assert out.columns == before.columns
        assert 0 < out.count() <= docs.count() + 5
        docs = out
    rows = docs.collect()
    assert all(0 <= r.shard < 16 and r.n_chars == len(r.text) for r in rows)
    nothing = before.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, nothing, SMALL)
    assert nothing.count() == 0


def test_pipeline_drops_looser_copies(spark):
    words = [f"w{i}" for i in range(200)]
    edited = [f"v{i}" if i % 50 == 25 else w for i, w in enumerate(words)]
    other = [f"v{i}" if i % 20 == 10 else w for i, w in enumerate(words)]  # about 0.6
    texts = [words, words + [f"a{i}" for i in range(30)], words[:170], edited, other]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, SMALL)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 4]


def test_pipeline_keeps_one_row_of_each_group(spark):
    words = [f"w{i}" for i in range(100)]
    same, near, other = " ".join(words), " ".join(words + ["a", "b"]), " ".join(f"o{i}" for i in range(50))
    rows = [(3, same), (5, near), (5, other), (None, near), (8, ""), (8, ""), (None, None), (None, None), (4, same)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, SMALL)
    expected = [(3, same), (5, other), (8, ""), (8, ""), (None, None), (None, None)]
    assert kept.columns == docs.columns
    assert collections.Counter(map(tuple, kept.collect())) == collections.Counter(expected)
