"""Columns and values of the queries that have no SQL, on the driver's tables, by plain Python."""

import collections
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lamina.llm import queries
from tests.conftest import SMALL
from tests.llm.test_operators import TOKENIZER


@pytest.fixture(scope="module")
def documents(spark):
    return sorted(spark.read.parquet(f"{SMALL}/documents.parquet").collect(), key=lambda r: r.doc_id)


def test_token_files(spark, documents):
    got = queries.QUERIES["op1_token_files"](spark, SMALL)
    assert dict(got.dtypes) == {c: "bigint" for c in ("doc_id", "start", "n_tokens", "ids_crc32")}
    plain, expected, start = Tokenizer.from_file(TOKENIZER), [], 0
    for r in documents:
        ids = plain.encode(r.text or "", add_special_tokens=False).ids + [2]
        expected.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in got.select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == expected


def test_token_counts(spark, documents):
    plain = Tokenizer.from_file(TOKENIZER)
    plain.encode_special_tokens = True
    expected = [(r.doc_id, len(plain.encode(r.text or "", add_special_tokens=False).ids)) for r in documents]
    assert sorted(map(tuple, queries.QUERIES["op5_token_counts"](spark, SMALL).collect())) == expected


def test_shards(spark, documents):
    got = queries.QUERIES["op4_minimax_shards"](spark, SMALL).collect()
    texts = {r.doc_id: r.text or "" for r in documents}
    assert sorted(r.doc_id for r in got) == sorted(texts)
    place, slots, sizes = {}, collections.defaultdict(list), collections.Counter()
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        assert place.setdefault(texts[r.doc_id], r.shard) == r.shard and 0 <= r.shard < 16
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = collections.Counter()
    for text in texts.values():
        groups[text] += len(text.encode()) + 1
    assert max(sizes.values()) - sum(sizes.values()) / 16 <= max(groups.values())


def test_fixity(spark):
    pages = [r.page_id for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    got = queries.QUERIES["op6_warc_fixity"](spark, SMALL).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    assert all(r.intact == (zlib.crc32(str(r.page_id).encode()) % 100 != 3) == (r.sha256 == r.replica_sha256) for r in got)


def test_mixing(spark, documents):
    got = queries.QUERIES["op7_mixing"](spark, SMALL).collect()
    texts = {r.doc_id: r.text or "" for r in documents}
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert r.n_tokens == len(texts[r.doc_id].encode().split())
        assert abs(sum(r[f"p_{d}"] for d in queries.DOMAIN_WEIGHTS) - 1) < 1e-9
        assert r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1)


def test_nearest(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in rows])
    vectors = np.array([r.embedding for r in rows], float)
    got = collections.defaultdict(list)
    for r in sorted(queries.QUERIES["op10_onebit_codes"](spark, SMALL).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert sorted(got) == sorted(i for i in ids.tolist() if i % 100 == 0)
    hits = 0
    for query, found in got.items():
        far = np.sqrt(((vectors - vectors[ids == query]) ** 2).sum(axis=1))
        order = [k for k in np.lexsort((ids, far)) if ids[k] != query][:10]
        assert [rank for rank, _, _ in found] == list(range(1, 11))
        assert all(score == pytest.approx(far[ids == v][0], rel=1e-12) for _, v, score in found)
        hits += len({v for _, v, _ in found} & {int(ids[k]) for k in order})
    assert hits >= 0.9 * 10 * len(got)
