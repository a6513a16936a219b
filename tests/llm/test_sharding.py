import hashlib
from collections import defaultdict

import pytest

from tests.llm.util import docs_of, odd_docs
from tidewright.llm import sharding


def brute(rows, limit):
    """{(id, bytes)...: shard}: splits oversized buckets one bit at a time."""
    bits = {k: f"{int(hashlib.md5(('' if k is None else str(k)).encode()).hexdigest()[:15], 16):060b}" for k, _ in rows}
    out = {}

    def split(part, prefix):
        if sum(b for _, b in part) <= limit or len(part) == 1 or len(prefix) == 60:
            out.update({k: prefix for k, _ in part})
        else:
            for c in "01":
                if inside := [r for r in part if bits[r[0]].startswith(prefix + c)]:
                    split(inside, prefix + c)

    split(rows, "")
    return out


@pytest.mark.parametrize("limit", [10, 300, 3_000, 10**6])
def test_against_splitting_bit_by_bit(spark, limit):
    docs = docs_of(spark, [(i, "é" * (i % 13)) for i in range(400)])
    rows = sharding.shard(docs, limit=limit).collect()
    assert {r.doc_id: r.shard for r in rows} == brute([(i, 2 * (i % 13)) for i in range(400)], limit)
    assert len(rows) == 400 and all(r.page == 0 and r.bytes == 2 * (r.doc_id % 13) for r in rows)


def test_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SPARE_BITS", -2)
    monkeypatch.setattr(sharding, "STEP_BITS", 2)
    docs = docs_of(spark, [(i, "x" * 10) for i in range(300)])
    assert {r.doc_id: r.shard for r in sharding.shard(docs, limit=25).collect()} == brute([(i, 10) for i in range(300)], 25)


def test_equal_keys_go_to_pages(spark):
    docs = docs_of(spark, [(7, "x" * 40)] * 50 + [(8, "y" * 10)])
    rows = sharding.shard(docs, limit=100).collect()
    held = defaultdict(int)
    for r in rows:
        held[r.shard, r.page] += r.bytes
    assert len(rows) == 51 and max(held.values()) <= 100 and len(held) == 26


def test_written_shards(spark, tmp_path):
    docs = docs_of(spark, [(i, "x" * 50) for i in range(40)] + [(3, "x" * 50)])
    sharding.write_shards(docs, f"{tmp_path}/s", limit=500)
    back = spark.read.parquet(f"{tmp_path}/s")
    assert back.count() == 41 and set(docs.columns) < set(back.columns)
    wide = sharding.directory(sharding.shard(docs, limit=500)).collect()
    assert sum(r.rows for r in wide) == 41 and all(r.bytes <= 500 for r in wide)


def test_odd_rows(spark):
    docs = odd_docs(spark).selectExpr("*", "1 as bits", "2 as bytes", "'s' as shard", "3 as page")
    rows = sharding.shard(docs, limit=50).collect()
    assert len(rows) == docs.count()
    assert sharding.shard(docs_of(spark, [])).count() == 0
