"""The pipeline's stages against plain forms, each on its own input."""

from collections import Counter

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_packing import check_packed
from tests.llm.util import docs_of
from tidewright.llm import lang_id
from tidewright.llm.common import stored
from tidewright.llm.simhash import simhash
from tidewright.llm.sql import LINE_DEDUP

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), name)
        held[name] = (docs, out)
        docs = out
    return held


def test_order_and_columns(stages):
    assert list(stages) == ["language_id", "line_dedup", "simhash_near_dedup", "source_mix", "best_fit_packing"]
    assert all(out.columns == COLUMNS for _, out in list(stages.values())[:-1])


def test_language_rejects_and_labels(stages):
    docs, out = stages["language_id"]
    found = {r.doc_id: r for r in lang_id.identify(docs, lang_id.train(docs)).collect()}
    want = {(r.doc_id, r.text, found[r.doc_id].language) for r in docs.collect() if found[r.doc_id].accepted}
    assert {(r.doc_id, r.text, r.lang) for r in out.collect()} == want and 0.9 * docs.count() < len(want) < docs.count() + 1


def test_lines(stages):
    docs, out = stages["line_dedup"]
    documents = docs.toPandas()  # noqa: F841
    con = duckdb.connect()
    con.register("documents", documents)
    want = {r[0]: r[2] for r in con.execute(LINE_DEDUP).fetchall() if not r[1] or (r[2] or "").strip(" \t\n\x0b\x0c\r")}
    got = {r.doc_id: r for r in out.collect()}
    assert {k: r.text for k, r in got.items()} == want
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.values())


def test_near_duplicates(stages):
    docs, out = stages["simhash_near_dedup"]
    prints = {r.doc_id: simhash((r.text or "").encode()) for r in docs.collect()}
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {r.doc_id for r in out.collect()} == {d for d in prints if find(d) == d}


def test_mix(stages):
    docs, out = stages["source_mix"]
    before, after = ({r.doc_id: tuple(r) for r in df.collect()} for df in (docs, out))
    copies = Counter(r.doc_id for r in out.select("doc_id").collect())
    assert all(after[d] == before[d] for d in after) and max(copies.values()) <= 3
    words = lambda t: len((t or "").split())
    total = sum(words(r[1]) for r in before.values())
    assert sum(words(before[d][1]) * n for d, n in copies.items()) == pytest.approx(total, rel=0.05)


def test_packing(stages):
    docs, out = stages["best_fit_packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    check_packed(out.collect(), [(r.doc_id, r.text) for r in docs.collect()], tokenizer, 2048)


def test_run_gives_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, SF)
    out = stages["best_fit_packing"][1]
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(tuple(r) for r in rows.select(*key).collect()) == Counter(tuple(r) for r in out.select(*key).collect())


def test_odd_documents_pass_every_stage(spark):
    """NULLs, empty texts, repeated rows and an empty table; the stages do not fail and keep the columns."""
    prose = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    odd = [(None, "no id at all but some more words here"), (901, None), (902, ""), (903, " \n "), (904, "x"), (905, prose[0][1], None, None), prose[1]]
    for rows in (prose + odd, []):
        docs = docs_of(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF), name)
        assert (docs.count() > 0) == bool(rows)
