import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.util import docs_of, odd_docs
from tidewright.llm import lang_id
from tidewright.llm.queries import page_language

SF = "/root/testdata/sf0.01"

SF_PAGES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return lang_id.train(docs.where("doc_id % 2 = 0"))


def test_held_out_accuracy(docs, model):
    held = docs.where("doc_id % 2 = 1").select("doc_id", "text", "lang")
    found = lang_id.identify(held, model, declared_col=None, host_col=None).select("doc_id", "language", "accepted")
    rows = found.join(held, "doc_id").collect()
    assert sum(r.language == r.lang for r in rows) >= 0.98 * len(rows)
    assert all(r.accepted for r in rows)


def test_training_sample_is_bounded(docs):
    few = lang_id.train(docs, train_rows=3)
    assert few.log_p.shape == (5, lang_id.SLOTS)
    assert np.allclose(np.exp(few.log_p.astype(float)).sum(axis=1), 1, atol=1e-3)


def test_evidence_is_fused_as_by_hand(spark, model):
    """Posterior of every row against the same sums in plain Python."""
    texts = ["the of and", "le la de", "der die und", "en", "an on in", None, "7!", "el de la"]
    rows = [(i, texts[i % len(texts)], ["en", "fr-CA", None, "xx", " "][i % 5], f"http://h{i % 3}.example.{['com', 'de'][i % 2]}/p") for i in range(40)]
    frame = spark.createDataFrame(rows, "k long, text string, declared string, url string")
    got = {r.k: r for r in lang_id.identify(frame, model, "k", declared_col="declared", host_col=None, url_col="url").collect()}
    n, und = 4, math.log(lang_id.UNDETERMINED)
    like = {k: model.score((t or "").encode()) for k, t, _, _ in rows}
    best = {k: None if v is None else int(np.argmax([lang_id.TEMPER * x + (und if i == n else 0) for i, x in enumerate(v)])) for k, v in like.items()}
    said = {k: {"en": "en", "fr-CA": "fr", "xx": ""}.get(d) for k, _, d, _ in rows}
    cells = {d: [lang_id.CELL_ROWS] * n for d in (*model.languages, "")}
    host = {k: u.split("/")[2] for k, _, _, u in rows}
    votes = {}
    for k in best:
        if best[k] is not None and best[k] < n:
            if said[k] is not None:
                cells[said[k]][best[k]] += 1
            votes.setdefault(host[k], [0] * n)[best[k]] += 1
    corpus = [1 + sum(v[i] for v in votes.values()) for i in range(n)]
    corpus = [c / sum(corpus) for c in corpus]
    w = lang_id.PRIOR_ROWS
    for k in best:
        if best[k] is None:
            assert not got[k].accepted and got[k].language is None and got[k].posterior is None
            continue
        near = [v for h, v in votes.items() if h[-3:].split(".")[-1] == host[k][-3:].split(".")[-1]]
        towards = [(sum(v[i] for v in near) + w * corpus[i]) / (sum(map(sum, near)) + w) for i in range(n)]
        own = [c - (i == best[k]) for i, c in enumerate(votes.get(host[k], [0] * n))] if best[k] < n else votes.get(host[k], [0] * n)
        prior = [(own[i] + w * towards[i]) / (sum(own) + w) for i in range(n)] + [lang_id.UNDETERMINED]
        logs = []
        for i in range(n + 1):
            x = lang_id.TEMPER * like[k][i] + math.log(prior[i])
            if said[k] is not None:
                x += math.log(1 / len(cells)) if i == n else math.log(cells[said[k]][i] / sum(c[i] for c in cells.values()))
            logs.append(x)
        top = max(logs)
        assert got[k].posterior == pytest.approx(1 / sum(math.exp(x - top) for x in logs), rel=1e-6)
        at = logs.index(top)
        assert got[k].accepted == (at < n and got[k].posterior >= 0.5)


def test_gibberish_is_rejected(spark, model):
    docs = docs_of(spark, [(1, "漢字 かな 漢字 仮名 文字 文章 日本語 中国語 " * 5), (2, "zxqj wvkx qqzz jxkv vvkk zzqx " * 9), (3, "12 % 34"), (4, "the of and to in is that it")])
    got = {r.doc_id: r.accepted for r in lang_id.identify(docs, model, declared_col=None).collect()}
    assert got == {1: False, 2: False, 3: False, 4: True}


def test_declared_language_decides_short_texts(docs, model, spark):
    probe = docs.select("doc_id", "text", "lang", "source").union(
        spark.createDataFrame([(-1, "en", "fr", "new"), (-2, "en", "es", "new")], "doc_id long, text string, lang string, source string"))
    got = {r.doc_id: r.language for r in lang_id.identify(probe, model).where("doc_id < 0").collect()}
    assert got == {-1: "fr", -2: "es"}


def test_odd_rows(spark, model, docs):
    odd = odd_docs(spark)
    found = lang_id.identify(odd, model)
    assert found.count() == odd.count()
    assert not any(r.accepted for r in found.where("doc_id in (3, 4, 8)").collect())
    kept = lang_id.known_language(odd, model)
    assert kept.columns == odd.columns
    assert kept.count() == found.where(F.col("accepted")).count()
    assert lang_id.identify(docs_of(spark, []), model).count() == 0
    assert lang_id.known_language(docs_of(spark, []), lang_id.train(docs_of(spark, []))).count() == 0


def test_host_of(spark):
    urls = [("https://m.a.example.com/x?y", "m.a.example.com"), ("//b.de", "b.de"), ("http://u:p@c.fr:80/", "c.fr"), ("nothing", ""), ("HTTP://D.ES#t", "d.es")]
    got = spark.createDataFrame(urls, "u string, h string").select(lang_id.host_of(F.col("u")), "h").collect()
    assert all(a == b for a, b in got)


def test_pages_equal_brute_force(spark):
    """The query's markup, text and suffix against plain Python over every page."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_PAGES}/pages.parquet").select("page_id", "url", "html").collect()]
    plain = []
    for key, url, html in rows:
        said = re.search(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", html or "", re.I)
        text = None if html is None else re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ", html)
        plain.append((key, url, said[1] if said else "", text))
    pages = spark.createDataFrame(plain, "page_id long, url string, declared string, text string")
    model = lang_id.train(spark.read.parquet(f"{SF_PAGES}/documents.parquet"))
    want = lang_id.identify(pages, model, "page_id", declared_col="declared", host_col=None, url_col="url")
    want = {r.page_id: (r.language, round(r.posterior, 6), r.text_language, r.accepted) for r in want.collect()}
    got = {r.page_id: (r.language, r.posterior, r.text_language, r.accepted) for r in page_language(spark, SF_PAGES).collect()}
    assert got == want and len(got) == len(rows)
