import re
import time

import pytest
from pyspark.sql import functions as F

from tests.llm.util import docs_of, keeps_columns, odd_docs
from tidewright.llm import pii

KEY = "test key"


def replaced(spark, texts):
    rows = pii.with_surrogates(docs_of(spark, list(enumerate(texts))), KEY).collect()
    return [r.text for r in sorted(rows, key=lambda r: r.doc_id)], [r.n_entities for r in sorted(rows, key=lambda r: r.doc_id)]


def test_types_and_formats(spark):
    texts = ["Write to Jo.Doe99@mail3.Example.com now", "call +1 (679) 555-3007.", "from 152.143.123.131###", "card 4785380592391139$$$",
             "card 4785 3805 9239 1139", "ssn 078-05-1120", "GB82 WEST 1234 5698 7654 32", "plain text, 12 apples 3.14 and 2026-01-02."]
    out, n = replaced(spark, texts)
    assert n == [1, 1, 1, 1, 1, 1, 1, 0] and out[7] == texts[7]
    shapes = [r"Write to [A-Z][a-z]\.[A-Z][a-z]{2}\d\d@[a-z]{4}\d\.[A-Z][a-z]{6}\.com now", r"call \+\d \(\d{3}\) \d{3}-\d{4}\.",
              r"from (\d{1,3}\.){3}\d{1,3}###", r"card 4\d{15}\$\$\$", r"card 4\d{3} \d{4} \d{4} \d{4}", r"ssn \d{3}-\d{2}-\d{4}",
              r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d"]
    for before, after, shape in zip(texts, out, shapes):
        assert re.fullmatch(shape, after) and after != before
    assert out[3][5:21] == out[4][5:].replace(" ", "")


def test_coreference_and_distinctness(spark):
    mails = [f"user{i}@host{i % 7}.org" for i in range(300)]
    texts = [f"a {m} b {m.upper()} c" for m in mails] + [" ".join(mails)]
    out, _ = replaced(spark, texts)
    told = out[-1].split(" ")
    assert len(set(told)) == 300 and not set(told) & set(mails)
    for i, m in enumerate(told):
        assert out[i] == f"a {m} b {m.rsplit('.', 1)[0].upper()}.ORG c" or out[i].lower() == f"a {m} b {m} c"
    assert len({m.split("@")[1] for m in told}) == 7


def test_small_space_has_no_collisions(spark):
    """A hundred addresses of one letter and one digit; the space has 260."""
    mails = [f"{a}{d}@x.de" for a in "abcdefghij" for d in range(10)]
    out, _ = replaced(spark, [" ".join(mails)])
    told = out[0].split(" ")
    assert len(set(told)) == 100 and not set(told) & set(mails)


@pytest.mark.parametrize("key", ["one", "two", "three"])
def test_full_space(spark, key):
    """Every mail of one letter at one host, and every two-digit end of a number: all stay different."""
    mails = [f"{chr(97 + k)}@gmail.com" for k in range(26)]
    phones = [f"+1 212 555 01{k:02}" for k in range(100)]
    start = time.perf_counter()
    rows = pii.with_surrogates(docs_of(spark, [(0, " ".join(mails)), (1, "; ".join(phones))]), key).collect()
    assert time.perf_counter() - start < 30
    mail, phone = (r.text for r in sorted(rows, key=lambda r: r.doc_id))
    assert len(set(mail.split(" "))) == 26 and not set(mail.split(" ")) & set(mails)
    assert len({m.split("@")[1] for m in mail.split(" ")}) == 1
    assert len(set(phone.split("; "))) == 100 and all(re.fullmatch(r"\+1 \d{3} \d{3} \d{4}", p) for p in phone.split("; "))


def test_permutation_is_one_to_one(spark):
    norms = [f"{a}{b}{c}" for a in "0123456789" for b in "abcdefghijklmnopqrstuvwxyz" for c in "01234"]
    table = spark.createDataFrame([(n, n) for n in norms], "norm string, body string")
    got = [r.body for r in pii.permuted(table, "body", KEY, F.lit("t")).collect()]
    assert len(set(got)) == len(norms) and all(re.fullmatch(r"\d[a-z]\d", g) for g in got)
    addresses = [(f"10.0.{i}.{j}", "address") for i in range(30) for j in range(256)]
    cores = pii.with_core(spark.createDataFrame(addresses, "norm string, kind string"), KEY, 0).select("core").distinct()
    assert cores.count() == len(addresses)


def luhn_right(number):
    digits = [int(c) for c in re.sub(r"\D", "", number)][::-1]
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def mod97_right(number):
    bare = number.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


def test_check_digits_stay_right_or_wrong(spark):
    texts = ["4111 1111 1111 1111", "4111111111111112", "378282246310005", "GB82 WEST 1234 5698 7654 32", "GB83WEST12345698765432", "DE89 3704 0044 0532 0130 00"]
    out, n = replaced(spark, texts)
    assert n == [1] * 6 and not set(out) & set(texts)
    assert [luhn_right(t) for t in out[:3]] == [True, False, True] and [mod97_right(t) for t in out[3:]] == [True, False, True]
    assert out[0][0] == "4" and out[3][:2] == "GB" and out[5][:2] == "DE"


def test_country_codes_and_scripts(spark):
    texts = ["+1 (212) 555-0147", "+49 30 123456", "+49 (30) 1234 5678", "Mr Արամ", "Mr 王小明", "Господин Иванов"]
    out, n = replaced(spark, texts)
    assert out[0].startswith("+1 (") and out[1].startswith("+49 ") and out[2].startswith("+49 (") and n[:3] == [1, 1, 1]
    assert out[3:5] == texts[3:5]  # no names of these scripts: left alone
    assert re.fullmatch("Господин [А-я]+мер", out[5]) and out[5] != texts[5]


def test_surrogates_keep_off_entities_that_occur(spark):
    """The image of one number stands in another text: it gets another image, and nothing meets."""
    first = "078-05-1120"
    image = replaced(spark, [first])[0][0]
    out, _ = replaced(spark, [first, image])
    assert len(set(out)) == 2 and not set(out) & {first, image}


def test_names_keep_gender_script_case_and_reference(spark):
    texts = ["Mr. John Smith met Mrs Mary Smith and MR. SMITH", "Then Mr Smith left Mrs. SMITH", "Госпожа Анна Иванова", "Frau Anna Weber"]
    out, n = replaced(spark, texts)
    m = re.fullmatch(r"Mr\. (\w+ron) (\w+mer) met Mrs (\w+lina) (\w+mer) and MR\. SMITH", out[0])
    assert m and m[2] == m[4] and n[0] == 2
    assert out[1] == f"Then Mr {m[2]} left Mrs. {m[2].upper()}"
    assert re.fullmatch("Госпожа [А-я]+лина [А-я]+мер", out[2]) and re.fullmatch(r"Frau \w+lina \w+mer", out[3])


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    mail = re.compile(r"[\w.+-]+@[\w-]+\.[\w.]*\w")
    held = {m for t in before.values() for m in mail.findall(t)}
    rows = pii.with_surrogates(docs, KEY).collect()
    assert held and sum(r.n_entities for r in rows) >= len(held)
    for r in rows:
        assert not held & set(mail.findall(r.text))
        if not r.n_entities:
            assert r.text == before[r.doc_id]
        assert len(r.text.split("\n")) == len(before[r.doc_id].split("\n"))


def test_reruns_and_keys(spark):
    docs = docs_of(spark, [(1, "x a.b@c.de y")])
    one, two = (pii.with_surrogates(docs, KEY).first().text for _ in range(2))
    assert one == two != pii.with_surrogates(docs, "other").first().text


def test_odd_rows(spark):
    odd = odd_docs(spark).selectExpr("*", "1 as n_entities", "2 as pos", "3 as part", "'k' as kind", "4 as core", "5 as _parts", "6 as said")
    rows = pii.with_surrogates(odd, KEY).collect()
    assert keeps_columns(odd, pii.with_surrogates(odd, KEY))
    assert len(rows) == odd.count() and sum(r.n_entities for r in rows) == 0
    assert pii.with_surrogates(docs_of(spark, []), KEY).count() == 0
    twice = docs_of(spark, [(1, "a@b.cd"), (1, "a@b.cd"), (None, "a@b.cd"), (2, None)])
    out = [r.text for r in pii.with_surrogates(twice, KEY).collect()]
    assert len(set(out)) == 2 and None in out and "a@b.cd" not in out
