import hashlib
import json
import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.util import docs_of, odd_docs
from tidewright.llm import bpe
from tidewright.llm.queries import bpe_round_trip

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def encoded(text, held):
    table = bpe.encoded_words(set(bpe.words_of(text)), bpe.vocabulary(None), held)
    return np.frombuffer(b"".join(map(table.__getitem__, bpe.words_of(text))), "<u4").tolist()


@pytest.fixture(scope="module")
def held(tmp_path_factory):
    path = tmp_path_factory.mktemp("lexicon") / "lexicon"
    words = [w.encode() for w in "the then there their these those a an and ands ing ring string strings of on 7 !! ' \u00e9t\u00e9 m\u00fcde".split()]
    path.write_bytes(bpe.compiled(words, bpe.vocabulary(None).merge))
    return bpe.Lexicon(str(path))


TEXTS = [
    "", " ", "a", "The THEN  there\nstrings", "It's they'LL 'tis don''t 12 345", "\u00c9t\u00e9 e\u0301t\u00e9 M\u00dcDE \u00df \u0130I \u03a3\u03a3 \u039f\u03a3", "a\x1cb \x1c a\x1f", "x\x00y\x7f",
    "<|endoftext|> a<|endoftext|>b <|STARTOFTEXT|> <|startoftext|><|endoftext|>", "<|endoftext", "\u65e5\u672c\u8a9e\u306e\u6587", "\ud55c\uad6d\uc5b4 \u1112\u1161\u11ab", "\u0627\u0644\u0639", "a\u0301\u0323 \u0301x",
    "\U0001f600!!\U0001f601 ...", "a\u2028b\u3000c\xa0d\u200be\u2003f\u180eg", "\u00bd\u2460 \u0663", "s'S t'T", "\ufb01\u212b\u01c5", "\u1e9e\u0345\u03b1\u0345", "\u2000\u2001 \u0344",
]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_equal_the_library(tokenizer, held, text):
    assert encoded(text, held) == tokenizer.encode(text, add_special_tokens=False).ids


def test_every_character_in_context(tokenizer, held):
    for code in range(0x30000):
        if 0xD800 <= code < 0xE000:
            continue
        text = f"The{chr(code)}n s{chr(code)}"
        if not unicodedata.category(chr(code)).startswith("Cn") and code % (1 if code < 0x3100 else 37) == 0:
            assert encoded(text, held) == tokenizer.encode(text, add_special_tokens=False).ids, hex(code)


@pytest.mark.parametrize("seed", range(20))
def test_random_texts(tokenizer, held, seed):
    rng = random.Random(seed)
    alphabet = "".join(rng.choices("etaoinshr dluTHE,.!'19\n\t\u00e9\u00fc\u00dfÉ-<|>", k=rng.randrange(3, 25)))
    for _ in range(40):
        text = "".join(rng.choices(alphabet, k=rng.randrange(200)))
        assert encoded(text, held) == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_words_merged_together_equal_each_alone():
    known, rng = bpe.vocabulary(None), random.Random(8)
    words = [bytes(rng.choices(b"etaoinshrdluz,\xc3\xa9", k=rng.randrange(1, 60))) for _ in range(3000)]
    want = [np.array(known.merge(w), "<u4").tobytes() for w in words]
    assert known.merge_all(words) == want
    heap = [known.merge_long([known.inner[b] for b in w[:-1]] + [known.final[w[-1]]]) for w in words]
    assert [np.array(h, "<u4").tobytes() for h in heap] == want
    assert known.merge_all([]) == []


def test_long_words_are_merged(tokenizer, held):
    text = "ab" * 20_000 + " " + "the" * 3000 + "\u65e5" * 5000
    assert encoded(text, held) == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(10))
def test_automaton_is_exact_and_minimal(tmp_path, seed):
    rng = random.Random(seed)
    words = {bytes(rng.choices(b"abc", k=rng.randrange(1, 7))): [rng.randrange(4) for _ in range(rng.randrange(4))] for _ in range(300)}
    path = tmp_path / "lexicon"
    path.write_bytes(bpe.compiled(words, words.__getitem__))
    held = bpe.Lexicon(str(path))
    others = {bytes(rng.choices(b"abcd", k=rng.randrange(1, 9))) for _ in range(500)} | {b"", b"a" * 500}
    asked = [*words, *others]
    for word, got in zip(asked, held.look_up(asked)):
        assert (got is None) if word not in words else np.frombuffer(got, "<u4").tolist() == words[word]
    # as few states as there are different sets of rests, with what is left of the ids
    lead, rests = {}, {}
    for word, ids in words.items():
        for i in range(len(word) + 1):
            seen = lead.get(word[:i])
            lead[word[:i]] = ids if seen is None else seen[: bpe.common(tuple(seen), tuple(ids))]
    for word, ids in words.items():
        for i in range(len(word) + 1):
            rests.setdefault(word[:i], set()).add((word[i:], tuple(ids[len(lead[word[:i]]) :])))
    assert len(held.finals) == len({frozenset(r) for k, r in rests.items() if k}) + 1


def test_suffixes_are_shared(held):
    assert len(held.finals) < sum(len(w) for w in "the then there their these those a an and ands ing ring string strings".split())


def check_query(rows, got, tokenizer):
    want = []
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_the_library(spark, tokenizer, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    check_query([(r.doc_id, r.text) for r in docs.collect()], bpe_round_trip(spark, f"/root/testdata/{sf}"), tokenizer)


def test_odd_rows(spark, tokenizer, tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 1000)
    extra = docs_of(spark, [(100 + i, t) for i, t in enumerate(TEXTS)]).selectExpr("*", "'r' as rank", "1 as size", "2 as _bucket", "'v' as variant", "'l' as label", "3 as fp")
    docs = odd_docs(spark).unionByName(extra, allowMissingColumns=True).selectExpr("*", "1 as ids", "'w' as word", "2 as n", "3 as text_bytes")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    check_query([(r.doc_id, r.text) for r in docs.collect()], bpe_round_trip(spark, str(tmp_path)), tokenizer)


def test_empty_table(spark, tmp_path):
    docs_of(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert bpe_round_trip(spark, str(tmp_path)).count() == 0


def test_lexicon_holds_the_most_frequent_words(spark):
    docs = docs_of(spark, [(k, "one " * (k + 1) + "two " * k + f"rare{k} Three. three!") for k in range(9)])
    assert set(bpe.frequent_words(docs, "text", None, 100)) == {b"one", b"two", b"three", b".", b"!", b"rare"} | set(b"%d" % k for k in range(0))
    assert set(bpe.frequent_words(docs, "text", None, 2)) <= {b"one", b"two"}


def test_other_files_are_refused(tmp_path):
    with pytest.raises(ValueError, match="word-end"):
        bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    said = json.load(open(PATH))
    said["normalizer"]["normalizers"] = said["normalizer"]["normalizers"][:2]
    (tmp_path / "other.json").write_text(json.dumps(said))
    with pytest.raises(ValueError, match="word-end"):
        bpe.Vocabulary(str(tmp_path / "other.json"))


def test_pieces_of_many_parts_equal_those_of_each():
    known, special = bpe.vocabulary(None), "<|endoftext|>"
    parts = sorted({p for t in TEXTS for p in bpe.words_of(t)} | {"The", "Été", "a1", "don't", special, f"a{special}B"})
    for told in (True, False):
        assert known.pieces_of(parts, told) == {p: known.pieces(p, told) for p in parts}


def test_ids_of_a_batch_are_decoded_together(spark):
    """Ids of no token, also at the ends of a text, and texts without ids keep the texts apart."""
    tokens = bpe.vocabulary(None).tokens
    a, b, none = tokens.index("the</w>"), tokens.index("of</w>"), len(tokens) + 5
    ids = [[a, b], [], [none], [none, a, none, 2**32 - 1], None, [b]]
    rows = [(k, None if i is None else bytearray(np.array(i, "<u4").tobytes())) for k, i in enumerate(ids)]
    got = bpe.decode(spark.createDataFrame(rows, "doc_id long, ids binary").coalesce(1)).collect()
    assert [r.text for r in sorted(got)] == ["the</w> of</w>", "", "", "the</w>", "", "of</w>"]
    assert bytes(next(r.ids for r in got if r.doc_id == 0)) == bytes(rows[0][1])
