"""Byte-level BPE against the tokenizers library."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from swapbook.llm import bpe
from swapbook.llm.queries import TOKENIZER

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decoded))


def compare(spark, library, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids", "2 as decoded")
    found = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(df, TOKENIZER).collect())
    assert found == sorted((i, *expected(library, t)) for i, t in rows)


def test_whole_table(spark, library):
    compare(spark, library, [(r.doc_id, r.text) for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()])


def test_odd_texts(spark, library):
    rng = random.Random(3)
    texts = [
        None, "", " ", "\n\n  x", "a<|endoftext|>b", "<|endoftext|><|endoftext|>", "don't we'll I'M 'S", "  two  spaces ",
        " nb em　wide", "日本語のテキスト", "🙂👩‍👩‍👧 é é", "\x00\x01\x7f\x85​", "١٢٣ ½ ²", "aaaa" * 3000,
        "тест Ελληνικά العربية", "word " * 20_000,
    ]
    pool = [chr(c) for c in [*range(1, 0x250), *range(0x3040, 0x3080), 0x1F600, 0x2028, 0x1680]]
    texts += ["".join(rng.choice(pool) for _ in range(rng.randrange(1, 200))) for _ in range(200)]
    texts += ["".join(rng.choice("ab c'st\n") for _ in range(100)) for _ in range(100)]
    compare(spark, library, list(enumerate(texts)) + [(3, "\n\n  x")])


def test_empty_table(spark):
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string"), TOKENIZER).count() == 0


def test_trie_walk_is_plain_merging():
    with open(TOKENIZER, encoding="utf-8") as file:
        model = bpe.ByteBpe(file.read())
    rng = random.Random(1)
    words = {"".join(rng.choice("etaoinshr") for _ in range(rng.randrange(1, 20))) for _ in range(500)}
    assert all(list(ids) == model.merged(w.encode()) for w, ids in model.encode_words(words).items())


def test_parts_cover_everything():
    texts = ["x" * n for n in (0, 5, 2_000_000, 1, 999_999, 2)] + [None] * 600
    slices = list(bpe.parts(texts))
    assert [i for s in slices for i in range(s.start, s.stop)] == list(range(len(texts)))
    assert list(bpe.parts([])) == []


def test_pairs_stay_apart_as_plain_merging_says():
    """The border between two tokens against merging their bytes, for any two tokens and for short ones; in any order of ranks."""
    with open(TOKENIZER, encoding="utf-8") as file:
        model = bpe.ByteBpe(file.read())
    assert model.ordered
    rng, ids = random.Random(2), list(model.id_of.values())
    short = [i for i in ids if len(model.bytes_of[i]) <= 3]
    apart = 0
    for k in range(20_000):
        pool = short if k % 2 else ids
        a, b = rng.choice(pool), rng.choice(pool)
        plain = model.merged(model.bytes_of[a] + model.bytes_of[b]) == [a, b]
        assert model.stay_apart(a, b) == plain
        apart += not plain
        model.ordered = False
        assert model._apart(a, b) == plain
        model.ordered = True
    assert apart > 100


def test_both_patterns_find_the_same_words():
    with open(TOKENIZER, encoding="utf-8") as file:
        model = bpe.ByteBpe(file.read())
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    alike = [c for c in every if bpe.plain(c)]
    assert {*map(chr, range(0x1C)), *map(chr, range(0x20, 0x80)), *"äßéłж日م\x85\u3000"} <= set(alike) and not bpe.plain("½")
    rng = random.Random(7)
    for _ in range(300):
        text = "".join(rng.choice(rng.choice([alike, "ab1 '_s\n\t\u2003", every])) for _ in range(200))
        assert model.words(text) == bpe.WORDS.findall(text)
        assert bpe.PLAIN_WORDS.findall(p := "".join(c for c in text if bpe.plain(c))) == bpe.WORDS.findall(p)


def test_frequent_words_are_encoded_once(monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_WORDS", 20)
    with open(TOKENIZER, encoding="utf-8") as file:
        model = bpe.ByteBpe(file.read())
    met, walk = [], model.encode_words
    monkeypatch.setattr(model, "encode_words", lambda words: walk(met.append(w) or w for w in words))
    for k in range(40):
        text = "often " + " ".join(f"rare{k}x{i}" for i in range(10))
        assert model.decode(model.encode([text])[0]) == text
        assert len(model.table) + len(model.old) < 150
    assert met.count("often") == 1
