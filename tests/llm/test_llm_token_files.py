"""Token files against the tokenizers library and against each other."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from swapbook.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
TABLES = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def expected(library, rows):
    """(doc_id, start, n_tokens, crc) of rows in order."""
    found, start = [], 0
    for i, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        found.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return found


def stored(spark, df, folder, **options):
    token_files.write(df, f"{folder}/out", PATH, **options)
    return [tuple(r) for r in token_files.read(spark, f"{folder}/out").orderBy("start").collect()]


def test_whole_table(spark, library, folder):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert stored(spark, docs, folder, file_tokens=50_000) == expected(library, rows)
    assert token_files.index(spark, f"{folder}/out").count() > 10


def test_odd_texts(library):
    rng = random.Random(5)
    texts = [
        "", " ", "  ", "\n", " \n", "\n ", "a ", " a", "a  b", "a \n b", "a\n\nb", "a\n\n b", "\t\tx", "a<|endoftext|> b", " <|endoftext|>", "a  <|endoftext|>\n\n<|endoftext|> b",
        "one\ntwo three\n four\n\nfive\n\n six\n", "\nx", "\n\nx", "\n\n\nx", "x\n\n\n", " x\ny",
        "don't we'll I'M 'S", " \x1c x", "a\x1d b", "\x1f", "a\x85b", "a\xa0 b", "a \xa0b", "a　　b", "日本語 テキスト", "🙂👩‍👩‍👧 é é",
        "\x00\x01\x7f​ x", "١٢٣ ½ ²", "aaaa" * 3000, "word " * 5000, "x" * 100 + " " + "y" * 100, "a" * 60 + "\n" + "b" * 60,
    ]
    pool = [chr(c) for c in [*range(1, 0x250), *range(0x3040, 0x3080), 0x1F600, 0x2028, 0x1680, 0x200B]]
    for alphabet, n in ((pool, 300), (" \n\t\xa0ab'1.\x1c", 3000)):
        texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40))) for _ in range(n)]
    with open(PATH, encoding="utf-8") as file:
        encoder = token_files.Encoder(file.read())
    found = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
    for text, ids in zip(texts, found):
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_table_is_bounded(library, monkeypatch):
    monkeypatch.setattr(token_files, "TABLE", 50)
    with open(PATH, encoding="utf-8") as file:
        encoder = token_files.Encoder(file.read())
    texts = [f"word{i} other{i} and {'z' * (i % 80)}" for i in range(200)]
    for some in (texts[:7], texts[7:100], texts[100:]):
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(some)] == [library.encode(t, add_special_tokens=False).ids for t in some]
    assert len(encoder.young) < 600


@pytest.mark.parametrize("top", [1, 255, 256, 65_536, 1 << 24, (1 << 32) - 1])
def test_any_place_of_a_file(top):
    rng = np.random.default_rng(top)
    lists = [rng.integers(0, top, n, endpoint=True).astype("<u4") >> rng.integers(0, 32, n).astype("<u4") for n in (1, 0, 700, 5000, 3)]
    file = token_files.unpack(token_files.pack(3, 4, [5, None, -7, 1 << 40, 0], [x.tobytes() for x in lists]) + b"\n")
    flat = np.concatenate(lists)
    assert (file.part, file.no) == (3, 4) and file.ends.tolist() == np.cumsum([len(x) for x in lists]).tolist()
    assert [i if k else None for i, k in zip(file.doc_ids.tolist(), file.known)] == [5, None, -7, 1 << 40, 0]
    assert (file.all_tokens() == flat).all()
    at = rng.permutation(len(flat))
    assert (file.tokens(at) == flat[at]).all() and (file.tokens(at[:0]) == flat[:0]).all()


def test_tokens_at(spark, folder):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    token_files.write(docs, f"{folder}/out", PATH, file_tokens=30_000)
    whole = token_files.read(spark, f"{folder}/out", with_ids=True).orderBy("start").collect()
    flat = [i for r in whole for i in r.ids]
    places = spark.range(0, len(flat) + 5000, 997).withColumnRenamed("id", "position")
    places = places.unionByName(places.limit(3)).unionByName(spark.sql("select cast(null as bigint) as position"))
    found = {r.position: r.id for r in token_files.tokens_at(spark, f"{folder}/out", places).collect()}
    assert found == {p: flat[p] for p in range(0, len(flat), 997)}


def test_null_repeated_empty_clashing(spark, library, folder):
    rows = [(5, "five"), (None, "none"), (3, None), (3, "x y"), (3, "x y"), (4, ""), (-1, "w " * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"content": F.lit(1), "_tie": F.lit(2), "_any": F.lit(3), "part": F.lit(4)})
    found = stored(spark, df, folder, file_tokens=10)
    assert [r[0] for r in found] == [None, -1, 3, 3, 3, 4, 5]
    ends = [r[1] + r[2] for r in found]
    assert [r[1] for r in found] == [0, *ends[:-1]]
    assert sorted((r[0] or 0, *r[2:]) for r in found) == sorted((r[0] or 0, *r[2:]) for r in expected(library, rows))
    assert stored(spark, df.limit(0), f"{folder}/empty") == []
