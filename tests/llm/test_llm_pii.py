"""Surrogates: nothing real is left, forms are kept, different entities stay different."""

import re

from pyspark.sql import functions as F

from swapbook.llm import pii

TABLES = "/root/testdata/sf0.01"
ANY = re.compile(r"[\w.%+-]+@[\w.-]+\.[A-Za-z]{2,}")


def replaced(spark, texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in pii.replace_entities(df, key).orderBy("doc_id").collect()]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed([int(x) for x in digits])):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def test_forms(spark):
    texts = [
        "write to Jane.Doe99@mail-host.example.org now", "call +44 20 7946 0958 today", "card 4111 1111 1111 1111 ok",
        "at 192.168.10.254.", "password=Abc123xyz!", "Mrs Anna Smith and Mr. Smith", "Госпожа Мария Иванова", None, "", "nothing 12 here",
    ]
    found = replaced(spark, texts)
    assert re.fullmatch(r"write to [A-Z][a-z]{3}\.[A-Z][a-z]{2}\d\d@[a-z]{4}-[a-z]{4}\.[a-z]{7}\.org now", found[0])
    assert re.fullmatch(r"call \+44 \d\d \d{4} \d{4} today", found[1])
    card = re.fullmatch(r"card (\d{4} \d{4} \d{4} \d{4}) ok", found[2])[1]
    assert luhn(card.replace(" ", "")) and card != "4111 1111 1111 1111"
    assert all(0 < int(x) < 255 for x in re.fullmatch(r"at ([\d.]+)\.", found[3])[1].split("."))
    assert re.fullmatch(r"password=[A-Z][a-z]{2}\d{3}[a-z]{3}!", found[4])
    first, surname, again = re.fullmatch(r"Mrs (\w+) (\w+) and Mr\. (\w+)", found[5]).groups()
    assert first in pii.GIVEN["latin", "f"] and surname == again != "Smith"
    assert re.fullmatch(r"Госпожа [А-Яа-я]+ [А-Я][а-я]+", found[6]) and "Иванова" not in found[6]
    assert found[7:] == texts[7:]
    assert replaced(spark, texts) == found != replaced(spark, texts, key="other")


def test_distinct_and_the_same_everywhere(spark):
    # two-letter addresses are few, so candidates do collide
    names = [f"{a}{b}@{c}.de" for a in "abcdefgh" for b in "abcdefgh" for c in "xy"]
    texts = [f"{n} and {names[(i + 1) % len(names)]}" for i, n in enumerate(names)]
    found = replaced(spark, texts)
    new = {}
    for before, after in zip(texts, found):
        for a, b in zip(ANY.findall(before), ANY.findall(after)):
            assert new.setdefault(a, b) == b
    assert len(set(new.values())) == len(names) and not set(new.values()) & set(names)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    out = pii.replace_entities(docs, "k")
    assert out.columns == [*docs.columns, "n_entities"]
    before = {r.doc_id: r.text for r in docs.collect()}
    rows = out.collect()
    assert len(rows) == len(before)
    entities = {e for r in docs.select(pii.matches(F.col("text")).alias("m")).collect() for e in r.m or []}
    kinds = ("@", "=")
    for r in rows:
        if not r.n_entities:
            assert r.text == before[r.doc_id]
        elif r.text is not None:
            assert not any(e in r.text for e in re.findall(pii.PATTERNS["email"], before[r.doc_id]) if e in entities and any(k in e for k in kinds))


def test_repeated_empty_clashing(spark):
    df = spark.createDataFrame([(1, "a@b.org"), (1, "a@b.org"), (None, "x" * 500_000 + " c@d.org")], "doc_id long, text string")
    df = df.withColumns({"entity": F.lit(1), "_found": F.lit(2), "_new": F.lit(3), "_doc": F.lit(4)})
    out = pii.replace_entities(df, "k")
    assert out.columns == [*df.columns, "n_entities"]
    rows = out.collect()
    assert len(rows) == 3 and len({r.text for r in rows if r.doc_id == 1}) == 1 and all(r.n_entities == 1 for r in rows)
    assert pii.replace_entities(df.limit(0), "k").count() == 0


def test_native(spark):
    plan = pii.replace_entities(spark.read.parquet(f"{TABLES}/documents.parquet"), "k")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_no_planted_secret_survives(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    planted = re.compile(r"token = \"([A-Za-z0-9_/+-]{6,})\"")
    before = {r.doc_id: planted.findall(r.text) for r in docs.filter(F.instr("text", "token = ") > 0).collect()}
    assert sum(map(len, before.values())) > 100
    after = {r.doc_id: r.text for r in pii.replace_entities(docs.filter(F.instr("text", "token = ") > 0), "k").collect()}
    for i, values in before.items():
        assert not any(v in after[i] for v in values) and len(planted.findall(after[i])) == len(values)
    found = replaced(spark, ["pwd = 'abcdef12' api_key=\"ABCDEF-99\" tokens = many token=short"])
    assert re.fullmatch(r"pwd = '[a-z]{6}\d\d' api_key=\"[A-Z]{6}-\d\d\" tokens = many token=short", found[0])
    assert "abcdef12" not in found[0] and "ABCDEF-99" not in found[0]


def test_long_runs(spark):
    """Linear in the text: runs of letters, marks and digits without an address."""
    runs = ["x" * 300_000, "a." * 150_000, "1" * 300_000, "a-b_" * 75_000, "Aa" * 150_000, "x" * 200_000 + "@", "1.2." * 75_000]
    assert replaced(spark, runs) == runs


def test_names_stay_apart(spark):
    """More given names than the list of surrogates, and more surnames than two letters allow without twins."""
    given = [f"{a}{b}rt" for a in "ABCD" for b in "aeiou"]
    surnames = [f"{a}{b}" for a in "ABCDEFGHIJ" for b in "abcdefghij"]
    texts = [f"Mr {g} Smith" for g in given] + [f"Mr. {s}" for s in surnames]
    found = replaced(spark, texts)
    assert len(set(found)) == len(texts) and not set(found) & set(texts)
    assert len({t.split()[-1] for t in found[: len(given)]}) == 1
    assert all(re.fullmatch(r"Mr [A-Z][a-z]+ [A-Z][a-z]{4}", t) for t in found[: len(given)])
    assert all(re.fullmatch(r"Mr\. [A-Z][a-z]+", t) for t in found[len(given) :])


def test_no_free_value_left(spark):
    """All addresses of the shortest form are there: a surrogate gets longer, none is one of them."""
    texts = [f"{a}@{b}.de" for a in range(10) for b in range(10)]
    found = replaced(spark, texts)
    assert len(set(found)) == len(texts) and not set(found) & set(texts) and all(ANY.fullmatch(t) for t in found)
