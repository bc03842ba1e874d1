"""The stored valuation table and the kept latest view."""

import datetime as dt
import os
import random

import data
import pytest
from pyspark.sql import functions as F

from swapbook.operators import portfolio
from swapbook.operators.revalue import revalue_on_tick
from swapbook.plans import inputs, registry
from swapbook.schemas import VALUATION, VALUATION_KEY
from swapbook.sources import commits, latest_view, valuation_table
from swapbook.streaming import sinks

DAY = dt.datetime(2024, 1, 1)


def valuations(spark, seed, n=200, days=4):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        number = rng.randint(0, 40)
        trade = data.trade(random.Random(number), number)
        when = DAY + dt.timedelta(rng.randint(0, days - 1), rng.randint(0, 86_399), rng.randint(0, 999_999))
        rows.append((*[trade[f.name] for f in VALUATION[:13]], when, rng.random() * 1e6, "swap_stream"))
    return spark.createDataFrame(rows, VALUATION)


def as_rows(df):
    return sorted(map(tuple, df.select(*VALUATION.fieldNames()).collect()), key=repr)


def test_runs_and_batches_are_kept_apart(spark, folder):
    a, b, c = (valuations(spark, seed) for seed in (1, 2, 3))
    for rows, run, batch in ((a, "one", 0), (b, "one", 1), (a, "one", 0), (c, "two", 0), (b, "one", 0)):
        valuation_table.append(rows, folder, run, batch)
    table = valuation_table.read(spark, folder)
    assert as_rows(table) == sorted(as_rows(a) + as_rows(b) + as_rows(c), key=repr)
    assert {tuple(r) for r in table.groupBy("run_id", "batch_id").count().collect()} == {("one", 0, 200), ("one", 1, 200), ("two", 0, 200)}


def test_uncommitted_rows_are_not_there_and_are_replaced(spark, folder):
    a, b = valuations(spark, 4), valuations(spark, 5, n=50)
    valuation_table.append(a, folder, "one", 0)
    # a batch that died before its commit
    valuation_table._write(b.withColumn("valuation_day", F.to_date("valuationdate")), folder, "one", 1)
    assert as_rows(valuation_table.read(spark, folder)) == as_rows(a)
    valuation_table.append(b, folder, "one", 1)
    assert as_rows(valuation_table.read(spark, folder)) == sorted(as_rows(a) + as_rows(b), key=repr)
    assert sum(r.rows for r in valuation_table.batches(spark, folder).collect()) == 250


def test_compacted_day(spark, folder):
    parts = [valuations(spark, 10 + i) for i in range(3)]
    for i, rows in enumerate(parts):
        valuation_table.append(rows, folder, "one", i)
    before = as_rows(valuation_table.read(spark, folder))
    valuation_table.compact(spark, folder, "2024-01-02")
    late = valuations(spark, 20)
    valuation_table.append(late, folder, "one", 3)
    after = sorted(before + as_rows(late), key=repr)
    assert as_rows(valuation_table.read(spark, folder)) == after
    assert valuation_table.vacuum(spark, folder) == 3 and valuation_table.vacuum(spark, folder) == 0
    day = valuation_table.read(spark, folder).filter("valuation_day = date'2024-01-02'")
    assert day.select("run_id", "batch_id").distinct().count() == 2 and len(os.listdir(f"{folder}/rows/valuation_day=2024-01-02")) == 2
    valuation_table.compact(spark, folder, "2024-01-02")  # what was compacted, once more
    valuation_table.vacuum(spark, folder)
    assert as_rows(valuation_table.read(spark, folder)) == after
    valuation_table.compact(spark, folder, "1999-01-01")


def test_lookups_are_pruned(spark, folder):
    valuation_table.append(valuations(spark, 6), folder, "one", 0)
    rows = portfolio.org_valuations(valuation_table.read(spark, folder).filter("valuation_day = date'2024-01-01'"), "org1")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(valuation_day" in plan and "EqualTo(organization,org1)" in plan
    history = portfolio.swap_history(valuation_table.read(spark, folder), "SWAP1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,SWAP1)" in history


def test_empty_table_and_view(spark, folder):
    assert valuation_table.read(spark, f"{folder}/none").count() == 0
    assert latest_view.read(spark, f"{folder}/none").count() == 0
    valuation_table.append(valuations(spark, 1).limit(0), f"{folder}/t", "one", 0)
    assert valuation_table.read(spark, f"{folder}/t").count() == 0 and valuation_table.batches(spark, f"{folder}/t").count() == 1


@pytest.mark.parametrize("most", [1, 2, 100])
def test_view_equals_history(spark, folder, monkeypatch, most):
    monkeypatch.setattr(latest_view, "MOST_DELTAS", most)
    history = None
    for batch in range(5):
        rows = valuations(spark, 30 + batch, n=80)
        latest_view.add(rows, folder, "one", batch)
        latest_view.add(rows, folder, "one", batch)
        history = rows if history is None else history.unionByName(rows)
        want = portfolio.latest_valuation(history).select(*VALUATION_KEY, "swapvalue", "valuationdate")
        got = latest_view.read(spark, folder)
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    one = latest_view.read(spark, folder, "org3")
    assert as_rows(one) == as_rows(latest_view.read(spark, folder).filter("organization = 'org3'")) and one.count()
    assert "bucket" in one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1][:60]


def test_view_reads_no_merged_deltas(spark, folder):
    for batch in range(4):
        latest_view.add(valuations(spark, batch, n=30), folder, "one", batch)
    latest_view.compact(spark, folder)
    assert latest_view._state(spark, folder)[1] == ["bases/0"]
    latest_view.add(valuations(spark, 9, n=30), folder, "one", 4)
    latest_view.compact(spark, folder)
    assert latest_view._state(spark, folder)[1:] == (["bases/1"], [])
    assert sorted(os.listdir(f"{folder}/deltas")) == ["one.4"]


def test_nested_sinks_compute_a_batch_once(spark, folder):
    """A table with a quarantine beside another sink: the rows are made once."""
    made = spark.sparkContext.accumulator(0)

    def counting(rows):
        for part in rows:
            made.add(len(part))
            yield part

    rows = valuations(spark, 7).withColumn("price_status", F.when(F.col("swapvalue") > 5e5, "ok").otherwise("missing_fx"))
    seen = []
    sink = sinks.both(
        sinks.table_sink(f"{folder}/t", f"{folder}/q"), lambda b, i: seen.append(b.count()), sinks.once(lambda b, i: seen.append(b.count()), f"{folder}/sent")
    )
    batch = rows.mapInPandas(counting, rows.schema)
    sink(batch, 0)
    assert seen == [200, 200] and made.value == 200
    assert not batch.is_cached
    sink(batch, 0)
    assert seen == [200, 200, 200]
    assert valuation_table.read(spark, f"{folder}/t").count() + spark.read.parquet(f"{folder}/q").count() == 200


def test_a_new_checkpoint_is_another_run(spark, folder):
    valuations(spark, 8).write.parquet(f"{folder}/in")
    for checkpoint in ("a", "a", "b"):
        stream = spark.readStream.schema(VALUATION).parquet(f"{folder}/in")
        out = sinks.both(sinks.table_sink(f"{folder}/t"), sinks.latest_sink(f"{folder}/v"))
        query = stream.writeStream.foreachBatch(out).option("checkpointLocation", f"{folder}/{checkpoint}").trigger(availableNow=True).start()
        query.awaitTermination(120)
    table = valuation_table.read(spark, f"{folder}/t")
    assert {r["count"] for r in table.groupBy("run_id").count().collect()} == {200} and table.count() == 400
    assert latest_view.read(spark, f"{folder}/v").count() == table.select(*VALUATION_KEY).distinct().count()


def test_commits(spark, folder):
    place = f"{folder}/commits/x.json"
    assert not commits.exists(spark, place)
    commits.put(spark, place, {"a": 1})
    commits.put(spark, place, {"a": 2})
    assert [r.a for r in spark.read.json(f"{folder}/commits").collect()] == [2] and os.listdir(f"{folder}/commits").count("x.json") == 1
    state = commits.fingerprint(spark, [folder])
    assert state == commits.fingerprint(spark, [folder])
    commits.put(spark, f"{folder}/more.json", {})
    assert state != commits.fingerprint(spark, [folder])


def test_rows_are_written_by_the_tasks_that_have_them(spark, folder):
    rows = valuations(spark, 11).repartition(3, "id")
    valuation_table.append(rows, folder, "one", 0, moved=False)
    assert as_rows(valuation_table.read(spark, folder)) == as_rows(rows)
    parts = spark.read.parquet(f"{folder}/rows").withColumn("_file", F.input_file_name())
    # a trade is in one file of a day, and a day has one file per task: nothing was moved
    assert parts.groupBy("valuation_day", "id").agg(F.countDistinct("_file").alias("n")).filter("n > 1").isEmpty()
    assert {r.n for r in parts.groupBy("valuation_day").agg(F.countDistinct("_file").alias("n")).collect()} == {3}


def test_history_is_written_in_parts_of_the_book(spark, folder, monkeypatch):
    """A large load is stored part by part, each in the order of organizations and ids, with the rows of the whole."""
    for name in ("orders", "lineitem", "events"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    monkeypatch.setattr(registry, "MESSAGES_PER_PART", 2500)
    path = registry._store(spark, folder)
    assert sorted(r.batch_id for r in valuation_table.batches(spark, path).collect()) == [0, 1, 2]
    history = valuation_table.read(spark, path)
    assert history.groupBy("id").agg(F.countDistinct("batch_id").alias("n")).filter("n > 1").isEmpty()
    whole = revalue_on_tick(inputs.trade_messages(spark, folder), inputs.ticks(spark, folder), inputs.curve(spark, folder))
    names = ("organization", "id", "payccy", "receiveccy", "valuationdate", "swapvalue")
    want = whole.filter("price_status = 'ok'").select(*names)
    assert want.exceptAll(history.select(*names)).isEmpty() and want.count() == history.count() > 1000
    files = [os.path.join(place, name) for place, _, found in os.walk(f"{path}/rows") for name in found if name.endswith(".parquet")]
    for file in files[:20]:
        rows = [(r.organization, r.id) for r in spark.read.parquet(file).select("organization", "id").collect()]
        assert rows == sorted(rows)
    assert registry._store(spark, folder) == path and len(files) > 30
