"""Job script for spark-submit: ``app.py revalue|store --servers HOST:PORT | --messages FOLDER ...``.

``revalue`` reads trades and ticks, re-prices the books and stores the valuations (and sends them
to the priced topics when there are Kafka servers). ``store`` reads priced trades and stores them.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from swapbook.operators.curve import DAY_COUNTS, WHOLE_YEARS
from swapbook.schemas import TOPIC_PRICED, TOPIC_RAW
from swapbook.session import build_session
from swapbook.sources import curves, files, kafka
from swapbook.streaming import jobs, metrics, sinks


# A micro-batch is sorted by bucket in one worker each, so its size is bounded even when the topics were left alone for long.
MAX_MESSAGES, MAX_FILES = 200_000, 100


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("mode", choices=("revalue", "store"))
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--messages", help="folder of JSON lines with seq and value")
    parser.add_argument("--input-dir", help="folder with ir_data/ and, if there is a seed, fx_data/")
    parser.add_argument("--fx-seed", action="store_true", help="start from the rates in fx_data/")
    parser.add_argument("--table", required=True, help="folder of the valuation table")
    parser.add_argument("--latest", help="folder of the kept latest view, if one is wanted")
    parser.add_argument("--metrics", help="folder of the counts of each micro-batch, if they are wanted")
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--buckets", type=int, default=64, help="parts of a currency's book")
    parser.add_argument("--day-count", choices=DAY_COUNTS, default=WHOLE_YEARS)
    parser.add_argument("--last-tick-only", action="store_true", help="re-price once per batch, currency and date")
    parser.add_argument("--keep-days", type=int, help="days after maturity that a trade stays in the book; all of them if not given")
    parser.add_argument("--max-per-trigger", type=int, help="messages (or files) per micro-batch; there is always a limit")
    parser.add_argument("--available-now", action="store_true", help="work off what is there, then stop")
    args = parser.parse_args(argv)
    if args.max_per_trigger is None:
        args.max_per_trigger = MAX_MESSAGES if args.servers else MAX_FILES
    if args.mode == "revalue" and args.input_dir is None:
        parser.error("revalue needs --input-dir")
    return args


def _messages(spark: SparkSession, args: argparse.Namespace, prefix: str) -> DataFrame:
    if args.servers:
        return kafka.read_messages(spark, args.servers, prefix=prefix, max_per_trigger=args.max_per_trigger)
    return files.stream_messages(spark, args.messages, args.max_per_trigger)


def start(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    """Start the queries of a mode."""
    state = args.checkpoint
    if args.mode == "store":
        raw = _messages(spark, args, TOPIC_PRICED)
        out = sinks.table_sink(args.table)
        if args.latest:
            out = sinks.both(out, sinks.latest_sink(args.latest))
        aside = sinks.append_sink(f"{args.table}_rejected")
        return [jobs.persist_query(raw, out, f"{state}/store", args.available_now, aside).start()]

    raw = _messages(spark, args, TOPIC_RAW)
    judged = curves.judged_curve(spark, curves.curve_paths(args.input_dir))
    curve = curves.accepted(judged)
    curves.rejected(judged).write.mode("overwrite").parquet(f"{args.table}_rejected_curve")
    seed = None
    if args.fx_seed:
        seed = curves.read_fx_seed(spark, f"{args.input_dir}/fx_data", stream=True)
        bad = curves.rejected(curves.judged_fx_seed(spark, f"{args.input_dir}/fx_data"))
        bad.write.mode("overwrite").parquet(f"{args.table}_rejected_seed")
    sink = sinks.table_sink(args.table, f"{args.table}_unpriced")
    if args.servers:
        sent = sinks.once(sinks.kafka_sink(args.servers), f"{args.table}_sent")
        sink = sinks.both(sink, sent)
    if args.latest:
        sink = sinks.both(sink, sinks.latest_sink(args.latest))
    revalue = jobs.revaluation_query(
        raw,
        curve,
        sink,
        f"{state}/revalue",
        args.available_now,
        seed=seed,
        buckets=args.buckets,
        day_count=args.day_count,
        last_tick_only=args.last_tick_only,
        keep_days=args.keep_days,
    )
    rejected = jobs.writer(
        jobs.rejected_messages(_messages(spark, args, TOPIC_RAW)),
        sinks.append_sink(f"{args.table}_rejected"),
        f"{state}/rejected",
        "rejected",
        args.available_now,
    )
    return [revalue.start(), rejected.start()]


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session(f"swapbook-{args.mode}")
    if args.metrics:
        spark.streams.addListener(metrics.MetricsListener(spark, args.metrics))
    for query in start(spark, args):
        query.awaitTermination()


if __name__ == "__main__":
    main()
