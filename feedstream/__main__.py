"""Start a job on Kafka topics: spark-submit --packages <kafka connector> -m feedstream <job>.

All endpoints are arguments; checkpoints and tables belong into a folder all executors share.
"""

import argparse

from feedstream.plans import ingest, jobs
from feedstream.reference_data import INPUT_TOPIC, RESULTS_TOPIC
from feedstream.session import build_session
from feedstream.sources.kafka import message_place, publish_options, read_topic, sink_options
from feedstream.streaming.jobs import await_any
from feedstream.streaming.monitor import ProgressLog
from feedstream.streaming.sinks import batch_files, batch_kafka


def arguments(argv=None):
    parser = argparse.ArgumentParser(prog="feedstream")
    parser.add_argument("job", choices=["ingest", "analyze", "older", "view", "alerts", "series"])
    parser.add_argument("--servers", required=True, help="Kafka brokers")
    parser.add_argument("--folder", required=True, help="shared folder for checkpoints and tables")
    parser.add_argument("--input-topic", default=INPUT_TOPIC)
    parser.add_argument("--results-topic", default=RESULTS_TOPIC)
    parser.add_argument("--rss", help="folder of landed feeds (ingest)")
    parser.add_argument("--atom", help="folder of landed feeds in Atom form (ingest)")
    parser.add_argument("--items", help="folder of landed items (ingest)")
    parser.add_argument("--lists", help="folder of landed lists of ids; only items they name (ingest)")
    parser.add_argument("--max-files", type=int, help="landed files per batch (ingest)")
    parser.add_argument("--max-per-trigger", type=int, help="records per batch")
    parser.add_argument("--alert-over", type=float, help="count per window that alerts (alerts)")
    parser.add_argument("--window", default="1 minute", help="window of counts (alerts)")
    parser.add_argument("--min-partitions", type=int, help="read tasks, if more than partitions")
    return parser.parse_args(argv)


def main(argv=None):
    args = arguments(argv)
    spark = build_session(f"feedstream-{args.job}")
    checkpoint = f"{args.folder}/checkpoints/{args.job}"
    spark.streams.addListener(ProgressLog(spark, f"{args.folder}/progress"))

    def topic(name):
        return read_topic(
            spark, args.servers, name, keep=[message_place().alias(ingest.ARRIVAL)],
            max_per_trigger=args.max_per_trigger, min_partitions=args.min_partitions,
        )

    if args.job == "ingest":
        bound = {"maxFilesPerTrigger": args.max_files} if args.max_files else {}
        publish = batch_kafka(publish_options(args.servers, args.input_topic))
        if args.rss or not args.lists:
            articles = ingest.articles(
                spark, args.rss, None if args.lists else args.items, streaming=True, atom_path=args.atom, **bound)
            jobs.start_ingest(articles, f"{args.folder}/ledger", publish, checkpoint)
        if args.lists:
            listed = ingest.listed_articles(spark, args.lists, args.items, **bound)
            jobs.start_ingest(
                listed, f"{args.folder}/item_ledger", publish, f"{checkpoint}-items", name="ingest_items")
    elif args.job == "analyze":
        lines = topic(args.input_topic)
        publish = batch_kafka(sink_options(args.servers, args.results_topic))
        bad = batch_files(f"{args.folder}/bad_records")
        jobs.start_analysis(lines, publish, checkpoint, quarantine=bad)
    elif args.job == "older":
        jobs.start_older_analysis(topic(args.input_topic), checkpoint)
    elif args.job == "series":
        jobs.start_series(topic(args.results_topic), f"{args.folder}/series", checkpoint)
    elif args.job == "alerts":
        rules = [] if args.alert_over is None else [("count", ">", args.alert_over, "high")]
        jobs.start_alerts(
            topic(args.results_topic), f"{args.folder}/alerts", checkpoint, rules,
            threshold=args.alert_over, width=args.window)
    else:
        jobs.start_view(topic(args.results_topic), f"{args.folder}/view", checkpoint)
    await_any(spark)


if __name__ == "__main__":
    main()
