"""Command line: batch profile, stream ingest, and replay into a topic.

    spark-submit ... -m clientele profile --users ... --output ... --sample 0.1
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from clientele.plans.profile import RawPaths, publish_profile, run_batch
from clientele.session import SETTINGS
from clientele.sources.files import read_json, read_lexicon
from clientele.sources.topics import publish
from clientele.streaming.ingest import TOPICS, kafka_messages, run_ingest

INPUTS = ("users", "business", "reviews", "tips", "checkins")


def session() -> SparkSession:
    builder = SparkSession.builder.appName("clientele")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="clientele")
    commands = top.add_subparsers(dest="command", required=True)

    profile = commands.add_parser("profile", help="sample, clean, enrich and merge JSON inputs")
    for name in INPUTS:
        profile.add_argument(f"--{name}", required=True, help=f"JSON lines of {name}")
    profile.add_argument("--output", required=True)
    profile.add_argument("--lexicon", required=True, help="tab-separated word and valence")
    profile.add_argument("--sample", type=float, default=1.0)
    profile.add_argument("--mode", choices=("hash", "bernoulli", "top"), default="hash")
    profile.add_argument("--how", choices=("inner", "left"), default="inner")
    profile.add_argument("--streamed", help="output of an ingest, to be taken in")
    profile.add_argument("--empty-friends", nargs="*", default=(), help="placeholders that stand for no friends")
    profile.add_argument("--tasks", type=int, help="deal the reviews out to so many tasks")
    profile.add_argument("--table", help="also publish the profile under this name")

    ingest = commands.add_parser("ingest", help="stream check-ins, tips and reviews")
    ingest.add_argument("--servers", required=True)
    ingest.add_argument("--output", required=True)
    ingest.add_argument("--lexicon", required=True)
    ingest.add_argument("--user-ids", help="Parquet folder of sampled user ids")
    ingest.add_argument("--tasks", type=int, help="deal each batch of reviews out to so many tasks")
    ingest.add_argument("--seconds", type=float, help="stop after this time")

    replay = commands.add_parser("replay", help="send a JSON file to a topic")
    replay.add_argument("--servers", required=True)
    replay.add_argument("--topic", choices=tuple(TOPICS), required=True)
    replay.add_argument("--file", required=True)
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = session()
    if args.command == "profile":
        paths = RawPaths(**{name: getattr(args, name) for name in INPUTS})
        lexicon = read_lexicon(spark, args.lexicon)
        counts: dict[str, int] = {}
        profile = run_batch(
            spark, paths, args.output, lexicon, args.sample, args.mode, args.how, args.streamed,
            tuple(args.empty_friends), args.tasks, counts,
        )
        for name, rows in counts.items():
            print(f"{name}: {rows} rows")
        if args.table:
            publish_profile(profile, args.table)
    elif args.command == "ingest":
        ids = spark.read.parquet(args.user_ids) if args.user_ids else None
        started = run_ingest(
            kafka_messages(spark, args.servers), args.output, read_lexicon(spark, args.lexicon), ids,
            tasks=args.tasks,
        )
        if args.seconds is None:
            spark.streams.awaitAnyTermination()
        else:
            spark.streams.awaitAnyTermination(timeout=args.seconds)
        for query in started:
            query.stop()
    else:
        publish(read_json(spark, args.file, TOPICS[args.topic]), args.servers, args.topic)


if __name__ == "__main__":
    main()
