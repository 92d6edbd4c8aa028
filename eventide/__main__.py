"""Command line: the source system's services as Spark jobs.

    python -m eventide ingest     --capture DIR --topic-dir DIR --dlq-dir DIR [--once]
    python -m eventide store      --topic-dir DIR --events DIR --dlq-dir DIR [--once] [--max-files N]
    python -m eventide windows    --topic-dir DIR --out DIR [--once] [--max-files N]
    python -m eventide replay     --events DIR --from YYYY-MM-DD --to YYYY-MM-DD [--dry-run] --topic-dir DIR
    python -m eventide dlq-replay --dlq-dir DIR [--replay] [--dry-run] --out DIR
    python -m eventide amplify    --seed FILE_OR_DIR --n N --out DIR [--rate R] [--start-ts S]
    python -m eventide features   --events DIR --out DIR

Every command takes ``--bootstrap-servers`` to use Kafka instead of topic
directories when the connector is installed, and ``--master`` for local runs.
Streaming commands run until stopped, or process what is there and stop
with ``--once``.  No command opens a port.
"""

from __future__ import annotations

import argparse
import json
import sys


def _session(args):
    from eventide.session import get_session
    return get_session(args.master, shuffle_partitions=args.shuffle_partitions)


def _trigger(args):
    return {"availableNow": True} if args.once else None


def cmd_ingest(args):
    from eventide.plans import jobs
    spark = _session(args)
    q = jobs.start_ingest(spark, args.capture, args.topic_dir, args.dlq_dir, checkpoint=args.checkpoint,
                          trigger=_trigger(args), bootstrap_servers=args.bootstrap_servers,
                          line_sep="\r\n\r\n" if args.crlf else "\n\n")
    q.awaitTermination()


def cmd_store(args):
    from eventide.plans import jobs
    from eventide.sources.wire import registry_frame
    from eventide.streaming.sources import read_topic
    spark = _session(args)
    stream = read_topic(spark, jobs.TOPIC, path=args.topic_dir, bootstrap_servers=args.bootstrap_servers,
                        starting_offsets="latest", max_files_per_trigger=args.max_files,
                        max_offsets_per_trigger=args.max_offsets)
    q = jobs.start_store(spark, stream, args.events, args.dlq_dir, registry_frame(spark),
                         checkpoint=args.checkpoint, trigger=_trigger(args),
                         bootstrap_servers=args.bootstrap_servers, max_records_per_file=args.max_records_per_file,
                         max_bytes_per_file=args.max_bytes_per_file)
    q.awaitTermination()


def cmd_windows(args):
    from eventide.plans import jobs
    from eventide.streaming.sources import payloads_from_topic, read_topic
    spark = _session(args)
    stream = read_topic(spark, jobs.TOPIC, path=args.topic_dir, bootstrap_servers=args.bootstrap_servers,
                        starting_offsets="earliest", max_files_per_trigger=args.max_files,
                        max_offsets_per_trigger=args.max_offsets)
    q = jobs.start_windows(spark, payloads_from_topic(stream), args.out, checkpoint=args.checkpoint,
                           trigger=_trigger(args), bootstrap_servers=args.bootstrap_servers)
    q.awaitTermination()


def cmd_replay(args):
    from eventide.plans import jobs
    spark = _session(args)
    if args.events_per_second and not args.dry_run:
        jobs.start_replay_paced(spark, args.events, args.topic_dir, args.date_from, args.date_to, args.events_per_second,
                                checkpoint=args.checkpoint, bootstrap_servers=args.bootstrap_servers).await_end()
        return
    t = jobs.replay(spark, args.events, args.date_from, args.date_to, topic_dir=args.topic_dir,
                    dry_run=args.dry_run, bootstrap_servers=args.bootstrap_servers).first()
    print(json.dumps({"files": t.files, "events": t.events, "dry_run": args.dry_run}))


def cmd_dlq_replay(args):
    from pyspark.sql import functions as F

    from eventide.operators.reliability import dlq_inspect, dlq_replay
    from eventide.sinks.wire import publish
    spark = _session(args)
    dlq = spark.read.parquet(args.dlq_dir)
    summary = dlq_inspect(dlq).groupBy("original_topic", "error_type").count()
    for r in summary.toLocalIterator():      # topics are free header values: a partition at a time
        print(json.dumps(r.asDict()))
    if args.replay:
        out = dlq_replay(dlq, dry_run=args.dry_run)
        if args.dry_run:
            print(json.dumps({"would_replay": out.first()[0]}))
        else:
            publish(out.select("key", "value", F.col("topic")), None, path=args.out,
                    bootstrap_servers=args.bootstrap_servers)


def cmd_amplify(args):
    from eventide.operators.generate import amplify
    from eventide.schema import CHANGE_EVENT_V1, align_schema
    from eventide.sinks.parquet import write_events
    spark = _session(args)
    seed = align_schema(spark.read.schema(CHANGE_EVENT_V1).json(args.seed), CHANGE_EVENT_V1)
    events = amplify(seed, args.n, start_ts=args.start_ts, rate=args.rate)
    write_events(events, args.out)


def cmd_features(args):
    from eventide.operators.features import edit_stats
    from eventide.sources.replay import read_events
    spark = _session(args)
    edit_stats(read_events(spark, args.events)).write.mode("overwrite").parquet(args.out)


def _limits(parser):
    parser.add_argument("--max-files", type=int, default=None, help="files a trigger, from a topic directory")
    parser.add_argument("--max-offsets", type=int, default=None, help="messages a trigger, from a broker")


def main(argv=None):
    p = argparse.ArgumentParser(prog="eventide")
    p.add_argument("--master", default=None)
    p.add_argument("--shuffle-partitions", type=int, default=200)
    p.add_argument("--bootstrap-servers", default=None)
    p.add_argument("--checkpoint", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("ingest")
    s.add_argument("--capture", required=True)
    s.add_argument("--topic-dir")
    s.add_argument("--dlq-dir")
    s.add_argument("--crlf", action="store_true", help="captures use CRLF line ends")
    s.add_argument("--once", action="store_true")
    s.set_defaults(fn=cmd_ingest)

    s = sub.add_parser("store")
    s.add_argument("--topic-dir")
    s.add_argument("--events", required=True)
    s.add_argument("--dlq-dir")
    _limits(s)
    s.add_argument("--max-records-per-file", type=int, default=None)
    s.add_argument("--max-bytes-per-file", type=int, default=None, help="estimated bytes of a file's rows at most")
    s.add_argument("--once", action="store_true")
    s.set_defaults(fn=cmd_store)

    s = sub.add_parser("windows")
    s.add_argument("--topic-dir")
    s.add_argument("--out")
    _limits(s)
    s.add_argument("--once", action="store_true")
    s.set_defaults(fn=cmd_windows)

    s = sub.add_parser("replay")
    s.add_argument("--events", required=True)
    s.add_argument("--from", dest="date_from", required=True)
    s.add_argument("--to", dest="date_to", required=True)
    s.add_argument("--topic-dir")
    s.add_argument("--dry-run", action="store_true")
    s.add_argument("--events-per-second", type=float, default=None, help="pace of the replay; default: none")
    s.set_defaults(fn=cmd_replay)

    s = sub.add_parser("dlq-replay")
    s.add_argument("--dlq-dir", required=True)
    s.add_argument("--replay", action="store_true")
    s.add_argument("--dry-run", action="store_true")
    s.add_argument("--out")
    s.set_defaults(fn=cmd_dlq_replay)

    s = sub.add_parser("amplify")
    s.add_argument("--seed", required=True)
    s.add_argument("--n", type=int, required=True)
    s.add_argument("--rate", type=int, default=1000)
    s.add_argument("--start-ts", type=int, default=1704067200)
    s.add_argument("--out", required=True)
    s.set_defaults(fn=cmd_amplify)

    s = sub.add_parser("features")
    s.add_argument("--events", required=True)
    s.add_argument("--out", required=True)
    s.set_defaults(fn=cmd_features)

    args = p.parse_args(argv)
    args.fn(args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
