"""Job entry points (``spark-submit -m``-style or ``python -m ratinglens.cli``).

    build   --players P --ratings R --dst D [--raw-names] [--buckets N]   text → views
    tables  --sf-dir S --dst D [--buckets N] [--build-id B]              tables → views
    speed   --brokers B --topic T --views V [--checkpoint C] [--option K=V]   Kafka → speed views
    files   --source F --views V [--checkpoint C] [--once]                   message files → speed views
    maintain --views V [--every N] [--grace S]                           snapshot and removal, once

A speed view belongs to one checkpoint, by default ``<views>-checkpoint``. The
speed jobs end after the running batch on SIGTERM, SIGINT, or once
``--stop-file`` exists; started again, they go on behind it. ``build`` writes
the lines that do not fit the schema, with the reason, below ``rejects/``.
Scratch folders are below the shared ``spark.checkpoint.dir``. For a cluster
run, ``--input-gb`` and ``--cores`` before the command size the partitions.
"""

from __future__ import annotations

import argparse
import json
import signal

from ratinglens.plans.build import build_views, publish_build
from ratinglens.schemas import PLAYERS, RATINGS
from ratinglens.session import build_session, scale_conf, scratch_dir
from ratinglens.sources import delimited, store, tables
from ratinglens.streaming import speed
from ratinglens.streaming.control import stop_on, supervise

SIGNALS = (signal.SIGTERM, signal.SIGINT)


def default_checkpoint(views: str) -> str:
    return views.rstrip("/") + "-checkpoint"


def stream_options(p: argparse.ArgumentParser) -> None:
    p.add_argument("--compact-every", type=int, default=500, help="snapshot every N micro-batches")
    p.add_argument("--mode", choices=["permissive", "strict", "failfast"], default="permissive")
    p.add_argument("--stop-file", help="end after the running batch once this path exists")


def audited(spark, path: str, schema, dst: str) -> None:
    delimited.write_table(delimited.audit_delimited(spark, path, schema), dst)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="ratinglens")
    ap.add_argument("--input-gb", type=float, help="size of the input, for the partition sizes")
    ap.add_argument("--cores", type=int, default=8, help="cores of the cluster, for the partition sizes")
    sub = ap.add_subparsers(dest="cmd", required=True)

    b = sub.add_parser("build")
    b.add_argument("--players", required=True)
    b.add_argument("--ratings", required=True)
    b.add_argument("--dst", required=True)
    b.add_argument("--raw-names", action="store_true", help="players file has one quoted 'Last, First' field")
    b.add_argument("--buckets", type=int, help="also register player-keyed views as tables bucketed on fide_id")
    b.add_argument("--table-prefix", default="")

    t = sub.add_parser("tables")
    t.add_argument("--sf-dir", required=True)
    t.add_argument("--dst")
    t.add_argument("--buckets", type=int)
    t.add_argument("--build-id", type=int, help="write into a new build folder and publish it")
    t.add_argument("--table-prefix", default="")

    s = sub.add_parser("speed")
    s.add_argument("--brokers", required=True)
    s.add_argument("--topic", required=True)
    s.add_argument("--views", required=True)
    s.add_argument("--checkpoint")
    s.add_argument("--starting-offsets", default="latest")
    s.add_argument("--single-partition", action="store_true", help="order by offset alone")
    s.add_argument(
        "--option", action="append", default=[], metavar="K=V", help="topic option, e.g. kafka.group.id=g"
    )
    s.add_argument("--trigger", default="2 seconds", help="micro-batch interval")
    stream_options(s)

    f = sub.add_parser("files")
    f.add_argument("--source", required=True)
    f.add_argument("--views", required=True)
    f.add_argument("--checkpoint")
    f.add_argument("--once", action="store_true", help="process what is there, then stop")
    f.add_argument("--trigger", default="2 seconds", help="micro-batch interval")
    f.add_argument("--max-files", type=int, help="files of a backlog in a micro-batch")
    f.add_argument("--max-bytes", type=int, help="bytes of a backlog in a micro-batch (at least a file)")
    stream_options(f)

    m = sub.add_parser("maintain")
    m.add_argument("--views", required=True)
    m.add_argument("--every", type=int, default=1, help="snapshot if so many deltas are due")
    m.add_argument("--grace", type=float, default=store.GRACE_S, help="seconds a superseded version is kept")

    args = ap.parse_args(argv)
    extra = scale_conf(int(args.input_gb * 2**30), args.cores) if args.input_gb else None
    spark = build_session(extra=extra)

    if args.cmd == "build":
        players = (
            delimited.normalise_players(delimited.read_players_raw(spark, args.players))
            if args.raw_names
            else delimited.read_players(spark, args.players)
        )
        ratings = delimited.read_ratings(spark, args.ratings)
        rejects = args.dst.rstrip("/") + "/rejects"
        audited(spark, args.ratings, RATINGS, f"{rejects}/ratings_lines")
        if not args.raw_names:
            audited(spark, args.players, PLAYERS, f"{rejects}/players_lines")
        print(json.dumps(build_views(spark, players, ratings, args.dst, args.buckets, args.table_prefix)))
    elif args.cmd == "tables":
        dst = args.dst or scratch_dir(spark, "views")
        players = tables.players_from_tables(spark, args.sf_dir)
        ratings = tables.ratings_from_tables(spark, args.sf_dir)
        if args.build_id is not None:
            paths = publish_build(spark, players, ratings, dst, args.build_id, args.buckets, args.table_prefix, True)
        else:
            paths = build_views(spark, players, ratings, dst, args.buckets, args.table_prefix, True)
        print(json.dumps(paths))
    elif args.cmd == "speed":
        speed.run_speed_layer(
            spark,
            args.brokers,
            args.topic,
            args.views,
            args.checkpoint or default_checkpoint(args.views),
            args.starting_offsets,
            args.trigger,
            args.compact_every,
            order_cols=("seq",) if args.single_partition else ("ts", "part", "seq"),
            options=dict(o.split("=", 1) for o in args.option),
            mode=args.mode,
            should_stop=stop_on(spark, args.stop_file, SIGNALS),
        )
    elif args.cmd == "files":
        q = speed.start_speed_layer(
            speed.read_message_files(
                spark, args.source, args.max_files, max_bytes_per_trigger=args.max_bytes
            ),
            args.views,
            args.checkpoint or default_checkpoint(args.views),
            processing_time=args.trigger,
            available_now=args.once,
            rejects_root=args.views.rstrip("/") + "-rejects",
            compact_every=args.compact_every,
            mode=args.mode,
        )
        supervise(q, None if args.once else stop_on(spark, args.stop_file, SIGNALS))
    elif args.cmd == "maintain":
        print(json.dumps(store.maintain_view(spark, args.views, ["fide_id"], args.every, args.grace)))


if __name__ == "__main__":
    main()
