"""Command line: the batch ETL, the event-time stream and the raw landing.

    python -m vitrine etl    --input PATH --silver PATH --warehouse-dir PATH [--database DB] [--dt D | --daily]
    python -m vitrine stream --source DIR --root DIR [--tail] [--once] [--tolerance-ms N] [--window-ms N]
                             [--slide-ms N] [--threshold N]
    python -m vitrine land   --source DIR --landing DIR --checkpoint DIR [--tail] [--once]

Like the original scripts, ``etl`` also reads ``HDFS_INPUT_PATH`` and
``TARGET_DATE`` from the environment when the flags are absent.  Paths may be
any scheme the cluster's Hadoop configuration supports.
"""

from __future__ import annotations

import argparse
import os
import sys

from vitrine import constants as C


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="vitrine")
    sub = p.add_subparsers(dest="command", required=True)

    etl = sub.add_parser("etl", help="raw JSON lines -> silver -> warehouse tables")
    etl.add_argument("--input", default=os.environ.get("HDFS_INPUT_PATH"))
    etl.add_argument("--silver", required=True)
    etl.add_argument("--warehouse-dir", required=True)
    etl.add_argument("--database", default="ecommerce_dw")
    etl.add_argument("--dt", default=os.environ.get("TARGET_DATE"))
    etl.add_argument("--daily", action="store_true", help="group by UTC event date instead of --dt")

    st = sub.add_parser("stream", help="exact event-time stream: late filter, windows, alerts")
    st.add_argument("--source", required=True)
    st.add_argument("--root", required=True, help="output and checkpoint folder")
    st.add_argument("--tail", action="store_true", help="--source names files that are still written")
    st.add_argument("--once", "--exit-on-eof", action="store_true", dest="once")
    st.add_argument("--tolerance-ms", type=int, default=C.MAX_ALLOWED_DELAY_MS)
    st.add_argument("--window-ms", type=int, default=C.WINDOW_SIZE_MS)
    st.add_argument("--slide-ms", type=int, default=C.WINDOW_SLIDE_MS)
    st.add_argument("--threshold", type=int, default=C.HOT_PRODUCT_THRESHOLD)
    st.add_argument("--wait-seconds", type=float, default=3600.0)

    ld = sub.add_parser("land", help="raw landing zone by ingestion date")
    ld.add_argument("--source", required=True)
    ld.add_argument("--landing", required=True)
    ld.add_argument("--checkpoint", required=True)
    ld.add_argument("--once", action="store_true")
    ld.add_argument("--tail", action="store_true", help="--source names files that are still written")
    ld.add_argument("--max-records-per-file", type=int, default=C.LANDING_ROLL_RECORDS)
    ld.add_argument("--roll-bytes", type=int, help="roll files by bytes and commit them by manifest")
    return p


def main(argv: list[str] | None = None, spark=None):
    args = _parser().parse_args(argv)
    from vitrine.session import build_session, ensure_session_settings
    spark = spark or build_session(master=os.environ.get("VITRINE_MASTER"))
    ensure_session_settings(spark)

    if args.command == "etl":
        from vitrine.plans.batch_etl import run_daily_etl
        from vitrine.sinks.warehouse import Warehouse
        if not args.input:
            raise SystemExit("etl: --input or HDFS_INPUT_PATH is required")
        wh = Warehouse(spark, args.database, args.warehouse_dir).create()
        return run_daily_etl(spark, args.input, args.silver, wh, dt=args.dt, daily=args.daily)

    if args.command == "stream":
        from vitrine.streaming.event_time import EventTimeJob
        job = EventTimeJob(spark, args.root, args.tolerance_ms, args.window_ms, args.slide_ms, args.threshold)
        lines = _lines(spark, args, args.wait_seconds)
        if args.once:
            _await(job.start_accept(lines, once=True))
            _await(job.start_windows(once=True))
            job.flush()
        else:
            accept, windows = job.start_accept(lines, once=False), job.start_windows(once=False)
            spark.streams.awaitAnyTermination()
            for q in (accept, windows):
                if q.exception() is not None:
                    raise RuntimeError(str(q.exception()))
        return job

    if args.command == "land":
        if args.roll_bytes:
            from vitrine.sinks.rolled import start_rolled
            q = start_rolled(spark, _lines(spark, args), args.landing, args.checkpoint, args.roll_bytes, once=args.once)
            _await(q)
            return q
        from vitrine.streaming.landing import start_landing
        q = start_landing(_lines(spark, args), args.landing, args.checkpoint,
                          once=args.once, max_records_per_file=args.max_records_per_file)
        _await(q)
        return q


def _lines(spark, args, wait_seconds: float | None = None):
    """Files that are complete, each read once, or files that grow."""
    if args.tail:
        from vitrine.sources.tail import tail_stream
        return tail_stream(spark, args.source)
    from vitrine.streaming.landing import line_stream
    return line_stream(spark, args.source, wait_seconds=wait_seconds)


def _await(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


if __name__ == "__main__":
    main(sys.argv[1:])
