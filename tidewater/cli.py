"""Stages from the command line: ``python -m tidewater.cli STAGE ...``.

Exit status 0 means done, 1 that the stage failed or refused, 2 bad arguments.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from . import session
from .settings import Settings


def _query(a: argparse.Namespace) -> None:
    from . import stored  # noqa: F401  adds its queries
    from .catalogue import QUERIES

    QUERIES[a.name](session.active(), a.tables).write.mode("overwrite").parquet(a.out)


def _ingest(a: argparse.Namespace) -> None:
    from .streaming import ingest

    spark = session.active()
    listener = ingest.MetricsListener()
    spark.streams.addListener(listener)
    stream = ingest.stream_events(spark, a.landing, a.late_after * 60)
    ingest.write_stream(stream, a.silver, a.checkpoint, not a.keep_running, a.quarantine).awaitTermination()
    print(listener.totals)


def _features(a: argparse.Namespace) -> None:
    from .plans.features import FEATURE_TABLES, FeatureTable, build_features
    from .sources.snapshots import SnapshotStore
    from .streaming import ingest, online

    spark = session.active()
    streams = (FeatureTable("repo_stream", online.repo_stream_features, ("repo_id",)), FeatureTable("actor_stream", online.actor_stream_features, ("actor_login",)))
    print(build_features(SnapshotStore(spark, a.store), ingest.read_silver(spark, a.silver), FEATURE_TABLES + streams))


def _publish(a: argparse.Namespace) -> None:
    from .sources.snapshots import SnapshotStore
    from .streaming.online import OnlineStore

    store = OnlineStore(SnapshotStore(session.active(), a.store), created=True)
    print(store.publish(a.source, a.target, a.key, a.time, a.mode))


def parser(settings: Settings | None = None) -> argparse.ArgumentParser:
    settings = settings or Settings.load()
    top = argparse.ArgumentParser(prog="tidewater")
    stages = top.add_subparsers(required=True)

    def stage(name: str, run, *options: tuple[str, dict]) -> None:
        sub = stages.add_parser(name)
        sub.set_defaults(run=run)
        for flag, how in options:
            sub.add_argument(flag, **how)

    need = {"required": True}
    stage("query", _query, ("name", {}), ("--tables", {"default": settings.tables}), ("--out", need))
    stage("ingest", _ingest, ("--landing", need), ("--silver", need), ("--checkpoint", need), ("--quarantine", {}), ("--late-after", {"type": int, "default": settings.late_minutes}), ("--keep-running", {"action": "store_true"}))
    stage("features", _features, ("--silver", need), ("--store", {"default": settings.store}))
    stage("publish", _publish, ("--store", {"default": settings.store}), ("--source", need), ("--target", need), ("--key", {"nargs": "+", "required": True}), ("--time", {"default": "event_time"}), ("--mode", {"default": "triggered"}))
    return top


def main(argv: Sequence[str] | None = None) -> int:
    try:
        args = parser().parse_args(argv)
        args.run(args)
    except (ValueError, LookupError, RuntimeError) as error:
        print(f"{type(error).__name__}: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
