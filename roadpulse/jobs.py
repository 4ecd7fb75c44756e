"""Command lines of the stored-table jobs, for ``spark-submit`` or ``python -m roadpulse.jobs``.

    python -m roadpulse.jobs clean --raw raw/ --silver silver/
    python -m roadpulse.jobs roads --edges edges/ --network network/ --segments segments/
    python -m roadpulse.jobs traffic --silver silver/ --segments segments/ --events events/ --events db:traffic_events
    python -m roadpulse.jobs labels --silver silver/ --labels labels/ --events labelled/

A table is a path, or ``db:NAME`` for a table of the database that ``--db-url`` and ``--db-user`` name; its
password comes from the environment variable that ``--db-password-variable`` names.
"""

from __future__ import annotations

import argparse
import json
import os
from collections.abc import Sequence

from roadpulse.operators import clean, matching
from roadpulse.plans import jobs
from roadpulse.session import build_session
from roadpulse.sources.snapshots import broken_documents
from roadpulse.sources.tables import Jdbc


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    top.add_argument("--master")
    for name in ("url", "user"):
        top.add_argument(f"--db-{name}")
    top.add_argument("--db-password-variable", default="ROADPULSE_DB_PASSWORD")
    names = top.add_subparsers(dest="job", required=True)
    one = names.add_parser("clean")
    one.add_argument("--raw", required=True)
    one.add_argument("--silver", required=True)
    one.add_argument("--min-confidence", type=float, default=clean.MIN_CONFIDENCE)
    one = names.add_parser("roads")
    for table in ("edges", "network", "segments"):
        one.add_argument(f"--{table}", required=True)
    one.add_argument("--chunk-metres", type=float, default=100.0)
    one.add_argument("--id-scope", choices=("osmid", "edge"), default="osmid")
    one = names.add_parser("traffic")
    one.add_argument("--silver", required=True)
    one.add_argument("--segments", required=True)
    one.add_argument("--events", required=True, action="append")
    one.add_argument("--snapshot")
    one.add_argument("--matches", help="folder of matched lines that later runs need not match again")
    one.add_argument("--scan-column")
    one.add_argument("--scan-bounds", type=int, nargs=2)
    one.add_argument("--scan-partitions", type=int, default=16)
    one.add_argument("--max-angle", type=float, default=matching.MAX_ANGLE)
    one.add_argument("--min-overlap", type=float, default=matching.MIN_OVERLAP_M)
    one.add_argument("--speed", choices=("avg", "min"), default="avg")
    one = names.add_parser("labels")
    one.add_argument("--silver", required=True)
    one.add_argument("--labels", required=True)
    one.add_argument("--events", required=True, action="append")
    one.add_argument("--labelled")
    return top


def main(given: Sequence[str] | None = None) -> dict | None:
    args = parser().parse_args(given)

    def table(name: str) -> str | Jdbc:
        if not name.startswith("db:"):
            return name
        if not (args.db_url and args.db_user):
            raise SystemExit(f"{name} needs --db-url and --db-user")
        return Jdbc(args.db_url, name.removeprefix("db:"), args.db_user, os.environ.get(args.db_password_variable, ""))

    spark = build_session(f"roadpulse-{args.job}", args.master)
    report = None
    if args.job == "clean":
        stored = jobs.clean_traffic(spark, args.raw, args.silver, args.min_confidence)
        report = {"stored_rows": stored.count(), "broken_documents": broken_documents(spark, args.raw).count()}
    elif args.job == "roads":
        report = jobs.process_roads(spark, args.edges, table(args.network), table(args.segments), args.chunk_metres, args.id_scope)
    elif args.job == "traffic":
        scan = ({"partition_column": args.scan_column, "bounds": tuple(args.scan_bounds), "partitions": args.scan_partitions}
                if args.scan_column else None)
        report = jobs.process_traffic(spark, args.silver, table(args.segments), [table(e) for e in args.events], args.snapshot, scan,
                                      args.max_angle, args.min_overlap, args.speed, args.matches)
    else:
        jobs.label_traffic(spark, args.silver, table(args.labels), [table(e) for e in args.events], args.labelled)
    if report is not None:
        print(json.dumps(report))
    return report


if __name__ == "__main__":
    main()
