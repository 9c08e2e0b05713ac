"""Command line for the load lifecycle: ``python -m meterlake run ...`` (L1) and ``info``.

The options follow the reference's ``run`` command (workflow, stores, month,
year, delta, keep, output); files are taken from a landing folder (one
sub-folder per meter code) instead of a browser download, and each store
name is bound to a Parquet point-store path with ``--store NAME=PATH``.
"""

from __future__ import annotations

import argparse
import json
import sys

from meterlake.functions.calendar import WORKFLOWS


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="meterlake", description=__doc__.splitlines()[0])
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("info", help="list the workflows and how stores are named")
    r = sub.add_parser("run", help="load the workbooks under a landing folder into point stores")
    r.add_argument("--landing", required=True, help="folder of <meter code>/<file>.xlsx workbooks")
    r.add_argument("-w", "--workflow", default="current", choices=WORKFLOWS)
    r.add_argument("-d", "--db", default="", help="comma-separated store names (empty names are ignored)")
    r.add_argument("--store", action="append", default=[], metavar="NAME=PATH",
                   help="bind a store name to a point-store path (repeatable)")
    r.add_argument("-m", "--month", type=int)
    r.add_argument("-y", "--year", type=int)
    r.add_argument("--delta", action="store_true", help="load only readings newer than each meter's mark")
    r.add_argument("-k", "--keep", action="store_true", help="move the landing folder to OUTPUT/<session>")
    r.add_argument("-o", "--output", help="folder for kept landing folders")
    r.add_argument("--as-of", help="the time 'now' refers to (default: the current time)")
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    args = build_parser().parse_args(argv)
    if args.command == "info":
        print(json.dumps({"workflows": list(WORKFLOWS), "stores": "NAME=PATH (Parquet point store)"}))
        return 0
    from meterlake.plans.workflows import run_load
    from meterlake.session import build_session

    stores = {}
    for s in args.store:
        name, sep, path = s.partition("=")
        if not sep or not name.strip() or not path:
            raise SystemExit(f"--store expects NAME=PATH, got {s!r}")
        stores[name.strip()] = path
    db = [t.strip() for t in args.db.split(",")]
    spark = spark or build_session()
    session, report, bad = run_load(spark, args.landing, args.workflow, db, stores, as_of=args.as_of,
                                    year=args.year, month=args.month, delta=args.delta, keep=args.keep,
                                    output=args.output)
    out = session.first().asDict()
    out["timestamp"] = out["timestamp"].isoformat()
    out["stores"] = [r.asDict() for r in report.collect()]      # one row per named store
    out["quarantined_rows"] = bad.count()
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    sys.exit(main())
