"""Command line: list, run or explain the named queries.

    python -m molarflow list
    python -m molarflow run <query> [sf_dir] [--rows N]
    python -m molarflow explain <query> [sf_dir]
"""

from __future__ import annotations

import argparse
import os
import sys

DEFAULT_DIR = "/root/testdata/sf0.01"


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="molarflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for name in ("run", "explain"):
        p = sub.add_parser(name)
        p.add_argument("query")
        p.add_argument("sf_dir", nargs="?", default=DEFAULT_DIR)
        p.add_argument("--rows", type=int, default=20)
        p.add_argument("--master", default=os.environ.get("MOLARFLOW_MASTER"))
    args = ap.parse_args(argv)

    from molarflow.plans import REGISTRY
    if args.cmd == "list":
        for name, spec in REGISTRY.items():
            print(f"{name:34s} {spec.covers}{'' if spec.sql else '  (no oracle)'}")
        return 0
    if args.query not in REGISTRY:
        print(f"unknown query {args.query!r}; try `python -m molarflow list`", file=sys.stderr)
        return 2
    from molarflow.session import get_spark
    spark = get_spark(args.master, extra={"spark.sql.shuffle.partitions": "16"} if args.master else None)
    spark.sparkContext.setLogLevel("ERROR")
    df = REGISTRY[args.query].build(spark, args.sf_dir)
    if args.cmd == "explain":
        df.explain("formatted")
    else:
        df.show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
