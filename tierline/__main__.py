"""Job entry point: ``spark-submit ... -m tierline <command> --lake DIR --landing DIR``.

run        ingest what is new and rebuild what depends on it
refresh    replay every landing file into new tables
verify     print all checks; exit 1 if one failed
health     print the runs, newest first, and what should alert somebody
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from tierline import registry
from tierline.operators.checks import VerificationError, require_clean
from tierline.plans import runlog, suburbs, verification
from tierline.plans.pipeline import Pipeline
from tierline.session import build_session
from tierline.sources.lake import Lake


def show_all(rows) -> None:
    """Print every row, one partition at the driver at a time."""
    print(" | ".join(rows.columns))
    for row in rows.toLocalIterator():
        print(" | ".join("" if x is None else str(x) for x in row))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tierline", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    ap.add_argument("command", choices=["run", "refresh", "verify", "health"])
    ap.add_argument("--lake", required=True)
    ap.add_argument("--landing", required=True)
    ap.add_argument("--config", help="registry file or folder; by default the packaged suburb mart")
    ap.add_argument("--env", default="dev")
    ap.add_argument("--run-id")
    ap.add_argument("--runs", type=int, default=50, help="health: how many of the newest runs to list (alerts are always all listed)")
    args = ap.parse_args(argv)

    spark = build_session(**{"spark.checkpoint.dir": f"{args.lake.rstrip('/')}/_work"})
    pipe = Pipeline(Lake(spark, args.lake), registry.load(args.config), args.landing, args.env)
    if args.command in ("run", "refresh"):
        trigger = "manual" if args.env == "dev" else "scheduled"
        done = pipe.run(args.run_id, trigger) if args.command == "run" else pipe.full_refresh(args.run_id)
        print(f"run_id={done.run_id} status={done.status} rows_read={done.rows_read} rows_written={done.rows_written}")
    elif args.command == "verify":
        # the packaged mart has views to serve; another configuration has its tables only
        found = verification.verify(pipe, None if args.config else suburbs.views(pipe.lake)).cache()
        show_all(found)
        try:
            require_clean(found)
        except VerificationError as exc:
            print(exc)
            return 1
    else:
        settings = pipe.registry.settings(args.env)
        rows = pipe.log.health(settings)
        rows.show(args.runs, False)
        show_all(runlog.alerts(rows, settings, F.current_timestamp()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
