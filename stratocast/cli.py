"""Command line: the daily job and the day-folder stream.

    python -m stratocast.cli run-day --raw RAW --warehouse WH [--day YYYY-MM-DD]
    python -m stratocast.cli run-stream --raw RAW --warehouse WH

Launch with ``spark-submit`` on a cluster; the session takes its settings
(including ``spark.checkpoint.dir``) from the launcher.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json

from stratocast.plans import incremental as INC
from stratocast.session import build_session
from stratocast.streaming import day_folders as ST


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="stratocast")
    sub = parser.add_subparsers(dest="command", required=True)
    day = sub.add_parser("run-day", help="stage and aggregate one day folder (next from the ledger by default)")
    day.add_argument("--raw", required=True)
    day.add_argument("--warehouse", required=True)
    day.add_argument("--day", type=_dt.date.fromisoformat)
    stream = sub.add_parser("run-stream", help="process every day folder that arrived since the last run")
    stream.add_argument("--raw", required=True)
    stream.add_argument("--warehouse", required=True)
    args = parser.parse_args(argv)

    spark = build_session(app_name=f"stratocast-{args.command}")
    print(json.dumps(run(spark, args.command, args.raw, args.warehouse, getattr(args, "day", None))))
    spark.stop()
    return 0


def run(spark, command: str, raw: str, warehouse: str, day: _dt.date | None = None, checkpoint: str | None = None) -> dict:
    """Run one command on an existing session; returns a JSON-able summary."""
    layout = INC.Layout(raw, warehouse)
    if command == "run-day":
        result = INC.run_day(spark, layout, day=day)
        if result is None:
            return {"finished": True}
        return {"day": str(result["day"]), "touched": [str(d) for d in result["touched"]], "tables": sorted(result["tables"])}
    if command == "run-stream":
        batches = ST.run_available(spark, layout, checkpoint=checkpoint)
        return {"batches": len(batches), "days": sorted({str(d) for b in batches for d in b})}
    raise ValueError(f"unknown command {command!r}")


if __name__ == "__main__":
    raise SystemExit(main())
