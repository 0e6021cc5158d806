"""Command line: run the warehouse pipeline (sandbox → stage → dw → marts).

python -m vitals --sf-dir /root/testdata/sf0.01 [--root DIR] [--files DIR] [--steps sandbox,stage,dw,marts] [--master local[8]]
"""

from __future__ import annotations

import argparse
import json

from vitals.plans.pipeline import STEPS, run
from vitals.session import get_session, scratch_path


def main() -> None:
    ap = argparse.ArgumentParser(prog="vitals")
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--root", help="shared folder for the layers (default: below spark.checkpoint.dir)")
    ap.add_argument("--files", help="folder of source files, one folder per sandbox table (default: laid down from --sf-dir)")
    ap.add_argument("--steps", default=",".join(STEPS))
    ap.add_argument("--master", default=None)
    args = ap.parse_args()
    spark = get_session(args.master)
    root = args.root or scratch_path(spark, "warehouse")
    report = run(spark, args.sf_dir, root, steps=[s for s in args.steps.split(",") if s], files=args.files)
    print(json.dumps({"root": root, **report}, default=str))


if __name__ == "__main__":
    main()
