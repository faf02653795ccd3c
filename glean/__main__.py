"""Command line: ``python -m glean build|scan-projects ...``."""

from __future__ import annotations

import argparse
import json


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="glean")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="raw JSON Lines sources -> training_data/ (split=train, split=val partitions)")
    b.add_argument("--raw-dir", required=True)
    b.add_argument("--output-dir", required=True)
    b.add_argument("--val-ratio", type=float, default=0.05)
    s = sub.add_parser("scan-projects", help="project folder tree -> training samples + project records")
    s.add_argument("--scan-dir", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--run-ts", default=None, help="ISO timestamp of this run (snapshot stamp)")
    args = ap.parse_args(argv)

    from glean.plans.jobs import build_corpus_job, extract_projects_job
    from glean.session import get_session

    spark = get_session("glean")
    if args.cmd == "build":
        print(json.dumps(build_corpus_job(spark, args.raw_dir, args.output_dir, args.val_ratio)))
    else:
        print(json.dumps(extract_projects_job(spark, args.scan_dir, args.output, args.run_ts)))


if __name__ == "__main__":
    main()
