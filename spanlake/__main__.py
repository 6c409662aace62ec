"""Shell entry of the jobs: ``python -m spanlake JOB …``."""

from __future__ import annotations

import argparse
import sys
from dataclasses import fields

from spanlake.plans import jobs
from spanlake.plans.layout import InputFiles, Layout
from spanlake.session import build_session, remove_scratch


def parse(arguments: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="spanlake")
    job = parser.add_subparsers(dest="job", required=True)
    for name in ("ingest", "conform", "report", "run-all", "present"):
        sub = job.add_parser(name)
        sub.add_argument("--input-dir", required=True)
        sub.add_argument("--output-dir", required=True)
        _add_layout(sub)
        if name in ("ingest", "run-all"):
            sub.add_argument("--snapshots-file", default=InputFiles.snapshots)
            sub.add_argument("--periods-file", default=InputFiles.periods)
            sub.add_argument("--expected-snapshots", type=int)
            sub.add_argument("--expected-periods", type=int)
            sub.add_argument("--multi-line", action="store_true")
            sub.add_argument("--check-header", action="store_true")
            sub.add_argument("--corrupt-column")
            sub.add_argument("--required", action="store_true")
        if name != "present":
            sub.add_argument("--resume", action="store_true")
        if name in ("conform", "run-all"):
            sub.add_argument("--drop-unknown", dest="keep_unknown", action="store_false")
            sub.add_argument("--parse-time", action="store_true")
    sub = job.add_parser("validate")
    sub.add_argument("--lake-dir", required=True)
    _add_layout(sub)
    return parser.parse_args(arguments)


def _add_layout(sub: argparse.ArgumentParser) -> None:
    for field in fields(Layout):
        sub.add_argument(f"--{field.name}-folder", default=field.default)


def main(arguments: list[str]) -> int:
    args = parse(arguments)
    spark = build_session(f"spanlake {args.job}")
    layout = Layout(**{f.name: getattr(args, f"{f.name}_folder") for f in fields(Layout)})
    given = {
        name: getattr(args, name)
        for name in (
            "multi_line", "check_header", "corrupt_column", "required", "keep_unknown", "parse_time",
            "resume",
        )
        if hasattr(args, name)
    }
    try:
        if args.job == "validate":
            jobs.validate(spark, args.lake_dir, layout=layout)
        elif args.job in ("conform", "report", "present"):
            run = getattr(jobs, args.job)
            run(spark, args.input_dir, args.output_dir, layout=layout, **given)
        else:
            run = jobs.ingest if args.job == "ingest" else jobs.run_all
            expected = {"snapshots": args.expected_snapshots, "periods": args.expected_periods}
            run(
                spark,
                args.input_dir,
                args.output_dir,
                {table: rows for table, rows in expected.items() if rows is not None},
                InputFiles(args.snapshots_file, args.periods_file),
                layout,
                **given,
            )
    except jobs.RuleViolation as violation:
        print(violation, file=sys.stderr)
        return 1
    finally:
        remove_scratch(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
