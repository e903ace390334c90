"""Command line: ``python -m covtab <command> ...`` (or via spark-submit).

    convert-dir       <input_dir> <output> [--chrom C] [--pos_start N] [--pos_end N]
    convert-manifest  <studies.tsv> <output> [region options]
    convert-study     --input_base B --study S <output> [region options] [--dry-run]
    find-dirs         --root R --out DIR
    validate          <table> [--expected-chrom C] [--expected-pos-start N] [--expected-pos-end N]
    inspect           <file_or_dir> [--chrom C] [--start N] [--end N] [--n N] [--recursive]
    null-report       <table>

Every command runs Spark jobs in the current (or a new) session; the exit code
is 1 when a check fails or an input is unreadable.
"""

from __future__ import annotations

import argparse
import sys


def _region(args):
    from covtab.region import RegionSpec
    return RegionSpec(args.chrom, args.pos_start, args.pos_end)


def _add_region(p):
    p.add_argument("--chrom", default=None, help="the one chromosome to keep, X included; without it, all autosomes")
    p.add_argument("--pos_start", type=int, default=None, help="first position of --chrom to keep, counted from 1")
    p.add_argument("--pos_end", type=int, default=None, help="last position of --chrom to keep")


def build_parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="covtab", description="Coverage tables on Spark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("convert-dir", help="one directory of BigWigs -> one sorted table")
    p.add_argument("input_dir")
    p.add_argument("output")
    _add_region(p)
    p = sub.add_parser("convert-manifest", help="every manifest row -> one table per (study, group)")
    p.add_argument("studies_file")
    p.add_argument("output")
    _add_region(p)
    p = sub.add_parser("convert-study", help="<input_base>/<study>/*/bigwig -> tables")
    p.add_argument("--input_base", required=True)
    p.add_argument("--study", required=True)
    p.add_argument("output")
    p.add_argument("--dry-run", action="store_true", help="only list the tables that would be written")
    _add_region(p)
    p = sub.add_parser("find-dirs", help="write a manifest of <root>/<study>/<group>/bigwig dirs")
    p.add_argument("--root", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("validate", help="check a published table or dataset")
    p.add_argument("table")
    p.add_argument("--expected-chrom", default=None)
    p.add_argument("--expected-pos-start", type=int, default=None)
    p.add_argument("--expected-pos-end", type=int, default=None)
    p = sub.add_parser("inspect", help="readability of a directory, or head of a file")
    p.add_argument("path")
    p.add_argument("--chrom", default=None)
    p.add_argument("--start", type=int, default=0)
    p.add_argument("--end", type=int, default=None)
    p.add_argument("--n", type=int, default=10)
    p.add_argument("--recursive", action="store_true")
    p = sub.add_parser("null-report", help="per-column NA counts of a table")
    p.add_argument("table")
    return ap


def _print_rows(df) -> None:
    """Every row, tab separated; rows pass the driver partition by partition."""
    print("\t".join(df.columns))
    for r in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in r))


def main(argv: list[str] | None = None, spark=None) -> int:
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F

    from covtab import paths
    from covtab.session import build_session, checkpoint_dir, ship_package

    args = build_parser().parse_args(argv)
    spark = spark or build_session()
    ship_package(spark)
    from covtab.operators.convert import ConversionError, EmptyResultError
    from covtab.sources.listing import DiscoveryError
    from covtab.sources.manifest import ManifestError

    try:
        if args.cmd in ("convert-dir", "convert-manifest", "convert-study"):
            from covtab.plans import jobs
            region = _region(args)
            if args.cmd == "convert-dir":
                res = jobs.convert_directory(spark, args.input_dir, args.output, region)
            elif args.cmd == "convert-manifest":
                res = jobs.convert_manifest(spark, args.studies_file, args.output, region)
            else:
                if args.dry_run:
                    from covtab.sources.listing import discover_bigwig_dirs
                    from covtab.sources.manifest import planned_outputs
                    plan = planned_outputs(discover_bigwig_dirs(spark, args.input_base, args.study),
                                           args.output, region)
                    print(f"{plan.count()} group(s) of study {args.study} would be converted")
                    for r in plan.orderBy("output_path").toLocalIterator():
                        print(r["plan_line"])
                    return 0
                res = jobs.convert_study(spark, args.input_base, args.study, args.output, region)
            if res.n_no_data:
                print(f"Note: {res.n_no_data} input file(s) kept no interval:", file=sys.stderr)
                for r in spark.read.parquet(res.no_data).orderBy("file_path").toLocalIterator():
                    print(f"  {r['file_path']}", file=sys.stderr)
            print(f"{res.rows_written} rows from {res.files} files are in {res.table}")
            return 0
        if args.cmd == "find-dirs":
            from covtab.sources.listing import discover_bigwig_dirs
            from covtab.sources.manifest import write_manifest
            checkpoint_dir(spark)
            dirs = discover_bigwig_dirs(spark, args.root).checkpoint(eager=True)
            write_manifest(dirs, paths.absolute(args.out))
            print(f"{dirs.count()} directories are listed in {args.out}")
            return 0
        if args.cmd == "validate":
            from covtab.operators.validate import validate_dataset
            from covtab.region import Expectation
            path = paths.absolute(args.table)
            if not paths.exists(spark, path):
                print(f"FAIL: no such table: {path}", file=sys.stderr)
                return 1
            expect = Expectation(args.expected_chrom, args.expected_pos_start, args.expected_pos_end)
            report = validate_dataset(spark, path, expect).persist()
            keys = [c for c in ("study_name", "qtl_group") if c in report.columns]
            _print_rows(report.orderBy(*keys, "seq", "detail"))
            n = report.filter(F.col("status") == "FAIL").count()
            print("PASS" if not n else f"FAIL: {n} check(s) failed",
                  file=sys.stderr if n else sys.stdout)
            return 1 if n else 0
        if args.cmd == "inspect":
            from covtab.plans import jobs
            if paths.is_directory(spark, paths.absolute(args.path)):
                per_file, summary, bad = jobs.inspect_directory(spark, args.path, args.recursive)
                _print_rows(summary)
                _print_rows(bad.orderBy("bigwig_dir", "position"))
                return 1 if bad.limit(1).count() else 0
            overview, first, head, failures = jobs.inspect_files(
                spark, args.path, args.chrom, args.start, args.end, args.n)
            _print_rows(overview)
            _print_rows(first.orderBy("rn"))
            _print_rows(head.orderBy("rn"))
            failed = failures.collect()  # one file
            for r in failed:
                print(f"FAIL: {r['file_path']}: {r['error']}", file=sys.stderr)
            return 1 if failed else 0
        if args.cmd == "null-report":
            from covtab.plans import jobs
            counts, rows = jobs.null_report(spark, args.table)
            _print_rows(counts)
            if counts.filter("has_na").limit(1).count():
                _print_rows(rows)
            return 0
    except (ConversionError, EmptyResultError, DiscoveryError, ManifestError, ValueError,
            FileNotFoundError, PySparkException) as e:
        print(f"Error: {e}", file=sys.stderr)
        return 1
    return 2


if __name__ == "__main__":
    raise SystemExit(main())
