"""Command line: run the upload job on CSV files, each file an upload of its own.

    python -m upcheck --upload DIR_OR_FILE... --authority PATH --clean-out DIR --audit-out DIR
                      [--authority-format parquet|csv] [--format csv|parquet]
                      [--id-col NAME] [--sequence-col NAME] [--run-col NAME] [--antigen-col NAME]
                      [--authority-id NAME] [--authority-sequence NAME] [--authority-run NAME]
                      [--authority-antigen NAME]
                      [--[no-]aa-ambiguous] [--[no-]aa-allow-null] [--[no-]nu-ambiguous]
                      [--[no-]nu-allow-null] [--target NAME...] [--on-unresolvable fail|quarantine]
"""

from __future__ import annotations

import argparse

from upcheck.plans.presets import UploadPreset
from upcheck.plans.upload_job import prepare_group, process_upload, write_result
from upcheck.session import get_session
from upcheck.sources.csv import read_upload_csv

#: Column with each row's file, in both outputs.
FILE = "upload_file"
NAMES = ("id_col", "sequence_col", "run_col", "antigen_col", "authority_id", "authority_sequence", "authority_run",
         "authority_antigen")
SWITCHES = ("aa_ambiguous", "aa_allow_null", "nu_ambiguous", "nu_allow_null")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="upcheck")
    ap.add_argument("--upload", required=True, nargs="+")
    ap.add_argument("--authority", required=True)
    ap.add_argument("--authority-format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--clean-out", required=True)
    ap.add_argument("--audit-out", required=True)
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    for name in NAMES:
        ap.add_argument(f"--{name.replace('_', '-')}", default=getattr(UploadPreset, name))
    for name in SWITCHES:
        ap.add_argument(f"--{name.replace('_', '-')}", action=argparse.BooleanOptionalAction, default=getattr(UploadPreset, name))
    ap.add_argument("--target", nargs="*", help="target column names (default: the preset's)")
    ap.add_argument("--on-unresolvable", default="fail", choices=["fail", "quarantine"])
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    spark = get_session(args.master)
    preset = UploadPreset(**{name: getattr(args, name) for name in (*NAMES, *SWITCHES)})
    upload = read_upload_csv(spark, args.upload, file_col=FILE, prepare=prepare_group(preset, args.target))
    authority = (read_upload_csv(spark, args.authority) if args.authority_format == "csv"
                 else spark.read.parquet(args.authority))
    result = process_upload(upload, authority, preset, target=args.target,
                            on_unresolvable=args.on_unresolvable, scope=(FILE,))
    write_result(result, args.clean_out, args.audit_out, fmt=args.format)
    m = result.reconcile_metrics.get
    print(f"upcheck: {m.get('rows')} reconciled rows, {m.get('replaced_rows')} rebuilt from the "
          f"authority; outputs in {args.clean_out} and {args.audit_out}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
