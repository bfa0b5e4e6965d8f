"""`spark-submit`-able entry: load statement folders into tables.

    python -m tallyroll <root> --mapping mapping.json --tables <base>
    python -m tallyroll <root>/<deal>/<vendor> --one-folder --mapping ... --tables ...
"""

from __future__ import annotations

import argparse

from tallyroll.plans.ingest import Limits, ingest
from tallyroll.session import build_session
from tallyroll.sources.mapping import load_mapping
from tallyroll.sources.tables import Tables


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallyroll", description=__doc__.splitlines()[0])
    parser.add_argument("roots", nargs="+", help="folders holding <deal>/<vendor>/<file>.csv")
    parser.add_argument("--mapping", required=True, help="JSON file {target: [alias, ...]}")
    parser.add_argument("--tables", required=True, help="base path of the destination tables")
    parser.add_argument("--payment-columns", nargs="+", help="columns that the payment table is to have from now on")
    parser.add_argument("--one-folder", action="store_true", help="a root is one vendor's folder")
    parser.add_argument("--max-files", type=int, default=Limits().files)
    parser.add_argument("--max-bytes", type=int, default=Limits().bytes)
    parser.add_argument("--backfill-isrc", action="store_true", help="songs without ISRC take over one of their title")
    args = parser.parse_args(argv)

    spark = build_session()
    tables = Tables(spark, args.tables).create()
    if args.payment_columns and tuple(args.payment_columns) != tables.destination().columns:
        tables.set_payment_columns(args.payment_columns)
    run = ingest(
        spark,
        tables,
        load_mapping(spark, args.mapping),
        *args.roots,
        folders="" if args.one_folder else "*/*",
        limits=Limits(args.max_files, args.max_bytes),
        backfill_isrc=args.backfill_isrc,
    )
    print(f"run {run.run_id}: {len(run.loads)} load(s) committed")


if __name__ == "__main__":
    main()
