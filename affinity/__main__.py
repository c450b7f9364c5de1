"""Command line: run registered queries and write their results.

    python -m affinity --root /data/tables --out /results avg_connectivity_coords unit_profile
    python -m affinity --files paths.json --out /results border_effect
    python -m affinity --root /data/tables --explain pair_features
    python -m affinity --files paths.json --param fanout_unit='"01001"' --out /results one_unit_fanout
    python -m affinity --list

``--root`` reads the test-table layout (one parquet per table); ``--files``
takes a JSON object with the fields of :class:`affinity.plans.files.FilePaths`
(the original file formats).  Each query is written as parquet under
``--out/<query>``.
"""

from __future__ import annotations

import argparse
import json
import sys

from affinity.plans import catalog


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m affinity", description=__doc__.splitlines()[0])
    ap.add_argument("queries", nargs="*", help="registered query names")
    src = ap.add_mutually_exclusive_group()
    src.add_argument("--root", help="folder with one parquet per table")
    src.add_argument("--files", help="JSON file with FilePaths fields (original file formats)")
    ap.add_argument("--out", help="output folder; each query is written to <out>/<query>")
    ap.add_argument("--explain", action="store_true", help="print the formatted plan instead of writing")
    ap.add_argument("--list", action="store_true", help="list the registered queries")
    ap.add_argument("--param", action="append", default=[], metavar="NAME=VALUE",
                    help="override an analysis parameter, e.g. level_year=2010 or fanout_unit='\"01001\"'")
    args = ap.parse_args(argv)

    if args.list:
        for name in catalog.names():
            print(name)
        return 0
    unknown = [q for q in args.queries if q not in catalog.names()]
    if unknown or not args.queries:
        ap.error(f"unknown or missing queries: {unknown}")
    if not (args.root or args.files) or not (args.out or args.explain):
        ap.error("give --root or --files, and --out or --explain")

    from pyspark.sql import SparkSession
    spark = SparkSession.builder.getOrCreate()
    if args.root:
        from affinity.plans.binding import Binding
        inputs = Binding(spark, args.root)  # own instance: --param must not touch a shared one
    else:
        from affinity.plans.files import FileInputs, FilePaths
        with open(args.files, encoding="utf-8") as f:
            inputs = FileInputs(spark, FilePaths(**json.load(f)))
    if args.param:
        import dataclasses
        updates = {}
        for item in args.param:
            key, _, raw = item.partition("=")
            try:
                updates[key] = json.loads(raw)
            except ValueError:
                updates[key] = raw
            if isinstance(updates[key], list):
                updates[key] = tuple(updates[key])
        inputs.params = dataclasses.replace(inputs.params, **updates)
    for name in args.queries:
        df = catalog.run(name, inputs)
        if args.explain:
            print(f"== {name} ==")
            df.explain("formatted")
        else:
            df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
            print(f"{name}: written to {args.out.rstrip('/')}/{name}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
