"""Command line: build the star from its three sources."""

from __future__ import annotations

import argparse

from starkit.plans.model import BuildConfig, run_build
from starkit.session import get_spark


def main() -> None:
    parser = argparse.ArgumentParser(prog="starkit", description=__doc__)
    parser.add_argument("--feed", required=True, help="parquet path or glob")
    parser.add_argument("--demographics", required=True, help="delimited file with a header")
    parser.add_argument("--labels", required=True, help="label text file or folder")
    parser.add_argument("--target", required=True, help="folder for the written model")
    parser.add_argument("--unknown-countries", choices=["drop", "member"], default="drop")
    parser.add_argument("--fact-keys", choices=["positional", "stable"], default="positional")
    parser.add_argument("--partition-fact", action="store_true")
    parser.add_argument("--demographics-separator", default=";")
    parser.add_argument("--map-delimiter", default=";", help="of the exported code maps")
    parser.add_argument("--count-rejects", action="store_true", help="report rows lost per lookup")
    args = parser.parse_args()
    config = BuildConfig(
        feed_path=args.feed,
        demographics_path=args.demographics,
        labels_path=args.labels,
        target=args.target,
        unknown_countries=args.unknown_countries,
        fact_keys=args.fact_keys,
        partition_fact=args.partition_fact,
        demographics_separator=args.demographics_separator,
        map_delimiter=args.map_delimiter,
        count_rejects=args.count_rejects,
    )
    _, metrics = run_build(get_spark(), config)
    for table in metrics:
        rows = "" if table.rows is None else f"{table.rows} rows, "
        fanout = f", {table.fanout_keys} keys with several rows" if table.fanout_keys else ""
        print(f"{table.table}: {rows}{table.seconds:.1f} s{fanout}")


if __name__ == "__main__":
    main()
