"""Job entry point: ``spark-submit cardmarts/__main__.py`` or ``python -m cardmarts``.

    python -m cardmarts --landing s3a://b/landing --lake s3a://b/lake --date 2024-01-01
    python -m cardmarts ... --layers silver gold --tables fact_transactions

Runs the chosen layers for one date (all active tables of each layer unless
``--tables`` names some), logs every step, and prints one JSON line per
written table. The session comes from the cluster; ``--input-bytes`` sizes
shuffle partitions with ``scale_conf``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from cardmarts.plans.run import LAYERS, Lake, register_layers, run_layer
from cardmarts.session import apply_conf, scale_conf
from cardmarts.sinks.tables import drop_old_versions


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cardmarts")
    ap.add_argument("--landing", help="landing root (needed for bronze)")
    ap.add_argument("--lake", required=True, help="lake root on a shared file system")
    ap.add_argument("--date", required=True, help="ingestion / load date, YYYY-MM-DD")
    ap.add_argument("--layers", nargs="+", choices=LAYERS, default=list(LAYERS))
    ap.add_argument("--tables", nargs="+", help="only these tables (with a single layer)")
    ap.add_argument("--format", default="parquet", help="table format (parquet, or delta if installed)")
    ap.add_argument("--register", action="store_true",
                    help="register <layer>.<table>, gold.vw_<table> and the run log in the catalog")
    ap.add_argument("--config-root", help="folder with the three config files (default: the packaged ones)")
    ap.add_argument("--keep-versions", type=int, help="afterwards remove older copies of the built tables")
    ap.add_argument("--input-bytes", type=int, help="approximate input size, to size shuffles")
    ap.add_argument("--json-glob", default="*.json", help="file pattern of JSON dictionary files")
    args = ap.parse_args(argv)
    if args.tables and len(args.layers) != 1:
        ap.error("--tables needs exactly one layer in --layers")
    if "bronze" in args.layers and not args.landing:
        ap.error("bronze needs --landing")

    spark = SparkSession.builder.appName("cardmarts").getOrCreate()
    if args.input_bytes:
        cores = spark.sparkContext.defaultParallelism
        apply_conf(spark, scale_conf(args.input_bytes, cores))
    lake = Lake(args.lake, args.format)
    written = {}
    prev = None
    for layer in args.layers:
        prev = written[layer] = run_layer(spark, lake, layer, args.date, landing_root=args.landing,
                                          tables=args.tables, file_glob=args.json_glob, inputs=prev,
                                          config_root=args.config_root)
        for table, w in written[layer].items():
            print(json.dumps({"layer": layer, "table": table, "path": w.path, "rows": w.rows}))
    if args.register:
        register_layers(spark, lake, written)
    if args.keep_versions:
        for layer, tables in written.items():
            for table in tables:
                drop_old_versions(spark, lake.table_root(layer, table), args.keep_versions)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
