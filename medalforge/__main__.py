"""Command line: publish gold from silver, then run named queries on it.

    python -m medalforge silver --root /shared/warehouse
    python -m medalforge build --root /shared/warehouse [--verify]
    python -m medalforge query customer_360 --root /shared/warehouse \\
        [--as-of 2002-01-01] [--out /shared/reports/customer_360] [--show 20] [--explain]
    python -m medalforge list

``--root`` holds ``bronze/<table>`` and ``silver/<table>`` Parquet folders and the
gold builds (``sources.catalog``); ``silver`` cleanses the six bronze tables.
Under ``spark-submit`` the cluster's session is used; ``--local`` starts a
local one instead.
"""

from __future__ import annotations

import argparse
import json
import sys

SILVER_TABLES = ("crm_cust_info", "erp_cust_az12", "erp_loc_a101",
                 "crm_prd_info", "erp_px_cat_g1v1", "crm_sales_details")


def _session(local: bool):
    from pyspark.sql import SparkSession

    from .session import build_session, shared_dir
    if local:
        return build_session()
    spark = SparkSession.builder.getOrCreate()
    shared_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m medalforge")
    sub = parser.add_subparsers(dest="command", required=True)
    build = sub.add_parser("build", help="silver → gold (dimensions, then the fact)")
    build.add_argument("--root", required=True)
    build.add_argument("--key-mode", choices=("distributed", "window"), default="distributed")
    build.add_argument("--verify", action="store_true",
                       help="check keys before publishing; fail on broken references")
    build.add_argument("--max-unmatched", type=float, default=0.5,
                       help="with --verify: share of sales that may find no product or customer")
    build.add_argument("--fact-layout", choices=("rebalance", "sort"), default="rebalance",
                       help="rebalance (one shuffle, AQE-sized files) or sort within input splits")
    silver = sub.add_parser("silver", help="bronze → silver (the six source tables)")
    silver.add_argument("--root", required=True)
    query = sub.add_parser("query", help="run a named query on the gold tables")
    from .plans.catalog import ANALYTICS
    query.add_argument("name", choices=sorted(ANALYTICS), metavar="name",
                       help="a named query (see: python -m medalforge list)")
    query.add_argument("--root", required=True)
    query.add_argument("--as-of", default=None, help="date for ages and recency (default: today)")
    query.add_argument("--out", default=None, help="write the result as Parquet here")
    query.add_argument("--show", type=int, default=0, help="print the first N rows")
    query.add_argument("--explain", action="store_true", help="print the formatted physical plan")
    sub.add_parser("list", help="list the named queries")
    for p in (silver, build, query):
        p.add_argument("--local", action="store_true", help="start a local Spark session")
    args = parser.parse_args(argv)

    from .plans.catalog import ANALYTICS, run
    if args.command == "list":
        print("\n".join(sorted(ANALYTICS)))
        return 0

    from .operators.gold import GOLD_ORDER, build_gold
    from .sources.catalog import Layers
    spark = _session(args.local)
    layers = Layers(spark, args.root)
    if args.command == "silver":
        from .warehouse import silver_step
        print("\n".join(silver_step(layers)))
        return 0
    if args.command == "build":
        timings: dict[str, float] = {}
        silver = {name: layers.silver(name) for name in SILVER_TABLES}
        build_gold(silver, layers, key_mode=args.key_mode, timings=timings, verify=args.verify,
                   fact_layout_mode=args.fact_layout, max_unmatched=args.max_unmatched)
        print(json.dumps({k: round(v, 3) for k, v in timings.items()}))
        return 0
    published = layers.current_build()
    gold = {name: layers.gold(name, published) for name in GOLD_ORDER}
    result = run(args.name, gold, args.as_of)
    if args.explain:
        result.explain("formatted")
    if args.out:
        result.write.mode("overwrite").parquet(args.out)
    if args.show:
        result.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
