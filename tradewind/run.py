"""The whole job: raw CSV folder in; clean layer, star, run log and insights out.

    python -m tradewind.run RAW_FOLDER OUT_FOLDER [--input-gb N]
        [--month-partitions] [--database NAME]
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tradewind.operators.cleaning import (
    clean_children,
    clean_ordered,
    clean_parents,
    quarantine_rejects,
    rows_of,
)
from tradewind.operators.integrity import require_constraints
from tradewind.operators.star import Star, build_star, require_all_lines, star_table_names
from tradewind.plans.suite import export_insights, run_metric_suite, suite_summary
from tradewind.session import input_bytes, open_session, size_for
from tradewind.sources.contracts import CLEAN_TABLES, STAR_TABLES
from tradewind.sources.landing import load_staging
from tradewind.sources.tables import (
    LayerVersion,
    expire_versions,
    layer_paths,
    overwrite_layer,
    read_layer,
    register_tables,
)

# Clean tables that BI readers get beside the star.
FUNNEL = ("qualified_leads", "closed_deals")


@dataclass(frozen=True)
class Outcome:
    star: Star
    quarantine: DataFrame
    log: DataFrame
    insights: DataFrame


def build_layers(
    spark: SparkSession, raw_folder: str, out: str, partition_by_month: bool = False
) -> tuple[Star, DataFrame]:
    """Land, clean and model; every layer is stored before the next one reads it.

    Parents are stored before their children resolve against them, so a child reads one
    key column instead of parsing its parents again.  Clean layer and star are one version:
    if a declared constraint is broken, a line is lost on the way into the star, or the run
    dies, nothing is published and readers keep the previous version of both.
    """
    out = out.rstrip("/")
    overwrite_layer(spark, load_staging(spark, raw_folder), f"{out}/staging")
    raw = read_layer(spark, f"{out}/staging")

    version = LayerVersion(spark, f"{out}/clean")
    parents = clean_parents(raw)
    clean = version.put(rows_of(parents))
    orders = clean_ordered(raw, clean, store_lost=True)
    clean |= version.put(rows_of(orders))
    children = clean_children(raw, clean, store_lost=True)
    clean |= version.put(rows_of(children))
    refused = quarantine_rejects(parents, orders, children)
    refused = version.put({"quarantine": refused})["quarantine"]
    require_constraints(clean, CLEAN_TABLES)

    star = build_star(spark, clean, version.place("star"), partition_by_month)
    require_all_lines(star)
    require_constraints(star.tables(), STAR_TABLES)
    version.name("star", star_table_names())
    version.put({**star.tables(), **{n: clean[n] for n in FUNNEL}}, "bi")
    version.publish()
    return star, refused


def run_all(
    spark: SparkSession,
    raw_folder: str,
    out: str,
    partition_by_month: bool = False,
    database: str | None = None,
) -> Outcome:
    star, quarantine = build_layers(spark, raw_folder, out, partition_by_month)
    log = run_metric_suite(spark, star, f"{out}/suite")
    insights = export_insights(spark, star, f"{out}/suite")
    if database:
        register_tables(spark, layer_paths(spark, f"{out}/clean", "bi"), database)
    for layers in ("staging", "clean"):
        expire_versions(spark, f"{out}/{layers}")
    return Outcome(star, quarantine, log, insights)


def main() -> None:
    parser = argparse.ArgumentParser(description="Marketplace analytics on Spark")
    parser.add_argument("raw_folder")
    parser.add_argument("out_folder")
    parser.add_argument("--month-partitions", action="store_true")
    parser.add_argument("--database", help="also register the published tables here")
    parser.add_argument("--input-gb", type=float, help="size to plan for; by default that of the files")
    args = parser.parse_args()
    spark = open_session()
    asked = int(args.input_gb * (1 << 30)) if args.input_gb else None
    size_for(spark, input_bytes(spark, args.raw_folder) if asked is None else asked)
    done = run_all(
        spark, args.raw_folder, args.out_folder, args.month_partitions, args.database
    )
    done.log.where("status <> 'ok'").select("metric", "error").show(60, truncate=False)
    ok, total = suite_summary(done.log).first()
    print(f"metrics ok: {ok} of {total}")


if __name__ == "__main__":
    main()
