"""End-to-end report run over real files.

Reads the yearly flight files and the airport lookup, writes the enriched
table once (Parquet, partitioned by Year), then computes every aggregate
report from that stored table in a single scan (``single_pass``) and writes
the data behind each chart with the report sink. The profile of the raw
files, the delay distribution, the label counts and, on request, the model
comparison are written the same way.

Storing the enriched table first means the enrichment runs once; the
grouping-sets aggregate then reads the table once for all seventeen reports.

Usage:
    python -m aerolens.plans.reporting --flights 'data/*.csv' \\
        --airports data/airports.csv --out /shared/reports \\
        --state-a California --state-b Texas [--years 2017 2018] [--models]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolens.operators import distribution, filters, quality
from aerolens.plans import single_pass
from aerolens.operators.enrich import enrich
from aerolens.operators.ml import FIT_PARTITIONS
from aerolens.plans.modeling import model_comparison
from aerolens.plans.tables import labelled_flights, model_rows, read_enriched, store_enriched
from aerolens.session import build_session
from aerolens.sources.files import load_profile, read_airports, read_flights
from aerolens.sources.schemas import FLIGHTS_CSV_SCHEMA
from aerolens.sources.sinks import write_report


def report_frames(
    enriched: DataFrame,
    state_a: str,
    state_b: str,
    years: Sequence[int] = (),
) -> dict[str, DataFrame]:
    """Every report of the enriched table, by name: the aggregate reports from
    one grouping-sets scan (per-year reports for all years at once, plus one
    filtered copy per requested year), then distribution and labels."""
    flown = filters.not_cancelled(enriched)
    out = single_pass.all_reports(enriched, state_a, state_b, years)
    out.update(distribution.delay_reports(flown))
    out.update({
        "label_counts": labelled_flights(enriched)
        .groupBy("Labels")
        .agg(F.count(F.lit(1)).alias("Number")),
    })
    return out


def run_reports(
    spark: SparkSession,
    flights_paths: str | Sequence[str],
    airports_path: str,
    out_dir: str,
    state_a: str,
    state_b: str,
    years: Sequence[int] = (),
    with_models: bool = False,
    flights_schema=FLIGHTS_CSV_SCHEMA,
    fit_partitions: int = FIT_PARTITIONS,
) -> dict[str, str]:
    """Run everything and return report name -> written path. Models are fitted
    on ``fit_partitions`` partitions, a few times the cores of the cluster."""
    out_dir = out_dir.rstrip("/")
    raw = read_flights(spark, flights_paths, flights_schema)
    written = {"null_percentages": write_report(quality.null_percentages(raw), out_dir, "null_percentages")}
    profile = load_profile(spark, flights_paths, flights_schema)
    written["load_profile"] = write_report(profile, out_dir, "load_profile")
    table = store_enriched(enrich(raw, read_airports(spark, airports_path)), f"{out_dir}/enriched")
    enriched = read_enriched(spark, table)
    for name, frame in report_frames(enriched, state_a, state_b, years).items():
        written[name] = write_report(frame, out_dir, name)
    if with_models:
        written["model_comparison"] = write_report(
            model_comparison(model_rows(enriched), partitions=fit_partitions), out_dir, "model_comparison"
        )
    return written


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Write every flight report's data.")
    parser.add_argument("--flights", nargs="+", required=True, help="yearly flight CSV paths or globs")
    parser.add_argument("--airports", required=True, help="airport lookup CSV")
    parser.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    parser.add_argument("--state-a", required=True)
    parser.add_argument("--state-b", required=True)
    parser.add_argument("--years", nargs="*", type=int, default=[])
    parser.add_argument("--models", action="store_true", help="also train and compare the classifiers")
    parser.add_argument("--fit-partitions", type=int, default=FIT_PARTITIONS, help="partitions the classifiers are fitted on")
    parser.add_argument("--shuffle-partitions", type=int, help="initial shuffle partitions (AQE shrinks)")
    parser.add_argument("--max-partition-bytes", help="input split size, e.g. 256m")
    parser.add_argument("--advisory-partition-bytes", help="post-shuffle partition size, e.g. 128m")
    args = parser.parse_args(argv)
    spark = build_session(
        "aerolens-reports",
        shuffle_partitions=args.shuffle_partitions,
        max_partition_bytes=args.max_partition_bytes,
        advisory_partition_bytes=args.advisory_partition_bytes,
    )
    for name, path in run_reports(
        spark, args.flights, args.airports, args.out, args.state_a, args.state_b,
        args.years, args.models, fit_partitions=args.fit_partitions,
    ).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
