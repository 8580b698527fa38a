"""``python -m pointloom --input points.csv --output folder [--config job.yaml] [--k 3] [--seed 1]
[--schema "x double, y double, z double"] [--format parquet] [--reference LAT LON]``"""

from __future__ import annotations

import argparse
import sys

from pointloom.plans.cluster_job import run_job
from pointloom.session import get_spark
from pointloom.sources import preview


def read_config(path: str) -> dict:
    """Keys ``input_path``, ``output_path`` and ``reference_point`` (``lat``, ``lon``)."""
    import yaml  # only needed with --config

    with open(path) as file:
        return yaml.safe_load(file) or {}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="pointloom", description="Cluster a table of points")
    parser.add_argument("--config", help="YAML file with input, output and reference point")
    parser.add_argument("--input", help="path or URI of the points, by default a CSV with a header")
    parser.add_argument("--output", help="folder or URI for results.csv and metrics.json")
    parser.add_argument("--schema", help="columns and types of the input, saves inferring them")
    parser.add_argument("--format", default="csv", help="format of the input (csv, parquet, ...)")
    parser.add_argument("--k", type=int, default=3, help="number of clusters")
    parser.add_argument("--seed", type=int, default=1, help="seed of the start")
    parser.add_argument(
        "--reference", type=float, nargs=2, metavar=("LAT", "LON"), help="point that distances are to"
    )
    args = parser.parse_args(argv)

    config = read_config(args.config) if args.config else {}
    source = args.input or config.get("input_path")
    output = args.output or config.get("output_path")
    point = config.get("reference_point") or {"lat": 0.0, "lon": 0.0}
    reference = args.reference or (point["lat"], point["lon"])
    if not source:
        print("error: give --input, or input_path in --config", file=sys.stderr)
        return 1

    job = run_job(
        get_spark(),
        source,
        output,
        reference=tuple(reference),
        k=args.k,
        seed=args.seed,
        schema=args.schema,
        file_format=args.format,
    )
    print(f"features: {', '.join(job.features.columns)}")
    print(f"silhouette: {'undefined' if job.score is None else job.score}")
    preview(job.labelled).show()
    return 0


if __name__ == "__main__":
    sys.exit(main())
