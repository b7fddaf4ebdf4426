"""Start a stage from the command line: ``python -m tarmac <stage> --help``.

Sessions come from ``spark-submit`` or the environment; ``--master`` sets one for a
machine of one's own. Stages skip the months that are complete unless ``--overwrite``."""

from __future__ import annotations

import argparse
import json

from tarmac import jobs
from tarmac.session import get_session


def _month(text: str) -> str:
    year, _, month = text.partition("-")
    if not (len(year) == 4 and year.isdigit() and month.isdigit() and 1 <= int(month) <= 12):
        raise argparse.ArgumentTypeError(f"not a month (YYYY-MM): {text}")
    return f"{year}-{int(month):02d}"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tarmac", description="Flight-delay pipeline stages on Spark.")
    p.add_argument("--master", help="Spark master, e.g. local[8]; default: that of the environment")
    stages = p.add_subparsers(dest="stage", required=True)

    def stage(name: str, text: str, months: bool = True) -> argparse.ArgumentParser:
        s = stages.add_parser(name, help=text, description=text)
        if months:
            s.add_argument("--start", type=_month, required=True, help="first month, YYYY-MM")
            s.add_argument("--end", type=_month, required=True, help="last month, YYYY-MM")
        return s

    def stations(s: argparse.ArgumentParser, required: bool) -> None:
        s.add_argument("--airports", required=required, help="airport file")
        s.add_argument("--stations", required=required, help="station dictionary (JSON)")
        s.add_argument("--stations-cache", help="Parquet copy of the station dictionary")

    s = stage("ingest", "land monthly flight files and station weather as Parquet")
    s.add_argument("--flights-csv", nargs="+", required=True, help="files, folders or patterns")
    s.add_argument("--flights", required=True, help="root of the landed flights")
    s.add_argument("--weather-files", nargs="+", help="station files, folders or patterns")
    s.add_argument("--weather", help="root of the landed weather")
    stations(s, False)
    s.add_argument("--coverage", action="store_true", help="also count flights with weather")
    s.add_argument("--overwrite", action="store_true")
    s = stage("features", "attach the nearest weather to every departure")
    s.add_argument("--flights", required=True)
    s.add_argument("--weather", help="root of the landed weather")
    s.add_argument("--weather-files", nargs="+", help="station files, if weather is not landed")
    stations(s, True)
    s.add_argument("--features", required=True, help="root of the features")
    s.add_argument("--drop-without-weather", action="store_true", help="inner instead of left join")
    s.add_argument("--hour-basis", choices=["session", "airport"], default="session")
    s.add_argument("--checks", help="folder for row count, busiest origins and earliest rows")
    s.add_argument("--overwrite", action="store_true")
    s = stage("eda", "every exploratory table, reading new months only")
    s.add_argument("--features", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--min-flights", type=int, default=5000)
    s = stage("baseline", "30-day averages and elastic net: train months start..end, one test month")
    s.add_argument("--features", required=True)
    s.add_argument("--test-month", type=_month, required=True)
    s.add_argument("--out")
    s.add_argument("--history", help="folder of kept totals, so that train rows are read once")
    for name, text in (("ridge", "90-day averages and ridge path"), ("trees", "boosted trees")):
        s = stage(name, text, months=False)
        s.add_argument("--features", required=True)
        s.add_argument("--out", required=True)
    return p


def _months(start: str, end: str) -> list[tuple[int, int]]:
    a, b = (int(m[:4]) * 12 + int(m[5:]) - 1 for m in (start, end))
    return [(k // 12, k % 12 + 1) for k in range(a, b + 1)]


def run(args: argparse.Namespace, spark) -> object:
    if getattr(args, "start", "") > getattr(args, "end", ""):
        raise ValueError(f"--start {args.start} lies after --end {args.end}")
    if args.stage == "ingest":
        return jobs.ingest_range(spark, args.flights_csv, args.flights, args.start, args.end, overwrite=args.overwrite,
                                 weather_files=args.weather_files, weather_root=args.weather, airports_csv=args.airports,
                                 stations_json=args.stations, stations_cache=args.stations_cache, do_coverage=args.coverage)
    if args.stage == "features":
        return jobs.build_features_range(spark, args.flights, args.weather_files, args.airports, args.stations, args.features,
                                         args.start, args.end, overwrite=args.overwrite, hour_basis=args.hour_basis,
                                         how="inner" if args.drop_without_weather else "left", stations_cache=args.stations_cache,
                                         weather_root=args.weather, checks_dir=args.checks)
    if args.stage == "eda":
        year, month = _months(args.end, args.end)[0]
        after = f"{year + month // 12}-{month % 12 + 1:02d}-01"
        return jobs.write_eda(spark, args.features, args.out, f"{args.start}-01", after, min_flights=args.min_flights)
    if args.stage == "baseline":
        return jobs.train_baseline(spark, args.features, _months(args.start, args.end), _months(args.test_month, args.test_month)[0], args.out,
                                   history_root=args.history)
    job = jobs.train_ridge if args.stage == "ridge" else jobs.train_trees
    return [r.asDict() for r in job(spark, args.features, args.out).collect()]


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = get_session(args.master)
    try:
        print(json.dumps(run(args, spark), default=str))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
