"""Jobs for ``spark-submit``: ``land`` turns raw files into the landed sources, ``check`` reports on the landed sources; ``clean``, ``star``, ``gold`` or ``all`` refresh.

    spark-submit --py-files caudal.zip caudal/jobs.py all --landing s3a://bucket/bronze --root s3a://bucket/lake --year 2024
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from caudal.operators.filters import Audit
from caudal.plans import ingest, landed
from caudal.plans.refresh import Layers, read_model, refresh_clean, refresh_gold, refresh_star, require_resolved_keys
from caudal.sources.writers import with_audit, write_table

STEPS = ("clean", "star", "gold")


def run(spark: SparkSession, step: str, root: str, landing: str | None = None, year: int | None = None, month: int | None = None,
        countries: Sequence[str] | None = None, allow_unresolved: bool = False) -> dict[str, dict[str, int]]:
    """Run one step or all; returns the rows written per table. ``countries``: of the climate source, by default all that landed.

    The clean step adds to the table ``audit/clean`` how many rows each cleaning step dropped.
    """
    layers = Layers(root)
    written = {}
    for name in STEPS if step == "all" else (step,):
        if name == "clean":
            if landing is None:
                raise ValueError("the clean step needs a landing root")
            audit = Audit()
            written[name] = refresh_clean(layers, landed.cleaned(spark, landing, countries, year, audit), year, month)
            period = [F.lit(p).cast("int").alias(n) for n, p in (("year", year), ("month", month))]
            write_table(with_audit(audit.report(spark).select(*period, "*")), layers.path("audit", "clean"), "append")
        elif name == "star":
            written[name] = refresh_star(spark, layers, year)
        else:
            if not allow_unresolved:
                require_resolved_keys(read_model(spark, layers))
            written[name] = refresh_gold(spark, layers)
    return written


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("step", choices=("land", "check", *STEPS, "all"))
    parser.add_argument("--raw", help="where raw files lie, for land")
    parser.add_argument("--root", help="where the clean, model and gold layers live")
    parser.add_argument("--landing", help="where the sources land")
    parser.add_argument("--year", type=int)
    parser.add_argument("--month", type=int)
    parser.add_argument("--countries", nargs="+", help="climate folders to read; none of them may be missing")
    parser.add_argument("--allow-unresolved", action="store_true", help="compute indicators although facts have unresolved keys")
    parser.add_argument("--report", help="where check stores its report")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"caudal-{args.step}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.step == "land":
        if not (args.raw and args.landing):
            parser.error("land needs --raw and --landing")
        print(json.dumps(ingest.land(spark, args.raw, args.landing)))
        return
    if args.step == "check":
        if not args.landing:
            parser.error("check needs --landing")
        report = landed.report(spark, args.landing, args.countries)
        if args.report:
            write_table(report, args.report)
        else:
            report.show(1000, truncate=False)  # one row per check
        return
    if not args.root:
        parser.error("a refresh needs --root")
    print(json.dumps(run(spark, args.step, args.root, args.landing, args.year, args.month, args.countries, args.allow_unresolved)))


if __name__ == "__main__":
    main()
