"""Build the bike-share lake: ``python -m lakeloom ROOT [step ...]``, or the same with spark-submit.

Steps are raw, silver, gold_bi, gold_ml and check; without any, all run and
failed checks stop the build before the next layer.  ``check=TABLE`` checks
one table.
"""

from __future__ import annotations

import argparse

from lakeloom.operators.quality import ChecksFailed, require_passed
from lakeloom.plans.trips_lakehouse import CHECKS, Build
from lakeloom.session import build_session
from lakeloom.sources.layers import Lake

STEPS = ("raw", "silver", "gold_bi", "gold_ml")


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lakeloom", description=__doc__)
    parser.add_argument("root", help="folder with source/, gets raw/, stg/, mart_bi/ and mart_ml/")
    parser.add_argument("steps", nargs="*", help="raw silver gold_bi gold_ml check check=TABLE")
    parser.add_argument("--master", help="Spark master; left to the cluster if not given")
    parser.add_argument("--numbering", choices=("dense", "ordered", "unique"), default="dense")
    parser.add_argument("--partition-years", action="store_true")
    options = parser.parse_args(arguments)
    tables = {f"check={name}": (name,) for name in CHECKS}
    unknown = [s for s in options.steps if s not in (*STEPS, "check") and s not in tables]
    if unknown:
        parser.error(f"unknown steps: {' '.join(unknown)}")
    spark = build_session(master=options.master)
    build = Build(spark, Lake(options.root), options.numbering, options.partition_years)
    try:
        if not options.steps:
            build.run()
        for step in options.steps:
            if step in STEPS:
                getattr(build, step)()
            else:
                require_passed(build.checks(tables.get(step)))
    except ChecksFailed as failure:
        print(f"failed checks: {failure}")
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
