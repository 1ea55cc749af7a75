"""Runs a registered query and writes its result: ``python -m evidlake release_rollup --tables DIR --out DIR --format csv``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from evidlake import catalogue
from evidlake.sources import writers


@dataclass(frozen=True)
class Job:
    """What to run, on which tables, and where the result goes (nowhere: it is shown)."""

    query: str
    tables: str
    out: str = ""
    format: str = "parquet"
    show: int = 20

    def run(self, spark: SparkSession) -> DataFrame:
        found = catalogue.queries()
        if self.query not in found:
            raise ValueError(f"no query named {self.query}; there are {', '.join(sorted(found))}")
        df = found[self.query](spark, self.tables)
        if not self.out:
            df.show(self.show, truncate=60)
        elif self.format == "csv":
            writers.csv(df, self.out, df.columns)
        elif self.format == "json":
            writers.json_lines(df, self.out)
        else:
            writers.table(df, self.out)
        return df


def parse(args: Sequence[str] | None = None) -> Job:
    p = argparse.ArgumentParser(prog="evidlake", description=__doc__)
    p.add_argument("query")
    p.add_argument("--tables", required=True, help="folder of the input tables")
    p.add_argument("--out", default="", help="folder of the result")
    p.add_argument("--format", choices=("parquet", "csv", "json"), default="parquet")
    p.add_argument("--show", type=int, default=20, help="rows to show where no folder is given")
    return Job(**vars(p.parse_args(args)))


if __name__ == "__main__":
    session = SparkSession.builder.getOrCreate()
    parse().run(session)
    session.stop()
