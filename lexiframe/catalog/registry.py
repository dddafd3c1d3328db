"""Helpers shared by the query modules."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Registry:
    """Collects queries and their SQL by name."""

    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        def register(query):
            self.queries[name] = query
            if sql is not None:
                self.sql[name] = sql
            return query

        return register


#: Setting with the number of partitions to spread scanned tables over; by default a scan stays as it is.
SCAN_PARTITIONS = "lexiframe.scan.partitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    n = spark.conf.get(SCAN_PARTITIONS, None)
    return found.repartition(int(n)) if n else found
