"""Sinks: each is one distributed write; nothing but short templates is rendered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_features(features: DataFrame, path: str) -> None:
    """One GeoJSON collection per city: ``path/city=<code>/``. Lines of a city are written by one ordered task; a city is a bounded set of areas."""
    head = '{"type":"FeatureCollection","features":['
    numbered = features.groupBy("city").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("code", "feature"))), lambda x: x["feature"]), ",\n").alias("body"))
    numbered.select("city", F.concat(F.lit(head), "body", F.lit("]}")).alias("value")).write.mode("overwrite").partitionBy("city").text(path)


def write_envelope(records: DataFrame, cells: DataFrame, boxes: DataFrame, path: str) -> None:
    """The cross-site index: records, city cells and boxes as three JSON tables below ``path``."""
    for name, df in (("records", records), ("counts_by_city", cells), ("not_counted", boxes)):
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/{name}")


def write_rejects(rejects: DataFrame, path: str) -> None:
    rejects.write.mode("overwrite").option("header", True).csv(path)


def write_pages(pages: DataFrame, path: str) -> None:
    """One row per page, partitioned so that a page's file is found by its code's city."""
    pages.select(F.substring("code", 1, 5).alias("city"), "path", F.col("html")).write.mode("overwrite").partitionBy("city").json(path)


def append_manifest(entries: DataFrame, path: str) -> None:
    """Append a run's entries; runs are partitions, earlier ones are never touched."""
    entries.write.mode("append").partitionBy("run_no").parquet(path)


def store_observation(rows: DataFrame, bad: DataFrame, path: str) -> None:
    """All or nothing: refuse if any row is invalid, never overwrite what is there."""
    if bad.limit(1).count():
        raise ValueError("invalid rows; nothing is written")
    rows.write.mode("errorifexists").parquet(path)


def write_findings(findings: DataFrame, path: str) -> None:
    findings.repartitionByRange("kind", "where", "item").sortWithinPartitions("kind", "where", "item").write.mode("overwrite").json(path)


def write_town_list(areas: DataFrame, path: str) -> None:
    """Normalized town names per city, sorted and distinct."""
    areas.select("city_code", F.col("key").alias("town")).distinct().repartitionByRange("city_code", "town").sortWithinPartitions("city_code", "town").write.mode("overwrite").json(path)
