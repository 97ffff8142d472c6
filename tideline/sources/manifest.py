"""Manifests: per table the newest folder, its write time and the total record count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "struct<cda_schema_id:string,cda_folder:string,cda_folder_tms:timestamp_ntz,total_records_count:bigint>"


def manifest_text(entry_columns: list[str], table_name: Column) -> Column:
    """One manifest document holding the entry of one table."""
    return F.to_json(F.create_map(table_name, F.struct(*entry_columns)))


def explode_manifests(documents: DataFrame, text: str = "value") -> DataFrame:
    """One row per table from documents of the form `{table: {entry}, ...}`."""
    tables = F.from_json(F.col(text), f"map<string,{ENTRY}>", {"mode": "FAILFAST"})
    return documents.select(F.explode(tables).alias("table_name", "entry")).select("table_name", "entry.*")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest document(s) at a path, one row per table."""
    return explode_manifests(spark.read.text(path, wholetext=True))
