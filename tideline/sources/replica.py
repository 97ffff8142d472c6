"""The system of record: table scans, row tags and column metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.context import RunContext


def replica_table(
    spark: SparkSession, url: str, table: str, bounds: tuple[int, int], partitions: int, properties: dict[str, str]
) -> DataFrame:
    """Id and version of one replica table over parallel range reads of the id."""
    return (
        spark.read.jdbc(
            url, table, column="id", lowerBound=bounds[0], upperBound=bounds[1],
            numPartitions=partitions, properties=properties,
        )
        .select("id", "beanversion")
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """The frames stacked by name, halves first so that hundreds of tables stay a shallow plan."""
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return union_all(frames[:middle]).unionByName(union_all(frames[middle:]), allowMissingColumns=True)


def union_tagged(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One long frame of many tables, each row tagged with its table name."""
    return union_all([frame.withColumn("table_name", F.lit(name)) for name, frame in tables.items()])


def read_tagged(spark: SparkSession, root: str, names: Sequence[str], schema: StructType) -> DataFrame:
    """One scan over the folders of many tables that share the given columns. The tag comes
    from the file path, so the number of tables adds nothing to the plan."""
    base = root.rstrip("/")
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    files = reader.parquet(*[f"{base}/{name}" for name in names])
    level = len(base.split("://", 1)[-1].strip("/").split("/"))
    inside = F.regexp_replace(F.col("_metadata.file_path"), r"^[a-z0-9]+:/*", "")
    return files.withColumn("table_name", F.element_at(F.split(inside, "/"), level + 1))


def tag_replica(rows: DataFrame, ctx: RunContext, schema_name: str) -> DataFrame:
    """Replica rows with the comparison key; the version is compared as text."""
    return rows.select(
        ctx.batch.alias("batch_id"),
        F.lit(schema_name.upper()).alias("schema_name"),
        F.upper("table_name").alias("table_name"),
        F.col("id").alias("replica_id"),
        F.col("beanversion").cast("string").alias("replica_beanversion"),
    )


def column_metadata(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns of the given tables, as an information schema would list them."""
    rows = [
        (name.upper(), field.name.upper(), position)
        for name, frame in tables.items()
        for position, field in enumerate(frame.schema.fields, 1)
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, ordinal_position int")


def catalog_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The tables of a catalog database by name."""
    return {t.name: spark.table(f"{database}.{t.name}") for t in spark.catalog.listTables(database)}
