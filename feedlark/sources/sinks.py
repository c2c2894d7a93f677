"""Writers: parquet, periods and keyed JSON objects, published only when whole; external tables.

Every writer fills a staging folder beside its target, counts the rows of each file that lies there, compares their
sum with the rows that were handed to the files, and only then moves the folder to its place with a manifest (file,
rows) in `_manifest`. Rows are counted in the stage that writes, where a task counts once however often it or what is
before it is run. A write that fails leaves the target as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedlark.operators.tables import group_comments

MANIFEST = "_manifest"  # readers skip names that begin so


class WriteError(RuntimeError):
    """The rows found after a write are not the rows that were written."""


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def _per_file(table: DataFrame) -> DataFrame:
    """(file, rows): the rows of every file of a table, counted where they lie; names without the folder."""
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    return table.groupBy(name.alias("file")).agg(F.sum(F.lit(1)).alias("rows"))


def _staged(df: DataFrame, path: str, write: Callable, read: Callable[[str], DataFrame], verify: bool = True) -> str:
    """Writes into a folder beside `path`, which holds all rows and a manifest when it is returned."""
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    system, at = _files(spark, staging)
    try:
        seen = Observation()
        write(df.observe(seen, F.count(F.lit(1)).alias("rows")), staging)
        if verify:
            _per_file(read(staging)).coalesce(1).write.json(f"{staging}/{MANIFEST}")
            manifest = spark.read.schema("file string, rows long").json(f"{staging}/{MANIFEST}")
            found = manifest.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
            if found != seen.get["rows"]:
                raise WriteError(f"{staging} holds {found} rows, {seen.get['rows']} were written")
    except BaseException:
        system.delete(at(staging), True)
        raise
    return staging


def _publish(spark: SparkSession, staging: str, path: str) -> None:
    system, at = _files(spark, path)
    system.delete(at(path), True)
    system.mkdirs(at(path).getParent())
    if not system.rename(at(staging), at(path)):
        raise WriteError(f"{staging} is whole, but could not be moved to {path}")


def check_manifest(spark: SparkSession, path: str, table: DataFrame) -> None:
    """Raises if a file that the last write left is gone or has other rows. `table` is what is read at `path`."""
    manifest = spark.read.schema("file string, rows long").json(f"{path}/{MANIFEST}")
    lost = manifest.join(_per_file(table), ["file", "rows"], "left_anti").limit(5).collect()
    if lost:
        raise WriteError(f"{path} lacks {[(r['file'], r['rows']) for r in lost]}")


def write_parquet(
    df: DataFrame,
    path: str,
    compression: str = "gzip",
    single_file: bool = False,
    max_records_per_file: int = 0,
    verify: bool = True,
) -> DataFrame:
    """Replace the table at `path` and read it back.

    Counting the result reads only file footers. `single_file` puts the whole write in one task: only for small
    reports.
    """
    spark = df.sparkSession
    read = lambda place: spark.read.schema(df.schema).parquet(place)

    def write(out: DataFrame, place: str) -> None:
        out.write.option("compression", compression).option("maxRecordsPerFile", max_records_per_file).parquet(place)

    _publish(spark, _staged(df.repartition(1) if single_file else df, path, write, read, verify), path)
    return read(path)


def write_by_period(df: DataFrame, path: str, period: str = "period") -> DataFrame:
    """Write one folder per period and replace only the periods present in `df`.

    The rebalance step splits a period that holds much of the data over several tasks. The manifest is that of
    the last write, whatever other periods lie there.
    """
    spark = df.sparkSession
    read = lambda place: spark.read.schema(df.schema).parquet(place)
    staging = _staged(df.hint("rebalance", period), path, lambda out, place: out.write.partitionBy(period).parquet(place), read)
    system, at = _files(spark, path)
    system.mkdirs(at(path))
    for folder in system.listStatus(at(staging)):  # one for each period, and the manifest
        name = folder.getPath().getName()
        if folder.isDirectory():
            system.delete(at(f"{path}/{name}"), True)
            if not system.rename(folder.getPath(), at(f"{path}/{name}")):
                raise WriteError(f"{staging}/{name} is whole, but could not be moved to {path}")
    system.delete(at(staging), True)
    return read(path)


def _write_json(df: DataFrame, path: str) -> None:
    """One object per line; a line is a row."""
    spark = df.sparkSession
    write = lambda out, place: out.write.option("ignoreNullFields", False).json(place)
    _publish(spark, _staged(df, path, write, spark.read.text), path)


def write_text_items(comments: DataFrame, path: str, chunk_rows: int = 1_000) -> None:
    """Write (id, pos, text) as one `{"TextItem": {id: [text, …]}}` object per line."""
    chunks = group_comments(comments, chunk_rows=chunk_rows)
    _write_json(chunks.select(F.create_map("id", "texts").alias("TextItem")), path)


def write_catalog(products: DataFrame, path: str) -> None:
    """Write products as one `{"Product": {id: [name, category, price]}}` object per line."""
    fields = F.array("product_name", "product_category", F.col("price").cast("string"))
    _write_json(products.select(F.create_map("product_id", fields).alias("Product")), path)


def external_table(spark: SparkSession, name: str, schema: str, path: str) -> DataFrame:
    """Declare a table over a result folder (kept if it exists) and check its columns."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING PARQUET LOCATION '{path}'")
    table = spark.table(name)
    wanted = spark.createDataFrame([], schema).dtypes
    if table.dtypes != wanted:
        raise WriteError(f"table {name} has columns {table.dtypes}, not {wanted}")
    return table
