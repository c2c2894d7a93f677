"""Readers for the raw inputs: keyed JSON objects, review CSVs, parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlark import runtime, schemas
from feedlark.operators.tables import keep_first, normalise_strings

# The fields that a CSV reader of the Python data stack takes for missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


class SourceError(ValueError):
    """A source does not have the layout it should have."""


def read_objects(spark: SparkSession, path: str, key: str, kind: str, pattern: str = "*.json") -> DataFrame:
    """Objects `{key: …}` of all JSON files of a folder: the key's value, file, block and line, which
    order the objects.

    A file holds one object per line, which lets Spark split it, or one object or array of objects over
    several lines. Every line is read as text and tried; a file with a line that is no object by itself is put
    together again from its lines, by their places, and read as a whole in its own row. Files are told apart by joins on
    their names, and no list of them is made outside Spark. A damaged file raises when it is read.
    """
    lines = spark.read.option("pathGlobFilter", pattern).text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    schema = f"array<struct<{key}: {kind}>>"
    lines = lines.filter(F.trim("value") != "").withColumn("found", F.from_json("value", schema))
    broken = F.col("found").isNull()
    first = F.min_by("value", F.when(broken, F.struct("block", "line")))
    whole = F.count_if(F.exists("found", lambda x: x[key].isNotNull()))
    odd = lines.groupBy("file").agg(first.alias("broken"), whole.alias("whole")).filter("broken is not null")
    if odd.isEmpty():
        return lines.select(F.inline("found"), "file", "block", "line")
    odd = runtime.materialise(odd.select("file", ((F.col("whole") > 0) & ~F.startswith(F.ltrim("broken"), F.lit("["))).alias("damaged")), "files")
    by_line = lines.join(odd, "file", "left_anti").select(F.inline("found"), "file", "block", "line")
    parts = lines.join(odd, "file").groupBy("file", "damaged").agg(
        F.sort_array(F.collect_list(F.struct("block", "line", "value"))).alias("parts")
    )
    text = F.when(F.col("damaged"), F.raise_error(F.concat(F.lit("objects and damaged lines in "), "file"))).otherwise(
        F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    )
    objects = F.from_json(text, schema, {"mode": "FAILFAST"})
    several = parts.select(F.posexplode(objects).alias("at", "object"), "file").select(
        f"object.{key}", "file", F.lit(0).cast("long").alias("block"), F.col("at").cast("long").alias("line")
    )
    return by_line.unionByName(several)


def read_text_items(spark: SparkSession, path: str, strict: bool = True, pattern: str = "*.json") -> DataFrame:
    """Posts kept as `{"TextItem": {id: [comment, …]}}`: one row (id, texts) per id and object.

    The ids are map keys and not columns, so their number, their case and repeated ids do not
    matter. A value may be a list or a single value, which becomes a string. A folder without any
    `TextItem` raises, or is returned as it is with `strict=False`.
    """
    raw = read_objects(spark, path, "TextItem", "map<string, variant>", pattern)
    items = raw.filter(F.col("TextItem").isNotNull())
    if items.isEmpty() and not raw.isEmpty():
        if strict:
            raise SourceError(f"no TextItem object in the JSON files of {path}")
        return spark.read.option("multiLine", True).option("pathGlobFilter", pattern).json(path)
    many = F.try_variant_get("value", "$", "array<string>")
    one = F.array_compact(F.array(F.try_variant_get("value", "$", "string")))
    listed = F.startswith(F.schema_of_variant("value"), F.lit("ARRAY"))
    return items.select(F.explode("TextItem").alias("id", "value")).select(
        "id", F.when(listed, many).otherwise(one).alias("texts")
    )


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Products kept as `{"Product": {id: [name, category, price]}}`, of all files of a folder.

    Strings are normalised; of several products with one id, the first by file name, object and place
    stays. An object without `Product` raises.
    """
    raw = read_objects(spark, path, "Product", "map<string, array<string>>")
    if not raw.filter(F.col("Product").isNull()).isEmpty():
        raise SourceError(f"an object without Product in the JSON files of {path}")
    rows = raw.select("file", "block", "line", F.posexplode("Product").alias("pos", "product_id", "v")).select(
        "file",
        "block",
        "line",
        "pos",
        "product_id",
        F.get("v", F.lit(0)).alias("product_name"),
        F.get("v", F.lit(1)).alias("product_category"),
        F.get("v", F.lit(2)).try_cast("double").alias("price"),
    )
    rows = normalise_strings(rows, skip=("file",))
    order = ["file", "block", "line", "pos"]
    return keep_first(rows, ["product_id"], order).select(*schemas.names(schemas.PRODUCTS))


def _missing(c: str) -> Column:
    return F.when(F.col(c).isin(NULL_TOKENS), None).otherwise(F.col(c))


def read_reviews_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Review CSVs of a folder (or one file): 5 columns by position, whatever the header says.

    A file of another width raises: the first one here, the others when their rows are read.
    Quoted fields may hold line breaks, so a file is one task; write many files, not a large one.
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("pathGlobFilter", "*.csv")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    wanted = schemas.names(schemas.RAW_REVIEWS)
    fields = reader.schema(schemas.RAW_REVIEWS).option("mode", "FAILFAST").csv(path)
    if fields.inputFiles():
        found = spark.read.option("header", True).option("pathGlobFilter", "*.csv").csv(path).columns
        if len(found) != len(wanted):
            raise SourceError(f"{path} has {len(found)} columns, not {len(wanted)}: {found}")
    fields = fields.select(*[_missing(c).alias(c) for c in wanted])
    return fields.withColumn("rating", F.col("rating").try_cast("double"))


def read_table(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """A parquet file, folder or glob."""
    return spark.read.option("recursiveFileLookup", recursive).parquet(path)
