"""Record streams: strict and lenient JSON lines, directories of manifests, strict JSON out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_strict(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines; the first line that isn't a record of the schema fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_lenient(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Good records and bad lines of JSON lines, with the file each is from."""
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    lines = spark.read.text(path).where("trim(value) <> ''").withColumn("_file", F.col("_metadata.file_path"))
    parsed = lines.withColumn("r", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("r._bad").isNotNull()
    return parsed.where(~bad).select(*[f"r.{f.name}" for f in schema], "_file"), parsed.where(bad).select("_file", F.col("value").alias("_bad"))


def read_nested(spark: SparkSession, path: str, pattern: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines of all files below ``path`` whose names fit ``pattern``."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).json(path)


def read_manifests(spark: SparkSession, path: str, schema: T.StructType | str, key: str) -> DataFrame:
    """Records of <path>/<id>/manifest.json whose id is their folder's name."""
    rows = spark.read.schema(schema).option("multiLine", "true").json(f"{path}/*/manifest.json")
    folder = F.element_at(F.split(F.input_file_name(), "/"), -2)
    return rows.withColumn("_folder", folder).where(F.col(key) == F.col("_folder")).drop("_folder")


def finite(schema: T.StructType) -> list[Column]:
    """The columns with NaN and infinite numbers as null, as strict JSON wants them."""
    out = []
    for f in schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType | T.FloatType):
            c = F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
        out.append(c.alias(f.name))
    return out


def write_strict(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.select(*finite(df.schema)).write.mode(mode).json(path)


def embedded_pairs(text: Column) -> Column:
    """question and answer of a JSON object in a text that may lack its outer braces."""
    kind = "struct<question:string,answer:string>"
    bare, braced = F.from_json(text, kind), F.from_json(F.concat(F.lit("{"), text, F.lit("}")), kind)
    return F.when(bare["question"].isNotNull(), bare).otherwise(braced)


def first_series(text: Column) -> Column:
    """The first bracketed list of numbers in a text."""
    lists = F.regexp_extract_all(text, F.lit(r"\[[-+0-9.eE,\s]{6,5000}\]"), F.lit(0))
    return F.get(F.filter(F.transform(lists, lambda x: F.from_json(x, "array<double>")), lambda x: x.isNotNull() & (F.size(x) > 0)), 0)


def contiguous_prefix(df: DataFrame, index: str) -> DataFrame:
    """Rows of the longest run 1..N of ``index`` without a gap, found from the least missing number."""
    have = df.select(index).distinct()
    gap = have.select((F.col(index) + 1).alias(index)).unionByName(df.sparkSession.createDataFrame([(1,)], f"{index} long")).distinct().join(have, index, "left_anti")
    least = gap.where(F.col(index) >= 1).agg(F.min(index).alias("gap"))
    return df.join(F.broadcast(least)).where((F.col(index) >= 1) & (F.col(index) < F.col("gap"))).drop("gap")


def read_csv_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header whose fields may hold line breaks and quoted JSON."""
    return spark.read.schema(schema).options(header="true", multiLine="true", quote='"', escape='"', mode="FAILFAST").csv(path)


def verify_files(files: DataFrame, path: str, name: str = "name", digest: str = "sha256") -> DataFrame:
    """For each expected file whether it is below ``path`` and whether its SHA-256 is the recorded one."""
    spark = files.sparkSession
    there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    found = there.select(F.element_at(F.split("path", "/"), -1).alias(name), F.sha2("content", 256).alias("__found"))
    joined = files.join(found, name, "left")
    return joined.select(*files.columns, F.col("__found").isNotNull().alias("exists"), F.coalesce(F.col("__found") == F.col(digest), F.lit(False)).alias("intact"))
