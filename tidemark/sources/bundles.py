"""Directories of cases and bundles of tools as tables, and bundles written as tagged records or as a readable text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a case must have, and the text of which only the beginning is shown.
REQUIRED = ("metadata.json", "generation_config.json", "basic_statistics.json")
DICTIONARY = "data_dictionary.md"
TOOL = "record_type string, tool_name string, name string, factory_function string, handler_function string, category string, schema_name string, description string, permission_name string, source_file string, start_line long, implementation_source string"


def _folder(path: Column, root: str) -> Column:
    """A file's place below ``root``, so the case's folder and the rest."""
    return F.split(F.substring_index(path, f"{root.rstrip('/').split('/')[-1]}/case_", -1), "/", 2)


def read_cases(spark: SparkSession, root: str, wanted: list[str] = (), most: int | None = None, excerpt: int = 3000) -> DataFrame:
    """case, metadata, generation_config, basic_statistics (JSON texts), dictionary_excerpt, files (of ``wanted``) and missing.

    A case is a folder below ``root`` whose name starts with case_.  ``missing`` names the required files that aren't
    there or aren't JSON; ``most`` keeps the first cases by name.  Only the four texts are read, other files are listed.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/case_*").select("path")
    files = listing.select(F.concat(F.lit("case_"), _folder(F.col("path"), root)[0]).alias("case"), _folder(F.col("path"), root)[1].alias("file"))
    there = files.groupBy("case").agg(F.array_sort(F.collect_set(F.when(F.col("file").isin(*wanted), F.col("file")))).alias("files"))
    texts = spark.read.option("wholetext", "true").text([f"{root}/case_*/*.json", f"{root}/case_*/*.md"]).select(F.concat(F.lit("case_"), _folder(F.col("_metadata.file_path"), root)[0]).alias("case"), _folder(F.col("_metadata.file_path"), root)[1].alias("file"), "value")
    of = lambda name: F.max(F.when(F.col("file") == name, F.col("value")))
    json_of = lambda name: F.to_json(F.try_parse_json(of(name)))
    read = texts.groupBy("case").agg(*[json_of(r).alias(r.removesuffix(".json")) for r in REQUIRED], F.substring(of(DICTIONARY), 1, excerpt).alias("dictionary_excerpt"))
    met = there.join(read, "case", "left")
    missing = F.array_compact(F.array(*[F.when(F.col(r.removesuffix(".json")).isNull(), F.lit(r)) for r in REQUIRED]))
    kept = met if most is None else met.join(F.broadcast(there.select("case").orderBy("case").limit(most)), "case", "left_semi")
    return kept.withColumn("missing", missing)


def read_tools(spark: SparkSession, path: str, schema_text: str = "", use_text: str = "") -> DataFrame:
    """The tools of a bundle: name, type, input, use_when, permission_name and source_file.

    A path that ends in .jsonl has a record a line, of which those of the type tool count; any other is one JSON object
    with a list ``tools``.  The name is the first of tool_name, name and factory_function that isn't empty; tools without
    any stay out.  ``schema_text`` and ``use_text`` ({category} in it) stand where a schema or description is missing.
    """
    if path.endswith(".jsonl"):
        rows = spark.read.schema(TOOL).json(path).where("record_type = 'tool'")
    else:
        rows = spark.read.schema(f"tools array<struct<{', '.join(f.replace(' ', ': ', 1) for f in TOOL.split(', '))}>>").option("multiLine", "true").json(path).select(F.inline("tools"))
    filled = lambda *names: F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in names])
    kind = F.coalesce("category", F.lit("tool"))
    told = F.replace(F.lit(use_text), F.lit("{category}"), kind)
    named = rows.withColumn("n", filled("tool_name", "name", "factory_function")).where("n IS NOT NULL")
    return named.select(F.col("n").alias("name"), kind.alias("type"), F.coalesce(filled("schema_name"), F.lit(schema_text)).alias("input"), F.coalesce(filled("description"), told).alias("use_when"), "permission_name", "source_file")


def bundle_rows(tools: DataFrame, modules: DataFrame, supporting: DataFrame) -> DataFrame:
    """One table of the tools, module sources and supporting sources, each with its record_type; absent columns are null."""
    tagged = [df.withColumn("record_type", F.lit(kind)) for kind, df in (("tool", tools), ("module_source", modules), ("supporting_source", supporting))]
    return tagged[0].unionByName(tagged[1], allowMissingColumns=True).unionByName(tagged[2], allowMissingColumns=True)


def _fenced(text: Column) -> Column:
    return F.concat(F.lit("\n```python\n"), F.coalesce(text, F.lit("")), F.lit("\n```\n"))


def tool_section(line: str = "- {label}: {value}") -> Column:
    """A tool as a section of a text: its name, what is known of it, its source."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    at = F.concat(shown("source_file"), F.lit(":"), shown("start_line"))
    quoted = lambda c: F.concat(F.lit("`"), c, F.lit("`"))
    about = {"Category": quoted(shown("category")), "Factory": quoted(shown("factory_function")), "Handler": quoted(shown("handler_function")), "Source": quoted(at), "Schema": quoted(shown("schema_name")), "Description": shown("description")}
    one = lambda label, value: F.replace(F.replace(F.lit(line), F.lit("{label}"), F.lit(label)), F.lit("{value}"), value)
    return F.concat(F.lit("### "), quoted(shown("permission_name")), F.lit("\n\n"), F.concat_ws("\n", *[one(k, v) for k, v in about.items()]), F.lit("\n"), _fenced(F.col("implementation_source")))


def source_section() -> Column:
    return F.concat(F.lit("### `"), F.coalesce("path", F.lit("")), F.lit("`\n"), _fenced(F.col("source_code")))


def bundle_sections(tools: DataFrame, modules: DataFrame, supporting: DataFrame) -> DataFrame:
    """part, place and text of each section: tools by permission_name, then module sources, then supporting ones by path."""
    own = tools.select(F.lit(0).alias("part"), F.col("permission_name").alias("place"), tool_section().alias("text"))
    rest = [df.select(F.lit(part).alias("part"), F.col("path").alias("place"), source_section().alias("text")) for part, df in ((1, modules), (2, supporting))]
    return own.unionByName(rest[0]).unionByName(rest[1])


def write_bundle(path: str, form: str, tools: DataFrame, modules: DataFrame, supporting: DataFrame) -> None:
    """A folder with the bundle as tagged JSON lines (jsonl) or as sections in their order (markdown): files sorted by range, none whole in one task."""
    if form == "jsonl":
        bundle_rows(tools, modules, supporting).write.mode("overwrite").json(path)
    elif form == "markdown":
        ordered = bundle_sections(tools, modules, supporting).orderBy("part", "place", "text")
        ordered.select("text").write.mode("overwrite").text(path)
    else:
        raise ValueError(f"no form {form!r}; there are jsonl and markdown")
