"""Decorated functions of source files as rows."""

from __future__ import annotations

import ast
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ship_package


def scan_functions(spark: SparkSession, path: str, decorator: str = "tool") -> DataFrame:
    """file, name, first and last line, argument names, first line of the docstring and hash of each function
    that carries ``decorator``; a file that doesn't parse gives one row with its error."""
    ship_package(spark)
    files = spark.read.text(path, wholetext=True).withColumn("file", F.col("_metadata.file_path"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for text, file in zip(part.value, part.file, strict=True):
                try:
                    tree = ast.parse(text)
                except SyntaxError as error:
                    rows.append((file, None, None, None, None, None, None, str(error)))
                    continue
                for node in ast.walk(tree):
                    names = [ast.unparse(d.func if isinstance(d, ast.Call) else d).split(".")[-1] for d in getattr(node, "decorator_list", [])]
                    if isinstance(node, ast.FunctionDef | ast.AsyncFunctionDef) and decorator in names:
                        source = ast.get_source_segment(text, node) or ""
                        doc = (ast.get_docstring(node) or "").split("\n")[0]
                        rows.append((file, node.name, node.lineno, node.end_lineno, ",".join(a.arg for a in node.args.args), doc, hashlib.sha256(source.encode()).hexdigest(), None))
            yield pd.DataFrame(rows, columns=["file", "name", "first_line", "last_line", "arguments", "doc", "sha256", "error"])

    return files.select("value", "file").mapInPandas(run, "file string, name string, first_line int, last_line int, arguments string, doc string, sha256 string, error string")
