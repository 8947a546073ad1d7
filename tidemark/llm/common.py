"""Helpers shared by the training-data operators: shared-folder tables, folds, words, Arrow passes."""

from __future__ import annotations

import gc
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import ship_package

#: Rows of one Arrow batch: whole texts travel in them, and a task's Python worker and JVM hold several batches.
BATCH_ROWS = 512

#: Bytes of a text to words: A-Z lower-cased, other ASCII but digits and letters to blanks, the rest kept.
WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(raw: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text after lower-casing A-Z."""
    return raw.translate(WORD_TABLE).split()


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return f"file://{tempfile.mkdtemp(prefix='tidemark-shared-')}"


def checkpoint_root(spark: SparkSession) -> str:
    """Folder that the whole cluster shares; only a local session without one (tests) gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = _own_folder()
    return root.rstrip("/")


#: Folders of the tables that materialise wrote, by the id of their frames' plans.
_WRITTEN: dict[int, str] = {}


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    It cuts the lineage, so a lost executor costs no more than the tasks of the later stage, and what
    follows sees one fixed result however often it is read.  ``discard`` deletes such tables.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/tidemark-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[id(table)] = path
    weakref.finalize(table, _WRITTEN.pop, id(table), None)
    return table


def discard(*tables: DataFrame) -> None:
    """Delete what ``materialise`` wrote for these frames; nothing that still reads them may run afterwards."""
    for table in tables:
        path = _WRITTEN.pop(id(table), None)
        if path:
            jvm = table.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of work that is done: it finds them when the driver collects its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Whether crc32 of the id as text is 2 modulo 4; a null id is not held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _share(df: DataFrame, key: str, share: float) -> DataFrame:
    """About that share of the rows by a hash of ``key``: the same at every run and partitioning."""
    if share >= 1:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))


def bounded_sample(df: DataFrame, key: str, text: str, max_bytes: int) -> DataFrame:
    """Rows of ``df`` with about ``max_bytes`` of ``text`` together; all if they fit.

    The share follows from the bytes there are, so what is gathered stays bounded at any size.
    """
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return _share(df, key, max_bytes / max(total, 1))


#: Labels that a sample joins to documents at most: so many ids are broadcast.
SAMPLE_LABELS = 100_000


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, max_bytes: int) -> DataFrame:
    """``docs`` (key and text) with the columns of ``labels`` (a row for each key), of about ``max_bytes`` of text.

    The labels are thinned first, to as many as documents of the mean size make up ``max_bytes`` and to
    SAMPLE_LABELS at most; so bounded, they are broadcast and the texts stay where they are.
    """
    docs = docs.select(key, text)
    mean = docs.agg(F.avg(F.octet_length(text))).first()[0] or 1.0
    rows = min(max_bytes / max(mean, 1.0), SAMPLE_LABELS)
    return docs.join(F.broadcast(_share(labels, key, rows / max(labels.count(), 1))), key)


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's rows of an Arrow batch to BATCH_ROWS.

    Spark reads the setting when a plan runs, not when it is made, so it can't be put back here.
    """
    bound = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < bound <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def map_text(
    df: DataFrame,
    text: str,
    outputs: T.StructType,
    make: Callable[[], Callable[[list[bytes | None]], list[list]]],
    keep: list[str] | None = None,
    *,
    as_is: bool = False,
) -> DataFrame:
    """Append columns that a Python function makes from the UTF-8 bytes of ``text`` (its values if ``as_is``).

    ``make`` is called once for each task and returns the function of a batch: bytes (or None) in,
    a list for each output column out.  ``keep`` names the columns carried along (all by default);
    output columns replace carried ones of the same name.
    """
    spark = df.sparkSession
    ship_package(spark)
    bound_batches(spark)
    new = {f.name.lower() for f in outputs}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    name = "fed"  # Spark looks columns up by name, so this one must be new
    while name in {c.lower() for c in kept}:
        name += "_"
    fed = df.select(*[F.col(f"`{c}`") for c in kept], (F.col(f"`{text}`") if as_is else F.col(f"`{text}`").cast("binary")).alias(name))
    schema = T.StructType([*fed.schema.fields[:-1], *outputs.fields])
    arrow = [(f.name, _arrow(f.dataType)) for f in outputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            if not batch.num_rows:
                continue
            made = fn(batch.column(batch.num_columns - 1).to_pylist())
            columns = [*batch.columns[:-1], *(pa.array(v, t) for v, (_, t) in zip(made, arrow, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], *(n for n, _ in arrow)])

    return fed.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
