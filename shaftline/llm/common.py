"""Helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shaftline.sources.scratch import scratch_path

# White space that separates words, as a character class for Java and Python.
SPACE = r"[\x20\x09-\x0D]"
TOKENIZERS = os.environ.get("SHAFTLINE_TOKENIZERS", "")


def tokenizer_path(name: str) -> str:
    """Where the vocabulary file ``name`` is: in ``$SHAFTLINE_TOKENIZERS``, or in
    the package of public vocabularies installed beside the library."""
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def words(text: str | None) -> list[bytes]:
    """Runs of anything but space and the controls 9 to 13, in UTF-8; ``split``
    of bytes parts at exactly those six."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """``words`` with A-Z lowered; ``lower`` of bytes leaves other letters alone."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new shared folder and read back.

    Later jobs start from the files: a lost executor costs no recomputation,
    and row ids given on the way stay as they are.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def find_library(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package without installing it.

    A cluster gets it with ``--py-files`` or an installed package; the extra
    entry does no harm there.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        environment["PYTHONPATH"] = f"{root}:{known}" if known else root


def map_arrow(
    df: DataFrame,
    per_batch: Callable[[pa.RecordBatch], Iterator[dict[str, object]]],
    schema: str | T.StructType,
) -> DataFrame:
    """``df.mapInArrow`` for a function from one batch to columns of any number
    of batches."""
    find_library(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in per_batch(batch):
                yield pa.RecordBatch.from_pydict(columns)
        # The worker lives on, for tasks of other operators.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def of_bounded_size(
    batch: pa.RecordBatch, column: str = "text", size: int = 4_000_000
) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of ``column`` each, one row at
    least, so that working memory follows the longest text and not the batch."""
    texts = batch.column(batch.schema.get_field_index(column))
    start, held = 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        if held and held + (n or 0) > size:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def fingerprint(text: Column) -> Column:
    """Tells apart texts of rows that share an id."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def keep_documents(docs: DataFrame, kept: DataFrame, text_key: Column) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, ``text_key``) is in ``kept(doc_id, text_key)``.

    Rows that repeat an id and a text are one document: the first one stays.
    They are looked for only where ``kept`` counts them (``copies`` > 1), and
    collapse in each task before they are shuffled.
    """
    key, id_ = "__text_key", "__doc_id"
    wanted = kept.select(
        F.col("doc_id").alias(id_), F.col("text_key").alias("__wanted"), "copies"
    )
    keyed = docs.withColumn(key, text_key)

    def among(rows: DataFrame) -> DataFrame:
        same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(key) == F.col("__wanted"))
        return keyed.join(rows, same, "left_semi")

    single = among(wanted.where("copies = 1"))
    repeated = wanted.where("copies > 1")
    if repeated.isEmpty():
        return single.drop(key)
    once = among(repeated).dropDuplicates(["doc_id", key])
    return single.unionByName(once).drop(key)
