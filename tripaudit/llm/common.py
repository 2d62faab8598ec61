"""What several of these operators share: tables, kept intermediate results, word rules."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripaudit.session import drop_scratch, scratch_dir

# The separators of words, and the same class for Java's regex.
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_REGEX = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Rolling:
    """The newest of a row of kept states; the one before is deleted when the next is written."""

    def __init__(self, df: DataFrame, label: str):
        self.spark, self.label, self.path = df.sparkSession, label, None
        self.step(df)

    def step(self, df: DataFrame) -> None:
        path = scratch_dir(self.spark, self.label)
        df.write.parquet(path)
        before, self.path = self.path, path
        self.df = self.spark.read.schema(df.schema).parquet(path)
        if before:
            drop_scratch(self.spark, before)

    def drop(self) -> None:
        """Delete the newest state as well."""
        drop_scratch(self.spark, self.path)


def lower_ascii(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z lower-cased and nothing else; null is empty."""
    return text.encode("utf-8", "surrogatepass").lower() if text else b""


def let(value: Column, body) -> Column:
    """Bind ``value`` once inside ``body`` (an inlined expression would be evaluated per element)."""
    return F.transform(F.array(value), body)[0]


def words_column(text: Column) -> Column:
    """Native array of the words of a text; null and blank texts give an empty array."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_REGEX))


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)
