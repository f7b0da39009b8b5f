"""Readers: typed tables, delimited lines, text corpora, landed pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def truth(c: Column | str) -> Column:
    """Text booleans: true, 1 and yes in any case."""
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c)).isin("true", "1", "yes")


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text columns to a schema. A blank is null, a bad value is null, never an error."""
    out = []
    for f in schema.fields:
        raw = F.nullif(F.trim(F.col(f"`{f.name}`")), F.lit(""))
        if isinstance(f.dataType, T.BooleanType):
            out.append(F.when(raw.isNotNull(), truth(raw)).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(F.coalesce(F.col(f"`{f.name}`"), F.lit("")).alias(f.name))
        else:
            out.append(raw.try_cast(f.dataType).alias(f.name))
    return df.select(*out)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row, quoted newlines and an optional byte-order mark."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")
    raw = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    present = [f.name for f in schema.fields if f.name in raw.columns]
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    raw = raw.select(*present, *[F.lit(None).cast("string").alias(m) for m in missing])
    return typed(raw, schema)


def read_corpus(spark: SparkSession, glob: str) -> DataFrame:
    """Text files named ``<doc>_<file>.txt`` as (doc_id, file_name, text)."""
    return (
        spark.read.text(glob, wholetext=True)
        .withColumn("file_name", F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1))
        .withColumn("doc_id", F.regexp_extract("file_name", r"^([^_]+)_", 1).try_cast("long"))
        .select("doc_id", "file_name", F.col("value").alias("text"))
    )


def first_file(corpus: DataFrame) -> DataFrame:
    """The file that stands for each document: the first in name order."""
    return corpus.groupBy("doc_id").agg(
        F.min("file_name").alias("file_name"),
        F.min_by("text", "file_name").alias("text"),
    )


def read_pages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed pages of a paged interface, one JSON document per line."""
    return spark.read.schema(schema).json(path)


def read_typography(spark: SparkSession, glob: str) -> DataFrame:
    """Typeset lines: ``font TAB size TAB down TAB text``; older files lack the third field."""
    full = r"^([^\t]*)\t([0-9.]+)\t([0-9.]+)\t(.*)$"
    short = r"^([^\t]*)\t([0-9.]+)\t(.*)$"
    raw = spark.read.text(glob)
    is_full = F.col("value").rlike(full)
    return raw.select(
        F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1).alias("file_name"),
        F.regexp_extract("value", short, 1).alias("font"),
        F.regexp_extract("value", short, 2).try_cast("double").alias("size"),
        F.coalesce(
            F.when(is_full, F.regexp_extract("value", full, 3)).try_cast("double"), F.lit(-1.0)
        ).alias("down"),
        F.when(is_full, F.regexp_extract("value", full, 4))
        .otherwise(F.regexp_extract("value", short, 3))
        .alias("text"),
    ).where(F.col("font") != "")


# Fixed value.
LINE = r"^(\d{2})-(\d{2})-(\d{4}) ~ (.+?) ~ (.+)$"


def parse_lines(lines: DataFrame, after: Column, value: str = "value") -> DataFrame:
    """``DD-MM-YYYY ~ body ~ title`` lines: kept, older than the cut-off, or malformed."""
    v = F.trim(value)
    tabled = F.to_date(
        F.try_to_timestamp(
            F.concat_ws(
                "-",
                F.regexp_extract(v, LINE, 1),
                F.regexp_extract(v, LINE, 2),
                F.regexp_extract(v, LINE, 3),
            ),
            F.lit("d-M-yyyy"),
        )
    )
    return lines.select(
        "*",
        tabled.alias("tabled"),
        F.trim(F.regexp_extract(v, LINE, 4)).alias("body"),
        F.trim(F.regexp_extract(v, LINE, 5)).alias("title"),
    ).withColumn(
        "outcome",
        F.when(F.col("tabled").isNull(), "malformed")
        .when(F.col("tabled") > after, "kept")
        .otherwise("before the cut-off"),
    )
