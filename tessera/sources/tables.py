"""Readers and writers: tab-separated sources, ground truth, metrics, submissions."""

from __future__ import annotations

import json
import math
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_COLUMNS = ("entity_id", "business_name", "business_address", "country")
SOURCE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in SOURCE_COLUMNS])
TRUTH_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])

# Strings that a source reader takes for null.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
    "None", "n/a", "nan", "null"
]


#: A column that sorts rows as their files have them.
PLACE = "_place_"


def read_rows(spark: SparkSession, path: str, schema: T.StructType, quoted_lines: bool, place: bool) -> DataFrame:
    """Rows of a file with a header; columns that a short row lacks are null. place: with the column PLACE.

    Files are split among tasks, a row a line. Where quoted fields hold line ends, quoted_lines reads each file in one
    task; without it a line that leaves a quote open is an error.
    """
    torn = "_torn_"
    df = spark.read.schema(T.StructType([*schema.fields, T.StructField(torn, T.StringType())])).csv(
        path, sep="\t", header=True, quote='"', escape='"', multiLine=quoted_lines, mode="PERMISSIVE", columnNameOfCorruptRecord=torn)
    first, *others = [F.col(f.name) for f in schema.fields]
    if not quoted_lines:
        line = F.col(torn)
        open_quote = (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1
        message = F.concat(F.lit("a quoted field goes on in the next line, read with quoted_lines=True: "), line)
        first = F.when(open_quote, F.raise_error(message)).otherwise(first).alias(schema.fields[0].name)
    if place:
        others.append(
            F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row")).alias(PLACE)
        )
    return df.select(first, *others)


def read_tsv(
    spark: SparkSession, path: str, nrows: int | None = None, na: bool = True, quoted_lines: bool = False, place: bool = False
) -> DataFrame:
    """A source with its four string columns; null tokens become null. nrows takes the first rows of one file."""
    df = read_rows(spark, path, SOURCE_SCHEMA, quoted_lines, place)
    if nrows is not None:
        df = df.limit(nrows)
    if na:
        df = df.withColumns({c: F.when(~F.col(c).isin(NA_TOKENS), F.col(c)) for c in SOURCE_COLUMNS})
    return df


def load_sources(spark: SparkSession, directory: str, prefix: str, nrows: int | None = None, place: bool = False) -> dict[str, DataFrame]:
    return {f"source{n}": read_tsv(spark, f"{directory}/{prefix}_source{n}.tsv", nrows, place=place) for n in (1, 2, 3)}


def reference_union(source2: DataFrame, source3: DataFrame) -> DataFrame:
    """Both searched sources, tagged."""
    return source2.withColumn("record_source", F.lit("source2")).unionByName(source3.withColumn("record_source", F.lit("source3")))


def load_reference_sources(spark: SparkSession, directory: str, prefix: str, nrows: int | None = None, place: bool = False) -> DataFrame:
    sources = load_sources(spark, directory, prefix, nrows, place)
    return reference_union(sources["source2"], sources["source3"])


def parse_ids(ids: Column) -> Column:
    """A comma-joined string to the distinct, stripped, non-empty ids in it."""
    strip = lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(ids, F.lit("")), ","), strip), lambda x: x != ""))


def load_ground_truth(spark: SparkSession, path: str, quoted_lines: bool = False) -> DataFrame:
    """(source1_entity_id, matched array<string>); empty sets stay, and of a repeated id the last row of the file wins."""
    df = read_rows(spark, path, TRUTH_SCHEMA, quoted_lines, place=True)
    return df.groupBy("source1_entity_id").agg(F.max_by(parse_ids(F.col("matched_entity_ids")), PLACE).alias("matched"))


def truth_pairs(truth: DataFrame) -> DataFrame:
    return truth.select("source1_entity_id", F.explode("matched").alias("candidate_entity_id"))


def profile(df: DataFrame) -> DataFrame:
    """Rows and nulls of each column, as (column, n_rows, n_nulls)."""
    one = df.agg(F.count("*").alias("n_rows"), *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])
    stacked = ", ".join(f"'{c}', coalesce(`{c}`, 0)" for c in df.columns)
    return one.selectExpr("n_rows", f"stack({len(df.columns)}, {stacked}) as (column, n_nulls)").select("column", "n_rows", "n_nulls")


def country_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("country").agg(F.count("*").alias("n_rows"))


def require_unique(df: DataFrame, key: str = "entity_id") -> DataFrame:
    """df, after a check that fails on a repeated key."""
    repeated = df.groupBy(key).count().where("count > 1").limit(5).collect()
    if repeated:
        raise ValueError(f"{key} is not unique: {[r[0] for r in repeated]}")
    return df


def unique_rows(df: DataFrame, keep: str = "error", key: str = "entity_id") -> DataFrame:
    """df with one row a key: "first" or "last" by PLACE, "error" fails on a repeated key, "any" takes df as it is.

    The column PLACE of a frame that was read with it is dropped.
    """
    if keep not in ("error", "first", "last", "any"):
        raise ValueError("keep: error, first, last or any")
    if keep in ("error", "any"):
        return (require_unique(df, key) if keep == "error" else df).drop(PLACE)
    row = F.struct(*[c for c in df.columns if c != PLACE])
    pick = (F.min_by if keep == "first" else F.max_by)("row", PLACE).alias("row")
    return df.select(F.col(key).alias("key"), row.alias("row"), PLACE).groupBy("key").agg(pick).select("row.*")


def inspect_dataset(spark: SparkSession, root: str, nrows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Of all sources of root/train and root/test: rows and nulls by column, and rows by country."""
    profiles, countries = [], []
    for part in ("train", "test"):
        for name, df in load_sources(spark, f"{root}/{part}", part, nrows).items():
            tags = {"part": F.lit(part), "source": F.lit(name)}
            profiles.append(profile(df).withColumns(tags))
            countries.append(country_counts(df).withColumns(tags))
    return reduce(DataFrame.unionByName, profiles), reduce(DataFrame.unionByName, countries)


def write_tsv(df: DataFrame, path: str, single: bool = False) -> None:
    """Tab-separated with a header, empty strings written as nothing; single: one part file."""
    (df.coalesce(1) if single else df).write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="", nullValue="")


def write_json(record: dict, directory: str, spark: SparkSession) -> str:
    """An experiment record as JSON through Spark's file system; NaN becomes null."""
    def plain(x):
        if isinstance(x, dict):
            return {str(k): plain(v) for k, v in x.items()}
        if isinstance(x, (list, tuple)):
            return [plain(v) for v in x]
        if isinstance(x, float) and not math.isfinite(x):
            return None
        return x if isinstance(x, (str, int, float, bool, type(None))) else str(x)

    path = f"{directory}/experiment_{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}.json"
    spark.createDataFrame([(json.dumps(plain(record), ensure_ascii=False),)], "value string").coalesce(1).write.text(path)
    return path
