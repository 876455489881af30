"""Business records projected from `documents`: name, address and country from its words, source from its source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import reference_union

# The beginning of a text with the 18 words that the projection takes.
WORDS = "^(?:[^a-zA-Z0-9]*+[a-zA-Z0-9]++){0,18}+"


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, business_name, business_address, country, record_source, truth_key of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = F.regexp_extract("text", WORDS, 0)  # no column asks for a later word
    words = F.filter(F.split(F.lower(F.regexp_replace(first, "[^a-zA-Z0-9]+", " ")), " "), lambda x: x != "")
    docs = docs.select(
        "doc_id", "n_chars", "lang", words.alias("tk"), (F.regexp_extract("source", "([0-9]+)", 1).cast("int") % 3 + 1).alias("sno")
    )
    number = F.col("doc_id").cast("string")
    padded = F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(0), 6 - F.length(number))), number)
    some = lambda at, n: F.array_join(F.slice("tk", at, n), " ")
    return docs.select(
        F.concat(F.lit("S"), F.col("sno"), F.lit("-"), padded).alias("entity_id"), some(1, 4).alias("business_name"),
        F.concat(F.col("n_chars").cast("string"), F.lit(" "), some(5, 8)).alias("business_address"), F.col("lang").alias("country"),
        F.concat(F.lit("source"), F.col("sno")).alias("record_source"), some(13, 6).alias("truth_key"))


def source(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    return entities(spark, sf_dir).where(F.col("record_source") == f"source{n}").drop("record_source", "truth_key")


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_union(source(spark, sf_dir, 2), source(spark, sf_dir, 3))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source1_entity_id, matched): records of the other sources with the same country and non-empty truth key."""
    e = entities(spark, sf_dir).select("entity_id", "country", "truth_key", "record_source")
    one = e.where("record_source = 'source1'").withColumnRenamed("entity_id", "source1_entity_id").drop("record_source")
    others = e.where("record_source <> 'source1' and truth_key <> ''").drop("record_source")
    found = one.join(others, ["country", "truth_key"], "left")
    return found.groupBy("source1_entity_id").agg(F.collect_set("entity_id").alias("matched"))
