"""A corpus pipeline of five of the training-data operators, each stage on all that the stage before it kept.

language ID -> exact dedup -> SimHash near-dedup -> suffix-array dedup -> packing. All stages but the last return the
columns of documents. Rows are told apart by a number of their own, so doc_id may be null or repeated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import language
from tessera.llm.common import discard, fresh, in_arrow, scratch, written
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.packing import pack
from tessera.llm.queries import tokenizer_path
from tessera.llm.simhash import simhash_near_dedup
from tessera.llm.substring import PASSAGE, PASSAGE_WORDS, without_repeats


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a number for each row that stays its own, and the column's name.

    A row of a file is numbered by its file and its place there. Any other frame, where a row of a file may be several
    rows by now, is written first. The list of files is broadcast; the driver holds one for every scan anyway.
    """
    row, path, at = (fresh(name, docs.columns) for name in ("tessera_row", "tessera_path", "tessera_at"))
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation" or not docs.inputFiles():
        return scratch(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row
    rows = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(at))
    files = rows.select(path).distinct().withColumn(row, F.row_number().over(Window.orderBy(path)).cast("long"))
    rows = rows.join(F.broadcast(scratch(files, "files")), path)
    return rows.select(*docs.columns, (F.shiftleft(row, 40) + F.col(at)).alias(row)), row


def one_of_each(docs: DataFrame, grouped: Callable[[DataFrame], DataFrame], keeper: Callable[[str], Column]) -> DataFrame:
    """Of each group of rows one row stays, the one that `keeper` gives; grouped: (doc_id a row's number, text) to group.

    What is joined with the documents is the list of rows to drop.
    """
    rows, row = numbered(docs)
    with written() as tables:
        groups = grouped(rows.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias("n"), "group")
        found = scratch(rows.select(F.col(row).alias("n"), "doc_id").join(groups, "n"), "found")
        keepers = found.groupBy("group").agg(keeper("n").alias("keeper"), F.count("*").alias("size"))
        keepers = scratch(keepers.where("size > 1").select("group", F.col("keeper.n").alias("keeper")), "keepers")
        dropped = scratch(found.join(keepers, "group").where("n <> keeper").select("n"), "dropped")
    discard(*tables[:-1])
    return rows.join(
        dropped.withColumnRenamed("n", fresh("n", rows.columns)), F.col(row) == F.col(fresh("n", rows.columns)), "left_anti"
    ).select(*docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language: null, or without a letter, also where none was learned. Other columns stay."""
    net = language.fit(docs, ~language.held_out())
    return docs.transform(in_arrow, language.determined(net), docs.schema)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row with the largest doc_id stays; a null doc_id only where no other has the text."""
    return one_of_each(docs, lambda rows: exact_dedup(rows).withColumn("group", F.col("keep_id")), lambda n: F.max(F.struct("doc_id", n)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints one row with the smallest doc_id stays; a null doc_id only without another."""
    return one_of_each(
        docs, lambda rows: simhash_near_dedup(rows).withColumn("group", F.col("component_id")),
        lambda n: F.min(F.struct(F.col("doc_id").isNull(), "doc_id", n))
    )


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of fifty words or 400 bytes are cut out; every document stays, with n_chars of what is left."""
    out = without_repeats(docs, width=PASSAGE, words=PASSAGE_WORDS)
    return out.withColumn(
        "n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    ) if "n_chars" in docs.columns else out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids, as pieces with their CRC-32."""
    return pack(docs, tokenizer_path("word_bpe_49k.json"), digest=True)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("packing", pack_sequences),
]

#: Language ID, fingerprints and tokenizers are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done: list[DataFrame] = []
    for _, stage in STAGES[:-1]:
        with written() as tables:
            docs = scratch(stage(spark, docs, sf_dir), "stage")
        discard(*done, *tables[:-1])
        done = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
