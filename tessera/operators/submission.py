"""One row per query entity: its candidates and its matches as sorted, comma-joined ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import write_tsv


def joined_ids(source1: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    lists = pairs.groupBy("source1_entity_id").agg(F.array_join(F.array_sort(F.collect_set("candidate_entity_id")), ",").alias(name))
    return source1.select(
        F.col("entity_id").alias("source1_entity_id")
    ).join(lists, "source1_entity_id", "left").withColumn(name, F.coalesce(name, F.lit("")))


def submission_frames(source1: DataFrame, pairs: DataFrame, scored: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    matches = scored.where(F.col("match_probability") >= threshold)
    return joined_ids(source1, pairs, "candidate_entity_ids"), joined_ids(source1, matches, "matched_entity_ids")


def write_submission(source1: DataFrame, pairs: DataFrame, scored: DataFrame, directory: str, threshold: float) -> tuple[str, str]:
    candidates, matches = submission_frames(source1, pairs, scored, threshold)
    paths = f"{directory}/candidate_pairs.tsv", f"{directory}/matching_results.tsv"
    for frame, path in zip((candidates, matches), paths, strict=True):
        write_tsv(frame.orderBy("source1_entity_id"), path)
    return paths
