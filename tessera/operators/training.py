"""Labels, sampling, group split, the classifier, and its storage."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import listed
from . import boosting
from .features import COMPARED, FEATURE_COLUMNS, laid, places


def label_pairs(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """pairs with target 1.0 where the truth has the pair, else 0.0."""
    true = truth.select("source1_entity_id", F.explode("matched").alias("candidate_entity_id")).withColumn("hit", F.lit(1.0))
    return pairs.join(
        true, ["source1_entity_id", "candidate_entity_id"], "left"
    ).withColumn("target", F.coalesce("hit", F.lit(0.0))).drop("hit")


def label_lists(lists: DataFrame, truth: DataFrame) -> DataFrame:
    """label_pairs of (source1_entity_id, candidates), so that lists meet the truth and no pair is dealt out."""
    true = truth.groupBy("source1_entity_id").agg(F.flatten(F.collect_list("matched")).alias("matched"))
    joined = lists.join(true, "source1_entity_id", "left")
    hits = F.coalesce(F.array_intersect("candidates", "matched"), F.array().cast("array<string>")).alias("hits")
    rows = joined.select("source1_entity_id", "candidates", hits)
    rows = rows.select("source1_entity_id", F.explode_outer("candidates").alias("candidate_entity_id"), "hits")
    return rows.select("source1_entity_id", "candidate_entity_id", F.array_contains("hits", F.col("candidate_entity_id")).cast("double").alias("target"))


def held_out(test_share: float = 0.2, seed: int = 42) -> Column:
    digest = F.md5(F.concat(F.col("source1_entity_id"), F.lit(f"/{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 10_000 < round(test_share * 10_000)


def split_by_source1(rows: DataFrame, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows; no entity is in both."""
    held = held_out(test_share, seed)
    return rows.where(~held), rows.where(held)


def sample_reference(reference: DataFrame, positives: DataFrame, n: int, sources: tuple[str, ...] = ("source2", "source3")) -> DataFrame:
    """All positives, and of each source the first n other records by id; a limit, so every task hands on n rows at most."""
    ids = positives.select(F.col("candidate_entity_id").alias("entity_id")).distinct()
    others = reference.join(ids, "entity_id", "left_anti")
    first = [others.where(F.col("record_source") == s).orderBy("entity_id").limit(n) for s in sources]
    return reduce(DataFrame.unionByName, first, reference.join(ids, "entity_id", "left_semi"))


def thin_negatives(labelled: DataFrame, per_entity: int = 5) -> DataFrame:
    """All positives and the first negatives of each entity, before any feature is computed."""
    w = Window.partitionBy("source1_entity_id").orderBy("target", "candidate_entity_id")  # negatives come first; one pass over the pairs
    return labelled.withColumn("at", F.row_number().over(w)).where((F.col("target") == 1) | (F.col("at") <= per_entity)).drop("at")


def class_balance(labelled: DataFrame) -> DataFrame:
    positive, negative = F.sum((F.col("target") == 1).cast("long")), F.sum((F.col("target") == 0).cast("long"))
    return labelled.agg(
        F.countDistinct("target").alias("n_classes"), F.coalesce(positive, F.lit(0)).alias("n_positive"),
        F.coalesce(negative, F.lit(0)).alias("n_negative")
    ).withColumn("positive_weight", F.least(F.col("n_negative") / F.greatest(F.lit(1), "n_positive"), F.lit(10.0)))


@dataclass
class ModelBundle:
    model: boosting.Forest
    feature_columns: list[str]
    best_threshold: float = 0.8


def coded(columns: dict[str, np.ndarray], names: list[str]) -> np.ndarray:
    return np.stack([boosting.codes_of(columns[c], c.endswith("_difference")) for c in names])


def packed_rows(training: DataFrame) -> DataFrame:
    """Rows of features and target as the learner takes them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
            target = columns["target"] == 1
            yield packed(False, None, target, coded(columns, FEATURE_COLUMNS))

    return training.select(*FEATURE_COLUMNS, F.col("target").cast("double")).mapInArrow(run, boosting.PACKED)


def packed(held: bool, pairs: bytes | None, target: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
    row = [held, len(target), int(target.sum()), pairs, boosting.pressed(target.astype(np.uint8)), boosting.pressed(codes)]
    names = ["held", "n", "positives", "pairs", "labels", "codes"]
    kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)


def packed_lists(source1: DataFrame, reference: DataFrame, lists: DataFrame, truth: DataFrame) -> DataFrame:
    """The features and labels of all pairs of (source1_entity_id, candidates), in rows of many pairs as the learner takes them.

    Queries are dealt into groups by country, and each group gets one copy of every record that it has as a candidate, as
    in `features.paired`; a group's features are made by arrays.
    """
    spark = lists.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    true = truth.groupBy("source1_entity_id").agg(F.flatten(F.collect_list("matched")).alias("matched"))
    hits = F.coalesce(F.array_intersect("candidates", "matched"), F.array().cast("array<string>")).alias("hits")
    sides = lambda df: df.select("entity_id", *[F.col(c).alias(k) for k, c in COMPARED.items()])
    group = F.hash("country", F.pmod(F.xxhash64("source1_entity_id"), F.lit(parts))).alias("group")
    left = lists.join(true, "source1_entity_id", "left").select("source1_entity_id", "candidates", hits)
    left = left.join(sides(source1).withColumnRenamed("entity_id", "source1_entity_id"), "source1_entity_id")
    left = left.select("*", group, held_out().alias("held"))
    left = left.repartition(4 * parts, "group").persist()  # both sides come from it, and it is not dealt out again
    wanted = left.select(F.col("group").alias("asked"), F.explode("candidates").alias("entity_id")).distinct()
    right = wanted.join(sides(reference), "entity_id")

    def run(mine: pa.Table, other: pa.Table) -> pa.Table:
        mine = mine.sort_by([("held", "ascending"), ("source1_entity_id", "ascending")]).combine_chunks()
        rows, starts, hit = met(mine, other.combine_chunks())
        names = pa.chunked_array(mine["source1_entity_id"]).combine_chunks()
        ids = pa.chunked_array(other["entity_id"]).combine_chunks()
        held = mine["held"].to_numpy()
        values = [{k: table[k].to_pylist() for k in COMPARED} for table in (mine, other)]
        out = []
        for first, end, columns in listed.features(*values, starts, rows):
            codes = coded(columns, FEATURE_COLUMNS)
            change = first + int(np.searchsorted(held[first:end], True))  # queries held out come last
            for low, high in ((first, change), (change, end)):
                at = slice(starts[low], starts[high])
                if at.start == at.stop:
                    continue
                query = pa.DictionaryArray.from_arrays(pa.array(np.repeat(np.arange(high - low, dtype=np.int32), np.diff(starts[low : high + 1]))), names[low:high])
                pairs = pa.RecordBatch.from_arrays([query, ids.take(pa.array(rows[at]))], ["source1_entity_id", "candidate_entity_id"])
                here = slice(at.start - starts[first], at.stop - starts[first])
                out.append(packed(bool(held[low]), pressed_pairs(pairs), hit[at], codes[:, here]))
        return pa.Table.from_batches(out, SCHEMA)

    return left.groupBy("group").cogroup(right.groupBy("asked")).applyInArrow(run, boosting.PACKED)


SCHEMA = pa.schema([
    ("held", pa.bool_()), ("n", pa.int64()), ("positives", pa.int64()), ("pairs", pa.binary()), ("labels", pa.binary()), ("codes", pa.binary())
])


def met(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The right rows of the candidates of all left rows (every row of an id), where each left row's begin, and whether they are hits."""
    lists, hits = (pa.chunked_array(left[c]).combine_chunks() for c in ("candidates", "hits"))
    coded_ids = pa.chunked_array(right["entity_id"]).combine_chunks().dictionary_encode()
    n = len(coded_ids.dictionary)
    found, owner = places(lists, coded_ids.dictionary)
    true, whose = places(hits, coded_ids.dictionary)
    hit = np.isin(owner * (n + 1) + found, whose * (n + 1) + true)
    return laid(owner, found, hit, coded_ids.indices.to_numpy().astype(np.int64), n, len(lists))


def pressed_pairs(pairs: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pairs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(pairs)
    return sink.getvalue().to_pybytes()


def positive_weight(n_positive: int, n_negative: int) -> float:
    if n_positive + n_negative == 0:
        raise ValueError("no training pairs")
    if not n_positive or not n_negative:
        raise ValueError("training pairs of both classes are needed")
    return min(n_negative / n_positive, 10.0)


def fit_packed(rows: DataFrame, rounds: int = 30, seed: int = 42) -> ModelBundle:
    """A model of the rows that are not held out; rows as boosting.dealt gives them."""
    total = rows.where("not held").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("positives"), F.lit(0)).alias("positives")).first()
    weight = positive_weight(total.positives, total.n - total.positives)
    return ModelBundle(boosting.fit(rows, len(FEATURE_COLUMNS), weight, rounds, seed), FEATURE_COLUMNS)


def score_packed(bundle: ModelBundle, rows: DataFrame) -> DataFrame:
    """source1_entity_id, candidate_entity_id, target and match_probability of all pairs, those held out too."""
    model, n_features = bundle.model, len(bundle.feature_columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, data, some, codes in zip(*(batch.column(c).to_pylist() for c in ("n", "pairs", "labels", "codes"))):
                pairs = pa.ipc.open_stream(data).read_all().combine_chunks()
                probability = model.probabilities(boosting.unpressed(codes, n * n_features).reshape(n_features, n))
                columns = [pairs["source1_entity_id"].combine_chunks().cast(pa.string()), pairs["candidate_entity_id"].combine_chunks()]
                columns += [pa.array(boosting.unpressed(some, n).astype(float)), pa.array(probability)]
                yield pa.RecordBatch.from_arrays(columns, ["source1_entity_id", "candidate_entity_id", "target", "match_probability"])

    schema = "source1_entity_id string, candidate_entity_id string, target double, match_probability double"
    return rows.select("n", "pairs", "labels", "codes").mapInArrow(run, schema)


def fit_model(training: DataFrame, rounds: int = 30, seed: int = 42) -> ModelBundle:
    """A model of rows with all features and the target."""
    rows = boosting.dealt(packed_rows(training))
    try:
        return fit_packed(rows, rounds, seed)
    finally:
        rows.unpersist()


def score(bundle: ModelBundle, features: DataFrame) -> DataFrame:
    """features with match_probability."""
    model, names = bundle.model, bundle.feature_columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = coded({c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}, names)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.probabilities(codes))], [*batch.schema.names, "match_probability"])

    fields = [T.StructField(f.name, f.dataType) for f in features.schema.fields]
    return features.mapInArrow(run, T.StructType([*fields, T.StructField("match_probability", T.DoubleType())]))


def save_model(bundle: ModelBundle, path: str, spark: SparkSession) -> None:
    meta = {"feature_columns": bundle.feature_columns, "best_threshold": bundle.best_threshold, "backend": "tessera-trees", "forest": bundle.model.text()}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata.json")


def load_model(path: str, spark: SparkSession) -> ModelBundle:
    meta = json.loads(spark.read.text(f"{path}/metadata.json").first().value)
    return ModelBundle(boosting.read_forest(meta["forest"]), meta["feature_columns"], meta["best_threshold"])
