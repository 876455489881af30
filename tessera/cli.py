"""Training and prediction over tab-separated sources."""

from __future__ import annotations

import argparse
import logging
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .functions.text import add_normalized_columns, add_sql_normalized_columns
from .operators import blocking, evaluation, features, submission, training
from .sources import tables

log = logging.getLogger("tessera")
ENGINES = ("priority", "priority_asymmetric", "inverted", "disk")


def candidates(
    source1: DataFrame, reference: DataFrame, raw_reference: DataFrame, engine: str, cap: int,
    config: blocking.BlockingConfig | None = None
) -> DataFrame:
    """Candidate pairs of normalized frames by one of ENGINES."""
    config = config or replace(blocking.DRIVER_CONFIG, max_candidates_per_entity=cap)
    if engine == "priority":
        return blocking.block_priority(source1, reference, cap)
    if engine == "priority_asymmetric":
        return blocking.block_priority(source1, add_sql_normalized_columns(raw_reference), cap)
    if engine in ("inverted", "disk"):
        return (blocking.block_inverted if engine == "inverted" else blocking.block_disk)(source1, reference, config)
    raise ValueError(f"engine: one of {ENGINES}")


class Progress:
    """Rows that each step of a driver hands on, counted as they pass."""

    def __init__(self) -> None:
        self.seen: dict[str, Observation] = {}

    def watch(self, step: str, df: DataFrame) -> DataFrame:
        self.seen[step] = Observation(step)
        return df.observe(self.seen[step], F.count(F.lit(1)).alias("rows"))

    def rows(self) -> dict[str, int]:
        """To be asked for when all steps have run."""
        out = {step: o.get["rows"] for step, o in self.seen.items()}
        log.info("rows by step: %s", out)
        return out


def train(
    spark: SparkSession, directory: str, out: str, sample: int | None = None, negatives: int | None = None,
    engine: str = "priority", cap: int = 300, rounds: int = 200, ids: str = "all", keep: str = "error"
) -> dict:
    """Fit and save a model, choose its threshold, save the experiment; returns the record.

    sample takes the first rows of source 1 and restricts the truth to them; negatives takes that many other records of
    each searched source. ids: "all" evaluates every held-out entity, "paired" only those with a candidate. keep: which
    row of a repeated id stays, see `unique_rows`.
    """
    source1 = tables.unique_rows(tables.read_tsv(spark, f"{directory}/train_source1.tsv", sample, place=True), keep)
    reference = tables.unique_rows(tables.load_reference_sources(spark, directory, "train", place=True), keep)
    truth = tables.load_ground_truth(spark, f"{directory}/train_ground_truth.tsv")
    truth = truth.join(source1.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")
    if negatives is not None:
        reference = training.sample_reference(reference, tables.truth_pairs(truth), negatives)
    left, right = add_normalized_columns(source1).persist(), add_normalized_columns(reference).persist()
    pairs = candidates(left, right, reference, engine, cap).persist()
    labelled = training.label_pairs(pairs, truth)
    thinned = labelled if sample else training.thin_negatives(labelled)
    made = features.build_pair_features(left, right, thinned).join(thinned, ["source1_entity_id", "candidate_entity_id"])
    fit, held = training.split_by_source1(made)
    bundle = training.fit_model(fit, rounds)
    scored = training.score(bundle, held)
    wanted = held if ids == "paired" else training.split_by_source1(left.select(F.col("entity_id").alias("source1_entity_id")))[1]
    sweep = evaluation.threshold_sweep(scored, truth, wanted.select("source1_entity_id").distinct())
    best = evaluation.best_threshold(sweep).first()
    if best is not None:
        bundle.best_threshold = best.threshold
    training.save_model(bundle, f"{out}/model", spark)
    record = {
        "blocking": blocking.blocking_stats(pairs, source1, reference).first().asDict() | blocking.blocking_recall(pairs, truth).first().asDict(),
        "balance": training.class_balance(thinned).first().asDict(), "best": best.asDict() if best else None,
        "sweep": [r.asDict() for r in sweep.orderBy("threshold").collect()], "engine": engine, "sample": sample,
    }
    tables.write_json(record, f"{out}/experiments", spark)
    for frame in (left, right, pairs):
        frame.unpersist()
    return record


def predict(
    spark: SparkSession, directory: str, model: str, out: str, prefix: str = "test", engine: str = "priority", cap: int = 500,
    threshold: float | None = None, nrows: int | None = None, keep: str = "error"
) -> tuple[str, str]:
    """Write candidate_pairs.tsv and matching_results.tsv; the threshold is the model's own unless one is given."""
    progress = Progress()
    bundle = training.load_model(model, spark)
    source1 = tables.unique_rows(tables.read_tsv(spark, f"{directory}/{prefix}_source1.tsv", nrows, place=True), keep)
    reference = tables.unique_rows(tables.load_reference_sources(spark, directory, prefix, nrows, place=True), keep)
    left = progress.watch("source1", add_normalized_columns(source1)).persist()
    right = progress.watch("reference", add_normalized_columns(reference)).persist()
    pairs = progress.watch("candidates", candidates(left, right, reference, engine, cap)).persist()
    scored = progress.watch("scored", training.score(bundle, features.build_pair_features(left, right, pairs)))
    paths = submission.write_submission(source1, pairs, scored, out, bundle.best_threshold if threshold is None else threshold)
    progress.rows()
    for frame in (left, right, pairs):
        frame.unpersist()
    return paths


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tessera")
    sub = parser.add_subparsers(dest="command", required=True)
    fit = sub.add_parser("train")
    use = sub.add_parser("predict")
    for p in (fit, use):
        p.add_argument("--data", required=True)
        p.add_argument("--out", required=True)
        p.add_argument("--engine", choices=ENGINES, default="priority")
        p.add_argument("--duplicates", choices=("error", "first", "last", "any"), default="error")
    fit.add_argument("--full", action="store_true")
    fit.add_argument("--sample", type=int, default=10_000)
    fit.add_argument("--negatives", type=int, default=50_000)
    fit.add_argument("--cap", type=int, default=300)
    use.add_argument("--model", required=True)
    use.add_argument("--prefix", default="test")
    use.add_argument("--threshold", type=float)
    use.add_argument("--cap", type=int, default=500)
    use.add_argument("--nrows", type=int)
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("tessera").config(
        "spark.sql.adaptive.enabled", "true"
    ).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "train":
        print(train(spark, a.data, a.out, None if a.full else a.sample, None if a.full else a.negatives, a.engine, a.cap, keep=a.duplicates)["best"])
    else:
        print(predict(spark, a.data, a.model, a.out, a.prefix, a.engine, a.cap, a.threshold, a.nrows, a.duplicates))


if __name__ == "__main__":
    main()
