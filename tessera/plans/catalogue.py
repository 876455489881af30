"""Named queries of the engine over the entity projection; `oracle` has the SQL that gives the same rows.

Queries after scoring use a rule in place of a model, the mean of the name's and the address's word overlap, so that
their rows can be checked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as X
from ..operators import blocking as B
from ..operators import boosting
from ..operators import evaluation as E
from ..operators import features as P
from ..operators import submission, training
from ..sources import entities as N
from ..sources import tables
from .oracle import ORACLE_SQL  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CAP, LIMIT = 500, 50
CONFIG = B.DRIVER_CONFIG
#: Negatives of each source, and rounds of the model, as the training driver has them.
NEGATIVES, ROUNDS = 50_000, 200


def query(f):
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame) -> DataFrame:
    return df.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def one(spark, d):
    """Source 1, normalized once: a query that reads it twice, or a later query, finds it persisted."""
    return X.add_normalized_columns(N.source(spark, d, 1)).persist()


def ref(spark, d):
    return X.add_normalized_columns(N.reference(spark, d)).persist()


def raw_text(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.col("text").alias("raw"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    a, b = one(spark, d), ref(spark, d)
    return P.build_pair_features(a, b, B.block_priority(a, b, CAP), builtin_only=True)


@query
def entity_projection(spark, d):
    return N.entities(spark, d)


@query
def reference_union(spark, d):
    return N.reference(spark, d)


@query
def profile_rows_nulls(spark, d):
    return tables.profile(N.reference(spark, d))


@query
def profile_country_counts(spark, d):
    return tables.country_counts(N.reference(spark, d))


@query
def truth_parse(spark, d):
    joined = N.truth(spark, d).select("source1_entity_id", F.concat(F.lit(" "), F.array_join(F.array_sort("matched"), " ,, ")).alias("ids"))
    return tables.truth_pairs(joined.select("source1_entity_id", tables.parse_ids(F.col("ids")).alias("matched")))


@query
def normalize_text(spark, d):
    return raw_text(spark, d).select("doc_id", X.normalize_text("raw").alias("normalized"))


@query
def normalize_name(spark, d):
    return raw_text(spark, d).select("doc_id", X.fold_legal_forms(X.normalize_text("raw")).alias("normalized"))


@query
def normalize_address(spark, d):
    return raw_text(spark, d).select("doc_id", X.fold_street_words(X.normalize_text("raw")).alias("normalized"))


@query
def sql_normalize_asymmetric(spark, d):
    columns = ("entity_id", "name_normalized", "address_normalized", "country_normalized", "house_number", "postal_code")
    return X.add_sql_normalized_columns(N.reference(spark, d)).select(*columns)


@query
def extract_numeric(spark, d):
    return ref(spark, d).select("entity_id", F.array_join("address_numeric_tokens", ",").alias("numbers"))


@query
def extract_postal(spark, d):
    return ref(spark, d).select("entity_id", "postal_code")


@query
def extract_house(spark, d):
    return ref(spark, d).select("entity_id", "house_number")


@query
def extract_unit(spark, d):
    return ref(spark, d).select("entity_id", "unit_number")


@query
def char_ngrams(spark, d):
    return ref(spark, d).select("entity_id", F.explode(X.char_ngrams(F.col("name_normalized"), (3, 4, 5))).alias("gram"))


@query
def token_postings(spark, d):
    return B.postings(ref(spark, d), CONFIG, ("name_token", "address_token"))


@query
def postings_capped(spark, d):
    return B.capped(B.postings(ref(spark, d), CONFIG, ("name_token", "address_token", "house")), B.limits(CONFIG, None))


def single_kind(kind):
    def run(spark, d):
        if kind.endswith("token"):
            return B.share_token(one(spark, d), ref(spark, d), kind)
        limit = B.limits(CONFIG, None) if kind.endswith("gram") else {}
        posted = B.postings(ref(spark, d), CONFIG, (kind,))
        posted = B.capped(posted, limit) if limit else posted
        return B.probe(B.postings(one(spark, d), CONFIG, (kind,)), posted).select("source1_entity_id", "candidate_entity_id").distinct()

    return run


for _name, _kind in {
    "block_exact_name": "name_exact", "block_exact_address": "address_exact", "block_exact_name_address": "name_address_exact", "block_house": "house",
    "block_postal": "postal", "block_name_tokens": "name_token", "block_address_tokens": "address_token", "block_name_ngrams": "name_gram", "block_address_ngrams": "address_gram",
}.items():
    QUERIES[_name] = single_kind(_kind)


@query
def block_inverted(spark, d):
    return B.block_inverted(one(spark, d), ref(spark, d), CONFIG)


@query
def block_disk_stopwords(spark, d):
    return B.block_disk(one(spark, d), ref(spark, d), CONFIG)


def priority_lists(spark, d):
    return B.candidate_lists(one(spark, d), ref(spark, d), CAP)


@query
def block_priority(spark, d):
    return B.pairs_of(priority_lists(spark, d))


@query
def block_priority_asymmetric(spark, d):
    return B.block_priority(one(spark, d), X.add_sql_normalized_columns(N.reference(spark, d)), CAP)


@query
def blocking_stats_all(spark, d):
    return rounded(B.blocking_stats(block_priority(spark, d), N.source(spark, d, 1), N.reference(spark, d)))


@query
def blocking_stats_nonzero(spark, d):
    return rounded(B.blocking_stats(block_priority(spark, d), N.source(spark, d, 1), N.reference(spark, d), all_entities=False))


@query
def blocking_recall(spark, d):
    return rounded(B.blocking_recall(block_priority(spark, d), N.truth(spark, d)))


@query
def fetch_records_semi(spark, d):
    return B.fetch_records(N.reference(spark, d), block_priority(spark, d))


@query
def negatives_anti(spark, d):
    return training.sample_reference(N.reference(spark, d), tables.truth_pairs(N.truth(spark, d)), NEGATIVES)


def dealt(spark, d):
    a, b = one(spark, d), ref(spark, d)
    return a, b, B.candidate_lists(a, b, CAP, by=P.group_of(a))


def features(spark, d, *columns):
    return P.list_features(*dealt(spark, d), columns, 6)


@query
def feat_token_jaccard(spark, d):
    return features(spark, d, "name_token_jaccard", "address_token_jaccard")


@query
def feat_char_jaccard(spark, d):
    return features(spark, d, "name_character_similarity", "address_character_similarity")


@query
def feat_cosine(spark, d):
    return features(spark, d, "name_tfidf_cosine", "address_tfidf_cosine", "combined_tfidf_cosine")


@query
def feat_numeric(spark, d):
    return features(spark, d, "numeric_token_overlap")


@query
def feat_flags(spark, d):
    return features(spark, d, "country_match", "exact_number_match", "postal_code_match")


@query
def feat_length(spark, d):
    return features(spark, d, "name_length_difference", "address_length_difference")


def candidates(spark, d):
    a, b = one(spark, d), ref(spark, d)
    return a, b, B.candidate_lists(a, b, CAP)


@query
def feat_indel(spark, d):
    return features(spark, d, "name_levenshtein_similarity")


@query
def feat_token_sort(spark, d):
    return features(spark, d, "name_token_sort_ratio")


@query
def feat_partial(spark, d):
    return P.list_features(*dealt(spark, d), ["name_partial_ratio", "address_partial_ratio"])


@query
def pair_features_all(spark, d):
    return P.list_features(*dealt(spark, d))


@query
def label_pairs(spark, d):
    return training.label_lists(priority_lists(spark, d), N.truth(spark, d))


@query
def negatives_top5(spark, d):
    return training.thin_negatives(label_pairs(spark, d))


@query
def class_balance(spark, d):
    return rounded(training.class_balance(label_pairs(spark, d)))


@query
def group_split(spark, d):
    fit, held = training.split_by_source1(label_pairs(spark, d))
    return fit.withColumn("part", F.lit("fit")).unionByName(held.withColumn("part", F.lit("held")))


def rule_scored(spark, d):
    rows = P.paired(one(spark, d), ref(spark, d), priority_lists(spark, d))
    mean = (S.jaccard(F.col("l_name_tokens"), F.col("r_name_tokens")) + S.jaccard(F.col("l_address_tokens"), F.col("r_address_tokens"))) / 2
    return rows.select("source1_entity_id", "candidate_entity_id", F.round(mean, 6).alias("match_probability"))


def query_ids(spark, d):
    return N.source(spark, d, 1).select(F.col("entity_id").alias("source1_entity_id"))


@query
def rule_score_threshold(spark, d):
    return rule_scored(spark, d).where(F.col("match_probability") >= 0.3)


@query
def threshold_sweep(spark, d):
    return rounded(E.threshold_sweep(rule_scored(spark, d), N.truth(spark, d), query_ids(spark, d)))


@query
def eval_macro_f05(spark, d):
    return rounded(E.evaluate(rule_scored(spark, d), N.truth(spark, d), query_ids(spark, d), 0.3))


@query
def best_threshold(spark, d):
    return E.best_threshold(rounded(E.threshold_sweep(rule_scored(spark, d), N.truth(spark, d), query_ids(spark, d))))


@query
def submission_candidates(spark, d):
    return submission.joined_ids(N.source(spark, d, 1), block_priority(spark, d), "candidate_entity_ids")


@query
def submission_matches(spark, d):
    return submission.submission_frames(N.source(spark, d, 1), block_priority(spark, d), rule_scored(spark, d), 0.3)[1]


@query
def gbt_score(spark, d):
    rows = boosting.dealt(training.packed_lists(*candidates(spark, d), N.truth(spark, d)))
    return training.score_packed(training.fit_packed(rows, ROUNDS), rows)
