"""The eighteen features of a candidate pair."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import listed
from ..functions import similarity as S
from ..functions import text as X

# The names of the features, in order.
FEATURE_COLUMNS = [
    "name_token_jaccard", "name_token_sort_ratio", "name_partial_ratio", "name_levenshtein_similarity", "name_character_similarity", "name_tfidf_cosine",
    "address_token_jaccard", "address_partial_ratio", "address_levenshtein_similarity", "address_character_similarity", "address_tfidf_cosine",
    "country_match", "exact_number_match", "postal_code_match", "numeric_token_overlap", "name_length_difference", "address_length_difference", "combined_tfidf_cosine",
]
USED = ("name_normalized", "address_normalized", "country_normalized", "house_number", "postal_code")


def record_columns() -> dict[str, Column]:
    """What the features compare, made once for each record; what no feature asks for is pruned."""
    name, address = F.col("name_normalized"), F.col("address_normalized")
    texts = {"name": name, "address": address, "both": F.trim(F.concat_ws(" ", name, address))}
    out = {c: F.col(c) for c in USED} | {"numbers": F.array_distinct("address_numeric_tokens")}
    for k, text in texts.items():
        out |= {
            f"{k}_tokens": X.tokens(text), f"{k}_grams": X.gram_codes(text), f"{k}_words": S.words(text),
            f"{k}_norm": S.norm(text)
        }
    return out


def paired(source1: DataFrame, reference: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs with the record columns of both sides, as l_* and r_*; pairs with a missing side drop out.

    pairs has a row a pair, or a row a query with its array `candidates`. Queries are dealt into groups by country; each
    group gets one copy of every record that any of its queries has as a candidate, and pairs meet records there. So
    what is shuffled is ids and the records of groups, not the records of pairs.
    """
    spark = pairs.sparkSession
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")  # sides dealt by group join on group and id
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = record_columns()
    if "candidates" not in pairs.columns:
        pairs = pairs.groupBy("source1_entity_id").agg(F.collect_list("candidate_entity_id").alias("candidates"))
    raw = [*USED, "address_numeric_tokens"]
    group = F.hash("country_normalized", F.pmod(F.xxhash64("source1_entity_id"), F.lit(parts))).alias("group")
    left = pairs.select("source1_entity_id", "candidates").join(
        source1.select(F.col("entity_id").alias("source1_entity_id"), *held(source1, raw)), "source1_entity_id"
    ).withColumn("group", group).repartition(parts, "group")
    wanted = left.select("group", F.explode_outer("candidates").alias("candidate_entity_id")).distinct()
    right = wanted.join(reference.select(F.col("entity_id").alias("candidate_entity_id"), *held(reference, raw)), "candidate_entity_id")
    right = right.repartition(parts, "group").select("group", "candidate_entity_id", *[v.alias(f"r_{k}") for k, v in made.items()])
    left = left.select("group", "source1_entity_id", "candidates", *[v.alias(f"l_{k}") for k, v in made.items()])  # made before the explosion
    left = left.withColumn("candidate_entity_id", F.explode_outer("candidates")).drop("candidates")
    return left.join(right.hint("shuffle_hash"), ["group", "candidate_entity_id"]).drop("group")


def held(records: DataFrame, columns: list[str]) -> list[Column]:
    """columns of records; the plain normalizer makes no numeric tokens."""
    return [F.col(c) for c in columns if c in records.columns]


def builtin_features() -> dict:
    c = F.col
    ln, rn, la, ra = c("l_name_normalized"), c("r_name_normalized"), c("l_address_normalized"), c("r_address_normalized")
    overlap = lambda k: S.jaccard(c(f"l_{k}"), c(f"r_{k}"))
    cosine = lambda k: S.cosine(c(f"l_{k}_words"), c(f"r_{k}_words"), c(f"l_{k}_norm"), c(f"r_{k}_norm"))
    same = lambda k: ((c(f"l_{k}") != "") & (c(f"l_{k}") == c(f"r_{k}"))).cast("double")
    return {
        "name_token_jaccard": overlap("name_tokens"),
        "name_character_similarity": overlap("name_grams"),
        "name_tfidf_cosine": cosine("name"),
        "address_token_jaccard": overlap("address_tokens"),
        "address_character_similarity": overlap("address_grams"),
        "address_tfidf_cosine": cosine("address"),
        "country_match": (c("l_country_normalized") == c("r_country_normalized")).cast("double"),
        "exact_number_match": same("house_number"),
        "postal_code_match": same("postal_code"),
        "numeric_token_overlap": overlap("numbers"),
        "name_length_difference": F.abs(F.length(ln) - F.length(rn)).cast("double"),
        "address_length_difference": F.abs(F.length(la) - F.length(ra)).cast("double"),
        "combined_tfidf_cosine": cosine("both"),
    }


def build_pair_features(
    source1: DataFrame, reference: DataFrame, pairs: DataFrame, builtin_only: bool = False, columns: list[str] | None = None
) -> DataFrame:
    """(source1_entity_id, candidate_entity_id) and the features in order, or those of `columns`; normalized frames come in."""
    rows = paired(source1, reference, pairs)
    made = builtin_features()
    wanted = [c for c in FEATURE_COLUMNS if (c in made or not builtin_only) and (columns is None or c in columns)]
    ratios = [c for c in wanted if c not in made]
    if ratios:
        texts = [F.col(f"{side}_{text}_normalized") for text in S.compared(ratios) for side in "lr"]
        rows = rows.withColumn("ratios", S.sequence_ratios(tuple(ratios))(*texts))
    return rows.select(
        "source1_entity_id", "candidate_entity_id", *[(made[k] if k in made else F.col(f"ratios.{k}")).alias(k) for k in wanted]
    )


#: What the features of lists compare, by its name there.
COMPARED = {
    "name": "name_normalized", "address": "address_normalized", "country": "country_normalized", "house": "house_number",
    "postal": "postal_code", "numbers": "address_numeric_tokens"
}


#: Queries of a group.
GROUP = 1_000


def group_of(source1: DataFrame) -> Column:
    """The group that a query is dealt to; groups are of like size, whatever the countries and partitions are."""
    return F.pmod(F.xxhash64("source1_entity_id"), F.lit(1 + source1.count() // GROUP)).cast("int")


def places(lists: pa.Array, ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of the items of lists that are among ids their place there and their list."""
    found = pc.fill_null(pc.index_in(lists.flatten(), value_set=ids, skip_nulls=True), -1).to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
    return found[found >= 0], owner[found >= 0]  # pairs with a missing side drop out


def laid(owner: np.ndarray, found: np.ndarray, hit: np.ndarray, number: np.ndarray, n: int, lists: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows whose `number` below n is asked for in `found`, all of each, where the rows of each list begin, and `hit` of the rows."""
    order, size = np.argsort(number, kind="stable"), np.bincount(number, minlength=n)
    begin = np.concatenate([[0], np.cumsum(size)])
    times = size[found]
    ends = np.cumsum(times)
    rows = order[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[found] - (ends - times), times)]
    owner, hit = np.repeat(owner, times), np.repeat(hit, times)
    return rows, np.searchsorted(owner, np.arange(lists + 1)), hit


def list_features(source1: DataFrame, reference: DataFrame, lists: DataFrame, columns: list[str] | None = None, digits: int | None = None) -> DataFrame:
    """build_pair_features of (source1_entity_id, candidates), by arrays; `group` of lists, where they have it, is group_of's.

    A group's lists are turned into numbers at once and kept packed, so the blocking runs once and no list is dealt out
    again; a record is copied once for each group that has it as a candidate. digits: features are rounded to so many.
    """
    spark = lists.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = [c for c in FEATURE_COLUMNS if columns is None or c in columns]
    used = {k: COMPARED[k] for k in COMPARED if any(k in listed.NEEDS[c] for c in wanted)}
    sides = lambda df, name: df.select(F.col("entity_id").alias(name), *[F.col(c).alias(k) for k, c in used.items()])
    group = group_of(source1)
    if "group" not in lists.columns:
        lists = lists.withColumn("group", group).repartition(4 * parts, "group")
    mine = sides(source1, "source1_entity_id").withColumn("own", group).repartition(4 * parts, "own")

    def pack(dealt: pa.Table, queries: pa.Table) -> pa.Table:
        one = lambda table, c: pa.chunked_array(table[c]).combine_chunks()
        at = pc.index_in(one(queries, "source1_entity_id"), value_set=one(dealt, "source1_entity_id"), skip_nulls=True)
        queries, at = queries.filter(at.is_valid()), at.drop_null()
        asked = one(dealt, "candidates").take(at)
        ids = asked.flatten().drop_null().unique()
        found, owner = places(asked, ids)
        size = pa.array(np.bincount(owner, minlength=len(asked)).astype(np.int32))
        sink = pa.BufferOutputStream()
        for table in (queries.drop_columns(["own"]).append_column("size", size), pa.table({"found": found.astype(np.int32)})):
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table)
        group = dealt["group"][:1].cast(pa.int32()) if len(queries) else []
        return pa.table({"group": pa.array([g.as_py() for g in group], pa.int32()), "packed": pa.array([sink.getvalue().to_pybytes()][: len(group)], pa.binary()), "ids": pa.array([ids.to_pylist()][: len(group)], pa.list_(pa.string()))})

    packs = lists.groupBy("group").cogroup(mine.groupBy("own")).applyInArrow(pack, "group int, packed binary, ids array<string>").persist()
    asked = packs.select(F.col("group").alias("asked"), F.posexplode("ids").alias("number", "entity_id"))
    right = asked.join(sides(reference, "entity_id"), "entity_id").repartition(4 * parts, "asked")
    left = packs.select("group", "packed").repartition(4 * parts, "group")
    schema = pa.schema([("source1_entity_id", pa.string()), ("candidate_entity_id", pa.string()), *[(c, pa.float64()) for c in wanted]])

    def run(packed: pa.Table, other: pa.Table) -> pa.Table:
        if not len(packed) or not len(other):
            return schema.empty_table()
        source = pa.BufferReader(packed["packed"][0].as_buffer())
        queries, found = (pa.ipc.open_stream(source).read_all().combine_chunks() for _ in range(2))
        found, size = found["found"].to_numpy().astype(np.int64), queries["size"].to_numpy()
        number = other["number"].to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(queries)), size)
        rows, starts, _ = laid(owner, found, owner, number, max(number.max(), found.max(initial=0)) + 1, len(queries))
        names, ids = (pa.chunked_array(t[c]).combine_chunks() for t, c in ((queries, "source1_entity_id"), (other, "entity_id")))
        values = [{k: table[k].to_pylist() for k in used} for table in (queries, other)]
        out = []
        for first, end, made in listed.features(*values, starts, rows, wanted):
            query = pa.array(np.repeat(np.arange(first, end), np.diff(starts[first : end + 1])))
            pairs = [names.take(query), ids.take(pa.array(rows[starts[first] : starts[end]]))]
            out.append(pa.RecordBatch.from_arrays([*pairs, *[pa.array(made[c] if digits is None else rounded(made[c], digits)) for c in wanted]], schema=schema))
        return pa.Table.from_batches(out, schema)

    text = ", ".join(f"{c} {'string' if c.endswith('_id') else 'double'}" for c in schema.names)
    return left.groupBy("group").cogroup(right.groupBy("asked")).applyInArrow(run, text)


def rounded(values: np.ndarray, digits: int) -> np.ndarray:
    """Half up as Spark rounds: a value is taken by its shortest decimal text where it lies at the middle."""
    scaled = values * 10.0**digits
    low = np.floor(scaled)
    out = (low + (scaled - low >= 0.5)) / 10.0**digits
    middle = np.flatnonzero(np.abs(scaled - low - 0.5) < 1e-6)
    found, pick = np.unique(values[middle], return_inverse=True)
    exact = [float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) for x in found.tolist()]
    out[middle] = np.array(exact, float)[pick]
    return out
