"""Candidate generation as equi-joins over postings.

Postings are rows (kind, country, key, entity_id). Frequent keys are cut to their first ids before any join, so a join's
output is bounded by queries times keys times limit. Where the semantics of a limit were open, the rule is: of each
(kind, country, key) the first ids in order; of each query the smallest ids, or the best priority and then the smallest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X


@dataclass(frozen=True)
class BlockingConfig:
    name_token_limit: int = 100
    address_token_limit: int = 100
    numeric_limit: int = 100
    character_ngram_limit: int = 100
    max_candidates_per_entity: int = 500
    character_ngram_sizes: tuple[int, ...] = (3, 4, 5)
    use_character_ngrams: bool = True
    use_token_indexes: bool = True


#: What the train and predict drivers take: postings of words and grams are cut shorter than those of numbers.
DRIVER_CONFIG = BlockingConfig(name_token_limit=50, address_token_limit=50, character_ngram_limit=50)

# Address words too common to search by.
GENERIC_ADDRESS_TOKENS = [
    "st", "rd", "ave", "blvd", "dr", "ln", "unit", "apt", "fl", "floor", "ste", "suite", "near", "opp", "opposite", "road",
    "street", "avenue", "lane", "colony", "dist", "district", "city", "state", "india", "us", "france", "de", "du", "la", "le"
]

SEPARATOR = "\u0001"


def keys(config: BlockingConfig, kinds: tuple[str, ...]) -> Column:
    """An array of (kind, key) of a normalized row; blank keys are left out."""
    name, address = F.col("name_normalized"), F.col("address_normalized")
    one = lambda c: F.array(c)
    of = {
        "name_exact": one(name),
        "address_exact": one(address),
        "name_address_exact": one(F.when((name != "") & (address != ""), F.concat_ws(SEPARATOR, name, address))),
        "house": one(F.col("house_number")),
        "postal": one(F.col("postal_code")),
        "name_token": X.tokens(name),
        "address_token": X.tokens(address),
        "name_gram": F.when(name != "", X.char_ngrams(name, config.character_ngram_sizes)),
        "address_gram": F.when(address != "", X.char_ngrams(address, config.character_ngram_sizes)),
    }
    none = F.array().cast("array<struct<kind:string,key:string>>")

    def tagged(kind: str) -> Column:
        full = F.filter(of[kind], lambda x: x.isNotNull() & (x != ""))
        return F.coalesce(F.transform(full, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("key"))), none)

    parts = [tagged(k) for k in kinds]
    return F.flatten(F.array(*parts))


def postings(normalized: DataFrame, config: BlockingConfig, kinds: tuple[str, ...]) -> DataFrame:
    return normalized.select(
        "entity_id", F.col("country_normalized").alias("country"), F.explode(keys(config, kinds)).alias("k")
    ).select("k.kind", "country", "k.key", "entity_id")


def limits(config: BlockingConfig, exact: int | None) -> dict[str, int]:
    cap = config.max_candidates_per_entity
    out = {
        "name_token": min(cap, config.name_token_limit), "address_token": min(cap, config.address_token_limit),
        "house": min(cap, config.numeric_limit), "postal": min(cap, config.numeric_limit),
        "name_gram": min(cap, config.character_ngram_limit), "address_gram": min(cap, config.character_ngram_limit)
    }
    return out | ({k: exact for k in ("name_exact", "address_exact", "name_address_exact")} if exact else {})


def capped(posted: DataFrame, limit: dict[str, int]) -> DataFrame:
    """The first ids of every key; kinds without a limit are whole."""
    by = F.create_map(*[F.lit(x) for kv in limit.items() for x in kv])
    w = Window.partitionBy("kind", "country", "key").orderBy("entity_id")
    most = max(limit.values())
    bounded = posted.where(F.col("kind").isin(list(limit))).withColumn("at", F.row_number().over(w)).where(
        (F.col("at") <= most) & (F.col("at") <= by[F.col("kind")])
    ).drop("at")
    return posted.where(~F.col("kind").isin(list(limit))).unionByName(bounded)


def probe(queries: DataFrame, posted: DataFrame) -> DataFrame:
    """All pairs that share a key; the joins are plain equi-joins, whose hot keys AQE can split."""
    q = queries.withColumnRenamed("entity_id", "source1_entity_id")
    return q.join(
        posted.withColumnRenamed("entity_id", "candidate_entity_id"), ["kind", "country", "key"]
    ).select("source1_entity_id", "candidate_entity_id", "kind")


#: Records of a slice at most, about; cells of two slices at least, so that small inputs have work for all tasks.
SLICE, CELLS = 1 << 14, 48
#: Pairs that a task hands on together.
PAIRS = 1 << 18


def share_token(source1: DataFrame, reference: DataFrame, kind: str) -> DataFrame:
    """All pairs of ids that share a word, each once.

    Both sides are dealt into slices by id, and every two slices of a country meet in a cell. There the reference's ids of
    each word are listed by number, a query marks those of all its words, and the marks are its candidates. So a pair
    is told apart by a mark, and until the end a query's candidates of a cell are one array.
    """
    text = {"name_token": "name_normalized", "address_token": "address_normalized"}[kind]
    right = 1 + reference.count() // SLICE
    left = max(-(-CELLS // right), 1 + source1.count() // SLICE)

    def worded(df: DataFrame, side: int, own: int, others: int) -> DataFrame:
        number = F.pmod(F.xxhash64("entity_id"), F.lit(own)).cast("int")
        each = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        rows = df.select("entity_id", F.col("country_normalized").alias("country"), X.tokens(F.col(text)).alias("words")).where(F.size("words") > 0)
        rows = rows.select(F.lit(side).alias("side"), "entity_id", "country", "words", number.alias("own"), each.alias("other"))
        one, two = ("other", "own") if side == 0 else ("own", "other")
        return rows.select("country", F.col(one).alias("left"), F.col(two).alias("right"), "side", "entity_id", "words")

    dealt = worded(reference, 0, right, left).unionByName(worded(source1, 1, left, right))
    parts = 4 * int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cell = ["country", "left", "right"]
    dealt = dealt.repartition(parts, *cell).sortWithinPartitions(*cell, "side", "entity_id")
    lists = dealt.mapInArrow(marked, "source1_entity_id string, candidates array<string>")
    return lists.select("source1_entity_id", F.explode("candidates").alias("candidate_entity_id"))


class Cell:
    """The reference's ids of a cell, and of each word their numbers, one word after the other."""

    def __init__(self, tables: list[pa.Table]) -> None:
        rows = pa.concat_tables(tables).combine_chunks() if tables else None
        one = lambda c: pa.chunked_array(rows[c]).combine_chunks()
        if rows is None:
            self.ids, self.words = pa.array([], pa.string()), pa.array([], pa.string())
            self.numbers, self.at = np.zeros(0, np.int64), np.zeros(1, np.int64)
            return
        ids, words = one("entity_id").dictionary_encode(null_encoding="encode"), one("words")
        keys = words.flatten().dictionary_encode()
        code = keys.indices.to_numpy()
        owner = np.repeat(ids.indices.to_numpy().astype(np.int64), pc.list_value_length(words).to_numpy())
        order = np.argsort(code, kind="stable")
        self.ids, self.words, self.numbers = ids.dictionary, keys.dictionary, owner[order]
        self.at = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(self.words)))])


def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(source1_entity_id, candidates) of rows in order of cell, side and id; equal ids are one query."""
    names, found, cell, here, refs = [], [], None, None, []
    mark = np.zeros(0, bool)
    last: list = []  # the id whose words are being marked

    def close() -> None:
        if last:
            hits = np.flatnonzero(mark)
            mark[hits] = False
            if len(hits):
                names.append(last[0])
                found.append(hits)
            last.clear()

    def handed() -> Iterator[pa.RecordBatch]:
        if names:
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), cell.ids.take(pa.array(np.concatenate(found))))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), lists], ["source1_entity_id", "candidates"])
            names.clear()
            found.clear()

    for batch in batches:
        columns = [batch.column(c).dictionary_encode().indices.to_numpy() if c == "country" else batch.column(c).to_numpy() for c in ("country", "left", "right", "side")]
        change = np.flatnonzero(np.any([x[1:] != x[:-1] for x in columns], axis=0)) + 1 if batch.num_rows else []
        edges = [0, *change, batch.num_rows]
        for low, high in zip(edges, edges[1:]):
            if low == high:
                continue
            rows = batch.slice(low, high - low)
            key = tuple(rows.column(c)[0].as_py() for c in ("country", "left", "right"))
            if key != here:
                close()
                yield from handed()
                here, cell, refs = key, None, []
            if rows.column("side")[0].as_py() == 0:
                refs.append(pa.table(rows))
                continue
            if cell is None:
                cell, refs = Cell(refs), []
                mark = np.zeros(len(cell.ids), bool)
            words = rows.column("words")
            code = pc.fill_null(pc.index_in(words.flatten(), value_set=cell.words), -1).to_numpy().tolist()
            ends, at, k, total = np.cumsum(pc.list_value_length(words).to_numpy()).tolist(), cell.at.tolist(), 0, sum(map(len, found))
            for name, end in zip(rows.column("entity_id").to_pylist(), ends):
                if not last or last[0] != name:
                    close()
                    total += len(found[-1]) if found else 0
                    if total > PAIRS:
                        yield from handed()
                        total = 0
                    last.append(name)
                for w in code[k:end]:
                    if w >= 0:
                        mark[cell.numbers[at[w] : at[w + 1]]] = True
                k = end
    close()
    yield from handed()


def first_candidates(pairs: DataFrame, cap: int, *order: str) -> DataFrame:
    w = Window.partitionBy("source1_entity_id").orderBy(*order, "candidate_entity_id")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= cap).select("source1_entity_id", "candidate_entity_id")


INVERTED = ("name_exact", "address_exact", "name_address_exact", "house", "postal", "name_token", "address_token")
GRAMS = ("name_gram", "address_gram")


def block_inverted(source1: DataFrame, reference: DataFrame, config: BlockingConfig = BlockingConfig()) -> DataFrame:
    """Inverted-index candidates of normalized frames: exact keys, tokens, grams, numbers; the smallest ids stay."""
    kinds = INVERTED + (GRAMS if config.use_character_ngrams else ())
    pairs = probe(postings(source1, config, kinds), capped(postings(reference, config, kinds), limits(config, None)))
    return first_candidates(pairs.select("source1_entity_id", "candidate_entity_id").distinct(), config.max_candidates_per_entity)


def block_disk(source1: DataFrame, reference: DataFrame, config: BlockingConfig = BlockingConfig()) -> DataFrame:
    """As block_inverted without grams; short and generic address words are not searched by."""
    kinds = INVERTED if config.use_token_indexes else tuple(k for k in INVERTED if not k.endswith("token"))
    searched = postings(source1, config, kinds).where(
        (F.col("kind") != "address_token") | ((F.length("key") > 2) & ~F.col("key").isin(GENERIC_ADDRESS_TOKENS))
    )
    pairs = probe(searched, capped(postings(reference, config, kinds), limits(config, config.max_candidates_per_entity)))
    return first_candidates(pairs.select("source1_entity_id", "candidate_entity_id").distinct(), config.max_candidates_per_entity)


PRIORITY = ("name_exact", "address_exact", "house", "postal", "name_token", "address_token")


def first_ids(posted: DataFrame, cap: int) -> DataFrame:
    """Of every key its first `cap` ids as one sorted array, with their number and, where the array is full, the last."""
    w = Window.partitionBy("kind", "country", "key").orderBy("entity_id")
    first = posted.withColumn("at", F.row_number().over(w)).where(F.col("at") <= cap)
    listed = first.groupBy("kind", "country", "key").agg(F.sort_array(F.collect_set("entity_id")).alias("ids"))
    return listed.withColumn("n", F.size("ids")).withColumn("last", F.when(F.col("n") >= cap, F.element_at("ids", -1)))


#: Postings of so many ids are copied for as many parts of the queries, so that a frequent key is not one task's.
LONG, COPIES = 64, 16


def candidate_lists(source1: DataFrame, reference: DataFrame, cap: int = 500, exact_first: bool = False, by: Column | None = None) -> DataFrame:
    """(source1_entity_id, candidates): as block_priority, the candidates of a query in one array, best first.

    by: a column of source1_entity_id by whose value queries are dealt into groups; it is kept as `group`.

    Postings are cut to their first `cap` ids, which loses nothing: for whichever query has the key, those ids come
    before a later one of the same posting, so a later one is no candidate by this key. In the same way a full posting
    of a query is enough for all its places from this priority on: later priorities and larger ids of the same one
    are dropped before anything is joined. What is dealt out is arrays of ids, not pairs.
    """
    config, keyed = BlockingConfig(), ["kind", "country", "key"]
    listed = first_ids(postings(reference, config, PRIORITY), cap)
    kind = F.col("kind")
    number = F.when(kind == "name_token", 2).when(kind == "address_token", 3).when(
        F.lit(exact_first) & kind.isin("name_exact", "address_exact"), 0
    ).otherwise(1)
    asked = postings(source1, config, PRIORITY).withColumnRenamed("entity_id", "source1_entity_id").withColumn("priority", number)
    met = asked.join(listed.select(*keyed, "n", "last"), keyed)
    full = F.min(F.when(F.col("last").isNotNull(), F.struct("priority", "last"))).over(Window.partitionBy("source1_entity_id"))
    met = met.withColumn("full", full).where(F.col("full").isNull() | (F.col("priority") <= F.col("full.priority")))
    met = met.withColumn("bound", F.when(F.col("priority") == F.col("full.priority"), F.col("full.last")))
    copy = F.when(F.col("n") >= LONG, F.pmod(F.xxhash64("source1_entity_id"), F.lit(COPIES))).otherwise(0).cast("int").alias("copy")
    copies = F.explode(F.sequence(F.lit(0), F.when(F.col("n") >= LONG, COPIES - 1).otherwise(0))).alias("copy")
    found = met.select(*keyed, copy, "source1_entity_id", "priority", "bound").join(listed.select(*keyed, copies, "ids"), [*keyed, "copy"])
    within = F.when(F.col("bound").isNull(), F.col("ids")).otherwise(F.filter("ids", lambda x: x <= F.col("bound")))
    lists = found.select("source1_entity_id", F.struct("priority", within.alias("ids")).alias("x"))
    asks = ["source1_entity_id"]
    if by is not None:  # the lists are dealt out once, by the group
        parts = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        lists, asks = lists.withColumn("group", by).repartition(4 * parts, "group"), ["group", *asks]
    lists = lists.groupBy(*asks).agg(F.collect_list("x").alias("lists"))

    def of(k: int) -> Column:
        return F.sort_array(F.array_distinct(F.flatten(F.filter("lists", lambda x: x["priority"] == k)["ids"])))

    ranked = [of(k) for k in range(0 if exact_first else 1, 4)]
    return lists.select(*asks, F.slice(F.array_distinct(F.concat(*ranked)), 1, cap).alias("candidates"))


def pairs_of(lists: DataFrame) -> DataFrame:
    return lists.select("source1_entity_id", F.explode_outer("candidates").alias("candidate_entity_id"))


def block_priority(source1: DataFrame, reference: DataFrame, cap: int = 500, exact_first: bool = False) -> DataFrame:
    """Candidates by priority: 1 an equal name, address, house number or postal code, 2 a name word, 3 an address word.

    The four equalities are separate equi-joins; one join on the country with the four as a condition would be quadratic
    in each country. exact_first ranks equal names and addresses before equal numbers.
    """
    return pairs_of(candidate_lists(source1, reference, cap, exact_first))


def blocking_stats(pairs: DataFrame, source1: DataFrame, reference: DataFrame, all_entities: bool = True) -> DataFrame:
    """One row: mean, median and maximum of candidates per entity, and the share of all pairs that blocking avoids.

    all_entities: entities without a candidate count as zero; otherwise they are left out.
    """
    counts = pairs.groupBy("source1_entity_id").agg(F.count("*").alias("n"))
    if all_entities:
        counts = source1.select(
            F.col("entity_id").alias("source1_entity_id")
        ).join(counts, "source1_entity_id", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    nothing = F.lit(None).cast("long")
    rows = counts.select(F.col("n").cast("long"), nothing.alias("a"), nothing.alias("b"))
    rows = rows.unionByName(source1.agg(F.count("*").alias("a")).select(nothing.alias("n"), "a", nothing.alias("b")))
    rows = rows.unionByName(reference.agg(F.count("*").alias("b")).select(nothing.alias("n"), nothing.alias("a"), "b"))
    total = F.max("a").cast("double") * F.max("b")
    return rows.agg(
        F.coalesce(F.avg("n"), F.lit(0.0)).alias("average_candidates"), F.coalesce(F.median("n"), F.lit(0.0)).alias("median_candidates"),
        F.coalesce(F.max("n"), F.lit(0)).cast("double").alias("maximum_candidates"),
        F.when(total > 0, 1 - F.coalesce(F.sum("n"), F.lit(0)) / total).otherwise(1.0).alias("candidate_reduction_ratio"))


def blocking_recall(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """The share of truth entities all of whose matches are candidates; empty truth is covered, no truth gives 1."""
    wanted = truth.select("source1_entity_id", F.explode_outer("matched").alias("candidate_entity_id"))
    found = wanted.join(pairs.distinct().withColumn("hit", F.lit(1)), ["source1_entity_id", "candidate_entity_id"], "left")
    missed = found.groupBy("source1_entity_id").agg(
        F.max((F.col("candidate_entity_id").isNotNull() & F.col("hit").isNull()).cast("int")).alias("missed")
    )
    return missed.agg(F.coalesce(F.avg(1.0 - F.col("missed")), F.lit(1.0)).alias("candidate_recall"))


def fetch_records(reference: DataFrame, ids: DataFrame) -> DataFrame:
    """The raw records of a frame of ids."""
    columns = ["entity_id", "business_name", "business_address", "country", "record_source"]
    return reference.select(columns).join(ids.select(F.col("candidate_entity_id").alias("entity_id")).distinct(), "entity_id", "left_semi")
