"""Golden cases of the scalar operators, properties of blocking, and the drivers on tiny files."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import similarity as S
from tessera.functions import text as X
from tessera.operators import blocking as B
from tessera.operators import evaluation as E
from tessera.operators import features as P
from tessera.operators import training
from tessera.sources import tables

TEXTS = {
    None: "", "Café  Société!": "cafe societe", "A_B c.d": "a_b c d", "O'Neil & Sons": "o neil sons", "ﬁrst Ⅻ": "first xii",
    "a​b": "a b", "a‍b": "ab", "Łódź": "łodz", "हिन्दी": "ह नद",
}


def test_fold():
    assert {k: X.fold(k) for k in TEXTS} == TEXTS


def test_normalized_columns(spark):
    rows = [
        ("1", "ACME Private Limited", "12-B, M.G. Road, Apt 5", "U.S."), ("2", "Foo (P) Limited", "1234 main 560001", None),
        ("3", "Company Corporation Inc.", "12345678901", "x"), ("4", "Limited Edition Company", "12 b 221b 12th 5a7 5", "x"),
        ("5", "P Public Limited", "florida ave", "x"), ("6", None, None, None)
    ]
    got = {
        r.entity_id: r
        for r in X.add_normalized_columns(
            spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string")
        ).collect()
    }
    assert [got[k].name_normalized for k in "123456"] == [
        "acme pvt ltd", "foo pvt ltd", "co corp inc", "ltd edition co", "p public ltd", ""
    ]
    assert got["1"].address_normalized == "12 b m g rd unit 5" and got["1"].unit_number == "5" and got["1"].country_normalized == "u s"
    assert (got["2"].postal_code, got["2"].house_number, got["3"].postal_code) == ("560001", "1234", "")
    assert got["4"].address_numeric_tokens == ["12", "221b", "5"] and got["5"].unit_number == "orida"
    assert got["6"].address_numeric_tokens == [] and got["6"].house_number == ""


def test_plain_normalizer(spark):
    df = spark.createDataFrame(
        [("Café São-Paulo Pvt. Ltd.", "12abc rd", None), ("x", "a 12345678901 x", " U.S. ")],
        "business_name string, business_address string, country string"
    )
    a, b = X.add_sql_normalized_columns(df).collect()
    assert (a.name_normalized, a.house_number) == ("caf  s o paulo pvt  ltd ", "12a") and (
        b.postal_code, b.country_normalized
    ) == ("1234567890", "u.s.")


def test_ratios():
    assert S.indel_ratio("acme ltd", "acme pvt ltd") == 0.8
    assert [
        round(S.indel_ratio(*p), 6) for p in (("kitten", "sitting"), ("corp acme", "acme corp"), ("", ""), ("", "abc"))
    ] == [0.615385, 0.444444, 1.0, 0.0]
    assert [
        round(S.partial_ratio(*p), 6)
        for p in (("acme", "the acme corp"), ("abcd", "cdef"), ("bakery", "baker st"), ("", ""), ("", "a"))
    ] == [1.0, 0.666667, 0.909091, 1.0, 0.0]


def test_ratios_together():
    """All pairs at once give what one pair at a time gives, with texts beyond 64 characters, ties and repeats."""
    r = random.Random(5)
    texts = ["", "a", "ab", "हिन्दी", "𝔸b𝔸", "x" * 64, "x" * 65, "ab" * 70] + [
        "".join(r.choice("abcd é") for _ in range(r.choice([1, 2, 3, 5, 8, 13, 63, 64, 65, 90]))) for _ in range(30)
    ]
    left, right = zip(*[(a, b) for a in texts for b in texts], ("ab", "ab"))
    whole, best = S.ratios(list(left), list(right))
    assert whole.tolist() == [S.indel_ratio(a, b) for a, b in zip(left, right)]
    assert best.tolist() == [S.partial_ratio(a, b) for a, b in zip(left, right)]
    assert S.ratios(list(left), list(right), partial=False)[0].tolist() == whole.tolist()
    assert [len(x) for x in S.ratios([], [])] == [0, 0]


def test_overlaps(spark):
    cases = [("a b", "b c"), ("", ""), ("a", ""), ("a a b", "a b"), ("ab", "abc")]
    a, b = F.col("a"), F.col("b")
    df = spark.createDataFrame(cases, "a string, b string").select(
        S.token_jaccard(a, b), S.cosine(S.words(a), S.words(b), S.norm(a), S.norm(b)), S.character_jaccard(a, b)
    )
    got = [tuple(round(x, 6) for x in r) for r in df.collect()]
    assert [g[0] for g in got][:3] == [round(1 / 3, 6), 1.0, 0.0]
    assert [g[1] for g in got][1:4] == [1.0, 0.0, 0.948683]
    assert (got[1][2], got[2][2], got[4][2]) == (1.0, 0.0, round(2 / 7, 6))
    assert sorted(
        spark.createDataFrame([("ab",)], "a string").select(X.char_ngrams(F.col("a"), (3,))).first()[0]
    ) == ["  a", " ab", "ab ", "b  "]


def test_evaluation(spark):
    truth = spark.createDataFrame(
        [("e1", ["a", "b"]), ("e2", []), ("e3", []), ("e4", ["c"]), ("e5", ["c", "d"])],
        "source1_entity_id string, matched array<string>"
    )
    scored = spark.createDataFrame(
        [("e1", "a", 0.9), ("e1", "b", 0.1), ("e3", "x", 0.9), ("e5", "c", 0.9), ("e5", "d", 0.5), ("e5", "z", 0.9)],
        "source1_entity_id string, candidate_entity_id string, match_probability double"
    )
    r = E.evaluate(scored, truth, truth.select("source1_entity_id"), 0.5).first()
    assert [round(x, 6) for x in r] == [0.509524, 0.533333, 0.5, 0.2, 5.0, 5.0]


SCHEMA = "entity_id string, business_name string, business_address string, country string"


def test_blocking_modes(spark):
    one = spark.createDataFrame([("q1", "Acme Ltd", "12 Main Street", "US"), ("q2", "", "", "US")], SCHEMA)
    ref = spark.createDataFrame(
        [("r1", "ACME Limited", "99 Oak Road", "US"), ("r2", "Zeta", "12 Main St", "US"), ("r3", "Acme Ltd", "12 Main Street", "India")],
        SCHEMA
    )
    a, b, plain = X.add_normalized_columns(one), X.add_normalized_columns(ref), X.add_sql_normalized_columns(ref)
    pairs = lambda df: {tuple(r) for r in df.collect()}
    both = {("q1", "r1"), ("q1", "r2")}
    assert pairs(B.block_priority(a, b)) == pairs(B.block_priority(a, plain)) == pairs(B.block_inverted(a, b)) == pairs(B.block_disk(a, b)) == both
    assert pairs(B.block_priority(a, plain, 1)) == {("q1", "r2")} and pairs(B.block_priority(a, b, 1)) == {("q1", "r1")}
    s = B.blocking_stats(B.block_priority(a, b), one, ref).first()
    assert (s.average_candidates, s.maximum_candidates, round(s.candidate_reduction_ratio, 6)) == (1.0, 2.0, round(1 - 2 / 6, 6))
    assert B.blocking_stats(B.block_priority(a, b), one.limit(0), ref).first().candidate_reduction_ratio == 1.0


def test_truth_and_unique(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("source1_entity_id\tmatched_entity_ids\nq1\tS2-1, S3-2,,S2-1\nq2\t\n")
    got = {r[0]: sorted(r[1]) for r in tables.load_ground_truth(spark, str(tmp_path / "t.tsv")).collect()}
    assert got == {"q1": ["S2-1", "S3-2"], "q2": []}
    with pytest.raises(ValueError):
        tables.require_unique(spark.createDataFrame([("a",), ("a",)], "entity_id string"))


def test_normalize_text_in_both_engines(spark):
    """ASCII texts, which the JVM folds, come out as the others do."""
    texts = [*TEXTS, "A\tb\x1cC  d", " _x__Y- ", "\x0b\x0c!", "I.B.M. 'n Co", "a" * 3000 + "!" * 10]
    got = spark.createDataFrame(list(enumerate(texts)), "n int, raw string").select("n", X.normalize_text("raw").alias("x")).collect()
    assert [r.x for r in sorted(got)] == [X.fold(t) for t in texts]


def test_priority_blocking_without_limits(spark):
    """Cutting postings to the cap loses no candidate: all keys of all records, ranked one by one."""
    r = random.Random(3)
    word = lambda: r.choice("alpha beta gamma delta corp road lane".split())
    make = lambda k, n: [(f"{k}{i:03}", f"{word()} {word()}", f"{r.randrange(4)} {word()} {word()}", r.choice(["us", "de"])) for i in range(n)]
    one, ref = make("q", 40), make("r", 150)
    a, b = (X.add_normalized_columns(spark.createDataFrame(x, SCHEMA)) for x in (one, ref))
    left, right = ([x.asDict() for x in f.collect()] for f in (a, b))
    for cap in (2, 7, 40):
        want = set()
        for x in left:
            ranked = []
            for y in right:
                if x["country_normalized"] != y["country_normalized"]:
                    continue
                if any(x[k] and x[k] == y[k] for k in ("name_normalized", "address_normalized", "house_number", "postal_code")):
                    ranked.append((1, y["entity_id"]))
                elif set(x["name_normalized"].split()) & set(y["name_normalized"].split()):
                    ranked.append((2, y["entity_id"]))
                elif set(x["address_normalized"].split()) & set(y["address_normalized"].split()):
                    ranked.append((3, y["entity_id"]))
            want |= {(x["entity_id"], i) for _, i in sorted(ranked)[:cap]}
        assert {tuple(p) for p in B.block_priority(a, b, cap).collect()} == want


def test_readers(spark, tmp_path):
    """Short rows, null tokens, quoted fields, line ends in quotes, repeated ids."""
    path = str(tmp_path / "s.tsv")
    head = "\t".join(tables.SOURCE_COLUMNS)
    with open(path, "w") as f:
        f.write(f'{head}\na\tone\nb\t"two ""x"""\tNA\tus\na\tlast\troad\tde\n')
    got = [tuple(r) for r in tables.read_tsv(spark, path).collect()]
    assert got == [("a", "one", None, None), ("b", 'two "x"', None, "us"), ("a", "last", "road", "de")]
    one = lambda keep: sorted(tuple(r)[:2] for r in tables.unique_rows(tables.read_tsv(spark, path, place=True), keep).collect())
    assert one("first") == [("a", "one"), ("b", 'two "x"')] and one("last") == [("a", "last"), ("b", 'two "x"')] and len(one("any")) == 3
    with pytest.raises(ValueError):
        one("error")
    with open(path, "w") as f:
        f.write(f'{head}\na\t"two\nlines"\troad\tus\n')
    assert [tuple(r) for r in tables.read_tsv(spark, path, quoted_lines=True).collect()] == [("a", "two\nlines", "road", "us")]
    with pytest.raises(Exception, match="goes on in the next line"):
        tables.read_tsv(spark, path).collect()
    for n in (1, 2, 3):
        (tmp_path / f"x_source{n}.tsv").write_text(f"{head}\nsame\tname{n}\troad\tus\nown{n}\tx\ty\tus\n")
    both = tables.load_reference_sources(spark, str(tmp_path), "x", place=True)
    for keep, n in (("first", 2), ("last", 3)):
        got = sorted(tuple(r) for r in tables.unique_rows(both, keep).select("entity_id", "business_name", "record_source").collect())
        assert got == [("own2", "x", "source2"), ("own3", "x", "source3"), ("same", f"name{n}", f"source{n}")]
    with open(path, "w") as f:
        f.write("source1_entity_id\tmatched_entity_ids\nq\tx,y\nq\tz\n")
    assert [tuple(r) for r in tables.load_ground_truth(spark, path).collect()] == [("q", ["z"])]


def test_inspect_dataset(spark, tmp_path):
    for part in ("train", "test"):
        (tmp_path / part).mkdir()
        for n in (1, 2, 3):
            (tmp_path / part / f"{part}_source{n}.tsv").write_text("\t".join(tables.SOURCE_COLUMNS) + "\n" + f"S{n}-1\tx\t\tus\n" * n)
    profiles, countries = tables.inspect_dataset(spark, str(tmp_path))
    got = {(r.part, r.source, r.column): (r.n_rows, r.n_nulls) for r in profiles.collect()}
    assert len(got) == 24 and got["test", "source3", "business_address"] == (3, 3) and got["train", "source1", "country"] == (1, 0)
    assert {(r.part, r.source, r.country, r.n_rows) for r in countries.collect()} == {
        (p, f"source{n}", "us", n) for p in ("train", "test") for n in (1, 2, 3)
    }


def test_evaluation_without_ids(spark):
    truth = spark.createDataFrame([("e1", ["a"])], "source1_entity_id string, matched array<string>")
    scored = spark.createDataFrame([("e1", "a", 0.9)], "source1_entity_id string, candidate_entity_id string, match_probability double")
    got = E.evaluate(scored, truth, truth.select("source1_entity_id").limit(0), 0.5).first().asDict()
    assert got == dict.fromkeys(
        ("macro_f0_5", "macro_precision", "macro_recall", "singleton_accuracy", "predicted_matches", "entities"), 0.0
    )


@pytest.mark.parametrize("engine", ["inverted", "disk"])
def test_engines_end_to_end(spark, tmp_path, engine):
    from tessera import cli

    one = spark.createDataFrame([(f"q{k}", f"Firm alpha{k}", f"{k} Road", "US") for k in range(5)], SCHEMA)
    ref = spark.createDataFrame([(f"r{k:03}", f"Firm alpha{k % 5}", f"{k} Lane", "US") for k in range(120)], SCHEMA)
    a, b = X.add_normalized_columns(one), X.add_normalized_columns(ref)
    got = {tuple(r) for r in cli.candidates(a, b, ref, engine, 500).collect()}
    firsts = {f"r{k:03}" for k in range(50)}  # of the word that all records have, the driver takes fifty
    assert {c for _, c in got} >= firsts and {c for q, c in got if q == "q0"} <= firsts | {f"r{k:03}" for k in range(0, 120, 5)}


def test_train_and_predict(spark, tmp_path):
    from tessera import cli

    head = "\t".join(tables.SOURCE_COLUMNS)
    for prefix in ("train", "test"):
        for n in (1, 2, 3):
            lines = [
                f"S{n}-{k}\tFirm {k} alpha{k} Limited\t{k} Road{k % 7}\t{'US' if k % 2 else 'NA'}" for k in range(40) if n == 1
                or k % 3 != n - 2
            ]
            (tmp_path / f"{prefix}_source{n}.tsv").write_text("\n".join([head, *lines]) + "\n")
    truth = [f"S1-{k}\t" + ",".join(f"S{n}-{k}" for n in (2, 3) if k % 3 != n - 2) for k in range(40)]
    (tmp_path / "train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "\n".join(truth) + "\n")
    record = cli.train(spark, str(tmp_path), str(tmp_path / "out"), rounds=3, cap=20)
    assert record["best"]["macro_f0_5"] > 0.8 and record["blocking"]["candidate_recall"] == 1.0
    paths = cli.predict(spark, str(tmp_path), str(tmp_path / "out/model"), str(tmp_path / "sub"), cap=20)
    got = [spark.read.csv(p, sep="\t", header=True).count() for p in paths]
    assert got == [40, 40]


def test_stream(spark, tmp_path):
    from tessera.streaming.scoring import stream_candidates

    rows = spark.createDataFrame([("q1", "Acme Ltd", "12 Main Street", "US")], SCHEMA)
    rows.write.parquet(str(tmp_path / "in"))
    ref = X.add_normalized_columns(spark.createDataFrame([("r1", "ACME Limited", "99 Oak Road", "US")], SCHEMA))
    out = str(tmp_path / "pairs")
    q = stream_candidates(
        spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), ref, lambda df,
        n: df.write.mode("overwrite").parquet(f"{out}/batch={n}"), str(tmp_path / "ck")
    )
    q.awaitTermination(120)
    assert [tuple(r) for r in spark.read.parquet(out).select("source1_entity_id", "candidate_entity_id").collect()] == [("q1", "r1")]


def test_pairs_are_dealt_as_lists(spark):
    """No exchange of a blocking, a fetch or the labels holds a row a pair, and pairs of a word are made once."""
    make = lambda k, n: spark.createDataFrame([(f"{k}{i:03}", f"alpha beta w{i % 3}", f"{i % 4} road w{i % 5}", "us") for i in range(n)], SCHEMA)
    a, b = X.add_normalized_columns(make("q", 30)), X.add_normalized_columns(make("r", 60))
    lists = B.candidate_lists(a, b, 20)
    assert {len(r.candidates) for r in lists.collect()} == {20}
    truth = spark.createDataFrame([("q000", ["r000", "r999"]), ("q001", [])], "source1_entity_id string, matched array<string>")
    labelled = training.label_lists(lists, truth)
    key = lambda df: sorted(tuple(r) for r in df.select("source1_entity_id", "candidate_entity_id", "target").collect())
    assert key(labelled) == key(training.label_pairs(B.pairs_of(lists), truth)) and sum(r.target for r in labelled.collect()) == 1
    plan = training.thin_negatives(labelled)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [row_number() windowspecdefinition(source1_entity_id") == 1
    shared = B.share_token(a, b, "name_token")
    assert "HashAggregate" not in shared._jdf.queryExecution().executedPlan().toString()
    left, right = ([(r.entity_id, set(r.name_normalized.split())) for r in f.collect()] for f in (a, b))
    assert sorted(tuple(r) for r in shared.collect()) == sorted((x, y) for x, u in left for y, v in right if u & v)


def test_features_meet_records_by_group(spark):
    """Records of a pair travel once a group: no exchange has both sides' texts, and chosen columns are as among all."""
    make = lambda k, n: spark.createDataFrame([(f"{k}{i:03}", f"alpha b{i % 7}", f"{i % 4} road w{i % 5}", "us") for i in range(n)], SCHEMA)
    a, b = X.add_normalized_columns(make("q", 20)), X.add_normalized_columns(make("r", 50))
    lists = B.candidate_lists(a, b, 30)
    every = {(r.source1_entity_id, r.candidate_entity_id): r for r in P.build_pair_features(a, b, B.pairs_of(lists)).collect()}
    assert len(every) == 600
    for columns in (["name_token_sort_ratio"], ["name_partial_ratio", "address_partial_ratio"], ["address_levenshtein_similarity", "country_match"]):
        df = P.build_pair_features(a, b, lists, columns=columns)
        assert df.columns[2:] == [c for c in P.FEATURE_COLUMNS if c in columns]
        assert all(every[r.source1_entity_id, r.candidate_entity_id][c] == r[c] for r in df.collect() for c in columns)
    plan = P.build_pair_features(a, b, lists, columns=["name_character_similarity"])._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin [candidate_entity_id#" not in plan.split("ShuffledHashJoin")[0]


def test_long_texts_are_combed(monkeypatch):
    """Texts beyond 64 characters are compared without one pair at a time, with characters of any code."""
    texts = ["ab" * 40 + "c", "ba" * 45, "\x00ÿþ" * 30, "हिन्दी" * 20, "ab" * 200]
    want = {(a, b): (S.indel_ratio(a, b), S.partial_ratio(a, b)) for a in texts for b in texts}
    for name in ("lcs", "indel_ratio", "partial_ratio"):
        monkeypatch.delattr(S, name)
    left, right = zip(*want)
    assert list(zip(*(x.tolist() for x in S.ratios(list(left), list(right))))) == list(want.values())


def test_gram_codes(spark):
    """Numbers of grams are alike where grams are, for characters of any plane."""
    texts = ["", "a", "abab abab", "हिन्दी", "𝔸b𝔸b𝔸", "éa é", "\U0010ffffab"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.char_ngrams(F.col("t"), (3,)).alias("g"), X.gram_codes(F.col("t")).alias("n"))
    for r in df.collect():
        assert [sum(ord(c) << 42 - 21 * k for k, c in enumerate(g)) for g in r.g] == r.n


def test_lists_have_the_features_and_labels_of_pairs(spark):
    """Packed lists hold all pairs once a record of an id, with the codes of the pairs' features, for odd texts and ids too."""
    import numpy as np
    import pyarrow as pa

    from tessera.operators import boosting

    r = random.Random(8)
    texts = ["", None, "!", "a", "A B a", "हिन्दी 𝔸b", "ab " * 40, "12 Main St 560001", "12b main st"] + [" ".join(r.choice("acme corp ltd b7 12 é".split()) for _ in range(4)) for _ in range(30)]
    make = lambda k, n: X.add_normalized_columns(spark.createDataFrame([(f"{k}{i:02}", r.choice(texts), r.choice(texts), r.choice(["us", "de", None])) for i in range(n)] + [(f"{k}00", "twice", "1 x", "us")], SCHEMA)).persist()
    a, b = make("q", 25), make("r", 40)
    a = a.unionByName(X.add_normalized_columns(spark.createDataFrame([("q30", "a", "a", "x"), ("q31", "a", "a", "y")], SCHEMA)))  # groups without a pair
    lists = spark.createDataFrame([(f"q{i:02}", [f"r{j:02}" for j in range(i, 45)]) for i in range(27)] + [("q30", []), ("q31", ["r99"])], "source1_entity_id string, candidates array<string>")
    truth = spark.createDataFrame([("q00", ["r00", "r41"]), ("q03", ["r05", "r01", "r07"]), ("q90", ["r01"])], "source1_entity_id string, matched array<string>")
    want = []
    for x in training.label_pairs(P.build_pair_features(a, b, B.pairs_of(lists)), truth).collect():
        codes = training.coded({c: np.array([x[c]]) for c in P.FEATURE_COLUMNS}, P.FEATURE_COLUMNS)[:, 0].tolist()
        want.append((x.source1_entity_id, x.candidate_entity_id, x.target, *codes))
    got, rows = [], training.packed_lists(a, b, lists, truth).collect()
    held = {x.source1_entity_id for x in training.split_by_source1(lists)[1].collect()}
    for x in rows:
        pairs = pa.ipc.open_stream(x.pairs).read_all()
        columns = *(pairs[c].to_pylist() for c in pairs.column_names), boosting.unpressed(x.labels, x.n).astype(float).tolist(), *boosting.unpressed(x.codes, x.n * 18).reshape(18, x.n).tolist()
        assert {q in held for q in columns[0]} == {x.held} and x.positives == sum(columns[2])
        got += zip(*columns)
    assert len(want) > 700 and sum(x[2] for x in want) == 6 and sorted(got) == sorted(want)


def test_runs_of_queries_have_the_same_features(monkeypatch):
    import numpy as np

    from tessera.functions import listed

    side = {"name": ["a b", "", "b c", "a b"], "address": ["1 x", "1 x", "", "yy"], "country": ["u", "u", "", "u"], "house": ["1", "1", "", ""], "postal": [""] * 4, "numbers": [["1"], ["1"], [], None]}
    starts, rows = np.array([0, 3, 3, 7, 8]), np.array([0, 1, 2, 0, 1, 2, 3, 3])
    whole = list(listed.features(side, side, starts, rows))
    monkeypatch.setattr(listed, "AT_ONCE", 2)
    runs = list(listed.features(side, side, starts, rows))
    assert len(whole) == 1 and [x[:2] for x in runs] == [(0, 1), (1, 2), (2, 3), (3, 4)]
    for c in P.FEATURE_COLUMNS:
        assert np.concatenate([x[2][c] for x in runs]).tolist() == whole[0][2][c].tolist()


def test_trees_of_one_stage(spark, tmp_path):
    """As good as Spark's own boosted trees on the same rows, in a few jobs instead of some for each tree."""
    import numpy as np
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    r = np.random.default_rng(4)
    x = np.round(r.random((3000, len(P.FEATURE_COLUMNS))), 2)
    x[:, 11], x[:, 15:17] = 1.0, r.integers(0, 40, (3000, 2))
    y = ((x[:, 0] > 0.6) & (x[:, 15] < 25) | (x[:, 7] > 0.9) ^ (r.random(3000) < 0.02)).astype(float)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], [*P.FEATURE_COLUMNS, "target"]).repartition(3).persist()
    df.count()
    spark.sparkContext.setJobGroup("trees", "trees")
    bundle = training.fit_model(df, 30)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("trees"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 10 and len(bundle.model.leaf) == 30
    loss = lambda rows: -np.mean([np.log(p if t else 1 - p) for t, p in rows])
    scored = training.score(bundle, df).collect()
    own = loss([(s.target, s.match_probability) for s in scored])
    weight = min((y == 0).sum() / (y == 1).sum(), 10.0)
    rows = VectorAssembler(inputCols=P.FEATURE_COLUMNS, outputCol="features").transform(df).withColumn("weight", F.when(F.col("target") == 1, weight).otherwise(1.0))
    other = GBTClassifier(labelCol="target", weightCol="weight", maxIter=30, stepSize=0.1, maxDepth=5, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42).fit(rows)
    theirs = loss([(s.target, s.probability[1]) for s in other.transform(rows).select("target", "probability").collect()])
    assert own < 1.1 * theirs
    training.save_model(bundle, str(tmp_path / "model"), spark)
    again = training.score(training.load_model(str(tmp_path / "model"), spark), df).collect()
    assert [s.match_probability for s in again] == [s.match_probability for s in scored]
    for s in scored[:50]:  # one row and one node at a time
        codes, total = training.coded({c: np.array([s[c]]) for c in P.FEATURE_COLUMNS}, P.FEATURE_COLUMNS)[:, 0], 0.0
        for feature, cut, leaf in zip(bundle.model.feature, bundle.model.cut, bundle.model.leaf):
            k = 0
            while k < len(feature):
                k = 2 * k + 1 + (feature[k] >= 0 and codes[feature[k]] > cut[k])
            total += leaf[k - len(feature)]
        assert abs(1 / (1 + np.exp(-2 * total)) - s.match_probability) < 1e-12
    with pytest.raises(ValueError):
        training.fit_model(df.where("target = 1"), 2)


def test_features_of_lists(spark):
    """pair_features_all makes no text pair by pair: lists are packed once and have the features of pairs, for odd texts and ids too."""
    from tessera.plans.catalogue import QUERIES

    r = random.Random(3)
    texts = ["", None, "!", "a", "A B a", "हिन्दी 𝔸b", "ab " * 40, "12 Main St 560001", "12b main st"] + [" ".join(r.choice("acme corp ltd b7 12 é".split()) for _ in range(4)) for _ in range(30)]
    make = lambda k, n: X.add_normalized_columns(spark.createDataFrame([(f"{k}{i:02}", r.choice(texts), r.choice(texts), r.choice(["us", "de", None])) for i in range(n)] + [(f"{k}00", "twice", "1 x", "us"), (None, "a", "a", "us")], SCHEMA)).persist()
    a, b = make("q", 25), make("r", 40)
    lists = spark.createDataFrame([(f"q{i:02}", [f"r{j:02}" for j in range(i, 45)]) for i in range(27)] + [("q30", []), (None, ["r01"])], "source1_entity_id string, candidates array<string>")
    key = lambda df: sorted(tuple(x) for x in df.collect())
    want = key(P.build_pair_features(a, b, B.pairs_of(lists)))
    assert len(want) > 700 and key(P.list_features(a, b, lists)) == want
    at = [0, 1, *(2 + P.FEATURE_COLUMNS.index(c) for c in ("name_partial_ratio", "country_match"))]
    assert key(P.list_features(a, b, lists, ["country_match", "name_partial_ratio"])) == sorted(tuple(x[k] for k in at) for x in want)
    assert not P.list_features(a, b, lists.where("source1_entity_id = 'q30'")).collect()
    dealt = B.candidate_lists(a, b, 7, by=P.group_of(a))
    assert key(P.list_features(a, b, dealt)) == key(P.build_pair_features(a, b, B.candidate_lists(a, b, 7)))
    plan = QUERIES["pair_features_all"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython [made(" not in plan and "InMemoryRelation [group" in plan


def test_features_are_rounded_half_up():
    import numpy as np

    values = np.array([k / n for n in (1, 3, 7, 64, 128, 384, 640, 3200, 8192) for k in range(n + 1)])
    from decimal import ROUND_HALF_UP, Decimal

    assert P.rounded(values, 6).tolist() == [float(Decimal(repr(x)).quantize(Decimal("0.000001"), ROUND_HALF_UP)) for x in values.tolist()]


def test_words_meet_in_cells(spark, monkeypatch):
    """Pairs of a word are made as arrays of a cell, each once for odd ids and words, in whatever slices."""
    import pyarrow as pa

    r = random.Random(5)
    words = ["acme", "corp", "b7", "हिन्दी", "x", "é"]
    make = lambda k, n: X.add_normalized_columns(spark.createDataFrame([(f"{k}{i % 37:02}", " ".join(r.choice(words) for _ in range(i % 4)), None, r.choice(["us", None])) for i in range(n)], SCHEMA)).persist()
    a, b = make("q", 50), make("r", 70)
    left, right = ([(x.entity_id, x.country_normalized, set(x.name_normalized.split())) for x in f.collect()] for f in (a, b))
    by = {c: {(x, y) for x, u, v in left for y, w, z in right if u == w == c and v & z} for c in ("us", "")}
    for size, cells in ((B.SLICE, B.CELLS), (20, 1), (9, 5)):
        monkeypatch.setattr(B, "SLICE", size)
        monkeypatch.setattr(B, "CELLS", cells)
        for country, want in by.items():
            one, two = (f.where(F.col("country_normalized") == country) for f in (a, b))
            shared = B.share_token(one, two, "name_token")
            assert sorted(tuple(x) for x in shared.collect()) == sorted(want) and want
        assert {tuple(x) for x in B.share_token(a, b, "name_token").collect()} == by["us"] | by[""]
    plan = shared._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan and "Generate explode(candidates" in plan
    monkeypatch.setattr(B, "PAIRS", 3)
    rows = [("us", 0, 0, 0, f"r{i}", ["a"] if i % 2 else ["a", "b"]) for i in range(4)] + [("us", 0, 0, 1, x, w) for x, w in (("p", ["c"]), ("q", ["a"]), ("q", ["b"]), ("s", ["b"]))] + [("us", 0, 1, 1, "q", ["a"])]
    batches = pa.table(dict(zip(("country", "left", "right", "side", "entity_id", "words"), map(list, zip(*rows))))).to_batches(max_chunksize=3)
    got = [(x["source1_entity_id"], x["candidates"]) for y in B.marked(iter(batches)) for x in y.to_pylist()]
    assert got == [("q", ["r0", "r1", "r2", "r3"]), ("s", ["r0", "r2"])]
