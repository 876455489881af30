"""Every query with SQL gives the rows that DuckDB gives; those without run and hold their properties."""

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans.catalogue import QUERIES, one, ref

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(rows, columns):
    order = sorted(columns)
    at = [columns.index(c) for c in order]
    return order, sorted((tuple(str(round(r[i], 6) + 0.0) if isinstance(r[i], float) else str(r[i]) for i in at) for r in rows))


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(entry.oracle_sql())))
def test_parity(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    got = plain([tuple(r) for r in df.collect()], df.columns)
    want = duck.execute(entry.oracle_sql()[name])
    assert got == plain(want.fetchall(), [c[0] for c in want.description])
    assert got[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(entry.oracle_sql())))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_all_features(spark, sf_dir, duck):
    """The columns of pair_features_all that have SQL of their own, and the best windows of some pairs one by one."""
    df = QUERIES["pair_features_all"](spark, sf_dir)
    rows = {(r.source1_entity_id, r.candidate_entity_id): r.asDict() for r in df.collect()}
    checked = set()
    for name in (
        "feat_token_jaccard", "feat_char_jaccard", "feat_cosine", "feat_numeric", "feat_flags", "feat_length", "feat_indel",
        "feat_token_sort"
    ):
        want = duck.execute(entry.oracle_sql()[name])
        columns = [c[0] for c in want.description]
        for row in want.fetchall():
            got = dict(zip(columns, row, strict=True))
            mine = rows[got["source1_entity_id"], got["candidate_entity_id"]]
            assert all(abs(float(got[c]) - mine[c]) < 2e-6 for c in columns[2:])
        checked |= set(columns[2:])
    assert len(checked) == 15

    def common(a, b):
        best = [0] * (len(b) + 1)
        for x in a:
            was = best[:]
            for j, y in enumerate(b):
                best[j + 1] = was[j] + 1 if x == y else max(was[j + 1], best[j])
        return best[-1]

    def plain_partial(a, b):
        if not a or not b:
            return float(a == b)
        if len(a) == len(b):
            return max(windowed(a, b), windowed(b, a))
        return windowed(*sorted((a, b), key=len))

    def windowed(short, long):
        parts = [long[max(0, i) : i + len(short)] for i in range(1 - len(short), len(long))]
        return max(2 * common(short, w) / (len(short) + len(w)) for w in parts)

    text = {r.entity_id: r for f in (one, ref) for r in f(spark, sf_dir).collect()}
    for pair in sorted(rows)[:: max(1, len(rows) // 40)]:
        x, y = (text[i] for i in pair)
        assert abs(rows[pair]["name_partial_ratio"] - plain_partial(x.name_normalized, y.name_normalized)) < 1e-9
        assert abs(rows[pair]["address_partial_ratio"] - plain_partial(x.address_normalized, y.address_normalized)) < 1e-9


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
