"""Each operator against a brute-force version, an exact round trip or held-out accuracy; nulls, ties and empty tables."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import queries as Q
from tessera.llm.common import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "".join(random.Random(1).choice("abcdefg hij. ") for _ in range(700))
EDGE = [
    None, "", " \n", "A", "a", "ß", "Hello world", "hello WORLD", "HELLO world", LONG, "x" + LONG, LONG, LONG[100:650] + "tail",
    "ab" * 900, "naïve <|endoftext|> 日本語 ١٢٣  \n\n x's", "word " * 3000, "12345 %%% !!!", "z" * 5000,
]


@pytest.fixture(scope="module")
def edge(spark, tmp_path_factory):
    """documents of edge cases, with a repeated row, a null doc_id and columns whose names operators use themselves."""
    d = str(tmp_path_factory.mktemp("edge"))
    rows = [(n, t, "en" if n % 2 else "de", None, 0, "extra", 5) for n, t in enumerate(EDGE)]
    rows += [rows[9], (None, "unowned", None, None, None, None, None)]
    spark.createDataFrame(rows, DOCS + ", owner string, fp long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(
        [(1, 1, 0), (5, 0, 0), (6, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int"
    ).write.parquet(f"{d}/labels.parquet")
    return d


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for name, schema in {
        "documents": DOCS, "labels": "doc_id long, quality int, toxic int", "embeddings": "vec_id long, embedding array<float>, label int",
        "pages": "page_id long, url string, html string", "conversations": "conv_id long, turn long, role string, text string",
    }.items():
        spark.createDataFrame([], schema).write.parquet(f"{d}/{name}.parquet")
    return d


def documents(spark, d):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_empty_tables(spark, empty, name):
    got = Q.QUERIES[name](spark, empty).collect()
    assert [r.conv_id for r in got] == [-1] if name == "op2_chat" else got == []


@pytest.fixture(params=["edge", "sf"])
def data(request, edge, sf_dir):
    return edge if request.param == "edge" else sf_dir


def tokenizer(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(Q.tokenizer_path(name))
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe(spark, data):
    t = tokenizer("byte_bpe_50k.json")
    want = []
    for i, text in documents(spark, data):
        ids = t.encode(text, add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))))
    assert rows(Q.op1_bpe(spark, data), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def test_bpe_random_texts():
    from tessera.llm.bpe import Codec, Encoder

    rnd = random.Random(2)
    texts = ["".join(rnd.choice(" aeThinkgäß\n'sdvlre.,!1½“") for _ in range(80)) for _ in range(1500)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(32, 0x2FF), rnd.randrange(0x300, 0xD000)])) for _ in range(30)) for _ in range(300)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        t = tokenizer(name)
        with open(Q.tokenizer_path(name), encoding="utf-8") as f:
            codec = Codec(f.read())
        got = Encoder(codec).encode(texts)
        assert [g.tolist() for g in got] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_bpe_long_words_and_other_files():
    """Words of any length take the one path, special tokens need no sign of their own, unknown files are errors."""
    import json

    from tessera.llm.bpe import Codec, Encoder

    with open(Q.tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    codec = Codec(json.dumps(spec))
    t = tokenizer("byte_bpe_50k.json")
    rnd = random.Random(3)
    texts = ["the" * 200, "".join(rnd.choice("etaoinsh") for _ in range(5000)), "interest" * 90 + "'s", "=" * 3000, "ab" + "é" * 400]
    called, exact = [], codec.merged
    codec.merged = lambda word: called.append(1) or exact(word)
    assert [g.tolist() for g in Encoder(codec).encode(texts)] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert len(called) < len(texts)  # some proposals of long words were right
    for text in texts:
        symbols = list(text.encode())
        assert codec.proposed_one(symbols) == codec.proposed(np.array(symbols), np.array([0]), np.array([len(symbols)]))[1].tolist()
    from tokenizers import Tokenizer

    spec["added_tokens"].append(spec["added_tokens"][0] | {"id": 50257, "content": "[STOP]"})
    own = Tokenizer.from_str(json.dumps(spec))
    text = ["a [STOP] b<|endoftext|>[STOP"]
    assert Encoder(Codec(json.dumps(spec))).encode(text)[0].tolist() == own.encode(text[0], add_special_tokens=False).ids
    for change in (
        {"pre_tokenizer": {"type": "Whitespace"}}, {"normalizer": {"type": "NFC"}},
        {"model": spec["model"] | {"byte_fallback": True}}
    ):
        with pytest.raises(ValueError):
            Codec(json.dumps(spec | change))


def test_bpe_round_trip(spark, edge):
    from tessera.llm.bpe import bpe_decode, bpe_encode

    docs = spark.read.parquet(f"{edge}/documents.parquet")
    path = Q.tokenizer_path("byte_bpe_50k.json")
    back = bpe_decode(bpe_encode(docs, path), path)
    assert rows(back, "doc_id", "decoded") == sorted(documents(spark, edge), key=repr)


def chat_of(spark, d):
    by = defaultdict(list)
    for r in Q.op2_conversations(spark, d).collect():
        by[r.conv_id].append(((r.turn is not None, r.turn or 0, r.role or "", r.text or ""), r.role or "", r.text or ""))
    for conv, turns in by.items():
        turns = [t[1:] for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        yield conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)


def test_chat(spark, sf_dir, tmp_path):
    columns = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert rows(Q.op2_chat(spark, sf_dir), *columns) == sorted(chat_of(spark, sf_dir), key=repr)
    odd = [
        (1, 0, "system", "be\\ [INST] <s>"), (1, 1, None, None), (1, 2, "assistant", "x</s>\\"), (1, 2, "assistant", "x</s>\\"),
        (1, None, "to\nol", "\\"), (None, 1, "user", "[/INST]")
    ]
    odd += [(7, n, ("user", "assistant")[n % 2], f"<s>{n} " + "long text " * (n % 40 * 30)) for n in range(120)]
    spark.createDataFrame(odd, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert rows(Q.op2_chat(spark, str(tmp_path)), *columns) == sorted(chat_of(spark, str(tmp_path)), key=repr)


def test_chat_windows_keep_budget_system_and_history(spark):
    from tessera.llm.chat import chat_windows, parse

    turns = [(1, 0, "system", "be brief")] + [(1, n, ("assistant", "user")[n % 2], f"turn {n} " + "word " * 40) for n in range(1, 30)]
    out = sorted(
        chat_windows(
            spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"),
            Q.tokenizer_path("byte_bpe_50k.json"), 300, 120
        ).collect(),
        key=lambda r: r.window
    )
    assert len(out) > 3 and all(r.n_tokens <= 300 for r in out)
    assert all(parse(r.text)[0] == ("system", "be brief") for r in out)
    assert all(r.n_repeated > 1 for r in out[1:])


def plain_windows(turns, budget, history):
    """(repeated, new, tokens) of each window, by adding up turn by turn."""
    i = 0
    while i < len(turns):
        system = turns[:1] if i and turns[0][0] == "system" else []
        recent, total = [], 0
        for t in reversed(turns[len(system) : i]):
            if (total := total + t[2]) > history:
                break
            recent.insert(0, t)
        repeated = system + recent
        while repeated and sum(t[2] for t in repeated) + turns[i][2] > budget:
            repeated.pop(1 if system and len(repeated) > 1 else 0)
        j, total = i + 1, sum(t[2] for t in repeated) + turns[i][2]
        while j < len(turns) and total + turns[j][2] <= budget:
            total, j = total + turns[j][2], j + 1
        yield len(repeated), j - i, total, [t[1] for t in repeated + turns[i:j]]
        i = j


def test_chat_spans_by_prefix_sums():
    from tessera.llm.chat import parse, windows

    rnd = random.Random(14)
    for _ in range(3000):
        turns = [
            (
                "system" if n == 0 and rnd.random() < 0.5 else rnd.choice(["user", "assistant"]), f"t{n}",
                rnd.randrange(1, rnd.choice([5, 40, 120]))
            )
            for n in range(rnd.randrange(1, 30))
        ]
        budget = rnd.randrange(20, 100)
        history = rnd.randrange(budget)
        got = [(r, n, tokens, [said for _, said in parse(text)]) for text, _, r, n, tokens in windows(iter(turns), budget, history)]
        assert got == list(plain_windows(turns, budget, history))


def test_chat_long_turn():
    """A turn of 6 million characters is parsed in little more than its own bytes, and read back as it was."""
    import tracemalloc

    from tessera.llm.chat import formatted, parse

    text = "ab \\ <x [y [INST] é\n" * 300_000
    written = formatted("user", text)[0]
    tracemalloc.start()
    assert parse(written) == [("user", text)]
    assert tracemalloc.get_traced_memory()[1] < 20 * len(text.encode())
    tracemalloc.stop()


def test_vectors(spark, sf_dir, tmp_path):
    rng = np.random.default_rng(5)
    made, n = [], 10_000
    base = rng.normal(size=(40, 64))
    for k, b in enumerate(base):
        for _ in range(1 + k % 12 * 6):
            near = b + rng.normal(size=64) * np.linalg.norm(b) / 8 * 0.27  # cosines on both sides of the threshold
            made.append((n, [float(x) for x in near.astype(np.float32)], k % 3))
            n += 1
    made += [
        (n + 1, None, 1), (n + 2, [0.0] * 64, 1), (n + 3, [float("nan")] * 64, 1), (n + 4, [None] * 64, 1),
        (n + 5, made[0][1], None), (n + 6, made[0][1][:5], 0), (n + 7, made[0][1], 0), (n + 8, [], 0), (n + 9, made[0][1], 0)
    ]
    spark.createDataFrame(made, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    for d in (str(tmp_path), sf_dir):
        vectors = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
        links, by = set(), defaultdict(list)
        for i, v, label in vectors:
            if v and label is not None and None not in v and np.isfinite(v).all() and np.any(v):
                by[label, len(v)].append((i, np.array(v) / np.linalg.norm(v)))
        for group in by.values():
            x = np.stack([v for _, v in group])
            for a, b in zip(*np.nonzero(np.triu(x @ x.T >= 0.93, 1)), strict=True):
                links.add((group[a][0], group[b][0]))
        root = union(links)
        degree = Counter(i for pair in links for i in pair)
        want = sorted((i, degree[i], root.get(i, i), root.get(i, i) == i) for i, _, _ in vectors)
        got = rows(Q.op3_embedding_near_dedup(spark, d), "vec_id", "n_links", "component_id", "kept")
        found, expected = sum(r[1] for r in got), sum(r[1] for r in want)
        assert expected * 0.999 <= found <= expected
        if found == expected:
            assert sorted(got) == want


def test_vectors_sql(spark, sf_dir, tmp_path):
    """The SQL gives the operator's rows, also where there are links."""
    import duckdb

    rng = np.random.default_rng(6)
    base = rng.normal(size=(8, 16))
    made = [
        (n, [float(x) for x in base[n % 8] + rng.normal(size=16) * 0.1], n % 2) for n in range(60)
    ] + [(60, None, 1), (61, [0.0] * 16, 0), (62, [1.0] * 16, None)]
    spark.createDataFrame(made, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    for path, d in ((f"{tmp_path}/embeddings.parquet/*.parquet", str(tmp_path)), (f"{sf_dir}/embeddings.parquet", sf_dir)):
        c = duckdb.connect()
        c.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
        want = c.execute(Q.ORACLE_SQL["op3_embedding_near_dedup"]).fetchall()
        assert rows(Q.op3_embedding_near_dedup(spark, d), "vec_id", "n_links", "component_id", "kept") == sorted(want, key=repr)


def at_threshold(dim, n):
    """Random pairs of unit vectors at a cosine just above 0.93."""
    rng = np.random.default_rng(9)
    a, b = rng.normal(size=(2, n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (b * a).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    return a, 0.930001 * a + np.sqrt(1 - 0.930001**2) * b


@pytest.mark.parametrize("label", [4_000, 16_000, 60_000, 250_000, 1_000_000, 4_000_000, 100_000_000, 1_000_000_000])
def test_vectors_meet_at_every_setting(label):
    """Of pairs at the threshold hardly any has no filter in common, whatever the size of the largest label."""
    from tessera.llm.vectors import Tables, settings

    tables = Tables(64, *settings(label))
    met = set()
    for at in range(0, 1000, 100):
        one, two = ({(int(v), int(f)) for v, f in zip(*tables.decode(x[at : at + 100]), strict=True)} for x in at_threshold(64, 1000))
        met |= {at + v for v, _ in one & two}
    assert len(met) >= 997


@pytest.mark.parametrize(("dim", "n"), [(64, 5000), (16, 2000), (8, 1000), (2, 500)])
def test_vectors_at_the_threshold(spark, dim, n):
    """No random pair just above a cosine of 0.93 is missed; every pair has a label of its own."""
    from tessera.llm.vectors import vector_near_dedup

    a, b = at_threshold(dim, n)
    made = [(2 * k + side, x[k].tolist(), k) for k in range(n) for side, x in enumerate((a, b))]
    got = vector_near_dedup(spark.createDataFrame(made, "vec_id long, embedding array<double>, label int"))
    assert got.where("n_links = 1").count() == 2 * n


def union(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {x: find(x) for x in list(parent)}


def test_components(spark):
    rnd = random.Random(4)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(1000 + n, 1001 + n) for n in range(60)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {k: v for k, v in union([x for x in links if x[0] != x[1]]).items()}


def test_language(spark, edge):
    got = {r.doc_id: r for r in Q.op4_language_id(spark, edge).collect()}
    assert all(got[n].lang_pred == "und" and got[n].score == 0 for n in (0, 1, 2, 16))
    assert all(0 <= r.score <= 1 for r in got.values())
    assert got[6].held_out == (zlib.crc32(b"6") % 4 == 2)
    assert len(got) == len(EDGE) + 1


def test_language_gradients():
    """Backpropagation through time against differences of the loss, with masked positions."""
    from tessera.llm.language import Direction

    rng = np.random.default_rng(3)
    d = Direction(rng, 5)
    x = rng.integers(97, 101, (12, 7))
    mask = (np.arange(12)[:, None] < np.array([12, 5, 1, 12, 9, 12, 3])).astype(np.float32)
    weight = rng.normal(size=(12, 7, 5)).astype(np.float32) * mask[:, :, None]
    loss = lambda: float((d.run(x, mask, 7).astype(np.float64) * weight).sum())
    _, kept = d.run(x, mask, 7, keep=True)
    for param, grad in zip((d.inputs, d.state), d.back(x, kept, weight), strict=True):
        some = np.argsort(-np.abs(grad).ravel())[: 30 : 2]
        for at in (np.unravel_index(n, param.shape) for n in some):
            was = param[at]
            param[at] = was + 0.003
            above = loss()
            param[at] = was - 0.003
            below = loss()
            param[at] = was
            assert abs((above - below) / 0.006 - grad[at]) < 0.02 * abs(grad[at]) + 0.003


def test_language_plain_forward_pass():
    """Pooled probabilities against one position at a time."""
    from tessera.llm.language import STEPS, Network

    net = Network(["a", "b", "c"], seed=8)
    texts = [b"", b"x", "zwölf Boxkämpfer jagen Viktor quer über den großen Deich".encode() * 5, bytes(range(256)), b"q" * STEPS]

    def states(d, block):
        h, out = np.zeros(d.state.shape[1]), []
        for byte in block:
            f = np.clip((d.inputs[0][byte] + h @ d.state[0]) / 4 + 0.5, 0, 1)
            h = h + f * (np.tanh(d.inputs[1][byte] + h @ d.state[1]) - h)
            out.append(h)
        return out

    want = []
    for t in texts:
        p = []
        for at in range(0, len(t), STEPS):
            block = t[at : at + STEPS]
            for one, two in zip(states(net.forth, block), states(net.back, block[::-1])[::-1], strict=True):
                z = np.exp(np.r_[one, two] @ net.out + net.bias)
                p.append(z / z.sum())
        want.append(np.mean(p, axis=0) if p else np.zeros(3))
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    got = net.pooled(np.frombuffer(b"".join(texts), np.uint8), offsets)
    assert np.abs(got - np.array(want)).max() < 1e-5


def test_language_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = [r for r in Q.op4_language_id(spark, d).collect() if r.held_out and r.lang_pred != "und"]
    assert len(got) > 200 and np.mean([lang[r.doc_id] == r.lang_pred for r in got]) > 0.95


def test_exact_dedup(spark, data):
    by = defaultdict(list)
    for i, t in documents(spark, data):
        by[t.encode().lower()].append(i)
    want = []
    for t, ids in by.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, sha(t)) for i in ids]
    assert rows(Q.op5_exact_dedup(spark, data), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)


def test_exact_dedup_in_pieces(spark):
    from tessera.llm.exact_dedup import exact_dedup

    texts = [(n, ("Hot", "hot", "cold", f"t{n}")[n % 4]) for n in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    got = rows(exact_dedup(docs, piece=16), "doc_id", "keep_id", "group_size")
    assert got == rows(exact_dedup(docs, piece=10_000), "doc_id", "keep_id", "group_size")
    assert (4, 0, 200) in got and (6, 2, 100) in got and (7, 7, 1) in got


def test_trie():
    from tessera.llm.exact_dedup import PatriciaTrie, common_prefix

    rnd = random.Random(6)
    words = sorted(bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(40))) for _ in range(3000))
    trie, out = PatriciaTrie(), []
    for n, w in enumerate(words):
        node, finished = trie.insert(w)
        out += finished
        assert b"".join(x.label for x in trie.path) == w
        if node.stored is None:
            node.stored = (w, [])
        assert node.stored[0] == w
        node.stored[1].append(n)
    out += trie.spill()
    assert sorted((x.stored[0], len(x.stored[1])) for x in out) == sorted(Counter(words).items())
    for a, b in zip(words, words[7:], strict=False):
        assert common_prefix(a, b) == next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    trie = PatriciaTrie()
    first, _ = trie.insert(b"shared stem, one")
    first.stored = 1
    second, finished = trie.insert(b"shared stem, two")
    assert finished == [first] and [n.label for n in trie.path] == [b"", b"shared stem, ", b"two"]  # one node for both
    assert trie.insert(b"shared stem, two and more")[1] == [] and trie.path[2] is second


def test_quality(spark, edge):
    got = {r.doc_id: r for r in Q.op6_quality(spark, edge).collect()}
    assert len(got) == len(EDGE) + 1 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())


def test_quality_plain_vote():
    """Blocked products and partial sorts against a vote that looks at every labelled vector in turn."""
    from tessera.llm.quality import NEIGHBOURS, POWER, Model

    rng = np.random.default_rng(4)
    x = (rng.random((300, 40)) < 0.3) * rng.random((300, 40))
    y = (x[:, 0] + 0.3 * rng.random(300) > 0.3).astype(int)
    m = Model(x.astype(np.float32), y, rank=8)
    some = x[:70].astype(np.float32) * 1.3
    some[5] = 0
    for row, got in zip(some, m.scores(some, block=16), strict=True):
        if not row.any():
            assert got == m.mean
            continue
        z = (row * m.idf / np.linalg.norm(row * m.idf)) @ m.basis
        near = sorted(
            ((float(v @ z / np.linalg.norm(z)), int(label)) for v, label in zip(m.vectors.T, m.labels, strict=True)), reverse=True
        )[:NEIGHBOURS]
        weight = [max(c, 0) ** POWER + 1e-6 for c, _ in near]
        assert abs(got - sum(w * label for w, (_, label) in zip(weight, near, strict=True)) / sum(weight)) < 1e-4


def test_quality_held_out(spark):
    d = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    got = [r for r in Q.op6_quality(spark, d).collect() if r.held_out and r.doc_id in label]
    good, bad = ([r.score for r in got if label[r.doc_id] == k] for k in (1, 0))
    assert np.mean([[(a > b) + (a == b) / 2 for b in bad] for a in good]) > 0.9


def test_simhash(spark, data):
    prints = {}
    for i, t in documents(spark, data):
        words = t.encode().lower().split()
        shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints.setdefault(i, sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    ids = [i for i in prints if i is not None]
    root = union([(a, b) for n, a in enumerate(ids) for b in ids[:n] if (prints[a] ^ prints[b]).bit_count() <= 3])
    got = rows(Q.op8_simhash_near_dedup(spark, data).where("doc_id is not null").distinct(), "doc_id", "fingerprint", "component_id")
    assert got == sorted(((i, f"{prints[i]:016x}", root.get(i, i)) for i in ids), key=repr)


def test_distance_tables():
    """A table's word holds what the distances to the references say, and its differences bound those of all unions."""
    from tessera.llm.simhash import REFERENCES, tables

    rnd = random.Random(17)
    prints = [0, (1 << 64) - 1] + [rnd.getrandbits(64) for _ in range(200)]
    words = tables(np.array(prints, np.uint64)).tolist()
    pairs = [int(r) for r in REFERENCES[1:]]
    for x, word in zip(prints, words, strict=True):
        counts = [(x.bit_count() - (x ^ p).bit_count() + 2) // 2 for p in pairs]
        assert [(word >> 2 * k & 3).bit_count() for k in range(32)] == counts
    for x, y, a, b in zip(prints, prints[1:], words, words[1:], strict=False):
        unions = [sum(c) for _ in range(50) for c in [rnd.sample(pairs, rnd.randrange(33))]]
        apart = [(x & p).bit_count() - (y & p).bit_count() for p in pairs]
        best = sum(p for p, d in zip(pairs, apart, strict=True) if d < 0)
        most = max(abs((x ^ u).bit_count() - (y ^ u).bit_count()) for u in [best, sum(pairs) - best, *unions])
        assert most == (a ^ b).bit_count() <= (x ^ y).bit_count()


def test_simhash_links_near_fingerprints(spark):
    from tessera.llm.simhash import links, tables

    rnd = random.Random(7)
    prints = set()
    for _ in range(150):
        base = rnd.getrandbits(64)
        prints |= {base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(6))) for _ in range(12)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    distances = tables(np.array(signed, np.int64).view(np.uint64)).view(np.int64).tolist()
    nodes = spark.createDataFrame(list(zip(signed, distances, strict=True)), "fp long, distances long")
    masked = (1 << 64) - 1
    want = union([(a, b) for n, a in enumerate(signed) for b in signed[:n] if ((a ^ b) & masked).bit_count() <= 3])
    for piece in (1024, 4):
        got = union([(r.u, r.v) for r in links(nodes, piece=piece).collect()])
        assert got == want


def repeats(texts, width):
    count = Counter(t[k : k + width] for t in texts for k in range(len(t) - width + 1))
    for t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - width + 1):
            if count[t[k : k + width]] > 1:
                gone[k : k + width] = True
        yield gone


def test_suffix_array_dedup(spark, data):
    docs = documents(spark, data)
    texts = [t.encode() for _, t in docs]
    want = []
    for (i, _), t, gone in zip(docs, texts, repeats(texts, 400), strict=True):
        left = np.frombuffer(t, np.uint8)[~gone].tobytes()
        want.append((i, len(t), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), sha(left)))
    assert rows(Q.op9_suffix_array_dedup(spark, data), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=repr)


def spans_of(gone):
    edges = np.diff(np.r_[0, gone.astype(int), 0])
    return list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True))


def test_passages_are_cut_and_short_repeats_stay(spark):
    """Fifty shared words go from every document that has them, fewer stay; columns may have any name."""
    from tessera.llm.substring import PASSAGE, PASSAGE_WORDS, without_repeats

    rnd = random.Random(13)
    prose = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 8))) for _ in range(n))
    passage, line = prose(52), prose(40)
    assert PASSAGE <= len(passage) < 400 and PASSAGE <= len(line) + 60
    own = [(prose(60), prose(30)) for _ in range(8)]
    made = [
        (n, f"{a} {(passage, line)[n % 2]} {b}", 1, "x", 2) for n, (a, b) in enumerate(own)
    ] + [(8, None, 0, None, 3), (None, "", 0, None, 3)]
    docs = spark.createDataFrame(made, "doc_id long, text string, spans int, SPAN_DIG string, dig int").repartition(3)
    out = without_repeats(docs, PASSAGE, PASSAGE_WORDS)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[8].text is None and got[None].text == "" and got[3].spans == 1 and got[3].SPAN_DIG == "x"
    for n, (a, b) in enumerate(own):
        if n % 2:
            assert got[n].text == made[n][1]
        else:  # a letter next to the passage may be shared too
            assert passage[1:-1] not in got[n].text and got[n].text.startswith(a[:-2]) and got[n].text.endswith(b[2:])


@pytest.mark.parametrize(("piece", "common"), [(256, 256), (3, 3)])
def test_suffix_array_dedup_in_pieces(spark, piece, common):
    from tessera.llm.substring import repeat_report, without_repeats

    rnd = random.Random(8)
    shared = "".join(rnd.choice("abcd") for _ in range(90))
    made = []
    for n in range(80):
        a, b = rnd.randrange(0, 45), rnd.randrange(45, 90)
        made.append(
            (
                n,
                "".join(
                    rnd.choice("wxyzü") for _ in range(rnd.randrange(40))
                ) + shared[a:b] + "".join(rnd.choice("uvé") for _ in range(rnd.randrange(40)))
            )
        )
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    gone = list(repeats([t.encode() for _, t in made], 24))
    got = {r.doc_id: r for r in repeat_report(docs, width=24, passage=16, words=3, gram=8, piece=piece, common=common).collect()}
    assert [got[n].n_removed for n in range(80)] == [int(g.sum()) for g in gone]
    runs = [
        [(a, z) for a, z in spans_of(g) if len(t.encode()[a:z].split()) >= 3]
        for (_, t), g in zip(made, repeats([t.encode() for _, t in made], 16), strict=True)
    ]
    assert [(got[n].n_passages, got[n].passage_bytes) for n in range(80)] == [(len(r), sum(z - a for a, z in r)) for r in runs]
    left = {r.doc_id: r.text for r in without_repeats(docs, width=24, gram=8, piece=piece, common=common).collect()}
    assert all(left[n].encode() == np.frombuffer(t.encode(), np.uint8)[~g].tobytes() for (n, t), g in zip(made, gone, strict=True))


def test_packing(spark, data):
    t = tokenizer("word_bpe_49k.json")
    want = Counter()
    for i, text in documents(spark, data):
        ids = [*t.encode(text, add_special_tokens=False).ids, 1]
        start = 0
        while start < len(ids):
            n = min(2048, 1 << (len(ids) - start).bit_length() - 1)
            want[i, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes()), len(ids)] += 1
            start += n
    got = Q.op10_packing(spark, data).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    assert len({r.sequence_id for r in got}) == len(got) and all(r.offset == 0 for r in got)


def test_html():
    from tessera.llm.html_text import text_of

    assert text_of(None) == text_of("") == ""
    assert text_of("<title>no</title><p>one<p>two<br>three<div>four</div>") == "one\n\ntwo\nthree\n\nfour"
    assert text_of("<ul><li>x<li>y<ol start=3><li>n<li>m</ol><li>z</ul>") == "* x\n* y\n 3. n\n 4. m\n* z"
    assert text_of("<table><tr><td>a<td>bbb<tr><th>cc<td>d</table>") == "a   bbb\ncc  d"
    assert text_of("a<!-- c --><script>x<p></script><b hidden>n</b><i style='DISPLAY : none'>n</i> &lt;b&gt; <b>b") == "a <b> b"
    assert text_of("<pre>\n a\n  b\n</pre>x") == " a\n  b\n\nx".strip("\n")
    assert text_of("<div>" * 20_000 + "deep" + "</p>") == "deep"
    assert text_of("a < b <i>c</i") == "a < b c"
    assert text_of(
        "<table><tr><th colspan=2>head<th>z<tr><td>a<td>bb<td>c<tr><td rowspan=2>d<td>e<tr><td>f<td>g</table>"
    ) == "head   z\na  bb  c\nd  e\n   f   g"
    assert text_of(
        "<table><tr><td>a<td>b<tr><td colspan=2>a long heading<tr><td colspan=0>x<td rowspan=0>y<td>z</table>"
    ) == "a  b\na long heading\nx  y            z"
    assert text_of(
        "<p>x<svg><title>t</title><defs><text>no</text></defs><path/><text>label</text></svg><math><mi>a</mi><mo>=</mo><annotation>tex</annotation></math><map>m</map>"
    ) == "x\nlabel\na=m"
    assert text_of("<a title='open>shown <b>on</b> 'x'>y") == "shown on 'x'>y"
    assert text_of("<a <b <c") == "<a <b <c"


@pytest.mark.parametrize(
    "piece",
    [
        "<a ", "<a title='", "<a \"'>", "<li><span>", "<table><tr><td>", "<ul><li>x", "</b><b>", "<p><i>", "<!-- ", "<![CDATA[",
        "<script", "<td colspan=1000 rowspan=0>", "<blockquote>q", "&amp", "</", "<x =  "
    ]
)
def test_html_hostile_pages(piece):
    """A megabyte of unclosed markup takes seconds."""
    import time

    from tessera.llm.html_text import text_of

    start = time.process_time()
    text_of("<ul><li>" + "<b>" * 1000 + piece * (1_000_000 // len(piece)))
    assert time.process_time() - start < 20


def test_html_shows_what_a_plain_parser_shows(spark, sf_dir):
    """The words of all pages against the standard parser's text outside of hidden elements."""
    from html.parser import HTMLParser

    from tessera.llm.html_text import UNSEEN, text_of

    class Visible(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.hidden, self.out = [], []

        def handle_starttag(self, tag, attrs):
            a = dict(attrs)
            style = (a.get("style") or "").replace(" ", "")
            if tag in ("br", "img", "meta", "link", "hr", "input", "p", "li", "td", "tr"):
                self.out.append(" ")
            elif self.hidden or tag in UNSEEN or "hidden" in a or "display:none" in style or "visibility:hidden" in style:
                self.hidden.append(tag)
            else:
                self.out.append("" if tag in ("a", "b", "i", "em", "strong", "span", "code") else " ")

        def handle_endtag(self, tag):
            if tag in self.hidden:
                while self.hidden.pop() != tag:
                    pass
            elif tag not in ("a", "b", "i", "em", "strong", "span", "code"):
                self.out.append(" ")

        def handle_data(self, data):
            if not self.hidden:
                self.out.append(data)

    bullet = {"*", *(f"{n}." for n in range(200))}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        v = Visible()
        v.feed(r.html)
        v.close()
        plain = [w for w in "".join(v.out).split() if w not in bullet]
        assert sorted(w for w in text_of(r.html).split() if w not in bullet) == sorted(plain)


def test_html_query(spark, sf_dir):
    got = Q.op7_html_text(spark, sf_dir).collect()
    assert len(got) == 50 and all(r.text and "track(" not in r.text and "<p" not in r.text for r in got)


def test_very_long_texts(spark, tmp_path):
    """A text of four megabytes, another with its first half, and a word of a megabyte, through every operator on documents."""
    rnd = random.Random(15)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzäéß") for _ in range(rnd.randrange(2, 9))) for _ in range(700_000)]
    long = " ".join(words)
    half = long[: len(long) // 2]
    made = [(0, long, "en"), (1, half, "de"), (2, "etaoin" * 170_000, "en"), (3, "short", "de")]
    d = str(tmp_path)
    spark.createDataFrame([(i, t, lang, None, len(t)) for i, t, lang in made], DOCS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(
        [(0, 1, 0), (1, 0, 0), (2, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int"
    ).write.parquet(f"{d}/labels.parquet")
    t = tokenizer("byte_bpe_50k.json")
    ids = {i: t.encode(text, add_special_tokens=False).ids for i, text, _ in made}
    assert rows(Q.op1_bpe(spark, d), "doc_id", "n_tokens", "ids_sha256") == [
        (i, len(x), sha(",".join(map(str, x)))) for i, x in sorted(ids.items())
    ]
    assert {r.lang_pred for r in Q.op4_language_id(spark, d).collect()} <= {"en", "de"}
    assert rows(Q.op5_exact_dedup(spark, d), "doc_id", "text_sha256") == [(i, sha(text.encode().lower())) for i, text, _ in made]
    assert len(Q.op6_quality(spark, d).collect()) == 4
    prints = {r.doc_id: int(r.fingerprint, 16) for r in Q.op8_simhash_near_dedup(spark, d).collect()}
    shingles = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]).encode(), 42) for k in range(len(words) - 2)]
    assert prints[0] == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in shingles) > len(shingles))
    got = {r.doc_id: r for r in Q.op9_suffix_array_dedup(spark, d).collect()}
    assert got[1].n_removed == got[1].n_bytes == len(half.encode()) == got[0].n_removed and got[0].n_spans == 1
    assert got[2].n_removed == got[2].n_bytes == 1_020_000 and got[3].n_removed == 0
    w = tokenizer("word_bpe_49k.json")
    totals = Counter()
    for r in Q.op10_packing(spark, d).collect():
        totals[r.doc_id] += r.length
    assert totals == {i: len(w.encode(text, add_special_tokens=False).ids) + 1 for i, text, _ in made}


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    have = {r.doc_id: r.text for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
    by = defaultdict(list)
    for i, t in have.items():
        if any(map(str.isalpha, t or "")):
            by[t.encode().lower()].append(i)
    kept = [max(v) for v in by.values()]
    near = {r.doc_id: r.component_id for r in Q.op8_simhash_near_dedup(spark, sf_dir).collect()}
    out = corpus_pipeline.run(spark, sf_dir).collect()
    got = {r.doc_id for r in out}
    assert got <= set(kept) and {near[i] for i in got} == {near[i] for i in kept}
    texts = {i: have[i].encode() for i in sorted(got)}
    t = tokenizer("word_bpe_49k.json")
    for (i, text), gone in zip(texts.items(), repeats(list(texts.values()), 200), strict=True):
        for a, z in spans_of(gone):
            if z - a < 400 and len(text[a:z].split()) < 50:
                gone[a:z] = False
        left = np.frombuffer(text, np.uint8)[~gone].tobytes().decode("utf-8", "replace")
        assert sum(r.length for r in out if r.doc_id == i) == len(t.encode(left, add_special_tokens=False).ids) + 1


def test_pipeline_null_and_repeated_ids(spark, sf_dir):
    """Each group keeps exactly one row, and different texts stay, whatever their doc_id."""
    import corpus_pipeline

    rnd = random.Random(11)
    said = ["".join(rnd.choice("abcdefg hij") for _ in range(900)) for _ in range(6)]
    near = " ".join(f"w{n}" for n in range(2000))
    made = [
        (None, said[0]), (1, said[0]), (2, said[1]), (2, said[1]), (2, said[1].upper()), (3, said[2]), (3, said[3]), (4, said[3]),
        (None, said[4]), (None, said[4]), (None, said[5])
    ]
    docs = spark.createDataFrame([(i, t, "en", None, 0) for i, t in made], DOCS)
    out = corpus_pipeline.drop_exact_copies(spark, docs, sf_dir)
    assert out.columns == docs.columns
    got = rows(out.select("doc_id", F.lower("text").alias("text")), "doc_id", "text")
    assert got == sorted([(1, said[0]), (2, said[1]), (3, said[2]), (4, said[3]), (None, said[4]), (None, said[5])], key=repr)
    made = [(None, near), (7, near + " x"), (8, near + " y"), (8, said[0]), (None, said[1]), (9, said[2]), (9, said[2])]
    docs = spark.createDataFrame([(i, t, "en", None, 0) for i, t in made], DOCS)
    out = corpus_pipeline.drop_near_copies(spark, docs, sf_dir)
    assert rows(out, "doc_id", "text") == sorted([(7, near + " x"), (8, said[0]), (None, said[1]), (9, said[2])], key=repr)


def test_pipeline_keeps_a_repeated_document_whole(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(12)
    text = "".join(rnd.choice("abcdefg hij") for _ in range(900))
    spark.createDataFrame(
        [(1, text, "en", None, 0), (1, text, "en", None, 0), (None, text, "en", None, 0), (2, "other words", "de", None, 0)], DOCS
    ).write.parquet(f"{tmp_path}/documents.parquet")
    t = tokenizer("word_bpe_49k.json")
    got = Counter()
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id] += r.length
    assert got == {
        1: len(t.encode(text, add_special_tokens=False).ids) + 1, 2: len(t.encode("other words", add_special_tokens=False).ids) + 1
    }


def test_pipeline_numbers_rows_once(spark, tmp_path):
    """Rows of files keep their place; rows made from rows of files have numbers of their own."""
    import corpus_pipeline

    spark.range(40).selectExpr("id AS doc_id", "concat('t', id) AS text").repartition(3).write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    for frame, n in ((docs, 40), (docs.selectExpr("doc_id", "text", "explode(array(1, 2)) AS k"), 80), (docs.limit(0), 0), (docs.unionByName(docs), 80)):
        rows_, row = corpus_pipeline.numbered(frame)
        got = [r[row] for r in rows_.collect()]
        assert len(set(got)) == len(got) == n and rows_.columns == [*frame.columns, row]
        assert sorted(got) == sorted(r[row] for r in rows_.select(row).collect())
    assert len(corpus_pipeline.numbered(docs)[0].where("tessera_row >= (1L << 40)").collect()) == 40


def test_pipeline_stages_on_awkward_rows(spark, tmp_path):
    """Files with repeated and null ids, repeated rows, null and empty texts and clashing columns, stage by stage."""
    import corpus_pipeline

    rnd = random.Random(16)
    prose = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 8))) for _ in range(n))
    one, two, three = prose(300), prose(300), prose(300)
    passage = prose(55)
    made = [
        (1, one), (1, one), (None, one), (2, one.upper()), (2, two), (2, None), (None, None), (3, ""), (4, "12 %"), (None, three),
        (5, f"{prose(80)} {passage} {prose(80)}"), (6, f"{prose(80)} {passage} {prose(80)}")
    ]
    columns = "spans int, span_dig long, owner string, fp long, n int, `group` string, keeper int, tessera_row int, tessera_path string, _torn_ int"
    extra = (1, 2, "o", 3, 4, "g", 5, 6, "p", 7)
    spark.createDataFrame(
        [(i, t, "en", None, 0, *extra) for i, t in made], f"{DOCS}, {columns}"
    ).repartition(3).write.parquet(f"{tmp_path}/0")
    kept = []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{n + 1}")
        got = spark.read.parquet(f"{tmp_path}/{n + 1}").collect()
        assert all(tuple(r)[5:] == extra for r in got)
        kept.append(sorted((str(r.doc_id), (r.text or "")[:20].lower()) for r in got))
    texts = {n: t[:20].lower() for n, (_, t) in enumerate(made) if t}
    rest = [("2", texts[4]), ("None", texts[9]), ("5", texts[10]), ("6", texts[11])]
    assert kept[0] == sorted([("1", texts[0]), ("1", texts[0]), ("None", texts[0]), ("2", texts[0]), *rest])
    assert kept[1] == kept[2] == kept[3] == sorted([("2", texts[0]), *rest])
    for r in spark.read.parquet(f"{tmp_path}/4").collect():
        assert passage[1:-1] not in r.text
        assert len(r.text) == r.n_chars and (r.doc_id in (5, 6) or len(r.text) > 900)
    assert corpus_pipeline.STAGES[-1][1](spark, spark.read.parquet(f"{tmp_path}/4"), str(tmp_path)).where("doc_id is null").count() > 0
    docs = spark.read.parquet(f"{tmp_path}/0").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0


def test_language_stage_without_labels(spark, sf_dir):
    """Where no language can be learned only null and letterless texts go."""
    import corpus_pipeline
    from tessera.llm import language

    texts = [None, "", "12 %!", "plain words", "mehr Worte", "plain words"]
    docs = spark.createDataFrame([(n if n < 4 else None, t, None, None, 7) for n, t in enumerate(texts)], DOCS)
    out = corpus_pipeline.identify_language(spark, docs, sf_dir)
    assert out.schema == docs.schema
    assert rows(out, "doc_id", "text", "n_chars") == sorted(
        [(3, "plain words", 7), (None, "mehr Worte", 7), (None, "plain words", 7)], key=repr
    )
    assert rows(language.predict(docs, None), "lang_pred", "score") == sorted([("und", 0.0)] * 3 + [(None, 0.0)] * 3, key=repr)
