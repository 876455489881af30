"""Queries of the training-data operators, by the names the entry registers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_arrow, table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_digest(ids: list, texts: list[str]) -> dict[str, list[str]]:
    import hashlib

    return {
        "ids_sha256": [hashlib.sha256(",".join(map(str, i.tolist())).encode()).hexdigest() for i in ids],
        "decoded_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in texts],
    }


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import bpe_encode

    return bpe_encode(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), decode=True, digest=op1_digest,
        digest_columns=("ids_sha256", "decoded_sha256")
    )


def op2_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose texts hold the template's own control strings."""
    own = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)


def op2_read_back(batches):
    """Windows of a conversation in order to its digests, all read from what was written and the loss spans."""
    import hashlib

    import pyarrow as pa

    from .chat import parse, unescape

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def done(c):
        return (c["conv"], c["turns"], c["hash"].hexdigest(), c["loss"], c["loss_hash"].hexdigest(), c["chars"], c["windows"])

    now, out = None, []
    for b in batches:
        for conv, n, text, loss, repeated in zip(
            *(b.column(k).to_pylist() for k in ("conv_id", "window", "text", "loss", "n_repeated")), strict=True
        ):
            if n == 0:
                if now is not None:
                    out.append(done(now))
                now = {
                    "conv": conv, "turns": 0, "hash": hashlib.sha256(), "loss": 0, "loss_hash": hashlib.sha256(), "chars": 0,
                    "windows": 0
                }
            now["chars"] += len(text)
            now["windows"] += 1
            for role, said in parse(text)[repeated:]:
                now["turns"] += 1
                now["hash"].update(f"{role}\n{said}\n".encode())
            for span in loss:
                target = unescape(text[span["start"] : span["stop"]])
                now["loss"] += len(target)
                now["loss_hash"].update(target.encode())
        if len(out) > 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
            out = []
    if now is not None:
        out.append(done(now))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import chat_windows

    windows = chat_windows(op2_conversations(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))
    return windows.transform(
        in_arrow, op2_read_back,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"
    )


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vectors import vector_near_dedup

    return vector_near_dedup(table(spark, sf_dir, "embeddings"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import language

    docs = table(spark, sf_dir, "documents")
    net = language.fit(docs, ~language.held_out())
    return language.predict(docs, net).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality
    from .language import held_out

    docs = table(spark, sf_dir, "documents")
    out_of_fit = held_out(modulus=5, rest=0)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~out_of_fit)
    return quality.score(docs, model).select(
        "doc_id", out_of_fit.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import extract_text

    return extract_text(table(spark, sf_dir, "pages"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import simhash_near_dedup

    out = simhash_near_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring import repeat_report

    return repeat_report(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    out = pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), digest=True)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_bpe, op2_chat, op3_embedding_near_dedup, op4_language_id, op5_exact_dedup, op6_quality, op7_html_text,
        op8_simhash_near_dedup, op9_suffix_array_dedup, op10_packing
    )
}

ORACLE_SQL: dict[str, str] = {
    "op3_embedding_near_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0
              AND len(list_filter(embedding, lambda y: y <> 0)) > 0),
        l AS (SELECT a.vec_id AS i, b.vec_id AS j FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
              WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
        reach(i, j) AS (SELECT i, j FROM l UNION SELECT r.i, l.j FROM reach r JOIN l ON l.i = r.j),
        c AS (SELECT i, min(j) AS least FROM reach GROUP BY i), n AS (SELECT i, count(*) AS n_links FROM l GROUP BY i)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(least(vec_id, c.least), vec_id) AS component_id, vec_id = coalesce(least(vec_id, c.least), vec_id) AS kept
        FROM embeddings LEFT JOIN n ON n.i = vec_id LEFT JOIN c ON c.i = vec_id""",
    "op5_exact_dedup": """
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256
        FROM t""",
}
