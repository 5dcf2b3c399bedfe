"""The registered queries of the operators: each applies one to its whole table.

``queries()`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``oracle_sql()``
has DuckDB SQL where SQL can say the same. The rest is tested against brute
force in ``tests/llm``.
"""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tierflow
from tierflow.llm import chat, contamination, conversation_repair, embedding_dedup, html_text, lexical_search, order_minhash, quality_classifier, suffix_dedup, token_files, toxicity, warc, word_bpe

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the executors' Python workers (once a session), as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(tierflow.__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(top)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.relpath(path, os.path.dirname(top)))
    place = os.path.join(tempfile.mkdtemp(prefix="tierflow-py-"), "tierflow_package.zip")
    with open(place, "wb") as f:
        f.write(data.getvalue())
    context.addPyFile(place)
    _SHIPPED.add(context.applicationId)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(_table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = chat.link(chat.events_of_turns(_table(spark, sf_dir, "conversations")), chat.reply_tool(spark))
    return linked.select(F.col("conversation").alias("conv_id"), F.col("place").alias("turn"), "role", "kind", F.col("id").alias("call_id"), "link", "level", F.array_join("errors", ",").alias("errors"), "json")


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.digest(toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels"))))


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, manifest)


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.digest(contamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_array_dedup(_table(spark, sf_dir, "documents"))


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.first_of_class(order_minhash.near_duplicates(_table(spark, sf_dir, "documents")))


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damaged(_table(spark, sf_dir, "conversations")), copies_col="copies")


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_classifier.digest(quality_classifier.score(docs, quality_classifier.train(docs, _table(spark, sf_dir, "labels"))))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": _op1,
    "op2_html_text": _op2,
    "op3_chat_format": _op3,
    "op4_toxicity": _op4,
    "op5_token_files": _op5,
    "op6_word_bpe": _op6,
    "op7_embedding_dedup": _op7,
    "op8_benchmark_decontamination": _op8,
    "op9_suffix_array_dedup": _op9,
    "op10_order_minhash": _op10,
    "op11_conversation_repair": _op11,
    "op12_lexical_search": _op12,
    "op13_quality_classifier": _op13,
}

_ORACLE: dict[str, str] = {
    "op1_warc": warc.ORACLE_SQL,
    "op3_chat_format": chat.ORACLE_SQL,
    "op7_embedding_dedup": embedding_dedup.ORACLE_SQL,
    "op8_benchmark_decontamination": contamination.ORACLE_SQL,
    "op9_suffix_array_dedup": suffix_dedup.ORACLE_SQL,
    "op11_conversation_repair": conversation_repair.ORACLE_SQL,
    "op12_lexical_search": lexical_search.ORACLE_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        return run

    return {name: shipped(f) for name, f in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
