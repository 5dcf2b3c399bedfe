"""The corpus pipeline: toxicity, near-duplicates, repeated passages, benchmarks, tokens.

Each stage is a function of (spark, docs, sf_dir) that works on all documents
its predecessor kept. All but the last return the columns of ``documents``:

1. ``toxicity`` drops documents that score at least 0.7 with a lexicon learned
   from the labelled ones among them;
2. ``order_minhash`` keeps of each class of near-duplicates the document with
   the smallest id;
3. ``suffix_dedup`` removes every 50-byte string that an earlier document has
   from the texts (and characters that this cuts), and counts ``n_chars`` anew;
4. ``contamination`` drops documents of which a twentieth or more are words of
   benchmark windows;
5. ``word_bpe`` encodes the texts and decodes the ids.

Nulls, empty and very long texts, repeated rows, empty tables and further
columns are handled as the operators say; a document that loses all its text
in stage 3 stays, with an empty text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import contamination as _contamination
from tierflow.llm import order_minhash as _order_minhash
from tierflow.llm import suffix_dedup as _suffix_dedup
from tierflow.llm import toxicity as _toxicity
from tierflow.llm import word_bpe as _word_bpe
from tierflow.llm.catalog import ship
from tierflow.llm.common import free_name, scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = _toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = free_name(docs, "toxicity")
    scored = _toxicity.score(docs, model, keep=docs.columns, name=name)
    return scored.filter(F.col(name) < _toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return _order_minhash.keep_one(docs, _order_minhash.near_duplicates(docs))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    kept = _suffix_dedup.suffix_array_dedup(docs, with_text=True, keep=others)
    columns = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return kept.select(*[columns.get(c, F.col(f"rest.{c}")).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _contamination.drop_contaminated(docs, _contamination.contamination(docs, benchmark))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return _word_bpe.encode(docs, TOKENIZER, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("order_minhash", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("contamination", drop_contaminated),
    ("word_bpe", tokenize),
]

#: SQL cannot score, sketch or merge; tests/llm/test_corpus_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, each on the Parquet files of the one before.

    The files lie in a folder of this run under ``spark.checkpoint.dir`` and
    stay, for the result reads the last of them.
    """
    folder = scratch_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
