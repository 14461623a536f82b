"""From raw documents to token ids: five stages over the whole table.

STAGES lists (name, function) in order. Each function takes (spark, docs, sf_dir)
and returns a DataFrame; the next stage reads it back from Parquet. All stages
but the last return the columns of ``documents``.

1. toxicity      documents scored 0.3 or more go
2. simhash       one document of each near-duplicate component stays (smallest id)
3. secret_scan   every secret found is replaced by [SECRET]; n_chars follows the text
4. mixing        documents are repeated or left out until sources meet their targets
5. bpe           token ids of each text, their number, and digests of ids and decoded text

Extra columns of the input are kept up to the last stage, which returns its own columns. Null
texts count as empty and stay null. Very long texts go through whole. Empty tables pass through. Repeated rows: stage 1 treats each alone, stage 2
keeps one, stage 4 makes some itself, each encoded alone in stage 5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricetrend.llm import bpe, mixing, secret_scan, simhash, toxicity
from pricetrend.llm.common import cut_lineage, table
from pricetrend.llm.queries import vocabulary
from pricetrend.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    examples = toxicity.choose(docs, table(spark, sf_dir, "labels"), learn_from=~toxicity.held_out())
    prefix = "toxicity_of_stage_"
    # Texts are cut into terms once; the IDF and the scores read what is written.
    marked = cut_lineage(toxicity.hits(docs, examples.terms, prefix=prefix), "stage-toxic-hits")
    model = toxicity.fit(examples, marked, prefix=prefix)
    scored = toxicity.score(marked, model, prefix=prefix)
    return scored.where(F.col(prefix + "score") < model.params.threshold).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_scan.redact(docs, secret_scan.learn(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), vocabulary())
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

# Nearest examples, ball hashing, automata, Newton steps and BPE aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
