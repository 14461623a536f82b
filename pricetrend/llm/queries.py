"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricetrend.llm import ann, bpe, codes, conversations, language, mixing, quality, secret_scan, simhash, token_counts, topk, toxicity, warc
from pricetrend.llm.common import cut_lineage, table, words_in
from pricetrend.session import scratch_path


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    examples = toxicity.choose(docs, table(spark, sf_dir, "labels"), learn_from=~toxicity.held_out())
    # The texts are read once; what is written has only the listed terms.
    marked = cut_lineage(toxicity.hits(docs, examples.terms).drop("text"), "toxic-hits")
    model = toxicity.fit(examples, marked)
    return toxicity.score(marked, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), F.col("toxicity_score").alias("score"),
        (F.col("toxicity_score") >= model.params.threshold).cast("int").alias("predicted"),
        F.col("toxicity_vote").alias("vote"), F.col("toxicity_examples").alias("examples"),
        F.col("toxicity_cosines").alias("cosines"))


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, vocabulary()).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), "url", F.col("html").cast("binary").alias("payload"))
    path = scratch_path(spark, "warc")
    warc.write(pages, path)
    found = warc.read(spark, path, payload=False).where("reason is null")
    return found.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = cut_lineage(docs.select("doc_id", "source", words_in(F.col("text")).alias("size")), "sizes")
    rows = mixing.per_row(mixing.plan(sized, "doc_id"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("row_copies") * F.col("size")).alias("taken"),
                       "source", "rate")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = toxicity.held_out()
    rows = quality.features(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn_from=~held)
    params = quality.QualityParams()
    scored = quality.score(rows, quality.fit(rows, params)).withColumnRenamed("id", "doc_id")
    keep = F.col("score") >= params.threshold
    return scored.select("doc_id", held.alias("held_out"), "score", keep.cast("int").alias("predicted"), keep.alias("keep"),
                         "text_score", "meta_score")


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def _spans_text(spans):
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.learn(docs))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda x: x["kind"].isin(*secret_scan.KINDS))
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in secret_scan.KINDS),
                        F.sha2(_spans_text(base), 256).alias("base_sha256"), _spans_text(F.col("spans")).alias("spans"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    limit = token_counts.CountParams().limit
    return token_counts.count_tokens(sized, vocabulary()).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = codes.compress(table(spark, sf_dir, "embeddings"))
    return codes.with_label_error(coded.rows).select(
        F.col("id").alias("vec_id"), codes.code_text(F.col("code")).alias("code"), "error", "label_error",
        F.lit(coded.digest()).alias("codebooks_sha256"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs, ~language.held_out())
    return language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.repaired(rows).withColumnRenamed("conv", "conv_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_bpe_round_trip": op2_bpe_round_trip,
    "op3_simhash": op3_simhash,
    "op4_warc": op4_warc,
    "op5_mixing": op5_mixing,
    "op6_quality": op6_quality,
    "op7_ann": op7_ann,
    "op8_secret_scan": op8_secret_scan,
    "op9_topk": op9_topk,
    "op10_token_counts": op10_token_counts,
    "op11_vector_codes": op11_vector_codes,
    "op12_language": op12_language,
    "op13_conversations": op13_conversations,
}

def _codes_sql(rounds: int = 4) -> str:
    """Product codes by the full search: every round compares all parts with all entries."""
    steps = ["""WITH v AS (SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
          list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
          FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (SELECT rid, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] AS x FROM v, range(4) AS t(part)),
        c0 AS (SELECT part, rid - 1 AS entry, x AS c FROM p WHERE rid <= 256)"""]
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS (SELECT rid, part, any_value(x) AS x,
          min(CAST(list_dot_product(x, x) + list_dot_product(c, c) - 2 * list_dot_product(x, c) AS BIGINT) * 256 + entry) AS m
          FROM p JOIN c{k} USING (part) GROUP BY rid, part)""")
        if k < rounds:
            steps.append(f"""s{k} AS (SELECT part, m % 256 AS entry, pos, CAST(sum(x[pos]) AS BIGINT) AS s, count(*) AS n
              FROM a{k}, range(1, (SELECT max(len(x)) + 1 FROM p)) AS t(pos) GROUP BY ALL),
            f{k} AS (SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY pos) AS c FROM s{k} GROUP BY part, entry),
            c{k + 1} AS (SELECT part, entry, coalesce(f.c, o.c) AS c FROM c{k} o LEFT JOIN f{k} f USING (part, entry))""")
    return ",\n".join(steps) + f"""
        , e AS (SELECT rid, string_agg(printf('%02x', m % 256), '' ORDER BY part) AS code, CAST(sum(m // 256) AS BIGINT) AS error FROM a{rounds} GROUP BY rid),
        b AS (SELECT sha256(string_agg(CAST(CAST(c[pos] AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) AS d
              FROM c{rounds}, range(1, (SELECT max(len(x)) + 1 FROM p)) AS t(pos))
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT d FROM b) AS codebooks_sha256
        FROM v JOIN e USING (rid)"""


ORACLE: dict[str, str] = {
    "op11_vector_codes": _codes_sql(),
    "op4_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
        k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS keeper FROM p)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id < keeper THEN keeper END AS refers_to
        FROM k""",
    "op9_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
                   FROM embeddings WHERE embedding IS NOT NULL
                   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
}
