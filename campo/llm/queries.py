"""Registered queries of the training-data operators, and SQL for those that
SQL can express."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from campo.llm import codes, exact, langid, lexical, lm, mixing, near, packing, pii, quality, tokenfile, topk, toxicity
from campo.llm.common import table
from campo.session import scratch_path

#: Folder of the public tokenizer files; None: that of the installed package.
TOKENIZERS: str | None = None


def tokenizer(name: str) -> str:
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_exact_dedup(spark, sf_dir) -> DataFrame:
    return exact.dedup(table(spark, sf_dir, "documents"))


def op2_language_id(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = langid.held_out(docs).alias("held_out")
    model = langid.train(docs.where(~langid.held_out(docs)), tokenizer("piece_bpe_32k.model"))
    return langid.predict(docs, model, held)


def op3_mixing(spark, sf_dir) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_toxicity(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_packing(spark, sf_dir) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op6_quality(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.annotate(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op7_near_dedup(spark, sf_dir) -> DataFrame:
    return near.near_dedup(table(spark, sf_dir, "documents"))


def op8_token_files(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, f"llm/token-files-{uuid.uuid4().hex}")
    tokenfile.write(table(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json"), end_id=1)
    return tokenfile.read(spark, path, digest=True)


def op9_personal_data(spark, sf_dir) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark, sf_dir) -> DataFrame:
    return lm.log_likelihood(table(spark, sf_dir, "documents"))


def op11_topk_search(spark, sf_dir) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors["vec_id"] % 20 == 0).select("query_id", "rank", "vec_id", "score")


def op12_vector_codes(spark, sf_dir) -> DataFrame:
    return codes.coded(table(spark, sf_dir, "embeddings"))


def op13_ranked_search(spark, sf_dir) -> DataFrame:
    found = lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


def pipeline(spark, sf_dir) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_language_id, op3_mixing, op4_toxicity, op5_packing, op6_quality, op7_near_dedup,
    op8_token_files, op9_personal_data, op10_lm_scoring,
    op11_topk_search, op12_vector_codes, op13_ranked_search, pipeline)}

ORACLE = {
    "op1_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
      FROM documents)
WINDOW w AS (PARTITION BY norm)
""",
    "op3_mixing": mixing.SQL,
    "op11_topk_search": topk.SQL,
    "op12_vector_codes": codes.SQL,
    "op13_ranked_search": lexical.SQL,
}
