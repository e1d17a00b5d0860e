"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations


from pyspark.sql import functions as F

from chargeline.llm import (chunk_dedup, decontaminate, langid, lexical_search, licenses, ngram_join, packing, pii, quality,
                            sharding, suffix_dedup, voronoi_topk, whitening)
from chargeline.llm.frames import documents

#: Shards of the sharding query; the grown tree has one more.
SHARDS = 40

#: Sources are mixed in proportion to their tokens to this power, until each is used up.
TEMPER = 0.7


def vocabulary(added: bool = False) -> packing.Vocabulary:
    import public_tokenizers as files

    return packing.Vocabulary(files.path("byte_bpe_50k.json"), files.path("byte_bpe_50k.tiktoken"), files.PATTERN,
                              added)


def benchmark(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")


def op1_sharding(spark, sf_dir):
    return sharding.assign(documents(spark, sf_dir), sharding.tree_of(SHARDS), sharding.tree_of(SHARDS + 1))


def op2_decontamination(spark, sf_dir):
    return decontaminate.search(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op3_quality(spark, sf_dir):
    return quality.score(documents(spark, sf_dir))


def op4_licenses(spark, sf_dir):
    return licenses.scan(documents(spark, sf_dir))


def op5_suffix_dedup(spark, sf_dir):
    return suffix_dedup.dedup(documents(spark, sf_dir))


def op6_ngram_join(spark, sf_dir):
    return ngram_join.groups(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op7_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), vocabulary(added=True), temper=TEMPER).drop("ids", "source")


def op8_pii(spark, sf_dir):
    return pii.summary(pii.find(documents(spark, sf_dir)))


def op9_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return langid.predict(docs, langid.train(docs))


def op10_chunk_dedup(spark, sf_dir):
    return chunk_dedup.duplicates(documents(spark, sf_dir), how=chunk_dedup.EVERY_RUN)


def embeddings(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")


def op11_voronoi_topk(spark, sf_dir):
    return voronoi_topk.search(embeddings(spark, sf_dir), F.col("vec_id") % 50 == 0)


def op12_whitening(spark, sf_dir):
    return whitening.whiten(embeddings(spark, sf_dir))


def op13_lexical_search(spark, sf_dir):
    return lexical_search.search(documents(spark, sf_dir), benchmark(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_decontamination, op3_quality, op4_licenses, op5_suffix_dedup, op6_ngram_join, op7_packing,
    op8_pii, op9_language, op10_chunk_dedup, op11_voronoi_topk, op12_whitening, op13_lexical_search)}

ORACLE_SQL: dict[str, str] = {
    "op11_voronoi_topk": """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda c: c IS NOT NULL AND isfinite(c)))
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op13_lexical_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), i AS (
  SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
), lengths AS (
  SELECT r, count(*) AS n FROM d GROUP BY r
), total AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM lengths
), tf AS (
  SELECT r, doc_id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM i) GROUP BY ALL
), weight AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, total GROUP BY term
), scored AS (
  SELECT item_id, r, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + ((50 * n * docs) // len)))))::BIGINT AS score
  FROM i JOIN tf USING (term) JOIN weight USING (term) JOIN lengths USING (r), total
  GROUP BY item_id, r, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
""",
}
