"""The operators applied to the supplied tables, one query for each.

Every query takes (spark, sf_dir), reads its whole table and returns its
whole result; ``SQL`` holds DuckDB SQL for those that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafstat.llm import (bottomk, bpe_automaton, concatenated, covering, dsir, licenses, llr_rules, lsh_forest, packing,
                          prefix_trie, shard, vbyte, warc)
from leafstat.llm.common import documents, ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@query
def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight, Gumbel key and verdict of every document."""
    return dsir.resample(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))[1]


@query
def op9_llr_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, mean log-likelihood ratio and verdict of every document."""
    trusted = documents(spark, sf_dir, "labels").where("quality = 1")
    return llr_rules.judged(documents(spark, sf_dir), trusted).select("row.doc_id", "rules.*")


@query
def op3_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document among 40 shards; row counts differ by one at most."""
    placed = shard.sharded(documents(spark, sf_dir), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "row")


@query
def op10_bottom_k_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and of its edited text, and their likeness."""
    return bottomk.compared(documents(spark, sf_dir))


@query
def op6_ranked_vbyte_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, count and checksum of every document's ids, read back from the files."""
    return vbyte.written_and_read(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@query
def op7_linear_grouping_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and offset of every piece of every document."""
    return packing.packed_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@query
def op2_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back from the WARC files that its ARC file became."""
    got = warc.archived(documents(spark, sf_dir, "pages"))
    return got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op2_arc_to_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     d AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS digest FROM p),
     g AS (SELECT n, digest, max(page_id) AS first FROM d WHERE n >= 1000 GROUP BY n, digest)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d LEFT JOIN g USING (n, digest)
"""


@query
def op8_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count and digests of every document's ids and of the text decoded from them."""
    got = bpe_automaton.coded(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return got.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op4_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical digest, licence of the entire text and licences of entire lines of every document."""
    return licenses.scanned(documents(spark, sf_dir), licenses.known_texts(spark))


SQL["op4_license_digests"] = licenses.oracle_sql()


@query
def op5_lsh_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class, number of links and copies of every document."""
    return lsh_forest.joined(documents(spark, sf_dir))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    return prefix_trie.rebuilt_trie(documents(spark, sf_dir, "conversations")).drop("n1", "n2")


@query
def op12_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and component of every document."""
    return covering.linked(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id", "n_equal")


@query
def op13_concatenated_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features, weight, score and rank of every document, drawn towards the benchmark's texts."""
    found = concatenated.resampled(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
