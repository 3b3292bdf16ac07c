"""Thin queries over the operators of this subpackage, and SQL that states what they return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.bpe import decode_documents, encode_documents
from siltstone.llm.decontamination import decontaminate
from siltstone.llm.embedding_dedup import near_vectors
from siltstone.llm.hard_negatives import mine_hard_negatives
from siltstone.llm.license_scan import scan_licenses
from siltstone.llm.pii import replace_pii, session_key
from siltstone.llm.quality import quality
from siltstone.llm.sharding import shard_documents
from siltstone.llm.simhash import near_duplicates
from siltstone.llm.substring_dedup import dedup_substrings
from siltstone.llm.suffix_array import dedup_bytes
from siltstone.llm.toxicity import toxicity
from siltstone.llm.vector_codes import compress_vectors, with_label_error


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_licenses(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "license_id", F.round("coverage", 6).alias("coverage"), "start_word", "end_word", F.size("spans").cast("long").alias("n_spans"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", F.col("n_hit").cast("long"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_vectors(table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def vocabulary_path() -> str:
    """The public tokenizer that op8 names; only its path is known here."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary_path()
    out = decode_documents(encode_documents(table(spark, sf_dir, "documents"), path), path)
    joined = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), session_key(spark), details=True)
    return out.select("doc_id", "text", F.size("_entities").alias("n_entities"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed_spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", changed), F.col("vec_id") % 100 == 0)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress_vectors(table(spark, sf_dir, "embeddings"))
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_simhash_dedup, op3_license_scan, op4_decontamination, op5_toxicity, op6_embedding_dedup, op7_sharding, op8_bpe, op9_pii, op10_suffix_array_dedup, op11_hard_negatives, op12_vector_codes, op13_quality)}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ITEM_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_SOUND = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_INTEGERS = "list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))"


def _assigned(books: str) -> str:
    """Nearest entry and squared distance of every part, as distance * 64 + entry."""
    distance = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    return f"SELECT vec_id, label, p.part, x, CAST(min({distance} * 64 + e) AS BIGINT) AS k FROM p JOIN {books} b ON p.part = b.part GROUP BY ALL"


def _moved(books: str, codes: str) -> str:
    """Floored means of the parts of each entry, old entries where there are none."""
    sums = f"SELECT part, k % 64 AS e, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n FROM {codes}, range(1, 5) t(i) GROUP BY ALL"
    means = f"SELECT part, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM ({sums}) GROUP BY ALL"
    return f"SELECT b.part, b.e, coalesce(m.c, b.c) AS c FROM {books} b LEFT JOIN ({means}) m ON b.part = m.part AND b.e = m.e"


#: op2, op3, op5, op7 to op10, op13 have none: SQL lacks their hashes, models and tokenizers, or takes too long on whole texts. They are tested against brute force.
ORACLE_SQL = {
    "op1_substring_dedup": """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, list_slice(w, i, i + 12) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13)),
f AS (SELECT g, min(doc_id) AS f FROM g GROUP BY g),
m AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN f ON g.g = f.g WHERE f < doc_id) GROUP BY 1)
SELECT w.doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed, sha256(array_to_string(list_filter(w, lambda x, i: ps IS NULL OR NOT list_contains(ps, i)), ' ')) AS kept_sha256 FROM w LEFT JOIN m ON w.doc_id = m.doc_id""",
    "op4_decontamination": f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents), b AS (SELECT item_id, w, least(len(w), 13) AS n FROM (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
dg AS (SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, dg.n, item_id FROM dg JOIN win ON dg.n = win.n AND dg.g = win.g),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN t ON d.doc_id = t.doc_id""",
    "op11_hard_negatives": f"""
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform({_INTEGERS}, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings WHERE label IS NOT NULL AND {_SOUND}),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score FROM p JOIN s ON p.anchor_id = s.anchor_id WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5""",
    "op12_vector_codes": f"""
WITH p AS MATERIALIZED (SELECT vec_id, label, part, list_slice(x, part * 4 + 1, part * 4 + 4) AS x FROM (SELECT vec_id, label, {_INTEGERS} AS x FROM embeddings WHERE {_SOUND}), range(16) t(part)),
c0 AS MATERIALIZED (SELECT part, row_number() OVER w - 1 AS e, x AS c FROM p WINDOW w AS (PARTITION BY part ORDER BY vec_id) QUALIFY row_number() OVER w <= 64),
a0 AS MATERIALIZED ({_assigned('c0')}), c1 AS MATERIALIZED ({_moved('c0', 'a0')}), a1 AS MATERIALIZED ({_assigned('c1')}), c2 AS MATERIALIZED ({_moved('c1', 'a1')}), a2 AS MATERIALIZED ({_assigned('c2')}),
r AS (SELECT vec_id, label, string_agg(lower(printf('%02x', k % 64)), '' ORDER BY part) AS code, CAST(sum(k // 64) AS BIGINT) AS error FROM a2 GROUP BY 1, 2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) FROM c2) AS codebooks_sha256 FROM r""",
    "op6_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY 1) LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY 1) ON vec_id = a""",
}
