"""The operators on the tables, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm.align import alignment
from oreflow.llm.caps import near_vectors
from oreflow.llm.common import held_out
from oreflow.llm.decontam import contamination
from oreflow.llm.exact import exact_duplicates
from oreflow.llm.langid import identify
from oreflow.llm.licenses import scan
from oreflow.llm.lm import score_documents
from oreflow.llm.packing import pack
from oreflow.llm.resample import resample
from oreflow.llm.simhash import near_duplicates
from oreflow.llm.substrings import remove_repeats
from oreflow.llm.toxicity import toxicity
from oreflow.llm.warc import archive

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LOWER_SQL = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    f"""SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
              doc_id = max(doc_id) OVER same AS kept, sha256(content) AS text_sha256
       FROM (SELECT doc_id, {LOWER_SQL.format(text="coalesce(text, '')")} AS content FROM documents)
       WINDOW same AS (PARTITION BY content)"""
)
def op7_exact_dedup(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query()
def op9_simhash(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


# Words, and windows of each length an item has, joined by spaces.
OP2_SQL = rf"""
WITH items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER_SQL.format(text="text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
windows AS (
    SELECT DISTINCT item, least(10, len(w)) AS k, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS phrase
    FROM items, LATERAL (SELECT unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s) WHERE len(w) > 0),
docs AS (
    SELECT doc_id, coalesce(regexp_extract_all({LOWER_SQL.format(text="text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
places AS (
    SELECT doc_id, s, k, array_to_string(w[s:s + k - 1], ' ') AS phrase
    FROM docs, (SELECT DISTINCT k FROM windows), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS s)),
hits AS (SELECT doc_id, s, k, item FROM places JOIN windows USING (k, phrase)),
hit_words AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS i FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query(OP2_SQL)
def op2_decontamination(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("row_key")


@query()
def op4_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), remembered=320 << 20)


@query(
    """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
            f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest, n) END AS first FROM p)
       SELECT page_id, n AS payload_bytes, digest AS payload_digest,
              CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
              CASE WHEN first <> page_id THEN first END AS refers_to
       FROM f"""
)
def op5_warc(spark, sf_dir):
    return archive(table(spark, sf_dir, "pages")).drop("url", "payload")


@query()
def op8_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out(F.col("doc_id"), 5, 0))


@query()
def op10_language_id(spark, sf_dir):
    held = held_out(F.col("doc_id"), 4, 2)
    return identify(table(spark, sf_dir, "documents"), ~held, held)


@query()
def op6_lm_scoring(spark, sf_dir):
    held, fold = held_out(F.col("doc_id"), 7, 2), held_out(F.col("doc_id"), 7, 3)
    return score_documents(table(spark, sf_dir, "documents"), held, fold)


@query(
    r"""WITH docs AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
             places AS (SELECT doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS phrase
                        FROM docs, LATERAL (SELECT unnest(range(1, len(w) - 48)) AS s)),
             hits AS (SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY phrase) AS owner FROM places) WHERE owner < doc_id),
             gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM hits),
             all_words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs),
             kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM all_words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
             removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)"""
)
def op3_substring_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept", "spans")


@query()
def op1_license_scan(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))


# crc32 byte by byte over its table of 256 remainders, once for each distinct feature.
OP13_SQL = rf"""
WITH RECURSIVE bits AS (
    SELECT CAST(range AS BIGINT) AS i, CAST(range AS BIGINT) AS c, 0 AS k FROM range(256)
    UNION ALL SELECT i, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), k + 1 FROM bits WHERE k < 8),
remainders AS (SELECT list(c ORDER BY i) AS r FROM bits WHERE k = 8),
docs AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER_SQL.format(text="text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
items AS (SELECT coalesce(regexp_extract_all({LOWER_SQL.format(text="text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
doc_features AS (
    SELECT doc_id, array_to_string(w[s:s + k - 1], ' ') AS f
    FROM docs, (SELECT unnest([1, 2, 3]) AS k), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS s)),
item_features AS (
    SELECT array_to_string(w[s:s + k - 1], ' ') AS f
    FROM items, (SELECT unnest([1, 2, 3]) AS k), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS s)),
hashed AS (
    SELECT f, xor(list_reduce(
        list_prepend(4294967295, list_transform(range(0, strlen(f)), lambda j: CAST('0x' || substr(hex(encode(f)), CAST(2 * j + 1 AS BIGINT), 2) AS BIGINT))),
        lambda c, b: xor(c >> 8, r[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM (SELECT f FROM doc_features UNION SELECT f FROM item_features), remainders),
s AS (SELECT bucket, count(*) AS n FROM doc_features JOIN hashed USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM item_features JOIN hashed USING (f) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM doc_features) AS ss, (SELECT count(*) FROM item_features) AS tt),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST(ss + 10000 AS DOUBLE) / (CAST(s.n + 1 AS DOUBLE) * CAST(tt + 10000 AS DOUBLE)))) AS BIGINT) AS gain
    FROM s LEFT JOIN t USING (bucket), totals),
sums AS (SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM doc_features JOIN hashed USING (f) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
    SELECT doc_id, len(w) >= 20 AS able, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
    FROM docs LEFT JOIN sums USING (doc_id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, 5 * count(*) FILTER (able) OVER () // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= drawn THEN place END AS rank FROM placed
"""


@query(OP13_SQL)
def op13_target_resampling(spark, sf_dir):
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op12_tokenizer_alignment(spark, sf_dir):
    return alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query(
    """WITH RECURSIVE able AS (
           SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE label IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
       pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
                 WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
       reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a)
       SELECT vec_id, (SELECT count(*) FROM pairs WHERE a = vec_id) AS n_links, min(b) AS component_id, vec_id = min(b) AS kept
       FROM embeddings JOIN reach ON a = vec_id GROUP BY vec_id"""
)
def op11_embedding_near_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))
