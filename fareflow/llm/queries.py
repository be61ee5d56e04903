"""One registered query per operator, over its whole table.

Each query applies its operator with production parameters and derives the
returned columns from the operator's own output.  ``ORACLE`` holds DuckDB SQL
where SQL can express the result; the others are tested against brute force
in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm.common import prepare, read, with_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def tokenizer_file(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Path of a public rank file and the pattern that goes with it."""
    import public_tokenizers
    return public_tokenizers.path(name), public_tokenizers.PATTERN


@register("op8_byte_bpe")
def op8(spark, sf):
    """Encode every document by the public byte-level ranks, decode it again."""
    from fareflow.llm import bpe
    ranks, pattern = tokenizer_file()
    docs = with_text(read(spark, sf, "documents"))
    return bpe.round_trip(docs, ranks, pattern).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@register("op3_crf_toxicity")
def op3(spark, sf):
    """Toxicity score of every document; learned from rows not held out."""
    from fareflow.llm import crf
    docs = with_text(read(spark, sf, "documents"))
    model = crf.learn(docs, read(spark, sf, "labels"))
    return crf.tag(docs, model).select(
        "doc_id", crf.held_out().alias("held_out"), "score",
        F.when(F.col("score") >= crf.TOXIC, 1).otherwise(0).alias("predicted"), "spans")


@register("op4_simhash_near_dedup")
def op4(spark, sf):
    """SimHash fingerprints of every document and their linked groups."""
    from fareflow.llm import simhash
    return simhash.report(simhash.near_duplicates(read(spark, sf, "documents")))


@register("op5_secret_battery")
def op5(spark, sf):
    """Secrets in every document: fixed patterns and the randomness battery."""
    from fareflow.llm import secrets
    return secrets.report(secrets.scan(read(spark, sf, "documents").select("doc_id", "text")))


@register("op10_template_decontamination")
def op10(spark, sf):
    """Benchmark items that leaked into each document, by template windows."""
    from fareflow.llm import decontam
    return decontam.contamination(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


@register("op7_relative_lz_dedup")
def op7(spark, sf):
    """Words of every document outside 20-word runs that occur earlier."""
    from fareflow.llm import rlz
    return rlz.dedup(read(spark, sf, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register("op9_column_bwt_dedup")
def op9(spark, sf):
    """Bytes of every document outside 400-byte runs that also start elsewhere."""
    from fareflow.llm import colbwt
    return colbwt.dedup(read(spark, sf, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op9_column_bwt_dedup"] = """
WITH b AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), w AS (
  SELECT doc_id, i, md5(substr(x, 2 * i + 1, 800)) AS h
  FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 399)) AS i FROM b WHERE length(x) >= 800)
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM w) WHERE n > 1
), f AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 0 ELSE 1 END AS fresh FROM r
), s AS (
  SELECT doc_id, min(i) AS a, max(i) + 400 AS z
  FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM f) GROUP BY doc_id, run
), c AS (
  SELECT s.doc_id, a, z, substr(x, 2 * coalesce(lag(z) OVER d, 0) + 1, 2 * (a - coalesce(lag(z) OVER d, 0))) AS before,
    CASE WHEN lead(a) OVER d IS NULL THEN substr(x, 2 * z + 1) ELSE '' END AS rest
  FROM s JOIN b ON s.doc_id = b.doc_id WINDOW d AS (PARTITION BY s.doc_id ORDER BY a)
), k AS (
  SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, string_agg(before || rest, '' ORDER BY a) AS kept FROM c GROUP BY doc_id
)
SELECT b.doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM b LEFT JOIN k ON b.doc_id = k.doc_id
"""


@register("op6_arc_to_warc")
def op6(spark, sf):
    """Pages as legacy archives, converted to WARC, written and read back."""
    from fareflow.llm import arc
    path = arc.archive_folder(spark)
    arc.convert(arc.page_archives(read(spark, sf, "pages")), path)
    return arc.read_warc(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op6_arc_to_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p
), m AS (
  SELECT payload_digest, min(page_id) AS original FROM d WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN original IS NULL OR original = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN original = page_id THEN NULL ELSE original END AS refers_to
FROM d LEFT JOIN m USING (payload_digest)
"""

ORACLE["op7_relative_lz_dedup"] = """
WITH w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS words
  FROM documents
), s AS (
  SELECT doc_id, i, list_aggregate(words[i:i + 19], 'string_agg', ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w WHERE len(words) >= 20)
), f AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS n FROM s
), gone AS (
  SELECT doc_id, list(DISTINCT j) AS cut
  FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM f WHERE n > 1) GROUP BY doc_id
), k AS (
  SELECT w.doc_id, len(words) AS n_words, coalesce(len(cut), 0) AS n_removed,
    CASE WHEN cut IS NULL THEN words
         ELSE [words[j] FOR j IN range(1, len(words) + 1) IF NOT list_contains(cut, j)] END AS kept
  FROM w LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
  sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM k
"""


@register("op1_multi_index_hashing")
def op1(spark, sf):
    """Ten nearest sign codes of every hundredth vector, among all vectors."""
    from fareflow.llm import mih
    codes = mih.codes(read(spark, sf, "embeddings"))
    return mih.search(codes, codes.where("id % 100 = 0")).select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


ORACLE["op1_multi_index_hashing"] = """
WITH c AS (
  SELECT DISTINCT vec_id AS id, list_aggregate([CASE WHEN embedding[i] > 0 THEN CAST(1 AS HUGEINT) << (i - 1) ELSE 0 END
    FOR i IN range(1, len(embedding) + 1)], 'sum') AS code
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), d AS (
  SELECT q.id AS query_id, c.id AS vec_id,
    bit_count(xor(CAST(q.code AS UBIGINT), CAST(c.code AS UBIGINT))) AS distance
  FROM c q JOIN c ON q.id <> c.id WHERE q.id % 100 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(distance AS INTEGER) AS distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)
WHERE rank <= 10
"""


@register("op2_quotation_linking")
def op2(spark, sf):
    """Conversations in reply order, quoted passages linked and taken out."""
    from fareflow.llm import quotes
    return quotes.conversations(read(spark, sf, "conversations"))


@register("op11_lockstep_alignment")
def op11(spark, sf):
    """Two tokenizations of every document aligned by their common token ends."""
    from fareflow.llm import align
    import public_tokenizers
    docs = read(spark, sf, "documents")
    return align.alignment(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@register("op12_packed_counters")
def op12(spark, sf):
    """What each of five filters removes at every step of all 120 orders, by source."""
    from fareflow.llm import audit
    return audit.audit(audit.states(read(spark, sf, "documents"), read(spark, sf, "labels")))


ORACLE["op12_packed_counters"] = """
WITH RECURSIVE l AS (
  SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id
), t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS words
  FROM documents
), d AS (
  SELECT t.doc_id, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    {'A': len(words) < 50, 'B': 100 * len(list_distinct(words)) < 65 * len(words),
     'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
     'D': regexp_matches(text, '[#$%&*|]'),
     'E': coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)} AS f
  FROM t LEFT JOIN l USING (doc_id)
), s AS (
  SELECT part, good, toxic, concat(CASE WHEN f.A THEN 'A' ELSE '' END, CASE WHEN f.B THEN 'B' ELSE '' END,
    CASE WHEN f.C THEN 'C' ELSE '' END, CASE WHEN f.D THEN 'D' ELSE '' END, CASE WHEN f.E THEN 'E' ELSE '' END) AS fails, count(*) AS n
  FROM d GROUP BY ALL
), o(filter_order) AS (
  SELECT '' UNION ALL
  SELECT filter_order || c FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c) WHERE NOT contains(filter_order, c)
), p AS (
  SELECT filter_order, CAST(i AS INTEGER) AS step, filter_order[i:i] AS c, filter_order[1:i - 1] AS prior
  FROM (SELECT filter_order, unnest(range(1, 6)) AS i FROM o WHERE length(filter_order) = 5)
), r AS (
  SELECT *, contains(fails, c) AS failing, prior <> '' AND regexp_matches(fails, '[' || prior || '_]') AS gone FROM s, p
), g AS (
  SELECT part, filter_order, step, c,
    sum(CASE WHEN NOT failing AND NOT gone THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN failing AND gone THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = c THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN failing AND NOT gone AND good THEN n ELSE 0 END) AS good_lost,
    sum(CASE WHEN failing AND NOT gone AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM r GROUP BY part, filter_order, step, c
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, c) AS BIGINT) AS shapley
FROM g
"""


@register("op13_harmonic_packing")
def op13(spark, sf):
    """Pieces of all documents packed into sequences of 4096 tokens."""
    from fareflow.llm import harmonic
    import public_tokenizers
    return harmonic.pack(read(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
