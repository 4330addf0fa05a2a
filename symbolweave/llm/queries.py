"""Queries that apply each operator to its whole table, and the SQL that states their results where SQL can."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symbolweave.llm import bpe, fuzzy_lines, itq, jaccard_join, langid, mixing, norm_topk, pii_crf, suffix_dedup, token_align, toxicity, turn_repair, warc
from symbolweave.llm.common import fold_of, ship, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _query(name: str, sql: str | None = None):
    def add(run):
        def shipped(spark, folder):
            ship(spark)
            return run(spark, folder)

        QUERIES[name] = shipped
        if sql:
            ORACLES[name] = sql
        return run
    return add


MIX_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           md5('7:' || COALESCE(doc_id::VARCHAR, '')) AS key
    FROM documents
), s AS (
    SELECT source, sum(size)::DOUBLE AS source_size,
           CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM d GROUP BY source
), fill(round, level, clamped) AS (
    SELECT 0, (SELECT 1.5 * sum(source_size) / sum(weight) FROM s), 0::BIGINT
    UNION ALL
    SELECT round + 1,
           ((SELECT 1.5 * sum(source_size) FROM s) - (SELECT COALESCE(sum(2 * source_size), 0) FROM s WHERE weight * level > 2 * source_size))
               / (SELECT sum(weight) FROM s WHERE weight * level <= 2 * source_size),
           (SELECT count(*) FROM s WHERE weight * level > 2 * source_size)
    FROM fill WHERE round = 0 OR (SELECT count(*) FROM s WHERE weight * level > 2 * source_size) > clamped
), t AS (
    SELECT source, source_size, LEAST(weight * level, 2 * source_size) AS target
    FROM s, (SELECT level FROM fill ORDER BY round DESC LIMIT 1)
), n AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t
), p AS (
    SELECT doc_id, source, size, COALESCE(sum(size) OVER (
        PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d
)
SELECT p.doc_id, p.source, p.size, n.source_size::BIGINT AS source_size, n.target, n.whole::BIGINT AS repeats,
       GREATEST(0, LEAST(p.size, floor(n.target + 0.5) - n.whole * n.source_size - p.before))::BIGINT AS part,
       (n.whole * p.size + GREATEST(0, LEAST(p.size, floor(n.target + 0.5) - n.whole * n.source_size - p.before)))::BIGINT AS taken
FROM p JOIN n ON p.source IS NOT DISTINCT FROM n.source
"""


@_query("op1_source_mix", MIX_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """The mix of all documents: 150% of their words over the sources by weights 5, 2, 1, at most two epochs each."""
    return mixing.mix(_table(spark, folder, "documents"))


def vocabulary() -> str:
    """The vocabulary file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


NEAR_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), u AS (
    SELECT *, sqrt(list_dot_product(x, x)) AS norm FROM v
), pairs AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
        AND len(a.x) = len(b.x) AND list_dot_product(a.x, b.x) / (a.norm * b.norm) >= 0.93
    WHERE a.norm > 0 AND b.norm > 0
), reach(node, other) AS (
    SELECT a, b FROM pairs UNION SELECT r.node, p.b FROM reach r JOIN pairs p ON r.other = p.a
), least AS (
    SELECT node, LEAST(node, min(other)) AS component FROM reach GROUP BY node
), links AS (
    SELECT a, count(*) AS n FROM pairs GROUP BY a
)
SELECT e.vec_id, COALESCE(links.n, 0)::BIGINT AS n_links, COALESCE(least.component, e.vec_id) AS component_id,
       e.vec_id = COALESCE(least.component, e.vec_id) AS kept
FROM embeddings e LEFT JOIN links ON e.vec_id = links.a LEFT JOIN least ON e.vec_id = least.node
"""


@_query("op2_itq_near_dup", NEAR_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all vectors with equal labels and cosine of at least 0.93."""
    return itq.near_duplicates(_table(spark, folder, "embeddings"))


@_query("op3_nb_toxicity")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every whole text, learnt from the labels outside the held-out third."""
    documents, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    fold = fold_of(F.col("doc_id"), 3)
    model = toxicity.fit(toxicity.labelled_sample(documents, labels, fold != 1, "toxic"))
    return toxicity.score_documents(documents, model, fold == 1)


TOP_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.x, v.x)::BIGINT AS score
    FROM v q JOIN v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id AND len(q.x) = len(v.x)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@_query("op4_norm_bucket_topk", TOP_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """The ten highest integer products of every hundredth vector against all others."""
    vectors = _table(spark, folder, "embeddings")
    return norm_topk.top_k(vectors, vectors.where("vec_id % 100 = 0").select("vec_id"))


@_query("op5_suffix_dedup")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole text without the bytes of 200-byte strings that start anywhere else too."""
    kept = suffix_dedup.dedup_bytes(_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query("op6_bpe_round_trip")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts and digests of every whole text, encoded and decoded again."""
    return bpe.encode_documents(_table(spark, folder, "documents"), vocabulary(), keep_ids=False)


WARC_SQL = """
WITH p AS (
    SELECT page_id, COALESCE(html, '') AS html, sha1(COALESCE(html, '')) AS hex,
           min(page_id) OVER (PARTITION BY COALESCE(html, '')) AS first_id
    FROM pages
)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
           (('0x' || substr(hex, 1 + 5 * (i // 4)::INTEGER, 5))::BIGINT >> (15 - 5 * (i % 4))::INTEGER) & 31)::INTEGER, 1)), 'string_agg', '')
           AS payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p
"""


@_query("op7_warc_normalise", WARC_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to whole-file gzip archives, normalised to one member per record and read by offset."""
    archives = stored(warc.write_archives(_table(spark, folder, "pages")), "warc-streams")
    normal = stored(warc.normalise(archives), "warc-members")
    number = lambda c: F.col(c).cast("long")
    return warc.read_records(normal, payloads=False).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


@_query("op9_cross_parse_language")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every whole text, learnt from the documents outside the held-out quarter."""
    documents = _table(spark, folder, "documents")
    fold = fold_of(F.col("doc_id"), 4)
    parser = langid.fit(documents.where(fold != 2))
    return langid.identify(documents, parser, fold == 2)


JACCARD_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), s AS (
    SELECT doc_id, CASE WHEN COALESCE(len(words), 0) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3])) END AS shingles
    FROM w
), e AS (
    SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s
), met AS (
    SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS k FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    WHERE 100 * LEAST(a.n, b.n) >= 85 * GREATEST(a.n, b.n) GROUP BY ALL
), pairs AS (
    SELECT a, b FROM met WHERE 100 * k >= 85 * (na + nb - k)
), reach(node, other) AS (
    SELECT a, b FROM pairs UNION SELECT r.node, p.b FROM reach r JOIN pairs p ON r.other = p.a
), least AS (
    SELECT node, LEAST(node, min(other)) AS component FROM reach GROUP BY node
)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, COALESCE(least.component, s.doc_id) AS component_id
FROM s LEFT JOIN least ON s.doc_id = least.node
"""


@_query("op8_voronoi_jaccard", JACCARD_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of all documents whose sets of four-word shingles are linked at 85%."""
    return jaccard_join.jaccard_groups(_table(spark, folder, "documents"))


@_query("op10_minhash_lines")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with one line of each group of near-equal lines: counts and a digest of the text that stays."""
    kept = fuzzy_lines.dedup_lines(_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@_query("op11_pii_spans")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every whole text: the fixed patterns' counts and digest, and all spans."""
    return pii_crf.find_spans(_table(spark, folder, "documents"))


@_query("op12_token_align")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole text in the tokens of two vocabularies: groups, links and how common the links are in the corpus."""
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_align.align(_table(spark, folder, "documents"), *paths).measures()


REPAIR_SQL = r"""
WITH RECURSIVE crc_table AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_concat([i::UBIGINT], list_transform(range(8), lambda k: 0::UBIGINT)),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS c FROM range(256) r(i))
), keyed AS (
    SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
           COALESCE(conv_id::VARCHAR, ' ') || ':' || COALESCE(turn::VARCHAR, ' ') AS key FROM conversations
), coded AS (
    SELECT conv_id, turn, role, text, xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(range(1, strlen(key) + 1), lambda i: ascii(key[i])::UBIGINT)),
            lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)::INTEGER])), 4294967295::UBIGINT) % 20 AS code
    FROM keyed k, crc_table
), damaged AS (
    SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN code = 1 THEN '' WHEN code = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy
    FROM coded WHERE code <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 256), md5(text), copy) AS i,
           row_number() OVER (PARTITION BY conv_id, role, md5(text) ORDER BY turn NULLS FIRST, left(text, 256), copy) AS nth,
           regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
    FROM damaged
), faulty AS (
    SELECT *, CASE WHEN last = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM placed
), summed AS (
    SELECT conv_id, count(*) AS n, COALESCE(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
           count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
           count(*) FILTER (WHERE fault = 't') AS truncated,
           count(*) FILTER (WHERE before IS NOT NULL AND before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faulty GROUP BY conv_id
), moves(a, b, cost, edits, lines) AS (
    -- States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant; inserts lead from one to the next.
    VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
           (0, 2, 2, 'I', 'user:' || chr(10)), (1, 2, 2, 'I', 'user:' || chr(10)), (2, 3, 2, 'I', 'assistant:' || chr(10)), (3, 2, 2, 'I', 'user:' || chr(10)),
           (0, 3, 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), (1, 3, 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))
), steps AS (
    SELECT f.conv_id, f.i, m.a, e.b, m.cost + e.cost AS cost, m.edits || e.edit AS edits, m.lines || e.line AS lines
    FROM faulty f, moves m, LATERAL (
        SELECT m.b AS b, 3 AS cost, 'D' AS edit, '' AS line
        UNION ALL SELECT CASE WHEN m.b = 2 THEN 3 ELSE 2 END, 2 + (f.fault = 't')::INTEGER, 'R',
            CASE WHEN m.b = 2 THEN 'assistant' ELSE 'user' END || ':' || f.text || chr(10) WHERE f.fault IN ('-', 't')
        UNION ALL SELECT CASE left(f.role, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, (f.fault = 't')::INTEGER, 'K', f.role || ':' || f.text || chr(10)
            WHERE f.fault IN ('-', 't') AND ((m.b = 0 AND left(f.role, 1) IN ('s', 'u')) OR (m.b = 1 AND left(f.role, 1) = 'u')
                OR (m.b = 2 AND left(f.role, 1) = 'a') OR (m.b = 3 AND left(f.role, 1) = 'u'))) e
), paths(conv_id, i, state, cost, audit, lines) AS (
    SELECT conv_id, 0::BIGINT, 0, 0, '', '' FROM summed
    UNION ALL
    SELECT conv_id, i, state, best.cost, best.audit, best.lines FROM (
        SELECT p.conv_id, s.i, s.b AS state, min({'cost': p.cost + s.cost, 'audit': p.audit || s.edits, 'lines': p.lines || s.lines}) AS best
        FROM paths p JOIN steps s ON p.conv_id IS NOT DISTINCT FROM s.conv_id AND s.i = p.i + 1 AND s.a = p.state GROUP BY ALL)
), ended AS (
    SELECT p.conv_id, min({'cost': p.cost + m.cost, 'audit': p.audit || m.edits, 'lines': p.lines || m.lines}) AS best
    FROM paths p JOIN summed s ON p.conv_id IS NOT DISTINCT FROM s.conv_id AND p.i = s.n JOIN moves m ON m.a = p.state AND m.b IN (0, 3)
    GROUP BY p.conv_id
)
SELECT o.conv_id, COALESCE(s.gaps, 0)::BIGINT AS gaps, COALESCE(s.blank, 0)::BIGINT AS blank, COALESCE(s.duplicate, 0)::BIGINT AS duplicate,
       COALESCE(s.truncated, 0)::BIGINT AS truncated, COALESCE(s.illegal, 0)::BIGINT AS illegal, COALESCE(e.best.cost, 0)::BIGINT AS cost,
       COALESCE(e.best.audit, '') AS audit, sha256(COALESCE(e.best.lines[:-2], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN summed s ON o.conv_id IS NOT DISTINCT FROM s.conv_id LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""


@_query("op13_turn_repair", REPAIR_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation after the damage: its faults, its cheapest edits and a digest of its repaired turns."""
    return turn_repair.repair(_table(spark, folder, "conversations")).report()
