"""One query per operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..queries.registry import Query, table
from .filter_audit import audit
from .hard_negatives import hard_negatives
from .mixing import mix
from .nearest import top_k
from .packing import encode, pack
from .page_text import main_text
from .secret_tags import find_secrets, learn, report
from .sentence_pieces import checked
from .shingle_join import near_documents
from .suffix_dedup import drop_repeats
from .toxicity import toxicity
from .vector_join import near_vectors
from .warc_records import derive, responses

#: Public tokenizer files by name.
BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"

LLM: dict[str, Query] = {}


def query(name, sql=None):
    def add(run):
        LLM[name] = Query(run, sql)
        return run

    return add


@query(
    "op1_near_vectors",
    """
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reached(vec_id, other) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT r.vec_id, l.y FROM reached r JOIN links l ON l.x = r.other
), c AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id),
n AS (SELECT x, count(*) AS n_links FROM links GROUP BY x)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c USING (vec_id) LEFT JOIN n ON n.x = e.vec_id
""",
)
def op1_near_vectors(spark, folder):
    return near_vectors(table(spark, folder, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


@query("op2_sentence_pieces")
def op2_sentence_pieces(spark, folder):
    return checked(table(spark, folder, "documents"), PIECES)


@query("op3_drop_repeats")
def op3_drop_repeats(spark, folder):
    return drop_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256")
    )


@query("op4_pack")
def op4_pack(spark, folder):
    pieces = pack(encode(table(spark, folder, "documents"), BYTE_BPE))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op5_near_documents")
def op5_near_documents(spark, folder):
    return near_documents(table(spark, folder, "documents")).drop("digest")


@query("op6_secrets")
def op6_secrets(spark, folder):
    documents = table(spark, folder, "documents")
    return report(find_secrets(documents.select("doc_id", "text"), learn(documents)))


@query("op7_toxicity")
def op7_toxicity(spark, folder):
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op8_main_text")
def op8_main_text(spark, folder):
    return main_text(table(spark, folder, "pages"))


@query("op9_warc_derive")
def op9_warc_derive(spark, folder):
    return derive(responses(table(spark, folder, "pages")))


@query(
    "op10_top_k",
    """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
)
def op10_top_k(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


@query(
    "op11_filter_audit",
    r"""
WITH d AS (
    SELECT d.doc_id, coalesce(d.lang, '') AS part, coalesce(d.text, '') AS text,
        regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+') AS words,
        coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic
    FROM documents d LEFT JOIN (
        SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
    ) l USING (doc_id)
), least AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text
), m AS (
    SELECT part, good, toxic,
        (len(words) < 200)::INT
        + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
        + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT
        + 8 * regexp_matches(text, '[#$%&*|]')::INT
        + 16 * coalesce(doc_id > least, false)::INT AS mask
    FROM d JOIN least USING (text)
), f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), o AS (
    SELECT concat(a.letter, b.letter, c.letter, d.letter, e.letter) AS filter_order,
        [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM f a JOIN f b ON b.bit <> a.bit JOIN f c ON c.bit NOT IN (a.bit, b.bit)
    JOIN f d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN f e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)
), s AS (
    SELECT filter_order, step::INT AS step, bits[step] AS bit, coalesce(list_sum(bits[1 : step - 1]), 0)::INT AS ahead
    FROM o, range(1, 6) t(step)
), g AS (
    SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask
), r AS (
    SELECT part, filter_order, step, bit,
        coalesce(sum(n) FILTER (mask & (ahead | bit) = 0), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & ahead = 0), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & ahead <> 0), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & ahead = 0), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & ahead = 0), 0)::BIGINT AS toxic_lost
    FROM g, s GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r
""",
)
def op11_filter_audit(spark, folder):
    return audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(
    "op12_mix",
    r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        md5(concat('mix:', coalesce(doc_id::VARCHAR, ''), ':', coalesce(text, ''))) AS key
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size) AS cap,
        [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM d GROUP BY source
), line AS (
    SELECT *, row_number() OVER w AS place, coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS clamped,
        sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS weights,
        1.5::DOUBLE * sum(source_size) OVER () AS total
    FROM s WINDOW w AS (ORDER BY cap / weight, source NULLS LAST)
), level AS (
    SELECT place AS stop, total - clamped AS rest, weights FROM line
    WHERE (total - clamped) * weight <= cap * weights ORDER BY place LIMIT 1
), t AS (
    SELECT source, source_size,
        CASE WHEN place < stop THEN cap ELSE rest * weight / level.weights END AS target
    FROM line, level
), p AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(floor(target) / source_size)::BIGINT ELSE 0 END AS whole FROM t
), k AS (
    SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, floor(p.target)::BIGINT - p.whole * p.source_size AS extra,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY key) AS upto,
        sum(d.size) OVER (PARTITION BY d.source, key) AS peers, count(*) OVER (PARTITION BY d.source, key) AS n
    FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
    (whole * size + CASE WHEN upto <= extra THEN size WHEN upto - peers < extra
        THEN floor((extra - upto + peers) / n) ELSE 0 END)::BIGINT AS taken
FROM k
""",
)
def op12_mix(spark, folder):
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query(
    "op13_hard_negatives",
    """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
    AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""",
)
def op13_hard_negatives(spark, folder):
    label = F.expr("case when vec_id % 7 = 0 then (label + 1) % 10 else label end")
    vectors = table(spark, folder, "embeddings").withColumn("label", label)
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)
