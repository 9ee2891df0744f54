"""Registered queries of the training-data operators and their SQL twins.

Each query applies its operator, with production parameters, to the whole of
its table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (
    alignment,
    chat_format,
    jaccard_join,
    language_id,
    line_dedup,
    lm_scoring,
    mixing,
    ordinal_quality,
    packing,
    training_order,
    vector_dedup,
    vector_search,
    whitening,
)
from ledgerlake.llm.common import prepare, table


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade (0 toxic, 1 low quality, 2 good) and P(good) of every
    document; ``kept`` selects those with P(good) of at least a half."""
    docs = table(spark, sf_dir, "documents")
    model = ordinal_quality.fit(docs, ordinal_quality.graded(table(spark, sf_dir, "labels")), levels=3)
    return ordinal_quality.score(docs, model, tail=2)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat or nearly repeat an earlier
    line of the corpus."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written to fixed-stride shards in permuted order; the rows
    are read back from the shard files."""
    return training_order.training_order(table(spark, sf_dir, "documents"))


def op4_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.format_conversations(turns.unionByName(own))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, number of links and verdict of every document at a Jaccard
    similarity of 0.8 on five-word shingles."""
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight whitened components of every usable vector."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under context mixing, next to that of
    its tokens one by one."""
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between two public vocabularies in every document."""
    return alignment.align_documents(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_ordinal_quality,
            op2_line_dedup,
            op3_training_order,
            op4_vector_dedup,
            op5_best_fit_packing,
            op6_vector_search,
            op7_chat_format,
            op8_mix_sources,
            op9_language_id,
            op10_jaccard_join,
            op11_embedding_whitening,
            op12_lm_scoring,
            op13_tokenizer_alignment,
        )
    }


_COMPONENTS = """
  reach(node, other) AS (
    SELECT a, b FROM links
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
  ),
  comp AS (SELECT node, least(node, min(other)) AS component FROM reach GROUP BY node),
  degree AS (SELECT a AS node, count(DISTINCT b) AS n FROM links GROUP BY a)
"""

ORACLES = {
    "op2_line_dedup": r"""
WITH l AS (
  SELECT doc_id, text, i - 1 AS pos, string_split(text, chr(10))[i] AS line
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS k, min((doc_id, pos)) OVER (PARTITION BY line) AS born
  FROM l WHERE trim(line) <> ''
),
d AS (SELECT line, born, length(line) AS n FROM ranked WHERE k = 1 AND length(line) >= 20),
near AS (
  SELECT DISTINCT CASE WHEN a.born > b.born THEN a.line ELSE b.line END AS line
  FROM d a JOIN d b ON a.n = b.n AND a.line < b.line AND left(a.line, a.n // 2) = left(b.line, b.n // 2)
  WHERE len(list_filter(range(1, a.n + 1), lambda i: a.line[i] <> b.line[i])) = 1
  UNION
  SELECT DISTINCT CASE WHEN a.born > b.born THEN a.line ELSE b.line END
  FROM d a JOIN d b ON a.n = b.n AND a.line < b.line AND right(a.line, a.n - a.n // 2) = right(b.line, b.n - b.n // 2)
  WHERE len(list_filter(range(1, a.n + 1), lambda i: a.line[i] <> b.line[i])) = 1
  UNION
  SELECT DISTINCT CASE WHEN a.born > b.born THEN a.line ELSE b.line END
  FROM d a JOIN d b ON b.n = a.n + 1 AND left(a.line, a.n // 2) = left(b.line, a.n // 2)
  WHERE len(list_filter(range(1, b.n + 1), lambda i: left(b.line, i - 1) || right(b.line, b.n - i) = a.line)) > 0
  UNION
  SELECT DISTINCT CASE WHEN a.born > b.born THEN a.line ELSE b.line END
  FROM d a JOIN d b ON b.n = a.n + 1 AND right(a.line, a.n - a.n // 2) = right(b.line, a.n - a.n // 2)
  WHERE len(list_filter(range(1, b.n + 1), lambda i: left(b.line, i - 1) || right(b.line, b.n - i) = a.line)) > 0
),
gone AS (SELECT doc_id, pos FROM ranked WHERE k > 1 OR line IN (SELECT line FROM near)),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text
  FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos WHERE g.pos IS NULL GROUP BY l.doc_id
)
SELECT t.doc_id,
       CASE WHEN t.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       CAST((SELECT count(*) FROM gone g WHERE g.doc_id = t.doc_id) AS BIGINT) AS n_dropped,
       CAST(coalesce(len(string_split(t.text, chr(10))), 0) AS BIGINT) AS n_lines
FROM documents t LEFT JOIN kept k ON k.doc_id = t.doc_id
""",
    "op4_vector_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
    ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.95
),"""
    + _COMPONENTS
    + """
SELECT e.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, coalesce(c.component, e.vec_id) AS component_id,
       e.vec_id = coalesce(c.component, e.vec_id) AS kept
FROM embeddings e LEFT JOIN degree d ON d.node = e.vec_id LEFT JOIN comp c ON c.node = e.vec_id
""",
    "op7_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
control AS (
  SELECT unnest(['<s>', '</s>', '[INST]', '[/INST]', '<<SYS>>', '<</SYS>>', '<|role|>', '<|text|>', '<|end|>', '<|endoftext|>', '<|im_start|>', '<|im_end|>', '\']) AS c
),
marked AS (
  SELECT t.*, (SELECT sum((length(t.text) - length(replace(t.text, c, ''))) // length(c)) FROM control) AS extra,
         CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 23 + length(role) END AS around
  FROM turns t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
       CAST(sum(length(text) + extra + around) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
""",
    "op8_mix_sources": r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, '')) || coalesce('|=' || source, '|')) AS key
  FROM documents
),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, source_size * 3 AS stop FROM per
),
rising AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(stop) OVER lower, 0) AS words_left, sum(w) OVER () - coalesce(sum(w) OVER lower, 0) AS weight_left,
         row_number() OVER (ORDER BY stop / w, source NULLS LAST) AS k
  FROM weighed WINDOW lower AS (ORDER BY stop / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
open AS (SELECT k, words_left, weight_left FROM rising WHERE words_left * w <= stop * weight_left ORDER BY k LIMIT 1),
goal AS (
  SELECT r.source, r.source_size,
         CASE WHEN r.k >= o.k THEN CAST(o.words_left AS DOUBLE) * CAST(r.w AS DOUBLE) / CAST(o.weight_left AS DOUBLE) ELSE CAST(r.stop AS DOUBLE) END AS target
  FROM rising r LEFT JOIN open o ON true
),
placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, CAST(floor(g.target + 0.5) AS BIGINT) AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0
            ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
FROM placed
""",
    "op10_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws FROM documents WHERE doc_id IS NOT NULL
),
grams AS (
  SELECT DISTINCT doc_id, gram FROM (
    SELECT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS gram
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
  )
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 5 * c >= 4 * (p.n + q.n - c)
),"""
    + _COMPONENTS
    + """
SELECT t.doc_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, coalesce(c.component, t.doc_id) AS component_id,
       t.doc_id = coalesce(c.component, t.doc_id) AS kept
FROM documents t LEFT JOIN degree d ON d.node = t.doc_id LEFT JOIN comp c ON c.node = t.doc_id
""",
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express exactly."""
    return dict(ORACLES)
