"""The corpus operators as queries over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ebbtide.llm.common import read
from ebbtide.llm.group_join import similar_documents
from ebbtide.llm.html_text import extracted_pages
from ebbtide.llm.line_dedup import without_repeats
from ebbtide.llm.nn_descent import near_duplicates
from ebbtide.llm.packing import packed, vocabulary
from ebbtide.llm.periodic_runs import periodic_runs, run_digests, with_planted_tails
from ebbtide.llm.pii import with_pseudonyms
from ebbtide.llm.preferences import preference_pairs, rendered_pairs
from ebbtide.llm.prefix_trie import conversation_trie, distinct_conversations, ordered_turns, with_shared_starts
from ebbtide.llm.quality import scored
from ebbtide.llm.toxicity import toxicity
from ebbtide.llm.winnowing import contaminated_documents
from ebbtide.llm.zip_warc import archived
from ebbtide.session import stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if oracle is not None:
            ORACLE[name] = oracle
        return query

    return add


@register("op2_text_density")
def op2(spark, sf_dir):
    return extracted_pages(read(spark, sf_dir, "pages"))


@register("op3_token_group_join")
def op3(spark, sf_dir):
    return similar_documents(read(spark, sf_dir, "documents"), width=3, percent=90)


@register("op5_line_windows")
def op5(spark, sf_dir):
    return without_repeats(read(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


# Stands for the key that a deployment draws at random and keeps; the query only has to give the same result each time.
DEMONSTRATION_KEY = b"a key for tables of invented data"


@register("op1_feistel_pseudonyms")
def op1(spark, sf_dir):
    return with_pseudonyms(read(spark, sf_dir, "documents"), DEMONSTRATION_KEY)


PREFERENCES = """WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         max(CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id) AS last_reply
  FROM conversations),
chosen AS (SELECT conv_id AS pair_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i
           FROM turns WHERE last_reply IS NOT NULL),
earlier AS (SELECT conv_id, lag(conv_id) OVER (ORDER BY conv_id) AS pair_id
            FROM (SELECT DISTINCT conv_id FROM turns WHERE last_reply IS NOT NULL)),
mixed AS (SELECT conv_id AS pair_id, 0 AS part, turn, role, text FROM turns WHERE turn < last_reply
          UNION ALL
          SELECT pair_id, 1, turn, role, text FROM turns JOIN earlier USING (conv_id) WHERE turn >= last_reply),
rejected AS (SELECT pair_id, role, text, row_number() OVER (PARTITION BY pair_id ORDER BY part, turn, role, text) AS i
             FROM mixed WHERE pair_id IN (SELECT pair_id FROM chosen)),
sizes AS (SELECT pair_id, (SELECT count(*) FROM chosen c WHERE c.pair_id = p.pair_id) AS n_chosen,
                 (SELECT count(*) FROM rejected r WHERE r.pair_id = p.pair_id) AS n_rejected
          FROM (SELECT DISTINCT pair_id FROM chosen) p),
differ AS (SELECT c.pair_id, min(c.i) AS i FROM chosen c LEFT JOIN rejected r ON r.pair_id = c.pair_id AND r.i = c.i
           WHERE r.i IS NULL OR r.role <> c.role OR r.text <> c.text GROUP BY c.pair_id),
shared AS (SELECT s.pair_id, n_chosen, n_rejected, coalesce(d.i - 1, n_chosen) AS n_prompt FROM sizes s LEFT JOIN differ d USING (pair_id)),
headed AS (SELECT h.*, coalesce(c.role = 'assistant' AND (r.role = 'assistant' OR r.role IS NULL), false) AS opens,
                  r.role IS NOT NULL AS has_rejected
           FROM shared h LEFT JOIN chosen c ON c.pair_id = h.pair_id AND c.i = n_prompt + 1
                         LEFT JOIN rejected r ON r.pair_id = h.pair_id AND r.i = n_prompt + 1),
prompts AS (SELECT h.pair_id, coalesce(string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY i)
                     FILTER (WHERE i <= n_prompt), '') || CASE WHEN any_value(opens) THEN '<|im_start|>assistant' || chr(10) ELSE '' END AS prompt
            FROM headed h JOIN chosen c USING (pair_id) GROUP BY h.pair_id),
pieces AS (SELECT side, pair_id, i, role,
                  CASE WHEN opens AND i = n_prompt + 1 THEN '' ELSE '<|im_start|>' || role || chr(10) END AS head,
                  text || '<|im_end|>' || chr(10) AS body
           FROM (SELECT 'chosen' AS side, * FROM chosen UNION ALL SELECT 'rejected', * FROM rejected) JOIN headed USING (pair_id) WHERE i > n_prompt),
placed AS (SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY side, pair_id ORDER BY i
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS start FROM pieces),
sides AS (SELECT side, pair_id, string_agg(head || body, '' ORDER BY i) AS completion,
                 coalesce(string_agg(CAST(start AS VARCHAR) || '+' || CAST(length(body) AS VARCHAR), ',' ORDER BY i)
                          FILTER (WHERE role = 'assistant'), '') AS trained
          FROM placed GROUP BY side, pair_id)
SELECT h.pair_id, CAST(n_prompt AS INT) AS n_prompt_turns, prompt, coalesce(a.completion, '') AS chosen, coalesce(a.trained, '') AS chosen_trained,
       coalesce(b.completion, '') AS rejected, coalesce(b.trained, '') AS rejected_trained
FROM headed h JOIN prompts p USING (pair_id) LEFT JOIN sides a ON a.pair_id = h.pair_id AND a.side = 'chosen'
LEFT JOIN sides b ON b.pair_id = h.pair_id AND b.side = 'rejected'"""


@register("op4_preference_pairs", PREFERENCES)
def op4(spark, sf_dir):
    """Every conversation with a reply is chosen; its rejected side ends with the last reply of the next one by id."""
    return rendered_pairs(*preference_pairs(read(spark, sf_dir, "conversations")))


REVISITS = """WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, sha256(coalesce(html, '')) AS digest FROM pages),
firsts AS (SELECT digest, min(page_id) AS least FROM payloads WHERE octet_length(encode(payload)) >= 100 GROUP BY digest)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id > least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > least THEN least END AS refers_to
FROM payloads LEFT JOIN firsts USING (digest)"""


@register("op6_zip_packaged_warc", REVISITS)
def op6(spark, sf_dir):
    return archived(read(spark, sf_dir, "pages"))


@register("op7_vector_best_fit")
def op7(spark, sf_dir):
    return packed(read(spark, sf_dir, "documents"), *vocabulary())


@register("op8_weak_label_quality")
def op8(spark, sf_dir):
    return scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@register("op9_winnowing")
def op9(spark, sf_dir):
    return contaminated_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@register("op10_nn_descent")
def op10(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "embeddings"))


@register("op11_recompression_runs")
def op11(spark, sf_dir):
    return run_digests(periodic_runs(with_planted_tails(read(spark, sf_dir, "documents"))))


# The CRC-32 of each id is taken bit by bit, and every node meets all its ancestors.
TRIE = """WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, role, text
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
           list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda s, b: list_reduce(list_concat([xor(s, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda t, z: xor(t >> 1, 3988292384 * (t & 1)))),
         4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM own)),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, i, role, text FROM convs c JOIN own o ON o.conv_id = c.base AND i <= h
  UNION ALL SELECT conv_id, 1, i, role, text FROM own JOIN convs USING (conv_id) WHERE i > h),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS depth FROM rebuilt),
prefixes AS (
  SELECT conv_id, depth, length(text) AS chars,
         string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS p FROM placed
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
members AS (SELECT conv_id AS member, depth, chars, min(conv_id) OVER (PARTITION BY depth, p) AS owner FROM prefixes),
nodes AS (SELECT owner, depth, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved FROM members GROUP BY owner, depth),
parents AS (SELECT n.*, m.owner AS parent FROM nodes n LEFT JOIN members m ON m.member = n.owner AND m.depth = n.depth - 1),
children AS (SELECT parent AS owner, depth - 1 AS depth, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT p.*, coalesce(n_children, 0) AS n_children FROM parents p LEFT JOIN children c USING (owner, depth)),
totals AS (
  SELECT a.owner, a.depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(n.saved) AS saved_tokens
  FROM full_nodes n JOIN members a ON a.member = n.owner AND a.depth <= n.depth GROUP BY a.owner, a.depth),
ends AS (
  SELECT owner, depth, string_agg(CAST(member AS VARCHAR), ',' ORDER BY member) AS ids
  FROM (SELECT *, max(depth) OVER (PARTITION BY member) AS last FROM members) WHERE depth = last GROUP BY owner, depth)
SELECT owner AS conv_id, CAST(depth AS BIGINT) AS depth, parent AS parent_conv_id, n_convs, CAST(n_children AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM full_nodes JOIN totals USING (owner, depth) LEFT JOIN ends USING (owner, depth)"""


@register("op12_centroid_trie", TRIE)
def op12(spark, sf_dir):
    conversations = read(spark, sf_dir, "conversations")
    turns = stage(ordered_turns(conversations), "ordered-turns")
    return conversation_trie(*with_shared_starts(turns, distinct_conversations(conversations)))


@register("op13_factorization_machine")
def op13(spark, sf_dir):
    """Labels of a fifth of the ids, by their CRC-32, are held out."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    scored = toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels").where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@register("pipeline")
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
