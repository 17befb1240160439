"""The registered queries of this subpackage and their SQL twins.

Languages, toxicity, token counts, mixing, nearest neighbours, repeated
passages and page layout have no SQL twin: a learned model, a tokenizer, random
numbers, an approximate search or a tree isn't expressible, or not at these
sizes. Their tests compare with brute force, with the library, or on held-out
rows.
"""

from __future__ import annotations

import functools

from pricewatch.llm import (
    ann,
    centroids,
    chat,
    decontam,
    html_text,
    importance,
    langid,
    licenses,
    mixing,
    paragraphs,
    setsketch,
    tokencount,
    toxicity,
)
from pricewatch.llm.ship import ship


def _with_code(fn):
    @functools.wraps(fn)
    def run(spark, sf_dir):
        ship(spark)
        return fn(spark, sf_dir)
    return run


QUERIES = {name: _with_code(fn) for name, fn in {
    "op1_html_extraction": html_text.op1,
    "op2_toxic_spans": toxicity.op2,
    "op3_chat_format": chat.op3,
    "op4_setsketch_near_dedup": setsketch.op4,
    "op5_token_counts": tokencount.op5,
    "op6_paragraph_dedup": paragraphs.op6,
    "op7_decontamination": decontam.op7,
    "op8_graph_neighbours": ann.op8,
    "op9_language_id": langid.op9,
    "op10_source_mixing": mixing.op10,
    "op11_license_scan": licenses.op11,
    "op12_importance_resampling": importance.op12,
    "op13_centroid_clustering": centroids.op13,
}.items()}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4
      THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE 100 * c.i >= 80 * (x.n + y.n - c.i)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT l.b, r.other FROM reach r JOIN links l ON l.a = r.doc_id
), comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN comp ON comp.doc_id = w.doc_id LEFT JOIN sizes ON sizes.doc_id = w.doc_id
"""

OP7_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k,
    unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2),
                          lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) AS s
  FROM b WHERE len(w) > 0
), spots AS (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k
), hits AS (
  SELECT doc_id, i, spots.k, item_id FROM spots JOIN bw ON bw.k = spots.k AND bw.s = array_to_string(w[i:i + spots.k - 1], ' ')
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE: dict[str, str] = {
    "op3_chat_format": chat.OP3_SQL,
    "op4_setsketch_near_dedup": OP4_SQL,
    "op7_decontamination": OP7_SQL,
    "op11_license_scan": licenses.twin(),
    "op12_importance_resampling": importance.OP12_SQL,
    "op13_centroid_clustering": centroids.twin(),
}
