"""DuckDB SQL for the operators that SQL can express by comparing all pairs (on ids without repeats)."""

from __future__ import annotations


def near_vectors_sql(threshold: float = 0.98) -> str:
    return f"""
    WITH RECURSIVE v AS (
      SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
      WHERE label IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding)
        AND list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0
        AND isfinite(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]))),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
              ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
              WHERE list_cosine_similarity(a.e, b.e) >= {threshold}),
    reach AS (SELECT vec_id AS a, vec_id AS c FROM embeddings
              UNION SELECT l.b, r.c FROM reach r JOIN links l ON r.a = l.a),
    comp AS (SELECT a AS vec_id, min(c) AS component_id FROM reach GROUP BY a),
    degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
    SELECT c.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.component_id, c.vec_id = c.component_id AS kept,
           CAST(1.0 AS DOUBLE) AS recall
    FROM comp c LEFT JOIN degree d USING (vec_id)
    """


def ngram_classes_sql(words: int = 5, threshold: float = 0.8) -> str:
    following = ", ".join(f"lead(word, {i}) OVER w" for i in range(1, words))
    return f"""
    WITH RECURSIVE lists AS (SELECT doc_id, string_split_regex(text, '[ \\n\\t\\r]+') AS ws FROM documents WHERE text <> ''),
    flat AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM lists),
    word AS (SELECT * FROM flat WHERE word <> ''),
    size AS (SELECT doc_id, count(*) AS n_words FROM word GROUP BY doc_id),
    runs AS (SELECT doc_id, concat_ws(' ', word, {following}) AS g, lead(word, {words - 1}) OVER w AS last
             FROM word WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
    s AS (SELECT DISTINCT doc_id, g FROM runs WHERE last IS NOT NULL
          UNION ALL SELECT doc_id, string_agg(word, ' ' ORDER BY pos) FROM word JOIN size USING (doc_id)
          WHERE n_words < {words} GROUP BY doc_id),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b
               ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
              WHERE c >= {threshold} * (x.n + y.n - c) - 1e-9
              UNION SELECT p.doc_id, q.doc_id FROM documents p JOIN documents q
              ON p.text = q.text AND p.doc_id <> q.doc_id WHERE p.text <> ''),
    reach AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM reach r JOIN links l ON r.a = l.a),
    comp AS (SELECT a AS doc_id, min(c) AS class_id FROM reach GROUP BY a),
    degree AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
    SELECT c.doc_id, c.class_id, coalesce(d.n_links, 0)::BIGINT AS n_links, c.doc_id = c.class_id AS kept
    FROM comp c LEFT JOIN degree d USING (doc_id)
    """
