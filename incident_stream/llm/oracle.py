"""The same results in SQL, for the queries that SQL can express."""

# One assignment of all parts to the entries of book{r}, and the book that follows from it.
_ASSIGN = """
near{r} AS MATERIALIZED (
    SELECT p.n, p.part, min({{'d': CAST(list_sum(list_transform(list_zip(p.v, b.v),
               lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS BIGINT), 'e': b.entry}}) AS best
    FROM parts p JOIN book{r} b USING (part) GROUP BY p.n, p.part
)"""
_MOVE = """
, spread{r} AS (
    SELECT part, s.best.e AS entry, unnest(p.v) AS x, generate_subscripts(p.v, 1) AS place
    FROM near{r} s JOIN parts p USING (n, part)
), means{r} AS (
    SELECT part, entry, place, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS mean
    FROM spread{r} GROUP BY part, entry, place
), book{q} AS MATERIALIZED (
    SELECT b.part, b.entry, coalesce(m.v, b.v) AS v
    FROM book{r} b LEFT JOIN (
        SELECT part, entry, list(CAST(mean AS BIGINT) ORDER BY place) AS v FROM means{r} GROUP BY part, entry
    ) m USING (part, entry)
),"""
_ROUNDS = 4
_KMEANS = "".join(
    _ASSIGN.format(r=r) + (_MOVE.format(r=r, q=r + 1) if r < _ROUNDS else "") for r in range(_ROUNDS + 1)
)

SQL = {
    "op6_preference": """
WITH turns AS (
    SELECT conv_id, list({'turn': turn, 'role': coalesce(role, ''), 'text': coalesce(text, '')}
                         ORDER BY turn NULLS LAST, coalesce(role, ''), coalesce(text, '')) AS t
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), replies AS (
    SELECT conv_id, t, list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant')[-1] AS last
    FROM turns
), swaps AS (
    SELECT conv_id, t, last,
           coalesce(lead(t[last].text) OVER (ORDER BY conv_id), first_value(t[last].text) OVER (ORDER BY conv_id)) AS other
    FROM replies WHERE last IS NOT NULL
), pairs AS (
    SELECT conv_id AS pair_id, t AS c,
           list_transform(range(1, len(t) + 1), lambda i: {'role': t[i].role,
               'text': CASE WHEN i = last THEN other ELSE t[i].text END}) AS r
    FROM swaps
), counted AS (
    SELECT pair_id, c, r,
           coalesce(list_filter(range(1, len(c) + 1), lambda i: c[i].role <> r[i].role OR c[i].text <> r[i].text)[1] - 1,
                    len(c)) AS n
    FROM pairs
), cut AS (
    SELECT pair_id, n, c[1:n] AS p, list_transform(c[n + 1:], lambda t: {'role': t.role, 'text': t.text}) AS c, r[n + 1:] AS r
    FROM counted
), drawn AS (
    SELECT pair_id, n,
           list_transform(p, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)) AS p,
           list_transform(c, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)) AS cs,
           list_transform(r, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)) AS rs,
           c, r
    FROM cut
)
SELECT pair_id, CAST(n AS INTEGER) AS n_common,
       coalesce(array_to_string(p, ''), '') AS prompt,
       coalesce(array_to_string(cs, ''), '') AS chosen,
       coalesce(array_to_string(list_transform(
           list_filter(range(1, len(c) + 1), lambda i: c[i].role = 'assistant'),
           lambda i: CAST(coalesce(list_sum(list_transform(cs[1:i - 1], lambda s: length(s))), 0)
                          + 13 + length(c[i].role) AS BIGINT)::VARCHAR || ':'
               || CAST(coalesce(list_sum(list_transform(cs[1:i], lambda s: length(s))), 0) - 1 AS BIGINT)::VARCHAR), ','), '') AS chosen_mask,
       coalesce(array_to_string(rs, ''), '') AS rejected,
       coalesce(array_to_string(list_transform(
           list_filter(range(1, len(r) + 1), lambda i: r[i].role = 'assistant'),
           lambda i: CAST(coalesce(list_sum(list_transform(rs[1:i - 1], lambda s: length(s))), 0)
                          + 13 + length(r[i].role) AS BIGINT)::VARCHAR || ':'
               || CAST(coalesce(list_sum(list_transform(rs[1:i], lambda s: length(s))), 0) - 1 AS BIGINT)::VARCHAR), ','), '') AS rejected_mask
FROM drawn
""",
    "op11_maxscore": """
WITH kept AS (
    SELECT row_number() OVER () AS n, vec_id,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), met AS (
    SELECT q.n, q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM kept q JOIN kept c ON q.n <> c.n
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM met
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op12_aho_rank": r"""
WITH docs AS (
    SELECT row_number() OVER () AS d, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents WHERE text IS NOT NULL
), items AS (
    SELECT row_number() OVER () AS i, item_id,
           list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
    FROM benchmark WHERE text IS NOT NULL
), totals AS (
    SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs WHERE len(terms) > 0
), held AS (
    SELECT d, any_value(doc_id) AS doc_id, any_value(len(terms)) AS n, term, count(*) AS tf
    FROM (SELECT d, doc_id, terms, unnest(terms) AS term FROM docs) GROUP BY d, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM held, totals GROUP BY term
), scored AS (
    SELECT i, item_id, d, doc_id,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM (SELECT i, item_id, unnest(terms) AS term FROM items) JOIN held USING (term) JOIN weights USING (term), totals
    GROUP BY i, item_id, d, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
""",
    "op13_value_dictionaries": f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS n, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT n, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] AS v
    FROM kept, (SELECT unnest(range(4)) AS part)
), book0 AS MATERIALIZED (
    SELECT part, n - 1 AS entry, v FROM parts WHERE n <= 256
),{_KMEANS}
, coded AS (
    SELECT n, string_agg(format('{{:02x}}', best.e), '' ORDER BY part) AS code,
           CAST(sum(best.d) AS BIGINT) AS error
    FROM near{_ROUNDS} GROUP BY n
), books AS (
    SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256
    FROM book{_ROUNDS}
)
SELECT vec_id, code, error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (n), books
""",
}
