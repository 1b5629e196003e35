"""SQL twins of the corpus queries that SQL can express."""

from __future__ import annotations

import string

from strataload.llm import sharding

LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 20
"""

EXACT = f"""
WITH t AS (SELECT doc_id, {LOWER} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""


def _network(x: str, seed: int, names: str) -> str:
    """The permutation's rounds as nested subqueries over ``names``; n, a and b are columns."""
    mixed = lambda v, key: (
        f"list_reduce([({v} % {sharding.PRIME} * {key[0]} + {key[1]}) % {sharding.PRIME}, {v}, {key[1]}], "
        f"lambda s, w: (s * s + w) % {sharding.PRIME})"
    )
    sql = f"SELECT *, {x} // b AS l, {x} % b AS r FROM {names}"
    for k, key in enumerate(sharding.round_keys(seed)):
        sql = (
            f"SELECT * REPLACE ((l + {mixed('r', key)}) % a AS l) FROM ({sql})" if k % 2 == 0
            else f"SELECT * REPLACE ((r + {mixed('l', key)}) % b AS r) FROM ({sql})"
        )
    return f"SELECT * EXCLUDE (l, r) REPLACE (l * b + r AS x) FROM ({sql})"


def sharded(shards: int = 24, seed: int = 20240229) -> str:
    # CRC-32 of the UTF-8 bytes, by its table of remainders.
    table = "[list_reduce([i::BIGINT] || range(8), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) FOR i IN range(256)]"
    return f"""
WITH RECURSIVE remainders AS (SELECT {table} AS t),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
bytes AS (
  SELECT doc_id, strlen(text) + 8 AS size, CASE WHEN text = '' THEN 0 ELSE xor(list_reduce(
    [4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT),
    lambda c, w: xor(c >> 8, t[(xor(c, w) & 255) + 1])), 4294967295) END AS text_crc32
  FROM d, remainders
),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS x, count(*) OVER () AS n FROM bytes
),
sides AS (SELECT *, ceil(sqrt(n))::BIGINT AS a, (n + ceil(sqrt(n))::BIGINT - 1) // ceil(sqrt(n))::BIGINT AS b FROM numbered),
walk AS (
  {_network('x', seed, 'sides')}
  UNION ALL
  {_network('x', seed, '(SELECT * FROM walk WHERE x >= n)')}
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (x % {shards})::INTEGER AS shard, x // {shards} AS slot, NULL::INTEGER AS grown_shard
FROM walk WHERE x < n
"""


NEAR = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [words]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: words[i : i + 4])) END AS shingles FROM w
),
e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
reach AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, len(shingles) AS n_shingles, min(b) AS component_id, doc_id = min(b) AS kept
FROM s JOIN reach r ON r.a = s.doc_id GROUP BY doc_id, shingles
"""

LINES = """
WITH l AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), w AS (
  SELECT doc_id, pos, line, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS next_line FROM l
), first AS (
  SELECT *, row_number() OVER (PARTITION BY line, next_line ORDER BY doc_id, pos) AS nth FROM w WHERE next_line IS NOT NULL
), alone AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS nth
  FROM l WHERE len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= 8
), gone AS (
  SELECT doc_id, pos FROM first WHERE nth > 1 UNION SELECT doc_id, pos + 1 FROM first WHERE nth > 1
  UNION SELECT doc_id, pos FROM alone WHERE nth > 1
)
SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_deleted,
       coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS text
FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id
"""

AUDIT = """
WITH RECURSIVE words AS (
  SELECT *, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), fails AS (
  SELECT doc_id, coalesce(lang, '') AS part,
    (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS f
  FROM words
), marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), d AS (
  SELECT part, f, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM fails LEFT JOIN marks USING (doc_id) GROUP BY part, f
), orders AS (
  SELECT '' AS o UNION ALL SELECT o || c FROM orders, unnest(string_split('ABCDE', '')) AS x(c) WHERE NOT contains(o, c) AND len(o) < 5
), removal AS (
  SELECT part, f, n, good, toxic, o, s.step, substr(o, s.step, 1) AS letter,
    list_min(list_transform(string_split(f, ''), lambda c: CASE WHEN c = '' THEN 6 ELSE strpos(o, c) END)) AS first_fail
  FROM d, orders, range(1, 6) AS s(step) WHERE len(o) = 5
), counts AS (
  SELECT part, o AS filter_order, step, letter, sum(CASE WHEN first_fail > step THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN first_fail = step THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN first_fail < step AND contains(f, letter) THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN f = letter THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN first_fail = step THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN first_fail = step THEN toxic ELSE 0 END) AS toxic_lost
  FROM removal GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counts
"""


def codes(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """Rounds unrolled: a codebook after each, and the assignments that lead to it."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
cut AS MATERIALIZED (
  SELECT id, vec_id, label, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS v FROM kept, range({parts}) AS r(p)
),
book0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM cut QUALIFY e < {entries})"""]
    for k in range(rounds + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (
  SELECT id, c.p, min((list_sum(list_transform(list_zip(c.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, e)) AS best
  FROM cut c JOIN book{k} b USING (p) GROUP BY id, c.p
)""")
        if k < rounds:
            steps.append(f"""
sums{k} AS (
  SELECT p, best[2] AS e, i, floor(sum(v[i]) / count(*))::BIGINT AS x
  FROM near{k} JOIN cut USING (id, p), unnest(range(1, len(v) + 1)) AS u(i) GROUP BY p, best[2], i
),
book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(any_value(m.v), any_value(b.v)) AS v
  FROM book{k} b LEFT JOIN (SELECT p, e, list(x ORDER BY i) AS v FROM sums{k} GROUP BY p, e) m USING (p, e) GROUP BY p, e
)""")
    return f"""
WITH {",".join(steps)},
coded AS (
  SELECT id, string_agg(lower(printf('%02x', best[2])), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error FROM near{rounds} GROUP BY id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_topk": TOPK, "op4_near_dedup": NEAR, "op6_line_dedup": LINES, "op8_exact_dedup": EXACT, "op10_sharding": sharded(),
            "op11_audit": AUDIT, "op13_codes": codes()}
