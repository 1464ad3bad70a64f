"""DuckDB SQL of the training-data queries that SQL can express.

The others (learned models, tokenizers) are tested against brute force, exact
round trips or held-out labels in ``tests/llm``.
"""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORDS = r"[^\x20\x09-\x0D]+"
_BENCH_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP2 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACE_WORDS}') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id AS id, doc_id AS c FROM w
  UNION
  SELECT l.b AS id, r.c FROM reach r JOIN links l ON l.a = r.id WHERE r.c < l.b
), best AS (SELECT id, min(c) AS c FROM reach GROUP BY id)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, best.c AS component_id, best.c = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN best ON best.id = w.doc_id
"""

OP3 = """
WITH v AS (
  SELECT vec_id, [floor(x::DOUBLE * 1024) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

OP4 = rf"""
WITH b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '{_BENCH_WORDS}') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_BENCH_WORDS}') AS w FROM documents
), dw AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS s
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size)
), hit AS (SELECT dw.doc_id, dw.i, dw.size, bw.item_id FROM dw JOIN bw ON dw.size = bw.size AND dw.s = bw.s),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

OP9 = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACE_WORDS}') AS w FROM documents
), win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w WHERE len(w) >= 35)
), rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY s) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM rep),
word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM w),
kept AS (
  SELECT word.doc_id, count(*) AS n, string_agg(word.word, ' ' ORDER BY word.p) AS t
  FROM word ANTI JOIN gone ON gone.doc_id = word.doc_id AND gone.p = word.p GROUP BY word.doc_id
)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

OP10 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), m AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS last FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN last > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last > page_id THEN last END AS refers_to
FROM m
"""

# A byte is two hex digits; i counts bytes from 0.
OP11 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (
  SELECT doc_id, i, hash(substr(h, 2 * i + 1, 100)) AS s, substr(h, 2 * i + 1, 100) AS t
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d WHERE len(h) >= 100)
), again AS (SELECT s FROM win GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY t) AS first FROM win JOIN again USING (s)) WHERE first < doc_id
), jump AS (
  SELECT doc_id, i, CASE WHEN i > max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 50 THEN 1 ELSE 0 END AS new
  FROM hit
), run AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM jump),
span AS (SELECT doc_id, r, min(i) AS a, max(i) + 50 AS b FROM run GROUP BY doc_id, r),
cut AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM span
), gone AS (
  SELECT cut.doc_id, count(*) AS n, sum(b - a) AS size, max(b) AS tail, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
  FROM cut JOIN d ON d.doc_id = cut.doc_id GROUP BY cut.doc_id
)
SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(size, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN gone ON gone.doc_id = d.doc_id
"""

def _rounds(rounds: int) -> str:
    """One assignment and one move of the centroids a round, then the last assignment."""
    out = []
    for r in range(rounds + 1):
        out.append(f"""a{r} AS MATERIALIZED (
  SELECT n, vec_id, v, arg_min(k, (d, k)) AS k, min(d) AS d
  FROM (SELECT n, vec_id, v.v, k, list_sum(list_transform(range(1, 65), lambda i: (v.v[i] - c.v[i]) * (v.v[i] - c.v[i])))::BIGINT AS d FROM v, c{r} c)
  GROUP BY n, vec_id, v
)""")
        if r < rounds:
            out.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v
    FROM (SELECT k, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM a{r}, range(1, 65) t(i) GROUP BY k, i) GROUP BY k
  ) m ON m.k = c.k
)""")
    return ",\n".join(out)


OP12 = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v FROM (SELECT sha256('3:' || vec_id) AS h, v FROM v WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT 8)
), {_rounds(10)}
SELECT vec_id, a10.k::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY a10.k)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c10.v, ',')) AS centroid_sha256
FROM a10 JOIN c10 ON c10.k = a10.k
"""

# crc32 of an ASCII text, bit by bit. DuckDB has no function for it.
_CRC32 = """(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len({0}) + 1), lambda i: ascii(substr({0}, i, 1))::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)))"""
_BODY = r"regexp_replace(text, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"
_NONE = "{'c': 1000000000, 'a': '', 'r': ''}"


def _step(state: str, cost: str, edit: str, line: str = "''") -> str:
    """The state's way with one more edit."""
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'r': {state}.r || {line}}}"


def _best(*ways: str) -> str:
    """The cheapest way, ties to the least audit."""
    return f"list_sort([{', '.join(ways)}])[1]"


def _kept(initial: str, before: tuple[str, ...], role: str) -> list[str]:
    """Ways that keep the row, or reroll it to ``role``."""
    keep = [f"CASE WHEN go OR initial <> '{initial}' THEN {_NONE} ELSE {_step(s, 'extra', 'K', 'line')} END" for s in before]
    return keep + [f"CASE WHEN go THEN {_NONE} ELSE {_step(s, '1 + extra', 'R', f'chr(10) || {chr(39)}{role}:{chr(39)} || text')} END" for s in before if role]


OP13 = f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS named FROM conversations
), h AS (SELECT *, xor({_CRC32.format('named')}, 4294967295) % 20 AS kind FROM k),
m AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM h, range(0, CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen, substr(role, 1, 1) AS initial, {_BODY} AS body
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM m)
), f AS MATERIALIZED (
  SELECT *, body = '' AS blank, body <> '' AND seen AS duplicate, body <> '' AND NOT seen AND NOT regexp_matches(body, '[.!?]$') AS truncated,
         body = '' OR seen AS go, CASE WHEN truncated THEN 5 ELSE 0 END AS extra, chr(10) || role || ':' || text AS line,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM o
), dp AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 'r': ''}} AS n, {_NONE} AS s, {{'c': 5, 'a': 'I', 'r': chr(10) || 'user:'}} AS u,
         {{'c': 10, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS a
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, n, s, u, {_best('a', _step('u', '5', 'I', "chr(10) || 'assistant:'"))} AS a FROM (
    SELECT conv_id, i, n, s, {_best('u', *(_step(x, '5', 'I', "chr(10) || 'user:'") for x in 'nsa'))} AS u, a FROM (
      SELECT dp.conv_id, f.i, {_step('n', '2', 'D')} AS n, {_best(_step('s', '2', 'D'), *_kept('s', ('n',), ''))} AS s,
             {_best(_step('u', '2', 'D'), *_kept('u', ('n', 's', 'a'), 'user'))} AS u, {_best(_step('a', '2', 'D'), *_kept('a', ('u',), 'assistant'))} AS a
      FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1))
), total AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id
), done AS (SELECT dp.conv_id, {_best('dp.n', 'dp.a')} AS best, total.* EXCLUDE (conv_id) FROM dp LEFT JOIN total ON total.conv_id IS NOT DISTINCT FROM dp.conv_id WHERE dp.i = coalesce(total.n, 0))
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit, sha256(substr(best.r, 2)) AS repaired_sha256
FROM done
"""

ORACLE: dict[str, str] = {
    "op13_conversation_repair": OP13,
    "op12_centroids": OP12,
    "op11_suffix_dedup": OP11,
    "op2_near_dedup": OP2,
    "op3_topk_mtree": OP3,
    "op4_decontamination": OP4,
    "op9_substring_dedup": OP9,
    "op10_warc": OP10,
}
