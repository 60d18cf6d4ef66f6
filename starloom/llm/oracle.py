"""DuckDB SQL for the operators of this package that SQL can express."""

from __future__ import annotations

#: Unsigned crc32 (the usual reflected polynomial) of the decimal text of ``{0}``.
_CRC32 = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({0}::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
  lambda r, b: list_reduce([xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))),
  4294967295)"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _field(expression: str) -> str:
    return f"coalesce(strlen({expression})::VARCHAR || ':' || {expression}, '-')"


def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return f"sha256({' || '.join(map(_field, fields))})"


MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf,
         CASE WHEN {_CRC32.format('doc_id')} % 5 = 0
              THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
low AS (
  SELECT 0 AS level, source, pos, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM placed
  UNION ALL
  SELECT level, source, pos, digest, count(*) OVER (PARTITION BY source) AS n FROM (
    SELECT level + 1 AS level, source, pos // 16 AS pos, sha256(string_agg(digest, '' ORDER BY pos)) AS digest
    FROM low WHERE n > 1 GROUP BY ALL)),
subroots AS (SELECT source, level AS height, digest AS subroot FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, subroot AS digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level, pos, digest, count(*) OVER () AS n FROM (
    SELECT level + 1 AS level, pos // 16 AS pos, sha256(string_agg(digest, '' ORDER BY pos)) AS digest
    FROM high WHERE n > 1 GROUP BY ALL)),
low_steps AS (
  SELECT a.source, a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
  FROM low a JOIN low b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.pos // 16 = b.pos // 16
  WHERE a.n > 1 GROUP BY ALL),
high_steps AS (
  SELECT a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
  FROM high a JOIN high b ON a.level = b.level AND a.pos // 16 = b.pos // 16
  WHERE a.n > 1 GROUP BY ALL),
root AS (SELECT digest AS root, level AS top FROM high WHERE n = 1),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM subroots),
walk AS (
  SELECT row_number() OVER () AS id, p.doc_id, p.leaf, r.subroot, r.height, r.place, p.source, p.pos, 0 AS level,
         coalesce(p.tampered, p.leaf) AS folded, '' AS proof
  FROM placed p JOIN ranked r ON p.source IS NOT DISTINCT FROM r.source
  UNION ALL
  SELECT w.id, w.doc_id, w.leaf, w.subroot, w.height, w.place, w.source, w.pos, w.level + 1,
         sha256(coalesce(s.before, h.before) || w.folded || coalesce(s.after, h.after)),
         w.proof || coalesce(s.before, h.before) || coalesce(s.after, h.after)
  FROM walk w CROSS JOIN root
  LEFT JOIN low_steps s ON w.level < w.height AND s.source IS NOT DISTINCT FROM w.source AND s.level = w.level AND s.pos = w.pos >> (4 * w.level)
  LEFT JOIN high_steps h ON w.level >= w.height AND h.level = w.level - w.height AND h.pos = w.place >> (4 * greatest(w.level - w.height, 0))
  WHERE w.level < w.height + root.top)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM walk CROSS JOIN root WHERE level = height + top
"""

SUBSTRINGS = f"""
WITH worded AS (SELECT row_number() OVER () AS id, doc_id, {_WORDS} AS words FROM documents),
windows AS (
  SELECT id, doc_id, p, md5(array_to_string(words[p:p + 49], ' ')) AS w
  FROM (SELECT id, doc_id, words, unnest(range(1, len(words) - 48)) AS p FROM worded WHERE len(words) >= 50)),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
gone AS (
  SELECT DISTINCT id, unnest(range(p, p + 50)) AS k FROM windows JOIN firsts USING (w) WHERE first < doc_id),
kept AS (
  SELECT id, string_agg(word, ' ' ORDER BY k) AS text FROM (SELECT id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS k FROM worded)
  ANTI JOIN gone USING (id, k) GROUP BY id),
lost AS (SELECT id, count(*) AS n FROM gone GROUP BY id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (id) LEFT JOIN lost USING (id)
"""

JACCARD = r"""
WITH RECURSIVE worded AS (
  SELECT row_number() OVER () AS id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
placed AS (SELECT id, unnest(words) AS word, unnest(range(len(words))) AS k FROM worded),
grams AS (
  SELECT id, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS shingle
  FROM placed WINDOW o AS (PARTITION BY id ORDER BY k)),
shingles AS (
  SELECT DISTINCT id, shingle FROM grams WHERE shingle IS NOT NULL
  UNION ALL SELECT id, array_to_string(words, ' ') FROM worded WHERE len(words) BETWEEN 1 AND 4),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
sets AS (SELECT id, doc_id, coalesce(n, 0) AS n FROM worded LEFT JOIN sizes USING (id)),
numbered AS (SELECT shingle, row_number() OVER () AS nr FROM shingles GROUP BY shingle HAVING count(*) > 1),
held AS (SELECT id, nr FROM shingles JOIN numbered USING (shingle)),
pairs AS (SELECT x.id AS x, y.id AS y, count(*) AS shared FROM held x JOIN held y ON x.nr = y.nr AND x.id < y.id GROUP BY x.id, y.id),
found AS (
  SELECT i.doc_id AS a, j.doc_id AS b FROM pairs JOIN sets i ON i.id = x JOIN sets j ON j.id = y
  WHERE i.doc_id IS NOT NULL AND j.doc_id IS NOT NULL AND 100 * shared >= 75 * (i.n + j.n - shared)),
links AS (SELECT a, b FROM found UNION SELECT b, a FROM found),
reach AS (
  SELECT doc_id AS node, doc_id AS other FROM sets
  UNION
  SELECT node, b FROM reach JOIN links ON other = a),
least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT doc_id, n::BIGINT AS n_shingles, component_id FROM sets LEFT JOIN least ON doc_id = node
"""

COLLISIONS = """
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS id, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
sound AS (
  SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM vectors
  WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.id AS a, b.id AS b, b.vec_id FROM sound a JOIN sound b ON a.label = b.label AND a.id <> b.id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.93),
reach AS (
  SELECT id AS node, id AS other, vec_id FROM vectors
  UNION
  SELECT node, b, links.vec_id FROM reach JOIN links ON other = a),
least AS (SELECT node, min(vec_id) AS component_id FROM reach GROUP BY node),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN least ON id = node LEFT JOIN counted ON id = a
"""

PERIODS = f"""
WITH worded AS (SELECT row_number() OVER () AS id, doc_id, {_CRC32.format('doc_id')} AS h, {_WORDS} AS words FROM documents),
sized AS (SELECT *, h // 10 AS g, len(words) AS n FROM worded),
planted AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a,
         CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - g % n) // (3 + g % 8) ELSE 1 END AS p FROM sized),
places AS (SELECT id, n, a, p, words, unnest(range(n)) AS k FROM planted),
w AS (SELECT id, n, k, words[1 + CASE WHEN k < a THEN k ELSE a + (k - a) % p END] AS word FROM places),
equal AS (
  SELECT x.id, y.k - x.k AS q, x.k FROM w x JOIN w y ON x.id = y.id AND x.word = y.word AND y.k > x.k AND 4 * (y.k - x.k) <= x.n),
islands AS (SELECT id, q, k, k - row_number() OVER (PARTITION BY id, q ORDER BY k) AS island FROM equal),
stretches AS (SELECT id, q, min(k) AS start, count(*) + q AS length FROM islands GROUP BY id, q, island),
runs AS (SELECT id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY id, start, length),
gone AS (SELECT DISTINCT id, unnest(range(start + period, start + length)) AS k FROM runs),
kept AS (SELECT id, string_agg(word, ' ' ORDER BY k) AS text FROM w ANTI JOIN gone USING (id, k) GROUP BY id),
listed AS (
  SELECT id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
         first(struct_pack(start := start, length := length, period := period) ORDER BY length / period DESC, start, period) AS best
  FROM runs GROUP BY id)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length, best.period::BIGINT AS period,
       (1000 * best.length // best.period)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM planted LEFT JOIN kept USING (id) LEFT JOIN listed USING (id)
"""
