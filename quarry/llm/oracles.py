"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

#: crc32 has no SQL function: its byte table, and one step per byte.
_CRC_TABLE = """
steps(b, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8)"""


def _crc32(octets: str) -> str:
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, {octets}), "
            "lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])))")


#: Words, matching stretches of 16 words at one lag, their longest islands, the smallest period of each.
PERIODIC_RUNS = f"""
WITH RECURSIVE {_CRC_TABLE},
given AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         {_crc32("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)")} AS h
  FROM documents, crc),
sized AS (SELECT *, len(w)::BIGINT AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM given),
docs AS (
  SELECT row_number() OVER () AS d, doc_id, n,
         CASE WHEN h % 10 = 0 AND n > 0
              THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1]
                                  ELSE w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END)
              ELSE w END AS w
  FROM sized),
grams AS (
  SELECT d, i, hash(list_slice(w, i + 1, i + 16)) AS x
  FROM (SELECT d, w, unnest(range(n - 15)) AS i FROM docs WHERE n >= 16)),
matches AS (
  SELECT g.d, g.i, g.i - e.i AS q, n
  FROM grams g JOIN grams e ON g.d = e.d AND g.x = e.x AND e.i < g.i JOIN docs ON docs.d = g.d
  WHERE 3 * (g.i - e.i) <= n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY d, q ORDER BY i) AS island FROM matches),
stretches AS (
  SELECT d, min(i) - q AS s, count(*) + 15 + q AS l, q FROM islands GROUP BY d, q, island),
runs AS (
  SELECT d, s, l, min(q) AS q FROM stretches WHERE l >= greatest(24, 3 * q) GROUP BY d, s, l),
listed AS (
  SELECT d, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS t,
         list({{'s': s, 'q': q, 'l': l}} ORDER BY l::DOUBLE / q DESC, s, q)[1] AS best
  FROM runs GROUP BY d),
dropped AS (SELECT DISTINCT d, unnest(range(s + q, s + l)) AS i FROM runs),
left_out AS (SELECT d, list(i) AS gone FROM dropped GROUP BY d),
words AS (SELECT d, unnest(w) AS word, unnest(range(n)) AS i FROM docs WHERE d IN (SELECT d FROM left_out)),
kept AS (
  SELECT words.d, string_agg(word, ' ' ORDER BY words.i) AS c
  FROM words LEFT JOIN dropped ON words.d = dropped.d AND words.i = dropped.i WHERE dropped.d IS NULL GROUP BY words.d)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.q AS period,
       1000 * best.l // best.q AS exponent_milli, sha256(coalesce(t, '')) AS runs_sha256,
       sha256(coalesce(kept.c, array_to_string(w, ' '))) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (d) LEFT JOIN kept USING (d)
"""

#: One edit apart: equal after one code point is left out at the same place (replaced), or one word
#: equals the other with a code point left out (inserted, deleted).
SPELLING_VARIANTS = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS r FROM documents),
counted AS (SELECT doc_id, r, count(*) AS k FROM runs GROUP BY doc_id, r),
hashed AS (
  SELECT *, {_crc32("flatten(list_transform(string_split(doc_id || ':' || r, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [195, ord(x)::BIGINT - 64] END))")} AS h
  FROM counted, crc),
planted AS (
  SELECT CASE WHEN doc_id IS NOT NULL AND h % 199 = 0 THEN left(r, h % length(r)) || substr(r, h % length(r) + 2)
              ELSE r END AS word, k FROM hashed),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM planted WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
cuts AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT cuts.word, words.word, words.n FROM cuts JOIN words ON cuts.rest = words.word
  UNION
  SELECT words.word, cuts.word, cuts.n FROM cuts JOIN words ON cuts.rest = words.word),
best AS (SELECT word, count(*) AS n_near, list({{'m': m, 'other': other}} ORDER BY m DESC, other)[1] AS b FROM near GROUP BY word),
forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.m >= 5 * n THEN b.other END AS form,
         CASE WHEN b.m >= 5 * n THEN b.m END AS form_n
  FROM words LEFT JOIN best ON words.word = best.word),
chain(word, root, depth) AS (
  SELECT word, word, 0 FROM forms
  UNION ALL
  SELECT chain.word, forms.form, depth + 1 FROM chain JOIN forms ON chain.root = forms.word WHERE forms.form IS NOT NULL),
roots AS (SELECT word, arg_max(root, depth) AS root FROM chain GROUP BY word)
SELECT forms.word, form, root, n, n_near, form_n FROM forms JOIN roots ON forms.word = roots.word
"""
