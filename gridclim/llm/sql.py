"""DuckDB SQL for the operators that SQL can express."""

from .licenses import NOTICES, SPELLINGS

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"list_filter(regexp_split_to_array({_LOWER}, '[^0-9a-z\\x{{80}}-\\x{{10FFFF}}]+'), lambda x: x <> '')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
g AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS gram
  FROM b, unnest(range(1, greatest(len(w) - 8, 2))) AS t(i) WHERE len(w) > 0
),
hit AS (
  SELECT doc_id, i, x.n, item
  FROM (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM d, (SELECT DISTINCT n FROM g), unnest(range(1, len(w) - n + 2)) AS t(i)
  ) AS x JOIN g ON x.gram = g.gram AND x.n = g.n
),
per AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM hit, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id
),
items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(len(items), 0) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_SPLIT = r"regexp_split_to_array(" + _LOWER + r", '[ \t\n\v\f\r]+')"

# Candidates share one of the rarest shingles of both sets: a fifth of a set and one more
# cannot miss what the other set holds at 80 percent.
NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter({_SPLIT}, lambda x: x <> '') AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
  FROM d, unnest(range(1, greatest(len(w), 2))) AS t(i) WHERE len(w) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
f AS (SELECT g, count(*) AS f FROM s GROUP BY g),
r AS (SELECT doc_id, g, row_number() OVER (PARTITION BY doc_id ORDER BY f, g) AS k FROM s JOIN f USING (g)),
p AS (SELECT doc_id, g FROM r JOIN n USING (doc_id) WHERE k <= n // 5 + 1),
c AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM p AS a JOIN p AS b ON a.g = b.g AND a.doc_id < b.doc_id),
o AS (
  SELECT a, b, count(*) AS o FROM c JOIN s AS x ON x.doc_id = c.a JOIN s AS y ON y.doc_id = c.b AND y.g = x.g
  GROUP BY a, b
),
e AS (
  SELECT a, b FROM o JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
  WHERE 100 * o >= 80 * (x.n + y.n - o)
),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT a AS doc_id, b AS other FROM u UNION SELECT reach.doc_id, u.b FROM reach JOIN u ON reach.other = u.a),
least AS (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(m, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)
"""


def _canonical(text: str) -> str:
    t = f"regexp_replace(lower(coalesce({text}, '')), '(?m)^[ \\t]*(?:copyright|©|\\(c\\))[^\\n]*$', '', 'g')"
    t = f"regexp_replace({t}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
    for old, new in SPELLINGS:
        t = f"replace({t}, '{old}', '{new}')"
    return t


_FLAT = "trim(regexp_replace(u, '[ \\n]+', ' ', 'g'))"
_KNOWN = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in row)) for row in NOTICES)

# All built-in notices are one paragraph.
LICENSES = f"""
WITH k AS (SELECT license, {_FLAT} AS flat FROM (SELECT license, {_canonical("text")} AS u FROM (VALUES {_KNOWN}) AS v(license, text))),
d AS (SELECT doc_id, {_canonical("text")} AS t FROM documents),
u AS (
  SELECT doc_id, 1 AS w, t AS u FROM d
  UNION ALL SELECT doc_id, 0, unnest(string_split(t, chr(10))) FROM d
  UNION ALL SELECT doc_id, 0, unnest(regexp_split_to_array(trim(t), '\\n[ \\n]*\\n')) FROM d
),
f AS (SELECT DISTINCT doc_id, w, license FROM (SELECT doc_id, w, {_FLAT} AS flat FROM u) AS x JOIN k USING (flat)),
g AS (SELECT doc_id, max(w) = 1 AS is_license, list_sort(list(DISTINCT license)) AS found FROM f GROUP BY doc_id)
SELECT doc_id, coalesce(is_license, false) AS is_license, coalesce(len(found), 0) AS n_licenses,
  coalesce(array_to_string(found, ','), '') AS licenses
FROM documents LEFT JOIN g USING (doc_id)
"""

LEXICAL_SEARCH = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS t FROM documents),
n AS (SELECT doc_id, len(t) AS n FROM d WHERE len(t) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
q AS (SELECT item_id, term, count(*) AS r FROM (SELECT item_id, unnest({_WORDS}) AS term FROM benchmark) AS x GROUP BY 1, 2),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) AS x GROUP BY 1, 2),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY 1) AS x, total
),
s AS (
  SELECT item_id, doc_id, CAST(sum(r * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN n USING (doc_id), total GROUP BY 1, 2
),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 20
"""


def _draw(k: int) -> str:
    return f"CAST('0x' || substr(digest, {8 * k + 1}, 8) AS BIGINT)"


FILL_IN_MIDDLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || CAST(doc_id AS VARCHAR)) AS digest FROM documents),
h AS (SELECT doc_id, t, length(t) AS n, {", ".join(f"{_draw(k)} AS h{k + 1}" for k in range(4))} FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h
),
p AS (SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1) AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
