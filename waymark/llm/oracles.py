"""DuckDB SQL for the operators that SQL can express over whole tables."""

from __future__ import annotations

SPACED = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: str) -> str:
    """A-Z lower-cased and nothing else; a missing text is empty."""
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


NGRAM_JOIN = f"""
WITH RECURSIVE worded AS (SELECT doc_id, regexp_extract_all({lowered('text')}, '{SPACED}') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM worded WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
reached AS (SELECT doc_id, doc_id AS least FROM documents UNION SELECT y, least FROM reached JOIN links ON x = doc_id),
found AS (SELECT doc_id, min(least) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d JOIN found f ON d.doc_id = f.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""

SYMBOLS = "#*$%&|<>"
# The line rules' numbers, endings and phrases, as in quality.py.
ENDINGS = "(\\.|!|\\?|:|;|…|。|！|？|؟|۔|।|॥)$"
CLOSED = " \t\n\r\x0b\x0c\"''”’»)]*"
PHRASES = (
    "all rights reserved|(?:licensed|released) under(?: the)?(?:[ -~]{0,60}licen[cs]e)?|terms of (?:use|service)|privacy policy"
    "|cookies?|lorem ipsum|javascript|subscribe|sign (?:in|up)|log ?in|click here|read more|share this|copyright"
)


def without(text: str, letters: str) -> str:
    return f"strlen(translate({text}, '{letters}', ''))"


def squeezed(text: str) -> str:
    return f"length(regexp_replace({text}, '[\\x20\\x09-\\x0D]', '', 'g'))"


QUALITY = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
words AS (SELECT r, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (SELECT r, regexp_extract_all(t, '{SPACED}') AS w FROM docs)),
windows AS (SELECT * FROM (SELECT r, i, w AS a, lead(w, 1) OVER own AS b, lead(w, 2) OVER own AS c FROM words
  WINDOW own AS (PARTITION BY r ORDER BY i)) WHERE c IS NOT NULL),
twice AS (SELECT r, a, b, c FROM windows GROUP BY ALL HAVING count(*) > 1),
repeats AS (SELECT r, count(DISTINCT i + k) AS n FROM (SELECT r, i FROM windows JOIN twice USING (r, a, b, c)),
  (SELECT unnest(range(3)) AS k) GROUP BY r),
lines AS (SELECT r, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM (SELECT r, string_split(t, chr(10)) AS l FROM docs)),
measured AS (SELECT *, len(regexp_extract_all(line, '{SPACED}')) AS n, row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 AS again,
  strlen(line) AS size, strlen(line) - {without('line', SYMBOLS)} AS symbols, strlen(line) - {without('line', '|')} AS bars,
  (strlen(line) - strlen(replace(line, '!!', ''))) // 2 AS shouts, strlen(line) - {without('line', UPPER)} AS upper,
  strlen(line) - {without('line', UPPER + LOWER)} AS letters, CASE WHEN n > 0 THEN length(line) ELSE 0 END AS width,
  length(regexp_extract(line, '{SPACED}')) AS first, n > 0 AND regexp_matches(rtrim(line, '{CLOSED}'), '{ENDINGS}') AS ended FROM lines),
flowing AS (SELECT *, n > 0 AND NOT ended AND coalesce(lead(n) OVER own > 0, false)
  AND width + 1 + lead(first) OVER own > greatest(coalesce(lag(width) OVER own, 0), lead(width) OVER own) AS goes_on
  FROM measured WINDOW own AS (PARTITION BY r ORDER BY i)),
flowed AS (SELECT *, first_value(CASE WHEN NOT goes_on THEN ended END IGNORE NULLS) OVER (PARTITION BY r ORDER BY i
  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ends FROM flowing),
shortened AS (SELECT *, n BETWEEN 1 AND 4 AND NOT ends AS short FROM flowed),
runs AS (SELECT *, i - row_number() OVER (PARTITION BY r, short ORDER BY i) AS run FROM shortened),
menus AS (SELECT *, short AND count(*) OVER (PARTITION BY r, short, run) >= 4 AS menu FROM runs),
judged AS (SELECT *, again OR 100 * symbols > 8 * size OR (bars >= 2 AND 100 * bars >= 15 * n) OR 100 * shouts >= 50 * n
  OR (upper >= 20 AND 100 * upper > 60 * letters)
  OR (n >= 8 AND NOT ends) OR menu
  OR (n <= 15 AND 100 * (size - strlen(regexp_replace(line, '(?i)({PHRASES})', '', 'g'))) >= 40 * size) AS failed FROM menus WHERE n > 0),
by_line AS (SELECT r, count(*) FILTER (WHERE again) AS dups, count(*) FILTER (WHERE failed) AS failures,
  coalesce(sum({squeezed('line')}) FILTER (WHERE NOT failed), 0) AS kept FROM judged GROUP BY r),
counted AS (SELECT doc_id, len(string_split(t, chr(10))) AS n_lines, coalesce(failures, 0) AS n_failed_lines,
  len(regexp_extract_all(t, '{SPACED}')) AS n_words, {squeezed('t')} AS word_chars, strlen(t) - {without('t', SYMBOLS)} AS n_symbols,
  coalesce(dups, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, coalesce(kept, 0) AS kept_chars
  FROM docs LEFT JOIN by_line USING (r) LEFT JOIN repeats USING (r)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, CAST(n_lines AS INTEGER) AS n_lines, CAST(n_failed_lines AS INTEGER) AS n_failed_lines, CAST(n_words AS BIGINT) AS n_words,
  CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(kept_chars AS BIGINT) AS kept_chars, base_failed,
  NOT base_failed AND 100 * (word_chars - kept_chars) <= 50 * word_chars AS kept FROM based"""

PLAIN = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({lowered('text')}, '{PLAIN}') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all({lowered('text')}, '{PLAIN}') AS w FROM benchmark),
parts AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i:i + 12], ' ') AS words FROM parts),
places AS (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size),
found AS (SELECT r, i, p.size, item_id FROM places p JOIN windows v ON p.size = v.size AND array_to_string(w[i:i + p.size - 1], ' ') = v.words),
hits AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + size)) AS place FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(m.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits h USING (r) LEFT JOIN named m USING (r)"""


def field_text(column: str) -> str:
    """A field as the leaves have it: `-`, or its UTF-8 length, a colon and its text."""
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"


def leaf_sql(n_chars: str) -> str:
    return f"sha256({' || '.join(field_text(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


# Fixed value: the reversed polynomial of CRC-32. One step per bit, eight per digit of the id.
CRC32_SQL = """(SELECT xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
  list_transform(range(8 * strlen(id)), lambda i : CASE WHEN i % 8 = 0 THEN ascii(id[i // 8 + 1]) ELSE 0 END)),
  lambda crc, byte : CASE WHEN xor(crc, byte) % 2 = 1 THEN xor(xor(crc, byte) // 2, 3988292384) ELSE xor(crc, byte) // 2 END)))"""


def tree_sql(name: str, leaves: str, group: str) -> dict[str, str]:
    """All nodes of the trees over `leaves` (group, i, digest), level by level, and the number of nodes of each level."""
    return {
        name: f"""SELECT {group}, 0 AS level, i, digest, count(*) OVER (PARTITION BY {group}) AS n FROM {leaves}
UNION ALL SELECT {group}, level + 1, i // 2, sha256(string_agg(digest, '' ORDER BY i)), (max(n) + 1) // 2 FROM {name} WHERE n > 1 GROUP BY {group}, level, i // 2""",
    }


_STEPS = {
    "docs": "SELECT *, row_number() OVER () AS r, CAST(doc_id AS VARCHAR) AS id, coalesce('=' || lang, '-') AS g FROM documents",
    "leaves": f"""SELECT r, doc_id, g, {leaf_sql('n_chars')} AS digest,
CASE WHEN {CRC32_SQL} % 7 = 0 THEN {leaf_sql('n_chars + 1')} ELSE {leaf_sql('n_chars')} END AS changed FROM docs""",
    "ranked": "SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, digest, r) - 1 AS i FROM leaves",
    **tree_sql("nodes", "ranked", "g"),
    "subroots": "SELECT g, digest AS subroot, 0 AS tree, row_number() OVER (ORDER BY g) - 1 AS i, digest FROM nodes WHERE n = 1",
    **tree_sql("top", "subroots", "tree"),
    # Below the root, every node's place and the other node of its run, if there is one.
    "beside": """SELECT a.g, a.level, a.i, b.digest AS other FROM nodes a LEFT JOIN nodes b ON a.g = b.g AND a.level = b.level AND b.i = xor(a.i, 1) WHERE a.n > 1
UNION ALL SELECT s.g, 1000 + a.level, a.i, b.digest FROM top a LEFT JOIN top b ON a.level = b.level AND b.i = xor(a.i, 1)
  JOIN subroots s ON s.i >> a.level = a.i WHERE a.n > 1""",
    "high": "SELECT g, max(level) + 1 AS depth FROM nodes GROUP BY g",
    "steps": """SELECT l.r, row_number() OVER (PARTITION BY l.r ORDER BY b.level) AS step, b.other, b.i FROM ranked l JOIN subroots s USING (g)
JOIN beside b ON b.g = l.g AND b.i = CASE WHEN b.level < 1000 THEN l.i >> b.level ELSE s.i >> (b.level - 1000) END""",
    "proofs": "SELECT r, sha256(string_agg(coalesce(other, ''), '' ORDER BY step)) AS proof FROM steps GROUP BY r",
    "folding": """SELECT r, 0 AS step, changed AS digest FROM ranked
UNION ALL SELECT f.r, f.step + 1, sha256(CASE WHEN s.other IS NULL THEN f.digest WHEN s.i % 2 = 0 THEN f.digest || s.other ELSE s.other || f.digest END)
FROM folding f JOIN steps s ON s.r = f.r AND s.step = f.step + 1""",
    "folded": "SELECT r, arg_max(digest, step) AS folded_root FROM folding GROUP BY r",
}
MANIFEST = "WITH RECURSIVE " + ",\n".join(f"{name} AS ({sql})" for name, sql in _STEPS.items()) + """
SELECT doc_id, l.digest AS leaf, s.subroot, t.digest AS root, coalesce(p.proof, sha256('')) AS proof_sha256, f.folded_root, f.folded_root = t.digest AS verified
FROM ranked l JOIN subroots s USING (g) JOIN folded f USING (r) LEFT JOIN proofs p USING (r), (SELECT digest FROM top WHERE n = 1) t"""
