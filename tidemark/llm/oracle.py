"""DuckDB SQL of the operators that SQL can express, written independently of the Spark plans."""

from __future__ import annotations

import string

from tidemark.llm.quality import (COMMON_WORDS, MAX_CHAR_DISTANCE, MAX_REPEATED_PERCENT, MAX_WORD_DISTANCE,
                                  MIN_CHARS_COMPARED, MIN_WORDS, MIN_WORDS_COMPARED)

LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


_ITEM_WORDS = f"regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT DISTINCT item_id, {_ITEM_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
p AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
      FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
            FROM (SELECT *, least(13, len(w)) AS n FROM b WHERE len(w) > 0))),
o AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
            FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n)),
h AS (SELECT doc_id, i, n, item_id FROM o JOIN p USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM h) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)"""

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words(LOWER)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 90 * (p.n + q.n - k)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.a, r.c FROM r JOIN l ON l.b = r.doc_id)
SELECT r.doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id
FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id"""


def _distance(p: str, q: str) -> str:
    def part(a, b):
        return f"CASE WHEN {a} > 0 THEN {a} * log2({a} / (({a} + {b}) / 2)) ELSE 0 END"

    pairs = f"list_transform(range(1, len({p}) + 1), lambda i: {part(f'{p}[i]', f'{q}[i]')} + {part(f'{q}[i]', f'{p}[i]')})"
    return f"sqrt(greatest(0, list_sum({pairs}) / 2))"


def _quality() -> str:
    classes = ["[a-z]", "[A-Z]", "[0-9]", "[#*$%&|<>]", r"[\x00-\x7F]", "."]
    left, sizes = "solid", []
    for c in classes[:-1]:
        rest = f"regexp_replace({left}, '{c}', '', 'g')"
        sizes.append(f"length({left}) - length({rest})")
        left = rest
    sizes.append(f"length({left})")
    common = " ".join(f"WHEN lang = '{lang}' THEN [{', '.join(f'{chr(39)}{w}{chr(39)}' for w in words)}]"
                      for lang, words in COMMON_WORDS.items())
    widest = max(map(len, COMMON_WORDS.values())) + 1
    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, {_words("coalesce(text, '')")} AS w FROM documents),
m AS (SELECT *, len(w) AS n, array_to_string(w, '') AS solid, CASE {common} ELSE [] END AS own FROM d),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (SELECT doc_id, count(DISTINCT pos) AS n_rep FROM (
          SELECT doc_id, unnest(range(i, i + 3)) AS pos
          FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS k FROM win) WHERE k > 1) GROUP BY 1),
lines AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n_dup FROM (
            SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d)
          WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY 1),
f AS (SELECT m.doc_id, lang, n, length(solid) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n_dup, 0) AS n_dup, coalesce(n_rep, 0) AS n_rep,
        CASE WHEN length(solid) >= {MIN_CHARS_COMPARED} THEN
          list_transform([{', '.join(sizes)}], lambda x: x / length(solid)) END AS c,
        CASE WHEN n >= {MIN_WORDS_COMPARED} THEN list_transform(list_append(
          list_transform(own, lambda o: len(list_filter(w, lambda x: x = o))),
          n - coalesce(list_sum(list_transform(own, lambda o: len(list_filter(w, lambda x: x = o)))), 0)),
          lambda x: x / n) END AS h
      FROM m LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id)),
ref AS (SELECT coalesce(lang, '') AS lang, [{', '.join(f'avg(c[{i}])' for i in range(1, 7))}] AS rc,
          [{', '.join(f'avg(h[{i}])' for i in range(1, widest + 1))}] AS rh FROM f GROUP BY 1),
j AS (SELECT f.*, CASE WHEN c IS NOT NULL THEN {_distance('c', 'rc')} END AS dc,
        CASE WHEN len(h) > 1 THEN {_distance('h', 'rh')} END AS dh,
        n < {MIN_WORDS} OR 100 * n_rep > {MAX_REPEATED_PERCENT} * n AS base_failed
      FROM f LEFT JOIN ref ON ref.lang = coalesce(f.lang, ''))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup AS BIGINT) AS n_dup_lines, CAST(n_rep AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND coalesce(dc, 0) <= {MAX_CHAR_DISTANCE} AND coalesce(dh, 0) <= {MAX_WORD_DISTANCE} AS kept
FROM j"""


QUALITY = _quality()


def _coded(value: str, text: str | None = None) -> str:
    text = text or f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


#: crc32 of the decimal doc_id: table and update by the rule of the reversed polynomial 0xEDB88320.
CRC_TABLE = """SELECT list(list_reduce(list_prepend(i, range(8)),
            lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)"""
CRC_OF_ID = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
            lambda ch: ascii(ch)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_HEAD = " || ".join(_coded(c) for c in ("doc_id", "source", "lang", "n_chars"))

MERKLE = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
leaves AS (
    SELECT doc_id, source, {_coded("source")} AS grp, sha256({_HEAD} || {_coded("text", "text")}) AS digest,
           CASE WHEN {CRC_OF_ID} % 5 = 0 THEN sha256({_HEAD} || {_coded("text", _LOWERED)}) END AS changed
    FROM documents, crc),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
           count(*) OVER (PARTITION BY grp) AS n FROM leaves),
nodes AS (
    SELECT grp, 0 AS lvl, pos, n, digest FROM placed
    UNION ALL
    SELECT grp, lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
    FROM nodes WHERE n > 1 GROUP BY grp, lvl, n, pos // 16),
sources AS (SELECT grp, any_value(source) AS source FROM placed GROUP BY grp),
tops AS (
    SELECT grp, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
    FROM nodes JOIN sources USING (grp) WHERE n = 1),
upper AS (
    SELECT 0 AS lvl, pos, n, digest FROM tops
    UNION ALL
    SELECT lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
    FROM upper WHERE n > 1 GROUP BY lvl, n, pos // 16),
walk AS (
    SELECT grp, pos AS leaf_pos, 0 AS lvl, pos, n, coalesce(changed, digest) AS folded, '' AS proof FROM placed
    UNION ALL
    SELECT w.grp, w.leaf_pos, w.lvl + 1, w.pos // 16, (w.n + 15) // 16,
           sha256(string_agg(CASE WHEN c.pos = w.pos THEN w.folded ELSE c.digest END, '' ORDER BY c.pos)),
           w.proof || coalesce(string_agg(c.digest, '' ORDER BY c.pos) FILTER (WHERE c.pos <> w.pos), '')
    FROM walk w JOIN nodes c ON c.grp = w.grp AND c.lvl = w.lvl AND c.pos // 16 = w.pos // 16
    WHERE w.n > 1 GROUP BY w.grp, w.leaf_pos, w.lvl, w.pos, w.n, w.folded, w.proof),
rise AS (
    SELECT w.grp, leaf_pos, t.digest AS subroot, 0 AS lvl, t.pos, t.n, folded, proof
    FROM walk w JOIN tops t USING (grp) WHERE w.n = 1
    UNION ALL
    SELECT w.grp, w.leaf_pos, w.subroot, w.lvl + 1, w.pos // 16, (w.n + 15) // 16,
           sha256(string_agg(CASE WHEN c.pos = w.pos THEN w.folded ELSE c.digest END, '' ORDER BY c.pos)),
           w.proof || coalesce(string_agg(c.digest, '' ORDER BY c.pos) FILTER (WHERE c.pos <> w.pos), '')
    FROM rise w JOIN upper c ON c.lvl = w.lvl AND c.pos // 16 = w.pos // 16
    WHERE w.n > 1 GROUP BY w.grp, w.leaf_pos, w.subroot, w.lvl, w.pos, w.n, w.folded, w.proof)
SELECT p.doc_id, p.digest AS leaf, r.subroot, u.digest AS root, sha256(r.proof) AS proof_sha256,
       r.folded AS folded_root, r.folded = u.digest AS verified
FROM placed p JOIN rise r ON r.grp = p.grp AND r.leaf_pos = p.pos AND r.n = 1 JOIN upper u ON u.n = 1"""
