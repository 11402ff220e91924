"""DuckDB SQL that gives the same rows as the queries it is named for."""

from .quality import RULES, STOP_WORDS


def _rules():
    parts = []
    for r in RULES:
        if r.low is not None:
            parts.append(f"{r.measure} >= {r.low!r} * {r.per}")
        if r.high is not None:
            parts.append(f"{r.measure} <= {r.high!r} * {r.per}")
    return " AND ".join(parts)


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

#: Measures of each document; {docs} is a table with doc_id and text.
QUALITY_MEASURES = rf"""
d AS (SELECT doc_id, coalesce(text, '') AS text FROM {{docs}}),
w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
pos AS (SELECT doc_id, unnest(generate_series(1, len(words) - 7)) AS i, words FROM w WHERE len(words) >= 8),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS s FROM pos),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, sum(n) AS n FROM (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS n
        FROM rep) GROUP BY doc_id),
m AS (SELECT w.doc_id, 1 AS one, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(length(regexp_replace(text, '[^!]+', '', 'g')) AS BIGINT) AS n_exclaims,
        CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(len(list_filter(words, lambda x: rtrim(lower(x), '.,;:!?') IN ({_STOP}))) AS BIGINT) AS n_stop_words,
        CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN cov USING (doc_id)),
j AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
quality AS (SELECT *, NOT base_failed AND {_rules()} AS kept FROM j)"""

QUALITY_SQL = f"""WITH {QUALITY_MEASURES.format(docs='documents')}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM quality"""

#: Per document of {docs}: words, words hit by windows of the benchmark, items found.
DECONTAM = r"""
dw AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM {docs}),
iw AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, list_filter(regexp_split_to_array(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM benchmark),
it AS (SELECT DISTINCT item, least(10, len(words)) AS size, array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS s
       FROM (SELECT item, words, unnest(generate_series(1, len(words) - least(10, len(words)) + 1)) AS i FROM iw WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM it),
dp AS (SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS s
       FROM (SELECT doc_id, size, words, unnest(generate_series(1, len(words) - size + 1)) AS i FROM dw, sizes WHERE len(words) >= size)),
hits AS (SELECT doc_id, i, size, item FROM dp JOIN it USING (size, s)),
nh AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM hits)) GROUP BY doc_id),
ni AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id),
jt AS (SELECT row_number() OVER () AS rid, words FROM iw WHERE len(words) > 0),
jp AS (SELECT rid, least(10, len(words)) AS size, j, array_to_string(words[j:j + least(10, len(words)) - 1], ' ') AS s FROM (SELECT rid, words, unnest(generate_series(1, len(words) - least(10, len(words)) + 1)) AS j FROM jt)),
diag AS (SELECT doc_id, rid, i - j AS d, size, i, i - row_number() OVER (PARTITION BY doc_id, rid, i - j ORDER BY i) AS run FROM dp JOIN jp USING (size, s)),
runs AS (SELECT doc_id, min(i) - 1 AS pos, count(*) + max(size) - 1 AS n FROM diag GROUP BY doc_id, rid, d, run),
lg AS (SELECT doc_id, max(n) AS longest, arg_min(pos, -n * 1000000000 + pos) AS longest_at FROM runs GROUP BY doc_id),
contamination AS (SELECT dw.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
        coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
        CAST(coalesce(longest, 0) AS BIGINT) AS longest, CAST(coalesce(longest_at, -1) AS BIGINT) AS longest_at
      FROM dw LEFT JOIN lg USING (doc_id) LEFT JOIN nh USING (doc_id) LEFT JOIN ni USING (doc_id))"""

DECONTAM_SQL = f"WITH {DECONTAM.format(docs='documents')}\nSELECT * FROM contamination"


def _field(c):
    return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"


def _leaf(text):
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars")) + f" || {_field(text)})"


#: Trees by recursion over levels; the last part folds every (changed) leaf up again.
MERKLE_SQL = f"""WITH RECURSIVE crc_bits AS (SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), generate_series(1, 8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t
  FROM generate_series(0, 255) s(i)),
crc_table AS (SELECT list(t ORDER BY i) AS ts FROM crc_bits),
d AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS rid, coalesce('1' || source, '0') AS tree,
        xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
            lambda c, b: xor(c >> 8, ts[(xor(c, b) & 255) + 1])), 4294967295) AS crc FROM documents, crc_table),
l AS (SELECT rid, doc_id, tree, {_leaf('text')} AS leaf, CASE WHEN crc % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS changed FROM d),
n0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM l),
up AS (SELECT 0 AS lvl, tree, idx, n, leaf AS h FROM n0
  UNION ALL SELECT lvl + 1, tree, idx // 3, (max(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY lvl, tree, idx // 3),
sub AS (SELECT tree, lvl AS top, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM up WHERE n = 1),
rup AS (SELECT 0 AS lvl, idx, n, subroot AS h FROM sub
  UNION ALL SELECT lvl + 1, idx // 3, (max(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM rup WHERE n > 1 GROUP BY lvl, idx // 3),
f AS (SELECT 0 AS lvl, rid, tree, idx, n, changed AS h, '' AS proof FROM n0
  UNION ALL SELECT f.lvl + 1, rid, f.tree, f.idx // 3, (max(f.n) + 2) // 3, sha256(string_agg(CASE WHEN u.idx = f.idx THEN f.h ELSE u.h END, '' ORDER BY u.idx)),
         max(proof) || coalesce(string_agg(u.h, '' ORDER BY u.idx) FILTER (u.idx <> f.idx), '')
       FROM f JOIN up u ON u.lvl = f.lvl AND u.tree = f.tree AND u.idx // 3 = f.idx // 3 WHERE f.n > 1 GROUP BY f.lvl, rid, f.tree, f.idx),
g AS (SELECT 0 AS lvl, rid, sub.idx, sub.n, f.h, proof FROM f JOIN sub USING (tree) WHERE f.n = 1
  UNION ALL SELECT g.lvl + 1, rid, g.idx // 3, (max(g.n) + 2) // 3, sha256(string_agg(CASE WHEN u.idx = g.idx THEN g.h ELSE u.h END, '' ORDER BY u.idx)),
         max(proof) || coalesce(string_agg(u.h, '' ORDER BY u.idx) FILTER (u.idx <> g.idx), '')
       FROM g JOIN rup u ON u.lvl = g.lvl AND u.idx // 3 = g.idx // 3 WHERE g.n > 1 GROUP BY g.lvl, rid, g.idx)
SELECT n0.doc_id, n0.leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, g.h AS folded_root, g.h = r.h AS verified
FROM n0 JOIN sub USING (tree) JOIN g USING (rid) JOIN (SELECT h FROM rup WHERE n = 1) r ON g.n = 1"""


def _share(n, total, terms):
    return f"(1 + (1000000000::HUGEINT * ({n} + 2)) // ({total} + 2 * {terms}))"


def _price(p, q):
    return f"((({p}) - ({q})) * (({p}) - ({q})) // (({p}) + ({q})))"


DIVERGENCE_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents),
w AS (SELECT rid, lang, source, unnest(words) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
v AS (SELECT lang, count(*) AS terms, sum(lang_n) AS lang_total FROM k GROUP BY lang),
g AS (SELECT lang, source FROM d GROUP BY lang, source),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
s AS (SELECT lang, source, coalesce(total, 0) AS total, coalesce(terms, 0) AS terms, coalesce(lang_total, 0) AS lang_total FROM g LEFT JOIN t USING (lang, source) LEFT JOIN v USING (lang)),
p AS (SELECT s.lang, s.source, k.term, coalesce(n, 0) AS n, {_share('coalesce(n, 0)', 'total', 'terms')} AS p, {_share('lang_n', 'lang_total', 'terms')} AS q
      FROM s JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
pv AS (SELECT a.lang, a.source, b.source AS item, sum({_price('a.p', 'b.p')}) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST({_price('p', 'q')} AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM r WHERE part = 'pair' OR rank <= 10"""
