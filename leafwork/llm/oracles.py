"""DuckDB SQL for the results of the queries that SQL can express on whole tables."""

_WORDS = """w AS (SELECT doc_id, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents)"""
# r tells rows apart: repeated rows have values of their own, and count as one document.
LINE_RULES = """WITH b AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
tri AS (SELECT r, i, [w[i], w[i + 1], w[i + 2]] AS t FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM b)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS n FROM tri) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
ln AS (SELECT r, source, hash(doc_id, text) AS d, unnest(string_split(text, chr(10))) AS l FROM b),
nl AS (SELECT r, source, d, l, lower(trim(regexp_replace(l, '[\\x20\\x09-\\x0D]+', ' ', 'g'))) AS n FROM ln WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM nl GROUP BY r),
hosts AS (SELECT source, count(*) AS docs FROM documents GROUP BY source),
freq AS (SELECT f.source, f.n FROM (SELECT source, n, count(DISTINCT d) AS c FROM nl GROUP BY source, n) f JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source WHERE c > greatest(20, 0.002 * docs)),
gone AS (SELECT r, sum(len(string_split(nl.n, ' '))) AS words, count(*) AS lines FROM nl JOIN freq ON nl.n = freq.n AND nl.source IS NOT DISTINCT FROM freq.source GROUP BY r),
s AS (SELECT b.doc_id, len(b.w) AS n_words, length(list_aggregate(b.w, 'string_agg', '')) AS word_chars, length(b.text) - length(regexp_replace(b.text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(dup.n, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words, coalesce(gone.words, 0)::BIGINT AS removed_words, coalesce(gone.lines, 0) AS n_removed_lines
  FROM b LEFT JOIN dup USING (r) LEFT JOIN cov USING (r) LEFT JOIN gone USING (r))
SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, removed_words, n_removed_lines,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT n_words - removed_words < 0.5 * n_words AS kept FROM s"""
JACCARD = f"""WITH RECURSIVE {_WORDS},
v AS (SELECT doc_id, list_transform(w, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM w),
g AS (SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(w) < 3 THEN w ELSE w[i:i + 2] END, ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 1))) AS i FROM v WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS h FROM g GROUP BY doc_id),
one AS (SELECT h, min(doc_id) AS doc_id, min(n) AS n, count(*) AS copies FROM n GROUP BY h),
go AS (SELECT g.doc_id, s FROM g JOIN one USING (doc_id)),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_ FROM go a JOIN go b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN one a ON a.doc_id = x JOIN one b ON b.doc_id = y WHERE 100 * both_ >= 90 * (a.n + b.n - both_)),
r AS (SELECT x AS doc_id, y AS reach FROM e UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.reach = e.x),
c AS (SELECT doc_id, min(reach) AS low FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(coalesce(c.low, o.doc_id, d.doc_id), coalesce(o.doc_id, d.doc_id)) AS component_id, coalesce(o.copies, 1) AS n_copies
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN one o ON o.h = n.h LEFT JOIN c ON c.doc_id = o.doc_id"""
