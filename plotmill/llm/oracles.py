"""SQL that gives the same rows as some queries of this package."""

_WS = r"[\s\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

_P3 = rf"""WITH s AS (SELECT record_id, prompt['story'] AS t FROM prompts WHERE length(prompt['story']) > 2400),
  l AS (SELECT record_id, t, string_split_regex(t, '{_WS}*[\r\n\x{{2028}}\x{{2029}}]{_WS}*') AS lines FROM s),
  n AS (SELECT record_id, t, lines, flatten(list_transform(lines, lambda x: string_split_regex(regexp_replace(x, '([.!?…]["''”’»«)\]}}]*){_WS}+', '\1' || chr(10), 'g'), chr(10)))) AS sentences FROM l),
  m AS (SELECT record_id, list_max(list_transform(lines, lambda x: length(x))) AS a, list_max(list_transform(sentences, lambda x: length(x))) AS b,
    list_max(list_transform(string_split_regex(t, '{_WS}+'), lambda x: length(x))) AS c FROM n)
  SELECT record_id, CASE WHEN a <= 2400 THEN 'paragraph' WHEN b <= 2400 THEN 'sentence' WHEN c <= 2400 THEN 'word' ELSE 'character' END AS boundary FROM m"""

_TERMS = r"""WITH f AS (SELECT record_id, field, prompt[field] AS v FROM prompts, (VALUES ('genre'), ('tone'), ('writing style')) AS x(field) WHERE prompt[field] IS NOT NULL),
  t AS (SELECT record_id, field, list_filter(list_transform(string_split_regex(lower(v), ',|\band\b'),
      lambda x: regexp_replace(regexp_replace(regexp_replace(x, '\s+', ' ', 'g'), '^ ', ''), '[ .]+$', '')), lambda x: x <> '') AS terms FROM f),
  h AS (SELECT * FROM t WHERE len(terms) > 0),
  d AS (SELECT field, count(*) AS field_records FROM h GROUP BY field),
  e AS (SELECT record_id, field, unnest(terms) AS term FROM h),
  c AS (SELECT field, term, count(*) AS occurrences, count(DISTINCT record_id) AS records FROM e GROUP BY field, term),
  r AS (SELECT field, term, occurrences, records, field_records, CASE WHEN records < 3 THEN 'rare' WHEN records > 0.1 * field_records THEN 'common' END AS mark FROM c JOIN d USING (field))"""

_P7 = r"""WITH RECURSIVE a AS (SELECT author_id, regexp_extract(replace(strip_accents(lower(name)), 'ø', 'o'), '([\p{L}]+)$', 1) AS w FROM authors),
  n AS (SELECT record_id, unnest(list_distinct(regexp_extract_all(replace(strip_accents(lower(prompt['author'])), 'ø', 'o'), '[\p{L}]+'))) AS w FROM prompts WHERE prompt['author'] IS NOT NULL),
  m AS (SELECT DISTINCT record_id, author_id FROM n JOIN a USING (w)),
  e AS (SELECT DISTINCT x.author_id AS u, y.author_id AS v FROM m x JOIN m y USING (record_id)),
  r(u, v) AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
  g AS (SELECT u, min(v) AS group_id FROM r GROUP BY u)
  SELECT record_id, min(group_id) AS group_id FROM m JOIN g ON m.author_id = g.u GROUP BY record_id"""

_P8 = r"""WITH i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS w FROM benchmark),
  d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
  iw AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - 11, 0) + 1), lambda k: array_to_string(w[k:k + 11], ' '))) AS p FROM i),
  dw AS (SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - 11, 0) + 1), lambda k: array_to_string(w[k:k + 11], ' '))) AS p FROM d)
  SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (p)"""

_P8_RUNS = r"""WITH i AS (SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS w FROM benchmark),
  d AS (SELECT DISTINCT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
  iw AS (SELECT item_id, s, array_to_string(w[s:s + 11], ' ') AS p FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS s FROM i WHERE len(w) >= 12)),
  dw AS (SELECT doc_id, a, array_to_string(w[a:a + 11], ' ') AS p FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS a FROM d WHERE len(w) >= 12)),
  f AS (SELECT DISTINCT doc_id, item_id, a, s FROM dw JOIN iw USING (p)),
  r AS (SELECT doc_id, item_id, a - s AS shift, s - row_number() OVER (PARTITION BY doc_id, item_id, a - s ORDER BY s) AS run FROM f),
  l AS (SELECT doc_id, item_id, count(*) + 11 AS length FROM r GROUP BY doc_id, item_id, shift, run)
  SELECT doc_id, item_id, count(*) AS runs, max(length) AS longest FROM l GROUP BY doc_id, item_id"""

# every place of every window is looked at: places are the blanks, (v, e, s) their strength, start and end
_P3_PIECES = rf"""WITH RECURSIVE q AS ({_P3}),
  src AS (SELECT record_id, prompt['story'] AS t FROM prompts WHERE regexp_matches(prompt['story'], '[^ \t-\r\x{{1c}}-\x{{1f}}\x{{85}}\x{{a0}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]')),
  w AS (SELECT record_id, t, regexp_extract_all(t, '{_WS}+') AS g, string_split_regex(t, '{_WS}+') AS x FROM src WHERE length(t) > 2400),
  c AS (SELECT record_id, t, list_transform(range(1, len(g) + 1), lambda k: {{'v': CASE WHEN regexp_matches(g[k], '[\r\n\x{{2028}}\x{{2029}}]') THEN 3 WHEN regexp_matches(x[k], '[.!?…]["''”’»«)\]}}]*$') THEN 2 ELSE 1 END,
      'e': (list_sum(list_transform(x[1:k], lambda y: length(y))) + coalesce(list_sum(list_transform(g[1:k - 1], lambda y: length(y))), 0))::BIGINT,
      's': (list_sum(list_transform(x[1:k], lambda y: length(y))) + list_sum(list_transform(g[1:k], lambda y: length(y))))::BIGINT}}) AS b FROM w),
  l AS (SELECT record_id, t, list_filter(b, lambda y: y.e > 0 AND y.e < length(t)) AS b, length(t) - length(regexp_replace(t, '^{_WS}+', '')) AS low, length(regexp_replace(t, '{_WS}+$', '')) AS stop FROM c),
  r(record_id, piece, s, e, v, over, nxt, fin) AS (
    SELECT record_id, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0, 0::BIGINT, low::BIGINT, false FROM l
    UNION ALL
    SELECT record_id, piece, s, e, v, over,
      CASE WHEN fin THEN 0 ELSE coalesce(list_filter(b, lambda y: y.s >= greatest(e - 200, s + 1) AND y.s < e)[1].s, CASE WHEN v = 0 THEN greatest(e - 200, s + 1) ELSE resume END) END AS nxt, fin FROM (
      SELECT record_id, b, piece, s, over, fin, CASE WHEN fin THEN 3 ELSE coalesce(p.v, 0) END AS v, CASE WHEN fin THEN stop ELSE coalesce(p.e, s + 2400) END AS e, coalesce(p.s, s + 2400) AS resume FROM (
        SELECT r.record_id, l.b, r.piece + 1 AS piece, r.nxt AS s, greatest(0, r.e - r.nxt) AS over, l.stop, l.stop - r.nxt <= 2400 AS fin,
          list_sort(list_filter(l.b, lambda y: y.e > greatest(r.e, r.nxt) AND y.e <= r.nxt + 2400))[-1] AS p
        FROM r JOIN l ON r.record_id = l.record_id WHERE NOT r.fin)))
  SELECT r.record_id, piece, max(piece) OVER (PARTITION BY r.record_id) AS n_pieces, s AS "start", e AS "end", over AS overlap, ['character', 'word', 'sentence', 'paragraph'][v + 1] AS cut,
    q.boundary, substr(l.t, s + 1, e - s) AS text FROM r JOIN l ON r.record_id = l.record_id JOIN q ON r.record_id = q.record_id WHERE piece > 0
  UNION ALL SELECT record_id, 1, 1, 0, length(t), 0, 'paragraph', NULL, t FROM src WHERE length(t) <= 2400"""

# sizes in runs of letters, digits and signs: by the statement of the problem the cases are the same with any usual tokenizer
_P9 = r"""WITH d AS (SELECT lower(trim(source)) AS k, len(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{M}]+|\p{N}|[^\s\p{L}\p{M}\p{N}]')) AS n FROM documents WHERE trim(coalesce(source, '')) <> ''),
  s AS (SELECT k, sum(n) AS n FROM d GROUP BY k)
  SELECT source FROM mix_targets LEFT JOIN s ON lower(trim(source)) = k WHERE max_repeats * coalesce(n, 0) < weight * (SELECT sum(n) FROM s)"""

ORACLES = {
    "p3_found": _P3,
    "p3_pieces": _P3_PIECES,
    "p5_terms": f"{_TERMS} SELECT * FROM r",
    "p5_found": f"{_TERMS} SELECT field, term, mark FROM r WHERE mark IS NOT NULL",
    "p7_found": _P7,
    "p8_found": _P8,
    "p8_leaks": _P8_RUNS,
    "p9_found": _P9,
    "p9_kept": "SELECT source, true AS tokens_kept, true AS documents_kept FROM mix_targets WHERE trim(coalesce(source, '')) <> ''",
}
