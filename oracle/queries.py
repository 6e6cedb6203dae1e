"""Oracle SQL per registered query (DuckDB dialect)."""

from oracle import ctes as C
from pairloom import fixed

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["candidate_pairs"] = f"""
WITH {C.LEAD_PAIRS},
m AS (
  SELECT *, {C.bow_diff('plag_tok', 'src_tok')} AS bow_diff,
         CAST(len(plag_tok) AS DOUBLE) / CAST(len(src_tok) AS DOUBLE) AS nb_words_ratio
  FROM lead_pairs
)
SELECT lang, lead_key, src_doc, src_ix, plag_doc, plag_ix, source_sent, plagiat_sent, bow_diff, nb_words_ratio
FROM m
WHERE nb_words_ratio > 0.5 AND nb_words_ratio < 1.5 AND bow_diff > 6
  AND NOT {C.inner_identical('plagiat_sent', 'source_sent')}
"""

WS = C.WS

ORACLE_SQL["sentences"] = f"WITH {C.SENTENCES} SELECT doc_id, ix, sent FROM sentences"

ORACLE_SQL["sentence_offsets"] = rf"""
WITH pl AS (
  SELECT doc_id, string_split(regexp_replace(text, '([.!?])({WS})', '\1' || chr(1) || '\2', 'g'), chr(1)) AS pieces
  FROM documents
), pe AS (
  SELECT doc_id, generate_subscripts(pieces, 1) AS pi, unnest(pieces) AS piece FROM pl
), pw AS (
  SELECT doc_id, pi, piece,
         coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY pi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pstart,
         regexp_replace(piece, '^{WS}+|{WS}+$', '', 'g') AS sent
  FROM pe
), kept AS (
  SELECT doc_id, pi, sent,
         CAST(pstart + length(piece) - length(regexp_replace(piece, '^{WS}+', '')) AS BIGINT) AS start
  FROM pw WHERE sent <> ''
)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pi) - 1 AS BIGINT) AS ix,
       start, CAST(start + length(sent) AS BIGINT) AS "end", sent
FROM kept
"""

ORACLE_SQL["sentence_length_filter"] = f"""
WITH {C.SENTENCES}
SELECT doc_id, ix, CAST(len(tok) AS BIGINT) AS n_tok FROM tok_sentences WHERE len(tok) BETWEEN 5 AND 40
"""

ORACLE_SQL["tokens"] = f"""
WITH {C.SENTENCES}
SELECT doc_id, ix, CAST(len(tok) AS BIGINT) AS n_tok, array_to_string(tok, ' ') AS tokens FROM tok_sentences
"""

def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


GERMAN_SW = _list(fixed.GERMAN_STOPWORDS)
LANG_LISTS = {code: _list(words) for code, words in fixed.LANGUAGE_WORDS.items()}

ORACLE_SQL["stopword_filter"] = rf"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}') AS t FROM documents),
k AS (SELECT doc_id, t, list_filter(t, lambda x: NOT list_contains({GERMAN_SW}, x)) AS kept FROM t)
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, CAST(len(kept) AS BIGINT) AS n_kept, array_to_string(kept, ' ') AS kept FROM k
"""


def detect_sql(expr: str) -> str:
    words = rf"regexp_extract_all(lower({expr}), '[\p{{L}}\p{{N}}]+')"
    parts = []
    for code in sorted(LANG_LISTS):
        parts.append(f"{{'hits': len(list_filter({words}, lambda w: list_contains({LANG_LISTS[code]}, w))), 'code': '{code}'}}")
    arr = "[" + ", ".join(parts) + "]"
    best = f"list_sort(list_transform({arr}, lambda s: {{'neg': -s.hits, 'code': s.code, 'hits': s.hits}}))[1]"
    return f"(CASE WHEN ({best}).hits > 0 THEN ({best}).code END)"


ORACLE_SQL["detect_language"] = f"SELECT doc_id, lang, {detect_sql('text')} AS detected FROM documents"

ORACLE_SQL["language_confusion"] = f"""
SELECT lang, detected, count(*) AS n FROM ({ORACLE_SQL['detect_language']}) GROUP BY lang, detected
"""

ORACLE_SQL["bow_difference"] = f"""
WITH {C.LEAD_PAIRS}
SELECT src_doc, src_ix, plag_doc, plag_ix, {C.bow_diff('plag_tok', 'src_tok')} AS bow_diff FROM lead_pairs
"""

ORACLE_SQL["word_ratio"] = f"""
WITH {C.LEAD_PAIRS}
SELECT src_doc, src_ix, plag_doc, plag_ix, CAST(len(plag_tok) AS DOUBLE) / CAST(len(src_tok) AS DOUBLE) AS nb_words_ratio
FROM lead_pairs
"""

ORACLE_SQL["jaccard"] = f"""
WITH {C.LEAD_PAIRS},
j AS (SELECT *, {C.tokens_all('plagiat_sent')} AS a, {C.tokens_all('source_sent')} AS b FROM lead_pairs)
SELECT src_doc, src_ix, plag_doc, plag_ix,
       CASE WHEN len(list_distinct(list_concat(a, b))) = 0 THEN NULL
            ELSE CAST(len(list_intersect(list_distinct(a), list_distinct(b))) AS DOUBLE) / CAST(len(list_distinct(list_concat(a, b))) AS DOUBLE) END AS jaccard
FROM j
"""

ORACLE_SQL["clean_control_chars"] = r"""
SELECT doc_id, regexp_replace(text, '\p{C}', ' ', 'g') AS text,
       CAST(length(text) - length(replace(text, chr(10), '')) AS BIGINT) AS n_newlines
FROM documents
"""


def strip_markup_sql(x: str) -> str:
    """Text of markup; of the character references the ones the pages hold."""
    c = x
    c = f"regexp_replace({c}, '(?s)<!--.*?-->', '', 'g')"
    c = f"regexp_replace({c}, '(?is)<(script|style)\\b[^>]*>.*?</(script|style)[^>]*>', '', 'g')"
    c = f"regexp_replace({c}, '(?is)</?({'|'.join(fixed.BLOCK_TAGS)})\\b[^>]*>', ' ', 'g')"
    c = f"regexp_replace({c}, '(?s)<[^>]*>', '', 'g')"
    for a, b in [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&middot;", "·"), ("&copy;", "©")]:
        c = f"replace({c}, '{a}', '{b}')"
    c = f"regexp_replace({c}, '&amp;?', '&', 'g')"
    c = f"regexp_replace({c}, '{WS}+', ' ', 'g')"
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def first_match(x: str, pat: str) -> str:
    return f"nullif(regexp_extract({x}, '{pat}', 1), '')"


#: The generated listing pages, known by what was put into them: no markup is read back.
LISTED = """
listed AS (
  SELECT page_id AS n, page_id // 6 AS g, lead(page_id) OVER (PARTITION BY page_id // 6 ORDER BY page_id) AS next,
         min(page_id) OVER (PARTITION BY page_id // 6) AS first FROM pages
), listing AS (
  SELECT *, -n - 1 AS page_id, 'http://wiki.example.org/wiki/Category:' || g || '?page=' AS base FROM listed
)"""

ORACLE_SQL["page_text"] = f"""
WITH {LISTED}
SELECT page_id, {strip_markup_sql('html')} AS text FROM pages
UNION ALL
SELECT page_id, 'List ' || n || ' Category ' || g || ' no link first second third next again' FROM listing
"""

ORACLE_SQL["page_fields"] = rf"""
WITH l AS (SELECT *, regexp_extract_all(html, '<a\b[^>]*\bhref="([^"]*)"', 1) AS links FROM pages)
SELECT page_id, url,
       {first_match('html', r'<html[^>]*\blang="([^"]*)"')} AS page_lang,
       {strip_markup_sql(first_match('html', '(?is)<title[^>]*>(.*?)</title>'))} AS title,
       {strip_markup_sql(first_match('html', '(?is)<h1[^>]*>(.*?)</h1>'))} AS heading,
       CAST(len(links) AS BIGINT) AS n_links,
       links[1] AS first_link, links[-1] AS last_link,
       regexp_matches(html, 'class="([^"]* )?ad( [^"]*)?"') AS has_ad
FROM l
"""


def abs_url_sql(h: str, b: str) -> str:
    origin = f"regexp_extract({b}, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"
    scheme = f"regexp_extract({b}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)"
    no_frag = f"regexp_extract({b}, '^([^#]*)', 1)"
    no_query = f"regexp_extract({b}, '^([^?#]*)', 1)"
    directory = f"regexp_extract({no_query}, '^(.*/)', 1)"
    return f"""(CASE WHEN regexp_matches({h}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {h}
      WHEN starts_with({h}, '//') THEN {scheme} || ':' || {h}
      WHEN starts_with({h}, '/') THEN {origin} || {h}
      WHEN starts_with({h}, '#') THEN {no_frag} || {h}
      WHEN starts_with({h}, '?') THEN {no_query} || {h}
      ELSE (CASE WHEN {directory} <> '' THEN {directory} ELSE {origin} || '/' END) || {h} END)"""


PAGE_LINKS = rf"""
tags AS (
  SELECT page_id, url, CAST(generate_subscripts(a, 1) - 1 AS BIGINT) AS link_no, unnest(a) AS attrs
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a\b([^>]*)>', 1) AS a FROM pages)
), hl AS (
  SELECT *, regexp_extract(attrs, '\bhref="([^"]*)"', 1) AS href,
         string_split(regexp_extract(attrs, '\bclass="([^"]*)"', 1), ' ') AS words
  FROM tags
), {LISTED.strip()}, links AS (
  SELECT page_id, link_no, href, {abs_url_sql('href', 'url')} AS abs_url, words FROM hl WHERE href <> ''
  UNION ALL SELECT page_id, 1, '/wiki/Abc/Fragment_' || n || '_01', 'http://wiki.example.org/wiki/Abc/Fragment_' || n || '_01', [] FROM listing
  UNION ALL SELECT page_id, 2, '/wiki/Abc/Analyse:Fragment_' || n || '_02', 'http://wiki.example.org/wiki/Abc/Analyse:Fragment_' || n || '_02', [] FROM listing
  UNION ALL SELECT page_id, 3, '/go?a=1&b=' || n, 'http://wiki.example.org/go?a=1&b=' || n, [] FROM listing
  UNION ALL SELECT page_id, 4, '?page=' || coalesce(next, first), base || coalesce(next, first),
                   CASE WHEN next IS NULL THEN ['x', 'paginator-next', 'disabled'] ELSE ['x', 'paginator-next'] END FROM listing
  UNION ALL SELECT page_id, 5, '?page=' || first, base || first, ['paginator-next'] FROM listing
)"""

ORACLE_SQL["page_links"] = f"""
WITH {PAGE_LINKS}
SELECT page_id, link_no, href, abs_url,
       (regexp_matches(abs_url, '^.*/wiki/.*/Fragment.*$') AND NOT contains(abs_url, 'Analyse')) AS is_fragment_link,
       (list_contains(words, 'paginator-next') AND NOT list_contains(words, 'disabled')) AS is_next
FROM links
"""

ORACLE_SQL["frontier_new_urls"] = f"""
WITH {PAGE_LINKS}
SELECT DISTINCT abs_url AS url FROM links WHERE abs_url NOT IN (SELECT url FROM pages WHERE url IS NOT NULL UNION ALL SELECT base || n FROM listing)
"""

ORACLE_SQL["next_page_depths"] = f"""
WITH RECURSIVE {LISTED}, reached AS (
  SELECT base, n, 0 AS depth FROM listing WHERE n = first
  UNION SELECT l.base, l.n, r.depth + 1 FROM reached r JOIN listing f ON f.n = r.n JOIN listing l ON l.n = f.next
)
SELECT base || n AS url, min(depth)::INT AS depth FROM reached GROUP BY 1
"""

M = C.matcher(LANG_LISTS)

ORACLE_SQL["text_before_hr"] = f"""
WITH {C.fragments(LANG_LISTS)}
SELECT url,
  {strip_markup_sql("CASE WHEN strpos(lower(raw_source_text), '<hr>') > 0 THEN substr(raw_source_text, 1, strpos(lower(raw_source_text), '<hr>') - 1) || '</td>' ELSE raw_source_text END")} AS source_text_cut,
  {strip_markup_sql("CASE WHEN strpos(lower(raw_plagiat_text), '<hr>') > 0 THEN substr(raw_plagiat_text, 1, strpos(lower(raw_plagiat_text), '<hr>') - 1) || '</td>' ELSE raw_plagiat_text END")} AS plagiat_text_cut
FROM fragments
"""
ORACLE_SQL["annotated_spans"] = f"WITH {M} SELECT url, side, para_no, span_no, cls, text FROM spans2"
ORACLE_SQL["span_offsets"] = f'WITH {M} SELECT url, side, para_no, span_no, start, "end" FROM offs2'
ORACLE_SQL["span_runs"] = f'WITH {M} SELECT url, side, para_no, key, start, "end" FROM runs'
ORACLE_SQL["common_span_keys"] = f"WITH {M} SELECT url, key FROM common"
ORACLE_SQL["span_key_counts"] = f"""
WITH {M}, t AS (SELECT url, count(*) AS n_src_annotations FROM runs WHERE side = 'src' GROUP BY url),
c AS (SELECT url, count(*) AS n_common FROM common GROUP BY url)
SELECT coalesce(t.url, c.url) AS url, coalesce(c.n_common, 0) AS n_common, coalesce(t.n_src_annotations, 0) AS n_src_annotations
FROM t FULL OUTER JOIN c ON t.url = c.url
"""
ORACLE_SQL["span_sentence_range"] = f"WITH {M} SELECT url, side, para_no, key, sent FROM key_sents"
ORACLE_SQL["span_last_wins"] = f"WITH {M} SELECT url, side, key, sent FROM key_text"
ORACLE_SQL["paired_annotations"] = f"WITH {M} SELECT url, i, key, plagiat_sent, source_sent FROM paired"
ORACLE_SQL["side_count_check"] = f"""
WITH {M}, p AS (SELECT DISTINCT url, key FROM runs WHERE side = 'plag'), s AS (SELECT DISTINCT url, key FROM runs WHERE side = 'src'),
j AS (SELECT coalesce(p.url, s.url) AS url, p.key AS pk, s.key AS sk FROM p FULL OUTER JOIN s ON p.url = s.url AND p.key = s.key)
SELECT url, count(pk) AS n_plag, count(sk) AS n_src, count(*) FILTER (WHERE pk IS NULL OR sk IS NULL) AS n_unmatched,
       count(pk) = count(sk) AS sizes_equal
FROM j GROUP BY url
"""
ORACLE_SQL["drop_identical_sentences"] = f"WITH {M} SELECT url, i, plagiat_sent, source_sent FROM u7"
ORACLE_SQL["fake_source_candidates"] = f"""
WITH {M}, cnt AS (SELECT url, i, count(*) AS n FROM cand GROUP BY url, i)
SELECT u.url, u.i, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n_candidates FROM u7 u LEFT JOIN cnt ON cnt.url = u.url AND cnt.i = u.i
"""
ORACLE_SQL["fake_source_pick"] = f"WITH {M} SELECT url, i, fake_source_sent FROM with_fake"
ORACLE_SQL["dedup_pairs"] = f"""
WITH {M}
SELECT url, i, plagiat_sent, source_sent FROM (
  SELECT *, row_number() OVER (PARTITION BY plagiat_sent, source_sent ORDER BY url, i) AS rn FROM u7) WHERE rn = 1
"""
ORACLE_SQL["annotations"] = f"WITH {M} SELECT * FROM annotations"

CORPUS = M + """,
mono AS (
  SELECT annotation_identifier, url, plagiat_sent, source_sent, fake_source_sent, lang_plagiat, lang_source, bow_diff, nb_words_ratio
  FROM annotations WHERE type = 'Verschleierung' AND lang_plagiat = lang_source
), by_lang AS (
  SELECT annotation_identifier, url, plagiat_sent, source_sent, bow_diff, nb_words_ratio, 1 AS isParaphrase, lang_plagiat AS lang
  FROM mono
  WHERE lang_plagiat IN ('en', 'de', 'es') AND lang_source = lang_plagiat
    AND nb_words_ratio > 0.5 AND nb_words_ratio < 1.5 AND bow_diff > 6
), labelled AS (
  SELECT * FROM by_lang
  UNION ALL
  SELECT b.annotation_identifier || '_f', b.url, b.plagiat_sent, m.fake_source_sent, b.bow_diff, b.nb_words_ratio, 0, b.lang
  FROM by_lang b JOIN mono m ON m.annotation_identifier = b.annotation_identifier AND m.lang_plagiat = b.lang
       AND m.lang_source = b.lang
  WHERE coalesce(m.fake_source_sent, '') <> ''
), cleaned AS (
  SELECT * FROM labelled WHERE NOT (contains(lower(plagiat_sent), lower(source_sent)) OR contains(lower(source_sent), lower(plagiat_sent)))
), split AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY lang, isParaphrase ORDER BY annotation_identifier)
                      <= floor(CAST(0.2 AS DOUBLE) * count(*) OVER (PARTITION BY lang, isParaphrase)) + 1
                 THEN 'test' ELSE 'train' END AS split
  FROM cleaned
)"""

ORACLE_SQL["monolingual"] = f"WITH {CORPUS} SELECT * FROM mono"
ORACLE_SQL["monolingual_by_lang"] = f"WITH {CORPUS} SELECT * FROM by_lang"
ORACLE_SQL["with_negatives"] = f"WITH {CORPUS} SELECT * FROM labelled"
ORACLE_SQL["inner_identical_filter"] = f"WITH {CORPUS} SELECT * FROM cleaned"
ORACLE_SQL["inner_identical_counts"] = f"""
WITH {CORPUS}
SELECT lang, isParaphrase,
       count(*) FILTER (WHERE contains(lower(plagiat_sent), lower(source_sent)) OR contains(lower(source_sent), lower(plagiat_sent))) AS skipped,
       count(*) AS total
FROM labelled GROUP BY lang, isParaphrase
"""
ORACLE_SQL["train_test_split"] = f"WITH {CORPUS} SELECT annotation_identifier, lang, isParaphrase, split FROM split"
ORACLE_SQL["split_shape"] = f"WITH {CORPUS} SELECT lang, split, count(*) AS n_rows, CAST(4 AS BIGINT) AS n_cols FROM split GROUP BY lang, split"
ORACLE_SQL["corpus_export"] = f"""
WITH {CORPUS}
SELECT lang, split, plagiat_sent, source_sent, isParaphrase, url,
       lang || '2024-1-1' || '_' || split || '.csv' AS file_name
FROM split
"""
ORACLE_SQL["annotation_augmented"] = f"""
WITH {M}
SELECT a.*, f.fragment_identifier, f.type AS category, split_part(f.fragment_identifier, '/', 1) AS author
FROM annotations a LEFT JOIN fragments f ON f.url = a.url
"""
ORACLE_SQL["upsert_latest"] = r"""
WITH u AS (
  SELECT doc_id, text, 0 AS version FROM documents
  UNION ALL
  SELECT doc_id, regexp_replace(text, '\p{C}', ' ', 'g'), 1 FROM documents WHERE regexp_replace(text, '\p{C}', ' ', 'g') <> text
)
SELECT doc_id, arg_max(text, version) AS text, max(version) AS version FROM u GROUP BY doc_id
"""
ORACLE_SQL["fragment_tsv_projection"] = f"""
WITH {C.fragments(LANG_LISTS)}
SELECT url, fragment_identifier, split_part(fragment_identifier, '/', 1) AS author, source_text, raw_source_text AS full_html,
       type AS category, lang_source, lang_plagiat, plagiat_text, CAST(gesichtet AS INTEGER) AS peer_reviewed
FROM fragments
"""
ORACLE_SQL["annotation_sheet"] = f"""
WITH {CORPUS},
sh AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', annotation_identifier)), annotation_identifier) - 1 AS item_no
       FROM cleaned),
lines AS (
  SELECT item_no, 0 AS line_no, 'source' AS field, source_sent AS value FROM sh
  UNION ALL SELECT item_no, 1, 'plag', plagiat_sent FROM sh
  UNION ALL SELECT item_no, 2, 'parahrase?', '' FROM sh
  UNION ALL SELECT item_no, 3, '', '' FROM sh
)
SELECT CAST(item_no AS BIGINT) AS item_no, CAST(line_no AS BIGINT) AS line_no, field, value FROM lines
"""

TFIDF = C.fragments(LANG_LISTS) + r""",
docs AS (SELECT url, 'src' AS side, source_text AS text FROM fragments UNION ALL SELECT url, 'plag' AS side, plagiat_text AS text FROM fragments),
tok AS (SELECT url, side, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM docs),
tf AS (SELECT url, side, term, count(*) AS tf FROM tok GROUP BY url, side, term),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
nd AS (SELECT count(*) AS n FROM docs),
vocab AS (SELECT term, df, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM dfs, nd WHERE df BETWEEN 3 AND 1000),
w0 AS (SELECT tf.url, tf.side, tf.term, tf.tf * v.idf AS raw FROM tf JOIN vocab v ON v.term = tf.term),
norms AS (SELECT url, side, sqrt(sum(raw * raw)) AS norm FROM w0 GROUP BY url, side),
weights AS (SELECT w0.url, w0.side, w0.term, raw / norm AS weight FROM w0 JOIN norms ON norms.url = w0.url AND norms.side = w0.side),
items AS (SELECT url, split_part(fragment_identifier, '/', 1) AS author FROM fragments)"""


def retrieval_sql(grouped: bool, dside: str) -> str:
    part = "PARTITION BY author" if grouped else ""
    key = "'42', author, url" if grouped else "'42', url"
    same = "AND c.author = o.author" if grouped else ""
    return TFIDF + f""",
perm AS (SELECT url, author, row_number() OVER ({part} ORDER BY md5(concat_ws('|', {key})), url) AS pos,
                count(*) OVER ({part}) AS n FROM items),
offs AS (SELECT p.*, unnest(range(1, least(20, n))) AS off FROM perm p),
dist AS (SELECT o.url AS q_id, o.author, c.url AS c_id FROM offs o JOIN perm c ON c.pos = ((o.pos - 1 + o.off) % o.n) + 1 {same}),
pairs AS (SELECT url AS q_id, author, url AS c_id, 'plag' AS c_side, true AS is_target, 0 AS tie FROM items
          UNION ALL SELECT q_id, author, c_id, '{dside}' AS c_side, false AS is_target, 1 AS tie FROM dist),
x AS (SELECT p.q_id, p.c_id, p.c_side, sum(a.weight * b.weight) AS s
      FROM pairs p JOIN weights a ON a.url = p.q_id AND a.side = 'src'
      JOIN weights b ON b.url = p.c_id AND b.side = p.c_side AND b.term = a.term GROUP BY p.q_id, p.c_id, p.c_side),
sims AS (SELECT p.*, round(coalesce(x.s, 0.0), 9) AS sim FROM pairs p LEFT JOIN x ON x.q_id = p.q_id AND x.c_id = p.c_id AND x.c_side = p.c_side),
res AS (SELECT q_id AS url, author, count(*) AS n_candidates, max(sim) FILTER (WHERE is_target) AS target_sim,
               max(sim) FILTER (WHERE NOT is_target) AS best_distractor_sim FROM sims GROUP BY q_id, author),
res2 AS (SELECT *, target_sim >= greatest(coalesce(best_distractor_sim, 0.0), 0.0) AS correct FROM res)"""


ORACLE_SQL["document_frequency"] = f"WITH {TFIDF} SELECT term, df, round(idf, 9) AS idf FROM vocab"
ORACLE_SQL["tfidf_weights"] = f"WITH {TFIDF} SELECT url, side, term, round(weight, 9) AS weight FROM weights"
ORACLE_SQL["retrieval_in_group"] = f"WITH {retrieval_sql(True, 'src')} SELECT * FROM res2"
ORACLE_SQL["retrieval_global"] = f"WITH {retrieval_sql(False, 'plag')} SELECT url, n_candidates, target_sim, best_distractor_sim, correct FROM res2"
ORACLE_SQL["top1_match"] = f"""
WITH {retrieval_sql(True, 'src')}
SELECT q_id AS url, arg_min(c_id, (-sim, tie, c_id, c_side)) AS best_id, arg_min(c_side, (-sim, tie, c_id, c_side)) AS best_side,
       max(sim) AS best_sim
FROM sims GROUP BY q_id
"""
ORACLE_SQL["accuracy_by_group"] = f"""
WITH {retrieval_sql(True, 'src')}
SELECT author, count(*) AS size, CAST(sum(CAST(correct AS BIGINT)) AS BIGINT) AS n_correct, avg(CAST(correct AS DOUBLE)) AS accuracy
FROM res2 GROUP BY ROLLUP (author)
"""
ORACLE_SQL["accuracy_curve"] = f"""
WITH {retrieval_sql(True, 'src')},
g AS (SELECT author, avg(CAST(correct AS DOUBLE)) AS accuracy FROM res2 GROUP BY author)
SELECT CAST(row_number() OVER (ORDER BY accuracy, author) AS BIGINT) AS rank, author, accuracy FROM g
"""

SCORED = CORPUS + f""",
scored AS (
  SELECT *, CASE WHEN len(list_distinct(list_concat(a, b))) = 0 THEN NULL
                 ELSE CAST(len(list_intersect(list_distinct(a), list_distinct(b))) AS DOUBLE) / len(list_distinct(list_concat(a, b))) END AS score
  FROM (SELECT *, {C.tokens_all('plagiat_sent')} AS a, {C.tokens_all('source_sent')} AS b FROM cleaned)
), per AS (
  SELECT lang, score, count(*) FILTER (WHERE isParaphrase = 1) AS p, count(*) FILTER (WHERE isParaphrase = 0) AS q
  FROM scored WHERE score IS NOT NULL GROUP BY lang, score
), pts AS (
  SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC) AS BIGINT) AS pos, score AS threshold,
         CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(q) OVER w AS BIGINT) AS fp,
         sum(p) OVER (PARTITION BY lang) AS tot_p, sum(q) OVER (PARTITION BY lang) AS tot_q
  FROM per WINDOW w AS (PARTITION BY lang ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), roc AS (
  SELECT lang, pos, threshold, tp, fp,
         CASE WHEN tot_p = 0 THEN NULL ELSE CAST(tp AS DOUBLE) / tot_p END AS tpr,
         CASE WHEN tot_q = 0 THEN NULL ELSE CAST(fp AS DOUBLE) / tot_q END AS fpr
  FROM pts
)"""

ORACLE_SQL["jaccard_accuracy"] = f"""
WITH {SCORED}
SELECT lang, count(*) AS n, avg(CAST((CASE WHEN score > 0.5 THEN 1 ELSE 0 END) = isParaphrase AS DOUBLE)) AS accuracy
FROM scored GROUP BY lang
"""
ORACLE_SQL["roc_points"] = f"WITH {SCORED} SELECT * FROM roc"
ORACLE_SQL["roc_auc"] = f"""
WITH {SCORED}
SELECT r.lang, round(sum((r.fpr - coalesce(p.fpr, 0.0)) * (r.tpr + coalesce(p.tpr, 0.0)) / 2), 9) AS auc
FROM roc r LEFT JOIN roc p ON p.lang = r.lang AND p.pos = r.pos - 1 GROUP BY r.lang
"""

ANNOT = r"""
l1 AS (
  SELECT doc_id * 4 + 0 AS line_no, 'source,"doc ' || doc_id || '";;;' AS value FROM labels
  UNION ALL SELECT doc_id * 4 + 1, 'plag,"doc ' || doc_id || '";;;' FROM labels
  UNION ALL SELECT doc_id * 4 + 2, CAST(quality + toxic AS VARCHAR) || ';;;' FROM labels
  UNION ALL SELECT doc_id * 4 + 3, ';;;' FROM labels
), l2 AS (
  SELECT doc_id * 4 + 0 AS line_no, 'source,"doc ' || doc_id || '"' AS value FROM labels
  UNION ALL SELECT doc_id * 4 + 1, 'plag,"doc ' || doc_id || '"' FROM labels
  UNION ALL SELECT doc_id * 4 + 2, 'parahrase?,' || CAST(quality * 2 AS VARCHAR) FROM labels
  UNION ALL SELECT doc_id * 4 + 3, '' FROM labels
), a1 AS (
  SELECT CAST(row_number() OVER (ORDER BY line_no) - 1 AS BIGINT) AS item_no, CAST(regexp_extract(value, '(\d);', 1) AS INTEGER) AS label
  FROM l1 WHERE regexp_matches(value, '(\d);')
), a2 AS (
  SELECT CAST(row_number() OVER (ORDER BY line_no) - 1 AS BIGINT) AS item_no, CAST(regexp_extract(value, 'parahrase\?,(\d).*', 1) AS INTEGER) AS label
  FROM l2 WHERE regexp_matches(value, 'parahrase\?,(\d).*')
), labels_all AS (
  SELECT item_no, label, 1 AS annotator FROM a1 UNION ALL SELECT item_no, label, 2 AS annotator FROM a2
)"""

ORACLE_SQL["annotator_labels"] = f"WITH {ANNOT} SELECT * FROM labels_all"
ORACLE_SQL["label_positions"] = f"WITH {ANNOT} SELECT annotator, item_no FROM labels_all WHERE label = 2"
ORACLE_SQL["annotator_agreement"] = f"""
WITH {ANNOT},
j AS (SELECT a1.label AS l1, a2.label AS l2 FROM a1 FULL OUTER JOIN a2 ON a1.item_no = a2.item_no)
SELECT count(l1) AS n_annotator1, count(l2) AS n_annotator2,
       count(*) FILTER (WHERE l1 IS NULL OR l2 IS NULL) AS n_unmatched,
       avg(CASE WHEN l1 IS NOT NULL AND l2 IS NOT NULL THEN CAST(l1 = l2 AS DOUBLE) END) AS agreement_with_2,
       avg(CASE WHEN l1 IS NOT NULL AND l2 IS NOT NULL THEN CAST((CASE WHEN l1 = 2 THEN 1 ELSE l1 END) = (CASE WHEN l2 = 2 THEN 1 ELSE l2 END) AS DOUBLE) END) AS agreement_without_2
FROM j
"""


def text_before_hr_sql(x: str) -> str:
    return strip_markup_sql(f"CASE WHEN strpos(lower({x}), '<hr>') > 0 THEN substr({x}, 1, strpos(lower({x}), '<hr>') - 1) || '</td>' ELSE {x} END")


#: What the generated pages say, taken from the fragments themselves instead of parsing pages; the given pages hold no fragment box.
ORACLE_SQL["page_fragment_fields"] = rf"""
WITH {C.fragments(LANG_LISTS)}
SELECT url, fragment_identifier, 'Verschleierung Müller äx ' || source AS type, length(url) % 2 = 0 AS gesichtet,
  regexp_replace(raw_plagiat_text, '\p{{C}}', ' ', 'g') AS raw_plagiat_text,
  regexp_replace(raw_source_text, '\p{{C}}', ' ', 'g') AS raw_source_text,
  {text_before_hr_sql('raw_plagiat_text')} AS plagiat_text,
  {text_before_hr_sql('raw_source_text')} AS source_text, 'wiki' AS source
FROM fragments
"""

ORACLE_SQL["monolingual_by_lang_sql"] = ORACLE_SQL["monolingual_by_lang"]

ORACLE_SQL["annotated_spans_parsed"] = rf"""
WITH {M}
SELECT url, side, para_no, span_no, cls,
       regexp_replace(regexp_replace(text, '{WS}+', ' ', 'g'), '^ +| +$', '', 'g') AS text
FROM spans2
"""


#: Over the corpus tables, one language and label after the other.
ORACLE_SQL["run_counters"] = f"""
WITH {CORPUS}, langs AS (SELECT unnest(['en', 'de', 'es']) AS lang),
per AS (
  SELECT l.lang, count(*) FILTER (x.isParaphrase = 1) AS p, count(*) FILTER (x.isParaphrase = 0) AS f FROM langs l LEFT JOIN labelled x USING (lang) GROUP BY 1),
kept AS (
  SELECT l.lang, count(*) FILTER (x.isParaphrase = 1) AS p, count(*) FILTER (x.isParaphrase = 0) AS f FROM langs l LEFT JOIN cleaned x USING (lang) GROUP BY 1),
sizes AS (
  SELECT l.lang, count(*) FILTER (x.split = 'train') AS a, count(*) FILTER (x.split = 'test') AS b FROM langs l LEFT JOIN split x USING (lang) GROUP BY 1)
SELECT 'errors' AS counter, NULL AS lang, (SELECT count(*) FROM annotations WHERE lang_plagiat IS NULL OR lang_source IS NULL) AS n
UNION ALL SELECT 'paraphrases', lang, p FROM per UNION ALL SELECT 'fake_paraphrases', lang, f FROM per
UNION ALL SELECT 'skipped_paraphrases', lang, per.p - kept.p FROM per JOIN kept USING (lang)
UNION ALL SELECT 'skipped_fake_paraphrases', lang, per.f - kept.f FROM per JOIN kept USING (lang)
UNION ALL SELECT 'train', lang, a FROM sizes UNION ALL SELECT 'test', lang, b FROM sizes
"""

#: Known by what each damaged record was made from; no CSV is read.
ORACLE_SQL["label_quarantine"] = """
WITH l AS (SELECT doc_id, coalesce(quality, 0) AS q, coalesce(toxic, 0) AS t, doc_id % 10 AS d FROM labels WHERE doc_id IS NOT NULL)
SELECT CASE WHEN d <> 6 THEN doc_id END AS doc_id, CASE WHEN d = 5 THEN 7 WHEN d <> 3 THEN q END AS quality,
       CASE d WHEN 1 THEN NULL WHEN 6 THEN 7 ELSE t END AS toxic,
       CASE d WHEN 1 THEN NULL WHEN 2 THEN 'x' WHEN 3 THEN 'a, b' WHEN 4 THEN 'said "so", twice' WHEN 5 THEN 'seven' WHEN 6 THEN NULL ELSE 'plain ' END AS note,
       CASE d WHEN 1 THEN 'missing fields' WHEN 3 THEN 'wrong kind of value' WHEN 5 THEN 'quality' WHEN 6 THEN 'no doc_id,toxic' ELSE '' END AS reasons
FROM l
"""


_WORD = r"[\p{L}\p{N}][\p{L}\p{N}.]*"


def _put(x: str, after: str, what: str) -> str:
    return rf"regexp_replace({x}, ' ({after}) ', ' \1 {what} ', 'g')"


BOUNDARIES = rf"""
texts AS (
  SELECT doc_id, text FROM documents
  UNION ALL SELECT -doc_id - 1, {_put(_put(_put('text', 'die|the|le|el', 'Dr.'), 'und|and|et|y', 'z.B.'), 'in|en|zu|to', 'am 3. Mai bei')} FROM documents
), ws AS (SELECT regexp_extract_all(text, '{_WORD}') AS w FROM texts),
wp AS (SELECT unnest(w) AS word, unnest(list_concat(w[2:], [NULL])) AS nxt FROM ws),
ty AS (SELECT lower(regexp_replace(word, '\.+$', '')) AS type, ends_with(word, '.') AS stop, lower(regexp_replace(nxt, '\.+$', '')) AS nxt FROM wp),
wc AS (SELECT type, count(*) AS n, count(*) FILTER (stop) AS n_stop FROM ty GROUP BY 1),
tot AS (SELECT sum(n)::DOUBLE AS total, sum(n_stop)::DOUBLE / sum(n) AS chance FROM wc),
sc AS (
  SELECT type, n, n_stop, length(replace(type, '.', ''))::DOUBLE AS size,
    2 * (n_stop * ln(0.99::DOUBLE) + (n - n_stop) * ln((1 - 0.99)::DOUBLE) - n_stop * ln(chance) - (n - n_stop) * ln(1 - chance)) AS tie
  FROM wc, tot WHERE n_stop > 0 AND NOT regexp_matches(type, '^[0-9.]+$')),
abbr AS (
  SELECT * FROM (SELECT type, n, n_stop, tie * exp(-size) * (length(type) - size + 1) * pow(size, (n_stop - n)::DOUBLE) AS score FROM sc) WHERE score >= 0.3),
co AS (SELECT type, nxt, count(*) AS n FROM ty WHERE stop AND nxt IS NOT NULL AND regexp_matches(type, '^([0-9]+|\p{{L}})$') GROUP BY ALL HAVING count(*) >= 2),
cf AS (
  SELECT co.type, co.nxt, co.n, co.n::DOUBLE AS k11, a.n::DOUBLE - co.n AS k12, b.n::DOUBLE - co.n AS k21, total - a.n - b.n + co.n AS k22
  FROM co JOIN wc a ON a.type = co.type JOIN wc b ON b.type = co.nxt, tot),
h AS (SELECT *, lambda_h(k11) + lambda_h(k12) + lambda_h(k21) + lambda_h(k22) AS cells FROM cf),
tied AS (SELECT type, nxt, n, 2 * (cells - lambda_h(k11 + k12) - lambda_h(k21 + k22) - lambda_h(k11 + k21) - lambda_h(k12 + k22)
                                   + lambda_h(k11 + k12 + k21 + k22)) AS ratio, k11 / (k11 + k12) AS here, (k11 + k21) / (k11 + k12 + k21 + k22) AS at_all FROM h),
coll AS (SELECT type, nxt AS next, n, ratio FROM tied WHERE ratio >= 7.88 AND here > at_all)"""


def _plogp(sql: str) -> str:
    """x ln x (0 at 0) in place of lambda_h(x): a log-likelihood ratio as sums of entropies of the four-field table."""
    import re

    return re.sub(r"lambda_h\(([^()]*)\)", r"(CASE WHEN (\1) > 0 THEN (\1) * ln(\1) ELSE 0 END)", sql)


BOUNDARIES = _plogp(BOUNDARIES)
ORACLE_SQL["learnt_abbreviations"] = f"WITH {BOUNDARIES} SELECT type, n, n_stop, round(score, 6) AS score FROM abbr"
ORACLE_SQL["learnt_collocations"] = f"WITH {BOUNDARIES} SELECT type, next, n, round(ratio, 4) AS ratio FROM coll"
ORACLE_SQL["learnt_sentences"] = rf"""
WITH {BOUNDARIES},
pl AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])({WS})', '\1' || chr(1) || '\2', 'g'), chr(1)) AS pieces FROM texts),
pe AS (SELECT doc_id, generate_subscripts(pieces, 1) AS pi, unnest(pieces) AS piece FROM pl),
pn AS (
  SELECT *, lead(lower(regexp_replace(regexp_extract(piece, '{_WORD}'), '\.+$', ''))) OVER (PARTITION BY doc_id ORDER BY pi) AS next,
         CASE WHEN ends_with(piece, '.') THEN nullif(lower(regexp_replace(regexp_extract(piece, '({_WORD})$', 1), '\.+$', '')), '') END AS type,
         coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY pi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM pe),
v AS (SELECT *, EXISTS (SELECT 1 FROM abbr a WHERE a.type = pn.type) OR EXISTS (SELECT 1 FROM coll c WHERE c.type = pn.type AND c.next = pn.next) AS veto FROM pn),
g AS (SELECT *, coalesce(count(*) FILTER (NOT veto) OVER (PARTITION BY doc_id ORDER BY pi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part FROM v),
w AS (SELECT doc_id, part, min(pos) AS pos, string_agg(piece, '' ORDER BY pi) AS raw FROM g GROUP BY 1, 2),
t AS (SELECT *, regexp_replace(raw, '^{WS}+|{WS}+$', '', 'g') AS sent FROM w),
s AS (SELECT *, CAST(pos + length(raw) - length(regexp_replace(raw, '^{WS}+', '')) AS BIGINT) AS start FROM t WHERE sent <> '')
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY part) - 1 AS ix, start, CAST(start + length(sent) AS BIGINT) AS "end", sent FROM s
"""
ORACLE_SQL["learnt_language"] = r"""
WITH t AS (SELECT doc_id, lang, substr(md5(doc_id::VARCHAR), 1, 1) IN ('0', '1', '2') AS held_out,
             ' ' || regexp_replace(lower(coalesce(text, '')), '[\P{L}\x{10000}-\x{10FFFF}]+', ' ', 'g') || ' ' AS t FROM documents),
g AS (SELECT doc_id, lang, held_out, substr(md5(substr(t, i::INT, 3)), 1, 4) AS b FROM t, unnest(range(1, length(t) - 1)) u(i)),
c AS (SELECT lang, b, count(*) AS n FROM g WHERE NOT held_out AND lang IS NOT NULL GROUP BY 1, 2),
l AS (SELECT lang, ln(count(*)::DOUBLE / sum(count(*)) OVER ()) AS prior FROM t WHERE NOT held_out AND lang IS NOT NULL GROUP BY 1),
z AS (SELECT lang, ln(sum(n) + 65536.0::DOUBLE) AS size FROM c GROUP BY 1),
d AS (SELECT doc_id, b, count(*) AS n FROM g GROUP BY 1, 2),
s AS (SELECT d.doc_id, l.lang AS code, sum(d.n * (ln(coalesce(c.n, 0) + 1.0::DOUBLE) - size)) + any_value(prior) AS score
      FROM d CROSS JOIN l JOIN z ON z.lang = l.lang LEFT JOIN c ON c.lang = l.lang AND c.b = d.b GROUP BY 1, 2)
SELECT t.doc_id, t.lang, t.held_out, CASE WHEN regexp_matches(t.t, '\p{L}') THEN (SELECT arg_max(code, score) FROM s WHERE s.doc_id = t.doc_id) END AS detected FROM t
"""


ORACLE_SQL["incremental_merge"] = r"""
SELECT doc_id,
       CASE WHEN lang = 'es' THEN upper(text) ELSE regexp_replace(text, '\p{C}', ' ', 'g') END AS text,
       CASE WHEN lang = 'es' THEN 2 WHEN regexp_replace(text, '\p{C}', ' ', 'g') <> text THEN 1 ELSE 0 END AS version
FROM documents
"""
ORACLE_SQL["positives_by_partition"] = f"""
WITH {CORPUS}, large AS (SELECT lang FROM labelled GROUP BY lang HAVING count(*) > 500)
SELECT annotation_identifier, plagiat_sent, source_sent, url, lang, isParaphrase
FROM labelled WHERE isParaphrase = 1 AND lang IN (SELECT lang FROM large)
"""
ORACLE_SQL["corpus_csv_read_back"] = f"WITH {CORPUS} SELECT lang, split, plagiat_sent, source_sent, isParaphrase, url FROM split"
ORACLE_SQL["sheet_labels_read_back"] = f"""
WITH {CORPUS}
SELECT row_number() OVER (ORDER BY md5(concat_ws('|', '42', annotation_identifier)), annotation_identifier) - 1 AS item_no,
       CAST(isParaphrase AS INTEGER) AS label
FROM cleaned
"""
ORACLE_SQL["stopword_file_counts"] = rf"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')) AS word FROM documents)
SELECT word, count(DISTINCT doc_id) AS n_docs, count(*) AS n_tokens FROM t WHERE list_contains({GERMAN_SW}, word) GROUP BY word
"""
ORACLE_SQL["fragments_in_order"] = f"""
WITH {C.fragments(LANG_LISTS)}
SELECT split_part(fragment_identifier, '/', 1) AS author, url, row_number() OVER (ORDER BY split_part(fragment_identifier, '/', 1), url) AS place
FROM fragments
"""

# ---- SQL functions, bucketed tables ----------------------------------------
ORACLE_SQL["annotated_spans_sql"] = ORACLE_SQL["annotated_spans_parsed"]
ORACLE_SQL["monolingual_sql"] = ORACLE_SQL["monolingual"]
ORACLE_SQL["annotation_augmented_bucketed"] = ORACLE_SQL["annotation_augmented"]
