"""Reusable DuckDB CTE blocks (RE2 regex, ``lambda x:`` lambdas)."""

WS = r"[ \t\n\r\f\x0B]"
TOKEN_RE = r"[\p{L}\p{N}]+|[^ \t\n\r\f\x0B\p{L}\p{N}]"
PUNCT = "['.', ',', ';', ':', '?', '!']"


def split_sents(expr: str) -> str:
    """Trimmed, non-empty sentences of ``expr`` as a list."""
    return (
        rf"list_filter(list_transform(string_split(regexp_replace({expr}, '([.!?])({WS})', '\1' || chr(1) || '\2', 'g'), chr(1)), "
        rf"lambda x: regexp_replace(x, '^{WS}+|{WS}+$', '', 'g')), lambda x: x <> '')"
    )


def tokens(expr: str) -> str:
    return rf"list_filter(regexp_extract_all({expr}, '{TOKEN_RE}'), lambda t: NOT list_contains({PUNCT}, t))"


def tokens_all(expr: str) -> str:
    return rf"regexp_extract_all({expr}, '{TOKEN_RE}')"


def set_diff_size(a: str, b: str) -> str:
    return f"len(list_filter(list_distinct({a}), lambda x: NOT list_contains({b}, x)))"


def bow_diff(a: str, b: str) -> str:
    return f"CAST({set_diff_size(a, b)} + {set_diff_size(b, a)} AS BIGINT)"


def inner_identical(p: str, s: str) -> str:
    return f"(contains(lower({p}), lower({s})) OR contains(lower({s}), lower({p})))"


SENTENCES = rf"""
sent_lists AS (
  SELECT doc_id, lang, source, {split_sents('text')} AS sents FROM documents
),
sentences AS (
  SELECT doc_id, lang, source, CAST(generate_subscripts(sents, 1) - 1 AS BIGINT) AS ix, unnest(sents) AS sent
  FROM sent_lists
),
tok_sentences AS (
  SELECT *, {tokens('sent')} AS tok FROM sentences
)"""

LEAD_PAIRS = SENTENCES + r""",
s5 AS (
  SELECT *, CAST(len(tok) AS BIGINT) AS n_tok, lower(array_to_string(tok[1:3], ' ')) AS lead_key
  FROM tok_sentences WHERE len(tok) BETWEEN 5 AND 40
),
uniq AS (
  SELECT * FROM s5 QUALIFY row_number() OVER (PARTITION BY lang, lead_key, sent ORDER BY doc_id, ix) = 1
),
next_doc AS (
  SELECT a.lang, a.lead_key, a.doc_id, min(b.doc_id) AS nd FROM (SELECT DISTINCT lang, lead_key, doc_id FROM uniq) a
  JOIN (SELECT DISTINCT lang, lead_key, doc_id FROM uniq) b ON a.lang = b.lang AND a.lead_key = b.lead_key AND b.doc_id > a.doc_id
  GROUP BY ALL
),
lead_pairs AS (
  SELECT a.lang, a.lead_key, a.doc_id AS src_doc, a.ix AS src_ix, a.source, a.sent AS source_sent, a.tok AS src_tok,
         b.doc_id AS plag_doc, b.ix AS plag_ix, b.sent AS plagiat_sent, b.tok AS plag_tok
  FROM uniq a JOIN next_doc n ON a.lang = n.lang AND a.lead_key = n.lead_key AND a.doc_id = n.doc_id
  JOIN uniq b ON b.lang = n.lang AND b.lead_key = n.lead_key AND b.doc_id = n.nd
  QUALIFY b.ix = min(b.ix) OVER (PARTITION BY a.lang, a.lead_key, a.doc_id, a.ix)
)"""


def detect_sql(expr: str, lang_lists: dict) -> str:
    words = rf"regexp_extract_all(lower({expr}), '[\p{{L}}\p{{N}}]+')"
    parts = []
    for code in sorted(lang_lists):
        parts.append(f"{{'hits': len(list_filter({words}, lambda w: list_contains({lang_lists[code]}, w))), 'code': '{code}'}}")
    arr = "[" + ", ".join(parts) + "]"
    best = f"list_sort(list_transform({arr}, lambda s: {{'neg': -s.hits, 'code': s.code, 'hits': s.hits}}))[1]"
    return f"(CASE WHEN ({best}).hits > 0 THEN ({best}).code END)"


def fragments(lang_lists: dict) -> str:
    return LEAD_PAIRS + rf""",
fp AS (
  SELECT src_doc, plag_doc, src_ix, plag_ix, lead_key, 'doc/' || src_doc || '/' || plag_doc AS url FROM lead_pairs
), fk AS (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY src_ix, plag_ix) AS k FROM fp
), marks AS (
  SELECT url, 'src' AS side, src_ix AS ix, k, lead_key FROM fk
  UNION ALL SELECT url, 'plag' AS side, plag_ix AS ix, k, lead_key FROM fk
), fit AS (
  SELECT doc_id, ix, sent, len(tok) BETWEEN 5 AND 40 AS fits, lower(array_to_string(tok[1:3], ' ')) AS lead_key FROM tok_sentences
), own AS (
  SELECT *, CASE WHEN doc_id % 4 = 3 THEN 'solo/' ELSE 'edit/' END || doc_id AS url, CASE WHEN fits THEN ix + 1 END AS k
  FROM (SELECT *, min(ix) FILTER (fits) OVER (PARTITION BY doc_id) AS first FROM fit)
  WHERE first IS NOT NULL AND (doc_id % 4 <> 3 OR ix = first)
), frag_docs AS (
  SELECT DISTINCT url, src_doc, plag_doc, '' AS made FROM fp
  UNION ALL SELECT DISTINCT url, doc_id, doc_id, substr(url, 1, 4) || ' ' FROM own
), side_sents AS (
  SELECT f.url, 'src' AS side, s.ix, s.sent, NULL AS prefix FROM frag_docs f JOIN sentences s ON s.doc_id = f.src_doc WHERE made = ''
  UNION ALL
  SELECT f.url, 'plag' AS side, s.ix, s.sent, NULL FROM frag_docs f JOIN sentences s ON s.doc_id = f.plag_doc WHERE made = ''
  UNION ALL SELECT url, 'src', ix, sent, NULL FROM own
  UNION ALL
  SELECT url, 'plag', ix,
    CASE WHEN k IS NULL OR k % 7 = 3 THEN sent
         ELSE regexp_extract(sent, '^[^ ]+ [^ ]+ [^ ]+ ?') || regexp_replace(regexp_replace(sent, '^[^ ]+ [^ ]+ [^ ]+ ?', ''), '([^ ]+) ([^ ]+)', '\1o \2', 'g') END,
    CASE WHEN k % 7 = 3 THEN 'We put these seven plain other words before' END FROM own
), all_marks AS (
  FROM marks
  UNION ALL SELECT url, 'src', ix, k, lead_key FROM own WHERE k IS NOT NULL
  UNION ALL SELECT url, 'plag', ix, k, lead_key FROM own WHERE k % 11 <> 5
), marked AS (
  SELECT url, side, ix, k, 'fragmark' || k || CASE WHEN side = 'plag' AND (length(url) + k) % 5 = 1 THEN 'x' ELSE '' END AS c,
         regexp_extract(regexp_replace(lead_key, '[<>&"]', ' ', 'g'), '^[^ ]*', 0) AS w1,
         regexp_replace(regexp_replace(lead_key, '[<>&"]', ' ', 'g'), '^[^ ]* ?', '') AS w2 FROM all_marks
), spans_html AS (
  SELECT ss.url, ss.side, ss.ix,
    CASE WHEN ss.ix > 0 AND ss.ix % 4 = 0 THEN '</p><p class="q">' ELSE '' END ||
    CASE WHEN m.k IS NOT NULL THEN CASE WHEN prefix IS NOT NULL THEN '<span class="text">' || prefix || '</span>' ELSE '' END ||
      '<span class="' || c || '">' || w1 || '</span><span class="text"> </span><span id="m" class="' || c || '"><b>n</b>' || w2 || '<br>'
      || CASE WHEN (length(m.url) + m.k) % 3 = 0 THEN '. Shared end.' ELSE '' END || '</span><span class="text">'
      || regexp_replace(regexp_replace(ss.sent, '^[^ ]+ [^ ]+ [^ ]+ ?', ''), '[<>&"]', ' ', 'g') || '</span>'
    ELSE '<span class="text">' || regexp_replace(ss.sent, '[<>&"]', ' ', 'g') || '</span>' END AS h
  FROM side_sents ss LEFT JOIN marked m ON m.url = ss.url AND m.side = ss.side AND m.ix = ss.ix
  UNION ALL
  SELECT url, side, 1000000 + k, '</p><p>' ||
    CASE WHEN (length(url) + k) % 8 = 7 THEN '<span class="' || c || '">' || w1 || '</span><span class="fragmark0">x</span>' ELSE '' END ||
    '<span class="' || c || '">' || w1 || '</span><span class="' || c || '">' || w2 || '</span><span class="text">again on the ' || side
    || ' side of it all.</span>'
  FROM marked WHERE (length(url) + k) % 8 >= 6
), cells AS (
  SELECT url, side,
         '<td><span class="text">Head of ' || side || '</span><span class="fragmark7">outside all</span><p>' || string_agg(h, '' ORDER BY ix, h)
         || '</p><hr><span class="fragmark1">refs</span></td>' AS markup
  FROM spans_html GROUP BY url, side
), doc_lang AS (
  SELECT doc_id, text, lang, source, {detect_sql('text', lang_lists)} AS detected FROM documents
), fragments AS (
  SELECT f.url, cs.markup AS raw_source_text, cp.markup AS raw_plagiat_text, a.text AS source_text,
         b.text AS plagiat_text, a.source, CASE WHEN made <> '' AND f.plag_doc % 9 = 4 THEN 'KomplettPlagiat' ELSE 'Verschleierung' END AS type, false AS gesichtet,
         a.lang || '-' || a.source || '/Fragment ' || made || f.src_doc || ' ' || f.plag_doc AS fragment_identifier,
         a.detected AS lang_source,
         CASE WHEN made = '' OR f.plag_doc % 11 <> 0 THEN CASE WHEN made <> '' AND f.plag_doc % 13 = 0 THEN 'xx' ELSE b.detected END END AS lang_plagiat
  FROM frag_docs f JOIN doc_lang a ON a.doc_id = f.src_doc JOIN doc_lang b ON b.doc_id = f.plag_doc
  LEFT JOIN cells cs ON cs.url = f.url AND cs.side = 'src'
  LEFT JOIN cells cp ON cp.url = f.url AND cp.side = 'plag'
)"""


P_BLOCK = r"(?s)<p(?: [^>]*)?>(.*?)</p>"
SPAN_RE = r'<span[^>]* class="([^"]*)">([^<]*)</span>'


def matcher(lang_lists: dict) -> str:
    return fragments(lang_lists) + rf""",
sides AS (
  -- own text of a span: what stands in nested elements does not count, a line break is a blank
  SELECT url, side, regexp_replace(regexp_replace(html, '<b>[^<]*</b>', '', 'g'), '<br>', ' ', 'g') AS html FROM (
  SELECT url, 'plag' AS side, raw_plagiat_text AS html FROM fragments
  UNION ALL SELECT url, 'src' AS side, raw_source_text AS html FROM fragments)
), pre AS (
  SELECT url, side, CASE WHEN strpos(lower(html), '<hr>') > 0 THEN substr(html, 1, strpos(lower(html), '<hr>') - 1)
                         ELSE html END AS pre FROM sides
), paras AS (
  SELECT url, side, list_concat([regexp_replace(pre, '{P_BLOCK}', ' ', 'g')], regexp_extract_all(pre, '{P_BLOCK}', 1)) AS ps
  FROM pre
), pe AS (
  SELECT url, side, CAST(generate_subscripts(ps, 1) - 1 AS BIGINT) AS para_no, unnest(ps) AS chunk FROM paras
), se AS (
  SELECT url, side, para_no, regexp_extract_all(chunk, '{SPAN_RE}', 1) AS cl, regexp_extract_all(chunk, '{SPAN_RE}', 2) AS tx
  FROM pe
), sp0 AS (
  SELECT url, side, para_no, CAST(generate_subscripts(cl, 1) - 1 AS BIGINT) AS span_no, unnest(cl) AS cls, unnest(tx) AS text
  FROM se
), spans AS (
  SELECT url, side, para_no, span_no, cls, regexp_replace(regexp_replace(text, '{WS}+', ' ', 'g'), '^ | $', '', 'g') AS text FROM sp0
), spans2 AS (
  SELECT *, CAST(length(text) AS BIGINT) AS len FROM spans WHERE length(text) > 0
), offs AS (
  SELECT *, CAST(1 + coalesce(sum(len + 1) OVER (PARTITION BY url, side, para_no ORDER BY span_no
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM spans2
), offs2 AS (
  SELECT *, start + len AS "end" FROM offs
), ann AS (
  SELECT *, CASE WHEN lag(cls) OVER (PARTITION BY url, side, para_no ORDER BY span_no) = cls THEN 0 ELSE 1 END AS new_run
  FROM offs2 WHERE starts_with(cls, 'fragmark')
), ann2 AS (
  SELECT *, sum(new_run) OVER (PARTITION BY url, side, para_no ORDER BY span_no
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_id FROM ann
), runs0 AS (
  SELECT url, side, para_no, run_id, min(cls) AS cls, min(start) AS start, max("end") AS "end",
         string_agg(lower(text), ' ' ORDER BY span_no) AS texts
  FROM ann2 GROUP BY url, side, para_no, run_id
), finals AS (
  SELECT url, side, para_no, cls || '_' || texts AS key, arg_max(start, run_id) AS start, arg_max("end", run_id) AS "end", max(run_id) AS last_run
  FROM runs0 GROUP BY url, side, para_no, cls || '_' || texts
), beginnings AS (  -- keys a run had before its last span
  SELECT a.url, a.side, a.para_no, a.run_id, any_value(a.cls) || '_' || string_agg(lower(b.text), ' ' ORDER BY b.span_no) AS key
  FROM ann2 a JOIN ann2 b ON b.url = a.url AND b.side = a.side AND b.para_no = a.para_no AND b.run_id = a.run_id AND b.span_no <= a.span_no
  WHERE EXISTS (SELECT 1 FROM ann2 c WHERE c.url = a.url AND c.side = a.side AND c.para_no = a.para_no AND c.run_id = a.run_id AND c.span_no > a.span_no)
  GROUP BY a.url, a.side, a.para_no, a.run_id, a.span_no
), runs AS (
  SELECT url, side, para_no, key, start, "end" FROM finals f
  WHERE NOT EXISTS (SELECT 1 FROM beginnings g WHERE g.url = f.url AND g.side = f.side AND g.para_no = f.para_no AND g.key = f.key
                    AND g.run_id > f.last_run)
), common AS (
  SELECT DISTINCT p.url, p.key FROM runs p
  WHERE p.side = 'plag' AND EXISTS (SELECT 1 FROM runs s WHERE s.side = 'src' AND s.url = p.url AND s.key = p.key)
), ptext AS (
  SELECT url, side, para_no, ' ' || string_agg(text, ' ' ORDER BY span_no) || ' ' AS text FROM spans2
  GROUP BY url, side, para_no
), ppl AS (
  SELECT url, side, para_no,
         string_split(regexp_replace(text, '([.!?])({WS})', '\1' || chr(1) || '\2', 'g'), chr(1)) AS pieces FROM ptext
), ppe AS (
  SELECT url, side, para_no, generate_subscripts(pieces, 1) AS pi, unnest(pieces) AS piece FROM ppl
), ppw AS (
  SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY url, side, para_no ORDER BY pi
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pstart,
         regexp_replace(piece, '^{WS}+|{WS}+$', '', 'g') AS sent FROM ppe
), ppk AS (
  SELECT url, side, para_no, pi, sent,
         CAST(pstart + length(piece) - length(regexp_replace(piece, '^{WS}+', '')) AS BIGINT) AS start
  FROM ppw WHERE sent <> ''
), psents AS (
  SELECT url, side, para_no, CAST(row_number() OVER (PARTITION BY url, side, para_no ORDER BY pi) - 1 AS BIGINT) AS ix,
         start, CAST(start + length(sent) AS BIGINT) AS "end", sent FROM ppk
), rk AS (
  SELECT r.* FROM runs r JOIN common c ON r.url = c.url AND r.key = c.key
), rix AS (
  SELECT rk.url, rk.side, rk.para_no, rk.key,
    coalesce((SELECT min(s.ix) FROM psents s WHERE s.url = rk.url AND s.side = rk.side AND s.para_no = rk.para_no AND s."end" >= rk.start),
             (SELECT max(s.ix) FROM psents s WHERE s.url = rk.url AND s.side = rk.side AND s.para_no = rk.para_no)) AS s_ix,
    coalesce((SELECT min(s.ix) FROM psents s WHERE s.url = rk.url AND s.side = rk.side AND s.para_no = rk.para_no AND s."end" >= rk."end"),
             (SELECT max(s.ix) FROM psents s WHERE s.url = rk.url AND s.side = rk.side AND s.para_no = rk.para_no)) AS e_ix
  FROM rk
), key_sents AS (
  SELECT r.url, r.side, r.para_no, r.key, string_agg(s.sent, ' ' ORDER BY s.ix) AS sent
  FROM rix r JOIN psents s ON s.url = r.url AND s.side = r.side AND s.para_no = r.para_no AND s.ix BETWEEN r.s_ix AND r.e_ix
  GROUP BY r.url, r.side, r.para_no, r.key
), key_text AS (
  SELECT url, side, key, arg_max(sent, para_no) AS sent FROM key_sents GROUP BY url, side, key
), paired AS (
  SELECT p.url, CAST(row_number() OVER (PARTITION BY p.url ORDER BY p.key) - 1 AS BIGINT) AS i, p.key,
         p.sent AS plagiat_sent, s.sent AS source_sent
  FROM key_text p JOIN key_text s ON p.url = s.url AND p.key = s.key AND p.side = 'plag' AND s.side = 'src'
), filtered AS (
  SELECT * FROM paired
  WHERE plagiat_sent <> source_sent
    AND len({tokens('plagiat_sent')}) BETWEEN 5 AND 40 AND len({tokens('source_sent')}) BETWEEN 5 AND 40
), u_p AS (
  SELECT url, i, generate_subscripts(l, 1) AS ix, unnest(l) AS sent FROM (SELECT url, i, {split_sents('plagiat_sent')} AS l FROM filtered)
), u_s0 AS (
  SELECT url, i, generate_subscripts(l, 1) AS ix, unnest(l) AS sent FROM (SELECT url, i, {split_sents('source_sent')} AS l FROM filtered)
), u_s AS (
  SELECT *, row_number() OVER (PARTITION BY url, i, sent ORDER BY ix) AS copy FROM u_s0
), u_hit AS (
  SELECT url, i, sent, count(*) AS n_plag FROM u_p p
  WHERE EXISTS (SELECT 1 FROM u_s0 s WHERE s.url = p.url AND s.i = p.i AND s.sent = p.sent) GROUP BY url, i, sent
), u_newp AS (
  SELECT url, i, string_agg(sent, ' ' ORDER BY ix) AS p FROM u_p p
  WHERE NOT EXISTS (SELECT 1 FROM u_s0 s WHERE s.url = p.url AND s.i = p.i AND s.sent = p.sent) GROUP BY url, i
), u_news AS (
  SELECT s.url, s.i, string_agg(s.sent, ' ' ORDER BY s.ix) AS s FROM u_s s
  LEFT JOIN u_hit h ON h.url = s.url AND h.i = s.i AND h.sent = s.sent
  WHERE h.n_plag IS NULL OR s.copy > h.n_plag GROUP BY s.url, s.i
), u7 AS (
  SELECT f.url, f.i,
    CASE WHEN EXISTS (SELECT 1 FROM u_hit h WHERE h.url = f.url AND h.i = f.i) THEN coalesce(np.p, '') ELSE f.plagiat_sent END AS plagiat_sent,
    CASE WHEN EXISTS (SELECT 1 FROM u_hit h WHERE h.url = f.url AND h.i = f.i) THEN coalesce(ns.s, '') ELSE f.source_sent END AS source_sent
  FROM filtered f LEFT JOIN u_newp np ON np.url = f.url AND np.i = f.i LEFT JOIN u_news ns ON ns.url = f.url AND ns.i = f.i
), src_sents AS (
  SELECT url, CAST(row_number() OVER (PARTITION BY url ORDER BY para_no, ix) - 1 AS BIGINT) AS sent_no, sent
  FROM psents WHERE side = 'src'
), cand AS (
  SELECT u.url, u.i, u.source_sent, c.sent AS fake, c.sent_no, len({tokens('c.sent')}) AS n
  FROM u7 u JOIN src_sents c ON c.url = u.url
  WHERE len({tokens('c.sent')}) BETWEEN 5 AND 40
    AND len({tokens('u.plagiat_sent')}) > 0
    AND CAST(len({tokens('u.plagiat_sent')}) AS DOUBLE) / len({tokens('c.sent')}) BETWEEN 0.5 AND 1.5
    AND c.sent <> u.source_sent
), cand_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY url, i ORDER BY n, sent_no) - 1 AS k,
         count(*) OVER (PARTITION BY url, i) AS cnt FROM cand
), pick AS (
  SELECT url, i, fake FROM cand_ranked
  WHERE k = ('0x' || substr(md5(concat_ws('|', '42', url, CAST(i AS VARCHAR))), 1, 15))::BIGINT % cnt
), with_fake AS (
  SELECT u.*, coalesce(p.fake, '') AS fake_source_sent FROM u7 u LEFT JOIN pick p ON p.url = u.url AND p.i = u.i
), measured AS (
  SELECT *, {bow_diff(tokens('plagiat_sent'), tokens('source_sent'))} AS bow_diff,
         CASE WHEN len({tokens('source_sent')}) = 0 THEN NULL
              ELSE CAST(len({tokens('plagiat_sent')}) AS DOUBLE) / len({tokens('source_sent')}) END AS nb_words_ratio
  FROM with_fake
), deduped AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY plagiat_sent, source_sent ORDER BY url, i) AS rn FROM measured
  ) WHERE rn = 1
), annotations AS (
  SELECT f.fragment_identifier || '_' || d.i AS annotation_identifier, d.url, d.plagiat_sent, d.source_sent,
         d.fake_source_sent, f.lang_source, f.lang_plagiat, f.type, d.nb_words_ratio, d.bow_diff
  FROM deduped d JOIN fragments f ON f.url = d.url
)"""
