"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from orderlens.llm.quality_rules import STOP_FORMS, STOP_LANGUAGES, SYMBOLS

_WORDS = r"'[^\x20\x09-\x0D]+'"

QUALITY_RULES = f"""
WITH rows AS (SELECT row_number() OVER () r, doc_id, lang, coalesce(text, '') t FROM documents),
cut AS (
    SELECT r, doc_id, lang, t, regexp_extract_all(t, {_WORDS}) ws,
           [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, {_WORDS})] ls
    FROM rows
),
windows AS (
    SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] || ' ' || ws[i + 4] g
    FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) i FROM cut)
),
repeated AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, count(DISTINCT p) n FROM (SELECT r, unnest(range(i, i + 5)) p FROM repeated) GROUP BY r),
counts AS (
    SELECT c.doc_id, c.lang, len(ws)::BIGINT n_words,
           length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT word_chars,
           length(regexp_replace(t, '[^{SYMBOLS}]+', '', 'g'))::BIGINT n_symbols,
           (len(ls) - len(list_distinct(ls)))::BIGINT n_dup_lines,
           coalesce(v.n, 0)::BIGINT n_repeat_words,
           len(ls)::BIGINT n_lines,
           len([x FOR x IN ws IF x IN ({", ".join(f"'{w}'" for w in STOP_FORMS)})])::BIGINT n_stop_words
    FROM cut c LEFT JOIN covered v ON c.r = v.r
),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts)
SELECT * EXCLUDE (lang), NOT base_failed
    AND word_chars >= 2 * n_words AND word_chars <= 15 * n_words
    AND 10 * n_symbols <= n_words
    AND (50 * n_stop_words >= n_words OR n_words < 20 OR coalesce(lang NOT IN {STOP_LANGUAGES}, false))
    AND 2 * n_dup_lines <= n_lines AS kept
FROM judged
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BENCH_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH docs AS (SELECT row_number() OVER () r, doc_id, {_BENCH_WORDS} ws FROM documents),
items AS (SELECT item_id, {_BENCH_WORDS} ws FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, size, array_to_string(ws[i:i + size - 1], ' ') g
    FROM (SELECT item_id, ws, least(13, len(ws)) size, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) i
          FROM items WHERE len(ws) > 0)
),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT r, size, i, array_to_string(ws[i:i + size - 1], ' ') g
    FROM (SELECT r, ws, size, unnest(range(1, len(ws) - size + 2)) i FROM docs, sizes)
),
hits AS (SELECT p.r, p.size, p.i, w.item_id FROM places p JOIN windows w ON p.size = w.size AND p.g = w.g),
words AS (SELECT r, count(DISTINCT p) n FROM (SELECT r, unnest(range(i, i + size)) p FROM hits) GROUP BY r),
found AS (
    SELECT r, count(*) n, string_agg(item, ',' ORDER BY item) ids
    FROM (SELECT DISTINCT r, item_id::VARCHAR item FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT d.doc_id, len(ws)::BIGINT n_words, coalesce(w.n, 0)::BIGINT n_hit, coalesce(f.n, 0)::BIGINT n_items,
       sha256(coalesce(f.ids, '')) items_sha256,
       coalesce(w.n, 0) > 0 AND 20 * coalesce(w.n, 0) >= len(ws) contaminated
FROM docs d LEFT JOIN words w ON d.r = w.r LEFT JOIN found f ON d.r = f.r
"""


REVISITS = """
WITH p AS (
    SELECT coalesce(page_id, 0) pid, coalesce(url, '') url, coalesce(html, '') html,
           TIMESTAMP '2024-01-01' + to_minutes(coalesce(page_id, 0)) AS first,
           regexp_extract(coalesce(url, ''), '^[a-z]+://([^/]*)', 1) site, lpad(coalesce(page_id, 0)::VARCHAR, 12, '0') num
    FROM pages
),
-- every full response, by its URL as it stands
captures AS (
    SELECT pid, url AS raw, 'page0-' || num record_id, first AS captured, html || '<!-- 0 -->' body FROM p WHERE pid % 4 IN (1, 2)
    UNION ALL
    SELECT pid, url, 'page1-' || num, first + (CASE WHEN pid % 3 = 0 THEN INTERVAL 7 DAY ELSE INTERVAL 4 DAY END), html || '<!-- 1 -->'
    FROM p WHERE pid % 4 = 2
    UNION ALL
    SELECT pid, url, 'page2-' || num, first + INTERVAL 8 DAY, html || '<!-- 2 -->' FROM p WHERE pid % 4 = 3
    UNION ALL
    SELECT pid, 'https://' || site || '/', 'site-' || num, first, 'site ' || site || ' of day ' || (pid // 1440) FROM p
),
sent AS (
    SELECT pid, url AS raw, 'page-' || num record_id, first,
           html || CASE WHEN pid % 4 = 2 AND pid % 3 <> 0 AND pid % 5 <> 4 THEN '<!-- 1 -->' ELSE '<!-- 0 -->' END body, true AS page
    FROM p
    UNION ALL
    SELECT pid, 'https://' || site || '/', 'site-' || num, first, 'site ' || site || ' of day ' || (pid // 1440), false FROM p
),
raws AS (
    SELECT raw, regexp_replace(trim(raw), '#.*$', '') bare FROM (SELECT raw FROM captures UNION SELECT raw FROM sent)
),
parts AS (
    SELECT raw, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?]*@)?([^/?]*)', 1)), ':(80|443)$', ''), '^www\\.', '') host,
           regexp_replace(regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '') path,
           list_sort([x FOR x IN string_split(regexp_extract(bare, '\\?(.*)$', 1), '&')
                      IF x <> '' AND NOT regexp_matches(lower(x), '^(utm_[a-z]+|gclid|fbclid|ref)(=|$)')]) params
    FROM raws
),
urls AS (
    SELECT raw, CASE WHEN host <> '' THEN
               'https://' || host || path || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS url
    FROM parts
),
full_ AS (
    SELECT u.url, c.captured, c.record_id, sha1(c.body) payload_sha1, strlen(c.body) size,
           CASE WHEN c.pid % 7 <> 3 THEN '"' || substr(md5(c.body), 1, 16) || '"' END etag,
           CASE WHEN c.pid % 11 <> 5 THEN strftime(c.captured, '%a, %d %b %Y %H:%M:%S GMT') END modified
    FROM captures c JOIN urls u ON c.raw = u.raw
),
again AS (
    SELECT u.url, s.first + INTERVAL 7 DAY AS captured, s.record_id, s.pid,
           CASE WHEN s.page AND s.pid % 7 <> 3 AND s.pid % 5 <> 1 THEN
                    CASE WHEN s.pid % 5 = 0 THEN '"stale-' ELSE 'W/"' END || substr(md5(s.body), 1, 16) || '"'
                WHEN NOT s.page AND s.pid % 2 = 0 THEN '"' || substr(md5(s.body), 1, 16) || '"' END etag,
           CASE WHEN s.pid % 5 = 1 THEN strftime(s.first, '%a, %d %b %Y %H:%M:%S GMT') END modified
    FROM sent s JOIN urls u ON s.raw = u.raw
),
matched AS (
    SELECT a.*, f.record_id response_id, f.etag f_etag, f.modified f_modified, f.size, f.payload_sha1 f_sha1,
           row_number() OVER (PARTITION BY a.record_id ORDER BY f.captured DESC, f.record_id DESC) place
    FROM again a LEFT JOIN full_ f ON a.url = f.url AND f.captured < a.captured
),
judged AS (
    SELECT *, CASE
        WHEN response_id IS NULL THEN 'no_earlier'
        WHEN etag IS NOT NULL THEN CASE WHEN replace(etag, 'W/', '') IS NOT DISTINCT FROM f_etag THEN 'resolved' ELSE 'mismatch' END
        WHEN modified IS NOT NULL THEN CASE WHEN modified IS NOT DISTINCT FROM f_modified THEN 'resolved' ELSE 'mismatch' END
        WHEN f_etag IS NULL AND f_modified IS NULL THEN 'resolved' ELSE 'no_validator' END AS status
    FROM matched WHERE place = 1
)
SELECT record_id, url, status,
       CASE WHEN status = 'resolved' THEN response_id END response_id,
       CASE WHEN status = 'resolved' THEN concat_ws(chr(10), 'cache-control: max-age=' || pid, 'content-length: ' || size,
            'content-type: text/html', 'date: ' || strftime(captured, '%a, %d %b %Y %H:%M:%S GMT'),
            'etag: ' || coalesce(etag, f_etag), 'last-modified: ' || coalesce(modified, f_modified)) END headers,
       CASE WHEN status = 'resolved' THEN f_sha1 END payload_sha1
FROM judged
"""

CHAT = """
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
logs AS (
    SELECT conv_id, list({'r': role, 't': text} ORDER BY turn, role, text) l, count(*) n FROM turns GROUP BY conv_id
),
proper AS (SELECT DISTINCT l[1:k] l FROM (SELECT l, unnest(range(1, n)) k FROM logs)),
maximal AS (
    SELECT min(conv_id) conv_id, l, any_value(n) n, count(*) copies FROM logs
    WHERE NOT EXISTS (SELECT 1 FROM proper p WHERE p.l = logs.l) GROUP BY l
),
pieces AS (SELECT conv_id, n, copies, unnest(range(1, n + 1)) k, unnest(l) x FROM maximal)
SELECT conv_id, n::BIGINT n_turns, copies::BIGINT n_copies, ((k - 1) // 512)::BIGINT part,
       string_agg('<|im_start|>' || replace(coalesce(x.r, 'unknown'), '<|', '< |') || chr(10) || replace(coalesce(x.t, ''), '<|', '< |')
                  || '<|im_end|>' || chr(10), '' ORDER BY k) rendered
FROM pieces GROUP BY ALL
"""


COLLOCATIONS = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') lang,
           unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^.,;:!?\x0A-\x0D]+')) piece
    FROM documents
),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') ws FROM pieces),
grams AS (
    SELECT lang, k, p, count(*) a
    FROM (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') p
          FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) i FROM cut, (VALUES (1), (2), (3), (4)) v(k)))
    GROUP BY ALL
),
often AS (SELECT *, string_split(p, ' ') ws FROM grams WHERE k > 1 AND a >= 30),
known AS (SELECT lang, p, a FROM grams WHERE a >= 30),
cuts AS (
    SELECT o.lang, o.p, o.k, o.a, j, f.a l, g.a r, 2000000 * o.a::HUGEINT // (f.a + g.a) score
    FROM (SELECT *, array_to_string(ws[:j], ' ') head, array_to_string(ws[j + 1:], ' ') rest
          FROM (SELECT *, unnest(range(1, k)) j FROM often)) o
    JOIN known f ON o.lang = f.lang AND o.head = f.p JOIN known g ON o.lang = g.lang AND o.rest = g.p
),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
inside AS (
    SELECT lang, array_to_string(ws[i:i + n - 1], ' ') p, max(a) longer
    FROM (SELECT lang, ws, a, n, unnest(range(1, k - n + 2)) i FROM often, (VALUES (2), (3)) v(n) WHERE n < k) GROUP BY ALL
),
kept AS (
    SELECT c.* FROM lowest c LEFT JOIN inside i ON c.lang = i.lang AND c.p = i.p
    WHERE i.longer IS NULL OR 100 * i.longer < 80 * c.a
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) place FROM kept),
sizes AS (SELECT lang, sum(len(ws))::BIGINT n FROM cut GROUP BY lang)
SELECT r.lang, place::BIGINT AS rank, p AS phrase, a::BIGINT a, l::BIGINT l, r::BIGINT r, n, score::BIGINT score
FROM ranked r JOIN sizes s ON r.lang = s.lang WHERE place <= 2000
"""


def oracle() -> dict[str, str]:
    return {
        "op5_revisits": REVISITS,
        "op6_quality_rules": QUALITY_RULES,
        "op7_decontamination": DECONTAMINATION,
        "op9_chat": CHAT,
        "op11_collocations": COLLOCATIONS,
    }
