"""DuckDB SQL for the queries that SQL can express."""

from headway.llm.reputation import SUFFIXES

_WORD = r"[^\x20\x09-\x0D]+"

# Documents numbered by r, with the words of the whole text.
_WORDED = f"""
d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, text, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '{_WORD}') AS ws FROM d)"""

_COUNTS = f"""{_WORDED},
grams AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS g FROM w, unnest(generate_series(1, len(ws) - 7)) AS x(i)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
repeated AS (SELECT r, count(DISTINCT i + j) AS n FROM again, generate_series(0, 7) AS y(j) GROUP BY r),
echoed AS (SELECT r, count(*) AS n FROM w, unnest(generate_series(2, len(ws))) AS x(i) WHERE ws[i] = ws[i - 1] GROUP BY r),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
          FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
c AS (SELECT d.r, doc_id, lang, source, len(ws) AS n_words,
             length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines,
             coalesce(repeated.n, 0) AS n_repeat_words, coalesce(echoed.n, 0) AS n_echo_words
      FROM d JOIN w USING (r) LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r) LEFT JOIN echoed USING (r)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             CASE WHEN n_words > 0 THEN word_chars * 100 // n_words END AS v_mean,
             CASE WHEN n_words > 0 THEN n_symbols * 1000 // n_words END AS v_symbols,
             CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines END AS v_dup,
             CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words END AS v_repeats,
             CASE WHEN n_words > 0 THEN n_echo_words * 1000 // n_words END AS v_echoes FROM c),
v AS (SELECT lang, source, unnest(['mean', 'symbols', 'dup', 'repeats', 'echoes']) AS ratio,
             unnest([v_mean, v_symbols, v_dup, v_repeats, v_echoes]) AS val FROM f WHERE NOT base_failed),
b AS (SELECT lang, source, ratio, CASE WHEN val < 16 THEN val
             ELSE (length(bin(val)) - 4) * 8 + (val >> (length(bin(val)) - 4)) END AS bin FROM v WHERE val IS NOT NULL),
sk AS (SELECT 0 AS level, lang, source, ratio, bin, count(*) AS n FROM b GROUP BY ALL
       UNION ALL SELECT 1, lang, NULL, ratio, bin, count(*) FROM b GROUP BY ALL
       UNION ALL SELECT 2, NULL, NULL, ratio, bin, count(*) FROM b GROUP BY ALL),
cum AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, ratio ORDER BY bin) AS upto,
               sum(n) OVER (PARTITION BY level, lang, source, ratio) AS total FROM sk),
q AS (SELECT level, lang, source, ratio, max(total) AS total, min(CASE WHEN 4 * upto >= total THEN bin END) AS b1,
             min(CASE WHEN 4 * upto >= 3 * total THEN bin END) AS b3 FROM cum GROUP BY level, lang, source, ratio),
e AS (SELECT level, lang, source, ratio, total,
             CASE WHEN b1 < 16 THEN b1 ELSE (8 + b1 % 8) * CAST(pow(2, b1 // 8 - 1) AS BIGINT) END AS low,
             CASE WHEN b3 < 16 THEN b3 ELSE (9 + b3 % 8) * CAST(pow(2, b3 // 8 - 1) AS BIGINT) - 1 END AS high FROM q),
l AS (SELECT level, lang, source, max(total) AS total,
             max(CASE WHEN ratio = 'mean' THEN low - greatest(3 * (high - low), 200) END) AS least_mean,
             max(CASE WHEN ratio = 'mean' THEN high + greatest(3 * (high - low), 400) END) AS most_mean,
             max(CASE WHEN ratio = 'symbols' THEN high + greatest(3 * (high - low), 150) END) AS most_symbols,
             max(CASE WHEN ratio = 'dup' THEN high + greatest(3 * (high - low), 400) END) AS most_dup,
             max(CASE WHEN ratio = 'repeats' THEN high + greatest(3 * (high - low), 300) END) AS most_repeats,
             max(CASE WHEN ratio = 'echoes' THEN high + greatest(3 * (high - low), 150) END) AS most_echoes
      FROM e GROUP BY level, lang, source),
judged AS (SELECT f.*, NOT base_failed AND coalesce(v_mean BETWEEN least_mean AND most_mean, true)
             AND coalesce(v_symbols <= most_symbols, true) AND coalesce(v_dup <= most_dup, true)
             AND coalesce(v_repeats <= most_repeats, true) AND coalesce(v_echoes <= most_echoes, true) AS kept
      FROM f LEFT JOIN (SELECT a.lang AS gl, a.source AS gs, x.* EXCLUDE (level, lang, source, total)
                        FROM (SELECT * FROM l WHERE level = 0) a
                        JOIN (SELECT * FROM l WHERE level = 1) g ON a.lang IS NOT DISTINCT FROM g.lang
                        JOIN (SELECT * FROM l WHERE level = 2) z ON true
                        JOIN l x ON x.level = CASE WHEN a.total >= 200 THEN 0 WHEN g.total >= 200 THEN 1 ELSE 2 END
                          AND (x.level = 2 OR x.lang IS NOT DISTINCT FROM a.lang) AND (x.level > 0 OR x.source IS NOT DISTINCT FROM a.source)
                       ) ON f.lang IS NOT DISTINCT FROM gl AND f.source IS NOT DISTINCT FROM gs)"""

QUALITY = f"""WITH {_COUNTS}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"""

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lowered(column: str) -> str:
    return f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


_HITS = f"""
dw AS (SELECT row_number() OVER () AS r, doc_id, text, regexp_extract_all({_lowered('text')}, '{_ALNUM}') AS ws FROM {{documents}}),
iw AS (SELECT item_id, regexp_extract_all({_lowered('text')}, '{_ALNUM}') AS ws FROM benchmark),
sought AS (SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS g
           FROM iw, unnest(generate_series(1, len(ws) - least(len(ws), 13) + 1)) AS x(i) WHERE len(ws) > 0),
lens AS (SELECT DISTINCT n FROM sought),
seen AS (SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g FROM dw, lens, unnest(generate_series(1, len(ws) - n + 1)) AS x(i)),
hits AS (SELECT r, n, i, item_id FROM seen JOIN sought USING (n, g)),
hit_words AS (SELECT r, count(DISTINCT i + j) AS n_hit FROM hits, unnest(generate_series(0, n - 1)) AS y(j) GROUP BY r),
hit_items AS (SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hits GROUP BY r),
clean AS (SELECT r, doc_id, text, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
                 sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
                 coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
          FROM dw LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r))"""

DECONTAMINATION = f"""WITH {_HITS.replace('{documents}', 'documents')}
SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM clean"""

TEMPLATES = f"""WITH d AS (SELECT DISTINCT doc_id, text FROM documents),
k AS (SELECT row_number() OVER (ORDER BY doc_id, text) AS r, doc_id, text, string_split(text, chr(10)) AS ls FROM d),
raw AS (SELECT r, i AS spot, ls[i] AS line, regexp_extract_all(ls[i], '{_WORD}') AS ws FROM k, unnest(generate_series(1, len(ls))) AS x(i)),
l AS (SELECT r, spot, line, list_transform(ws, lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END) AS ts FROM raw WHERE len(ws) > 0),
e AS (SELECT *, len(ts) || ' ' || array_to_string(ts[1:3], ' ') AS leaf FROM l),
kinds AS (SELECT leaf, line, any_value(ts) AS ts, count(*) AS n FROM e GROUP BY leaf, line),
top AS (SELECT leaf, place, CASE WHEN 2 * n >= total THEN token END AS token
        FROM (SELECT leaf, place, token, sum(n) AS n,
                     row_number() OVER (PARTITION BY leaf, place ORDER BY sum(n) DESC, token DESC) AS rank,
                     sum(sum(n)) OVER (PARTITION BY leaf, place) AS total
              FROM (SELECT leaf, n, unnest(ts) AS token, generate_subscripts(ts, 1) AS place FROM kinds) GROUP BY leaf, place, token) WHERE rank = 1),
agreed AS (SELECT leaf, line, len(ts) AS size, count(*) FILTER (WHERE u.token = top.token) AS same
           FROM (SELECT leaf, line, ts, unnest(ts) AS token, generate_subscripts(ts, 1) AS place FROM kinds) u JOIN top USING (leaf, place)
           GROUP BY leaf, line, len(ts)),
rest AS (SELECT leaf, line, unnest(ts) AS token, generate_subscripts(ts, 1) AS place FROM kinds JOIN agreed USING (leaf, line) WHERE 10 * same < 6 * size),
constants AS (SELECT leaf, place, token FROM rest GROUP BY leaf, place, token HAVING count(*) >= 5),
held AS (SELECT leaf, line, list(place || ' ' || token ORDER BY place) AS shape FROM rest JOIN constants USING (leaf, place, token) GROUP BY leaf, line),
assigned AS (SELECT leaf, line, CASE WHEN 10 * same >= 6 * size THEN leaf WHEN 10 * len(shape) >= 6 * size THEN leaf || repeat(chr(10), 2) || array_to_string(shape, ' ')
                    ELSE leaf || chr(10) || line END AS template FROM agreed LEFT JOIN held USING (leaf, line)),
spread AS (SELECT template, min(r) AS keeper FROM e JOIN assigned USING (leaf, line) GROUP BY template HAVING count(DISTINCT r) >= 5),
gone AS (SELECT DISTINCT r, spot FROM e JOIN assigned USING (leaf, line) JOIN spread USING (template) WHERE r != keeper),
listed AS (SELECT r, list(spot) AS gone FROM gone GROUP BY r)
SELECT doc_id, CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_filter(ls, lambda x, i: NOT list_contains(gone, i)), chr(10)) END AS text,
       coalesce(len(ls), 0) AS n_lines, coalesce(len(gone), 0) AS n_dropped
FROM documents JOIN k USING (doc_id, text) LEFT JOIN listed USING (r)"""


def jaccard(n: int, num: int, den: int, documents: str) -> str:
    """Tables up to jaccard_components(r, component) of documents numbered in jaccard_rows."""
    return f"""
jaccard_rows AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_lowered('text')}, '{_WORD}') AS ws FROM {documents}),
grams AS (SELECT DISTINCT r, array_to_string(ws[i:i + least(len(ws), {n}) - 1], ' ') AS g
          FROM jaccard_rows, unnest(generate_series(1, len(ws) - least(len(ws), {n}) + 1)) AS x(i) WHERE len(ws) > 0),
sizes AS (SELECT r, count(*) AS size FROM grams GROUP BY r),
links AS (SELECT a.r AS r, b.r AS s FROM grams a JOIN grams b ON a.g = b.g AND a.r != b.r
          JOIN sizes x ON x.r = a.r JOIN sizes y ON y.r = b.r
          GROUP BY a.r, b.r, x.size, y.size HAVING {den} * count(*) >= {num} * (x.size + y.size - count(*))),
reached(r, s) AS (SELECT r, r FROM jaccard_rows UNION SELECT reached.r, links.s FROM reached JOIN links ON links.r = reached.s),
jaccard_components AS (SELECT reached.r, min(o.doc_id) AS component_id FROM reached JOIN jaccard_rows o ON o.r = reached.s GROUP BY reached.r)"""


JACCARD = f"""WITH RECURSIVE {jaccard(3, 90, 100, 'documents')}
SELECT doc_id, coalesce(size, 0) AS n_shingles, component_id
FROM jaccard_rows JOIN jaccard_components USING (r) LEFT JOIN sizes USING (r)"""

# Words by their crc32, from the table of its 256 byte steps.
_CRC32 = f"""
step(i, c, k) AS (SELECT i, i, 0 FROM range(256) AS x(i)
                  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8),
steps AS (SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8),
rw AS (SELECT row_number() OVER () AS r, doc_id, text, regexp_extract_all({_lowered('text')}, '{_ALNUM}') AS ws FROM documents),
tw AS (SELECT regexp_extract_all({_lowered('text')}, '{_ALNUM}') AS ws FROM benchmark),
sources AS (SELECT r, unnest(ws) AS w FROM rw),
targets AS (SELECT unnest(ws) AS w FROM tw),
crc AS (SELECT w, xor(list_reduce(list_concat([4294967295], list_transform(generate_series(1, strlen(w)), lambda i: CAST('0x' || substr(hex(w), 2 * i - 1, 2) AS BIGINT))),
                                  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
        FROM (SELECT w FROM sources UNION SELECT w FROM targets), steps)"""

RESAMPLE = f"""WITH RECURSIVE {_CRC32},
s AS (SELECT bucket, count(*) AS n FROM sources JOIN crc USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM targets JOIN crc USING (w) GROUP BY bucket),
every AS (SELECT CAST((SELECT count(*) FROM sources) AS DOUBLE) AS s_all, CAST((SELECT count(*) FROM targets) AS DOUBLE) AS t_all),
gain AS (SELECT s.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0)::DOUBLE + 1) * (s_all + 10000) / ((s.n::DOUBLE + 1) * (t_all + 10000)))) AS BIGINT) AS gain
         FROM s LEFT JOIN t USING (bucket), every),
w AS (SELECT r, sum(gain) AS weight FROM sources JOIN crc USING (w) JOIN gain USING (bucket) GROUP BY r),
d AS (SELECT r, doc_id, text, CAST(len(ws) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
             CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM rw LEFT JOIN w USING (r)),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM d),
placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, text) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM scored LEFT JOIN placed USING (r)"""

_SUFFIXES = "', '".join(SUFFIXES)


def _levelled(level: str, keys: str, parents: str) -> str:
    """Tables {level}_k (correlation) and {level}_p (posterior) of {level}_n(keys, n, bad, prior)."""
    return f"""
{level}_n AS (SELECT {keys}, sum(n) AS n, sum(bad) AS bad, any_value(mean) AS prior, any_value(size) AS size FROM hosts JOIN {parents} GROUP BY {keys}),
{level}_k AS (SELECT 1 / least(0.5, greatest(0.001, coalesce((sum(n * (bad / n - prior) ** 2 / (prior * (1 - prior))) - count(*)) / nullif(sum(n) - count(*), 0), 0))) - 1 AS worth
              FROM {level}_n WHERE n > 0),
{level}_p AS (SELECT {keys}, least(worth, size) * prior + bad AS a, least(worth, size) * (1 - prior) + n - bad AS b, a / (a + b) AS mean, a + b AS size
              FROM {level}_n, {level}_k)"""


URL_FILTER = f"""WITH rules(blocks, rule, rule_host, rule_path) AS (VALUES (false, 'org/', 'org', '/'), (true, 'example.org/es/', 'example.org', '/es/'),
  (true, 'example.org/en/1', 'example.org', '/en/1'), (false, 'com/fr/', 'com', '/fr/'), (true, 'com/de/', 'com', '/de/')),
rest AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS x FROM pages),
p AS (SELECT r, page_id, coalesce(translate(regexp_extract(x, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
             coalesce(regexp_extract(x, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest),
fits AS (SELECT r, arg_max(rule, 1000 * length(rule) + length(rule_host)) AS rule, arg_max(blocks, 1000 * length(rule) + length(rule_host)) AS blocks
         FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY r),
j AS (SELECT p.*, rule, blocks FROM p LEFT JOIN fits USING (r)),
named AS (SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name, count(blocks)::DOUBLE AS n, coalesce(sum(blocks::INTEGER), 0)::DOUBLE AS bad FROM j GROUP BY host),
split AS (SELECT *, string_split(name, '.') AS ls, regexp_matches(name, '^[0-9.]+$|^\\[') AS literal FROM named),
hosts AS (SELECT host, n, bad, CASE WHEN literal THEN name WHEN two IN ('{_SUFFIXES}') THEN array_to_string(ls[-3:], '.') ELSE two END AS domain,
                 CASE WHEN literal THEN '' WHEN two IN ('{_SUFFIXES}') THEN two ELSE ls[-1] END AS suffix
          FROM (SELECT *, array_to_string(ls[-2:], '.') AS two FROM split)),
root AS (SELECT (sum(bad) + 1) / (sum(n) + 2) AS mean, sum(n) + 2 AS size FROM hosts),{_levelled('suffix', 'suffix', 'root ON true')},{_levelled('domain', 'domain, suffix', 'suffix_p USING (suffix)')},{_levelled('host', 'host', 'domain_p USING (domain, suffix)')}
SELECT page_id, j.host, path, rule,
       CASE WHEN coalesce(blocks, mean - sqrt(0.95::DOUBLE / 0.05::DOUBLE) * sqrt(a * b / ((a + b) ** 2 * (a + b + 1))) > 0.5) THEN 'block' ELSE 'allow' END AS verdict
FROM j JOIN host_p USING (host)"""

LEXICAL = f"""WITH dw AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_lowered('text')}, '{_ALNUM}') AS ws FROM documents),
iw AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all({_lowered('text')}, '{_ALNUM}') AS ws FROM (SELECT DISTINCT item_id, text FROM benchmark)),
every AS (SELECT count(*) FILTER (WHERE len(ws) > 0) AS n_docs, sum(len(ws)) AS n_words FROM dw),
sought AS (SELECT DISTINCT q, item_id, unnest(ws) AS t FROM iw),
tf AS (SELECT r, doc_id, t, n, count(*) AS tf FROM (SELECT r, doc_id, len(ws) AS n, unnest(ws) AS t FROM dw) GROUP BY r, doc_id, t, n),
df AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, every GROUP BY t, n_docs),
impact AS (SELECT r, doc_id, t, w * (1000000000 * tf // (1000 * tf + 8 * (100 - 90 + 90 * n * n_docs // n_words))) AS v FROM tf JOIN df USING (t), every),
scored AS (SELECT q, item_id, r, doc_id, CAST(sum(v) AS BIGINT) AS score FROM sought JOIN impact USING (t) GROUP BY q, item_id, r, doc_id HAVING sum(v) > 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM scored)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= 10"""
