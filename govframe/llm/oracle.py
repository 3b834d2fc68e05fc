"""DuckDB SQL for the registered queries that SQL can express, written from their contracts."""

from __future__ import annotations

from govframe.llm import url_filter

_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SPLIT = r"'[^\x20\x09-\x0D]+'"


def _listed(terms: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{t}'" for t in terms) + "]"


_URL = f"""
WITH u AS (
  SELECT page_id, url, strpos(url, '://') AS p FROM pages
), r AS (
  SELECT page_id, url, CASE WHEN p > 0 THEN substr(url, p + 3) ELSE '' END AS rest FROM u
), h AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), {_ASCII}) AS host,
         regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path
  FROM r
), m AS (
  SELECT page_id, url, coalesce(host, '') AS host, coalesce(path, '') AS path FROM h
), rules(verdict_, rhost, rpath) AS (VALUES {", ".join(f"('{x.verdict}', '{x.host}', '{x.path}')" for x in url_filter.CONTRACT_RULES)}),
best AS (
  SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(verdict_, length(rhost || rpath)) AS verdict_
  FROM m JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id
), vocabulary AS (
  SELECT term, max(strict) AS strict, max(weight) AS weight FROM (
    SELECT b || w || a AS term, 1 AS strict, 2.0::DOUBLE AS weight
    FROM (SELECT unnest({_listed(url_filter.STRICT)}) AS w), (SELECT unnest({_listed(("", *url_filter.BEFORE))}) AS b), (SELECT unnest({_listed(("", *url_filter.AFTER))}) AS a)
    UNION ALL SELECT unnest({_listed(url_filter.PHRASES)}), 1, 2.0
    UNION ALL SELECT w || a, 0, 1.0 FROM (SELECT unnest({_listed(url_filter.SOFT)}) AS w), (SELECT unnest({_listed(("", *url_filter.SOFT_AFTER))}) AS a)
    UNION ALL SELECT unnest({_listed(url_filter.WEAK)}), 0, 0.5
  ) GROUP BY term
), low AS (SELECT page_id, translate(coalesce(url, ''), {_ASCII}) AS low FROM pages),
found AS (
  SELECT page_id, term FROM (SELECT page_id, unnest(regexp_extract_all(low, '[a-z0-9]+')) AS term FROM low)
  UNION
  SELECT page_id, term FROM low, (SELECT unnest({_listed(url_filter.PHRASES)}) AS term) WHERE regexp_matches(low, '(^|[^a-z0-9])' || term || '($|[^a-z0-9])')
), s AS (
  SELECT page_id, list(term ORDER BY term) AS terms, sum(strict)::INT AS n_strict, sum(1 - strict)::INT AS n_soft, sum(weight)::DOUBLE AS score
  FROM found JOIN vocabulary USING (term) GROUP BY page_id
)
SELECT m.page_id, host, path, rule,
       coalesce(verdict_, CASE WHEN n_strict > 0 OR (n_soft >= 2 AND score >= 2) THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(terms, []) AS terms, coalesce(n_strict, 0) AS n_strict, coalesce(n_soft, 0) AS n_soft, coalesce(score, 0) AS score
FROM m LEFT JOIN best ON best.page_id = m.page_id LEFT JOIN s ON s.page_id = m.page_id
"""

_CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), r AS (
  SELECT conv_id, turn, role, text, length(text) + len(regexp_extract_all(text, '<\\*\|')) AS escaped
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(12 + length(role) + 2 * len(regexp_extract_all(role, '[%<' || chr(10) || ']')) + 1 + escaped + 11)::BIGINT AS formatted_chars
FROM r GROUP BY conv_id
"""

_WORD8 = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_DECONTAM = f"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, {_ASCII}), {_WORD8}), []) AS w FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item_id, coalesce(regexp_extract_all(translate(text, {_ASCII}), {_WORD8}), []) AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)
), hit AS (SELECT DISTINCT doc_id, i, dw.n, dw.win FROM dw JOIN (SELECT DISTINCT n, win FROM bw) x ON dw.n = x.n AND dw.win = x.win),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit JOIN bw ON hit.n = bw.n AND hit.win = bw.win) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_RULES = {
    "short": "n_words < 50", "repetitive": "100 * n_repeat_words > 50 * n_words", "symbols": "10 * n_symbols > 3 * n_words",
    "dup_lines": "2 * n_dup_lines > n_words", "word_length": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 25 * n_words)",
}
_RULES["any"] = " OR ".join(f"({c})" for c in _RULES.values())
_PRIOR = ", ".join(
    f"least(greatest(avg(f_{r} / n_docs), 1e-6), 1 - 1e-6) AS m_{r}, coalesce(var_samp(f_{r} / n_docs), 0) AS v_{r}" for r in _RULES
)
_SPREAD = {r: f"(v_{r} - m_{r} * (1 - m_{r}) * noise)" for r in _RULES}
_WEIGHT = ", ".join(f"least(greatest(CASE WHEN {_SPREAD[r]} > 0 THEN m_{r} * (1 - m_{r}) / {_SPREAD[r]} - 1 ELSE 1000 END, 2), 1000) AS k_{r}" for r in _RULES)
_QUALITY = f"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text, coalesce(regexp_extract_all(text, {_SPLIT}), []) AS w FROM documents
), grams AS (
  SELECT doc_id, i, array_to_string(w[i : i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 3)) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1
  ) GROUP BY doc_id
), m AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {_SPLIT})) AS l FROM w) LEFT JOIN rep USING (doc_id)
), h AS (
  SELECT source, count(*)::DOUBLE AS n_docs, {", ".join(f"count(*) FILTER ({c})::DOUBLE AS f_{r}" for r, c in _RULES.items())}
  FROM m WHERE source IS NOT NULL GROUP BY source
), p AS (SELECT {_PRIOR}, avg(1 / n_docs) AS noise FROM h),
k AS (SELECT *, {_WEIGHT} FROM p),
bad AS (
  SELECT source FROM h, k
  WHERE greatest({", ".join(f"(f_{r} + m_{r} * k_{r}) / (n_docs + k_{r})" for r in _RULES)}) >= 0.9
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({_RULES["short"]}) OR ({_RULES["repetitive"]}) AS base_failed,
       NOT (({_RULES["short"]}) OR ({_RULES["repetitive"]})) AND (source IS NULL OR source NOT IN (SELECT source FROM bad)) AS kept
FROM m
"""

_NEAR = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, {_ASCII}), {_SPLIT}), []) AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g, least(len(w), 5) AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM both_ JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
reach(doc_id, top) AS (
  SELECT doc_id, doc_id FROM d
  UNION SELECT y, top FROM reach JOIN link ON x = reach.doc_id WHERE y > top
)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(top) AS component_id, doc_id = min(top) AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id, n.n
"""

_PASSAGES = f"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, {_SPLIT}), []) AS w FROM documents),
x AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
f AS (SELECT h, min(doc_id) AS first FROM x GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM x JOIN f USING (h) WHERE first < doc_id),
g AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, string_agg(word, ' ' ORDER BY p) AS t
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) d LEFT JOIN gone USING (doc_id, p)
  WHERE gone.p IS NULL GROUP BY d.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_PHRASES = f"""
WITH t AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), {_ASCII}) AS text FROM documents
), p AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
  FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t)
), size AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
g AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (VALUES (1), (2), (3), (4)) ks(k) WHERE len(w) >= k)
), f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS (SELECT *, unnest(range(1, k)) AS j FROM c),
s AS (
  SELECT cut.lang, cut.phrase, cut.k, cut.a, j, x.f AS l, y.f AS r, (2000000::HUGEINT * cut.a) // (x.f + y.f) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(cut.w[1 : j], ' ')
  JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(cut.w[j + 1 : cut.k], ' ')
), low AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inside AS (
  SELECT DISTINCT b.lang, b.inner_, b.a
  FROM (SELECT lang, a, k, array_to_string(w[i : i + m - 1], ' ') AS inner_
        FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM c, (VALUES (2), (3)) ms(m) WHERE m < k)) b
), covered AS (SELECT lang, inner_ AS phrase, max(a) AS longest FROM inside GROUP BY ALL),
left_ AS (
  SELECT low.* FROM low LEFT JOIN covered USING (lang, phrase) WHERE longest IS NULL OR 100::HUGEINT * longest < 80::HUGEINT * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM left_ JOIN size USING (lang) QUALIFY rank <= 2000
"""

ORACLE = {"op1_url_filter": _URL, "op2_chat_format": _CHAT, "op4_minhash": _NEAR, "op8_decontaminate": _DECONTAM, "op9_host_quality": _QUALITY, "op10_passages": _PASSAGES, "op12_collocations": _PHRASES}
