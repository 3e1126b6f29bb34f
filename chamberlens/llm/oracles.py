"""SQL for the queries of this subpackage that a single-node engine can answer too."""

from __future__ import annotations

from chamberlens.llm.license_scan import (
    BREAKS,
    LEAD_IN,
    LICENCE_RULES,
    NOT_WORD,
    SENTENCES,
    SPDX,
    SPDX_EXCEPTION,
    SPDX_LATER,
    SPDX_NO_LICENCE,
    SPDX_ONLY,
    TITLE_WORDS,
    _END,
    _SPDX_ID,
    _row,
    cues,
)
from chamberlens.llm.url_filter import BAD_LIMIT, PAIRED_SUFFIXES, RULES, SIGMAS

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


DECONTAMINATION = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), phrase AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM item WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM phrase
), spot AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS words
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc CROSS JOIN sizes WHERE len(w) >= n)
), found AS (SELECT s.doc_id, s.n, s.p, f.item_id FROM spot s JOIN phrase f ON f.n = s.n AND f.words = s.words
), hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _rules(column: int) -> str:
    cases = []
    for verdict, written in sorted(RULES, key=lambda r: -len(r[1])):
        name, _, rest = written.partition("/")
        fits = f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{rest}')"
        cases.append(f"WHEN {fits} THEN '{(verdict, written)[column]}'")
    return f"CASE {' '.join(cases)} END"


_PAIRED = ", ".join(_text(s) for s in PAIRED_SUFFIXES)
_TAIL = "array_to_string(string_split({0}, '.')[-{1}:], '.')"
_SUFFIX = f"CASE WHEN {_TAIL.format('host', 2)} IN ({_PAIRED}) THEN {_TAIL.format('host', 2)} ELSE {_TAIL.format('host', 1)} END"
_DOMAIN = f"CASE WHEN {_TAIL.format('host', 2)} IN ({_PAIRED}) THEN {_TAIL.format('host', 3)} ELSE {_TAIL.format('host', 2)} END"


def _strength(groups: str) -> str:
    return f"""
  SELECT 1 / least(greatest(coalesce(CASE WHEN noise * (n - nn / n - (k - 1)) <> 0
         THEN (d - noise * (k - 1)) / (noise * (n - nn / n - (k - 1))) END, 0.001), 0.001), 0.5) - 1 AS strength
  FROM (SELECT any_value(p) * (1 - any_value(p)) AS noise, sum(n * (s / n - p) * (s / n - p)) AS d,
               CAST(sum(n) AS DOUBLE) AS n, CAST(sum(n * n) AS DOUBLE) AS nn, count(*) AS k
        FROM {groups}, overall WHERE n > 0)"""


URL_FILTER = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages
), page AS (
  SELECT page_id, {LOWER.format("regexp_extract(r, '^[^/?#]*')")} AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), outcome AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id
), trial AS (
  SELECT host, bad FROM page LEFT JOIN outcome
  ON doc_id = TRY_CAST(nullif(regexp_extract(path, '^/[^/]+/([0-9]{{1,18}})', 1), '') AS BIGINT)
), hosts AS (
  SELECT host, {_DOMAIN} AS domain, {_SUFFIX} AS suffix, count(bad) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS s
  FROM trial GROUP BY host
), domains AS (SELECT domain, suffix, sum(n) AS n, sum(s) AS s FROM hosts GROUP BY domain, suffix
), suffixes AS (SELECT suffix, sum(n) AS n, sum(s) AS s FROM hosts GROUP BY suffix
), overall AS (SELECT coalesce((sum(s) + 0.5) / (sum(n) + 1.0), 0.5) AS p FROM hosts
), kh AS ({_strength("hosts")}), kd AS ({_strength("domains")}), ks AS ({_strength("suffixes")}
), by_suffix AS (SELECT suffix, (s + strength * p) / (n + strength) AS prior FROM suffixes, overall, ks
), by_domain AS (
  SELECT d.domain, d.suffix, (d.s + strength * prior) / (d.n + strength) AS prior
  FROM domains d JOIN by_suffix b ON b.suffix = d.suffix, kd
), judged AS (
  SELECT h.host, (h.s + strength * prior) / (h.n + strength) AS m, h.n + strength AS size
  FROM hosts h JOIN by_domain b ON b.domain = h.domain AND b.suffix = h.suffix, kh
), blocked AS (SELECT host FROM judged WHERE m - {SIGMAS} * sqrt(m * (1 - m) / (size + 1)) > {BAD_LIMIT})
SELECT page_id, host, path, {_rules(1)} AS rule,
       coalesce({_rules(0)}, CASE WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM page
"""


def _escaped(column: str) -> str:
    return f"replace(replace(replace({column}, '\\', '\\\\'), '<', '<\\'), '[', '[\\')"


CHAT_FORMAT = f"""
WITH told AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), joined AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length({_escaped("role")}) + length({_escaped("text")}) + {len("<|im_start|><|im_sep|><|im_end|>")}) AS formatted_chars
  FROM told GROUP BY conv_id
)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM joined
"""


def _license_sql() -> str:
    """The operator's rules as joins: a known sentence fits at a line if the sentence's words
    up to that line end with it and it begins near the start of a line."""
    longest_first = sorted(SENTENCES.items(), key=lambda x: -len(x[1]))
    known = ", ".join(
        f"({_text(' ' + s)}, {_text(i)}, {at}, {LEAD_IN if s.count(' ') >= TITLE_WORDS else 0})" for at, (i, s) in enumerate(longest_first)
    )
    text = f"replace(coalesce(text, ''), {_text(_END)}, ' ')"
    for pattern, by in BREAKS:
        text = f"regexp_replace({text}, {_text(pattern)}, {_text(by.format('', chr(92) + '1', chr(92) + '2'))}, 'g')"
    steps, last = [], "r0"
    for i, (name, sequence) in enumerate(LICENCE_RULES, 1):
        row = _text(_row(sequence))
        steps.append(
            f"r{i} AS (SELECT doc_id, ids, replace(left_over, {row}, '|') AS left_over, "
            f"CASE WHEN contains(left_over, {row}) AND NOT list_contains(names, {_text(name)}) "
            f"THEN list_append(names, {_text(name)}) ELSE names END AS names FROM {last})"
        )
        last = f"r{i}"
    names = sorted({name for name, _ in LICENCE_RULES})
    spelling = "map([" + ", ".join(_text(n.lower()) for n in names) + "], [" + ", ".join(map(_text, names)) + "])"
    no_licence = ", ".join(map(_text, SPDX_NO_LICENCE))
    current = rf"regexp_replace(regexp_replace(i, {_text(SPDX_LATER)}, '\1-or-later'), {_text(SPDX_ONLY)}, '\1-only')"
    return f"""
WITH RECURSIVE cut AS (SELECT doc_id, string_split({text}, {_text(_END)}) AS pieces FROM documents
), piece AS (SELECT doc_id, unnest(pieces) AS sentence, generate_subscripts(pieces, 1) AS place FROM cut
), likely AS (SELECT * FROM piece WHERE regexp_matches(lower(sentence), {_text(cues(SENTENCES))})
), written AS (
  SELECT doc_id, place, unnest(string_split(sentence, chr(10))) AS raw, generate_subscripts(string_split(sentence, chr(10)), 1) AS spot FROM likely
), line AS (
  SELECT doc_id, place, ' ' || trim(regexp_replace(lower(raw), {_text(NOT_WORD)}, ' ', 'g')) AS words, spot
  FROM written WHERE trim(regexp_replace(lower(raw), {_text(NOT_WORD)}, ' ', 'g')) <> ''
), run AS (
  SELECT doc_id, place, row_number() OVER w AS j, string_agg(words, '') OVER w AS words, sum(length(words)) OVER w AS ends, length(words) AS size
  FROM line WINDOW w AS (PARTITION BY doc_id, place ORDER BY spot)
), known(words, id, nth, room) AS (VALUES {known}
), fits AS (
  SELECT r.doc_id, r.place, r.j, id, nth, b.j AS begins FROM run r JOIN known k ON ends_with(r.words, k.words)
  JOIN run b ON b.doc_id = r.doc_id AND b.place = r.place AND b.j <= r.j AND b.ends - b.size <= r.ends - length(k.words)
   AND b.ends > r.ends - length(k.words) AND r.ends - length(k.words) - (b.ends - b.size) <= room
), hit AS (SELECT doc_id, place, j, arg_min(id, nth) AS id, arg_min(begins, nth) AS begins FROM fits GROUP BY ALL
), earlier AS (
  SELECT h.doc_id, h.place, h.j, max(g.j) AS before FROM hit h JOIN hit g ON g.doc_id = h.doc_id AND g.place = h.place AND g.j < h.begins GROUP BY ALL
), chosen(doc_id, place, j) AS (
  SELECT doc_id, place, max(j) FROM hit GROUP BY ALL
  UNION ALL SELECT c.doc_id, c.place, e.before FROM chosen c JOIN earlier e ON e.doc_id = c.doc_id AND e.place = c.place AND e.j = c.j
), listed AS (
  SELECT doc_id, string_agg(id, ',' ORDER BY place, j) AS ids, '|' || string_agg('<' || id || '>', '' ORDER BY place, j) || '|' AS left_over
  FROM chosen JOIN hit USING (doc_id, place, j) GROUP BY doc_id
), r0 AS (SELECT doc_id, ids, left_over, CAST([] AS VARCHAR[]) AS names FROM listed
), {", ".join(steps)}
, tagged AS (
  SELECT doc_id, list_transform(list_filter(flatten(list_transform(regexp_extract_all(coalesce(text, ''), {_text(SPDX)}, 1),
         lambda e: regexp_extract_all(regexp_replace(e, {_text(SPDX_EXCEPTION)}, '', 'g'), {_text(_SPDX_ID)}))),
         lambda i: i NOT IN ({no_licence})), lambda i: coalesce({spelling}[lower({current})], {current})) AS spdx
  FROM documents
), named AS (
  SELECT d.doc_id, ids, left_over, list_concat(coalesce(names, CAST([] AS VARCHAR[])), spdx) AS names
  FROM documents d LEFT JOIN {last} ON {last}.doc_id = d.doc_id JOIN tagged t ON t.doc_id = d.doc_id
)
SELECT doc_id, CAST(coalesce(len(string_split(ids, ',')), 0) AS BIGINT) AS n_sentences, coalesce(ids, '') AS sentence_ids,
       array_to_string(list_filter(names, lambda x, i: list_position(names, x) = i), ',') AS licenses,
       CAST(coalesce(length(left_over) - length(replace(left_over, '<', '')), 0) AS BIGINT) AS n_unexplained
FROM named
"""


NEAR_DEDUP = rf"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM doc WHERE len(w) > 0)
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT x, y FROM common JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM doc UNION SELECT r.doc_id, l.y FROM reach r JOIN link l ON l.x = r.other
), least_id AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM doc d JOIN least_id USING (doc_id) LEFT JOIN size USING (doc_id)
"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LINE_DEDUP = f"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents
), keyed AS (SELECT doc_id, place, line, {LOWER.format(f"trim(line, {_BLANKS})")} AS key FROM line
), shared AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (SELECT k.doc_id, place, line, first IS NOT NULL AND first <> k.doc_id AS gone FROM keyed k LEFT JOIN shared s ON s.key = k.key)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
), placed AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 20
"""

_CRC_STEP = "list_reduce(range(8), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)), xor(crc, b))"
_CRC = f"xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda crc, b: {_CRC_STEP}, 4294967295::BIGINT), 4294967295)"
PREFIX_TRIE = rf"""
WITH conv AS (
  SELECT conv_id, {_CRC} % 4 AS h,
         list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), rebuilt AS (
  SELECT c.conv_id, list_concat(CASE WHEN c.h > 0 THEN b.turns[1:c.h] END, c.turns[c.h + 1:]) AS path
  FROM conv c LEFT JOIN conv b ON b.conv_id = c.conv_id - c.conv_id % 20
), member AS (
  SELECT conv_id, d, CASE WHEN d > 0 THEN path[1:d] ELSE [] END AS prefix, d = len(path) AS ends,
         CASE WHEN d > 0 THEN len(regexp_extract_all(path[d].text, '[^ 	-
]+')) ELSE 0 END AS words
  FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)
), node AS (
  SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends
  FROM member GROUP BY prefix, d
), family AS (
  SELECT CASE WHEN d > 1 THEN prefix[1:d - 1] ELSE [] END AS prefix, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL
), subtree AS (
  SELECT CASE WHEN k > 0 THEN prefix[1:k] ELSE [] END AS prefix, count(*) FILTER (WHERE leaf) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT n.prefix, f.prefix IS NULL AS leaf, (n_convs - 1) * words AS saved, unnest(range(0, d + 1)) AS k
        FROM node n LEFT JOIN family f ON f.prefix = n.prefix) GROUP BY ALL
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
       CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM node n JOIN subtree s ON s.prefix = n.prefix LEFT JOIN family f ON f.prefix = n.prefix
LEFT JOIN node p ON p.d = n.d - 1 AND p.prefix = CASE WHEN n.d > 1 THEN n.prefix[1:n.d - 1] ELSE [] END
"""

LLM_ORACLES = {
    "op2_decontamination": DECONTAMINATION,
    "op3_url_filter": URL_FILTER,
    "op4_chat_format": CHAT_FORMAT,
    "op5_license_scan": _license_sql(),
    "op6_near_dedup": NEAR_DEDUP,
    "op7_line_dedup": LINE_DEDUP,
    "op10_top_k": TOP_K,
    "op13_prefix_trie": PREFIX_TRIE,
}
