"""The text queries once more, as SQL over the same tables."""

ORACLES: dict[str, str] = {}

ORACLES["op4_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
w AS (
  SELECT rid, doc_id, text,
         list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(text, chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d),
pos AS (
  SELECT rid, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM w),
win AS (
  SELECT rid, i,
         string_agg(word, ' ') OVER s AS g, count(*) OVER s AS n
  FROM pos WINDOW s AS (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
twice AS (
  SELECT rid, i FROM (
    SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win WHERE n = 8) x
  WHERE c > 1),
steps AS (
  SELECT rid, least(8, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 8)) AS step
  FROM twice),
rep AS (SELECT rid, sum(step) AS n FROM steps GROUP BY rid),
stut AS (
  SELECT rid, count(*) FILTER (WHERE word = before) AS n FROM (
    SELECT rid, word, lag(word) OVER (PARTITION BY rid ORDER BY i) AS before FROM pos) x
  GROUP BY rid),
f AS (
  SELECT w.rid, doc_id, text, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         len(l) AS n_lines, coalesce(stut.n, 0) AS n_stutter,
         length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) AS n_upper,
         length(text) - length(regexp_replace(text, '\p{L}', '', 'g')) AS n_letters
  FROM w LEFT JOIN rep USING (rid) LEFT JOIN stut USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR n_symbols * 10 > n_words
            OR 1 - (n_lines - n_dup_lines)::DOUBLE / greatest(n_lines, 1) > 0.4
            OR n_stutter::DOUBLE / greatest(n_words, 1) > 0.2
            OR 2 * n_upper > greatest(n_letters, 1)) AS kept
FROM f
"""

ORACLES["op3_url_rules"] = r"""
WITH rules(rhost, rpath, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
p AS (
  SELECT row_number() OVER () AS rid, page_id,
         coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
best AS (
  SELECT rid, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY rid ORDER BY length(rhost || rpath) DESC,
           length(rhost) DESC, verdict DESC) AS k
  FROM p JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM best WHERE k = 1) b USING (rid)
"""

ORACLES["op6_chat"] = r"""
WITH RECURSIVE m AS (
  SELECT row_number() OVER () AS rid, conv_id, turn, coalesce(role, 'unknown') AS role,
         coalesce(text, '') AS text
  FROM conversations),
lines AS (
  SELECT rid, conv_id, turn, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line
  FROM (SELECT *, string_split(text, chr(10)) AS l FROM m) x),
parsed AS (
  SELECT *, length(regexp_replace(regexp_extract(line, '^\s*((?:>\s*)+)', 1), '[^>]', '', 'g'))
           AS level,
         regexp_replace(line, '^\s*((?:>\s*)+)', '') AS body
  FROM lines),
runs AS (
  SELECT rid, conv_id, turn, level, string_agg(body, ' ' ORDER BY i) AS body
  FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, level ORDER BY i) AS run FROM parsed) x
  GROUP BY rid, conv_id, turn, level, run),
units AS (
  SELECT DISTINCT conv_id, turn, level,
         lower(trim(regexp_replace(body, '\s+', ' ', 'g'), ' ')) AS body
  FROM (SELECT conv_id, turn, level, body FROM runs
        UNION ALL SELECT conv_id, turn, level, body FROM parsed) x
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
originals AS (
  SELECT conv_id, body, min(turn) AS first FROM units WHERE level = 0 AND body <> ''
  GROUP BY conv_id, body),
scored AS (
  SELECT conv_id, turn, level, first, sum(length(body)) AS n
  FROM units JOIN originals USING (conv_id, body)
  WHERE level > 0 AND body <> '' AND first < turn
  GROUP BY conv_id, turn, level, first),
links AS (
  SELECT conv_id, turn, first AS parent FROM (
    SELECT *, row_number() OVER (
      PARTITION BY conv_id, turn ORDER BY level, n DESC, first DESC) AS k
    FROM scored) x
  WHERE k = 1),
up(conv_id, turn, parent, thread, depth) AS (
  SELECT conv_id, turn, parent, parent, 1 FROM links
  UNION ALL
  SELECT up.conv_id, up.turn, up.parent, links.parent, up.depth + 1
  FROM up JOIN links ON up.conv_id = links.conv_id AND up.thread = links.turn),
threads AS (
  SELECT conv_id, turn, parent, min(thread) AS thread, max(depth) AS depth
  FROM up GROUP BY conv_id, turn, parent),
own AS (
  SELECT rid, coalesce(string_agg(body, chr(10) ORDER BY i) FILTER (WHERE level = 0 AND NOT (
           coalesce(after, 0) > 0 AND
           regexp_matches(body, '(?i)^.{0,200}\b(wrote|schrieb|a écrit|escribió):\s*$'))), '') AS said,
         count(*) FILTER (WHERE level > 0) AS n_quoted
  FROM (SELECT *, lead(level) OVER (PARTITION BY rid ORDER BY i) AS after FROM parsed) x
  GROUP BY rid),
clean AS (
  SELECT m.conv_id, m.turn, role, n_quoted,
         trim(CASE WHEN contains(text, '>') THEN said ELSE text END,
              ' ' || chr(9) || chr(10) || chr(13)) AS text
  FROM m JOIN own USING (rid))
SELECT clean.conv_id, clean.turn, coalesce(thread, clean.turn) AS thread,
       coalesce(depth, 0)::BIGINT AS depth, parent, role, text, n_quoted,
       '<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' AS formatted
FROM clean LEFT JOIN threads
  ON clean.conv_id = threads.conv_id AND clean.turn = threads.turn
"""

ORACLES["op7_near_duplicates"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
texts AS (SELECT text, min(doc_id) AS rep FROM d GROUP BY text),
words AS (
  SELECT rep, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM texts),
shingles AS (
  SELECT DISTINCT rep, array_to_string(w[i:i + 4], ' ') AS s FROM (
    SELECT rep, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
    FROM words WHERE len(w) > 0) x),
sizes AS (SELECT rep, count(*) AS n FROM shingles GROUP BY rep),
pairs AS (
  SELECT a.rep AS x, b.rep AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.rep <> b.rep GROUP BY a.rep, b.rep),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON x = p.rep JOIN sizes q ON y = q.rep
  WHERE c >= 0.8 * (p.n + q.n - c) - 1e-9),
reach(x, y) AS (
  SELECT x, y FROM links
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
classes AS (SELECT x, min(y) AS least FROM reach GROUP BY x),
degrees AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT doc_id, least(rep, coalesce(classes.least, rep)) AS class_id, rep AS text_id,
       coalesce(n, 0) AS n_links
FROM d JOIN texts USING (text) LEFT JOIN classes ON rep = classes.x
  LEFT JOIN degrees ON rep = degrees.x
"""

ORACLES["op8_warc"] = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS h
  FROM pages),
f AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS first,
         list_transform(range(8), lambda k: ('0x' || substr(h, 5 * k + 1, 5))::BIGINT) AS fives
  FROM p)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda j: substr(
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((fives[j // 4 + 1] >> (15 - 5 * (j % 4))) & 31) + 1)::BIGINT, 1)), 'string_agg', '')
         AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END
         AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""


def _turn_repair() -> str:
    """The cheapest edits by working back from the last row; a layer has a cheapest way per state."""
    after = {0: 2, 1: 2, 2: 3, 3: 2}
    keeps = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    role = {2: "user", 3: "assistant"}

    def way(cost: str, letter: str, rest: str, line: str) -> str:
        out = f"{line} || CASE WHEN {rest}.o = '' THEN '' ELSE chr(10) || {rest}.o END" if line else f"{rest}.o"
        return f"{{'c': {rest}.c + {cost}, 'a': '{letter}' || {rest}.a, 'o': {out}}}"

    never = "{'c': 1000000000::BIGINT, 'a': '', 'o': ''}"
    plain, ways = [], []
    for s in range(4):
        kept = " ".join(
            f"WHEN ok AND initial = '{i}' THEN {way('more', 'K', f'v{t}', '(role || chr(58) || text)')}"
            for i, t in keeps[s].items()
        )
        t = after[s]
        rerole = way("1 + more", "R", f"v{t}", f"('{role[t]}:' || text)")
        plain.append(
            f"list_sort([{way('2', 'D', f'v{s}', '')}, CASE {kept} ELSE {never} END,"
            f" CASE WHEN ok THEN {rerole} ELSE {never} END])[1] AS b{s}"
        )
        one = way("5", "I", f"b{t}", f"'{role[t]}:'")
        u = after[t]
        two = (
            f"{{'c': b{u}.c + 10, 'a': 'II' || b{u}.a, 'o': '{role[t]}:' || chr(10) || '{role[u]}:' ||"
            f" CASE WHEN b{u}.o = '' THEN '' ELSE chr(10) || b{u}.o END}}"
        )
        ways.append(f"list_sort([b{s}, {one}, {two}])[1] AS v{s}")
    return rf"""
WITH RECURSIVE conv AS (
  SELECT conv_id, row_number() OVER () AS k FROM (SELECT DISTINCT conv_id FROM conversations) x),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                        lambda c: ascii(c)::BIGINT) AS codes
  FROM conversations),
hashed AS (
  SELECT * EXCLUDE (codes), xor(4294967295, list_reduce(codes, lambda a, c:
           list_reduce(range(8), lambda b, i: CASE WHEN b & 1 = 1 THEN xor(b >> 1, 3988292384) ELSE b >> 1 END,
                       xor(a, c)), 4294967295::BIGINT)) % 20 AS what
  FROM given),
damaged AS (
  SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN what = 1 THEN '' WHEN what = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE what WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed),
placed AS (
  SELECT k, turn, role, text, role[1] AS initial,
         row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text, copy) AS i
  FROM damaged d JOIN conv c ON d.conv_id IS NOT DISTINCT FROM c.conv_id),
judged AS (
  SELECT *, count(*) OVER (PARTITION BY k) AS n,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
         coalesce(lag(initial) OVER (PARTITION BY k ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM placed),
lattice AS (
  SELECT k, i, n, role, text, initial, fault IN ('', 'truncated') AS ok,
         CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS more
  FROM judged),
ways AS (
  SELECT DISTINCT k, n AS i, {{'c': 0::BIGINT, 'a': '', 'o': ''}} AS v0,
         {{'c': 10::BIGINT, 'a': 'II', 'o': 'user:' || chr(10) || 'assistant:'}} AS v1,
         {{'c': 5::BIGINT, 'a': 'I', 'o': 'assistant:'}} AS v2, {{'c': 0::BIGINT, 'a': '', 'o': ''}} AS v3
  FROM lattice
  UNION ALL
  SELECT k, i - 1, {", ".join(ways)}
  FROM (SELECT k, i, {", ".join(plain)} FROM ways JOIN lattice USING (k, i)) x),
best AS (SELECT k, v0 FROM ways WHERE i = 0),
counts AS (
  SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE illegal) AS illegal
  FROM judged GROUP BY k)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v0.c, 0)::BIGINT AS cost,
       coalesce(v0.a, '') AS audit, sha256(coalesce(v0.o, '')) AS repaired_sha256
FROM conv LEFT JOIN counts USING (k) LEFT JOIN best USING (k)"""


ORACLES["op13_turn_repair"] = _turn_repair()

ORACLES["op12_vector_duplicates"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e,
         row_number() OVER () AS rid FROM embeddings),
good AS (
  SELECT * FROM v
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL)) = 0
    AND len(list_filter(e, lambda x: isnan(x) OR isinf(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.rid AS x, b.rid AS y
  FROM good a JOIN good b ON a.label = b.label AND len(a.e) = len(b.e) AND a.rid < b.rid
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT rid AS x, rid AS y FROM v
  UNION
  SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x),
tops AS (SELECT r.x, min(v.vec_id) AS top FROM reach r JOIN v ON r.y = v.rid GROUP BY r.x),
counts AS (SELECT x, count(*) AS n FROM both_ways GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, top AS component_id,
       vec_id IS NOT DISTINCT FROM top AS kept
FROM v JOIN tops ON v.rid = tops.x LEFT JOIN counts ON v.rid = counts.x"""
