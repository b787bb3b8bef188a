"""DuckDB SQL of the queries that SQL can express, by query name.

The others (fingerprints, automata, Newton steps, random walks, trained models)
are tested against plain Python versions in ``tests/llm``.
"""

from __future__ import annotations

WORD = r"'[^\x20\x09-\x0D]+'"
TEXTS = "texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents)"
TOKENS = f"tokens AS (SELECT *, regexp_extract_all(t, {WORD}) AS w FROM texts)"

# --- quality rules: windows by unnesting, ratios by their definitions ---------------

STOP = """the of and to in a is that for it as was with be by on not he his are this at from have or an they which you we
der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch
le la les de des et en un une du dans que qui est pour pas au sur par avec
el los las y con del se por para su al no una lo como""".split()
QUALITY = f"""
WITH {TEXTS}, {TOKENS},
starts AS (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS p FROM tokens WHERE len(w) >= 3),
repeated AS (SELECT r, p FROM starts QUALIFY count(*) OVER (PARTITION BY r, w[p], w[p + 1], w[p + 2]) > 1),
covered AS (SELECT r, count(DISTINCT p + k) AS n FROM repeated, (VALUES (0), (1), (2)) AS s(k) GROUP BY r),
counts AS (
  SELECT r, doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(list_filter(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZÜ', 'abcdefghijklmnopqrstuvwxyzü'), '\\p{{L}}+'),
      lambda x: x IN ({', '.join(f"'{x}'" for x in sorted(set(STOP)))}))) AS n_stop,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM tokens),
measured AS (
  SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    coalesce(CAST(word_chars AS DOUBLE) / nullif(n_words, 0), 0.0) AS mean_word_chars,
    coalesce(CAST(n_symbols AS DOUBLE) / nullif(n_words, 0), 0.0) AS symbol_ratio,
    coalesce(CAST(n_stop AS DOUBLE) / nullif(n_words, 0), 0.0) AS stop_word_ratio,
    coalesce(CAST(len(lines) - len(list_distinct(lines)) AS DOUBLE) / nullif(len(lines), 0), 0.0) AS dup_line_ratio
  FROM counts LEFT JOIN covered USING (r)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT *, NOT base_failed AND mean_word_chars BETWEEN 2 AND 15 AND symbol_ratio <= 0.2 AND stop_word_ratio >= 0.05 AND dup_line_ratio <= 0.3 AS kept
FROM judged"""

# --- sharding: the law by its definition, the checksum by its polynomial --------------

SHARDING = """
WITH tables AS (
  SELECT list_transform(generate_series(0, 255), lambda n: list_reduce(list_prepend(n, generate_series(1, 8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc),
bytes AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
records AS (
  SELECT doc_id, CAST(n + 16 AS BIGINT) AS size,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(generate_series(1, n), lambda i: CAST('0x' || substr(h, 2 * i - 1, 2) AS BIGINT))),
      lambda c, b: xor(crc[CAST(xor(c, b) & 255 AS INTEGER) + 1], c >> 8))) AS text_crc32
  FROM bytes, tables),
scores AS (
  SELECT *, list_transform(generate_series(0, 40), lambda j: -ln((CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/' || CAST(j AS VARCHAR)), 1, 13))
    AS BIGINT) + 0.5) / 4503599627370496.0)) AS s
  FROM records),
placed AS (
  SELECT doc_id, size, text_crc32, list_position(s, list_min(s[1:40])) - 1 AS shard, list_position(s, list_min(s)) - 1 AS grown_shard FROM scores)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard, CAST(grown_shard AS INTEGER) AS grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot
FROM placed"""

# --- substring dedup: every window unnested ---------------------------------------------

SUBSTRINGS = f"""
WITH {TEXTS}, {TOKENS},
windows AS (SELECT r, doc_id, p, array_to_string(w[p:p + 12], ' ') AS key
  FROM (SELECT *, unnest(generate_series(1, len(w) - 12)) AS p FROM tokens WHERE len(w) >= 13 AND doc_id IS NOT NULL)),
late AS (SELECT r, p FROM windows QUALIFY min(doc_id) OVER (PARTITION BY key) < doc_id),
gone AS (SELECT DISTINCT r, p + k AS p FROM late, generate_series(0, 12) AS s(k)),
spread AS (SELECT r, unnest(generate_series(1, len(w))) AS p, unnest(w) AS x FROM tokens),
kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM spread ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM tokens LEFT JOIN kept USING (r)"""

# --- chat formatting: sizes and digests from the turns themselves ------------------------

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS turns,
    sum(length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g'))
      + CASE WHEN role = 'assistant' THEN 7 ELSE 14 + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'),
        '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g')) END) OVER w AS upto
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (WHERE role = 'assistant' OR n = turns) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""

# --- ranked lexical search: every posting scored ----------------------------------------

TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
SEARCH = f"""
WITH docs AS (SELECT * FROM (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS w FROM documents) WHERE len(w) > 0),
totals AS (SELECT count(*) AS docs_all, CAST(sum(len(w)) AS BIGINT) AS terms_all FROM docs),
postings AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs) GROUP BY r, t),
weights AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(docs_all) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM postings, totals GROUP BY t),
wanted AS (SELECT DISTINCT item_id, unnest({TERMS}) AS t FROM benchmark),
scores AS (SELECT item_id, r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(w) * docs_all) // terms_all)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (t) JOIN postings USING (t) JOIN docs USING (r), totals GROUP BY item_id, r)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores JOIN docs USING (r) WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10"""

# --- phrase mining: every n-gram unnested, products in 128 bits ---------------------------

PHRASES = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
said AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM said, (VALUES (1), (2), (3)) AS s(k) WHERE len(w) >= k),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g, count(*) AS f FROM starts GROUP BY lang, k, g),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cuts AS (SELECT *, array_to_string(w[1:c], ' ') AS lg, array_to_string(w[c + 1:k], ' ') AS rg FROM (SELECT *, unnest(generate_series(1, k - 1)) AS c FROM candidates)),
scored AS (SELECT cuts.*, x.f AS l, y.f AS r, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = lg JOIN f y ON y.lang = cuts.lang AND y.g = rg),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
held AS (SELECT s.lang, s.g FROM candidates s JOIN (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS g
  FROM candidates WHERE k = 3) t ON t.lang = s.lang AND t.g = s.g AND 100 * t.a >= 50 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM lowest ANTI JOIN held USING (lang, g))
SELECT lang, rank, g AS phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

# --- WARC: the kinds of records by equal payloads, the digest by its alphabet ------------

WARC = """
WITH payloads AS (SELECT page_id, url, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
ranked AS (SELECT *, row_number() OVER w AS place, first_value(page_id) OVER w AS head FROM payloads
  WINDOW w AS (PARTITION BY t ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST))
SELECT page_id, CAST(octet_length(encode(t)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(generate_series(0, 31), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(h, 1 + CAST(i // 8 AS INTEGER) * 10, 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN head END AS refers_to
FROM ranked"""

ORACLE_SQL: dict[str, str] = {
    "op3_quality_rules": QUALITY,
    "op5_sharding": SHARDING,
    "op7_substring_dedup": SUBSTRINGS,
    "op8_chat_formatting": CHAT,
    "op11_warc": WARC,
    "op12_lexical_search": SEARCH,
    "op13_phrase_mining": PHRASES,
}
