"""DuckDB SQL of the corpus operators that SQL can express."""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def number(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 13))::BIGINT"


def unit(text: str) -> str:
    return f"(({number(text)} + 0.5::DOUBLE) / 4503599627370496::DOUBLE)"


#: crc_of: doc_id, c, the CRC-32 of the text's UTF-8 bytes. The table of remainders comes from its rule.
CRC = """
steps(b, k, v) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8),
remainders AS (SELECT list(v ORDER BY b) AS t FROM steps WHERE k = 8),
crc_of AS (
  SELECT doc_id, coalesce(xor(list_reduce(
      list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda s: ('0x' || s)::BIGINT),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295), 0) AS c
  FROM documents, remainders)"""

EXACT = f"""
WITH lowered AS (SELECT doc_id, {LOWERED} AS body FROM documents),
groups AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM lowered GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM lowered JOIN groups USING (body)"""


def _nearest(shards: int, name: str) -> str:
    return f"""SELECT doc_id, arg_min(s, -ln({unit("doc_id || '|' || s")})) AS {name} FROM documents, range({shards}) r(s) GROUP BY doc_id"""


SHARDING = f"""
WITH RECURSIVE {CRC},
sheet AS (
  SELECT doc_id, (octet_length(encode(coalesce(text, ''))) + 1)::BIGINT AS size, c AS text_crc32, 'key' AS law,
    a.shard::INT AS shard, b.grown::INT AS grown_shard, {number("'cell|' || doc_id || '|' || c")} % 4096 AS cell
  FROM documents JOIN crc_of USING (doc_id)
  JOIN ({_nearest(16, "shard")}) a USING (doc_id) JOIN ({_nearest(17, "grown")}) b USING (doc_id))
SELECT doc_id, size, text_crc32, law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY cell, doc_id, text_crc32) - 1 AS slot, grown_shard
FROM sheet"""

MIXING = f"""
WITH RECURSIVE {CRC},
sizes AS (
  SELECT source, sum(octet_length(encode(coalesce(text, ''))) + 1)::DOUBLE AS bytes,
    CASE source WHEN 'src0' THEN 2.0::DOUBLE WHEN 'src1' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM documents GROUP BY source),
rates AS (SELECT source, sum(bytes) OVER () * weight / sum(weight) OVER () / bytes AS rate FROM sizes),
parts AS (
  SELECT source, rate, greatest(ceil(rate / 4.0), 1)::INT AS parts, rate / greatest(ceil(rate / 4.0), 1) AS mean FROM rates),
cdf AS (
  SELECT source, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS c
  FROM parts, range(48) r(k)),
drawn AS (
  SELECT doc_id, source, part, '17|' || doc_id || '|' || crc_of.c AS key, {unit("'17|' || doc_id || '|' || crc_of.c || '|' || part")} AS u
  FROM documents JOIN crc_of USING (doc_id) JOIN parts USING (source), LATERAL (SELECT unnest(range(1, parts + 1)) AS part)),
counted AS (
  SELECT doc_id, key, sum((SELECT count(*) FROM cdf WHERE cdf.source = drawn.source AND cdf.c <= drawn.u))::INT AS repeats
  FROM drawn GROUP BY doc_id, key)
SELECT documents.*, repeats, copy::INT AS copy, {number("'shuffle|' || key || '|' || copy")} AS shuffle_key
FROM documents JOIN counted USING (doc_id), LATERAL (SELECT unnest(range(repeats)) AS copy)"""

WORD = r"[^\x20\x09-\x0D]+"
#: Of op13: rule, value, cutoffs from the one that rejects most.
CUTOFFS = """(VALUES
  ('symbols', [500, 1000, 2000, 4000, 8000, 16000]), ('dup_lines', [1000, 2000, 3000, 4000, 6000, 8000]),
  ('repeats', [500, 1000, 1500, 2000, 3000, 4000]), ('long_words', [700, 800, 900, 1000, 1200, 1500]),
  ('short_words', [-350, -300, -275, -250, -225, -200])) c(rule, cutoffs)"""

RISK_RULES = f"""
WITH worded AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(lang, 'und') AS stratum, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS lines
  FROM documents),
windows AS (
  SELECT row, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM worded, LATERAL (SELECT unnest(range(1, len(words) - 1)) AS i)),
repeated AS (
  SELECT row, count(DISTINCT place) AS n FROM (
    SELECT row, unnest([i, i + 1, i + 2]) AS place FROM (
      SELECT row, i, count(*) OVER (PARTITION BY row, a, b, c) AS times FROM windows) WHERE times > 1) GROUP BY row),
counted AS (
  SELECT row, doc_id, stratum, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(body) - length(translate(body, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM worded LEFT JOIN repeated USING (row)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
levels AS (
  SELECT row, rule, len(list_filter(cutoffs, lambda c: n_words > 0 AND CASE rule
      WHEN 'symbols' THEN n_symbols * 10000 // greatest(n_words, 1) WHEN 'dup_lines' THEN n_dup_lines * 10000 // greatest(n_lines, 1)
      WHEN 'repeats' THEN n_repeat_words * 10000 // greatest(n_words, 1) WHEN 'long_words' THEN word_chars * 100 // greatest(n_words, 1)
      ELSE -(word_chars * 100 // greatest(n_words, 1)) END >= c)) AS level
  FROM based, {CUTOFFS}),
known AS (
  SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = max(quality)),
held AS (
  SELECT stratum, rule, level, good FROM based JOIN known USING (doc_id) JOIN levels USING (row) WHERE NOT base_failed),
counts AS (
  SELECT stratum, rule, step, count(*) FILTER (WHERE good) AS n, count(*) FILTER (WHERE good AND level >= step) AS k,
    count(*) FILTER (WHERE NOT good AND level >= step) AS bad
  FROM held, range(1, 7) s(step) GROUP BY ALL),
tests AS (SELECT count(DISTINCT stratum) * 5 AS m FROM held),
valued AS (
  SELECT *, CASE WHEN k < n * 0.01::DOUBLE THEN (
      SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.01::DOUBLE) + (n - i) * ln(0.99::DOUBLE)))
      FROM range(k + 1) r(i)) ELSE 1 END AS p_value
  FROM counts),
certified AS (
  SELECT *, bool_and(p_value <= 0.05::DOUBLE / m) OVER (PARTITION BY stratum, rule ORDER BY step DESC) AS certified FROM valued, tests),
chosen AS (
  SELECT stratum, rule, max((bad - 20 * k, step)) AS best FROM certified WHERE certified AND bad - 20 * k > 0 GROUP BY stratum, rule),
refused AS (
  SELECT DISTINCT row FROM based JOIN levels USING (row) JOIN chosen USING (stratum, rule) WHERE level >= best[2])
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND row NOT IN (SELECT row FROM refused) AS kept
FROM based"""

COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array({LOWERED}, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS words
  FROM documents),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i : i + k - 1], ' '))) AS phrase
  FROM pieces, range(1, 4) r(k)),
totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang),
counts AS (SELECT lang, k, phrase, count(*) AS a, string_split(phrase, ' ') AS words FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 10),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, cut, array_to_string(c.words[:cut], ' ') AS head, array_to_string(c.words[cut + 1:], ' ') AS rest
  FROM counts c, LATERAL (SELECT unnest(range(1, c.k)) AS cut) WHERE c.k > 1),
valued AS (
  SELECT cuts.*, x.a AS l, y.a AS r, ((1000000::HUGEINT * cuts.a * cuts.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM cuts JOIN counts x ON x.lang = cuts.lang AND x.phrase = head JOIN counts y ON y.lang = cuts.lang AND y.phrase = rest),
best AS (SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_of AS (
  SELECT lang, array_to_string(words[s : s + 1], ' ') AS phrase, max(a) AS outer_a FROM counts, range(1, 3) p(s) WHERE k = 3 GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN inner_of USING (lang, phrase) WHERE k = 3 OR outer_a IS NULL OR 100 * outer_a < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN totals USING (lang)
WHERE rank <= 2000"""

ORACLE = {"op1_source_mixing": MIXING, "op5_exact_dedup": EXACT, "op7_rendezvous_shards": SHARDING, "op11_collocations": COLLOCATIONS, "op13_risk_rules": RISK_RULES}
