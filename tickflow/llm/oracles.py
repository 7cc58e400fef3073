"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

# Blocks of 100 words and shards of 4000 documents, as in ``mixing.mix``.
OP8 = r"""
WITH sizes AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs,
    row_number() OVER (ORDER BY source NULLS LAST) AS source_no
  FROM sizes GROUP BY source
), weighted AS (
  SELECT *, (source_no - 1) % 3 + 1 AS weight, 3 * source_size AS ceiling FROM per_source
), sums AS (
  SELECT sum(source_size)::BIGINT AS words, sum(weight)::BIGINT AS weights FROM weighted
), ranked AS (
  SELECT weighted.*, words, weights,
    words - coalesce(sum(ceiling) OVER before, 0)::BIGINT AS remaining,
    weights - coalesce(sum(weight) OVER before, 0)::BIGINT AS rest
  FROM weighted, sums
  WINDOW before AS (ORDER BY ceiling / weight, source_no
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), capped AS (
  SELECT *, ceiling::HUGEINT * rest <= remaining::HUGEINT * weight AS is_full FROM ranked
), level AS (
  SELECT coalesce(sum(ceiling) FILTER (is_full), 0)::BIGINT AS full_words,
    coalesce(sum(weight) FILTER (is_full), 0)::BIGINT AS full_weights FROM capped
), targeted AS (
  SELECT capped.*, CASE WHEN is_full THEN ceiling::DOUBLE
    ELSE ((words - full_words) * weight)::DOUBLE / (weights - full_weights) END AS target,
    ceil(words / 100.0::DOUBLE)::BIGINT AS seats, ceil(n_docs / 4000.0::DOUBLE)::BIGINT AS shards
  FROM capped, level
), source_quotients AS (
  SELECT source_no, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source_no) AS place, seats
  FROM (SELECT *, unnest(range(seats)) AS k FROM targeted WHERE target > 0)
), source_quotas AS (
  SELECT source_no, count(*) AS quota FROM source_quotients WHERE place <= seats GROUP BY source_no
), laid AS (
  SELECT s.*, t.source_no, t.source_size, t.target, t.shards,
    ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '') || '|' || size), 1, 15))::BIGINT AS ord
  FROM sizes s JOIN targeted t ON s.source IS NOT DISTINCT FROM t.source
), sharded AS (
  SELECT *, ord % shards AS shard FROM laid
), placed AS (
  SELECT *, sum(size) OVER (PARTITION BY source_no, shard ORDER BY ord, doc_id, size
    ROWS UNBOUNDED PRECEDING)::BIGINT AS stop
  FROM sharded
), shard_sizes AS (
  SELECT source_no, shard, sum(size)::BIGINT AS shard_size, coalesce(max(quota), 0) AS seats,
    ceil(sum(size) / 100.0::DOUBLE)::BIGINT AS n_blocks
  FROM sharded LEFT JOIN source_quotas USING (source_no) GROUP BY source_no, shard
), shard_quotients AS (
  SELECT source_no, shard, seats, row_number() OVER (PARTITION BY source_no
    ORDER BY shard_size::DOUBLE / (2 * k + 1) DESC, shard) AS place
  FROM (SELECT *, unnest(range(seats)) AS k FROM shard_sizes WHERE shard_size > 0)
), shard_quotas AS (
  SELECT source_no, shard, n_blocks, least(n_blocks * 3, coalesce(got, 0)) AS quota
  FROM shard_sizes LEFT JOIN (
    SELECT source_no, shard, count(*) AS got FROM shard_quotients WHERE place <= seats
    GROUP BY source_no, shard) USING (source_no, shard)
  WHERE n_blocks > 0
), drawn AS (
  SELECT source_no, shard, block, quota, n_blocks, row_number() OVER (PARTITION BY source_no, shard
    ORDER BY ('0x' || substr(md5('mix|' || source_no || '|' || shard || '|' || block), 1, 15))::BIGINT, block)
    <= quota % n_blocks AS extra
  FROM (SELECT *, unnest(range(n_blocks)) AS block FROM shard_quotas)
), chosen AS (
  SELECT * FROM drawn WHERE extra
), extra_words AS (
  SELECT p.source_no, p.shard, p.stop,
    sum(least((block + 1) * 100, p.stop) - greatest(block * 100, p.stop - p.size))::BIGINT AS words
  FROM (SELECT *, unnest(range((stop - size) // 100, (stop - 1) // 100 + 1)) AS block
        FROM placed WHERE size > 0) p
  JOIN chosen c USING (source_no, shard, block)
  GROUP BY p.source_no, p.shard, p.stop
)
SELECT doc_id, size, source_size, target,
  (coalesce(quota // n_blocks, 0) * size
   + CASE WHEN size > 0 THEN coalesce(e.words, 0) ELSE 0 END)::BIGINT AS taken
FROM placed p
LEFT JOIN shard_quotas q USING (source_no, shard)
LEFT JOIN extra_words e ON p.source_no = e.source_no AND p.shard = e.shard AND p.stop = e.stop
"""

# Base32 from the bits of the digest, five at a time.
OP2 = r"""
WITH digests AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages
), ranked AS (
  SELECT *, max(page_id) OVER (PARTITION BY digest) AS winner,
    row_number() OVER (PARTITION BY digest ORDER BY page_id DESC NULLS LAST, url NULLS FIRST) = 1 AS first
  FROM digests
), bits AS (
  SELECT *, array_to_string(list_transform(string_split(digest, ''),
    lambda c: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001',
      '1010', '1011', '1100', '1101', '1110', '1111'][strpos('0123456789abcdef', c)]), '') AS bin
  FROM ranked
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(
      16 * bin[5 * i + 1]::INT + 8 * bin[5 * i + 2]::INT + 4 * bin[5 * i + 3]::INT
      + 2 * bin[5 * i + 4]::INT + bin[5 * i + 5]::INT + 1)::INT]), '') AS payload_digest,
  CASE WHEN first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first THEN NULL ELSE winner END AS refers_to
FROM bits
"""

# Turns in order; control strings in texts gain one character each when escaped.
OP3 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES
    (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
), lengths AS (
  SELECT *, length(role) + length(text) + 13
    + len(regexp_extract_all(role, '[<\[]~*/?(?:s>|INST\])'))
    + len(regexp_extract_all(text, '[<\[]~*/?(?:s>|INST\])')) AS chars
  FROM turns
), running AS (
  SELECT *, sum(chars) OVER (w ROWS UNBOUNDED PRECEDING) AS upto,
    lead(conv_id) OVER w IS NULL AND row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS is_last
  FROM lengths WINDOW w AS (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(CASE WHEN role = 'assistant' OR is_last THEN upto ELSE 0 END)::BIGINT AS formatted_chars
FROM running GROUP BY conv_id
"""

# Windows as texts of words joined by a space.
OP4 = r"""
WITH doc_words AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i
    FROM (SELECT *, least(10, len(words)) AS size FROM item_words WHERE len(words) > 0))
), sizes AS (
  SELECT DISTINCT size FROM item_windows
), found AS (
  SELECT row_no, i, size, array_to_string(words[i:i + size - 1], ' ') AS win
  FROM (SELECT row_no, words, size, unnest(range(1, len(words) - size + 2)) AS i
    FROM doc_words, sizes WHERE len(words) >= size)
  WHERE array_to_string(words[i:i + size - 1], ' ') IN (SELECT win FROM item_windows)
), hits AS (
  SELECT row_no, count(DISTINCT i + j)::BIGINT AS n_hit
  FROM (SELECT row_no, i, unnest(range(size)) AS j FROM found) GROUP BY row_no
), items AS (
  SELECT row_no, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT row_no, item_id::VARCHAR AS item
    FROM found JOIN item_windows USING (size, win)) GROUP BY row_no
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (row_no) LEFT JOIN items USING (row_no)
"""

OP9 = r"""
WITH lines AS (
  SELECT row_no, doc_id, i, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT row_no, doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS i
    FROM (SELECT row_number() OVER () AS row_no, doc_id,
      string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), repeated AS (
  SELECT key, max(doc_id) AS holder FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT lines.*, holder IS NOT NULL AND holder <> doc_id AS dropped
  FROM lines LEFT JOIN repeated USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines,
  count(*) FILTER (dropped)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY row_no
"""

# Without more texts in a group than a sketch keeps, its quantiles are exact.
OP10 = r"""
WITH base AS (
  SELECT row_number() OVER () AS row_no, doc_id, lang, source,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT row_no, i, list_aggregate(words[i:i + 4], 'string_agg', ' ') AS words5
  FROM (SELECT row_no, words, unnest(range(1, len(words) - 3)) AS i FROM base)
), repeated AS (
  SELECT row_no, i FROM (
    SELECT row_no, i, count(*) OVER (PARTITION BY row_no, words5) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT row_no, count(DISTINCT i + j)::BIGINT AS n_repeat_words
  FROM repeated, range(5) r(j) GROUP BY row_no
), counted AS (
  SELECT row_no, doc_id, lang, source, len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars, n_symbols,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM base LEFT JOIN covered USING (row_no)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
), ratios AS (
  SELECT lang, source, n_symbols / word_chars AS symbols, n_dup_lines / n_lines AS dup_lines,
    word_chars / n_words AS word_length
  FROM judged WHERE NOT base_failed
), levels AS (
  SELECT lang, source, grouping(lang, source) AS level, count(*) AS n,
    quantile_disc(symbols, 0.5) AS s50, quantile_disc(symbols, 0.1) AS s10,
    quantile_disc(dup_lines, 0.5) AS d50, quantile_disc(dup_lines, 0.1) AS d10,
    quantile_disc(word_length, 0.5) AS w50, quantile_disc(word_length, 0.1) AS w10
  FROM ratios GROUP BY GROUPING SETS ((lang, source), (lang), ())
), picked AS (
  SELECT g.lang, g.source, CASE WHEN g.n >= 100 THEN 1 WHEN l.n >= 100 THEN 2 ELSE 3 END AS pick,
    [g.s50, l.s50, a.s50][pick] AS s50, [g.s10, l.s10, a.s10][pick] AS s10,
    [g.d50, l.d50, a.d50][pick] AS d50, [g.d10, l.d10, a.d10][pick] AS d10,
    [g.w50, l.w50, a.w50][pick] AS w50, [g.w10, l.w10, a.w10][pick] AS w10
  FROM (SELECT * FROM levels WHERE level = 0) g
  JOIN (SELECT * FROM levels WHERE level = 1) l ON l.lang IS NOT DISTINCT FROM g.lang
  JOIN (SELECT * FROM levels WHERE level = 3) a ON true
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
    AND n_symbols / word_chars - s50 <= 7.0::DOUBLE * greatest(s50 - s10, 0.004::DOUBLE)
    AND n_dup_lines / n_lines - d50 <= 7.0::DOUBLE * greatest(d50 - d10, 0.05::DOUBLE)
    AND abs(word_chars / n_words - w50)
      <= 7.0::DOUBLE * greatest(w50 - w10, 0.2::DOUBLE) + 11.0::DOUBLE / sqrt(n_words) AS kept
FROM judged j LEFT JOIN picked p
  ON j.lang IS NOT DISTINCT FROM p.lang AND j.source IS NOT DISTINCT FROM p.source
"""
OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), said AS (
  SELECT row_no, lang, source,
    unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d
), kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS lang_count FROM said
  GROUP BY lang, term HAVING count(DISTINCT row_no) >= 10
), sizes AS (
  SELECT lang, count(*) AS v, sum(lang_count) AS lang_n FROM kept GROUP BY lang
), groups AS MATERIALIZED (
  SELECT DISTINCT lang, source FROM d
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM said JOIN kept USING (lang, term) GROUP BY ALL
), every AS (
  SELECT g.lang, g.source, k.term, k.lang_count, coalesce(c.n, 0) AS n,
    sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
), priced AS MATERIALIZED (
  SELECT lang, source, term, n,
    (1 + 1000000000::HUGEINT * (n + 2) // (total + 2 * v))::HUGEINT AS p,
    (1 + 1000000000::HUGEINT * (lang_count + 2) // (lang_n + 2 * v))::HUGEINT AS q
  FROM every JOIN sizes USING (lang)
), pair_values AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
  FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_values v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM priced WHERE n > 0 AND p > q
)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 10
"""


def _op12() -> str:
    """Vectors of 64 components in 8 parts of 8, 16 entries and 6 rounds, written out."""
    x, c = [f"x{j}" for j in range(8)], [f"c{j}" for j in range(8)]
    square = " + ".join(f"(x{j} - c{j}) * (x{j} - c{j})" for j in range(8))
    means = ", ".join(f"floor(sum(x{j}) / count(*))::BIGINT AS m{j}" for j in range(8))
    moved = ", ".join(f"coalesce(m{j}, c{j}) AS c{j}" for j in range(8))
    cut = ", ".join(f"units[8 * part + {j + 1}] AS x{j}" for j in range(8))

    def assigned(r: int) -> str:
        return f"""
, assigned{r} AS MATERIALIZED (
  SELECT row_no, part, any_value(label) AS label, any_value(vec_id) AS vec_id,
    min(d) AS d, arg_min(entry, (d, entry)) AS entry, {", ".join(f"any_value({n}) AS {n}" for n in x)}
  FROM (SELECT p.*, b.entry, {square} AS d FROM points p JOIN book{r} b USING (part))
  GROUP BY row_no, part
)"""

    def book(r: int) -> str:
        return f"""
, book{r} AS MATERIALIZED (
  SELECT part, entry, {moved} FROM book{r - 1} LEFT JOIN (
    SELECT part, entry, {means} FROM assigned{r - 1} GROUP BY part, entry) USING (part, entry)
)"""

    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS row_no,
    list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS units
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), points AS MATERIALIZED (
  SELECT row_no, vec_id, label, part, {cut} FROM kept, (SELECT unnest(range(8)) AS part)
), book0 AS MATERIALIZED (
  SELECT part, row_no AS entry, {", ".join(f"x{j} AS c{j}" for j in range(8))} FROM points WHERE row_no < 16
)
{"".join(assigned(r) + book(r + 1) for r in range(6))}{assigned(6)}
, codes AS (
  SELECT row_no, any_value(vec_id) AS vec_id, any_value(label) AS label, sum(d)::BIGINT AS error,
    string_agg('0' || lower(to_hex(entry)), '' ORDER BY part) AS code
  FROM assigned6 GROUP BY row_no
), printed AS (
  SELECT sha256(string_agg(concat_ws(',', {", ".join(c)}), ',' ORDER BY part, entry)) AS codebooks_sha256
  FROM book6
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM codes, printed
"""


OP12 = _op12()

OP13 = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS MATERIALIZED (
  SELECT row_no, doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2),
      lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS s
  FROM d
), shingles AS MATERIALIZED (
  SELECT row_no, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS MATERIALIZED (
  SELECT a.row_no AS x, b.row_no AS y FROM shingles a JOIN shingles b USING (shingle)
  WHERE a.row_no <> b.row_no
  GROUP BY a.row_no, b.row_no
  HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), reached AS (
  SELECT row_no, row_no AS other FROM sets
  UNION
  SELECT row_no, y FROM reached JOIN links ON other = x
)
SELECT a.doc_id, len(a.s)::BIGINT AS n_shingles, min(b.doc_id) AS component_id
FROM reached JOIN sets a ON a.row_no = reached.row_no JOIN sets b ON b.row_no = reached.other
GROUP BY reached.row_no, a.doc_id, a.s
"""

ORACLES: dict[str, str] = {
    "op2_warc": OP2,
    "op3_chat": OP3,
    "op4_decontaminate": OP4,
    "op8_mixing": OP8,
    "op9_line_dedup": OP9,
    "op10_quality_rules": OP10,
    "op11_divergence": OP11,
    "op12_vector_codes": OP12,
    "op13_ngram_join": OP13,
}
