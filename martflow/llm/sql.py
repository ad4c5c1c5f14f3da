"""SQL that gives the rows of the operators, for those that SQL can express."""

from __future__ import annotations

from martflow.llm.shards import BITS, CELLS, SHARDS, curve_steps

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def _crc_steps() -> list[int]:
    steps = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        steps.append(value)
    return steps


def _crc32(text: str) -> str:
    """CRC-32 of a text, byte by byte."""
    numbers = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    fold = f"lambda c, b: xor(c >> 8, {_crc_steps()}[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {numbers}), {fold}), 4294967295)"


def _curve() -> str:
    steps = f"{curve_steps(3)}"
    selects = "SELECT *, 0 AS s0, 0 AS h0 FROM cells"
    for k, level in enumerate(reversed(range(BITS))):
        corner = f"((lang_cell >> {level}) & 1) + 2 * ((source_cell >> {level}) & 1) + 4 * ((size_cell >> {level}) & 1)"
        selects = (
            f"SELECT *, step{k} // 8 AS s{k + 1}, h{k} * 8 + step{k} % 8 AS h{k + 1} FROM "
            f"(SELECT *, {steps}[s{k} * 8 + {corner} + 1] AS step{k} FROM ({selects}))"
        )
    return selects


HILBERT_SHARDS = f"""
WITH cells AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size, {_crc32("coalesce(text, '')")} AS text_crc32,
         {_crc32("coalesce(lang, '')")} % {CELLS} AS lang_cell, {_crc32("coalesce(source, '')")} % {CELLS} AS source_cell,
         length(bin(size)) - 1 AS size_cell
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY h{BITS}, doc_id, text_crc32) - 1 AS rank, count(*) OVER () AS total
  FROM ({_curve()}))
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
       CAST(rank * {SHARDS} // total AS INTEGER) AS shard,
       CAST(rank - (rank * {SHARDS} // total * total + {SHARDS - 1}) // {SHARDS} AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM ranked
"""

HARD_NEGATIVES = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.alike
     AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

SPELLING = f"""
WITH RECURSIVE runs AS MATERIALIZED (
  SELECT doc, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc,
               unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
step AS MATERIALIZED (SELECT unnest(range(256)) AS byte, unnest({_crc_steps()}) AS code),
longest AS MATERIALIZED (SELECT max(octet_length(encode(doc || ':' || run))) AS bytes FROM runs),
far AS (
  SELECT 0 AS distance, byte, code FROM step
  UNION ALL SELECT distance + 1, f.byte, xor(f.code >> 8, s.code) FROM far f JOIN step s ON s.byte = f.code & 255, longest
  WHERE distance < longest.bytes),
bare AS (
  SELECT 0 AS size, 4294967295::BIGINT AS code
  UNION ALL SELECT size + 1, xor(b.code >> 8, s.code) FROM bare b JOIN step s ON s.byte = b.code & 255, longest
  WHERE size < longest.bytes),
bytes AS (
  SELECT doc, run, n, size, unnest(range(1, size + 1)) AS place, CAST('0x' || substr(text, 2 * place - 1, 2) AS BIGINT) AS byte
  FROM (SELECT *, hex(encode(doc || ':' || run)) AS text, octet_length(encode(doc || ':' || run)) AS size FROM runs)),
coded AS MATERIALIZED (
  SELECT doc, run, n, xor(xor(bit_xor(far.code), any_value(bare.code)), 4294967295) AS code
  FROM bytes JOIN far ON far.distance = size - place AND far.byte = bytes.byte JOIN bare USING (size) GROUP BY doc, run, n),
words AS MATERIALIZED (
  SELECT CASE WHEN code % 199 = 0 THEN substr(run, 1, CAST(code % length(run) AS INTEGER)) || substr(run, CAST(code % length(run) AS INTEGER) + 2)
              ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
  FROM coded GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
cut AS (SELECT word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest
        FROM (SELECT *, unnest(range(1, length(word) + 1)) AS place FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word),
best AS (SELECT word, count(*) AS n_near, min({{'less': -other_n, 'form': other}}) AS likely FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -likely.less >= 5 * n THEN likely.form END AS form,
         CASE WHEN -likely.less >= 5 * n THEN -likely.less END AS form_n
  FROM words LEFT JOIN best USING (word)),
steps AS (
  SELECT word, word AS root, 0 AS hops FROM forms
  UNION ALL SELECT s.word, f.form, s.hops + 1 FROM steps s JOIN forms f ON s.root = f.word AND f.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n
FROM forms JOIN (SELECT word, arg_max(root, hops) AS root FROM steps GROUP BY word) USING (word)
"""
