"""SQL that the queries are checked against."""

ORACLES: dict[str, str] = {}

ORACLES["op4_exact_dedup"] = """
WITH d AS (
  SELECT doc_id,
         sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM d
"""

ORACLES["op9_mixing"] = r"""
WITH words AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, ''))) AS key
  FROM documents
),
keyed AS (
  SELECT *, CAST('0x' || substr(md5('mix/shard:' || key), 1, 2) AS BIGINT) AS shard,
         md5('mix/order:' || key) AS place
  FROM words
),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) AS number
  FROM keyed GROUP BY source
),
weighed AS (
  SELECT *, (number - 1) % 3 + 1 AS weight, (sum(source_size) OVER ())::BIGINT AS total,
         3 * source_size / CAST((number - 1) % 3 + 1 AS DOUBLE) AS fill
  FROM sources
),
levels AS (
  SELECT *,
         (total - 3 * coalesce(sum(source_size) OVER (
            ORDER BY fill, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER (
            ORDER BY fill, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS lvl
  FROM weighed
),
targets AS (
  SELECT *, least(3.0::DOUBLE * source_size,
    weight * (SELECT lvl FROM levels WHERE fill >= lvl ORDER BY fill, number LIMIT 1)) AS target,
    floor(total / 16.0::DOUBLE + 0.5)::BIGINT AS blocks
  FROM levels
),
seats AS (
  SELECT *, CASE WHEN total > 0 THEN floor(target * blocks / total + 0.5)::BIGINT ELSE 0 END AS base
  FROM targets
),
open_seats AS (
  SELECT *, (blocks - sum(base) OVER ())::BIGINT AS missing FROM seats
),
tries AS (
  SELECT number, missing, step,
         CASE WHEN missing > 0 THEN -(target / (2.0 * (base + step) + 1.0))
              ELSE target / (2.0 * (base - step) - 1.0) END AS quotient
  FROM open_seats, range(0, 64) AS r(step)
  WHERE missing <> 0 AND (missing > 0 OR step < base)
),
dealt AS (
  SELECT s.source, s.source_size, s.number, s.target, s.base + coalesce((
    SELECT sum(sign(missing)) FROM (
      SELECT *, row_number() OVER (ORDER BY quotient, sign(missing) * number) AS place FROM tries
    ) t WHERE t.number = s.number AND place <= abs(missing)), 0) AS blocks
  FROM open_seats s
),
shards AS (
  SELECT source, shard, sum(size)::BIGINT AS shard_size FROM keyed GROUP BY source, shard
),
parties AS (
  SELECT h.shard, h.shard_size, d.*,
         CASE WHEN source_size > 0
              THEN floor(shard_size * blocks / source_size::DOUBLE + 0.5)::BIGINT ELSE 0 END AS base
  FROM shards h JOIN dealt d ON h.source IS NOT DISTINCT FROM d.source
),
open_parties AS (
  SELECT *, CASE WHEN source_size > 0
                 THEN (blocks - sum(base) OVER (PARTITION BY number))::BIGINT ELSE 0 END AS missing
  FROM parties
),
part_tries AS (
  SELECT number, shard, missing,
         CASE WHEN missing > 0 THEN -(shard_size / (2.0 * (base + step) + 1.0))
              ELSE shard_size / (2.0 * (base - step) - 1.0) END AS quotient
  FROM open_parties, range(0, 129) AS r(step)
  WHERE missing <> 0 AND (missing > 0 OR step < base)
),
changes AS (
  SELECT number, shard, sum(sign(missing)) AS change FROM (
    SELECT *, row_number() OVER (
      PARTITION BY number ORDER BY quotient, sign(missing) * shard) AS place
    FROM part_tries) WHERE place <= abs(missing) GROUP BY number, shard
),
quotas AS (
  SELECT p.source, p.shard, p.shard_size, p.source_size, p.target,
         least((p.base + coalesce(c.change, 0)) * 16, 3 * p.shard_size)::BIGINT AS quota
  FROM open_parties p LEFT JOIN changes c ON p.number = c.number AND p.shard = c.shard
),
laid AS (
  SELECT *, sum(size) OVER (PARTITION BY source, shard ORDER BY place, size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS earlier
  FROM keyed
)
SELECT l.doc_id, l.size, l.source, q.source_size, q.target,
       (CASE WHEN shard_size > 0 THEN quota // shard_size ELSE 0 END * size + greatest(0, least(size,
         quota - CASE WHEN shard_size > 0 THEN quota // shard_size ELSE 0 END * shard_size - earlier
       )))::BIGINT AS taken
FROM laid l JOIN quotas q ON l.source IS NOT DISTINCT FROM q.source AND l.shard = q.shard
"""

ORACLES["op3_top_k"] = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, p.vec_id,
         CAST(list_dot_product(q.v, p.v) AS BIGINT) AS score
  FROM usable q JOIN usable p ON q.vec_id % 50 = 0 AND p.vec_id <> q.vec_id
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

ORACLES["op6_chat_rotation"] = r"""
WITH messages AS (
  SELECT conv_id, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS content,
         row_number() OVER (PARTITION BY conv_id
           ORDER BY turn NULLS LAST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS index
  FROM conversations
),
people AS (
  SELECT DISTINCT conv_id, speaker AS perspective FROM messages WHERE speaker <> 'system'
),
pieces AS (
  SELECT m.conv_id, p.perspective, m.index // 64 AS chunk, m.index, m.speaker = p.perspective AS ours,
         '<|im_start|>' || CASE WHEN m.speaker = p.perspective THEN 'assistant'
                                WHEN m.speaker = 'system' THEN 'system'
                                ELSE 'user name=' || translate(
                                  regexp_replace(m.speaker, '<(\\*)\|', '<\1\\|', 'g'),
                                  chr(13) || chr(10), '  ') END || chr(10) AS head,
         regexp_replace(m.content, '<(\\*)\|', '<\1\\|', 'g') || '<|im_end|>' AS body
  FROM messages m JOIN people p ON m.conv_id IS NOT DISTINCT FROM p.conv_id
),
laid AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER (
      PARTITION BY conv_id, perspective, chunk ORDER BY index
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - length(body) - 1 AS begins
  FROM pieces
)
SELECT conv_id, perspective, chunk, count(*) AS messages,
       string_agg(head || body || chr(10), '' ORDER BY index) AS text,
       coalesce(string_agg(CAST(begins AS BIGINT) || ':' || CAST(begins + length(body) AS BIGINT), ','
         ORDER BY index) FILTER (WHERE ours), '') AS masks
FROM laid GROUP BY conv_id, perspective, chunk
"""


def _draw(name: str, weight: int) -> str:
    digits = f"CAST('0x' || substr(md5('{name}:' || key), 1, 13) AS BIGINT)"
    return f"(-ln((CAST({digits} AS DOUBLE) + 0.5::DOUBLE) / {16**13}::DOUBLE) / {weight}::DOUBLE)"


def _descent(regions: int) -> str:
    """Two regions of two racks of two shards, and if there is a third region, shard 8 alone in it."""
    racks = []
    for region in range(2):
        pairs = []
        for rack in range(2):
            first = region * 4 + rack * 2
            one, other = (f"{region}/{rack}/{shard}" for shard in (first, first + 1))
            pairs.append(f"CASE WHEN {_draw(one, 1)} <= {_draw(other, 1)} THEN {first} ELSE {first + 1} END")
        pick = f"{_draw(f'{region}/0', 2)} <= {_draw(f'{region}/1', 2)}"
        racks.append(f"CASE WHEN {pick} THEN {pairs[0]} ELSE {pairs[1]} END")
    low = f"CASE WHEN {_draw('0', 4)} <= {_draw('1', 4)} THEN {racks[0]} ELSE {racks[1]} END"
    if regions == 2:
        return low
    return f"CASE WHEN {_draw('2', 1)} < least({_draw('0', 4)}, {_draw('1', 4)}) THEN 8 ELSE {low} END"


ORACLES["op1_sharding"] = f"""
WITH crc_step AS (
  SELECT list(c ORDER BY i) AS crc_table FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
             CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(i))
),
keyed AS (
  SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS digits,
         coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, ''))) AS key
  FROM documents
),
placed AS (
  SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(text)),
               lambda i: CAST('0x' || substr(digits, 2 * i + 1, 2) AS BIGINT))),
             lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)
           AS text_crc32,
         {_descent(2)} AS shard, {_descent(3)} AS grown_shard,
         CAST('0x' || substr(md5('slot:' || key), 1, 2) AS BIGINT) AS bucket
  FROM keyed, crc_step
)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id, text_crc32, size) - 1 AS slot,
       CAST(grown_shard AS INTEGER) AS grown_shard
FROM placed
"""


ORACLES["op11_periodic_runs"] = r"""
WITH crc_step AS (
  SELECT list(c ORDER BY i) AS crc_table FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
             CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(i))
),
texts AS (
  SELECT row_number() OVER () AS place, doc_id, hex(encode(CAST(doc_id AS VARCHAR))) AS digits,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words
  FROM documents
),
hashed AS (
  SELECT place, doc_id, words, len(words) AS n,
         coalesce(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(digits) // 2),
               lambda i: CAST('0x' || substr(digits, 2 * i + 1, 2) AS BIGINT))),
             lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295::BIGINT), 1) AS h
  FROM texts, crc_step
),
chosen AS (
  SELECT *, h % 10 = 0 AND n > 0 AS periodic, CASE WHEN n > 0 THEN (h // 10) % n ELSE 0 END AS a
  FROM hashed
),
shaped AS (
  SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM chosen
),
spelled AS (
  SELECT place, doc_id, n, i,
         words[(CASE WHEN periodic AND i >= a THEN a + (i - a) % p ELSE i END) + 1] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM shaped)
),
alike AS (
  SELECT x.place, y.i - x.i AS q, x.i,
         x.i - row_number() OVER (PARTITION BY x.place, y.i - x.i ORDER BY x.i) AS island
  FROM spelled x JOIN spelled y
    ON x.place = y.place AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
),
stretches AS (
  SELECT place, min(i) AS first, count(*) + q AS size, q FROM alike GROUP BY place, q, island
  HAVING count(*) + q >= greatest(6, 4 * q)
),
runs AS (
  SELECT place, first, size, min(q) AS q FROM stretches GROUP BY place, first, size
),
listed AS (
  SELECT place, count(*) AS n_runs,
         first(first ORDER BY size DESC, first, q) AS best_first,
         first(size ORDER BY size DESC, first, q) AS best_size,
         first(q ORDER BY size DESC, first, q) AS best_q,
         string_agg(first || ',' || size || ',' || q || chr(10), '' ORDER BY first, q) AS lines
  FROM runs GROUP BY place
),
kept AS (
  SELECT s.place, string_agg(s.word, ' ' ORDER BY s.i) AS text
  FROM spelled s ANTI JOIN (
    SELECT place, unnest(range(first + q, first + size)) AS i FROM runs
  ) d ON s.place = d.place AND s.i = d.i
  GROUP BY s.place
)
SELECT t.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best_first::BIGINT AS start,
       best_size::BIGINT AS length, best_q::BIGINT AS period,
       (1000 * best_size // best_q)::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM texts t LEFT JOIN listed l ON t.place = l.place LEFT JOIN kept k ON t.place = k.place
"""


ORACLES["op12_collocations"] = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(part, '[^\x20\x09]+') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS part
        FROM documents)
),
places AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces
),
grams AS (
  SELECT lang, array_to_string(words[i : i + size - 1], ' ') AS phrase, size
  FROM places, range(1, 5) AS s(size) WHERE i + size - 1 <= len(words)
),
counted AS (
  SELECT lang, phrase, size, count(*) AS f FROM grams GROUP BY lang, phrase, size
),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang),
candidates AS MATERIALIZED (
  SELECT *, string_split(phrase, ' ') AS words FROM counted WHERE size > 1 AND f >= 30
),
sides AS MATERIALIZED (
  SELECT lang, phrase, f AS a, k, array_to_string(words[1 : k], ' ') AS one,
         array_to_string(words[k + 1 : size], ' ') AS other
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
),
cuts AS (
  SELECT s.lang, s.phrase, s.a, k, l.f AS l, r.f AS r,
         (2000000::HUGEINT * s.a // (l.f::HUGEINT + r.f))::BIGINT AS score
  FROM sides s JOIN counted l ON l.lang = s.lang AND l.phrase = s.one
  JOIN counted r ON r.lang = s.lang AND r.phrase = s.other
),
weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
inside AS (
  SELECT lang, array_to_string(words[i : i + width - 1], ' ') AS phrase, max(f) AS f
  FROM (SELECT *, unnest(range(1, size)) AS i FROM candidates), range(2, 4) AS s(width)
  WHERE width < size AND i + width - 1 <= size GROUP BY ALL
),
ranked AS (
  SELECT w.lang, w.phrase, a, l, r, n, score,
         row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, encode(w.phrase)) AS rank
  FROM weakest w JOIN totals t ON w.lang = t.lang
  LEFT JOIN inside x ON x.lang = w.lang AND x.phrase = w.phrase
  WHERE x.f IS NULL OR 100 * x.f < 80 * w.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
