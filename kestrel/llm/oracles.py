"""DuckDB SQL of the text operators, written from the contracts."""

from __future__ import annotations

_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


def _crc32(word: str) -> str:
    """CRC-32 of a text's UTF-8 bytes (reflected polynomial 0xEDB88320), bit by bit."""
    step = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    for _ in range(7):
        step = f"list_transform([{step}], lambda c: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)[1]"
    table = f"(SELECT list({step} ORDER BY c0) FROM (SELECT range AS c0, range AS c FROM range(256)))"
    data = f"list_transform(range(octet_length(encode({word}))), " \
           f"lambda i: CAST('0x' || substr(hex(encode({word})), 2 * i + 1, 2) AS BIGINT))"
    return (f"xor(list_reduce(list_prepend(4294967295, {data}), "
            f"lambda crc, b: xor(crc // 256, crc_table[CAST(xor(crc % 256, b) AS INTEGER) + 1])), 4294967295)"), table


def resampling_sql() -> str:
    crc, table = _crc32("word")
    words = f"unnest(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'))"
    return f"""
WITH crc AS (SELECT {table} AS crc_table),
d AS (SELECT doc_id, {words} AS word FROM documents),
b AS (SELECT {words} AS word FROM benchmark),
vocabulary AS (SELECT DISTINCT word FROM (SELECT word FROM d UNION ALL SELECT word FROM b)),
hashed AS (SELECT word, {crc} % 10000 AS bucket FROM vocabulary, crc),
own AS (SELECT bucket, count(*) AS s FROM d JOIN hashed USING (word) GROUP BY 1),
wanted AS (SELECT bucket, count(*) AS t FROM b JOIN hashed USING (word) GROUP BY 1),
totals AS (SELECT (SELECT count(*) FROM d) AS s_all, (SELECT count(*) FROM b) AS t_all),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE)
                     / (CAST(s + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM own LEFT JOIN wanted USING (bucket), totals),
sums AS (SELECT doc_id, count(*) AS n, sum(gain) AS total FROM d JOIN hashed USING (word) JOIN gains USING (bucket)
         GROUP BY 1),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(CAST(floor(total / n) AS BIGINT), 0) AS weight,
         CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h
  FROM documents LEFT JOIN sums USING (doc_id)),
noisy AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
                  count(*) OVER (PARTITION BY n_features >= 20) AS among FROM noisy)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * among // 100 THEN place END AS rank
FROM ranked"""


def filter_audit_sql() -> str:
    return r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
failed AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM d),
counted AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good,
         count(*) FILTER (WHERE toxic = 1) AS bad
  FROM failed LEFT JOIN labels USING (doc_id) GROUP BY 1, 2),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, CAST(range AS INTEGER) AS step, substr(filter_order, range, 1) AS letter,
                 substr(filter_order, 1, range - 1) AS before FROM orders, range(1, 6)),
seen AS (
  SELECT part, filter_order, step, letter, n, good, bad, fails, contains(fails, letter) AS here,
         translate(fails, before, '') <> fails AS earlier
  FROM steps, counted),
summed AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (WHERE NOT here AND NOT earlier), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE here AND NOT earlier), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE here AND earlier), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE fails = letter), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE here AND NOT earlier), 0) AS good_lost,
         coalesce(sum(bad) FILTER (WHERE here AND NOT earlier), 0) AS toxic_lost
  FROM seen GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM summed"""
