"""Equivalent SQL (DuckDB dialect) of the corpus queries that SQL can express."""

from __future__ import annotations

# Every pair of a query and another vector, ranked by the exact inner product.
TOP10 = """
    WITH vectors AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, d.vec_id,
               CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM vectors AS q JOIN vectors AS d ON q.vec_id <> d.vec_id
        WHERE q.vec_id % 100 = 0)
    SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
    FROM scored
    WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER w <= 10"""

# Base32 takes five bits at a time from the forty hexadecimal digits of the digest.
RECORDS = """
    WITH payloads AS (
        SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
    digests AS (
        SELECT page_id, hex, octet_length(encode(payload)) AS payload_bytes,
               list_transform(range(40), lambda i: instr('0123456789abcdef', hex[i + 1]) - 1) AS d
        FROM payloads),
    named AS (
        SELECT *, list_aggregate(list_transform(range(32), lambda g:
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
                       ((d[g * 5 // 4 + 1] * 16 + coalesce(d[g * 5 // 4 + 2], 0)) >> (3 - g * 5 % 4)) % 32 + 1]),
                   'string_agg', '') AS payload_digest
        FROM digests),
    firsts AS (SELECT hex, min(page_id) AS first FROM named GROUP BY hex)
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM named JOIN firsts USING (hex)"""

# All places at which an item and a document have a word in common, by their shift;
# then every window of a shift with enough of them. No hashes and no masks. Eight words
# in ten have to agree; of items below eight words, all.
LEAKS = """
    WITH doc_words AS (
        SELECT doc_id, text, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS ws
        FROM documents WHERE text IS NOT NULL),
    item_words AS (
        SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS ws
        FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
    texts AS (SELECT text, any_value(ws) AS ws FROM doc_words GROUP BY text),
    items AS (
        SELECT item_id, ws, len(ws) AS n, least(13, len(ws)) AS width,
               CASE WHEN len(ws) < 8 THEN len(ws) ELSE (8 * least(13, len(ws)) + 9) // 10 END AS need
        FROM item_words WHERE len(ws) > 0),
    d AS (SELECT text, len(ws) AS m, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM texts),
    b AS (SELECT item_id, unnest(ws) AS w, unnest(range(len(ws))) AS j FROM items),
    matches AS (SELECT text, any_value(m) AS m, item_id, i - j AS shift, list(j ORDER BY j) AS js
                FROM d JOIN b USING (w) GROUP BY text, item_id, i - j),
    windows AS (
        SELECT text, item_id, n, shift, width, need, js,
               unnest(range(greatest(0, -shift), least(n, m - shift) - width + 1)) AS s
        FROM matches JOIN items USING (item_id) WHERE len(js) >= need),
    counted AS (
        SELECT *, len(list_filter(js, lambda j: j >= s AND j < s + width)) AS matched FROM windows),
    best AS (
        SELECT text, item_id, n, matched, s, shift FROM counted WHERE matched >= need
        QUALIFY row_number() OVER (PARTITION BY text, item_id ORDER BY matched DESC, s, shift) = 1)
    SELECT doc_id, item_id, CAST(matched AS INTEGER) AS matched, CAST(n AS INTEGER) AS item_words,
           CAST(s AS INTEGER) AS item_start, CAST(s + shift AS INTEGER) AS text_start
    FROM best JOIN doc_words USING (text)"""

# One global order, cut at equal parts of all bytes. CRC-32 byte by byte from its table.
SHARDS = """
    WITH crc_table AS (
        SELECT list(v ORDER BY n) AS tab
        FROM (SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, k:
                  CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v
              FROM (SELECT unnest(range(256)) AS n))),
    sized AS (
        SELECT doc_id, coalesce(text, '') AS text, octet_length(encode(coalesce(text, ''))) + 16 AS size,
               CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS grp
        FROM documents),
    texts AS (
        SELECT DISTINCT text, list_transform(string_split(hex(encode(text)), ''),
                   lambda x: instr('0123456789ABCDEF', x) - 1) AS d
        FROM sized),
    bytes AS (SELECT text, list_transform(range(len(d) // 2), lambda i: d[2 * i + 1] * 16 + d[2 * i + 2]) AS bs FROM texts),
    sums AS (
        SELECT text, xor(4294967295, list_reduce(list_prepend(4294967295, bs),
                   lambda c, x: xor(c >> 8, tab[xor(c, x) % 256 + 1]))) AS text_crc32
        FROM bytes, crc_table),
    placed AS (
        SELECT *, sum(size) OVER w - size AS offset_, row_number() OVER w - 1 AS place,
               sum(size) OVER () / 40 AS target
        FROM sized
        WINDOW w AS (ORDER BY grp, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)),
    groups AS (SELECT grp, min(offset_) AS grp_start, sum(size) AS grp_bytes FROM placed GROUP BY grp),
    cut AS (
        SELECT *, CAST(least(39, floor(
                   CASE WHEN grp_bytes <= target * 0.01 THEN grp_start + grp_bytes / 2
                        ELSE offset_ + size / 2 END / target)) AS INTEGER) AS shard
        FROM placed JOIN groups USING (grp))
    SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
           CAST(place - min(place) OVER (PARTITION BY shard) AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
    FROM cut JOIN sums USING (text)"""


# Every window as text, with the smallest document it begins in; no hashes.
WINDOWS = """
    WITH docs AS (
        SELECT row_number() OVER () AS row_, doc_id,
               list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '') AS ws
        FROM documents),
    starts AS (SELECT row_, doc_id, ws, unnest(range(len(ws) - 49)) AS s FROM docs WHERE doc_id IS NOT NULL),
    windows AS (SELECT row_, doc_id, s, md5(array_to_string(list_slice(ws, s + 1, s + 50), ' ')) AS w FROM starts),
    firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
    gone AS (SELECT row_, list(DISTINCT s + i) AS removed
             FROM (SELECT row_, s, unnest(range(50)) AS i FROM windows JOIN firsts USING (w) WHERE doc_id > first)
             GROUP BY row_),
    words AS (SELECT row_, unnest(ws) AS w, unnest(range(len(ws))) AS place FROM docs),
    lost AS (SELECT row_, unnest(removed) AS place FROM gone),
    kept AS (SELECT row_, string_agg(w, ' ' ORDER BY place) AS kept, count(*) AS n_kept
             FROM words ANTI JOIN lost USING (row_, place) GROUP BY row_)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM docs LEFT JOIN kept USING (row_)"""

# CRC-32 byte by byte; near words by what is left when one code point is taken out.
VARIANTS = """
    WITH RECURSIVE crc_table AS (
        SELECT list(v ORDER BY n) AS tab
        FROM (SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, k:
                  CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v
              FROM (SELECT unnest(range(256)) AS n))),
    runs AS (
        SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+')) AS run FROM documents)
        GROUP BY ALL),
    hexed AS (
        SELECT *, list_transform(string_split(hex(encode(doc_id || ':' || w)), ''),
                   lambda x: instr('0123456789ABCDEF', x) - 1) AS d
        FROM runs),
    hashed AS (
        SELECT w, n, length(w) AS len, xor(4294967295, list_reduce(list_prepend(4294967295,
                   list_transform(range(len(d) // 2), lambda i: d[2 * i + 1] * 16 + d[2 * i + 2])),
                   lambda c, x: xor(c >> 8, tab[xor(c, x) % 256 + 1]))) AS h
        FROM hexed, crc_table),
    words AS MATERIALIZED (
        SELECT word, CAST(sum(n) AS BIGINT) AS n
        FROM (SELECT CASE WHEN h % 31 = 0 THEN left(w, CAST(h % len AS INTEGER)) || substr(w, CAST(h % len AS INTEGER) + 2)
                          ELSE w END AS word, n FROM hashed)
        WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    shorter AS MATERIALIZED (
        SELECT word, n, place, left(word, place) || substr(word, place + 2) AS rest
        FROM (SELECT word, n, unnest(range(CAST(length(word) AS INTEGER))) AS place FROM words)),
    pairs AS (
        SELECT a.word AS u, a.n AS un, b.word AS v, b.n AS vn
        FROM shorter AS a JOIN shorter AS b ON a.rest = b.rest AND a.place = b.place AND a.word < b.word
        UNION
        SELECT a.word, a.n, b.word, b.n FROM shorter AS a JOIN words AS b ON a.rest = b.word),
    near AS (SELECT u AS word, v AS near, vn AS near_n FROM pairs UNION ALL SELECT v, u, un FROM pairs),
    best AS (
        SELECT word, count(*) OVER (PARTITION BY word) AS n_near, near, near_n FROM near
        QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
    forms AS MATERIALIZED (
        SELECT word, n, coalesce(n_near, 0) AS n_near,
               CASE WHEN near_n >= 10 * n THEN near END AS form, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
        FROM words LEFT JOIN best USING (word)),
    chain AS (
        SELECT word, form AS last FROM forms WHERE form IS NOT NULL
        UNION ALL
        SELECT chain.word, forms.form FROM chain JOIN forms ON chain.last = forms.word WHERE forms.form IS NOT NULL),
    roots AS (SELECT chain.word, last AS root FROM chain JOIN forms ON chain.last = forms.word WHERE forms.form IS NULL)
    SELECT word, form, coalesce(root, word) AS root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
    FROM forms LEFT JOIN roots USING (word)"""


def _lloyd() -> str:
    """Three rounds from hashed starts, every distance measured; a step of common table expressions a round."""
    start = """
    WITH vectors AS MATERIALIZED (
        SELECT row_number() OVER () AS row_, vec_id, v
        FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
              FROM embeddings
              WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
    components AS MATERIALIZED (SELECT row_, unnest(range(64)) AS place, unnest(v) AS x FROM vectors),
    c0 AS MATERIALIZED (
        SELECT CAST(row_number() OVER w - 1 AS INTEGER) AS cluster, v FROM vectors
        WINDOW w AS (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) QUALIFY row_number() OVER w <= 16)"""
    assign = """,
    a{n} AS MATERIALIZED (
        SELECT row_, vec_id, cluster, distance
        FROM (SELECT row_, vec_id, cluster, CAST(list_sum(list_transform(list_zip(a.v, c.v),
                         lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
              FROM vectors AS a, c{n} AS c)
        QUALIFY row_number() OVER (PARTITION BY row_ ORDER BY distance, cluster) = 1)"""
    move = """,
    s{m} AS MATERIALIZED (
        SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY place) AS v
        FROM (SELECT cluster, place, CAST(sum(x) AS BIGINT) AS total, count(*) AS n
              FROM components JOIN a{n} USING (row_) GROUP BY cluster, place)
        GROUP BY cluster),
    c{m} AS MATERIALIZED (SELECT cluster, coalesce(s{m}.v, c{n}.v) AS v FROM c{n} LEFT JOIN s{m} USING (cluster))"""
    rounds = "".join(assign.format(n=n) + move.format(n=n, m=n + 1) for n in range(3))
    return start + rounds + assign.format(n=3) + """
    SELECT vec_id, cluster, distance,
           CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
           CAST(sum(distance) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(v, ',')) AS centroid_sha256
    FROM a3 JOIN c3 USING (cluster)"""


# Sources fill up by size per weight; the first that isn't full sets the level of the rest.
# Whole passes take every word, so only the last, partial pass needs its blocks: each slot
# walks sixteen rounds of trades to the block it takes.
MIX = """
    WITH RECURSIVE sized AS (
        SELECT doc_id, source, size,
               CAST('0x' || md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), 'null'), size, 0))[:15] AS BIGINT) AS turn
        FROM (SELECT doc_id, source, CAST(len(list_filter(
                  regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS BIGINT) AS size
              FROM documents)),
    weighed AS (
        SELECT *, CAST([3, 1, 2][(sid - 1) % 3 + 1] AS DOUBLE) AS weight, 1.5::DOUBLE * sum(source_size) OVER () AS pool
        FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(ceil(count(*) / 4096) AS BIGINT) AS cells,
                     row_number() OVER (ORDER BY source NULLS LAST) AS sid
              FROM sized GROUP BY source)),
    levels AS (
        SELECT a.sid, any_value(a.weight) AS weight, any_value(a.source_size) AS source_size,
               (any_value(a.pool) - coalesce(sum(2::DOUBLE * b.source_size) FILTER (
                    (b.source_size / b.weight, b.sid) < (a.source_size / a.weight, a.sid)), 0))
               / sum(b.weight) FILTER ((b.source_size / b.weight, b.sid) >= (a.source_size / a.weight, a.sid)) AS level
        FROM weighed AS a, weighed AS b GROUP BY a.sid),
    chosen AS (
        SELECT arg_min(level, (source_size / weight, sid)) AS level FROM levels
        WHERE weight * level <= 2::DOUBLE * source_size),
    targets AS (
        SELECT sid, source, source_size, cells, target, CAST(round(target) AS BIGINT) AS goal
        FROM (SELECT *, least(2::DOUBLE * source_size, coalesce(weight * (SELECT level FROM chosen), 2::DOUBLE * source_size)) AS target
              FROM weighed)),
    passes AS (
        SELECT sid, CASE WHEN goal > 0 THEN goal // source_size ELSE 0 END AS whole,
               CASE WHEN goal > 0 THEN goal % source_size ELSE 0 END AS take, source_size // 512 AS blocks
        FROM targets),
    placed AS (
        SELECT row_number() OVER () AS n, doc_id, size, t.*,
               sum(size) OVER (PARTITION BY sid ORDER BY turn % cells, turn, doc_id NULLS FIRST, size
                               ROWS UNBOUNDED PRECEDING) - size AS first_word
        FROM sized AS s JOIN targets AS t ON s.source IS NOT DISTINCT FROM t.source),
    walk AS (
        SELECT sid, whole, take, blocks, slot, slot AS block, 0 AS step
        FROM (SELECT *, unnest(range((take + 511) // 512)) AS slot FROM passes)
        UNION ALL
        SELECT sid, whole, take, blocks, slot,
               CASE WHEN slot < blocks AND CAST('0x' || md5(concat_ws(':', sid, whole, 0, step + 1, greatest(block, mirror)))[:15] AS BIGINT) % 2 = 1
                    THEN mirror ELSE block END,
               step + 1
        FROM (SELECT *, (CAST('0x' || md5(concat_ws(':', sid, whole, 0, step + 1))[:15] AS BIGINT) % greatest(blocks, 1)
                         + greatest(blocks, 1) - block) % greatest(blocks, 1) AS mirror
              FROM walk WHERE step < 16)),
    taken AS (
        SELECT n, sum(least(first_word + size, block * 512 + words) - greatest(first_word, block * 512)) AS words
        FROM placed JOIN (SELECT sid, block, least(512, take - slot * 512) AS words FROM walk WHERE step = 16) AS w USING (sid)
        WHERE first_word < block * 512 + words AND first_word + size > block * 512
        GROUP BY n)
    SELECT doc_id, size, source, source_size, target,
           CAST(whole * size + coalesce(taken.words, 0) AS BIGINT) AS taken
    FROM placed JOIN passes USING (sid) LEFT JOIN taken USING (n)"""

ORACLE = {
    "op11_orchard_clusters": _lloyd(),
    "op12_spelling_variants": VARIANTS,
    "op13_repeated_windows": WINDOWS,
    "op10_byte_shards": SHARDS,
    "op1_voronoi_top10": TOP10,
    "op7_warc_roundtrip": RECORDS,
    "op8_spaced_seed_leaks": LEAKS,
    "op9_mixed_sources": MIX,
}
