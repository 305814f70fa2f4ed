"""The same queries in DuckDB SQL, where SQL can express them."""

OP5 = r"""
WITH normal AS (
    SELECT doc_id,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
    FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM normal
"""

OP4 = r"""
WITH words AS (
    SELECT doc_id,
           [('0x' || substr(md5(w), 1, 5))::BIGINT
            for w in regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')] AS classes
    FROM documents
),
places AS (
    SELECT doc_id, classes[i] AS v, CASE WHEN i > 1 THEN classes[i - 1] END AS u
    FROM words, unnest(range(1, len(classes) + 1)) AS t(i)
),
uni AS (SELECT v AS w, count(*) AS c FROM places GROUP BY v),
bi AS (SELECT u, v, count(*) AS c FROM places WHERE u IS NOT NULL GROUP BY u, v HAVING count(*) >= 2),
total AS (SELECT sum(c) AS n FROM uni),
scored AS (
    SELECT p.doc_id,
           count(bi.c) AS n_seen,
           sum(CASE WHEN p.u IS NULL THEN ln(uv.c / n)
                    WHEN bi.c IS NULL THEN ln(0.4 * uv.c / n)
                    ELSE ln(bi.c / uu.c) END) AS s
    FROM places p
    CROSS JOIN total
    JOIN uni uv ON uv.w = p.v
    LEFT JOIN uni uu ON uu.w = p.u
    LEFT JOIN bi ON bi.u = p.u AND bi.v = p.v
    GROUP BY p.doc_id
)
SELECT doc_id,
       len(classes)::BIGINT AS n_words,
       coalesce(n_seen, 0)::BIGINT AS n_seen,
       round(s / len(classes), 6) AS lm_score
FROM words LEFT JOIN scored USING (doc_id)
"""

OP4_WORDS = r"""
WITH words AS (
    SELECT doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS spoken
    FROM documents
),
places AS (
    SELECT doc_id, spoken[i] AS v, CASE WHEN i > 1 THEN spoken[i - 1] END AS u
    FROM words, unnest(range(1, len(spoken) + 1)) AS t(i)
),
uni AS (SELECT v AS w, count(*) AS c FROM places GROUP BY v),
bi AS (SELECT u, v, count(*) AS c FROM places WHERE u IS NOT NULL GROUP BY u, v HAVING count(*) >= 2),
total AS (SELECT sum(c) AS n FROM uni),
scored AS (
    SELECT p.doc_id,
           count(bi.c) AS n_seen,
           sum(CASE WHEN p.u IS NULL THEN ln(uv.c / n)
                    WHEN bi.c IS NULL THEN ln(0.4 * uv.c / n)
                    ELSE ln(bi.c / uu.c) END) AS s
    FROM places p
    CROSS JOIN total
    JOIN uni uv ON uv.w = p.v
    LEFT JOIN uni uu ON uu.w = p.u
    LEFT JOIN bi ON bi.u = p.u AND bi.v = p.v
    GROUP BY p.doc_id
)
SELECT doc_id,
       len(spoken)::BIGINT AS n_words,
       coalesce(n_seen, 0)::BIGINT AS n_seen,
       round(s / len(spoken), 6) AS lm_score
FROM words LEFT JOIN scored USING (doc_id)
"""

OP6 = r"""
WITH captures AS (
    SELECT page_id,
           DATE '2024-01-01' + (page_id % 366)::INT AS fetched,
           regexp_replace(lower(regexp_extract(url,
               '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '\.+$', '') AS host,
           regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
),
hosts AS (
    SELECT host, x, ['malware', 'spam', 'adult'][x % 3 + 1] AS list,
           DATE '2023-10-01' + (x % 300 + x % 40) AS start
    FROM (SELECT DISTINCT host, ('0x' || substr(md5(host), 1, 6))::INT AS x
          FROM captures WHERE host <> '')
),
entries AS (
    SELECT list, 'host:' || host AS key, start AS dated, true AS active FROM hosts
    UNION ALL SELECT list, 'host:' || host, start + 50, false FROM hosts
    UNION ALL SELECT list, 'host:' || host, start + 20, true FROM hosts
    UNION ALL SELECT list, 'host:' || host, start + 150, true FROM hosts WHERE x % 4 = 0
    UNION ALL SELECT list, 'domain:' || regexp_replace(host, '^[^.]*[.]', ''), start + 30, true
              FROM hosts WHERE x % 23 = 0
    UNION ALL SELECT list, 'domain:' || regexp_replace(host, '^[^.]*[.]', ''), start + 90, false
              FROM hosts WHERE x % 23 = 0
    UNION ALL SELECT list, 'prefix:' || host || '/en', start + 80, true FROM hosts WHERE x % 5 = 0
),
days AS (SELECT list, key, dated, max(active) AS active FROM entries GROUP BY list, key, dated),
intervals AS (
    SELECT list, key, dated AS valid_from, active,
           lead(dated) OVER (PARTITION BY list, key ORDER BY dated) AS valid_to
    FROM days
),
keys AS (
    SELECT page_id, fetched, 'host:' || host AS key FROM captures WHERE host <> ''
    UNION
    SELECT page_id, fetched, 'domain:' || array_to_string(parts[i:], '.')
    FROM (SELECT page_id, fetched, string_split(host, '.') AS parts FROM captures WHERE host <> ''),
         unnest(range(1, len(parts) + 1)) AS t(i)
    UNION
    SELECT page_id, fetched, 'prefix:' || host || '/' || array_to_string(parts[1:i], '/')
    FROM (SELECT page_id, fetched, host,
                 [p for p in string_split(path, '/') if p <> ''] AS parts
          FROM captures WHERE host <> ''),
         unnest(range(1, len(parts) + 1)) AS t(i)
),
matches AS (
    SELECT page_id, count(*) AS n, string_agg(DISTINCT list, ',' ORDER BY list) AS lists
    FROM keys JOIN intervals USING (key)
    WHERE active AND valid_from <= fetched AND (valid_to IS NULL OR fetched < valid_to)
    GROUP BY page_id
)
SELECT page_id, host, fetched, coalesce(n, 0)::BIGINT AS n_matches,
       coalesce(lists, '') AS lists, n IS NOT NULL AS blocked
FROM captures LEFT JOIN matches USING (page_id)
"""

OP11 = r"""
WITH words AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
),
items AS (
    SELECT item_id, w, least(10, len(w)) AS size
    FROM (SELECT item_id, regexp_extract_all(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
          FROM benchmark)
    WHERE len(w) > 0
),
item_windows AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS gram
    FROM items, unnest(range(1, len(w) - size + 2)) AS t(i)
),
windows AS (
    SELECT row, i, size, array_to_string(w[i : i + size - 1], ' ') AS gram
    FROM words, (SELECT DISTINCT size FROM items) AS s,
         unnest(range(1, len(w) - size + 2)) AS t(i)
),
hits AS (
    SELECT row, i, v.size, item_id FROM windows AS v JOIN item_windows AS g
    ON v.size = g.size AND v.gram = g.gram
),
hit_words AS (
    SELECT row, count(DISTINCT p) AS n
    FROM (SELECT DISTINCT row, i, size FROM hits), unnest(range(i, i + size)) AS t(p) GROUP BY row
),
hit_items AS (
    SELECT row, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT row, item_id::VARCHAR AS name FROM hits WHERE item_id IS NOT NULL)
    GROUP BY row
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit,
       coalesce(k.n, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       h.n IS NOT NULL AS contaminated
FROM words LEFT JOIN hit_words AS h USING (row) LEFT JOIN hit_items AS k USING (row)
"""

# The checksum of a text: a table of 256 remainders, made by the rule of its polynomial, and a step
# for each byte.
_CRC_TABLE = """
    SELECT list_transform(range(256), lambda b: list_reduce(
        list_concat([b], range(8)),
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs
"""


def _crc32(text: str) -> str:
    """SQL for the unsigned checksum of a text, where a column ``crcs`` holds the table."""
    return f"""xor(4294967295, list_reduce(
        list_concat([4294967295], list_transform(range(octet_length(encode({text}))),
            lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])))"""


OP12 = rf"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
spoken AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
          FROM documents)
    GROUP BY ALL
),
checked AS (
    SELECT run, n, {_crc32("id || ':' || run")} AS h FROM spoken, crc WHERE length(run) >= 5
),
words AS (
    SELECT word, sum(n)::BIGINT AS n
    FROM (SELECT n, CASE WHEN h % 97 = 0
                         THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                         ELSE run END AS word
          FROM checked)
    WHERE length(word) >= 5
    GROUP BY word HAVING sum(n) >= 3
),
gaps AS (
    SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS gap,
           substr(word, 1, i - 1) || substr(word, i + 1) AS shorter
    FROM words, unnest(range(1, length(word) + 1)) AS t(i)
),
near AS (
    SELECT a.word, b.word AS other, b.n AS n FROM gaps a JOIN gaps b USING (gap) WHERE a.word <> b.word
    UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON w.word = g.shorter
    UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON w.word = g.shorter
),
best AS (
    SELECT word, count(*) AS n_near,
           arg_min(other, (-n, other)) AS other, arg_min(n, (-n, other)) AS other_n
    FROM near GROUP BY word
),
known AS (
    SELECT words.word, words.n, coalesce(n_near, 0)::BIGINT AS n_near,
           CASE WHEN other_n >= 2 * words.n THEN other END AS form,
           CASE WHEN other_n >= 2 * words.n THEN other_n END AS form_n
    FROM words LEFT JOIN best USING (word)
),
ways AS (
    SELECT word, word AS at, 0 AS step FROM known
    UNION ALL
    SELECT ways.word, known.form, step + 1
    FROM ways JOIN known ON known.word = ways.at WHERE known.form IS NOT NULL
)
SELECT known.word, known.form, max_by(ways.at, ways.step) AS root, known.n, known.n_near, known.form_n
FROM known JOIN ways ON ways.word = known.word
GROUP BY ALL
"""

def _field(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NULL THEN '-' ELSE "
        f"octet_length(encode({column}::VARCHAR)) || ':' || {column}::VARCHAR END"
    )


def _tree(name: str, leaves: str) -> str:
    """CTEs of the nodes of all trees of ``leaves`` (tree, place, digest), and of their tops."""
    return f"""
{name} AS (
    SELECT tree, 0 AS level, place, digest FROM {leaves}
    UNION ALL
    SELECT tree, any_value(level) + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place))
    FROM (SELECT *, max(place) OVER (PARTITION BY tree) AS last FROM {name}) WHERE last > 0
    GROUP BY tree, place // 3
),
{name}_top AS (
    SELECT tree, max(level) AS height, arg_max(digest, level) AS digest FROM {name} GROUP BY tree
)"""


def _climb(name: str, nodes: str, start: str) -> str:
    """CTEs that follow ``start`` (row, tree, place, way, fold) up its tree; the last are the ends."""
    return f"""
{name}_steps AS (
    SELECT row, tree, place, 0 AS level, way, fold FROM {start}
    UNION ALL
    SELECT c.row, any_value(c.tree), any_value(c.place) // 3, any_value(c.level) + 1,
           any_value(c.way) || coalesce(
               string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place <> c.place), ''),
           sha256(string_agg(CASE WHEN n.place = c.place THEN c.fold ELSE n.digest END, ''
                             ORDER BY n.place))
    FROM {name}_steps AS c
    JOIN {nodes} AS n ON n.tree = c.tree AND n.level = c.level AND n.place // 3 = c.place // 3
    JOIN {nodes}_top AS t ON t.tree = c.tree
    WHERE c.level < t.height
    GROUP BY c.row
),
{name} AS (
    SELECT row, any_value(tree) AS tree, arg_max(way, level) AS way, arg_max(fold, level) AS fold
    FROM {name}_steps GROUP BY row
)"""


OP13 = rf"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
hashed AS MATERIALIZED (
    SELECT row_number() OVER () AS row, doc_id, source,
           {" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))} AS head,
           {_field("text")} AS body,
           {_field("lost")} AS lost_body
    FROM (SELECT *, CASE WHEN {_crc32("doc_id::VARCHAR")} % 2 = 0 THEN replace(text, chr(10), '')
                         ELSE text END AS lost
          FROM documents, crc)
),
leaves AS MATERIALIZED (
    SELECT row, doc_id, sha256(head || body) AS digest, sha256(head || lost_body) AS claimed,
           dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
           row_number() OVER (
               PARTITION BY source ORDER BY doc_id NULLS FIRST, sha256(head || body)) - 1 AS place
    FROM hashed
),
{_tree("nodes", "leaves")},
subroots AS (SELECT 0 AS tree, tree AS place, digest FROM nodes_top),
{_tree("uppers", "subroots")},
{_climb("low", "nodes", "(SELECT row, tree, place, '' AS way, claimed AS fold FROM leaves)")},
{_climb("high", "uppers", "(SELECT row, 0 AS tree, tree AS place, way, fold FROM low)")}
SELECT doc_id, leaves.digest AS leaf, nodes_top.digest AS subroot, uppers_top.digest AS root,
       sha256(way) AS proof_sha256, fold AS folded_root, fold = uppers_top.digest AS verified
FROM leaves
JOIN high USING (row)
JOIN nodes_top ON nodes_top.tree = leaves.tree
CROSS JOIN uppers_top
"""


ORACLES: dict[str, str] = {
    "op4_lm_score": OP4,
    "op4_lm_score_words": OP4_WORDS,
    "op5_exact_dedup": OP5,
    "op6_url_filter": OP6,
    "op11_decontamination": OP11,
    "op12_spelling_variants": OP12,
    "op13_merkle_manifest": OP13,
}
