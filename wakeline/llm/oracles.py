"""DuckDB SQL for the queries that SQL can express."""

SUBSTRING_DEDUP = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row_id, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), starts AS (
    SELECT row_id, words, unnest(range(1, len(words) - 33)) AS pos FROM texts WHERE len(words) >= 35
), windows AS (
    SELECT row_id, pos, count(*) OVER (PARTITION BY array_to_string(words[pos:pos + 34], ' ')) AS times FROM starts
), gone AS (
    SELECT DISTINCT row_id, unnest(range(pos, pos + 35)) AS pos FROM windows WHERE times > 1
), kept AS (
    SELECT w.row_id, string_agg(w.word, ' ' ORDER BY w.pos) AS text, count(*) AS n
    FROM (SELECT row_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM texts) w
    ANTI JOIN gone g ON g.row_id = w.row_id AND g.pos = w.pos
    GROUP BY w.row_id
)
SELECT t.doc_id, len(t.words)::BIGINT AS n_words, (len(t.words) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON k.row_id = t.row_id
"""

CONTAMINATION = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS size,
           array_to_string(words[pos:pos + least(len(words), 10) - 1], ' ') AS run
    FROM (SELECT *, unnest(range(1, greatest(len(words) - 8, 2))) AS pos FROM items WHERE len(words) > 0)
), text_windows AS (
    SELECT row_id, pos, size, array_to_string(words[pos:pos + size - 1], ' ') AS run
    FROM (SELECT row_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos
          FROM texts, (SELECT DISTINCT size FROM item_windows) WHERE len(words) >= size)
), found AS (
    SELECT row_id, pos, t.size, item_id FROM text_windows t JOIN item_windows i USING (size, run)
), hits AS (
    SELECT row_id, count(DISTINCT word) AS n
    FROM (SELECT row_id, unnest(range(pos, pos + size)) AS word FROM found) GROUP BY row_id
), lists AS (
    SELECT row_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT row_id, item_id::VARCHAR AS item FROM found) GROUP BY row_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(l.n, 0)::BIGINT AS n_items,
       sha256(coalesce(l.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM texts t LEFT JOIN hits h USING (row_id) LEFT JOIN lists l USING (row_id)
"""

URL_FILTERS = r"""
WITH parts AS (
    SELECT row_number() OVER () AS row_id, page_id,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), rules(rule_host, rule_path, verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), best AS (
    SELECT row_id, rule_host || rule_path AS rule, verdict
    FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY length(rule_host) DESC, length(rule_path) DESC) = 1
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (row_id)
"""

PERSPECTIVES = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS speaker, coalesce(text, '') AS text, row_number() OVER () AS row_id
    FROM conversations
), own AS (
    SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'
), seen AS (
    SELECT s.*, o.perspective,
           CASE WHEN s.speaker = o.perspective THEN 'assistant' WHEN s.speaker = 'system' THEN 'system' ELSE 'user' END AS role
    FROM said s JOIN own o ON s.conv_id IS NOT DISTINCT FROM o.conv_id
), pieces AS (
    SELECT *, '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || speaker ELSE '' END || chr(10)
              || text || '<|im_end|>' || chr(10) AS rendered
    FROM seen
), placed AS (
    SELECT *, coalesce(sum(length(rendered)) OVER w, 0) AS start, count(*) OVER w AS seq
    FROM pieces
    WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text, row_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT conv_id, perspective, turn, seq::BIGINT AS seq, speaker, role, rendered, start::BIGINT AS start,
       (start + length(rendered))::BIGINT AS "end", role = 'assistant' AS trained,
       CASE WHEN role = 'assistant' THEN start + length(rendered) - length(text) - 11
            ELSE start + length(rendered) END::BIGINT AS loss_start,
       CASE WHEN role = 'assistant' THEN start + length(rendered) - 1 ELSE start + length(rendered) END::BIGINT AS loss_end
FROM placed
"""

LINE_DEDUP = r"""
WITH texts AS (
    SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, md5(text)) AS row_id, doc_id, text, string_split(text, chr(10)) AS parts
    FROM documents
), split AS (
    SELECT row_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS pos FROM texts
), lines AS (
    SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY pos) AS seq
    FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), pairs AS (
    SELECT *, lead(line) OVER (PARTITION BY row_id ORDER BY pos) AS next_line FROM lines
), marked AS (
    SELECT *, next_line IS NOT NULL AND row_number() OVER (PARTITION BY line, next_line ORDER BY row_id, seq) > 1 AS starts,
           length(line) >= 120 AND row_number() OVER (PARTITION BY line ORDER BY row_id, seq) > 1 AS again
    FROM pairs
), gone AS (
    SELECT row_id, pos FROM (
        SELECT row_id, pos, again OR starts OR coalesce(lag(starts) OVER (PARTITION BY row_id ORDER BY pos), false) AS out FROM marked
    ) WHERE out
), kept AS (
    SELECT row_id, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n
    FROM split ANTI JOIN gone USING (row_id, pos) GROUP BY row_id
)
SELECT doc_id, coalesce(len(parts), 0)::BIGINT AS n_lines, (coalesce(len(parts), 0) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (row_id)
"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


# The checksum of a decimal number, bit by bit, without its last complement: it is odd where the checksum is even.
_CRC = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)"""


def _tree(name: str, rows: str, part: str) -> str:
    """Nodes of all levels; steps from each row of ``rows`` (``part``, rank, n) up to its root."""
    return f"""
{name}_nodes(part, level, place, n, digest) AS (
  SELECT {part}, 0, rank, n, digest FROM {rows}
  UNION ALL
  SELECT part, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
  FROM {name}_nodes WHERE n > 1 GROUP BY part, level, place // 3, n),
{name}_own AS (
  SELECT {part} AS part, rank, unnest(range(0, 38)) AS level FROM {rows}),
{name}_steps AS (
  SELECT o.part, o.rank, o.level,
         coalesce(string_agg(digest, '' ORDER BY place) FILTER (place < o.rank // CAST(pow(3, o.level) AS BIGINT)), '') || '|' ||
         coalesce(string_agg(digest, '' ORDER BY place) FILTER (place > o.rank // CAST(pow(3, o.level) AS BIGINT)), '') AS step
  FROM {name}_own o JOIN {name}_nodes s
    ON s.part IS NOT DISTINCT FROM o.part AND s.level = o.level AND s.n > 1 AND s.place // 3 = o.rank // CAST(pow(3, o.level + 1) AS BIGINT)
  GROUP BY o.part, o.rank, o.level),
{name}_paths AS (
  SELECT part, rank, list(step ORDER BY level) AS path FROM {name}_steps GROUP BY part, rank)"""


MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_leaf("text")} AS digest,
         CASE WHEN {_CRC} % 2 = 1 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS changed
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS rank,
         count(*) OVER (PARTITION BY source) AS n
  FROM leaves),
{_tree("leaf", "ranked", "source")},
parts AS (
  SELECT part AS source, digest, row_number() OVER (ORDER BY part NULLS FIRST) - 1 AS rank, count(*) OVER () AS n, 1 AS forest
  FROM leaf_nodes WHERE n = 1),
{_tree("part", "parts", "forest")},
whole AS (
  SELECT r.doc_id, r.digest AS leaf, r.changed, p.digest AS subroot, (SELECT digest FROM part_nodes WHERE n = 1) AS root,
         list_concat(coalesce(a.path, []), coalesce(b.path, [])) AS path
  FROM ranked r JOIN parts p ON p.source IS NOT DISTINCT FROM r.source
  LEFT JOIN leaf_paths a ON a.part IS NOT DISTINCT FROM r.source AND a.rank = r.rank
  LEFT JOIN part_paths b ON b.rank = p.rank),
folded AS (
  SELECT *, list_reduce(list_prepend(changed, path),
                        lambda node, s: sha256(split_part(s, '|', 1) || node || split_part(s, '|', 2))) AS folded_root
  FROM whole)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded"""
