"""DuckDB SQL for the operators that SQL can express: plain routes to the same rows."""

from __future__ import annotations


def _crc32(text: str, table: str) -> str:
    """SQL of the unsigned crc32 of an ASCII string, by a table of 256 remainders."""
    steps = f"list_reduce([4294967295] || list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT), " \
            f"lambda c, x: xor(c >> 8, {table}[(xor(c, x) & 255) + 1]))"
    return f"xor({steps}, 4294967295)"


_CRC_TABLE = ("SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], "
              "lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS remainders "
              "FROM (SELECT unnest(range(256))::BIGINT AS i)")


def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR) || ':' || {x}::VARCHAR END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, nodes: str) -> str:
    """CTEs of a tree per ``grp``: its levels, and what flanks each node in its run."""
    run = f"PARTITION BY grp, lvl, pos // 16 ORDER BY pos ROWS BETWEEN"
    return f"""{name} AS (
  SELECT 0 AS lvl, grp, pos, node, count(*) OVER (PARTITION BY grp) AS n FROM {nodes}
  UNION ALL
  SELECT lvl + 1, grp, pos // 16, sha256(string_agg(node, '' ORDER BY pos)), (n + 15) // 16
  FROM {name} WHERE n > 1 GROUP BY lvl, grp, pos // 16, n),
{name}_flanks AS MATERIALIZED (
  SELECT lvl, grp, pos, coalesce(string_agg(node, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(node, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name} WHERE n > 1)"""


def _fold(name: str, tree: str, start: str) -> str:
    """CTEs that fold (id, grp, pos, acc, sib) up a tree."""
    return f"""{name} AS (
  SELECT id, grp, 0 AS lvl, pos, acc, sib FROM {start}
  UNION ALL
  SELECT f.id, f.grp, f.lvl + 1, f.pos // 16, sha256(t.before || f.acc || t.after), f.sib || t.before || t.after
  FROM {name} f JOIN {tree}_flanks t ON t.lvl = f.lvl AND t.grp = f.grp AND t.pos = f.pos),
{name}_end AS (SELECT id, arg_max(grp, lvl) AS grp, arg_max(acc, lvl) AS acc, arg_max(sib, lvl) AS sib FROM {name} GROUP BY id)"""


MERKLE = f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
rows AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, coalesce('1' || source, '0') AS grp, {_leaf('text')} AS leaf,
         CASE WHEN {_crc32('doc_id::VARCHAR', 'remainders')} % 5 = 0 THEN
           {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
  FROM documents, crc),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS node FROM rows),
{_tree('sources', 'leaves')},
subroots AS MATERIALIZED (
  SELECT '' AS grp, grp AS source, node, row_number() OVER (ORDER BY grp) - 1 AS pos FROM sources WHERE n = 1),
{_tree('whole', 'subroots')},
started AS (SELECT id, grp, pos, coalesce(tampered, leaf) AS acc, '' AS sib FROM leaves),
{_fold('lower_part', 'sources', 'started')},
halfway AS (SELECT e.id, s.grp, s.pos, e.acc, e.sib FROM lower_part_end e JOIN subroots s ON s.source = e.grp),
{_fold('upper_part', 'whole', 'halfway')}
SELECT l.doc_id, l.leaf, s.node AS subroot, w.node AS root, sha256(e.sib) AS proof_sha256, e.acc AS folded_root,
       e.acc = w.node AS verified
FROM leaves l JOIN subroots s ON s.source = l.grp JOIN upper_part_end e ON e.id = l.id
JOIN whole w ON w.n = 1
"""


def _product_codes(rounds: int = 6, entries: int = 16) -> str:
    """CTEs of Lloyd's rounds over parts of integer vectors, one after the other."""
    distance = "list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    ctes = [
        """kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 4096)::BIGINT) AS v,
         row_number() OVER (ORDER BY vec_id) - 1 AS nth
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """parts AS MATERIALIZED (
  SELECT vec_id, label, nth, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS v FROM kept, range(8) t(p))""",
        f"book0 AS MATERIALIZED (SELECT p, nth AS e, v FROM parts WHERE nth < {entries})"]
    for r in range(rounds + 1):
        ctes.append(f"""near{r} AS MATERIALIZED (
  SELECT x.vec_id, x.p, min({distance} * {entries} + c.e) AS far_and_entry
  FROM parts x JOIN book{r} c USING (p) GROUP BY x.vec_id, x.p)""")
        if r < rounds:
            ctes.append(f"""sums{r} AS (
  SELECT p, e, i, sum(x) AS s, count(*) AS n
  FROM (SELECT x.p, a.far_and_entry % {entries} AS e, unnest(x.v) AS x, unnest(range(len(x.v))) AS i
        FROM parts x JOIN near{r} a USING (vec_id, p)) GROUP BY p, e, i),
means{r} AS (
  SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM sums{r} GROUP BY p, e),
book{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN means{r} m USING (p, e))""")
    return "WITH " + ",\n".join(ctes) + f""",
coded AS (
  SELECT vec_id, string_agg(format('{{:02x}}', far_and_entry % {entries}), '' ORDER BY p) AS code,
         sum(far_and_entry // {entries})::BIGINT AS error
  FROM near{rounds} GROUP BY vec_id)
SELECT c.vec_id, c.code, c.error, sum(c.error) OVER (PARTITION BY k.label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM coded c JOIN kept k USING (vec_id)
"""


VECTOR_CODES = _product_codes()


_LEAK_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
               "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

DECONTAMINATE = f"""
WITH item_words AS (SELECT item_id::VARCHAR AS item_id, {_LEAK_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 10) AS n FROM item_words WHERE len(w) > 0),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, n, array_to_string(w[off + 1 : off + n], ' ') AS words
  FROM (SELECT item_id, w, n, unnest(range(len(w) - n + 1)) AS off FROM sized)),
doc_words AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, {_LEAK_WORDS} AS w FROM documents),
places AS (
  SELECT id, n, off, array_to_string(w[off + 1 : off + n], ' ') AS words
  FROM (SELECT id, w, n, unnest(range(len(w) - n + 1)) AS off FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS MATERIALIZED (SELECT p.id, p.off, p.n, x.item_id FROM places p JOIN windows x ON x.n = p.n AND x.words = p.words),
hits AS (SELECT id, count(DISTINCT off + k) AS n_hit FROM found, range(10) t(k) WHERE k < n GROUP BY id),
items AS (SELECT id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT id, item_id FROM found) GROUP BY id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits h USING (id) LEFT JOIN items i USING (id)
"""
