"""SQL of the Merkle manifest and of the collocations, for DuckDB."""

from __future__ import annotations

LEVELS = 8  # unrolled levels of a language's tree: up to 8^8 leaves
TOP_LEVELS = 3  # of the tree over the languages' roots


def _tree(name: str, levels: int) -> str:
    """CTEs ``name_1 … name_levels`` over ``name_0 (g, n, pos, node)``; ``name_k_s`` holds each node's siblings on that level."""
    out = []
    for k in range(levels):
        own = f"PARTITION BY g, pos // 8 ORDER BY pos ROWS BETWEEN"
        out.append(f"""{name}_{k}_s AS MATERIALIZED (SELECT g, pos, coalesce(string_agg(node, '') OVER ({own} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
            coalesce(string_agg(node, '') OVER ({own} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}_{k} WHERE n > 1)""")
        out.append(f"""{name}_{k + 1} AS MATERIALIZED (SELECT g, (n + 7) // 8 AS n, pos // 8 AS pos, sha256(string_agg(node, '' ORDER BY pos)) AS node
            FROM {name}_{k} WHERE n > 1 GROUP BY g, n, pos // 8 UNION ALL SELECT * FROM {name}_{k} WHERE n = 1)""")
    return ",\n".join(out)


def _fold(name: str, levels: int, start: str, result: str, pos: str) -> str:
    """CTEs that carry (leaf columns, h, p) of ``start`` up the tree: ``h`` folded with the siblings, ``p`` all siblings in order."""
    out, last = [], start
    for k in range(levels):
        now = result if k == levels - 1 else f"{result}_{k}"
        out.append(f"""{now} AS MATERIALIZED (SELECT f.* REPLACE (CASE WHEN s.l IS NULL THEN h ELSE sha256(s.l || h || s.r) END AS h, p || coalesce(s.l || s.r, '') AS p)
            FROM {last} f LEFT JOIN {name}_{k}_s s ON s.g = f.{'g' if name == 't' else 'z'} AND s.pos = f.{pos} // {8 ** k})""")
        last = now
    return ",\n".join(out)


def _leaf(text: str) -> str:
    fields = ["doc_id", '"source"', "lang", "n_chars", text]
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields) + ")"


MERKLE = f"""WITH RECURSIVE bits AS (SELECT i::BIGINT AS i, i::BIGINT AS v, 0 AS k FROM range(256) t(i)
    UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
docs AS (SELECT d.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295::BIGINT) AS crc FROM documents d, crc),
leaves AS (SELECT coalesce('=' || lang, '') AS g, doc_id, {_leaf('text')} AS leaf,
    CASE WHEN crc % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_leaf('text')} END AS other FROM docs),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves),
t_0 AS (SELECT g, n, pos, leaf AS node FROM placed),
{_tree('t', LEVELS)},
u_0 AS MATERIALIZED (SELECT 0 AS g, count(*) OVER () AS n, row_number() OVER (ORDER BY g) - 1 AS pos, node, g AS own FROM t_{LEVELS}),
u_in AS (SELECT g, n, pos, node FROM u_0),
{_tree('u', TOP_LEVELS).replace('FROM u_0 WHERE', 'FROM u_in WHERE')},
start AS (SELECT p.g, p.doc_id, p.leaf, p.pos, p.other AS h, '' AS p, 0 AS z, u.pos AS top, u.node AS subroot FROM placed p JOIN u_0 u ON u.own = p.g),
{_fold('t', LEVELS, 'start', 'low', 'pos')},
{_fold('u', TOP_LEVELS, 'low', 'high', 'top')}
SELECT doc_id, leaf, subroot, root, sha256(p) AS proof_sha256, h AS folded_root, h = root AS verified
FROM high, (SELECT node AS root FROM u_{TOP_LEVELS})"""

COLLOCATIONS = r"""WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
f AS MATERIALIZED (SELECT lang, p, k, count(*) AS f FROM (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 5) t(k) WHERE len(w) >= k))
    GROUP BY lang, p, k),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, p, string_split(p, ' ') AS w, f AS a FROM f WHERE k > 1 AND f >= 30),
cuts AS (SELECT lang, p, w, a, unnest(range(1, len(w))) AS k FROM candidates),
parts AS MATERIALIZED (SELECT lang, p, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y FROM cuts),
scores AS (SELECT c.lang, c.p, c.a, min({'score': 2000000::HUGEINT * c.a // (x.f + y.f), 'k': c.k, 'l': x.f, 'r': y.f}) AS s
    FROM parts c JOIN f x ON x.lang = c.lang AND x.p = c.x JOIN f y ON y.lang = c.lang AND y.p = c.y GROUP BY c.lang, c.p, c.a),
inner_ AS (SELECT lang, a AS longer, array_to_string(w[i:i + k - 1], ' ') AS p FROM (
    SELECT lang, a, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM candidates, range(2, 4) t(k) WHERE len(w) > k)),
covers AS (SELECT lang, p, max(longer) AS longer FROM inner_ GROUP BY lang, p),
kept AS (SELECT s.lang, s.p AS phrase, a, s.s.l AS l, s.s.r AS r, s.s.score::BIGINT AS score
    FROM scores s LEFT JOIN covers c ON c.lang = s.lang AND c.p = s.p WHERE coalesce(100 * longer < 80 * a, true)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""
