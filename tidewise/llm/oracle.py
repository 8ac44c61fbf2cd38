"""SQL of the corpus queries that SQL can express, for the tables as DuckDB views."""

from __future__ import annotations

from .mixing import LEVELS, UNIT
from .urls import DEPTH, KINDS, LOWER, PRIOR, RARE, SIMILAR, THRESHOLD, UPPER


def _names(columns, prefix: str = "") -> str:
    return ", ".join(prefix + c for c in columns)


def _same(columns, left: str, right: str) -> str:
    return " AND ".join(f"{left}.{c} IS NOT DISTINCT FROM {right}.{c}" for c in columns)


def _share_sql(depth: int, weights: dict[str, dict[str, float]]) -> str:
    """The budgets of one level's nodes from those of the level above."""
    path, above, name = LEVELS[: depth + 1], ("root", *LEVELS[:depth]), LEVELS[depth]
    listed = " ".join(f"WHEN {name} = '{k}' THEN {round(v * UNIT)}" for k, v in weights.get(name, {}).items())
    weight = f"CASE {listed} ELSE {UNIT} END" if listed else f"{UNIT}"
    siblings = f"PARTITION BY {_names(above)}"
    order = f"({siblings} ORDER BY room::DOUBLE / weight ASC NULLS LAST, {name} ASC NULLS FIRST"
    return f"""
c{depth} AS (SELECT 0 AS root, {_names(path)}, sum(room)::HUGEINT AS room, {weight} AS weight FROM nodes GROUP BY ALL),
h{depth} AS (SELECT c.*, p.given::HUGEINT AS given FROM c{depth} c JOIN p{depth} p ON {_same(above, "c", "p")}),
w{depth} AS (
  SELECT *, greatest(given - coalesce(sum(room) OVER {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS rest,
    sum(weight) OVER {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS onward FROM h{depth}),
f{depth} AS (SELECT *, min(CASE WHEN room * onward <= rest * weight THEN 1 ELSE 0 END) OVER {order}
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1 AS filled FROM w{depth}),
o{depth} AS (SELECT *, max(CASE WHEN NOT filled THEN rest END) OVER ({siblings}) AS open_rest,
    max(CASE WHEN NOT filled THEN onward END) OVER ({siblings}) AS open_weights FROM f{depth}),
s{depth} AS (SELECT *, CASE WHEN filled THEN room ELSE (open_rest * weight) // open_weights END AS part FROM o{depth}),
t{depth} AS (SELECT *, open_rest - sum(CASE WHEN NOT filled THEN part END) OVER ({siblings}) AS spare,
    row_number() OVER ({siblings} ORDER BY filled, {name} ASC NULLS FIRST) AS turn FROM s{depth}),
p{depth + 1} AS (SELECT root, {_names(path)}, part + CASE WHEN NOT filled AND turn <= spare THEN 1 ELSE 0 END AS given FROM t{depth}),"""


def mixing_sql(budget: float, weights: dict[str, dict[str, float]], epochs: int, seed: int) -> str:
    flat = "trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))"
    levels = "".join(_share_sql(d, weights) for d in range(len(LEVELS)))
    return f"""
WITH docs AS (
  SELECT doc_id, 'domain' || (('0x' || substr(md5(source), 1, 4))::INTEGER % 4)::VARCHAR AS domain, lang, source,
    CASE WHEN {flat} = '' THEN 0 ELSE length({flat}) - length(replace({flat}, ' ', '')) + 1 END AS tokens FROM documents),
leaves AS (SELECT {_names(LEVELS)}, sum(tokens)::HUGEINT AS tokens FROM docs WHERE tokens > 0 GROUP BY ALL),
nodes AS (SELECT *, tokens * {epochs} AS room FROM leaves),
p0 AS (SELECT 0 AS root, least(sum(room), (SELECT floor(sum(tokens)::DOUBLE * {budget})::HUGEINT FROM leaves)) AS given FROM nodes),
{levels}
shares AS (
  SELECT l.*, p.given // l.tokens AS whole, p.given % l.tokens AS rest FROM leaves l JOIN p{len(LEVELS)} p ON {_same(LEVELS, "l", "p")} WHERE p.given > 0),
placed AS (
  SELECT d.*, whole, rest, substr(md5('{seed}:' || whole::VARCHAR || ':' || doc_id::VARCHAR), 1, 16) AS spot
  FROM docs d JOIN shares s ON {_same(LEVELS, "d", "s")} WHERE d.tokens > 0),
cut AS (
  SELECT *, greatest(0, least(tokens, rest - coalesce(sum(tokens) OVER (PARTITION BY {_names(LEVELS)} ORDER BY spot, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS last FROM placed),
taken AS (SELECT *, unnest(range(0, (whole + CASE WHEN last > 0 THEN 1 ELSE 0 END)::BIGINT)) AS e FROM cut)
SELECT doc_id, {_names(LEVELS)}, e::INTEGER AS epoch, (CASE WHEN e < whole THEN tokens ELSE last END)::BIGINT AS take_tokens FROM taken
"""


def _parts_sql(url: str) -> tuple[str, str]:
    rest = f"CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) ELSE '' END"
    host = f"regexp_extract({rest}, '^[^/?#]*', 0)"
    path = f"regexp_extract(substr({rest}, length({host}) + 1), '^[^?#]*', 0)"
    return f"translate({host}, '{UPPER}', '{LOWER}')", path


def urls_sql(rules: list[tuple[str, str, str]]) -> str:
    host, path = _parts_sql("url")
    segments = "string_split(path, '/')[2:]"
    short = f"CASE WHEN len({segments}) > {DEPTH} THEN list_append(({segments})[1:{DEPTH}], '**') ELSE {segments} END"
    shape = f"array_to_string(list_transform({short}, lambda s: regexp_replace(s, '[0-9]+', '#', 'g')), '/')"
    levels = ""
    for d in range(DEPTH + 1):
        levels += f"""
n{d} AS (SELECT *, segments[{d + 1}] AS next FROM l{d}),
k{d} AS (SELECT host, template FROM n{d} WHERE next IS NOT NULL GROUP BY host, template
  HAVING count(DISTINCT next) >= {KINDS} AND count(DISTINCT next) >= {RARE} * sum(n)),
l{d + 1} AS (SELECT n.* EXCLUDE (next, template), CASE WHEN next IS NULL THEN n.template
    ELSE n.template || '/' || CASE WHEN k.host IS NOT NULL AND next <> '**' THEN '*' ELSE next END END AS template
  FROM n{d} n LEFT JOIN k{d} k ON n.host = k.host AND n.template = k.template),"""
    fits = [
        (f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v)
        for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1]))
    ]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{name}'" for c, name, _ in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits)
    return f"""
WITH split AS (SELECT page_id, {host} AS host, {path} AS path FROM pages),
shaped AS (SELECT *, {shape} AS shape FROM split),
known AS (
  SELECT s.host, s.shape, CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END AS good
  FROM shaped s JOIN labels l ON try_cast(regexp_extract(s.path, '/([0-9]{{1,18}})[^/]*/?$', 1) AS BIGINT) = l.doc_id
  WHERE quality IS NOT NULL AND toxic IS NOT NULL),
l0 AS (
  SELECT host, shape, sum(n)::BIGINT AS n, sum(good)::BIGINT AS good, sum(bad)::BIGINT AS bad, string_split(shape, '/') AS segments, '' AS template
  FROM (SELECT host, shape, 1 AS n, 0 AS good, 0 AS bad FROM shaped UNION ALL SELECT host, shape, 0, good, 1 - good FROM known) GROUP BY host, shape),
{levels}
leaves AS (
  SELECT host, template, regexp_replace(template, '/[^/]*$', '') AS parent, sum(good)::DOUBLE AS good, sum(bad)::DOUBLE AS bad
  FROM l{DEPTH + 1} GROUP BY host, template),
around AS (SELECT *, good + bad AS n, sum(good) OVER w AS all_good, sum(good + bad) OVER w AS total FROM leaves WINDOW w AS (PARTITION BY host, parent)),
rated AS (SELECT *, total - n AS others, all_good / nullif(total, 0) AS rate FROM around),
tested AS (
  SELECT *, abs(good / nullif(n, 0) - (all_good - good) / nullif(others, 0))
    / nullif(sqrt(rate * (1 - rate) * (1 / nullif(n, 0) + 1 / nullif(others, 0))), 0) AS z FROM rated),
branched AS (SELECT *, CASE WHEN coalesce(z < {SIMILAR}, true) THEN '' ELSE template END AS branch FROM tested),
overall AS (SELECT coalesce(sum(good) / nullif(sum(good + bad), 0), 1.0) AS share FROM leaves),
hosts AS (SELECT host, (sum(good) + {PRIOR} * any_value(share)) / (sum(good + bad) + {PRIOR}) AS host_share FROM leaves, overall GROUP BY host),
merged AS (SELECT host, parent, branch, sum(good) AS good, sum(bad) AS bad FROM branched GROUP BY ALL),
judged AS (SELECT m.*, (good + {PRIOR} * host_share) / (good + bad + {PRIOR}) AS purity FROM merged m JOIN hosts USING (host)),
final AS (
  SELECT l.host, l.shape, l.template, j.purity FROM l{DEPTH + 1} l JOIN branched b ON l.host = b.host AND l.template = b.template
  JOIN judged j ON b.host = j.host AND b.parent = j.parent AND b.branch = j.branch)
SELECT page_id, s.host, s.path, {rule.replace("host", "s.host").replace("path", "s.path")} AS rule,
  {verdict.replace("host", "s.host").replace("path", "s.path")} WHEN purity < {THRESHOLD} THEN 'block' ELSE 'allow' END AS verdict,
  template, round(purity, 6) AS purity
FROM shaped s LEFT JOIN final f ON s.host = f.host AND s.shape = f.shape
"""


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def phrases_sql(least: int, absorb: int, top: int) -> str:
    """Phrases of two to four words by their worst cut; every phrase of every piece is written out and counted."""
    return f"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts),
lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS words FROM pieces),
total AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM lists GROUP BY lang HAVING sum(len(words)) > 0),
placed AS (
  SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS spot FROM lists, (SELECT unnest(range(1, 5)) AS size)
),
counted AS (
  SELECT lang, size, words[spot : spot + size - 1] AS words, count(*) AS a FROM placed GROUP BY ALL HAVING count(*) >= {least}
),
cuts AS (
  SELECT lang, size, words, a, k, words[1 : k] AS head, words[k + 1 : size] AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM counted WHERE size >= 2)
),
scored AS (
  SELECT c.lang, c.size, c.words, c.a, c.k, h.a AS l, t.a AS r, (CAST(2000000 AS HUGEINT) * c.a) // (CAST(h.a AS HUGEINT) + t.a) AS score
  FROM cuts AS c JOIN counted AS h ON h.lang = c.lang AND h.words = c.head JOIN counted AS t ON t.lang = c.lang AND t.words = c.tail
),
worst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, words ORDER BY score, k) AS pick FROM scored) WHERE pick = 1),
parts AS (SELECT lang, a, words, size, m, unnest(range(1, size - m + 2)) AS spot FROM (SELECT *, unnest(range(2, size)) AS m FROM counted WHERE size >= 3)),
around AS (SELECT lang, words[spot : spot + m - 1] AS words, max(a) AS a FROM parts GROUP BY ALL),
own AS (
  SELECT w.* FROM worst AS w LEFT JOIN around AS o ON o.lang = w.lang AND o.words = w.words
  WHERE o.a IS NULL OR CAST(100 AS HUGEINT) * o.a < CAST({absorb} AS HUGEINT) * w.a
),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' ')) AS rank,
    array_to_string(words, ' ') AS phrase, a, l, r, score FROM own
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN total USING (lang) WHERE rank <= {top}
"""
