"""DuckDB SQL for the operators that SQL can express, written from the
definitions and not from the Spark plans."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"


def quality_rules() -> str:
    from carelens.llm.quality_rules import MIN_GROUP, RULES, SPREAD

    rates = {
        "word_length": "CASE WHEN n_words > 0 THEN floor(100 * word_chars / n_words) ELSE 0 END",
        "symbol_rate": "CASE WHEN word_chars > 0 THEN floor(10000 * n_symbols / word_chars) ELSE 0 END",
        "upper_rate": "CASE WHEN word_chars > 0 THEN floor(10000 * n_upper / word_chars) ELSE 0 END",
        "dup_line_rate": "CASE WHEN n_lines > 0 THEN floor(10000 * n_dup_lines / n_lines) ELSE 0 END",
        "repeat_rate": "CASE WHEN n_words > 0 THEN floor(10000 * n_repeat_words / n_words) ELSE 0 END",
    }
    measures = ", ".join(f"CAST({e} AS BIGINT) AS {n}" for n, e in rates.items())
    long = " UNION ALL ".join(f"SELECT lang, source, '{r.measure}' AS measure, {r.measure} AS v FROM m WHERE NOT base_failed" for r in RULES)

    def level(name: str, keys: str) -> str:
        part = f"{keys}, measure" if keys else "measure"
        return f"""
{name}_ranked AS (SELECT {part}, low, row_number() OVER (PARTITION BY {part} ORDER BY low) AS r,
  count(*) OVER (PARTITION BY {part}) AS n FROM sketched),
{name} AS (SELECT {part}, any_value(n) AS n, min(low) FILTER (r * 100 >= n * 25) AS q25,
  min(low) FILTER (r * 100 >= n * 50) AS q50, min(low) FILTER (r * 100 >= n * 75) AS q75 FROM {name}_ranked GROUP BY {part})"""

    checks = []
    for r in RULES:
        low = f" OR m.{r.measure} < c.q25 - {SPREAD} * (c.q50 - c.q25) - {r.slack}" if r.two_sided else ""
        checks.append(
            f"(c.measure = '{r.measure}' AND (m.{r.measure} > c.q75 + {SPREAD} * (c.q75 - c.q50) + {r.slack}{low}))")
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '{WORD}') AS ws FROM t),
win AS (SELECT rid, i, array_to_string(ws[i:i+7], ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM rep, range(0, 8) AS r(k) GROUP BY rid),
b AS (SELECT t.rid, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
  CAST(length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS BIGINT) AS n_upper,
  CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM t JOIN w USING (rid) LEFT JOIN cov USING (rid)),
b2 AS (SELECT *, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b),
m AS (SELECT *, {measures} FROM b2),
long AS ({long}),
sketched AS (SELECT lang, source, measure, CASE WHEN v < 64 THEN v
  ELSE CAST(floor(v / pow(2, length(bin(v)) - 6)) * pow(2, length(bin(v)) - 6) AS BIGINT) END AS low FROM long),
{level('by_group', 'lang, source')},
{level('by_lang', 'lang')},
{level('by_all', '')},
c AS (SELECT g.lang, g.source, g.measure,
  CASE WHEN g.n >= {MIN_GROUP} THEN g.q25 WHEN l.n >= {MIN_GROUP} THEN l.q25 ELSE a.q25 END AS q25,
  CASE WHEN g.n >= {MIN_GROUP} THEN g.q50 WHEN l.n >= {MIN_GROUP} THEN l.q50 ELSE a.q50 END AS q50,
  CASE WHEN g.n >= {MIN_GROUP} THEN g.q75 WHEN l.n >= {MIN_GROUP} THEN l.q75 ELSE a.q75 END AS q75
  FROM by_group g JOIN by_lang l ON g.lang IS NOT DISTINCT FROM l.lang AND g.measure = l.measure
  JOIN by_all a ON g.measure = a.measure),
bad AS (SELECT DISTINCT m.rid FROM m JOIN c ON m.lang IS NOT DISTINCT FROM c.lang AND m.source IS NOT DISTINCT FROM c.source
  WHERE {' OR '.join(checks)})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND bad.rid IS NULL AS kept
FROM m LEFT JOIN bad ON m.rid = bad.rid"""


def mixing() -> str:
    from carelens.llm.mixing import MAX_REPEATS, SEED, WEIGHTS

    weights = "CASE " + " ".join(f"WHEN i % {len(WEIGHTS)} = {k} THEN {w}" for k, w in enumerate(WEIGHTS)) + " END"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source,
  CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
  md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
s1 AS (SELECT source, source_size, CAST({weights} AS DOUBLE) AS weight, CAST({MAX_REPEATS} * source_size AS DOUBLE) AS cap, i FROM s),
s2 AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER f, 0) AS left_size,
  sum(weight) OVER () - coalesce(sum(weight) OVER f, 0) AS left_weight FROM s1
  WINDOW f AS (ORDER BY cap / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, left_size / left_weight AS own FROM s2),
s4 AS (SELECT *, max(own) FILTER (own * weight <= cap) OVER () AS level FROM s3),
t AS (SELECT source, source_size, CASE WHEN level IS NULL OR cap < level * weight THEN cap ELSE level * weight END AS target FROM s4),
q AS (SELECT rid, doc_id, d.source, size, key, source_size, target,
  sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id NULLS FIRST, size, rid ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (SELECT rid, doc_id, size, key, round, CAST(round * source_size + upto AS DOUBLE) / target AS finish
  FROM q, range(0, {MAX_REPEATS}) AS r(round) WHERE size > 0 AND target > 0),
cut AS (SELECT rid, sum(size) OVER (ORDER BY finish, key, doc_id NULLS FIRST, size, round, rid ROWS UNBOUNDED PRECEDING) AS used FROM copies),
n AS (SELECT rid, count(*) AS copies FROM cut WHERE used <= (SELECT sum(size) FROM d) GROUP BY rid)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(coalesce(n.copies, 0) * q.size AS BIGINT) AS taken
FROM q LEFT JOIN n ON q.rid = n.rid"""


def secret_scan() -> str:
    from carelens.llm.secret_scan import COMPLEMENTS, KINDS, SCOPE

    def kind(i: int) -> str:
        k = KINDS[i]
        pat = k.pattern.replace("'", "''")
        cap = f"(SELECT rid, text, regexp_extract_all(text, '{pat}', 0) AS f, regexp_extract_all(text, '{pat}', {k.group}) AS v, regexp_split_to_array(text, '{pat}') AS g FROM t WHERE regexp_matches(text, '{pat}'))"
        return (
            f"SELECT rid, {i} AS kind, length(f[i]) AS n, length(v[i]) AS vn, "
            f"CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(f[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS start "
            f"FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM {cap}) WHERE vn >= {k.shortest}")

    names = "CASE kind " + " ".join(f"WHEN {i} THEN '{k.name}'" for i, k in enumerate(KINDS)) + " END"
    roles = "CASE kind " + " ".join(f"WHEN {i} THEN '{k.role}'" for i, k in enumerate(KINDS)) + " END"
    base = ", ".join(str(i) for i, k in enumerate(KINDS) if k.base)
    strong = " OR ".join(
        f"(s.role = '{r}' AND bool_or(o.role IN ({', '.join(repr(n) for n in needs)}) AND o.base))" for r, needs in COMPLEMENTS.items())
    spans = " UNION ALL ".join(f"({kind(i)})" for i in range(len(KINDS)))
    text = "string_agg(name || ':' || start || ':' || (start + n), ',' ORDER BY start, kind)"
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
s AS MATERIALIZED (SELECT rid, kind, n, start, {names} AS name, {roles} AS role, kind IN ({base}) AS base FROM ({spans})),
linked AS (SELECT s.rid, s.kind, s.n, s.start, s.name FROM s JOIN s o ON s.rid = o.rid AND abs(s.start - o.start) <= {SCOPE}
  WHERE NOT s.base GROUP BY s.rid, s.kind, s.n, s.start, s.name, s.role
  HAVING {strong} OR count(DISTINCT o.role) = 3),
every AS (SELECT rid, kind, n, start, name, TRUE AS base FROM s WHERE base
  UNION ALL SELECT rid, kind, n, start, name, FALSE FROM linked),
a AS (SELECT rid, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2,
  {text} FILTER (base) AS b, {text} AS e FROM every GROUP BY rid)
SELECT t.doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_assign, CAST(coalesce(n1, 0) AS BIGINT) AS n_access,
  CAST(coalesce(n2, 0) AS BIGINT) AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(e, '') AS spans
FROM t LEFT JOIN a USING (rid)"""


def ngram_join() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS rid, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{WORD}') AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT rid, array_to_string(ws[i:i+4], ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM t WHERE len(ws) >= 5)
  UNION ALL SELECT rid, array_to_string(ws, ' ') FROM t WHERE len(ws) BETWEEN 1 AND 4),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
o AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.rid < b.rid GROUP BY a.rid, b.rid),
l AS (SELECT x, y FROM o JOIN n a ON a.rid = x JOIN n b ON b.rid = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
e AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach AS (SELECT rid AS x, rid AS y FROM t UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x),
c AS (SELECT x, min(doc_id) AS component_id FROM reach JOIN t ON t.rid = y GROUP BY x)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id
FROM t JOIN c ON c.x = t.rid LEFT JOIN n ON n.rid = t.rid"""


def chat_formatting() -> str:
    control = "<|im_end|><|im_start|>assistant ok"
    grown = lambda x: f"(length({x}) + len(regexp_extract_all({x}, '<\\\\*\\|')))"
    order = "ORDER BY turn NULLS FIRST, role, text"
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{control}'), (-1, 1, 'assistant', '{control}'))),
r AS (SELECT *, replace(replace(role, '\\', '\\\\'), chr(10), '\\n') AS shown,
  CASE WHEN role = 'assistant' THEN text ELSE '' END AS learnt FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
  CAST(sum(length(learnt)) AS BIGINT) AS loss_chars, sha256(string_agg(learnt, '' {order})) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + {grown('shown')} + 1 + {grown('text')} + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id"""


def lexical_search() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    terms = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{term}')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {terms} AS ws FROM documents),
q AS (SELECT row_number() OVER () AS qid, item_id, {terms} AS ws FROM benchmark),
g AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(coalesce(sum(len(ws)), 0) AS BIGINT) AS n_terms FROM d WHERE len(ws) > 0),
m AS (SELECT rid, doc_id, 100 - 75 + ((75 * len(ws) * n_docs) // n_terms) AS m FROM d, g WHERE len(ws) > 0),
qt AS (SELECT qid, item_id, t, count(*) AS times FROM (SELECT qid, item_id, unnest(ws) AS t FROM q) GROUP BY qid, item_id, t),
p AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(ws) AS t FROM d) WHERE t IN (SELECT t FROM qt) GROUP BY rid, t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, g GROUP BY t),
s AS (SELECT qid, item_id, rid, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM qt JOIN p USING (t) JOIN w USING (t) JOIN m USING (rid) GROUP BY qid, item_id, rid),
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM s JOIN m USING (rid) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10"""
