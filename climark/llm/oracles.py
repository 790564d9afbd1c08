"""DuckDB SQL for the corpus queries that SQL can express on whole tables.

The others encode, learn, pack or slide windows over characters; ``tests/llm``
compares them with brute force, exact round trips and held-out labels.
"""

from __future__ import annotations

from climark.llm.quality_rules import (BOILERPLATE, MARK, SEPARATOR, SYMBOL, SYMBOL_RUN, TERMINAL, UPPER, LineRules)

ORACLE: dict[str, str] = {}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCH_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = r"[^\x20\x09-\x0D]+"


def _count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, {_q(pattern)}))"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ORACLE["op2_benchmark_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_BENCH_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_BENCH_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, m, array_to_string(w[k:k + m - 1], ' ') AS g
       FROM (SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k
             FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, m, p, array_to_string(w[p:p + m - 1], ' ') AS g
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p
             FROM d, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m)),
h AS (SELECT dw.doc_id, dw.p, dw.m, iw.item_id FROM dw JOIN iw ON dw.m = iw.m AND dw.g = iw.g),
hit AS (SELECT doc_id, count(DISTINCT ix) AS n FROM (SELECT doc_id, unnest(range(p, p + m)) AS ix FROM h) GROUP BY 1),
ids AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(ids.n, 0) AS n_items,
       sha256(coalesce(ids.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN ids ON ids.doc_id = d.doc_id"""

ORACLE["op3_ngram_jaccard_join"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + least(5, len(w)) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id
FROM d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id"""


def _quality(rules: LineRules = LineRules()) -> str:
    phrases = " OR ".join(f"contains(lower(line), {_q(p)})" for p in BOILERPLATE)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
g AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, x) AS c
      FROM (SELECT doc_id, p, array_to_string(w[p:p + 2], ' ') AS x
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) >= 3))),
rep AS (SELECT doc_id, count(DISTINCT ix) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS ix FROM g WHERE c > 1) GROUP BY 1),
l AS (SELECT doc_id, line, regexp_extract_all(line, '{_SPACED}') AS lw
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)),
lf AS (SELECT doc_id, line, len(lw) AS n, length(array_to_string(lw, '')) AS chars, coalesce(right(lw[-1], 8), '') AS tail
       FROM l WHERE len(lw) > 0),
judged AS (SELECT doc_id, line, chars,
    (n >= {rules.punctuation_from_words} AND NOT regexp_matches(tail, {_q(TERMINAL)}))
    OR (regexp_matches(line, {_q(MARK)}) AND (
        (n > 2 AND {_count('line', SEPARATOR)} * 100 >= n * {rules.separator_words_percent})
        OR {_count('line', SYMBOL_RUN)} * 100 >= n * {rules.symbol_words_percent}))
    OR (n > 2 AND regexp_matches(line, {_q(UPPER + '{2}')}) AND {_count('line', UPPER)} * 100 >= chars * {rules.shout_percent})
    OR (length(line) <= {rules.boilerplate_chars} AND ({phrases})) AS fails FROM lf),
f AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup, sum(CASE WHEN fails THEN chars ELSE 0 END) AS lost
      FROM judged GROUP BY 1),
t AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST({_count('text', SYMBOL)} AS BIGINT) AS n_symbols, CAST(coalesce(f.dup, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, coalesce(f.lost, 0) AS lost
      FROM d LEFT JOIN f ON f.doc_id = d.doc_id LEFT JOIN rep ON rep.doc_id = d.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed,
       NOT (n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words)
       AND lost * 100 <= word_chars * {rules.max_lost_percent} AS kept FROM t"""


ORACLE["op10_quality_rules"] = _quality()

ORACLE["op13_line_dedup"] = """
WITH l AS (SELECT doc_id, line, p, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
           FROM (SELECT doc_id, unnest(x) AS line, unnest(range(len(x))) AS p
                 FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents))),
s AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT l.doc_id, l.line, l.p, s.k IS NOT NULL AND l.doc_id <> s.keeper AS gone FROM l LEFT JOIN s ON s.k = l.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id"""


def _vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Rounds of assignment and floor means over the parts' integer vectors."""
    def nearest(n: int) -> str:
        return f"""
a{n} AS (SELECT v.n, v.part, v.v, arg_min(c.entry, {_distance}) AS entry, min({_distance}) // {entries} AS dist
         FROM v JOIN c{n} c ON c.part = v.part GROUP BY v.n, v.part, v.v)"""

    _distance = (f"list_sum([CAST((v.v[i] - c.v[i]) * (v.v[i] - c.v[i]) AS HUGEINT) FOR i IN range(1, len(v.v) + 1)])"
                 f" * {entries} + c.entry")
    steps = []
    for n in range(rounds):
        steps.append(nearest(n) + f""",
m{n} AS (SELECT part, entry, list(x ORDER BY i) AS v
         FROM (SELECT part, entry, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x
               FROM (SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS i FROM a{n}) GROUP BY 1, 2, 3)
         GROUP BY 1, 2),
c{n + 1} AS (SELECT c.part, c.entry, coalesce(m.v, c.v) AS v
             FROM c{n} c LEFT JOIN m{n} m ON m.part = c.part AND m.entry = c.entry)""")
    steps.append(nearest(rounds))
    return f"""
WITH k AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS n, vec_id, label,
                  [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
           FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
v AS (SELECT n, part, e[part * len(e) // {parts} + 1:(part + 1) * len(e) // {parts}] AS v
      FROM (SELECT n, e, unnest(range({parts})) AS part FROM k)),
c0 AS (SELECT part, n AS entry, v FROM v WHERE n < {entries}),{",".join(steps)},
codes AS (SELECT n, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code,
                 CAST(sum(dist) AS BIGINT) AS error FROM a{rounds} GROUP BY n)
SELECT k.vec_id, codes.code, codes.error, CAST(sum(codes.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256
FROM k JOIN codes ON codes.n = k.n"""


ORACLE["op11_vector_codes"] = _vector_codes()


_CRC32 = ("xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ascii(ch) AS BIGINT) FOR ch IN "
          "string_split(CAST(conv_id AS VARCHAR), '')], lambda crc, ch: list_reduce([xor(crc, ch)] || "
          "[CAST(bit AS BIGINT) FOR bit IN range(8)], lambda r, bit: xor(r >> 1, 3988292384 * (r & 1)))))")

ORACLE["op12_prefix_trie"] = rf"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS o,
                  coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, n, conv_id - conv_id % 20 AS base, {_CRC32} % 4 AS h FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY 1)),
r AS (SELECT c.conv_id, t.o AS d, role, text FROM c JOIN t ON t.conv_id = c.base AND t.o <= c.h
      UNION ALL
      SELECT t.conv_id, t.o - c.h + least(c.h, coalesce(b.n, 0)), role, text
      FROM t JOIN c ON c.conv_id = t.conv_id AND t.o > c.h LEFT JOIN c b ON b.conv_id = c.base),
p AS (SELECT conv_id, d, len(regexp_extract_all(text, '{_SPACED}')) AS w,
             md5(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY d)) AS k,
             d = max(d) OVER (PARTITION BY conv_id) AS last FROM r),
q AS (SELECT *, coalesce(lag(k) OVER (PARTITION BY conv_id ORDER BY d), 'root') AS pk FROM p
      UNION ALL SELECT conv_id, 0, 0, 'root', conv_id NOT IN (SELECT conv_id FROM r), NULL FROM c),
g AS (SELECT k, any_value(d) AS d, any_value(pk) AS pk, min(conv_id) AS owner, count(*) AS n,
             string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last) AS ends FROM q GROUP BY k),
kids AS (SELECT pk, count(*) AS n FROM g WHERE pk IS NOT NULL GROUP BY pk),
-- of every member: the words that it holds again from here down, and whether it is the first at a childless end
u AS (SELECT q.k, sum(CASE WHEN g.owner = q.conv_id THEN 0 ELSE q.w END) OVER down AS saved,
             max(CASE WHEN q.last AND g.owner = q.conv_id AND kids.n IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY q.conv_id) AS leaf
      FROM q JOIN g ON g.k = q.k LEFT JOIN kids ON kids.pk = q.k
      WINDOW down AS (PARTITION BY q.conv_id ORDER BY q.d DESC)),
s AS (SELECT k, CAST(sum(saved) AS BIGINT) AS saved, CAST(sum(leaf) AS BIGINT) AS leaves FROM u GROUP BY k)
SELECT g.owner AS conv_id, CAST(g.d AS BIGINT) AS depth, up.owner AS parent_conv_id, g.n AS n_convs,
       coalesce(kids.n, 0) AS n_children, s.leaves AS n_leaves, s.saved AS saved_tokens, sha256(coalesce(g.ends, '')) AS ends_sha256
FROM g JOIN s ON s.k = g.k LEFT JOIN g up ON up.k = g.pk LEFT JOIN kids ON kids.pk = g.k"""
