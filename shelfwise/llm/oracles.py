"""DuckDB SQL for the corpus queries whose result SQL can express."""

from __future__ import annotations

from shelfwise.llm import chat_windows as C
from shelfwise.llm import url_reputation as U


def url_reputation(rules) -> str:
    """Same moments and shrinkage, level by level, in one statement."""
    def strength(level: str, prior: str) -> str:
        return f"""(SELECT COALESCE(greatest({U.MIN_STRENGTH!r}, least({U.MAX_STRENGTH!r}, CASE WHEN rho > 0 THEN 1.0 / rho - 1.0 ELSE {U.MAX_STRENGTH!r} END)), {U.MAX_STRENGTH!r})
  FROM (SELECT CASE WHEN SUM((n - 1.0) * {prior} * (1.0 - {prior})) > 0
               THEN (SUM(n * pow(good / n - {prior}, 2)) - SUM({prior} * (1.0 - {prior}))) / SUM((n - 1.0) * {prior} * (1.0 - {prior})) END AS rho
        FROM {level} WHERE n > 0))"""

    def fits(rule: str) -> str:
        host, slash, rest = rule.partition("/")
        return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{rest}')"

    by_length = sorted(rules, key=lambda r: -len(r[1]))
    cases = lambda at: " ".join(f"WHEN {fits(r[1])} THEN '{r[at]}'" for r in by_length)
    return f"""
WITH rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS r FROM pages),
p AS (SELECT page_id, translate(COALESCE(regexp_extract(r, '^([^/?#]*)', 1), ''), '{U.UPPER}', '{U.UPPER.lower()}') AS host,
             COALESCE(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest),
marks AS (SELECT doc_id AS page_id, MIN(quality) AS y FROM labels WHERE quality IS NOT NULL GROUP BY ALL),
h0 AS (SELECT host, array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix,
              COUNT(y) AS n, CAST(COALESCE(SUM(y), 0) AS DOUBLE) AS good FROM p LEFT JOIN marks USING (page_id) GROUP BY ALL),
root AS (SELECT (SUM(good) + 1.0) / (SUM(n) + 2.0) AS rate FROM h0),
s0 AS (SELECT suffix, SUM(n) AS n, SUM(good) AS good, ANY_VALUE(rate) AS m FROM h0, root GROUP BY suffix),
s1 AS (SELECT suffix, (good + k * m) / (n + k) AS m FROM s0, (SELECT {strength('s0', 'm')} AS k)),
d0 AS (SELECT domain, ANY_VALUE(m) AS m, SUM(n) AS n, SUM(good) AS good FROM h0 JOIN s1 USING (suffix) GROUP BY domain),
d1 AS (SELECT domain, (good + k * m) / (n + k) AS m FROM d0, (SELECT {strength('d0', 'm')} AS k)),
h1 AS (SELECT host, m, n, good FROM h0 JOIN d1 USING (domain)),
h2 AS (SELECT host, (good + k * m) / (n + k) AS q, n + k AS size FROM h1, (SELECT {strength('h1', 'm')} AS k)),
judged AS (SELECT host, least(1.0, q + {U.BOUND_Z!r} * sqrt(q * (1.0 - q) / (size + 1.0))) < {U.MIN_SHARE!r} * rate AS bad FROM h2, root)
SELECT page_id, host, path, CASE {cases(1)} END AS rule, CASE {cases(0)} WHEN bad THEN 'block' ELSE 'allow' END AS verdict
FROM p JOIN judged USING (host)"""


def chat_windows(control: str, budget: int = C.BUDGET, history: int = C.HISTORY) -> str:
    """Turns, targets and digests straight from the table; the windows'
    characters from the prefix sums and the turns repeated across windows."""
    stride = (budget - history) // 2
    esc = lambda x: f"replace(replace({x}, '\\', '\\\\'), '<|', '<\\|')"
    marks = len(C.START) + len(C.END) + 2
    return f"""
WITH t AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '{control}' UNION ALL SELECT -1, 1, 'assistant', '{control}'),
sized AS (SELECT *, len(regexp_extract_all(text, '{C.TOKEN}')) + {C.MARKS} AS tokens,
                 {marks} + length(replace({esc('role')}, chr(10), '\\n')) + length({esc('text')}) AS chars FROM t),
placed AS (SELECT *, COALESCE(SUM(tokens) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM sized),
dealt AS (SELECT *, pos // {stride} AS w, pos = 0 AND role = 'system' AS sys FROM placed),
spans AS (SELECT conv_id, w - 1 AS w, MIN(pos) AS opens FROM dealt GROUP BY ALL),
counted AS (SELECT d.*, chars * CASE WHEN sys THEN (SELECT COUNT(DISTINCT e.w) FROM dealt e WHERE e.conv_id = d.conv_id)
                                     WHEN s.opens - d.pos <= {history} THEN 2 ELSE 1 END AS shown
            FROM dealt d LEFT JOIN spans s ON s.conv_id = d.conv_id AND s.w = d.w)
SELECT conv_id, COUNT(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       CAST(COALESCE(SUM(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(SUM(shown) AS BIGINT) AS formatted_chars
FROM counted GROUP BY conv_id"""


#: all pairs: fine as a check of small tables only, which is where it runs
NN_DESCENT = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
whole AS (SELECT vec_id, e, list_max(list_transform(e, lambda x: abs(x))) AS most FROM v
          WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
-- scaled first: squares of very large or very small components leave the range of a double
scaled AS (SELECT vec_id, list_transform(e, lambda x: x / most) AS e FROM whole WHERE most > 0),
good AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM scaled),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
root AS (SELECT a AS vec_id, MIN(b) AS component_id FROM reach GROUP BY ALL),
n AS (SELECT a AS vec_id, COUNT(*) AS n_links FROM links GROUP BY ALL)
SELECT vec_id, COALESCE(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM root LEFT JOIN n USING (vec_id)"""


def collocations(longest: int = 5, least: int = 100, best: int = 2000) -> str:
    """Phrases from the definition: all sequences counted, candidates inside
    an equally frequent longer one dropped, every cut scored."""
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
sized AS (SELECT lang, w, unnest(range(1, {longest + 1})) AS size FROM worded),
placed AS (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM sized),
seen AS (SELECT lang, size, w[pos:pos + size - 1] AS words, count(*) AS f FROM placed GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM seen WHERE size = 1 GROUP BY lang),
cands AS (SELECT * FROM seen WHERE size > 1 AND f >= {least}),
inside_sizes AS (SELECT lang, words, size, f, unnest(range(2, size)) AS part FROM cands),
inside_places AS (SELECT lang, words, f, part, unnest(range(1, size - part + 2)) AS pos FROM inside_sizes),
inside AS (SELECT lang, words[pos:pos + part - 1] AS words, max(f) AS longer FROM inside_places GROUP BY ALL),
kept AS (SELECT c.* FROM cands c LEFT JOIN inside i ON i.lang = c.lang AND i.words = c.words
         WHERE i.longer IS NULL OR 100 * i.longer < 100 * c.f),
cuts AS (SELECT lang, words, size, f AS a, unnest(range(1, size)) AS k FROM kept),
scored AS (
  SELECT c.lang, c.words, c.a, c.k, x.f AS l, y.f AS r, t.n, (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN seen x ON x.lang = c.lang AND x.words = c.words[1:c.k]
  JOIN seen y ON y.lang = c.lang AND y.words = c.words[c.k + 1:c.size]),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
named AS (SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, n, score::BIGINT AS score FROM lowest)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM named QUALIFY rank <= {best}"""
