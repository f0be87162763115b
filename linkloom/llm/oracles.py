"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from .quality_rules import CLASS_NOISE, COMMON_WORDS, MAX_CLASS_DISTANCE, MAX_REPEAT_PERCENT, MAX_WORD_DISTANCE, MIN_CLASS_WORDS, MIN_WORD_WORDS, MIN_WORDS, TRIM_DISTANCE
from .source_mixing import DOMAIN_WEIGHTS, DOMAINS, LANG_WEIGHTS, MAX_EPOCHS, SEED, SHARE

SQL: dict[str, str] = {}
WHITE = "[\\x20\\x09-\\x0D]"
WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), '{WHITE}+'), lambda x: x <> '')"

SQL["op2_exact_dedup"] = f"""WITH s AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{WHITE}+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256 FROM s WINDOW g AS (PARTITION BY text_sha256)"""


# ---------------------------------------------------------------- quality rules


def _classes() -> str:
    """A count per class: small letters, white space, capitals, points, digits, symbols, other letters."""
    patterns = ("\\p{Ll}", "\\x20\\x09-\\x0D", "\\p{Lu}", ".,;:!?''\"()\\-", "\\p{Nd}", "#*$%&|<>", "\\p{Lt}\\p{Lm}\\p{Lo}")
    return ", ".join(f"length(regexp_replace(text, '[^{p}]', '', 'g'))" for p in patterns)


def _bins() -> str:
    forms = lambda x: ", ".join(f"'{f}'" for f in sorted({x, x.capitalize(), x.upper()}))
    count = lambda x: f"len(list_filter(w, lambda x: x IN ({forms(x)})))"
    cases = " ".join(f"WHEN '{lang}' THEN [{', '.join(count(x) for x in words.split())}]" for lang, words in COMMON_WORDS.items())
    return f"CASE lang {cases} END"


def _distances(p: str, good: str) -> str:
    part = lambda v: f"CASE WHEN {v} > 0 THEN {v} * log2({v} / ((x + y) / 2)) ELSE 0 END"
    return f"""ref{p} AS (SELECT lang_key, kind, k, sum(c)::DOUBLE AS r FROM cells JOIN {good} USING (doc_id) GROUP BY ALL), tot{p} AS (SELECT lang_key, kind, sum(r) AS rs FROM ref{p} GROUP BY ALL),
d{p} AS (SELECT doc_id, kind, CASE WHEN min(s) = 0 THEN 1 ELSE sqrt(greatest(sum(({part("x")} + {part("y")}) / 2), 0)) END AS dist FROM (SELECT doc_id, kind, s, CASE WHEN s > 0 THEN c / s ELSE 0 END AS x, r / rs AS y FROM cells JOIN sums USING (doc_id, kind) JOIN ref{p} USING (lang_key, kind, k) JOIN tot{p} USING (lang_key, kind) WHERE rs > 0) GROUP BY ALL)"""


SQL["op10_quality_rules"] = f"""WITH w AS (SELECT doc_id, lang, coalesce(lang, '') AS lang_key, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, w[i:i + 4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM w),
base AS (SELECT doc_id, lang_key, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0) AS n_repeat_words FROM w JOIN l USING (doc_id) LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM base),
h AS (SELECT doc_id, lang_key, length(text) AS n, [{_classes()}] AS c7, {_bins()} AS words FROM w),
cells AS (SELECT doc_id, lang_key, 'class' AS kind, unnest(range(1, 9)) AS k, unnest(list_append(c7, n - list_sum(c7))) AS c FROM h UNION ALL SELECT doc_id, lang_key, 'word', unnest(range(1, 21)), unnest(words) FROM h WHERE words IS NOT NULL),
sums AS (SELECT doc_id, kind, sum(c)::DOUBLE AS s FROM cells GROUP BY ALL),
good1 AS (SELECT doc_id FROM b WHERE NOT base_failed), {_distances("1", "good1")},
good2 AS (SELECT b.doc_id FROM b LEFT JOIN d1 ON d1.doc_id = b.doc_id AND d1.kind = 'class' WHERE NOT base_failed AND coalesce(dist, 0) <= {TRIM_DISTANCE}), {_distances("2", "good2")}
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed
AND NOT coalesce(n_words >= {MIN_CLASS_WORDS} AND c.dist > {MAX_CLASS_DISTANCE} + {CLASS_NOISE} / sqrt(n_words), false) AND NOT coalesce(n_words >= {MIN_WORD_WORDS} AND v.dist > {MAX_WORD_DISTANCE}, false) AS kept
FROM b LEFT JOIN d2 c ON c.doc_id = b.doc_id AND c.kind = 'class' LEFT JOIN d2 v ON v.doc_id = b.doc_id AND v.kind = 'word'"""


# ---------------------------------------------------------------- source mixing


def _weights(column: str, weights: dict[str, float]) -> str:
    return f"(CASE {column} {' '.join(f'WHEN {chr(39)}{k}{chr(39)} THEN {float(v)}' for k, v in weights.items())} ELSE 1.0 END)" if weights else "1.0"


def _shared(depth: int, path: list[str], weight: str, before: str) -> str:
    """The budgets of one level of the tree."""
    parent, key = ", ".join(path[:-1]) or "1", path[-1]
    order = f"PARTITION BY {parent} ORDER BY capacity / weight, {key} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    join = f"JOIN a{depth - 1} USING ({', '.join(path[:-1])})" if depth else ", total"
    return f"""n{depth} AS (SELECT * FROM (SELECT {', '.join(path)}, sum(tokens * {MAX_EPOCHS})::DOUBLE AS capacity, {weight} AS weight FROM leaves GROUP BY ALL) {join}),
s{depth} AS (SELECT *, ({before} - coalesce(sum(capacity) OVER ({order}), 0)) / (sum(weight) OVER (PARTITION BY {parent}) - coalesce(sum(weight) OVER ({order}), 0)) AS level FROM n{depth}),
f{depth} AS (SELECT *, level * weight >= capacity AS is_full FROM s{depth}),
g{depth} AS (SELECT *, (min({{'r': capacity / weight, 'k': {key}, 'l': level}}) FILTER (WHERE NOT is_full) OVER (PARTITION BY {parent})).l AS water FROM f{depth}),
a{depth} AS (SELECT {', '.join(path)}, floor(CASE WHEN water IS NULL OR is_full THEN capacity ELSE least(capacity, water * weight) END + 1e-6)::BIGINT AS b{depth + 1} FROM g{depth})"""


SQL["op9_source_mixing"] = f"""WITH slim AS (SELECT doc_id, CASE WHEN digits <> '' THEN 'd' || digits::BIGINT % {DOMAINS} ELSE 'none' END AS domain, lang, source, n_tokens FROM (SELECT doc_id, lang, source, regexp_extract(source, '([0-9]{{1,9}})$', 1) AS digits, len({WORDS})::BIGINT AS n_tokens FROM documents)),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM slim GROUP BY ALL), total AS (SELECT floor(sum(tokens) * {SHARE})::BIGINT AS b0 FROM leaves),
{_shared(0, ["domain"], _weights("domain", DOMAIN_WEIGHTS), "b0")}, {_shared(1, ["domain", "lang"], _weights("lang", LANG_WEIGHTS), "b1")}, {_shared(2, ["domain", "lang", "source"], "1.0", "b2")},
plan AS (SELECT *, b3 // nullif(tokens, 0) AS epochs, b3 % nullif(tokens, 0) AS rest FROM leaves JOIN a2 USING (domain, lang, source)),
run AS (SELECT s.*, tokens, b3, epochs, rest, sum(n_tokens) OVER (PARTITION BY s.domain, s.lang, s.source ORDER BY md5('{SEED}:' || epochs || ':' || doc_id), doc_id) AS upto FROM slim s JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, tokens AS leaf_tokens, b3 AS leaf_budget, CASE WHEN tokens = 0 THEN {MAX_EPOCHS} ELSE epochs + (rest > 0 AND upto <= rest)::BIGINT END AS copies FROM run"""

# ---------------------------------------------------------------- tool linking; turns are unique in the tables

_TEXT = "to_json(text)::VARCHAR"
_BEGIN, _TURN = f"""'{{"chars":' || n || """, """',"turn":' || turn || '}'"""
SQL["op8_tool_linking"] = f"""WITH RECURSIVE turns AS (SELECT conv_id, turn, role, text, length(text) AS n FROM conversations),
c AS (SELECT conv_id, turn, conv_id || '-' || turn AS call_id, CASE WHEN role = 'system' THEN 'configure' WHEN n % 13 = 5 THEN 'browse' ELSE 'ask' END AS name, n % 7 AS form,
CASE n % 5 WHEN 0 THEN [turn + 1, turn + 2] WHEN 1 THEN []::BIGINT[] ELSE [turn - 2, turn - 1] END AS after,
CASE n % 7 WHEN 0 THEN {_BEGIN} ',"prompt":' || {_TEXT} || '}}' WHEN 1 THEN {_BEGIN} ',"prompt":' || {_TEXT} || ',"turn":"' || turn || '"}}' WHEN 2 THEN {_BEGIN} ',"note":"' || turn || '","prompt":' || {_TEXT} || {_TURN}
WHEN 3 THEN to_json('{{"prompt":' || {_TEXT})::VARCHAR WHEN 4 THEN '[' || {_TEXT} || ']' ELSE {_BEGIN} ',"prompt":' || {_TEXT} || {_TURN} END AS arguments FROM turns WHERE role IN ('user', 'system')),
r AS (SELECT conv_id, turn, conv_id || '-' || (turn - 1) AS call_id, text FROM turns WHERE role NOT IN ('user', 'system')),
e AS (SELECT a.conv_id, a.turn, b.turn AS parent FROM (SELECT conv_id, turn, unnest(after) AS parent FROM c) a JOIN c b ON b.conv_id = a.conv_id AND b.turn = a.parent),
odd AS (SELECT DISTINCT conv_id FROM e WHERE parent >= turn), o AS (SELECT e.* FROM e JOIN odd USING (conv_id)),
reach AS (SELECT conv_id, turn, parent FROM o UNION SELECT a.conv_id, a.turn, o.parent FROM reach a JOIN o ON o.conv_id = a.conv_id AND o.turn = a.parent),
loops AS (SELECT conv_id, turn FROM reach WHERE turn = parent), bad AS (SELECT conv_id, turn FROM loops UNION SELECT a.conv_id, a.turn FROM reach a JOIN loops l ON l.conv_id = a.conv_id AND l.turn = a.parent),
ok AS (SELECT o.* FROM o WHERE (conv_id, turn) NOT IN (SELECT (conv_id, turn) FROM bad)),
depth AS (SELECT conv_id, turn, 0 AS d FROM c UNION SELECT ok.conv_id, ok.turn, d + 1 FROM depth JOIN ok ON ok.conv_id = depth.conv_id AND ok.parent = depth.turn),
heads AS (SELECT c.*, (conv_id, turn) IN (SELECT (conv_id, turn) FROM bad) AS cyclic, (SELECT max(d) FROM depth WHERE depth.conv_id = c.conv_id AND depth.turn = c.turn) AS d,
CASE WHEN name = 'browse' THEN 'unknown_tool' ELSE ['missing:turn', 'type:turn', 'unexpected:note', 'not_json', 'not_object', '', ''][form + 1] END AS errors FROM c),
placed AS (SELECT *, CASE WHEN cyclic THEN 1000000 ELSE d END AS level FROM heads),
m AS (SELECT conv_id, 'call' AS kind, call_id, turn AS seq, level, cyclic, turn AS spot, 0 AS part, CASE WHEN call_id IN (SELECT call_id FROM r) THEN 'linked' ELSE 'unanswered' END AS link, errors,
'{{"arguments":' || arguments || ',"call_id":"' || call_id || '","name":"' || name || '","role":"tool_call"}}' AS json FROM placed
UNION ALL SELECT r.conv_id, 'result', r.call_id, r.turn, coalesce(p.level, 0), coalesce(p.cyclic, false), coalesce(p.turn, r.turn), CASE WHEN p.turn IS NULL THEN 2 ELSE 1 END, CASE WHEN p.turn IS NULL THEN 'orphan' ELSE 'linked' END, '', '{{"call_id":"' || r.call_id || '","content":' || to_json(r.text)::VARCHAR || ',"role":"tool_result"}}' FROM r LEFT JOIN placed p USING (call_id))
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY level, spot, part, seq) AS position, kind, call_id, seq, link, cyclic, errors, json, 1::BIGINT AS repeats FROM m"""

# ---------------------------------------------------------------- MinHash near-dedup: all links, by all shared shingles

SQL["op5_minhash_dedup"] = f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WHITE}+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i:i + 4] AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT x, b FROM reach JOIN links ON a = y)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) ON x = d.doc_id"""
