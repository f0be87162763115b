"""DuckDB SQL with the results of ``queries``, written directly on the tables."""

from __future__ import annotations

from ..functions.text import ADDRESS_MAPPINGS, INDIC, NAME_MAPPINGS, STREET_MAPPING, SUFFIXES

SQL: dict[str, str] = {}


# ---------------------------------------------------------------- pieces


def clean(x: str) -> str:
    spelled = f"replace(replace(lower({x}), 'ß', 'ss'), '&', ' and ')"
    return f"trim(regexp_replace(regexp_replace({spelled}, '[^\\p{{L}}\\p{{N}}\\p{{M}}\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def clean_ascii(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(replace(lower({x}), '&', ' and '), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def toks(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def mapped(x: str, mapping: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda w: CASE w {cases} ELSE w END), ' ')"


def jaccard(a: str, b: str) -> str:
    return f"(CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN len(list_intersect({a}, {b})) / greatest(len(list_distinct(list_concat({a}, {b}))), 1) ELSE 0.0 END)"


RECORDS = """rec AS (SELECT *, 'S' || source || '-' || doc_id AS entity_id FROM (
  SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 1 WHEN doc_id % 2 = 0 THEN 2 ELSE 3 END AS source,
    split_part(text, chr(10), 1) AS name, trim(replace(substr(text, length(split_part(text, chr(10), 1)) + 2), chr(10), ' '), ' ') || ' ' || n_chars AS address, lang AS country, md5(text) AS digest FROM documents))"""
SIDES = f"""{RECORDS}, crec AS (SELECT doc_id, source, entity_id, {clean("name")} AS name, {clean("address")} AS address, country, digest FROM rec),
q AS (SELECT doc_id AS qid, * FROM crec WHERE source = 1), t AS (SELECT doc_id AS rid, * FROM crec WHERE source > 1),
links AS (SELECT qid, rid FROM q JOIN t USING (digest))"""
SEARCH = f"""{RECORDS}, crec AS (SELECT doc_id, {clean("name")} AS name, {clean("address")} AS address FROM rec), q AS (SELECT doc_id AS qid, * FROM crec WHERE doc_id % 20 = 0), t AS (SELECT doc_id AS rid, * FROM crec)"""


def latin(x: str) -> str:
    """For the Latin letters of the documents."""
    return f"lower(strip_accents(replace({x}, 'ß', 'ss')))"


def normal(query: str, target: str) -> str:
    """Normalised records with all four fields."""
    return f"""{RECORDS}, nrec0 AS (SELECT doc_id, source, digest, {mapped(clean("name"), NAME_MAPPINGS)} AS name, {mapped(clean("address"), ADDRESS_MAPPINGS)} AS address FROM rec),
nrec AS (SELECT *, {clean(latin("name"))} AS tname, {clean(latin("address"))} AS taddress FROM nrec0), q AS (SELECT doc_id AS qid, * FROM nrec WHERE {query}), t AS (SELECT doc_id AS rid, * FROM nrec WHERE {target}), links AS (SELECT qid, rid FROM q JOIN t USING (digest))"""


PARTS = f"""names AS (SELECT p_partkey, {clean_ascii("p_name")} AS text FROM part),
pq AS (SELECT p_partkey AS qid, text FROM names WHERE p_partkey % 20 = 0), pt AS (SELECT p_partkey AS rid, text, len({toks("text")}) AS row_size FROM names)"""
PAIRS = f"names AS (SELECT p_partkey, {clean_ascii('p_name')} AS text FROM part), pairs AS (SELECT x.p_partkey, x.text AS a, y.text AS b FROM names x JOIN names y ON y.p_partkey = x.p_partkey + 1)"


def bm25(p: str, q: str, t: str, k: int = 20) -> str:
    """CTEs that end in {p}_top (qid, rid, score, rank); q has qid, text, t has rid, text, row_size."""
    return f"""{p}_tp AS (SELECT rid, row_size, tok, count(*) AS f FROM (SELECT rid, row_size, unnest({toks("text")}) AS tok FROM {t}) GROUP BY ALL),
{p}_st AS (SELECT count(*) AS n, avg(row_size) AS d FROM {t}),
{p}_df AS (SELECT tok, greatest(ln((n - df + 0.5) / (df + 0.5)), 1e-6) AS idf FROM (SELECT tok, count(*) AS df FROM {p}_tp GROUP BY tok), {p}_st),
{p}_qw AS (SELECT qid, unnest({toks("text")}) AS tok, generate_subscripts({toks("text")}, 1) AS pos FROM {q}),
{p}_qp AS (SELECT qid, tok FROM (SELECT qid, tok, row_number() OVER (PARTITION BY qid ORDER BY min(pos)) AS r FROM {p}_qw GROUP BY qid, tok) WHERE r <= 16),
{p}_sc AS (SELECT qid, rid, round(sum(idf * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * row_size / d))), 6) AS s FROM {p}_qp JOIN {p}_df USING (tok) JOIN {p}_tp USING (tok), {p}_st GROUP BY qid, rid),
{p}_top AS (SELECT qid, rid, -s AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY s DESC, rid) AS rank FROM {p}_sc) WHERE rank <= {k})"""


def grams(source: str, key: str, low: int, high: int) -> str:
    words = f"SELECT {key}, w, length(w) + 2 AS l FROM (SELECT {key}, unnest({toks('text')}) AS w FROM {source})"
    sized = f"SELECT {key}, ' ' || w || ' ' AS p, l, unnest(range({low}, least({high}, greatest(l, {low})) + 1)) AS n FROM ({words})"
    return f"SELECT {key}, substr(p, place, n) AS term FROM (SELECT {key}, p, n, unnest(range(1, greatest(l - n + 1, 1) + 1)) AS place FROM ({sized}))"


def tfidf(p: str, q: str, t: str, kind: str = "char", low: int = 3, high: int = 5, sublinear: bool = True, min_df: int = 2, k: int = 20, max_features: int = 150_000) -> str:
    of = lambda source, key: grams(source, key, low, high) if kind == "char" else f"SELECT {key}, unnest({toks('text')}) AS term FROM {source}"
    tf = "(1 + ln(tf))" if sublinear else "tf"
    return f"""{p}_tg AS (SELECT rid, term, count(*) AS tf FROM ({of(t, "rid")}) GROUP BY ALL), {p}_qg AS (SELECT qid, term, count(*) AS tf FROM ({of(q, "qid")}) GROUP BY ALL),
{p}_v AS (SELECT term, ln((1 + (SELECT count(*) FROM {t})) / (1 + count(*))) + 1 AS idf FROM {p}_tg GROUP BY term HAVING count(*) >= {min_df} ORDER BY sum(tf) DESC, term LIMIT {max_features}),
{p}_tw AS (SELECT rid, term, {tf} * idf AS w FROM {p}_tg JOIN {p}_v USING (term)), {p}_qw AS (SELECT qid, term, {tf} * idf AS w FROM {p}_qg JOIN {p}_v USING (term)),
{p}_tn AS (SELECT rid, sqrt(sum(w * w)) AS norm FROM {p}_tw GROUP BY rid), {p}_qn AS (SELECT qid, sqrt(sum(w * w)) AS norm FROM {p}_qw GROUP BY qid),
{p}_sc AS (SELECT qid, rid, round(sum((a.w / x.norm) * (b.w / y.norm)), 6) AS s FROM {p}_qw a JOIN {p}_tw b USING (term) JOIN {p}_qn x USING (qid) JOIN {p}_tn y USING (rid) GROUP BY qid, rid),
{p}_top AS (SELECT qid, rid, s AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY s DESC, rid) AS rank FROM {p}_sc WHERE s > 0) WHERE rank <= {k})"""


def field_sides(field: str, fields: tuple[str, ...] = ("name", "address")) -> str:
    size = " + ".join(f"len({toks(f)})" for f in fields)
    return f"q_{field} AS (SELECT qid, {field} AS text FROM q WHERE {field} <> ''), t_{field} AS (SELECT rid, {field} AS text, {size} AS row_size FROM t)"


def channels(sides: str, fields: tuple[str, ...], k: int = 20) -> str:
    """CTEs that end in ch (qid, rid, score, rank, channel)."""
    parts = [x for f in fields for x in (field_sides(f, fields), bm25(f"b_{f}", f"q_{f}", f"t_{f}", k), tfidf(f"c_{f}", f"q_{f}", f"t_{f}", k=k))]
    union = " UNION ALL ".join(f"SELECT *, '{kind}_{f}' AS channel FROM {p}_{f}_top" for f in fields for kind, p in (("bm25", "b"), ("tfidf", "c")))
    return f"{sides}, {', '.join(parts)}, ch AS ({union})"


ALL_FIELDS = ("name", "address", "tname", "taddress")
CHANNELS = channels(SEARCH, ("name", "address"))
HYBRID = channels(normal("doc_id % 20 = 0", "true"), ALL_FIELDS)


def fused(source: str) -> str:
    return f"SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rrf DESC, rid) AS global_rank FROM (SELECT qid, rid, round(sum(1 / (60 + rank)), 12) AS rrf, count(*) AS n_channels, min(rank) AS best_rank FROM {source} GROUP BY qid, rid)"


# ---------------------------------------------------------------- retrieval

SQL["bm25_topk"] = f"WITH {PARTS}, {bm25('x', 'pq', 'pt')} SELECT * FROM x_top"
SQL["tfidf_char_topk"] = f"WITH {PARTS}, {tfidf('x', 'pq', 'pt')} SELECT * FROM x_top"
SQL["tfidf_word_topk"] = f"WITH {PARTS}, {tfidf('x', 'pq', 'pt', 'word', sublinear=False, min_df=1)} SELECT * FROM x_top"
SQL["tfidf_legacy_topk"] = f"WITH {PARTS}, {tfidf('x', 'pq', 'pt', low=2, sublinear=False, min_df=1, max_features=200_000)} SELECT * FROM x_top"
SQL["bm25_topk_two_field"] = f"WITH {SEARCH}, {field_sides('name')}, {field_sides('address')}, {bm25('bn', 'q_name', 't_name')}, {bm25('ba', 'q_address', 't_address')} SELECT qid, rid FROM bn_top UNION SELECT qid, rid FROM ba_top"
SQL["budget_recut"] = f"WITH {PARTS}, {bm25('b', 'pq', 'pt', 50)}, {tfidf('c', 'pq', 'pt', k=50)} SELECT qid, rid, 'bm25_text' AS channel, rank FROM b_top WHERE rank <= 10 UNION ALL SELECT qid, rid, 'tfidf_text', rank FROM c_top WHERE rank <= 20"
SQL["hybrid_rrf_topk"] = f"WITH {HYBRID} SELECT qid, rid, round(rrf, 8) AS rrf, n_channels, best_rank, global_rank FROM ({fused('ch')}) WHERE global_rank <= 20"
SQL["rrf_mode_subset"] = f"WITH {CHANNELS} SELECT qid, rid, round(rrf, 8) AS rrf, global_rank FROM ({fused('(SELECT * FROM ch WHERE channel LIKE $$tfidf%$$)')})"
SQL["channel_scores"] = f"WITH {SEARCH}, q_name AS (SELECT qid, name AS text FROM q WHERE name <> ''), t_name AS (SELECT rid, name AS text, len({toks('name')}) AS row_size FROM t), {bm25('bn', 'q_name', 't_name')}, {tfidf('cn', 'q_name', 't_name')} SELECT qid, rid, c.score AS tfidf, b.score AS bm25, (c.score IS NOT NULL)::BIGINT + (b.score IS NOT NULL)::BIGINT AS n_ranks FROM cn_top c FULL JOIN bn_top b USING (qid, rid)"
SQL["tfidf_pair_cosine"] = f"WITH {PAIRS}, pt AS (SELECT p_partkey AS rid, text FROM names), pq AS (SELECT p_partkey AS qid, text FROM names), {tfidf('x', 'pq', 'pt')} SELECT p_partkey, round(coalesce(sum((a.w / m.norm) * (b.w / n.norm)), 0), 6) AS cosine FROM pairs LEFT JOIN x_qw a ON a.qid = p_partkey LEFT JOIN x_tw b ON b.rid = p_partkey + 1 AND b.term = a.term LEFT JOIN x_qn m ON m.qid = p_partkey LEFT JOIN x_tn n ON n.rid = p_partkey + 1 GROUP BY p_partkey"
SQL["embedding_cosine_topk"] = "WITH s AS (SELECT a.vec_id AS qid, b.vec_id AS rid, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score FROM embeddings a, embeddings b WHERE a.vec_id % 20 = 0) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, rid) AS rank FROM s WHERE score > 0) WHERE rank <= 20"

# ---------------------------------------------------------------- exact blocking

BLOCKED = """q AS (SELECT 'S1-' || s_suppkey AS qid, split_part(s_name, '#', -1) AS name, CASE WHEN s_suppkey % 10 = 0 THEN '' ELSE s_nationkey::VARCHAR END AS country FROM supplier),
c AS (SELECT 'S2-' || c_custkey AS tid, split_part(c_name, '#', -1) AS name, c_nationkey::VARCHAR AS country FROM customer),
m AS (SELECT qid, tid FROM q JOIN c ON q.name = c.name AND (q.country = '' OR q.country = c.country) WHERE q.name <> '')"""
SQL["exact_name_country"] = f"WITH {BLOCKED} SELECT * FROM m"
SQL["exact_list_output"] = f"WITH {BLOCKED} SELECT qid, coalesce(string_agg(tid, ',' ORDER BY tid), '') AS matched_entity_ids FROM q LEFT JOIN m USING (qid) GROUP BY qid"
SQL["exact_unmatched"] = f"WITH {BLOCKED} SELECT qid FROM q WHERE qid NOT IN (SELECT qid FROM m)"

# ---------------------------------------------------------------- text

SQL["clean_text"] = f"WITH {RECORDS} SELECT doc_id, {clean('name')} AS name, {clean('address')} AS address FROM rec"
SQL["clean_ascii"] = "SELECT p_partkey, " + clean_ascii("p_name || ' & ' || p_type") + " AS text FROM part"
SQL["normalize_legacy"] = f"WITH {RECORDS} SELECT doc_id, trim(regexp_replace(regexp_replace(replace(strip_accents(replace(lower(name), 'ß', 'ss')), '&', ' and '), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS name FROM rec"
SQL["transliterated"] = f"WITH {RECORDS} SELECT doc_id, {latin('name')} AS name FROM rec"
# Greek v has no letter of its own; Hebrew stands in with other letters.
SQL["transliterated_scripts"] = "WITH n AS (SELECT p_partkey, regexp_replace(p_name, '[^abdegiklmnoprstuv ]', '', 'g') AS name FROM part) SELECT p_partkey, name AS cyrillic, translate(name, 'v', 'b') AS greek, translate(name, 'eikou', 'ayqvb') AS hebrew FROM n"
COMPANIES = """comp AS (SELECT c_custkey, lower(c_mktsegment) || ['', ' pvt ltd', ' inc', ' company', ' llc co', ' corporation limited', ' ltda'][c_custkey % 7 + 1] AS name,
c_custkey || ' st mary rd apt ' || (c_nationkey * 997 + 10000) || CASE WHEN c_custkey % 3 = 0 THEN ' 12ab 7b' ELSE '' END || CASE WHEN c_custkey % 4 = 0 THEN ' hwy 123456' ELSE '' END AS address FROM customer)"""
WORDS_OF_KEY = "array_to_string(list_transform(string_split(c_custkey::VARCHAR, ''), lambda c: ['Orchid', 'Maple', 'Falcon', 'Cedar', 'Lotus', 'Amber', 'River', 'Coral', 'Silver', 'Olive'][c::INT + 1]), ' ')"
FIRMS = f"""firm0 AS (SELECT c_custkey, {WORDS_OF_KEY} AS w, c_custkey // 20 % 4 AS form, (c_nationkey * 997 + 10000)::VARCHAR AS zip, 'Nation ' || c_nationkey AS nation FROM customer),
firm AS (SELECT c_custkey, w || ' Pvt Ltd' AS qn, CASE WHEN form = 1 THEN replace(w, ' ', '') ELSE w END || ' ' || ['', 'Ltd', 'Private Limited'][c_custkey % 3 + 1] AS tn, c_custkey || ' St Mary Rd, Apt ' || zip AS qa, CASE WHEN form = 2 THEN '9' || c_custkey || ' Market Ln' ELSE c_custkey || ' St. Mary Road ' || zip END AS ta, CASE WHEN form = 3 THEN '' ELSE nation END AS tc FROM firm0)"""


def firm_fields(key: str, name: str, address: str) -> str:
    return f"SELECT c_custkey AS {key}, {mapped(clean_ascii(name), NAME_MAPPINGS)} AS name, {mapped(clean_ascii(address), ADDRESS_MAPPINGS)} AS address FROM firm"


FIRM_SIDES = f"{FIRMS}, q AS (SELECT *, name AS tname, address AS taddress FROM ({firm_fields('qid', 'qn', 'qa')}) WHERE qid % 20 = 0), t AS (SELECT *, name AS tname, address AS taddress FROM ({firm_fields('rid', 'tn', 'ta')}))"
SQL["hybrid_companies_topk"] = f"WITH {channels(FIRM_SIDES, ALL_FIELDS)} SELECT qid, rid, round(rrf, 8) AS rrf, n_channels, best_rank, global_rank FROM ({fused('ch')}) WHERE global_rank <= 20"
SQL["normalized_companies"] = f"WITH {FIRM_SIDES} SELECT rid, t.name AS name_norm, t.address AS address_norm, regexp_replace(t.name, '(?:(?:^| )(?:{'|'.join(SUFFIXES)}))+$', '') AS name_core, tname AS name_translit, taddress AS address_translit, {clean_ascii('tc')} AS country_norm, 'LATIN' AS script FROM t JOIN firm ON c_custkey = rid"
SQL["token_mapping"] = f"WITH {COMPANIES} SELECT c_custkey, {mapped('name', NAME_MAPPINGS)} AS name, {mapped('address', ADDRESS_MAPPINGS)} AS address, {mapped('address', ADDRESS_MAPPINGS | STREET_MAPPING)} AS street FROM comp"
SQL["suffix_strip"] = f"WITH {COMPANIES} SELECT c_custkey, regexp_replace({mapped('name', NAME_MAPPINGS)}, '(?:(?:^| )(?:{'|'.join(SUFFIXES)}))+$', '') AS core FROM comp"
SQL["first_distinct_tokens"] = f"WITH {RECORDS}, c AS (SELECT doc_id, {toks(clean('address'))} AS w FROM rec), p AS (SELECT doc_id, unnest(w) AS tok, generate_subscripts(w, 1) AS pos FROM c), o AS (SELECT doc_id, tok, min(pos) AS pos FROM p GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS r FROM o) SELECT doc_id, coalesce(string_agg(tok, ' ' ORDER BY pos) FILTER (WHERE r <= 16), '') AS tokens FROM c LEFT JOIN r USING (doc_id) GROUP BY doc_id"
SQL["script_label"] = f"WITH {RECORDS} SELECT doc_id, CASE WHEN regexp_matches(name, '\\p{{Latin}}') THEN 'LATIN' ELSE 'NONE' END AS script FROM rec"


def joined(x: str) -> str:
    return f"array_to_string(list_sort(list_distinct({x})), ',')"


SQL["numbers_postal_house"] = f"WITH {COMPANIES} SELECT c_custkey, {joined(chr(114) + 'egexp_extract_all(address, $$\\b\\d+\\b$$)')} AS numbers, {joined('regexp_extract_all(address, $$\\b\\d{5,6}\\b$$)')} AS postal, regexp_extract(address, '\\b\\d+[a-z]?\\b') AS house FROM comp"
ACCENTED = "[À-ÅÇ-ÏÑ-ÖÙ-Ýà-åç-ïñ-öù-ýÿ-ďĒ-ĥĨ-İĴ-ķĹ-ľŃ-ňŌ-őŔ-ťŨ-žƠơƯưǍ-ǜǞ-ǣǦ-ǰǴǵǸ-țȞȟȦ-ȳḀ-ẙẛẠ-ỹ]"
INDIC_CLASS = "[" + "".join(f"\\p{{{s.capitalize()}}}" for s in INDIC) + "]"
FLAGS = {
    "non_ascii": "regexp_matches(x, '[^\\x00-\\x7F]')",
    "accented_latin": f"regexp_matches(x, '{ACCENTED}')",
    "indic": f"regexp_matches(x, '{INDIC_CLASS}')",
    "devanagari": "regexp_matches(x, '\\p{Devanagari}')",
    "mixed_script": "regexp_matches(x, '\\p{Latin}') AND regexp_matches(x, '[\\p{Greek}\\p{Cyrillic}\\p{Arabic}\\p{Hebrew}\\p{Han}]')",
    "numeric_token": "regexp_matches(x, '(^|[^\\p{L}\\p{N}_])\\d+($|[^\\p{L}\\p{N}_])')",
    "likely_postal": "regexp_matches(x, '(^|[^\\p{L}\\p{N}_])\\d{5,6}($|[^\\p{L}\\p{N}_])')",
}
SQL["char_flags"] = f"WITH {RECORDS} SELECT doc_id, {', '.join(f'({v})::BIGINT AS {k}' for k, v in FLAGS.items())} FROM (SELECT doc_id, name || ' ' || address AS x FROM rec)"
SQL["char_ngram_counts"] = f"WITH {PARTS} SELECT term AS gram, count(*) AS n FROM ({grams('pt', 'rid', 3, 5)}) GROUP BY term"

# ---------------------------------------------------------------- ingest and integrity

LINES = """lines AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 3 WHEN c_custkey % 7 = 0 THEN 6 ELSE 4 END AS fields, c_name, c_mktsegment FROM customer)"""
SQL["repair_rows"] = f"WITH {LINES} SELECT c_custkey, 'S2-' || c_custkey AS entity_id, c_name AS business_name, CASE fields WHEN 6 THEN 'Unit 4 ' || c_mktsegment ELSE c_mktsegment END AS business_address, CASE fields WHEN 3 THEN '' WHEN 6 THEN 'FR' ELSE 'DE' END AS country FROM lines"
SQL["repair_audit"] = f"WITH {LINES} SELECT CASE fields WHEN 3 THEN 'missing_trailing_country' ELSE 'extra_tabs_in_address' END AS repair, count(*) AS n FROM lines WHERE fields <> 4 GROUP BY 1"
SQL["id_list_validate"] = "WITH l AS (SELECT c_custkey, ['', 'a', 'a,b', 'a,a', 'a,', ' a,b', 'a, b', 'b,,c'][c_custkey % 8 + 1] AS list FROM customer), i AS (SELECT c_custkey, CASE WHEN list = '' THEN []::VARCHAR[] ELSE string_split(list, ',') END AS ids FROM l) SELECT c_custkey, len(ids) AS n_ids, (len(list_filter(ids, lambda x: x = '' OR trim(x) <> x)) > 0 OR len(list_distinct(ids)) <> len(ids))::BIGINT AS bad FROM i"
SQL["id_well_formed"] = "WITH m AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'S2-' || c_custkey WHEN 1 THEN 'S3-' || c_custkey WHEN 2 THEN ' S2-' || c_custkey ELSE 'S2-' || c_custkey || ',1' END AS id FROM customer) SELECT c_custkey, (starts_with(id, 'S2-') AND trim(id) = id AND NOT contains(id, ','))::BIGINT AS ok FROM m"
GUESSED = f"""{RECORDS}, q AS (SELECT entity_id AS qid, doc_id FROM rec WHERE source = 1), t AS (SELECT entity_id AS tid, source FROM rec WHERE source > 1),
links AS (SELECT qid, 'S' || ((doc_id + 1) % 2 + 2) || '-' || (doc_id + doc_id % 4) AS tid FROM q WHERE doc_id % 9 <> 0),
labels AS (SELECT qid FROM q WHERE doc_id % 9 <> 0 UNION ALL SELECT qid FROM q WHERE doc_id % 8 = 0 AND doc_id % 9 <> 0),
unknown AS (SELECT DISTINCT tid FROM links WHERE tid NOT IN (SELECT tid FROM t)), absent AS (SELECT DISTINCT qid FROM q WHERE qid NOT IN (SELECT qid FROM labels))"""
SQL["truth_unknown_targets"] = f"WITH {GUESSED} SELECT * FROM unknown"
SQL["truth_missing_labels"] = f"WITH {GUESSED} SELECT * FROM absent"
SQL["truth_examples"] = f"WITH {GUESSED} SELECT tid FROM unknown ORDER BY tid LIMIT 25"
SQL["unknown_by_prefix"] = f"WITH {GUESSED} SELECT CASE WHEN tid LIKE 'S2-%' THEN 'S2' WHEN tid LIKE 'S3-%' THEN 'S3' ELSE 'other' END AS source, count(*) AS n_links FROM links WHERE tid NOT IN (SELECT tid FROM t) GROUP BY 1"
SQL["duplicate_ids"] = f"WITH {GUESSED} SELECT 'truth' AS file, count(*) AS n_rows, count(*) - count(DISTINCT qid) AS n_duplicates FROM labels"
SQL["integrity_status"] = f"WITH {GUESSED}, {LINES}, f AS (SELECT (SELECT count(*) FROM unknown) + (SELECT count(*) FROM absent) + (SELECT count(*) - count(DISTINCT qid) FROM labels) AS failures, (SELECT count(*) FROM lines WHERE fields <> 4) AS repairs) SELECT failures, repairs, CASE WHEN failures > 0 THEN 'fail' WHEN repairs > 0 THEN 'pass_with_repairs' ELSE 'pass' END AS status FROM f"
SQL["validate_output"] = f"""WITH {GUESSED}, m AS (SELECT DISTINCT qid, tid FROM links), c AS (SELECT DISTINCT qid, tid FROM links WHERE tid IN (SELECT tid FROM t))
SELECT 'repeated_query' AS problem, 0::BIGINT AS n UNION ALL SELECT 'unknown_query', 0 UNION ALL SELECT 'bad_list', 0
UNION ALL SELECT 'query_without_row', count(*) FROM q WHERE qid NOT IN (SELECT qid FROM m) OR qid NOT IN (SELECT qid FROM c)
UNION ALL SELECT 'match_not_candidate', count(*) FROM (SELECT * FROM m EXCEPT SELECT * FROM c) UNION ALL SELECT 'unknown_target', count(*) FROM unknown"""

# ---------------------------------------------------------------- files

FILE = "file AS (SELECT *, 'S2-' || lpad(c_custkey::VARCHAR, 9, '0') AS entity_id FROM customer)"
SQL["strict_read"] = f"WITH {FILE} SELECT entity_id, c_name AS business_name, c_mktsegment AS business_address, c_nationkey::VARCHAR AS country FROM file"
SQL["repair_lines"] = f"WITH {LINES}, n AS (SELECT *, row_number() OVER (ORDER BY c_custkey) + 1 AS line FROM lines) SELECT line, 'S2-' || c_custkey AS entity_id, CASE fields WHEN 3 THEN 'missing_trailing_country' ELSE 'extra_tabs_in_address' END AS repair FROM n WHERE fields <> 4"
SQL["source_set"] = "SELECT source, c_nationkey::VARCHAR AS country, count(*) AS n, 'S' || source || '-' || lpad(min(c_custkey)::VARCHAR, 9, '0') AS first_id FROM customer, (SELECT unnest([1, 2, 3])::BIGINT AS source) GROUP BY source, c_nationkey"
SQL["file_statistics"] = f"WITH {FILE}, whole AS (SELECT concat_ws(chr(9), 'entity_id', 'business_name', 'business_address', 'country') || chr(10) || string_agg(concat_ws(chr(9), entity_id, c_name, c_mktsegment, c_nationkey) || chr(10), '' ORDER BY c_custkey) AS text, count(*) + 1 AS n FROM file) SELECT sha256(text) AS sha256, strlen(text)::BIGINT AS bytes, n AS physical_lines FROM whole"
LISTS = f"{RECORDS}, l AS (SELECT DISTINCT a.entity_id AS qid, b.entity_id AS tid FROM rec a JOIN rec b USING (digest) WHERE a.source = 1 AND b.source > 1)"
SQL["list_file"] = f"WITH {LISTS} SELECT entity_id AS qid, coalesce(string_agg(tid, ',' ORDER BY tid), '') AS ids, row_number() OVER (ORDER BY entity_id) + 1 AS line FROM rec LEFT JOIN l ON qid = entity_id WHERE source = 1 GROUP BY entity_id"
SQL["truth_read"] = f"WITH {LISTS} SELECT * FROM l"
SQL["files_validated"] = f"WITH {RECORDS} SELECT count(*) AS n_queries FROM rec WHERE source = 1"
SQL["manifest_guard"] = "SELECT * FROM (VALUES ('first', 'false'), ('same', 'true'), ('other', 'refused')) v(run, answer)"
SQL["resumed_scores"] = "SELECT o_orderkey, floor(o_totalprice)::BIGINT AS score FROM orders"
SQL["first_of_each"] = "SELECT file, n, c_name FROM (SELECT c_nationkey AS file, c_custkey AS n, c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r FROM customer) WHERE r <= 5"
SQL["threshold_validity"] = "SELECT c_custkey, (c_acctbal / 5000 BETWEEN 0 AND 1.000001)::BIGINT AS valid FROM customer"
SQL["tfidf_empty_vocabulary"] = "SELECT 0::BIGINT AS qid, 0::BIGINT AS rid, 0.0::DOUBLE AS score, 0::BIGINT AS rank WHERE false"

# ---------------------------------------------------------------- profiles

SQL["distribution_disc"] = "WITH d AS (SELECT lang, length(text) AS v FROM documents) SELECT lang, count(*) AS count, min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean, quantile_disc(v, 0.5) AS median, quantile_disc(v, 0.95) AS p95 FROM d GROUP BY lang"
SQL["quantile_linear"] = "SELECT l_returnflag, round(avg(l_extendedprice), 6) AS mean, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95 FROM lineitem GROUP BY 1"
TOKENS = f"{RECORDS}, tk AS (SELECT token, count(*) AS n FROM (SELECT unnest(list_concat({toks(clean('name'))}, {toks(clean('address'))})) AS token FROM rec) GROUP BY token)"
SQL["token_top30"] = f"WITH {TOKENS} SELECT * FROM tk ORDER BY n DESC, token LIMIT 30"
SQL["token_rare30"] = f"WITH {TOKENS} SELECT * FROM tk ORDER BY n, token LIMIT 30"
SQL["unique_nonblank"] = f"WITH {RECORDS} SELECT count(DISTINCT nullif(name, '')) AS unique_name, count(DISTINCT nullif(address, '')) AS unique_address FROM rec"
MISSING = {"missing_name": "regexp_replace(name, '\\s+', '', 'g') = ''", "missing_address": "regexp_replace(address, '\\s+', '', 'g') = ''", "missing_country": "trim(country) = ''"}
SQL["missing_percentages"] = f"WITH {RECORDS}, f AS (SELECT *, name || ' ' || address AS x FROM (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN '  ' ELSE name END AS name, address, country FROM rec)) " + " UNION ALL ".join(f"SELECT '{k}' AS flag, count(*) FILTER (WHERE {v}) AS n_true, round(100 * count(*) FILTER (WHERE {v}) / count(*), 6) AS percentage FROM f" for k, v in (MISSING | FLAGS).items())
SQL["group_counts"] = f"WITH {RECORDS} SELECT country, count(*) AS n FROM rec GROUP BY country"
SQL["script_counts"] = f"WITH {RECORDS} SELECT CASE WHEN regexp_matches(name || ' ' || address, '\\p{{Latin}}') THEN 'LATIN' ELSE 'NONE' END AS script, count(*) AS n FROM rec GROUP BY 1"
SQL["repeated_names"] = f"WITH {RECORDS} SELECT count(*) AS n_repeated FROM (SELECT name FROM rec WHERE name <> '' GROUP BY name HAVING count(*) > 1)"
SQL["truth_cardinality"] = f"""WITH {RECORDS}, l AS (SELECT a.entity_id AS qid, b.entity_id AS tid FROM rec a JOIN rec b USING (digest) WHERE a.source = 1 AND b.source > 1),
n AS (SELECT r.entity_id, count(tid) AS n, count(*) FILTER (WHERE tid LIKE 'S2-%') AS s2, count(*) FILTER (WHERE tid LIKE 'S3-%') AS s3 FROM rec r LEFT JOIN l ON l.qid = r.entity_id WHERE r.source = 1 GROUP BY 1)
SELECT count(*) AS n_queries, round(100 * count(*) FILTER (WHERE n = 0) / count(*), 6) AS singleton_percentage, count(*) FILTER (WHERE n = 1) AS one_match, count(*) FILTER (WHERE n = 2) AS two_matches, count(*) FILTER (WHERE n >= 3) AS three_plus, sum(n)::BIGINT AS total_links, sum(s2)::BIGINT AS source2_links, sum(s3)::BIGINT AS source3_links, round(avg(n), 6) AS average_matches FROM n"""
SQL["cardinality_histogram"] = f"WITH {RECORDS}, l AS (SELECT a.entity_id AS qid, b.entity_id AS tid FROM rec a JOIN rec b USING (digest) WHERE a.source = 1 AND b.source > 1), n AS (SELECT r.entity_id, count(tid) AS n_matches FROM rec r LEFT JOIN l ON l.qid = r.entity_id WHERE r.source = 1 GROUP BY 1) SELECT n_matches, count(*) AS n_queries FROM n GROUP BY 1"
LEVENSHTEIN = "(CASE WHEN a <> '' AND b <> '' THEN 1 - levenshtein(a, b) / greatest(length(a), length(b)) ELSE 0.0 END)"
SQL["feature_summary"] = f"WITH {PAIRS}, v AS (SELECT 'k' || p_partkey % 3 AS sample_type, {LEVENSHTEIN} AS levenshtein, {jaccard(toks('a'), toks('b'))} AS jaccard FROM pairs) " + " UNION ALL ".join(f"SELECT sample_type, '{k}' AS feature, round(avg({k}), 6) AS mean, round(quantile_cont({k}::DOUBLE, 0.5), 6) AS p50, round(quantile_cont({k}::DOUBLE, 0.95), 6) AS p95 FROM v GROUP BY sample_type" for k in ("levenshtein", "jaccard"))

# ---------------------------------------------------------------- sampling, graph, splits

SQL["hash_sample"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY sha256('42:' || o_orderkey), o_orderkey LIMIT 100"
SQL["label_complete_sample"] = f"""WITH {RECORDS}, l AS (SELECT DISTINCT b.entity_id AS tid FROM rec a JOIN rec b USING (digest) WHERE a.source = 1 AND b.source > 1), t AS (SELECT entity_id AS tid, source FROM rec WHERE source > 1)
SELECT tid, source::BIGINT AS source, 'positive' AS role FROM t WHERE tid IN (SELECT tid FROM l) UNION ALL
SELECT tid, source, 'distractor' FROM (SELECT tid, source, row_number() OVER (PARTITION BY source ORDER BY sha256((source + 42) || ':' || tid), tid) AS r FROM t WHERE tid NOT IN (SELECT tid FROM l)) WHERE r <= 50"""
COMPONENTS = """RECURSIVE e AS (SELECT DISTINCT doc_id AS qid, md5(split_part(text, chr(10), 1)) AS tid FROM documents UNION SELECT doc_id, md5(text) FROM documents),
n AS (SELECT DISTINCT a.qid AS x, b.qid AS y FROM e a JOIN e b USING (tid)), reach AS (SELECT x, y FROM n UNION SELECT r.x, n.y FROM reach r JOIN n ON r.y = n.x),
comp AS (SELECT x AS qid, min(y) AS component FROM reach GROUP BY x)"""
SQL["components"] = f"WITH {COMPONENTS} SELECT * FROM comp"
SQL["components_of_sample"] = f"WITH {COMPONENTS.replace('e AS (', 'e AS (SELECT * FROM (').replace(' FROM documents),', ' FROM documents) WHERE qid % 20 = 0),')} SELECT * FROM comp"
SQL["grouped_split"] = f"WITH {COMPONENTS}, g AS (SELECT component, row_number() OVER (ORDER BY sha256('42:' || component), component) AS place, count(*) OVER () AS n FROM (SELECT DISTINCT component FROM comp)), h AS (SELECT *, ceil(round(n * 0.4, 9)) AS rest FROM g) SELECT qid, component, CASE WHEN place <= n - rest THEN 'train' WHEN place <= n - ceil(rest / 2) THEN 'calibration' ELSE 'holdout' END AS split FROM comp JOIN h USING (component)"
PLACE = "(('0x' || substr(sha256('42:' || component), 1, 8))::BIGINT)"
SQL["grouped_folds"] = f"WITH {COMPONENTS} SELECT qid, component, {PLACE} % 5 AS fold FROM comp"

# ---------------------------------------------------------------- similarities

SQL["levenshtein_sim"] = f"WITH {PAIRS} SELECT p_partkey, round({LEVENSHTEIN}, 6) AS sim FROM pairs"
SQL["jaro_winkler_sim"] = f"WITH {PAIRS} SELECT p_partkey, round(jaro_similarity(a, b), 6) AS jaro, round(jaro_winkler_similarity(a, b), 6) AS jaro_winkler FROM pairs"
SQL["token_set_features"] = f"WITH {PAIRS}, w AS (SELECT p_partkey, a, b, {toks('a')} AS x, {toks('b')} AS y FROM pairs) SELECT p_partkey, round({jaccard('x', 'y')}, 6) AS jaccard, round(CASE WHEN len(x) > 0 AND len(y) > 0 THEN len(list_intersect(x, y)) / least(len(list_distinct(x)), len(list_distinct(y))) ELSE 0 END, 6) AS overlap, (CASE WHEN len(x) > 0 AND len(y) > 0 AND (list_has_all(x, y) OR list_has_all(y, x)) THEN 1 ELSE 0 END)::DOUBLE AS containment, (a = b AND a <> '')::INT::DOUBLE AS exact FROM w"
SQL["prefix_length"] = f"WITH {PAIRS}, n AS (SELECT p_partkey, a, b, len(list_filter(range(1, least(length(a), length(b)) + 1), lambda n: substr(a, 1, n) = substr(b, 1, n))) AS c FROM pairs) SELECT p_partkey, round(CASE WHEN a <> '' AND b <> '' THEN c / least(length(a), length(b)) ELSE 0 END, 6) AS prefix, round(CASE WHEN a <> '' AND b <> '' THEN least(length(a), length(b)) / greatest(length(a), length(b)) ELSE 0 END, 6) AS length_ratio FROM n"
SQL["numeric_features"] = f"""WITH {COMPANIES}, p AS (SELECT x.c_custkey, x.address AS a, y.address AS b FROM comp x JOIN comp y ON y.c_custkey = x.c_custkey + 1),
n AS (SELECT *, regexp_extract_all(a, '\\b\\d+\\b') AS na, regexp_extract_all(b, '\\b\\d+\\b') AS nb, regexp_extract_all(a, '\\b\\d{{5,6}}\\b') AS pa, regexp_extract_all(b, '\\b\\d{{5,6}}\\b') AS pb, regexp_extract(a, '\\b\\d+[a-z]?\\b') AS ha, regexp_extract(b, '\\b\\d+[a-z]?\\b') AS hb FROM p)
SELECT c_custkey, round({jaccard("na", "nb")}, 6) AS numeric_jaccard, len(list_intersect(na, nb))::DOUBLE AS number_intersection, (len(na) > 0 AND len(nb) > 0 AND len(list_intersect(na, nb)) = 0)::INT::DOUBLE AS numeric_conflict, (ha <> '' AND ha = hb)::INT::DOUBLE AS house_equal, (len(list_intersect(pa, pb)) > 0)::INT::DOUBLE AS postal_equal, (len(pa) > 0 AND len(pb) > 0 AND len(list_intersect(pa, pb)) = 0)::INT::DOUBLE AS postal_conflict, (len(pa) = 0 OR len(pb) = 0)::INT::DOUBLE AS postal_missing FROM n"""

# ---------------------------------------------------------------- evaluation

CANDIDATES = f"""{SIDES}, q_name AS (SELECT qid, name AS text FROM q WHERE name <> ''), t_name AS (SELECT rid, name AS text, len({toks("name")}) AS row_size FROM t), {bm25("bn", "q_name", "t_name")},
cand AS (SELECT b.qid, b.rid, b.rank, round(({jaccard("q_n", "t_n")} + {jaccard("q_a", "t_a")}) / 2, 6) AS score FROM (SELECT bn_top.qid, bn_top.rid, bn_top.rank, {toks("q.name")} AS q_n, {toks("t.name")} AS t_n, {toks("q.address")} AS q_a, {toks("t.address")} AS t_a FROM bn_top JOIN q USING (qid) JOIN t USING (rid)) b),
y AS (SELECT c.*, (l.rid IS NOT NULL)::BIGINT AS y FROM cand c LEFT JOIN links l USING (qid, rid)),
per AS (SELECT q.qid, q.country, CASE WHEN regexp_matches(q.name, '\\p{{Latin}}') THEN 'LATIN' ELSE 'NONE' END AS script, coalesce(n_true, 0) AS n_true, coalesce(n_predicted, 0) AS n_predicted, coalesce(n_hit, 0) AS n_hit, coalesce(n_candidates, 0) AS n_candidates, coalesce(n_found, 0) AS n_found FROM q
LEFT JOIN (SELECT qid, count(*) AS n_true FROM links GROUP BY qid) USING (qid) LEFT JOIN (SELECT qid, count(*) AS n_candidates, sum(y)::BIGINT AS n_found, count(*) FILTER (WHERE score >= 0.6) AS n_predicted, coalesce(sum(y) FILTER (WHERE score >= 0.6), 0)::BIGINT AS n_hit FROM y GROUP BY qid) USING (qid))"""
F_HALF = "CASE WHEN n_true = 0 THEN (n_predicted = 0)::INT ELSE 1.25 * n_hit / (0.25 * n_true + n_predicted) END"
MEASURES = f"""count(*) AS s1_count, round(avg({F_HALF}), 6) AS macro_f05, round(coalesce(sum(n_hit) / nullif(sum(n_predicted), 0), 0), 6) AS micro_precision, round(sum(n_hit) / nullif(sum(n_true), 0), 6) AS micro_recall,
round(count(*) FILTER (WHERE n_true = 0 AND n_predicted = 0) / nullif(count(*) FILTER (WHERE n_true = 0), 0), 6) AS singleton_accuracy, round(sum(n_found) / nullif(sum(n_true), 0), 6) AS candidate_micro_recall, round(avg(n_predicted), 6) AS average_predicted_matches, (sum(n_predicted) - sum(n_hit))::BIGINT AS false_positives, (sum(n_true) - sum(n_hit))::BIGINT AS false_negatives"""
SQL["label_join"] = f"WITH {CANDIDATES} SELECT qid, rid, score, y FROM y"
SQL["class_counts"] = f"WITH {CANDIDATES} SELECT CASE WHEN y = 1 THEN 'positive' WHEN rank <= 5 THEN 'hard_negative' ELSE 'normal_negative' END AS class, count(*) AS n_pairs FROM y GROUP BY 1"
SQL["macro_f05"] = f"WITH {CANDIDATES} SELECT count(*) AS s1_count, round(avg({F_HALF}), 6) AS macro_f05 FROM per"
SQL["micro_metrics"] = f"WITH {CANDIDATES} SELECT * EXCLUDE (macro_f05) FROM (SELECT {MEASURES} FROM per)"
SQL["slice_breakdown"] = f"WITH {CANDIDATES}, s AS (SELECT *, unnest(['all', 'country:' || country, 'script:' || script, 'writing:' || CASE script WHEN 'LATIN' THEN 'Latin' WHEN 'NONE' THEN 'unknown' ELSE 'non-Latin' END, 'cardinality:' || CASE n_true WHEN 0 THEN 'singleton' WHEN 1 THEN 'one-match' ELSE 'multi-match' END]) AS slice FROM per) SELECT slice, {MEASURES} FROM s GROUP BY slice"
TRACE = f"""{CANDIDATES}, grid AS (SELECT step, CASE WHEN step = 201 THEN 1.000001 ELSE step / 200 END AS threshold FROM (SELECT unnest(range(0, 202)) AS step)),
steps AS (SELECT g.step, p.qid, p.n_true, count(c.rid) AS n_predicted, coalesce(sum(c.y), 0) AS n_hit FROM grid g CROSS JOIN per p LEFT JOIN y c ON c.qid = p.qid AND round(c.score * 200, 9) >= g.step GROUP BY ALL),
trace AS (SELECT step, round(threshold, 6) AS threshold, round(avg({F_HALF}), 6) AS macro_f05 FROM steps JOIN grid USING (step) GROUP BY ALL)"""
SQL["threshold_trace"] = f"WITH {TRACE} SELECT * FROM trace"
SQL["threshold_search"] = f"WITH {TRACE} SELECT threshold, macro_f05 FROM trace ORDER BY macro_f05 DESC, threshold DESC LIMIT 1"
SQL["candidate_sizes"] = f"WITH {CANDIDATES} SELECT round(avg(n_candidates), 6) AS average_candidates, round(quantile_cont(n_candidates::DOUBLE, 0.5), 6) AS median_candidates, round(quantile_cont(n_candidates::DOUBLE, 0.95), 6) AS p95_candidates, round(quantile_cont(n_candidates::DOUBLE, 0.99), 6) AS p99_candidates, sum(n_candidates)::BIGINT AS candidate_pairs, round(1 - avg(n_candidates) / (SELECT count(*) FROM t), 6) AS reduction_ratio FROM per"
RETRIEVED = channels(normal("source = 1", "source > 1"), ALL_FIELDS, 50) + f", fused AS ({fused('ch')}), within AS (SELECT * FROM ch WHERE rank <= 20), cut AS ({fused('within')})"
HITS = "per_q AS (SELECT q.qid, count(l.rid) AS n_true, count(c.rid) AS n_found, {at} FROM q LEFT JOIN links l USING (qid) LEFT JOIN fused c ON c.qid = l.qid AND c.rid = l.rid GROUP BY q.qid)"
SQL["recall_at_k"] = f"WITH {RETRIEVED}, {HITS.format(at=', '.join(f'count(*) FILTER (WHERE c.global_rank <= {k}) AS at_{k}' for k in (5, 10, 20, 30, 50)))} SELECT count(*) AS s1_count, round(sum(n_found) / nullif(sum(n_true), 0), 6) AS candidate_micro_recall, round(avg(CASE WHEN n_true > 0 THEN n_found / n_true END), 6) AS macro_coverage, " + ", ".join(f"round(sum(at_{k}) / nullif(sum(n_true), 0), 6) AS recall_at_{k}" for k in (5, 10, 20, 30, 50)) + " FROM per_q"
PILOT = f"{RETRIEVED}, cy AS (SELECT cut.*, (l.rid IS NOT NULL)::BIGINT AS y FROM cut LEFT JOIN links l USING (qid, rid)), nt AS (SELECT q.qid, count(l.rid) AS n_true FROM q LEFT JOIN links l USING (qid) GROUP BY q.qid), caps AS (SELECT unnest([20, 50])::BIGINT AS k), pc AS (SELECT k, p.qid, p.n_true, count(c.rid) AS pairs, coalesce(sum(c.y), 0) AS found FROM caps CROSS JOIN nt p LEFT JOIN cy c ON c.qid = p.qid AND c.global_rank <= k GROUP BY ALL), pilot AS (SELECT k, round(sum(found) / nullif(sum(n_true), 0), 6) AS candidate_micro_recall, round(avg(CASE WHEN n_true > 0 THEN found / n_true END), 6) AS macro_coverage, count(*) FILTER (WHERE found > 0) AS query_hits, count(*) FILTER (WHERE n_true > 0) AS non_singletons, sum(pairs)::BIGINT AS candidate_pairs FROM pc GROUP BY k)"
SQL["cap_pilot"] = f"WITH {PILOT} SELECT * FROM pilot"
SQL["cap_decision"] = f"WITH {PILOT}, r AS (SELECT max(candidate_micro_recall) FILTER (WHERE k = 20) AS low, max(candidate_micro_recall) FILTER (WHERE k = 50) AS high FROM pilot) SELECT CASE WHEN low IS NULL OR high IS NULL THEN 'run_k20' WHEN high < 0.93 THEN 'targeted_rescue_required' WHEN round(high - low, 9) >= 0.01 THEN 'consider_k50_only_if_gain_justifies_cost' ELSE 'select_k20' END AS decision FROM r"
SQL["attribution"] = f"WITH {RETRIEVED}, f AS (SELECT DISTINCT qid, rid, CASE WHEN channel LIKE '%tname' OR channel LIKE '%taddress' THEN 'transliteration' WHEN channel LIKE 'tfidf%' THEN 'tfidf' ELSE 'bm25' END AS family FROM within), p AS (SELECT l.qid, l.rid, count(family) AS n, min(family) AS family FROM links l LEFT JOIN f ON f.qid = l.qid AND f.rid = l.rid GROUP BY ALL) SELECT CASE n WHEN 0 THEN 'missed_all' WHEN 1 THEN 'only_' || family ELSE 'multiple_families' END AS attribution, count(*) AS n_links FROM p GROUP BY 1"


def ascii_only(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace({x}, '[^ -~]', '', 'g'), '\\s+', ' ', 'g'))"


def script(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '\\p{{Latin}}') THEN 'LATIN' ELSE 'NONE' END"


def whole_numbers(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[^\\p{{L}}\\p{{N}}_]+'), lambda w: regexp_full_match(w, '\\d+'))"


SQL["error_classes"] = f"""WITH {CANDIDATES}, j AS (SELECT coalesce(l.qid, c.qid) AS qid, coalesce(l.rid, c.rid) AS tid, l.rid IS NOT NULL AS yes, coalesce(c.score >= 0.6, false) AS selected, c.rid IS NOT NULL AS retrieved FROM links l FULL JOIN cand c ON c.qid = l.qid AND c.rid = l.rid),
v AS (SELECT j.*, n_true, {script("q.name")} AS script_q, {script("t.name")} AS script_t, {whole_numbers("q.address")} AS na, {whole_numbers("t.address")} AS nb, {jaccard(toks("q.address"), toks("t.address"))} AS address_sim,
CASE WHEN {ascii_only("q.name")} <> '' AND {ascii_only("t.name")} <> '' THEN round(jaro_winkler_similarity({ascii_only("q.name")}, {ascii_only("t.name")}), 6) ELSE 0 END AS name_sim FROM j JOIN q USING (qid) JOIN t ON t.rid = j.tid JOIN per USING (qid) WHERE yes OR selected),
c AS (SELECT *, unnest(list_filter([CASE WHEN selected AND NOT yes THEN 'false_positives' END, CASE WHEN yes AND NOT selected THEN 'false_negatives' END, CASE WHEN yes AND NOT retrieved THEN 'retrieval_misses' END, CASE WHEN selected AND n_true = 0 THEN 'singleton_false_merges' END,
CASE WHEN len(na) > 0 AND len(nb) > 0 AND len(list_intersect(na, nb)) = 0 THEN 'numeric_conflicts' END, CASE WHEN name_sim >= 0.85 AND address_sim < 0.4 THEN 'high_name_low_address' END, CASE WHEN name_sim < 0.4 AND address_sim >= 0.8 THEN 'low_name_high_address' END, CASE WHEN script_q <> script_t AND yes <> selected THEN 'cross_script_failures' END], lambda x: x IS NOT NULL)) AS error_class FROM v)
SELECT error_class, qid, tid, yes::BIGINT AS yes, selected::BIGINT AS selected, retrieved::BIGINT AS retrieved, script_q, script_t FROM c"""


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
