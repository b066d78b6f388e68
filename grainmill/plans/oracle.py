"""The named queries of the core as SQL for another engine."""

from __future__ import annotations

from dataclasses import replace

from ..functions import lexicons as lex
from ..functions.profiles import LENIENT_ARABIC, PROFILES, LanguageProfile, alternation
from ..functions.text import WS
from ..operators import dedup
from ..sources.registry import CORPORA


#: The share of accented letters that the Italian letter rule asks for where it is turned on.
ITALIAN_LETTERS = 0.01


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(s: str) -> str:
    return f"regexp_replace({s}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def collapse(s: str) -> str:
    return strip(f"regexp_replace({s}, '[{WS}]+', ' ', 'g')")


def low(s: str) -> str:
    """Lower case with the two code points of the dotted capital I."""
    return f"lower(replace({s}, 'İ', 'i' || chr(775)))"


def doc_id(s: str, length: int = 12) -> str:
    return f"substr(md5({collapse(low(s))}), 1, {length})"


def found(s: str, pattern: str) -> str:
    return f"len(regexp_extract_all({s}, {q(pattern)}))"


def word_count(s: str) -> str:
    return found(s, f"[^{WS}]+")


def words(s: str) -> str:
    return f"regexp_extract_all({s}, {q(f'[^{WS}]+')})"


def ratio(a: str, b: str) -> str:
    return f"(({a})::DOUBLE / nullif(({b})::DOUBLE, 0))"


def lines(s: str) -> str:
    return f"list_filter(list_transform(string_split({s}, chr(10)), lambda x: {strip('x')}), lambda x: x <> '')"


def any_of(s: str, chars: str) -> str:
    return f"{s} IN ({', '.join(q(c) for c in chars)})"


def runs(c: str, longest: int = 5) -> str:
    """Places in a list of characters where one that is no leader equals the ``longest`` after it; without backreferences."""
    same = " AND ".join(f"{c}[i] = {c}[i + {k}]" for k in range(1, longest + 1))
    return f"list_filter(range(1, greatest(len({c}) - {longest - 1}, 1)), lambda i: {same} AND NOT ({any_of(f'{c}[i]', lex.LEADERS)}) AND {c}[i] <> chr(10))"


def case(rules: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {t} THEN '{r}'" for t, r in rules) + " END"


def citation(p: LanguageProfile) -> str:
    return (p.citation or "").replace(r"\d", r"\p{Nd}")


def line_reason(p: LanguageProfile, x: str) -> str:
    rules = [(f"regexp_matches({x}, {q(f'[^{WS}]{{{p.max_word_length + 1},}}')})", "line_long_word"), (f"contains({low(x)}, 'javascript')", "line_javascript")]
    if p.policy:
        rules.append((f"regexp_matches({low(x)}, {q(alternation(p.policy))})", "line_policy"))
    rules.append((f"{word_count(x)} < {p.min_words_per_line} AND NOT ({any_of(f'right({x}, 1)', p.line_ends)})", "line_too_few_words"))
    return case(rules)


def marked(p: LanguageProfile) -> str:
    """CTEs up to the marked lines of every document."""
    alpha = found("t", r"\p{L}")
    rules = []
    if p.specific and p.min_specific_ratio:
        rules.append((f"{ratio(found('t', f'[{p.specific}]'), alpha)} < {p.min_specific_ratio}", p.low_specific_reason))
    rules += [
        (f"length(t) < {p.min_doc_length}", "too_short_chars"), ("contains(t, '{')", "curly_bracket"), (f"regexp_matches({low('t')}, {q(alternation(p.placeholders))})", "lorem_ipsum"),
        (f"{alpha} = 0", "no_alpha_chars"), (f"{ratio(found('t', f'[{p.script}]'), alpha)} < {p.min_script_ratio}", p.low_script_reason),
    ]
    body = f"regexp_replace(t, {q(citation(p))}, '', 'g')" if p.citation else "t"
    return f"""WITH base AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
judged AS (SELECT doc_id, {case(rules)} AS raw_reason, t FROM base),
cut AS (SELECT doc_id, raw_reason, CASE WHEN raw_reason IS NULL THEN list_transform({lines(body)}, lambda x: struct_pack(line := x, reason := {line_reason(p, 'x')})) END AS m FROM judged)"""


def _top_share(n: int) -> str:
    grams = f"list_transform(range(1, greatest(len(w_) - {n - 2}, 1)), lambda i: array_to_string(w_[i:i + {n - 1}], ' '))"
    most = "list_max(list_transform(map_entries(list_aggregate({}, 'histogram')), lambda pair: CASE WHEN pair.value > 1 THEN pair.value * length(pair.key) ELSE 0 END))"
    return ratio(f"CASE WHEN len(w_) >= {n} THEN coalesce({most.format(grams)}, 0) ELSE 0 END", "length(out)")


def optional(p: LanguageProfile) -> list[tuple[str, str]]:
    mean, rules = ratio("list_sum(list_transform(w_, lambda x: length(x)))", "len(w_)"), []
    for limit, test, reason in (
        (p.min_avg_word_length, f"{mean} < {p.min_avg_word_length}", "avg_word_too_short"), (p.max_avg_word_length, f"{mean} > {p.max_avg_word_length}", "avg_word_too_long"),
        (p.dup_line_frac, f"{ratio('n - nd', 'n')} > {p.dup_line_frac}", "dup_line_frac"), (p.top_5_gram_frac, f"{_top_share(5)} > {p.top_5_gram_frac}", "top_5_gram_frac"), (p.top_10_gram_frac, f"{_top_share(10)} > {p.top_10_gram_frac}", "top_10_gram_frac"),
        (p.non_alpha_words_ratio, f"{ratio(f'len(list_filter(w_, lambda x: regexp_matches(x, {q(chr(92) + "p{L}")})))', 'len(w_)')} < {p.non_alpha_words_ratio}", "non_alpha_words"),
    ):
        if limit is not None:
            rules.append((test, reason))
    return rules


def filtered(p: LanguageProfile) -> str:
    """CTEs up to ``done(doc_id, reject_reason, filtered_text)``."""
    total = "coalesce(list_sum(list_transform({}, lambda x: length(x))), 0)"
    rules = [
        ("raw_reason IS NOT NULL", "raw"), ("n = 0", "empty"), (f"w < {p.min_doc_words}", "too_few_words"),
        (f"{ratio('e', 'n')} < {p.line_punct_thr}" + (" AND e > 0" if p.line_punct_exclude_zero else ""), "line_punct_ratio"),
        (f"{ratio('s', 'n')} > {p.short_line_thr}", "short_line_ratio"), (f"{ratio('b', 'n')} > {p.max_bullet_ratio}", "bullet_ratio"), (f"{ratio('n - 1', 'w')} > {p.new_line_ratio}", "list_ratio"),
        (f"{ratio('c - d', 'c')} > {p.char_duplicates_ratio}", "char_dup_ratio"), (f"runs OR regexp_matches(out, {q(p.laughter)})", "excessive_repetition"), *optional(p),
    ]
    return f"""{marked(p)},
kept AS (SELECT doc_id, raw_reason, list_transform(list_filter(m, lambda x: x.reason IS NULL), lambda x: x.line) AS k FROM cut),
sized AS (SELECT doc_id, raw_reason, len(k) AS n, coalesce(list_sum(list_transform(k, lambda x: {word_count('x')})), 0) AS w, len(list_filter(k, lambda x: {any_of('right(x, 1)', p.line_ends)})) AS e,
  len(list_filter(k, lambda x: length(x) <= {p.short_line_length})) AS s, len(list_filter(k, lambda x: {any_of('left(x, 1)', lex.BULLETS)})) AS b,
  {total.format('k')} AS c, {total.format('list_distinct(k)')} AS d, len(list_distinct(k)) AS nd, array_to_string(k, chr(10)) AS out FROM kept),
spelled AS (SELECT *, regexp_extract_all(coalesce(out, ''), '(?s).') AS c_ FROM sized),
run AS (SELECT * EXCLUDE (c_), len({runs('c_', p.max_char_repetition)}) > 0 AS runs, {words("coalesce(out, '')")} AS w_ FROM spelled),
done AS (SELECT doc_id, coalesce(raw_reason, {case(rules[1:])}) AS reject_reason, out FROM run)"""


def quality(p: LanguageProfile) -> str:
    return f"{filtered(p)} SELECT doc_id, reject_reason, CASE WHEN reject_reason IS NULL THEN out END AS filtered_text FROM done"


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


def language(col: str = "lang") -> str:
    head = f"regexp_extract(lower(trim({col})), '^([a-z]+)', 1)"
    names = {"ar": "'ar','ara','arb'", "tr": "'tr','tur'", "hi": "'hi','hin'", "it": "'it','ita'", "th": "'th','tha'"}
    return "CASE " + " ".join(f"WHEN {head} IN ({v}) THEN '{k}'" for k, v in names.items()) + " ELSE 'und' END"


def _by_language() -> str:
    parts = [f"SELECT d.doc_id, r.reject_reason FROM (SELECT doc_id FROM documents WHERE {language()} = '{k}') d JOIN ({quality(p)}) r USING (doc_id)" for k, p in PROFILES.items()]
    return _union([*parts, f"SELECT doc_id, 'no_profile' AS reject_reason FROM documents WHERE {language()} = 'und'"])


CONTENTS = f"SELECT {doc_id('text')} AS id, source, max({word_count('text')})::BIGINT AS tokens FROM documents WHERE text <> '' AND source <> '' GROUP BY 1, 2"


def _shingled(where: str = "text IS NOT NULL", table: str = "documents") -> str:
    n = dedup.SHINGLE
    return f"""w AS (SELECT doc_id AS doc, {words(low('text'))} AS w FROM {table} WHERE {where}),
s AS (SELECT doc, unnest(list_distinct(list_transform(range(1, greatest(len(w) - {n - 2}, 1)), lambda i: array_to_string(w[i:i + {n - 1}], ' ')))) AS s FROM w WHERE len(w) >= {n}),
hw AS (SELECT doc, list_transform(w, lambda x: ('0x' || substr(md5(x), 1, 8))::BIGINT & {dedup.PRIME}) AS hw FROM w WHERE len(w) >= {n}),
h AS (SELECT doc, unnest(list_distinct(list_transform(range(1, len(hw) - {n - 2}), lambda i: ({' + '.join(f'hw[i + {k}] * {a} % {dedup.PRIME}' for k, a in enumerate(dedup.shingle_factors()))}) % {dedup.PRIME}))) AS h FROM hw),
sig AS (SELECT doc, [{', '.join(f'min((h * {a} + {b}) % {dedup.PRIME})' for a, b in dedup.permutations())}] AS g FROM h GROUP BY doc),
band AS (SELECT doc, b AS band, md5(array_to_string(list_transform(g[b * {dedup.ROWS} + 1:b * {dedup.ROWS} + {dedup.ROWS}], lambda x: x::VARCHAR), ',')) AS bucket FROM sig, range({dedup.BANDS}) AS r(b))"""



def _edges(table: str) -> str:
    return f"""rep AS (SELECT doc_id AS doc, min(doc_id) OVER (PARTITION BY {doc_id('text', 32)}) AS rep FROM {table} WHERE text IS NOT NULL),
firsts AS (SELECT * FROM {table} WHERE doc_id IN (SELECT rep FROM rep)),
{_shingled(table='firsts')},
edges AS (SELECT least, doc FROM (SELECT min(doc) OVER (PARTITION BY band, bucket) AS least, doc FROM band) WHERE least <> doc UNION SELECT rep, doc FROM rep WHERE rep <> doc)"""


_EDGES = _edges("documents")
_LABELS = """walk AS (SELECT least AS v, least AS r FROM edges UNION SELECT doc, doc FROM edges UNION SELECT e.y, w.r FROM walk w JOIN (SELECT least AS x, doc AS y FROM edges UNION ALL SELECT doc, least FROM edges) e ON e.x = w.v WHERE w.r < e.y),
labels AS (SELECT v, min(r) AS label FROM walk GROUP BY v)"""
_CROSS = f"""src AS (SELECT * FROM documents WHERE text <> '' AND source <> ''),
{_shingled(table='src')},
met AS (SELECT band.doc, band, bucket, source FROM band JOIN src ON band.doc = src.doc_id),
per AS (SELECT band, bucket, source, min(doc) AS first FROM met GROUP BY ALL),
hub AS (SELECT band, bucket, list(first ORDER BY first, source) AS f, list(source ORDER BY first, source) AS s FROM per GROUP BY ALL HAVING count(*) > 1),
edges AS (SELECT DISTINCT least(doc, t) AS least, greatest(doc, t) AS doc FROM (SELECT met.doc, CASE WHEN met.source = s[1] THEN f[2] ELSE f[1] END AS t FROM met JOIN hub USING (band, bucket)))"""

_LISTS = f"SELECT CASE WHEN len(s) > 0 THEN s ELSE ['unknown'] END AS s, tokens FROM (SELECT list_sort(list_distinct(list_filter(coalesce(source, []), lambda x: x IS NOT NULL AND x <> ''))) AS s, coalesce({word_count('text')}, 0) AS tokens FROM consensus_docs)"


def _sentence_dedup() -> str:
    marked_text = f"regexp_replace(coalesce(text, ''), '({dedup.SENTENCE_END})([{WS}]+)', '\\1' || chr(10), 'g')"
    n = dedup.SPAN
    return f"""WITH s AS (SELECT doc_id, list_filter(list_transform(string_split({marked_text}, chr(10)), lambda x: {collapse('x')}), lambda x: x <> '') AS s FROM documents),
p AS (SELECT doc_id, unnest(range(len(s) - {n - 1})) AS pos, s FROM s WHERE len(s) >= {n}),
h AS (SELECT doc_id, pos, md5(array_to_string(list_transform(s[pos + 1:pos + {n}], lambda x: {low('x')}), chr(10))) AS h FROM p WHERE len(list_filter(s[pos + 1:pos + {n}], lambda x: {word_count('x')} < {dedup.SENTENCE_WORDS})) = 0),
o AS (SELECT doc_id, list(DISTINCT pos) AS starts FROM h WHERE h IN (SELECT h FROM h GROUP BY h HAVING count(*) >= {dedup.SPAN_COUNT}) GROUP BY doc_id),
k AS (SELECT s.doc_id, s, list_transform(list_filter(range(1, len(s) + 1), lambda i: len(list_filter(coalesce(starts, []), lambda j: i - 1 >= j AND i - 1 < j + {n})) = 0), lambda i: s[i]) AS kept FROM s LEFT JOIN o USING (doc_id))
SELECT doc_id, coalesce(array_to_string(kept, ' '), '') AS text, (len(s) - len(kept))::INTEGER AS dropped FROM k WHERE {word_count("coalesce(array_to_string(kept, ' '), '')")} >= {dedup.DOCUMENT_WORDS}"""


def _filtered_by_language() -> str:
    parts = [f"SELECT d.doc_id, d.source, r.filtered_text AS text FROM (SELECT doc_id, source FROM documents WHERE {language()} = '{k}') d JOIN ({quality(p)}) r USING (doc_id) WHERE r.reject_reason IS NULL" for k, p in PROFILES.items()]
    return _union(parts)


def _yields() -> str:
    """Documents, kept and deduplicated ones of every source."""
    count = lambda table, more="": f"SELECT coalesce(source, '') AS source, count(*) AS n{more} FROM {table} GROUP BY 1"
    return f"""WITH RECURSIVE passed AS MATERIALIZED ({_filtered_by_language()}), {_edges('passed')}, {_LABELS},
remain AS (SELECT * FROM passed WHERE doc_id NOT IN (SELECT v FROM labels WHERE v <> label))
SELECT a.source, a.n AS documents, coalesce(b.n, 0)::BIGINT AS kept, coalesce(c.n, 0)::BIGINT AS deduplicated, coalesce(c.t, 0)::BIGINT AS tokens
FROM ({count('documents')}) a LEFT JOIN ({count('passed')}) b ON a.source = b.source LEFT JOIN ({count('remain', f", sum(coalesce({word_count('text')}, 0)) AS t")}) c ON a.source = c.source"""


def _record_keys() -> str:
    """Keys of the lines that are whole JSON objects with a number or string of digits as key."""
    line = "trim(ltrim(trim(l, ' ' || chr(9) || chr(13)), chr(65279)), ' ' || chr(9) || chr(13))"
    key = "json_extract_string(l, '$.rec_key')"
    return rf"""WITH l AS (SELECT DISTINCT {line} AS l FROM (SELECT unnest(string_split(replace(body, chr(13), chr(10)), chr(10))) AS l FROM small_files)),
j AS (SELECT {key} AS k, json_type(l, '$.rec_key') AS t FROM l WHERE l LIKE '{{%' AND json_valid(l))
SELECT DISTINCT k::BIGINT AS rec_key FROM j WHERE t IN ('UBIGINT', 'BIGINT', 'VARCHAR') AND regexp_full_match(k, '[0-9]+')"""


def _records() -> str:
    """Of every key the line of the latest attempt, then with a text, then of the longest text, then of the greatest md5."""
    line = "trim(ltrim(trim(l, ' ' || chr(9) || chr(13)), chr(65279)), ' ' || chr(9) || chr(13))"
    value = lambda c: f"CASE WHEN json_type(l, '$.{c}') = 'NULL' THEN NULL ELSE json_extract_string(l, '$.{c}') END AS {c}"
    return rf"""WITH l AS (SELECT attempt, {line} AS l FROM (SELECT coalesce(attempt, 0) AS attempt, unnest(string_split(replace(body, chr(13), chr(10)), chr(10))) AS l FROM small_files)),
j AS (SELECT attempt, json_extract_string(l, '$.rec_key') AS k, json_type(l, '$.rec_key') AS t, {value('text')}, {value('source')}, {value('lang')} FROM l WHERE l LIKE '{{%' AND json_valid(l)),
r AS (SELECT k::BIGINT AS rec_key, text, source, lang, row_number() OVER (PARTITION BY k::BIGINT ORDER BY attempt DESC, text IS NOT NULL DESC, coalesce(length(text), 0) DESC,
  md5(coalesce(text, '') || chr(31) || coalesce(source, '') || chr(31) || coalesce(lang, '')) DESC) AS n FROM j WHERE t IN ('UBIGINT', 'BIGINT', 'VARCHAR') AND regexp_full_match(k, '[0-9]+'))
SELECT rec_key, text, source, lang FROM r WHERE n = 1"""


def sql() -> dict[str, str]:
    one = "coalesce(text, '')"
    script = ", ".join(f"round({ratio(found(one, f'[{p.script}]'), found(one, chr(92) + 'p{L}'))}, 6) AS {k}" for k, p in PROFILES.items())
    out = {
        "q_scan_standard": "SELECT doc_id, text, lang, source, domain FROM documents",
        "q_row_counts": "SELECT 'documents.parquet' AS file, count(*) AS rows FROM documents",
        "q_registry": f"""SELECT lang, repo, subset, output, CASE WHEN subset IS NULL THEN NULL WHEN repo = 'allenai/c4' THEN 'multilingual/c4-' || subset || '*' WHEN split_part(repo, '/', 1) = 'HuggingFaceFW' THEN 'data/' || subset || '/*' ELSE subset || '/*' END AS include
FROM (VALUES {', '.join(f"('{lang}', '{repo}', {q(subset) if subset else 'NULL'}, '{to}')" for lang, rows in CORPORA.items() for repo, subset, to in rows)}) AS c(lang, repo, subset, output)""",
        "q_json_lines": "SELECT text FROM documents WHERE text <> ''",
        "q_json_chunks": "SELECT text FROM documents WHERE text <> ''",
        "q_flagship": _yields(),
        "q_quality_optional_it": quality(PROFILES["it"].with_optional_rules()),
        "q_quality_lang_score": f"SELECT doc_id, CASE WHEN reject_reason IS NULL AND (((doc_id % 100) + 100) % 100) / 100.0 < {PROFILES['it'].with_optional_rules().lang_score_threshold} THEN 'lang_score' ELSE reject_reason END AS reject_reason FROM ({quality(PROFILES['it'].with_optional_rules())})",
        "q_subsets": "SELECT DISTINCT 'source=' || coalesce(nullif(source, ''), '__HIVE_DEFAULT_PARTITION__') AS subset FROM documents",
        "q_quality_letters_it": quality(replace(PROFILES["it"], min_specific_ratio=ITALIAN_LETTERS)),
        "q_rejected": f"SELECT doc_id, reject_reason FROM ({quality(PROFILES['it'])}) WHERE reject_reason IS NOT NULL",
        "q_stream_quality": f"SELECT doc_id, text, reject_reason, filtered_text FROM ({quality(PROFILES['it'])}) JOIN documents USING (doc_id)",
        "q_stream_exact_dedup": f"SELECT DISTINCT {doc_id('text', 32)} AS id FROM documents WHERE text IS NOT NULL",
        "q_stream_crawl_counts": "SELECT strftime(to_timestamp(floor(epoch(crawled_at) / 604800) * 604800) AT TIME ZONE 'UTC', '%Y-%m-%d') AS start, source, count(*) AS documents FROM documents GROUP BY ALL",
        "q_append_standard": f"SELECT text, {doc_id('text')} AS id, source FROM documents WHERE text <> '' UNION ALL SELECT text, {doc_id('text')}, 'again' FROM documents WHERE text <> ''",
        "q_file_source": r"SELECT filepath, nullif(regexp_extract(filepath, '(?:^|/)data/[^/]+/[^/]+/([^/]+)/', 1), '') AS folder FROM file_info WHERE regexp_extract(filepath, '(?:^|/)data/[^/]+/[^/]+/([^/]+)/', 1) <> 'misc'",
        "q_source_normalize": "SELECT doc_id, coalesce(nullif(source, ''), 'unknown') AS sources FROM documents",
        "q_convert_standard": f"SELECT text, {doc_id('text')} AS id, 'web' AS source FROM documents WHERE text IS NOT NULL",
        "q_doc_id": f"SELECT doc_id, {doc_id('text')} AS id FROM documents",
        "q_script_ratio": f"SELECT doc_id, {script} FROM documents",
        "q_specific_char_ratio": f"SELECT doc_id, {', '.join(f'round({ratio(found(one, f"[{PROFILES[k].specific}]"), found(one, chr(92) + "p{L}"))}, 6) AS {k}' for k in ('tr', 'it'))} FROM documents",
        "q_remove_citations": f"SELECT doc_id, {', '.join(f'regexp_replace(text, {q(citation(p))}, {q("")}, {q("g")}) AS {k}' for k, p in PROFILES.items())} FROM documents",
        "q_line_explode": f"SELECT doc_id, (i - 1)::INTEGER AS line_no, l[i] AS line, {word_count('l[i]')}::INTEGER AS words FROM (SELECT doc_id, {lines('text')} AS l FROM documents), unnest(range(1, len(l) + 1)) AS u(i)",
        "q_char_dup_ratio": f"SELECT doc_id, round({ratio('c - d', 'c')}, 6) AS dup_ratio FROM (SELECT doc_id, coalesce(list_sum(list_transform(l, lambda x: length(x))), 0) AS c, coalesce(list_sum(list_transform(list_distinct(l), lambda x: length(x))), 0) AS d FROM (SELECT doc_id, {lines(one)} AS l FROM documents))",
        "q_char_repetition": f"SELECT doc_id, len({runs('c')}) > 0 AS repeats FROM (SELECT doc_id, regexp_extract_all({one}, '(?s).') AS c FROM documents)",
        "q_lang_repetition": f"SELECT doc_id, {', '.join(f'regexp_matches({one}, {q(p.laughter)}) AS {k}' for k, p in PROFILES.items())} FROM documents",
        "q_shingles": f"WITH {_shingled()} SELECT doc AS doc_id, count(*) AS shingles, min(s) AS first FROM s GROUP BY doc",
        "q_reject_reason_histogram": _union([f"SELECT '{k}' AS profile, reason, count(*) AS documents FROM (SELECT coalesce(reject_reason, 'kept') AS reason FROM ({quality(p)})) GROUP BY reason" for k, p in PROFILES.items()]),
        "q_line_drop_histogram": _union([f"SELECT '{k}' AS profile, reason, count(*) AS lines FROM ({marked(p)} SELECT coalesce(x.reason, 'kept') AS reason FROM (SELECT unnest(m) AS x FROM cut)) GROUP BY reason" for k, p in PROFILES.items()]),
        "q_quality_lenient_ar": quality(LENIENT_ARABIC),
        "q_quality_by_language": _by_language(),
        "q_hash_sources": f"SELECT id, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources, count(DISTINCT source)::INTEGER AS n_sources FROM (SELECT {doc_id('text')} AS id, source FROM documents WHERE text <> '' AND source <> '') GROUP BY id",
        "q_consensus_hash": f"SELECT id, first(text ORDER BY source, doc_id) AS text, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM (SELECT {doc_id('text')} AS id, text, source, doc_id FROM documents WHERE text <> '' AND source <> '') GROUP BY id HAVING count(DISTINCT source) >= 2",
        "q_consensus_participation": f"SELECT source, count(*) AS documents FROM (SELECT id, source FROM ({CONTENTS}) WHERE id IN (SELECT id FROM ({CONTENTS}) GROUP BY id HAVING count(*) >= 2)) GROUP BY source",
        "q_source_unique_docs": f"SELECT source, count(*) AS documents FROM ({CONTENTS}) GROUP BY source",
        "q_pairwise_overlap": f"""WITH c AS ({CONTENTS}), n AS (SELECT source, count(*) AS n FROM c GROUP BY source),
o AS (SELECT a.source AS source_a, b.source AS source_b, count(*) AS overlap, sum(a.tokens)::BIGINT AS tokens FROM c a JOIN c b ON a.id = b.id AND a.source < b.source GROUP BY ALL)
SELECT a.source AS source_a, b.source AS source_b, coalesce(overlap, 0)::BIGINT AS overlap, coalesce(tokens, 0)::BIGINT AS tokens, round(100.0 * coalesce(overlap, 0) / a.n::DOUBLE, 6) AS pct_of_a, round(100.0 * coalesce(overlap, 0) / b.n::DOUBLE, 6) AS pct_of_b
FROM n a JOIN n b ON a.source < b.source LEFT JOIN o ON o.source_a = a.source AND o.source_b = b.source""",
        "q_overlap_tokens": f"WITH c AS ({CONTENTS}) SELECT a.source AS source_a, b.source AS source_b, sum(a.tokens)::BIGINT AS tokens FROM c a JOIN c b ON a.id = b.id AND a.source < b.source GROUP BY ALL",
        "q_source_intersect": f"WITH c AS ({CONTENTS}) SELECT id FROM c WHERE source = 'hplt2' INTERSECT SELECT id FROM c WHERE source = 'culturax'",
        "q_source_except": f"WITH c AS ({CONTENTS}) SELECT id FROM c WHERE source = 'hplt2' EXCEPT SELECT id FROM c WHERE source = 'culturax'",
        "q_token_count": f"SELECT source, sum(coalesce({word_count('text')}, 0))::BIGINT AS tokens, count(*) AS documents FROM documents GROUP BY source",
        "q_token_totals": f"SELECT sum(coalesce({word_count('text')}, 0))::BIGINT AS tokens, count(*) AS documents FROM documents",
        "q_tokens_by_source": f"SELECT source, sum(tokens)::BIGINT AS tokens, count(*) AS documents FROM (SELECT unnest(s) AS source, tokens FROM ({_LISTS})) GROUP BY source",
        "q_pairwise_tokens": f"SELECT s[i] || '|' || s[j] AS pair, sum(tokens)::BIGINT AS tokens, count(*) AS documents FROM ({_LISTS}), unnest(range(1, len(s) + 1)) AS a(i), unnest(range(1, len(s) + 1)) AS b(j) WHERE i < j GROUP BY ALL",
        "q_tokens_of_single_sources": f"SELECT coalesce(nullif(source, ''), 'unknown') AS source, sum(coalesce({word_count('text')}, 0))::BIGINT AS tokens, count(*) AS documents FROM documents GROUP BY 1",
        "q_stats_log": f"WITH d AS (SELECT lang, source, text, coalesce({word_count('text')}, 0) AS n FROM documents), s AS (SELECT lang, source, sum(n)::BIGINT AS tokens, count(*)::BIGINT AS documents FROM d GROUP BY ALL), t AS (SELECT lang, source, sum(n)::BIGINT AS tokens, count(*)::BIGINT AS documents FROM d WHERE length(text) > 200 GROUP BY ALL) SELECT lang, 'deduped' AS stage, source, tokens, documents FROM s UNION ALL SELECT lang, 'filtered', source, tokens, documents FROM t UNION ALL SELECT lang, 'filtered', source, tokens, documents FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.lang IS NOT DISTINCT FROM s.lang AND t.source IS NOT DISTINCT FROM s.source)",
        "q_stats_summary": f"SELECT lang, 'filtered' AS stage, count(DISTINCT coalesce(source, '')) AS sources, sum(coalesce({word_count('text')}, 0))::BIGINT AS tokens, count(*)::BIGINT AS documents FROM documents GROUP BY lang",
        "q_minhash_signature": f"WITH {_shingled()} SELECT doc AS doc_id, array_to_string(list_transform(g, lambda x: x::VARCHAR), ',') AS signature FROM sig",
        "q_minhash_edges": f"WITH {_EDGES} SELECT least AS a, doc AS b FROM edges",
        "q_components": f"WITH RECURSIVE {_EDGES}, {_LABELS} SELECT v, label FROM labels",
        "q_minhash_dedup": f"WITH RECURSIVE {_EDGES}, {_LABELS} SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT v FROM labels WHERE v <> label)",
        "q_cross_source_edges": f"WITH {_CROSS} SELECT least AS a, doc AS b FROM edges",
        "q_minhash_consensus": f"""WITH RECURSIVE {_CROSS}, {_LABELS}, g AS (SELECT label, list_sort(list(DISTINCT source)) AS s FROM labels JOIN src ON v = doc_id GROUP BY label)
SELECT {doc_id('text')} AS id, text, array_to_string(s, ',') AS sources FROM g JOIN src ON label = doc_id WHERE len(s) >= 2""",
        "q_exact_dedup": f"SELECT {doc_id('text')} AS id, min(doc_id) AS kept, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY 1",
        "q_keep_first_window": f"SELECT doc_id, id FROM (SELECT doc_id, {doc_id('text')} AS id, row_number() OVER (PARTITION BY {doc_id('text')} ORDER BY doc_id) AS n FROM documents WHERE text IS NOT NULL) WHERE n = 1",
        "q_union_null_fill": "SELECT text, NULL::VARCHAR AS id, source FROM documents UNION ALL SELECT text, id, source FROM standard_docs UNION ALL SELECT text, NULL, NULL FROM eval_items",
        "q_sentence_dedup": _sentence_dedup(),
        "q_cumulative_start": "SELECT task_rank, filepath, num_rows, coalesce(sum(num_rows) OVER (PARTITION BY task_rank ORDER BY filepath ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM (SELECT DISTINCT task_rank, filepath, num_rows FROM file_info)",
        "q_address_lookup": """WITH p AS (SELECT task1 AS task, doc1 AS doc FROM dup_pairs UNION SELECT task2, doc2 FROM dup_pairs), f AS (SELECT DISTINCT task_rank, filepath, source, num_rows, cumulative_start FROM file_info WHERE num_rows > 0)
SELECT task, doc, source, filepath, doc - cumulative_start AS "row" FROM p JOIN f ON task = task_rank AND doc >= cumulative_start AND doc < cumulative_start + num_rows""",
        "q_repack_flatten": "SELECT text, id, coalesce(nullif(array_to_string(source, ','), ''), 'consensus') AS source FROM consensus_docs",
        "q_write_standard": f"SELECT text, {doc_id('text')} AS id, source FROM documents WHERE text <> ''",
        "q_consolidate": "SELECT text, id, source FROM standard_docs",
        "q_repack": "SELECT text, id, coalesce(nullif(array_to_string(source, ','), ''), 'consensus') AS source FROM consensus_docs",
        "q_top_sources": "SELECT source, count(*) AS documents FROM documents WHERE source <> '' GROUP BY source ORDER BY documents DESC, source LIMIT 5",
    }
    out["p6_found"], out["p6_records"] = _record_keys(), _records()
    out["q_json_report"] = out["q_token_count"]
    out["q_write_consensus"] = out["q_consensus_hash"].replace(" AS sources ", " AS source ")
    for k, p in PROFILES.items():
        out[f"q_quality_filter_{k}"] = quality(p)
    return out
