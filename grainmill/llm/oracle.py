"""Exact statements of some results as SQL for another engine, over whole tables."""

from __future__ import annotations

from .leaks import FOUND_SHARE as LEAKED
from .leaks import SPAN
from .near import LEAST
from .near import RUN as NEAR_RUN
from .repetition import FOUND_SHARE, RUN


def letters(s: str) -> str:
    """Letters, marks and digits of a text, folded."""
    low = f"replace(replace(lower(replace(nfc_normalize({s}), 'İ', 'i')), 'ı', 'i'), 'i' || chr(775), 'i')"
    return rf"regexp_replace({low}, '[^\p{{L}}\p{{M}}\p{{Nd}}]', '', 'g')"


def _grams(name: str, key: str, text: str, table: str, n: int) -> str:
    """CTEs ``{name}(key, t)`` and ``{name}_grams(key, p, g)``: every run of n letters by place."""
    return f"""{name} AS (SELECT DISTINCT {key} AS key, {letters(text)} AS t FROM {table} WHERE {text} <> ''),
{name}_grams AS (SELECT key, p, substr(t, p, {n}) AS g FROM {name}, unnest(range(1, greatest(length(t) - {n - 2}, 1))) AS u(p) WHERE length(t) >= {n})"""


_GROUPS = """f AS (SELECT DISTINCT task_rank, filepath, num_rows, cumulative_start FROM file_info),
addr AS (SELECT task_rank AS task, cumulative_start + row_in_file AS doc, rec_id FROM standard_docs JOIN f USING (filepath) WHERE row_in_file < num_rows),
e AS (SELECT DISTINCT a.rec_id AS x, b.rec_id AS y FROM dup_pairs p JOIN addr a ON a.task = p.task1 AND a.doc = p.doc1 JOIN addr b ON b.task = p.task2 AND b.doc = p.doc2 WHERE a.rec_id <> b.rec_id),
w AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
walk AS (SELECT x AS v, x AS r FROM w UNION SELECT w.y, walk.r FROM walk JOIN w ON w.x = walk.v WHERE walk.r < w.y),
g AS (SELECT v AS rec_id, min(r) AS group_rec_id FROM walk GROUP BY v)"""
_SHARES = f"""{_grams('r', 'rec_id', 'text', 'standard_docs', RUN)},
again AS (SELECT key, p FROM (SELECT key, p, row_number() OVER (PARTITION BY key, g ORDER BY p) AS n FROM r_grams) WHERE n > 1),
covered AS (SELECT key, count(DISTINCT p + i) AS n FROM again, range({RUN}) AS o(i) GROUP BY key)"""


#: By notation what separates a name from its value; the first notation that fits all units of a record is its own.
_SHAPES = {
    "bar": r"\|\s*([^|]*?)\s*\|\s*([^|]*?)\s*\|?",
    "tab": r"([^\t]*?)[ ]*\t\s*(.*)",
    "equal": r"([^=]*?)\s*=\s*(.*)",
    "colon": r"([^:]*?)\s*:\s*(.*)",
}
_BLANKS = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_FLAT = r"[\x{0B}-\x{0C}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _pairs_of(units: str) -> str:
    """The (name, value) pairs of a list of units in the first notation that fits all of them, else null."""
    fits = lambda p: f"len({units}) > 1 AND len(list_filter({units}, lambda u: NOT regexp_full_match(u, '{p}') OR regexp_full_match(regexp_extract(u, '^{p}$', 1), '{_BLANKS}*'))) = 0"
    made = lambda p: f"list_transform({units}, lambda u: struct_pack(n := regexp_extract(u, '^{p}$', 1), v := regexp_extract(u, '^{p}$', 2)))"
    return "CASE " + " ".join(f"WHEN {fits(p)} THEN {made(p)}" for p in (f"(?s:{x})" for x in _SHAPES.values())) + " END"


def _same_records() -> str:
    """CTEs up to ``same(rec_id, lk, label)``: the smallest id of the set of every record with letters."""
    trim = lambda s: f"regexp_replace({s}, '^{_BLANKS}+|{_BLANKS}+$', '', 'g')"
    return f"""base AS (SELECT rec_id, {letters("coalesce(text, '')")} AS lk, {trim("replace(text, chr(65279), '')")} AS t FROM standard_docs WHERE text <> ''),
solid AS (SELECT * FROM base WHERE lk <> ''),
objects AS (SELECT rec_id, regexp_replace(t, '{_BLANKS}+', ' ', 'g') AS o FROM solid WHERE length(t) > 4 AND t[1] = '{{' AND right(t, 1) = '}}'),
object_pairs AS (SELECT rec_id, list_transform(json_keys(o), lambda k: struct_pack(n := k, v := coalesce(map_extract(CAST(o::JSON AS MAP(VARCHAR, JSON)), k)[1] ->> '$', 'null'))) AS f FROM objects WHERE json_valid(o)),
plain AS (SELECT rec_id, regexp_replace(replace(t, chr(13), chr(10)), '{_FLAT}', ' ', 'g') AS t FROM solid WHERE length(t) > 4 AND NOT (t[1] = '{{' AND right(t, 1) = '}}') AND (contains(t, chr(9)) OR contains(t, ':') OR contains(t, '=') OR t[1] = '|')),
units AS (SELECT rec_id, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x, ' ')), lambda x: {trim('x')} <> '') AS l,
  list_filter(list_transform(string_split(replace(t, chr(10), ' '), ';'), lambda x: {trim('x')}), lambda x: x <> '') AS s FROM plain),
read AS (SELECT rec_id, coalesce({_pairs_of('l')}, {_pairs_of('s')}) AS f FROM units UNION ALL SELECT rec_id, f FROM object_pairs WHERE len(f) > 1),
fielded AS (SELECT rec_id, unnest(f) AS p FROM read WHERE f IS NOT NULL),
folded AS (SELECT DISTINCT rec_id, {letters('p.n')} AS n, {letters('p.v')} AS v FROM fielded),
keyed AS (SELECT rec_id, string_agg(n || chr(31) || v, chr(30) ORDER BY n, v) AS fk FROM folded GROUP BY rec_id HAVING max(n) <> ''),
one AS (SELECT lk, min(rec_id) AS label FROM solid GROUP BY lk),
links AS (SELECT DISTINCT lk, fk FROM solid JOIN keyed USING (rec_id)),
two AS (SELECT fk, min(label) AS label FROM links JOIN one USING (lk) GROUP BY fk),
three AS (SELECT lk, min(label) AS label FROM links JOIN two USING (fk) GROUP BY lk),
four AS (SELECT fk, min(label) AS label FROM links JOIN three USING (lk) GROUP BY fk),
five AS (SELECT lk, min(label) AS label FROM links JOIN four USING (fk) GROUP BY lk),
same AS (SELECT rec_id, lk, coalesce(five.label, one.label) AS label FROM solid JOIN one USING (lk) LEFT JOIN five USING (lk))"""


def _similar() -> str:
    """CTEs up to ``alike(a, b)``: records that share enough of their distinct runs."""
    return f"""runs AS (SELECT DISTINCT rec_id, hash(substr(lk, p, {NEAR_RUN})) AS g FROM solid, unnest(range(1, greatest(length(lk) - {NEAR_RUN - 2}, 1))) AS u(p) WHERE length(lk) >= {NEAR_RUN}),
sizes AS (SELECT rec_id, count(*) AS n FROM runs GROUP BY rec_id),
common AS (SELECT x.rec_id AS a, y.rec_id AS b, count(*) AS n FROM runs x JOIN runs y ON x.g = y.g AND x.rec_id < y.rec_id GROUP BY ALL),
alike AS (SELECT a, b FROM common JOIN sizes s ON s.rec_id = a JOIN sizes t ON t.rec_id = b WHERE common.n >= {LEAST} * (s.n + t.n - common.n))"""


def sql() -> dict[str, str]:
    return {
        "p2_found": f"WITH {_same_records()} SELECT label AS keep_rec_id, rec_id FROM same WHERE label <> rec_id",
        "p2_copies": f"WITH {_same_records()} SELECT label AS keep_rec_id, count(*) AS copies FROM same GROUP BY label",
        "p7_found": f"WITH {_same_records()}, {_similar()} SELECT a AS rec_id_a, b AS rec_id_b FROM alike JOIN same x ON x.rec_id = a JOIN same y ON y.rec_id = b WHERE x.label <> y.label",
        "p7_pairs": f"""WITH {_same_records()}, heads AS (SELECT lk, min(rec_id) AS head FROM solid GROUP BY lk), {_similar()}
SELECT a AS rec_id_a, b AS rec_id_b FROM alike JOIN same x ON x.rec_id = a JOIN same y ON y.rec_id = b WHERE x.label <> y.label AND a IN (SELECT head FROM heads) AND b IN (SELECT head FROM heads)""",
        "p7_members": f"""WITH {_same_records()}, heads AS (SELECT lk, min(rec_id) AS head FROM solid GROUP BY lk), {_similar()},
partners AS (SELECT h, count(*) AS n FROM (SELECT a AS h, b AS o FROM alike UNION ALL SELECT b, a FROM alike) WHERE h IN (SELECT head FROM heads) AND o IN (SELECT head FROM heads) GROUP BY h)
SELECT rec_id, head AS class_id, coalesce(partners.n, 0)::BIGINT AS links FROM solid JOIN heads USING (lk) LEFT JOIN partners ON h = head""",
        "p3_found": f"WITH {_SHARES} SELECT key AS rec_id FROM covered JOIN r USING (key) WHERE n >= {FOUND_SHARE} * length(t)",
        "p3_shares": f"WITH {_SHARES} SELECT d.rec_id, round(coalesce(n, 0) / greatest(length(coalesce(t, '')), 1), 6) AS repeated_share FROM standard_docs d LEFT JOIN r ON r.key = d.rec_id LEFT JOIN covered ON covered.key = d.rec_id",
        "p4_found": f"WITH RECURSIVE {_GROUPS} SELECT rec_id, group_rec_id FROM g",
        "p4_group_sources": f"""WITH RECURSIVE {_GROUPS}, s AS (SELECT group_rec_id, rec_id, nullif(lower(trim(source)), '') AS source FROM g JOIN standard_docs USING (rec_id))
SELECT group_rec_id, count(DISTINCT rec_id)::BIGINT AS records, coalesce(array_to_string(list_sort(list(DISTINCT source) FILTER (source IS NOT NULL)), ','), '') AS source FROM s GROUP BY group_rec_id""",
        "p8_round_trip": "SELECT doc_id, true AS same FROM documents",
        "p9_found": f"""WITH {_grams('d', 'doc_id', 'text', 'documents', SPAN)},
{_grams('i', 'item_id', 'text', 'eval_items', SPAN)},
met AS (SELECT DISTINCT d_grams.key AS doc_id, i_grams.key AS item_id, i_grams.p FROM d_grams JOIN i_grams USING (g)),
covered AS (SELECT doc_id, item_id, count(DISTINCT p + k) AS n FROM met, range({SPAN}) AS o(k) GROUP BY ALL)
SELECT doc_id, item_id FROM covered JOIN i ON i.key = item_id WHERE n >= {LEAKED} * length(t)""",
    }
