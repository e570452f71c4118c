"""SQL of the queries that run raw rows through normalizers, validation, deduplication and scores.

Each piece is a list of common table expressions over the raw tables that says in SQL what the operators should find;
nothing of the engine runs in it. ``seen`` holds one row per raw row and message.
"""

from __future__ import annotations

from loomfold.functions.hashing import BAND_ROWS, BANDS, PRIME, multipliers
from loomfold.functions.jsonx import TYPE_NAMES
from loomfold.functions.text import FOREIGN_MARKERS
from loomfold.operators.audit import LEAKS

_TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_NORMAL = r"lower(trim(regexp_replace(coalesce({}, ''), '\s+', ' ', 'g')))"


def _clean(x: str) -> str:
    """Content without reasoning and marks, capped; null and empty texts stay, others become null if nothing is left."""
    cot = rf"regexp_replace(regexp_replace({x}, '(?is)<think>.*?</think>\s*', '', 'g'), '(?is)<think>.*$', '', 'g')"
    bare = _TRIM.format(cot)
    for marker in FOREIGN_MARKERS:
        bare = f"replace({bare}, '{marker}', '')"
    bare = _TRIM.format(bare)
    capped = f"CASE WHEN length({bare}) > 200000 THEN concat({bare}[:200000], E'\\n…[content truncated]') ELSE {bare} END"
    return f"CASE WHEN {x} = '' THEN '' ELSE nullif({capped}, '') END"


def _name(x: str) -> str:
    bare = rf"regexp_replace(regexp_replace({_TRIM.format(f'coalesce({x}, {chr(39)}{chr(39)})')}, '[^0-9a-zA-Z_]+', '_', 'g'), '^_+|_+$', '', 'g')"
    return f"CASE WHEN {bare} = '' THEN 'unknown_tool' WHEN regexp_matches({bare}, '^[0-9]') THEN concat('fn_', {bare}) ELSE {bare} END"


def _json_string(x: str) -> str:
    return f"coalesce(to_json({x})::VARCHAR, 'null')"


#: Calls of trajectories: (ord, pos, k, name, args), args as compact JSON of an object.
TRAJECTORY = f"""
    turns AS (SELECT row_no AS ord, unnest(range(0, len(trajectory))) AS pos, unnest(trajectory) AS m FROM raw_trajectory),
    seen AS (SELECT ord, pos, CASE m.role WHEN 'function' THEN 'tool' ELSE m.role END AS role, m.content AS raw, coalesce(m.tool_calls, []) AS given FROM turns
        WHERE m.role IN ('system', 'user', 'assistant', 'tool', 'function')),
    flat AS (SELECT ord, pos, unnest(range(0, len(given))) AS k, unnest(given) AS c FROM seen WHERE role <> 'tool'),
    calls AS (SELECT ord, pos, k, {_name("c.function.name")} AS name, CASE WHEN {_TRIM.format("coalesce(c.function.arguments, '')")} = '' THEN '{{}}'
            WHEN json_type(c.function.arguments) = 'OBJECT' THEN json(c.function.arguments)::VARCHAR ELSE concat('{{"value":', {_json_string("c.function.arguments")}, '}}') END AS args
        FROM flat WHERE c.function.name <> ''),
    args AS (SELECT ord, pos, k, name, key_no, key, json_type(json_extract(args, concat('$."', key, '"'))) AS kind
        FROM (SELECT ord, pos, k, name, args, unnest(range(0, len(json_keys(args)))) AS key_no, unnest(json_keys(args)) AS key FROM calls)),
    firsts AS (SELECT ord, name, key, min((pos, k, key_no)) AS place, min_by(CASE kind WHEN 'BOOLEAN' THEN 'boolean' WHEN 'BIGINT' THEN 'integer' WHEN 'UBIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number'
            WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' ELSE 'string' END, (pos, k, key_no)) AS kind FROM args GROUP BY ALL),
    props AS (SELECT ord, name, string_agg(concat(to_json(key)::VARCHAR, ':{{"type":"', kind, '"}}'), ',' ORDER BY place) AS p FROM firsts GROUP BY ALL),
    named AS (SELECT ord, name, min((pos, k)) AS place FROM calls GROUP BY ALL),
    tools AS (SELECT n.ord, concat('[', string_agg(concat('{{"type":"function","function":{{"name":"', n.name, '","description":"","parameters":{{"type":"object","properties":{{', coalesce(p.p, ''), '}}}}}}}}'), ',' ORDER BY n.place), ']') AS tools,
        list(n.name ORDER BY n.place) AS names FROM named n LEFT JOIN props p USING (ord, name) GROUP BY n.ord),
    said AS (SELECT ord, pos, string_agg(concat('{{"function":{{"name":"', name, '","arguments":', args, '}}}}'), ',' ORDER BY k) AS said FROM calls GROUP BY ALL),
    msgs AS (SELECT s.ord, s.pos, s.role, CASE WHEN role = 'tool' THEN NULL ELSE {_clean("raw")} END AS content, CASE WHEN role = 'tool' THEN {_TRIM.format(r"regexp_replace(raw, '^OBSERVATION:\s*', '')")} END AS response, c.said
        FROM seen s LEFT JOIN said c USING (ord, pos)),
    texts AS (SELECT ord, pos, CASE WHEN role = 'tool' THEN concat('{{"role":"tool","content":null,"tool_responses":[{{"name":null,"response":', {_json_string("response")}, '}}]}}')
            ELSE concat('{{"role":"', role, '","content":', {_json_string("content")}, coalesce(',"tool_calls":[' || said || ']', ''), '}}') END AS t FROM msgs),
    records AS (SELECT r.row_no AS ord, concat('[', coalesce((SELECT string_agg(t, ',' ORDER BY pos) FROM texts x WHERE x.ord = r.row_no), ''), ']') AS messages, coalesce(t.tools, '[]') AS tools, coalesce(t.names, []) AS names,
        r.instance_id, r.repo FROM raw_trajectory r LEFT JOIN tools t ON t.ord = r.row_no WHERE r.trajectory IS NOT NULL)"""

NORM_TRAJECTORY = f"""WITH {TRAJECTORY}
    SELECT r.ord, (SELECT count(*) FROM msgs m WHERE m.ord = r.ord)::INT AS n_messages, (SELECT count(*) FROM calls c WHERE c.ord = r.ord)::INT AS n_calls, md5(messages) AS messages, md5(tools) AS tools FROM records r"""


def _literal(x: str) -> str:
    """JSON text of a column that holds JSON or a Python literal of plain values."""
    python = f"""replace(replace(replace(replace({x}, '''', '"'), ': True', ': true'), ': False', ': false'), ': None', ': null')"""
    return f"CASE WHEN json_valid({x}) THEN {x} WHEN json_valid({python}) THEN {python} END"


def _renamed(x: str) -> str:
    """JSON text of a schema with the names of types as JSON schema has them."""
    for given, name in TYPE_NAMES.items():
        if given != name:
            x = f"""regexp_replace({x}, '"type":"{given}(, optional)?"', '"type":"{name}"', 'g')"""
    return x


#: Rows of one query and its calls.
FUNCTIONS = f"""
    given AS (SELECT row_no AS ord, query, {_literal("answers")} AS a, {_literal("tools")} AS t FROM raw_xlam),
    answers AS (SELECT ord, unnest(range(0, len(l))) AS k, unnest(l) AS c FROM (SELECT ord, CASE WHEN json_type(a) = 'ARRAY' THEN json_extract(a, '$[*]') ELSE []::JSON[] END AS l FROM given)),
    calls AS (SELECT ord, 1 AS pos, k, {_name("json_extract_string(c, '$.name')")} AS name, coalesce(CASE json_type(c, '$.arguments') WHEN 'OBJECT' THEN json(json_extract(c, '$.arguments'))::VARCHAR
            WHEN 'ARRAY' THEN concat('{{"_args":', json_extract(c, '$.arguments')::VARCHAR, '}}') END, '{{}}') AS args FROM answers WHERE json_type(c) = 'OBJECT' AND json_extract_string(c, '$.name') <> ''),
    listed AS (SELECT ord, unnest(range(0, len(l))) AS n, unnest(l) AS d FROM (SELECT ord, CASE json_type(t) WHEN 'ARRAY' THEN json_extract(t, '$[*]') WHEN 'OBJECT' THEN [t::JSON] ELSE []::JSON[] END AS l FROM given)),
    bodies AS (SELECT ord, n, CASE WHEN json_type(d, '$.function') = 'OBJECT' THEN json_extract(d, '$.function') ELSE d END AS b FROM listed WHERE json_type(d) = 'OBJECT'),
    defs AS (SELECT ord, n, json_extract_string(b, '$.name') AS raw, {_name("json_extract_string(b, '$.name')")} AS name, coalesce(json_extract_string(b, '$.description'), '') AS description, json_extract(b, '$.parameters') AS p
        FROM bodies WHERE json_extract_string(b, '$.name') <> ''),
    params AS (SELECT ord, n, key_no, key, json_extract(p, concat('$."', key, '"')) AS spec FROM (SELECT ord, n, p, unnest(range(0, len(json_keys(p)))) AS key_no, unnest(json_keys(p)) AS key FROM defs
        WHERE json_type(p) = 'OBJECT' AND json_type(p, '$.properties') IS NULL AND lower(coalesce(json_extract_string(p, '$.type'), '')) NOT IN ('object', 'dict'))),
    flat AS (SELECT ord, n, key_no, key, CASE WHEN json_type(spec) <> 'OBJECT' THEN '{{"type":"string"}}' ELSE concat('{{"type":"', coalesce(json_extract_string(spec, '$.type'), 'string'), '"',
            coalesce(',"description":' || to_json(json_extract_string(spec, '$.description'))::VARCHAR, ''), coalesce(',"enum":' || json_extract(spec, '$.enum')::VARCHAR, ''), coalesce(',"items":' || json_extract(spec, '$.items')::VARCHAR, ''), '}}') END AS s,
            json_type(spec) <> 'OBJECT' OR (coalesce(json_type(spec, '$.default'), 'NULL') <> 'NULL' AND json_extract_string(spec, '$.default') NOT IN ('', 'None') AND NOT contains(lower(coalesce(json_extract_string(spec, '$.type'), '')), 'optional')) AS needed
        FROM params),
    maps AS (SELECT ord, n, concat('{{"type":"object","properties":{{', string_agg(concat(to_json(key)::VARCHAR, ':', s), ',' ORDER BY key_no), '}}',
        coalesce(',"required":[' || string_agg(to_json(key)::VARCHAR, ',' ORDER BY key_no) FILTER (WHERE needed) || ']', ''), '}}') AS schema FROM flat GROUP BY ALL),
    schemas AS (SELECT d.ord, d.n, d.name, d.raw, d.description, CASE WHEN m.schema IS NOT NULL THEN m.schema WHEN json_type(p) = 'OBJECT' THEN concat('{{"type":"object","properties":', coalesce(json_extract(p, '$.properties')::VARCHAR, '{{}}'),
            coalesce(',"required":' || CASE WHEN json_type(p, '$.required') = 'ARRAY' THEN json_extract(p, '$.required')::VARCHAR END, ''), '}}') ELSE '{{"type":"object","properties":{{}}}}' END AS schema FROM defs d LEFT JOIN maps m USING (ord, n)),
    tools AS (SELECT ord, concat('[', string_agg(concat('{{"type":"function","function":{{"name":"', name, '","description":', to_json(description)::VARCHAR, ',"parameters":', {_renamed("schema")}, '}}}}'), ',' ORDER BY n), ']') AS tools,
        list(name ORDER BY n) AS names, list(schema ORDER BY n) AS schemas, bool_or(raw <> name) AS renamed FROM schemas GROUP BY ord),
    said AS (SELECT ord, count(*) AS n, string_agg(concat('{{"function":{{"name":"', name, '","arguments":', args, '}}}}'), ',' ORDER BY k) AS said FROM calls GROUP BY ord),
    clean AS (SELECT ord, {_clean("query")} AS q FROM given),
    msgs AS (SELECT c.ord, r.pos, r.role, CASE WHEN pos = 0 THEN q END AS content, NULL::VARCHAR AS response FROM clean c, (VALUES (0, 'user'), (1, 'assistant')) r(pos, role)),
    records AS (SELECT g.ord, concat('[{{"role":"user","content":', {_json_string("q")}, '}},{{"role":"assistant","content":null', coalesce(',"tool_calls":[' || s.said || ']', ''), '}}]') AS messages,
        coalesce(t.tools, '[]') AS tools, list_distinct_in_order(coalesce(t.names, [])) AS names, coalesce(s.n, 0) AS n_calls, NULL::VARCHAR AS instance_id, NULL::VARCHAR AS repo
        FROM given g JOIN clean USING (ord) LEFT JOIN said s USING (ord) LEFT JOIN tools t USING (ord))"""
FUNCTIONS = FUNCTIONS.replace("list_distinct_in_order(coalesce(t.names, []))", "coalesce(list_filter(t.names, lambda v, i: list_position(t.names, v) = i), [])")

NORM_FUNCTIONS = f"""WITH {FUNCTIONS}
    SELECT ord, n_calls::INT AS n_calls, n_calls > 1 AS parallel, md5(messages) AS messages, md5(tools) AS tools, array_to_string(names, ',') AS names FROM records"""


def _normal_args(x: str) -> str:
    """Arguments with their keys in order, to compare contents."""
    return f"(SELECT coalesce(string_agg(concat(k, '=', json_extract({x}, concat('$.\"', k, '\"'))::VARCHAR), '|' ORDER BY k), '') FROM (SELECT unnest(json_keys({x})) AS k))"


#: What both kinds of rows say and call: (kind, ord, ...).
_BOTH = f"""
    r0 AS (SELECT 0 AS kind, * FROM (WITH {TRAJECTORY} SELECT ord, names, instance_id, repo, NULL::VARCHAR[] AS schemas, NULL::VARCHAR[] AS defined FROM records)
        UNION ALL SELECT 1, * FROM (WITH {FUNCTIONS} SELECT r.ord, r.names, r.instance_id, r.repo, t.schemas, t.names FROM records r LEFT JOIN tools t USING (ord))),
    m0 AS (SELECT 0 AS kind, * FROM (WITH {TRAJECTORY} SELECT ord, pos, role, content, response FROM msgs) UNION ALL SELECT 1, * FROM (WITH {FUNCTIONS} SELECT ord, pos, role, content, response FROM msgs)),
    c0 AS (SELECT 0 AS kind, * FROM (WITH {TRAJECTORY} SELECT ord, pos, k, name, args FROM calls) UNION ALL SELECT 1, * FROM (WITH {FUNCTIONS} SELECT ord, pos, k, name, args FROM calls)),
    r AS MATERIALIZED (SELECT * REPLACE (ord + kind * 1099511627776 AS ord) FROM r0), m AS MATERIALIZED (SELECT * REPLACE (ord + kind * 1099511627776 AS ord) FROM m0),
    c AS MATERIALIZED (SELECT * REPLACE (ord + kind * 1099511627776 AS ord) FROM c0)"""

#: First reason for which a record isn't well-formed.
_REASONS = r"""
    undeclared AS (SELECT c.ord, min_by(c.name, (c.pos, c.k)) AS name FROM c JOIN r USING (ord) WHERE len(r.names) > 0 AND NOT list_contains(r.names, c.name) GROUP BY c.ord),
    about AS (SELECT r.ord, r.kind, count(m.ord) AS n_turns, count(*) FILTER (WHERE m.role = 'assistant') AS n_assistant, count(*) FILTER (WHERE m.role = 'tool') AS n_tool,
        coalesce(sum(length(m.content)), 0) AS chars, coalesce(bool_or(m.role = 'assistant' AND regexp_matches(m.content, '\S')), false) AS said, any_value(r.names) AS names
        FROM r LEFT JOIN m USING (ord) GROUP BY r.ord, r.kind),
    n_calls AS (SELECT ord, count(*) AS n FROM c GROUP BY ord),
    reasons AS (SELECT a.*, coalesce(n.n, 0) AS n, CASE WHEN n_turns = 0 THEN 'empty_messages' WHEN n_assistant = 0 THEN 'no_assistant_turn' WHEN u.name IS NOT NULL THEN concat('undeclared_tool:', u.name)
        WHEN n.n IS NULL AND NOT said THEN 'empty_assistant' END AS reason FROM about a LEFT JOIN n_calls n USING (ord) LEFT JOIN undeclared u USING (ord))"""

_INST = _TRIM.format("coalesce(instance_id, '')")
_GROUP = rf"""CASE WHEN regexp_matches(split_part({_INST}, '.', 1), '(?s)^.+?-[0-9]+$') THEN concat('swe::', lower(split_part({_INST}, '.', 1)))
    WHEN {_INST} <> '' THEN concat('swe::', lower(regexp_replace({_INST}, '(?i)_run[0-9]+$', ''))) WHEN repo <> '' THEN concat('swe::repo::', lower(repo)) END"""
_MINIMA = ", ".join(f"min((h * {a} + {b}) % {PRIME}) AS m{i}" for i, (a, b) in enumerate(multipliers()))
_KEYS = ", ".join("md5(concat_ws(',', " + ", ".join(f"m{b * BAND_ROWS + i}" for i in range(BAND_ROWS)) + "))" for b in range(BANDS))

#: Tokens of the well-formed records, and the outcome of one ordered pass: rounds that keep what is first everywhere.
_GREEDY = f"""
    v AS (SELECT r.* FROM r JOIN reasons q USING (ord) WHERE q.reason IS NULL),
    said0 AS (SELECT ord, pos, string_agg(concat(name, {_normal_args("args")}), '' ORDER BY k) AS hashed, string_agg(concat(name, ' ', {_NORMAL.format("args")}), ' ' ORDER BY k) AS spoken FROM c GROUP BY ALL),
    whole AS (SELECT m.ord, string_agg(concat(role, {_NORMAL.format("content")}, s.hashed, {_NORMAL.format("response")}), '' ORDER BY m.pos) AS content,
        string_agg(concat_ws(' ', {_NORMAL.format("content")}, s.spoken), ' ' ORDER BY m.pos) FILTER (WHERE role = 'assistant') AS spoken FROM m LEFT JOIN said0 s USING (ord, pos) GROUP BY m.ord),
    texts AS (SELECT v.ord, concat(w.content, array_to_string(list_sort(v.names), '')) AS content, list_filter(string_split(concat_ws(' ', w.spoken, array_to_string(list_sort(v.names), ' ')), ' '), lambda x: x <> '') AS w,
        {_GROUP} AS group_key FROM v JOIN whole w USING (ord)),
    shingled AS (SELECT ord, unnest(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(0, len(w) - 4), lambda i: array_to_string(w[i + 1 : i + 5], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END) AS s FROM texts),
    signed AS (SELECT ord, {_MINIMA} FROM (SELECT ord, (('0x' || substring(md5(s), 1, 8))::BIGINT % {PRIME})::BIGINT AS h FROM shingled) GROUP BY ord),
    banded AS (SELECT ord, unnest(range(0, {BANDS})) AS band, unnest([{_KEYS}]) AS key FROM signed),
    tok AS MATERIALIZED (SELECT ord, 0 AS layer, concat('e', md5(content)) AS token FROM texts UNION SELECT ord, 1, concat('s', group_key) FROM texts WHERE group_key IS NOT NULL UNION SELECT ord, 2, concat('b', band, key) FROM banded),
    st(step, ord, state) AS (SELECT 0, ord, 'o' FROM (SELECT DISTINCT ord FROM tok)
        UNION ALL (WITH cur AS (SELECT step, ord, state FROM st), op AS (SELECT ord FROM cur WHERE state = 'o'), firsts AS (SELECT token, min(ord) AS f FROM tok JOIN op USING (ord) GROUP BY token),
            kept AS (SELECT t.ord FROM tok t JOIN op USING (ord) JOIN firsts USING (token) GROUP BY t.ord HAVING bool_and(f = t.ord)),
            gone AS (SELECT DISTINCT t.ord FROM tok t JOIN op USING (ord) WHERE t.token IN (SELECT token FROM tok JOIN kept USING (ord)))
        SELECT step + 1, ord, CASE WHEN state <> 'o' THEN state WHEN ord IN (SELECT ord FROM kept) THEN 'k' WHEN ord IN (SELECT ord FROM gone) THEN 'd' ELSE 'o' END FROM cur WHERE (SELECT count(*) FROM op) > 0)),
    outcome AS (SELECT ord, state FROM st WHERE step = (SELECT max(step) FROM st)),
    holders AS (SELECT token, min(ord) AS holder FROM tok JOIN outcome USING (ord) WHERE state = 'k' GROUP BY token),
    dropped AS (SELECT t.ord, ['exact', 'swe_group', 'near'][min(layer) + 1] AS dup_reason FROM tok t JOIN holders USING (token) WHERE holder < t.ord GROUP BY t.ord)"""

#: Scores of records, with the calls whose arguments fit the last definition of their tool.
_SCORED = """
    schema_of AS (SELECT c.ord, c.pos, c.k, c.args, r.kind, r.schemas[len(r.defined) + 1 - list_position(list_reverse(r.defined), c.name)] AS schema FROM c JOIN r USING (ord)),
    fits AS (SELECT ord, count(*) FILTER (WHERE kind = 0 OR (schema IS NOT NULL AND len(list_filter(coalesce(json_extract_string(schema, '$.required[*]'), []), lambda x: NOT list_contains(json_keys(args), x))) = 0
        AND (len(coalesce(json_keys(schema, '$.properties'), [])) = 0 OR len(list_filter(json_keys(args), lambda x: NOT list_contains(json_keys(schema, '$.properties'), x))) = 0))) AS valid FROM schema_of GROUP BY ord),
    scores AS (SELECT a.ord, greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.5::DOUBLE + CASE WHEN n > 0 AND n_tool > 0 THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN n_assistant > 1 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END
        + CASE WHEN n > 0 THEN 0.15::DOUBLE * (valid / n) - 0.10::DOUBLE * (1.0::DOUBLE - valid / n) ELSE 0.0::DOUBLE END + CASE WHEN len(names) > 0 AND n > 0 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END
        + CASE WHEN chars < 40 AND n = 0 THEN -0.20::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN n_turns < 2 THEN -0.10::DOUBLE ELSE 0.0::DOUBLE END)) AS score FROM reasons a LEFT JOIN fits USING (ord))"""

#: The same pass over all records, well-formed or not.
GREEDY = f"""WITH RECURSIVE {_BOTH}, {_GREEDY.replace("r JOIN reasons q USING (ord) WHERE q.reason IS NULL", "r")}
    SELECT r.ord, CASE r.kind WHEN 0 THEN 'trajectory' ELSE 'xlam' END AS source, d.dup_reason FROM r LEFT JOIN dropped d USING (ord)"""

#: The verdicts of a whole run on both tables.
VERDICTS = f"""WITH RECURSIVE {_BOTH}, {_REASONS}, {_GREEDY}, {_SCORED}
    SELECT q.ord, q.reason, d.dup_reason, round(s.score, 6) AS score, CASE WHEN s.score >= 0.75::DOUBLE THEN 'high' WHEN s.score >= 0.5::DOUBLE THEN 'medium' ELSE 'low' END AS tier
    FROM reasons q JOIN scores s USING (ord) LEFT JOIN dropped d USING (ord)"""


_LEAKS = ", ".join(f"'{x}'" for x in LEAKS)
#: Defects of rows on disk by occurrence and by row: (rec_no, source, defect, times). Parts of another type than they should have count as missing.
_DEFECTS = rf"""
    d0 AS (SELECT rec_no, coalesce(source, '?') AS source, length(messages) AS size, coalesce(tool_names, []) AS names, json_valid(messages) AS ok, coalesce(messages, '') AS messages,
        CASE WHEN {_TRIM.format("coalesce(tools, '')")} = '' THEN '[]' ELSE tools END AS tools FROM records),
    d1 AS (SELECT *, CASE WHEN ok THEN CASE json_type(messages) WHEN 'ARRAY' THEN json_extract(messages, '$[*]') WHEN 'OBJECT' THEN [messages::JSON] ELSE []::JSON[] END END AS msgs,
        CASE WHEN json_valid(tools) THEN CASE json_type(tools) WHEN 'ARRAY' THEN json_extract(tools, '$[*]') WHEN 'OBJECT' THEN [tools::JSON] ELSE []::JSON[] END END AS defs FROM d0),
    x AS (SELECT rec_no, unnest(range(0, len(msgs))) AS pos, unnest(msgs) AS e FROM d1),
    msg AS (SELECT rec_no, pos, e, json_extract_string(e, '$.role') AS role, CASE json_type(e, '$.content') WHEN 'VARCHAR' THEN json_extract_string(e, '$.content') WHEN 'NULL' THEN NULL ELSE json_extract(e, '$.content')::VARCHAR END AS content FROM x),
    cal AS (SELECT rec_no, json_extract(c, '$.function') AS f FROM (SELECT rec_no, unnest(CASE WHEN json_type(e, '$.tool_calls') = 'ARRAY' THEN json_extract(e, '$.tool_calls[*]') ELSE []::JSON[] END) AS c FROM msg)),
    ans AS (SELECT rec_no, CASE json_type(a, '$.response') WHEN 'VARCHAR' THEN json_extract_string(a, '$.response') ELSE json_extract(a, '$.response')::VARCHAR END AS response FROM
        (SELECT rec_no, unnest(CASE WHEN json_type(e, '$.tool_responses') = 'ARRAY' THEN json_extract(e, '$.tool_responses[*]') ELSE []::JSON[] END) AS a FROM msg)),
    def AS (SELECT rec_no, json_extract_string(t, '$.function.name') AS name, CASE WHEN json_type(t, '$.function.parameters') = 'VARCHAR' THEN CASE WHEN json_valid(json_extract_string(t, '$.function.parameters')) THEN json_extract_string(t, '$.function.parameters')::JSON END
        ELSE json_extract(t, '$.function.parameters') END AS p FROM (SELECT rec_no, unnest(defs) AS t FROM d1 WHERE msgs IS NOT NULL)),
    keyed AS (SELECT *, CASE WHEN json_type(p) = 'OBJECT' THEN json_keys(p) ELSE [] END AS keys, CASE WHEN json_type(p, '$.properties') = 'OBJECT' THEN json_keys(p, '$.properties') ELSE [] END AS properties FROM def),
    sums AS (SELECT d.rec_no, d.source, d.names, (SELECT count(*) FROM cal c WHERE c.rec_no = d.rec_no) AS n_calls, (SELECT count(*) FROM ans a WHERE a.rec_no = d.rec_no) AS n_answers FROM d1 d WHERE msgs IS NOT NULL),
    found AS (
        SELECT rec_no, 'oversized_row_gt_1MB' AS defect FROM d1 WHERE size > 1000000
        UNION ALL SELECT rec_no, 'messages_parse_error' FROM d1 WHERE msgs IS NULL
        UNION ALL SELECT rec_no, 'tools_parse_error' FROM d1 WHERE msgs IS NOT NULL AND defs IS NULL
        UNION ALL SELECT rec_no, 'tool_missing_name' FROM keyed WHERE coalesce(name, '') = ''
        UNION ALL SELECT rec_no, 'tool_params_not_jsonschema' FROM keyed WHERE len(keys) > 0 AND NOT (list_contains(keys, 'type') AND list_contains(keys, 'properties'))
        UNION ALL SELECT rec_no, 'schema_keys_leaked_as_args' FROM keyed WHERE list_contains(properties, 'type') AND list_contains(properties, 'properties') AND list_contains(properties, 'required')
        UNION ALL SELECT DISTINCT rec_no, 'invalid_role' FROM msg WHERE NOT coalesce(role IN ('system', 'user', 'assistant', 'tool'), false)
        UNION ALL SELECT rec_no, 'no_assistant_turn' FROM d1 WHERE msgs IS NOT NULL AND rec_no NOT IN (SELECT rec_no FROM msg WHERE role = 'assistant')
        UNION ALL SELECT rec_no, 'cot_leak' FROM msg WHERE contains(content, '<think>')
        UNION ALL SELECT rec_no, 'foreign_marker_leak' FROM msg WHERE len(list_filter([{_LEAKS}], lambda v: contains(content, v))) > 0
        UNION ALL SELECT rec_no, 'role_label_leak' FROM msg WHERE regexp_matches(lower(content), '^\s*assistant[\n ]')
        UNION ALL SELECT rec_no, 'raw_function_xml' FROM msg WHERE role = 'assistant' AND contains(content, '<function=')
        UNION ALL SELECT rec_no, 'args_not_object' FROM cal WHERE NOT coalesce(regexp_matches({_TRIM.format("CASE json_type(f, '$.arguments') WHEN 'VARCHAR' THEN json_extract_string(f, '$.arguments') ELSE json_extract(f, '$.arguments')::VARCHAR END")}, '^[\[{{]'), false)
        UNION ALL SELECT c.rec_no, 'undeclared_tool_call' FROM cal c JOIN sums s USING (rec_no) WHERE len(s.names) > 0 AND NOT coalesce(list_contains(s.names, json_extract_string(c.f, '$.name')), false)
        UNION ALL SELECT rec_no, 'observation_prefix_leak' FROM ans WHERE response LIKE 'OBSERVATION:%'
        UNION ALL SELECT rec_no, 'call_response_imbalance_gt1' FROM sums WHERE n_calls > 0 AND n_answers > 0 AND n_calls - n_answers > 1),
    counted AS (SELECT d.source, f.defect, f.rec_no, count(*) AS times FROM found f JOIN d0 d USING (rec_no) GROUP BY ALL)"""

AUDIT = f"""WITH {_DEFECTS}
    SELECT defect, sum(times)::BIGINT AS occurrences, count(*) AS rows, round(100.0::DOUBLE * sum(times)::DOUBLE / (SELECT count(*) FROM records), 3) AS pct_occurrences, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM records), 3) AS pct_rows
    FROM counted GROUP BY defect"""

WORST = f"""WITH {_DEFECTS},
    per AS (SELECT source, defect, sum(times)::BIGINT AS occurrences FROM counted GROUP BY ALL), top AS (SELECT source, sum(occurrences)::BIGINT AS total FROM per GROUP BY source ORDER BY total DESC, source LIMIT 6),
    placed AS (SELECT p.source, t.total, p.defect, p.occurrences, row_number() OVER (PARTITION BY p.source ORDER BY p.occurrences DESC, p.defect)::INT AS place FROM per p JOIN top t USING (source))
    SELECT * FROM placed WHERE place <= 3"""


#: Counts of a run over both tables.
REPORT = f"""WITH RECURSIVE {_BOTH}, {_REASONS}, {_GREEDY}, {_SCORED},
    v AS (SELECT q.ord, q.reason, d.dup_reason, CASE WHEN s.score >= 0.75::DOUBLE THEN 'high' WHEN s.score >= 0.5::DOUBLE THEN 'medium' ELSE 'low' END AS tier FROM reasons q JOIN scores s USING (ord) LEFT JOIN dropped d USING (ord))
    SELECT 'seen' AS metric, count(*) AS n FROM v WHERE reason IS NULL UNION ALL SELECT 'kept', count(*) FROM v WHERE reason IS NULL AND dup_reason IS NULL
    UNION ALL SELECT k, count(v.ord) FROM (VALUES ('exact'), ('swe_group'), ('near')) t(k) LEFT JOIN v ON v.dup_reason = k GROUP BY k
    UNION ALL SELECT concat('filtered ', reason), count(*) FROM v WHERE reason IS NOT NULL GROUP BY reason UNION ALL SELECT concat('quality ', tier), count(*) FROM v WHERE reason IS NULL AND dup_reason IS NULL GROUP BY tier""".replace("v AS (SELECT r.* FROM r", "w0 AS (SELECT r.* FROM r").replace("FROM v JOIN whole w", "FROM w0 v JOIN whole w")

#: Calls against a reference set of the earlier half of the time: the content decides, then the first of equal contents.
AGAINST = f"""WITH {FUNCTIONS},
    r AS (SELECT r.*, x.loaded_at FROM records r JOIN raw_xlam x ON x.row_no = r.ord), cut AS (SELECT (min(epoch_us(loaded_at)) + max(epoch_us(loaded_at))) // 2 AS at FROM raw_xlam),
    said0 AS (SELECT ord, pos, string_agg(concat(name, {_normal_args("args")}), '' ORDER BY k) AS hashed FROM calls GROUP BY ALL),
    whole AS (SELECT m.ord, string_agg(concat(role, {_NORMAL.format("content")}, s.hashed), '' ORDER BY m.pos) AS content FROM msgs m LEFT JOIN said0 s USING (ord, pos) GROUP BY m.ord),
    t AS (SELECT r.ord, epoch_us(r.loaded_at) < cut.at AS early, concat(w.content, array_to_string(list_sort(r.names), '')) AS content FROM r JOIN whole w USING (ord), cut),
    known AS (SELECT DISTINCT content FROM t WHERE early)
    SELECT ord, CASE WHEN content IN (SELECT content FROM known) OR row_number() OVER (PARTITION BY content ORDER BY ord) > 1 THEN 'exact' END AS dup_reason FROM t WHERE NOT early"""
