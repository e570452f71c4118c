"""Queries of the training-data operators; each takes (spark, folder of the tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomfold.llm import answers, fusion, leakage, mixing, nearjoin, splitting, truncation
from loomfold.llm.chunkdedup import History


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with at least one text that was cut off."""
    return truncation.truncated_records(_table(spark, sf_dir, "records")).select(F.col("key").alias("rec_no"))


def p2_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate of truncation per source."""
    return truncation.rates(_table(spark, sf_dir, "records"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User messages whose answer is empty, cut off, a refusal, the question again or in another language."""
    return answers.defective_pairs(_table(spark, sf_dir, "records")).select(F.col("key").alias("rec_no"), "msg_no", "defect")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records whose likeness by runs of three words is at least 0.7."""
    return nearjoin.near_pairs(_table(spark, sf_dir, "records"), tenths=7, size=3)


def p4_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record with the smallest rec_no of the records that have the same runs: copies without their pairs."""
    members, _ = nearjoin.near_classes(_table(spark, sf_dir, "records"), tenths=7, size=3)
    return members.select(F.col("key").alias("rec_no"), "rep")


def p4_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicates between classes of equal records, by their representatives, with common runs and runs in either."""
    _, links = nearjoin.near_classes(_table(spark, sf_dir, "records"), tenths=7, size=3)
    return links.select(F.least("a", "b").alias("rec_a"), F.greatest("a", "b").alias("rec_b"), "common", "either")


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate records: each record with the smallest rec_no that it is linked to, over any steps."""
    members, links = nearjoin.near_classes(_table(spark, sf_dir, "records"), tenths=7, size=3)
    return nearjoin.components(members, links).select(F.col("key").alias("rec_no"), "group_no")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of incoming that repeat accepted content: all of records, or earlier accepted rows of incoming."""
    records, incoming = _table(spark, sf_dir, "records"), _table(spark, sf_dir, "incoming")
    history = History(spark, size=3, tenths=7).start(records)
    return history.admit(incoming, append=False).select(F.col("key").alias("rec_no"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that each field of the surviving record of a group is taken from."""
    fused = fusion.fuse(_table(spark, sf_dir, "records"), _table(spark, sf_dir, "sources"), exact=True)
    return fused.select("group_no", "field_name", "rec_no")


def p6_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many fields the votes decide, the prior against them, or the check against both."""
    return fusion.decisions(fusion.fuse(_table(spark, sf_dir, "records"), _table(spark, sf_dir, "sources"), exact=True))


def p6_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One surviving record per group, built field by field."""
    return fusion.survivors(fusion.fuse(_table(spark, sf_dir, "records"), _table(spark, sf_dir, "sources"), exact=True))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least 12 consecutive words of an evaluation item."""
    found = leakage.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "eval_items"), least=12)
    return found.select("doc_id", "item_id")


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each leaked item the number of documents that hold a passage of it and the longest passage."""
    return leakage.report(leakage.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "eval_items"), least=12))


def p7_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents left after those with leaked passages are removed."""
    documents = _table(spark, sf_dir, "documents")
    found = leakage.leaks(documents, _table(spark, sf_dir, "eval_items"), least=12)
    return leakage.without_leaks(documents, found).select("doc_id", "source", "doc_kind")


def p8_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drawn documents with their repeats."""
    return mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actual share of each source against its target."""
    return mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))[1]


def p8_budget_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws of three tenths of all tokens: the exponent is bisected to the repetition limits."""
    return mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"), share=0.3)[0]


def p8_budget_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares of that mix: target, planned with the bisected exponent, and actual."""
    return mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"), share=0.3)[1]


def p8_entropy_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares of a mix whose weights are the natural shares, exponentiated to an entropy of 3 nats."""
    return mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"), target_entropy=3.0)[1]


def p9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered pieces of documents with more tokens than their kind may have."""
    return splitting.split(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "split_limits"))


QUERIES = {"p8_draws": p8_draws, "p8_shares": p8_shares, "p8_budget_draws": p8_budget_draws, "p8_budget_shares": p8_budget_shares, "p8_entropy_shares": p8_entropy_shares, "p9_pieces": p9_pieces, "p3_found": p3_found, "p2_found": p2_found, "p2_rates": p2_rates, "p7_found": p7_found, "p7_report": p7_report, "p7_clean": p7_clean, "p6_found": p6_found, "p6_survivors": p6_survivors, "p6_decisions": p6_decisions, "p5_found": p5_found, "p4_found": p4_found, "p4_groups": p4_groups, "p4_members": p4_members, "p4_links": p4_links}
SQL: dict[str, str] = {}


#: Pieces of SQL that several queries share: columns with JSON text inside JSON opened, and the usable values of a field.
_OPEN = "CASE json_type({0}) WHEN 'VARCHAR' THEN json_extract_string({0}, '$') ELSE {0} END"
_NO_VALUE = ", ".join(f"'{w}'" for w in sorted(fusion.NO_VALUE))

SQL["p6_found"] = f"""
    WITH r AS (SELECT rec_no, right(lower(regexp_replace(id, '^\\s+|\\s+$', '', 'g')), 16) AS g, source, {_OPEN.format("metadata")} AS m, {_OPEN.format("quality")} AS q FROM records),
    k AS (SELECT g, min(rec_no) AS group_no FROM r WHERE g <> '' GROUP BY g HAVING count(*) > 1),
    v AS (SELECT k.group_no, r.rec_no, r.source, r.m, r.q, coalesce(a.trust, b.trust, 0) AS trust,
            coalesce(try_cast(json_extract_string(r.m, '$.fetched_at') AS DOUBLE), epoch(try_cast(replace(replace(json_extract_string(r.m, '$.fetched_at'), 'T', ' '), 'Z', '') AS TIMESTAMP)), -1e18) AS fetched
        FROM r JOIN k USING (g) LEFT JOIN sources a ON lower(trim(r.source)) = a.source_key LEFT JOIN sources b ON json_extract_string(r.m, '$.hf_id') = b.hf_id),
    f AS (SELECT group_no, rec_no, trust, fetched, unnest(['license', 'repo', 'instance_id', 'score', 'source']) AS field_name,
            unnest([json_extract_string(m, '$.license'), json_extract_string(m, '$.repo'), json_extract_string(m, '$.instance_id'), json_extract_string(q, '$.score'), source]) AS value FROM v),
    u AS (SELECT *, max(trust) OVER w AS most, max(fetched) OVER w AS last FROM f WHERE lower(trim(value)) NOT IN ({_NO_VALUE}) WINDOW w AS (PARTITION BY group_no, field_name))
    SELECT group_no, field_name, min(rec_no) AS rec_no FROM u WHERE trust = most AND fetched = last GROUP BY ALL"""
SQL["p6_survivors"] = SQL["p6_found"].rsplit("SELECT", 1)[0] + """, b AS (SELECT group_no, field_name, min_by(value, rec_no) AS value FROM u WHERE trust = most AND fetched = last GROUP BY ALL)
    SELECT group_no, """ + ", ".join(f"max(value) FILTER (WHERE field_name = '{f}') AS {f}" for f in fusion.FIELDS) + " FROM b GROUP BY group_no"

_RUNS = """regexp_extract_all(lower(coalesce({0}, '')), '[\\p{{L}}\\p{{N}}]+')"""
SQL["p7_found"] = f"""
    WITH d AS (SELECT doc_id, {_RUNS.format("text")} AS w FROM documents), i AS (SELECT item_id, {_RUNS.format("item_text")} AS w FROM eval_items),
    a AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 10), lambda p: array_to_string(w[p : p + 11], ' '))) AS run FROM i WHERE len(w) >= 12),
    b AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 10), lambda p: array_to_string(w[p : p + 11], ' '))) AS run FROM d WHERE len(w) >= 12)
    SELECT DISTINCT doc_id, item_id FROM a JOIN b USING (run)"""
SQL["p7_clean"] = f"SELECT doc_id, source, doc_kind FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM ({SQL['p7_found']}))"

SQL["p4_found"] = """
    WITH m AS (SELECT rec_no, tool_names, CASE WHEN json_valid(messages) THEN CASE json_type(messages) WHEN 'VARCHAR' THEN json_extract_string(messages, '$') ELSE messages END END AS j FROM records),
    x AS (SELECT rec_no, generate_subscripts(json_extract(j, '$[*]'), 1) AS pos, unnest(json_extract(j, '$[*]')) AS e FROM m WHERE j IS NOT NULL),
    c AS (SELECT rec_no, pos, CASE json_type(e, '$.content') WHEN 'VARCHAR' THEN json_extract_string(e, '$.content') WHEN 'ARRAY' THEN array_to_string(json_extract_string(e, '$.content[*].text'), E'\\n') END AS t
        FROM x WHERE json_extract_string(e, '$.role') IN ('user', 'assistant')),
    t AS (SELECT rec_no, string_agg(t, ' ' ORDER BY pos) AS t FROM c WHERE t <> '' GROUP BY rec_no),
    w AS (SELECT m.rec_no, list_filter(regexp_split_to_array(lower(concat_ws(' ', t.t, array_to_string(list_sort(m.tool_names), ' '))), '[\\s\\x0B\\x1C-\\x1F\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+'),
        lambda v: v <> '') AS w FROM m LEFT JOIN t USING (rec_no) WHERE m.j IS NOT NULL),
    s AS (SELECT rec_no, list_distinct(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda p: array_to_string(w[p : p + 2], ' ')) END) AS s FROM w),
    r AS (SELECT rec_no, len(s) AS n, unnest(s) AS run FROM s),
    b AS (SELECT a.rec_no AS rec_a, b.rec_no AS rec_b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS common FROM r a JOIN r b ON a.run = b.run AND a.rec_no < b.rec_no GROUP BY ALL)
    SELECT rec_a, rec_b FROM b WHERE 10 * common >= 7 * (na + nb - common)"""

_SETS = SQL["p4_found"].split("    r AS (SELECT rec_no, len(s) AS n")[0].rstrip().rstrip(",")
SQL["p4_members"] = f"{_SETS} SELECT rec_no, min(rec_no) OVER (PARTITION BY list_sort(s)) AS rep FROM s"
SQL["p4_links"] = f"""{_SETS}, reps AS (SELECT min(rec_no) AS rec_no, any_value(s) AS s FROM s GROUP BY list_sort(s)),
    r AS (SELECT rec_no, len(s) AS n, unnest(s) AS run FROM reps),
    b AS (SELECT a.rec_no AS rec_a, b.rec_no AS rec_b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS common FROM r a JOIN r b ON a.run = b.run AND a.rec_no < b.rec_no GROUP BY ALL)
    SELECT rec_a, rec_b, common::INT AS common, (na + nb - common)::INT AS either FROM b WHERE 10 * common >= 7 * (na + nb - common)"""

SQL["p4_groups"] = f"""
    WITH RECURSIVE pairs AS MATERIALIZED ({SQL['p4_found']}), ways AS MATERIALIZED (SELECT rec_a AS a, rec_b AS b FROM pairs UNION ALL SELECT rec_b, rec_a FROM pairs),
    reach(a, b) AS (SELECT a, b FROM ways UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a)
    SELECT rec_no, least(rec_no, coalesce((SELECT min(b) FROM reach WHERE a = rec_no), rec_no)) AS group_no FROM records WHERE json_valid(messages) AND
        json_type(CASE json_type(messages) WHEN 'VARCHAR' THEN CASE WHEN json_valid(json_extract_string(messages, '$')) THEN json_extract_string(messages, '$') END ELSE messages END) IN ('ARRAY', 'OBJECT')"""

SQL["p7_report"] = f"""
    WITH d AS (SELECT doc_id, {_RUNS.format("text")} AS w FROM documents), i AS (SELECT item_id, {_RUNS.format("item_text")} AS w FROM eval_items),
    a AS (SELECT item_id, unnest(range(1, len(w) - 10)) AS p, unnest(list_transform(range(1, len(w) - 10), lambda p: array_to_string(w[p : p + 11], ' '))) AS run FROM i WHERE len(w) >= 12),
    b AS (SELECT doc_id, unnest(range(1, len(w) - 10)) AS q, unnest(list_transform(range(1, len(w) - 10), lambda p: array_to_string(w[p : p + 11], ' '))) AS run FROM d WHERE len(w) >= 12),
    m AS (SELECT item_id, doc_id, p, q, q - p AS diagonal, p - row_number() OVER (PARTITION BY item_id, doc_id, q - p ORDER BY p) AS island FROM a JOIN b USING (run)),
    l AS (SELECT item_id, doc_id, count(*) + 11 AS n FROM m GROUP BY item_id, doc_id, diagonal, island)
    SELECT item_id, count(DISTINCT doc_id) AS n_docs, max(n) AS longest FROM l GROUP BY item_id"""
