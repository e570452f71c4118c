"""Queries over whole tables for the curation operators, each with equivalent SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomfold.functions import hashing, parsers, text
from loomfold.functions.jsonx import arguments, coerced_json, value_type
from loomfold.operators import audit, dedup, enrich, quality, report, validate
from loomfold.operators.normalize import normalize, to_rows
from loomfold.plans import oracles
from loomfold.session import shared_dir, spread, written
from loomfold.sources import readers
from loomfold.sources.registry import Registry, Source
from loomfold.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under the name of its function, with its SQL."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _told(x: Column) -> tuple[Column, Column]:
    return F.md5(F.coalesce(x, F.lit("<null>"))).alias("h"), F.length(x).cast("bigint").alias("n")


#: SQL pieces that several queries share.
TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
OBSERVED = r"regexp_replace(m.content, '^OBSERVATION:\s*', '')"
NORMAL = r"lower(trim(regexp_replace(coalesce({}, ''), '\s+', ' ', 'g')))"


# -- text ---------------------------------------------------------------------


@query(rf"""
    WITH x AS (SELECT doc_id, regexp_replace(regexp_replace(concat('<think>', coalesce(lang, ''), E'\n</think> ', text, CASE WHEN doc_id % 2 = 0 THEN '<THINK>open' ELSE '' END),
            '(?is)<think>.*?</think>\s*', '', 'g'), '(?is)<think>.*$', '', 'g') AS t FROM documents)
    SELECT doc_id, md5(coalesce(nullif({TRIM.format('t')}, ''), '<null>')) AS h, length(nullif({TRIM.format('t')}, ''))::BIGINT AS n FROM x""")
def strip_cot(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents")
    open_end = F.when(F.col("doc_id") % 2 == 0, F.lit("<THINK>open")).otherwise(F.lit(""))
    given = F.concat(F.lit("<think>"), F.coalesce("lang", F.lit("")), F.lit("\n</think> "), "text", open_end)
    return d.select("doc_id", *_told(text.strip_cot(given)))


def _markers_sql() -> str:
    out = "concat('[INST] ', text, ' <|im_end|></s>')"
    for m in text.FOREIGN_MARKERS:
        out = f"replace({out}, '{m}', '')"
    return f"SELECT doc_id, md5(coalesce(nullif({TRIM.format(out)}, ''), '<null>')) AS h, length(nullif({TRIM.format(out)}, ''))::BIGINT AS n FROM documents"


@query(_markers_sql())
def strip_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.concat(F.lit("[INST] "), "text", F.lit(" <|im_end|></s>"))
    return _t(spark, sf_dir, "documents").select("doc_id", *_told(text.strip_markers(given)))


@query(f"SELECT doc_id, md5({NORMAL.format('text')}) AS h, length({NORMAL.format('text')})::BIGINT AS n FROM documents")
def normal_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", *_told(text.normal_text("text")))


@query(r"""SELECT doc_id, md5(CASE WHEN length(text) > 1000 THEN concat(substring(text, 1, 1000), E'\n…[content truncated]') ELSE text END) AS h,
    length(CASE WHEN length(text) > 12000 THEN concat(substring(text, 1, 12000), E'\n…[DOM truncated]') ELSE text END)::BIGINT AS n_dom FROM documents""")
def content_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(text.capped("text", 1000)).alias("h"), F.length(text.cap_dom("text")).cast("bigint").alias("n_dom"))


@query(r"""WITH x AS (SELECT p_partkey, concat(' ', p_size, '-', p_name, ' (', p_brand, ')!') AS raw FROM part),
    y AS (SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(raw, '^\s+|\s+$', '', 'g'), '[^0-9a-zA-Z_]+', '_', 'g'), '^_+|_+$', '', 'g') AS bare FROM x)
    SELECT p_partkey, CASE WHEN bare = '' THEN 'unknown_tool' WHEN regexp_matches(bare, '^[0-9]') THEN concat('fn_', bare) ELSE bare END AS name FROM y""")
def tool_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit(" "), "p_size", F.lit("-"), "p_name", F.lit(" ("), "p_brand", F.lit(")!"))
    return _t(spark, sf_dir, "part").select("p_partkey", text.tool_name(raw).alias("name"))


@query(rf"""WITH x AS (SELECT row_no, unnest(trajectory) AS m FROM raw_trajectory)
    SELECT row_no, count(*) AS n, sum(length({TRIM.format(OBSERVED)}))::BIGINT AS chars,
        count(*) FILTER (WHERE m.content LIKE 'OBSERVATION:%') AS prefixed FROM x WHERE m.content IS NOT NULL GROUP BY row_no""")
def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _t(spark, sf_dir, "raw_trajectory").select("row_no", F.explode("trajectory").alias("m")).where("m.content IS NOT NULL")
    return m.groupBy("row_no").agg(
        F.count("*").alias("n"), F.sum(F.length(text.observation("m.content"))).alias("chars"), F.count_if(F.startswith("m.content", F.lit("OBSERVATION:"))).alias("prefixed")
    )


# -- keys and hashes ----------------------------------------------------------

GROUP_KEY = rf"""CASE WHEN regexp_matches(split_part({TRIM.format("coalesce(instance_id, '')")}, '.', 1), '(?s)^.+?-[0-9]+$') THEN concat('swe::', lower(split_part({TRIM.format("coalesce(instance_id, '')")}, '.', 1)))
    WHEN {TRIM.format("coalesce(instance_id, '')")} <> '' THEN concat('swe::', lower(regexp_replace({TRIM.format("coalesce(instance_id, '')")}, '(?i)_run[0-9]+$', '')))
    WHEN repo <> '' THEN concat('swe::repo::', lower(repo)) END"""


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir, "raw_trajectory")
    return t.withColumn("group_key", text.group_key("instance_id", F.lit(None).cast("string"), "repo"))


@query(f"SELECT row_no, {GROUP_KEY} AS group_key FROM raw_trajectory")
def group_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(spark, sf_dir).select("row_no", "group_key")


@query(f"""WITH x AS (SELECT row_no, {GROUP_KEY} AS k FROM raw_trajectory)
    SELECT row_no FROM (SELECT row_no, k, row_number() OVER (PARTITION BY k ORDER BY row_no) AS place FROM x) WHERE k IS NULL OR place = 1""")
def group_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _keyed(spark, sf_dir).select("row_no", "group_key")
    free, keyed = rows.where("group_key IS NULL"), rows.where("group_key IS NOT NULL")
    return dedup.first_wins(keyed, F.col("group_key"), "row_no").unionByName(free).select("row_no")


@query(f"SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY md5({NORMAL.format('text')})")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents").groupBy(F.md5(text.normal_text("text"))).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    return d.select("doc_id", "copies")


@query(f"SELECT rec_no FROM incoming WHERE md5({NORMAL.format('messages')}) NOT IN (SELECT md5({NORMAL.format('messages')}) FROM records)")
def reference_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _t(spark, sf_dir, "records").select(F.md5(text.normal_text("messages")).alias("h")).distinct()
    return _t(spark, sf_dir, "incoming").withColumn("h", F.md5(text.normal_text("messages"))).join(known, "h", "left_anti").select("rec_no")


@query("SELECT doc_id, concat(substring(replace(concat(source, '_', doc_kind), '/', '_'), 1, 34), '_', substring(md5(text), 1, 16)) AS id FROM documents")
def make_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", text.record_id("source", "doc_kind", F.substring(F.md5("text"), 1, 16)).alias("id"))


SHINGLES = f"""words AS (SELECT doc_id, list_filter(string_split({NORMAL.format('text')}, ' '), lambda w: w <> '') AS w FROM documents),
    counted AS (SELECT doc_id, w, len(w) - 4 AS c FROM words),
    stepped AS (SELECT doc_id, w, c, CASE WHEN c <= 1500 THEN 1 ELSE c // 1500 + 1 END AS step FROM counted),
    shingled AS (SELECT doc_id, unnest(CASE WHEN c >= 1 THEN list_distinct(list_transform(range(0, c, step), lambda i: array_to_string(w[i + 1 : i + 5], ' ')))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END) AS s FROM stepped)"""


def _shingled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_t(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", hashing.text_shingles(text.normal_text("text")).alias("shingles"))


@query(f"WITH {SHINGLES} SELECT doc_id, count(*) AS n, min(md5(s)) AS least FROM shingled GROUP BY doc_id")
def shingles(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _shingled(spark, sf_dir).select("doc_id", F.explode("shingles").alias("s"))
    return s.groupBy("doc_id").agg(F.count("*").alias("n"), F.min(F.md5("s")).alias("least"))


def _minhash_sql(shown: int = 64) -> str:
    return ", ".join(f"min((h * {a} + {b}) % {hashing.PRIME}) AS m{i}" for i, (a, b) in enumerate(hashing.multipliers()[:shown]))


HASHED = f"{SHINGLES}, hashed AS (SELECT doc_id, (('0x' || substring(md5(s), 1, 8))::BIGINT % {hashing.PRIME})::BIGINT AS h FROM shingled)"


@query(f"WITH {HASHED} SELECT doc_id, {_minhash_sql()} FROM hashed GROUP BY doc_id")
def minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashing.minhash(_shingled(spark, sf_dir), "doc_id")


def _bands_sql() -> str:
    keys = ", ".join("md5(concat_ws(',', " + ", ".join(f"m{b * hashing.BAND_ROWS + r}" for r in range(hashing.BAND_ROWS)) + "))" for b in range(hashing.BANDS))
    return f"""WITH {HASHED}, signed AS (SELECT doc_id, {_minhash_sql()} FROM hashed GROUP BY doc_id),
        banded AS (SELECT doc_id, unnest(range(0, {hashing.BANDS})) AS band, unnest([{keys}]) AS band_key FROM signed)
        SELECT band::INT AS band, band_key, count(*) AS n, min(doc_id) AS first_doc FROM banded GROUP BY ALL HAVING count(*) > 1"""


@query(_bands_sql())
def near_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands that several documents share, without expanding them into pairs."""
    banded = hashing.bands(hashing.minhash(_shingled(spark, sf_dir), "doc_id"), "doc_id")
    return banded.groupBy("band", "band_key").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")


# -- caps, provenance, catalog ------------------------------------------------


@query("""SELECT doc_id FROM (SELECT d.doc_id, s.row_cap // 1000 AS cap, row_number() OVER (PARTITION BY d.source ORDER BY d.doc_id) AS place
    FROM documents d LEFT JOIN sources s ON d.source = s.source_key) WHERE cap IS NULL OR cap <= 0 OR place <= cap""")
def source_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    caps = _t(spark, sf_dir, "sources").select(F.col("source_key").alias("source"), F.floor(F.col("row_cap") / 1000).alias("cap"))
    return enrich.capped(_t(spark, sf_dir, "documents").select("doc_id", "source").join(caps, "source", "left"), "source", "doc_id", "cap").select("doc_id")


@query("""SELECT t.row_no, t.instance_id, t.repo, coalesce(s.hf_id, 'none') AS hf_id, coalesce(s.license, 'unknown') AS license,
        (1 + 1 + 1 + (t.instance_id IS NOT NULL)::INT + (t.repo IS NOT NULL)::INT) AS n_keys
    FROM raw_trajectory t LEFT JOIN sources s ON t.source = s.source_key""")
def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _t(spark, sf_dir, "sources").select("source_key", "hf_id", "license")
    t = _t(spark, sf_dir, "raw_trajectory").join(s, F.col("source") == F.col("source_key"), "left")
    given = enrich.with_provenance(F.create_map(F.lit("kind"), F.lit("trajectory")), {"instance_id": F.col("instance_id"), "repo": F.col("repo")})
    whole = enrich.with_defaults(given, {"hf_id": F.coalesce("hf_id", F.lit("none")), "license": F.coalesce("license", F.lit("unknown")), "kind": F.lit("never")})
    m = t.select("row_no", whole.alias("m"))
    return m.select("row_no", *(F.col("m")[k].alias(k) for k in ("instance_id", "repo", "hf_id", "license")), F.size("m").alias("n_keys"))


def _registry(spark: SparkSession, sf_dir: str) -> Registry:
    """The registry of the sources table; the subsets of a source are the kinds of its documents. Bounded by the table of sources."""
    kinds = _t(spark, sf_dir, "documents").where("source IS NOT NULL").groupBy("source").agg(F.array_sort(F.collect_set("doc_kind")).alias("kinds"))
    rows = _t(spark, sf_dir, "sources").join(kinds, F.col("source") == F.col("source_key"), "left").orderBy("source_key").collect()
    given = [{"key": r.source_key, "hf_id": r.hf_id, "tier": r.tier, "normalizer": r.normalizer, "dedup_group": r.dedup_group, "enabled": r.enabled, "license": r.license or "unknown", "notes": f"{r.license}|{r.normalizer}", "subsets": [{"config": k, "split": "train"} for k in r.kinds or ()]} for r in rows]
    return Registry({}, tuple(map(Source.of, given)))


def _keys(spark: SparkSession, chosen: list[Source]) -> DataFrame:
    return spark.createDataFrame([(s.key, s.tier) for s in chosen], "source_key string, tier string")


_WIRED = "enabled AND source_key IN (SELECT source FROM documents WHERE doc_kind IS NOT NULL)"


@query("SELECT dedup_group, string_agg(source_key, ', ' ORDER BY source_key) AS members FROM sources GROUP BY dedup_group")
def catalog_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.members_by_group(_t(spark, sf_dir, "sources"))


@query(rf"""WITH x AS (SELECT *, ({_WIRED}) AS wired, CASE tier WHEN 'function_calling' THEN 0 WHEN 'agent_traces' THEN 1 WHEN 'swe_terminal' THEN 2 WHEN 'web' THEN 3 WHEN 'core' THEN 4 WHEN 'rl' THEN 5 WHEN 'general' THEN 6 ELSE 7 END AS o FROM sources)
    SELECT row_number() OVER (ORDER BY o, tier, NOT wired, lower(hf_id)) AS place, tier, source_key, hf_id, coalesce(license, 'unknown') AS license, CASE WHEN wired THEN 'wired' ELSE 'listed' END AS status,
        substring(concat(coalesce(license, 'None'), '\|', normalizer), 1, 90) AS notes FROM x""")
def catalog_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("place")).cast("bigint")  # the catalog is small
    return report.catalog_table(_registry(spark, sf_dir).frame(spark)).withColumn("place", place)


@query(f"SELECT source_key, tier FROM sources WHERE {_WIRED} AND tier IN ('web', 'general')")
def sources_by_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keys(spark, _registry(spark, sf_dir).by_tier(["web", "general"]))


@query("SELECT source_key, tier FROM sources WHERE NOT enabled OR dedup_group = source_key")
def sources_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources chosen by key, wired or not: the disabled ones, and those that are their own group."""
    registry = _registry(spark, sf_dir)
    return _keys(spark, registry.by_key([s.key for s in registry.sources if not s.enabled or s.dedup_group == s.key]))


@query("SELECT DISTINCT tier FROM sources")
def tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(t,) for t in _registry(spark, sf_dir).tiers], "tier string")


@query("SELECT rec_no FROM records WHERE json_valid(quality) AND json_extract_string(quality, '$.tier') = 'high'")
def high_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.of_quality(_t(spark, sf_dir, "records"), "high").select("rec_no")


@query("SELECT s.tier, count(*) AS n FROM records r JOIN sources s ON lower(trim(r.source)) = s.source_key GROUP BY s.tier")
def tier_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _t(spark, sf_dir, "sources").select("source_key", "tier")
    return report.by(_t(spark, sf_dir, "records").join(s, F.lower(F.trim("source")) == F.col("source_key")), "tier")


@query("""SELECT s.source_key AS source, coalesce(a.n, 0)::BIGINT AS seen, coalesce(b.n, 0)::BIGINT AS written FROM sources s
    LEFT JOIN (SELECT source, count(*) AS n FROM documents GROUP BY source) a ON a.source = s.source_key
    LEFT JOIN (SELECT source, count(*) AS n FROM documents WHERE trim(text) <> '' GROUP BY source) b ON b.source = s.source_key""")
def per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents")
    return report.per_source(_t(spark, sf_dir, "sources").withColumnRenamed("source_key", "source"), d, d.where(F.trim("text") != ""))


@query("""SELECT sum(n - 1)::BIGINT AS collisions, round_even(sum(chars) / greatest(sum(n), 1), 0)::BIGINT AS average_size
    FROM (SELECT id, count(*) AS n, sum(length(coalesce(messages, ''))) AS chars FROM records GROUP BY id)""")
def id_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.collisions(_t(spark, sf_dir, "records"))


# -- validation and quality on typed trajectories -------------------------------


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trajectories as typed records, as they come: roles, contents, calls; the names of a trajectory's first call are declared."""
    t = _t(spark, sf_dir, "raw_trajectory")
    answers = F.array().cast("array<struct<name:string,response:string,response_is_str:boolean>>")
    calls = lambda m: F.transform(F.coalesce(m["tool_calls"], F.array().cast("array<struct<function:struct<name:string,arguments:string>>>")), lambda c: F.struct(c["function"]["name"].alias("name"), c["function"]["arguments"].alias("arguments")))
    messages = F.transform("trajectory", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), F.lit(False).alias("content_is_json"), calls(m).alias("tool_calls"), answers.alias("tool_responses")))
    names = F.slice(F.array_distinct(F.transform(validate.calls_of("messages"), lambda c: c["name"])), 1, 2)
    rows = t.select(F.col("row_no").alias("ord"), "instance_id", messages.alias("messages"))
    empty = F.array().cast("array<struct<name:string,description:string,parameters:string>>")
    return rows.withColumns({
        "tool_names": names, "tools": empty, "error": F.lit(None).cast("string"), "no_call_expected": F.col("instance_id").isNull(),
        "resolved": F.when(F.col("ord") % 3 == 0, F.lit(True)).when(F.col("ord") % 3 == 1, F.lit(False)), "reward": F.lit(0.0), "curated": F.col("ord") % 2 == 0,
    })


TYPED = """m AS (SELECT row_no AS ord, instance_id, trajectory, flatten(list_transform(coalesce(trajectory, []), lambda x: coalesce(x.tool_calls, []))) AS calls FROM raw_trajectory),
    t AS (SELECT *, list_filter(trajectory, lambda x: NOT coalesce(x.role IN ('system', 'user', 'assistant', 'tool'), false)) AS odd FROM m),
    d AS (SELECT ord, list(name ORDER BY pos) AS names FROM (SELECT ord, name, pos, row_number() OVER (PARTITION BY ord ORDER BY pos) AS k FROM
        (SELECT ord, c.function.name AS name, min(i) AS pos FROM (SELECT ord, unnest(calls) AS c, unnest(range(0, len(calls))) AS i FROM m) GROUP BY ALL)) WHERE k <= 2 GROUP BY ord),
    b AS (SELECT t.*, coalesce(d.names, []) AS names, list_filter(t.calls, lambda c: NOT coalesce(regexp_matches(c.function.arguments, '^\\s*[\\[{]'), false)
        OR (len(coalesce(d.names, [])) > 0 AND NOT coalesce(list_contains(d.names, c.function.name), false))) AS bad FROM t LEFT JOIN d USING (ord)),
    reasons AS (SELECT ord, CASE WHEN len(coalesce(trajectory, [])) = 0 THEN 'empty_messages'
        WHEN len(odd) > 0 THEN concat('bad_role:[', coalesce(concat('''', odd[1].role, ''''), 'None'), ']')
        WHEN len(list_filter(trajectory, lambda x: x.role = 'assistant')) = 0 THEN 'no_assistant_turn'
        WHEN len(bad) > 0 THEN CASE WHEN NOT coalesce(regexp_matches(bad[1].function.arguments, '^\\s*[\\[{]'), false) THEN 'tool_call_args_not_object' ELSE concat('undeclared_tool:', coalesce(bad[1].function.name, 'None')) END
        WHEN len(calls) = 0 AND len(list_filter(trajectory, lambda x: x.role = 'assistant' AND regexp_matches(coalesce(x.content, ''), '\\S'))) = 0 THEN 'empty_assistant' END AS reason FROM b)"""


@query(f"WITH {TYPED} SELECT ord, reason FROM reasons")
def validate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validated(_typed(spark, sf_dir)).select("ord", "reason")


@query(f"WITH {TYPED} SELECT reason, n FROM (SELECT reason, count(*) AS n, min(ord) AS f FROM reasons WHERE reason IS NOT NULL GROUP BY reason ORDER BY n DESC, f LIMIT 20)")
def filter_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.top_reasons(validate.validated(_typed(spark, sf_dir)))


COUNTS = f"""{TYPED}, counted AS (SELECT ord, instance_id, names, len(trajectory) AS n_turns, len(list_filter(trajectory, lambda x: x.role = 'assistant')) AS n_assistant,
    len(list_filter(trajectory, lambda x: x.role = 'tool')) AS n_tool, len(calls) AS n_tool_calls, coalesce(list_sum(list_transform(trajectory, lambda x: coalesce(length(x.content), 0))), 0)::BIGINT AS n_chars FROM b)"""


@query(f"WITH {COUNTS} SELECT ord, n_turns, n_assistant, n_tool, n_tool_calls, n_chars FROM counted")
def record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = quality.counts()
    return _typed(spark, sf_dir).select("ord", *(c[k].alias(k) for k in ("n_turns", "n_assistant", "n_tool", "n_tool_calls", "n_chars")))


SCORES = f"""{COUNTS}, scores AS (SELECT ord, greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.5::DOUBLE
    + CASE WHEN n_tool_calls > 0 AND n_tool > 0 THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN n_assistant > 1 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END
    + CASE WHEN n_tool_calls > 0 THEN 0.15::DOUBLE * 0.0::DOUBLE - 0.10::DOUBLE * (1.0::DOUBLE - 0.0::DOUBLE) ELSE 0.0::DOUBLE END
    + CASE WHEN len(names) > 0 AND n_tool_calls > 0 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN ord % 3 = 0 THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END
    + CASE WHEN ord % 3 = 1 THEN -0.05::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN ord % 2 = 0 THEN 0.10::DOUBLE ELSE 0.0::DOUBLE END
    + CASE WHEN instance_id IS NULL THEN 0.03::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN n_chars < 40 AND n_tool_calls = 0 THEN -0.20::DOUBLE ELSE 0.0::DOUBLE END
    + CASE WHEN n_turns < 2 THEN -0.10::DOUBLE ELSE 0.0::DOUBLE END)) AS score FROM counted),
    tiers AS (SELECT ord, score, CASE WHEN score >= 0.75::DOUBLE THEN 'high' WHEN score >= 0.5::DOUBLE THEN 'medium' ELSE 'low' END AS tier FROM scores)"""


@query(f"WITH {SCORES} SELECT ord, score, tier FROM tiers")
def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(_typed(spark, sf_dir)).select("ord", "score", "tier")


@query(f"WITH {SCORES} SELECT tier, count(*) AS n FROM tiers GROUP BY tier")
def quality_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.by(quality.scored(_typed(spark, sf_dir)), "tier")


@query(oracles.AUDIT)
def audit_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.totals(_t(spark, sf_dir, "records"))


@query(oracles.WORST)
def audit_worst_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.worst_sources(_t(spark, sf_dir, "records"))


# -- JSON ----------------------------------------------------------------------


@query("""SELECT event_id, CASE json_type(json_extract(props, '$.k')) WHEN 'BIGINT' THEN 'integer' WHEN 'UBIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number' WHEN 'BOOLEAN' THEN 'boolean' ELSE 'string' END AS kind,
    json_extract_string(props, '$.k') AS k, (SELECT count(*) FROM (SELECT unnest(json_keys(props))))::INT AS n_keys FROM events""")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    import pyarrow as pa

    def tell(props):
        given = [arguments(x) for x in props.to_pylist()]
        kinds = pa.struct([("kind", pa.string()), ("k", pa.string()), ("n_keys", pa.int32())])
        return pa.array([{"kind": value_type(g.get("k")), "k": None if g.get("k") is None else str(g["k"]), "n_keys": len(g)} for g in given], kinds)

    return _t(spark, sf_dir, "events").select("event_id", F.arrow_udf(tell, "struct<kind:string,k:string,n_keys:int>")("props").alias("x")).select("event_id", "x.*")


# -- normalizers ----------------------------------------------------------------

_TRAJECTORY = {"messages_col": "trajectory", "tools_col": None, "synthesize_tools": True, "clean_tool_content": True}


def _trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(_t(spark, sf_dir, "raw_trajectory"), "openai_messages", "trajectory", "default", _TRAJECTORY, "row_no", provenance=("instance_id", "repo"))


def _functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(_t(spark, sf_dir, "raw_xlam"), "xlam", "xlam", "default", None, "row_no")


@query(oracles.NORM_TRAJECTORY)
def norm_openai_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trajectories with cleaned observations, decoded arguments and synthesized tools, as whole JSON texts."""
    n_calls = F.size(validate.calls_of()).alias("n_calls")
    return _trajectories(spark, sf_dir).select("ord", F.size("messages").alias("n_messages"), n_calls, F.md5("messages_json").alias("messages"), F.md5("tools_json").alias("tools"))


@query(oracles.NORM_FUNCTIONS)
def norm_xlam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries with their calls, answers in JSON and other notation, tools of both styles of parameters coerced."""
    n_calls = F.size(validate.calls_of())
    return _functions(spark, sf_dir).select(
        "ord", n_calls.alias("n_calls"), (n_calls > 1).alias("parallel"), F.md5("messages_json").alias("messages"), F.md5("tools_json").alias("tools"), F.array_join("tool_names", ",").alias("names")
    )


# -- deduplication and the whole run ------------------------------------------------


def _both(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trajectories(spark, sf_dir).unionByName(_functions(spark, sf_dir).withColumn("ord", F.col("ord") + F.lit(1 << 40)))


@query(oracles.GREEDY)
def greedy_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each trajectory and call record with why it was dropped, over all three layers."""
    return dedup.deduplicate(written(_both(spark, sf_dir), "both")).select("ord", "source", "dup_reason")


@query(oracles.VERDICTS)
def curate_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run says of each row of both raw tables: why it isn't well-formed, why it is a duplicate, its score and tier."""
    checked = written(validate.validated(_both(spark, sf_dir)), "checked")
    told = dedup.deduplicate(checked.where("reason IS NULL")).select("ord", "dup_reason")
    scored = quality.scored(checked).select("ord", "reason", F.round("score", 6).alias("score"), "tier")
    return scored.join(told, "ord", "left").select("ord", "reason", "dup_reason", "score", "tier")


@query(oracles.REPORT)
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that a run reports: why rows were left out, duplicates by layer, tiers of what is kept."""
    checked = written(validate.validated(_both(spark, sf_dir)), "checked")
    unique = written(dedup.deduplicate(checked.where("reason IS NULL")), "unique")
    layers = ("seen", "kept", *(name for _, name in dedup.LAYERS))
    totals = dedup.stats(unique).select(F.explode(F.array(*(F.struct(F.lit(k).alias("metric"), F.col(k).alias("n")) for k in layers))).alias("x")).select("x.*")
    filtered = report.top_reasons(checked, most=1_000).select(F.concat(F.lit("filtered "), "reason"), "n")
    tiers = report.by(quality.scored(unique.where("dup_reason IS NULL")), "tier").select(F.concat(F.lit("quality "), "tier"), "n")
    return totals.union(filtered).union(tiers)


@query(oracles.AGAINST)
def dedup_against(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls of the later half of the time against the content hashes of the earlier half as reference set."""
    t = _t(spark, sf_dir, "raw_xlam")
    at = t.agg(F.expr("(min(unix_micros(cast(loaded_at AS timestamp))) + max(unix_micros(cast(loaded_at AS timestamp)))) div 2")).first()[0]
    early = F.expr(f"unix_micros(cast(loaded_at AS timestamp)) < {at or 0}")
    made = lambda rows: normalize(rows, "xlam", "xlam", "default", None, "row_no")
    known = made(t.where(early)).select(F.col("content_hash").alias("hash"))
    return dedup.deduplicate(written(made(t.where(~early)), "late"), known, near=False).select("ord", "dup_reason")


@query()
def reference_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.row_hashes(_t(spark, sf_dir, "records"))


@query()
def curate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run on both raw tables: canonical rows that are valid, unique and scored."""
    valid = written(validate.validated(_both(spark, sf_dir)).where("reason IS NULL"), "valid")
    kept = dedup.deduplicate(valid, readers.row_hashes(_t(spark, sf_dir, "records"))).where("dup_reason IS NULL")
    return to_rows(enrich.with_record_ids(quality.scored(kept)))


@query(f"SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY md5({NORMAL.format('text')}) ORDER BY doc_id) > 1 THEN 'exact' END AS reason FROM documents")
def stream_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a file stream, decided against all that was kept before; the outcome is that of one ordered pass."""
    base = f"{shared_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    rows = spark.readStream.schema(_t(spark, sf_dir, "documents").schema).parquet(f"{sf_dir}/documents.parque[t]")
    tokens = lambda batch: batch.select(F.col("doc_id").alias("ord"), F.lit("e").alias("layer"), F.md5(text.normal_text("text")).alias("token"))
    stream = incremental.stream_dedup(rows, tokens, incremental.KeptTokens(spark, f"{base}/kept"), f"{base}/out", f"{base}/checkpoint").start()
    stream.awaitTermination()
    return spark.read.parquet(f"{base}/out").select(F.col("ord").alias("doc_id"), "reason")


@query("""SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def windowed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-time windows; on a table no event is late."""
    w = incremental.windowed_counts(_t(spark, sf_dir, "events"))
    return w.withColumn("total", F.round("total", 4))
