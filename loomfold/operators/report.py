"""Counts of a run, the catalog of sources and the card of a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Titles of tiers and the order in which a catalog has them (fixed values).
TIER_TITLES = {
    "function_calling": "Tool / Function Calling",
    "agent_traces": "Agent Traces (real coding-agent sessions)",
    "swe_terminal": "SWE / Terminal (environment interaction)",
    "web": "Web / Browser / GUI",
    "core": "Core Agent Trajectory Corpora",
    "rl": "RL / Verifier / Rejection-Sampling",
    "general": "General Instruction (retention)",
}


def top_reasons(rows: DataFrame, reason: str = "reason", order: str = "ord", most: int = 20) -> DataFrame:
    """(reason, n): the most frequent reasons, ties by the first row that has them. Rows a normalizer dropped are no reason."""
    counted = rows.where(F.col(reason).isNotNull() & (F.col(reason) != "dropped")).groupBy(reason).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counted.orderBy(F.desc("n"), "first").limit(most).select(F.col(reason).alias("reason"), "n")


def by(rows: DataFrame, column: str) -> DataFrame:
    """(column, n)."""
    return rows.groupBy(column).agg(F.count("*").alias("n"))


def per_source(catalog: DataFrame, seen: DataFrame, written: DataFrame, key: str = "source") -> DataFrame:
    """(source, seen, written) of every source of the catalog, also those without rows."""
    a = seen.groupBy(key).agg(F.count("*").alias("seen"))
    b = written.groupBy(key).agg(F.count("*").alias("written"))
    return catalog.select(key).distinct().join(a, key, "left").join(b, key, "left").fillna(0, ["seen", "written"])


def members_by_group(catalog: DataFrame) -> DataFrame:
    """(dedup_group, members): sorted keys of the sources of each group; bounded by the catalog."""
    return catalog.groupBy("dedup_group").agg(F.array_join(F.array_sort(F.collect_list("source_key")), ", ").alias("members"))


def catalog_table(catalog: DataFrame) -> DataFrame:
    """(place, tier, source_key, hf_id, status, notes): tiers in their order, others by name, wired first, then by hub id."""
    order = F.create_map(*(F.lit(x) for i, t in enumerate(TIER_TITLES) for x in (t, i)))
    wired = F.col("wired")
    status = F.coalesce(F.when(F.col("status") != "", F.col("status")), F.when(wired, F.lit("wired")).otherwise(F.lit("listed")))
    notes = F.substring(F.replace(F.coalesce("notes", F.lit("")), F.lit("|"), F.lit("\\|")), 1, 90)
    place = F.struct(F.coalesce(order[F.col("tier")], F.lit(len(TIER_TITLES))), F.col("tier"), ~wired, F.lower("hf_id"))
    return catalog.select(place.alias("place"), "tier", "source_key", "hf_id", "license", status.alias("status"), notes.alias("notes"))


def markdown_table(headers: list[str], rows: list) -> str:
    lines = [headers, ["---"] * len(headers), *rows]
    return "\n".join("| " + " | ".join(map(str, line)) + " |" for line in lines)


def catalog_markdown(registry) -> str:
    """The catalog of a registry as Markdown: contents by tier, then the groups of sources that belong together."""
    sources = registry.sources
    names = [t for t in TIER_TITLES if any(s.tier == t for s in sources)]
    names += sorted({s.tier for s in sources} - set(names))
    out = ["# Catalog of agent datasets", "", f"**{len(sources)} datasets, {sum(s.wired for s in sources)} wired**", ""]
    for t in names:
        mine = sorted((s for s in sources if s.tier == t), key=lambda s: (not s.wired, s.hf_id.lower()))
        rows = [
            (f"`{s.hf_id}`", s.rows or "—", s.tokens or "—", s.license, s.format or s.normalizer, s.status or ("wired" if s.wired else "listed"), s.notes.replace("|", "\\|")[:90]) for s in mine
        ]
        out += [f"## {TIER_TITLES.get(t, t)}", "", markdown_table(["Dataset", "Rows", "Tokens", "License", "Format", "Status", "Notes"], rows), ""]
    groups: dict[str, list[str]] = {}
    for s in sources:
        groups.setdefault(s.dedup_group, []).append(s.key)
    out += ["## Groups", "", markdown_table(["Group", "Members"], [(f"`{g}`", ", ".join(sorted(m))) for g, m in sorted(groups.items())]), ""]
    return "\n".join(out)


def card_markdown(name: str, report: dict) -> str:
    """The card of a dataset from the report of its run."""
    section = lambda title, head, counts: f"## {title}\n\n" + markdown_table([head, "rows"], sorted(counts.items(), key=lambda x: (-x[1], x[0])))
    sources = [(k, v["seen"], v["written"]) for k, v in report["per_source"].items()]
    parts = [
        f"---\nlicense: other\nconfigs:\n- config_name: default\n  data_files: data/*.parquet\n---\n\n# {name}\n\nRows: **{report['total_written']}**",
        section("By tier", "tier", report["by_tier"]),
        section("By quality", "quality", report["by_quality"]),
        "## By source\n\n" + markdown_table(["source", "seen", "written"], sources),
        "## Duplicates\n\n" + markdown_table(["metric", "rows"], list(report["dedup"].items())),
    ]
    return "\n\n".join(parts) + "\n"
