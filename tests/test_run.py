import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loomfold import cli
from loomfold.functions.hashing import banding
from loomfold.operators.enrich import of_quality
from loomfold.plans import pipeline
from loomfold.session import shared_dir
from loomfold.sources import readers, sinks
from loomfold.sources.registry import Registry, Source, Subset, load_registry
from loomfold.streaming.incremental import KeptTokens, stream_dedup, windowed_counts

YAML = """
defaults: {near_dedup: true}
sources:
  - key: calls
    hf_id: us/calls
    tier: function_calling
    normalizer: xlam
    license: mit
    subsets: [{config: a, split: train, max_rows: 4}, {config: gone, split: train}]
  - key: steps
    hf_id: us/steps
    tier: swe_terminal
    cfg: {messages_col: trajectory, synthesize_tools: true}
    provenance: [instance_id]
    subsets: [{config: b/c, split: train}]
  - {key: listed, hf_id: us/listed, tier: web, enabled: false, rows: 5, notes: "a|b"}
"""


@pytest.fixture
def world(spark, tmp_path):
    (tmp_path / "registry.yaml").write_text(YAML)
    calls = [(i, f"question number {i} about the weather in a far away town", json.dumps([{"name": "f", "arguments": {"x": i % 3}}]), json.dumps([{"name": "f", "parameters": {"x": {"type": "int"}}}])) for i in range(6)]
    spark.createDataFrame([*calls], "i bigint, query string, answers string, tools string").coalesce(1).write.parquet(str(tmp_path / "raw/us/calls/a/train.parquet"))
    step = lambda i, text: (i, [("user", "do it"), ("assistant", text)], f"o__r-{i // 2}")
    spark.createDataFrame([step(0, "a b c"), step(1, "other words"), step(2, ""), step(3, "third text")], "i bigint, trajectory array<struct<role:string,content:string>>, instance_id string").coalesce(1).write.parquet(
        str(tmp_path / "raw/us/steps/b/c/train.parquet")
    )
    return tmp_path


def test_registry(world, spark):
    registry = load_registry(world / "registry.yaml")
    assert [s.key for s in registry.by_tier()] == ["calls", "steps"] and [s.key for s in registry.by_tier(["web"])] == []
    assert [s.key for s in registry.by_key(["listed", "calls"])] == ["calls", "listed"] and registry.tiers == ["function_calling", "swe_terminal", "web"]
    assert registry.sources[1].normalizer == "openai_messages" and registry.sources[1].dedup_group == "steps" and registry.sources[2].rows == "5"
    assert [r.wired for r in registry.frame(spark).orderBy("position").collect()] == [True, True, False]
    (world / "none.yaml").write_text("")
    assert load_registry(world / "none.yaml") == Registry({}, ())


def test_whole_run(world, spark):
    registry = load_registry(world / "registry.yaml")
    out = str(world / "out")
    told = pipeline.run(spark, registry, str(world / "raw"), out, order="i")
    # calls: 4 rows by the cap, two of which make the same call; the steps of one issue collapse, an empty answer is no record
    assert told["per_source"] == {"calls": {"seen": 4, "written": 3}, "steps": {"seen": 4, "written": 2}}
    assert told["filtered"] == {"empty_assistant": 1} and told["dedup"]["swe_group"] == 1 and told["dedup"]["near"] == 1 and told["total_written"] == 5
    assert list(told["errors"]) == ["calls/gone/train"] and told["by_tier"] == {"function_calling": 3, "swe_terminal": 2}
    rows = readers.read_shards(spark, f"{out}/data").collect()
    assert len(rows) == 5 and {r.id[: -17] for r in rows} == {"calls_a", "steps_b_c"}
    meta = [json.loads(r.metadata) for r in rows if r.source == "steps"]
    assert all(m["hf_id"] == "us/steps" and m["license"] == "unknown" and m["instance_id"].startswith("o__r-") for m in meta)
    # a second run against the first keeps what the first dropped by other layers than the hash, which isn't registered
    against = readers.reference_hashes(spark, readers.read_shards(spark, f"{out}/data"), str(world / "cache"), "first")
    again = pipeline.run(spark, registry, str(world / "raw"), str(world / "out2"), against=against, near=False, order="i")
    assert again["total_written"] == 2 and again["dedup"]["exact"] == 5
    # report, card, gate and publication
    report = sinks.read_report(spark, f"{out}/_report.json")
    assert report["total_written"] == 5 and sinks.may_publish(report, 5) and not sinks.may_publish(report, 6) and not sinks.may_publish(None)
    from loomfold.operators.report import card_markdown

    card = card_markdown("me/set", report)
    assert "| calls | 4 | 3 |" in card and "**5**" in card
    assert sinks.publish(spark, out, str(world / "hub"), card, dry_run=True).startswith("dry run") and not (world / "hub").exists()
    sinks.publish(spark, out, str(world / "hub"), card, dry_run=False)
    assert json.loads((world / "hub/_visibility.json").read_text()) == {"private": True}
    # a second publication replaces the shards; a run that still goes on is waited for, one without rows isn't published
    waits = iter([True, False])
    assert sinks.publish_when_done(spark, lambda: next(waits), out, str(world / "hub"), lambda told: "card", 5, 0.01, private=False)
    assert readers.read_shards(spark, str(world / "hub/data")).count() == 5 and json.loads((world / "hub/_visibility.json").read_text()) == {"private": False}
    assert sinks.publish_when_done(spark, lambda: False, str(world / "nowhere"), str(world / "hub"), str) is None
    assert (world / "hub/README.md").exists() and list((world / "hub/data").glob("*.parquet"))
    assert pipeline.run(spark, registry, str(world / "raw"), str(world / "out3"), keys=["listed"])["total_written"] == 0
    with pytest.raises(ValueError, match="no subset"):
        pipeline.check_source(spark, registry.sources[2], str(world / "raw"))
    assert [r.reason for r in pipeline.check_source(spark, registry.sources[0], str(world / "raw"), 2).collect()] == [None, None]


def sequential_run(rows):
    """Kept ids of one pass in order: the first row of each answer."""
    seen, kept = set(), []
    for i, answer in rows:
        if answer not in seen:
            seen.add(answer)
            kept.append(i)
    return kept


@pytest.mark.parametrize("kind", ["parquet", "json"])
def test_order_is_unique_and_that_of_the_files_over_many_partitions(spark, tmp_path, kind):
    rows = [(i, f"answer {i * 7919 % 90}") for i in range(900)]
    root = tmp_path / "raw dir/us/many/a"
    for part in range(300):  # three rows a file
        text = [{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": a}], "n": i} for i, a in rows[part * 3 : part * 3 + 3]]
        (root / f"train.{kind}").mkdir(parents=True, exist_ok=True)
        target = root / f"train.{kind}/part-{part:05d}.{kind}"
        if kind == "json":
            target.write_text("\n".join(map(json.dumps, text)))
        else:
            pq.write_table(pa.Table.from_pylist(text), target)
    registry = Registry({}, (Source.of({"key": "many", "hf_id": "us/many", "tier": "web", "provenance": ["n"], "subsets": [{"config": "a", "split": "train"}]}),))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        opened = readers.open_subset(spark, str(tmp_path / "raw dir"), registry.sources[0], registry.sources[0].subsets[0])
        assert opened.rdd.getNumPartitions() >= 300
        numbered, behind = readers.in_file_order(opened)
        assert behind == 300 and [r.n for r in numbered.select("_row", "n").orderBy("_row").collect()] == list(range(900))
        assert numbered.select("_row").distinct().count() == 900
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    pipeline.run(spark, registry, str(tmp_path / "raw dir"), str(tmp_path / "out"), near=False, limit=850)
    got = sorted(json.loads(r.metadata)["n"] for r in readers.read_shards(spark, str(tmp_path / "out/data")).collect())
    assert got == sequential_run([x for x in rows if x[0] < 850]) and len(got) == 90


def test_orders_of_a_column_do_not_reach_into_other_subsets(spark):
    source = Source.of({"key": "s", "hf_id": "h", "tier": "web", "normalizer": "xlam"})
    df = spark.createDataFrame([(5, "q"), (1, "r")], "i bigint, query string")
    subset = Subset("c", "train")
    one, two = (pipeline.normalized(df, source, subset, position, None, "i")[0].select("ord").collect() for position in (1, 2))
    assert max(r.ord for r in one) < min(r.ord for r in two)
    with pytest.raises(Exception, match="order outside of its range"):
        pipeline.normalized(df.withColumn("i", F.lit(1 << 43)), source, subset, 0, None, "i")[0].collect()


def test_near_threshold_divides_the_signatures():
    assert banding(0.85) == (4, 15) and banding(0.5, 128) == (25, 5) and banding(0.7)[1] < banding(0.95)[1]


def test_high_tier(spark):
    df = spark.createDataFrame([(1, '{"tier":"high"}'), (2, '{"tier":"low"}'), (3, None), (4, "{")], "i int, quality string")
    assert [r.i for r in of_quality(df).collect()] == [1]


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_shards_are_bounded(spark, tmp_path):
    sinks.write_shards(spark.range(25).coalesce(1).selectExpr("cast(id as string) id"), str(tmp_path / "data"), 10)
    assert len(list((tmp_path / "data").glob("*.parquet"))) == 3


def test_cli(world, capsys):
    base = ["--registry", str(world / "registry.yaml"), "--root", str(world / "raw")]
    assert cli.main([*base, "catalog", "--outfile", str(world / "C.md")]) == 0
    text = (world / "C.md").read_text()
    assert "3 datasets, 2 wired" in text and "a\\|b" in text and text.index("us/calls") < text.index("us/steps")
    assert cli.main([*base, "validate", "--key", "calls", "listed"]) == 0
    told = capsys.readouterr().out
    assert "calls -> ok=5 bad=0" in told or "calls -> ok=4 bad=0" in told
    assert "no subset" in told
    out = str(world / "cli")
    assert cli.main([*base, "run", "--out", out, "--tier", "function_calling", "--no-near", "--limit", "2"]) == 0
    assert cli.main([*base, "stats", "--out", out]) == 0 and '"total_written": 2' in capsys.readouterr().out
    assert cli.main([*base, "audit", "--out", out]) == 0
    assert cli.main([*base, "push", "--out", out, "--repo", str(world / "hub"), "--min-rows", "9"]) == 1
    assert cli.main([*base, "push", "--out", out, "--repo", str(world / "hub"), "--dry-run"]) == 0
    assert cli.main([*base, "seed", "--path", f"{out}/data", "--cache", str(world / "h")]) == 0 and "2 hashes" in capsys.readouterr().out


def test_stream_equals_batch(spark, tmp_path):
    kinds = "ord bigint, layer string, token string"
    batches = [[(0, "e", "a"), (0, "b", "x")], [(1, "e", "a"), (1, "b", "y"), (2, "e", "c"), (2, "b", "y")], [(3, "e", "d"), (3, "b", "y")]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, kinds).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(kinds).parquet(str(tmp_path / "in"))
        query = stream_dedup(stream, lambda df: df, KeptTokens(spark, str(tmp_path / "kept")), str(tmp_path / "out"), str(tmp_path / "check")).start()
        query.awaitTermination()
        assert query.exception() is None
        del i
    got = {r.ord: r.reason for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {0: None, 1: "exact", 2: None, 3: "near"}


def test_windowed_stream(spark, tmp_path):
    events = spark.createDataFrame([("2025-01-01 00:01:00", "a", 1.0), ("2025-01-01 00:04:00", "a", 2.0), ("2025-01-01 00:06:00", "b", 1.0)], "t string, event_type string, value double").withColumn("ts", F.to_timestamp("t"))
    events.drop("t").write.parquet(str(tmp_path / "e"))
    query = windowed_counts(spark.readStream.schema(events.drop("t").schema).parquet(str(tmp_path / "e"))).writeStream.outputMode("complete").format("memory").queryName("w").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.event_type, r.n, r.total) for r in spark.table("w").collect()) == [("a", 2, 3.0), ("b", 1, 1.0)]
