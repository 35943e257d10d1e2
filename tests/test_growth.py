"""Plans whose tasks and broadcasts must not grow with the tables."""

import re

from pyspark.sql import functions as F

from lodestream.operators import substitution
from lodestream.plans import stream as S


def test_values_are_met_by_pairs_and_never_broadcast(spark):
    """A value of two tokens meets the texts that hold both side by side, not all that hold the longer one; no side is broadcast by the size before its explode."""
    result = '{"a": "zz-1234", "b": "(solo9)", "c": "one two three"}'
    rows = [(1, 0, result)] + [(1, i, f"{i}-1234") for i in range(1, 50)] + [(1, 50, "see zz-1234, one  two three; one two"), (2, 0, result), (2, 1, "zz 1234 (solo9) one two three")]
    df = spark.createDataFrame(rows, "submission long, pos long, text string")
    found = substitution.consumed_fields(df, df, ["submission"], "pos")
    assert {(r["submission"], r["pos"]): list(r["consumed"]) for r in found.collect()} == {(1, 0): ["a"], (2, 0): ["b", "c"]}
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_streams_are_dealt_by_their_rows(spark):
    """More rows get more partitions, which Spark may not merge by the bytes of the narrow rows."""
    rows = spark.range(1000).select((F.col("id") % 90).alias("key"), "id")
    assert S.dealt(rows, "key", 50).rdd.getNumPartitions() == 20
    assert S.dealt(rows, "key", 10).rdd.getNumPartitions() == 100
    assert {tuple(r) for r in S.dealt(rows, "key", 10).collect()} == {tuple(r) for r in rows.collect()}


def test_fewer_tasks_than_cores_are_dealt_too(spark):
    """Up to as many tasks as the session has cores, Spark merged the partitions by the bytes of the narrow rows, here to one."""
    rows = spark.range(1000).select((F.col("id") % 90).alias("key"), "id")
    cores = spark.sparkContext.defaultParallelism
    assert S.dealt(rows, "key", 1000 // cores + 1).rdd.getNumPartitions() == cores
    assert S.n_tasks(rows, 500) == min(cores, 8) and S.n_tasks(rows, 1000) == 0
    counts = S.dealt(rows, "key", 500).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(counts) > 2 and max(r["count"] for r in counts) <= 500
    assert {tuple(r) for r in S.dealt(rows, "key", 500).collect()} == {tuple(r) for r in rows.collect()}


def test_log_lines_are_parsed_once(spark, sf):
    """What stood before a line comes from joins of the parsed lines, not of the lines parsed again."""
    from lodestream.plans import turns

    for query in (turns.log_stream_codes, turns.log_delivery_codes):
        assert "parse_json" not in query(spark, sf)._jdf.queryExecution().optimizedPlan().toString().lower()


def test_values_lie_beside_their_stream(spark, sf, monkeypatch):
    """One row a stream with an array of values grows with the streams: it is dealt as they are, and never broadcast."""
    from lodestream.plans import detection

    monkeypatch.setattr(S.dealt, "__defaults__", (100, None))
    joined = detection.rows(spark, sf)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan
    n = S.n_tasks(spark.read.parquet(f"{sf}/events.parquet"), 100)
    dealt = re.findall(r"Exchange hashpartitioning\(\S+, (\d+)\), (\w+)", plan)
    assert n > 8 and dealt.count((str(n), "REPARTITION_BY_NUM")) == 2 and len(dealt) == 3  # the third is that of the distinct streams
    assert joined.rdd.getNumPartitions() == n


def test_issues_keep_their_rows(spark, sf):
    """Columns of an issue's row come with it: the streams are built once and not joined with themselves."""
    from lodestream.operators import gates
    from lodestream.plans import relations

    hits = spark.createDataFrame([(1, 5, 0, "a", 50), (1, 4, 0, "a", None), (1, 6, 1, "a", 60), (1, 4, 0, "b:2", 40)], "k long, pos long, turn long, rule string, event long")
    got = {(r["pos"], r["rule"], r["site"], r["event"]) for r in gates.gate_issues(hits, ["k"], "pos", keep=("event",)).collect()}
    assert got == {(4, "a", "1", None), (6, "a", "1", 60), (4, "b", "2", 40)}
    plan = relations.issues_with_rows(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("row_number()") == 1


def test_later_reads_need_no_join(spark, sf):
    """Reads that are calls themselves are counted where the calls lie, as a join with them counts."""
    from lodestream.functions import terms as T
    from lodestream.operators import cascade, detect
    from lodestream.plans import detection

    plan = detection.cascade_facts(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("row_number()") == 1 and "Union" not in plan
    rows = [(1, p, 0, 0, tool, path, "", "", "", "", "", "", 0, 9) for p, (tool, path) in enumerate([("write", "/A"), ("read", "/a"), ("read", ""), ("write", ""), ("read", None), ("read", "/a"), ("write", "/a")])]
    calls = spark.createDataFrame(
        rows, "k long, pos long, turn long, slot int, tool string, path string, command string, content string, args string, current_user string, prior_user string, asked_before string, user_index long, intro_index long"
    ).withColumn("held", detect.no_values())
    reads = F.col("tool").isin(*T.READ_TOOLS)
    counted = lambda given: {r["pos"]: r["later_reads"] for r in cascade.call_facts(calls, ["k"], given).collect()}
    assert counted(reads) == counted(calls.filter(reads)) == {0: 2, 1: 1, 2: 0, 3: 0, 4: 0, 5: 0, 6: 0}


def test_walks_take_streams_where_they_lie(spark):
    """Rows that are dealt already are not dealt again, by bytes that don't tell their number."""
    from lodestream.operators.walks import walk_in_order

    rows = spark.range(1000).select((F.col("id") % 90).alias("key"), "id").repartition(20, "key")
    walked = walk_in_order(rows, ["key"], ["id"], list, lambda s, r: s.append(r.id) or len(s), "n", "long", 20)
    assert walked._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert walked.rdd.getNumPartitions() == 20 and walked.filter("n = id div 90 + 1").count() == 1000
