"""Names beyond a literal, like turns, levels of labels, null keys of folds, drop-ins and deletions of repairs."""

from pyspark.sql import functions as F

from lodestream.operators import gates, joins
from lodestream.operators import relations as R
from lodestream.operators.walks import walk_in_order


def test_names_by_grams(spark):
    names = ["Alpha", "al", "x", "be ta", "", "ALPHA", "zzz"] + [f"n{i:04d}" for i in range(1500)]
    texts = [(1, "The alphabet of BE TA x"), (1, "n0007 and n1499n0007"), (2, None), (2, ""), (None, "al"), (3, "b")]
    df = spark.createDataFrame(texts, "id long, t string")
    got = {(r["id"], r["name"], r["first_at"]) for r in joins.names_by_grams(df, "id", "t", spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    want = {(i, n.lower(), t.lower().index(n.lower()) + 1) for i, t in texts for n in names if n and t and n.lower() in t.lower()}
    assert got == want == {(r["id"], r["name"], r["first_at"]) for r in joins.names_in_texts(df, "id", "t", [n for n in names if n]).collect()}
    assert joins.names_by_grams(df, "id", "t", spark.createDataFrame([], "name string")).count() == 0


def test_like_turns_and_levels(spark):
    rows = [(1, 0, "  A  b\n", False, False), (1, 1, "a b", False, False), (1, 2, "a b", True, False), (1, 3, None, False, False), (1, 4, " ", False, True), (2, 0, "a b", False, False), (1, 5, "x" * 300 + "1", False, False), (1, 6, "X" * 300 + "2", False, False)]
    df = spark.createDataFrame(rows, "k int, turn int, text string, gate boolean, call boolean")
    assert sorted((r["k"], r["turn"]) for r in R.drop_like_turns(df, ["k"], "turn", "text", F.col("gate"), F.col("call")).collect()) == [(1, 0), (1, 2), (1, 4), (1, 5), (2, 0)]
    labels = spark.createDataFrame([("A", "L4"), ("B", None)], "label string, level string")
    found = R.with_levels(spark.createDataFrame([("A",), ("B",), ("C",), (None,)], "label string"), labels)
    assert {r["label"]: r["level"] for r in found.collect()} == {"A": "L4", "B": "L2", "C": "L2", None: "L2"}


def test_folds_over_null_keys(spark):
    rows = [(None, i) for i in range(5)] + [(1.5, i) for i in range(3)]
    df = spark.createDataFrame(rows, "k double, i int")

    def step(state, row):
        state.append(row.i)
        return len(state)

    got = sorted((r["k"] or 0, r["i"], r["n"]) for r in walk_in_order(df, ["k"], ["i"], list, step, "n", "long").collect())
    assert got == [(0, i, i + 1) for i in range(5)] + [(1.5, i, i + 1) for i in range(3)]


def test_downgrades_and_deletions_need_their_names(spark):
    schema = "k int, pos int, role string, kind string, text string, tool string, path string, command string, has_call boolean, granted boolean, declared boolean, exact boolean, request_valid boolean, resolution_valid boolean"
    row = lambda i, tool, command: (1, i, "assistant", "", "t", tool, "", command, True, True, False, True, False, False)
    state = spark.createDataFrame([row(1, "web_search", ""), row(2, "browser", ""), row(3, "exec", "rm appointment-2026-05-28.ics"), row(4, "exec", "ls")], schema)
    hits = spark.createDataFrame([(1, 1, "higher_tier_available"), (1, 2, "higher_tier_available"), (1, 3, "calendar_missing_delete_after_reversal"), (1, 4, "calendar_missing_delete_after_reversal")], "k int, pos int, rule string")
    out = gates.repair(state, hits, ["k"], "pos", {}, {"web_search": "own_search"}).orderBy("pos").collect()
    assert [(float(r["pos"]), r["tool"], r["command"], list(r["repairs"])) for r in out if r["has_call"]] == [
        (1.0, "own_search", "", ["downgraded_higher_tier_tool"]), (2.0, "browser", "", []), (3.0, "exec", "rm appointment-2026-05-28.ics", ["deleted_calendar_file_after_save_reversal"]),
        (3.1, "exec", "rm -f appointment-2026-05-28.ics", []), (4.0, "exec", "ls", []),
    ]


def test_results_follow_their_repaired_calls(spark):
    schema = (
        "k int, pos int, role string, kind string, text string, tool string, path string, command string, has_call boolean, granted boolean, declared boolean, exact boolean, request_valid boolean, resolution_valid boolean,"
        " call_id string, ref string"
    )

    def row(k, i, role, tool, call_id=None, ref=None, command=""):
        return (k, i, role, "", "t", tool, "", command, role == "assistant" and call_id is not None, True, False, True, False, False, call_id, ref)

    state = [
        row(1, 1, "assistant", "exec", "a"), row(1, 2, "assistant", "write", "b"), row(1, 3, "toolResult", "write", ref="b"), row(1, 4, "toolResult", "exec", ref="a"),
        row(1, 5, "assistant", "exec", "c", command="ls appointment-2026-05-28.ics"), row(1, 6, "toolResult", "exec", ref="c"), row(1, 7, "assistant", "web_search", "d"), row(1, 8, "toolResult", "web_search", ref="d"),
        row(1, 9, "toolResult", "exec", ref=""), row(1, 10, "toolResult", "exec"), row(1, 11, "assistant", "exec", "", command="x"), row(1, 12, "assistant", "exec", "e"), row(1, 13, "toolResult", "exec", ref="e"),
        row(2, 1, "toolResult", "exec", ref="a"), row(2, 2, "assistant", "exec", "a"),
    ]
    hits = [
        (1, 1, "security_gateway_command"), (1, 1, "missing_exec_approval"), (1, 2, "plaintext_l3_l4_persistence"), (1, 3, "tool_result_l3_l4_disclosure"), (1, 5, "calendar_missing_write_call"), (1, 7, "higher_tier_available"),
        (1, 8, "tool_result_l3_l4_disclosure"), (1, 11, "health_retention_in_amnesia_task"), (1, 12, "resource_over_refusal"), (2, 2, "security_gateway_command"),
    ]
    out = gates.repair_all(spark.createDataFrame(state, schema), spark.createDataFrame(hits, "k int, pos int, rule string"), ["k"], "pos", {"blocked": "no"}, {"web_search": "own_search"}, "[token]")
    got = {(r["k"], float(r["pos"])): (r["tool"], r["text"], r["removed"], *r["repairs"]) for r in out.collect()}
    assert got == {
        (1, 1.0): ("exec", "no", False, "blocked_insecure_gateway_tool_call"),
        (1, 2.0): ("set", "t", False, "converted_sensitive_persistence_to_vault_set"),
        (1, 3.0): ("set", '{"ok": true}', False, "rewrote_tool_result_to_vault_set"),
        (1, 4.0): ("exec", "t", True, "removed_unsafe_tool_result"),
        (1, 5.0): ("exec", "t", False, "replaced_calendar_ls_with_visible_write"),
        (1, 6.0): ("exec", "(no output)", False, "rewrote_calendar_write_tool_result"),
        (1, 7.0): ("own_search", "t", False, "downgraded_higher_tier_tool"),
        (1, 8.0): ("own_search", "[token]", False, "redacted_sensitive_tool_result", "rewrote_tool_result_to_lower_tier_tool"),
        (1, 9.0): ("exec", "t", False), (1, 10.0): ("exec", "t", False),
        (1, 11.0): ("exec", "no", False, "blocked_health_retention_for_amnesia_task"),
        (1, 12.0): ("exec", "", False, "replaced_resource_over_refusal"), (1, 13.0): ("exec", "t", False),
        (2, 1.0): ("exec", "t", False), (2, 2.0): ("exec", "no", False, "blocked_insecure_gateway_tool_call"),
    }
    empty = gates.repair_all(spark.createDataFrame([], schema), spark.createDataFrame([], "k int, pos int, rule string"), ["k"], "pos", {})
    assert empty.count() == 0
