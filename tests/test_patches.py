"""Patches on a small stream."""

from lodestream.operators import patches


def test_patches(spark):
    rows = spark.createDataFrame([("s", 0, "user", "a"), ("s", 1, "assistant", "b"), ("s", 2, "user", None), ("t", 0, "user", "x")], "id string, pos long, role string, text string")
    ops = [
        ("s", 1, 2, "insert_before", "user", "i2"),
        ("s", 1, 1, "insert_before", "assistant", "i1"),
        ("s", 1, 3, "remove_event", None, None),
        ("s", 1, 4, "replace_text", None, "lost"),
        ("s", 0, 1, "replace_text", None, "first"),
        ("s", 0, 2, "replace_text", None, "last"),
        ("s", 2, 1, "replace_text", None, None),
        ("s", 9, 1, "insert_before", "user", "nowhere"),
        ("t", 0, 1, "unknown", None, "no"),
    ]
    edits = spark.createDataFrame(ops, "id string, line long, seq long, op string, role string, text string")
    got = sorted(map(tuple, patches.apply_patches(rows, edits, ["id"], "pos").collect()), key=str)
    assert got == [("s", 0, "user", "last"), ("s", 1, "assistant", "i1"), ("s", 2, "user", "i2"), ("s", 3, "user", None), ("t", 0, "user", "x")]
    assert patches.apply_patches(rows.limit(0), edits, ["id"], "pos").count() == 0


def test_entity_reuse(spark, tmp_path):
    """The test tables hold no such value, so a small table shows a hit, a label said first by the assistant, and nulls."""
    from lodestream.plans.structure import entity_reuse

    turns = [(1, 0, "user", "mail me at Ann@x.org"), (1, 1, "assistant", "I wrote to ann@x.org"), (1, 2, "assistant", "again ann@x.org"), (2, 0, "assistant", "bob@x.org"), (2, 1, "user", "bob@x.org"), (3, 0, "user", None), (3, 1, "assistant", "ann@x.org")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert list(map(tuple, entity_reuse(spark, str(tmp_path)).collect())) == [(1, "ID_EMAIL", "ann@x.org", 0, 1)]
