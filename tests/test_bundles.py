"""Archives in parts, bundles and preference data on small files written here."""

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from lodestream.sources import bundles, members
from lodestream.sources import sessions as S


@pytest.fixture(scope="module")
def archives(tmp_path_factory):
    d = tmp_path_factory.mktemp("archives")
    with zipfile.ZipFile(d / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("big.bin", bytes(range(256)) * 400)
        z.writestr("empty", b"")
        z.writestr("folder/", b"")
        z.writestr("small.txt", b"hello")
    (d / "b.zip").write_bytes(b"no archive")
    (d / "sub").mkdir()
    packed = bytearray((d / "a.zip").read_bytes())
    at = packed.index(b"big.bin") + 60
    packed[at : at + 20] = b"x" * 20
    (d / "sub" / "c.zip").write_bytes(bytes(packed))
    return d


def test_members_in_parts(spark, archives):
    spark.dataSource.register(members.ZipMembers)
    ways = (members.read_parts(spark, str(archives), 1000), spark.read.format("zip_members").option("part_bytes", 1000).option("slices", 3).load(str(archives)))
    for parts in ways:
        rows = [r.asDict() | {"archive": os.path.basename(r["archive"])} for r in parts.collect()]
        big = sorted((r for r in rows if r["archive"] == "a.zip" and r["name"] == "big.bin"), key=lambda r: r["part"])
        assert b"".join(r["content"] for r in big) == bytes(range(256)) * 400 and max(len(r["content"]) for r in big) == 1000 and {r["size"] for r in big} == {102_400}
        assert [(r["part"], r["content"]) for r in rows if r["archive"] == "a.zip" and r["name"] == "empty"] == [(0, b"")]
        assert [(r["name"], r["content"], r["error"] is None) for r in rows if r["archive"] == "b.zip"] == [(None, None, False)]
        broken = [r for r in rows if r["archive"] == "c.zip" and r["name"] == "big.bin"]
        assert sum(r["error"] is not None for r in broken) == 1 and any(r["archive"] == "c.zip" and r["content"] == b"hello" for r in rows)
        whole = {(os.path.basename(r["archive"]), r["name"]): (r["content"], r["error"]) for r in members.whole_members(parts, 102_399).collect()}
        assert whole["a.zip", "small.txt"] == (b"hello", None) and whole["a.zip", "empty"] == (b"", None) and whole["a.zip", "big.bin"] == (None, "larger than 102399 bytes")
        assert whole["b.zip", None][1] and whole["c.zip", "big.bin"][0] is None and len(whole) == 7
    assert members.whole_members(ways[0]).filter("name = 'big.bin' AND archive LIKE '%a.zip'").first()["content"] == bytes(range(256)) * 400


def test_a_large_member_needs_little_memory(spark, tmp_path):
    import resource

    with zipfile.ZipFile(tmp_path / "l.zip", "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z, z.open("zeros", "w", force_zip64=True) as out:
        for _ in range(300):
            out.write(bytes(1 << 20))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    total = 0
    for row in members._parts_of("l", str(tmp_path / "l.zip"), 8 << 20):
        total += len(row[4])
    assert total == 300 << 20 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 100_000
    spark.dataSource.register(members.ZipMembers)
    assert spark.read.format("zip_members").load(str(tmp_path / "l.zip")).agg(F.sum(F.octet_length("content")), F.max(F.octet_length("content"))).first() == (300 << 20, 8 << 20)


def test_read_members_reports(spark, archives):
    rows = {(os.path.basename(r["archive"]), r["name"]): r["error"] for r in S.read_members(spark, str(archives) + "/[ab].zip", 1000).collect()}
    assert rows == {("a.zip", "big.bin"): "larger than 1000 bytes", ("a.zip", "empty"): None, ("a.zip", "small.txt"): None, ("b.zip", None): "File is not a zip file"}


def test_bundles(spark, tmp_path):
    path = str(tmp_path / "out")
    events = spark.createDataFrame([("s1", i, f"e{i}", None) for i in range(40)] + [("s2", 0, "x", "y")], "submission_id string, pos int, id string, text string").repartition(9)
    meta = spark.createDataFrame([("s1", "PASS"), ("s2", "FAIL")], "submission_id string, status string")
    files = spark.createDataFrame([("s1", "a.md", "hello")], "submission_id string, path string, content string")
    bundles.write_bundles(path, {"events": events, "workspace": files, "metadata": meta})
    made = os.listdir(f"{path}/events/submission_id=s1")
    lines = [json.loads(x) for n in made if n.endswith(".json") for x in open(f"{path}/events/submission_id=s1/{n}")]
    assert [x["id"] for x in lines] == [f"e{i}" for i in range(40)] and lines[0] == {"pos": 0, "id": "e0", "text": None}
    back = bundles.read_table(spark, path, "events", "pos int, id string, text string, submission_id string")
    one = bundles.lookup(back, "s2")
    assert [tuple(r) for r in one.collect()] == [(0, "x", "y", "s2")] and "PartitionFilters: [isnotnull(submission_id" in one._jdf.queryExecution().toString()
    pairs = spark.createDataFrame([("s1",), ("s1",)], "submission_id string")
    known = bundles.read_table(spark, path, "metadata", "status string, submission_id string")
    assert [(r["submission_id"], r["has_pairs"]) for r in bundles.catalog(known, pairs).collect()] == [("s1", True), ("s2", False)]
    assert not any(r["has_pairs"] for r in bundles.catalog(known, None).collect())
    bundles.write_bundles(path, {"metadata": meta.filter("submission_id = 's2'").withColumn("status", F.lit("PASS"))})
    known = bundles.read_table(spark, path, "metadata", "status string, submission_id string")
    assert {(r["submission_id"], r["status"]) for r in known.collect()} == {("s1", "PASS"), ("s2", "PASS")}
    for odd in ({"events": events}, {"metadata": meta, "other": meta}):
        with pytest.raises(ValueError):
            bundles.write_bundles(path, odd)


def test_preferences(spark, tmp_path):
    schema = "submission_id string, turn int, criticality double, level int, tier int, context array<struct<role:string,content:string>>, chosen struct<thinking:string,call:string,answer:string>, rejected array<struct<thinking:string,call:string,answer:string,mode:string,reward:double>>"
    bad = [("", None, "no", "over_refusal", 0.4), ("t", "{}", "did it", "over_disclosure", 0.1), (None, None, "made up", "hallucination", 0.1)]
    df = spark.createDataFrame([("s", 1, 0.5, 3, 2, [("user", "u" * 300), (None, None)], ("think", None, "ok"), bad), ("s", 2, 0.7, 2, 3, [], (None, '{"a": 1}', ""), bad[:1])], schema)
    dpo = bundles.dpo_records(df).collect()
    assert [r["rejected"] for r in dpo] == ["no", "<thinking>\nt\n</thinking>\n\n<tool_call>\n{}\n</tool_call>\n\ndid it", "made up", "no"]
    assert dpo[0]["prompt"] == f"[user]: {'u' * 200}\n[user]: " and dpo[0]["chosen"] == "<thinking>\nthink\n</thinking>\n\nok" and dpo[3]["chosen"] == '<tool_call>\n{"a": 1}\n</tool_call>'
    turns = {r["turn"]: (r["worst"]["mode"], r["mean_reward"], r["n_rejected"]) for r in bundles.turn_records(df).collect()}
    assert turns == {1: ("over_disclosure", 0.2, 3), 2: ("over_refusal", 0.4, 1)}
    report = bundles.preference_report(df).first()
    assert (report["total"], report["over_refusal_ratio"], report["violation_ratio"]) == (4, 0.5, 0.25) and report["by_mode"] == {"hallucination": 1, "over_disclosure": 1, "over_refusal": 2} and report["by_level"] == {"2": 1, "3": 3}
    bundles.write_preferences(str(tmp_path / "p"), df)
    assert {n: spark.read.json(str(tmp_path / "p" / n)).count() for n in ("pairs", "dpo", "turns", "report")} == {"pairs": 2, "dpo": 4, "turns": 2, "report": 1}


def test_last_of_equal_keys_and_equal_names(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"people": [{"id": "a", "v": 1}, {"id": "b", "v": 2}, {"id": "a", "v": 3}]}')
    assert {r["id"]: r["v"] for r in S.read_json_dimension(spark, str(tmp_path / "d.json"), "id", "people").collect()} == {"a": 3, "b": 2}
    (tmp_path / "l.json").write_text('[{"id": "a", "v": 1}, {"id": "a", "v": 2}]')
    assert [r["v"] for r in S.read_json_dimension(spark, str(tmp_path / "l.json"), "id").collect()] == [2]
    for folder in ("x", "y"):
        (tmp_path / "c" / folder).mkdir(parents=True)
        (tmp_path / "c" / folder / "same.jsonl").write_text(f"{folder} first line\nsecond\n")
    lines = S.read_corpus(spark, str(tmp_path / "c"))
    assert lines.select("path").distinct().count() == 2 and S.read_corpus(spark, str(tmp_path / "c"), 1).count() == 2
    assert {r["line"] for r in S.first_lines(lines.withColumnRenamed("value", "text"), "path", "text", 5, 6).collect()} == {"x first line", "y first line"}
