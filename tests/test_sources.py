"""Archives, manifests and JSON lines on small files; the latch over several micro-batches."""

import zipfile

from pyspark.sql import functions as F

from lodestream.sources import archives
from lodestream.streaming import latch


def test_archive_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with zipfile.ZipFile(tmp_path / "in" / "a.zip", "w") as z:
        z.writestr("log.jsonl", '{"id": "1", "type": "message", "message": {"role": "user"}}\n\n[1]\nnot json\r\n')
        z.writestr("empty.jsonl", "")
        z.writestr("other.txt", "x")
    (tmp_path / "in" / "broken.zip").write_bytes(b"no archive")
    rows = archives.parse_events(archives.read_event_lines(spark, str(tmp_path / "in"), batch=2)).orderBy("path", "line").collect()
    assert [(r.entry, r.line, r.is_object, r.id, r.role) for r in rows] == [("log.jsonl", 1, True, "1", "user"), ("log.jsonl", 3, False, None, None), ("log.jsonl", 4, False, None, None), (None, None, False, None, None)]
    assert rows[2].json == "not json"


def test_manifest_and_paths(spark, tmp_path):
    (tmp_path / "m.csv").write_text("submission_id,export_url\ns1,https://host/b/x/o/dir%2Fa.zip?alt=media\ns2,\ns3,file:///tmp/b.zip\n")
    rows = archives.read_manifest(spark, str(tmp_path / "m.csv")).withColumn("p", archives.object_path("export_url")).collect()
    assert [(r.submission_id, r.task_id, r.p) for r in rows] == [("s1", None, "dir/a.zip"), ("s3", None, "/tmp/b.zip")]


def test_json_lines_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "y")], "id long, text string, part string")
    archives.write_json_lines(df, str(tmp_path / "out"), ["part"])
    back = spark.read.schema(df.schema).json(str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect())) == [(1, "a", "x"), (2, None, "y")]


def test_latch_keeps_state_between_batches(spark, tmp_path):
    schema = "event_id long, user_id long, ts long, event_type string"
    for n, rows in enumerate(([(0, 1, 0, "view"), (1, 1, 1, "error")], [(2, 1, 2, "view"), (3, 2, 2, "view")], [(4, 1, 3, "signup"), (5, 1, 4, "view")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    path = str(tmp_path / "out")
    step = latch.latch_into(path, "user_id", ["ts", "event_id"], "error", "signup", "event_id", "event_type")
    out = latch.run_once(stream, path, step, "event_id long, pending long, late boolean")
    assert {r.event_id: (r.pending, r.late) for r in out.collect()} == {i: (p, False) for i, p in {0: 0, 1: 1, 2: 1, 3: 0, 4: 0, 5: 0}.items()}


def test_latch_of_late_rows_hot_and_null_keys(spark):
    state = spark.createDataFrame([(1, (5, 5), 1), (None, (1, 1), 1)], "user_id long, at struct<ts:long,event_id:long>, held long")
    rows = [(i, 9, i, "error" if i % 1000 == 3 else "signup" if i % 1000 == 500 else "view") for i in range(50_000)]
    rows += [(100_001, 1, 4, "signup"), (100_002, 1, 6, "view"), (100_003, 1, 7, "signup"), (100_004, None, 8, "view"), (100_005, 2, 1, None)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts long, event_type string").repartition(7)
    made, after = latch.latch_batch(df, state, "user_id", ["ts", "event_id"], "error", "signup", "event_type")
    got = {r.event_id: (r.pending, r.late) for r in made.collect()}
    assert [got[i] for i in range(100_001, 100_006)] == [(None, True), (1, False), (0, False), (1, False), (0, False)]
    assert all(got[i] == (int(3 <= i % 1000 < 500), False) for i in range(50_000))
    assert {r.user_id: (tuple(r["at"]), r.held) for r in after.collect()} == {1: ((7, 100_003), 0), None: ((8, 100_004), 1), 2: ((1, 100_005), 0), 9: ((49_999, 49_999), 0)}
