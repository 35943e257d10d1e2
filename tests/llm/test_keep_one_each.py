"""Near-duplicate groups leave one row each, whatever their ids."""

from test_operators import prose

from lodestream.llm import simhash


def test_one_row_a_group_not_an_id(spark):
    texts = [prose(i, 200) for i in range(9)]
    rows = [(None, t, "a") for t in texts[:4]] + [(7, texts[4], "a"), (7, texts[5], "a")]
    rows += [(5, texts[6], "b"), (None, texts[6], "a"), (5, texts[6], "a"), (8, texts[6], "a"), (None, texts[7], "b"), (None, texts[7], "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = [*rows[:6], (5, texts[6], "a"), (None, texts[7], "a")]
    for table in (df, df.repartition(5, "text")):
        got = [tuple(r) for r in simhash.keep_one_each(table).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    single = spark.createDataFrame(rows[:7], df.schema)
    assert simhash.keep_one_each(single).columns == df.columns and simhash.keep_one_each(single).count() == 7


def test_columns_of_any_name(spark):
    text = prose(1, 200)
    rows = [(1, text, "x", 1, {"k": 2}, "z"), (1, text, "x", 1, {"k": 1}, "z"), (2, text, "y", 2, None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, _row_id int, m map<string,int>, _row_key string")
    out = simhash.keep_one_each(df)
    assert out.columns == df.columns and [tuple(r) for r in out.collect()] == [rows[1]]
