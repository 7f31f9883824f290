"""Shape profiles open all levels of a document in one reading."""

from conftest import plan_of

from sidewise.operators import documents as D

ODD = [
    '{"a":{"b":{"c":{"d":{"e":1}}}}}', '{"a":{},"b":[],"c":[1,{"x":2}],"d":null,"e":{"f":null,"g":{}}}', '[1,{"a":1}]', "[]", "{}", "3", "bad{", None,
    ' {"a":1.5,"":{"":"q"},"a.b":true}', '{"a":{"b":[]},"z":[1,2,3]}',
]
EXPECTED = {
    ("$.a", "OBJECT", 3, 1), ("$.a.b", "OBJECT", 1, 1), ("$.a.b.c", "OBJECT", 1, 1), ("$.a.b.c.d", "OBJECT", 1, 1), ("$.a.b.c.d.e", "BIGINT", 1, None),
    ("$.b", "ARRAY", 1, 0), ("$.c", "ARRAY", 1, 2), ("$.d", "VOID", 1, None), ("$.e", "OBJECT", 1, 2), ("$.e.f", "VOID", 1, None), ("$.e.g", "OBJECT", 1, 0),
    ("$.a", "DECIMAL", 1, None), ("$.", "OBJECT", 1, 1), ("$..", "STRING", 1, None), ("$.a.b", "BOOLEAN", 1, None), ("$.a.b", "ARRAY", 1, 0), ("$.z", "ARRAY", 1, 3),
}


def test_profile_of_odd_documents(spark):
    df = spark.createDataFrame([(text,) for text in ODD], "data string")
    for depth in (None, 1, 2, 7):
        expected = {row for row in EXPECTED if depth != 1 or row[0] in {"$.a", "$.b", "$.c", "$.d", "$.e", "$.z", "$."} or row == ("$.a.b", "BOOLEAN", 1, None)}
        if depth == 2:
            expected = {row for row in EXPECTED if not row[0].startswith("$.a.b.c")}
        assert {tuple(r) for r in D.json_shape_profile(df, "data", depth).collect()} == expected


def test_profile_reads_documents_once(spark, tmp_path):
    spark.createDataFrame([(ODD[0],)], "data string").write.parquet(str(tmp_path / "documents"))
    df = spark.read.parquet(str(tmp_path / "documents"))
    for depth in (1, 3, 6):
        assert plan_of(D.json_shape_profile(df, "data", depth)).count("FileScan") == 1
