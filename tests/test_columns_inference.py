import pytest

from berth.operators import columns as C
from berth.operators import inference as I


def names(spark, raw):
    df = spark.createDataFrame([("t", i + 1, r) for i, r in enumerate(raw)],
                               "table_id string, ordinal bigint, raw_name string")
    return [r["column_name"] for r in C.normalized_columns(df).orderBy("ordinal").collect()]


def test_header_naming_golden(spark):
    assert names(spark, ["Año", "Valor", "a b", "a-b", "Valor"]) == ["ano", "valor", "a_b", "a_b_2", "valor_1"]
    assert names(spark, ["a", "a"]) == ["a", "a_1"]
    assert names(spark, ["", None, "x"]) == ["unnamed_0", "unnamed_1", "x"]


def test_suffix_collision_is_reported(spark):
    df = spark.createDataFrame([("t", 1, "x"), ("t", 2, "x_2"), ("t", 3, "x 2")],
                               "table_id string, ordinal bigint, raw_name string")
    cols = C.normalized_columns(df)
    assert [r["column_name"] for r in cols.orderBy("ordinal").collect()] == ["x", "x_2", "x_2_2"]
    same = spark.createDataFrame([("t", 1, "a b"), ("t", 2, "a-b"), ("t", 3, "a_b_2")],
                                 "table_id string, ordinal bigint, raw_name string")
    assert [r["column_name"] for r in C.normalized_columns(same).orderBy("ordinal").collect()] == [
        "a_b", "a_b_2", "a_b_2"]
    assert C.collisions(C.normalized_columns(same)).count() == 1


def test_date_like_matches_anywhere(spark):
    df = spark.createDataFrame([(n,) for n in ["fecha", "plano", "mesa", "valor", "year_x"]], "column_name string")
    got = {r["column_name"]: r["f"] for r in df.select("column_name", C.date_like().alias("f")).collect()}
    assert got == {"fecha": True, "plano": True, "mesa": True, "valor": False, "year_x": True}


@pytest.mark.parametrize("values,col,default,lenient", [
    (["1.5", "n/a"], "v", "DOUBLE", "DOUBLE"),
    (["1", "2"], "v", "LONG", "LONG"),
    (["1", "x"], "v", "STRING", "LONG"),
    (["1.5", "x"], "v", "STRING", "DOUBLE"),
    (["2020-01-01", None], "fecha", "STRING", "TIMESTAMP"),
    ([None, "NA"], "v", "LONG", "LONG"),
    (["True", "false"], "v", "BOOLEAN", "BOOLEAN"),
    (["x", "y"], "v", "STRING", "STRING"),
])
def test_column_types(spark, values, col, default, lenient):
    df = spark.createDataFrame([("t", col, i, v) for i, v in enumerate(values)],
                               "table_id string, col string, row bigint, value string")
    r = I.column_profile(df).first()
    assert (r["inferred_type"], r["lenient_type"]) == (default, lenient)


def test_lenient_values_null_the_rest(spark):
    df = spark.createDataFrame([("t", "v", 1, "1"), ("t", "v", 2, "x")],
                               "table_id string, col string, row bigint, value string")
    out = {r["row"]: r["long_value"] for r in I.typed_cells(df, I.column_profile(df), lenient=True).collect()}
    assert out == {1: 1, 2: None}


def test_the_shape_of_a_date_format_changes_no_value(spark):
    """Texts that don't have a format's shape are not parsed; those that the parser reads all have it."""
    from pyspark.sql import functions as F
    texts = ["31-01-2020", "1-1-2020", "31-01-2020 10:30", "31-01-2020 10:30:59", "31-01-2020 10", "31/01/2020", "31.01.2020", "2020/01/31",
             "2020/01/31 23:59:59", "12020/01/31", "+12020/01/31", "2020-01-31", "31-13-2020", "31-02-2020", " 31-01-2020", "31-01-2020 ",
             "31-01-20", "31-01--2020", "x", "", "1.5", "31-01-2020\n", None, "3101 2020", "31012020", "5/7/2020", "31-ene-2020"]
    patterns = [*I.DATE_FORMATS[1:], "ddMMyyyy", "d/M/y", "d-MMM-yyyy", "yyyy/MM/dd'T'HH"]
    assert [I.date_shape(p) is None for p in patterns] == [False] * 6 + [True] * 2
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    for p in patterns:
        got = rows.select(F.unix_micros(I.as_date(rows.v, p))).collect()
        assert got == rows.selectExpr(f'unix_micros(try_to_timestamp(v, "{p}"))').collect()
    plan = rows.select(I.as_date(rows.v, "dd-MM-yyyy"))._jdf.queryExecution().toString()
    assert "RLIKE" in plan.upper()
