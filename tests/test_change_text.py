import pytest
from pyspark.sql import functions as F

from rowharbor.functions import change_text as ct


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column).first()[0]


@pytest.mark.parametrize(
    "text, control, op",
    [
        ("Insert(x)", False, "c"),
        ("UPDATE(x)", False, "u"),
        ("Delete(x)", False, "d"),
        ('Update(.. String("please insert"))', False, "c"),
        ("Delete(then update)", False, "u"),
        ("Begin(insert)", True, "c"),
        ("COMMIT(..)", True, None),
        ("relation..", True, None),
        ("Type(..)", True, None),
        ("Truncate(..)", False, None),
        (" begin", False, None),
        ("", False, None),
    ],
)
def test_operation(spark, text, control, op):
    t = F.col("t")
    assert one(spark, ct.is_control(t), text) is control
    assert one(spark, ct.op_code(F.lower(t)), text) == op
    assert one(spark, ct.has_operation(t), text) is (op is not None)


@pytest.mark.parametrize(
    "text, oid",
    [
        ("Insert(table_id: TableId(16384), values: [])", "16384"),
        ("Insert(table: 77 ..)", "77"),
        ("Insert(table:\t\n 77x1)", "77"),
        ("Insert(table: x, TableId(12))", "12"),
        ("table: x then table: 5", "5"),
        ("Insert(x 42)", "42"),
        ("a1b2", "12"),
        ("Insert(x)", "0"),
        ("", "0"),
        ("no marker in a text that is longer than fifty bytes 7", "0"),
        ("é" * 24 + "1", "1"),
        ("é" * 25 + "1", "0"),
        ("TableId without digits in a text longer than fifty bytes", "0"),
        ("TableId { schema: 9, id 3 }", "9"),
        ("TableId(²)", "²"),
        ("Insert(table_id: TableId(" + "1" * 21 + "), ..)", "1" * 21),
    ],
)
def test_table_oid(spark, text, oid):
    assert one(spark, ct.table_oid(F.col("t")), text) == oid


def test_only_the_first_table_marker_counts(spark):
    text = "table: x and table: 5 and so on, more than fifty bytes in all"
    assert one(spark, ct.table_oid(F.col("t")), text) == "0"


@pytest.mark.parametrize(
    "text, oid",
    [
        ("Insert(table_id: TableId(" + "1" * 21 + "), ..)", ""),
        ("Insert(table_id: 123x TableId(" + "1" * 21 + "), ..)", "123"),
        ("Insert(TableId(" + "1" * 21 + "), ..)", "1" * 21),
        ("Insert(TableId " + "1" * 21 + "), ..)", "0"),
        ("Insert(TableId(" + "1" * 20 + "), ..)", "1" * 20),
    ],
)
def test_second_search(spark, text, oid):
    t = F.col("t")
    assert one(spark, ct.checked_table_oid(ct.table_oid(t), t), text) == oid


@pytest.mark.parametrize(
    "text, raw",
    [
        ("TableId(16385)", "16385"),
        ("TableId { schema: 1, table: 16385 }", "16385"),
        ('TableId { table: "users" }', ""),
        ("TableId { table: users, x }", "users"),
        ("table: users ", "users"),
        ("table: users", "users"),
        ('{ "a" (b) } TableIdTableId', "ab"),
    ],
)
def test_raw_table_id(spark, text, raw):
    assert one(spark, ct.raw_table_id(F.col("t")), text) == raw


@pytest.mark.parametrize(
    "text, values",
    [
        ("x values: [a, b] }", "a, b"),
        ("x values: [] values: [c]", ""),
        ("x values: [a] b]", "a"),
        ("x values: [a\nb]", "a\nb"),
        ("x values: [a", None),
        ("x] values: a", None),
    ],
)
def test_value_list(spark, text, values):
    assert one(spark, ct.value_list(F.col("t")), text) == values


@pytest.mark.parametrize(
    "text, body",
    [
        ('TableRow { values: [I32(1), String("x")] }', 'values: [I32(1), String("x"'),
        ("TableRowTableRow(I32(1), Null)", "I32(1), Null"),
        ("x TableRow", "x TableRow"),
        ("TableRow", ""),
    ],
)
def test_row_list(spark, text, body):
    assert one(spark, ct.row_list(F.col("t")), text) == body


def test_split_keeps_empty_ends(spark):
    t = F.col("t")
    assert one(spark, ct.split_cells(t), "") == [""]
    assert one(spark, ct.split_cells(t), ", a, ") == ["", "a", ""]
