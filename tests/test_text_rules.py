"""The text rules against plain Python, on generated records."""

import re
import unicodedata

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rowharbor.functions import change_text as ct

PIECES = st.sampled_from(
    ["table:", "TableId", "TableId(", "table_id: ", "values: [", "]", "[", "(", ")",
     "{", "}", '"', ",", ", ", " ", "\n", "\t", "insert", "Update", "DELETE", "Begin",
     "TableRow", "x", "é", "²", "7", "16384", "1" * 21, "Null", "type", " "]
)
TEXTS = st.lists(
    st.lists(PIECES, max_size=9).map("".join), min_size=60, max_size=120
)
LIMITS = settings(
    max_examples=10,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


def numeric(c):
    return unicodedata.category(c) in ("Nd", "Nl", "No")


def run_of_digits(text, skip=lambda c: False):
    i = 0
    while i < len(text) and skip(text[i]):
        i += 1
    j = i
    while j < len(text) and numeric(text[j]):
        j += 1
    return text[i:j]


def plain_oid(text):
    if "table:" in text:
        found = run_of_digits(text.split("table:", 1)[1], str.isspace)
        if found:
            return found
    if "TableId" in text:
        found = run_of_digits(text.split("TableId", 1)[1], lambda c: not numeric(c))
        if found:
            return found
    if len(text.encode()) < 50:
        found = "".join(c for c in text if numeric(c))
        if found:
            return found
    return "0"


def plain_change_oid(text):
    oid = plain_oid(text)
    if len(oid.encode()) <= 20:
        return oid
    for marker in ("table_id: ", "TableId("):
        if marker in text:
            return run_of_digits(text.split(marker, 1)[1])
    return "0"


def plain_raw_id(text):
    if "table:" in text:
        return re.split('[,}"]', text.split("table:", 1)[1])[0].strip()
    return re.sub('[(){}" ]', "", text).replace("TableId", "")


def plain_values(text):
    rest = text.partition("values: [")[2]
    return rest.split("]")[0] if "]" in rest else None


def plain_row(text):
    while text.startswith("TableRow"):
        text = text[len("TableRow") :]
    return text.strip(" ()[]{}")


def plain_op(text):
    low = text.lower()
    if low.startswith(("relation", "begin", "commit", "type")):
        return None
    for word, op in (("insert", "c"), ("update", "u"), ("delete", "d")):
        if word in low:
            return op
    return None


@LIMITS
@given(TEXTS)
def test_rules(spark, texts):
    t = F.col("t")
    op = F.when(~ct.is_control(t) & ct.has_operation(t), ct.op_code(F.lower(t)))
    got = (
        spark.createDataFrame(list(enumerate(texts)), "n int, t string")
        .select(
            "n",
            op.alias("op"),
            ct.checked_table_oid(ct.table_oid(t), t),
            ct.raw_table_id(t),
            ct.value_list(t),
            ct.row_list(t),
            ct.split_cells(t),
        )
        .orderBy("n")
        .collect()
    )
    for text, row in zip(texts, got, strict=True):
        want = (
            plain_op(text),
            plain_change_oid(text),
            plain_raw_id(text),
            plain_values(text),
            plain_row(text),
            text.split(", "),
        )
        assert tuple(row)[1:] == want, repr(text)
