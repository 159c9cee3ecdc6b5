"""Reading change records and table ids that arrive as printed text.

The rules here are searches in text, not a grammar: the operation is found
anywhere in the record, the table id by its first marker, the value list up to
the first closing bracket. They are kept as they are so that a text change log
lands with the same result everywhere. Typed change logs need none of this.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Markers searched in the text, operation codes, length limits.
CONTROL_PREFIXES = ("relation", "begin", "commit", "type")
OPERATIONS = (("insert", "c"), ("update", "u"), ("delete", "d"))
TABLE_MARKER = "table:"
TABLE_ID_MARKER = "TableId"
TABLE_ID_FIELD = "table_id: "
TABLE_ID_OPEN = "TableId("
VALUES_MARKER = "values: ["
VALUES_END = "]"
CELL_SEPARATOR = ", "
ROW_MARKER = "TableRow"
ROW_EDGE_CHARACTERS = " ()[]{}"
TABLE_ID_PUNCTUATION = '(){}" '
MAX_TABLE_ID_BYTES = 20
SHORT_TEXT_BYTES = 50
NO_TABLE_ID = "0"


def is_control(text: Column) -> Column:
    """True for records that describe the stream rather than a row."""
    return text.rlike(rf"(?i)\A(?:{'|'.join(CONTROL_PREFIXES)})")


def has_operation(text: Column) -> Column:
    """True where ``op_code`` finds a code; meant for filters, where it costs one
    pass over the text instead of one lower-cased copy per word."""
    return text.rlike(f"(?i){'|'.join(word for word, _ in OPERATIONS)}")


def op_code(lowered: Column) -> Column:
    """``c``, ``u`` or ``d`` by the first word of that order found anywhere in
    the lower-cased record, values included; null when none is there."""
    code = F.lit(None).cast("string")
    for word, op in reversed(OPERATIONS):
        code = F.when(lowered.contains(word), F.lit(op)).otherwise(code)
    return code


def _after(text: Column, marker: str) -> Column:
    """Text behind the first ``marker``; null when there is none."""
    at = F.instr(text, marker)
    return F.when(at > 0, F.substr(text, at + F.lit(len(marker))))


def _first(text: Column, pattern: str) -> Column:
    """First group of an anchored pattern; null when it does not match."""
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), 0)


def raw_table_id(table_id: Column) -> Column:
    """Id a snapshot's table is looked up by: what follows ``table:`` up to a
    comma, brace or quote, else the text without punctuation and type name."""
    named = F.regexp_extract(_after(table_id, TABLE_MARKER), r'\A[^,}"]*', 0)
    named = F.regexp_replace(named, r"\A\p{IsWhite_Space}+|\p{IsWhite_Space}+\z", "")
    bare = F.translate(table_id, TABLE_ID_PUNCTUATION, "")
    return F.coalesce(named, F.replace(bare, F.lit(TABLE_ID_MARKER), F.lit("")))


def table_oid(text: Column) -> Column:
    """Digits of the table id in a record or a printed id, ``0`` if none."""
    all_digits = F.when(
        F.octet_length(text) < SHORT_TEXT_BYTES, F.regexp_replace(text, r"\P{N}+", "")
    )
    return F.coalesce(
        _first(_after(text, TABLE_MARKER), r"\A\p{IsWhite_Space}*(\p{N}+)"),
        _first(_after(text, TABLE_ID_MARKER), r"\A\P{N}*(\p{N}+)"),
        _first(all_digits, r"\A(.+)"),
        F.lit(NO_TABLE_ID),
    )


def checked_table_oid(oid: Column, text: Column) -> Column:
    """``table_oid`` of a change record, searched once more when it has too many
    digits to be an id; that search may end in '', which maps to no table."""
    second = F.coalesce(
        F.regexp_extract(_after(text, TABLE_ID_FIELD), r"\A\p{N}*", 0),
        F.regexp_extract(_after(text, TABLE_ID_OPEN), r"\A\p{N}*", 0),
        F.lit(NO_TABLE_ID),
    )
    return F.when(F.octet_length(oid) > MAX_TABLE_ID_BYTES, second).otherwise(oid)


def value_list(text: Column) -> Column:
    """Cells of a change record as one string, null when no list is found. The
    list ends at the first closing bracket, even one inside a cell."""
    at = F.instr(text, VALUES_MARKER)
    start = at + F.lit(len(VALUES_MARKER))
    end = F.position(F.lit(VALUES_END), text, start)
    return F.when((at > 0) & (end > 0), F.substr(text, start, end - start))


def row_list(text: Column) -> Column:
    """Cells of a printed snapshot row as one string."""
    body = F.regexp_replace(text, rf"\A(?:{ROW_MARKER})+", "")
    return F.trim(body, F.lit(ROW_EDGE_CHARACTERS))


def split_cells(cells: Column) -> Column:
    """One token per cell; a separator inside a cell splits it too."""
    return F.split(cells, CELL_SEPARATOR)
