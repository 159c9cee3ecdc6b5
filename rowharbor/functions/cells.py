"""Cells to variants, and cells to a named payload."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What reads as a number, and how an unnamed cell is called.
INTEGER_PATTERN = r"\A[+-]?[0-9]+\z"
FLOAT_PATTERN = r"\A[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\z"
NON_FINITE_PATTERN = r"(?i)\A[+-]?(inf|infinity|nan)\z"
LONGEST_NON_FINITE = len("+infinity")
UNNAMED_PREFIX = "col_"
UNNAMED_PATTERN = r"\Acol_[0-9]+\z"
# A float without exponent and of at most this many digits is always finite.
PLAIN_FLOAT_PATTERN = r"\A[+-]?([0-9]{1,300}[.]?[0-9]*|[.][0-9]+)\z"


def _inside(token: Column) -> Column:
    """What follows the first parenthesis, without the closing ones; null when
    the token has no parenthesis."""
    at = F.instr(token, "(")
    return F.when(at > 0, F.rtrim(F.substr(token, at + F.lit(1)), F.lit(")")))


def _variant(token: Column, text: Column) -> Column:
    """Variant of a token whose inside is ``text``. Most cells are told apart by
    their first character; the patterns stand before the casts because a cast
    also takes '12 ' and '1d', and because a failing one is slow."""
    number = text.try_cast("double")
    finite = F.when(F.abs(number) < F.lit(float("inf")), number).cast("variant")
    whole = text.try_cast("bigint").cast("variant")
    unquoted = F.trim(text, F.lit('"')).cast("variant")
    # Signs, the point and the digits lie between these two characters.
    maybe_number = (text >= "+") & (text < ":")
    non_finite = (F.octet_length(text) <= LONGEST_NON_FINITE) & text.rlike(
        NON_FINITE_PATTERN
    )
    return (
        F.when(text.isNull(), token.cast("variant"))
        .when(text.startswith('"'), unquoted)
        .when(
            maybe_number & text.rlike(INTEGER_PATTERN), F.coalesce(whole, finite)
        )
        .when(maybe_number & text.rlike(PLAIN_FLOAT_PATTERN), number.cast("variant"))
        .when(maybe_number & text.rlike(FLOAT_PATTERN), finite)
        .when(non_finite, F.lit(None).cast("variant"))
        .otherwise(unquoted)
    )


def decode_cell(token: Column) -> Column:
    """Variant of one printed cell such as ``I64(7)`` or ``String("x")``:
    integer, float, string, or null for a non-finite float."""
    return _variant(token, _inside(token))


def decode_cells(tokens: Column) -> Column:
    """``decode_cell`` over an array of tokens. ``tokens`` is read twice, so it
    should be a column rather than an expression."""
    return F.zip_with(tokens, F.transform(tokens, _inside), _variant)


def cell_names(cells: Column, names: Column) -> Column:
    """Name of each cell by position: the column's name, else ``col_<i>``.
    Columns without a cell get no name; ``names`` may be null."""
    wanted = F.size(cells)
    known = F.when(names.isNotNull(), F.size(names)).otherwise(F.lit(0))
    unnamed = F.transform(
        F.sequence(known, wanted - 1), lambda i: F.concat(F.lit(UNNAMED_PREFIX), i)
    )
    return (
        F.when(wanted == 0, F.array().cast("array<string>"))
        .when(known == wanted, names)
        .when(known > wanted, F.slice(names, F.lit(1), wanted))
        .when(known == 0, unnamed)
        .otherwise(F.concat(names, unnamed))
    )


def ambiguous_names(names: Column) -> Column:
    """True when two cells of one row could get the same name."""
    return (F.size(F.array_distinct(names)) < F.size(names)) | F.exists(
        names, lambda n: n.rlike(UNNAMED_PATTERN)
    )


def payload_object(cells: Column, keys: Column, ambiguous: Column) -> Column:
    """Payload of a row's cells and their names; of two cells with one name, the
    last wins. ``ambiguous`` is known once per table, so only rows of such
    tables pay for the search."""
    pairs = F.arrays_zip(keys.alias("name"), cells.alias("cell"))
    last = F.filter(
        pairs,
        lambda pair, i: F.array_position(
            F.slice(keys, i + 2, F.size(keys)), pair["name"]
        )
        == 0,
    )
    payload = F.when(
        F.coalesce(ambiguous, F.lit(False)), F.map_from_entries(last)
    ).otherwise(F.map_from_arrays(keys, cells))
    return F.to_variant_object(payload)
