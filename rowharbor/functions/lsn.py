"""Log sequence numbers: ``X/Y`` in hexadecimal, or one decimal number."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: what one step of the part before the slash counts.
HIGH_STEP = 4294967296
LSN_CHARACTERS = "0123456789ABCDEF/abcdef"
LSN_TEXT = r"\A([0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}|[0-9]+)\z"


def _part(lsn: Column, i: int) -> Column:
    return F.split_part(lsn, F.lit("/"), F.lit(i))


def _has_slash(lsn: Column) -> Column:
    return F.instr(lsn, "/") > 0


def lsn_number(lsn: Column) -> Column:
    """Order of an LSN, which text order gets wrong; null when it is none."""
    lsn = F.when(lsn.rlike(LSN_TEXT), lsn)
    high = F.conv(_part(lsn, 1), 16, 10).cast("decimal(20,0)")
    low = F.conv(_part(lsn, 2), 16, 10).cast("decimal(20,0)")
    return F.when(
        _has_slash(lsn), (high * F.lit(HIGH_STEP) + low).cast("decimal(20,0)")
    ).otherwise(lsn.try_cast("decimal(20,0)"))


def lsn_digits(lsn: Column) -> tuple[Column, Column]:
    """Digits before and after the slash; with the number they make the text."""
    slash = _has_slash(lsn)
    return (
        F.length(_part(lsn, 1)),
        F.when(slash, F.length(_part(lsn, 2))).otherwise(F.lit(0)),
    )


def lsn_small_letters(lsn: Column) -> Column:
    """Which characters are small letters, as a number of one bit each, the last
    character lowest."""
    bits = F.translate(F.when(lsn.rlike(LSN_TEXT), lsn), LSN_CHARACTERS, "0" * 17 + "1" * 6)
    return F.coalesce(F.conv(bits, 2, 10).cast("long"), F.lit(0).cast("long"))


def lsn_text(number: Column, high_digits: Column, low_digits: Column, small: Column) -> Column:
    """Text of an LSN as it was given: its number, digits and small letters."""
    high = F.hex(F.floor(number / F.lit(HIGH_STEP)).cast("long"))
    low = F.hex((number % F.lit(HIGH_STEP)).cast("long"))
    zero = F.lit("0")
    text = F.when(
        low_digits > 0,
        F.concat(
            F.lpad(high, high_digits, zero), F.lit("/"), F.lpad(low, low_digits, zero)
        ),
    ).otherwise(F.lpad(number.cast("string"), high_digits, zero))
    size = F.length(text)

    def character(i: Column) -> Column:
        own = F.substring(text, i, F.lit(1))
        is_small = F.call_function("shiftright", small, (size - i).cast("int")).bitwiseAND(F.lit(1)) == 1
        return F.when(is_small, F.lower(own)).otherwise(own)

    lowered = F.array_join(F.transform(F.sequence(F.lit(1), size), character), "")
    return F.when(small == 0, text).otherwise(lowered)
