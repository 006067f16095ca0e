"""CSV records of whole pages with column expressions (S10): no reader schema, each page against its own header.

A page is reduced to its structure: every field that isn't empty becomes ``x``, so only ``x``,
commas and line ends are left, and a line end inside quotes is gone with its field. The
pieces between line ends are the records, their commas the widths.

Quoting follows the usual dialect: a quote opens a field only at its start, a doubled quote
inside is a quote, text after the closing quote belongs to the field, and a quote inside an
unquoted field is an ordinary character. Lines end with LF, CRLF or CR; a blank line is a
record without fields.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# All repetitions are possessive: Java matches them in a loop, whatever the length of a field.
_FIELD = r'(?:"(?:[^"]|"")*+"?+[^,\r\n]*+|[^,\r\n"][^,\r\n]*+)'
_FIRST_RECORD = rf"\A(?:{_FIELD}|,)*+"
_LINE_END = r"\r\n|\r|\n"


def text_of(content: Column) -> Column:
    """The page as text without byte order mark; null where the bytes aren't UTF-8."""
    return F.regexp_replace(F.try_validate_utf8(content.cast("string")), "\\A\ufeff", "")


def header_fields(text: Column) -> Column:
    """The fields of the first record, unquoted."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), F.regexp_extract(text, _FIRST_RECORD, 0)), F.lit(rf",({_FIELD}?)"), F.lit(1))

    def unquoted(field: Column) -> Column:
        inner = F.regexp_extract(field, r'(?s)\A"((?:[^"]|"")*+)"?+(.*)\z', 1)
        rest = F.regexp_extract(field, r'(?s)\A"((?:[^"]|"")*+)"?+(.*)\z', 2)
        return F.when(F.startswith(field, F.lit('"')), F.concat(F.replace(inner, F.lit('""'), F.lit('"')), rest)).otherwise(field)

    return F.transform(raw, unquoted)


def record_counts(text: Column) -> Column:
    """Struct of the records after the header: ``rows``, ``malformed_rows`` (another width than
    the header's) and ``blank_rows`` (of the right width, every field empty)."""
    pieces = F.split(F.regexp_replace(text, _FIELD, "x"), _LINE_END, -1)

    def width(piece: Column) -> Column:
        return F.when(piece == "", 0).otherwise(F.length(F.translate(piece, "x", "")) + 1)

    def counts(p: Column) -> Column:
        # what follows the last line end is a record only if there is something
        n = F.size(p) - F.when(F.element_at(p, -1) == "", 1).otherwise(0)
        records = F.slice(p, 2, F.greatest(n - 1, F.lit(0)))
        expected = width(F.element_at(p, 1))
        fits = lambda r: width(r) == expected
        return F.struct(
            F.size(records).cast("long").alias("rows"),
            F.size(F.filter(records, lambda r: ~fits(r))).cast("long").alias("malformed_rows"),
            F.size(F.filter(records, lambda r: fits(r) & ~F.contains(r, F.lit("x")))).cast("long").alias("blank_rows"))

    return F.transform(F.array(pieces), counts)[0]  # one evaluation for all three
