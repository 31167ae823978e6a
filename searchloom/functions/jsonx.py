"""Typed reads from JSON text through VARIANT.

Casting a variant converts between types ("1" becomes 1), so every getter first
asks for the stored type and answers null when it is another one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTEGER_TEXT = r"^[+-]?[0-9]+$"


def fields_of(v: Column, names: list[str]) -> Column:
    """The named fields of a JSON object as struct<variant...>; null for any other type.

    An absent field is null, a JSON null is a variant null. Reading an object once and
    working on the struct is much cheaper than one path lookup per use.
    """
    return F.try_variant_get(v, "$", "struct<" + ",".join(f"`{n}`:variant" for n in names) + ">")


def with_json_object(
    df: DataFrame, text: str, out: str, names: list[str], allow_empty: bool = False
) -> DataFrame:
    """Add ``out``: the ``names`` fields of ``text`` if it is exactly one JSON object, else null.

    The parser ignores what follows the first value. Wrapping the text in ``[...]``
    makes leftovers a syntax error or a second element, unless the text closes the
    bracket itself; only texts with a ``]`` therefore pay for a second parse.
    """
    col = F.col(text)
    wrapped = F.try_parse_json(F.concat(F.lit("["), col, F.lit("]")))
    in_braces = F.try_parse_json(F.concat(F.lit('{"p":'), col, F.lit("}")))
    shape = col.rlike(r"^[ \t\r\n]*\{") if allow_empty else col.rlike(r"^[ \t\r\n]*\{[ \t\r\n]*[^} \t\r\n]")
    whole = (
        shape
        & F.try_variant_get("_wrapped", "$[1]", "variant").isNull()
        & (~F.contains(col, F.lit("]")) | in_braces.isNotNull())
    )
    struct = "struct<" + ",".join(f"`{n}`:variant" for n in names) + ">"
    return (
        df.withColumn("_wrapped", wrapped)
        .withColumn(out, F.when(whole, F.try_variant_get("_wrapped", "$[0]", struct)))
        .drop("_wrapped")
    )


def kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def string_of(v: Column) -> Column:
    """A JSON string as it is; any other type is null."""
    return F.when(kind(v) == "STRING", F.try_variant_get(v, "$", "string"))


def integer_of(v: Column) -> Column:
    """An integer literal within 64 bits; 1.0, 1e2 and "1" are null."""
    return F.when(kind(v) == "BIGINT", F.try_variant_get(v, "$", "bigint"))


def integer_or_text_of(v: Column) -> Column:
    """An integer literal, or a string of digits."""
    text = F.try_variant_get(v, "$", "string")
    return F.when((kind(v) == "BIGINT") | ((kind(v) == "STRING") & text.rlike(INTEGER_TEXT)), text.try_cast("bigint"))


def truncated_number_of(v: Column) -> Column:
    """Any JSON number cut towards zero; null for other types."""
    number = kind(v).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return F.when(number, F.try_variant_get(v, "$", "double").try_cast("bigint"))


def array_of(v: Column) -> Column:
    """A JSON array as array<variant>; null for absent, null and other types."""
    return F.try_variant_get(v, "$", "array<variant>")


def clamp_int32(n: Column) -> Column:
    """Outside 0..2^31-1 counts as zero, and zero is left out."""
    return F.when(n.between(1, 2147483647), n.cast("int"))


def zero_as_null(n: Column) -> Column:
    return F.when(n != 0, n)


def empty_as_null(text: Column) -> Column:
    return F.when(text != "", text)


def integer_text(text: Column) -> Column:
    """A base-10 64-bit integer text as a number; blanks around it are not accepted."""
    return F.when(text.rlike(INTEGER_TEXT), text.try_cast("bigint"))
