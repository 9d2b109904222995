"""Text, encoding and coercion expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

REPLACEMENT_CHARACTER = "�"

# Characters removed when a file name is stripped.
WHITESPACE = " \t\n\r\x0b\x0c"

# Spellings read as booleans.
TRUE_WORDS = ("true", "t", "yes", "y", "1")
FALSE_WORDS = ("false", "f", "no", "n", "0")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_base64(c: Column | str) -> Column:
    """Base64 text to UTF-8 text; null when the input is not base64."""
    return F.try_to_binary(col(c), F.lit("base64")).cast("string")


def encode_base64(c: Column | str) -> Column:
    """UTF-8 text to one line of base64."""
    return F.regexp_replace(F.base64(col(c).cast("binary")), "[\r\n]", "")


def with_newline(c: Column | str) -> Column:
    return F.concat(col(c), F.lit("\n"))


def trim_blanks(c: Column | str) -> Column:
    """Drop trailing blanks."""
    return F.rtrim(col(c))


def replace_invalid(c: Column | str, by: str = " ") -> Column:
    """Every character that was not valid UTF-8 becomes ``by``."""
    return F.translate(F.make_valid_utf8(col(c)), REPLACEMENT_CHARACTER, by)


def truncate(c: Column | str, width: int, mode: str = "chars") -> Column:
    """Cut to ``width`` characters, or to ``width`` bytes without splitting a character."""
    text = col(c)
    if mode == "chars":
        return F.substring(text, 1, width)
    if mode != "bytes":
        raise ValueError(f"unknown width mode: {mode}")
    raw = text.cast("binary")

    def starts_character(position: int) -> Column:
        return ~F.hex(F.substring(raw, position, 1)).between("80", "BF")

    cut = F.when(F.octet_length(text) <= width, text)
    for back in range(4):
        if width - back >= 0:
            kept = F.substring(raw, 1, width - back).cast("string")
            cut = cut.when(starts_character(width - back + 1), kept)
    return cut


def blank(c: Column | str) -> Column:
    """True for null and for the empty string."""
    return F.coalesce(F.length(col(c)), F.lit(0)) == 0


def fill_template(template: Column | str, values: Mapping[str, Column | str]) -> Column:
    """Replace each ``{name}`` by its value; a null value leaves an empty place.

    The template is cut at its placeholders first, so a value that itself holds
    ``{name}`` is never filled a second time.
    """
    if isinstance(template, str):
        pieces: list[Column] = []
        rest = template
        while rest:
            hits = [(rest.find("{" + k + "}"), k) for k in values if "{" + k + "}" in rest]
            if not hits:
                pieces.append(F.lit(rest))
                break
            at, name = min(hits)
            if at:
                pieces.append(F.lit(rest[:at]))
            value = values[name]
            value = value if isinstance(value, Column) else F.lit(value)
            pieces.append(F.coalesce(value.cast("string"), F.lit("")))
            rest = rest[at + len(name) + 2:]
        return F.concat(*pieces) if pieces else F.lit("")
    filled = template
    for name, value in values.items():
        value = value if isinstance(value, Column) else F.lit(value)
        filled = F.replace(filled, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return filled


def label(c: Column | str) -> Column:
    """Upper case with underscores shown as spaces."""
    return F.upper(F.replace(col(c), F.lit("_"), F.lit(" ")))


def as_text(c: Column | str) -> Column:
    return col(c).cast("string")


def as_boolean(c: Column | str) -> Column:
    """Read the words of a boolean; anything else is null."""
    word = F.lower(F.trim(col(c).cast("string")))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def number_text(c: Column | str) -> Column:
    """A double as its shortest decimal text: plain from 0.0001 up to below 1e16.

    Outside that range the exponent has a sign and two digits at least: ``1e+16``.
    """
    value = col(c)
    size = F.abs(value)
    spark_text = value.cast("string")
    digits = F.rtrim(value.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(F.endswith(digits, F.lit(".")), F.concat(digits, F.lit("0"))).otherwise(digits)
    mantissa = F.regexp_replace(F.split_part(spark_text, F.lit("E"), F.lit(1)), r"\.0$", "")
    power = F.split_part(spark_text, F.lit("E"), F.lit(2))
    sign = F.when(F.startswith(power, F.lit("-")), "-").otherwise("+")
    exponent = F.ltrim(power, F.lit("-"))
    padded = F.when(F.length(exponent) < 2, F.concat(F.lit("0"), exponent)).otherwise(exponent)
    scientific = F.concat(mantissa, F.lit("e"), sign, padded)
    in_range = (size >= 1e-4) & (size < 1e16)
    return F.when(~F.contains(spark_text, F.lit("E")), spark_text).when(in_range, plain).otherwise(scientific)


def random_id() -> Column:
    return F.uuid()


def escape_html(c: Column | str) -> Column:
    escaped = col(c)
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(safe))
    return escaped


def hyperlink(c: Column | str) -> Column:
    """An anchor that opens the address in a new tab."""
    return F.concat(F.lit('<a target="_blank" href="'), escape_html(c), F.lit('">LINK</a>'))
