"""Text repair and name cleaning, all as native column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# One token is an escape sequence or a run of plain text. A backslash that
# starts none of the known escapes comes out alone or with the next character.
_TOKEN = (r"(?s)\\[0-7]{1,3}|\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}"
          r"|\\.|\\|[^\\]+")

# Single-character escapes and the character each one stands for.
_SIMPLE = {
    "\\a": "\a", "\\b": "\b", "\\f": "\f", "\\n": "\n", "\\r": "\r", "\\t": "\t",
    "\\v": "\v", "\\\\": "\\", "\\'": "'", '\\"': '"', "\\\n": "",
}

_NOT_LATIN1 = r"[^\u0000-\u00FF]"
_NOT_ASCII = r"[^\u0000-\u007F]"
# Stands for an escape that is no single byte. It is not Latin-1 itself, so one
# check of the joined text finds it.
_BROKEN = "\uFFFF"


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def _byte(digits: Column, base: int) -> Column:
    """The character of a byte value, or the mark of a broken escape above 255."""
    code = F.conv(digits, base, 10).cast("bigint")
    return _bind(code, lambda n: F.when(n < 256, F.chr(n)).otherwise(_BROKEN))


def _decode_token(token: Column) -> Column:
    kind = F.substring(token, 2, 1)
    value = (
        F.when(~token.startswith("\\"), token)
        .when(kind.between("0", "7"), _byte(F.substr(token, F.lit(2)), 8))
        .when(kind.isin("x", "u", "U") & (F.length(token) > 2),
              _byte(F.substr(token, F.lit(3)), 16))
        # Cut off, named, or a backslash at the very end.
        .when(kind.isin("x", "u", "U", "N", ""), _BROKEN)
    )
    for escape, char in _SIMPLE.items():
        value = value.when(token == escape, F.lit(char))
    return value.otherwise(token)


def _from_bytes(chars: Column) -> Column:
    """Characters up to U+00FF taken as bytes of UTF-8 text; NULL when they are not."""
    text = F.try_validate_utf8(F.encode(chars, "ISO-8859-1").cast("string"))
    return F.when(~chars.rlike(_NOT_LATIN1), F.trim(text, F.lit('"')))


def decode_text(col: Column | str) -> Column:
    """Undo backslash escapes, read the bytes as UTF-8, strip outer double quotes.

    ``Bj\\303\\266rk`` becomes ``Björk``. NULL and empty text pass through. Text
    that cannot be decoded (a character above U+00FF, a broken escape, bytes
    that are not UTF-8) comes back unchanged, so one bad row cannot stop a stream.
    """
    c = F.col(col) if isinstance(col, str) else col
    tokens = F.regexp_extract_all(c, F.lit(_TOKEN), F.lit(0))
    chars = F.array_join(F.transform(tokens, _decode_token), "")
    return (
        # Plain ASCII without escapes, nearly every value, needs no tokens.
        F.when(~c.contains("\\") & ~c.rlike(_NOT_ASCII), F.trim(c, F.lit('"')))
        .when(c.rlike(_NOT_LATIN1), c)
        .otherwise(F.coalesce(_bind(chars, _from_bytes), c))
    )


def _escape_run(run: Column) -> Column:
    pairs = F.regexp_extract_all(F.hex(F.encode(run, "UTF-8")), F.lit(".."), F.lit(0))
    octal = F.transform(pairs, lambda p: F.concat(F.lit("\\"), F.lpad(F.conv(p, 16, 8), 3, "0")))
    return (F.when(run.startswith("\\"), F.concat(run, run))
            .when(run.rlike(_NOT_ASCII), F.array_join(octal, ""))
            .otherwise(run))


def escape_text(col: Column | str) -> Column:
    """Inverse of :func:`decode_text`: UTF-8 bytes above 7F as octal, backslash doubled."""
    c = F.col(col) if isinstance(col, str) else col
    runs = F.regexp_extract_all(
        c, F.lit(r"\\+|[\u0000-\u007F&&[^\\]]+|[^\u0000-\u007F]+"), F.lit(0))
    plain = ~c.contains("\\") & ~c.rlike(_NOT_ASCII)
    return F.when(plain, c).otherwise(F.array_join(F.transform(runs, _escape_run), ""))


def clean_name(col: Column | str) -> Column:
    """Artist name without double quotes and backslashes."""
    c = F.col(col) if isinstance(col, str) else col
    return F.translate(c, '"\\', "")
