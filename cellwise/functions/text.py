"""Column expressions over delimited number text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that trimming removes (everything up to the space).
BLANKS = "".join(map(chr, range(0x21)))

# Characters without width or with invisible effect that pasted text carries.
INVISIBLE = "\ufeff\u200b\u2060\u00a0\u202a\u202b\u202c\u202d\u202e"


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def tokens(line: Column) -> Column:
    """Comma-separated tokens; empty tokens at the end of the line do not count."""
    kept = F.rtrim(line, F.lit(","))
    only_commas = (kept == "") & (line != "")
    return F.when(only_commas, F.array().cast("array<string>")).otherwise(F.split(kept, ","))


def filled_tokens(line: Column) -> Column:
    """Trimmed tokens without the blank ones."""
    return F.filter(F.transform(tokens(line), trimmed), lambda t: t != "")


def number(token: Column) -> Column:
    """The token as DOUBLE, or NULL when it is no number.

    Spark also reads ``nan`` and ``inf`` in any case; only ``NaN`` and ``Infinity``
    spelled so count here.
    """
    # Only these words hold an n, so plain digits skip the pattern.
    exact = trimmed(token).rlike("^[+-]?(NaN|Infinity)$")
    return F.when(~F.lower(token).contains("n") | exact, token.try_cast("double"))


def is_numeric_line(line: Column) -> Column:
    """At least one number, and nothing but numbers and blank tokens."""
    filled = filled_tokens(line)
    return (F.size(filled) > 0) & F.forall(filled, lambda t: number(t).isNotNull())


def scrub_invisible(text: Column) -> Column:
    return F.translate(text, INVISIBLE, "")


def normalized_line(line: Column) -> Column:
    """Invisible characters out, ends trimmed, runs of whitespace become one comma."""
    return F.regexp_replace(trimmed(scrub_invisible(line)), r"\s+", ",")


def two_decimals(value: Column) -> Column:
    """``value`` to two decimals, halves away from zero, as ROUND gives it.

    ROUND goes through decimal text. A number of middling size whose hundredths are clearly
    on one side of a half needs none: a whole number over 100 is the same double.
    """
    hundredths = F.abs(value) * 100
    whole = F.floor(hundredths + 0.5).cast("double")
    clear = (hundredths < 1e9) & (F.abs(hundredths + 0.5 - F.rint(hundredths + 0.5)) > 1e-5)
    quick = F.when(whole == 0, F.lit(0.0)).when(value < 0, -whole / 100).otherwise(whole / 100)
    return F.when(clear, quick).otherwise(F.round(value, 2))


def clipped(line: Column, width: int = 120) -> Column:
    """Lines longer than ``width`` are cut there and marked with an ellipsis."""
    return F.when(F.length(line) > width, F.concat(F.substring(line, 1, width), F.lit(" …"))).otherwise(line)
