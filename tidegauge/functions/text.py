"""Text helpers: labels, sentinels, number formats, tokens."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge import rules
from tidegauge.functions import as_col

# --- fixed values: camel-case word pattern and binary size units ------------
CAMEL_PATTERN = "[A-Z](?:[a-z]+|[A-Z]*(?=[A-Z]|$))"
SIZE_UNITS = ("KiB", "MiB", "GiB", "TiB", "PiB", "EiB")


def _from(text: Column, position: int) -> Column:
    return F.substr(text, F.lit(position))


def sentence_case(text: str | Column) -> Column:
    """First letter upper, the rest lower (not per word)."""
    text = as_col(text)
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(_from(text, 2)))


def normalise_network(
    name: str | Column, aliases: dict[str, str] = rules.NETWORK_ALIASES
) -> Column:
    """Known short names become the canonical network id; others stay."""
    name = as_col(name)
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(aliases.items())])
    return F.coalesce(F.try_element_at(table, name), name)


def null_if_any(text: str | Column, sentinels: tuple[str, ...]) -> Column:
    """Null when the whole text is one of the sentinel words."""
    text = as_col(text)
    return F.when(~text.isin(*sentinels), text)


def with_commas(number: str | Column) -> Column:
    return F.format_number(as_col(number), 0)


def _tenths(size: Column, unit: int) -> Column:
    """size * 10 / unit as a whole number, exact ties to even."""
    scaled = (size * 10).cast("decimal(25,0)")
    rest = scaled % unit
    low = ((scaled - rest) / unit).cast("decimal(25,0)")
    up = (rest * 2 > unit) | ((rest * 2 == unit) & (low % 2 == 1))
    return (low + up.cast("int")).cast("decimal(25,0)")


def binary_size(size: str | Column) -> Column:
    """`1.5 MiB` style text of a whole number of bytes.

    The one decimal is worked out on integers, so it does not depend on how an
    engine formats floating-point ties.
    """
    size = as_col(size).cast("decimal(20,0)")
    magnitude = F.abs(size)
    text = F.when(magnitude == 1, F.lit("1 Byte")).when(
        magnitude < 1024, F.concat(magnitude.cast("string"), F.lit(" Bytes"))
    )
    for power, unit in enumerate(SIZE_UNITS, start=1):
        tenths = _tenths(magnitude, 1024**power)
        shown = F.concat(
            ((tenths - tenths % 10) / 10).cast("decimal(25,0)").cast("string"),
            F.lit("."),
            (tenths % 10).cast("decimal(1,0)").cast("string"),
            F.lit(f" {unit}"),
        )
        if power == len(SIZE_UNITS):
            text = text.otherwise(shown)
        else:
            text = text.when(magnitude < 1024 ** (power + 1), shown)
    return F.concat(F.when(size < 0, "-").otherwise(""), text)


def camel_tokens(word: str | Column) -> Column:
    """Lower-case words of a camelCase text, as an array."""
    word = as_col(word)
    capital = F.concat(F.upper(F.substring(word, 1, 1)), _from(word, 2))
    return F.transform(F.regexp_extract_all(capital, F.lit(CAMEL_PATTERN), F.lit(0)), F.lower)
