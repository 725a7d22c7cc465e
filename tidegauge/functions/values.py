"""Sizes, hashes, flags and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge import rules
from tidegauge.functions import as_col

BYTES_PER_MB = 1024 * 1024


def bytes_to_mb(size: str | Column) -> Column:
    """Exact in a double: the divisor is a power of two."""
    return as_col(size) / F.lit(float(BYTES_PER_MB))


def mb_to_bytes(size_mb: str | Column) -> Column:
    return (as_col(size_mb) * BYTES_PER_MB).cast("bigint")


def content_hash(content: str | Column, algorithm: str = "md5") -> Column:
    content = as_col(content)
    if algorithm == "md5":
        return F.md5(content)
    if algorithm == "sha1":
        return F.sha1(content)
    if algorithm in ("sha224", "sha256", "sha384", "sha512"):
        return F.sha2(content, int(algorithm[3:]))
    raise ValueError(f"unsupported hash: {algorithm}")


def nonzero_flag(text: str | Column) -> Column:
    """True for any number but zero; null for text that is no number."""
    return as_col(text).try_cast("double") != 0


def missing_to_null(text: str | Column, tokens: tuple[str, ...] = rules.NA_TOKENS) -> Column:
    text = as_col(text)
    return F.when(~text.isin(*tokens), text)


def nan_to_null(number: str | Column) -> Column:
    number = as_col(number)
    return F.when(~F.isnan(number), number)


def pack_json(columns: list[str], numbers: dict[str, str] | None = None) -> Column:
    """The columns that are not null, as one JSON object.

    `numbers` names columns to be written with a given numeric type instead of as text.
    """
    if not columns:
        return F.lit("{}")
    numbers = numbers or {}

    def field(name: str) -> Column:
        column = F.col(f"`{name}`")
        if name not in numbers:
            return column.alias(name)
        typed = column.try_cast(numbers[name])
        return (nan_to_null(typed) if numbers[name] in ("double", "float") else typed).alias(name)

    return F.to_json(F.struct(*[field(name) for name in columns]))


def pack_map(values: Column, numbers: dict[str, str] | None = None) -> Column:
    """The entries of a text map whose value is not null, as one JSON object ordered by key.

    `numbers` names keys to be written with a given numeric type instead of as text.
    """

    def entry(pair: Column) -> Column:
        written = F.to_json(F.create_map(pair["key"], pair["value"]))
        for name, kind in (numbers or {}).items():
            typed = pair["value"].try_cast(kind)
            typed = nan_to_null(typed) if kind in ("double", "float") else typed
            number = F.when(typed.isNotNull(), F.to_json(F.create_map(pair["key"], typed)))
            written = F.when(pair["key"] == name, number).otherwise(written)
        return F.substring(written, F.lit(2), F.length(written) - 2)

    pairs = F.array_sort(F.map_entries(F.map_filter(values, lambda _, text: text.isNotNull())))
    return F.concat(F.lit("{"), F.array_join(F.transform(pairs, entry), ","), F.lit("}"))


def json_text(json: str | Column, key: str) -> Column:
    """Value of a top-level key as text; null when the key is missing."""
    return F.get_json_object(as_col(json), f"$.{key}")


def tag_contains(json: str | Column, key: str, value: str) -> Column:
    return json_text(json, key).contains(value)
