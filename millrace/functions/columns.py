"""Column expressions. All are native Spark expressions, so they stay inside code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_MATCH = -1
IGNORED_TOKEN = -100


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh_name(columns: Sequence[str], name: str) -> str:
    """A name that no column has, in any case of its letters: the given one, with underscores before it if need be."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating column (a data frame library sees both as missing)."""
    c = quoted(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def null_if(c: Column | str, sentinel: str) -> Column:
    """NULL where the text equals the sentinel exactly (no trimming)."""
    return F.nullif(_col(c), F.lit(sentinel))


def to_type(c: Column | str, type_name: str, strict: bool = False) -> Column:
    """Cast; bad text becomes NULL, or fails the query when ``strict``."""
    return _col(c).cast(type_name) if strict else _col(c).try_cast(type_name)


def map_value(c: Column | str, mapping: Mapping) -> Column:
    """Look a value up in a small dictionary; values outside it become NULL."""
    c = _col(c)
    items = list(mapping.items())
    if not items:
        return F.lit(None)
    (first_key, first_value), rest = items[0], items[1:]
    start = F.when(c == F.lit(first_key), F.lit(first_value))
    return reduce(lambda acc, kv: acc.when(c == F.lit(kv[0]), F.lit(kv[1])), rest, start)


def threshold_label(c: Column | str, at_least: float, type_name: str = "int") -> Column:
    """Boolean label: the value, read as ``type_name``, reaches the threshold."""
    return _col(c).try_cast(type_name) >= F.lit(at_least)


def positive_score(probability: Column | str = "probability") -> Column:
    """Probability of class 1 from a probability vector column."""
    return F.get(vector_to_array(_col(probability)), F.lit(1))


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """Seeded 32-digit md5 of the columns' text; sorting by it is a reproducible shuffle.

    Different rows have different texts: bars and backslashes inside a value are escaped, and NULL is a
    bare ``\\N``.
    """
    parts = [value_text(quoted(c)) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def value_text(c: Column) -> Column:
    """A value as text that has no bare bar, and that differs from NULL's."""
    text = F.replace(F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
    return F.coalesce(text, F.lit("\\N"))


# ---- class names -------------------------------------------------------------------------------


def _names_array(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def id_to_name(c: Column | str, names: Sequence[str], on_unknown: str = "error") -> Column:
    """Class name at a 0-based position of the ordered list."""
    c = _col(c)
    found = F.get(_names_array(names), c.cast("int"))
    if on_unknown == "null":
        return found
    message = F.concat(F.lit("class id outside the list: "), c.cast("string"))
    return F.when(c.isNull() | found.isNotNull(), found).otherwise(F.raise_error(message))


def _position(c: Column, names: Sequence[str]) -> Column:
    """0-based position, NULL when the name is not in the list."""
    at = F.array_position(_names_array(names), c)
    return F.when(at > 0, (at - 1).cast("int"))


def name_to_id(c: Column | str, names: Sequence[str], on_unknown: str = "error") -> Column:
    """Class id of a name. Tried in turn: the text as it is, the trimmed text, the text as an id.

    ``on_unknown``: ``"error"`` fails the query, ``"no_match"`` gives -1.
    """
    c = _col(c)
    as_id = F.trim(c).try_cast("int")
    found = F.coalesce(
        _position(c, names),
        _position(F.trim(c), names),
        F.when(as_id.between(NO_MATCH, len(names) - 1), as_id),
    )
    if on_unknown == "no_match":
        return F.coalesce(found, F.lit(NO_MATCH))
    message = F.concat(F.lit("unknown class name: "), c)
    return F.when(c.isNull() | found.isNotNull(), found).otherwise(F.raise_error(message))


def alt_label(c: Column | str) -> Column:
    """``X: t`` spelled ``(X) t``."""
    return F.concat(F.lit("("), F.replace(_col(c), F.lit(": "), F.lit(") ")))


def parse_response(c: Column | str, names: Sequence[str], full_match: bool = False) -> Column:
    """Class id named in a free-text response.

    By default the first name in list order whose usual or alternative spelling occurs anywhere in
    the text, or -1. With ``full_match`` the whole text must be a class name; others fail.
    """
    c = _col(c)
    if full_match:
        return name_to_id(c, names)
    hits = [
        F.when(c.contains(F.lit(n)) | c.contains(alt_label(F.lit(n))), F.lit(i))
        for i, n in enumerate(names)
    ]
    return F.coalesce(*hits, F.lit(NO_MATCH))


def choice_prompt(question: str, names: Sequence[str]) -> Column:
    """Question followed by one option per line (folds to a literal)."""
    return F.concat(F.lit(question), F.lit("\n"), F.array_join(_names_array(names), "\n"))


def mask_labels(c: Column | str, masked_ids: Sequence[int], fill: int = IGNORED_TOKEN) -> Column:
    """Copy of a token array in which the given ids are replaced by the ignored value."""
    ids = list(masked_ids)
    return F.transform(_col(c), lambda x: F.when(x.isin(ids), F.lit(fill)).otherwise(x))
