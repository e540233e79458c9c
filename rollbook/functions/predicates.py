"""Filter documents as one Column.

A document is a conjunction of ``field: condition``. A condition is a value (equality), a
compiled pattern, or operators: ``$eq $ne $gt $gte $lt $lte $in $nin $exists $regex`` (with
``$options``) ``$not``. ``$and $or $nor`` combine documents. A field may be a path into structs
(``record.ip``).

A missing field is null here, and an absent column is null in all rows. Null equals only null,
is neither greater nor less than anything and matches no pattern; whatever a condition does
not match, its negation does, nulls included. Values are compared with fields of their own
kind only (text, number, boolean, time): with another kind nothing is equal or ordered.

Negation is carried down to the comparisons, so the Column has only shapes that a scan can
evaluate itself. Patterns that only look for a beginning, or for a text anywhere, become
``startswith`` and ``contains`` for the same reason. In a filter null counts as false, so
positive comparisons need no test for it.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

_ORDER: dict[str, Callable[[Column, Any], Column]] = {
    "$gt": lambda c, v: c > v,
    "$gte": lambda c, v: c >= v,
    "$lt": lambda c, v: c < v,
    "$lte": lambda c, v: c <= v,
}
_OPTIONS = "imsx"
#: Characters with a meaning in a pattern.
_SPECIAL = frozenset("\\^$.|?*+()[]{}")


def predicate(df: DataFrame, where: Mapping[str, Any]) -> Column:
    """``where`` as a filter for ``df``."""
    return _document(df, where, True)


def _all(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, terms) if terms else F.lit(True)


def _any(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, terms) if terms else F.lit(False)


def _document(df: DataFrame, where: Mapping[str, Any], wanted: bool) -> Column:
    """The rows that match, or with ``wanted`` false exactly the others."""
    terms = []
    for name, condition in where.items():
        if name in ("$and", "$or", "$nor"):
            if not isinstance(condition, Sequence) or isinstance(condition, str) or not condition:
                raise ValueError(f"{name} takes a list of documents")
            inner = wanted != (name == "$nor")
            parts = [_document(df, part, inner) for part in condition]
            # Not (a or b) is (not a) and (not b).
            terms.append(_all(parts) if (name == "$and") == inner else _any(parts))
        elif name.startswith("$"):
            raise ValueError(f"{name} does not combine documents")
        else:
            terms.append(_condition(*_field(df, name), condition, wanted))
    return _all(terms) if wanted else _any(terms)


def _field(df: DataFrame, name: str) -> tuple[Column | None, T.DataType]:
    """A field and its type; None where the rows have none of that name."""
    if name in df.columns:
        return df[name], df.schema[name].dataType
    head, *rest = name.split(".")
    if head not in df.columns:
        return None, T.NullType()
    column, kind = df[head], df.schema[head].dataType
    for part in rest:
        if not isinstance(kind, T.StructType) or part not in kind.names:
            return None, T.NullType()
        column, kind = column.getField(part), kind[part].dataType
    return column, kind


def _condition(field: Column | None, kind: T.DataType, condition: Any, wanted: bool) -> Column:
    if isinstance(condition, re.Pattern):
        flags = (name for name, flag in zip(_OPTIONS, (re.I, re.M, re.S, re.X)) if condition.flags & flag)
        condition = {"$regex": condition.pattern, "$options": "".join(flags)}
    if not isinstance(condition, Mapping):
        condition = {"$eq": condition}
    terms = [_operator(field, kind, op, value, condition, wanted) for op, value in condition.items() if op != "$options"]
    return _all(terms) if wanted else _any(terms)


def _operator(
    field: Column | None, kind: T.DataType, op: str, value: Any, whole: Mapping[str, Any], wanted: bool
) -> Column:
    if op == "$not":
        return _condition(field, kind, value, not wanted)
    if op in ("$ne", "$nin"):
        return _operator(field, kind, {"$ne": "$eq", "$nin": "$in"}[op], value, whole, not wanted)
    if op == "$exists":
        there = wanted == bool(value)
        return F.lit(not there) if field is None else field.isNotNull() if there else field.isNull()
    if op in ("$eq", "$in"):
        values = list(value) if op == "$in" else [value]
        if any(isinstance(v, re.Pattern) for v in values):
            return (_any if wanted else _all)([_condition(field, kind, v, wanted) for v in values])
        return _one_of(field, kind, values, wanted)
    if op in _ORDER:
        known = field is not None and _same_kind(kind, value)
        return _unless_null(field, _ORDER[op](field, F.lit(value)), wanted) if known else F.lit(not wanted)
    if op == "$regex":
        pattern = value.pattern if isinstance(value, re.Pattern) else value
        known = field is not None and isinstance(kind, T.StringType)
        return _unless_null(field, _pattern(field, pattern, whole.get("$options", "")), wanted) if known else F.lit(not wanted)
    raise ValueError(f"no operator {op}")


def _unless_null(field: Column, holds: Column, wanted: bool) -> Column:
    return holds if wanted else field.isNull() | ~holds


def _one_of(field: Column | None, kind: T.DataType, values: list[Any], wanted: bool) -> Column:
    if field is None:
        return F.lit((None in values) == wanted)
    known = [v for v in values if v is not None and _same_kind(kind, v)]
    terms = [field == F.lit(known[0]) if len(known) == 1 else field.isin(*known)] if known else []
    if wanted:
        return _any([*terms, field.isNull()] if None in values else terms)
    others = _all([~t for t in terms])
    return others & field.isNotNull() if None in values else others | field.isNull()


def _same_kind(kind: T.DataType, value: Any) -> bool:
    if isinstance(value, bool):
        return isinstance(kind, T.BooleanType)
    if isinstance(value, (int, float, Decimal)):
        return isinstance(kind, T.NumericType)
    if isinstance(value, str):
        return isinstance(kind, T.StringType)
    if isinstance(value, dt.date):  # a moment too
        return isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))
    return isinstance(value, (bytes, bytearray)) and isinstance(kind, T.BinaryType)


def _literal(pattern: str) -> str | None:
    """The text that a pattern without special characters looks for."""
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern) and not pattern[i + 1].isalnum():
            i += 1
            c = pattern[i]
        elif c in _SPECIAL:
            return None
        out.append(c)
        i += 1
    return "".join(out)


def _pattern(field: Column, pattern: str, options: str) -> Column:
    if set(options) - set(_OPTIONS):
        raise ValueError(f"pattern options {options!r}")
    if not options:
        anchored = pattern.startswith("^")
        rest = pattern[anchored:].removesuffix(".*") if not pattern.endswith("\\.*") else pattern[anchored:]
        text = _literal(rest)
        if text is not None:
            return field.startswith(F.lit(text)) if anchored else field.contains(F.lit(text))
    return field.rlike(f"(?{options}){pattern}" if options else pattern)
