"""Paths, padded lists and input strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket(path: Column) -> Column:
    return F.split_part(_no_scheme(path), F.lit("/"), F.lit(1))


def key(path: Column) -> Column:
    """Everything after the first slash behind the scheme, '' when there is none."""
    return F.regexp_extract(_no_scheme(path), r"^[^/]*/(.*)$", 1)


def is_object_path(path: Column) -> Column:
    """An object-store path with a bucket name."""
    return path.rlike(r"^s3://[^/]")


def _no_scheme(path: Column) -> Column:
    return F.regexp_replace(path, r"^s3://", "")


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def glob_to_regex(pattern: str) -> str:
    """Shell pattern with ``*``, ``?`` and ``[...]`` as an anchored expression."""
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        close = pattern.find("]", i + 2) if c == "[" else -1
        if close > 0:
            body = pattern[i + 1 : close]
            out.append("[" + ("^" + body[1:] if body.startswith("!") else body) + "]")
            i = close
        else:
            out.append({"*": ".*", "?": "."}.get(c, c if c.isalnum() or c == "_" else "\\" + c))
        i += 1
    return "^" + "".join(out) + "$"


def padded(numbers: Column) -> Column:
    """Two-digit strings."""
    return F.transform(numbers, lambda n: F.lpad(n.cast("string"), 2, "0"))


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def parse_numbers(text: Column, count: int) -> Column:
    """``count`` numbers separated by semicolons, else NULL."""
    parts = F.transform(F.split(text, ";"), lambda p: F.trim(p).try_cast("double"))
    good = (F.size(parts) == count) & F.forall(parts, lambda p: p.isNotNull())
    return F.when(~is_blank(text) & good, parts)


def parse_date(text: Column) -> Column:
    """``yyyy-MM-dd``, else NULL."""
    exact = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")
    return F.when(exact, F.to_date(F.try_to_timestamp(text, F.lit("yyyy-M-d"))))


def input_state(text: Column, parsed: Column) -> Column:
    """``absent`` for blank input, ``ok`` for parsed, ``invalid`` otherwise."""
    return F.when(is_blank(text), "absent").when(parsed.isNotNull(), "ok").otherwise("invalid")
