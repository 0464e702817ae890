"""Matches of a regular expression with their places, by built-in functions.

``split`` gives the pieces between the leftmost non-overlapping matches, ``regexp_extract_all`` the matches
themselves; running lengths of both are the places, in code points. Patterns must not match the
empty string; repeated groups should be possessive, so that long matches need no stack.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def let(value: Column, body) -> Column:
    """body(value), with value computed once even where body uses it in lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def find_all(text: Column, pattern: str) -> Column:
    """array<struct<start int, match string, before string, after string>> of a text that is not null."""
    none = F.array().cast("array<struct<start:int,match:string,before:string,after:string>>")

    def placed(found: Column) -> Column:
        return let(F.split(text, pattern, -1), lambda pieces: with_places(pieces, found))

    def with_places(pieces: Column, found: Column) -> Column:
        lengths = F.zip_with(pieces, found, lambda p, m: F.length(p) + F.coalesce(F.length(m), F.lit(0)))
        return let(
            running(lengths),
            lambda ends: F.transform(
                found,
                lambda m, i: F.struct(
                    (F.get(ends, i) - F.length(m)).alias("start"), m.alias("match"),
                    F.get(pieces, i).alias("before"), F.get(pieces, i + 1).alias("after"),
                ),
            ),
        )

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.rlike(pattern), let(found, placed)).otherwise(none)


def running(numbers: Column) -> Column:
    """Running totals. Blocks of 256 keep long arrays from being copied once per element."""
    step = 256

    def totals(a: Column) -> Column:
        return F.aggregate(
            a, F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all")),
            lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.array_append(s["all"], s["sum"] + x).alias("all")),
            lambda s: s["all"],
        )

    def long(a: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(a), F.lit(step))
        blocks = F.transform(starts, lambda i: totals(F.slice(a, i, F.lit(step))))
        return let(
            blocks,
            lambda bs: let(
                totals(F.transform(bs, lambda b: F.element_at(b, -1))),
                lambda upto: F.flatten(
                    F.transform(bs, lambda b, i: F.transform(b, lambda x: x + F.when(i > 0, F.get(upto, i - 1)).otherwise(F.lit(0))))
                ),
            ),
        )

    return let(numbers, lambda a: F.when(F.size(a) <= step, totals(a)).otherwise(long(a)))
