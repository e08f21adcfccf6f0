"""Matches of a pattern with their places, in JVM expressions whose cost grows with the number of matches.

A text is split at the pattern; the lengths of the pieces and of the matches,
summed, give the places.  Spark evaluates these array functions row by row and
copies an array when something is appended, so sums are kept in blocks of
``_BLOCK``: a million matches in one text cost a million short copies and not
a million long ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

_BLOCK = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sums(numbers: Column, first: Column) -> Column:
    """For each number ``first`` and the sum of those before it (cost: the square of their count)."""
    nothing = F.struct(first.cast("int").alias("upto"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(numbers, nothing, lambda s, n: F.struct(
        (s["upto"] + n).cast("int").alias("upto"), F.concat(s["out"], F.array(s["upto"])).alias("out")), lambda s: s["out"])


def running(numbers: Column) -> Column:
    """For each number of an array the sum of those before it."""
    def blocked(numbers: Column) -> Column:
        of = F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / _BLOCK).cast("int"))
        blocks = F.transform(of, lambda b: F.slice(numbers, b * _BLOCK + 1, F.lit(_BLOCK)))
        return let(blocks, lambda blocks: F.flatten(F.zip_with(blocks, _sums(
            F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, n: s + n)), F.lit(0)), _sums)))
    return let(numbers, lambda n: F.when(F.size(n) > _BLOCK, blocked(n)).otherwise(_sums(n, F.lit(0))))


def matches(text: Column, pattern: str, around: int = 0) -> Column:
    """Non-overlapping matches from the left: array of (start, end, word, left, right).

    Places are code points, the end exclusive; ``left`` and ``right`` are up to
    ``around`` characters between the match and its neighbouring matches.
    """
    def placed(words: Column, gaps: Column, before: Column) -> Column:
        def one(word: Column, i: Column) -> Column:
            start = F.get(before, i) + F.length(F.get(gaps, i))
            return F.struct(start.alias("start"), (start + F.length(word)).alias("end"), word.alias("word"),
                            *([F.substring(F.get(gaps, i), -around, around).alias("left"),
                               F.substring(F.get(gaps, i + 1), 1, around).alias("right")] if around else []))
        return F.transform(words, one)

    def found(words: Column) -> Column:
        return let(F.split(text, pattern, -1), lambda gaps: let(
            running(F.zip_with(F.slice(gaps, F.lit(1), F.size(words)), words, lambda g, w: F.length(g) + F.length(w))),
            lambda before: placed(words, gaps, before)))
    kind = "array<struct<start:int,end:int,word:string" + (",left:string,right:string>>" if around else ">>")
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
               lambda words: F.when(F.size(words) > 0, found(words)).otherwise(F.array().cast(kind)))


def blanked(text: Column, pattern: str, wanted: Callable[[Column], Column]) -> Column:
    """The text with the matches for which ``wanted`` holds replaced by as many blanks."""
    def hidden(words: Column, gaps: Column) -> Column:
        return F.array_join(F.transform(gaps, lambda gap, i: F.when(i < F.size(words), F.concat(gap, F.when(
            wanted(F.get(words, i)), F.repeat(F.lit(" "), F.length(F.get(words, i)))).otherwise(F.get(words, i)))).otherwise(gap)), "")
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda words: F.when(
        F.size(words) > 0, let(F.split(text, pattern, -1), lambda gaps: hidden(words, gaps))).otherwise(text))
