"""Quality rules on repetition: how much of a text lies in n-grams and lines that repeat.

One rolling hash runs over the words in numpy: the hashes of all n-grams come
from those of n - 1 words in one step, and only n-grams whose two parts of
n - 1 words both repeat are sorted.  The characters of words inside an n-gram
that occurs twice or more in the text (its first place included) are counted
once, and set against all word characters.  Short n-grams (2 to 4) are judged by their single most frequent
n-gram, long ones (5 to 10) by all repeated ones together, lines by the
characters of those equal to an earlier line.  The work is one pass over the
rows; nothing is shuffled.

The limits are the published repetition limits for web text.  Defined
results: a null text has no words and fails the base rule; lines without a
word are never duplicates; every row is judged by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from strata.llm.text import covered, mix, raw, space_words

#: Most per cent of word characters in the most frequent n-gram, by n (fixed values of the published rules).
TOP_NGRAM = {2: 20, 3: 18, 4: 16}
#: Most per cent of word characters in repeated n-grams, by n (fixed values of the published rules).
DUP_NGRAM = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
#: Most per cent of word characters in lines equal to an earlier one, and of such lines.
DUP_LINE_CHARS, DUP_LINES = 20, 30
MIN_WORDS, MAX_REPEATED = 50, 50
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(c for c in range(256) if c not in _SYMBOLS)
SCHEMA = ("struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
          "n_lines:bigint,dup_line_chars:bigint,top_chars:array<bigint>,dup_chars:array<bigint>>")


def _chars(word: bytes) -> int:
    return len(word) if word.isascii() else len(word.decode("utf-8", "surrogatepass"))


def _repeated(keys: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of windows at ``starts``: those that occur twice or more, and those equal to the most frequent (first on ties)."""
    if not len(keys):
        return starts, starts
    _, first, which, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    most = counts.max()
    if most == 1:
        return starts[:0], starts[:0]
    best = first[counts == most].min()
    return starts[counts[which] > 1], starts[which == which[best]]


def _longer(starts: np.ndarray) -> np.ndarray:
    """Where a window of one word more can repeat: its first and its last words both repeat."""
    return starts[:-1][np.diff(starts) == 1]


def _repeats(ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 2, 3, ... the starts of repeated windows of n words, and of the most frequent one."""
    values = mix(ids.astype(np.uint64) + np.uint64(1))
    rolled, starts = values, np.flatnonzero(np.bincount(ids)[ids] > 1) if len(ids) else ids
    for n in range(2, max(DUP_NGRAM) + 1):
        rolled = rolled[:max(0, len(ids) - n + 1)] * _BASE + values[n - 1:]
        starts = _longer(starts)
        starts, top = _repeated(rolled[starts], starts)
        yield starts, top


def _repeated_threes(ids: np.ndarray) -> np.ndarray:
    """Starts of 3-word windows that occur twice or more, by exact keys: a number for each pair, then for pair and word."""
    if not len(ids):
        return ids
    counts = np.bincount(ids)
    size, starts, number = len(counts), np.flatnonzero(counts[ids] > 1), ids
    for k in (1, 2):
        starts = _longer(starts)
        keys = number[starts] * size + ids[starts + k]
        _, which, found = np.unique(keys, return_inverse=True, return_counts=True)
        number = np.zeros(len(ids), np.int64)
        number[starts] = which
        starts = starts[found[which] > 1]
    return starts


def measure(text) -> tuple:
    """The counts of SCHEMA for one text."""
    words = space_words(text, lower=False)
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    sizes = np.fromiter(map(_chars, index), np.int64, len(index))[ids] if len(ids) else ids
    data = raw(text)
    seen, dup_lines, dup_chars, lines = set(), 0, 0, 0
    for line in data.split(b"\n"):
        if content := line.split():
            lines += 1
            if line in seen:
                dup_lines += 1
                dup_chars += sum(map(_chars, content))
            seen.add(line)
    repeat = covered(_repeated_threes(ids), 3, len(ids)).sum()
    base = (len(words), int(sizes.sum()), len(data.translate(None, _NOT_SYMBOLS)), dup_lines, int(repeat), lines,
            dup_chars)
    inside = lambda starts, n: int(sizes[covered(starts, n, len(ids))].sum()) if len(starts) else 0
    found = dict(enumerate(_repeats(ids), start=2))
    return (*base, [inside(found[n][1], n) for n in TOP_NGRAM], [inside(found[n][0], n) for n in DUP_NGRAM])


def _measured(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = [x.split(":")[0] for x in SCHEMA[7:-1].split(",")]
    for batch in texts:
        yield pd.DataFrame([measure(t) for t in batch], columns=names)


def repetition(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: the counts, the base rule, the names of the broken rules and the verdict."""
    m = docs.select(F.col(id_col), F.pandas_udf(_measured, SCHEMA)(F.col(text)).alias("m")).select(id_col, "m.*")
    total = F.col("word_chars")
    rules = [F.when(F.col("top_chars")[k] * 100 > limit * total, F.lit(f"top_{n}_gram"))
             for k, (n, limit) in enumerate(TOP_NGRAM.items())]
    rules += [F.when(F.col("dup_chars")[k] * 100 > limit * total, F.lit(f"dup_{n}_gram"))
              for k, (n, limit) in enumerate(DUP_NGRAM.items())]
    rules += [F.when(F.col("dup_line_chars") * 100 > DUP_LINE_CHARS * total, F.lit("dup_line_chars")),
              F.when(F.col("n_dup_lines") * 100 > DUP_LINES * F.col("n_lines"), F.lit("dup_lines"))]
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)
    m = m.withColumn("broken", F.array_compact(F.array(*rules))).withColumn("base_failed", failed)
    return m.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
