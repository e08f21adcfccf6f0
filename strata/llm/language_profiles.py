"""Language identification by rank-order profiles.

A profile is the list of the ``SIZE`` most frequent character n-grams (one to
three letters, words bounded by a blank), most frequent first.  Each language
has the profile of all its training text; a document is given the language
whose profile is nearest to its own by out-of-place distance: the sum over the
document's n-grams of how far their ranks differ, ``SIZE`` for an n-gram that
the language's profile lacks.

Learning counts n-grams in every task first and shuffles one row per language,
n-gram and task; the profiles (``SIZE`` rows for each language, at most
``MAX_LANGUAGES`` languages) are all that reaches the driver.

A document that is in no learned language lies farther from the nearest one than
that language's own documents do.  ``limits`` takes from the learning documents
the score below which a document is rejected, by language and text length: short
texts lie farther from a profile than long ones.

Defined results: a text that is null or has no letter, and any text when
nothing was learned, is ``und`` with score 0; a document with a null id, lang
or text is not learned from; equal counts rank by the n-gram, equal distances
go to the first language by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from strata.llm.text import give_back

SIZE, MAX_LANGUAGES = 300, 1000
UNKNOWN = "und"
_BLANK, _BITS = 32, 21  # n-grams are packed as three code points of 21 bits
_MERGE, _FRAME = 1 << 19, 1 << 16
#: A limit is ``SLACK`` times the ``LOW`` quantile of the learning documents' scores: clean documents below the
#: quantile stay.  Lengths with fewer than ``LEAST`` learning documents are judged together with the nearest ones.
LOW, SLACK, LEAST = 0.01, 0.75, 30
_STEPS = 1000


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text) -> np.ndarray:
    """The packed n-grams of a text, one for each place; empty without a letter."""
    if not isinstance(text, str) or not text:
        return np.zeros(0, np.int64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64)
    codes = np.concatenate(([_BLANK], np.where(letter, codes, _BLANK), [_BLANK])).astype(np.int64)
    codes = codes[np.concatenate(([True], (codes[1:] != _BLANK) | (codes[:-1] != _BLANK)))]
    inner = codes != _BLANK
    pairs = codes[:-1] | codes[1:] << _BITS
    threes = pairs[:-1] | codes[2:] << 2 * _BITS
    return np.concatenate((codes[inner], pairs, threes[inner[1:-1]]))


def profile(text, size: int = SIZE) -> np.ndarray:
    """The most frequent n-grams of a text, most frequent first."""
    found, counts = np.unique(ngrams(text), return_counts=True)
    return found[np.argsort(-counts, kind="stable")[:size]]


def is_held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; never so for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = SIZE) -> DataFrame:
    """The profiles of all languages: lang, rank (from 0), ngram, n."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def merged(waiting):
            found, which = np.unique(np.concatenate([k for k, _ in waiting]), return_inverse=True)
            return found, np.bincount(which.reshape(-1), np.concatenate([c for _, c in waiting])).astype(np.int64)

        def frames():
            for name, waiting in held.items():
                found, counts = merged(waiting)
                for at in range(0, len(found), _FRAME):
                    yield pd.DataFrame({"lang": name, "ngram": found[at:at + _FRAME], "n": counts[at:at + _FRAME]})

        # n-grams of all languages together are held up to _MERGE, then merged, and handed on if that does not halve them
        held: dict[str, list] = {}
        size = 0
        for batch in batches:
            for name, value in zip(batch["lang"], batch["text"]):
                found, counts = np.unique(ngrams(value), return_counts=True)
                if len(found):
                    held.setdefault(name, []).append((found, counts))
                    size += len(found)
                    if size > _MERGE:
                        held = {k: [merged(waiting)] for k, waiting in held.items()}
                        size = sum(len(w[0][0]) for w in held.values())
                        if size > _MERGE // 2:
                            yield from frames()
                            held, size = {}, 0
        yield from frames()
        held.clear()
        give_back()

    known = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    totals = (known.mapInPandas(count, "lang string, ngram bigint, n bigint")
              .groupBy("lang", "ngram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "ngram")
    # ranks are cut as they come from row_number, so that every task sends its first ``size`` of a language alone
    return (totals.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
            .select("lang", (F.col("place") - 1).alias("rank"), "ngram", "n"))


class Classifier:
    """Language profiles as arrays: sorted n-grams with their ranks."""

    def __init__(self, rows, size: int = SIZE):
        by_lang: dict[str, list[tuple[int, int]]] = {}
        for r in rows:
            by_lang.setdefault(r["lang"], []).append((r["ngram"], r["rank"]))
        if len(by_lang) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
        self.size, self.names = size, sorted(by_lang)
        self.tables = [tuple(np.array(x, np.int64) for x in zip(*sorted(by_lang[n]))) for n in self.names]

    def _distance(self, own: np.ndarray, which: int) -> int:
        known, places = self.tables[which]
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        return np.where(known[at] == own, np.abs(places[at] - np.arange(len(own))), self.size).sum()

    def predict(self, text) -> tuple[str, float]:
        own = profile(text, self.size)
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        distances = [self._distance(own, k) for k in range(len(self.names))]
        best = int(np.argmin(distances))
        return self.names[best], float(1 - distances[best] / (self.size * len(own)))

    def score(self, text, lang) -> float | None:
        """The score of a text for one language; null without a letter or a profile."""
        own = profile(text, self.size)
        if not len(own) or lang not in self.names:
            return None
        return float(1 - self._distance(own, self.names.index(lang)) / (self.size * len(own)))


def predictor(spark: SparkSession, profiles: DataFrame, size: int = SIZE):
    """A column function: text to struct(lang, score)."""
    model = spark.sparkContext.broadcast(Classifier(profiles.select("lang", "rank", "ngram").toLocalIterator(), size))

    @F.pandas_udf("struct<lang:string,score:double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([model.value.predict(t) for t in texts], columns=["lang", "score"])
            del texts
        give_back()
    return predict


def length_class(text: Column) -> Column:
    """Texts of 2^k to 2^(k+1) - 1 characters are class k; 0 for an empty text."""
    return F.floor(F.log2(F.greatest(F.length(text), F.lit(1)))).cast("int")


def _limit(counts: np.ndarray) -> float:
    """``SLACK`` times the ``LOW`` quantile of scores counted in ``_STEPS`` steps."""
    return SLACK * int(np.searchsorted(np.cumsum(counts), LOW * counts.sum(), side="right")) / _STEPS


class Limits:
    """Scores of learning documents, counted by language, length class and step; limits by language and length."""

    def __init__(self, rows):
        self.counts: dict[str, dict[int, np.ndarray]] = {}
        for r in rows:
            own = self.counts.setdefault(r["lang"], {}).setdefault(r["length"], np.zeros(_STEPS + 1, np.int64))
            own[r["step"]] += r["n"]
        self.all: dict[int, np.ndarray] = {}
        for own in self.counts.values():
            for length, counts in own.items():
                self.all[length] = self.all.get(length, 0) + counts

    @staticmethod
    def _near(by_length: dict[int, np.ndarray], length: int) -> np.ndarray | None:
        """The counts of the nearest lengths that hold ``LEAST`` documents together."""
        held = np.zeros(_STEPS + 1, np.int64)
        for away in range(max((abs(length - k) for k in by_length), default=-1) + 1):
            for k in {length - away, length + away} & by_length.keys():
                held = held + by_length[k]
            if held.sum() >= LEAST:
                return held
        return None

    def limit(self, lang: str, length: int) -> float:
        """A language with too few documents is judged by those of all languages; with too few of these, by all there are."""
        held = self._near(self.counts.get(lang, {}), length)
        if held is None:
            held = self._near(self.all, length)
        if held is None:
            held = sum(self.all.values(), np.zeros(_STEPS + 1, np.int64))
        return _limit(held) if held.sum() else 0.0


def limits(docs: DataFrame, profiles: DataFrame, text: str = "text", lang: str = "lang", size: int = SIZE) -> DataFrame:
    """The least score of a document by language and length class: lang, length, least."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(Classifier(profiles.select("lang", "rank", "ngram").toLocalIterator(), size))

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, names in batches:
            yield pd.Series([model.value.score(t, n) for t, n in zip(texts, names)], dtype="float64")
            del texts, names
        give_back()

    steps = (docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
             .select("lang", length_class(F.col("text")).alias("length"), score("text", "lang").alias("score"))
             .where(F.col("score").isNotNull() & ~F.isnan("score"))
             .groupBy("lang", "length", F.floor(F.col("score") * _STEPS).cast("int").alias("step"))
             .agg(F.count(F.lit(1)).alias("n")))
    held = Limits(steps.toLocalIterator())
    rows = [(name, length, held.limit(name, length)) for name in sorted(held.counts) for length in range(32)]
    return spark.createDataFrame(rows, "lang string, length int, least double")


def identify(docs: DataFrame, folds: int = 4, fold: int = 2, id_col: str = "doc_id") -> DataFrame:
    """Learn from the documents outside the fold, predict all: id, held_out, lang_pred, score."""
    held_out = is_held_out(F.col(id_col), folds, fold)
    predict = predictor(docs.sparkSession, learn(docs.where(F.col(id_col).isNotNull() & ~held_out)))
    return (docs.select(id_col, predict(F.col("text")).alias("p"))
            .select(id_col, held_out.alias("held_out"), F.col("p.lang").alias("lang_pred"),
                    F.col("p.score").alias("score")))
