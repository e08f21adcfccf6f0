"""Near-duplicate removal with bottom-k sketches from one hash function.

A text's set is its distinct word shingles, known by 63-bit hashes; its sketch
is the ``K`` smallest of them.  Texts with equal sets are one vertex from the
start, so copies are never paired.

1. **Inverted lists.**  Two texts with a similarity of ``percent`` share at
   least ``shared()`` retained values, but for a probability of ``MISS``.  So
   under any one order of the values they share one among the first
   ``K - shared + 1`` of each: these alone go into the lists.  The order is by
   the number of texts that retain a value, rarest first, so a text's own words
   come first and passages that many texts share last; values that one text
   alone retains take their places in the order but need no list.
2. **Union-sketch estimate.**  The ``K`` smallest values of both sketches are
   the sketch of the union; the share of them that both have estimates the
   similarity.  Pairs with fewer than ``shared()`` of them go.
3. **Exact check** of what is left, on the full sets.

Only components are asked for, so a list of thousands of near copies is not
paired out.  Every member of a list is compared with the list's smallest id
first.  A text can then only be linked to another component if it has
``shared()`` retained values in lists that hold another component; for those
texts alone, lists over the full sets (the same rule with exact counts, so far
shorter) are made, compared with a changing member first and paired out only
between components last, and there only where the first common value's places
in both orders leave enough values for the similarity.

Defined results: a text without words, or null, is linked with nothing; rows
with the same id are one vertex; a row with a null id is linked with nothing,
its component is null and it is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from strata.llm.components import components
from strata.llm.store import saved, spare_names
from strata.llm.text import give_back, space_words, window_hashes, word_hashes

K, MISS = 64, 1e-9


def shingles(text, n: int) -> np.ndarray:
    """Sorted distinct hashes of the text's n-word shingles; of the whole text if it has fewer words."""
    words = word_hashes(space_words(text))
    if not len(words):
        return np.zeros(0, np.int64)
    return np.unique(window_hashes(words, min(n, len(words)), n) >> np.uint64(1)).astype(np.int64)


@lru_cache
def shared(k: int, percent: int, miss: float = MISS) -> int:
    """Fewest common values among the k smallest of a union, for a similarity of ``percent``, but for ``miss``."""
    p, below = percent / 100, 0.0
    for hits in range(k + 1):
        below += comb(k, hits) * p**hits * (1 - p)**(k - hits)
        if below > miss:
            return max(1, hits)
    return k


def least_overlap(size, k: int | None, percent: int):
    """Fewest values that two sets (``k`` None) or sketches share at that similarity; ``size`` is one of them."""
    exact = F.ceil(size * percent / 100)
    if k is None:
        return exact
    # up to this size a similar text is retained in full too, and the count is exact
    return F.when(size * 100 <= k * percent, exact).otherwise(F.least(F.lit(shared(k, percent)), exact))


def _signatures(docs: DataFrame, n: int, k: int) -> DataFrame:
    """doc_id, n_shingles, twin (digest of the whole set), sketch."""
    @F.pandas_udf("struct<n:bigint,twin:binary,sketch:array<bigint>>")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                own = shingles(text, n)
                rows.append((len(own), xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None, own[:k]))
            del texts
            yield pd.DataFrame(rows, columns=["n", "twin", "sketch"])
            del rows
        give_back()
    return docs.select("doc_id", sign("text").alias("s")).select("doc_id", F.col("s.n").alias("n_shingles"), "s.twin",
                                                                  "s.sketch")


def _common_values(rows: DataFrame) -> DataFrame:
    """The rows (value, id, size) of values that two texts or more have, with their number."""
    counts = rows.groupBy("value").agg(F.count("*").alias("texts")).where("texts > 1")
    return rows.join(counts, "value")


def _lists(common: DataFrame, k: int | None, percent: int) -> DataFrame:
    """(value, id, size, reach): the first values of every text, rarest first, as far as a similar text must share one.

    ``reach``, for full sets, is the size of the largest similar set with which this may be the first common value:
    the text's values from here on are as many as the two must share.
    """
    size = F.least("size", F.lit(k)) if k else F.col("size")
    own = Window.partitionBy("id", "size")
    place = size - F.count("*").over(own) + F.row_number().over(own.orderBy("texts", "value"))
    fewest = least_overlap(size, k, percent)
    return (common.withColumn("place", place).where(F.col("place") <= size - fewest + 1)
            .select("value", "id", "size", F.floor((F.col("size") - F.col("place") + 1) * F.lit(100 + percent) / percent
                                                   - F.col("size") + 1e-6).alias("reach")))


def _stars(lists: DataFrame, head, percent: int) -> DataFrame:
    """Pairs (a, b), a < b: every member of a list with the member that has the least ``head``."""
    heads = lists.groupBy("value").agg(F.min(F.struct(head.alias("order"), "id", "size", "c")).alias("h"))
    return (lists.join(heads, "value").where((F.col("id") != F.col("h.id")) & (F.col("c") != F.col("h.c")))
            .where(_sized(F.col("size"), F.col("h.size"), percent))
            .select(F.least("id", "h.id").alias("a"), F.greatest("id", "h.id").alias("b")).distinct())


def _placed(lists: DataFrame, found: DataFrame) -> DataFrame:
    """Lists with every member's component so far (``c``), where a list holds two or more."""
    placed = (lists.join(found.withColumnRenamed("vertex", "id"), "id", "left")
              .select(*lists.columns, F.coalesce("component", "id").alias("c")))
    mixed = (placed.groupBy("value").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low != high")
             .select("value"))
    return placed.join(mixed, "value")


def _alike(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose union sketch does not rule the similarity out."""
    least = shared(k, percent)

    @F.pandas_udf("boolean")
    def likely(left: pd.Series, right: pd.Series, n_left: pd.Series, n_right: pd.Series) -> pd.Series:
        out = []
        for a, b, na, nb in zip(left, right, n_left, n_right):
            both = len(np.intersect1d(a, b, assume_unique=True))
            if na <= k and nb <= k:  # whole sets: the count is exact
                out.append(100 * both >= percent * (na + nb - both))
                continue
            union = np.union1d(a, b)[:k]
            hits = len(np.intersect1d(np.intersect1d(a, union, assume_unique=True), b, assume_unique=True))
            out.append(hits >= min(least, len(union)))
        return pd.Series(out, dtype=bool)
    side = lambda x: texts.select(F.col("id").alias(x), F.col("sketch").alias(f"s{x}"), F.col("n").alias(f"n{x}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .where(likely("sa", "sb", "na", "nb")).select("a", "b"))


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text): the different texts of some ids."""
    return (docs.join(ids, "id", "left_semi").groupBy("id").agg(F.collect_set("text").alias("texts"))
            .select("id", F.explode("texts").alias("text")))


def _verified(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs (a, b) that are similar by their full sets."""
    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        out, last, own = [], None, None
        for a, b in zip(left, right):
            if a != last:
                last, own = a, shingles(a, n)
            other = shingles(b, n)
            both = len(np.intersect1d(own, other, assume_unique=True))
            out.append(100 * both >= percent * (len(own) + len(other) - both))
        return pd.Series(out, dtype=bool)
    needed = _texts_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    side = lambda x: needed.select(F.col("id").alias(x), F.col("text").alias(f"t{x}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").where(similar("ta", "tb")).select("a", "b")


def _sized(left, right, percent: int):
    """Whether two sizes allow the similarity."""
    return F.least(left, right) * 100 >= F.greatest(left, right) * percent


def classes(docs: DataFrame, n: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_shingles, component_id, kept."""
    rows = docs.select("doc_id", "text")
    signed = saved(_signatures(rows, n, k), "signatures")
    known = signed.where("doc_id is not null and twin is not null")
    texts = saved(known.groupBy("twin").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"),
                                            F.first("sketch").alias("sketch")), "texts")
    # copies, and rows that share an id, are joined to the text's vertex, its smallest id
    copies = (known.select("doc_id", "twin").join(texts.select("twin", "id"), "twin").where("doc_id != id")
              .select(F.col("doc_id").alias("u"), F.col("id").alias("v")))
    source = rows.where("doc_id is not null").withColumnRenamed("doc_id", "id")

    retained = texts.select(F.explode("sketch").alias("value"), "id", F.col("n").alias("size"))
    common = saved(_common_values(retained), "values")
    lists = _lists(common, k, percent).withColumn("c", F.col("id"))
    pairs = _alike(_stars(lists, F.col("id"), percent), texts, k, percent)
    edges = copies.union(saved(_verified(pairs, source, n, percent), "links").select("a", "b"))
    found = saved(components(edges), "components")

    least = least_overlap(F.least("size", F.lit(k)), k, percent)
    unsettled = saved(_placed(common, found).groupBy("id", "size").agg(F.count("*").alias("open"))
                      .where(F.col("open") >= least).select("id").distinct(), "unsettled")
    sets = _common_values(_full_sets(_texts_of(source, unsettled), n))
    lists = saved(_lists(sets, None, percent), "full-lists")
    # the second member is another one in every list, so each text meets many
    for step, head in (("star", F.xxhash64("id", "value")), ("cross", None)):
        placed = saved(_placed(lists, found), "open-lists")
        pairs = _stars(placed, head, percent) if head is not None else _across(placed, percent)
        links = saved(_verified(_alike(pairs, texts, k, percent), source, n, percent), f"{step}-links")
        if links.take(1):
            edges = found.select(F.col("vertex").alias("u"), F.col("component").alias("v")).union(links.select("a", "b"))
            found = saved(components(edges), "components")
    whole = signed.join(found, signed["doc_id"] == found["vertex"], "left")
    component = F.coalesce("component", "doc_id")
    return whole.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _full_sets(docs: DataFrame, n: int) -> DataFrame:
    """(value, id, size): all shingles of (id, text)."""
    @F.pandas_udf("array<bigint>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shingles(t, n) for t in texts], dtype=object)
            del texts
        give_back()
    sets = docs.select("id", cut("text").alias("set")).select("id", "set", F.size("set").cast("bigint").alias("size"))
    return sets.select(F.explode("set").alias("value"), "id", "size")


def _across(placed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one list that are in different components and within reach of each other."""
    small, large = (side.select("value", F.col("id").alias(x), F.col("size").alias(f"n{x}"),
                                F.col("reach").alias(f"r{x}"), F.col("c").alias(f"c{x}"))
                    for x, side in (("a", placed.where("reach >= size")), ("b", placed)))
    return (small.join(large, "value").where("ca != cb").where(F.struct("na", "a") < F.struct("nb", "b"))
            .where("nb <= ra and na <= rb").where(_sized(F.col("na"), F.col("nb"), percent)).select("a", "b").distinct())


def deduplicate(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each class: the one with the smallest id.

    Rows that share an id, or whose id is null, are rows of their own: they are
    written with a row number, take part in the classes by it, and follow the
    rows with an id of their own in the order (then by id, nulls first, then by
    row number).
    """
    spare = spare_names(docs, "id", "row")
    repeated = saved(docs.groupBy(F.col("doc_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
                     .where("n > 1 or id is null").select("id"), "repeated-ids")
    if repeated.isEmpty():
        dropped = classes(docs, n, percent).where(~F.col("kept")).select(F.col("doc_id").alias(spare["id"])).distinct()
        return docs.join(dropped, F.col("doc_id") == F.col(spare["id"]), "left_anti")
    ids = repeated.select(F.col("id").alias(spare["id"]))
    same = F.col("doc_id").eqNullSafe(F.col(spare["id"]))
    single = docs.join(ids, same, "left_anti")
    shared_ids = saved(docs.join(ids, same, "left_semi").withColumn(spare["row"], F.monotonically_increasing_id()), "repeated-rows")
    vertex = lambda repeated, row: F.struct(F.lit(repeated).alias("repeated"), F.col("doc_id").alias("id"), row.alias("row"))
    both = (single.select(vertex(False, F.lit(None).cast("bigint")).alias("doc_id"), "text")
            .unionByName(shared_ids.select(vertex(True, F.col(spare["row"])).alias("doc_id"), "text")))
    gone = saved(classes(both, n, percent).where(~F.col("kept")).select("doc_id.*"), "dropped")
    gone_ids = gone.where("not repeated").select(F.col("id").alias(spare["id"]))
    gone_rows = gone.where("repeated").select(F.col("row").alias(spare["row"]))
    return (single.join(gone_ids, F.col("doc_id") == F.col(spare["id"]), "left_anti")
            .unionByName(shared_ids.join(gone_rows, spare["row"], "left_anti").select(*docs.columns)))
