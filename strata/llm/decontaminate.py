"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

The windows of all benchmark items (``n`` consecutive words; an item with
fewer words is one window) are hashed into a sorted array that every task
holds.  A document's windows are hashed the same way, looked up, and each hit
is compared word by word before it counts, so a hash collision cannot mark a
clean document.  One pass over the documents, no shuffle.

The benchmark is broadcast in parts of about ``part_windows`` windows.  Items
are first cut into units of at most ``UNIT_WINDOWS`` windows, equal units are
kept once with the ids of all their items, and units are dealt to parts by
hash: neither a long item nor many copies of one make a part larger (the ids
of a unit are split beyond ``UNIT_ITEMS``).  A usual benchmark is one part; a
larger one takes one pass over the documents for each part, with the hits of
earlier passes kept in a written table.

Defined results: a null or wordless text has no words and no hits; an item
without words has no window; an item with a null id marks words but is not
named; repeated items are named once; repeated document rows each get a row.
Other columns of either table are neither read nor returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from strata.llm.store import saved
from strata.llm.text import alnum_spans, alnum_words, combine, covered
from strata.session import scratch_root

PART_WINDOWS, UNIT_WINDOWS, UNIT_ITEMS = 1 << 20, 1 << 12, 1 << 16
HITS = "struct<n_words:bigint,hits:array<struct<first:int,last:int>>,items:array<string>>"


def units(benchmark: DataFrame, n: int, unit_windows: int = UNIT_WINDOWS, unit_items: int = UNIT_ITEMS) -> DataFrame:
    """The distinct pieces of all items: words (blank between), windows, items (ids, a bounded share of them a row)."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, text in zip(batch["item"], batch["text"]):
                words = alnum_words(text)
                for at in range(0, max(1, len(words) - n + 1) if words else 0, unit_windows):
                    piece = words[at:at + unit_windows + n - 1]
                    rows.append((item, b" ".join(piece).decode(), max(1, len(piece) - n + 1)))
            yield pd.DataFrame(rows, columns=["item", "words", "windows"])

    pieces = (benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("text"))
              .mapInPandas(cut, "item string, words string, windows bigint").distinct())
    most = pieces.groupBy("words").agg(F.count("item").alias("n")).agg(F.max("n")).first()[0] or 0
    share = F.pmod(F.xxhash64("item"), F.lit(max(1, -(-most // unit_items))))
    return (pieces.groupBy("words", share.alias("share"))
            .agg(F.max("windows").alias("windows"), F.collect_set("item").alias("items")))


class Windows:
    """The windows of some units, ready to be looked up: sorted hashes, where each stands, and the units it stands in."""

    def __init__(self, pieces: list[tuple[str, list[str]]], n: int):
        self.vocabulary: dict[bytes, int] = {}
        number = lambda w: self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        texts = [np.fromiter(map(number, words.encode().split()), np.uint32) for words, _ in pieces]
        self.items = [items for _, items in pieces]
        self.tokens = np.concatenate([np.zeros(0, np.uint32), *texts])
        lengths = np.array([len(t) for t in texts], np.int64)
        begin = np.cumsum(lengths) - lengths
        self.by_size = {}
        for size in map(int, np.unique(np.minimum(lengths, n))):
            of = np.flatnonzero(np.minimum(lengths, n) == size)
            counts = lengths[of] - size + 1
            inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            starts, owners = np.repeat(begin[of], counts) + inside, np.repeat(of, counts).astype(np.int32)
            seed = 0
            while True:  # another seed if two windows share a hash
                hashes = combine((self.tokens[starts + k] for k in range(size)), len(starts), seed)
                order = np.argsort(hashes, kind="stable")
                hashes, at = hashes[order], starts[order]
                new = np.concatenate(([True], hashes[1:] != hashes[:-1]))
                again = np.flatnonzero(~new)
                if all((self.tokens[at[again] + k] == self.tokens[at[again - 1] + k]).all() for k in range(size)):
                    break
                seed += 1
            bounds = np.append(np.flatnonzero(new), len(new))
            self.by_size[size] = (seed, hashes[new], at[new], bounds, owners[order])

    def find(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words are inside an occurrence, and the items that occur."""
        get = self.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in words), np.uint32, len(words))
        hit, items = np.zeros(len(ids), bool), set()
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        for size, (seed, hashes, starts, bounds, owners) in self.by_size.items():
            if len(ids) < size:
                continue
            full = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(full):
                continue
            own = combine((ids[full + k] for k in range(size)), len(full), seed)
            at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
            like = np.flatnonzero(hashes[at] == own)
            full, at = full[like], at[like]
            same = np.ones(len(full), bool)
            for k in range(size):
                same &= self.tokens[starts[at] + k] == ids[full + k]
            if same.any():
                hit |= covered(full[same], size, len(ids))
                within = [owners[bounds[k]:bounds[k + 1]] for k in np.unique(at[same])]
                for unit in np.unique(np.concatenate(within)):
                    items.update(self.items[unit])
        return hit, items


def _spans(hit: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[0::2], edges[1::2])]


def _pass(docs: DataFrame, pieces: list, n: int, earlier: str | None, out: str, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(Windows(pieces, n))

    def look(texts: pd.Series, before: pd.DataFrame | None) -> pd.DataFrame:
        rows = []
        for k, value in enumerate(texts):
            words = alnum_words(value)
            hit, found = shared.value.find(words)
            if before is not None:
                for span in before["hits"].iloc[k]:
                    hit[span["first"]:span["last"] + 1] = True
                found |= set(before["items"].iloc[k])
            rows.append((len(words), _spans(hit), sorted(found)))
        return pd.DataFrame(rows, columns=["n_words", "hits", "items"])

    if earlier is None:
        @F.pandas_udf(HITS)
        def first(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for texts in batches:
                yield look(texts, None)
        return docs.withColumn(out, first(F.col(text)))

    @F.pandas_udf(HITS)
    def later(texts: pd.Series, before: pd.DataFrame) -> pd.DataFrame:
        return look(texts, before)
    return docs.withColumn(out, later(F.col(text), F.col(earlier)))


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text", out: str = "found",
              part_windows: int = PART_WINDOWS) -> DataFrame:
    """``docs`` with a struct column ``out``: n_words, hits (word ranges), items (ids of occurring items)."""
    if out in docs.columns:
        raise ValueError(f"the documents already have a column {out}")
    pieces = saved(units(benchmark, n), "benchmark")
    size = pieces.agg(F.coalesce(F.sum(F.col("windows") + F.size("items")), F.lit(0))).first()[0]
    parts = max(1, -(-size // part_windows))
    part_of = F.pmod(F.xxhash64("words", "share"), F.lit(parts))
    state, earlier = docs, None
    for part in range(parts):
        rows = [(r.words, r["items"]) for r in pieces.where(part_of == part).select("words", "items").toLocalIterator()]
        into = out if part == parts - 1 else f"{out}_{part}"
        state = _pass(state, rows, n, earlier, into, text)
        state = state.drop(earlier) if earlier else state
        if into != out:
            scratch_root(docs.sparkSession)
            state = state.checkpoint()
        earlier = into
    return state


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id",
                  part_windows: int = PART_WINDOWS) -> DataFrame:
    """Per document: words, hit words, the occurring items and their digest, the hit word ranges."""
    found = find_hits(docs.select(id_col, "text"), benchmark, n, part_windows=part_windows)
    n_hit = F.aggregate("found.hits", F.lit(0).cast("bigint"),
                        lambda total, span: total + span["last"] - span["first"] + 1)
    return found.select(
        id_col, F.col("found.n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("found.items")), 256).alias("items_sha256"),
        (F.size("found.hits") > 0).alias("contaminated"), F.col("found.hits").alias("hits"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, remove: str = "documents",
                  part_windows: int = PART_WINDOWS) -> DataFrame:
    """Remove contaminated documents, or (``remove="spans"``) the hit passages out of their texts."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    mark = "strata_found_hits"
    found = find_hits(docs, benchmark, n, out=mark, part_windows=part_windows)
    if remove == "documents":
        return found.where(F.size(f"{mark}.hits") == 0).select(*docs.columns)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, marks: pd.DataFrame) -> pd.Series:
        return pd.Series([without(t, h) for t, h in zip(texts, marks["hits"])], dtype=object)
    clean = F.when(F.size(f"{mark}.hits") == 0, F.col("text")).otherwise(cut("text", mark))
    return found.withColumn("text", clean).select(*docs.columns)


def without(text, hits) -> str | None:
    """A text without the passages from the first to the last word of each hit."""
    if not isinstance(text, str) or not len(hits):
        return text
    data, starts, ends = alnum_spans(text)
    kept, at = [], 0
    for span in hits:
        kept.append(data[at:starts[span["first"]]])
        at = ends[span["last"]]
    return b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")


def digest(ids) -> str:
    """The digest of a set of item ids, as ``contamination`` returns it."""
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


def sql(n: int = 10) -> str:
    """``contamination`` without the word ranges, as DuckDB SQL over ``documents`` and ``benchmark``."""
    words = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
items AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark),
starts AS (SELECT item, w, least({n}, len(w)) AS size, unnest(range(1, greatest(1, len(w) - {n - 1}) + 1)) AS k
           FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, size, array_to_string(w[k:k + size - 1], ' ') AS run FROM starts),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM docs, sizes WHERE len(w) >= size),
found AS (SELECT r, k, size, item
          FROM (SELECT r, k, size, array_to_string(w[k:k + size - 1], ' ') AS run FROM places) JOIN windows USING (size, run)),
hit AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(k, k + size)) AS place FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT r, item FROM found WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""
