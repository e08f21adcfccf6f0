"""Byte-level BPE: encoding in overlapping chunks, decoding by joining raw bytes.

A text of at most ``CHUNK`` characters is one chunk.  A longer one is cut into
chunks that each carry ``OVERLAP`` characters of the next, and its chunks are
spread over the cluster:

1. every chunk is split into pre-tokens on its own, from its first character;
2. neighbours are stitched at the first place in their overlap where both have
   a pre-token boundary: pre-tokenising looks only forward, so from a common
   boundary on both splits agree;
3. the piece between two stitches is encoded, each pre-token by itself;
4. the pieces' ids are joined in order.

If an overlap holds no common boundary (say, one run of thousands of letters),
the whole text is encoded in one piece, so the result never depends on the
chunks.  Equal long texts are encoded once.

Python's and the tokenizer library's Unicode tables may differ in age, first
at U+0558.  So a piece with characters from U+0530 on is split by the library
itself, and in such a chunk only a blank between ASCII letters or digits, a
boundary under any table, can be a stitch.

Defined results: a null text is empty; an empty text has no ids and decodes to
no bytes; repeated rows each get a row.  The ranks file is opened on the
driver (a path is a parameter) and broadcast; special tokens are never made.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from strata.llm.text import give_back

CHUNK, OVERLAP = 20_000, 500
_CACHE = 50_000  # pre-tokens whose ids a worker remembers; on reaching it the memory is emptied
_INNER = "strata_bpe_"
_LATER = re.compile("[^\x00-\u052f]")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, lines)))}


class Codec:
    """Ranks and pattern; the encoder itself is made where it is used."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern}

    def _ready(self):
        if not hasattr(self, "split"):
            self.bpe = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})
            self.split = regex.compile(self.pattern)
            self.known: dict[str, bytes] = {}
        return self

    def boundaries(self, chunk: str, last: bool) -> np.ndarray:
        """Offsets where a pre-token starts.  What follows an inner chunk can change its last two pre-tokens."""
        starts = [m.start() for m in self._ready().split.finditer(chunk)]
        if _LATER.search(chunk):
            sure = {m.start() + 1 for m in re.finditer("(?a)[a-zA-Z0-9] (?=[a-zA-Z0-9])", chunk)}
            starts = [s for s in starts if s in sure]
        return np.array(starts if last else starts[:-2], np.int64)

    def encode(self, piece) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not isinstance(piece, str) or not piece:
            return b""
        known = self._ready().known
        if _LATER.search(piece):
            return np.array(self.bpe.encode_ordinary(piece), "<u4").tobytes()
        if len(known) > _CACHE:
            known.clear()
        tokens = self.split.findall(piece)
        for token in set(tokens).difference(known):
            known[token] = np.array(self.bpe.encode_ordinary(token), "<u4").tobytes()
        return b"".join(map(known.__getitem__, tokens))

    def release(self) -> None:
        """Free the encoder and what it remembers: a Python worker lives on and serves other work."""
        for made in ("bpe", "split", "known", "raw"):
            self.__dict__.pop(made, None)
        give_back()

    def decode(self, ids: bytes) -> bytes:
        if not hasattr(self, "raw"):  # a worker that only decodes makes no encoder
            self.raw = [b""] * (max(self.ranks.values(), default=-1) + 1)
            for token, rank in self.ranks.items():
                self.raw[rank] = token
        return b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec(spark: SparkSession, ranks_path: str, pattern: str):
    """The broadcast tokenizer that ``encode`` and ``decode`` take."""
    return spark.sparkContext.broadcast(Codec(read_ranks(ranks_path), pattern))


def decode(ids: Column, shared) -> Column:
    """The raw bytes of encoded ids."""
    @F.pandas_udf("binary")
    def join(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            raw = [shared.value.decode(v) for v in values]
            del values
            yield pd.Series(raw, dtype=object)
            del raw
        shared.value.release()
    return join(ids)


def encode(docs: DataFrame, shared, text: str = "text", out: str = "ids", chunk: int = CHUNK,
           overlap: int = OVERLAP) -> DataFrame:
    """``docs`` with a binary column ``out``: the ids of the whole text, little-endian unsigned 32-bit."""
    if not 0 < overlap <= chunk:
        raise ValueError("the overlap must be above 0 and no longer than a chunk")
    if taken := [c for c in docs.columns if c == out or c.startswith(_INNER)]:
        raise ValueError(f"the documents already have columns {taken}")

    @F.pandas_udf("binary")
    def whole(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            ids = [shared.value.encode(t) for t in texts]
            del texts  # not held while the next batch is read
            yield pd.Series(ids, dtype=object)
            del ids
        shared.value.release()

    is_long = F.coalesce(F.length(text) > chunk, F.lit(False))
    short = docs.where(~is_long).withColumn(out, whole(F.col(text)))
    key = f"{_INNER}key"
    long = docs.where(is_long).withColumn(key, F.sha2(F.col(text).cast("binary"), 256))
    pieces = _pieces(long.select(F.col(key).alias("key"), F.col(text).alias("text")), shared, chunk, overlap)
    encoded = (pieces.where("piece is not null").withColumn("ids", whole("piece"))
               .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("no", "ids"))).alias("parts")))

    # joined as hex: a Python step here would lose the partitioning by key and shuffle the ids once more
    ids = F.unhex(F.array_join(F.transform("parts.ids", F.hex), ""))
    stitched = pieces.groupBy("key").agg(F.every("synced").alias("synced")).where("synced")
    found = stitched.join(encoded, "key").select(F.col("key").alias(key), ids.alias(f"{_INNER}ids"))
    long = long.join(found, key, "left")
    # texts whose chunks never came into step are encoded in one piece
    rest = F.when(F.col(f"{_INNER}ids").isNull(), F.col(text))
    long = long.withColumn(out, F.coalesce(f"{_INNER}ids", whole(rest)))
    return short.unionByName(long.select(*docs.columns, out))


def _pieces(texts: DataFrame, shared, chunk: int, overlap: int) -> DataFrame:
    """key, no, piece (text between two stitches), synced (whether the chunk's start was stitched)."""
    @F.pandas_udf("struct<head:array<bigint>,tail:array<bigint>>")
    def bounds(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for chunks, starts, last in batches:
            rows = []
            for value, start, ends in zip(chunks, starts, last):
                at = shared.value.boundaries(value, ends)
                rows.append((at[at < overlap] + start, at[at >= chunk] + start))
            yield pd.DataFrame(rows, columns=["head", "tail"])
        shared.value.release()

    size = F.length("text")
    rows = (texts.withColumn("start", F.explode(F.sequence(F.lit(0), size - 1, F.lit(chunk))))
            .select("key", (F.col("start") / chunk).cast("int").alias("no"), F.col("start").cast("bigint"),
                    (F.col("start") + chunk >= size).alias("last"),
                    F.expr(f"substring(text, start + 1, {chunk + overlap})").alias("chunk"))
            .groupBy("key", "no").agg(F.first("chunk").alias("chunk"), F.first("start").alias("start"),
                                      F.first("last").alias("last"))
            .withColumn("b", bounds("chunk", "start", "last")))
    order = Window.partitionBy("key").orderBy("no")
    common = F.array_min(F.array_intersect(F.lag("b.tail").over(order), F.col("b.head")))
    rows = rows.withColumn("from", F.when(F.col("no") == 0, F.lit(0)).otherwise(common))
    rows = rows.withColumn("to", F.when(F.col("last"), F.col("start") + F.length("chunk"))
                           .otherwise(F.lead("from").over(order)))
    piece = F.expr("substring(chunk, cast(from - start + 1 as int), cast(to - from as int))")
    return rows.select("key", "no", piece.alias("piece"), F.col("from").isNotNull().alias("synced"))


def round_trip(docs: DataFrame, shared, id_col: str = "doc_id", **sizes) -> DataFrame:
    """Per document: number of ids, digests of the ids and of the bytes they decode to."""
    coded = encode(docs.select(id_col, "text"), shared, out="ids", **sizes)
    coded = coded.select(id_col, "ids", decode(F.col("ids"), shared).alias("bytes"))
    return coded.select(id_col, (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
