"""Language-model scores by deleted interpolation.

P(w | g h) = l3 * c(g h w) / c(g h) + l2 * c(h w) / c(h) + l1 * c(w) / N + l0 / (V + 1),
here for ``order`` 3: the maximum-likelihood estimates of every order (2 by
default) and a uniform floor, mixed by weights that depend on the longest
context that was seen and on how often it was (one bucket for each power of
two).  The weights are learned by expectation-maximisation on held-out
documents, with counts from the other learning documents; then all learning
documents count.  EM ends when no weight moves by ``EM_STOP``, or after
``EM_STEPS`` steps with a warning that names the last move.

Counts never reach the driver and the count tables are never built as a whole:

1. documents are dealt to blocks by hash; each block asks once for every
   distinct word and run of up to ``order`` words in it, and reports its own counts
   (pre-aggregated; a request is an array of hashes for one bucket of the hash
   range);
2. each bucket adds up what the blocks report for its hashes and answers every
   block with the totals, in the order asked: a pair that stands in every
   document costs one entry for each block;
3. each block scores its documents with the answers.

The weights need one short pass over the blocks of held-out documents, which
are summed by the counts of runs and contexts; each EM step is one aggregation
over that table.  Blocks and buckets hold about ``BLOCK_BYTES`` of text, so
their number, not their size, grows with the corpus.  Words are known by
64-bit hashes; counts are 64 bits wide, and sent in as many bytes as the
largest of them needs.

Defined results: a null text is empty and has the end as its only token; a
document with a null id is scored but not learned from; with nothing learned
every score is 0; every row gets a row.
"""

from __future__ import annotations

import logging
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.store import saved
from strata.llm.text import combine, space_words, word_hashes

BLOCK_BYTES = 8 << 20
EM_STEPS, EM_STOP, FLOOR = 15, 1e-3, 1e-6
_START, _END = np.uint64(0x5354415254000001), np.uint64(0x454E440000000002)
_COUNTED, _HELD, _NEW = 0, 1, 2


def _pack(values: np.ndarray, kind: str) -> bytes:
    """Numbers byte plane by byte plane: planes of small numbers are zeros, which Spark's compression removes."""
    array = np.ascontiguousarray(values.astype(kind))
    return array.view(np.uint8).reshape(-1, array.itemsize).T.tobytes()


def _unpack(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def _pack_counts(values: np.ndarray) -> bytes:
    """Counts from 0 in 1, 2, 4 or 8 bytes each, as the largest needs; the first byte says how many."""
    most = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w))
    return bytes([width]) + _pack(values, f"<u{width}")


def _unpack_counts(data: bytes) -> np.ndarray:
    return _unpack(data[1:], f"<u{data[0]}").astype(np.int64)


class _Block:
    """The distinct runs of 1 to ``order`` words of some texts (sorted hashes), and where they end."""

    def __init__(self, texts, order: int):
        hashes = [np.append(word_hashes(space_words(t)), _END) for t in texts]
        self.sizes = np.array([len(h) for h in hashes])
        tokens = np.concatenate(hashes)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.runs, self.at, run = [], [], tokens
        for k in range(order):
            if k:  # a run is the run before it and its own last word; a text begins with the start
                before = np.concatenate(([_START], run[:-1]))
                before[self.first] = _START
                run = combine((before, tokens), len(tokens))
            distinct, at = np.unique(run, return_inverse=True)
            self.runs.append(distinct)
            self.at.append(at.reshape(-1))

    def estimates(self, counts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """At every token: the counts of its runs of 1, 2, ... words, and of the contexts of those from 2 on."""
        own = [c[at] for c, at in zip(counts, self.at)]
        texts = counts[0][np.searchsorted(self.runs[0], _END)]
        contexts = []
        for shorter in own[:-1]:
            context = np.concatenate(([0], shorter[:-1]))
            context[self.first] = texts  # as often as a text has begun
            contexts.append(context)
        return own, contexts


def _bucket_edges(buckets: int) -> np.ndarray:
    return np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)


def _requests(docs: DataFrame, buckets: int, order: int) -> DataFrame:
    edges = _bucket_edges(buckets)

    def ask(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block = _Block(rows["text"], order)
        learned = np.repeat(rows["role"].to_numpy() != _NEW, block.sizes)
        held = rows["role"].iloc[0] == _HELD
        out = []
        for kind, (hashes, at) in enumerate(zip(block.runs, block.at)):
            counts = np.bincount(at, learned, len(hashes)).astype(np.int64)
            cuts = [0, *np.searchsorted(hashes, edges), len(hashes)]
            for bucket, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                if b > a:
                    steps = np.diff(hashes[a:b], prepend=np.uint64(0))
                    out.append((key[0], held, kind, bucket, _pack(steps, "<u8"), _pack_counts(counts[a:b])))
        return pd.DataFrame(out, columns=["block", "held", "kind", "bucket", "hashes", "counts"])
    return docs.groupBy("block").applyInPandas(
        ask, "block bigint, held boolean, kind int, bucket int, hashes binary, counts binary")


def _answers(requests: DataFrame) -> DataFrame:
    """(block, kind, bucket, all, counted): totals in the order asked.  Rows of block -1 hold sums of the bucket."""
    def answer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        hashes = [np.cumsum(_unpack(h, "<u8"), dtype=np.uint64) for h in rows["hashes"]]
        sizes = np.array([len(h) for h in hashes])
        own, which = np.unique(np.concatenate(hashes), return_inverse=True)
        counts = np.concatenate([_unpack_counts(c) for c in rows["counts"]])
        held = np.repeat(rows["held"].to_numpy(), sizes)
        both, counted = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        np.add.at(both, which, counts)  # whole numbers throughout: sums as floats would round beyond 2^53
        np.add.at(counted, which, np.where(held, 0, counts))
        out, end = [], np.cumsum(sizes)
        for block, is_held, a, b in zip(rows["block"], rows["held"], end - sizes, end):
            at = which[a:b]
            out.append((block, *key, _pack_counts(both[at]), _pack_counts(counted[at]) if is_held else b"", 0, 0, 0, 0))
        out.append((-1, *key, b"", b"", both.sum(), (both > 0).sum(), counted.sum(), (counted > 0).sum()))
        return pd.DataFrame(out, columns=["block", "kind", "bucket", "all", "counted", "n_all", "v_all", "n", "v"])
    return requests.groupBy("kind", "bucket").applyInPandas(
        answer, "block bigint, kind int, bucket int, all binary, counted binary, "
                "n_all bigint, v_all bigint, n bigint, v bigint")


def _joined(answers: pd.DataFrame, column: str, order: int) -> list[np.ndarray]:
    """The totals of a block's runs of 1 to ``order`` words."""
    told = answers.sort_values("bucket")
    return [np.concatenate([_unpack_counts(x) for x in told.loc[told["kind"] == kind, column]]) for kind in range(order)]


def context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + the power of two below its count."""
    return np.where(count > 0, np.floor(np.log2(np.maximum(count, 1))).astype(np.int64) + 1, 0)


def weight_bucket(contexts: list[np.ndarray], length: int) -> np.ndarray:
    """0 if no context was seen; else by the longest seen one, 64 buckets for each length, and by its count."""
    out = np.zeros(length, np.int64)
    for k, context in enumerate(contexts):
        out = np.where(context > 0, 64 * k + context_bucket(context), out)
    return out


def _columns(order: int) -> tuple[list[str], list[str]]:
    """Names of the counts of runs of 1, 2, ... words, and of the contexts of those from 2 on."""
    return [f"c{k}" for k in range(1, order + 1)], ["ch", *(f"ch{k}" for k in range(3, order + 1))][:order - 1]


def _held_out_counts(docs: DataFrame, answers: DataFrame, order: int) -> DataFrame:
    """bucket, the counts of runs and contexts, n: the held-out tokens that have them."""
    runs, contexts = _columns(order)
    keys = ["bucket", *runs, *contexts]

    def count(key: tuple, rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({k: [] for k in [*keys, "n"]}, dtype=np.int64)
        block = _Block(rows["text"], order)
        own, before = block.estimates(_joined(told, "counted", order))
        table = pd.DataFrame({"bucket": weight_bucket(before, len(own[0])), **dict(zip(runs, own)),
                              **dict(zip(contexts, before))})
        return table.groupby(keys).size().reset_index(name="n")
    return (docs.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInPandas(count, ", ".join(f"{k} bigint" for k in [*keys, "n"]))
            .groupBy(*keys).agg(F.sum("n").alias("n")))


def learn_weights(counts: DataFrame, n: int, v: int, steps: int = EM_STEPS,
                  order: int = 2) -> dict[int, tuple[float, ...]]:
    """Weights (longest run first, the floor last) by bucket, by EM over held-out counts; bucket -1: without any."""
    if not n:
        return {-1: (0.0,) * order + (1.0,)}
    even = (1 / (order + 1),) * (order + 1)
    runs, contexts = _columns(order)
    weights = {r.bucket: even for r in counts.select("bucket").distinct().collect()}
    parts = [F.when(F.col(h) > 0, F.col(c) / F.col(h)).otherwise(0.0) for c, h in zip(runs[:0:-1], contexts[::-1])]
    parts += [F.col("c1") / F.lit(float(n)), F.lit(1.0 / (v + 1))]
    moved = 0.0
    for _ in range(steps):
        table = F.create_map(*[x for b, w in weights.items() for x in (F.lit(b).cast("bigint"), F.array(*map(F.lit, w)))])
        shares = [table[F.col("bucket")][k] * p for k, p in enumerate(parts)]
        total = sum(shares[1:], shares[0])
        sums = counts.groupBy("bucket").agg(
            *[F.sum(F.col("n") * s / total).alias(f"s{k}") for k, s in enumerate(shares)], F.sum("n").alias("n"))
        new = {}
        for r in sums.collect():  # one row for each power of two
            raised = [max(FLOOR, r[f"s{k}"] / r.n) for k in range(order + 1)]
            new[r.bucket] = tuple(x / sum(raised) for x in raised)
        moved = max(abs(a - b) for k in new for a, b in zip(new[k], weights[k])) if new else 0
        weights = new
        if moved < EM_STOP:
            break
    else:
        logging.getLogger(__name__).warning("EM ended after %d steps; a weight last moved by %.4f", steps, moved)
    return {-1: even} | weights


def weight_table(weights: dict[int, tuple[float, ...]], order: int) -> np.ndarray:
    """Weights by bucket; contexts seen more often than any in the held-out text take those of the most frequent."""
    table = np.array([weights.get(k, weights[-1]) for k in range(64 * (order - 1) + 1)])
    for end in range(64, len(table), 64):
        top = max(k for k in weights if k <= end)
        if top >= 0:
            table[max(top, end - 64) + 1:end + 1] = table[top]
    return table


def _scores(docs: DataFrame, answers: DataFrame, weights: dict, n: int, v: int, order: int) -> DataFrame:
    table = weight_table(weights, order)

    def score(key: tuple, rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"doc_id": pd.Series(dtype=object)})
        block = _Block(rows["text"], order)
        own, contexts = block.estimates(_joined(told, "all", order))
        mix, c1 = table[weight_bucket(contexts, len(own[0]))], own[0]
        p, usable = mix[:, order - 1] * c1 / max(n, 1) + mix[:, order] / (v + 1), mix[:, order - 1] + mix[:, order]
        for k, context in enumerate(contexts):
            weight = mix[:, order - 2 - k]
            p = p + weight * own[k + 1] / np.maximum(context, 1)
            usable = usable + np.where(context > 0, weight, 0)
        if contexts:  # an unseen context has no estimate: its weight goes to the lower orders
            p = np.where(contexts[-1] > 0, p, p / np.maximum(usable, FLOOR))
        base = np.log10((c1 + 1) / (n + v + 1))
        each = lambda x: np.add.reduceat(x, block.first)
        return pd.DataFrame({"doc_id": rows["doc_id"], "n_tokens": block.sizes, "n_known": each((c1 > 0).astype(int)),
                             "base_score": each(base), "score": each(np.log10(p))})
    return (docs.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        score, "doc_id string, n_tokens bigint, n_known bigint, base_score double, score double"))


def score(docs: DataFrame, learned: Column, held: Column, id_col: str = "doc_id", text: str = "text",
          block_bytes: int = BLOCK_BYTES, order: int = 2) -> DataFrame:
    """Scores of all texts under the model learned from the rows with ``learned``; ``held`` names those for EM."""
    if order < 1:
        raise ValueError("the order is 1 or more")
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)), F.count("*")).first()
    blocks = max(1, math.ceil((size[0] + 8 * size[1]) / block_bytes))
    role = F.when(~F.coalesce(learned, F.lit(False)), _NEW).when(held, _HELD).otherwise(_COUNTED)
    spread = F.pmod(F.xxhash64(F.col(id_col), F.col(text)), F.lit(blocks))
    dealt = (docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text).alias("text"), role.alias("role"),
                         spread.alias("block"))
             .withColumn("block", F.when(F.col("role") == _HELD, F.col("block") + blocks).otherwise(F.col("block"))))
    answers = saved(_answers(_requests(dealt, blocks, order)), "counts")
    sums = answers.where((F.col("block") == -1) & (F.col("kind") == 0)).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_all", "v_all", "n", "v")]).first()
    told = answers.where(F.col("block") >= 0).select("block", "kind", "bucket", "all", "counted")
    held_out = saved(_held_out_counts(dealt.where(F.col("role") == _HELD), told.where(F.col("block") >= blocks), order),
                     "held-out")
    weights = learn_weights(held_out, sums.n, sums.v, order=order)
    return (_scores(dealt, told, weights, sums.n_all, sums.v_all, order)
            .withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType)).withColumnRenamed("doc_id", id_col)
            .withColumn("train_tokens", F.lit(sums.n_all).cast("bigint")))
