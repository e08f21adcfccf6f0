"""Spelling variants: words one edit apart, found with k-d trees over letter counts.

A word is seen as the vector of its letter counts.  One replaced letter lowers
one count by one and raises another, one inserted letter raises one count: the
vectors of near words are at most 2 apart (L1), for words of one length or of
neighbouring lengths.

1. Words and their numbers are counted in every task first; what is left after
   the least length and number is the vocabulary.
2. For each length whose words do not fit one cell, the upper part of a k-d
   tree is grown level by level: histograms of the counts in every cell still
   too large give the split that halves it best.  There are at most
   ``2 * MAX_CELLS`` splits however large the vocabulary is; only they reach
   the driver and the tasks.
3. Every word is sent to the cells of its own length and of the next one whose
   box a single edit can reach.  Crossing a split uses up the raised or the
   lowered letter, so a word reaches few cells (about the square of the tree's
   depth); of two cells of one length only the lower asks the higher.
4. Each cell grows the rest of its tree and searches it for all its queries at
   once, pruning by the same rule; pairs that are left are compared letter by
   letter.  A cell with many queries is searched in several tasks.
5. A word's form is its most frequent near word if that is frequent enough.
   Forms are followed by pointer doubling: frequencies at least double at every
   step, so a chain has at most 63 of them and six or seven joins reach its end.

Letter counts are folded to ``DIMENSIONS`` and cut off at ``_MOST``; neither
makes a distance larger, so no near word is lost.  Word lists between steps are
written tables; no text is shuffled.

Defined results: a null text has no words; a null id is read as an empty one; an
empty table gives no rows; repeated rows count again.  Texts are read whole,
words of any length are counted and compared.  Equal numbers go to the first
word in code-point order.  Columns other than id and text are not read,
whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from strata.llm.store import saved

#: What a word is made of, how misspellings are planted, and which words are compared.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
PLANT, LEAST_LENGTH, LEAST_NUMBER, FORM_TIMES = 97, 5, 3, 2

DIMENSIONS, _MOST = 32, 120
CELL, QUERIES, MAX_CELLS = 4096, 65_536, 1 << 14
_HELD = 1 << 24  # characters of distinct words that a task holds before it hands them on
_LOWER = {c: c + 32 for c in range(65, 91)}
_LEAF, _PAIR_BYTES = 32, 1 << 23


def planted(key: str, run: str) -> str:
    """The run, or without one code point where the digest of ``key:run`` says so."""
    h = zlib.crc32(f"{key}:{run}".encode())
    at = h % len(run)
    return run if h % PLANT else run[:at] + run[at + 1:]


def words(key: str, text: str) -> Counter:
    """Numbers of a document's words of the least length."""
    runs: Counter = Counter()
    for run, n in Counter(RUN.findall(text)).items():
        runs[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    out: Counter = Counter()
    for run, n in runs.items():
        if len(run) >= LEAST_LENGTH:
            word = planted(key, run)
            if len(word) >= LEAST_LENGTH:
                out[word] += n
    return out


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words of the least length and number."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        size = 0
        for batch in batches:
            for key, value in zip(batch["key"], batch["text"]):
                found = words(key, value)
                size += sum(len(w) for w in found if w not in held)
                held.update(found)
                if size > _HELD:
                    yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                    held, size = Counter(), 0
        if held:
            yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"), F.col(text).alias("text"))
    return (rows.where("text is not null").mapInPandas(count, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_NUMBER))


def vectors(found: list[str]) -> np.ndarray:
    """Letter counts, one row for each word."""
    data = np.frombuffer("".join(found).encode("latin-1"), np.uint8).astype(np.int64)
    letter = np.where(data < 128, data - 97, 26 + data % (DIMENSIONS - 26))
    of = np.repeat(np.arange(len(found)), [len(w) for w in found])
    counts = np.bincount(of * DIMENSIONS + letter, minlength=len(found) * DIMENSIONS)
    return np.minimum(counts.reshape(-1, DIMENSIONS), _MOST).astype(np.int8)


class Tree:
    """Splits of the upper k-d trees: for each length the root, for each node its split or none."""

    def __init__(self):
        self.splits: dict[int, dict[int, tuple[int, int]]] = {}  # length -> node -> (dimension, value); children 2k, 2k + 1

    def own(self, length: int, vecs: np.ndarray) -> np.ndarray:
        """The leaf of every vector."""
        at = np.empty(len(vecs), object)  # node numbers outgrow 64 bits in a degenerate tree
        splits = self.splits.get(length, {})
        stack = [(1, np.arange(len(vecs)))]
        while stack:
            node, rows = stack.pop()
            if node not in splits:
                at[rows] = node
            elif len(rows):
                d, t = splits[node]
                left = vecs[rows, d] <= t
                stack += [(2 * node, rows[left]), (2 * node + 1, rows[~left])]
        return at

    def reached(self, length: int, vecs: np.ndarray, lowered: bool) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows): every leaf that a raised letter, and a lowered one if ``lowered``, can reach."""
        splits = self.splits.get(length, {})
        stack = [(1, *_free(vecs, lowered))]
        while stack:
            node, rows, up, down = stack.pop()
            if not len(rows):
                continue
            if node not in splits:
                yield node, rows
                continue
            for side, part in enumerate(_parted(vecs, rows, up, down, *splits[node])):
                stack.append((2 * node + side, *part))


def _free(vecs: np.ndarray, lowered: bool):
    none = np.full(len(vecs), -1, np.int8)
    return np.arange(len(vecs)), none, none if lowered else np.full(len(vecs), -2, np.int8)


def _parted(vecs, rows, up, down, d, t):
    """The rows that go on to either side of a split, with the dimension each has raised and lowered (-1: still free)."""
    value = vecs[rows, d] + (up == d) - (down == d)
    left, right = value <= t, value > t
    raised, lowered = (value == t) & (up == -1), (value == t + 1) & (down == -1)
    go_left, go_right = left | lowered, right | raised
    return ((rows[go_left], up[go_left], np.where(lowered, d, down).astype(np.int8)[go_left]),
            (rows[go_right], np.where(raised, d, up).astype(np.int8)[go_right], down[go_right]))


def grow(vocab: DataFrame, cell: int = CELL, max_cells: int = MAX_CELLS) -> Tree:
    """The upper trees: every leaf holds at most ``cell`` words, or words of one and the same vector."""
    spark, tree = vocab.sparkSession, Tree()
    sizes = vocab.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    cell = max(cell, total // max_cells)
    todo = {(r["length"], 1) for r in sizes.where(F.col("n") > cell).collect()}
    while todo:
        shared = spark.sparkContext.broadcast((tree, {length: {n for k, n in todo if k == length} for length, _ in todo}))

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            grown, open_ = shared.value
            held: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                size = batch["word"].str.len()
                for length in set(size) & open_.keys():
                    vecs = vectors(list(batch["word"][size == length]))
                    at = grown.own(length, vecs)
                    for node in set(at) & open_[length]:
                        own = vecs[at == node].astype(np.int64) + np.arange(DIMENSIONS) * (_MOST + 1)
                        held[length, node] = (held.get((length, node), 0)
                                              + np.bincount(own.reshape(-1), minlength=DIMENSIONS * (_MOST + 1)))
            for (length, node), counts in held.items():
                some = np.flatnonzero(counts)
                yield pd.DataFrame({"length": length, "node": str(node), "d": some // (_MOST + 1), "t": some % (_MOST + 1),
                                    "n": counts[some]})

        seen = (vocab.mapInPandas(count, "length int, node string, d int, t int, n bigint")
                .groupBy("length", "node", "d", "t").agg(F.sum("n").alias("n")))
        along = Window.partitionBy("length", "node", "d")
        cuts = seen.select("length", "node", "d", "t", F.sum("n").over(along.orderBy("t")).alias("left"),
                           F.sum("n").over(along).alias("all"))
        best = (cuts.where("left < all").groupBy("length", "node")
                .agg(F.max(F.struct(F.least("left", F.col("all") - F.col("left")).alias("less"), "d", "t", "left", "all")).alias("b")))
        done, todo = todo, set()
        for r in best.collect():
            length, node, b = r["length"], int(r["node"]), r["b"]
            tree.splits.setdefault(length, {})[node] = (b["d"], b["t"])
            todo |= {(length, 2 * node + side) for side, n in ((0, b["left"]), (1, b["all"] - b["left"])) if n > cell}
        if todo == done:
            break
    return tree


def routed(vocab: DataFrame, tree: Tree) -> DataFrame:
    """(length, cell, role, word, n): a word in its own cell (0), as a query of its length (1), of the next length (2)."""
    shared = vocab.sparkSession.sparkContext.broadcast(tree)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grown = shared.value
        for batch in batches:
            size = batch["word"].str.len()
            parts = []

            def send(rows: pd.DataFrame, length: int, cell, role: int) -> None:
                parts.append(rows.assign(length=length, cell=cell, role=role))
            for length in sorted(set(size)):
                own = batch[size == length]
                vecs = vectors(list(own["word"]))
                at = grown.own(length, vecs)
                send(own, length, [str(a) for a in at], 0)
                for role, target in ((1, length), (2, length + 1)):
                    for cell, rows in grown.reached(target, vecs, role == 1):
                        rows = rows[at[rows] < cell] if role == 1 else rows
                        if len(rows):
                            send(own.iloc[rows], target, str(cell), role)
            if parts:
                yield pd.concat(parts)[["length", "cell", "role", "word", "n"]]
    return vocab.mapInPandas(route, "length int, cell string, role int, word string, n bigint")


def _letters(found: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(found).encode("latin-1"), np.uint8).reshape(len(found), length)


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of one length differ in exactly one letter."""
    return (a != b).sum(1) == 1


def inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether a row of ``b`` is that of ``a`` with one more letter."""
    same_start = np.logical_and.accumulate(a == b[:, :-1], 1).sum(1)
    same_end = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], 1).sum(1)
    return same_start + same_end >= a.shape[1]


def _pairs(vecs, items, queries, lowered: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query rows, item rows) that the tree and the distance of their vectors leave, in bounded pieces.

    ``items`` and ``queries`` are row numbers of ``vecs``.
    """
    everything, up, down = _free(vecs[queries], lowered)
    stack = [(items, queries[everything], up, down)]
    while stack:
        items, rows, up, down = stack.pop()
        if not len(rows) or not len(items):
            continue
        own = vecs[items]
        split = _middle(own) if len(items) > _LEAF else None
        if split is None:
            step = max(1, _PAIR_BYTES // (len(items) * DIMENSIONS))
            for at in range(0, len(rows), step):
                some = rows[at:at + step]
                apart = np.abs(vecs[some][:, None, :] - own[None, :, :]).sum(2, dtype=np.int32)
                q, k = np.nonzero(apart <= (2 if lowered else 1))
                yield some[q], items[k]
            continue
        left = own[:, split[0]] <= split[1]
        (rows_l, up_l, down_l), (rows_r, up_r, down_r) = _parted(vecs, rows, up, down, *split)
        stack += [(items[left], rows_l, up_l, down_l), (items[~left], rows_r, up_r, down_r)]


def _middle(own: np.ndarray) -> tuple[int, int] | None:
    """The dimension and value that halve the rows best; none if all rows are alike."""
    best = (0, 0, 0)
    for d in np.flatnonzero(own.max(0) != own.min(0)):
        below = np.cumsum(np.bincount(own[:, d]))
        less = np.minimum(below, len(own) - below)
        t = int(less.argmax())
        best = max(best, (int(less[t]), int(d), t))
    return best[1:] if best[0] else None


def search(cell: pd.DataFrame) -> pd.DataFrame:
    """Near pairs of one cell: items with each other, and queries with items."""
    cell = cell.sort_values(["role", "word"], ignore_index=True)
    length, word, n, role = int(cell["length"].iloc[0]), cell["word"], cell["n"].to_numpy(), cell["role"].to_numpy()
    vecs = vectors(list(word))
    items = np.flatnonzero(role == 0)
    # a salted cell's items are compared with each other in its first part alone
    asks = items if cell["part"].iloc[0] == 0 else items[:0]
    out = []
    for lowered, queries in ((True, np.concatenate((asks, np.flatnonzero(role == 1)))), (False, np.flatnonzero(role == 2))):
        if not len(queries) or not len(items):
            continue
        fixed = _letters(list(word[items]), length)
        text = _letters(list(word[queries]), length if lowered else length - 1)
        place = np.zeros(len(cell), np.int64)
        place[queries] = np.arange(len(queries))
        where = np.zeros(len(cell), np.int64)
        where[items] = np.arange(len(items))
        test = replaced if lowered else inserted
        for q, k in _pairs(vecs, items, queries, lowered):
            if lowered:
                once = (role[q] == 1) | (q < k)
                q, k = q[once], k[once]
            step = max(1, _PAIR_BYTES // length)
            for at in range(0, len(q), step):
                some, other = q[at:at + step], k[at:at + step]
                near = test(text[place[some]], fixed[where[other]])
                out.append((some[near], other[near]))
    q, k = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int), np.zeros(0, int))
    return pd.DataFrame({"a": word.to_numpy()[q], "a_n": n[q], "b": word.to_numpy()[k], "b_n": n[k]})


def near_pairs(vocab: DataFrame, cell: int = CELL, queries: int = QUERIES) -> DataFrame:
    """(a, a_n, b, b_n): every unordered pair of near words once."""
    sent = saved(routed(vocab, grow(vocab, cell)), "spelling-routed")
    asked = sent.where("role > 0").groupBy("length", "cell").agg(F.count(F.lit(1)).alias("asked"))
    many = asked.select("length", "cell", F.ceil(F.col("asked") / queries).cast("int").alias("parts")).where("parts > 1")
    both = sent.join(many, ["length", "cell"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    one = F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    parted = both.select("length", "cell", "role", "word", "n", F.explode(F.when(F.col("role") == 0, every).otherwise(one)).alias("part"))
    return parted.groupBy("length", "cell", "part").applyInPandas(search, "a string, a_n bigint, b string, b_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that forms lead to; ``forms`` holds (word, form), each word once."""
    state = saved(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while not state.where("moved").isEmpty():
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        state = saved(state.join(onward, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "spelling-roots")
    return state.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text", cell: int = CELL, queries: int = QUERIES) -> DataFrame:
    """Per word of the vocabulary: word, form, root, n, n_near, form_n."""
    vocab = saved(vocabulary(docs, id_col, text), "spelling-words")
    ways = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
                             F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n"))))
    near = (near_pairs(vocab, cell, queries).select(ways.alias("w")).select("w.*").groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")))
    frequent = -F.col("best.less") >= FORM_TIMES * F.col("n")
    known = saved(vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(frequent, F.col("best.other")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n")), "spelling-forms")
    ends = roots(known.where("form is not null").select("word", "form"))
    return (known.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
