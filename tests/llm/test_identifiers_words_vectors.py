"""op11 personal data, op12 spelling variants, op13 centroids: plain Python comparisons, planted cases, edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import centroids, personal_data, places, queries, spelling
from tests.conftest import SF_SMALL
from tests.oracle_harness import duck, rows_of

DOCS = "doc_id long, text string"

# ------------------------------------------------------------------- op11

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    each = [int(c) for c in reversed(digits)]
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(each)) % 10 == 0


def kept(kind, word):
    digits = re.sub("[^0-9]", "", word)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in word.split(".")),
            "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]()


def base_row(text):
    spans, counts = [], []
    for kind, pattern in BASE.items():
        found = [m for m in re.finditer(pattern, text or "") if kept(kind, m.group())]
        counts.append(len(found))
        spans += [f"{kind}:{m.start()}:{m.end()}" for m in found]
    return (*counts, hashlib.sha256(",".join(spans).encode()).hexdigest()), ",".join(spans)


def pii(spark, rows, **how):
    out = personal_data.scan(spark.createDataFrame(rows, DOCS), **how)
    assert out.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    return out.collect()


def test_base_spans_of_the_table_and_of_random_texts(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in personal_data.scan(docs).collect():
        assert tuple(r)[1:6] == base_row(texts[r.doc_id])[0]
    rng = random.Random(5)
    pieces = ["a", "é", "ß", "𝒳", "@", ".", "-", "+", " ", "\n", "0", "1", "25", "255", "256", "999", "4532015112830366",
              "4532-0151 1283 0366", "x.org", "_", "%", "(", ")", "+1 555 123 4567", "1.2.3.4"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(40)))) for i in range(400)]
    for r in pii(spark, rows, support=10**6):
        assert (tuple(r)[1:6], r.spans) == base_row(rows[r.doc_id][1])


def test_trusted_contexts_find_unseen_identifiers_and_no_others(spark):
    rows = [(i, f"Please call me at +1 (555) 123-45{i:02d} today. My mail is user{i}@site{i}.example.com thanks.") for i in range(10)]
    rows += [(100, "Please call me at 555 123 4567 today."), (101, "we sold 1234567 units and 7654321 boxes"),
             (102, "My mail is jo@localhost thanks"), (102, "My mail is jo@localhost thanks"), (None, "Please call me at (555) 765-4321! today"),
             (103, None), (104, ""), (105, "My mail is 12345678 thanks")]
    found = sorted((str(r.doc_id), r.spans) for r in pii(spark, rows) if r.doc_id is None or r.doc_id >= 100)
    assert found == [("100", "like_phone:18:30"), ("101", ""), ("102", "like_email:11:23"), ("102", "like_email:11:23"), ("103", ""),
                     ("104", ""), ("105", ""), ("None", "like_phone:18:32")]
    # four seeds of a kind are too few
    assert all("like" not in r.spans for r in pii(spark, rows[:4] + rows[10:]))


def brute_trusted(edges, rounds, least, support, share):
    """``trusted`` in plain Python, from {(pattern, instance): (seed, mail)}."""
    seeds = {i for (_, i), (s, _) in edges.items() if s >= 0}
    needed = max(support, -(-len(seeds) // share))
    score, best = {}, {}
    for _ in range(rounds):
        best = {}
        for p in {p for p, _ in edges}:
            own = [(i, s) for (q, i), (s, _) in edges.items() if q == p]
            for k in range(4):
                n = sum(s == k for _, s in own)
                total = 1000 * n + sum(score.get((i, k), 0) for i, s in own if s < 0)
                confidence = min(999, total // len(own))
                if n >= needed and confidence >= least:
                    best[p, k] = confidence
        doubts = defaultdict(int)
        for (p, i), (s, mail) in edges.items():
            for k in range(4):
                if s < 0 and (p, k) in best and mail == (k == 0):
                    doubts[i, k] += math.floor(-1e6 * math.log(1 - best[p, k] / 1000))
        score = {key: math.floor(1000 - 1000 * math.exp(-d / 1e6)) for key, d in doubts.items()}
    return best


@pytest.mark.parametrize("seed", range(3))
def test_scores_equal_plain_python(spark, seed):
    rng = random.Random(seed)
    kinds = {i: rng.choice([-1, -1, 0, 1, 3, 3]) for i in range(60)}
    edges = {}
    for _ in range(500):
        i = rng.randrange(60)
        p = rng.randrange(5) + 10 * max(kinds[i], 0) if rng.random() < 0.8 else rng.randrange(40)
        edges[p, i] = (kinds[i], kinds[i] == 0)
    frame = spark.createDataFrame([(p, i, s, m) for (p, i), (s, m) in edges.items()], "pattern long, instance long, seed int, mail boolean")
    got = personal_data.trusted(frame, rounds=3, least=500, support=2, share=1000)
    assert {(r.pattern, r.kind): r.confidence for r in got.collect()} == brute_trusted(edges, 3, 500, 2, 1000)


@pytest.mark.parametrize("others", [0, 600_000])
def test_a_context_is_trusted_whatever_the_number_of_other_seeds(spark, others):
    """Five seeds are enough; so are the scores of the candidates that stand with them."""
    few = spark.createDataFrame([(-1, -i, 3, False) for i in range(1, 6)] + [(-1, -9, -1, False)] + [(-2, -i, 3, False) for i in range(11, 15)],
                                "pattern long, instance long, seed int, mail boolean")
    more = spark.range(others).select(F.col("id").alias("pattern"), F.col("id").alias("instance"), F.lit(3).alias("seed"), F.lit(False).alias("mail"))
    got = personal_data.trusted(few.union(more)).collect()
    assert [(r.pattern, r.kind, r.confidence) for r in got] == [(-1, 3, 995)]


@pytest.mark.parametrize("text", ["a" * 200_000, "a@" * 80_000, "x@" + "a." * 100_000, "9" * 200_000, "9 " * 80_000, "+1" + "(" * 200_000,
                                  "1" + "!" * 200_000, "1.2.3.4 " * 20_000])
def test_very_long_texts_end(spark, text):
    (r,) = pii(spark, [(1, text)])
    assert r.n_ip == (20_000 if text.startswith("1.2") else 0)


def test_empty_table_and_clashing_columns(spark):
    assert pii(spark, []) == []
    wide = spark.createDataFrame([(1, "a@b.c", 5, 6, 7)], "doc_id long, text string, row int, found int, email int")
    assert [r.spans for r in personal_data.scan(wide).collect()] == ["email:0:5"]


def test_native_plan_has_no_python(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    text = personal_data.occurrences(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text


def test_running_sums_beyond_one_block(spark):
    numbers = list(range(1000))
    got = spark.createDataFrame([(numbers,), ([],), ([5],)], "n array<int>").select(places.running(F.col("n")).alias("s")).collect()
    assert [r.s for r in got] == [[int(x) for x in np.concatenate(([0], np.cumsum(numbers)[:-1]))], [], [0]]


# ------------------------------------------------------------------- op12

LOW = {c: c + 32 for c in range(65, 91)}


def brute_variants(rows):
    n = Counter()
    for key, text in rows:
        for m in re.finditer("[A-Za-zÀ-ÿ]+", text or ""):
            run = m.group().translate(LOW)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    words = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    form, count = {}, {}
    for w in words:
        others = [o for o in words if near(w, o)]
        count[w] = len(others)
        if others and words[best := min(others, key=lambda o: (-words[o], o))] >= 2 * words[w]:
            form[w] = best
    out = set()
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, words[w], count[w], words.get(form.get(w))))
    return out


def variant_rows(spark, rows, **how):
    out = spelling.variants(spark.createDataFrame(rows, DOCS), **how)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = [tuple(r) for r in out.collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("seed,cell,asked", [(0, 4096, 65536), (1, 5, 10), (2, 20, 7)])
def test_variants_equal_brute_force(spark, seed, cell, asked):
    """Few letters, many near words; small cells force splits, salted cells and deep trees."""
    rng = random.Random(seed)
    def word():
        return "".join(rng.choice("abAé÷z") for _ in range(rng.randrange(3, 9)))
    pool = [word() for _ in range(150)]
    rows = [(rng.choice([None, *range(50)]), rng.choice([" ", "-", "1"]).join(rng.choice(pool) for _ in range(rng.randrange(60))))
            for _ in range(60)]
    rows += [(1, None), (2, ""), rows[0], (3, "z" * 3000 + " " + "z" * 2999 + "y " + "z" * 2999)] * 3
    assert variant_rows(spark, rows, cell=cell, queries=asked) == brute_variants(rows)


def test_long_chains_of_forms_end_at_the_last(spark):
    chain = ["aaaaa" + "b" * k for k in range(6)]
    rows = [(1000 + i, " ".join([w] * (3 * 2**k))) for i, (k, w) in enumerate(enumerate(chain))]
    found = variant_rows(spark, rows)
    assert found == brute_variants(rows) and {r[2] for r in found} == {max(found, key=lambda r: r[3])[2]}


def test_variants_of_nothing_and_of_clashing_columns(spark):
    assert variant_rows(spark, []) == set()
    assert variant_rows(spark, [(1, None), (2, "a b c 1 2 3")]) == set()
    wide = spark.createDataFrame([(1, "hello hello hello", "x", 3)], "doc_id long, text string, word string, n int")
    assert [r.word for r in spelling.variants(wide).collect()] == ["hello"]


# ------------------------------------------------------------------- op13

def test_centroids_equal_sql(spark):
    out = queries.SPARK["op13_centroids"](spark, SF_SMALL)
    res = duck(SF_SMALL).execute(queries.SQL["op13_centroids"])
    names = [d[0] for d in res.description]
    assert Counter(rows_of(out.columns, [tuple(r) for r in out.collect()])) == Counter(rows_of(names, res.fetchall()))


def brute_centroids(rows, k, rounds, seed, dim):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: (i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())
    centres = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for j, own in groups.items():
            centres[j] = [sum(col) // len(own) for col in zip(*own)]
    found = [(i, *nearest(v)) for i, v in kept]
    per = Counter()
    for _, d, j in found:
        per[j] += d
    return Counter((i, j, d, per[j], sum(per.values()), hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest())
                   for i, d, j in found)


def test_centroids_equal_brute_force_with_odd_vectors(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(40)]), [float(np.float32(rng.gauss(0, 3))) for _ in range(3)]) for _ in range(80)]
    rows += [(1, None), (2, []), (3, [1.0, None, 2.0]), (4, [float("nan"), 0.0, 0.0]), (5, [float("inf"), 0.0, 0.0]), (6, [1.0, 2.0]),
             *[(7, [0.5, 0.5, 0.5])] * 30]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id long, embedding array<float>, cluster int, v int")
    got = centroids.cluster(df, k=5, rounds=4, dim=3)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == brute_centroids(rows, 5, 4, 3, 3)


def test_centroids_of_few_vectors_of_none_and_of_huge_ones(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    empty = centroids.cluster(make([(1, None)]), dim=2)
    assert empty.count() == 0 and [f.dataType.simpleString() for f in empty.schema] == ["bigint", "int", "bigint", "bigint", "bigint", "string"]
    assert sorted(r.distance for r in centroids.cluster(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])]), dim=2).collect()) == [0, 0]
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(make([(1, [1e30, 2.0])]), dim=2).collect()
