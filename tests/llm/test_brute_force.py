"""Operators against plain Python that goes over everything, on small random tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import decontaminate, interpolation, language_profiles, queries, repetition, url_filter
from tests.conftest import SF_SMALL
from tests.llm.test_llm import WORDS, bench, by_id, docs
from tests.oracle_harness import compare, duck


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_decontamination_against_plain_python(spark):
    rng = np.random.default_rng(7)
    items = [(k, " ".join(rng.choice(WORDS[:3], rng.integers(1, 40))), "c") for k in range(40)]
    items += [(100 + k, "Long-item " + " ".join(WORDS * 3), "c") for k in range(9)] + [(200, None, "c"), (None, "mu nu", "c")]
    texts = [" ".join(rng.choice(WORDS[:4], rng.integers(0, 60))) for _ in range(60)] + [" ".join(WORDS * 4).upper(), None]
    words = lambda t: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    windows = defaultdict(set)
    for item, text, _ in items:
        own = words(text)
        for k in range(max(1, len(own) - 9) if own else 0):
            windows[tuple(own[k:k + 10])].add(item)
    for size in (1 << 20, 30):                                            # one part, and many
        got = by_id(decontaminate.contamination(docs(spark, texts), bench(spark, items), part_windows=size))
        for k, text in enumerate(texts):
            own, hit, found = words(text), set(), set()
            for window, owners in windows.items():
                for at in range(len(own) - len(window) + 1):
                    if tuple(own[at:at + len(window)]) == window:
                        hit.update(range(at, at + len(window)))
                        found |= owners - {None}
            r = got[k + 1]
            assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(own), len(hit), len(found), bool(hit))
            assert r.items_sha256 == hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()


def test_units_of_long_items_and_of_many_copies(spark):
    text = " ".join(f"w{k}" for k in range(100))
    rows = decontaminate.units(bench(spark, [(k, text, "c") for k in range(50)]), 10, unit_windows=30, unit_items=20).collect()
    assert {r.windows for r in rows} == {30, 1} and max(len(r["items"]) for r in rows) < 50
    ids = defaultdict(list)
    for r in rows:
        ids[r.words] += r["items"]
    assert len(ids) == 4 and all(sorted(map(int, x)) == list(range(50)) for x in ids.values())
    machine = decontaminate.Windows([(r.words, r["items"]) for r in rows], 10)
    hit, items = machine.find(f"x {text} y".encode().split())
    assert hit.sum() == 100 and len(items) == 50


def repetition_by_hand(text):
    words = [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w]
    chars = sum(map(len, words))
    seen, dup_lines, dup_chars, lines = set(), 0, 0, 0
    for line in (text or "").split("\n"):
        own = [w for w in re.split("[\x20\x09-\x0D]+", line) if w]
        if own:
            lines += 1
            if line in seen:
                dup_lines, dup_chars = dup_lines + 1, dup_chars + sum(map(len, own))
            seen.add(line)

    def inside(n, top):
        places = defaultdict(list)
        for k in range(len(words) - n + 1):
            places[tuple(words[k:k + n])].append(k)
        many = {w: p for w, p in places.items() if len(p) > 1}
        if top and many:
            best = max(many, key=lambda w: len(many[w]))                   # the first of equally frequent ones
            many = {best: many[best]}
        return {k + j for p in many.values() for k in p for j in range(n)}

    size = lambda at: sum(len(words[k]) for k in at)
    broken = [f"top_{n}_gram" for n, limit in repetition.TOP_NGRAM.items() if size(inside(n, True)) * 100 > limit * chars]
    broken += [f"dup_{n}_gram" for n, limit in repetition.DUP_NGRAM.items() if size(inside(n, False)) * 100 > limit * chars]
    broken += ["dup_line_chars"] * (dup_chars * 100 > 20 * chars) + ["dup_lines"] * (dup_lines * 100 > 30 * lines)
    repeats = len(inside(3, False))
    failed = len(words) < 50 or 100 * repeats > 50 * len(words)
    return (len(words), chars, len(re.findall(r"[#*$%&|<>]", text or "")), dup_lines, repeats, broken, failed,
            not failed and not broken)


def test_repetition_against_plain_python(spark):
    rng = np.random.default_rng(13)
    vocabulary = [*WORDS, "é#", "Ω&|", *(f"w{k}" for k in range(400))]
    texts = []
    for k in range(120):
        words = [str(w) for w in rng.choice(vocabulary[:int(rng.choice([2, 5, 22, 100, 420]))], rng.integers(0, 160))]
        for _ in range(int(rng.integers(0, 4))):                           # a passage put in again
            if len(words) > 12:
                a = int(rng.integers(len(words) - 12))
                words += words[a:a + int(rng.integers(2, 12))] * int(rng.integers(1, 4))
        texts.append("".join(w + str(rng.choice([" ", "  ", "\n", "\t"], p=[.8, .05, .1, .05])) for w in words))
    texts += ["a\nb\n a\na\n" * 20, " ".join(f"u{k}" for k in range(70)), None, ""]
    got = by_id(repetition.repetition(docs(spark, texts).drop("n_words")))
    want = [repetition_by_hand(t) for t in texts]
    assert len({w[-1] for w in want}) == 2                                 # some stay, some go
    for k, w in enumerate(want):
        r = got[k + 1]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.broken, r.base_failed, r.kept) == w


def interpolated_by_hand(tokens, fold, order):
    """log10 probabilities of token lists, learned from those whose fold is not 2, with fold 3 for EM."""
    def counted(ids):
        runs = [Counter() for _ in range(order + 1)]
        for i in ids:
            own = ["<s>"] * order + tokens[i]
            for at in range(order, len(own)):
                for k in range(1, order + 1):
                    runs[k][tuple(own[at - k + 1:at + 1])] += 1
            for k in range(1, order):                                      # a context of nothing but the start
                runs[k][("<s>",) * k] += 1
        return runs, sum(len(tokens[i]) for i in ids), len({w for i in ids for w in tokens[i]})

    def estimates(model, own, at):
        runs, n, v = model
        contexts = [runs[k - 1][tuple(own[at - k + 1:at])] for k in range(2, order + 1)]
        parts = [runs[1][(own[at],)] / max(n, 1), 1 / (v + 1)]
        for k, context in enumerate(contexts, start=2):
            parts.insert(0, runs[k][tuple(own[at - k + 1:at + 1])] / context if context else None)
        seen = [(k, math.floor(math.log2(c))) for k, c in enumerate(contexts) if c]
        return parts, 64 * seen[-1][0] + 1 + seen[-1][1] if seen else 0

    learned = [i for i in range(len(tokens)) if fold[i] != 2]
    model = counted([i for i in learned if fold[i] != 3])
    held = [estimates(model, ["<s>"] * order + tokens[i], at + order)
            for i in learned if fold[i] == 3 for at in range(len(tokens[i]))]
    even = [1 / (order + 1)] * (order + 1)
    weights = {b: even for _, b in held}
    for _ in range(15):
        new = {}
        for bucket in weights:
            sums, of = [0.0] * (order + 1), [p for p, b in held if b == bucket]
            for parts in of:
                shares = [w * (p or 0) for w, p in zip(weights[bucket], parts)]
                sums = [s + x / sum(shares) for s, x in zip(sums, shares)]
            raised = [max(1e-6, s / len(of)) for s in sums]
            new[bucket] = [x / sum(raised) for x in raised]
        moved = max(abs(a - b) for k in new for a, b in zip(new[k], weights[k]))
        weights = new
        if moved < 1e-3:
            break
    model, out = counted(learned), []
    for own in tokens:
        total = 0.0
        for at in range(len(own)):
            parts, bucket = estimates(model, ["<s>"] * order + own, at + order)
            end = 0 if bucket == 0 else (bucket + 63) // 64 * 64
            top = max((b for b in weights if b <= end), default=-1)
            mix = weights[top] if 0 <= top < bucket else weights.get(bucket, even)
            given = [(w, p) for w, p in zip(mix, parts) if p is not None]
            total += math.log10(sum(w * p for w, p in given) / sum(w for w, _ in given))
        out.append(total)
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_interpolation_scores_against_plain_python(spark, order):
    rng = np.random.default_rng(21)
    texts = [" ".join(rng.choice(WORDS[:int(rng.choice([3, 8, 22]))], rng.integers(0, 50))) for _ in range(70)]
    texts += [None, "Unseen Word here", "alpha Unseen beta"]
    fold = [zlib.crc32(str(k).encode()) % 7 for k in range(len(texts))]
    want = interpolated_by_hand([lowered(t).split() + ["</s>"] for t in texts], fold, order)
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7))
    got = by_id(interpolation.score(d, own != 2, own == 3, block_bytes=700, order=order))
    assert len(got) == len(texts)
    for k, score in enumerate(want):
        assert got[k].score == pytest.approx(score, rel=1e-9), (k, texts[k])


def test_counts_beyond_32_bits_stay_whole():
    for counts in ([], [0, 255], [256, 0], [70_000, 1], [(1 << 33) + 1, 5, 0], [(1 << 53) + 1]):
        values = np.array(counts, np.int64)
        assert interpolation._unpack_counts(interpolation._pack_counts(values)).tolist() == counts


def test_totals_beyond_32_bits_stay_whole(spark):
    pack, counts = interpolation._pack, interpolation._pack_counts
    steps = pack(np.array([5, 4], np.uint64), "<u8")                       # the hashes 5 and 9
    big = (1 << 53) + 1
    rows = [(block, False, 0, 0, steps, counts(np.array([big, 1], np.int64))) for block in (0, 1)]
    asked = spark.createDataFrame(rows, "block long, held boolean, kind int, bucket int, hashes binary, counts binary")
    for r in interpolation._answers(asked).where("block >= 0").collect():
        assert interpolation._unpack_counts(bytes(r["all"])).tolist() == [2 * big, 2]


@pytest.mark.parametrize("name", ["op1_decontamination", "op5_perspectives"])
def test_query_matches_its_sql(spark, name):
    r = compare(spark, SF_SMALL, name, duck(SF_SMALL))
    assert r.get("values_match"), r


def test_perspectives_sql_on_odd_rows(spark):
    import duckdb
    from strata.llm import perspectives
    rng = np.random.default_rng(2)
    names = ["system", "ann", "bob", None, "Zoë"]
    rows = [(int(rng.integers(1, 6)), int(rng.integers(0, 900)), names[int(rng.integers(5))], str(rng.choice(["", "hi", "ä\nb"])))
            for _ in range(300)]
    rows += [*rows[:9], (7, None, "ann", None), (7, 1, "ann", "x"), (8, 3, "system", "only"), (None, 1, "ann", "lost")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.register("conversations", turns.toArrow())
    want = con.execute(perspectives.sql()).fetchall()
    names = [c[0] for c in con.description]
    got = [tuple(r) for r in perspectives.rendered(turns).select(*names).collect()]
    assert Counter(got) == Counter(want)


def grams_by_hand(text):
    """Counts of one to three letters, by a key that orders as the n-grams do."""
    padded = " " + " ".join("".join(c if c.isalpha() else " " for c in (text or "").lower()).split()) + " "
    if padded == "  ":
        return Counter()
    found = [padded[k:k + n] for n in (1, 2, 3) for k in range(len(padded) - n + 1)]
    found = [g for g in found if g != " " and (len(g) < 3 or g[1] != " ")]
    return Counter(sum(ord(c) << 21 * k for k, c in enumerate(g)) for g in found)


def test_language_profiles_against_plain_python(spark):
    taught = queries.table(spark, SF_SMALL, "documents").select("doc_id", "text", "lang").collect()
    rows = [(r.doc_id, r.text, r.lang) for r in taught] + [(10**9, "Ä ö ß", None), (10**9 + 1, None, "en"), (10**9 + 2, "12 #", "en")]
    ranked = lambda c: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:300]]
    fold = {k: zlib.crc32(str(k).encode()) % 4 == 2 for k, _, _ in rows}
    totals = defaultdict(Counter)
    for k, text, lang in rows:
        if not fold[k] and lang is not None and text is not None:
            totals[lang] += grams_by_hand(text)
    profiles = {lang: {g: at for at, g in enumerate(ranked(c))} for lang, c in sorted(totals.items()) if c}
    got = by_id(language_profiles.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    for k, text, _ in rows:
        own = ranked(grams_by_hand(text))
        away = {lang: sum(abs(p[g] - at) if g in p else 300 for at, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(away, key=away.get) if own else "und"
        assert (got[k].lang_pred, got[k].held_out) == (best, fold[k])
        assert got[k].score == pytest.approx(1 - away[best] / (300 * len(own)) if own else 0.0)


def test_url_filter_against_search(spark):
    rng = np.random.default_rng(17)
    hosts = ["a.org", "b.org", "x.example.com", "www.example.com", "q.net", "net", "ok.com", "c.org"]
    paths = ["/en/1", "/es/2", "/fr/", "/z", "/en"]
    spots = [(h, p) for h in hosts for p in paths]
    pages, near = [], defaultdict(set)
    for k in range(60):
        here, there = (spots[int(x)] for x in rng.integers(0, len(spots), 2))
        html = f'<link rel="canonical" href="http://{there[0]}{there[1]}">' if k % 3 else None
        pages.append((k, f"HTTP://{here[0].upper()}{here[1]}#f", html))
        if html:
            near[here].add(there)
            near[there].add(here)

    def rule(spot):
        fits = [(len(h + p), h + p, v) for v, h, p in queries.RULES
                if (spot[0] == h or spot[0].endswith("." + h)) and spot[1].startswith(p)]
        return max(fits)[1:] if fits else (None, None)

    def verdict(spot):
        if rule(spot)[1]:
            return rule(spot)[1]
        seen, todo = {spot}, [spot]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        given = {rule(s)[1] for s in seen}
        return "block" if "block" in given and "allow" not in given else "allow"

    rules = spark.createDataFrame(queries.RULES, "verdict string, host string, path string")
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filter.judge(table, rules).collect()}
    assert {r.verdict for r in got.values()} == {"allow", "block"}
    for k, url, _ in pages:
        spot = next(s for s in spots if url == f"HTTP://{s[0].upper()}{s[1]}#f")
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == (*spot, rule(spot)[0], verdict(spot))
