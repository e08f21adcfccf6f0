"""Personal data: fixed patterns, and identifiers found by the words they stand among; DataFrame functions only.

Four base patterns find e-mail addresses, IP addresses, card and phone numbers.
They are the seeds of a bootstrap over all documents:

1. every seed, and every *candidate* (a token with six digits or an ``@`` that
   is no base span), gives lexical patterns: the word before it, the two words
   before it, the words on both sides;
2. patterns and instances form a graph, one edge for each pair that occurs, counted
   with map-side aggregation.  A pattern's confidence for a kind is the mean
   score of its instances for that kind, where seeds score 1 and candidates 0 at
   first; a candidate's score is that at least one of its trusted patterns is
   right.  Both are computed in turns, ``ROUNDS`` times;
3. candidates in a pattern that is trusted at the end become spans ``like_<kind>``;
   one with an ``@`` can only be an e-mail address, any other none.

A pattern is trusted with a confidence of ``LEAST`` if ``SUPPORT`` different seeds
of the kind stand in it, whatever the number of documents; with a ``share``, at least
one in ``share`` of all seeds must do so too.  Trusted patterns may be as many as the seeds
allow, so Spark decides by their size whether they are broadcast; rows in a frequent pattern
are dealt to ``_SALT`` places.  Scores are whole thousandths, so no result depends on the
order of additions.  No text is shuffled: occurrences are written once, with a row
number, and only those in a trusted pattern are grouped by row.

Patterns that could start inside a run are held to its beginning (the match
is the same, as the run must be taken whole), and repeated groups give
nothing back: a text of any length is scanned in linear time.

Defined results: a null text is empty and has no span; repeated rows each get a
row with the same spans, a null id is an id like any other; an empty table gives no
rows.  Columns other than id and text are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.places import blanked, let, matches
from strata.llm.store import saved

KINDS = ("email", "ip", "card", "phone")
#: The base patterns.  ``(?<![x])|\\G`` holds a match to the beginning of a run or the end of the last match.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PATTERNS = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE)))
_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

#: A candidate begins after a blank or one of ``:=<"'[`` and takes following tokens that begin with a digit or bracket.
CANDIDATE = r"""(?<![^\s:=<"'\[])[^\s0-9@:=<"'\[]*+[0-9@]\S*+(?:\x20[0-9(]\S*+)*+"""
LEAST_DIGITS, AROUND = 6, 60
ROUNDS, LEAST, SUPPORT = 3, 800, 5
_SALT = 16


def _digits(word: Column) -> Column:
    return F.regexp_replace(word, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def value(k: Column) -> Column:
        d = F.substring(digits, -k, F.lit(1)).cast("int")
        return F.when(k % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, k: s + value(k)) % 10 == 0


def _holds(kind: str, word: Column) -> Column:
    """Whether a match of a base pattern is kept."""
    if kind == "ip":
        return word.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return let(_digits(word), lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(word)).between(8, 15)
    return F.lit(True)


def _may(kind: str, text: Column) -> Column:
    """Cheap test that leaves out texts without a match."""
    return {"email": text.contains("@"), "phone": text.contains("+")}.get(kind, text.rlike(PATTERNS[kind]))


def base(text: Column, kind: str) -> Column:
    """Kept matches of one base pattern: array of (start, end, word, left, right)."""
    nothing = F.array().cast("array<struct<start:int,end:int,word:string,left:string,right:string>>")
    return F.when(_may(kind, text), F.filter(matches(text, PATTERNS[kind], AROUND), lambda m: _holds(kind, m["word"]))).otherwise(nothing)


def candidates(text: Column) -> Column:
    """Tokens that may be identifiers and are no base span, without outer punctuation."""
    def core(m: Column) -> Column:
        def cut(word: Column, front: Column) -> Column:
            inner = F.regexp_replace(F.substring(word, front + 1, F.length(word)), r"(?<=[A-Za-z0-9)])[^A-Za-z0-9)]++$", "")
            return let(inner, lambda w: F.struct((m["start"] + front).alias("start"), (m["start"] + front + F.length(w)).alias("end"),
                                                 w.alias("word"), m["left"].alias("left"), m["right"].alias("right")))
        return let(F.length(m["word"]) - F.length(F.regexp_replace(m["word"], r"^[^A-Za-z0-9+(@]++", "")), lambda front: cut(m["word"], front))
    wanted = lambda c: c["word"].rlike("[A-Za-z0-9]@[A-Za-z0-9]") | (F.length(_digits(c["word"])) >= LEAST_DIGITS)
    hidden = text
    for kind in KINDS:
        hidden = F.when(_may(kind, text), blanked(hidden, PATTERNS[kind], lambda w, k=kind: _holds(k, w))).otherwise(hidden)
    return let(hidden, lambda t: F.filter(F.transform(matches(t, CANDIDATE, AROUND), core), wanted))


def _contexts(m: Column) -> Column:
    """The lexical patterns of a match, as 64-bit digests; none without a word before it."""
    clean = lambda s: F.regexp_replace(F.lower(s), r"[^\p{L}]+", " ")

    def of(before: Column, after: Column) -> Column:
        n = F.size(before)
        last, first = F.get(before, n - 1), F.get(after, F.lit(0))
        one = F.array(F.xxhash64(F.lit("1"), last))
        two = F.when(n > 1, F.array(F.xxhash64(F.lit("2"), F.get(before, n - 2), last))).otherwise(F.array().cast("array<bigint>"))
        both = F.when(F.size(after) > 0, F.array(F.xxhash64(F.lit("3"), last, first))).otherwise(F.array().cast("array<bigint>"))
        return F.when(n > 0, F.concat(one, two, both)).otherwise(F.array().cast("array<bigint>"))
    words = lambda s: F.filter(F.split(clean(s), " "), lambda w: w != "")
    return let(words(m["left"]), lambda before: let(words(m["right"]), lambda after: of(before, after)))


def occurrences(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, id, the four arrays of base spans, found): one row for each document, found with the lexical patterns."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("id", "text", *[base(F.col("text"), kind).alias(kind) for kind in KINDS])
    seen = lambda array, kind: F.transform(array, lambda m: F.struct(
        F.lit(kind).alias("seed"), m["start"].alias("start"), m["end"].alias("end"), m["word"].contains("@").alias("mail"),
        F.xxhash64(F.lit(kind), F.lower(m["word"])).alias("instance"), _contexts(m).alias("patterns")))
    tokens = F.when(F.col("text").rlike("[0-9@]"), candidates(F.col("text"))).otherwise(
        F.array().cast("array<struct<start:int,end:int,word:string,left:string,right:string>>"))
    found = F.concat(*[seen(F.col(kind), number) for number, kind in enumerate(KINDS)], seen(tokens, -1))
    places = [F.transform(kind, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))).alias(kind) for kind in KINDS]
    return rows.select(F.monotonically_increasing_id().alias("row"), "id", *places, found.alias("found"))


def _may_be(mail: Column, kind: Column) -> Column:
    return mail == (kind == KINDS.index("email"))


def _in_trusted(rows: DataFrame, best: DataFrame, dealt: Column) -> DataFrame:
    """The rows whose pattern is trusted for a kind that they may be, with that kind and its confidence."""
    salted = best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALT - 1))))
    return (rows.withColumn("salt", F.pmod(dealt, F.lit(_SALT)).cast("int")).join(salted, ["pattern", "salt"]).drop("salt")
            .where(_may_be(F.col("mail"), F.col("kind"))))


def trusted(edges: DataFrame, rounds: int = ROUNDS, least: int = LEAST, support: int = SUPPORT, share: int | None = None) -> DataFrame:
    """(pattern, kind, confidence in thousandths) from edges (pattern, instance, seed, mail); seed is -1 for candidates."""
    sums = lambda of: [F.sum(F.when(F.col("kind") == k, of).otherwise(0)).alias(f"s{k}") for k in range(len(KINDS))]
    own = edges.withColumn("kind", F.col("seed"))
    seeds = saved(own.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), *sums(F.lit(1000)))
                  .where(F.greatest(*[F.col(f"s{k}") for k in range(len(KINDS))]) >= 1000 * support), "pii-patterns")
    needed = support
    if share:
        needed = max(support, -(-edges.where("seed >= 0").select("instance").distinct().count() // share))
    waiting = edges.where("seed < 0").select("pattern", "instance", "mail")

    def chosen(totals: DataFrame) -> DataFrame:
        each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"s{k}").alias("s"), F.col(f"t{k}").alias("t"))
                                   for k in range(len(KINDS))]))
        confidence = F.least(F.lit(999), F.floor(F.col("t") / F.col("n")))
        return (totals.select("pattern", "n", each.alias("e")).select("pattern", "n", "e.*").where(F.col("s") >= 1000 * needed)
                .select("pattern", "kind", confidence.cast("int").alias("confidence")).where(F.col("confidence") >= least))
    best = saved(chosen(seeds.select("*", *[F.col(f"s{k}").alias(f"t{k}") for k in range(len(KINDS))])), "pii-trusted")
    for _ in range(rounds - 1):
        doubt = F.floor(-1e6 * F.log(1 - F.col("confidence") / 1000))
        held = (_in_trusted(waiting, best, F.col("instance"))
                .groupBy("instance", "kind").agg(F.sum(doubt).alias("doubt"))
                .select("instance", "kind", F.floor(1000 - 1000 * F.exp(-F.col("doubt") / 1e6)).alias("score")))
        # an instance may have a large share of all edges: its score is sent to _SALT places
        salted = held.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALT - 1))))
        gained = (waiting.withColumn("salt", F.pmod(F.col("pattern"), F.lit(_SALT)).cast("int")).join(salted, ["instance", "salt"])
                  .groupBy("pattern").agg(*[c.alias(f"g{k}") for k, c in enumerate(sums(F.col("score")))]))
        totals = seeds.join(gained, "pattern", "left").select(
            *seeds.columns, *[(F.col(f"s{k}") + F.coalesce(f"g{k}", F.lit(0))).alias(f"t{k}") for k in range(len(KINDS))])
        best = saved(chosen(totals), "pii-trusted")
    return best


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", support: int = SUPPORT, share: int | None = None) -> DataFrame:
    """Per document: base matches by kind, the digest of the base spans, all spans as text."""
    rows = saved(occurrences(docs, id_col, text), "pii-occurrences")
    each = rows.select("row", F.explode("found").alias("f")).select("row", "f.*")
    pairs = each.select("row", "seed", "start", "end", "mail", "instance", F.explode("patterns").alias("pattern"))
    edges = saved(pairs.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.max("mail").alias("mail")), "pii-edges")
    best = trusted(edges, support=support, share=share)
    hits = (_in_trusted(pairs.where("seed < 0"), best, F.xxhash64("row", "start"))
            .groupBy("row", "start", "end").agg(F.max(F.struct("confidence", (-F.col("kind")).alias("k"))).alias("b"))
            .groupBy("row").agg(F.array_sort(F.collect_list(F.struct((-F.col("b.k")).alias("kind"), "start", "end"))).alias("more")))
    listed = lambda name, array: F.transform(array, lambda m: F.concat_ws(
        ":", name if isinstance(name, Column) else F.lit(name), m["start"].cast("string"), m["end"].cast("string")))
    names = F.array(*[F.lit(f"like_{kind}") for kind in KINDS])
    more = F.transform(F.coalesce("more", F.array().cast("array<struct<kind:int,start:int,end:int>>")), lambda m: F.concat_ws(
        ":", F.get(names, m["kind"]), m["start"].cast("string"), m["end"].cast("string")))
    plain = rows.select("row", "id", *KINDS).join(hits, "row", "left").select(
        "id", *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        F.concat(*[listed(kind, F.col(kind)) for kind in KINDS]).alias("spans"), more.alias("more"))
    return plain.select(F.col("id").alias(id_col), *[f"n_{kind}" for kind in KINDS],
                        F.sha2(F.array_join("spans", ","), 256).alias("base_sha256"),
                        F.array_join(F.concat("spans", "more"), ",").alias("spans"))
