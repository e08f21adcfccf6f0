"""Secret detection with DataFrame functions only.

Three base patterns find assignments, access keys and hexadecimal keys.  The
method adds what has no fixed form: in runs of a character class (candidates),
the Shannon entropy of a window of ``WINDOW`` characters is followed along the
run.  The counts of the window's characters are kept and changed by the one
that enters and the one that leaves, so a step costs the same at any length.
Windows above the class's limit are merged into spans; a span must hold every
kind of character that its class needs.  Places that match the allow list
(identifiers, alphabets, the surroundings of a documentation word) are blanked
before the candidates are looked for, so what stands beside them in the same
run is judged all the same; base spans are never suppressed.

Matches come with their places from ``places``, in time that grows with their
number.  Everything is evaluated row by row, in
the JVM; nothing is shuffled.

Defined results: a null text is empty and has no span; places are code points,
the end exclusive; every row is judged by itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.places import matches

#: The base patterns with the least length of the group that is judged.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
KINDS = ["assign", "access", "hex"]

WINDOW = 20


@dataclass(frozen=True)
class CharClass:
    """Characters, the least entropy of a window in bits, and what a span must contain."""

    name: str
    alphabet: str
    pattern: str
    bits: float
    needs: tuple[str, ...]


#: The limits are the 0.1 % quantiles of the entropy of 60,000 random windows of 20 characters: 2.71 bits for 16
#: characters (mean 3.36), 3.18 for base32 (3.79), 3.22 for 36 (3.84), 3.48 for 62 and 64 (4.03 and 4.04).
#: Hexadecimal runs are left to the first class: the last two need a letter beyond F.
CLASSES = (
    CharClass("entropy_hex", "0123456789abcdefABCDEF", "[0-9a-fA-F]{20,}", 2.7, ("[0-9]", "[a-fA-F]")),
    CharClass("entropy_base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
              "[A-Za-z0-9+/_=-]{20,}", 3.48, ("[0-9]", "[A-Z]", "[a-z]")),
    CharClass("entropy_lower", "abcdefghijklmnopqrstuvwxyz0123456789", "[a-z0-9]{20,}", 3.22, ("[0-9]", "[g-z]")),
    CharClass("entropy_upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "[A-Z0-9]{20,}", 3.18, ("[0-9]", "[G-Z]")),
)
ALLOW = (
    "(?<![0-9A-Za-z])[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}(?![0-9A-Za-z])",
    f"[A-Za-z0-9]{{0,{WINDOW}}}(?i:example|sample|placeholder|dummy)[A-Za-z0-9]{{0,{WINDOW}}}",
    "(?i:abcdefghij(?:klmnopqrstuvwxyz)?|0123456789|1234567890)",
)


def _runs(text: Column, pattern: str, group: int = 0) -> Column:
    """Non-overlapping matches from the left: array of (start, word, judged group)."""
    found = matches(text, pattern)
    if not group:
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), m["word"].alias("word"), m["word"].alias("judged")))
    return F.zip_with(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda m, judged: F.struct(
        m["start"].alias("start"), m["word"].alias("word"), judged.alias("judged")))


def _marked(text: Column, kind: str, order: int, runs: Column) -> Column:
    return F.transform(runs, lambda r: F.struct(r["start"].alias("start"), F.lit(order).alias("order"),
                                                (r["start"] + F.length(r["word"])).alias("end"),
                                                F.lit(kind).alias("kind")))


def _weight(count: Column) -> Column:
    """count * log2(count), 0 for 0."""
    return F.when(count > 1, count * F.log2(count)).otherwise(F.lit(0.0))


def dense_windows(word: Column, cls: CharClass, window: int = WINDOW) -> Column:
    """Merged spans (start, end) of the windows of a run whose entropy reaches the class's limit."""
    chars = F.split(word, "")
    moves = F.arrays_zip(chars.alias("enters"), F.concat(F.array_repeat(F.lit(None).cast("string"), window), chars).alias("leaves"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    empty = F.struct(F.lit(0).alias("at"), F.array_repeat(F.lit(0), len(cls.alphabet)).alias("counts"),
                     F.lit(0.0).alias("sum"), F.lit(-1).alias("start"), F.lit(-1).alias("end"), none.alias("spans"))
    # the span that grows is two numbers: an array is copied when a span ends, not at every step
    ended = lambda state: F.when(state["start"] >= 0, F.concat(state["spans"], F.array(F.struct(
        state["start"].alias("start"), state["end"].alias("end"))))).otherwise(state["spans"])

    def move(state: Column, step: Column) -> Column:
        enters, leaves = F.instr(F.lit(cls.alphabet), step["enters"]), F.instr(F.lit(cls.alphabet), step["leaves"])
        old = F.when(step["leaves"].isNull(), F.lit(0)).otherwise(F.get(state["counts"], leaves - 1))
        same = step["leaves"].eqNullSafe(step["enters"])
        new = F.get(state["counts"], enters - 1)
        total = F.when(same, state["sum"]).otherwise(
            state["sum"] + _weight(old - 1) - _weight(old) + _weight(new + 1) - _weight(new))
        counts = F.when(same, state["counts"]).otherwise(F.transform(
            state["counts"], lambda n, k: n + (k == enters - 1).cast("int") - F.coalesce((k == leaves - 1).cast("int"), F.lit(0))))
        at = state["at"] + 1
        dense = (at >= window) & (F.log2(F.lit(float(window))) - total / window >= cls.bits)
        begins = dense & ((state["start"] < 0) | (state["end"] < at - window))
        return F.struct(at.alias("at"), counts.alias("counts"), total.alias("sum"),
                        F.when(begins, at - window).otherwise(state["start"]).alias("start"),
                        F.when(dense, at).otherwise(state["end"]).alias("end"),
                        F.when(begins, ended(state)).otherwise(state["spans"]).alias("spans"))
    steps = F.slice(moves, F.lit(1), F.size(chars))
    return F.aggregate(steps, empty, move, ended)


def _blanked(text: Column, allow: tuple[str, ...]) -> Column:
    """The text with every match of the allow list replaced by as many blanks."""
    for fine in allow:
        pieces = F.arrays_zip(F.split(text, fine, -1).alias("gap"),
                              F.regexp_extract_all(text, F.lit(fine), F.lit(0)).alias("match"))
        text = F.when(text.rlike(fine), F.array_join(F.transform(
            pieces, lambda p: F.concat(p["gap"], F.rpad(F.lit(""), F.coalesce(F.length(p["match"]), F.lit(0)), " "))),
            "")).otherwise(text)
    return text


def _entropy_spans(text: Column, cls: CharClass, order: int) -> Column:
    def wanted(word: Column) -> Column:
        out = F.lit(True)
        for need in cls.needs:
            out = out & word.rlike(need)
        return out
    runs = F.filter(_runs(text, cls.pattern), lambda run: wanted(run["word"]))
    return F.flatten(F.transform(runs, lambda run: F.transform(
        F.filter(dense_windows(run["word"], cls),
                 lambda s: wanted(F.substring(run["word"], s["start"] + 1, s["end"] - s["start"]))),
        lambda s: F.struct((run["start"] + s["start"]).alias("start"), F.lit(order).alias("order"),
                           (run["start"] + s["end"]).alias("end"), F.lit(cls.name).alias("kind")))))


def spans(text: Column, classes: tuple[CharClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW) -> Column:
    """All spans (start, order, end, kind) by start, then kind: base kinds first, then the character classes."""
    text = F.coalesce(text, F.lit(""))
    nothing = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    assigned = F.filter(_runs(text, ASSIGN, 2), lambda r: F.length(r["judged"]) >= ASSIGN_LEAST)
    found = [F.when(text.rlike(ASSIGN), _marked(text, "assign", 0, assigned)).otherwise(nothing),
             F.when(text.rlike(ACCESS), _marked(text, "access", 1, _runs(text, ACCESS))).otherwise(nothing),
             F.when(text.rlike(HEX), _marked(text, "hex", 2, _runs(text, HEX))).otherwise(nothing)]
    candidate = F.lit(False)
    for c in classes:
        candidate = candidate | text.rlike(c.pattern)
    # one element or none: the blanked text is made once, not once for each class
    judged = F.when(candidate, F.array(_blanked(text, allow))).otherwise(F.array().cast("array<string>"))
    found.append(F.flatten(F.transform(judged, lambda t: F.concat(*[
        F.when(t.rlike(c.pattern), _entropy_spans(t, c, len(KINDS) + k)).otherwise(nothing)
        for k, c in enumerate(classes)]))))
    return F.array_sort(F.concat(*found))


def _listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: base matches by kind, the digest of the base spans, all spans as text."""
    found = docs.select(id_col, spans(F.col(text)).alias("found"))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("found", lambda s: s["order"] < len(KINDS))
    return found.select(id_col, *[count(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", mark: str = "<secret>") -> DataFrame:
    """The documents with every span, or group of overlapping spans, replaced by the mark."""
    held = "strata_secret_spans"
    with_spans = docs.withColumn(held, spans(F.col(text)))
    done = F.aggregate(
        held, F.struct(F.lit(0).alias("upto"), F.lit("").alias("out")),
        lambda state, s: F.when(s["end"] <= state["upto"], state).otherwise(F.struct(
            s["end"].alias("upto"),
            F.when(s["start"] < state["upto"], state["out"]).otherwise(F.concat(
                state["out"], F.substring(F.col(text), state["upto"] + 1, s["start"] - state["upto"]), F.lit(mark))).alias("out"))),
        lambda state: F.concat(state["out"], F.substring(F.col(text), state["upto"] + 1, F.length(text))))
    return with_spans.withColumn(text, F.when(F.size(held) > 0, done).otherwise(F.col(text))).select(*docs.columns)
