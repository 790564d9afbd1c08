"""Secret scan with DataFrame functions only: fixed patterns plus the Shannon
entropy of sliding windows.

Base spans come from three patterns (``assign``, ``access``, ``hex``).  The
entropy pass takes every run of 20 or more key characters as a candidate,
names its character class (hex, alpha for letters of one case, mixed for letters
of both, alnum, base64), slides a window of 20
characters over it and keeps the window's symbol counts up to date as one
character enters and one leaves; windows at or above the class's threshold that
overlap or touch are one ``entropy`` span.  An allow list suppresses candidates that as a
whole are no secrets (UUIDs, digits only, paths of which every segment is made of
words).  No pattern repeats a group: Java recurses for each such repeat, so one long
text would end the executor.  Placeholders and alphabet runs suppress the windows that touch them; what
is left on either side is scored on its own.  Spans inside a base span are not
reported twice.  Positions are code points, end exclusive.

Entropies are compared as integers (c * log2 c scaled by 2**20), so a window's
value does not depend on the order of updates.

Defined results for odd input: null text counts as empty and has no spans;
repeated rows are scanned one by one; an empty table gives an empty table;
further columns are passed through, result columns replace input columns of
the same name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climark.llm.common import let

# The base patterns and the order of kinds.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{12,}"   # the same matches as AKIA[A-Z0-9]+ of 16 or more characters
HEX = r"[0-9a-f]{32,}"          # the same matches as [0-9a-f]+ of 32 or more characters
ASSIGN_MIN_VALUE = 8
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
ALLOW = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUID
    r"^[0-9_=/+-]+$",                                                                 # numbers, rulers
)
#: Placeholders and alphabet runs: candidates are cut there.
STRETCH = (r"(?i)example|placeholder|changeme|your[_-]?(?:key|token|secret)|x{6,}|0{8,}"
           r"|abcdefghijklmnopqrstuvwxyz|abcdefghij|0123456789|qwertyuiop")
SCALE = 1 << 20


@dataclass(frozen=True)
class EntropyRules:
    """Window length and the least bits per character by class."""
    window: int = 20
    bits: dict = field(default_factory=lambda: {"hex": 3.0, "alpha": 3.8, "mixed": 3.9, "alnum": 3.55, "base64": 3.75})


SPAN = "struct<start:int,kind:int,end:int>"


def _located(pieces: Column, matches: Column) -> Column:
    """(start, end) of each match from the text between matches."""
    both = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches,
                      lambda p, m: F.struct(F.length(p).alias("skip"), F.length(m).alias("len")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["skip"]
        return F.struct((start + x["len"]).alias("at"),
                        F.concat(acc["out"], F.array(F.struct(start.alias("start"), (start + x["len"]).alias("end")))).alias("out"))

    return F.aggregate(both, empty, step, lambda acc: acc["out"])


def _spans(text: Column, kind: str, pattern: str, keep=None) -> Column:
    """Spans of a pattern's leftmost non-overlapping matches; ``keep(text)``
    gives a parallel array of booleans."""
    none = F.array().cast(f"array<{SPAN}>")

    def found(matches: Column) -> Column:
        spans = _located(F.split(text, pattern, -1), matches)
        if keep is not None:
            both = F.filter(F.arrays_zip(spans.alias("s"), keep(text).alias("k")), lambda x: x["k"])
            spans = F.transform(both, lambda x: x["s"])
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
               lambda m: F.when(F.size(m) == 0, none).otherwise(found(m)))


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns by start, then kind."""
    long_value = lambda t: F.transform(
        F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGN_MIN_VALUE)
    return F.sort_array(F.concat(_spans(text, "assign", ASSIGN, long_value), _spans(text, "access", ACCESS),
                                 _spans(text, "hex", HEX)))


def path_of_words(candidate: Column) -> Column:
    """True for a path (a slash first, or three) whose segments are words, camel case too, with up
    to four digits each, between dashes; words may be empty."""
    def words(piece: Column) -> Column:
        return let(F.regexp_replace(piece, "[0-9]{1,4}$", ""), lambda w: (w == "") | w.rlike("^(?:[A-Z]+|[a-z])$") | (
            w.rlike("^[A-Za-z]+$") & ~w.rlike("[A-Z](?![a-z]{2})") & ~w.rlike("^[a-z](?![a-z])")))

    deep = F.length(candidate) - F.length(F.replace(candidate, F.lit("/"))) >= 3
    return (candidate.startswith("/") | deep) & F.forall(F.split(candidate, "[/_=-]+"), words)


def hot_windows(candidate: Column, threshold: Column, window: int) -> Column:
    """Array of (first, last): starts of the first and the last window of each run of
    touching windows of ``candidate`` whose entropy reaches ``threshold`` (scaled bits
    per character)."""
    share = [round(c * math.log2(c) * SCALE) if c else 0 for c in range(window + 1)]
    weight = F.array(*map(F.lit, share))                     # c * log2 c by count
    entering = F.transform(F.split(candidate, ""), lambda ch: F.instr(F.lit(ALPHABET), ch) - 1)
    most = F.lit(round(math.log2(window) * SCALE))
    runs = "array<struct<first:int,last:int>>"

    def run(acc: Column) -> Column:
        return F.array(F.struct(acc["first"].alias("first"), acc["last"].alias("last")))

    def walk(codes: Column) -> Column:
        leaving = F.concat(F.array_repeat(F.lit(-1), window), codes)
        moves = F.zip_with(codes, F.slice(leaving, F.lit(1), F.size(codes)),
                           lambda e, l: F.struct(e.alias("e"), l.alias("l")))
        start = F.struct(F.array_repeat(F.lit(0), len(ALPHABET)).alias("count"), F.lit(0).cast("long").alias("sum"),
                         F.lit(0).alias("i"), F.lit(None).cast("int").alias("first"),
                         F.lit(None).cast("int").alias("last"), F.array().cast(runs).alias("runs"))

        def step(acc: Column, move: Column) -> Column:
            e, left = move["e"], move["l"]
            counts = F.transform(acc["count"], lambda c, j: c + F.when(j == e, 1).otherwise(0)
                                 - F.when(j == left, 1).otherwise(0))
            c_in = F.get(acc["count"], e)
            c_out = F.get(acc["count"], F.greatest(left, F.lit(0)))
            change = F.when(e == left, F.lit(0)).otherwise(
                F.get(weight, c_in + 1) - F.get(weight, c_in)
                + F.when(left < 0, F.lit(0)).otherwise(F.get(weight, c_out - 1) - F.get(weight, c_out)))

            def after(total: Column) -> Column:
                at = acc["i"] - (window - 1)
                hot = (at >= 0) & (most - total / window >= threshold)
                apart = hot & (at > acc["last"] + window)
                return F.struct(counts.alias("count"), total.alias("sum"), (acc["i"] + 1).alias("i"),
                                F.when(hot & (acc["first"].isNull() | apart), at).otherwise(acc["first"]).alias("first"),
                                F.when(hot, at).otherwise(acc["last"]).alias("last"),
                                F.when(apart, F.concat(acc["runs"], run(acc))).otherwise(acc["runs"]).alias("runs"))

            return let(acc["sum"] + change, after)

        return F.aggregate(moves, start, step, lambda acc: F.when(
            acc["first"].isNull(), acc["runs"]).otherwise(F.concat(acc["runs"], run(acc))))

    return let(entering, walk)


def _pieces(candidate: Column) -> Column:
    """(c, at): what ``STRETCH`` leaves of ``candidate`` and where it starts."""
    def cut(matches: Column) -> Column:
        between = F.split(candidate, STRETCH, -1)
        starts = F.concat(F.array(F.lit(0)), F.transform(_located(between, matches), lambda s: s["end"]))
        return F.when(F.size(matches) == 0, F.array(F.struct(candidate.alias("c"), F.lit(0).alias("at")))).otherwise(
            F.arrays_zip(between.alias("c"), starts.alias("at")))

    return let(F.regexp_extract_all(candidate, F.lit(STRETCH), F.lit(0)), cut)


def _entropy_spans(text: Column, base: Column, rules: EntropyRules) -> Column:
    none = F.array().cast(f"array<{SPAN}>")

    def threshold(c: Column) -> Column:
        bits = {k: F.lit(round(v * SCALE)) for k, v in rules.bits.items()}
        return (F.when(c.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), bits["hex"])
                .when(c.rlike("^(?:[A-Z]?[a-z]+|[A-Z]+)$"), bits["alpha"]).when(c.rlike("^[A-Za-z]+$"), bits["mixed"])
                .when(c.rlike("^[A-Za-z0-9]+$"), bits["alnum"]).otherwise(bits["base64"]))

    def allowed(c: Column) -> Column:
        out = path_of_words(c)
        for pattern in ALLOW:
            out = out | c.rlike(pattern)
        return out

    def judge(x: Column) -> Column:
        end = x["start"] + F.length(x["c"])
        inside = F.exists(base, lambda b: (b["start"] <= x["start"]) & (b["end"] >= end))
        runs = let(threshold(x["c"]), lambda least: hot_windows(x["c"], least, rules.window))
        hot = F.transform(runs, lambda h: F.struct(
            (x["start"] + h["first"]).alias("start"), F.lit(KINDS.index("entropy")).alias("kind"),
            (x["start"] + h["last"] + rules.window).alias("end")))
        return F.when(~inside & (F.length(x["c"]) >= rules.window) & ~allowed(x["c"]), hot).otherwise(none)

    def cut(x: Column) -> Column:
        return F.transform(_pieces(x["c"]), lambda p: F.struct(
            p["c"].alias("c"), (x["s"]["start"] + p["at"]).alias("start")))

    def found(candidates: Column) -> Column:
        located = F.arrays_zip(candidates.alias("c"), _located(F.split(text, CANDIDATE, -1), candidates).alias("s"))
        pieces = F.flatten(F.transform(F.filter(located, lambda x: ~allowed(x["c"])), cut))
        return F.filter(F.flatten(F.transform(pieces, judge)), lambda s: ~F.exists(
            base, lambda b: (b["start"] <= s["start"]) & (b["end"] >= s["end"])))

    return let(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)),
               lambda c: F.when(F.size(c) == 0, none).otherwise(found(c)))


def rendered(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each stretch covered by spans (sorted by start) replaced."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        before = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            s["end"].alias("at"),
            F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], before, F.lit(mark))).alias("out")))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))))


def scan_secrets(docs: DataFrame, text_col: str = "text", rules: EntropyRules = EntropyRules()) -> DataFrame:
    """``docs`` with n_assign, n_access, n_hex, n_entropy (long), base_sha256,
    spans (string) and redacted_text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def count(spans: Column, kind: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    def with_entropy(base: Column) -> Column:
        return let(_entropy_spans(text, base, rules), lambda extra: let(
            F.sort_array(F.concat(base, extra)), lambda spans: F.struct(
                *[count(spans, k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
                F.sha2(rendered(base), 256).alias("base_sha256"), rendered(spans).alias("spans"),
                redacted(text, spans).alias("redacted_text"))))

    names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "redacted_text"]
    keep = [c for c in docs.columns if c.lower() not in names]
    out = docs.select(*[F.col(f"`{c}`") for c in keep], let(base_spans(text), with_entropy).alias("_secret_facts"))
    return out.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"_secret_facts.{n}").alias(n) for n in names])
