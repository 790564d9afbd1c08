"""Line-first cleaning with DataFrame functions only.

Every line is judged on its own by punctuation, navigation and boilerplate
rules; failing lines are removed, and a document is rejected when the removed
lines held too much of its text, or when the base rules on the whole text
fail.  One projection, no shuffle.

Defined results for odd input: null text counts as empty (0 in every count,
rejected as too short); repeated rows are judged one by one; an empty table
gives an empty table; any further columns are passed through, and result
columns replace input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climark.llm.common import let

# Fixed values.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
SYMBOL_RUN = r"[#*$%&<>]+"
TERMINAL = r"[.!?:;…。！？][\"'»”’)\]]*$"
SEPARATOR = r"[|>›»•·]"
WINDOW = r"(?<![^ ])(?=([^ ]+ [^ ]+ [^ ]+))"
MARK = r"[|>›»•·#*$%&<]"
UPPER = r"[A-ZÀ-ÖØ-Þ]"
BOILERPLATE = (
    "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie policy",
    "accept cookies", "enable javascript", "lorem ipsum", "click here", "sign in", "log in",
    "subscribe to our newsletter", "skip to content", "read more", "back to top", "powered by",
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules (all inclusive as named)."""
    min_words: int = 50                # base: fewer words fail
    max_repeat_percent: int = 50       # base: more words in repeated 3-word windows fail
    punctuation_from_words: int = 12   # an unpunctuated line this long (or longer) fails
    separator_words_percent: int = 30  # navigation: separators per 100 words from which a line fails
    symbol_words_percent: int = 50     # boilerplate: runs of symbols per 100 words from which it fails
    shout_percent: int = 60            # boilerplate: upper-case letters per 100 characters from which it fails
    boilerplate_chars: int = 200       # phrases count only in lines up to this length
    max_lost_percent: int = 50         # a document losing more of its word characters is rejected


def word_chars(words: Column) -> Column:
    """Code points in the words."""
    return F.length(F.array_join(words, ""))


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than space and U+0009..U+000D."""
    return F.array_remove(F.split(text, SPACE, -1), "")


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice: sort the windows
    with their positions, so equal ones are neighbours."""
    def covered(windows: Column) -> Column:
        indexed = F.sort_array(F.transform(windows, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        return let(indexed, lambda s: F.size(F.array_distinct(F.flatten(F.transform(
            F.flatten(F.filter(F.zip_with(
                s, F.concat(F.array(F.lit(None).cast("struct<g:string,i:int>")), s),
                lambda a, b: F.when(a["g"] == b["g"], F.array(a["i"], b["i"]))), lambda x: x.isNotNull())),
            lambda i: F.array(i, i + 1, i + 2))))))

    windows = F.regexp_extract_all(F.array_join(words, " "), F.lit(WINDOW), F.lit(1))
    found = let(windows, lambda w: F.when(
        F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(found)


def line_fails(line: Column, rules: LineRules = LineRules()) -> Column:
    """True if a line with a word breaks a rule."""
    def judge(words: Column) -> Column:
        n_words, end = F.size(words), F.right(F.element_at(words, -1), F.lit(8))
        no_end = (n_words >= rules.punctuation_from_words) & ~end.rlike(TERMINAL)
        marks = line.rlike(MARK) & (
            ((n_words > 2) & (F.regexp_count(line, F.lit(SEPARATOR)) * 100 >= n_words * rules.separator_words_percent))
            | (F.regexp_count(line, F.lit(SYMBOL_RUN)) * 100 >= n_words * rules.symbol_words_percent))
        shout = (n_words > 2) & line.rlike(UPPER + "{2}") & (
            F.regexp_count(line, F.lit(UPPER)) * 100 >= word_chars(words) * rules.shout_percent)
        phrase = (F.length(line) <= rules.boilerplate_chars) & let(
            F.lower(line), lambda low: F.exists(F.array(*map(F.lit, BOILERPLATE)), low.contains))
        return no_end | marks | shout | phrase

    return let(words_of(line), judge)


def clean_lines(docs: DataFrame, text_col: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    (long), base_failed, kept (boolean), lines_removed, chars_lost (long) and
    clean_text (the lines that passed)."""
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.split(text, "\n", -1)

    def judged(ls: Column) -> Column:
        worded = F.filter(ls, has_word)
        kept = F.filter(ls, lambda x: ~has_word(x) | ~line_fails(x, rules))
        return let(F.struct(worded.alias("w"), F.array_join(kept, "\n").alias("k"), F.size(kept).alias("nk")),
                   lambda s: F.struct((F.size(s["w"]) - F.size(F.array_distinct(s["w"]))).cast("long").alias("dup"),
                                      s["k"].alias("clean"),
                                      word_chars(F.split(s["k"], SPACE, -1)).cast("long").alias("left"),
                                      (F.size(ls) - s["nk"]).cast("long").alias("removed")))

    def counted(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).cast("long").alias("rep"),
                        word_chars(w).cast("long").alias("chars"))

    facts = F.struct(let(words_of(text), counted).alias("w"), let(lines, judged).alias("l"),
                     F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("sym"))

    def verdict(f: Column) -> Column:
        failed = (f["w"]["n"] < rules.min_words) | (
            f["w"]["rep"] * 100 > f["w"]["n"] * rules.max_repeat_percent)
        lost = f["w"]["chars"] - f["l"]["left"]
        return F.struct(
            f["w"]["n"].alias("n_words"), f["w"]["chars"].alias("word_chars"), f["sym"].alias("n_symbols"),
            f["l"]["dup"].alias("n_dup_lines"), f["w"]["rep"].alias("n_repeat_words"),
            failed.alias("base_failed"),
            (~failed & (lost * 100 <= f["w"]["chars"] * rules.max_lost_percent)).alias("kept"),
            f["l"]["removed"].alias("lines_removed"), lost.alias("chars_lost"), f["l"]["clean"].alias("clean_text"))

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "lines_removed", "chars_lost", "clean_text")
    keep = [c for c in docs.columns if c.lower() not in names]
    out = docs.select(*[F.col(f"`{c}`") for c in keep], let(facts, verdict).alias("_line_facts"))
    return out.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"_line_facts.{n}").alias(n) for n in names])
