"""Quality rules: line-first cleaning, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, let, whole_text

SYMBOLS = "#*$%&|<>"
#: Phrases of lines that carry no prose of their own, lower case.
BOILERPLATE = ("all rights reserved", "licensed under", "terms of use", "terms of service", "privacy policy", "cookie policy", "enable javascript", "click here", "subscribe to our", "copyright ©")
#: A document is rejected if less than this share, in hundredths, of its characters is in lines that pass.
KEEP_PERCENT = 50
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{BLANKS}]+"), lambda w: w != "")


def _without(text: Column, chars: str) -> Column:
    """Literal replacement; cheaper than a pattern or translate()."""
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _covered(at: Column) -> Column:
    """Words in windows of three that start at the sorted positions *at*."""
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    step = lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last"))
    return F.aggregate(at, start, step, lambda a: a["n"])


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the text.

    Windows are compared by 64-bit hashes of their words within one text. Texts
    without a repeated window, found by one hash-set pass, skip the sort.
    """
    windows = lambda h: F.transform(F.slice(h, 1, F.size(h) - 2), lambda a, i: F.xxhash64(a, F.get(h, i + 1), F.get(h, i + 2)))
    same = lambda x, y: F.coalesce(x["w"] == y["w"], F.lit(False))
    twice = lambda s: F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)))
    ordered = lambda t: F.sort_array(F.transform(t, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    at = lambda t: F.sort_array(F.transform(let(ordered(t), twice), lambda x: x["i"]))
    marked = lambda t: F.when(F.size(F.array_distinct(t)) == F.size(t), 0).otherwise(_covered(at(t)))
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return let(hashed, lambda h: F.when(F.size(h) < 3, 0).otherwise(let(windows(h), marked)))


def _passes(line: Column) -> Column:
    """Whether a line stays: prose punctuation, no symbol noise, shouting, navigation or boilerplate."""
    n_words = F.size(_words(line))
    count = lambda pattern: F.regexp_count(line, F.lit(pattern))
    punctuated = line.rlike("[.!?:;…。！？]")
    noisy = count("[#*$%&<>]") * 2 > n_words
    shouting = count("!!") * 4 > n_words
    navigation = count("[|»›]") * 6 > n_words
    low = F.lower(line)
    boilerplate = F.lit(False)
    for phrase in BOILERPLATE:
        boilerplate = boilerplate | low.contains(phrase)
    return punctuated & ~noisy & ~shouting & ~navigation & ~boilerplate


def quality_rules(df: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """*df* with the counts, the cleaned text and the verdict of the line rules.

    Rules are judged per line first: a line goes if it has no sentence
    punctuation, if symbols, exclamation runs or separators are frequent among
    its words, or if it holds a boilerplate phrase. What is left is clean_text.
    A document is kept unless it fails the base rules (fewer than 50 words, or
    over half its words in repeated 3-word windows) or loses more than half of
    its characters with its lines.

    Null text has no words and is rejected; so are empty texts. All columns of
    *df* stay; the new ones are *prefix* + word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_words, base_failed, kept and clean_text and replace columns of
    these names. Every row is judged alone, so repeated rows get equal answers.
    """
    text = whole_text(text_col)
    has_word = lambda s: s.rlike(f"[^{BLANKS}]")
    bare = _without(text, " \t\n\x0b\f\r")
    lines = F.filter(F.split(text, "\n"), has_word)
    judged = let(lines, lambda ls: F.struct(
        (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("dup"),
        F.aggregate(ls, F.lit(0), lambda a, s: a + F.char_length(s)).alias("chars"),
        F.filter(ls, _passes).alias("clean"),
    ))
    counted = let(_words(text), lambda ws: F.struct(F.size(ws).cast("long").alias("n"), _repeat_words(ws).cast("long").alias("repeat")))
    marked = df.withColumns({
        "__w": counted,
        "__l": judged,
        "__c": F.char_length(bare).cast("long"),
        "__s": (F.octet_length(text) - F.octet_length(_without(text, SYMBOLS))).cast("long"),
    })
    n, repeat = F.col("__w.n"), F.col("__w.repeat")
    clean_chars = F.aggregate(F.col("__l.clean"), F.lit(0), lambda a, s: a + F.char_length(s))
    failed = (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)
    return marked.withColumns({
        f"{prefix}n_words": n,
        f"{prefix}word_chars": F.col("__c"),
        f"{prefix}n_symbols": F.col("__s"),
        f"{prefix}n_dup_lines": F.col("__l.dup"),
        f"{prefix}n_repeat_words": repeat,
        f"{prefix}base_failed": failed,
        f"{prefix}kept": ~failed & (100 * clean_chars >= KEEP_PERCENT * F.col("__l.chars")),
        f"{prefix}clean_text": F.array_join(F.col("__l.clean"), "\n"),
    }).drop("__w", "__l", "__c", "__s")


def drop_rejected(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of *df* that :func:`quality_rules` keeps, with their columns unchanged."""
    return quality_rules(df, text_col, "__rules_").where("__rules_kept").select(*(F.col(f"`{c}`") for c in df.columns))
