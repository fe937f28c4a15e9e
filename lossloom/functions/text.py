"""Cleaning, keyword rules, phrase counts and token arrays, all as built-in column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Longer than any token array; small enough that start + length stays an int.
MAX_LENGTH = 1 << 30
ASCII_PUNCTUATION = r"""!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~"""

# The character filters of the note cleaner. The literal forms look like "keep letters, comma,
# stop, blank" but mean one character outside the class followed by closing brackets.
LITERAL_FILTER = r"[^A-Za-z,.\[space]\]+"
LITERAL_FILTER_DIGITS = r"[^A-Za-z0-9,.\[space]\]+"
STRICT_FILTER = r"[^A-Za-z,. ]+"
STRICT_FILTER_DIGITS = r"[^A-Za-z0-9,. ]+"
ENTITY_WORDS = (("&lt;", "less"), ("&gt;", "greater"), ("&amp;", "and"), ("x0D", ""))


def _swap(column: Column, old: str, new: str) -> Column:
    return F.replace(column, F.lit(old), F.lit(new))


def clean_note(column: Column, keep_digits: bool = False, strict: bool = False,
               null_text: str | None = "None") -> Column:
    """Strip tags, spell out entities, drop control marks, filter characters, squeeze blanks.

    A missing note becomes `null_text`; pass None to keep it missing.
    """
    text = column if null_text is None else F.coalesce(column, F.lit(null_text))
    text = F.regexp_replace(text, "<.*?>", "")
    for entity, word in ENTITY_WORDS:
        text = _swap(text, entity, word)
    text = F.translate(text, "\n\r*", "   ")
    text = _swap(text, "&#;", "")
    text = F.translate(text, "\t()", "")
    text = _swap(text, "null,", "")
    text = F.translate(text, "'", "")
    if strict:
        pattern = STRICT_FILTER_DIGITS if keep_digits else STRICT_FILTER
    else:
        pattern = LITERAL_FILTER_DIGITS if keep_digits else LITERAL_FILTER
    return F.regexp_replace(F.regexp_replace(text, pattern, ""), "[ \t]+", " ")


def strip_punctuation(column: Column) -> Column:
    """Remove ASCII punctuation at both ends."""
    return F.regexp_replace(column, f"^[{ASCII_PUNCTUATION}]+|[{ASCII_PUNCTUATION}]+$", "")


def letters_digits_blanks(column: Column) -> Column:
    """Keep ASCII letters, digits and white space."""
    return F.regexp_replace(column, r"[^ \t\n\r\f\x0Ba-zA-Z0-9]", "")


def contains_any(column: Column, words: Sequence[str]) -> Column:
    """0/1: does the text contain one of the words (case-sensitive); 0 for a missing text."""
    test = reduce(lambda acc, w: acc | column.contains(w), words[1:], column.contains(words[0]))
    return F.coalesce(test, F.lit(False)).cast("int")


@dataclass(frozen=True)
class KeywordRule:
    """Regex rule: every `all_of` pattern and, if given, at least one `any_of` pattern must be found."""

    name: str
    all_of: tuple[str, ...] = ()
    any_of: tuple[str, ...] = ()

    def column(self, text: Column) -> Column:
        lowered = F.lower(text)
        tests = [lowered.rlike(p) for p in self.all_of]
        if self.any_of:
            tests.append(lowered.rlike("|".join(self.any_of)))
        return F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False)).cast("int").alias(self.name)


# Keyword patterns over the loss description and over the adjuster notes. Blanks inside the
# alternations are significant.
DESCRIPTION_RULES = (
    KeywordRule("totalloss_flag", any_of=("loss",)),
    KeywordRule("glass_flag", any_of=("replac ", " repair")),
    KeywordRule("rear_flag", any_of=("rear",)),
    KeywordRule("unknownperson_flag", any_of=("person",)),
    KeywordRule("remark_flag", any_of=("claim ", " shop")),
    KeywordRule("stolen_flag", any_of=("stolen",)),
)
NOTE_RULES = (
    KeywordRule("policereport_flag", any_of=("repo", "rpt")),
    KeywordRule("med_flag", any_of=("pay ", " auth ", " record")),
    KeywordRule("wageloss_flag", any_of=("loss",)),
    KeywordRule("injuri_flag", any_of=("protect ", " person")),
    KeywordRule("softtissue_flag", any_of=("therapi",)),
    KeywordRule("attorney_flag", any_of=("attorney",)),
    KeywordRule("keys_flag", any_of=("key",)),
)

# Words that raise a flag when a text contains one of them.
RED_FLAG_WORDS = {
    "fire": ("FIRE", "EXPLOSION", "BLAST", "ARSON"),
    "theft": ("THEFT", "BURGLARY", "STEAL", "STOLE", "ROBBERY", "LARCENY"),
    "total_loss": ("TOTALLOSS", "TOTAL LOSS"),
    "attorney": ("ATTORNEY", "LAWYER", "COUNSEL", "ADVOCATE", "LITIGATION"),
    "chiro": ("CHIROPRACTOR", "PHYSIOTHERAPY", "CHIROPRACTIC"),
    "collision": ("REA", "REAR", "COLL", "COLI"),
}

# The selected key phrases, in column order.
KEY_PHRASES = (
    "OWNERSHIP CLAIM", "CLMT ATTY", "WAGE LOSS", "PRIORITY CATEGORY", "MEDICAL RECORDS", "TEMPORARY OWNERSHIP",
    "ATTORNEY OFFICE", "POLICE REPORT", "PHYSICAL THERAPY", "SOFT TISSUE", "NECK PAIN", "INDEPENDENT MEDICAL",
    "BODILY INJURY", "AUTO BODY", "SHOP CHOICE", "BODY SHOP",
)


def keyword_flags(text: Column, rules: Iterable[KeywordRule]) -> list[Column]:
    return [rule.column(text) for rule in rules]


def phrase_flags(text: Column, phrases: Sequence[str] = KEY_PHRASES, prefix: str = "KEY_PHRASE_NEW_") -> list[Column]:
    """One 0/1 column per phrase, compared in lower case."""
    lowered = F.lower(text)
    return [F.coalesce(lowered.contains(p.lower()), F.lit(False)).cast("int").alias(f"{prefix}{i}")
            for i, p in enumerate(phrases)]


def phrase_count(text: Column, phrase: str) -> Column:
    """Non-overlapping, case-sensitive occurrences of a phrase."""
    removed = F.length(text) - F.length(F.replace(text, F.lit(phrase), F.lit("")))
    return (removed / F.lit(len(phrase))).cast("bigint")


def limited_split(column: Column, delimiter: str = ",", limit: int | None = None) -> Column:
    """Parts of a delimited text: all of them, or with `limit` the first ones only."""
    parts = F.split(column, re.escape(delimiter))
    return parts if limit is None else F.slice(parts, 1, limit)


def bump_suffix(column: Column, prefix_length: int = 6) -> Column:
    """Keep the prefix and add one to the whole number after it."""
    number = column.substr(F.lit(prefix_length + 1), F.length(column)).cast("bigint") + 1
    return F.concat(F.substring(column, 1, prefix_length), number.cast("string"))


def words(text: Column) -> Column:
    """Default tokenizer: runs of lower-cased ASCII letters and digits."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def blank_split(text: Column, keep_empty: bool = True) -> Column:
    """Split on one blank (keeping empties) or on runs of white space (dropping them)."""
    if keep_empty:
        return F.split(text, " ")
    return F.filter(F.split(text, "[ \t\n\r\f\x0B]+"), lambda w: w != "")


def tokens(text: Column, stop_words: Sequence[str] = (), min_length: int = 4,
           tokenizer: Callable[[Column], Column] = words, cleaner: Callable[[Column], Column] | None = None) -> Column:
    """Tokens that are long enough and not stop words.

    `cleaner` runs after the filter. The default tokenizer emits only ASCII letters and digits, on which the
    note cleaner changes nothing, so none is applied by default.
    """
    kept = F.filter(
        tokenizer(text),
        lambda w: (F.length(w) >= min_length) & ~w.isin(*stop_words) if stop_words else F.length(w) >= min_length,
    )
    return kept if cleaner is None else F.transform(kept, cleaner)


def topic_words(text: Column, stop_words: Sequence[str] = ()) -> Column:
    """Letters and digits only, lower case, stop words out: the input of the topic models."""
    spread = blank_split(F.lower(letters_digits_blanks(text)), keep_empty=False)
    if not stop_words:
        return spread
    return F.filter(spread, lambda w: ~w.isin(*stop_words))


def ngrams(token_array: Column, n: int) -> Column:
    """Consecutive n-tuples joined by a blank; empty when there are fewer than n tokens.

    Shifted copies are zipped, so the array is read n times whatever its length.
    """
    joined = token_array
    for shift in range(2, n + 1):
        joined = F.zip_with(joined, F.slice(token_array, shift, MAX_LENGTH), lambda a, b: F.concat(a, F.lit(" "), b))
    return joined if n == 1 else F.filter(joined, lambda g: g.isNotNull())


def ngram_range(token_array: Column, low: int, high: int) -> Column:
    return F.concat(*[ngrams(token_array, n) for n in range(low, high + 1)])
