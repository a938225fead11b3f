"""Text cleaning and tokenising expressions.

Character classes are spelled as Unicode properties: Java's ``\\w`` is ASCII only
and would delete accented letters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: regular expressions
NOT_LETTER_OR_SPACE = r"[^a-zA-Z\s]"
NOT_WORD_OR_SPACE = r"[^\p{L}\p{N}_\s]"
ASCII_PUNCTUATION = r"[!-/:-@\[-`{-~]"
DIGITS = r"\p{Nd}+"
WORD_WITH_DIGIT = r"[\p{L}\p{N}_]*\p{Nd}[\p{L}\p{N}_]*"
LINE_BREAK = r"[\r\n]"
URL = r"https?://\S+|www\.\S+"
TAG = r"<[^\n]*?>+"
BRACKETED = r"\[[^\n]*?\]"
MENTION = r"@\S+"
HASHTAG = r"(^|[^\p{L}\p{N}_])#\S+"
HTTP_WORD = r"http\S+"
NOT_WORD = r"[^\p{L}\p{N}_]+"
SINGLE_LETTER = r"\s+[b-zA-Z]\s+"
PARENTHESISED = r"\([^\n]*\)"
WORD = r"[\p{L}\p{N}_]{2,}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once, so that a lambda in ``body`` does not recompute it per element."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, " +", " "))


def clean_headline(text: Column) -> Column:
    """Lower case, trim, ASCII letters only, single spaces."""
    return collapse_spaces(strip(F.trim(F.lower(text)), NOT_LETTER_OR_SPACE))


def clean_review(text: Column) -> Column:
    """Lower case; punctuation, digits and line breaks removed."""
    out = F.lower(text)
    for pattern in (NOT_WORD_OR_SPACE, DIGITS, LINE_BREAK):
        out = strip(out, pattern)
    return out


def clean_post(text: Column) -> Column:
    """Lower case; bracketed text, URLs, tags, punctuation, line breaks and words with digits removed."""
    out = F.lower(text)
    for pattern in (BRACKETED, URL, TAG, ASCII_PUNCTUATION, "\n", WORD_WITH_DIGIT):
        out = strip(out, pattern)
    return out


def clean_social(text: Column) -> Column:
    """Lower case; mentions, hashtags, links, non-words and stand-alone letters removed."""
    out = F.lower(F.regexp_replace(text, r"[\n\t]", " "))
    out = F.regexp_replace(strip(out, MENTION), HASHTAG, "$1")
    out = F.trim(F.regexp_replace(strip(out, HTTP_WORD), NOT_WORD, " "))
    return F.regexp_replace(F.regexp_replace(out, SINGLE_LETTER, " "), r"\s+", " ")


def clean_comma_parts(text: Column) -> Column:
    """Each comma part without parentheses, digits, spaces and punctuation, joined by spaces."""
    def part(p: Column) -> Column:
        for pattern in (PARENTHESISED, r"[0-9]", " ", ASCII_PUNCTUATION):
            p = strip(p, pattern)
        return F.lower(p)

    return F.array_join(F.transform(F.split(text, ","), part), " ")


def remove_punctuation_digits(text: Column) -> Column:
    """Lower case without ASCII punctuation and digits."""
    return F.lower(strip(strip(text, ASCII_PUNCTUATION), r"[0-9]"))


def space_tokens(text: Column) -> Column:
    """Non-empty pieces between whitespace."""
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def word_tokens(text: Column) -> Column:
    """Lower-case words of two characters and more."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), 0)


def characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?s)."), 0)


def char_ngrams(text: Column, n: int) -> Column:
    """Every position's next ``n`` characters; the last n-1 pieces are shorter."""
    def pieces(chars: Column) -> Column:
        every = F.transform(
            F.sequence(F.lit(1), F.size(chars)), lambda i: F.array_join(F.slice(chars, i, n), "")
        )
        return F.when(F.size(chars) > 0, every).otherwise(F.array().cast("array<string>"))

    return let(characters(text), pieces)


def word_ngrams(tokens: Column, low: int, high: int) -> Column:
    """Space-joined word n-grams of every length from ``low`` to ``high``."""
    def of_length(words: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
        joined = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
        return F.when(F.size(words) >= n, joined).otherwise(F.array().cast("array<string>"))

    return let(tokens, lambda words: F.concat(*[of_length(words, n) for n in range(low, high + 1)]))


def strip_suffix(word: Column) -> Column:
    """Rule-based normal form: words longer than five characters lose one English suffix."""
    return F.when(F.length(word) > 5, F.regexp_replace(word, "(ing|ed|es|s)$", "")).otherwise(word)
