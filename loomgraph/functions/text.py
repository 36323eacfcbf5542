"""Text column expressions.

Every function maps Columns to a Column built from Spark's regex and string
functions, so the work stays in the JVM under whole-stage code generation.
Character classes are written out explicitly so that Spark (Java regex)
and the DuckDB oracle (RE2) agree with Python's ``re`` semantics:

* Python ``\\w`` is ``[\\p{L}\\p{N}_]`` (Java's ``\\w`` is ASCII only);
* Python ``\\s`` / ``str.isspace`` is the class below (Java's ``\\s`` is
  ASCII only);
* Python ``str.strip()`` strips that class on both ends (Spark ``trim``
  strips spaces only);
* Python ``.`` stops only at ``\\n`` (Java's also at ``\\r`` and others).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's whitespace characters (str.isspace) are
#   \t \n \x0B \f \r \x1C-\x1F space \x85 \xA0 \u1680 \u2000-\u200A \u2028 \u2029
#   \u202F \u205F \u3000
# In Java this is Character.isWhitespace plus the four code points it leaves
# out (checked equal on every code point); the short union scans about twice
# as fast as the listed class. RE2 (DuckDB) gets the list itself.
WS = r"\p{javaWhitespace}\x85\xA0\u2007\u202F"
WS_RE2 = r"\t\n\v\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# Python's word characters and letters as class bodies.
WORD = r"\p{L}\p{N}_"
LETTER = r"\p{L}"
# Fixed value: sentence boundary used by the reference's own splitter: a
# whitespace run right after one of . ? !
SENTENCE_END = ".?!"
# Fixed value: reference script range for chunk cleaning (Devanagari).
DEVANAGARI = ("\u0900", "\u097F")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def collapse_ws(t, repl: str = " ") -> Column:
    return F.regexp_replace(_c(t), f"[{WS}]+", repl)


def strip(t) -> Column:
    """Python ``str.strip()``."""
    return F.regexp_replace(_c(t), f"^[{WS}]+|[{WS}]+\\z", "")


def english_fix(t) -> Column:
    """`` n't`` -> ``n't``, `` '`` -> ``'``, then drop one whitespace
    character before any of ``? . ! , '``."""
    t = F.replace(_c(t), F.lit(" n't"), F.lit("n't"))
    t = F.replace(t, F.lit(" '"), F.lit("'"))
    return F.regexp_replace(t, f"[{WS}]([?.!,'])", "$1")


def clean_text(t) -> Column:
    """Collapse whitespace runs to one space, delete every character
    that is not a word character, whitespace or ``. , ! ?``, strip."""
    t = collapse_ws(t)
    return F.trim(F.regexp_replace(t, f"[^{WORD}{WS}.,!?]+", ""))  # spaces are the only whitespace left


def word_count(t) -> Column:
    """Number of whitespace-separated words (Python ``len(t.split())``).

    With a space on either side the words are what lies between the whitespace
    runs. ``t`` is referenced once: it would be computed per reference in filters,
    lambdas and conditions."""
    apart = F.split(F.concat(F.lit(" "), _c(t), F.lit(" ")), f"[{WS}]+")
    return (F.array_size(apart) - 2).cast("long")


def letter_count(t) -> Column:
    return F.length(F.regexp_replace(_c(t), f"[^{LETTER}]+", "")).cast("long")


def letter_ratio(t) -> Column:
    """Letters / length, length floored at 1 (stripped text)."""
    s = strip(t)
    return letter_count(s) / F.greatest(F.lit(1), F.length(s))


def good_text(t, min_words: int, min_ratio: float, stripped: bool = False) -> Column:
    """Word count and letter ratio test on the stripped text. Pass
    ``stripped=True`` when ``t`` is already stripped (saves a regex pass)."""
    s = _c(t) if stripped else strip(t)
    return (word_count(s) >= F.lit(min_words)) & (
        letter_count(s) / F.greatest(F.lit(1), F.length(s)) >= F.lit(float(min_ratio)))


def good_line(t, min_words: int = 5, min_ratio: float = 0.3, stripped: bool = False) -> Column:
    """F1: at least 5 words and a letter ratio of at least 0.3."""
    return good_text(t, min_words, min_ratio, stripped)


def good_summary(t, min_words: int = 8, min_ratio: float = 0.4, stripped: bool = False) -> Column:
    """F2: at least 8 words and a letter ratio of at least 0.4."""
    return good_text(t, min_words, min_ratio, stripped)


def non_blank(t) -> Column:
    """F3."""
    return strip(t) != F.lit("")


def blank_if_short(t, min_words: int = 10) -> Column:
    """chunks of fewer than ``min_words`` words become ``''`` (row kept)."""
    return F.when(word_count(t) < F.lit(min_words), F.lit("")).otherwise(_c(t))


def remove_stopwords(t, stopwords: list[str]) -> Column:
    """Drop words whose lower case is in ``stopwords``, single-space join.

    The list is a literal array evaluated in the JVM (no join); it is meant
    for word lists, which are small by nature."""
    stop = F.array(*[F.lit(w) for w in sorted(set(stopwords))])
    words = F.split(strip(t), f"[{WS}]+")
    return F.array_join(F.filter(words, lambda w: ~F.array_contains(stop, F.lower(w))), " ")


def summary_fix(t) -> Column:
    """`` .`` -> ``.``, collapse whitespace, runs of 2+ periods -> one, strip."""
    t = F.replace(_c(t), F.lit(" ."), F.lit("."))
    t = collapse_ws(t)
    t = F.regexp_replace(t, r"\.\.+", ".")
    return strip(t)


def node_text(t) -> Column:
    """P5: newline, comma and period become spaces; whitespace collapsed and stripped."""
    return strip(collapse_ws(F.regexp_replace(_c(t), "[\n,.]", " ")))


def script_clean(t, lo: str = DEVANAGARI[0], hi: str = DEVANAGARI[1]) -> Column:
    """Drop parenthesised spans (shortest, within a line), keep only the
    code points ``lo``-``hi`` plus whitespace and ``. ! ?`` (and the danda),
    collapse 2+ whitespace to one space, strip. The range is a parameter:
    the reference's fixed Devanagari range erases Latin text (D12)."""
    t = F.regexp_replace(_c(t), r"\([^\n]*?\)", "")
    t = F.regexp_replace(t, f"[^{_u(lo)}-{_u(hi)}{WS}\\x{{964}}.!?]", "")
    t = F.regexp_replace(t, f"[{WS}]{{2,}}", " ")
    return strip(t)


def _u(ch: str) -> str:
    return f"\\x{{{ord(ch):x}}}"


def sentence_split(t) -> Column:
    """G1 split: pieces separated by a whitespace run that follows . ? !"""
    return F.split(_c(t), f"(?<=[{SENTENCE_END}])[{WS}]+")


def whitespace_tokens(t) -> Column:
    """Python ``t.split()`` as an array (empty text gives an empty array)."""
    s = strip(t)
    return F.when(s == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(s, f"[{WS}]+"))
