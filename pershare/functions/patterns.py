"""Phrases and regular expressions.

Patterns are Java regexes. ``(?iu)`` ignores case in every script, ``(?d)`` makes ``\\n`` the only line
end that ``.`` stops at. Classes are spelled out because Java's own differ from the semantics wanted
here, and because they are quicker: ``SPACE`` is white space of every kind with the four separator
controls, ``DIGIT`` the decimal digits of every script, and ``WORD`` letters, numbers of every kind
(so a superscript footnote mark belongs to its word) and the underscore.
"""

import sys
import unicodedata

# The results depend on these phrases, keywords and weights.
PHRASES = ("eps", "e.p.s", "income per share", "earnings per share", "loss per share")
NET_WORDS = ("net", "total")
NON_GAAP = r"non[- ]?g\.?a\.?a\.?p\.?|adjusted"
GAAP = r"g\.?a\.?a\.?p\.?|unadjusted|un[- ]?adjusted|non[- ]?adjusted"
BASIC_SCORE, DILUTED_SCORE, UNADJUSTED_SCORE, NET_SCORE, LOSS_SCORE = 100, 50, 100, 50, 50
SIMILARITY_THRESHOLD = 0.5
DEFAULT_TIMEFRAME = 2020

# The marks that stand for a missing value.
MISSING_MARKS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
DIGIT = r"\p{Nd}"
WORD = r"[\p{L}\p{N}_]"
BOUNDARY = rf"(?:(?<!{WORD})(?={WORD})|(?<={WORD})(?!{WORD}))"

# Edges of a string made of white space.
EDGE_SPACE = rf"^{SPACE}+|{SPACE}+\z"
# A decimal number, with or without a whole part: such a row is no header.
DECIMAL = rf"\.{DIGIT}"
# A number with whole part and fraction, and the sign character that may precede it.
VALUE = rf"[(\-]?{SPACE}*[$]?{SPACE}*{DIGIT}+\.{DIGIT}+"

# A cell of digits, separators and dashes only.
PLAIN_NUMBER = r"^[-0-9.,]+\z"

ADJUSTED_PATTERN = rf"(?iud){BOUNDARY}(?:{NON_GAAP}){BOUNDARY}"
GAAP_PATTERN = rf"(?iud){BOUNDARY}(?:{GAAP}){BOUNDARY}"


def quote(text: str) -> str:
    """``text`` with every regex metacharacter escaped."""
    return "".join(c if c.isalnum() or c in " _" else "\\" + c for c in text)


def phrase_pattern(phrase: str) -> str:
    """Words of the phrase in order, each with an optional plural, with anything in between.

    The phrase begins and ends with a word character, so both edges are plain word edges.
    """
    words = r".*?".join(quote(word) + "s?" for word in phrase.split())
    return rf"(?<!{WORD}){words}(?!{WORD})"


def any_phrase_pattern(phrases=PHRASES) -> str:
    return "(?iud)" + "|".join(phrase_pattern(p) for p in phrases)


def required_fragments(phrases=PHRASES) -> str:
    """Found in every text that holds the last word of some phrase, wherever it stands.

    A phrase can match only if its last word occurs in one piece, so a table none of whose labels
    passes this cheap test cannot give a candidate. To be matched regardless of case.
    """
    last_words = sorted({p.split()[-1] for p in phrases})
    return "|".join(quote(w) for w in last_words)


EPS_PATTERN = any_phrase_pattern()
EPS_FRAGMENT = required_fragments()
EPS_LAST_WORDS = sorted({p.split()[-1] for p in PHRASES})
# The one letter that is lower case and still matches another, an s, regardless of case.
LONG_S = "\u017f"
LOSS_PATTERN = any_phrase_pattern([p for p in PHRASES if p.startswith("loss")])
GAIN_PATTERN = any_phrase_pattern([p for p in PHRASES if not p.startswith("loss")])

# What a phrase of several words may have of itself in one label and of the rest in another: its first word, which must stand
# at the start of a word, and the two that follow, which all these phrases share.
(MIDDLE_WORD, LAST_WORD), = {tuple(p.split()[1:]) for p in PHRASES if " " in p}
ONE_WORD_PATTERN = any_phrase_pattern([p for p in PHRASES if " " not in p])
FIRST_PATTERNS = {w: rf"(?<!{WORD}){w}" for w in (p.split()[0] for p in PHRASES if " " in p)}
GAAP_WORD = r"g\.?a\.?a\.?p\.?"
LAST_PATTERN = rf"{LAST_WORD}s?(?!{WORD})"

# Decimal digits of every script and, position by position, their ASCII values.
_DIGITS = [c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
FOREIGN_DIGITS = "".join(_DIGITS)
ASCII_DIGITS = "".join(str(unicodedata.digit(c)) for c in _DIGITS)
