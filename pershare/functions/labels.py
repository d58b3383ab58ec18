"""Expressions over the context of a value: phrase match, type labels, flags and score."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from pershare.functions.patterns import (
    ADJUSTED_PATTERN,
    BASIC_SCORE,
    BOUNDARY,
    DILUTED_SCORE,
    EPS_LAST_WORDS,
    EPS_PATTERN,
    FIRST_PATTERNS,
    GAAP_PATTERN,
    GAAP_WORD,
    GAIN_PATTERN,
    LAST_PATTERN,
    LAST_WORD,
    LONG_S,
    LOSS_PATTERN,
    LOSS_SCORE,
    MIDDLE_WORD,
    NET_SCORE,
    NET_WORDS,
    ONE_WORD_PATTERN,
    UNADJUSTED_SCORE,
)
from pershare.functions.vectors import let

# Headers up to this length stand for themselves.
SHORT_HEADER = 240


def join_context(header: Column, label: Column) -> Column:
    """Header text and row label in lower case; the label alone without a header."""
    return F.lower(F.concat_ws(" ", header, label))


def short_header(header: Column) -> Column:
    """A text of bounded length in place of a header of any length: whatever comes before or behind it, every function of
    this module finds the same in both. A short header is its own.

    So the short texts of the parts of a header, joined by blanks, can be shortened again. Only what a phrase may begin
    or end with keeps its order, line by line; all else is a list of marks.
    """
    return F.when(F.length(header) <= SHORT_HEADER, header).otherwise(let(F.lower(header), _shortened))


def _shortened(text: Column) -> Column:
    marks = F.concat_ws(
        " ",
        F.when(is_basic(text), "basic"),
        F.when(is_diluted(text), "diluted"),
        F.when(is_net(text), "net"),
        F.when(is_adjusted(text), "adjusted"),
        F.when(text.rlike(GAAP_PATTERN), "gaap"),
        F.when(text.rlike(ONE_WORD_PATTERN), "eps"),
    )
    # the points keep the marks apart from what "non" may stand before, unless the text itself begins or ends so
    begins = F.when(text.rlike(rf"(?iud)^(?:{GAAP_WORD}){BOUNDARY}"), "gaap")
    ends = F.when(text.rlike(rf"(?iud){BOUNDARY}non\z"), "non")
    lines = let(F.transform(F.split(text, "\n", -1), _phrase_parts), _joined_lines)
    return F.concat_ws(" ", begins, F.lit("."), marks, F.lit("."), lines, ends)


def _joined_lines(lines: Column) -> Column:
    """The parts of a phrase meet on one line only, so lines between the first and the last add whole phrases at most."""
    whole = F.concat_ws(
        "\n",
        F.when(F.exists(lines, lambda line: line.rlike(LOSS_PATTERN)), "loss per share"),
        F.when(F.exists(lines, lambda line: line.rlike(GAIN_PATTERN)), "eps"),
    )
    several = F.concat_ws("\n", F.get(lines, F.lit(0)), whole, F.element_at(lines, -1))
    return F.when(F.size(lines) == 1, F.get(lines, F.lit(0))).otherwise(several)


def _phrase_parts(line: Column) -> Column:
    """The words of phrases in a line that decide which phrases it holds, begins or ends, in their order: each first word
    where it first occurs, the middle word where it occurs first, first behind each first word and last, and the last word
    where it occurs last. No pattern goes over the line more than a few times, however often a word occurs."""

    def place(up_to: str, pattern: str, word: str) -> Column:
        found = rf"(?iud)^({up_to}){pattern}"
        at = F.length(F.regexp_extract(line, found, 1))
        return F.when(line.rlike(found), F.struct(at.alias("at"), F.lit(word).alias("word")))

    places = [place(".*?", MIDDLE_WORD, MIDDLE_WORD), place(".*", MIDDLE_WORD, MIDDLE_WORD)]
    for first, pattern in FIRST_PATTERNS.items():
        places.append(place(".*?", pattern, first))
        places.append(place(f"(?>.*?{pattern}).*?", MIDDLE_WORD, MIDDLE_WORD))
    places.append(place(".*", LAST_PATTERN, LAST_WORD))
    in_order = F.array_sort(F.array_distinct(F.array_compact(F.array(*places))))
    return F.array_join(F.transform(in_order, lambda p: p.word), " ")


def mentions_eps(context: Column) -> Column:
    """Whether a lower-case context names one of the phrases.

    Most contexts hold no last word of any phrase, which is found out without the pattern.
    """
    return _holds_any(context, [*EPS_LAST_WORDS, LONG_S]) & context.rlike(EPS_PATTERN)


def _holds_any(text: Column, words) -> Column:
    return reduce(or_, [F.contains(text, F.lit(word)) for word in words])


def is_basic(context: Column) -> Column:
    return context.rlike("(?iu)basic")


def is_diluted(context: Column) -> Column:
    return context.rlike("(?iu)diluted")


def is_net(context: Column) -> Column:
    return _holds_any(F.lower(context), NET_WORDS)


def is_adjusted(context: Column) -> Column:
    return F.lower(context).rlike(ADJUSTED_PATTERN)


def type_labels(context: Column) -> Column:
    """Labels found in the context, in fixed order; ``gaap`` only where ``non-gaap`` is absent."""
    gaap = F.lower(context).rlike(GAAP_PATTERN) & ~is_adjusted(context)
    return F.array_compact(
        F.array(
            F.when(is_basic(context), "basic"),
            F.when(is_diluted(context), "diluted"),
            F.when(is_net(context), "net"),
            F.when(is_adjusted(context), "non-gaap"),
            F.when(gaap, "gaap"),
        )
    )


def share_type(context: Column) -> Column:
    return F.when(is_basic(context), "basic").when(is_diluted(context), "diluted")


def score(type_: Column, is_adjusted_: Column, is_net_: Column, is_loss_: Column) -> Column:
    """Higher wins: basic over diluted, unadjusted over adjusted, net, loss."""
    return (
        F.when(type_ == "basic", BASIC_SCORE).when(type_ == "diluted", DILUTED_SCORE).otherwise(0)
        + F.when(is_adjusted_, 0).otherwise(UNADJUSTED_SCORE)
        + F.when(is_net_, NET_SCORE).otherwise(0)
        + F.when(is_loss_, LOSS_SCORE).otherwise(0)
    )


def signed(context: Column, value: Column, force_loss_negative: bool = False) -> Column:
    """``value``, or with the option its negative where the context names nothing but a loss."""
    if not force_loss_negative:
        return value
    only_loss = context.rlike(LOSS_PATTERN) & ~context.rlike(GAIN_PATTERN)
    return F.when(only_loss, -F.abs(value)).otherwise(value)


def candidate_fields(context: Column, value: Column, loss: Column | None = None) -> list[Column]:
    """The columns of one candidate, from its context and value."""
    return [
        value.alias("value"),
        share_type(context).alias("type"),
        is_adjusted(context).alias("is_adjusted"),
        (value < 0 if loss is None else loss).alias("is_loss"),
        is_net(context).alias("is_net"),
        context.alias("context"),
    ]
