"""The text path: sentences, phrase variants, numbers and their nearness to the phrase.

Everything about a sentence - its tokens, their vectors, the comparison of numbers - stays in the
sentence's row as arrays; nothing is shuffled before candidates are ranked.
"""

import hashlib
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pershare.functions import labels
from pershare.functions.cells import strip
from pershare.functions.patterns import (
    PHRASES,
    SIMILARITY_THRESHOLD,
    SPACE,
    WORD,
    any_phrase_pattern,
    phrase_pattern,
    quote,
)
from pershare.functions.vectors import cosine, has_nan, let, mean_vector

# Workers get this module's code with the task, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A full stop after one of these ends no sentence.
ABBREVIATIONS = (
    "approx", "co", "corp", "dr", "e.p.s", "inc", "ltd", "mr", "mrs", "ms", "no", "u.s", "vs"
)

# Digits that are no decimal digits: superscript, subscript and circled forms.
_DIGIT = r"[\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨]"
# A number, or a part of one with at most one point, or a lone separator.
_NUMBER_PART = rf"^(?:{_DIGIT}+\.?{_DIGIT}*|\.{_DIGIT}+|[.,])\z"

TOKEN_TYPE = "array<struct<tok:string,vec:array<float>>>"
_ARROW_TOKENS = pa.list_(pa.struct([("tok", pa.string()), ("vec", pa.list_(pa.float32()))]))

Encoder = Callable[[list[str]], list[tuple[list[str], list]]]


def split_sentences(text: Column, abbreviations: tuple[str, ...] = ABBREVIATIONS) -> Column:
    """Pieces of text that end in ``.``, ``!`` or ``?``, with closing marks, before white space.

    A point within a number or a word ends nothing, nor does one after an abbreviation.
    """
    ends = r"([.!?][\"')\]”’]*+)"
    if abbreviations:
        known = "|".join(quote(a) for a in abbreviations)
        ends += rf"(?<!(?<!{WORD})(?i:{known})\.)"
    # a noncharacter stands for the white space at the ends, so any number of closing marks may come before it
    marked = F.regexp_replace(F.replace(text, F.lit("\uffff"), F.lit(" ")), rf"{ends}{SPACE}+", "$1\uffff")
    return F.split(marked, "\uffff")


def sentences(texts: DataFrame, abbreviations: tuple[str, ...] = ABBREVIATIONS) -> DataFrame:
    """One row per sentence of ``text``; other columns stay."""
    keep = [c for c in texts.columns if c != "text"]
    split = texts.select(
        *keep, F.posexplode(split_sentences(F.col("text"), abbreviations)).alias("sent_idx", "s")
    )
    return split.select(*keep, "sent_idx", strip(F.col("s")).alias("sentence")).filter(
        F.col("sentence") != ""
    )


def mentions_any(text: Column, phrases: tuple[str, ...] = PHRASES) -> Column:
    return text.rlike(any_phrase_pattern(phrases))


def sentence_variants(
    sents: DataFrame, phrases: tuple[str, ...] = PHRASES, outer: bool = False
) -> DataFrame:
    """One row per sentence and phrase found in it: ``variant_idx`` and ``phrase``.

    With ``outer`` a sentence without any stays as one row with nulls.
    """
    sentence = F.col("sentence")
    found = F.array_compact(
        F.array(
            *(
                F.when(
                    sentence.rlike("(?iud)" + phrase_pattern(phrase)),
                    F.struct(F.lit(i).alias("variant_idx"), F.lit(phrase).alias("phrase")),
                )
                for i, phrase in enumerate(phrases)
            )
        )
    )
    return sents.select("*", F.inline_outer(found) if outer else F.inline(found))


def token_vectors(sents: DataFrame, make_encoder: Callable[[], Encoder]) -> DataFrame:
    """Add ``tokens``: token text and vector, from an encoder supplied by the caller.

    ``make_encoder`` returns a function from a list of sentences to a list of (token texts, vectors). It is called once in
    the life of a Python worker, which serves many tasks, and not before the first sentence comes. Null sentences get null
    without being encoded.
    """
    digest = hashlib.sha256(cloudpickle.dumps(make_encoder)).hexdigest()

    @F.arrow_udf(TOKEN_TYPE)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = batch.to_pylist()
            wanted = [t for t in texts if t is not None]
            encoded = iter(_encoder(digest, make_encoder)(wanted) if wanted else [])
            rows = [None if t is None else _token_rows(*next(encoded)) for t in texts]
            yield pa.array(rows, type=_ARROW_TOKENS)

    return sents.withColumn("tokens", encode.asNondeterministic()(F.col("sentence")))


def _encoder(digest: str, make_encoder: Callable[[], Encoder]) -> Encoder:
    """The worker's encoder; this module's own globals come anew with every task, so it is kept beside the modules."""
    kept = sys.modules.setdefault("_pershare_encoders", types.ModuleType("_pershare_encoders"))
    if not hasattr(kept, digest):
        setattr(kept, digest, make_encoder())
    return getattr(kept, digest)


def _token_rows(texts, vectors) -> list[dict]:
    return [{"tok": tok, "vec": vec} for tok, vec in zip(texts, vectors, strict=True)]


def anchor_tokens(tokens: Column, phrase: Column) -> Column:
    """Tokens that contain some word of the phrase."""
    words = F.split(phrase, " ")
    return F.filter(
        tokens, lambda t: F.exists(words, lambda word: F.contains(F.lower(t.tok), word))
    )


def anchor_vector(tokens: Column, phrase: Column) -> Column:
    """Mean vector of the anchor tokens; null without any."""
    return mean_vector(F.transform(anchor_tokens(tokens, phrase), lambda t: t.vec))


def dollar_numbers(tokens: Column) -> Column:
    """Decimal numbers after a dollar sign: ``num`` and ``tok_idx``, the place of the sign.

    A number is the run of number parts right after the sign, joined, without its commas; a run
    without a point is no decimal number. Each run lies between two tokens that are no number
    parts, so the places of those tokens are enough to find all runs in one pass.
    """
    stops = F.transform(tokens, lambda t, i: F.when(~t.tok.rlike(_NUMBER_PART), i))

    def runs(bounds: Column) -> Column:
        def run(bound: Column, k: Column) -> Column:
            length = F.get(bounds, k + 1) - bound - 1
            parts = F.transform(F.slice(tokens, bound + 2, length), lambda t: t.tok)
            return F.when(
                (F.get(tokens, bound).tok == "$") & (length > 0),
                F.struct(
                    F.translate(F.array_join(parts, ""), ",", "").alias("num"),
                    bound.alias("tok_idx"),
                ),
            )

        return F.array_compact(F.transform(bounds, run))

    found = let(F.concat(F.array_compact(stops), F.array(F.size(tokens))), runs)
    return F.filter(found, lambda r: F.contains(r.num, F.lit(".")))


def number_similarities(tokens: Column, numbers: Column, anchor: Column) -> Column:
    """Each number with the similarity of its sign's vector to the anchor.

    ``sim`` is null for a vector that is no number somewhere, and so is the whole result without
    an anchor.
    """

    def compare(number: Column) -> Column:
        similarity = let(
            F.get(tokens, number.tok_idx).vec,
            lambda vector: F.when(~has_nan(vector), cosine(vector, anchor)),
        )
        return F.struct(
            similarity.alias("sim"), (-number.tok_idx).alias("place"), number.num.alias("num")
        )

    return F.when(anchor.isNotNull() & ~has_nan(anchor), F.transform(numbers, compare))


def nearest_number(
    tokens: Column, phrase: Column, threshold: float | None = SIMILARITY_THRESHOLD
) -> Column:
    """``sim``, ``place`` (negative token index) and ``num`` of the number nearest to the phrase.

    Of equally near numbers the first wins. Null where none is nearer than ``threshold``, or where
    some number cannot be compared at all.
    """

    def best(numbers: Column) -> Column:
        compared = let(
            anchor_vector(tokens, phrase),
            lambda anchor: number_similarities(tokens, numbers, anchor),
        )
        return let(
            compared,
            lambda all_: F.when(
                ~F.exists(all_, lambda n: n.sim.isNull()), F.array_max(all_)
            ),
        )

    found = let(dollar_numbers(tokens), lambda n: F.when(F.size(n) > 0, best(n)))
    return found if threshold is None else let(found, lambda f: F.when(f.sim > threshold, f))


def nearest_numbers(
    variants: DataFrame, threshold: float | None = SIMILARITY_THRESHOLD
) -> DataFrame:
    """``num``, ``tok_idx`` and ``sim`` of the nearest number of each sentence and phrase."""
    return (
        variants.withColumn("best", nearest_number(F.col("tokens"), F.col("phrase"), threshold))
        .filter(F.col("best").isNotNull())
        .select(
            *(c for c in variants.columns if c != "tokens"),
            F.col("best.num").alias("num"),
            (-F.col("best.place")).alias("tok_idx"),
            F.col("best.sim").alias("sim"),
        )
    )


def text_candidates(nearest: DataFrame) -> DataFrame:
    """Candidates from the nearest numbers; those that cannot be read are dropped."""
    sentence = F.col("sentence")
    return (
        nearest.withColumn("number", F.col("num").try_cast("double"))
        .filter(F.col("number").isNotNull())
        .select(
            "filename",
            F.lit("text").alias("source"),
            "elem_seq",
            "sent_idx",
            "variant_idx",
            *labels.candidate_fields(sentence, F.col("number"), F.lit(False)),
        )
    )
