"""Word tokens of a text as native column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English stop words of Spark ML's StopWordsRemover.
STOP_WORDS = tuple(
    """
i me my myself we our ours ourselves you your yours yourself yourselves he
him his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through
during before after above below to from up down in out on off over under
again further then once here there when where why how all any both each few
more most other some such no nor not only own same so than too very s t can
will just don should now i'll you'll he'll she'll we'll they'll i'd you'd
he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot
could here's how's let's ought that's there's what's when's where's who's
why's would
""".split()
)

# The characters of the regex class \\s.
WHITESPACE = " \t\n\x0b\f\r"

WORD_SEPARATORS = r"[\W_]+"


def whitespace_tokens(text: Column) -> Column:
    """Lower-case tokens between single whitespace characters.

    A run of whitespace gives empty tokens inside the text and at its start but
    none at its end, and a text of whitespace alone gives no token.
    """
    kept = F.rtrim(F.lower(text), F.lit(WHITESPACE))
    only_blanks = (kept == "") & (text != "")
    return F.when(only_blanks, F.array().cast("array<string>")).otherwise(
        F.split(kept, r"\s")
    )


def without_stop_words(
    tokens: Column, stop_words: Iterable[str] = STOP_WORDS
) -> Column:
    """Tokens that are no stop word in any case, order and repeats kept."""
    stop = sorted({word.lower() for word in stop_words})
    if not stop:
        return tokens
    return F.filter(tokens, lambda token: ~F.lower(token).isin(stop))


def distinct_words(tokens: Column) -> Column:
    """Distinct ASCII alphanumeric runs of the tokens.

    The tokens are joined again so that one split serves the whole text: a
    blank is itself a separator, hence no word can span two tokens. Repeats go
    here, in the row, so that they never reach a shuffle.
    """
    return F.array_distinct(
        F.split(F.array_join(tokens, " "), WORD_SEPARATORS)
    )


def has_letter(word: Column) -> Column:
    return word.rlike("[a-zA-Z]")
