"""Column -> Column text rules: tokenising, bracket/quote clean-up, validity.

Every rule is a native expression, so it runs inside the JVM and can be used on
any string column, in a projection or in a higher-order function.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: what the corpus format and the counting rules prescribe. ---
# Markup removed from every body before anything else, in this order.
BUILTIN_SKIP_PATTERNS = (
    r"\(ABSTRACT TRUNCATED AT \d+ WORDS\)",
    r'<s n="\d+">',
    r"[.?]?</s>",
)
NO_HEADINGS = "No_Headings"
# Last character of a gram, or of a word, that is cut once.
GRAM_END = r"[;:,]\z"
WORD_END = r"[;:,.]\z"
# Bracket/quote rules: (pattern, replacement), applied in the order listed below.
OUTER_PARENS = (r"\A\(([^()]*)\)\z", "$1")
LONE_OPENER = (r"""\A(?:\(([^)]*)|"([^"]*)|'([^']*))\z""", "$1$2$3")
LONE_CLOSER = (r"""\A(?:([^(]*)\)|([^"]*)"|([^']*)')\z""", "$1$2$3")
SAME_QUOTES = (r"""(?s)\A(?:"(.*)"|'(.*)')\z""", "$1$2")
LONE_OPEN_PAREN = (r"\A\(([^)]*)\z", "$1")
LONE_CLOSE_PAREN = (r"\A([^(]*)\)\z", "$1")
LONE_OPEN_QUOTE = (r"""\A(?:"([^"]*)|'([^']*))\z""", "$1$2")
FIRST_QUOTE_LAST = (r"""\A(?:([^"]*)"|([^']*)')\z""", "$1$2")
GRAM_RULES = (OUTER_PARENS, LONE_OPENER, LONE_CLOSER, SAME_QUOTES)
WORD_RULES = GRAM_RULES + (LONE_OPEN_QUOTE, FIRST_QUOTE_LAST)
PAIR_RULES = (
    OUTER_PARENS,
    LONE_OPEN_PAREN,
    LONE_CLOSE_PAREN,
    SAME_QUOTES,
    LONE_OPEN_QUOTE,
    FIRST_QUOTE_LAST,
)
LETTER = r"[A-Za-z_]"
# --- End of fixed values. ---

# Whitespace, "/" and "-" separate tokens, except inside arrows (-->), signs in
# parentheses (+-) and sign pairs +/-. Possessive quantifiers keep the matcher
# iterative (no stack growth on a token of any length); the look-behinds let a
# run of dashes or signs be tried once, not once per character.
TOKEN = (
    r"(?:[^\s/(+-]++"
    r"|(?<!-)-++>"
    r"|\([+-]++\)"
    r"|(?<![+-])[+-]++/[+-]++"
    r"|[(+])++"
)
TRIMMED = "".join(map(chr, range(0x21)))


def java_trim(col: Column) -> Column:
    """Strip every leading and trailing character up to U+0020."""
    return F.btrim(col, F.lit(TRIMMED))


def strip_patterns(body: Column, skip_patterns: Sequence[str] = ()) -> Column:
    """Remove the built-in markup, then the caller's patterns in the order given."""
    return reduce(
        lambda c, p: F.regexp_replace(c, F.lit(p), F.lit("")),
        (*BUILTIN_SKIP_PATTERNS, *skip_patterns),
        body,
    )


def prepare_body(
    body: Column, case_sensitive: bool = True, skip_patterns: Sequence[str] = ()
) -> Column:
    """Case folding comes first, so upper-case patterns miss a folded text."""
    return strip_patterns(body if case_sensitive else F.lower(body), skip_patterns)


def sentences(body: Column) -> Column:
    """One array element per line."""
    return F.split(body, "\n")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def word_runs(text: Column) -> Column:
    """Tokens of a text to be stemmed: runs of ASCII word characters."""
    return F.regexp_extract_all(text, F.lit(r"\w+"), F.lit(0))


def _apply(rules, col: Column) -> Column:
    return reduce(lambda c, r: F.regexp_replace(c, F.lit(r[0]), F.lit(r[1])), rules, col)


def _clean(col: Column, end: str, rules, touches: str) -> Column:
    # Most terms hold none of the characters any rule looks at: one cheap scan
    # decides, the chain runs on the rest.
    chain = _apply(rules, F.regexp_replace(col, F.lit(end), F.lit("")))
    return F.when(col.rlike(touches), chain).otherwise(col)


def clean_gram(gram: Column) -> Column:
    return _clean(gram, GRAM_END, GRAM_RULES, r"""[()"';:,]""")


def clean_word(word: Column, variant: str = "word") -> Column:
    """`variant` is "word" for word counts, "pair" for co-occurrence."""
    if variant not in ("word", "pair"):
        raise ValueError(f"unknown variant: {variant!r}")
    rules = WORD_RULES if variant == "word" else PAIR_RULES
    return _clean(word, WORD_END, rules, r"""[()"';:,.]""")


def gram_is_stable(gram: Column) -> Column:
    """True where the bracket/quote rules and a trim leave the gram as it is."""
    untouched = ~gram.rlike(r"""[()"']""")
    return untouched | (java_trim(_apply(GRAM_RULES, gram)) == gram)


def has_letter(col: Column) -> Column:
    return col.rlike(LETTER)


def valid_raw_gram(gram: Column) -> Column:
    """Validity of the *cleaned* gram, decided on the raw one.

    Clean-up removes punctuation only, so whether a letter is left shows already
    before it. A cleaned gram can start with a blank only where the first token
    was a lone opener; only there the clean-up is evaluated for the test.
    """
    return has_letter(gram) & ~(
        gram.rlike(r"""\A[("'] """) & clean_gram(gram).startswith(" ")
    )


def valid_word(word: Column) -> Column:
    """Test on a cleaned word: more than one character, no lone leading . or *."""
    return (F.length(word) > 1) & ~word.rlike(r"\A(?:\.[^.]*|\*[^*]*)\z")


def headings(header: Column) -> Column:
    """Subject headings: third of exactly three ':' parts, split at '|'."""
    parts = F.split(F.regexp_replace(header, r":+\z", ""), ":")
    third = F.regexp_replace(F.get(parts, F.lit(2)), r"\|+\z", "")
    listed = F.when(third == "", F.array().cast("array<string>")).otherwise(
        F.split(third, r"\|")
    )
    return F.when(F.size(parts) == 3, listed).otherwise(F.array(F.lit(NO_HEADINGS)))


def gram_windows(toks: Column, n: int) -> Column:
    """Every `n` consecutive tokens joined by a blank.

    The last n-1 positions have no window and hold NULL, which the validity
    filter drops; that is cheaper than slicing the array first.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    return F.transform(toks, lambda x, i: _window(toks, x, i, n))


def _window(toks: Column, x: Column, i: Column, n: int) -> Column:
    parts = [x]
    for k in range(1, n):
        parts += [F.lit(" "), F.get(toks, i + k)]
    return F.concat(*parts) if n > 1 else x


def gram_windows_between(toks: Column, lo: int, hi: int) -> Column:
    """Windows of all sizes lo..hi as structs (n, gram), NULL grams as above."""
    if not 1 <= lo <= hi:
        raise ValueError("need 1 <= lo <= hi")
    return F.flatten(
        F.transform(
            toks,
            lambda x, i: F.array(
                *[
                    F.struct(F.lit(n).alias("n"), _window(toks, x, i, n).alias("gram"))
                    for n in range(lo, hi + 1)
                ]
            ),
        )
    )
