"""Suffix stripping after M. F. Porter, "An algorithm for suffix stripping" (1980).

Stems are computed per Arrow batch on its distinct tokens only; the rest of the
batch is filled by index. The helper is plain Python, small and stateless apart
from a bounded memo per worker.
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: the suffix tables of the published algorithm. ---
STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
)
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)
# --- End of fixed values. ---

_MEMO_LIMIT = 1 << 18


def _shape(word: str) -> str:
    """One letter per character: v(owel) or c(onsonant)."""
    out = []
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out.append("v" if vowel else "c")
    return "".join(out)


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _cvc(word: str) -> bool:
    return _shape(word)[-3:] == "cvc" and len(word) > 2 and word[-1] not in "wxy"


def _longest(word: str, table):
    """The longest matching suffix decides, whether or not its condition holds."""
    hits = [row for row in table if word.endswith(row[0])]
    return max(hits, key=lambda row: len(row[0])) if hits else None


def porter(word: str) -> str:
    """Stem of one token. Words of one or two letters stay as they are."""
    if len(word) < 3:
        return word
    # plurals
    hit = _longest(word, (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")))
    if hit:
        word = word[: -len(hit[0])] + hit[1]
    # -eed, -ed, -ing
    hit = _longest(word, (("eed", "ee"), ("ed", ""), ("ing", "")))
    if hit:
        stem = word[: -len(hit[0])]
        if hit[0] == "eed":
            if _measure(stem) > 0:
                word = stem + "ee"
        elif "v" in _shape(stem):
            word = stem
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif _double(word) and word[-1] not in "lsz":
                word = word[:-1]
            elif _measure(word) == 1 and _cvc(word):
                word += "e"
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    # derivational suffixes
    for table in (STEP2, STEP3):
        hit = _longest(word, table)
        if hit and _measure(word[: -len(hit[0])]) > 0:
            word = word[: -len(hit[0])] + hit[1]
    hit = _longest(word, [(s,) for s in STEP4])
    if hit:
        stem = word[: -len(hit[0])]
        if _measure(stem) > 1 and (hit[0] != "ion" or stem.endswith(("s", "t"))):
            word = stem
    # final -e, -ll
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _cvc(stem)):
            word = stem
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


_memo: dict[str, str] = {}


def _stem_distinct(values: pa.Array) -> pa.Array:
    """Stem a string array through its dictionary of distinct values."""
    coded = values.dictionary_encode()
    if len(_memo) > _MEMO_LIMIT:
        _memo.clear()
    stems = []
    for token in coded.dictionary.to_pylist():
        stem = _memo.get(token)
        if stem is None:
            stem = _memo[token] = porter(token)
        stems.append(stem)
    return pa.array(stems, pa.string()).take(coded.indices)


def _stem_array(column: pa.Array) -> pa.Array:
    return _stem_distinct(column)


def _stem_lists(column: pa.Array) -> pa.Array:
    lengths = column.value_lengths().fill_null(0).to_pylist()
    offsets = [0]
    for k in lengths:
        offsets.append(offsets[-1] + k)
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), _stem_distinct(column.flatten())
    )


def stem(token: Column) -> Column:
    """Stem of a string column."""
    return F.arrow_udf(_stem_array, "string")(token)


def stem_all(toks: Column) -> Column:
    """Stems of an array<string> column, order kept."""
    return F.arrow_udf(_stem_lists, "array<string>")(toks)


# Ship these few functions with the task, so that executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
