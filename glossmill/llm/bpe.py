"""Byte-level BPE: texts to token ids and back.

A text is cut by the tokenizer's pattern; the pieces ("words" here) are encoded
each for itself. Distinct words are encoded with Spark's higher-order functions:
a fold over the array of a word's bytes that joins, step by step, the adjacent
pair whose union has the lowest rank, ranks coming from a literal map. Words are
not joined back to texts by a shuffle of all words. The most frequent ones, a
fixed number, are encoded once and given to all tasks; the other distinct words of
some texts are encoded where these are, by the same fold over arrays: a step joins
a pair in every word. Nothing but word counts is shuffled.
Tasks hold texts, distinct words and ids as arrays, two MB of text at a time.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossmill.llm.arrays import gather, row_runs, text_bytes, text_chunks
from glossmill.llm.common import stored

HEAD = 400_000  # most frequent words whose ids every task holds (about 15 MB)
BUCKETS = 65536  # of the rank map: a lookup reads one bucket of a few entries
SHORT = 32  # characters of a word that may be held by every task
LONG = 128  # bytes of a word above which pairs are joined with a heap
CHUNK = 2 << 20  # bytes of text, or of ids, of the rows that a task works on together

# White space as the tokenizer's pattern sees it (Unicode's property).
_BLANK = "\t\n\v\f\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_ASCII_BLANK = np.array([chr(b) in _BLANK[:6] for b in range(256)])
_WIDE_BLANK = [c.encode() for c in _BLANK[6:]]
# One word for certain, by any version of Unicode.
_LETTERS = "^ ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+$"


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file of lines `base64 rank`."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def byte_string(word: Column) -> Column:
    """The UTF-8 bytes of a word as a string of one character per byte."""
    return F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The ranks as one literal: an array of small maps, chosen by hash.

    Written as JSON, which the optimizer turns into a value when it plans.
    """
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        key = piece.decode("latin-1")
        buckets[zlib.crc32(key.encode()) % BUCKETS][key] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, without the copy of the result that transform() makes: for states."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda x, _: x, body)


def fold(word: Column, table: Column) -> Column:
    """Token ids of a word (see `byte_string`): merges by rank folded over its bytes.

    The state is the array of pieces and the rank of each with its right
    neighbour; a step joins the leftmost pair of lowest rank and looks up the two
    ranks that changed. Steps after the last possible merge leave it as it is.
    """
    return bound(table, lambda t: bound(word, lambda w: _fold(w, t)))


def _fold(word: Column, table: Column) -> Column:
    def rank(piece):
        bucket = (F.crc32(piece.cast("binary")) % BUCKETS).cast("int")
        return F.try_element_at(F.get(table, bucket), piece)  # NULL: no such piece

    def spliced(*arrays):
        return F.flatten(F.array(*arrays))

    def join(state, i):  # from 1: the pair of pieces i and i + 1
        pieces, ranks = state["p"], state["r"]

        def joined(piece):
            left = F.when(
                i > 1, F.array(rank(F.concat(F.get(pieces, i - 2), piece)))
            ).otherwise(F.array().cast("array<int>"))
            right = F.when(
                i + 1 < F.size(pieces),
                F.array(rank(F.concat(piece, F.get(pieces, i + 1)))),
            ).otherwise(F.array().cast("array<int>"))
            # flatten() of slices is cheaper to interpret than concat() of arrays.
            return F.struct(
                spliced(
                    F.slice(pieces, F.lit(1), i - 1),
                    F.array(piece),
                    F.slice(pieces, i + 2, F.size(pieces)),
                ).alias("p"),
                spliced(
                    F.slice(ranks, F.lit(1), F.greatest(i - 2, F.lit(0))),
                    left,
                    right,
                    F.slice(ranks, i + 2, F.size(pieces)),
                ).alias("r"),
            )

        return bound(F.concat(F.get(pieces, i - 1), F.get(pieces, i)), joined)

    def step(state, _):
        # The low bits of the least number: the first place of the lowest rank.
        best = F.array_min(
            F.transform(state["r"], lambda r, i: r.cast("long") * (1 << 20) + i)
        )
        place = (best % (1 << 20)).cast("int") + 1
        return bound(place, lambda i: F.when(i.isNull(), state).otherwise(join(state, i)))

    def merged(single):
        pairs = F.transform(
            F.slice(single, F.lit(1), F.size(single) - 1),
            lambda b, i: rank(F.concat(b, F.get(single, i + 1))),
        )
        return F.aggregate(
            F.slice(single, F.lit(1), F.size(single) - 1),
            F.struct(single.alias("p"), pairs.alias("r")),
            step,
            lambda state: F.transform(state["p"], rank),
        )

    whole = rank(word)
    pieces = bound(F.split(word, ""), merged)
    return F.when(whole.isNotNull(), F.array(whole)).otherwise(pieces)


def heap_merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same ids for a word of any length, in n log n steps."""
    n = len(word)
    end = list(range(1, n + 1))  # of the piece that starts here
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n

    def push(i):
        j = after[i]
        if j < n:
            rank = ranks.get(word[i : end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[i], end[j]))

    heap: list[tuple[int, int, int, int]] = []
    for i in range(n):
        push(i)
    while heap:
        _, i, middle, stop = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or end[i] != middle or end[j] != stop:
            continue
        end[i], alive[j], after[i] = stop, False, after[j]
        if after[j] < n:
            before[after[j]] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def pair_table(ranks: dict[bytes, int]):
    """Ranks of the single bytes; pairs of ranks that make a piece, sorted, and its rank."""
    single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], "<i8")
    made = {}
    for piece, rank in ranks.items():
        for i in range(1, len(piece)):
            a, b = ranks.get(piece[:i]), ranks.get(piece[i:])
            if a is not None and b is not None:
                made[a << 32 | b] = rank
    keys = np.array(sorted(made), "<i8")
    return single, keys, np.array([made[k] for k in keys.tolist()], "<i8")


def fold_words(words: list[bytes], table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The fold over the bytes of many words together: ids, each word's first and count.

    A step joins in every word the leftmost pair of lowest rank, as `fold` does.
    Words of about the same length share a matrix; `table` is that of `pair_table`.
    """
    single, keys, made = table
    none = np.iinfo(np.int64).max
    size = np.fromiter(map(len, words), np.int64, len(words))
    flat = single[np.frombuffer(b"".join(words), np.uint8)]
    begin = np.cumsum(size) - size

    def rank(a, b):
        key = a << 32 | b
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (keys[at] == key), made[at], none)

    first, count, out, held = np.empty_like(size), np.empty_like(size), [], 0
    least, width = 0, 8
    while least < size.max(initial=0):
        some = np.flatnonzero((size <= width) & (size > least))
        ids = np.full((len(some), width), -1, np.int64)
        places = np.arange(width)
        ids[places < size[some, None]] = gather(flat, begin, size, some)[0]
        ranks = rank(ids[:, :-1], ids[:, 1:])
        live = np.arange(len(some))
        while len(live):
            at = ranks[live].argmin(axis=1)
            best = ranks[live, at]
            on = best < none
            live, at, best = live[on], at[on], best[on]
            each = np.arange(len(live))
            old, new = ids[live], np.full((len(live), width), -1, np.int64)
            new[:, :-1] = old[:, 1:]
            new = np.where(places > at[:, None], new, old)
            new[each, at] = best
            ids[live] = new
            old, moved = ranks[live], np.full((len(live), width - 1), none, np.int64)
            moved[:, :-1] = old[:, 1:]
            moved = np.where(places[:-1] > at[:, None], moved, old)
            moved[each, at] = rank(best, new[each, at + 1])
            back = np.flatnonzero(at > 0)
            moved[back, at[back] - 1] = rank(new[back, at[back] - 1], best[back])
            ranks[live] = moved
        left = ids >= 0
        count[some] = left.sum(axis=1)
        first[some] = held + np.cumsum(count[some]) - count[some]
        out.append(ids[left].astype("<i4"))
        held += len(out[-1])
        least, width = width, 2 * width
    return np.concatenate([np.empty(0, "<i4"), *out]), first, count


def _splitter(pattern: str):
    """Function from a unit to its words.

    The pattern keeps a run of letters with a space before it together, and a run
    of these marks after it: most units need no search.
    """
    search = regex.compile(pattern).findall

    def split(unit: str) -> list[str]:
        start = 1 if unit[0] == " " else 0
        if unit[start:].isalpha():
            return [unit]
        if unit[-1] in ".,!?;:" and unit[start:-1].isalpha():
            return [unit[:-1], unit[-1]]
        return search(unit)

    return split


def _unit_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the units of texts begin: bytes of all, and where each text begins or ends.

    Words never cross the border of a unit. A unit is a run without blanks together
    with one space before it, or blanks that no such unit takes: of blanks before a
    word the last is apart from the others.
    """
    blank = _ASCII_BLANK[data]
    for code in _WIDE_BLANK:
        at = np.flatnonzero(data[: len(data) - len(code) + 1] == code[0])
        for i in range(1, len(code)):
            at = at[data[at + i] == code[i]]
        for i in range(len(code)):
            blank[at + i] = True
    begins = np.zeros(len(data) + 1, bool)
    begins[texts] = True
    turns = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    is_blank = blank[turns]
    words = turns[~is_blank]
    words = words[~begins[words]]  # where a word follows a blank of its text
    last = words - 1
    for _ in range(2):
        last -= (data[last] & 0xC0) == 0x80  # to the first byte of the blank
    begins[turns[is_blank]] = True
    begins[last] = True
    begins[words[data[last] != 0x20]] = True
    return np.flatnonzero(begins[:-1])


class _Parted:
    """Texts as numbers: each unit's place among distinct ones, each of these as words.

    `units`, `unit_ends`: places of all texts' units, and where each text's end;
    `first`, `count`, `parts`: a distinct unit's words are `parts[first:first + count]`;
    `words`: the distinct words.
    """

    def __init__(self, texts: pa.Array, split: Callable[[str], list[str]]):
        data, ends = text_bytes(texts)
        starts = _unit_starts(data, ends)
        self.unit_ends = np.searchsorted(starts, ends[1:])
        borders = np.append(starts, len(data)).astype("<i4")
        each = pa.StringArray.from_buffers(len(starts), pa.py_buffer(borders), pa.py_buffer(data))
        each = each.dictionary_encode()
        self.units, distinct = each.indices.to_numpy(), each.dictionary
        plain = pc.match_substring_regex(distinct, _LETTERS)
        rest = list(map(split, distinct.filter(pc.invert(plain)).to_pylist()))
        plain = plain.to_numpy(zero_copy_only=False)
        words = pa.concat_arrays(
            [distinct.filter(pa.array(plain)), pa.array([w for some in rest for w in some], pa.string())]
        ).dictionary_encode()
        self.words, place = words.dictionary, words.indices.to_numpy()
        self.count = np.ones(len(distinct), np.int64)
        self.count[~plain] = [len(some) for some in rest]
        self.first = np.cumsum(self.count) - self.count
        self.parts = np.empty(len(place), np.int64)
        others = np.ones(len(place), bool)
        others[self.first[plain]] = False
        n = int(plain.sum())
        self.parts[self.first[plain]], self.parts[others] = place[:n], place[n:]

    def word_counts(self) -> np.ndarray:
        n = np.bincount(self.units, minlength=len(self.count))
        # Sums below 2 ** 53 are exact.
        n = np.bincount(self.parts, np.repeat(n, self.count), len(self.words))
        return n.astype(np.int64)


def _count_task(pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _splitter(pattern)
        for batch in batches:
            for _, texts in text_chunks(batch, batch.schema.names[0], CHUNK):
                parted = _Parted(texts, split)
                short = pc.less_equal(pc.utf8_length(parted.words), SHORT)
                found = pa.record_batch({"word": parted.words, "n": pa.array(parted.word_counts())})
                yield found.filter(short)

    return run


def _word_codes(words: pa.Array, head, ranks: dict[bytes, int], table):
    """Ids of distinct words one after the other, each word's first and count."""
    known, codes, ends = head
    # The words are fewer than the head: they make the table that the head is looked up in.
    place = pc.index_in(known, value_set=words)
    at = np.flatnonzero(place.is_valid().to_numpy(zero_copy_only=False))
    found = np.zeros(len(words), bool)
    found[place := place.drop_null().to_numpy()] = True
    at = at[np.argsort(place)]
    first, count = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
    values = [gather(codes, ends[:-1], np.diff(ends), at)[0]]
    count[found] = np.diff(ends)[at]
    first[found] = np.cumsum(count[found]) - count[found]
    rest = np.flatnonzero(~found)
    raw = [w.encode() for w in words.take(pa.array(rest)).to_pylist()]
    whole = [(i, [ranks[w]]) for i, w in zip(rest, raw) if w in ranks]
    long = [(i, heap_merge(w, ranks)) for i, w in zip(rest, raw) if len(w) > LONG and w not in ranks]
    short = [(i, w) for i, w in zip(rest, raw) if len(w) <= LONG and w not in ranks]
    held = len(values[0])
    for i, ids in whole + long:
        values.append(np.array(ids, "<i4"))
        first[i], count[i] = held, len(ids)
        held += len(ids)
    which = [i for i, _ in short]
    folded, at, count[which] = fold_words([w for _, w in short], table)
    first[which] = held + at
    return np.concatenate([*values, folded]), first, count


def _encode_task(pattern: str, head, ranks, table, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _splitter(pattern)
        for batch in batches:
            for part, texts in text_chunks(batch, "__text", CHUNK):
                parted = _Parted(texts, split)
                values, first, count = _word_codes(parted.words, head.value, ranks.value, table.value)
                # From words to distinct units, from these to texts.
                values, ends = gather(values, first, count, parted.parts)
                ends = np.append(0, ends)
                first, last = ends[parted.first], ends[parted.first + parted.count]
                ids, ends = gather(values, first, last - first, parted.units)
                ends = np.append(0, ends)[np.append(0, parted.unit_ends)]
                columns = {n: part.column(n) for n in part.schema.names if n != "__text"}
                columns[name] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                yield pa.record_batch(columns)

    return run


def frequent_words(docs: DataFrame, pattern: str, text: str = "text", head: int = HEAD) -> DataFrame:
    """`word, n`: all words from some frequency on, `head` at most and none found once.

    Only words of at most 32 characters are looked at, which bounds the size of the
    table; longer ones are not worth a place. Counts are exact, over every document.
    """
    counted = docs.select(F.col(text)).mapInArrow(_count_task(pattern), "word string, n long")
    total = stored(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")
    # Frequencies in steps of a quarter of a power of two: some hundred numbers.
    step = F.floor(F.log2("n") * 4).alias("step")
    sizes = total.filter("n > 1").groupBy(step).agg(F.count("*"), F.min("n")).collect()
    room, least = head, None
    for _, words, n in sorted(sizes, reverse=True):
        room -= words
        if room < 0:
            break
        least = n
    return total.filter(F.col("n") >= least) if least else total.limit(0)


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    head: int = HEAD,
) -> DataFrame:
    """`docs` without its text and with `ids` (array<int>).

    NULL and empty texts have no ids. Rows may repeat. Texts and words may be of
    any length: words of over 128 bytes are merged with a heap, to the same ids.
    An empty table gives an empty one.
    """
    spark = docs.sparkSession
    table = rank_map(ranks)
    frequent = frequent_words(docs, pattern, text, head).select(
        "word", fold(byte_string(F.col("word")), table).alias("ids")
    )
    rows = frequent.toArrow().combine_chunks()
    codes = pa.concat_arrays([pa.array([], rows.schema.field("ids").type), *rows["ids"].chunks])
    words = pa.concat_arrays([pa.array([], pa.string()), *rows["word"].cast(pa.string()).chunks])
    # Three arrays: no worker holds an object for a word.
    known = words, codes.values.to_numpy(), codes.offsets.to_numpy().astype(np.int64)
    context = spark.sparkContext
    shared = [context.broadcast(x) for x in (known, ranks, pair_table(ranks))]
    columns = [c for c in docs.columns if c != text]
    slim = docs.select(*columns, F.col(text).alias("__text"))
    schema = T.StructType([*slim.drop("__text").schema, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return slim.mapInArrow(_encode_task(pattern, *shared, ids), schema)


def _list_chunks(batch: pa.RecordBatch, name: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch by numbers in an array column, with these and where each row's end."""
    ends = batch.column(name).offsets.to_numpy()
    flat = batch.column(name).values.to_numpy()  # offsets count from its first number
    for lo, hi in row_runs(ends, CHUNK // 4):
        yield batch.slice(lo, hi - lo), flat[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo]


def _decode_task(pieces, source: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, ids, ends in _list_chunks(batch, source):
                raw = pieces.value.take(pa.array(ids))
                stops = np.frombuffer(raw.buffers()[1], "<i4")[raw.offset : raw.offset + len(raw) + 1]
                borders = pa.py_buffer(np.ascontiguousarray(stops[ends]))
                raw = pa.BinaryArray.from_buffers(pa.binary(), part.num_rows, [None, borders, raw.buffers()[2]])
                columns = {n: part.column(n) for n in part.schema.names}
                yield pa.record_batch(columns | {name: raw})

    return run


def decode(coded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", name: str = "decoded") -> DataFrame:
    """`coded` with the new column `name`: the pieces of its ids, concatenated (binary).

    NULL and empty arrays give the empty string of bytes; an id outside the
    vocabulary fails.
    """
    pieces = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    shared = coded.sparkSession.sparkContext.broadcast(pa.array(pieces, pa.binary()))
    schema = T.StructType([*coded.schema.fields, T.StructField(name, T.BinaryType())])
    return coded.mapInArrow(_decode_task(shared, ids, name), schema)
