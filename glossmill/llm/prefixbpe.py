"""Byte-level BPE by dynamic programming over prefixes (encoder of a tokenizers JSON file).

For a piece of text (one match of the pre-tokenizer's pattern) the BPE encoding of
every prefix ends in one token, and that last token is the only token t which ends
the prefix and which is compatible with the last token u of the prefix before t:
BPE of the bytes of u and t together gives exactly u, t. So, going left to right,
each prefix stores its last token; an Aho-Corasick automaton over the vocabulary
lists the tokens that end at each byte, longest first, and the first compatible
one is taken. Following these back-pointers from the end gives the ids.
Whether a token encodes to itself (which it must to appear at all) is decided once
by plain BPE over its bytes, which also gives the merge that makes it. Compatibility
of a pair then walks up the right spine of the first and the left spine of the
second (the tokens that stand at their boundary while they are built) and asks
whether a merge across the boundary comes first; it is remembered per pair.

Added tokens (here `<|endoftext|>`) are split out first and become their ids, as
the library does with add_special_tokens=False; decoding joins the tokens' bytes,
added tokens as their text, and reads them as UTF-8 with replacement.

Spark runs this in Pandas UDFs: each Python worker loads the vocabulary once, and
remembers the ids of the pieces it met (up to CACHE pieces) and the pairs it tested
(up to PAIRS), then starts over, so its memory is bounded whatever the input.
`digests` encodes and decodes in one pass and hands only digests back to the JVM.

Defined cases: a NULL text encodes as no ids and decodes to the empty text; empty
texts likewise; very long texts are encoded whole (pieces are found by the pattern,
a piece of any length takes time linear in its number of token matches); extra
columns are carried through, `ids` and `decoded` replace input columns of those names.
"""

from __future__ import annotations

import json
from itertools import chain
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CACHE = 1 << 19
PAIRS = 1 << 20


def byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others
    take the characters from U+0100 on, in byte order."""
    keep = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    kept = set(keep)
    out, extra = {}, 0
    for b in range(256):
        if b in kept:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


class _Pieces(dict):
    """Ids of the pieces met, computed on a miss; cleared when CACHE are held."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def __missing__(self, text: str) -> tuple[int, ...]:
        if len(self) >= CACHE:
            self.clear()
        ids = self[text] = self.model.piece(text)
        return ids


class PrefixBPE:
    def __init__(self, path: str, pattern: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        alphabet = byte_alphabet()
        self.vocab = model["vocab"]
        self.token_bytes: dict[int, bytes] = {}
        for text, i in self.vocab.items():
            self.token_bytes[i] = bytes(alphabet[c] for c in text)
        self.byte_id = {b[0]: i for i, b in self.token_bytes.items() if len(b) == 1}
        self.ranks = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[(self.vocab[a], self.vocab[b])] = (rank, self.vocab[a + b])
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for content, i in self.added.items():
            self.token_bytes[i] = content.encode("utf-8")
        self.split_added = (
            regex.compile("(" + "|".join(regex.escape(c) for c in sorted(self.added, key=len, reverse=True)) + ")")
            if self.added
            else None
        )
        self.pattern = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton()
        for i, b in self.token_bytes.items():
            if i not in self.added.values():
                self.automaton.add_word(b.decode("latin-1"), (len(b), i))
        self.automaton.make_automaton()
        self.compatible_pairs: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.split: dict[int, tuple[int, int, int] | None] = {}
        self.spines: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self.pieces = _Pieces(self)

    def merged(self, data: bytes) -> tuple[list[int], tuple[int, int, int] | None]:
        """Plain BPE of a short byte string: merge the pair of lowest rank, leftmost first.

        Also the last merge made, (left, right, rank), or None.
        """
        ids = [self.byte_id[b] for b in data]
        last = None
        while len(ids) > 1:
            best, at = None, -1
            for k in range(len(ids) - 1):
                r = self.ranks.get((ids[k], ids[k + 1]))
                if r is not None and (best is None or r[0] < best[0]):
                    best, at = r, k
            if best is None:
                break
            last = (ids[at], ids[at + 1], best[0])
            ids[at : at + 2] = [best[1]]
        return ids, last

    def starts_piece(self, t: int) -> bool:
        ok = self.whole.get(t)
        if ok is None:
            ids, last = self.merged(self.token_bytes[t])
            ok = self.whole[t] = ids == [t]
            if ok:
                self.split[t] = last
        return ok

    def spine(self, t: int, side: int) -> list[tuple[int, float]]:
        """Tokens from t's first (side 0) or last (side 1) byte up to t, each with the
        rank of the merge that makes its parent on the way (t itself: never)."""
        key = (t, side)
        known = self.spines.get(key)
        if known is not None:
            return known
        chain, made = [], float("inf")
        while True:
            chain.append((t, made))
            if not self.starts_piece(t) or self.split[t] is None:
                break
            left, right, rank = self.split[t]
            t, made = (left if side == 0 else right), rank
        out = self.spines[key] = chain[::-1]
        return out

    def compatible(self, u: int, t: int) -> bool:
        """BPE of u's and t's bytes gives u, t: no merge across the boundary comes first.

        The boundary pair runs up u's right spine and t's left spine; each token stays
        at the boundary until the merge that makes its parent, merges fire in rank order.
        """
        ok = self.compatible_pairs.get((u, t))
        if ok is not None:
            return ok
        if len(self.compatible_pairs) >= PAIRS:
            self.compatible_pairs.clear()
        if not (self.starts_piece(u) and self.starts_piece(t)):
            self.compatible_pairs[(u, t)] = False
            return False
        xs, ys = self.spine(u, 1), self.spine(t, 0)
        i = j = 0
        ok = True
        while ok:
            (x, gone_x), (y, gone_y) = xs[i], ys[j]
            r = self.ranks.get((x, y))
            # equal ranks: the pair further left is merged first
            if r is not None and r[0] < gone_x and r[0] <= gone_y:
                ok = False
            elif i == len(xs) - 1 and j == len(ys) - 1:
                break
            elif gone_x <= gone_y:
                i += 1
            else:
                j += 1
        self.compatible_pairs[(u, t)] = ok
        return ok

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of one piece by the last token of every prefix."""
        data = text.encode("utf-8")
        n = len(data)
        last = [-1] * (n + 1)
        size = [0] * (n + 1)
        pairs, whole = self.compatible_pairs.get, self.whole.get
        # matches come by end position, the longest first at each end
        for end, (length, t) in self.automaton.iter(data.decode("latin-1")):
            i = end + 1
            if last[i] >= 0:
                continue
            start = i - length
            if start == 0:
                ok = whole(t)
                if ok is None:
                    ok = self.starts_piece(t)
            else:
                u = last[start]
                ok = pairs((u, t))
                if ok is None:
                    ok = self.compatible(u, t)
            if ok:
                last[i] = t
                size[i] = length
        if min(last[1:], default=0) < 0:  # not met with a vocabulary closed under its merges
            raise ValueError(f"no token ends a prefix of {data!r}")
        out = []
        i = n
        while i > 0:
            out.append(last[i])
            i -= size[i]
        return tuple(reversed(out))

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        ids: list[int] = []
        ids_of = self.pieces.__getitem__
        parts = self.split_added.split(text) if self.split_added else [text]
        for k, part in enumerate(parts):
            if k % 2 == 1:
                ids.append(self.added[part])
            else:
                ids.extend(chain.from_iterable(map(ids_of, self.pattern.findall(part))))
        return ids

    def decode(self, ids) -> str:
        if ids is None:
            return ""
        return b"".join(map(self.token_bytes.__getitem__, map(int, ids))).decode("utf-8", errors="replace")


@lru_cache(maxsize=4)
def model(path: str, pattern: str) -> PrefixBPE:
    return PrefixBPE(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """docs with `ids` (array<int>), the encoding of each whole text."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids_of(texts: pd.Series) -> pd.Series:
        m = model(path, pattern)
        return pd.Series([np.asarray(m.encode(t), dtype=np.int32) for t in texts])

    keep = [c for c in docs.columns if c != "ids"]
    return docs.select(*keep, ids_of(F.col(text)).alias("ids"))


def decode(coded: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """coded with `decoded`, the text of the ids."""

    @F.pandas_udf(T.StringType())
    def text_of(rows: pd.Series) -> pd.Series:
        m = model(path, pattern)
        return pd.Series([m.decode(r) for r in rows])

    keep = [c for c in coded.columns if c != "decoded"]
    return coded.select(*keep, text_of(F.col(ids)).alias("decoded"))


DIGESTS = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text") -> Column:
    """Per row: number of ids, sha256 of the ids as little-endian uint32, sha256 of the
    UTF-8 of their decoding. A column of `docs`; ids never leave the Python worker."""
    import hashlib

    @F.pandas_udf(DIGESTS)
    def digest(texts: pd.Series) -> pd.DataFrame:
        m = model(path, pattern)
        out = []
        for t in texts:
            ids = m.encode(t)
            packed = np.asarray(ids, dtype="<u4").tobytes()
            decoded = m.decode(ids).encode("utf-8")
            out.append((len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        return pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest(F.col(text))


def le_u32_hex(ids: Column) -> Column:
    """Hex of the ids as little-endian unsigned 32-bit integers, one string."""
    def one(i):
        h = F.lpad(F.hex(i.cast("long")), 8, "0")
        return F.concat(F.substring(h, 7, 2), F.substring(h, 5, 2), F.substring(h, 3, 2), F.substring(h, 1, 2))

    return F.array_join(F.transform(ids, one), "")
