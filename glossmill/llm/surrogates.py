"""Personal data and secrets replaced by surrogates.

Every entity found gets a surrogate from a keyed hash of its type and canonical
form, so all its mentions in all documents get the same one, and without the key
it cannot be undone. Surrogates keep the type and the format of each mention:
lengths and classes of characters, separators, check digits, script and gender of
names. Entities whose surrogates coincide, or would be another entity that really
occurs, are drawn again until all are distinct; only those few are remembered, the
rest is computed where it is needed.

Not detected: names that no title announces in the same text, their mentions in
lower case, as initials or inside longer words, names with an apostrophe, and phones in groups of two or four
without +, brackets or a leading 0.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.common import digest_key, stored

PHONE_DIGITS = 7
WIDEN = 8  # attempts after which a surrogate gets more signs than its entity
FEW = 200_000  # redrawn entities that are given to every task; more are joined

# Titles that tell gender, and letters by script and gender of a
# name's last syllable.
_TITLES = {
    "m": "Mr Herr Herrn Monsieur M Señor Sr Don г-н господин κ κος Κος κύριος Κύριος".split(),
    "f": "Mrs Ms Miss Frau Madame Mme Mlle Señora Sra Doña г-жа госпожа κα Κα κυρία Κυρία".split(),
    "n": "Dr Prof Mx".split(),
}
_SYLLABLES = {
    "latin": ("bcdfglmnprstv", "aeiou", {"m": "n", "f": "a", "n": "e"}),
    "cyrillic": ("бвгдклмнпрст", "аеиоу", {"m": "н", "f": "а", "n": "о"}),
    "greek": ("βγδκλμνπρστ", "αειου", {"m": "ς", "f": "α", "n": "ο"}),
}
_GENDER = {title: gender for gender, titles in _TITLES.items() for title in titles}

_NAMES = "|".join(sorted((re.escape(t) for t in _GENDER), key=len, reverse=True))
_NAME = r"[^\W\d_a-zà-þа-яёΐά-ώ][^\W\d_]+"
# A number is a phone's if a country or area code shows: +, brackets, a leading 0,
# or groups as numbers are written in; dates, years and table cells are none.
_DATE = (
    r"(?:(?:1[5-9]|20|21)\d\d[ .-][01]?\d[ .-][0-3]?\d(?!\d)"
    r"|[0-3]?\d[ .-][0-3]?\d[ .-](?:1[5-9]|20|21)\d\d(?!\d)"
    r"|\(?(?:1[5-9]|20|21)\d\d\)?[ .-](?:1[5-9]|20|21)\d\d(?!\d))"
)
_GROUPS = r"\d{1,4}(?:[ .-]?\d{2,4}){1,4}"
_PHONES = (
    r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?" + _GROUPS,
    r"\((?!(?:19|20)\d\d\))\d{2,4}\)[ .-]?" + _GROUPS,
    r"0\d(?P<s1>[ .-])\d\d(?:(?P=s1)\d\d){3}",
    r"0\d{1,4}[ .-](?=\d{0,8}[ .-]?\d{3})\d{2,8}(?:[ .-]\d{2,4}){0,3}",
    r"(?<!\d[.-])(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?![.-]?\d)",
    r"(?<!\d[.-])[6-9]\d{2}(?P<s2>[ .-])\d{3}(?P=s2)\d{3}(?![ .-]?\d)",
    r"(?<!\d[.-])\d{2,3}[ .-]\d{3}(?P<s3>[ .-])\d\d(?P=s3)\d\d(?![.-]?\d)",
    r"(?<!\d[.-])\d{3}-\d{4}(?![.-]?\d)",
)

_ENTITY = re.compile(
    r"(?P<email>(?<![\w.+-])[\w+-]++(?:\.[\w+-]++)*+@[^\W_](?:[\w-]*+)(?:\.[^\W_][\w-]*+)+)"
    r"|(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-]))"
    r"|(?P<phone>(?<![\w.+])(?!" + _DATE + r")(?:" + "|".join(_PHONES) + r")(?!\w))"
    r"|(?P<intl>(?<![\w.+])\+\d{8,15}(?!\w))"
    r"|(?P<hex>(?<!\w)(?=[0-9A-Fa-f]*?\d)[0-9A-Fa-f]{32,}+(?!\w))"
    r"|(?P<key>(?i:(?<=key)|(?<=token)|(?<=secret)|(?<=password)|(?<=passwd))\s{0,3}[=:]\s{0,3}[\"']?[\w./+=-]{12,}+)"
    r"|(?P<aws>(?<!\w)(?:AKIA|ASIA|ghp_|gho_|sk-|xox[abp]-)[\w-]{12,}+)"
    r"|(?P<name>(?<!\w)(?:" + _NAMES + r")\.? " + _NAME + r"(?:[ -]" + _NAME + r"){0,2})"
)
_LETTERS = re.compile(r"(?<!\w)[^\W\d_]{2,}+(?!\w)")
#: Without one of these a text holds none of the above.
_HINT = re.compile(
    r"[\d@]|(?<!\w)(?:" + _NAMES + r")\.? \w"
    r"|(?i:key|token|secret|password|passwd)\s{0,3}[=:]|AKIA|ASIA|ghp_|gho_|sk-|xox[abp]-"
)
_KEYED = re.compile(r"\A(\s*[=:]\s*[\"']?)(.*)\Z", re.S)


def _parts(kind: str, mention: str) -> list[tuple[str, str, int, int]]:
    """(type, canonical form, start, end within the mention) of its entities."""
    if kind == "key":
        lead = _KEYED.match(mention)[1]
        kind, start = "secret", len(lead)
        if not re.search(r"[^\W_]", mention[start:]):
            return []  # a drawn line hides nothing, and has no other surrogate
        return [(kind, mention[start:], start, len(mention))]
    if kind in ("hex", "aws"):
        return [("secret", mention, 0, len(mention))]
    if kind == "email":
        return [("email", mention.lower(), 0, len(mention))]
    if kind == "name":
        title, _, rest = mention.partition(" ")
        gender = _GENDER.get(title.rstrip("."), "n")
        out, at = [], len(title) + 1
        words = re.split(r"([ -])", rest)
        # The family name is one entity whatever the title; first names have a gender.
        for i, word in enumerate(words):
            if i % 2 == 0:
                role = "family" if i == len(words) - 1 else gender
                out.append((f"name-{role}", word.casefold(), at, at + len(word)))
            at += len(word)
        return out
    if kind in ("intl", "phone"):
        digits = re.sub(r"\D", "", mention)
        return [("phone", digits, 0, len(mention))] if len(digits) >= PHONE_DIGITS else []
    if kind in ("card", "iban"):
        return [(kind, re.sub(r"[ -]", "", mention), 0, len(mention))]
    return [(kind, mention, 0, len(mention))]


class _Draw:
    """Numbers from a keyed hash."""

    def __init__(self, key: bytes, kind: str, canonical: str, attempt: int):
        self.seed = hmac.new(key, f"{kind}\0{canonical}\0{attempt}".encode(), hashlib.sha256)
        self.count, self.pool = 0, 0
        self.left = 0

    def below(self, n: int) -> int:
        if self.left < 24:
            block = self.seed.copy()
            block.update(self.count.to_bytes(8, "big"))
            self.pool, self.left = int.from_bytes(block.digest(), "big"), 256
            self.count += 1
        self.pool, value = divmod(self.pool, 1 << 24)
        self.left -= 24
        return value * n >> 24


def _same_class(c: str, draw: _Draw) -> str:
    if c.isdigit():
        return str(draw.below(10))
    if c.isalpha():
        letter = chr(97 + draw.below(26))
        return letter.upper() if c.isupper() else letter
    return c


def _luhn(digits: list[int]) -> int:
    doubled = [d if i % 2 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
    return -sum(doubled) % 10


def surrogate(key: bytes, kind: str, canonical: str, attempt: int) -> str:
    """The canonical form of the entity that stands for this one.

    Where so many attempts failed that no surrogate of this format may be left, it
    gets one sign more with each further attempt, so one is always found.
    """
    draw = _Draw(key, kind, canonical, attempt)
    new = _same_format(draw, kind, canonical, attempt)
    if attempt < WIDEN or kind == "ip" or kind.startswith("name-"):
        return new
    more = range(attempt - WIDEN + 1)
    if kind == "email":
        return "".join(chr(97 + draw.below(26)) for _ in more) + new
    return new + "".join(str(draw.below(10)) for _ in more)


def _same_format(draw: _Draw, kind: str, canonical: str, attempt: int) -> str:
    if kind == "email":
        local, _, domain = canonical.rpartition("@")
        local = "".join(_same_class(c, draw) for c in local)
        host = "".join(_same_class(c, draw) for c in domain.split(".")[0])
        return f"{local}@{host}.example.{('com', 'net', 'org')[draw.below(3)]}"
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "card":
        digits = [int(c) for c in canonical]
        new = digits[:1] + [draw.below(10) for _ in digits[1:]]
        if _luhn(digits[:-1]) == digits[-1]:
            new[-1] = _luhn(new[:-1])
        return "".join(map(str, new))
    if kind == "iban":
        return canonical[:2] + "".join(_same_class(c, draw) for c in canonical[2:])
    if kind == "phone":
        # The leading digit (of a country or trunk code) stays while that leaves a choice.
        first = canonical[0] if attempt < WIDEN // 2 else str(1 + draw.below(9))
        return first + "".join(str(draw.below(10)) for _ in canonical[1:])
    if kind == "secret" and re.fullmatch("[0-9A-Fa-f]+", canonical):
        signs = "0123456789ABCDEF" if canonical.isupper() else "0123456789abcdef"
        return "".join(signs[draw.below(16)] for _ in canonical)
    if kind.startswith("name-"):
        script = "latin"
        if re.search("[а-яё]", canonical):
            script = "cyrillic"
        elif re.search("[α-ω]", canonical):
            script = "greek"
        first, second, ends = _SYLLABLES[script]
        gender = kind[5:] if kind[5:] in ends else "n"
        n = max(2, min(5, (len(canonical) + 1) // 2)) + min(attempt, 8) // 2
        made = "".join(first[draw.below(len(first))] + second[draw.below(len(second))] for _ in range(n))
        return made[:-1] + ends[gender] if gender == "f" else made + ends[gender]
    return "".join(_same_class(c, draw) for c in canonical)


def _shown(kind: str, mention: str, new: str) -> str:
    """The surrogate in the format of the mention."""
    if kind in ("phone", "card", "iban"):
        signs = iter(new)
        return "".join(next(signs) if c.isalnum() else c for c in mention) + "".join(signs)
    if kind == "email" or kind.startswith("name-"):
        if mention.isupper():
            return new.upper()
        if mention[:1].isupper():
            return new[:1].upper() + new[1:]
    return new


def found(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(type, canonical form, start, end) of the entities of a text, in order.

    Names are told by a title; words equal to a part of a titled name are its
    mentions too, wherever they stand in the same text with a capital.
    """
    if not _HINT.search(text):
        return
    titled = [
        (kind, canonical, match.start() + start, match.start() + end)
        for match in _ENTITY.finditer(text)
        for kind, canonical, start, end in _parts(match.lastgroup, match[0])
        if canonical
    ]
    parts: dict[str, str] = {}
    for kind, canonical, _, _ in titled:
        if kind.startswith("name-"):
            parts.setdefault(canonical, kind)
    yield from _with_untitled(text, titled, parts) if parts else titled


def _with_untitled(text: str, titled: list, parts: dict[str, str]) -> list:
    """The entities and, between them, the capitalised words that are name parts.

    A part that the text has in lower case more often than with a capital is a
    common word ("Mr Smith The") and is left alone.
    """
    capital, small = [], Counter()
    for match in _LETTERS.finditer(text):
        word = match[0].casefold()
        if word in parts:
            if match[0][0].islower():
                small[word] += 1
            else:
                capital.append((word, match.start(), match.end()))
    seen = Counter(word for word, _, _ in capital)
    out, at = [], 0
    for word, lo, hi in capital:
        while at < len(titled) and titled[at][3] <= lo:
            out.append(titled[at])
            at += 1
        inside = at < len(titled) and titled[at][2] < hi
        if not inside and small[word] <= seen[word]:
            out.append((parts[word], word, lo, hi))
    return out + titled[at:]


def _entity_task(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()

        def handed():
            rows = sorted(seen)
            seen.clear()
            return pa.record_batch(
                {
                    "kind": pa.array([k for k, _ in rows], pa.string()),
                    "entity": pa.array([c for _, c in rows], pa.string()),
                }
            )

        for batch in batches:
            for text in batch.column("__text"):
                seen.update((k, c) for k, c, _, _ in found(text.as_py() or ""))
                if len(seen) > 100_000:
                    yield handed()
        yield handed()

    return run


def _draw_task(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            drawn = [surrogate(key, r["kind"], r["entity"], r["attempt"]) for r in rows]
            yield batch.append_column("surrogate", pa.array(drawn, pa.string()))

    return run


def distinct_surrogates(docs: DataFrame, key: bytes) -> DataFrame:
    """`kind, entity, attempt, surrogate` of all entities of `__text`.

    Within a type no two entities share a surrogate, and no surrogate is an entity
    that occurs.
    """
    slim = docs.select("__text")
    real = stored(
        slim.mapInArrow(_entity_task(key), "kind string, entity string").distinct(), "entities"
    )
    schema = "kind string, entity string, attempt long, surrogate string"
    taken = real.withColumn("attempt", F.lit(0).cast("long")).mapInArrow(_draw_task(key), schema)
    while True:
        taken = stored(taken, "surrogates")
        # The smallest entity keeps a surrogate that several drew, unless it is real.
        least = taken.groupBy("kind", "surrogate").agg(
            F.min(F.struct("attempt", "entity")).alias("first"), F.count("*").alias("n")
        )
        occurs = real.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("real"))
        bad = (
            least.join(occurs, ["kind", "surrogate"], "left")
            .filter("n > 1 OR real")
            .select("kind", "surrogate", F.when(F.col("real").isNull(), F.col("first.entity")).alias("keeps"))
        )
        again = taken.join(bad, ["kind", "surrogate"]).filter("keeps IS NULL OR keeps <> entity")
        again = stored(again.select("kind", "entity", "attempt"), "again")
        if not again.take(1):
            return taken
        redrawn = again.withColumn("attempt", F.col("attempt") + 1).mapInArrow(
            _draw_task(key), schema
        )
        taken = taken.join(again, ["kind", "entity"], "left_anti").unionByName(redrawn)


def _replace_task(key: bytes, attempts):
    """Replace; attempts per entity from the broadcast, or from the row's `__again`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = attempts.value if attempts is not None else {}
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                again = part.column("__again").to_pylist() if attempts is None else None
                texts, counts = [], []
                for i, text in enumerate(part.column("__text")):
                    text = text.as_py()
                    if again is not None:
                        known = {(a["kind"], a["entity"]): a["attempt"] for a in again[i] or ()}
                    out, at, n = [], 0, 0
                    for kind, entity, lo, hi in found(text or ""):
                        new = surrogate(key, kind, entity, known.get((kind, entity), 0))
                        out += [text[at:lo], _shown(kind, text[lo:hi], new)]
                        at, n = hi, n + 1
                    texts.append(text if not n else "".join(out) + text[at:])
                    counts.append(n)
                names = [c for c in part.schema.names if c not in ("__text", "__again")]
                yield pa.record_batch(
                    {c: part.column(c) for c in names}
                    | {"__new": pa.array(texts, pa.string()), "__n": pa.array(counts, pa.int64())}
                )

    return run


def _mention_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            rows = [
                {"__r0": a, "__r1": b, "kind": k, "entity": c}
                for a, b, text in zip(
                    *(batch.column(n).slice(start, 500).to_pylist() for n in ("__r0", "__r1", "__text"))
                )
                for k, c in {(k, c) for k, c, _, _ in found(text or "")}
            ]
            if rows:
                yield pa.RecordBatch.from_pylist(rows)


def replaced(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """`docs` with entities of the text replaced, and `n_replaced` (long).

    NULL and empty texts stay as they are with 0 replaced; so does every text
    without an entity. Equal entities get equal surrogates in all rows, repeated
    rows included; an empty table gives an empty one.
    """
    columns = docs.columns
    rest = [F.col(c).alias(f"__c{i}") for i, c in enumerate(columns) if c != text]
    slim = docs.select(F.col(text).alias("__text"), *rest)
    assigned = distinct_surrogates(slim, key)
    again = assigned.filter("attempt > 0").select("kind", "entity", "attempt")
    context = docs.sparkSession.sparkContext
    kept = [f"__c{i}" for i, c in enumerate(columns) if c != text]
    kinds = dict(slim.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in kept), "__new string", "__n long"])
    if again.count() <= FEW:
        few = {(r["kind"], r["entity"]): r["attempt"] for r in again.collect()}
        out = slim.mapInArrow(_replace_task(key, context.broadcast(few)), schema)
    else:
        # Too many to hand out: each document gets its own, joined by its content.
        keyed = slim.select("*", *[c.alias(f"__r{i}") for i, c in enumerate(digest_key(F.col("__text")))])
        mentions = keyed.select("__r0", "__r1", "__text").distinct().mapInArrow(
            _mention_task, "__r0 long, __r1 long, kind string, entity string"
        )
        lists = (
            mentions.join(again, ["kind", "entity"])
            .groupBy("__r0", "__r1")
            .agg(F.collect_set(F.struct("kind", "entity", "attempt")).alias("__again"))
        )
        joined = keyed.join(lists, ["__r0", "__r1"], "left").drop("__r0", "__r1")
        out = joined.mapInArrow(_replace_task(key, None), schema)
    return out.select(
        *[F.col("__new" if c == text else f"__c{i}").alias(c) for i, c in enumerate(columns)],
        F.col("__n").alias("n_replaced"),
    )
