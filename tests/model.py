"""Small procedural model of the text rules, for comparison on random strings."""

import re

PROTECTED = re.compile(r"-+>|\([+-]+\)|[+-]+/[+-]+")


def tokens(line):
    kept = set()
    for m in PROTECTED.finditer(line):
        kept.update(range(*m.span()))
    out, run = [], ""
    for i, ch in enumerate(line):
        separator = ch in " \t\n\x0b\f\r" or (ch in "/-" and i not in kept)
        if not separator:
            run += ch
        elif run:
            out.append(run)
            run = ""
    return out + [run] if run else out


def _outer(s):
    inside = s[1:-1]
    framed = len(s) > 1 and s[0] == "(" and s[-1] == ")"
    return inside if framed and not re.search(r"[()]", inside) else s


def _opener(s, marks):
    for mark, partner in marks:
        if s.startswith(mark) and partner not in s[1:]:
            return s[1:]
    return s


def _closer(s, marks):
    for mark, partner in marks:
        if s.endswith(mark) and partner not in s[:-1]:
            return s[:-1]
    return s


def _quotes(s):
    same = len(s) > 1 and s[0] == s[-1] and s[0] in "\"'"
    return s[1:-1] if same else s


QUOTES = [('"', '"'), ("'", "'")]
OPENERS = [("(", ")")] + QUOTES
CLOSERS = [(")", "(")] + QUOTES


def gram(s):
    s = re.sub(r"[;:,]\Z", "", s)
    return _quotes(_closer(_opener(_outer(s), OPENERS), CLOSERS))


def valid_gram(s):
    return bool(re.search("[A-Za-z_]", s)) and not s.startswith(" ")


def word(s, pair=False):
    s = re.sub(r"[;:,.]\Z", "", s)
    s = _opener(_outer(s), OPENERS[:1] if pair else OPENERS)
    s = _closer(s, CLOSERS[:1] if pair else CLOSERS)
    s = _opener(_quotes(s), QUOTES)
    return _closer(s, QUOTES)


def valid_word(s):
    lone = any(s.startswith(m) and m not in s[1:] for m in ".*")
    return len(s) > 1 and not lone


def words(line, pair=False):
    found = [word(t, pair) for t in tokens(line) if re.search("[A-Za-z_]", t)]
    return [w for w in found if valid_word(w)]


def grams(line, n):
    t = tokens(line)
    found = [gram(" ".join(t[i : i + n])) for i in range(len(t) - n + 1)]
    return [g for g in found if valid_gram(g)]
