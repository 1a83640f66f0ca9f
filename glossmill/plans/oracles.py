"""The queries again as plain SQL, written from the rules and not from the operators.

Each text rule is applied literally, in order and to every term: no guard, no
pre-aggregation, no block and no pruning other than in the pair queries.
"""

from __future__ import annotations

from glossmill.plans.corpus import STOP_WORDS

TOKEN = r"(?:-+>|\([+-]+\)|[+-]+/[+-]+|[^\s\x0B/-])+"
STOPS = "(" + ", ".join(f"'{w}'" for w in STOP_WORDS) + ")"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _replace(expr: str, *rules: tuple[str, str]) -> str:
    for pattern, new in rules:
        expr = f"regexp_replace({expr}, {_q(pattern)}, {_q(new)}, 'g')"
    return expr


PARENS = (r"\A\(([^()]*)\)\z", r"\1")
OPENER = (r"""\A(?:\(([^)]*)|"([^"]*)|'([^']*))\z""", r"\1\2\3")
CLOSER = (r"""\A(?:([^(]*)\)|([^"]*)"|([^']*)')\z""", r"\1\2\3")
QUOTES = (r"""(?s)\A(?:"(.*)"|'(.*)')\z""", r"\1\2")
PAREN_OPEN = (r"\A\(([^)]*)\z", r"\1")
PAREN_CLOSE = (r"\A([^(]*)\)\z", r"\1")
QUOTE_OPEN = (r"""\A(?:"([^"]*)|'([^']*))\z""", r"\1\2")
QUOTE_LAST = (r"""\A(?:([^"]*)"|([^']*)')\z""", r"\1\2")
GRAM = (PARENS, OPENER, CLOSER, QUOTES)


def clean_gram(expr: str) -> str:
    return _replace(expr, (r"[;:,]\z", ""), *GRAM)


def clean_word(expr: str, pair: bool = False) -> str:
    first = (PARENS, PAREN_OPEN, PAREN_CLOSE) if pair else (PARENS, OPENER, CLOSER)
    return _replace(expr, (r"[;:,.]\z", ""), *first, QUOTES, QUOTE_OPEN, QUOTE_LAST)


DOCS = """
SELECT doc_id, text AS body, [source, lang] AS headings,
       CAST(1990 + doc_id % 25 AS INTEGER) AS year, true AS cut
FROM documents"""
PAGES = "SELECT page_id AS doc_id, html AS body, false AS cut FROM pages"
CHAT = """
SELECT row_number() OVER () AS doc_id, text AS body, [role] AS headings, false AS cut
FROM conversations"""


def lines(source: str = DOCS, lower: bool = False, more: str = "") -> str:
    """CTEs `rec` (one row per record) and `line` (one row per line)."""
    folded = "lower(line)" if lower else "line"
    stripped = _replace(
        folded,
        (r"\(ABSTRACT TRUNCATED AT \d+ WORDS\)", ""),
        (r'<s n="\d+">', ""),
        (r"[.?]?</s>", ""),
    )
    cut = _replace("line", (r"[.?]\z", ""))
    return f"""
WITH src AS ({source}),
rec AS (SELECT *, row_number() OVER () AS rid FROM src),
raw AS (SELECT * EXCLUDE (body), unnest(string_split(body, chr(10))) AS line FROM rec),
trimmed AS (SELECT * REPLACE (CASE WHEN cut THEN {cut} ELSE line END AS line) FROM raw),
line AS (SELECT * REPLACE ({stripped} AS line) FROM trimmed),
tok AS (SELECT * EXCLUDE (line),
               regexp_extract_all(line, {_q(TOKEN)}) AS t FROM line){more}"""


def grams(n: int, source: str = DOCS, lower: bool = False) -> str:
    """CTE `gram`: every valid cleaned gram, one row each."""
    window = f"array_to_string(t[i:i+{n - 1}], ' ')"
    more = f""",
g0 AS (SELECT * EXCLUDE (t), unnest(list_transform(
         range(1, greatest(len(t) - {n} + 2, 1)), lambda i: {window})) AS gram FROM tok),
g1 AS (SELECT * REPLACE ({clean_gram("gram")} AS gram) FROM g0),
gram AS (SELECT * FROM g1 WHERE regexp_matches(gram, '[A-Za-z_]')
                            AND NOT regexp_matches(gram, '\\A\\s'))"""
    return lines(source, lower, more)


def count(what: str, keys: str, min_freq: int = 10) -> str:
    return f"""
SELECT {keys}, CAST(count(*) AS BIGINT) AS freq FROM {what}
GROUP BY {keys} HAVING count(*) >= {min_freq}"""


def words(source: str = DOCS, lower: bool = False, pair: bool = False) -> str:
    """CTE `word`: every valid token, `s` as found and `word` cleaned."""
    more = f""",
w0 AS (SELECT * EXCLUDE (t), unnest(t) AS s FROM tok),
w1 AS (SELECT *, {clean_word("s", pair)} AS word FROM w0
       WHERE regexp_matches({_replace("s", (r"[;:,.]\z", ""))}, '[A-Za-z_]')),
word AS (SELECT * FROM w1 WHERE length(word) > 1
         AND NOT regexp_matches(word, '\\A(?:\\.[^.]*|\\*[^*]*)\\z'))"""
    return lines(source, lower, more)


def pairs(unit: str, source: str = DOCS, stop: bool = False, min_freq: int = 10) -> str:
    """A word in fewer than `min_freq` units is in no pair that reaches it."""
    listed = f"WHERE word NOT IN {STOPS}" if stop else ""
    base = words(source, pair=True)
    if unit == "line":
        base = base.replace(
            "line AS (SELECT * REPLACE", "numbered AS (SELECT *, row_number() OVER () "
            "AS lid FROM trimmed),\nline AS (SELECT * REPLACE", 1
        ).replace("FROM trimmed),\ntok", "FROM numbered),\ntok", 1)
    key = "lid" if unit == "line" else "rid"
    return f"""{base},
u AS (SELECT DISTINCT {key} AS unit, word FROM word {listed}),
often AS (SELECT word, row_number() OVER (ORDER BY word) AS w
          FROM u GROUP BY word HAVING count(*) >= {min_freq}),
k AS (SELECT unit, w FROM u JOIN often USING (word)),
p AS (SELECT a.w AS h, b.w AS l, CAST(count(*) AS BIGINT) AS freq
      FROM k a JOIN k b ON a.unit = b.unit AND a.w > b.w
      GROUP BY a.w, b.w HAVING count(*) >= {min_freq})
SELECT x.word AS hi, y.word AS lo, freq
FROM p JOIN often x ON x.w = p.h JOIN often y ON y.w = p.l"""


def _chunk_rows(stop: bool = False) -> str:
    """CTE `kept`: every chunk that counts, framed."""
    framed = (
        r"CASE WHEN regexp_matches(c, '\A\[[A-Z]+ ') THEN c ELSE '[NP ' || c || ' ]' END"
    )
    inner = "trim(f[1:length(f) - 2])"
    text = _replace(inner, (r"\A\[[A-Z]+ \W*", ""))
    bad = r"\A(?:\s*|[\W\d]*|[Pp]\s?[=<](?:[\d\s.]+)?|[Ii]+)\z"
    listed = f"AND s NOT IN {STOPS}" if stop else ""
    return f"""
WITH parts AS (
  SELECT doc_id, 1990 + doc_id % 25 AS year, string_split(
    regexp_replace(text, ', ?', chr(10) || ',' || chr(10), 'g'), chr(10)) AS p
  FROM documents),
piece AS (SELECT doc_id, year, unnest(range(1, len(p) + 1)) AS n, trim(unnest(p)) AS c
          FROM parts),
open AS (SELECT *, {framed} AS f0 FROM piece
         WHERE c <> '' AND c NOT LIKE ']%' AND c NOT LIKE '[EOS]%'),
closed AS (SELECT *, CASE WHEN f0 LIKE '% ]' THEN f0 ELSE f0 || ' ]' END AS f1 FROM open),
framed AS (SELECT *, {_replace("f1", (r" *[;:,.]+ ]\z", " ]"))} AS f FROM closed),
inner_text AS (SELECT *, {text} AS s FROM framed),
kept AS (SELECT doc_id, n, CAST(year AS VARCHAR) AS year, f FROM inner_text
         WHERE length(f) > 7 AND length(s) > 1 {listed}
         AND NOT regexp_matches({inner}, '\\A\\[\\w+ [)>,.]')
         AND NOT regexp_matches(s, {_q(bad)}))"""


def _normal_chunk(expr: str) -> str:
    return _replace(
        expr,
        (r"\A\[NP (?:[Aa]n?|[Tt]he) ", "[NP "),
        (r"\A(\[[^()]+?)\s*\) \]\z", r"\1 ]"),
    )


def chunk_counts(by: str, min_freq: int, lower: bool = False) -> str:
    folded = "lower(f)" if lower else "f"
    key = "CAST(doc_id AS VARCHAR) AS doc_id" if by == "doc_id" else "year"
    return f"""{_chunk_rows()},
term AS (SELECT {key}, {_normal_chunk(folded)} AS term FROM kept)
{count("term", f"{by}, term", min_freq)}"""


def trend(yearly: str) -> str:
    """Windows from every start year, straight from the definition."""
    return f"""
WITH y AS (SELECT term, CAST(year AS INTEGER) AS year, CAST(sum(freq) AS BIGINT) AS freq
           FROM ({yearly}) GROUP BY ALL),
span AS (SELECT term, min(year) AS a, max(year) AS z FROM y GROUP BY term),
starts AS (SELECT term, z, CAST(unnest(range(a, z - 3)) AS INTEGER) AS start_year
           FROM span WHERE z - a >= 4)
SELECT s.term, s.start_year, CAST(least(start_year + 9, z) AS INTEGER) AS end_year,
       CAST(coalesce(sum(y.freq), 0) AS BIGINT) AS freq
FROM starts s LEFT JOIN y
  ON y.term = s.term AND y.year BETWEEN start_year AND start_year + 9
GROUP BY s.term, s.start_year, z"""


SHORT_YEARLY = """
SELECT o_orderpriority AS term, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(count(*) AS BIGINT) AS freq FROM orders GROUP BY ALL"""


def tagged(n: int, lower: bool = False, layout: str = "split") -> str:
    form = "lower(t[{0}])" if lower else "t[{0}]"
    first, last = form.format("i"), form.format(f"i+{n - 1}")

    def tag(at):
        return (
            f"CASE WHEN regexp_matches(t[{at}], '\\A[A-Z]') THEN 'NNP' "
            f"WHEN regexp_matches(t[{at}], '[0-9]') THEN 'CD' ELSE 'NN' END"
        )

    inner = f"array_to_string(t[i+1:i+{n - 2}], ' ')" if n > 2 else "''"
    gram = f"array_to_string(t[i:i+{n - 1}], ' ')"
    if lower:
        inner, gram = f"lower({inner})", f"lower({gram})"
    keys = "first, middle, last, pos_first, pos_last"
    if layout == "whole":
        keys = "gram, pos_first, last"
    stable = _replace("gram", *GRAM)
    return f"""{lines()},
spot AS (SELECT t, unnest(range(1, len(t) - {n} + 2)) AS i FROM tok WHERE len(t) >= {n}),
g AS (SELECT {first} AS first, {inner} AS middle, {last} AS last,
             {tag("i")} AS pos_first, {tag(f"i+{n - 1}")} AS pos_last, {gram} AS gram
      FROM spot),
ok AS (SELECT * FROM g
       WHERE trim({stable}) = gram AND regexp_matches(gram, '[A-Za-z_]')
       AND NOT regexp_matches(gram, '\\A\\s') AND first <> '''''' AND last <> ''''''
       AND NOT regexp_matches(first, '\\A[\\s!#$%&*+).\\d-]*\\z')
       AND NOT regexp_matches(last, '\\A[\\s!#$%&*+(.\\d-]*\\z'))
{count("ok", keys)}"""


def _sweep() -> str:
    window = "array_to_string(t[i:i+n-1], ' ')"
    more = f""",
size AS (SELECT *, unnest(range(2, 11)) AS n FROM tok),
g0 AS (SELECT n, unnest(list_transform(
         range(1, greatest(len(t) - n + 2, 1)), lambda i: {window})) AS gram FROM size),
g1 AS (SELECT n, {clean_gram("gram")} AS gram FROM g0),
gram AS (SELECT CAST(n AS INTEGER) AS n, gram FROM g1
         WHERE regexp_matches(gram, '[A-Za-z_]') AND NOT regexp_matches(gram, '\\A\\s'))"""
    return lines(more=more) + count("gram", "n, gram")


def _skip() -> str:
    """User patterns see the whole body, so they come before the line split."""
    body = _replace(
        "array_to_string(list_transform(string_split(text, chr(10)), "
        r"lambda x: regexp_replace(x, '[.?]\z', '')), chr(10))",
        (r"\d+", ""),
        (r",?\n[A-E]", ""),
    )
    return (
        grams(2, f"SELECT doc_id, {body} AS body, false AS cut FROM documents")
        + count("gram", "gram")
    )


# Suffix stripping with the measure of a stem as a pattern.
_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_START = f"\\A(?:{_C}{_V}|[aeiou]+)"  # a leading y is a consonant
M0 = f"{_START}{_C}"
M1 = f"{_START}{_C}(?:{_V})?\\z"
M2 = f"{_START}{_C}{_V}{_C}"
HAS_VOWEL = _START
CVC = f"\\A{_C}[aeiouy][^aeiouwxy]\\z"


def _strip(w: str, suffix: str) -> str:
    return f"{w}[1:length({w}) - {len(suffix)}]"


def _table(rows, test: str, extra=()) -> str:
    """The longest suffix found decides; its row applies if the stem passes."""
    out = []
    for suffix, new in sorted(rows, key=lambda r: -len(r[0])):
        stem = _strip("w", suffix)
        passes = f"regexp_matches({stem}, '{test}')"
        if suffix in extra:
            passes += f" AND regexp_matches({stem}, '[st]\\z')"
        out.append(
            f"WHEN ends_with(w, '{suffix}') THEN "
            f"CASE WHEN {passes} THEN {stem} || '{new}' ELSE w END"
        )
    return "CASE " + "\n ".join(out) + " ELSE w END"


def stems(tokens: str) -> str:
    """CTE `stemmed(token, stem)` of the distinct tokens of a CTE `tokens`."""
    ing, ed = _strip("w", "ing"), _strip("w", "ed")
    step2 = {
        "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance",
        "izer": "ize", "abli": "able", "alli": "al", "entli": "ent", "eli": "e",
        "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate",
        "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous",
        "aliti": "al", "iviti": "ive", "biliti": "ble",
    }
    step3 = {
        "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic",
        "ful": "", "ness": "",
    }
    step4 = (
        "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous "
        "ive ize"
    ).split()
    e, last = _strip("w", "e"), "w[length(w)]"
    double = (
        f"length(w) > 1 AND {last} = w[length(w) - 1] "
        f"AND NOT regexp_matches({last}, '[aeioulsz]') "
        f"AND NOT ({last} = 'y' AND regexp_matches(w, '[^aeiouy]yy\\z'))"
    )
    return f""",
s0 AS (SELECT DISTINCT token, token AS w FROM {tokens} WHERE length(token) > 2),
s1 AS (SELECT token, CASE
  WHEN ends_with(w, 'sses') THEN {_strip("w", "es")}
  WHEN ends_with(w, 'ies') THEN {_strip("w", "es")}
  WHEN ends_with(w, 'ss') THEN w
  WHEN ends_with(w, 's') THEN {_strip("w", "s")} ELSE w END AS w FROM s0),
s2 AS (SELECT token, CASE
  WHEN ends_with(w, 'eed') THEN
    CASE WHEN regexp_matches({_strip("w", "eed")}, '{M0}') THEN {_strip("w", "d")}
         ELSE w END
  WHEN ends_with(w, 'ed') AND regexp_matches({ed}, '{HAS_VOWEL}') THEN {ed}
  WHEN ends_with(w, 'ing') AND regexp_matches({ing}, '{HAS_VOWEL}') THEN {ing}
  ELSE w END AS w, w AS before,
  NOT ends_with(w, 'eed') AND (ends_with(w, 'ed') AND regexp_matches({ed}, '{HAS_VOWEL}')
    OR ends_with(w, 'ing') AND regexp_matches({ing}, '{HAS_VOWEL}')) AS cut FROM s1),
s3 AS (SELECT token, CASE WHEN NOT cut THEN w
  WHEN regexp_matches(w, '(?:at|bl|iz)\\z') THEN w || 'e'
  WHEN {double} THEN w[1:length(w) - 1]
  WHEN regexp_matches(w, '{M1}') AND regexp_matches(w, '{CVC}') THEN w || 'e'
  ELSE w END AS w FROM s2),
s4 AS (SELECT token, CASE WHEN ends_with(w, 'y') AND
  regexp_matches({_strip("w", "y")}, '{HAS_VOWEL}') THEN {_strip("w", "y")} || 'i'
  ELSE w END AS w FROM s3),
s5 AS (SELECT token, {_table(step2.items(), M0)} AS w FROM s4),
s6 AS (SELECT token, {_table(step3.items(), M0)} AS w FROM s5),
s7 AS (SELECT token, {_table([(x, "") for x in step4], M2, ("ion",))} AS w FROM s6),
s8 AS (SELECT token, CASE WHEN ends_with(w, 'e') AND (regexp_matches({e}, '{M2}')
  OR regexp_matches({e}, '{M1}') AND NOT regexp_matches({e}, '{CVC}')) THEN {e}
  ELSE w END AS w FROM s7),
s9 AS (SELECT token, CASE WHEN ends_with(w, 'll') AND regexp_matches(w, '{M2}')
  THEN w[1:length(w) - 1] ELSE w END AS stem FROM s8),
stemmed AS (SELECT token, stem FROM s9
            UNION ALL SELECT DISTINCT token, token FROM {tokens}
            WHERE length(token) < 3)"""


def stemmed_lines() -> str:
    """CTE `tok` with the stems of each line, in order, as `t`; CTE `stemmed`."""
    base = lines().replace(_q(TOKEN), _q("[0-9A-Za-z_]+"), 1)
    base = base.replace("tok AS (SELECT * EXCLUDE (line),", "tok0 AS (SELECT *,", 1)
    return (
        base
        + ", numbered AS (SELECT *, row_number() OVER () AS lid FROM tok0)"
        + ", token AS (SELECT rid, lid, unnest(range(0, len(t))) AS n, "
        "unnest(t) AS token FROM numbered)"
        + stems("token")
        + """,
tok AS (SELECT rid, list(stem ORDER BY n) AS t
        FROM token JOIN stemmed USING (token) GROUP BY rid, lid)"""
    )


def _stem_queries() -> dict[str, str]:
    tail = grams(2).split("AS t FROM line)", 1)[1]
    two = stemmed_lines() + tail
    word = stemmed_lines() + words().split("AS t FROM line)", 1)[1]
    return {
        "stem_vocab": stemmed_lines()
        + """
SELECT token, stem, CAST(count(*) AS BIGINT) AS freq
FROM token JOIN stemmed USING (token) GROUP BY token, stem""",
        "ngram2_stemmed": two + count("gram", "gram"),
        "ngram2_stemmed_docfreq": two
        + ", d AS (SELECT DISTINCT rid, gram FROM gram)"
        + count("d", "gram"),
        "wordcount_stemmed": word + count("word", "word"),
    }


HEADER = """
SELECT doc_id, doc_id || ':' || CAST(1990 + doc_id % 25 AS VARCHAR) ||
  CASE doc_id % 8
    WHEN 0 THEN '' WHEN 1 THEN ':' WHEN 2 THEN ':' || source || '|' || lang
    WHEN 3 THEN ':' || source || ':' || lang WHEN 4 THEN ':' || source || '|'
    WHEN 5 THEN ':|' || source WHEN 6 THEN ':|'
    ELSE ':' || source || '|' || lang || '|' || source END AS header
FROM documents"""
HEADINGS = f"""
WITH h AS ({HEADER}),
p AS (SELECT doc_id, string_split(regexp_replace(header, ':+\\z', ''), ':') AS p FROM h),
t AS (SELECT doc_id, len(p) AS k, regexp_replace(p[3], '\\|+\\z', '') AS third FROM p),
l AS (SELECT doc_id, CASE WHEN k <> 3 THEN ['No_Headings']
        WHEN third = '' THEN [] ELSE string_split(third, '|') END AS l FROM t)
SELECT doc_id, CAST(unnest(range(0, len(l))) AS INTEGER) AS at, unnest(l) AS heading
FROM l WHERE len(l) > 0"""

BY_HEADING = ", h AS (SELECT unnest(headings) AS heading, {0} FROM {1})"


def _by_heading(base: str, word: str, row: str, alias: str) -> str:
    return (
        base
        + BY_HEADING.format(f"{word} AS {alias}", row)
        + count("h", f"heading, {alias}")
    )


def _doc_by_heading(base: str, expr: str, row: str, alias: str, min_freq: int) -> str:
    return (
        base
        + f", h AS (SELECT DISTINCT rid, unnest(headings) AS heading, "
        f"{expr} AS {alias} FROM {row})"
        + count("h", f"heading, {alias}", min_freq)
    )


def _doc(base: str, name: str, min_freq: int = 10) -> str:
    return (
        base
        + f", d AS (SELECT DISTINCT rid, {name} FROM {name})"
        + count("d", name, min_freq)
    )


def _oracles() -> dict[str, str]:
    token_rows = (
        lines().replace(
            "tok AS (SELECT * EXCLUDE (line),",
            "whole AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY n) AS line "
            "FROM (SELECT doc_id, line, row_number() OVER () AS n FROM line) "
            "GROUP BY doc_id),\ntok AS (SELECT * EXCLUDE (line),", 1
        ).replace("AS t FROM line)", "AS t FROM whole)", 1)
        + """
SELECT doc_id, CAST(unnest(range(0, len(t))) AS INTEGER) AS at, unnest(t) AS token
FROM tok WHERE len(t) > 0"""
    )
    return {
        "tokens": token_rows,
        "headings": HEADINGS,
        "parse_marked_records": r"""
WITH l AS (SELECT doc_id, source, lang, string_split(text, chr(10)) AS l FROM documents),
b AS (SELECT *, list_transform(l, lambda x:
        regexp_replace(trim(x), '[.?]\z', '')) AS lines FROM l)
SELECT CAST(doc_id AS VARCHAR) AS doc_id,
       CAST(1990 + doc_id % 25 AS VARCHAR) || ' Jun 11' AS pub_date,
       CAST(1990 + doc_id % 25 AS INTEGER) AS year, source || '|' || lang AS headings,
       array_to_string(lines, chr(10)) AS body FROM b""",
        "parse_chunk_records": _chunk_rows()
        + """,
per AS (SELECT doc_id, string_agg(f, chr(9) ORDER BY n) AS chunks FROM kept
        GROUP BY doc_id)
SELECT CAST(d.doc_id AS VARCHAR) AS doc_id,
       CAST(1990 + d.doc_id % 25 AS VARCHAR) AS year, coalesce(chunks, '') AS chunks
FROM documents d LEFT JOIN per USING (doc_id)""",
        "parse_tagged": lines()
        + r"""
SELECT array_to_string(t, ' ') AS tokens, array_to_string(list_transform(t, lambda x:
  CASE WHEN regexp_matches(x, '\A[A-Z]') THEN 'NNP'
       WHEN regexp_matches(x, '[0-9]') THEN 'CD' ELSE 'NN' END), ' ') AS pos
FROM tok WHERE len(t) > 0""",
        "parse_marked_malformed": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
                  CASE WHEN doc_id % 3 = 0 THEN '[' || doc_id || ']' ELSE CAST(doc_id AS VARCHAR) END AS name,
                  CAST(1990 + doc_id % 25 AS INTEGER) AS year FROM documents)
SELECT CASE WHEN doc_id % 7 = 3 THEN '' ELSE name END AS doc_id,
       CASE WHEN doc_id % 7 = 3 THEN 0 ELSE year END AS year,
       CASE WHEN doc_id % 7 = 3 THEN 'unclosed' ELSE 'ok' END AS reason,
       CASE WHEN doc_id % 7 = 3
            THEN CAST(length(name || ':' || year || chr(10) || '_ArticleTitle_' || chr(10)
                             || '_AbstractText_' || chr(10) || text) AS BIGINT) ELSE 0 END AS raw_chars
FROM d
UNION ALL
SELECT '', 0, 'headerless', CAST(length('stray ' || doc_id) AS BIGINT) FROM d WHERE doc_id % 5 = 1""",
        "parse_tagged_malformed": lines()
        + r""",
s AS (SELECT t, len(t) AS n, array_to_string(t, chr(9)) AS tj,
             array_to_string(list_transform(t, lambda x:
               CASE WHEN regexp_matches(x, '\A[A-Z]') THEN 'NNP'
                    WHEN regexp_matches(x, '[0-9]') THEN 'CD' ELSE 'NN' END), chr(9)) AS pj
      FROM tok WHERE len(t) > 0)
SELECT CASE WHEN n % 5 <> 2 AND n % 4 <> 1 THEN replace(tj, chr(9), ' ') ELSE '' END AS tokens,
       CASE WHEN n % 5 <> 2 AND n % 4 <> 1 THEN replace(pj, chr(9), ' ') ELSE '' END AS pos,
       CASE WHEN n % 5 = 2 THEN 'unclosed' WHEN n % 4 = 1 THEN 'untagged' ELSE 'ok' END AS reason,
       CAST(CASE WHEN n % 5 = 2 THEN 1 + length(tj) + 1 + CASE WHEN n % 4 = 1 THEN 0 ELSE 6 + length(pj) END
                 WHEN n % 4 = 1 THEN 1 + length(tj) + 1 + 6 + length(pj) ELSE 0 END AS BIGINT) AS raw_chars
FROM s
UNION ALL
SELECT '', '', 'headerless', CAST(4 AS BIGINT) FROM s WHERE n % 3 = 0""",
        "yearly_from_lines": f"SELECT year, term, freq FROM ({SHORT_YEARLY})",
        "ngram1": grams(1) + count("gram", "gram"),
        "ngram2": grams(2) + count("gram", "gram"),
        "ngram3": grams(3) + count("gram", "gram"),
        "ngram2_lower": grams(2, lower=True) + count("gram", "gram"),
        "skip_patterns": _skip(),
        "ngram2_docfreq": _doc(grams(2), "gram"),
        "ngram_by_heading": _by_heading(grams(2), "gram", "gram", "gram"),
        "ngram_by_heading_docfreq": _doc_by_heading(grams(2), "gram", "gram", "gram", 5),
        "ngram_sweep": _sweep(),
        "ngram2_markup": grams(2, PAGES) + count("gram", "gram", 2),
        "ngram1_markup": grams(1, PAGES) + count("gram", "gram", 2),
        "ngram3_chat": grams(3, CHAT)
        + BY_HEADING.format("gram", "gram")
        + count("h", "heading, gram", 2),
        "wordcount": words() + count("word", "word"),
        "wordcount_stop": words()
        + f", k AS (SELECT word FROM word WHERE word NOT IN {STOPS})"
        + count("k", "word"),
        "wordcount_stop_table": words()
        + f", k AS (SELECT word FROM word WHERE word NOT IN {STOPS})"
        + count("k", "word"),
        "wordcount_lower": words(lower=True) + count("word", "word"),
        "wordcount_docfreq": _doc(words(), "word"),
        "wordcount_by_heading": _by_heading(words(), "s", "word", "word"),
        "wordcount_by_heading_clean": _by_heading(words(), "word", "word", "word"),
        "wordcount_by_heading_docfreq": _doc_by_heading(words(), "s", "word", "word", 10),
        "wordcount_markup": words(PAGES) + count("word", "word", 2),
        "cooccur_sentence": pairs("line"),
        "cooccur_sentence_stop": pairs("line", stop=True),
        "cooccur_sentence_stop_table": pairs("line", stop=True),
        "cooccur_document": pairs("record"),
        "cooccur_document_blocks": pairs("record"),
        "cooccur_sentence_grid": pairs("line"),
        "cooccur_markup": pairs("line", PAGES),
        "chunk_filter": _chunk_rows(stop=True)
        + f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_normal_chunk("f")} AS term FROM kept""",
        "chunk_by_year": chunk_counts("year", 5),
        "chunk_by_year_lower": chunk_counts("year", 5, lower=True),
        "chunk_by_doc": chunk_counts("doc_id", 2),
        "bwi": trend(
            words() + " SELECT word AS term, year, count(*) AS freq FROM word GROUP BY ALL"
        ),
        "bwi_short": trend(SHORT_YEARLY),
        "bwi_any_year": trend(
            "SELECT o_orderpriority AS term, CAST(o_orderkey % 20011 - 10000 AS INTEGER) AS year, "
            "CAST(count(*) AS BIGINT) AS freq FROM orders GROUP BY ALL"
        ),
        "bwi_from_chunks": trend(chunk_counts("year", 2)),
        "bwi_lines": f"""
SELECT term || '_' || start_year || '-' || end_year || chr(9) || freq AS line
FROM ({trend(SHORT_YEARLY)})""",
        "tagged_ngram1": tagged(1),
        "tagged_ngram2": tagged(2),
        "tagged_ngram3": tagged(3),
        "tagged_ngram2_lower": tagged(2, lower=True),
        "tagged_ngram_legacy": tagged(2, layout="whole"),
    }


ORACLES = _oracles() | _stem_queries()
