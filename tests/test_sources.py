import time

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import glossmill as g
from glossmill.operators import chunks as C

MARKED = """_pubmed_id=101:2021 Jun 11:Anatomy|Cell Biology
_ArticleTitle_
<s n="1">Repair of the (CNS) pathway.</s>
_AbstractText_
<s n="1">Cells +/- factor A-->B, "signal" loss?</s>

  <s n="2">Wow it works!</s>\t
(ABSTRACT TRUNCATED AT 250 WORDS)
_pubmed_id_end_
text after the end is ignored
_pubmed_id=102:2009
_ArticleTitle_
_pubmed_id_end_
_pubmed_id=103:1999:X
never closed
  _pubmed_id=104:abcd:|
<s n="1">Indented marker.</s>
 _pubmed_id_end_
"""
WANT = [
    (
        "101", "2021 Jun 11", 2021, ["Anatomy", "Cell Biology"],
        '<s n="1">Repair of the (CNS) pathway.</s>\n'
        '<s n="1">Cells +/- factor A-->B, "signal" loss?</s>\n'
        '<s n="2">Wow it works!</s>',
    ),
    ("102", "2009", 2009, ["No_Headings"], ""),
    ("104", "abcd", None, [], '<s n="1">Indented marker.</s>'),
]


@pytest.mark.parametrize("line_end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("preamble", ["", "\n \n", "<s n=\"1\">junk</s>\n_pubmed_id_end_\n"])
def test_marked_scan(spark, tmp_path, line_end, preamble):
    (tmp_path / "a.txt").write_bytes(
        (preamble + MARKED).replace("\n", line_end).encode()
    )
    got = g.read_marked(spark, str(tmp_path))
    assert rows(got, "doc_id", "pub_date", "year", "headings", "body") == WANT


def test_marked_scan_across_splits(spark, tmp_path):
    records = [
        f'_pubmed_id={i}:2000:H{i}\n_ArticleTitle_\n<s n="1">w{i} {"x " * (i % 50)}.</s>\n'
        "_pubmed_id_end_\n"
        for i in range(500)
    ]
    for part in range(2):
        text = "".join(records[part::2])
        (tmp_path / f"{part}.txt").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        df = g.read_marked(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 10
        got = rows(df, F.col("doc_id").cast("int"), "headings")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(i, [f"H{i}"]) for i in range(500)]


CHUNKED = """_pubmed_id=40404:2009
_ArticleTitle_
[NP The MAP kinase ]
, and
[EOS]
_AbstractText_
[NP MAP kinase) ]
[NP many bacteria ]
and
[NP x ]
[NP p < 0.05 ]
[NP foo,; ]
[VP (CNS) ]
[NP II ]
] x
[EOS]
_pubmed_id_end_
"""


def test_chunked_scan(spark, tmp_path):
    (tmp_path / "c.txt").write_text(CHUNKED)
    df = g.read_chunked(spark, str(tmp_path))
    assert rows(df, "doc_id", "year") == [("40404", "2009")]
    assert df.first().chunks == [
        "[NP The MAP kinase ]", "[NP MAP kinase) ]", "[NP many bacteria ]",
        "[NP and ]", "[NP foo ]", "[VP (CNS) ]",
    ]
    stopped = g.read_chunked(spark, str(tmp_path), stop_words=["and"])
    assert "[NP and ]" not in stopped.first().chunks
    counts = g.chunk_counts(df, min_freq=1)
    assert rows(counts) == [
        ("2009", "[NP MAP kinase ]", 2),
        ("2009", "[NP and ]", 1),
        ("2009", "[NP foo ]", 1),
        ("2009", "[NP many bacteria ]", 1),
        ("2009", "[VP (CNS) ]", 1),
    ]
    table = spark.createDataFrame([("and",)], "word string")
    late = g.chunk_counts(df, min_freq=1, stop_words=table, by="doc_id")
    assert "[NP and ]" not in [r[1] for r in rows(late)]
    folded = g.chunk_counts(df, min_freq=1, case_sensitive=False)
    assert ("2009", "[np the map kinase ]", 1) in rows(folded)
    skipped = g.chunk_counts(df, min_freq=1, skip_patterns=[r"MAP kinase\) \]\t\[NP "])
    assert ("2009", "[NP many bacteria ]", 1) in rows(skipped)


def test_chunk_with_tab_and_quirks(spark):
    df = spark.createDataFrame([("1", "2000", ["[NP a\tb ]"])],
                               "doc_id string, year string, chunks array<string>")
    assert rows(g.chunk_counts(df, min_freq=1), "term") == [("[NP a",), ("b ]",)]
    lines = spark.createDataFrame([("[NP foo",), ("bar .",), ("[np x y ]",)], "c string")
    framed = rows(lines.select(C.frame_chunk(F.col("c"))))
    assert framed == [("[NP [np x y ] ]",), ("[NP bar ]",), ("[NP foo ]",)]


def test_chunked_bad_header(spark):
    df = spark.createDataFrame(
        [("_pubmed_id=1\n[NP foo bar ]\n_pubmed_id_end_",),
         ("_pubmed_id=2:201\n[NP foo bar ]\n_pubmed_id_end_",),
         ("_pubmed_id=3:2010 Jan\n[NP foo bar ]\n_pubmed_id_end_",)],
        "value string",
    )
    got = g.parse_chunked(df, malformed="drop")
    assert rows(got) == [("3", "2010", ["[NP foo bar ]"])]
    with pytest.raises(PySparkException):
        g.parse_chunked(df).collect()


TAGGED = """TOK:\tThe\tMAP\tkinase\t(\tMAPK\t)
POS:\tDT\tNN\tNN\t-LRB-\tNN\t-RRB-
LEM:\tthe\tmap\tkinase\t(\tmapk\t)
CNK:\tB-NP\tI-NP\tI-NP\tO\tB-NP\tO

TOK:\tno\ttags
CNK:\tO\tO
TOK:\tnot closed
POS:\tNN
TOK:\ta\tb\tc
POS:\tDT\tNN
CNK:\tO
"""


def test_tagged_scan_and_ngrams(spark, tmp_path):
    (tmp_path / "t.txt").write_text(TAGGED)
    df = g.read_tagged(spark, str(tmp_path))
    assert df.count() == 2
    got = rows(g.tagged_ngrams(df, min_freq=1))
    assert got == [
        ("MAP", "", "kinase", "NN", "NN", 1),
        ("The", "", "MAP", "DT", "NN", 1),
        ("a", "", "b", "DT", "NN", 1),
    ]
    whole = rows(g.tagged_ngrams(df, 3, min_freq=1, layout="whole"))
    # A bracket inside a gram stays.
    assert whole == [
        ("The MAP kinase", "DT", "kinase", 1),
        ("kinase ( MAPK", "NN", "MAPK", 1),
    ]
    single = rows(g.tagged_ngrams(df, 1, min_freq=1, layout="whole"))
    assert ("MAP", "", "MAP", 1) in single
    lower = rows(g.tagged_ngrams(df, 3, min_freq=1, case_sensitive=False))
    assert lower == [
        ("kinase", "(", "mapk", "NN", "NN", 1),
        ("the", "map", "kinase", "DT", "NN", 1),
    ]


def test_yearly_scan(spark, tmp_path):
    (tmp_path / "y.txt").write_text(
        "2003_[NP MAP kinase ]\t197\n2004_a_b\t3\textra\nbad line\n40404_x\tq\n"
    )
    got = rows(g.read_yearly(spark, str(tmp_path), malformed="drop"))
    assert got == [(2003, "[NP MAP kinase ]", 197), (2004, "a_b", 3)]
    with pytest.raises(PySparkException):
        g.read_yearly(spark, str(tmp_path)).collect()


def test_word_lists(spark, tmp_path):
    (tmp_path / "w.txt").write_text("the\nof\n")
    (tmp_path / "p.txt").write_text("b+\n\na\\d\n")
    assert g.read_stop_words(spark, str(tmp_path / "w.txt")) == ["the", "of"]
    both = g.read_skip_patterns(spark, str(tmp_path / "p.txt"), str(tmp_path / "w.txt"))
    assert both == ["b+", "a\\d", "the", "of"]
    with pytest.warns(UserWarning):
        assert g.read_stop_words(spark, str(tmp_path / "none.txt")) == []
    assert g.read_word_table(spark, str(tmp_path / "w.txt")).columns == ["word"]
    with pytest.warns(UserWarning):
        assert g.read_word_table(spark, str(tmp_path / "none.txt")).count() == 0
    (tmp_path / "long.txt").write_text("".join(f"w{i}\n" for i in range(50_000)))
    assert len(g.read_skip_patterns(spark, str(tmp_path / "long.txt"))) == 50_000
    assert len(g.read_stop_words(spark, str(tmp_path / "long.txt"))) == 50_000


def test_chunk_stop_table_with_skip_patterns(spark):
    df = spark.createDataFrame(
        [("1", "2000", ["[NP and ]", "[NP MAP kinase) ]", "[NP many bacteria ]"])] * 2
        + [("2", "2001", ["[NP and ]"])],
        "doc_id string, year string, chunks array<string>",
    )
    table = spark.createDataFrame([("and",)], "word string")
    options = dict(min_freq=1, skip_patterns=[r"MAP kinase\) \]\t\[NP "])
    listed = rows(g.chunk_counts(df, stop_words=["and"], **options))
    assert rows(g.chunk_counts(df, stop_words=table, **options)) == listed
    assert listed == [("2000", "[NP many bacteria ]", 2)]


def test_patterns_take_linear_time(spark):
    n = 1_000_000
    values = [
        ("_pubmed_id=1:2000" + "\n" * n + "x",),
        ("_pubmed_id=1:2000\n[NP a" + "." * n + "x ]\n_pubmed_id_end_",),
        ("_pubmed_id=1:2000\n[NP a" + " " * n + "x) ]\n_pubmed_id_end_",),
        ("TOK:a" + "\n " * n + "x",),
    ]
    df = spark.createDataFrame(values, "value string")
    start = time.perf_counter()
    g.chunk_counts(g.parse_chunked(df), min_freq=1).collect()
    g.parse_marked(df).collect()
    g.parse_tagged(df).collect()
    assert time.perf_counter() - start < 60


def test_tsv_round_trip(spark, tmp_path):
    yearly = spark.createDataFrame(
        [(2000 + i, f"[NP t{i % 4} ]", i + 1) for i in range(20)],
        "year int, term string, freq long",
    )
    out = str(tmp_path / "out")
    g.write_tsv(yearly, out, g.yearly_key(), parts=3)
    parts = [p for p in (tmp_path / "out").glob("part-*") if p.stat().st_size]
    assert 1 < len(parts) <= 3
    for part in parts:
        keys = [line.split("\t")[0] for line in part.read_text().splitlines()]
        assert keys == sorted(keys)
    assert rows(g.read_yearly(spark, out)) == rows(yearly)
    with pytest.raises(PySparkException):
        g.write_tsv(yearly, out, g.yearly_key())
    pairs = spark.createDataFrame([("b", "a", 3)], "hi string, lo string, freq long")
    g.write_tsv(pairs, str(tmp_path / "p"), ["hi", "lo"], parts=1)
    assert [r[0] for r in spark.read.text(str(tmp_path / "p")).collect()] == ["b\ta\t3"]


def test_records_framed_by_place(spark, tmp_path):
    """A record is what follows a marker, whatever its header looks like."""
    from pyspark.sql import Observation

    (tmp_path / "a.txt").write_text(
        "stray text\nmore _pubmed_id_end_\n_pubmed_id_end_\n"
        "_pubmed_id=[9]:2021\n<s n=\"1\">kept.</s>\n_pubmed_id_end_\n"
        "_pubmed_id=<s 7>:2020\n_pubmed_id_end_\n"
        "_pubmed_id=_ArticleTitle_:2019\n_pubmed_id_end_\n"
        "_pubmed_id=8:2018\nnever closed\n"
    )
    (tmp_path / "b.txt").write_text("_pubmed_id=5:2001\n_pubmed_id_end_\n")
    seen = Observation("marked")
    got = g.read_marked(spark, str(tmp_path), observation=seen)
    assert rows(got, "doc_id", "year") == [("5", 2001), ("<s 7>", 2020), ("[9]", 2021), ("_ArticleTitle_", 2019)]
    counts = seen.get
    assert (counts["good"], counts["headerless"], counts["unclosed"]) == (4, 1, 1)
    kept = g.read_marked(spark, str(tmp_path), malformed="keep")
    bad = rows(kept.filter("reason IS NOT NULL"), "reason", "doc_id", "raw")
    assert bad == [
        ("headerless", None, "stray text\nmore _pubmed_id_end_\n_pubmed_id_end_"),
        ("unclosed", None, "8:2018\nnever closed\n"),
    ]
    with pytest.raises(PySparkException, match="malformed record"):
        g.read_marked(spark, str(tmp_path), malformed="fail").collect()


def test_first_record_told_in_packed_splits(spark, tmp_path):
    """Many small files share a partition; only each file's head lacks a marker."""
    for i in range(40):
        head = "" if i % 2 else f"junk {i}\n"
        (tmp_path / f"{i}.txt").write_text(
            head + f"_pubmed_id={i}:2000\nA\n_pubmed_id_end_\n_pubmed_id=[{i}]:2001\nB\n_pubmed_id_end_\n"
        )
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60")
    try:
        got = rows(g.read_marked(spark, str(tmp_path)), "doc_id")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = sorted([(str(i),) for i in range(40)] + [(f"[{i}]",) for i in range(40)])
    assert got == want


def test_tagged_junk_before_first_token_line(spark, tmp_path):
    from pyspark.sql import Observation

    (tmp_path / "t.txt").write_text(
        "junk\nPOS:\tNN\nCNK:\tx\n"
        "TOK:\ta\tb\nPOS:\tDT\tNN\nLEM:\ta\tb\nCNK:\tx\n"
        "TOK:\tno\ttag\nCNK:\tx\n"
        "TOK:\topen\n"
    )
    seen = Observation("tagged")
    got = g.read_tagged(spark, str(tmp_path), observation=seen)
    assert [tuple(r) for r in got.collect()] == [(["a", "b"], ["DT", "NN"])]
    c = seen.get
    assert (c["good"], c["headerless"], c["untagged"], c["unclosed"]) == (1, 1, 1, 1)
