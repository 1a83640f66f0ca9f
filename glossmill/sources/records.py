"""Scans of marked, chunked and tagged text files and of yearly count lines.

Each `read_*` is a thin scan that cuts files into one row per record; each
`parse_*` works on any DataFrame with a string column `value` (each value a whole
text, as a file is, unless a boolean column `opened` says that a marker stood
before it), so text that already lives in a table needs no files. The record
marker is the scan's line separator: files stay splittable, and a record may cross
a split. Whether text is a record is decided by its place after a marker, never by
how its first line looks; faulty records are failed, dropped or kept with their
reason, and counted (`settle`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions import text as T
from glossmill.functions.rows import explode
from glossmill.operators import chunks as C

# --- Fixed values: the file formats. ---
RECORD_OPEN = "_pubmed_id="
RECORD_CLOSE = "_pubmed_id_end_"
SECTION_MARKS = ("_ArticleTitle_", "_AbstractText_")
TRUNCATED = "ABSTRACT TRUNCATED AT"
SENTENCE_CLOSE = ("[EOS]", "]")
TOKEN_LINE = "TOK:"
TAG_LINE = "POS:"
CLOSING_LINE = "CNK:"
# --- End of fixed values. ---

_BLANKS = r"[\x00-\x20]*"
# A line end with the blanks around it; starts once per run of blanks.
_NEW_LINE = (
    r"(?<![\x00-\x20])[\x00-\x09\x0B\x0C\x0E-\x20]*+[\r\n][\x00-\x20]*+"
)
_MODES = ("fail", "drop")


# Per record: why it is not used, or NULL.
REASONS = ("headerless", "unclosed", "bad_header", "untagged")
_MALFORMED = ("fail", "drop", "keep")
# Files of a scan whose first-record table is broadcast; more are joined by key.
MAX_BROADCAST_FILES = 200_000


def _scan(spark: SparkSession, path, marker: str) -> DataFrame:
    """`value, opened`: text between record markers, and whether a marker stood before it.

    The marker is the line separator, so files split. Only a file's first value has
    no marker before it; it is told by place: the smallest row number within the
    file's first split (`_metadata`), one row per file, joined back.
    """
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.option("lineSep", "\n" + marker).text(paths)
    rows = raw.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
    )
    firsts = (
        rows.where(F.col("_start") == 0)
        .groupBy("_file")
        .agg(F.min("_row").alias("_row"))
        .withColumn("_first", F.lit(True))
    )
    if len(raw.inputFiles()) <= MAX_BROADCAST_FILES:
        firsts = F.broadcast(firsts)
    joined = rows.join(firsts, ["_file", "_row"], "left")
    return joined.select("value", F.col("_first").isNull().alias("opened"))


def _pieces(df: DataFrame, opening: str, closing: str) -> DataFrame:
    """`inner, reason, raw` per record candidate of each value.

    A value is cut at opening markers at the start of a line (indented ones too).
    The first piece is a record if a marker stood before the value (`opened`) or
    the value starts with one; otherwise it is text without header ("headerless",
    or nothing if blank). A record needs a closing marker ("unclosed"); text after
    it up to the next opening marker is not part of any record. Without a column
    `opened` every value is a whole text, as a file is. All of it is one expression
    below one generator, so a value is taken apart once.
    """
    opened = F.col("opened") if "opened" in df.columns else F.lit(False)
    at_start = rf"\A{_BLANKS}{opening}"
    first_is_record = opened | F.col("value").rlike(at_start)
    value = F.when(opened, F.col("value")).otherwise(F.regexp_replace("value", F.lit(at_start), F.lit("")))

    def judge(piece: Column, i: Column) -> Column:
        cut = F.split(piece, _NEW_LINE + closing, 2)
        closed = F.size(cut) == 2
        reason = F.when((i == 0) & ~first_is_record, F.lit("headerless")).when(~closed, F.lit("unclosed"))
        inner = F.when(closed, F.get(cut, F.lit(0))).otherwise(piece)
        return F.struct(inner.alias("inner"), reason.alias("reason"), piece.alias("raw"))

    judged = F.transform(F.split(value, _NEW_LINE + opening), judge)
    judged = F.filter(judged, lambda p: ~((p["reason"] == "headerless") & p["raw"].rlike(rf"\A{_BLANKS}\z")))
    pieces = explode(df, [], judged, "piece")
    return pieces.select(*[F.col(f"piece.{c}").alias(c) for c in ("inner", "reason", "raw")])


def settle(rows: DataFrame, malformed: str, observation=None, fatal=REASONS) -> DataFrame:
    """Apply a malformed-record mode to rows with a `reason` column.

    "fail" raises on the first record with a reason in `fatal` and leaves out other
    faulty ones, "drop" leaves all faulty ones out, "keep"
    returns them with their reason (to be written aside). With an
    `pyspark.sql.Observation`, the number of good records and of each reason is
    counted in the same pass and read after an action: `observation.get`.
    """
    if malformed not in _MALFORMED:
        raise ValueError(f"malformed must be one of {_MALFORMED}")
    reason = F.col("reason")
    if observation is not None:
        counts = [F.count_if(reason.isNull()).alias("good")]
        counts += [F.count_if(reason == r).alias(r) for r in REASONS]
        rows = rows.observe(observation, *counts)
    if malformed == "drop":
        return rows.filter(reason.isNull())
    if malformed == "fail":
        message = F.concat(F.lit("malformed record ("), reason, F.lit("): "), F.substring("raw", 1, 200))
        verdict = F.when(reason.isNull(), F.lit(True)).when(~reason.isin(*fatal), F.lit(False))
        return rows.filter(verdict.otherwise(F.raise_error(message)))
    return rows


def _marked(df: DataFrame, malformed: str = "drop", observation=None, check_header=False, fatal=REASONS) -> DataFrame:
    """`header, lines, reason, raw`: trimmed body lines of records, markers dropped.

    With `check_header`, a header without ':' or with a date under four characters
    is a fault ("bad_header").
    """
    pieces = _pieces(df, RECORD_OPEN, RECORD_CLOSE)
    parts = F.split("inner", r"[\r\n]", 2)
    header = F.rtrim(F.get(parts, F.lit(0)), F.lit(T.TRIMMED))
    halves = pieces.select(
        header.alias("header"),
        F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("rest"),
        "reason",
        "raw",
    )
    if check_header:
        fields = F.split("header", ":", 2)
        date = F.coalesce(F.get(fields, F.lit(1)), F.lit(""))
        good = (F.size(fields) == 2) & (F.length(date) >= 4)
        halves = halves.withColumn(
            "reason", F.when(F.col("reason").isNull() & ~good, F.lit("bad_header")).otherwise(F.col("reason"))
        )
    halves = settle(halves, malformed, observation, fatal)

    def kept(line: Column) -> Column:
        wanted = (line != "") & ~line.contains(TRUNCATED)
        for mark in SECTION_MARKS:
            wanted &= ~line.startswith(mark)
        return wanted

    lines = F.transform(F.split("rest", r"[\r\n]+"), T.java_trim)
    faulty = F.col("reason").isNotNull()
    return halves.select(
        F.when(~faulty, F.col("header")).alias("header"),
        F.when(~faulty, F.filter(lines, kept)).alias("lines"),
        "reason",
        "raw",
    )


def parse_marked(df: DataFrame, malformed: str = "drop", observation=None) -> DataFrame:
    """`doc_id, pub_date, year, headings, header, body` of each closed record.

    Faulty records (text before a file's first marker, records without closing
    marker) go by `malformed`: "drop" (the default), "fail", or "keep", which adds
    `reason` and `raw` and leaves the other columns NULL for them. See `settle`.
    """
    parts = F.split("header", ":")
    date = F.get(parts, F.lit(1))
    out = _marked(df, malformed, observation).select(
        F.get(parts, F.lit(0)).alias("doc_id"),
        date.alias("pub_date"),
        F.substring(date, 1, 4).try_cast("int").alias("year"),
        F.when(F.col("header").isNotNull(), T.headings(F.col("header"))).alias("headings"),
        "header",
        F.array_join("lines", "\n").alias("body"),
        "reason",
        "raw",
    )
    return out if malformed == "keep" else out.drop("reason", "raw")


def read_marked(spark: SparkSession, path, malformed: str = "drop", observation=None) -> DataFrame:
    """Marked records of a file, folder, glob or list of these."""
    return parse_marked(_scan(spark, path, RECORD_OPEN), malformed, observation)


def parse_chunked(df: DataFrame, stop_words=(), malformed: str = "fail", observation=None) -> DataFrame:
    """`doc_id, year, chunks`: the framed chunks of each record that count.

    A header without ':' or with a date under four characters fails the job, or
    with malformed="drop" loses its record; text before a file's first marker and
    records without closing marker are left out (and counted) in both modes.
    "keep" adds `reason` and `raw`.
    `stop_words` is a list; give a stop table to `chunk_counts`.
    """
    if malformed not in _MALFORMED:
        raise ValueError(f"malformed must be one of {_MALFORMED}")
    marked = _marked(df, malformed, observation, check_header=True, fatal=("bad_header",)).select(
        "lines", F.split("header", ":", 2).alias("parts"), "reason", "raw"
    )

    def is_chunk(line: Column) -> Column:
        wanted = F.lit(True)
        for mark in SENTENCE_CLOSE:
            wanted &= ~line.startswith(mark)
        return wanted

    framed = F.transform(F.filter("lines", is_chunk), C.frame_chunk)
    chunks = F.filter(framed, C.valid_chunk)
    listed = list(stop_words)
    if listed:
        chunks = F.filter(chunks, lambda c: ~C.chunk_text(c).isin(listed))
    out = marked.select(
        F.get("parts", F.lit(0)).alias("doc_id"),
        F.substring(F.get("parts", F.lit(1)), 1, 4).alias("year"),
        chunks.alias("chunks"),
        "reason",
        "raw",
    )
    return out if malformed == "keep" else out.drop("reason", "raw")


def read_chunked(
    spark: SparkSession, path, stop_words=(), malformed: str = "fail", observation=None
) -> DataFrame:
    return parse_chunked(_scan(spark, path, RECORD_OPEN), stop_words, malformed, observation)


def parse_tagged(df: DataFrame, malformed: str = "drop", observation=None) -> DataFrame:
    """`tokens, pos` of each sentence that has a token, a tag and a closing line.

    Faults: text before a file's first token line ("headerless"), no closing line
    ("unclosed"), no tag line ("untagged"); handled by `malformed` as in `settle`.
    """
    pieces = _pieces(df, TOKEN_LINE, CLOSING_LINE)
    tagged = F.col("inner").rlike(_NEW_LINE + TAG_LINE)
    pieces = pieces.withColumn(
        "reason", F.when(F.col("reason").isNull() & ~tagged, F.lit("untagged")).otherwise(F.col("reason"))
    )
    rows = settle(pieces, malformed, observation)
    tags = F.regexp_extract("inner", rf"(?s).*{_NEW_LINE}{TAG_LINE}([^\r\n]*)", 1)
    words = F.get(F.split("inner", r"[\r\n]", 2), F.lit(0))
    good = F.col("reason").isNull()
    out = rows.select(
        F.when(good, F.split(T.java_trim(words), "\t")).alias("tokens"),
        F.when(good, F.split(T.java_trim(tags), "\t")).alias("pos"),
        "reason",
        "raw",
    )
    return out if malformed == "keep" else out.drop("reason", "raw")


def read_tagged(spark: SparkSession, path, malformed: str = "drop", observation=None) -> DataFrame:
    return parse_tagged(_scan(spark, path, TOKEN_LINE), malformed, observation)


def parse_yearly(df: DataFrame, malformed: str = "fail") -> DataFrame:
    """`year, term, freq` of lines `year_term<TAB>freq`; further fields are ignored.

    The key is cut at its first '_'. A line with fewer than two fields, without
    '_' or with a number that is none fails the job or is dropped.
    """
    if malformed not in _MODES:
        raise ValueError(f"malformed must be one of {_MODES}")
    fields = df.select("value", F.split("value", "\t").alias("f"))
    key = F.split(F.get("f", F.lit(0)), "_", 2)
    rows = fields.select(
        "value",
        F.get(key, F.lit(0)).try_cast("int").alias("year"),
        F.get(key, F.lit(1)).alias("term"),
        F.get("f", F.lit(1)).try_cast("bigint").alias("freq"),
    )
    good = (
        F.col("year").isNotNull()
        & F.col("term").isNotNull()
        & F.col("freq").isNotNull()
    )
    if malformed == "drop":
        rows = rows.filter(good)
    else:
        message = F.concat(F.lit("bad count line: "), F.col("value"))
        rows = rows.withColumn(
            "freq", F.when(good, F.col("freq")).otherwise(F.raise_error(message))
        )
    return rows.select("year", "term", "freq")


def read_yearly(spark: SparkSession, path, malformed: str = "fail") -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return parse_yearly(spark.read.text(paths), malformed)
