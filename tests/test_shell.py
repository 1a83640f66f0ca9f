from test_sources import CHUNKED, MARKED, TAGGED

from glossmill.jobs import main


def output(spark, path):
    return sorted(r[0] for r in spark.read.text(str(path)).collect())


def test_every_job_from_the_shell(spark, tmp_path):
    for name, text in (("m", MARKED), ("c", CHUNKED), ("t", TAGGED)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part").write_text(text)
    (tmp_path / "skip").write_text("factor \n")
    (tmp_path / "stop").write_text("and\nthe\n")

    def run(job, source, *options):
        target = tmp_path / "-".join(("out", job, *options)).replace("/", "_")
        main([job, *options, "--parts", "2", str(tmp_path / source), str(target)])
        return output(spark, target)

    grams = run("ngrams", "m", "--min-freq", "1", "--skip", str(tmp_path / "skip"))
    assert "+/- A-->B\t1" in grams
    headed = run("ngrams", "m", "--min-freq", "1", "--by-heading", "--per-document")
    assert "Anatomy\tof the\t1" in headed
    swept = run("ngram-sweep", "m", "--min-freq", "1", "--highest", "3")
    assert "Repair of the\t1" in swept
    words = run("word-counts", "m", "--min-freq", "1", "--stop-words", str(tmp_path / "stop"))
    assert "CNS\t1" in words and "the\t1" not in words
    pairs = run("cooccurrence", "m", "--min-freq", "1", "--per-document")
    assert "works!\tWow\t1" in pairs
    tagged = run("tagged-ngrams", "t", "--min-freq", "1", "-n", "2")
    assert "MAP\t\tkinase\tNN\tNN\t1" in tagged
    chunks = run("chunk-counts", "c", "--min-freq", "1", "--stop-words", str(tmp_path / "stop"))
    assert "2009_[NP MAP kinase ]\t2" in chunks
    assert "2009_[NP and ]\t1" not in chunks
    (tmp_path / "y").mkdir()
    (tmp_path / "y" / "part").write_text("2000_[NP x ]\t5\n2005_[NP x ]\t6\n")
    trend = run("rolling-term-sum", "y")
    assert trend == ["[NP x ]_2000-2005\t11", "[NP x ]_2001-2005\t6"]


def test_jobs_count_and_fail_on_faulty_records(spark, tmp_path, capsys):
    import pytest
    from pyspark.errors import PySparkException

    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "part").write_text("stray\n" + MARKED)
    target = tmp_path / "out"
    main(["word-counts", "--min-freq", "1", "--parts", "1", str(tmp_path / "m"), str(target)])
    assert "records: good 3, headerless 1, unclosed 1, bad_header 0, untagged 0" in capsys.readouterr().err
    with pytest.raises(PySparkException, match="malformed record"):
        main(["word-counts", "--malformed", "fail", str(tmp_path / "m"), str(tmp_path / "out2")])
