import pytest
from conftest import rows

import glossmill as g
from glossmill.functions.stemming import porter

# Word pairs of the published description.
PAIRS = """caresses caress ponies poni ties ti caress caress cats cat feed feed
agreed agre plastered plaster bled bled motoring motor sing sing conflated conflat
troubled troubl sized size hopping hop tanned tan falling fall hissing hiss
fizzed fizz failing fail filing file happy happi sky sky relational relat
conditional condit rational ration valenci valenc hesitanci hesit digitizer digit
conformabli conform radicalli radic differentli differ vileli vile analogousli analog
vietnamization vietnam predication predic operator oper feudalism feudal
decisiveness decis hopefulness hope callousness callous formaliti formal
sensitiviti sensit sensibiliti sensibl triplicate triplic formative form
formalize formal electriciti electr electrical electr hopeful hope goodness good
revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop
adjustable adjust defensible defens irritant irrit replacement replac
adjustment adjust dependent depend adoption adopt homologou homolog communism commun
activate activ angulariti angular homologous homolog effective effect bowdlerize bowdler
probate probat rate rate cease ceas controll control roll roll is is""".split()


@pytest.mark.parametrize(("word", "stem"), list(zip(PAIRS[::2], PAIRS[1::2])))
def test_published_pairs(word, stem):
    assert porter(word) == stem


def test_jobs(records):
    df = records("Running cats' motoring-cars\nhopes", "running (cats) é")
    grams = g.ngrams(df, stem=True, min_freq=1)
    assert rows(grams) == [
        ("Run cat", 1), ("cat motor", 1), ("motor car", 1), ("run cat", 1),
    ]
    docs = g.ngrams(df, stem=True, min_freq=1, unit="document")
    assert rows(docs) == rows(grams)
    words = dict(rows(g.word_counts(df, stem=True, min_freq=1)))
    assert words == {"Run": 1, "run": 1, "cat": 2, "motor": 1, "car": 1, "hope": 1}
    per_doc = g.word_counts(df, stem=True, min_freq=1, unit="document")
    assert dict(rows(per_doc)) == words
    vocabulary = rows(g.stem_vocabulary(df))
    assert ("cats", "cat", 2) in vocabulary
