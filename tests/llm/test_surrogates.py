"""Entities of single texts: what is found, and where it ends."""

import pytest

from glossmill.llm import surrogates


def spans(text):
    return [(kind, text[lo:hi]) for kind, _, lo, hi in surrogates.found(text)]


@pytest.mark.parametrize(
    "lead, value",
    [
        *((f"{word}{sign}", "correcthorsebattery") for word in ("key", "TOKEN", "Secret", "password", "passwd") for sign in ("=", " = ", ": '")),
        *(("see ", f"{start}abcdefghijklmnop") for start in ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "xoxa-", "xoxb-", "xoxp-")),
    ],
)
def test_secrets_without_digits(lead, value):
    assert spans(lead + value) == [("secret", value)]
    assert spans(f"{lead}{value} 7") == [("secret", value)]  # the same next to a digit


@pytest.mark.parametrize("n", [129, 201, 100_000])
def test_long_secrets(n):
    for lead, value in (
        ("token: ", "x" * n),
        ("", "ghp_" + "y" * n),
        ("", "0a" * (n // 2 + 1)),
    ):
        assert spans(f"{lead}{value}, end") == [("secret", value)]
        new = surrogates.surrogate(b"k", "secret", value, 0)
        assert len(new) == len(value) and new != value
    # Equal but for the last character: two entities.
    ends = {spans("token: " + "x" * n + c)[0] for c in "ab"}
    assert len(ends) == 2


def test_long_runs_are_linear():
    for text in ("0a" * 500_000 + "é", "token=" * 200_000, "sk-" * 400_000, "a" * 1_000_000 + " 1"):
        list(surrogates.found(text))


CLEAN = [
    "2021-03-14", "14.03.2021", "03 14 2021", "1999-2004", "(1999) 2004-2010", "10 20 30",
    "10 20 30 40 50", "100 200 300 400", "12-34-56", "key = ____________", "2021 2022 2023",
]
PHONES = [
    "+1 (411) 555-1507", "(411) 555-1507", "411-555-1507", "1-411-555-1507", "555-1507",
    "+49 30 1234 5678", "030 1234567", "01 23 45 67 89", "0151-2345678", "912 345 678",
    "495 123-45-67", "+44 20 7946 0958", "(020) 7946 0958", "+33 1 23 45 67 89", "+15550123456",
]


def test_clean_numbers_stay():
    for text in CLEAN:
        assert spans(f"see {text}, end") == [], text


def test_phones_are_found_whole():
    for text in PHONES:
        assert spans(f"call {text}, end") == [("phone", text)], text


def test_a_full_class_gets_longer_surrogates(spark):
    # All e-mails with one-letter local part and host that surrogates can have.
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = [f"{a}@{b}.example.{c}" for a in letters for b in letters for c in ("com", "net", "org")]
    docs = spark.createDataFrame([(m,) for m in mails], "text string")
    out = [r["text"] for r in surrogates.replaced(docs, b"k").collect()]
    assert len(set(out)) == len(mails) and not set(out) & set(mails)
    phone = surrogates.surrogate(b"k", "phone", "4115551507", surrogates.WIDEN)
    assert len(phone) == 11 and surrogates._shown("phone", "(411) 555-1507", phone)[-1] == phone[-1]


def test_untitled_mentions_of_titled_names():
    text = "John came. Mr John Smith said. Smith signed, SMITH's note. John agreed with Smithers."
    names = [text[lo:hi] for kind, _, lo, hi in surrogates.found(text) if kind.startswith("name")]
    assert names == ["John", "John", "Smith", "Smith", "SMITH", "John"]
    assert len({(k, c) for k, c, _, _ in surrogates.found(text)}) == 2
    # No part of a name, though it stands in one with a capital.
    text = "Dr Miller The report and the date, the end, the. The miller. Miller, jo.miller@x.com."
    assert [w for _, w in spans(text)] == ["Miller", "The", "Miller", "jo.miller@x.com"]


def test_greek_titles():
    text = "Ο κ. Παπαδόπουλος ήρθε. Η κα Άννα Νίκου, ο Παπαδόπουλος, κ λέξη."
    assert [w for _, w in spans(text)] == ["Παπαδόπουλος", "Άννα", "Νίκου", "Παπαδόπουλος"]


def test_mentions_share_a_surrogate(spark):
    docs = spark.createDataFrame([("Mr John Smith said. Smith signed. John agreed.",)], "text string")
    row = surrogates.replaced(docs, b"k").first()
    words = row["text"].replace(".", "").split()
    assert row["n_replaced"] == 4 and words[1] == words[6] and words[2] == words[4]
    assert not {"John", "Smith"} & set(words)
