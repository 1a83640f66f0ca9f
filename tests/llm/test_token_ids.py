"""Token files hold the library's ids of odd texts, whatever chunks are encoded together."""

import random

import public_tokenizers
import pyarrow as pa

from glossmill.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_ids_are_the_library_s():
    draw = random.Random(2)
    marks = list(" \t\n\x0bAbÉc.,é日\x1c\xa0'12~ßİ")
    texts = ["".join(draw.choices(marks, k=draw.randint(0, 12))) for _ in range(2000)]
    texts += ["", "~", "~ ~ a~b", "word. word, Word." * 50, "` ~"]
    tokenizer, _ = tokens._tokenizer(PATH)
    ids, ends = tokens._encoder(PATH)(pa.array(texts, pa.large_string()))
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == want


def test_distinct_chunks_are_encoded_once_in_few_calls(monkeypatch):
    """The library is asked once for many chunks, not once for each (F4)."""
    asked = []
    real, known = tokens._tokenizer(PATH)
    known.clear()

    class Counted:
        def encode(self, text, **how):
            asked.append(text)
            return real.encode(text, **how)

        def encode_batch_fast(self, texts, **how):
            asked.extend(texts)
            return real.encode_batch_fast(texts, **how)

    monkeypatch.setattr(tokens, "_tokenizer", lambda path: (Counted(), known))
    ids, ends = tokens._encoder(PATH)(pa.array(["a%d b%d " % (i, i) * 3 for i in range(900)], pa.large_string()))
    assert len(ends) == 901 and len(asked) < 20
