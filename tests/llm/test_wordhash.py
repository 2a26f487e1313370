import random

import numpy as np
import pyarrow as pa
import pytest

from weblens.llm.wordhash import shingle_sets, text_slices, word_hashes, span_hashes

SPACES = " \t\n\x0b\x0c\r"


def split(text):
    out, word = [], ""
    for c in text:
        if c in SPACES:
            out, word = out + [word] if word else out, ""
        else:
            word += c
    return out + [word] if word else out


@pytest.mark.parametrize("most", [1, 40, 1 << 20])
def test_words_as_by_hand(most):
    rng = random.Random(1)
    texts = ["".join(rng.choice("aAbé \t\n\x1c\xa0.") for _ in range(rng.randrange(30))) for _ in range(300)] + [None, ""]
    known, at = {}, 0
    for first, data, offsets in text_slices(pa.array(texts), most):
        assert first == at
        hashes, bounds = word_hashes(data, offsets)
        for i, j in zip(bounds[:-1], bounds[1:]):
            expected = split(texts[at] or "")
            assert j - i == len(expected)
            for word, h in zip(expected, hashes[i:j].tolist()):
                assert known.setdefault(word, h) == h
            at += 1
    assert at == len(texts)
    assert len(set(known.values())) == len(known)


def test_shingles():
    def one(text, lower=True):
        return next(iter(shingle_sets(data, offsets, 4, lower)[0].tolist() for _, data, offsets in text_slices(pa.array([text]))))
    assert one("") == [] and len(one("a b c")) == 1 and len(one("a b c d")) == 1 and len(one("a b c d e a b c d")) == 5
    assert one("A b\tC d") == one("a B c D") != one("a b d c")
    assert one("a b c") != one("a b") and one("a b c")[0] not in one("a b c d e")
    assert one("É b c d") != one("é b c d")
    assert isinstance(shingle_sets(np.zeros(0, np.uint8), np.zeros(2, np.int64), 4)[0], np.ndarray)


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_texts_that_polynomials_confuse():
    """For every base modulo 2^64 the two texts have one polynomial."""
    one = thue_morse(1024)
    other = one.translate(str.maketrans("ab", "ba"))
    data = np.frombuffer((one + other).encode(), np.uint8)
    for size in (256, 1024):
        starts = np.arange(0, 2048, size)
        for hashes in span_hashes(data, starts, starts + size, two=True):
            assert len(set(hashes.tolist())) == (2 if size == 1024 else len({(one + other)[s:s + size] for s in starts}))


def test_spans_of_any_length_and_place():
    rng = np.random.default_rng(5)
    data = rng.integers(0, 3, 3000).astype(np.uint8)
    starts = rng.integers(0, 3000, 4000)
    ends = np.minimum(3000, starts + rng.integers(0, 300, 4000))
    first, second = span_hashes(data, starts, ends, two=True)
    seen = {}
    for a, b, x, y in zip(starts, ends, first.tolist(), second.tolist()):
        assert seen.setdefault(data[a:b].tobytes(), (x, y)) == (x, y)
    assert len({x for x, _ in seen.values()}) == len(seen) == len({y for _, y in seen.values()})
