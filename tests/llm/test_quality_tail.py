"""Quality rules judge documents to their last byte, and short ones by smaller chunks."""

import random

import numpy as np
import pytest

from quillmill.llm import quality

BANDS = quality.Bands()
COMPRESS = quality._compress(BANDS)


def prose(size, seed=0):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeiounrstlm") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    return " ".join(rng.choice(words) for _ in range(size))[:size]


def noise(size):
    return "".join(map(chr, np.random.default_rng(1).integers(33, 127, size)))


def judge(text):
    return quality.measure(text, BANDS, COMPRESS)


@pytest.mark.parametrize("clean", [2048, 4096, 6144])
@pytest.mark.parametrize("tail, reason", [(noise(2000), "incompressible chunks"), (("the same phrase again and again, " * 99)[:2000], "repetitive chunks")])
def test_tail_counts(clean, tail, reason):
    assert judge(prose(clean))[0]
    keep, why, _, _, chunks, outside = judge(prose(clean) + tail)
    # Where much of a text repeats itself, the ratio of the whole may reject it first.
    assert not keep and why in (reason, reason.split()[0]) and (chunks, outside) == (clean // 2048 + 1, 1)


def test_short_documents_have_chunks():
    assert judge(prose(1500))[:2] == (True, None)
    assert judge(prose(1024) + noise(600))[:2] == (False, "incompressible chunks")
    assert judge(prose(1024) + "again " * 100)[:2] == (False, "repetitive chunks")
    assert judge(prose(200))[4] == 0


def test_overlap_counts_once():
    # One chunk of seven is bad; the last one, a byte further, overlaps it and is bad too.
    text = prose(6 * 2048) + noise(2048) + "x"
    assert judge(text)[0] and judge(text)[4:] == (8, 2)


def test_full_chunks_still_reject_alone():
    # A quarter of the full chunks is bad, a little less than a quarter of all bytes.
    assert not judge(noise(2048) + prose(3 * 2048 + 100))[0]
