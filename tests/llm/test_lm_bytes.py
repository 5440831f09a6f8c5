import numpy as np

from locusloom.llm import lm_scoring as lm


def test_hashes_and_counts_come_back_in_fewer_bytes():
    rng = np.random.default_rng(3)
    h = np.unique(rng.integers(0, 1 << 56, 20_000, np.uint64))
    assert (lm._from_steps(lm._steps(h)) == h).all() and len(lm._steps(h)) < 6.1 * len(h)  # seven bytes each before
    for x in (np.zeros(0, np.uint64), h[:1], np.array([0, 2**64 - 1], np.uint64)):
        assert (lm._from_steps(lm._steps(x)) == x).all()
    for c in (np.zeros(0, np.int64), np.zeros(3, np.int64), np.array([1, 255, 256, 70_000, 2**40])):
        assert (lm._from_small(lm._small(c)) == c).all()
