"""Faster forms of the decontamination's steps against plain ones."""

import numpy as np
import pytest

from etlkit.llm import decontaminate


@pytest.mark.parametrize("n", [1, 2, 300, 20_000])
def test_words_are_looked_up_by_their_upper_bits(n):
    rng = np.random.default_rng(n)
    known = np.unique(np.concatenate([rng.integers(0, 1 << 64, n, np.uint64), np.arange(n // 2, dtype=np.uint64) + np.uint64(7 << 50), [np.uint64((1 << 64) - 1)]]).astype(np.uint64))
    hashes = np.concatenate([known, known + np.uint64(1), rng.integers(0, 1 << 64, 5000, np.uint64), np.array([0], np.uint64)])
    plain = np.searchsorted(known, hashes)
    plain[known[np.minimum(plain, len(known) - 1)] != hashes] = len(known)
    assert (decontaminate.Vocabulary(known)(hashes) == plain).all()


@pytest.mark.parametrize("n, m", [(1, 1), (3, 5), (700, 9), (811, 713)])
def test_near_vectors_with_few_hits(n, m):
    rng = np.random.default_rng(n)
    vectors, known = rng.normal(size=(n, 6)).astype(np.float32), rng.normal(size=(m, 6)).astype(np.float32)
    near = np.concatenate([(vectors[i:i + max(1, decontaminate.CLOSE // m)] @ known.T) for i in range(0, n, max(1, decontaminate.CLOSE // m))])
    for least in (-100, 4, 100):
        cosine, p, q = decontaminate._near(vectors, known, least)
        assert list(zip(p, q)) == [tuple(x) for x in np.argwhere(near >= least)] and np.allclose(cosine, near[p, q], rtol=1e-5)


def test_regions_hold_the_words_of_any_stretch():
    word = np.random.default_rng(3).integers(0, 40, 900)
    bits = decontaminate.word_bits(40)
    regions = decontaminate.Regions(word, bits, 150)
    start = np.repeat(np.arange(0, 740, 7), 150)
    end = start + np.tile(np.arange(1, 151), 106)
    whole = np.array([np.bitwise_or.reduce(bits[word[a:b]]) for a, b in zip(start, end)])
    assert ((regions(start, end) & whole) == whole).all()
