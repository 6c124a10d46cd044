import numpy as np
import pytest
from statsheet.llm.hashing import FIXED_BASE, LONGEST, PRIME, Hasher, draw, hasher, times
from test_near_dedup import thue_morse


def test_products_modulo_the_prime():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, PRIME, (2, 5000), np.uint64)
    a[:3], b[:3] = [PRIME - 1, 0, PRIME - 1], [PRIME - 1, PRIME - 1, 1]
    assert times(a, b).tolist() == [int(x) * int(y) % PRIME for x, y in zip(a, b)]


def test_sums_and_windows():
    d = np.random.default_rng(2).integers(0, 256, 3000).astype(np.uint8)
    for base in (FIXED_BASE, draw()):
        h = Hasher(base)
        sums, total = h.prefix(d), 0
        for i, c in enumerate(d.tolist()):
            assert sums[i] == total
            total = (total + (c + 1) * pow(base, i, PRIME)) % PRIME
        two = np.concatenate((d[100:300], d))
        assert (h.windows(h.prefix(two), 50)[200:] == h.windows(sums, 50)).all()
        assert (h.ranges(sums, np.array([7]), np.array([57])) == h.windows(sums, 50)[7]).all()
    full = hasher(FIXED_BASE).prefix(np.full(LONGEST - 1, 255, np.uint8))
    assert int(full[-1]) == 256 * (pow(FIXED_BASE, LONGEST - 1, PRIME) - 1) * pow(FIXED_BASE - 1, -1, PRIME) % PRIME
    with pytest.raises(ValueError):
        hasher(FIXED_BASE).prefix(np.zeros(LONGEST, np.uint8))


def test_built_strings_differ():
    h = hasher(FIXED_BASE)
    for n in (64, 1024, 4096):
        one, two = (np.frombuffer(thue_morse(n, *x).encode(), np.uint8) for x in ("ab", "ba"))
        assert (h.windows(h.prefix(one), n) != h.windows(h.prefix(two), n)).all()
