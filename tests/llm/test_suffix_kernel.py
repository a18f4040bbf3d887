import numpy as np
import pytest

from chargeplan.llm.common import ByteHash
from chargeplan.llm.suffix_dedup import permuted_lcp, repeated_windows, suffix_array


@pytest.mark.parametrize("seed", range(12))
def test_suffix_array_and_lcp_equal_sorting(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 400))
    text = rng.integers(1, int(rng.choice([2, 3, 5, 200])), n).astype(np.uint8)
    if seed % 3 == 0:
        text = np.concatenate([text[:50]] * 6)
    s = np.append(text, 0).astype(np.uint8)
    want = sorted(range(len(s)), key=lambda i: s[i:].tobytes())
    sa = suffix_array(text, ByteHash(lower=False))
    assert sa.tolist() == want
    phi, plcp = permuted_lcp(s, sa)
    for a, b in zip(want, want[1:]):
        k = 0
        while s[a + k] == s[b + k] and max(a, b) + k + 1 < len(s):
            k += 1
        assert phi[b] == a and plcp[b] == k


def test_windows_do_not_cross_contexts():
    h = ByteHash(lower=False)
    a, b = b"x" * 10 + b"hello world, hello", b"hello world, hi"
    got = repeated_windows([a, b], 12, h)
    assert got[0].tolist() == [10 <= i <= 12 for i in range(len(a) - 11)]
    assert got[1].tolist() == [i <= 2 for i in range(len(b) - 11)]
