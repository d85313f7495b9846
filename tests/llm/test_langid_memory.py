"""The driver's memory while languages are learned."""

import tracemalloc

import numpy as np

from ledgerline.llm.langid import DIMS, LanguageModel


def test_learning_holds_the_sample_twice_at_most():
    """Beside the sample, training keeps one index and one value per n-gram: no counts and no unscaled copy."""
    rng = np.random.default_rng(1)
    sample = []
    for lang in ("de", "en"):
        for _ in range(400):
            at = np.sort(rng.choice(3 * DIMS, 1500, replace=False))
            sample.append((lang, np.stack([at, rng.integers(1, 9, 1500)], axis=1).astype("<u4").tobytes()))
    tracemalloc.start()
    try:
        LanguageModel(["de", "en"], sample)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 3.2 * sum(len(b) for _, b in sample)
