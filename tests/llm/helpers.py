"""Texts for tests."""


def sentence(rng, n, vocab=3000):
    return " ".join(f"w{rng.integers(vocab)}" for _ in range(n))
