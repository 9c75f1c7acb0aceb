"""Invented prose for the tests."""

import random


def prose(seed: int, n: int) -> str:
    """Deterministic invented prose without repeated three-word runs to speak of."""
    r = random.Random(seed)
    return " ".join("".join(r.choice(("ka", "lo", "mi", "ra", "te", "su", "ve", "no")) for _ in range(r.randint(1, 4))) for _ in range(n))
