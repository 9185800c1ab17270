import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))



@pytest.fixture(scope="session")
def odd_rows():
    """NULLs, empty and blank texts, one word, long texts, repeated rows, ties, other scripts."""
    rng = random.Random(11)
    words = ["Alpha", "beta", "Gamma", "é", "É", "x1", "the", "of", "日本", "🙂"]
    text = lambda n: " ".join(rng.choices(words, k=n))
    base = text(60)
    return [
        (None, None), (None, "null id"), (None, base), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "word"), (5, "Word"),
        (6, base), (7, base), (7, base), (8, base.replace(" ", "  ")), (9, base + " "), (10, base[: len(base) // 2]),
        (11, text(15_000)), (12, "a" * 50_000), (13, "\x00<|endoftext|> <s> ▁   x"), (14, base.lower()), (15, base.upper()),
        (-3, base + " tail"), (2**62, "the of " * 40), (16, "the of"),
    ]
