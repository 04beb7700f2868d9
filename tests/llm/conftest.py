import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def words():
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    return ["".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(900)]


@pytest.fixture(scope="session")
def odd_texts():
    """Texts that break things: missing, empty, blank, other scripts, very long, without blanks."""
    return [None, "", " ", "\n\t\x0b ", "a", "漢字かな交じり文", "\u0000x", "é" * 3, "word " * 30_000,
            "x" * 20_000, "▁▁ a  b ", "🙂🙂 ok", "a b", "a b", "a  b", "a\tb"]
