from __future__ import annotations

import pytest

#: Null and empty texts, a repeated row, ties, copies, a long text and other columns with odd names.
WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe", "ri", "so", "tu") for b in ("ba", "do", "fe", "gi", "ho", "ju")]


def prose(seed: int, n: int) -> str:
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ","]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    base = prose(1, 120)
    near = base.split()
    near[60] = "other"
    return [
        (0, None), (1, ""), (2, "   \n\t "), (3, "one two"), (4, "one two"), (5, base), (6, base), (7, " ".join(near)), (8, prose(2, 6000)), (9, base.upper()), (10, prose(3, 4)),
        (11, prose(4, 90)), (11, prose(4, 90)), (12, prose(5, 80) + " " + prose(6, 70)), (13, prose(7, 50) + " " + prose(6, 70) + " " + prose(8, 40)), (None, "a null id here too"), (14, "日本語 のテキスト です ね はい"), (15, "x" * 5000),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows with columns whose names operators might want for themselves."""
    return spark.createDataFrame([(i, t, "en", "s", 1, "a", 2) for i, t in odd_rows], "doc_id long, text string, lang string, source string, n long, shard string, spans int").repartition(3)
