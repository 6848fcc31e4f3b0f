import random

import pytest

WORDS = [f"w{i}x" for i in range(400)] + ["the", "of", "and", "gg", "wp", "mid", "ward", "é"]


def chatter(rng, n):
    out = []
    for i in range(n):
        out.append(rng.choice(WORDS) + rng.choice(["", "", "", "", ",", ".", ".\n"]))
    return " ".join(out)


def edge_rows():
    """(contest_id, transcript): nulls, empty and long texts, ties, repeated rows, exact and near copies."""
    rng = random.Random(3)
    base, long = chatter(rng, 120), chatter(rng, 6000)
    near = base.split(" ")
    near[60] = "changed"
    rows = [(i, chatter(rng, rng.randint(1, 150))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "   \n "), (53, "!!!"), (54, base), (55, base), (55, base), (56, base.upper().replace("É", "é")),
             (57, " ".join(near)), (58, long), (59, long[:9000] + " tail"), (None, base + " end"), (60, "gg"), (60, "gg"),
             (61, "aaaa" * 80), (62, "ab " * 200), (63, long + base), (64, "tab\tand\x1cseparator <|endoftext|> done")]
    return rows


@pytest.fixture(scope="session")
def transcripts(spark):
    """Transcripts with extra columns whose names clash with internal ones."""
    rows = [(c, t, "spot", 1, t) for c, t in edge_rows()]
    return spark.createDataFrame(rows, "contest_id long, transcript string, _row string, count int, _text string").repartition(3)


@pytest.fixture(scope="session")
def nothing(transcripts):
    return transcripts.limit(0)
