import itertools
import random

import pytest

from draftlake.operators import drafts, windows
from draftlake.operators.drafts import ERAS

MODERN = "BBBBBBBPPBBBPPPPPPBBBBPP"
CASES = [
    (MODERN, None, "7_33_plus"),
    ("BBBBBPPBBPPPPPPBBBBPP", None, "7_33_plus"),
    ("BBBBPPPPPPBBBBBBPPPP", None, "pre_7_30"),
    ("BBBBPPPPBBBBBBPPPPBBBBPP", None, "7_30_to_7_32"),
    ("PPPPPPPPPP", "length", None),
    ("PB" * 15, "length", None),
    (MODERN.replace("B", "P", 1), "pick_count", None),
    (MODERN[:7] + "BB" + MODERN[9:], "pick_count", None),
    ("PB" * 10, "pattern", "unknown"),
    (MODERN[:7] + MODERN[8:], "pick_count", None),
]


def frame(spark, codes, first_slot=0):
    rows = [(c, s + first_slot, x == "P", s, s % 2) for c, code in enumerate(codes) for s, x in enumerate(code)]
    return spark.createDataFrame(rows, "contest_id bigint, slot int, is_pick boolean, item_id int, side int")


def test_fixture_sequences(spark):
    got = {r["contest_id"]: r for r in drafts.validate_drafts(frame(spark, [c[0] for c in CASES])).collect()}
    for i, (code, fault, era) in enumerate(CASES):
        assert got[i]["code"] == code
        assert got[i]["fault"] == fault
        if era:
            assert got[i]["era"] == era


def test_far_slots_take_the_list(spark):
    codes = [MODERN, "BBBBPPPPPPBBBBBBPPPP"]
    near = {r["contest_id"]: (r["code"], r["digest"]) for r in drafts.validate_drafts(frame(spark, codes)).collect()}
    far = {r["contest_id"]: (r["code"], r["digest"]) for r in drafts.validate_drafts(frame(spark, codes, 50)).collect()}
    # Sides follow the slot number inside the draft, so the digest is the same too.
    assert near == far


def test_repeated_slot_is_flagged(spark):
    df = frame(spark, [MODERN])
    rows = drafts.draft_sequences(df.unionByName(df.limit(1))).collect()
    assert rows[0]["repeated_slot"]


def greedy(observed, pattern):
    """Independent statement of the rule: only bans of the pattern may be skipped."""
    if not observed:
        return False
    at = 0
    for step in pattern:
        if at == len(observed):
            break
        if observed[at] == step:
            at += 1
        elif step == "P":
            return False
    return at == len(observed)


FULL = {"7_33_plus": MODERN, "7_30_to_7_32": "BBBBPPPPBBBBBBPPPPBBBBPP", "pre_7_30": "BBBBPPPPPPBBBBBBPPPP"}


def test_patterns_equal_the_greedy_rule():
    import re
    rnd = random.Random(7)
    codes = ["".join(c) for n in range(1, 11) for c in itertools.product("BP", repeat=n)]
    for full in FULL.values():
        for _ in range(1500):
            drop = {i for i, x in enumerate(full) if x == "B" and rnd.random() < 0.3}
            code = "".join(x for i, x in enumerate(full) if i not in drop)
            codes += [code, code[: rnd.randrange(1, len(code))]]
    for name, _, whole, beginning in ERAS:
        for code in codes:
            assert bool(re.search(beginning, code)) == greedy(code, FULL[name]), (name, code)
            if code.count("P") == 10 and 16 <= len(code) <= 24:
                assert bool(re.search(whole, code)) == greedy(code, FULL[name]), (name, code)


@pytest.mark.parametrize("code,counts", [
    (MODERN, [7, 2, 3, 6, 4, 2]), ("BBBBBPPBBPPPPPPBBBBPP", [5, 2, 2, 6, 4, 2])])
def test_phase_numbers(spark, code, counts):
    rows = windows.derive_phases(frame(spark, [code])).orderBy("slot").collect()
    expected = [p for p, n in enumerate(counts) for _ in range(n)]
    assert [r["phase"] for r in rows] == expected
    names = ["ban_1", "pick_1", "ban_2", "pick_2", "ban_3", "pick_3"]
    assert [r["phase_name"] for r in rows] == [names[p] for p in expected]


def test_opening_pick_starts_at_one(spark):
    rows = windows.derive_phases(frame(spark, ["PPB"])).orderBy("slot").collect()
    assert [(r["phase"], r["phase_name"]) for r in rows] == [(1, "pick_1"), (1, "pick_1"), (2, "ban_2")]
