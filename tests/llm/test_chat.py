"""Perspective rotation against a plain rendering."""
import random
from collections import defaultdict

import pytest

from covtab.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def render(rows):
    """``(conv, perspective) -> [(speaker, segment, trained)]``."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        speaker = (role or "").strip(" ") or chat.UNNAMED
        by[conv].append((turn is not None, turn or 0, speaker, text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        for p in {t[2] for t in turns if t[2] != "system"}:
            out[conv, p] = [
                (s, (chat.ASSISTANT_HEAD if s == p else chat.SYSTEM_HEAD if s == "system"
                     else chat.USER_HEAD.format(s)) + words + chat.END,
                 words + chat.END if s == p else "") for _, _, s, words in turns]
    return out


def check(spark, rows, **parameters):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS position", "'x' AS segment")
    got = defaultdict(list)
    for r in chat.rotate(df, **parameters).collect():
        got[r.conv_id, r.perspective].append(r)
    want = render(rows)
    assert got.keys() == want.keys()
    for key, segments in got.items():
        segments.sort(key=lambda r: r.position)
        assert [r.position for r in segments] == list(range(len(segments)))
        whole = "".join(r.segment for r in segments)
        assert [(r.speaker, whole[r.start:r.end], whole[r.mask_start:r.mask_end])
                for r in segments] == want[key]


@pytest.mark.parametrize("block_turns", [1, 3, 256])
def test_rendering_masks_and_places(spark, block_turns):
    rng = random.Random(block_turns)
    rows = [(c, t, rng.choice(["ann", "bob", "cy", "system", None, " "]),
             rng.choice(["", None, "hi", "été \U0001f600\nline"]))
            for c in range(5) for t in range(11)]
    rows += [(9, t, rng.choice("abcd"), f"turn {t}") for t in range(120)]  # a hot one
    rows += [(2, 3, "ann", "tie"), (2, 3, "ann", "tie"), (2, None, "bob", "null turn")]
    rows += [(None, 0, "ann", "null conversation")]
    rows += [(7, 0, "system", "alone")]
    check(spark, rows, block_turns=block_turns)


def test_empty_table(spark):
    check(spark, [])


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, 0, "a", "x")], SCHEMA)
    plan = chat.rotate(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_turns_without_a_conversation_id_are_one_conversation(spark):
    rows = [(None, t, "abs"[t % 3], f"turn {t}") for t in range(9)]
    rows += [(None, None, None, None), (None, 3, "system", "rules")]
    check(spark, rows + [(0, t, "ab"[t % 2], f"other {t}") for t in range(4)], block_turns=4)
