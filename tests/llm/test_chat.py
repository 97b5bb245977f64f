"""Collapsing of logs against comparing all beginnings, and odd inputs."""

from __future__ import annotations

import random

from creditledger.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    logs = {}
    for c, t, r, x in set(rows):
        logs.setdefault(c, []).append((t is not None, t or 0, r or "", x or "", r, x))
    logs = {c: sorted(v) for c, v in logs.items()}
    kept = set()
    for c, own in logs.items():
        longer = any(len(o) > len(own) and o[: len(own)] == own for o in logs.values())
        copies = [d for d, o in logs.items() if o == own]
        if not longer and c == min(copies):
            kept.add(c)
    return {
        c: "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for _, _, r, x, _, _ in logs[c]) for c in kept
    }


def rendered(spark, rows):
    out = {}
    for r in chat.collapse_and_render(spark.createDataFrame(rows, SCHEMA)).orderBy("part").collect():
        out[r.conv_id] = out.get(r.conv_id, "") + r.rendered
    return out


def test_snapshots_collapse(spark):
    rng = random.Random(3)
    rows, number = [], 0
    for _ in range(30):
        turns = [(t, rng.choice(["user", "assistant"]), rng.choice("abc")) for t in range(rng.randrange(1, 9))]
        for size in {len(turns), *[rng.randrange(1, len(turns) + 1) for _ in range(3)]}:
            rows += [(number, *t) for t in turns[:size]]
            number += 1
    assert rendered(spark, rows) == brute(rows)


def test_long_logs_go_over_blocks(spark):
    long = [(1, t, "user", str(t)) for t in range(2500)]
    rows = long + [(2, *r[1:]) for r in long[:2000]] + [(3, *r[1:]) for r in long[:1999]] + [(3, 1999, "user", "other")]
    out = rendered(spark, rows)
    assert set(out) == {1, 3}
    assert out[1] == "".join(f"<|im_start|>user\n{t}<|im_end|>\n" for t in range(2500))


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "a"),
        (1, 0, "user", "a"),
        (2, 0, "user", "a"),
        (3, 0, None, None),
        (4, 0, "", ""),
        (5, None, "user", "x"),
        (5, 0, "user", "y"),
        (6, 0, "user", "b"),
        (6, 0, "tool", "c"),
        (6, 1, "user", "d"),
    ]
    out = rendered(spark, rows)
    assert out[1] == "<|im_start|>user\na<|im_end|>\n"
    assert 2 not in out and {3, 4} <= set(out)
    assert out[5].index("x") < out[5].index("y")
    assert out[6].index("tool") < out[6].index("user")


def test_null_ids_and_empty_tables(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "user", "b"), (1, 0, "user", "a")]
    assert set(rendered(spark, rows)) == {None}
    empty = spark.createDataFrame([], SCHEMA + ", part string, n long")
    assert chat.collapse_and_render(empty).count() == 0


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], SCHEMA)
    plan = chat.render(df)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "ArrowEval"))


def test_copies_are_not_collected(spark):
    text = "x" * 3000
    copies = spark.range(800_000).selectExpr("1L AS conv_id", "0L AS turn", "'user' AS role", f"'{text}' AS text")
    (row,) = chat.render(copies.coalesce(1)).collect()
    assert row.n_turns == 1 and row.rendered == f"<|im_start|>user\n{text}<|im_end|>\n"


def test_rows_without_a_number_are_many_ranges(spark):
    own = [(1, None, "user", f"t{k}") for k in range(3000)] + [(1, 7, "user", f"u{k}") for k in range(3000)]
    rows = own + [(2, *r[1:]) for r in sorted(own, key=lambda r: (r[1] is not None, r[3]))]
    rows += [(3, None, "user", "again")] * 5000 + [(None, None, "tool", f"v{k}") for k in range(2000)]
    ranges = chat.ranged(spark.createDataFrame(rows, SCHEMA)).groupBy("conv_id", "block").count().collect()
    assert sum(r["count"] for r in ranges) == 14001
    assert max(r["count"] for r in ranges) < 2900
    assert rendered(spark, rows) == brute(rows)


def test_a_text_holds_a_block_of_turns_whatever_their_numbers(spark):
    """A third of all rows: one log, half of it without a number, half with one and the same."""
    beginning = "the same beginning of many texts, longer than what ranges are drawn by, "
    own = [(1, k % 2 or None, "user", f"{beginning * (k % 3)}{k}") for k in range(5000)]
    lost = [(None, 4, "tool", f"v{k % 1500}") for k in range(4000)]
    rows = own + lost + [(k, 0, "user", f"w{k}") for k in range(2, 6000)]
    out = chat.collapse_and_render(spark.createDataFrame(rows, SCHEMA)).collect()
    sizes = {(r.conv_id, r.part): r.n_turns for r in out}
    assert [sizes[1, p] for p in range(5)] == [1024] * 4 + [904]
    assert [sizes[None, p] for p in range(2)] == [1024, 476]
    assert len(sizes) == 7 + 5998
    assert rendered(spark, own + lost) == brute(own + lost)
