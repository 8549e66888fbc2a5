import hashlib
import random
import re
import sys
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest

from tripflow.llm import conversations as C
from tripflow.llm.four_russians import SYMBOLS, Tables

PATTERN = re.compile("(s?(ua)+)?")


def cheapest(rows):
    """(cost, audit) by trying everything: rows are (initial, must go, truncated)."""

    @lru_cache(None)
    def rest(i, state, inserted=0):
        # States of (s?(ua)+)? by what stands so far: "", "s", "...u", "...a".
        moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
        options = [(0, "")] if i == len(rows) and state in ("", "a") else []

        def take(edit, cost, *then):
            c, a = rest(*then)
            options.append((cost + c, edit + a))

        if i < len(rows):
            initial, gone, cut = rows[i]
            take("D", 4, i + 1, state)
            if not gone and (state, initial) in moves:
                take("K", 3 * cut, i + 1, moves[state, initial])
            for new in "ua":
                if not gone and (state, new) in moves:
                    take("R", 3 + 3 * cut, i + 1, moves[state, new])
        for new in "ua":
            if inserted < 4 and (state, new) in moves:
                take("I", 3, i, moves[state, new], inserted + 1)
        return min(options, default=(10**6, ""))

    return rest(0, "")


def expected(rows, everyone):
    """The query's rows by plain loops; ``rows`` after damage."""
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn, role, text))
    out = {}
    for conv in everyone:
        here = sorted(by_conv[conv], key=lambda r: (r[0] is not None, r[0] or 0))
        turns = [t for t, _, _ in here if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults, symbols = set(), [], []
        for _, role, text in here:
            last = text.rstrip(" \t\n\x0b\f\r")[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
            symbols.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(here, here[1:]))
        cost, audit = cheapest(tuple(symbols))
        lines, state, left = [], "", list(here)
        for edit in audit:
            if edit != "I":
                _, role, text = left.pop(0)
            else:
                role, text = "", ""
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if state == "u" else "user"
            state = role[0]
            lines.append((role, text))
        assert not left and PATTERN.fullmatch("".join(r[0] for r, _ in lines))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (conv, gaps, *counts, illegal, cost, audit, digest)
    return out


def hurt(rows):
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text, dice = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        if dice == 0:
            continue
        text = "" if dice == 1 else re.sub("[.!?]", "", text) if dice == 2 else text
        yield from [(conv, turn, "user" if dice == 4 else role, text)] * (1 + (dice == 3))


@pytest.mark.parametrize("block", [1, 2, 3, 4])
def test_tables_against_trying_everything(block):
    draw, tables = random.Random(block), Tables(block)
    strings = [np.array([draw.randrange(SYMBOLS) for _ in range(n)], np.int64) for n in [*range(14)] * 25]
    audits, costs = tables.repair(strings)
    for string, audit, cost in zip(strings, audits, costs):
        rows = tuple(("sua "[(s - 1) // 2] if s else "x", s == 0, bool(s and (s - 1) % 2)) for s in string.tolist())
        assert (cost, audit) == cheapest(rows)


def test_no_strings():
    assert Tables().repair([]) == ([], pytest.approx(np.zeros(0)))
    audits, costs = Tables().repair([np.zeros(0, np.int64)])
    assert audits == [""] and costs.tolist() == [0]


def conversations(seed, n):
    draw = random.Random(seed)
    texts = ["Hello.", "Hello.", "Yes!", "no end", " ", "", "\x0b\t", "Été?  \n", "A very common turn.", " ", "x. "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "User"]
    rows = []
    for conv in range(n):
        for turn in range(draw.randint(1, 12)):
            usual = ["user", "assistant"][turn % 2]
            role = usual if draw.random() < 0.7 else draw.choice([*roles, None])
            text = f"Turn {turn} of {conv}." if draw.random() < 0.5 else draw.choice([*texts, None])
            rows.append((conv if conv else None, turn * draw.choice([1, 1, 1, 3]) if draw.random() < 0.95 else None, role, text))
    # Turns that tie are put in order by a digest, which plain loops can't know: keep one row of each.
    return list({(r[0], r[1]): r for r in rows}.values())


SCHEMA = "conv_id long, turn long, role string, text string"


def test_query_against_plain_loops(spark, tmp_path):
    rows = conversations(4, 120)
    long = [(500, t, ["user", "assistant"][t % 2], "words and words. " * 20_000) for t in range(4)]
    many = [(501, t, "user" if t % 3 else "assistant", f"Row {t % 700}" + "." * (t % 2)) for t in range(1500)]
    equal = [(502, 3, "user", "One text.")] * 30
    rows += long + many + equal + [(600 + i, 0, "user", "Alone.") for i in range(60)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], f"{SCHEMA}, audit string").repartition(4)
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    found = C.op12_conversation_repair(spark, str(tmp_path))
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    sys.setrecursionlimit(20_000)
    want = expected(list(hurt(rows)), {r[0] for r in rows})
    got = found.collect()
    assert len(got) == len(want)
    empty = hashlib.sha256(b"").hexdigest()
    assert any(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", empty) for r in got)  # all rows dropped
    for r in got:
        assert tuple(r) == want[r["conv_id"]]


def test_rows_after_repair(spark):
    rows = [("a", 0, "user", "Hi."), ("a", 1, "user", "Hi."), ("a", 2, "system", "Be kind"), ("a", 3, "user", "So?"), ("b", 0, "tool", "")]
    frame = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    plans = C.plan_repairs(frame)
    found = {r["conv_id"]: r["audit"] for r in plans.collect()}
    assert found == {"a": "KDDR", "b": "D"}
    after = C.repaired(frame, plans).orderBy("conv_id", "place").collect()
    assert [tuple(r) for r in after] == [("a", 0, "user", "Hi.", "K"), ("a", 1, "assistant", "So?", "R")]


def test_a_conversation_in_many_partitions(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Row {t}.") for t in range(3000)] + [(2, 0, "user", "x.")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    plans = {r["conv_id"]: r for r in C.plan_repairs(frame).collect()}
    assert plans[1]["audit"] == "K" * 3000 and plans[1]["gaps"] == 0
    assert (plans[2]["audit"], plans[2]["cost"]) == ("KI", 3)
    after = C.repaired(frame, C.plan_repairs(frame)).where("conv_id = 2").orderBy("place").collect()
    assert [tuple(r) for r in after] == [(2, 0, "user", "x.", "K"), (2, 1, "assistant", "", "I")]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert C.op12_conversation_repair(spark, str(tmp_path)).collect() == []
