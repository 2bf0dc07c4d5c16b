"""Repairs against a search over all edits, charts against all ways to split, and odd rows."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from ledgerloom.llm import conversation_repair as cr

SCHEMA = "conv_id bigint, turn bigint, role string, text string, cost string, place string, copies string"
GOOD = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    """The contract's damage, row by row."""
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        if kind:
            yield from [(conv, turn, role, text)] * (2 if kind == 3 else 1)


def judged(rows):
    """Whether each row must go and whether it is truncated, with the counts of faults."""
    seen, out, counts = set(), [], [0, 0, 0]
    for _, _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        blank, again = not body, (role, text) in seen
        seen.add((role, text))
        cut = not blank and not again and body[-1] not in ".!?"
        counts[0 if blank else 1 if again else 2] += blank or again or cut
        out.append((blank or again, cut))
    return out, counts


def cheapest(rows, marks):
    """The least (cost, audit), by a best-first search over rows read and roles written."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, kept = heapq.heappop(heap)
        if at == len(rows) and GOOD.fullmatch(roles):
            return cost, audit, kept
        # Only the start and the last role matter for what may follow.
        if (at, roles[:1] == "s" and len(roles) == 1, roles[-1:]) in done:
            continue
        done.add((at, roles[:1] == "s" and len(roles) == 1, roles[-1:]))

        def go(more, edit, step, role, line, cost=cost, audit=audit, roles=roles, kept=kept):
            if role is None:
                heapq.heappush(heap, (cost + more, audit + edit, step, roles, kept))
            elif re.fullmatch(r"s|s?(ua)*u?", roles + role):
                heapq.heappush(heap, (cost + more, audit + edit, step, roles + role, (*kept, line)))

        for role in ("user", "assistant"):
            go(2, "I", at, role[0], f"{role}:")
        if at < len(rows):
            (_, _, role, text), (gone, cut) = rows[at], marks[at]
            go(3, "D", at + 1, None, None)
            if not gone:
                if role:
                    go(cut, "K", at + 1, role[0], f"{role}:{text}")
                for new in ("user", "assistant"):
                    go(2 + cut, "R", at + 1, new[0], f"{new}:{text}")


def plain(rows):
    out = []
    for conv in {r[0] for r in rows}:
        mine = list(damaged(r for r in rows if r[0] == conv))
        mine.sort(key=lambda r: (r[1] is not None, r[1], r[2], hashlib.md5(r[3].encode()).digest()))
        marks, counts = judged(mine)
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        bad = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        cost, audit, kept = cheapest(mine, marks)
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((conv, min(gaps, 2**63 - 1), *counts, bad, cost, audit, digest))
    return sorted(map(repr, out))


def found(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(4)
    return sorted(repr(tuple(r)) for r in cr.repair(df, cr.damage(df)).collect())


def talk(rng, conv, length):
    texts = ["Yes.", "no", "Why?", " ", "", "so.  \n", "a. b", None, f"t{rng.random()}."]
    roles = ["user", "assistant"] * 4 + ["system", "tool", "", None, "umpire"]
    return [(conv, rng.choice([t, t, t, t + 3]), rng.choice(roles), rng.choice(texts)) for t in range(length)]


def test_equals_the_search(spark):
    rng = random.Random(9)
    rows = [row for conv in range(150) for row in talk(rng, conv, rng.randrange(1, 14))]
    assert found(spark, rows) == plain(rows)


@pytest.mark.parametrize("length", [64, 65, 700])
def test_long_conversations(spark, length):
    rng = random.Random(length)
    rows = talk(rng, 3, length) + talk(rng, 4, 2)
    rows += [(5, t, ("user", "assistant")[t % 2], f"Line {t}.") for t in range(length)]
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi.")]
    rows += [(1, None, "user", "Hi."), (1, None, "user", "Hi."), (1, -5, "assistant", "So."), (1, 2**62, "user", "x" * 500_000)]
    rows += [(2, -(2**63), "s", "."), (2, 2**63 - 1, "ä", "é!")]
    rows += [(7, 4, "user", "One.")] * 40
    rows += [(8, t, "", "") for t in range(5)]
    assert found(spark, rows) == plain(rows)
    none = spark.createDataFrame([], SCHEMA)
    assert cr.repair(none, cr.damage(none)).collect() == []


def test_conversations_without_rows_left(spark):
    lost = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert found(spark, [(lost, 0, "user", "Hi.")]) == [repr((lost, 0, 0, 0, 0, 0, 0, "", empty))]


def test_joined_blocks_equal_the_chart():
    rng = random.Random(1)
    for _ in range(60):
        cells = [
            cr.row_cells(rng.choice(["s", "u", "a", "t", ""]), rng.random() < 0.2, rng.random() < 0.3, rng.choice([1, 1, 3]))
            for _ in range(rng.randrange(1, 12))
        ]
        whole = cr.parsed(cells)
        at = sorted(rng.sample(range(1, len(cells)), min(2, len(cells) - 1)))
        parts = [cells[a:b] for a, b in zip([0, *at], [*at, len(cells)], strict=True)]
        assert cr.joined([cr.parsed(p) for p in parts]) == whole
