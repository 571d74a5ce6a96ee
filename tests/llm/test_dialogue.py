"""Repair of conversations against a plain search over all edits."""

import itertools
import random
import re
import zlib
from hashlib import sha256

import pytest

from sitebooks.llm import dialogue, queries
from sitebooks.llm.common import ready

WORD = re.compile(r"[^\x20\x09-\x0D]")
AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """Cost, letters and lines of the cheapest repair of (role, text, fault) rows: from the back, all edits from all states."""
    best = {"": (0, "", ()), "a": (0, "", ())}  # behind the last row
    for row in [None, *reversed(rows)]:
        edited = dict(best) if row is None else {}
        if row is not None:
            role, text, fault = row
            more = 5 if fault == "truncated" else 0
            for state in ("", "s", "u", "a"):
                options = [(2, "D", state, ())]
                if fault not in ("blank", "duplicate"):
                    if (state, role[:1]) in (("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")):
                        options.append((more, "K", role[:1], (f"{role}:{text}",)))
                    to = AFTER[state]
                    options.append((1 + more, "R", to, (f"{'user' if to == 'u' else 'assistant'}:{text}",)))
                edited[state] = min(((c + best[t][0], w + best[t][1], line + best[t][2]) for c, w, t, line in options), key=lambda x: x[:2])
        now = {}
        for state in ("", "s", "u", "a"):  # any insertions before the row, then the row
            ways, to, lines = [edited[state]] if state in edited else [], state, ()
            for k in range(1, 4):
                to = AFTER[to]
                lines += ("user:" if to == "u" else "assistant:",)
                if to in edited:
                    c, w, rest = edited[to]
                    ways.append((5 * k + c, "I" * k + w, lines + rest))
            now[state] = min(ways, key=lambda x: x[:2])
        best = now
    return best[""]


def plain(rows):
    """The contract, conversation by conversation."""
    out, by_conv = [], {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, role, text))
    for conv, turns in by_conv.items():
        left = []
        for turn, role, text in turns:
            role, text = " " if role is None else role, " " if text is None else text
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            luck = zlib.crc32(key.encode()) % 20
            if luck == 0:
                continue
            text = "" if luck == 1 else re.sub("[.!?]", "", text) if luck == 2 else text
            role = "user" if luck == 4 else role
            left += [(turn, role, text)] * (2 if luck == 3 else 1)
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        known = [r[0] for r in left if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        seen, rows_, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in left:
            words = WORD.findall(text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None
            seen.add((role, text))
            counts[fault] = counts.get(fault, 0) + 1
            rows_.append((role, text, fault))
        initials = [r[0][:1] for r in rows_]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, lines = cheapest(tuple(rows_)) if rows_ else (0, "", ())
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r))


def check(spark, rows, **sizes):
    frame = ready(spark).createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, edits string").repartition(3)
    found = dialogue.digest(dialogue.repaired(frame, **sizes), frame)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = sorted(map(tuple, found.collect()), key=lambda r: (r[0] is not None, r))
    for mine, theirs in zip(got, plain(rows)):
        assert mine == theirs
    assert len(got) == len(plain(rows))


ROLES = ["user", "assistant", "system", "u", "sys", "tool", "", " ", None]
TEXTS = ["Yes.", "No!", "Why?", "cut off", "", " \t\n", "one. two", None, "é.", "Yes. ", "x" * 3000 + "."]


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(11)
    rows = []
    for conv in [None, *range(150)]:
        turns = rng.choice(([0, 1, 2, 3], list(range(12)), [None, 5, 5, 7, 7, None, 9], [3], list(range(0, 60, 3)), [None, None]))
        for i, turn in enumerate(turns):
            clean = rng.random() < 0.6
            role = ("user", "assistant")[i % 2] if clean else rng.choice(ROLES)
            rows.append((conv, turn, role, rng.choice(TEXTS[:3]) + f" {i}." if clean else rng.choice(TEXTS)))
    rows += rows[:40]
    rng.shuffle(rows)
    return rows


def test_equals_a_plain_search(spark, talks):
    check(spark, talks)


def test_conversations_over_many_segments(spark, talks):
    rng = random.Random(2)
    long = [(7000, i // 3, rng.choice(ROLES[:3]), rng.choice(TEXTS)) for i in range(400)]
    check(spark, talks[:200] + long + [(7001, 4, "user", "Same.")] * 60, most=5, lattice=3)


def test_no_rows_left_and_no_rows(spark):
    dropped = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    check(spark, [(dropped, 0, "user", "Gone."), (dropped, 0, "user", "Gone."), (None, None, None, None)])
    check(spark, [])


@pytest.mark.parametrize("seed", range(6))
def test_auction_finds_the_least_word_of_least_cost(seed):
    rng = random.Random(seed)
    for _ in range(60):
        codes = bytes(rng.randrange(4) + rng.choice((0, 0, 4, 8)) for _ in range(rng.randrange(1, 40)))
        rows = tuple(("sua?"[c & 3], "t", "blank" if c & 4 else "truncated" if c & 8 else None) for c in codes)
        costs, ways = dialogue.solved(codes, dialogue.ENDS, rng.choice((1, 3, 24)))
        word, state = ways[dialogue.START]
        assert (costs[dialogue.START], word + dialogue.CLOSING[state]) == cheapest(rows)[:2]


def test_matrices_compose():
    rng = random.Random(9)
    codes = bytes(rng.randrange(4) + rng.choice((0, 0, 4, 8)) for _ in range(90))
    first, second = (dialogue.matrix(x) for x in (codes[:37], codes[37:]))
    whole = dialogue.matrix(codes)
    for a in range(4):
        for b in range(4):
            both = min(first[4 * a + k] + second[4 * k + b] for k in range(4))
            assert min(both, dialogue.FAR) == whole[4 * a + b]


def test_query_equals_the_contract(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, queries.op12_dialogue_repair(spark, sf_dir).collect()))
    assert got == plain(rows)
