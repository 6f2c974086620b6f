"""Conversation repair against a row-by-row search, whole enumeration and odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from barlake.llm import conversations as C

BLANK = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit) of rows (initial, must go, truncated), one row at a time."""
    def settle(best):
        for _ in range(2):  # at most two insertions in a row are of use
            for p, (cost, audit) in list(best.items()):
                q = {"": "u", "s": "u", "a": "u", "u": "a"}[p]
                best[q] = min(best.get(q, (1 << 60, "")), (cost + 2, audit + "I"))
        return best
    best = settle({"": (0, "")})
    for initial, gone, late in rows:
        now = {}
        for p, (cost, audit) in best.items():
            options = [(p, 3, "D")]
            if not gone:
                want = {"": "u", "s": "u", "a": "u", "u": "a"}[p]
                options.append((want, 2 + late, "R"))
                if initial == want or (initial == "s" and p == ""):
                    options.append((initial, late, "K"))
            for q, more, edit in options:
                now[q] = min(now.get(q, (1 << 60, "")), (cost + more, audit + edit))
        best = settle(now)
    return min(best[p] for p in ("", "a") if p in best)


def plain(table):
    """Results of (conv, turn, role, text) rows, conversation by conversation."""
    out = {}
    by = {}
    for conv, turn, role, text in table:
        by.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        role, text = ("user" if k == 4 else role), ("" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)
        by[conv] += [(turn, role, text)] * (2 if k == 3 else 1)
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in rows:
            bare = text.rstrip(BLANK)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen
                          else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in rows]
        cost, audit = cheapest([(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults, strict=True)])
        left, said, last = iter(rows), [], ""
        for edit in audit:
            want = "assistant" if last == "u" else "user"
            if edit == "I":
                said.append((want, ""))
            else:
                _, role, text = next(left)
                if edit == "D":
                    continue
                said.append((role if edit == "K" else want, text))
            last = said[-1][0][0]
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in said))
        turns = [t for t, _, _ in rows if t is not None]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in (
            "blank", "duplicate", "truncated")], sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest())
    return out


def found(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def as_rows(df):
    return [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()]


def test_all_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    want = plain(as_rows(df))
    assert found(C.damaged_and_repaired(df)) == want
    assert found(C.damaged_and_repaired(df, block_symbols=3, block_chars=1_000)) == want


def odd_table():
    rnd = random.Random(5)
    texts = ["Fine.", "cut off", "", "  \n", "Why? ", "Yes!\t", None, "é世🙂."]
    roles = ["user", "assistant", "system", "tool", "", None, "s", "User", "ua"]
    rows = [(c, rnd.choice([None, 0, 1, 2, 3, 7]), rnd.choice(roles), rnd.choice(texts))
            for c in (None, 1, 2, 3, -4) for _ in range(rnd.randint(1, 30))]
    rows += [(10, t, "user" if t % 2 == 0 else "assistant", f"Turn {t % 300}.") for t in range(4_000)]  # one long conversation
    rows += [(11, 5, "user", "Again and again.")] * 3_000 + [(12, 1, "user", "long text " * 50_000)]
    rows += [(c, 0, "user", "One.") for c in range(100, 160)]  # some lose their only row
    return rows


def test_odd_rows(spark):
    rows = odd_table()
    want = plain(rows)
    assert any(w[5] == 0 and w[6] == "" for w in want.values())
    df = spark.createDataFrame([(*r, 1, 1, "x") for r in rows],
                               "conv_id long, turn long, role string, text string, conv int, n int, cls string")
    for blocks in ({}, {"block_symbols": 100, "block_chars": 5}):
        assert found(C.damaged_and_repaired(df, **blocks)) == want
    assert C.damaged_and_repaired(df.limit(0)).collect() == []


def test_every_short_sequence():
    """All sequences of up to three symbols, against the search over single rows."""
    for size in range(4):
        for seq in itertools.product(range(C.SYMBOLS), repeat=size):
            matrix = C.evaluate([bytes(seq)])[bytes(seq)]
            rows = [("sua-"[s // 2] if s != C.GONE else "u", s == C.GONE, s % 2 if s != C.GONE else 0) for s in seq]
            assert C.finish(C.times_vector(C.unit(C.START), matrix)) == cheapest(rows)


@pytest.mark.parametrize("seed", range(3))
def test_grammar_gives_the_sequences_back(seed):
    rnd = random.Random(seed)
    seqs = [bytes(rnd.choices(range(C.SYMBOLS), weights=[1, 1, 9, 1, 9, 1, 1, 1, 3], k=rnd.randint(0, 60))) for _ in range(80)]
    seqs += [bytes([8]) * 1_001, b""]
    rules, short = C.re_pair([np.frombuffer(s, np.uint8) for s in seqs])

    def expand(s):
        return [s] if s < C.SYMBOLS else [x for y in rules[s - C.SYMBOLS] for x in expand(y)]
    assert [bytes(x for s in seq for x in expand(s)) for seq in short] == seqs
    assert sum(map(len, short)) + 2 * len(rules) < sum(map(len, seqs))
    matrices = C.evaluate(seqs)
    for s in seqs:
        rows = [("sua-"[x // 2] if x != C.GONE else "u", x == C.GONE, x % 2 if x != C.GONE else 0) for x in s]
        assert C.finish(C.times_vector(C.unit(C.START), matrices[s])) == cheapest(rows)


def test_ropes_compare_like_strings():
    rnd = random.Random(1)
    for _ in range(200):
        def rope(s):
            if len(s) < 2 or rnd.random() < 0.2:
                return s
            k = rnd.randint(1, len(s) - 1)
            return (rope(s[:k]), rope(s[k:]))
        a = "".join(rnd.choices("DK", k=rnd.randint(0, 8)))
        b = a[:rnd.randint(0, 8)] + "".join(rnd.choices("DK", k=rnd.randint(0, 3)))
        assert C.less(rope(a), rope(b)) == (a < b) and C.text_of(rope(a)) == a
