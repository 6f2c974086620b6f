"""Conversation structure repair: a grammar-compressed DP over role/fault symbols.

Rows of a conversation become symbols (role class and fault). The cheapest edits
that give role initials ``(s?(ua)+)?`` are a shortest path over four states (start,
after system, after user, after assistant), so a stretch of rows is a 4 x 4 min-plus
matrix whose entries hold a cost and a rope of edit initials, and stretches join by
matrix product. Re-Pair replaces frequent pairs of symbols by rules; the matrix of a
rule is the product of its two halves, worked out once, bottom-up, and shared by all
conversations of the block that use the rule.

Rows are dealt by range of (conversation, turn), so a conversation of any size is
spread over tasks. One that lies inside a block of rows is finished there. One that
crosses a border leaves a matrix per piece; the pieces are multiplied in order, and
its repaired text, one message to be hashed in order, is streamed past the edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from barlake.llm.common import cut

# White space, ends of sentences, edit costs, roles of edits.
BLANKS = " \t\n\x0b\x0c\r"
ENDINGS = (".", "!", "?")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
ROLES = {1: "user", 2: "assistant"}
#: Role classes by initial; any other initial is class 3.
CLASSES = ("s", "u", "a")
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: Symbols: role class * 2 + truncated, and the row that must go.
GONE, SYMBOLS = 8, 9
STATES = 4
START, AFTER_S, AFTER_U, AFTER_A = range(STATES)
#: States from which a user or an assistant row may come next, and the state after it.
NEXT = {1: ((START, AFTER_S, AFTER_A), AFTER_U), 2: ((AFTER_U,), AFTER_A)}
#: Symbols and code points of text that a block holds; a longer conversation is cut.
BLOCK_SYMBOLS, BLOCK_CHARS = 50_000, 4_000_000
#: Ropes up to this length are plain strings.
LEAF = 64


# ------------------------------------------------------------------- ropes --

def join_ropes(a, b):
    """Concatenation: a string while short, else a (left, right) node that shares both."""
    if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= LEAF:
        return a + b
    if not a or not b:
        return a or b
    return (a, b)


def leaves(rope) -> Iterator[str]:
    stack = [rope]
    while stack:
        top = stack.pop()
        if isinstance(top, str):
            yield top
        else:
            stack += (top[1], top[0])


def text_of(rope) -> str:
    return rope if isinstance(rope, str) else "".join(leaves(rope))


def less(a, b) -> bool:
    """Whether rope ``a`` comes before ``b`` in ASCII order; parts that both share are skipped."""
    if isinstance(a, str) and isinstance(b, str):
        return a < b
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if not isinstance(x, str):
            left += (x[1], x[0])
            right.append(y)
        elif not isinstance(y, str):
            right += (y[1], y[0])
            left.append(x)
        else:
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x < y
            if len(x) > n:
                left.append(x[n:])
            if len(y) > n:
                right.append(y[n:])
    return bool(right)


# ---------------------------------------------------------------- matrices --

def better(a, b):
    """The cheaper of two entries (cost, rope) or None, the ASCII-least of equals."""
    if a is None or b is None:
        return a if b is None else b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if less(b[1], a[1]) else a


def times_vector(vector: list, matrix: list) -> list:
    out = [None] * STATES
    for p, v in enumerate(vector):
        if v is None:
            continue
        for q, m in enumerate(matrix[p]):
            if m is not None and (out[q] is None or v[0] + m[0] <= out[q][0]):
                out[q] = better(out[q], (v[0] + m[0], join_ropes(v[1], m[1])))
    return out


def times(a: list, b: list) -> list:
    return [times_vector(row, b) for row in a]


def _identity() -> list:
    return [[(0, "") if p == q else None for q in range(STATES)] for p in range(STATES)]


def inserts() -> list:
    """The cheapest insertions that lead from state to state (none where it stays)."""
    step = _identity()
    for froms, to in NEXT.values():
        for p in froms:
            step[p][to] = (INSERT, "I")
    return times(step, step)


def symbol_matrix(symbol: int) -> list:
    """Insertions, then what may become of one row."""
    own = [[None] * STATES for _ in range(STATES)]
    for p in range(STATES):
        own[p][p] = (DELETE, "D")
    if symbol != GONE:
        cls, late = divmod(symbol, 2)
        if cls == 0:
            own[START][AFTER_S] = (KEEP + late * TRUNCATED, "K")
        for role, (froms, to) in NEXT.items():
            for p in froms:
                kept = (KEEP + late * TRUNCATED, "K") if cls == role else (REROLE + late * TRUNCATED, "R")
                own[p][to] = better(own[p][to], kept)
    return times(inserts(), own)


def finish(vector: list) -> tuple[int, str]:
    """Cost and edits of a whole conversation, whose rows led from the start to ``vector``."""
    end = times_vector(vector, inserts())
    cost, rope = better(end[START], end[AFTER_A])
    return cost, text_of(rope)


def unit(state: int) -> list:
    return [(0, "") if p == state else None for p in range(STATES)]


# ----------------------------------------------------------------- grammar --

def re_pair(sequences: list[np.ndarray]) -> tuple[list[tuple[int, int]], list[np.ndarray]]:
    """Rules (left, right), numbered from ``SYMBOLS`` on, and the sequences in terms of
    them: the most frequent pair of neighbours becomes a rule while one occurs twice."""
    lengths = np.array([len(s) for s in sequences], dtype=np.int64)
    whole = np.concatenate([np.append(s, -1) for s in sequences]).astype(np.int64) if len(lengths) else np.zeros(0, np.int64)
    rules: list[tuple[int, int]] = []
    while len(whole) > 1:
        x, y = whole[:-1], whole[1:]
        width = SYMBOLS + len(rules)
        pairs = np.where((x >= 0) & (y >= 0), x * width + y, -1)
        kinds, counts = np.unique(pairs[pairs >= 0], return_counts=True)
        at = None
        for k in np.argsort(-counts, kind="stable"):
            if counts[k] < 2:
                break
            at = np.flatnonzero(pairs == kinds[k])
            left, right = divmod(int(kinds[k]), width)
            if left == right:  # in a run of one symbol every second place
                starts = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - starts) % 2 == 0]
            if len(at) >= 2:
                break
            at = None
        if at is None:
            break
        rules.append((left, right))
        whole[at] = SYMBOLS + len(rules) - 1
        whole = np.delete(whole, at + 1)
    ends = np.flatnonzero(whole == -1)
    return rules, [whole[a:b] for a, b in zip(np.concatenate([[0], ends[:-1] + 1]) if len(ends) else [], ends, strict=True)]


def evaluate(sequences: list[bytes]) -> dict[bytes, list[list]]:
    """Matrix of each distinct sequence of symbols, by one grammar for all of them."""
    distinct = list(dict.fromkeys(sequences))
    rules, short = re_pair([np.frombuffer(s, np.uint8) for s in distinct])
    matrices = [symbol_matrix(s) for s in range(SYMBOLS)]
    for left, right in rules:
        matrices.append(times(matrices[left], matrices[right]))
    out = {}
    for key, symbols in zip(distinct, short, strict=True):
        product = _identity()
        for s in symbols:
            product = times(product, matrices[s])
        out[key] = product
    return out


# --------------------------------------------------------------------- text --

class Repaired:
    """The repaired conversation, hashed row by row as edits meet rows."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.first, self.hash = audit, 0, START, True, hashlib.sha256()

    def _put(self, role: str, text: str) -> None:
        self.hash.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False

    def _next_role(self) -> str:
        role = 2 if self.state == AFTER_U else 1
        self.state = NEXT[role][1]
        return ROLES[role]

    def _insert(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self._put(self._next_role(), "")

    def row(self, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            self._insert()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "R":
                self._put(self._next_role(), text)
            elif edit == "K":
                self._put(role, text)
                self.state = {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}[role[0]]

    def hexdigest(self) -> str:
        self._insert()
        return self.hash.hexdigest()


# ---------------------------------------------------------------- DataFrame --

def damage(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, n) of the fixed damage; ``n`` copies stand side by side,
    none of a dropped row (whose turn, role and text are null). Null roles, texts and
    key parts are one space."""
    c = conversations.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                             *[F.coalesce(F.col(x).cast("string"), F.lit(" ")).alias(x) for x in ("role", "text")])
    part = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(" "))
    rows = c.withColumn("k", F.crc32(F.concat(part("conv"), F.lit(":"), part("turn"))) % 20)
    k = F.col("k")
    return rows.select(
        "conv", F.when(k != 0, F.col("turn")).alias("turn"),
        F.when(k == 4, F.lit("user")).when(k != 0, F.col("role")).alias("role"),
        F.when(k == 1, F.lit("")).when(k == 2, F.regexp_replace("text", "[.!?]", "")).when(k != 0, F.col("text")).alias("text"),
        F.when(k == 0, 0).when(k == 3, 2).otherwise(1).cast("long").alias("n"))


def _faults(rows: DataFrame) -> DataFrame:
    """Equal rows of one turn as one row with their number, and the first fault of each:
    1 blank, 2 duplicate (of an earlier turn), 3 truncated, else 0; and the role's class."""
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))
    place = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    text = [F.xxhash64("text"), F.xxhash64(F.lit(1), "text")]
    # Texts that stand at several turns only: one row per text, combined before the shuffle.
    seen = (rows.where("n > 0").groupBy("conv", "role", text[0].alias("a"), text[1].alias("b"))
            .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1")
            .select(F.col("conv").alias("c"), F.col("role").alias("r"), "a", "b", "first"))
    both = rows.join(seen, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
                     & (text[0] == F.col("a")) & (text[1] == F.col("b")), "left")
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (F.when(trimmed == "", 1).when(F.col("first").isNotNull() & (F.col("first") < place), 2)
             .when(~F.right(trimmed, F.lit(1)).isin(*ENDINGS), 3).otherwise(0))
    cls = F.coalesce(F.nullif(F.instr(F.lit("".join(CLASSES)), F.substr("role", F.lit(1), F.lit(1))), F.lit(0)) - 1, F.lit(3))
    cls = F.when(F.col("role") == "", 3).otherwise(cls)
    return both.select("conv", "turn", "role", "text", "n", fault.alias("fault"), cls.alias("cls"))


LONG, INT, TEXT, FLAG = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType()
COUNTS = [(c, LONG) for c in ("blank", "duplicate", "truncated", "illegal")]


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


PIECE = _schema(("conv", LONG), ("part", INT), ("seq", INT), ("closed", FLAG), ("lo", LONG), ("hi", LONG), ("turns", LONG),
                ("head", INT), ("tail", INT), *COUNTS, ("cost", LONG), ("audit", TEXT), ("sha", TEXT),
                ("costs", T.ArrayType(LONG)), ("audits", T.ArrayType(TEXT)))
RESULT = _schema(("conv", LONG), ("gaps", LONG), *COUNTS, ("cost", LONG), ("audit", TEXT))
HASHED = _schema(("conv", LONG), ("sha", TEXT))


class _Piece:
    """Rows of one conversation inside a block."""

    def __init__(self, conv, closed: bool):
        self.conv, self.closed, self.symbols, self.rows = conv, closed, bytearray(), []
        self.lo = self.hi = self.head = self.tail = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role, text, n, fault, cls) -> None:
        if turn is not None and turn != self.hi:
            self.turns += 1
            self.lo, self.hi = turn if self.lo is None else self.lo, turn
        if self.tail is not None and (self.tail, cls) not in LEGAL:
            self.illegal += 1
        self.head = cls if self.head is None else self.head
        self.tail = cls
        self.illegal += n - 1
        if fault == 1:
            self.blank += n
        elif fault == 2:
            self.duplicate += n
        else:
            self.symbols.append(cls * 2 + (fault == 3))
            self.truncated += fault == 3
            self.duplicate += n - 1
            n -= 1
        self.symbols += bytes([GONE]) * n

    def result(self, part: int, seq: int, matrix: list) -> dict:
        out = {k: getattr(self, k) for k in ("conv", "closed", "lo", "hi", "turns", "head", "tail", "blank", "duplicate",
                                             "truncated", "illegal")} | {"part": part, "seq": seq}
        if self.closed:
            out["cost"], out["audit"] = finish(times_vector(unit(START), matrix))
            repaired = Repaired(out["audit"])
            for role, text, n in self.rows:
                repaired.row(role, text, n)
            out["sha"] = repaired.hexdigest()
        else:
            cells = [m for row in matrix for m in row]
            out["costs"] = [None if m is None else m[0] for m in cells]
            out["audits"] = [None if m is None else text_of(m[1]) for m in cells]
        return out


def _pieces(block_symbols: int, block_chars: int):
    """Sorted rows of a task -> one row per conversation, or per piece of one that may
    go on in another task or block."""
    arrow = to_arrow_schema(PIECE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[_Piece] = []
        symbols = chars = seq = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, symbols, chars, seq
            matrices = evaluate([bytes(p.symbols) for p in held])
            rows = [p.result(part, seq + i, matrices[bytes(p.symbols)]) for i, p in enumerate(held)]
            seq += len(held)
            held, symbols, chars = [], 0, 0
            return pa.RecordBatch.from_pylist(rows, schema=arrow)

        for batch in batches:
            for conv, turn, role, text, n, fault, cls in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                full = symbols >= block_symbols or chars >= block_chars
                if not held or held[-1].conv != conv:
                    if full:
                        yield flush()
                    # The first conversation of a task may have begun in the one before.
                    held.append(_Piece(conv, closed=bool(held) or seq > 0))
                elif full:
                    held[-1].closed = False
                    yield flush()
                    held.append(_Piece(conv, closed=False))
                if n:
                    piece = held[-1]
                    before = len(piece.symbols)
                    piece.add(turn, role, text, n, fault, cls)
                    piece.rows.append((role, text, n))
                    symbols += len(piece.symbols) - before
                    chars += len(text)
        if held:
            held[-1].closed = False
            yield flush()

    return run


def _joined(table: pa.Table) -> pa.Table:
    """The pieces of one conversation, multiplied in order."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["seq"]))
    out = {k: sum(r[k] for r in rows) for k in ("blank", "duplicate", "truncated", "illegal")} | {"conv": rows[0]["conv"]}
    vector, turns, lo, hi, tail = unit(START), 0, None, None, None
    for r in rows:
        if r["head"] is not None:
            out["illegal"] += tail is not None and (tail, r["head"]) not in LEGAL
            tail = r["tail"]
        if r["lo"] is not None:
            turns += r["turns"] - (r["lo"] == hi)
            lo, hi = r["lo"] if lo is None else lo, r["hi"]
        cells = [None if c is None else (c, a) for c, a in zip(r["costs"], r["audits"], strict=True)]
        vector = times_vector(vector, [cells[i:i + STATES] for i in range(0, STATES * STATES, STATES)])
    out["gaps"] = 0 if lo is None else hi - lo + 1 - turns
    out["cost"], out["audit"] = finish(vector)
    return pa.Table.from_pylist([out], schema=to_arrow_schema(RESULT))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, audit first, then its rows in order) -> hash of each repaired conversation."""
    arrow, conv, repaired = to_arrow_schema(HASHED), None, None
    done = lambda: pa.RecordBatch.from_pylist([{"conv": conv, "sha": repaired.hexdigest()}], schema=arrow)
    for batch in batches:
        for c, audit, role, text, n in zip(*[batch.column(x).to_pylist() for x in ("conv", "audit", "role", "text", "n")], strict=True):
            if audit is not None:
                if repaired is not None:
                    yield done()
                conv, repaired = c, Repaired(audit)
            elif n:
                repaired.row(role, text, n)
    if repaired is not None:
        yield done()


def repair(rows: DataFrame, block_symbols: int = BLOCK_SYMBOLS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(conv, turn, role, text, n copies) -> one row per conv: gaps, counts of first
    faults, illegal neighbours, cost, audit and the hash of the repaired text.

    Order inside a conversation: turn (nulls first), then role, then text; equal rows
    stand side by side. A conv whose rows all have n = 0 gives zeros, an empty audit and
    the hash of the empty string; a null conv is a conversation of its own; a role of any
    other initial (or none) can only be reroled or deleted. Rows of any length are read
    whole; a conversation beyond a block (or a task's range) is folded piece by piece, and
    only its audit, which is its result, is held at once. Empty tables give no rows."""
    spark = rows.sparkSession
    order = ["conv", "turn", "role", "text"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(_faults(rows).repartitionByRange(n, *order).sortWithinPartitions(*order))
    pieces = cut(dealt.mapInArrow(_pieces(block_symbols, block_chars), PIECE))
    whole = pieces.where("closed").select(
        "conv", F.when(F.col("lo").isNull(), F.lit(0)).otherwise(F.col("hi") - F.col("lo") + 1 - F.col("turns")).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha")
    crossing = cut(pieces.where("NOT closed").groupBy("conv").applyInArrow(_joined, RESULT))
    ids = crossing.select(F.col("conv").alias("c"))
    own = dealt.join(ids, F.col("conv").eqNullSafe(F.col("c")), "left_semi")
    stream = (crossing.select("conv", F.lit(0).alias("kind"), "audit", *[F.lit(None).cast(t).alias(c) for c, t in (
        ("turn", "long"), ("role", "string"), ("text", "string"), ("n", "long"))])
        .unionByName(own.select("conv", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), "turn", "role", "text", "n")))
    hashed = stream.repartition(n, "conv").sortWithinPartitions("conv", "kind", "turn", "role", "text").mapInArrow(_hashes, HASHED)
    hashed = hashed.select(F.col("conv").alias("c"), "sha")
    return whole.unionByName(crossing.join(hashed, F.col("conv").eqNullSafe(F.col("c"))).drop("c"))


def damaged_and_repaired(conversations: DataFrame, **blocks) -> DataFrame:
    """One row per conv_id of ``conversations`` after the fixed damage; see ``repair``.
    Columns beside conv_id, turn, role and text are not read."""
    return repair(damage(conversations), **blocks).select(
        F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.col("sha").alias("repaired_sha256"))
