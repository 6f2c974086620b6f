"""Personal data: exact patterns, and boosted trees over proposed spans.

Four kinds are found by pattern and always stay. Beside them, generators of high
recall propose spans that may overlap (all runs of digit groups, account numbers,
address groups, written-out e-mail addresses). Boosted trees score each proposal by its
format and its context; thresholds calibrated on examples that the trees did not
see select the spans, the best of those that overlap.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm import boosting
from barlake.llm.common import map_texts, temp_name, whole_texts

# Kinds in order; the first four are found by pattern.
BASE_KINDS = ["email", "ip", "card", "phone"]
MODEL_KINDS = ["email_model", "phone_model", "card_model", "ssn_model", "iban_model", "ipv6_model", "mac_model"]
KINDS = BASE_KINDS + MODEL_KINDS
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

# Generators of proposals.
NUMBERS = re.compile(r"[0-9](?:[0-9 +().\-/]*[0-9])?")
GROUP = re.compile(r"[0-9]+")
SSN = re.compile(r"[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}")
#: Digits and characters of one proposed number; the run it lies in may be longer.
MIN_DIGITS, MAX_DIGITS, MAX_CHARS = 7, 19, 42
ACCOUNT = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
COLONS = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?:[:-][0-9A-Fa-f]{0,4}){4,7}(?![0-9A-Fa-f:])")
SHORTENED = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::"
                       r"(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?(?![0-9A-Za-z:])")
WRITTEN = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(] ?(?:at|AT) ?[\])] ?[A-Za-z0-9-]+"
                     r"(?: ?(?:[\[(] ?(?:dot|DOT) ?[\])]|\.) ?[A-Za-z0-9-]+)+")
# Context words by theme.
CONTEXT = {
    "phone": {"phone", "tel", "telephone", "mobile", "cell", "call", "fax", "contact"},
    "person": {"ssn", "social", "security", "taxpayer", "insurance"},
    "card": {"card", "visa", "mastercard", "credit", "debit", "payment", "pay"},
    "bank": {"iban", "bank", "account", "transfer"},
    "mail": {"email", "mail", "write", "reach", "address"},
    "thing": {"version", "page", "order", "invoice", "total", "chapter", "item", "part", "serial", "build", "ratio",
              "score", "table", "figure", "isbn", "date", "since", "year"},
}
WORDS = re.compile(r"[A-Za-z]+")
CONTEXT_CHARS = 40
MASKS = {k: f"[{k.removesuffix('_model').upper()}]" for k in KINDS}
#: Examples of each form that train and calibrate; share of true spans among those selected.
EXAMPLES, PRECISION, SEED = 120, 0.99, 11
#: Proposals scored at once: memory does not follow a text's length.
BLOCK = 4096


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) by pattern, by start, then kind: leftmost
    non-overlapping matches of each kind, without those that fail its check."""
    out = []
    if "@" in text:
        done = 0
        for m in DOMAIN.finditer(text):
            start = m.start()
            while start > done and (text[start - 1] in "._%+-" or (text[start - 1].isascii() and text[start - 1].isalnum())):
                start -= 1
            if start < m.start():
                out.append((start, 0, m.end()))
                done = m.end()
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def numbers(text: str) -> Iterator[tuple[int, int, str]]:
    """Every span of neighbouring digit groups of 7 to 19 digits: a window over each
    run, however long. A plus or an opening bracket before the first belongs to it."""
    for m in NUMBERS.finditer(text):
        if m.end() - m.start() < MIN_DIGITS:
            continue
        window: list[tuple[int, int]] = []  # groups that may still begin a span
        for g in GROUP.finditer(text, m.start(), m.end()):
            window.append(g.span())
            digits = 0
            for k in range(len(window) - 1, -1, -1):
                start, end = window[k]
                digits += end - start
                if digits > MAX_DIGITS or g.end() - start > MAX_CHARS:
                    del window[:k + 1]
                    break
                if digits < MIN_DIGITS:
                    continue
                start -= start > 0 and text[start - 1] in "+("
                kind = ("ssn_model" if SSN.fullmatch(text, start, g.end()) else
                        "card_model" if digits >= 13 else "phone_model")
                yield start, g.end(), kind


def proposals(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, kind) of possible personal data; they may overlap."""
    if DIGIT.search(text):
        yield from numbers(text)
        for m in ACCOUNT.finditer(text):
            yield m.start(), m.end(), "iban_model"
        if ":" in text or "-" in text:
            for m in COLONS.finditer(text):
                pairs = re.fullmatch(r"[0-9A-Fa-f]{2}([:-][0-9A-Fa-f]{2}){5}", m[0])
                if pairs or "-" not in m[0] and "::" not in m[0]:
                    yield m.start(), m.end(), "mac_model" if pairs else "ipv6_model"
    if "::" in text:
        for m in SHORTENED.finditer(text):
            if 1 <= len(re.findall("[0-9A-Fa-f]+", m[0])) <= 7:
                yield m.start(), m.end(), "ipv6_model"
    if "(" in text or "[" in text:
        for m in WRITTEN.finditer(text):
            yield m.start(), m.end(), "email_model"


def _beside(text: str, at: int, side: int) -> tuple[int, int]:
    """The digit group beside a span, at most two separators away: how it is parted
    (0 none, 1 by blanks or nothing, 2 by others) and its size, 5 at most."""
    near = text[max(0, at - 7):at][::-1] if side < 0 else text[at:at + 7]
    m = re.match(r"([ +().\-/]{0,2})([0-9]{1,5})", near)
    return (1 if not m[1].strip(" ") else 2, len(m[2])) if m else (0, 0)


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    """Format and context of one proposal."""
    s = text[start:end]
    digits = re.sub(r"[^0-9]", "", s)
    groups = [len(g) for g in re.findall(r"[0-9A-Za-z]+", s)] or [0]
    before = {w.lower() for w in WORDS.findall(text[max(0, start - CONTEXT_CHARS):start])}
    after = {w.lower() for w in WORDS.findall(text[end:end + CONTEXT_CHARS // 2])}
    left, right = text[start - 1:start], text[end:end + 1]
    compact = re.sub(r"[^0-9A-Z]", "", s)
    account = kind == "iban_model" and int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1
    return [MODEL_KINDS.index(kind), len(s), len(digits), len(groups), max(groups), min(groups), groups[0], groups[-1],
            s.count(" "), s.count("-"), s.count("."), s.count("/"), s.count("(") - s.count(")"), s.count("("),
            s.startswith("+"), s.count(":"), sum(c.isalpha() for c in s), sum(c.isupper() for c in s),
            len(digits) >= 13 and luhn(digits), account, left.isalnum(), right.isalnum(), left in ("$", "€", "£", "#"),
            len(set(digits)), *(groups + [0, 0, 0])[1:4], digits.startswith("0"), "::" in s, s.count("+"),
            len(set(re.findall(r"[^0-9A-Za-z]+", s))), *_beside(text, start, -1), *_beside(text, end, 1), *[len(before & words) for words in CONTEXT.values()],
            *[len(after & words) for words in CONTEXT.values()]]


@dataclass
class Model:
    trees: boosting.Boosted
    thresholds: dict[str, float]


def _examples(rng: np.random.Generator, n: int) -> list[tuple[str, int, int, str, int]]:
    """Labelled proposals: written from templates, ``n`` of each form."""
    d = lambda k: "".join(str(x) for x in rng.integers(0, 10, k))
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    hexes = lambda k: "".join("0123456789abcdef"[x] for x in rng.integers(0, 16, k))

    def card() -> str:
        body = pick(["4", "5", "37"]) + d(14)
        body = body[:15]
        number = next(body + str(c) for c in range(10) if luhn(body + str(c)))
        return pick([number, " ".join(number[i:i + 4] for i in range(0, 16, 4)), "-".join(number[i:i + 4] for i in range(0, 16, 4))])

    def iban() -> str:
        country, body = pick(["DE", "FR", "ES", "GB"]), d(18)
        check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
        whole = f"{country}{check:02d}{body}"
        return pick([whole, " ".join(whole[i:i + 4] for i in range(0, len(whole), 4))])

    true = {
        "phone": lambda: pick([f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"0{d(2)} {d(4)} {d(4)}"]),
        "person": lambda: f"{d(3)}-{d(2)}-{d(4)}",
        "card": card,
        "bank": iban,
        "mail": lambda: pick([f"user{d(2)} (at) mail{d(1)} (dot) com", f"a.name [at] host{d(1)} [dot] org", f"name{d(1)}(at)site.net",
                              f"{pick(['mary', 'jan.novak', 'info'])} (at) {pick(['company', 'mail', 'uni'])} (dot) {pick(['com', 'org', 'net'])}"]),
        "": lambda: pick([":".join(hexes(4) for _ in range(8)), ":".join(hexes(2) for _ in range(6))]),
    }
    short = lambda: pick([f"2001:db8::{hexes(int(rng.integers(1, 5)))}", f"fe80::{d(1)}",
                          f"fe80::{':'.join(hexes(4) for _ in range(4))}", f"2{d(3)}:{hexes(4)}:{hexes(3)}::{hexes(2)}:{hexes(4)}"])
    false = [
        lambda: f"{d(2)}/{d(2)}/20{d(2)}", lambda: f"20{d(2)}-{d(2)}-{d(2)}", lambda: f"{d(4)}-{d(4)}", lambda: d(int(rng.integers(8, 13))),
        lambda: f"{d(3)}.{d(3)}.{d(3)}.{d(3)}.{d(1)}", lambda: d(16) if rng.random() < 0.5 else f"{d(4)} {d(4)} {d(4)} {d(3)}7",
        lambda: f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}", lambda: " ".join(d(2) for _ in range(6)), lambda: f"{d(1)}.{d(1)}.{d(4)} {d(2)}",
        lambda: f"{pick(['AB', 'XY', 'QT'])}{d(2)} {d(4)} {d(4)} {d(4)}", lambda: f"{d(2)}:{d(2)}:{d(2)}:{d(2)}:{d(2)}",
        lambda: f"{d(4)}({d(2)}) {d(3)}-{d(3)}", lambda: " ".join(d(int(rng.integers(1, 5))) for _ in range(int(rng.integers(3, 15)))),
        lambda: f"{pick(['a', 'bad', 'face', 'add', 'Cafe', 'dead'])}::{pick(['a', 'b', 'add', 'Bed', 'fade', 'c1'])}"]
    plain = ["the", "of", "thndre", "and", "onwhat", "de", "que", "der", "ieung", "was"]
    # Of each form: its theme, its label, and whether rows of it are parted by single blanks.
    forms = [(f, theme, 1, False) for theme, f in true.items()] + [(short, "", 1, False)] + [(f, "thing", 0, False) for f in false]
    forms += [(true[theme], theme, 1, True) for theme in ("phone", "person", "card")]
    out = []
    for make, theme, label, rows in forms:
        for _ in range(n):
            words = [pick(plain) for _ in range(6)]
            themes = sorted(CONTEXT.get(theme, ()))
            if themes and rng.random() < 0.6:
                words[-1 - int(rng.integers(2))] = pick(themes)
            text = " ".join(words) + pick([" ", ": ", " "])
            if rows and rng.random() < 0.4:
                text += d(int(rng.integers(1, 4))) + " "
            head, values = len(text), []
            for _ in range(int(rng.integers(1, 5)) if rows else 1):
                value = make()
                values.append((len(text), len(text) + len(value)))
                text += value + " "
            size = len(text) - 1
            text = text[:-1] + pick([" ", ". ", ", "]) + " ".join(pick(plain) for _ in range(4))
            for start, end, kind in proposals(text):
                if start < size and end > head:
                    whole = any(start <= s and end >= e - 1 and end - start <= e - s + 1 for s, e in values)
                    if kind == "card_model" and not (label and whole) and theme in ("card", "thing") and luhn(re.sub(r"[^0-9]", "", text[start:end])):
                        continue  # a valid number by chance
                    out.append((text, start, end, kind, int(label and whole)))
    return out


@lru_cache(maxsize=4)
def train(seed: int = SEED, examples: int = EXAMPLES, precision: float = PRECISION) -> Model:
    """Trees from one half of the written examples; thresholds from the other: for
    each kind the lowest score from which on ``precision`` of the spans are true
    (the kind adds nothing where no score reaches it)."""
    rows = _examples(np.random.default_rng(seed), examples)
    x = np.array([features(t, s, e, k) for t, s, e, k, _ in rows], dtype=np.float64)
    y = np.array([r[4] for r in rows], dtype=np.float64)
    fit_half = np.random.default_rng(seed + 1).random(len(rows)) < 0.5
    trees = boosting.fit(x[fit_half], y[fit_half])
    score = trees.probability(x[~fit_half])
    truth, kinds = y[~fit_half], np.array([r[3] for r in rows])[~fit_half]
    thresholds = {}
    for kind in MODEL_KINDS:
        own = kinds == kind
        order = np.argsort(-score[own], kind="stable")
        ranked, hits = score[own][order], truth[own][order]
        right = np.cumsum(hits) / np.arange(1, len(hits) + 1)
        enough = np.flatnonzero((right >= precision) & (np.r_[ranked[1:], -1] < ranked)) if len(hits) else []
        thresholds[kind] = float(max(ranked[enough[-1]], 0.5)) if len(enough) else 2.0
    return Model(trees, thresholds)


def _touched(starts: list[int], ends: list[int], start: int, end: int) -> bool:
    """Whether a span overlaps one of some disjoint spans in order."""
    i = bisect_left(starts, end) - 1
    return i >= 0 and ends[i] > start


def spans(text: str, model: Model) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Pattern spans, and all spans: (start, kind number, end) by start, then kind."""
    base = base_spans(text)
    starts: list[int] = []  # base spans, overlapping ones together
    ends: list[int] = []
    for s, _, e in base:
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    options = (p for p in proposals(text) if not _touched(starts, ends, p[0], p[1]))
    chosen: list[tuple[float, int, int, str]] = []
    while block := list(islice(options, BLOCK)):
        score = model.trees.probability(np.array([features(text, *p) for p in block], dtype=np.float64))
        chosen += [(-float(x), *p) for x, p in zip(score, block, strict=True) if x >= model.thresholds[p[2]]]
    chosen.sort(key=lambda c: c[0])
    taken: list[tuple[int, int, int]] = []
    starts, ends = [], []
    for _, start, end, kind in chosen:
        if not _touched(starts, ends, start, end):
            at = bisect_left(starts, start)
            starts.insert(at, start)
            ends.insert(at, end)
            taken.append((start, KINDS.index(kind), end))
    return base, sorted(base + taken)


def redacted(text: str, found: list[tuple[int, int, int]]) -> str:
    """``text`` with each span (overlapping ones together) replaced by its kind."""
    parts, done = [], 0
    for start, kind, end in found:
        if start >= done:
            parts += [text[done:start], MASKS[KINDS[kind]]]
        done = max(done, end)
    return "".join(parts) + text[done:]


SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _listed(found: list[tuple[int, int, int]]) -> list[dict]:
    return [{"start": s, "rank": k, "end": e, "kind": KINDS[k]} for s, k, e in found]


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, base spans, spans): one row per input row.

    Spans are (start, rank, end, kind) in code points, by start, then kind. Null
    texts are empty; an empty text has no spans. Repeated rows stay, a null doc_id
    stays null, extra columns are not carried, an empty table gives none.
    """
    def make() -> Callable:
        def run(cols: dict) -> dict:
            both = [spans(t, model) for t in cols["text"]]
            return {"doc_id": cols["doc_id"], "base": [_listed(b) for b, _ in both], "spans": [_listed(a) for _, a in both]}
        return run
    return map_texts(whole_texts(docs, id_col, text_col), make, f"doc_id long, base {SPAN}, spans {SPAN}")


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by a mask of its kind; all rows and
    columns stay. Null texts stay null."""
    import pandas as pd

    def masked(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            yield series.map(lambda t: None if t is None else redacted(t, spans(t, model)[1]))

    masked.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    own = temp_name(docs, "masked")
    with_mask = docs.withColumn(own, F.pandas_udf(masked, "string")(F.col(text_col).cast("string")))
    return with_mask.select(*[F.col(own).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def joined(column: str):
    """kind:start:end of a span column, comma-joined."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(column: str, kind: str):
    return F.size(F.filter(column, lambda s: s["kind"] == kind)).cast("long")
