"""License scans: Aho-Corasick over words, and licence expressions.

One automaton finds notice phrases, titles, short names, identifiers and tags (also those
of package metadata) in the words of a text. Where the words alone do not tell, the bytes
that they came from must have the tag's or the identifier's own form.
The expression after a tag is put in postfix order by a shunting-yard parser and
evaluated: ``and`` binds tighter than ``or``, ``with`` tightest.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame

from barlake.llm.common import map_texts, whole_texts

# Base phrases and labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Further notice phrases, their labels and how sure each is.
NOTICES = {
    "gnu lesser general public license": ("lgpl", 0.9),
    "gnu affero general public license": ("agpl", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "eclipse public license": ("epl", 0.9),
    "bsd license": ("bsd", 0.8),
    "isc license": ("isc", 0.8),
    "boost software license": ("bsl", 0.9),
    "creative commons attribution": ("cc-by", 0.8),
    "cc by nc": ("cc-by-nc", 0.9),
    "cc by sa": ("cc-by-sa", 0.9),
    "cc by nd": ("cc-by-nd", 0.9),
    "released into the public domain": ("public-domain", 0.8),
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "this program is free software you can redistribute it and or modify": ("gpl", 0.7),
}
# Titles of further licences and their labels.
TITLES = {
    "apache software license": "apache", "licensed under apache": "apache", "licensed under the apache": "apache",
    "licensed under mit": "mit", "licensed under the mit": "mit", "mit licensed": "mit", "expat license": "mit",
    "new bsd license": "bsd", "simplified bsd license": "bsd", "modified bsd license": "bsd", "revised bsd license": "bsd",
    "licensed under bsd": "bsd", "licensed under the bsd": "bsd", "licensed under the gpl": "gpl", "licensed under gpl": "gpl",
    "licensed under the lgpl": "lgpl", "gnu library general public license": "lgpl", "gnu gpl": "gpl", "gnu lgpl": "lgpl",
    "gnu agpl": "agpl", "gnu free documentation license": "gfdl", "artistic license": "artistic", "zlib license": "zlib",
    "python software foundation license": "psf", "european union public licence": "eupl",
    "common development and distribution license": "cddl", "server side public license": "sspl",
    "business source license": "busl", "sil open font license": "ofl", "academic free license": "afl",
    "universal permissive license": "upl", "microsoft public license": "ms-pl", "open database license": "odbl",
    "creative commons zero": "public-domain", "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
}
# Released versions of the licences that are known by a short name and a version.
VERSIONS = {"gpl": ("1", "2", "2.0", "3", "3.0"), "lgpl": ("2", "2.0", "2.1", "3", "3.0"), "agpl": ("1.0", "3", "3.0"),
            "mpl": ("1.0", "1.1", "2", "2.0"), "epl": ("1.0", "2.0"), "apache": ("1.1", "2", "2.0")}
#: Short names: "GPLv3", "LGPL v2.1", "MPL version 2.0", "Apache 2.0 license", "BSD 3-Clause license", "3-clause BSD".
SHORT_NAMES = {form.replace(".", " "): label for label, versions in VERSIONS.items() for v in versions
               for form in (f"{label}v{v}", f"{label} v{v}", f"{label} version {v}", f"{label} {v} license")}
SHORT_NAMES |= {form: "bsd" for n in "234" for form in (f"bsd {n} clause license", f"{n} clause bsd", f"bsd {n} clause")}
NOTICES |= {phrase: (label, 0.8) for phrase, label in {**SHORT_NAMES, **TITLES}.items() if phrase not in NOTICES}
#: Identifiers that stand in the text by themselves, read whole at the words found.
IDENTIFIERS = {f"{label} {v}".replace(".", " ") for label, versions in VERSIONS.items() for v in versions} \
    | {"cc0 1 0", "cc by sa 4 0", "cc by nc 4 0"}
IDENTIFIER = re.compile(rb"[A-Za-z0-9]+-[A-Za-z0-9.+-]*[A-Za-z0-9+]")
IDENTIFIER_WEIGHT = 0.8
TAGS = ["spdx license identifier", "license expression", "license", "licenses"]
TAG = re.compile(rb"(?:spdx-license-identifier|license-expression)[ \t]*:", re.IGNORECASE)
FIRST_RUN = re.compile(rb"[ \t]*[^\s]*")
#: A key of package metadata with a quoted value, which counts if all of it is an expression.
METADATA = re.compile(rb"""licenses?["']?[ \t]*[:=][ \t]*(?:\[[ \t]*)?(["'])([^"'\r\n]*)\1""", re.IGNORECASE)
# Whole licence identifiers, in lower case and without a final plus, by family.
_VERSION, _GNU = r"-v?[0-9]+(\.[0-9]+)*", r"(-only|-or-later|-with-[a-z0-9.-]+-exception)?"
FAMILIES = [(label, re.compile(whole)) for label, whole in (
    ("agpl", rf"agpl({_VERSION})?{_GNU}"),
    ("lgpl", rf"lgpl({_VERSION})?{_GNU}"),
    ("gpl", rf"gpl({_VERSION})?{_GNU}"),
    ("apache", rf"apache({_VERSION})?"),
    ("bsd", r"0bsd|bsd|bsd-[1-4]-clause(-[a-z0-9-]+)?|bsd-source-code"),
    ("cc-by-nc", rf"cc-by-nc(-sa|-nd)?({_VERSION})?(-[a-z]{{2,3}})?"),
    ("cc-by-sa", rf"cc-by-sa({_VERSION})?(-[a-z]{{2,3}})?"),
    ("cc-by-nd", rf"cc-by-nd({_VERSION})?(-[a-z]{{2,3}})?"),
    ("cc-by", rf"cc-by({_VERSION})?(-[a-z]{{2,3}})?"),
    ("public-domain", r"cc0|cc0-1\.0|unlicense"),
    ("mit", r"mit(-0|-advertising|-click|-cmu|-enna|-feh|-festival|-khronos-old|-modern-variant|-open-group|-stk|"
            r"-testregex|-wu)?"),
    ("mpl", rf"mpl({_VERSION})?(-no-copyleft-exception)?"),
    ("epl", rf"epl({_VERSION})?"),
    ("isc", r"isc(-veillard)?"),
    ("bsl", r"bsl|bsl-1\.0"),
)]
FAMILY_LABELS = {label for label, _ in FAMILIES}
PERMISSIVE = {"apache", "bsd", "mit", "isc", "bsl", "cc-by", "public-domain"}
BASE_WEIGHT, TAG_WEIGHT = 0.8, 0.95
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

#: A-Z in lower case, every other ASCII character that is no word's a blank.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                  for b in range(256))
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+")


@dataclass
class Expression:
    """Value of a licence expression: labels named, whether some choice is
    permissive throughout, and the expression written out."""
    labels: frozenset[str]
    permissive: bool
    text: str


def postfix(source: str) -> list[str]:
    """Shunting-yard: the expression's tokens in postfix order, operators in lower
    case. ValueError if it is malformed."""
    out: list[str] = []
    waiting: list[str] = []
    operand_next = True
    for token in _TOKEN.findall(source):
        low = token.lower()
        if low in PRECEDENCE:
            if operand_next:
                raise ValueError("operand expected")
            while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= PRECEDENCE[low]:
                out.append(waiting.pop())
            waiting.append(low)
            operand_next = True
        elif token == "(":
            if not operand_next:
                raise ValueError("operator expected")
            waiting.append(token)
        elif token == ")":
            if operand_next:
                raise ValueError("operand expected")
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                raise ValueError("no opening bracket")
            waiting.pop()
        else:
            if not operand_next:
                raise ValueError("operator expected")
            out.append(token)
            operand_next = False
    if operand_next or "(" in waiting:
        raise ValueError("unfinished")
    return out + waiting[::-1]


def family(identifier: str) -> str:
    """The family whose whole identifiers it is one of, else itself in lower case."""
    low = identifier.lower().removesuffix("+")
    return next((label for label, whole in FAMILIES if whole.fullmatch(low)), low)


def evaluate(source: str) -> Expression:
    """Value of an expression; ``with`` keeps its licence and notes the exception."""
    stack: list[tuple[bool, tuple]] = []
    for token in postfix(source):
        if token not in PRECEDENCE:
            stack.append((family(token) in PERMISSIVE, (token,)))
            continue
        (right_ok, right), (left_ok, left) = stack.pop(), stack.pop()
        ok = left_ok if token == "with" else left_ok and right_ok if token == "and" else left_ok or right_ok
        stack.append((ok, (token, left, right)))
    permissive, tree = stack[0]
    labels, written, waiting = set(), [], [(tree, True)]
    while waiting:  # written out without recursion, in time of its length
        node, named = waiting.pop()
        if isinstance(node, str):
            written.append(node)
        elif len(node) == 1:
            written.append(node[0])
            if named:
                labels.add(family(node[0]))
        elif node[0] == "with":
            waiting += [(node[2], False), (" with ", False), (node[1], named)]
        else:
            waiting += [(")", False), (node[2], named), (f" {node[0]} ", False), (node[1], named), ("(", False)]
    return Expression(frozenset(labels), permissive, "".join(written))


def well_formed(tokens: Iterable[str]) -> list[str]:
    """The longest prefix of the tokens that is an expression; reads no further
    than the first misplaced token."""
    read: list[str] = []
    whole, depth, operand_next = 0, 0, True
    for token in tokens:
        operator = token.lower() in PRECEDENCE
        depth += (token == "(") - (token == ")")
        if operand_next == (operator or token == ")") or depth < 0:
            break
        read.append(token)
        operand_next = operator or token == "("
        if not operand_next and depth == 0:
            whole = len(read)
    return read[:whole]


def expression_after(text: str) -> Expression | None:
    """The longest well-formed expression that a text starts with, if any; it ends
    with its line, or with the first character that is no expression's."""
    def tokens() -> Iterable[str]:
        at = 0
        for m in _TOKEN.finditer(text):
            if text[at:m.start()].strip(" \t"):
                return
            yield m[0]
            at = m.end()

    found = well_formed(tokens())
    return evaluate(" ".join(found)) if found else None


def automaton() -> ahocorasick.Automaton:
    """All phrases and tags, words delimited by single blanks."""
    found = ahocorasick.Automaton()
    for phrase in {**BASE, **NOTICES, **dict.fromkeys(TAGS), **dict.fromkeys(IDENTIFIERS)}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


@dataclass
class Scan:
    n_words: int = 0
    places: list[int] = field(default_factory=list)
    base: set[str] = field(default_factory=set)
    weights: dict[str, float] = field(default_factory=dict)
    expressions: list[Expression] = field(default_factory=list)


def scan_text(text: bytes, phrases: ahocorasick.Automaton) -> Scan:
    spaced = text.translate(_TO_WORDS)
    words = spaced.split()
    out = Scan(len(words))
    if not words:
        return out
    line = b" " + b" ".join(words) + b" "
    hits = [(end - len(phrase) - 1, phrase) for end, phrase in phrases.iter(line.decode("latin-1"))]
    if not hits:
        return out
    blanks = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32)

    def sure(label: str, weight: float) -> None:
        out.weights[label] = max(weight, out.weights.get(label, 0))

    tagged: set[int] = set()  # words that begin a tag
    named: list[int] = []  # words that begin an identifier
    for start, phrase in hits:
        if phrase in BASE:
            out.places.append(int(np.searchsorted(blanks, start)))
            out.base.add(BASE[phrase])
            sure(BASE[phrase], BASE_WEIGHT)
        if phrase in NOTICES:
            sure(*NOTICES[phrase])
        if phrase in TAGS:
            tagged.add(int(np.searchsorted(blanks, start)))
        if phrase in IDENTIFIERS:
            named.append(int(np.searchsorted(blanks, start)))
    if tagged or named:
        blank = np.frombuffer(spaced, dtype=np.uint8) == 32
        offsets = np.flatnonzero(~blank & np.r_[True, blank[:-1]])  # of each word in the text
        for w in sorted(tagged):
            m = METADATA.match(text, int(offsets[w]))
            value = m[2].decode() if m else ""
            whole = well_formed(_TOKEN.findall(value))
            if whole and "".join(whole) == re.sub(r"\s+", "", value):
                out.expressions.append(evaluate(" ".join(whole)))
                for label in out.expressions[-1].labels:
                    sure(label, TAG_WEIGHT)
        heads = [m for m in (TAG.match(text, int(offsets[w])) for w in sorted(tagged)) if m]
        ends = [m.start() for m in heads[1:]] + [len(text)] if heads else []
        # An identifier in the first run after a tag is the tag's.
        taken = [FIRST_RUN.match(text, m.end(), end).span() for m, end in zip(heads, ends, strict=True)]
        for w in named:
            at = int(offsets[w])
            m = IDENTIFIER.match(text, at)
            label = family(m[0].decode()) if m else None
            k = bisect.bisect(taken, (at, len(text))) - 1
            if label in FAMILY_LABELS and not (k >= 0 and at < taken[k][1]):
                sure(label, IDENTIFIER_WEIGHT)
        for m, end in zip(heads, ends, strict=True):
            value = expression_after(text[m.end():end].decode())
            if value is not None:
                out.expressions.append(value)
                for label in value.labels:
                    sure(label, TAG_WEIGHT)
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licences of each row: doc_id, n_words, n_base (places of base phrases),
    first_word, last_word (their smallest and largest start, else null),
    base_labels, labels (distinct, sorted, comma-joined), score (0 to 1: that some
    licence is stated), expressions (array of string), permissive (whether each
    stated expression leaves a permissive choice; null without one).

    Null texts are empty: no words, no labels, score 0. Repeated rows stay, a null
    doc_id stays null, extra columns are not carried, an empty table gives none.
    A malformed expression counts up to its last well-formed part. Expressions are
    read whole, however long; each tag has its own, also with others on its line.
    """
    def make() -> Callable:
        phrases = automaton()

        def run(cols: dict) -> dict:
            found = [scan_text(t, phrases) for t in cols["text"]]
            return {
                "doc_id": cols["doc_id"], "n_words": [f.n_words for f in found], "n_base": [len(f.places) for f in found],
                "first_word": [min(f.places, default=None) for f in found],
                "last_word": [max(f.places, default=None) for f in found],
                "base_labels": [",".join(sorted(f.base)) for f in found],
                "labels": [",".join(sorted(f.weights)) for f in found],
                "score": [round(1 - float(np.prod([1 - w for w in f.weights.values()])), 6) for f in found],
                "expressions": [[e.text for e in f.expressions] for f in found],
                "permissive": [all(e.permissive for e in f.expressions) if f.expressions else None for f in found]}
        return run

    schema = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
              "labels string, score double, expressions array<string>, permissive boolean")
    return map_texts(whole_texts(docs, id_col, text_col), make, schema, binary=True)
