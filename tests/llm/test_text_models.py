"""Quality, personal data, secrets, licences: against plain code and held-out rows."""

import base64
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.llm import boosting, licenses, pii, quality, queries, secrets

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels)
    return docs, labels, model


def test_quality_on_held_out_rows(scored):
    docs, labels, model = scored
    rows = quality.classify(docs, model).join(labels.select("doc_id", "quality"), "doc_id").filter("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows) / len(rows)
    good = [r for r in rows if r["quality"] == 1]
    assert right >= 0.9 and sum(r["predicted"] for r in good) / len(good) >= 0.98
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_quality_finds_bad_rows_and_keeps_good_ones(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.classify(docs, quality.train(docs, labels)).join(labels.select("doc_id", "quality"), "doc_id") \
        .filter("held_out").select("quality", "predicted").collect()
    bad = [r["predicted"] for r in rows if r["quality"] == 0]
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    assert bad.count(0) / len(bad) >= 0.85 and good.count(1) / len(good) >= 0.98


def test_quality_trains_on_texts_of_any_length(spark, monkeypatch):
    """Only long labelled texts: none is left out; the byte budget stops the drawing, not a text."""
    rows = [(i, ("calm words in a row. " if i % 2 else "BUY!! NOW!! ") * 2_000) for i in range(40)]
    docs = spark.createDataFrame([*rows, rows[1], (41, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(42)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda texts, y: seen.append((texts, y)))
    quality.train(docs, labels)
    quality.train(docs, labels, train_bytes=1)
    quality.train(docs.limit(0), labels)
    used = {r["doc_id"] for r in docs.filter("text is not null").filter(~quality.held_out()).select("doc_id").collect()}
    texts, y = seen[0]
    assert len(texts) == len(used) and all(len(t) >= 24_000 for t in texts)
    assert all((t[:1] == b"c") == bool(label) for t, label in zip(texts, y, strict=True))
    assert len(seen[1][0]) == 1 and seen[1][0][0] in texts
    assert seen[2] == ([], [])


def test_quality_learns_nothing_from_held_out_labels(scored):
    docs, labels, model = scored
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.train(docs, flipped)
    assert all(np.array_equal(model.weights[k], again.weights[k]) for k in model.weights)


def test_quality_reads_whole_texts(scored, monkeypatch):
    model = scored[2]
    junk = b"THE!! AND!! OF!! THEREA!! " * 40
    clean = next(t for t in (r["text"].encode() for r in scored[0].filter("length(text) > 2000").limit(50).collect())
                 if quality.scores([t], model)[0] > 0.9)
    long = clean * 40
    assert quality.scores([long + junk], model)[0] < 0.5 < quality.scores([long], model)[0]
    texts = [clean, b"", long, junk, b"a"]
    whole = quality.scores(texts, model)
    monkeypatch.setattr(quality, "SLICE_BYTES", 100)
    assert np.allclose(quality.scores(texts, model), whole, atol=1e-4)


def test_quality_without_two_classes():
    assert quality.scores([b"x"], quality.fit([], [])).tolist() == [1.0]
    assert quality.scores([b"x"], quality.fit([b"a", b"b"], [1, 1]))[0] >= 0.3


PII = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
       ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_pii(text):
    out = []
    for k, (kind, pattern) in enumerate(PII):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in re.sub("[^0-9]", "", m[0])][::-1]
            valid = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                     "card": 14 <= len(digits) <= 19 and (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0,
                     "phone": 10 <= len(digits) <= 15}[kind]
            if valid:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii_patterns(texts):
    rng = random.Random(5)
    made = ["".join(rng.choice("ab@@..1234567890+- ()é_%\n") for _ in range(40)) for _ in range(4000)]
    for t in [*texts.values(), *made]:
        assert pii.base_spans(t) == plain_pii(t)


def test_pii_query(spark, texts):
    for r in queries.op4_pii(spark, "/root/testdata/sf0.001").collect():
        base = [(pii.BASE_KINDS[k], s, e) for s, k, e in plain_pii(texts[r["doc_id"]])]
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(b[0] == k for b in base) for k in pii.BASE_KINDS]
        assert set(filter(None, line.split(","))) <= set(r["spans"].split(","))


def test_pii_trees_on_unseen_examples():
    model = pii.train()
    rows = pii._examples(np.random.default_rng(99), 60)
    score = model.trees.probability(np.array([pii.features(*r[:4]) for r in rows]))
    taken = np.array([s >= model.thresholds[r[3]] for s, r in zip(score, rows)])
    truth = np.array([r[4] for r in rows], dtype=bool)
    assert truth[taken].mean() >= 0.97 and taken[truth].mean() >= 0.9
    text = "my ssn 123-45-6789, iban DE89 3704 0044 0532 0130 00; write to john (at) example (dot) com"
    assert pii.redacted(text, pii.spans(text, model)[1]) == "my ssn [SSN], iban [IBAN]; write to [EMAIL]"
    assert pii.spans("chapter 12 of 2024-01-02, version 10.20.30", model) == ([], [])


def test_boosting_learns_xor():
    rng = np.random.default_rng(0)
    x = rng.random((400, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((boosting.fit(x, y).probability(x) > 0.5) == y).mean() > 0.97


ASSIGN = "|".join("".join(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token"))
SECRETS = [("assign", re.compile(r"""(%s|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""" % ASSIGN)),
           ("access", re.compile("AKIA[A-Z0-9]+")), ("hex", re.compile("[0-9a-f]+"))]


def plain_secrets(text):
    out = []
    for k, (kind, pattern) in enumerate(SECRETS):
        for m in pattern.finditer(text):
            size = len(m[2]) if kind == "assign" else m.end() - m.start()
            if size >= {"assign": 8, "access": 16, "hex": 32}[kind]:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{SECRETS[k][0]}:{s}:{e}" for s, k, e in sorted(out))


def test_secrets(spark, docs, texts):
    rng = random.Random(8)
    parts = ["token", "=", ":", " ", "'", '"', "API_KEY", "api_key", "Secret", "AKIA", "ABCDEFGH1234", "0123456789abcdef", "é🙂",
             "abc.def", "password", "\n", "zz"]
    made = {10_000 + i: "".join(rng.choice(parts) for _ in range(12)) for i in range(400)}
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(made.items()), "doc_id long, text string"))
    found = secrets.scan(both, secrets.train(docs)).select("doc_id", secrets.joined(F.col("base")).alias("base"),
                                                           secrets.joined(F.col("spans")).alias("spans")).collect()
    for r in found:
        want = plain_secrets({**texts, **made}[r["doc_id"]])
        assert r["base"] == want
        assert set(want.split(",")) <= set(r["spans"].split(",")) | {""}


def test_markov_models_tell_random_strings(spark, docs):
    model = secrets.train(docs)
    rng = random.Random(4)
    strings = [("".join(rng.choice(secrets.ALPHABET[:62]) for _ in range(24)), 1) for _ in range(100)]
    words = [w for r in docs.limit(100).collect() for w in re.findall(r"[A-Za-z]{4,}", r["text"])]
    strings += [("_".join(rng.choice(words) for _ in range(4)), 0) for _ in range(100)]
    df = spark.createDataFrame(strings, "s string, random int")
    rows = df.select("random", (secrets.log_ratio(F.col("s"), model) >= secrets.MIN_RATIO).alias("found")).collect()
    assert sum(r["found"] for r in rows if r["random"]) >= 95
    assert sum(r["found"] for r in rows if not r["random"]) == 0
    clean = secrets.redact(spark.createDataFrame([("key Zk9qL2v8Rt4xW1pS7mNd3bYc6 and token=abcdefgh1.",)], "text string"), model)
    assert clean.first()["text"] == "key [SECRET] and [SECRET]"


def ordinary_samples(text):
    """Short runs of words of one letter case (or capitalised) and numbers between separators."""
    for run in re.findall(r"[A-Za-z0-9+/_=-]+", text):
        pieces = [x for x in re.split(r"[+/_=-]+", run) if x]
        if 2 <= len(run) <= 19 and all(re.fullmatch("[A-Z]?[a-z]+|[A-Z]+|[0-9]+", x) for x in pieces):
            yield run


def test_markov_models_count_labelled_samples_of_the_whole_corpus(spark, texts):
    paths = {10_000 + i: f"/opt/v{i}/lib64+x=y_{i}-z Ab_cD-x a//b_1 --- aB Q9 token=Zq9Zq9Zq9 " + "a1/" * 70 for i in range(2_500)}
    rows = spark.createDataFrame(list({**texts, **paths}.items()), "doc_id long, text string")
    model = secrets.train(rows)
    n, seen = len(secrets.ALPHABET), np.zeros((len(secrets.ALPHABET),) * 2)
    at = secrets.ALPHABET.index
    for t in [*texts.values(), *paths.values()]:
        for _, start, end in (p.split(":") for p in plain_secrets(t).split(",") if p):
            start, end = int(start), int(end)
            t = t[:start] + " " * (end - start) + t[end:]
        for run in ordinary_samples(t):
            for c, d in zip(run, run[1:]):
                seen[at(c), at(d)] += secrets.PAIR
            for chars, weight in ((secrets.SEPARATORS, secrets.JOINT), (secrets.DIGITS, secrets.DIGIT_JOINT)):
                for c in chars:
                    seen[at(run[-1]), at(c)] += weight
                    seen[at(c), at(run[0])] += weight
            if "a" <= run[-1] <= "z":
                seen[at(run[-1]), at(run[0].upper())] += secrets.JOINT
    random_model = np.ones((n, n))
    for i in range(secrets.RANDOM_STRINGS):
        d = hashlib.sha256(str(i).encode()).digest()
        b = base64.b64encode(d).decode()
        for s in (d.hex(), b, d.hex().upper(), b.translate(str.maketrans("+/", "-_", "="))):
            for c, e in zip(s, s[1:]):
                random_model[at(c), at(e)] += 1
    total = seen.sum(axis=1, keepdims=True)
    share = np.where(total > 0, seen / np.maximum(total, 1), 1 / n) * (1 - secrets.SMOOTHING) + secrets.SMOOTHING / n
    want = np.log(random_model / random_model.sum(axis=1, keepdims=True)) - np.log(share)
    assert np.allclose(np.array(model.ratios.split(","), dtype=float).reshape(n, n), want, atol=2e-6)
    assert secrets.train(rows.unionByName(rows)).ratios == model.ratios


@pytest.mark.parametrize("per_text", [1, 20, 100])
def test_keys_hide_nothing_however_many(spark, texts, per_text):
    rng = random.Random(per_text)
    own = {i: {"".join(rng.choice(secrets.ALPHABET[:62]) for _ in range(40)) for _ in range(per_text)} for i in texts}
    rows = spark.createDataFrame([(i, f"{t} " + " ".join(sorted(own[i]))) for i, t in texts.items()], "doc_id long, text string")
    got = secrets.scan(rows, secrets.train(rows)).select("doc_id", F.transform("spans", lambda s: s["value"]).alias("v")).collect()
    assert sum(len(set(r["v"]) & own[r["doc_id"]]) for r in got) >= 0.99 * per_text * len(texts)


def test_many_matches_of_one_text(spark, docs):
    model, rng = secrets.train(docs), random.Random(11)
    key = lambda k, chars: "".join(rng.choice(chars) for _ in range(k))
    kinds = [lambda: key(40, "0123456789abcdef"), lambda: "é🙂 token=" + key(rng.randint(5, 12), "abc9."),
             lambda: "AKIA" + key(16, "ABCDEFGH0123"), lambda: key(rng.randint(20, 90), secrets.ALPHABET[:62]),
             lambda: "word " * rng.randint(1, 700)]
    made = {i: " ".join(rng.choice(kinds)() for _ in range(m)) for i, m in enumerate([1, 2, 3, 7, 1_500])}
    df = spark.createDataFrame([*made.items(), (9, " ".join(kinds[0]() for _ in range(20_000)))], "doc_id long, text string")
    for r in secrets.scan(df.filter("doc_id < 9"), model).select("doc_id", "spans", secrets.joined(F.col("base")).alias("b")).collect():
        text, spans = made[r["doc_id"]], [tuple(s) for s in r["spans"]]
        base = [(int(s), int(e)) for _, s, e in (p.split(":") for p in plain_secrets(text).split(",") if p)]
        assert r["b"] == plain_secrets(text) and spans == sorted(spans)
        assert all(text[s:e] == v for s, _, e, _, v in spans)
        assert not any(k == "random" and any(a <= s and e <= b for a, b in base) for s, _, e, k, _ in spans)
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(df, model).collect()}
    for r in secrets.scan(df.filter("doc_id < 9"), model).collect():
        out, at, text = [], 0, made[r["doc_id"]]
        for s, e in sorted((s["start"], s["end"]) for s in r["spans"]):
            if s > at or not out:
                out += [text[at:s], secrets.MASK]
            at = max(at, e)
        assert clean[r["doc_id"]] == "".join([*out, text[at:]])
    assert clean[9] == " ".join([secrets.MASK] * 20_000)


def plain_licenses(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        want = phrase.split()
        for i in range(len(words) - len(want) + 1):
            if words[i:i + len(want)] == want:
                places.append(i)
                labels.add(label)
    return len(words), sorted(places), labels


def test_license_phrases(texts):
    rng, phrases = random.Random(2), licenses.automaton()
    choice = ["MIT", "license", "License,", "cc", "BY", "by", "Apache", "gnu general", "public", "é", "x", "cc-by", " "]
    made = [" ".join(rng.choice(choice) for _ in range(25)) for _ in range(2000)]
    for t in [*texts.values(), *made]:
        got = licenses.scan_text(t.encode(), phrases)
        assert (got.n_words, sorted(got.places), got.base) == plain_licenses(t)
        assert got.base <= set(got.weights)


@pytest.mark.parametrize("source,text,permissive", [
    ("MIT", "MIT", True),
    ("MIT OR GPL-2.0-only AND BSD-3-Clause", "(MIT or (GPL-2.0-only and BSD-3-Clause))", True),
    ("(MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0",
     "((MIT or Apache-2.0) and GPL-2.0-only with Classpath-exception-2.0)", False),
])
def test_license_expressions(source, text, permissive):
    value = licenses.evaluate(source)
    assert (value.text, value.permissive) == (text, permissive)


@pytest.mark.parametrize("source", ["", "MIT OR", "AND MIT", "(MIT", "MIT)", "MIT Apache-2.0", "()"])
def test_malformed_expressions(source):
    with pytest.raises(ValueError):
        licenses.evaluate(source)


@pytest.mark.parametrize("identifier,label", [
    ("MIT", "mit"), ("MIT-0", "mit"), ("mitre", "mitre"), ("MITNFA", "mitnfa"), ("MIT-or-later", "mit-or-later"),
    ("GPL-2.0+", "gpl"), ("GPL-3.0-or-later", "gpl"), ("LGPL-2.1-only", "lgpl"), ("gpl-2.0-with-classpath-exception", "gpl"),
    ("GPL-CC-1.0", "gpl-cc-1.0"), ("BSD-3-Clause-Clear", "bsd"), ("0BSD", "bsd"), ("BSD-Protection", "bsd-protection"),
    ("CC-BY-4.0", "cc-by"), ("CC-BY-3.0-US", "cc-by"), ("CC-BY-NC-SA-4.0", "cc-by-nc"), ("CC0-1.0", "public-domain"),
    ("ISC", "isc"), ("iscsi", "iscsi"), ("BSL-1.0", "bsl"), ("BSL-1.1", "bsl-1.1"), ("Apache-2.0", "apache"),
    ("apache-like", "apache-like"),
])
def test_license_identifiers_are_matched_whole(identifier, label):
    assert licenses.family(identifier) == label
    assert licenses.evaluate(identifier).permissive == (label in licenses.PERMISSIVE)


def test_license_tags():
    got = licenses.scan_text(b"// SPDX-License-Identifier: (MIT OR Apache-2.0) AND ISC */\nx", licenses.automaton())
    assert set(got.weights) == {"mit", "apache", "isc"} and got.expressions[0].permissive
    assert licenses.expression_after("MIT OR").text == "MIT"
    assert licenses.expression_after("; none") is None


@pytest.mark.parametrize("text, labels", [
    ("BSD 3-Clause License", {"bsd"}), ("Licensed under MIT.", {"mit"}), ('{"license": "MIT",', {"mit"}),
    ("license = 'Apache-2.0 OR MIT'", {"apache", "mit"}), ("uses Apache-2.0, see", {"apache"}), ("LGPL v3", {"lgpl"}),
    ("GPLv2", {"gpl"}), ("the MPL version 2.0", {"mpl"}), ("the new BSD license", {"bsd"}), ("GPL-3.0-or-later", {"gpl"}),
    ("SIL Open Font License", {"ofl"}), ('"licenses": ["ISC"]', {"isc"}), ("CC0-1.0", {"public-domain"}),
    ("version 2.0 of apache 2 0 64 servers", set()), ('"license": "see the file"', set()), ("license: MIT", set()),
    ("the SPDX license identifier is a tag", set()), ("mitre licensed", set()), ("gplv2x", set()), ("Apache 2.0.64", set())])
def test_license_titles_short_names_and_metadata(text, labels):
    assert set(licenses.scan_text(text.encode(), licenses.automaton()).weights) == labels


def test_license_expressions_are_read_whole():
    names = [f"Own-{i}" for i in range(30_000)] + ["GPL-2.0-only"]
    text = "SPDX-License-Identifier: " + " AND ".join(names) + " */ x"
    got = licenses.scan_text(text.encode(), licenses.automaton())
    assert set(got.weights) == {n.lower() for n in names[:-1]} | {"gpl"} and not got.expressions[0].permissive
    assert got.expressions[0].text == "(" * 30_000 + names[0] + "".join(f" and {n})" for n in names[1:])
    chain = licenses.expression_after("(" * 200 + "MIT OR ISC" + ")" * 200 + " AND (BSD-2-Clause")
    assert (chain.text, chain.labels) == ("(MIT or ISC)", {"mit", "isc"})
    assert licenses.evaluate("MIT WITH (x-1 OR gpl-2.0) OR ISC").labels == {"mit", "isc"}


def test_license_every_tag_of_a_line():
    tag = "SPDX-License-Identifier"
    line = f"é {tag}: MIT a b {tag} : GPL-2.0-only {tag}: ISC AND {tag}: {tag}:\tBSD-3-Clause\r\nOR X license-expression:(EPL-2.0\n)"
    got = licenses.scan_text(line.encode(), licenses.automaton())
    assert [e.text for e in got.expressions] == ["MIT", "GPL-2.0-only", "ISC", "BSD-3-Clause"]
    assert set(got.weights) == {"mit", "gpl", "isc", "bsd"}


def _found(text, model):
    return [(pii.KINDS[k].removesuffix("_model"), text[s:e]) for s, k, e in pii.spans(text, model)[1]]


def test_pii_rows_of_numbers():
    model, rng = pii.train(), random.Random(3)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    for kind, shape in (("phone", (3, 3, 4)), ("ssn", (3, 2, 4))):
        right = total = 0
        for n in [2, 3, 5, 8, 40] * 6:
            row = ["-".join(digits(k) for k in shape) for _ in range(n)]
            text = f"list {' '.join(row)} end"
            proposed = {text[s:e] for s, e, _ in pii.proposals(text)}
            assert set(row) <= proposed
            if not pii.base_spans(text):
                total += n
                right += len({(kind, v) for v in row} & set(_found(text, model)))
        assert total and right / total >= 0.95
    assert _found("call 12 555-123-4567 now", model) == [("phone", "555-123-4567")]
    assert _found("all 555-123-4567 555-987-6543", model) == [("phone", "555-123-4567"), ("phone", "555-987-6543")]


def test_pii_shortened_addresses():
    model = pii.train()
    assert _found("at 2001:db8::1 and fe80::1, not std::min", model) == [("ipv6", "2001:db8::1"), ("ipv6", "fe80::1")]
    proposed = [(s, e) for s, e, _ in pii.proposals("fe80::abcd dead::beef::1 x::1 1:2:3:4:5:6:7::8")]
    assert proposed == [(0, 10)]


def test_pii_windows_and_blocks(monkeypatch):
    rng, model = random.Random(6), pii.train()
    for _ in range(300):
        text = "".join(rng.choice("0123456789  -.(+/x") for _ in range(60))
        groups = [m.span() for m in re.finditer("[0-9]+", text)]
        want = set()
        for i, (s, _) in enumerate(groups):
            for _, e in groups[i:]:
                n = sum(c.isdigit() for c in text[s:e])
                if 7 <= n <= 19 and e - s <= 42 and not re.search("[^0-9 +().\\-/]", text[s:e]):
                    want.add((s - (s > 0 and text[s - 1] in "+("), e))
        got = [(s, e) for s, e, _ in pii.numbers(text)]
        assert len(got) == len(want) and set(got) == want
    text = " ".join(f"{rng.randrange(900) + 100}-{rng.randrange(90) + 10}-{rng.randrange(9000) + 1000}" for _ in range(200))
    whole = pii.spans(text, model)
    monkeypatch.setattr(pii, "BLOCK", 7)
    assert pii.spans(text, model) == whole and len(whole[1]) > 100


def test_runs_beyond_base_spans_are_secrets(spark, docs):
    model = secrets.train(docs)
    head, inner, tail = "Zk9qL2v8Rt4xW1pS7mNd", "0123456789abcdef" * 2, "Qw8Xc5Vb3Nm7Lk1J"
    texts = [f"a {head}{inner}{tail} b", f"a {inner} b", f"a token={head}{tail} b", f"a {inner}{tail} {inner}."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    clean = [r["text"] for r in secrets.redact(df, model).orderBy("doc_id").collect()]
    assert clean == ["a [SECRET] b", "a [SECRET] b", "a [SECRET] b", "a [SECRET] [SECRET]."]
    found = {r["doc_id"]: r["s"] for r in secrets.scan(df, model).select("doc_id", secrets.joined(F.col("spans")).alias("s")).collect()}
    assert found[0] == f"random:2:{2 + len(head + inner + tail)},hex:21:54" and found[1] == "hex:2:34"
    assert found[2].split(":")[0] == "assign" and "random" not in found[2]
