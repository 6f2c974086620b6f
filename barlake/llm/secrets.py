"""Secret scans with DataFrame functions only.

Key-value assignments, access keys and long hexadecimal runs are found by
pattern. Other runs of key characters are scored by two character Markov models,
one of random strings and one of ordinary identifiers: a run is a secret when the
log-likelihood ratio of the random model against the ordinary one is high. Both
models are trained from labelled samples; no run that may be a secret is one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import temp_name

# Kinds in order, and their patterns.
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
MIN_VALUE = 8
SPANS = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
#: Labelled ordinary samples: whole runs too short to be candidates that are words of one
#: letter case (or capitalised) and numbers, joined by separators.
ORDINARY = (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]{2,19}(?![A-Za-z0-9+/_=-]))[+/_=-]*"
            r"(?:(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)(?:[+/_=-]+|(?![A-Za-z0-9+/_=-])))*(?![A-Za-z0-9+/_=-])")
#: Ordinary identifiers join such samples: what a joint counts, in hundredths of a pair seen,
#: with each separator or a capital, and with each digit.
PAIR, JOINT, DIGIT_JOINT = 100, 10, 1
SEPARATORS, DIGITS = "+/_=-", "0123456789"
#: Random strings of each form that train the model of random strings.
RANDOM_STRINGS = 2_000
#: Share of each character's ordinary successors that is spread evenly: what an
#: unseen pair costs does not depend on the size of the corpus.
SMOOTHING = 0.001
#: Nats by which a run must look more random than ordinary.
MIN_RATIO = 15.0
MASK = "[SECRET]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used there."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """``values`` joined from the first to each, in log2(size) passes (a sum or a maximum)."""
    steps = F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda p: p < F.size(values))
    return F.aggregate(steps, values, lambda acc, p: F.transform(
        acc, lambda v, i: F.when(i >= p, join(v, F.get(acc, i - p))).otherwise(v)))


def _found(text: Column, pattern: str, kind: str, keep: Callable[[Column], Column] | None) -> Column:
    """Spans (start, rank, end, kind, value) of leftmost non-overlapping matches."""
    rank = KINDS.index(kind)

    def span(value: Column, end: Column) -> Column:
        return F.struct((end - F.char_length(value)).alias("start"), F.lit(rank).alias("rank"), end.alias("end"),
                        F.lit(kind).alias("kind"), value.alias("value"))

    def place(x: Column) -> Column:
        sizes = F.zip_with(F.slice(x["gaps"], F.lit(1), F.size(x["values"])), x["values"],
                           lambda g, v: F.char_length(g) + F.char_length(v))
        ends = _let(sizes, lambda n: _running(n, lambda v, w: v + w))
        return F.zip_with(x["values"], ends, span)

    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    spans = _let(F.struct(values.alias("values"), F.split(text, pattern, -1).alias("gaps")), place)
    if keep is not None:
        spans = F.filter(spans, lambda s: keep(s["value"]))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPANS))


def base_spans(text: Column) -> Column:
    """Assignments, access keys and hexadecimal runs, by start, then kind."""
    assign = _found(text, ASSIGN, "assign",
                    lambda v: F.char_length(F.regexp_extract(v, ASSIGN, 2)) >= MIN_VALUE)
    return F.array_sort(F.concat(assign, _found(text, ACCESS, "access", None), _found(text, HEX, "hex", None)))


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratio of each pair of characters, row by row of ``ALPHABET``,
    joined by commas (a fixed number of entries, whatever the corpus)."""
    ratios: str


def _sample_pairs(s: Column) -> Column:
    """(pair, kind): neighbours of a sample (0) and its first and last character (1)."""
    inner = F.transform(F.sequence(F.lit(1), F.char_length(s) - 1),
                        lambda i: F.struct(F.substr(s, i, F.lit(2)).alias("pair"), F.lit(0).alias("kind")))
    ends = F.struct(F.concat(F.left(s, F.lit(1)), F.right(s, F.lit(1))).alias("pair"), F.lit(1).alias("kind"))
    return F.concat(inner, F.array(ends))


def _weighted(pair: Column, kind: Column, n: Column) -> Column:
    """(pair, o): what a counted pair, or a first and last character, adds to the ordinary model."""
    first, last = F.left(pair, F.lit(1)), F.right(pair, F.lit(1))
    entry = lambda two, weight: F.struct(two.alias("pair"), (n * weight).alias("o"))
    joints = [entry(two, weight) for chars, weight in ((SEPARATORS, JOINT), (DIGITS, DIGIT_JOINT))
              for c in chars for two in (F.concat(last, F.lit(c)), F.concat(F.lit(c), first))]
    camel = entry(F.concat(last, F.upper(first)), JOINT)
    return (F.when(kind == 0, F.array(entry(pair, PAIR)))
            .when(last.between("a", "z"), F.array(*joints, camel)).otherwise(F.array(*joints)))


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Both Markov models, from labelled samples. Random: encoded digests of numbers.
    Ordinary: every run of all documents, outside base spans, that its length and form
    label so (``ORDINARY``), and the joints at which longer identifiers put such runs
    together. A run long enough to be a secret is in neither, so keys hide nothing
    however many there are. Pairs of neighbours are combined before the shuffle, to at
    most two rows per pair of ``ALPHABET`` and task."""
    spark = docs.sparkSession
    n = len(ALPHABET)
    texts = docs.select(F.col(text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    plain = F.when(F.size("cuts") > 0, _replaced(F.col("text"), F.col("cuts"), "\n")).otherwise(F.col("text"))
    samples = (texts.select("text", _merged(base_spans(F.col("text"))).alias("cuts"))
               .select(F.explode(F.regexp_extract_all(plain, F.lit(ORDINARY), F.lit(0))).alias("s")))
    seen = (samples.select(F.inline(_sample_pairs(F.col("s")))).groupBy("pair", "kind").agg(F.count("*").alias("n"))
            .select(F.inline(_weighted(F.col("pair"), F.col("kind"), F.col("n"))))
            .select("pair", F.lit(0).cast("long").alias("r"), "o"))
    digest = spark.range(RANDOM_STRINGS).select(F.sha2(F.col("id").cast("string"), 256).alias("d"))
    forms = F.array(F.col("d"), F.base64(F.unhex("d")), F.upper(F.col("d")),
                    F.translate(F.base64(F.unhex("d")), "+/=", "-_"))
    randoms = (digest.select(F.explode(forms).alias("s"))
               .select("s", F.explode(F.sequence(F.lit(1), F.char_length("s") - 1)).alias("i"))
               .select(F.col("s").substr(F.col("i"), F.lit(2)).alias("pair"), F.lit(1).cast("long").alias("r"),
                       F.lit(0).cast("long").alias("o")))
    at = lambda i: F.instr(F.lit(ALPHABET), F.col("pair").substr(i, 1)) - 1
    pairs = (seen.unionByName(randoms).groupBy("pair").agg(F.sum("r").alias("r"), F.sum("o").alias("o"))
             .select(at(1).alias("c"), at(2).alias("d"), "r", "o"))
    grid = spark.range(n * n).select((F.floor(F.col("id") / n)).cast("int").alias("c"),
                                     (F.col("id") % n).cast("int").alias("d"))
    counts = grid.join(pairs, ["c", "d"], "left").select("c", "d", (F.coalesce("r", F.lit(0)) + 1).alias("r"),
                                                         F.coalesce("o", F.lit(0)).alias("o"))
    totals = counts.groupBy("c").agg(F.sum("r").alias("rs"), F.sum("o").alias("os"))
    seen = F.when(F.col("os") > 0, F.col("o") / F.col("os")).otherwise(1 / n)
    ratio = F.round(F.log(F.col("r") / F.col("rs")) - F.log((1 - SMOOTHING) * seen + SMOOTHING / n), 6)
    rows = counts.join(totals, "c").select((F.col("c") * n + F.col("d")).alias("at"), ratio.alias("x"))
    one = rows.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))),
                                            lambda s: s["x"].cast("string")), ",").alias("ratios")).first()
    return Model(one["ratios"])


def log_ratio(value: Column, model: Model) -> Column:
    """Nats by which ``value`` looks more random than ordinary (pairs with characters
    outside the alphabet do not count)."""
    table = F.split(F.lit(model.ratios), ",").cast("array<double>")
    n = len(ALPHABET)

    def score(x: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            c, d = F.get(x["codes"], i - 1), F.get(x["codes"], i)
            return acc + F.when((c >= 0) & (d >= 0), F.get(x["table"], c * n + d)).otherwise(0.0)
        return F.aggregate(F.sequence(F.lit(1), F.size(x["codes"]) - 1), F.lit(0.0), add)

    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    return F.when(F.char_length(value) > 1, _let(F.struct(codes.alias("codes"), table.alias("table")), score)
                  ).otherwise(F.lit(0.0))


def random_spans(text: Column, base: Column, model: Model) -> Column:
    """Runs of 20 and more key characters, one of them a letter, that the models
    call random and that base spans do not wholly cover."""
    runs = _found(text, RUN, "random",
                  lambda v: v.rlike("[A-Za-z]") & (log_ratio(v, model) >= MIN_RATIO))

    def exceeding(x: Column) -> Column:
        """Runs that end after every cover that starts before them."""
        return F.transform(
            F.filter(F.arrays_zip(x["events"], x["reach"]), lambda e: (e["events"]["run"] >= 0) & (e["reach"] < e["events"]["end"])),
            lambda e: F.get(x["runs"], e["events"]["run"]))

    def reached(x: Column) -> Column:
        reach = F.transform(x["events"], lambda e: F.when(e["run"] < 0, e["end"]).otherwise(-1))
        return _let(F.struct(x["runs"].alias("runs"), x["events"].alias("events"),
                             _let(reach, lambda r: _running(r, F.greatest)).alias("reach")), exceeding)

    def uncovered(x: Column) -> Column:
        event = lambda s, run: F.struct(s["start"].alias("start"), run.alias("run"), s["end"].alias("end"))
        events = F.array_sort(F.concat(F.transform(x["covered"], lambda c: event(c, F.lit(-1))),
                                       F.transform(x["runs"], event)))
        return F.when((F.size(x["runs"]) == 0) | (F.size(x["covered"]) == 0), x["runs"]).otherwise(
            _let(F.struct(x["runs"].alias("runs"), events.alias("events")), reached))

    return _let(F.struct(runs.alias("runs"), _merged(base).alias("covered")), uncovered)


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, base spans, spans): one row per input row.

    Spans are (start, rank, end, kind, value) in code points, by start, then kind;
    a random run may overlap base spans that it exceeds. A null text is empty; an empty
    text has no spans. Repeated rows stay, a null doc_id stays null, extra columns are not
    carried, an empty table gives none. A text is read whole; m matches cost m log m steps.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    based = texts.select("doc_id", "text", base_spans(F.col("text")).alias("base"))
    return based.select("doc_id", "base", F.array_sort(
        F.concat("base", random_spans(F.col("text"), F.col("base"), model))).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _merged(spans: Column) -> Column:
    """Disjoint (start, end) that cover the spans (given by start), in order."""
    def cut(x: Column) -> Column:
        def whole(firsts: Column) -> Column:
            return F.transform(firsts, lambda at, j: F.struct(
                F.get(x["spans"], at)["start"].alias("start"),
                F.get(x["reach"], F.coalesce(F.get(firsts, j + 1), F.size(x["spans"])) - 1).alias("end")))
        indexes = F.sequence(F.lit(0), F.size(x["spans"]) - 1)
        return _let(F.filter(indexes, lambda i: (i == 0) | (F.get(x["reach"], i - 1) < F.get(x["spans"], i)["start"])), whole)

    def reached(s: Column) -> Column:
        reach = _let(F.transform(s, lambda p: p["end"]), lambda e: _running(e, F.greatest))
        return _let(F.struct(s.alias("spans"), reach.alias("reach")), cut)

    return F.when(F.size(spans) > 0, _let(spans, reached)).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


#: Characters of one slice of a text that is cut at many places.
SLICE = 1_024


def _replaced(text: Column, cuts: Column, mask: str) -> Column:
    """``text`` with each of its disjoint cuts (at least one) replaced by ``mask``."""
    def rebuilt(x: Column) -> Column:
        def part(start: Column, end: Column) -> Column:
            low = F.floor(start / SLICE).cast("int")
            held = F.slice(x["slices"], low + 1, F.floor(end / SLICE).cast("int") - low + 1)
            return F.substr(F.array_join(held, ""), start - low * SLICE + 1, end - start)

        def before(c: Column, i: Column) -> Column:
            start = F.when(i == 0, F.lit(0)).otherwise(F.get(x["cuts"], i - 1)["end"])
            return F.concat(part(start, c["start"]), F.lit(mask))
        return F.concat(F.array_join(F.transform(x["cuts"], before), ""), part(F.element_at(x["cuts"], -1)["end"], x["size"]))

    slices = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{SLICE}}}"), F.lit(0))
    return _let(F.struct(slices.alias("slices"), F.char_length(text).alias("size"), cuts.alias("cuts")), rebuilt)


def redact(docs: DataFrame, model: Model, text_col: str = "text", size_col: str | None = None,
           mask: str = MASK) -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mask``.

    All rows and columns stay, whatever their names; ``size_col`` (if given) gets
    the new length in code points where the text changed. Null texts stay null.
    """
    base, cuts = temp_name(docs, "base_spans"), temp_name(docs, "cut_spans")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.withColumn(base, base_spans(text))
    rows = rows.withColumn(cuts, _merged(F.array_sort(F.concat(F.col(base), random_spans(text, F.col(base), model)))))

    changed = F.size(cuts) > 0
    clean = F.when(changed, _replaced(text, F.col(cuts), mask)).otherwise(F.col(text_col))
    out = []
    for c in docs.columns:
        if c == text_col:
            out.append(clean.alias(c))
        elif c == size_col:
            out.append(F.when(changed, F.char_length(clean)).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return rows.select(*out)

