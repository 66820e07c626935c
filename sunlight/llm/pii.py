"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

The spans of the fixed patterns (e-mail, IP address, payment card, phone number) are
the seed entities, in whatever form they are written. Every other identifier-like
run of the corpus is an instance too: letters, digits and ``._%+@/-`` that hold a digit or
``@`` after their letters, wherever they begin (after a space or after punctuation, as in ``SSN:123-45-6789``
or ``"AB123456"``), with further groups of digits and capitals after single spaces (``DE89 3704 0044``).
The lexical pattern of an instance is the two words before it, punctuation included; one where there is
but one, and a mark at the start of a text or right after another instance.

Pattern and instance form a bipartite graph that Spark scores in rounds: a
pattern is as sure as the mean of its instances (seeds 1, others what earlier
rounds gave), weighed by how many sure instances support it; an instance that is
no seed is as sure as its patterns taken together. After the rounds, patterns
above ``SURE_PATTERN`` with ``LEAST_SEEDS`` different seeds mark their remaining
instances as personal data (kind ``context``).

Only DataFrame functions are used. Positions come from cutting a text at the
matches: the lengths of the gaps and matches before a match add up to its
start, in code points; its pattern is the end of the gap before it. Each pattern is written so
that a search is linear in the text: possessive repetition, and a start only where a run starts.

Defined cases: a null text is the empty text. Repeated rows are returned
each. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import stash, table

# The base patterns. Lookbehinds only keep a search from starting inside a run that has
# failed as a whole; possessive marks only save backtracking that cannot succeed.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# A longest chain of digits with at most one space or dash between, of 14 to 19 digits.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

LEAST_IDENTIFIER = 4
# A run is looked at once, from its start: the class of its characters stands three times.
IDENTIFIER = (r"(?<![\p{L}\p{N}._%+@/-])(?=[\p{L}._%+/-]*+[0-9@])[\p{L}\p{N}._%+@/-]++"
              r"(?:\x20(?=[A-Z]*+[0-9])[0-9A-Z]{1,6}+(?![\p{L}\p{N}._%+@/-]))*+")
FIRST, NEXT = "^", "~"                    # patterns at the start of a text, and right after another instance
ROUNDS = 3
SURE_PATTERN = 0.8
LEAST_SEEDS = 3

BLOCK = 64
_SPAN = "array<struct<start:int,end:int,value:string,pattern:string>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _ends(lengths: Column) -> Column:
    """Running sums of an array, ``BLOCK`` numbers at a time: no step copies what was summed before."""
    add = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x)
    blocks = F.sequence(F.lit(0), F.floor(F.size(lengths) / BLOCK).cast("int"))
    before = F.aggregate(blocks, F.array(F.lit(0)), lambda acc, b: F.concat(
        acc, F.array(F.element_at(acc, -1) + add(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))))))
    block = lambda i: F.floor(i / BLOCK).cast("int")
    return _let(before, lambda upto: F.transform(lengths, lambda _, i: F.get(upto, block(i)) + add(
        F.slice(lengths, block(i) * BLOCK + 1, F.pmod(i, F.lit(BLOCK)) + 1))))


def _last_words(gap: Column, at: Column) -> Column:
    """The last two words of the text before a match, in lower case."""
    words = F.reverse(F.regexp_extract(F.reverse(gap), r"^\s*+\S++(?:\s++\S++)?+", 0))
    plain = F.lower(F.trim(F.regexp_replace(words, r"\s++", " ")))
    return F.when(plain != "", plain).when(at == 0, F.lit(FIRST)).otherwise(F.lit(NEXT))


def located(text: Column, pattern: str) -> Column:
    """Matches as (start, end, value, pattern), leftmost and not overlapping; pattern: the words before."""
    cut = F.struct(F.split(text, pattern, -1).alias("gaps"),
                   F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"))

    def spans(c):
        lengths = F.zip_with(F.slice(c["gaps"], 1, F.size(c["values"])), c["values"],
                             lambda g, v: F.length(g) + F.length(v))
        return _let(lengths, lambda n: F.transform(_ends(n), lambda end, i: F.struct(
            (end - F.length(F.get(c["values"], i))).alias("start"), end.alias("end"), F.get(c["values"], i).alias("value"),
            _last_words(F.get(c["gaps"], i), i).alias("pattern"))))

    return _let(cut, lambda c: F.when(F.size(c["values"]) > 0, spans(c)).otherwise(F.array().cast(_SPAN)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Every second digit from the right doubled, nine taken off above nine; the sum ends in zero."""
    d = F.reverse(_digits(value))
    parts = F.transform(F.sequence(F.lit(1), F.length(d)), lambda i: F.substring(d, i, F.lit(1)).cast("int") *
                        (F.lit(2) - F.pmod(i, F.lit(2))))
    return F.pmod(F.aggregate(parts, F.lit(0), lambda a, x: a + x - F.when(x > 9, 9).otherwise(0)), F.lit(10)) == 0


def _small_parts(value: Column) -> Column:
    """Every dotted number is at most 255 (leading zeros allowed)."""
    plain = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(plain, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= F.lit("255"))))


def _kept(text: Column, kind: str) -> Column:
    """Spans of one kind; texts that cannot hold one are not searched."""
    none = F.array().cast(_SPAN)
    if kind == "email":
        return F.when(F.contains(text, F.lit("@")), located(text, EMAIL)).otherwise(none)
    if kind == "ip":
        return F.when(text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
                      F.filter(located(text, IP), lambda s: _small_parts(s["value"]))).otherwise(none)
    if kind == "card":
        return F.when(text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
                      F.filter(located(text, CARD), lambda s: _luhn(s["value"]))).otherwise(none)
    return F.when(text.rlike(r"\+[0-9]"), F.filter(
        located(text, PHONE), lambda s: F.length(_digits(s["value"])).between(10, 15))).otherwise(none)


def base_spans(text: Column) -> Column:
    """Array of (start, end, kind, value, pattern) of the fixed patterns, by start, then kind."""
    def tagged(order: int, kind: str) -> Column:
        return F.transform(_kept(text, kind), lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"),
            F.lit(kind).alias("kind"), s["value"].alias("value"), s["pattern"].alias("pattern")))

    return F.array_sort(F.concat(*[tagged(n, k) for n, k in enumerate(KINDS)]))


def mentions(text: Column) -> Column:
    """Identifier-like runs as (start, end, value, pattern), without punctuation at their ends."""
    found = F.when(text.rlike("[0-9@]"), located(text, IDENTIFIER)).otherwise(F.array().cast(_SPAN))

    def describe(s):
        value = F.regexp_replace(s["value"], r"^[^\p{L}\p{N}+]+|[^\p{L}\p{N}]+$", "")
        start = s["start"] + F.length(F.regexp_extract(s["value"], r"^[^\p{L}\p{N}+]*+", 0))
        return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"),
                        s["pattern"].alias("pattern"))

    return F.filter(F.transform(found, describe),
                    lambda m: (F.length(m["value"]) >= LEAST_IDENTIFIER) & m["value"].rlike("[0-9@]"))


def score_graph(graph: DataFrame, rounds: int = ROUNDS, sure: float = SURE_PATTERN,
                least_seeds: int = LEAST_SEEDS) -> DataFrame:
    """Sure patterns: (pattern, score). ``graph``: pattern, value, seed (boolean), one row per pair.

    A pattern's score is the mean of its instances; its weight in their belief
    grows with its support. Patterns need ``least_seeds`` different seeds.
    """
    edges = graph.select("pattern", "value", F.col("seed").cast("double").alias("seed"))
    scores = edges.withColumn("score", F.col("seed"))
    for n in range(rounds):
        # Written, so that the joins below have plain scans on that side and a hot pattern can be split.
        patterns = stash(graph.sparkSession, scores.groupBy("pattern").agg(
            F.avg("score").alias("mean"), F.sum("score").alias("support"), F.sum("seed").alias("seeds")), "pii-patterns")
        if n < rounds - 1:
            weight = F.col("mean") * F.col("support") / (1 + F.col("support"))
            believed = scores.join(patterns.select("pattern", weight.alias("weight")), "pattern").groupBy("value").agg(
                (1 - F.exp(F.sum(F.log(1 - F.least(F.lit(0.999), F.col("weight")))))).alias("belief"))
            scores = edges.join(believed, "value").select(
                "pattern", "value", "seed", F.when(F.col("seed") == 1, F.lit(1.0)).otherwise(F.col("belief")).alias("score"))
    return patterns.where((F.col("mean") >= sure) & (F.col("seeds") >= least_seeds)) \
        .select("pattern", F.col("mean").alias("score"))


def find_personal_data(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       rounds: int = ROUNDS, sure: float = SURE_PATTERN,
                       least_seeds: int = LEAST_SEEDS) -> DataFrame:
    """One row per document: doc_id and spans (array of start, end, kind), by start, then kind."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = stash(spark, docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", base_spans(F.col("text")).alias("base"),
        mentions(F.col("text")).alias("mentions")), "pii")
    # Base spans are the seeds; a mention that touches none is a candidate.
    apart = lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    fields = ["start", "end", "value", "pattern"]
    of = lambda spans, seed: found.select("row", F.explode(spans).alias("m")).select(
        "row", *[F.col(f"m.{f}").alias(f) for f in fields], F.lit(seed).alias("seed"))
    each = stash(spark, of(F.col("base"), True).unionAll(of(F.filter("mentions", apart), False)), "pii-mentions")
    graph = each.groupBy("pattern", "value").agg(F.max("seed").alias("seed"))
    patterns = score_graph(graph, rounds, sure, least_seeds)
    new = each.where(~F.col("seed")).join(patterns, "pattern").groupBy("row").agg(F.collect_list(F.struct(
        "start", F.lit(len(KINDS)).alias("order"), "end", F.lit("context").alias("kind"))).alias("new"))
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["order"].alias("order"),
                                                   s["end"].alias("end"), s["kind"].alias("kind")))
    joined = found.select("row", "doc_id", plain.alias("base")).join(new, "row", "left")
    spans = F.array_sort(F.when(F.col("new").isNull(), F.col("base")).otherwise(F.concat("base", "new")))
    return joined.select("doc_id", F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))).alias("spans"))


def op3_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(spark, table(spark, sf_dir, "documents"))
    text = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "context")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"), count("context").alias("n_context"))
