"""Mixing to target weights with soft domain membership.

A classifier learned from a labelled table predicts, for every document,
posteriors over domains. Nonnegative document rates are then fitted so that
the expected tokens of each domain, sum of rate x tokens x posterior, match
targets in least squares, by projected-gradient steps on executors. (The
least-squares metric is that of the domains' Gram matrix, so small domains
count as much as large ones.)

Classifier: softmax regression over hashed words, word ends and the share of
different words; buckets whose presence does not differ significantly
between domains (chi-squared) are left out. It is fitted on the driver from a
bounded sample of about ``LABELLED`` labelled documents.

Fit: posteriors are rounded to ``1/CELLS``, documents with equal posteriors
share one rate exactly (steps are scaled by 1/tokens, so the direction
depends on the posterior alone), and so tokens are added up per posterior
cell first. A step is one aggregate over the cells that returns one number
per domain; rates are a fold over the steps' residuals, so nothing is
rewritten between steps. The fit ends within ``TOLERANCE`` of the targets, when the loss no
longer falls, or after ``MOST_STEPS`` steps; ``mix`` returns the targets and the totals reached.

Only DataFrame functions are used. The driver holds the weights (``BUCKETS``
numbers per domain) and one residual vector per step. Broadcasts: the
labelled sample and those weights.

Defined cases: a null or empty text has no tokens but a posterior and a rate
like any other. Labels of unknown documents are ignored; a document labelled
twice counts in each. Without labels all posteriors, and so all rates, are
equal. An empty table gives an empty result. Repeated rows are documents of
their own. Other columns pass through unchanged.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import stash, table

BUCKETS = 1 << 15
LABELLED = 10_000
LEAST_CHI2, LEAST_SEEN = 20.0, 3
CELLS = 1000
MOST_STEPS = 40
TOLERANCE = 5e-4
SHARE_BINS = 10

# Production domains and weights: the labelled table's classes.
DOMAINS = ("good", "poor", "toxic")
WEIGHTS = {"good": 0.90, "poor": 0.08, "toxic": 0.02}


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the table of quality and toxic flags; rows without flags are left out."""
    return labels.where(F.col("toxic").isNotNull() & F.col("quality").isNotNull()).select(
        "doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good")
        .otherwise("poor").alias("domain"))


def _numbers(values: list, kind: str = "double") -> Column:
    """A constant array, as one literal whatever its length."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


# -- features ---------------------------------------------------------------

def with_bag(df: DataFrame, text: Column, buckets: int = BUCKETS) -> DataFrame:
    """``df`` with ``__tokens`` (words of the text) and ``__bag``, its distinct buckets.

    Buckets come from the words as they stand, from their last characters (which
    tell decorated and shouted words) and from the share of different words. Steps are columns of their own, so that a text is cut only once.
    """
    bucket = lambda *x: F.pmod(F.xxhash64(*x), F.lit(buckets)).cast("int")
    words = F.split(F.coalesce(text.cast("string"), F.lit("")), r"[ \t\n\x0b\f\r]+")
    edge = lambda at: (F.element_at("__words", F.lit(at)) == "").cast("int")
    return (df.withColumn("__words", words)
            .withColumn("__own", F.array_distinct(F.transform("__words", lambda w: bucket(w))))
            .withColumn("__ends", F.array_distinct(F.transform("__words", lambda w: bucket(F.lit(1), F.substring(w, -1, 1)))))
            .withColumn("__tokens", F.greatest(F.lit(0), F.size("__words") - edge(1) - edge(-1)).cast("long"))
            .withColumn("__bag", F.array_distinct(F.concat("__own", "__ends", F.array(bucket(
                F.lit(2), F.floor(F.size("__own") / F.size("__words") * SHARE_BINS))))))
            .drop("__words", "__own", "__ends"))


def learn(spark: SparkSession, docs: DataFrame, labelled: DataFrame, domains: tuple[str, ...] = DOMAINS,
          id_col: str = "doc_id", text_col: str = "text", rows: int = LABELLED,
          buckets: int = BUCKETS) -> tuple[list[float], list[list[float]]]:
    """(bias, per domain the weight of each bucket) from a bounded sample of labels."""
    known = labelled.where(F.col("domain").isin(*domains) & F.col("doc_id").isNotNull()).distinct()
    n = known.count()
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("mix")), F.lit(1 << 24)) / F.lit(float(1 << 24))
    sample = known.where(draw < min(1.0, rows / max(1, n))).select(F.col("doc_id").alias("__id"), "domain")
    # About ``rows`` rows of two values, whatever the input.
    bags = stash(spark, with_bag(
        docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(sample), "__id"),
        F.col("__text"), buckets).select("domain", F.col("__bag").alias("bag")), "mix-bags")
    sizes = {r["domain"]: r["n"] for r in bags.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    if not total:
        return [0.0] * len(domains), [[0.0] * buckets for _ in domains]
    counts = bags.select("domain", F.explode("bag").alias("b")).groupBy("b") \
        .pivot("domain", list(domains)).agg(F.count(F.lit(1))).na.fill(0)
    # Documents of a domain with a bucket against those of the others: chi-squared of the two-by-two table.
    every = sum((F.col(d) for d in domains), F.lit(0))
    strength = []
    for d in domains:
        size, inside = sizes.get(d, 0), F.col(d)
        cross = inside * float(total) - every * float(size)
        spread = every * (float(total) - every) * float(size) * float(total - size)
        strength.append(F.when(spread > 0, cross * cross * float(total) / spread).otherwise(0.0))
    strong = F.greatest(*strength) if len(domains) > 1 else strength[0]
    told = sorted(r["b"] for r in counts.where((strong >= LEAST_CHI2) & (every >= LEAST_SEEN)).select("b").collect())
    flags = _numbers([int(f) for f in np.isin(np.arange(buckets), told)], "boolean")
    sample_rows = bags.select("domain", F.filter("bag", lambda b: F.get(flags, b)).alias("hits")).collect()
    bias, found = fit_softmax([domains.index(r["domain"]) for r in sample_rows], [r["hits"] for r in sample_rows],
                              told, len(domains))
    weights = np.zeros((len(domains), buckets))
    weights[:, told] = found
    return bias.tolist(), weights.tolist()


def fit_softmax(domain: list[int], hits: list[list[int]], features: list[int], domains: int,
                rounds: int = 300, rate: float = 0.5, penalty: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """(bias, weights by domain and feature) of a softmax regression on binary features, by scaled gradient steps."""
    y = np.eye(domains)[domain]
    row = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    column = np.searchsorted(features, np.array([b for h in hits for b in h], dtype=np.int64))
    w, bias = np.zeros((len(features), domains)), np.zeros(domains)
    w_scale, b_scale = np.full_like(w, 1e-8), np.full_like(bias, 1e-8)
    for _ in range(rounds):
        z = np.column_stack([np.bincount(row, w[column, k], len(hits)) for k in range(domains)]) + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        off = (p / p.sum(axis=1, keepdims=True) - y) / len(hits)
        grad = np.column_stack([np.bincount(column, off[row, k], len(features)) for k in range(domains)]) + penalty * w
        w_scale += grad ** 2
        w -= rate * grad / np.sqrt(w_scale)
        grad = off.sum(axis=0)
        b_scale += grad ** 2
        bias -= rate * grad / np.sqrt(b_scale)
    return bias, w.T


def posteriors(docs: DataFrame, prior: list[float], weights: list[list[float]], text_col: str = "text",
               cells: int = CELLS) -> DataFrame:
    """``docs`` with ``__tokens`` (words of the text) and ``__cell`` (posteriors in units of 1/cells)."""
    buckets = len(weights[0])
    # Flags say which buckets carry weight; the few that do are looked up.
    flags = _numbers([int(any(w[b] != 0.0 for w in weights)) for b in range(buckets)], "boolean")
    tables = [_numbers(w) for w in weights]
    hits = F.filter("__bag", lambda b: F.get(flags, b))
    logs = F.aggregate(hits, _numbers([float(p) for p in prior]), lambda acc, b: F.array(
        *[F.get(acc, F.lit(k)) + F.get(t, b) for k, t in enumerate(tables)]))
    scored = with_bag(docs, F.col(text_col), buckets).withColumn("__logs", logs).drop("__bag")
    odds = F.transform("__logs", lambda v: F.exp(v - F.array_max("__logs")))
    total = F.aggregate(odds, F.lit(0.0), lambda a, v: a + v)
    return scored.withColumn("__cell", F.transform(odds, lambda v: F.round(v / total * cells).cast("int"))) \
        .drop("__logs")


# -- the fit ----------------------------------------------------------------

def _dot(cell: Column, values: list[float], cells: int) -> Column:
    return sum((F.get(cell, F.lit(k)) * F.lit(float(v) / cells) for k, v in enumerate(values)), F.lit(0.0))


def rate_of(cell: Column, steps: list[list[float]], cells: int = CELLS, most: float = math.inf) -> Column:
    """Rate of a posterior cell: steps projected to 0 and ``most``, one after the other, from rate 1."""
    if not steps:
        return F.lit(1.0)
    width = len(steps[0])
    moves = _numbers([float(v) for step in steps for v in step])
    along = lambda s: sum((F.get(cell, F.lit(k)) * F.get(moves, s * width + k)
                           for k in range(width)), F.lit(0.0)) / F.lit(float(cells))
    project = (lambda r: F.greatest(F.lit(0.0), r)) if most == math.inf else \
        (lambda r: F.greatest(F.lit(0.0), F.least(F.lit(float(most)), r)))
    return F.aggregate(F.sequence(F.lit(0), F.lit(len(steps) - 1)), F.lit(1.0),
                       lambda rate, s: project(rate - along(s)))


def fit_rates(cells_table: DataFrame, targets: list[float], cells: int = CELLS, most_steps: int = MOST_STEPS,
              tolerance: float = TOLERANCE) -> tuple[list[list[float]], list[float]]:
    """(steps for ``rate_of``, reached totals). ``cells_table``: cell (array of int), tokens.

    A step moves along the gradient in the metric of the Gram matrix of the
    rates above zero, which is exact until a rate reaches zero. Should the loss
    grow, the remaining steps use the Gram matrix of all rates, whose steps never
    grow it.
    """
    width = len(targets)
    share = lambda k: F.get("cell", F.lit(k)) / F.lit(float(cells))
    weight = lambda i, j: F.col("tokens") * share(i) * share(j)
    pairs = [(i, j) for i in range(width) for j in range(width)]
    wanted, steps, before, careful = np.array(targets), [], math.inf, False
    while True:
        row = cells_table.withColumn("r", rate_of(F.col("cell"), steps, cells)).agg(
            *[F.sum(F.col("r") * F.col("tokens") * share(k)) for k in range(width)],
            *[F.sum(weight(i, j)) for i, j in pairs],
            *[F.sum(F.when(F.col("r") > 0, weight(i, j))) for i, j in pairs]).first()
        numbers = np.array([float(v or 0.0) for v in row])
        reached, off = numbers[:width].tolist(), numbers[:width] - wanted
        every, live = (m.reshape(width, width) for m in np.split(numbers[width:], 2))
        metric = np.linalg.pinv(every, hermitian=True)
        loss = float(off @ metric @ off)
        close = (np.abs(off) <= tolerance * np.maximum(1.0, wanted)).all()
        stalled = before < math.inf and before - loss <= tolerance * before
        if close or len(steps) >= most_steps or (stalled and (careful or loss <= before)):
            break
        careful = careful or stalled
        before = loss
        steps.append(((metric if careful else np.linalg.pinv(live, hermitian=True)) @ off).tolist())
    return steps, reached


def fit_thinning(cells_table: DataFrame, targets: list[float], supply: list[float], cells: int = CELLS,
                 most_steps: int = MOST_STEPS, tolerance: float = TOLERANCE) -> tuple[list[list[float]], list[float]]:
    """(steps for ``rate_of`` with ``most`` 1, reached totals): like ``fit_rates``, with no rate over 1.

    A domain whose target is beyond its supply is aimed at its supply. Residuals
    count by the domain's supply. The steps' metric is that diagonal: posteriors
    add to 1, so no step grows the loss; and as no domain exceeds its supply, no
    step lowers a document that is wholly of a domain aimed at its supply.
    """
    width = len(targets)
    share = lambda k: F.get("cell", F.lit(k)) / F.lit(float(cells))
    have = np.array(supply)
    wanted, steps, before = np.minimum(targets, have), [], math.inf
    scale = np.divide(1.0, have, out=np.zeros(width), where=have > 0)
    while True:
        row = cells_table.withColumn("r", rate_of(F.col("cell"), steps, cells, 1.0)).agg(
            *[F.sum(F.col("r") * F.col("tokens") * share(k)) for k in range(width)]).first()
        reached = np.array([float(v or 0.0) for v in row])
        off = reached - wanted
        loss = float((off ** 2 * scale).sum())
        if (np.abs(off) <= tolerance * np.maximum(1.0, wanted)).all() or len(steps) >= most_steps \
                or before - loss <= tolerance * before < math.inf:
            return steps, reached.tolist()
        before = loss
        steps.append((scale * off).tolist())


def mix(spark: SparkSession, docs: DataFrame, labelled: DataFrame, weights: dict[str, float] = WEIGHTS,
        total_tokens: float | None = None, id_col: str = "doc_id", text_col: str = "text",
        keep: list[str] | None = None, cells: int = CELLS,
        keep_domain: str | None = None) -> tuple[DataFrame, list[float], list[float]]:
    """(columns ``keep`` of ``docs``, all by default, with __tokens, __cell and __rate,
    targets, reached totals). Texts are scored once: the result is written before the fit.

    Without ``total_tokens`` the targets add up to the largest total that needs
    no repetition: the document with the highest rate has rate 1. With
    ``keep_domain`` they add up to the total in which that domain's whole supply
    has its weight: only the other domains are lowered, where they are over
    their weight; a domain of less supply than its target stays whole, and its
    target is not reached. Without supply of ``keep_domain`` all rates are 1.
    """
    domains = tuple(weights)
    prior, table_ = learn(spark, docs, labelled, domains, id_col, text_col)
    columns = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]
    scored = stash(spark, posteriors(docs, prior, table_, text_col, cells=cells)
                   .select(*columns, "__tokens", "__cell"), "mix-scored")
    small = stash(spark, scored.select("__cell", "__tokens").groupBy(F.col("__cell").alias("cell"))
                  .agg(F.sum("__tokens").alias("tokens")), "mix-cells")
    have = small.agg(*[F.sum(F.col("tokens") * F.get("cell", F.lit(k)) / cells).alias(d)
                       for k, d in enumerate(domains)]).first()
    whole = sum(weights.values())
    shares = [weights[d] / whole for d in domains]
    supply = [float(have[d] or 0.0) for d in domains]
    if keep_domain is not None:
        at = domains.index(keep_domain)
        total = supply[at] / shares[at]
        targets = [s * total for s in shares]
        steps, reached = fit_thinning(small, targets, supply, cells) if total else ([], supply)
        rate = rate_of(F.col("__cell"), steps, cells, 1.0)
        # Where no document is wholly of the kept domain, the surest ones are to have rate 1.
        top = small.agg(F.max(F.when(F.col("tokens") > 0, rate_of(F.col("cell"), steps, cells, 1.0)))).first()[0]
        if top:
            rate, reached = rate / F.lit(float(top)), [t / top for t in reached]
        return scored.withColumn("__rate", rate), targets, reached
    wanted = [k for k in range(len(domains)) if shares[k] > 0 and supply[k] > 0]
    total = total_tokens if total_tokens is not None else min((supply[k] / shares[k] for k in wanted), default=0.0)
    targets = [s * total for s in shares]
    steps, reached = fit_rates(small, targets, cells)
    rate = rate_of(F.col("__cell"), steps, cells)
    if total_tokens is None and wanted:
        top = small.agg(F.max(F.when(F.col("tokens") > 0, rate_of(F.col("cell"), steps, cells)))).first()[0]
        if top:
            rate = rate / F.lit(float(top))
            targets, reached = [t / top for t in targets], [t / top for t in reached]
    return scored.withColumn("__rate", rate), targets, reached


def sample_by_rate(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows drawn once with the chance of their rate (rates over 1: always), by a hash of the id.

    A row without id is drawn by its place in the table ``mix`` has written.
    """
    drawn = F.when(F.col(id_col).isNull(), F.xxhash64(F.monotonically_increasing_id(), F.lit("draw row"))) \
        .otherwise(F.xxhash64(F.col(id_col), F.lit("draw")))
    chance = F.pmod(drawn, F.lit(1 << 30)) / F.lit(float(1 << 30))
    return mixed.withColumn("__chance", chance).where("__chance < __rate") \
        .drop("__tokens", "__cell", "__rate", "__chance")


def op2_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    mixed, _, _ = mix(spark, docs, label_domains(table(spark, sf_dir, "labels")), keep=["doc_id"])
    return mixed.select("doc_id", F.col("__tokens").alias("n_tokens"),
                        *[(F.get("__cell", F.lit(k)) / F.lit(float(CELLS))).alias(f"p_{d}")
                          for k, d in enumerate(WEIGHTS)], F.col("__rate").alias("rate"))
