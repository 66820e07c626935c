"""Secret scan: fixed patterns plus a randomness test battery.

Three fixed patterns find the usual forms (assigned passwords and tokens,
access keys, long hexadecimal strings). The battery looks at every other long
token. Its encoding is inferred (hexadecimal, base 32, 36, 62, 64, URL-safe
64) from its body, the characters without separators and after a word prefix
(``sk_``): numbers and plain words have none and are not tested. Three tests are
made against a uniform alphabet of that encoding: chi-squared over the
alphabet (with exact small-sample moments: the statistic is a linear function
of the number of equal character pairs), runs above and below the middle of
the alphabet, and lag-one serial correlation. A token that the combined tests
reject as random is dropped. For the others the question is whether ordinary
text could look so even: its null distribution has the character frequencies
of the whole corpus, and a token of that kind and length has a p-value under
it. Short tokens can hardly be told apart and long ones easily, so false
discoveries are controlled (Benjamini-Hochberg) in strata of length. Runs and serial
correlation serve the first question, rejecting what is not random; the p-values
under control come from the equal pairs alone.

Texts are read once. The driver receives one histogram of p-values (strata x
``BINS`` rows at most) and one table of character counts.

Defined cases: a null text is the empty text. Repeated rows are returned each.
An empty table gives an empty result. Offsets count code points.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import stash, table

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"[0-9a-f]{24,}")       # runs are greedy, so shorter ones are just not found

KINDS = ("assign", "access", "hex", "random")
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WORD = re.compile(r"[A-Za-z]?[a-z]+|[A-Z]+|[0-9]+")

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = (
    ("hex", DIGITS + "abcdef"), ("HEX", DIGITS + "ABCDEF"), ("base32", UPPER + "234567"),
    ("base36", DIGITS + LOWER), ("BASE36", DIGITS + UPPER), ("base62", DIGITS + UPPER + LOWER),
    ("base64", UPPER + LOWER + DIGITS + "+/"), ("base64url", UPPER + LOWER + DIGITS + "-_"),
)
STRATA = (24, 32, 48, 96)               # lengths at which the next stratum begins
STEPS_PER_DECADE, DECADES = 40, 30
BINS = STEPS_PER_DECADE * DECADES
FALSE_DISCOVERIES = 0.01
BATTERY_LEAST = 0.001


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns."""
    found = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return found


def infer_encoding(token: str) -> int | None:
    """Index of the first (smallest) alphabet that holds the token; None for numbers and words."""
    if all(WORD.fullmatch(part) for part in re.split(r"[+/_-]+", token) if part):
        return None
    chars = set(token)
    return next((i for i, (_, letters) in enumerate(ALPHABETS) if chars <= set(letters)), None)


def body(token: str) -> str:
    """``token`` without the separators - and _, and without the words it begins with.

    A leading run of letters is a word if it is no group of a grouped key, as its
    length or letters are not those of the rest; at least 16 characters stay after it.
    """
    parts = [p for p in re.split("[-_]+", token) if p]
    while len(parts) > 1 and parts[0].isalpha() and WORD.fullmatch(parts[0]):
        rest = "".join(parts[1:])
        smallest = lambda s: next((i for i, (_, a) in enumerate(ALPHABETS) if set(s) <= set(a)), None)
        if len(rest) < 16 or (len(parts[0]) == len(parts[1]) and smallest(rest) == smallest(parts[0] + rest)):
            break
        parts = parts[1:]
    return "".join(parts)


def statistics(token: str, encoding: int) -> tuple[int, float, float]:
    """(equal character pairs, z of the runs test, z of the serial correlation)."""
    letters = ALPHABETS[encoding][1]
    at = np.array([letters.index(c) for c in token], dtype=np.float64)
    n = len(at)
    counts = np.unique(at, return_counts=True)[1]
    pairs = int((counts * (counts - 1) // 2).sum())
    high = at >= len(letters) / 2
    a, b = int(high.sum()), int(n - high.sum())
    if a and b:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * a * b / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        z_runs = (runs - mean) / math.sqrt(var) if var > 0 else 0.0
    else:
        z_runs = -math.sqrt(n)
    d = at - at.mean()
    z_serial = ((d[1:] * d[:-1]).sum() / (d ** 2).sum() + 1 / n) * math.sqrt(n) if d.any() else math.sqrt(n)
    return pairs, z_runs, z_serial


def _gamma_below(x: float, mean: float, var: float) -> float:
    """P(X <= x) for a gamma variable of these moments (Wilson-Hilferty)."""
    if mean <= 0 or var <= 0:
        return 1.0
    shape = mean * mean / var
    z = ((max(x, 1e-9) / mean) ** (1 / 3) - 1 + 1 / (9 * shape)) * 3 * math.sqrt(shape)
    return max(1e-300, 0.5 * math.erfc(-z / math.sqrt(2)))


def _pair_moments(n: int, freq: np.ndarray) -> tuple[float, float]:
    """Mean and variance of the number of equal pairs among ``n`` draws."""
    two, three = float((freq ** 2).sum()), float((freq ** 3).sum())
    pairs, triples = n * (n - 1) / 2, n * (n - 1) * (n - 2) / 6
    return pairs * two, pairs * (two - two * two) + 6 * triples * (three - two * two)


def battery_p(n: int, encoding: int, pairs: int, z_runs: float, z_serial: float) -> float:
    """Combined p-value of the three tests under a uniform alphabet (Cauchy combination)."""
    k = len(ALPHABETS[encoding][1])
    mean, var = _pair_moments(n, np.full(k, 1 / k))
    too_uneven = max(1e-300, 1 - _gamma_below(pairs - 0.5, mean, var))
    ps = [too_uneven, math.erfc(abs(z_runs) / math.sqrt(2)), math.erfc(abs(z_serial) / math.sqrt(2))]
    t = sum(math.tan((0.5 - min(max(p, 1e-15), 0.99)) * math.pi) for p in ps) / 3
    return 0.5 - math.atan(t) / math.pi


def ordinary_frequencies(encoding: int, corpus: np.ndarray) -> np.ndarray:
    """Frequencies of an alphabet's characters in ordinary text, from the corpus counts of ASCII.

    A letter counts in either case; an alphabet with both cases splits it as the corpus does.
    """
    letters = ALPHABETS[encoding][1]
    upper, lower = corpus[65:91].sum() + 1.0, corpus[97:123].sum() + 1.0
    both = any(c.isupper() for c in letters) and any(c.islower() for c in letters)
    freq = np.array([corpus[ord(c)] + corpus[ord(c.swapcase())] if c.isalpha() else corpus[ord(c)]
                     for c in letters]) + 1.0
    if both:
        freq *= [upper / (upper + lower) if c.isupper() else lower / (upper + lower) if c.islower() else 1.0
                 for c in letters]
    return freq / freq.sum()


def ordinary_p(n: int, pairs: int, frequencies: np.ndarray) -> float:
    """Chance that ordinary characters of these frequencies give so few equal pairs."""
    return _gamma_below(pairs + 0.5, *_pair_moments(n, frequencies))


def stratum(n: int) -> int:
    return sum(n >= s for s in STRATA)


def _bin(p: float) -> int:
    """0 (p near 1) to BINS - 1 (smallest); p of a bin is at most 10 ** (-bin / STEPS_PER_DECADE)."""
    return min(BINS - 1, int(-math.log10(max(p, 1e-300)) * STEPS_PER_DECADE))


def discovery_bins(histogram: list[tuple[int, int, int]], level: float = FALSE_DISCOVERIES) -> list[int]:
    """Benjamini-Hochberg in each stratum: the least bin that counts as a discovery."""
    least = []
    for s in range(len(STRATA) + 1):
        counts = np.zeros(BINS, dtype=np.int64)
        for t, b, n in histogram:
            if t == s:
                counts[b] += n
        below = counts[::-1].cumsum()[::-1]                     # tokens with p in this bin or a smaller one
        bound = 10.0 ** (-np.arange(BINS) / STEPS_PER_DECADE)
        ok = (below > 0) & (bound * counts.sum() <= level * below)
        least.append(int(np.argmax(ok)) if ok.any() else BINS)
    return least


SCANNED = ("row long, doc_id long, base array<struct<start:int,end:int,kind:string>>, "
           "tokens array<struct<start:int,end:int,encoding:int,n:int,pairs:int,runs:double,serial:double>>, "
           "characters array<long>")
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
_TOKENS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("encoding", pa.int32()),
                              ("n", pa.int32()), ("pairs", pa.int32()), ("runs", pa.float64()),
                              ("serial", pa.float64())]))


def scan_text(text: str) -> tuple[list[tuple], list[tuple]]:
    """(base spans, statistics of the tokens outside them)."""
    base = base_spans(text)
    tokens = []
    for m in TOKEN.finditer(text):
        start, end = m.span()
        core = m[0].rstrip("=").strip("-_/+")
        if len(core) < 16 or any(s < end and start < e for s, e, _ in base):
            continue
        if infer_encoding(core) is None:
            continue
        core = body(core)
        encoding = infer_encoding(core)
        if encoding is not None:
            tokens.append((start, end, encoding, len(core), *statistics(core, encoding)))
    return base, tokens


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document, and one row (doc_id null, row -1) per batch with its character counts."""
    def run(batches):
        for b in batches:
            texts = pc.fill_null(b.column(2), "")
            found = [scan_text(t) for t in texts.to_pylist()]
            raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
            n = len(texts)
            counts = np.bincount(raw, minlength=256)[:128] if len(raw) else np.zeros(128, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([b.column(0), pa.array([-1], pa.int64())]),
                 pa.concat_arrays([b.column(1), pa.array([None], pa.int64())]),
                 pa.array([[dict(zip(("start", "end", "kind"), s)) for s in f[0]] for f in found] + [[]], _SPANS),
                 pa.array([[dict(zip(("start", "end", "encoding", "n", "pairs", "runs", "serial"), t)) for t in f[1]]
                           for f in found] + [[]], _TOKENS),
                 pa.array([None] * n + [counts.tolist()], pa.list_(pa.int64()))],
                names=["row", "doc_id", "base", "tokens", "characters"])
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCANNED)


def find_secrets(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 level: float = FALSE_DISCOVERIES) -> DataFrame:
    """One row per document: doc_id and spans (array of start, end, kind), fixed patterns and discoveries."""
    scanned = stash(spark, scan(docs, id_col, text_col), "secrets")
    characters = scanned.where("row = -1").select(F.posexplode("characters").alias("c", "n")) \
        .groupBy("c").agg(F.sum("n").alias("n")).collect()                       # 128 rows
    corpus = np.zeros(128)
    for r in characters:
        corpus[r["c"]] = r["n"]

    ordinary = [ordinary_frequencies(e, corpus) for e in range(len(ALPHABETS))]

    def judged(t) -> tuple[int, int]:
        """(stratum, bin), or bin -1 for a token that is not random."""
        if battery_p(t["n"], t["encoding"], t["pairs"], t["runs"], t["serial"]) < BATTERY_LEAST:
            return stratum(t["n"]), -1
        return stratum(t["n"]), _bin(ordinary_p(t["n"], t["pairs"], ordinary[t["encoding"]]))

    def tally(batches):
        for b in batches:
            found = [judged(t) for tokens in b.column(0).to_pylist() for t in tokens]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int32()), pa.array([max(0, f[1]) for f in found], pa.int32())],
                names=["stratum", "bin"])

    with_tokens = scanned.where(F.size("tokens") > 0)
    histogram = with_tokens.select("tokens").mapInArrow(tally, "stratum int, bin int") \
        .groupBy("stratum", "bin").agg(F.count(F.lit(1)).alias("n")).collect()    # strata x BINS rows at most
    least = discovery_bins([(r["stratum"], r["bin"], r["n"]) for r in histogram], level)

    def discover(batches):
        for b in batches:
            out = []
            for base, tokens in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                new = [{"start": t["start"], "end": t["end"], "kind": "random"} for t in tokens
                       if (j := judged(t))[1] >= least[j[0]]]
                out.append(sorted(base + new, key=lambda s: (s["start"], KINDS.index(s["kind"]))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, _SPANS)], names=["doc_id", "spans"])

    return scanned.where("row >= 0").select("doc_id", "base", "tokens").mapInArrow(
        discover, "doc_id long, spans array<struct<start:int,end:int,kind:string>>")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(spark, table(spark, sf_dir, "documents"))
    text = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
        count("random").alias("n_random"))
