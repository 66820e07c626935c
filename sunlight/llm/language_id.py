"""Language identification by hierarchical discrimination.

First the family of the language, then, within the predicted family, linear
support vector machines one versus one separate the closely related
languages. Families are a parameter (language code to family; a code that is
not listed is a family of its own); families among themselves are also
separated one versus one.

Features are relative frequencies of hashed character bigrams and trigrams
over the letters of the whole text, lower-cased, with every run of other
characters as one space. Training rows are drawn by a hash of their id, about
``TRAIN_PER_LANGUAGE`` of each language (a documented bound; of a family with
over ``FAMILY_LANGUAGES`` languages the family machines see that many languages'
worth); labels are those of documents outside the held-out fifth (crc32 of the
id as text, modulo 5, not 0). Each machine is a group fitted by one task from its
two sides; the driver receives weights only. Prediction is one pass of Arrow
batches over all texts, on arrays; the broadcast weights have a fixed size for
each machine.

Defined cases: ``und`` with score 0 if the text is null or has no letter, or
if no labelled document was given. Null labels are not learned. Repeated rows
are predicted each. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .common import restored, stash, table

UNKNOWN = "und"
BUCKETS = 4096
TRAIN_PER_LANGUAGE = 1000
FAMILY_LANGUAGES = 4
CHARS_AT_ONCE = 1 << 20
ROWS_AT_ONCE = 512

# Families of ISO 639-1 codes.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "bg": "slavic",
    "fi": "uralic", "et": "uralic", "hu": "uralic",
}


def held_out(id_col: str = "doc_id") -> Column:
    """Held-out fifth; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")), F.lit(5)) == 0


# -- features --------------------------------------------------------------

def _letters() -> np.ndarray:
    """Code point to lower-case letter, or space; beyond the table letters stand for themselves."""
    out = np.full(0x10000, 32, dtype=np.uint32)
    for c in range(0x10000):
        if chr(c).isalpha():
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


_LETTERS: list[np.ndarray] = []


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Normalised code points of the texts, each closed by a space, and their ends."""
    if not _LETTERS:
        _LETTERS.append(_letters())
    joined = "\n".join(texts) + "\n"
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    low = raw < 0x10000
    out = np.where(low, _LETTERS[0][np.where(low, raw, 0)], raw)
    ends = np.cumsum([len(t) + 1 for t in texts])
    keep = out != 32                                    # runs of other characters are one space, none at a start
    keep[1:] |= out[:-1] != 32
    kept_upto = np.r_[0, np.cumsum(keep)]
    return out[keep], kept_upto[ends]


def _grams(points: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the bigram and the trigram that end at each place (from the third)."""
    p = points.astype(np.uint32)
    with np.errstate(over="ignore"):
        two = p[1:-1] * np.uint32(0x85EBCA6B) + p[2:] * np.uint32(0xC2B2AE35)
        three = (two ^ (p[:-2] * np.uint32(0x27D4EB2F))) * np.uint32(0x9E3779B1)
        two = two * np.uint32(0x9E3779B1)
    return (two >> np.uint32(8)) % np.uint32(buckets), (three >> np.uint32(8)) % np.uint32(buckets)


def _blocks(texts: list[str]):
    """Ranges of texts of about ``CHARS_AT_ONCE`` characters."""
    start, chars = 0, 0
    for i, t in enumerate(texts):
        chars += len(t) + 1
        if chars >= CHARS_AT_ONCE:
            yield start, i + 1
            start, chars = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def features(texts: list[str], buckets: int = BUCKETS) -> np.ndarray:
    """Frequencies of the grams of each text, (texts, buckets)."""
    out = np.zeros((len(texts), buckets), dtype=np.float32)
    for i, t in enumerate(texts):
        points, _ = _points([t])
        if len(points) >= 3:
            two, three = _grams(points, buckets)
            n = np.bincount(two, minlength=buckets) + np.bincount(three, minlength=buckets)
            out[i] = n / n.sum()
    return out


def margins(texts: list[str], weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """(texts, machines) values of the linear machines, without building the feature matrix."""
    out = np.tile(bias, (len(texts), 1))
    for lo, hi in _blocks(texts):
        points, ends = _points(texts[lo:hi])
        if len(points) < 3:
            continue
        starts = np.r_[0, ends[:-1]]
        two, three = _grams(points, len(weights))
        first = np.minimum(starts, len(two))
        last = np.maximum(np.minimum(ends - 2, len(two)), first)   # grams inside a text only
        n = 2 * (last - first)
        for k in range(weights.shape[1]):
            each = weights[:, k][two] + weights[:, k][three]
            upto = np.r_[0.0, np.cumsum(each, dtype=np.float64)]
            out[lo:hi, k] += (upto[last] - upto[first]) / np.maximum(n, 1)
    return out


# -- machines --------------------------------------------------------------

class SparseRows:
    """Feature rows by their non-zero cells; products are formed ``ROWS_AT_ONCE`` rows at a time."""

    def __init__(self, cells: list[bytes], shares: list[bytes], buckets: int = BUCKETS):
        self.shape = (len(cells), buckets)
        self.cells = np.frombuffer(b"".join(cells), "<u2")
        self.shares = np.frombuffer(b"".join(shares), "<f2").astype(np.float32)
        self.upto = np.r_[0, np.cumsum([len(c) // 2 for c in cells])].astype(np.int64)

    def _blocks(self):
        for lo in range(0, self.shape[0], ROWS_AT_ONCE):
            rows = slice(lo, min(lo + ROWS_AT_ONCE, self.shape[0]))
            part = slice(self.upto[rows.start], self.upto[rows.stop])
            yield rows, self.cells[part], self.shares[part], self.upto[rows.start:rows.stop + 1] - self.upto[rows.start]

    def mean_square(self) -> float:
        return float(np.square(self.shares, dtype=np.float64).sum() / max(1, self.shape[0]))

    def dot(self, w: np.ndarray) -> np.ndarray:
        out = np.empty(self.shape[0])
        for rows, cells, shares, upto in self._blocks():
            sums = np.r_[0.0, np.cumsum(w[cells] * shares)]
            out[rows] = sums[upto[1:]] - sums[upto[:-1]]
        return out

    def pull(self, r: np.ndarray) -> np.ndarray:
        out = np.zeros(self.shape[1])
        for rows, cells, shares, upto in self._blocks():
            out += np.bincount(cells, np.repeat(r[rows], np.diff(upto)) * shares, self.shape[1])
        return out


class DenseRows:
    """The same for a matrix."""

    def __init__(self, x: np.ndarray):
        self.x, self.shape = x, x.shape

    def mean_square(self) -> float:
        return float(np.einsum("ij,ij->i", self.x, self.x).mean())

    def dot(self, w: np.ndarray) -> np.ndarray:
        return self.x @ w

    def pull(self, r: np.ndarray) -> np.ndarray:
        return r @ self.x


def fit_svm(x: "np.ndarray | SparseRows", y: np.ndarray, strength: float = 10.0, rounds: int = 150) -> tuple[np.ndarray, float]:
    """Linear machine for y in {-1, 1}: squared hinge with an L2 penalty, accelerated gradient steps.

    Both sides weigh the same whatever their sizes. Rows are used in place, without a copy.
    """
    rows = DenseRows(x) if isinstance(x, np.ndarray) else x
    scale = np.sqrt(rows.mean_square()) or 1.0
    cost = np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum())) * strength
    step = 1 / (1 + 2 * strength * 2 * 2)
    w, look, t = np.zeros(rows.shape[1] + 1), np.zeros(rows.shape[1] + 1), 1.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (rows.dot(look[:-1] / scale) + look[-1]))
        pull = cost * slack * y
        grad = look - 2 * np.append(rows.pull(pull) / scale, pull.sum())
        new, t_new = look - step * grad, (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w[:-1] / scale, float(w[-1])


class Discriminator:
    """Family machines and, per family, language machines, in one weight matrix.

    ``machines`` holds (name a, name b, column) of each; ``sides`` says which languages
    a machine sees, and on which side.
    """

    def __init__(self, languages: list[str], families: dict[str, str], buckets: int = BUCKETS):
        self.languages = sorted(languages)
        of = {l: families.get(l, l) for l in self.languages}
        self.families = sorted(set(of.values()))
        self.members = {f: [l for l in self.languages if of[l] == f] for f in self.families}
        number = itertools.count()
        pairs = lambda names: [(a, b, next(number)) for a, b in itertools.combinations(names, 2)]
        self.family_machines = pairs(self.families)
        self.language_machines = {f: pairs(ls) for f, ls in self.members.items()}
        count = next(number)
        self.weights, self.bias = np.zeros((buckets, count), np.float32), np.zeros(count)

    def sides(self) -> list[tuple[int, str, float, float]]:
        """(machine, language, side, share of its rows)."""
        rows = []
        for a, b, k in self.family_machines:
            for f, side in ((a, 1.0), (b, -1.0)):
                share = min(1.0, FAMILY_LANGUAGES / len(self.members[f]))
                rows += [(k, l, side, share) for l in self.members[f]]
        for a, b, k in (m for ms in self.language_machines.values() for m in ms):
            rows += [(k, a, 1.0, 1.0), (k, b, -1.0, 1.0)]
        return rows

    @staticmethod
    def _vote(names: list[str], machines, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the name with most votes (then the larger margins) and its confidence, per row."""
        if len(names) == 1:
            return np.zeros(len(m), np.int64), np.ones(len(m))
        votes, worst = np.zeros((len(m), len(names))), np.full((len(m), len(names)), np.inf)
        for a, b, k in machines:
            i, j = names.index(a), names.index(b)
            value = m[:, k]
            votes[:, i] += (value >= 0) + np.tanh(value) * 1e-3
            votes[:, j] += (value < 0) - np.tanh(value) * 1e-3
            worst[:, i] = np.minimum(worst[:, i], value)
            worst[:, j] = np.minimum(worst[:, j], -value)
        best = votes.argmax(axis=1)
        return best, 1 / (1 + np.exp(-4 * np.clip(worst[np.arange(len(m)), best], -20, 20)))

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        m = margins(texts, self.weights, self.bias)
        at, sure = self._vote(self.families, self.family_machines, m)
        lang, score = np.empty(len(texts), object), np.zeros(len(texts))
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(at == f)
            best, inner = self._vote(self.members[name], self.language_machines[name], m[rows])
            lang[rows] = np.array(self.members[name], object)[best]
            score[rows] = sure[rows] * inner
        return lang, score


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def fit(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", families: dict[str, str] = FAMILIES,
        per_language: int = TRAIN_PER_LANGUAGE) -> Discriminator | None:
    """Machines from a bounded sample of the labelled documents that are not held out."""
    known = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull())
    counts = {r["lang"]: r["n"] for r in known.groupBy(F.col(lang_col).cast("string").alias("lang"))
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*[v for l, n in counts.items() for v in (F.lit(l), F.lit(min(1.0, per_language / n)))])
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit("train")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = known.where(draw < F.element_at(share, F.col(lang_col).cast("string")))

    def extract(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                x = features(pc.fill_null(part.column(1), "").to_pylist())
                full = [np.flatnonzero(r) for r in x]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([c.astype("<u2").tobytes() for c in full], pa.binary()),
                     pa.array([r[c].astype("<f2").tobytes() for r, c in zip(x, full)], pa.binary())],
                    names=["lang", "cells", "shares"])

    # About per_language rows of each language, the non-zero frequencies of each.
    rows = stash(spark, sample.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("t"))
                 .mapInArrow(extract, "lang string, cells binary, shares binary"), "language-sample")
    languages = [r["lang"] for r in rows.select("lang").distinct().collect()]
    if not languages:
        return None
    model = Discriminator(languages, families)
    if not len(model.bias):
        return model
    # One row per machine and language.
    sides = spark.createDataFrame(model.sides(), "machine int, lang string, side double, share double")
    taken = F.pmod(F.xxhash64("cells", "shares", "machine"), F.lit(1 << 20)) < F.col("share") * float(1 << 20)
    fitted = rows.join(F.broadcast(sides), "lang").where(taken).select("machine", "side", "cells", "shares") \
        .groupBy("machine").applyInPandas(_fit_machine, "machine int, weights binary, bias double")
    for r in fitted.collect():                                    # the model itself: BUCKETS weights per machine
        model.weights[:, r["machine"]] = np.frombuffer(r["weights"], "<f4")
        model.bias[r["machine"]] = r["bias"]
    return model


def _fit_machine(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One machine from the rows of its two sides, in an order that does not depend on the shuffle."""
    rows = rows.sort_values(["side", "cells", "shares"], kind="stable")
    w, bias = fit_svm(SparseRows(rows["cells"].tolist(), rows["shares"].tolist()), rows["side"].to_numpy())
    return pd.DataFrame({"machine": [key[0]], "weights": [w.astype("<f4").tobytes()], "bias": [bias]})


def identify(spark: SparkSession, docs: DataFrame, model: Discriminator | None, text_col: str = "text",
             names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and its score (columns ``names``)."""
    sent = spark.sparkContext.broadcast(vars(model) if model else None)
    columns = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns if c != text_col],
                                  F.lit(0).alias("__none")).alias("row"),
                         F.col(text_col).cast("string").alias("text"))

    def run(batches):
        machines = restored(Discriminator, sent.value) if sent.value else None
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(lo, ROWS_AT_ONCE)
                texts = b.column("text").to_pylist()
                lang, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
                rows = [i for i, t in enumerate(texts) if has_letter(t)]
                if rows and machines:
                    lang[rows], score[rows] = machines.predict([texts[i] for i in rows])
                yield pa.RecordBatch.from_arrays(
                    [b.column("row"), b.column("text"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    names=["row", "text", "lang", "score"])

    schema = T.StructType([packed.schema["row"], T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])
    return packed.mapInArrow(run, schema).select(
        *[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in columns],
        F.col("lang").alias(names[0]), F.col("score").alias(names[1]))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(spark, docs.select("doc_id", "text"), fit(spark, docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
