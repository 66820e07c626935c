"""Fill-in-middle transformation with an indexable skip list per text.

A text is a row of units (lines by default). Its skip list has the units in
the lowest lane and, in each express lane above, about a quarter of the nodes
below, chosen by a hash of their place. Every link carries two widths: the
units it passes and their code points. A cut is a rank in units; descending
from the topmost lane, following links while the accumulated units stay
within the rank, ends exactly at the rank, with the code points before it. Two
descents give both cuts; nothing is searched for in the text itself.

Ranks, and which form a text gets, come from four numbers of the hex sha256 of
``seed:id``, so a document is transformed alike in every run and at any
partitioning. ``restored`` rebuilds the text from output and form with DataFrame
functions alone: sentinels do not occur in a transformed text, so they part
it unambiguously (``check_sentinels`` refuses sentinels that could overlap).

The transformation is one pass of Arrow batches without a shuffle. A task holds
one batch, and writes its outputs in slices of about ``SLICE_BYTES``.

Defined cases: a null text counts as empty; an empty text, and one that
contains a sentinel, stay as they are (form ``plain``, null widths). A null id
hashes as the empty text. Repeated rows are transformed alike. An empty table
gives an empty result. Other columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .common import table

LINES = r"[^\n]*\n|[^\n]+"
SENTINELS = ("<P>", "<S>", "<M>")          # before prefix, suffix and middle
SEED = 7
RATE, SPM_RATE = 100, 50                   # percent transformed, and of these suffix first
LANE_BITS = 2                              # a lane keeps one node in 2 ** LANE_BITS of the lane below
SLICE_BYTES = 4 << 20


def check_sentinels(sentinels: tuple[str, str, str]) -> None:
    """Refuse sentinels that could begin inside one another or be read in two ways.

    The first character of each may occur at the start of sentinels only, and no
    sentinel may begin with another. Then no occurrence can reach from a text
    into a sentinel or out of one.
    """
    firsts = {s[:1] for s in sentinels}
    if "" in firsts or any(c in s[1:] for s in sentinels for c in firsts) or any(
            a != b and a.startswith(b) or i != j and a == b
            for i, a in enumerate(sentinels) for j, b in enumerate(sentinels)):
        raise ValueError(f"sentinels {sentinels} could overlap")


class SkipList:
    """Indexable skip list over units of the given widths in code points.

    ``lanes`` are bottom first: (units of each link, code points of each link,
    place of each node in the lane below).
    """

    def __init__(self, widths: np.ndarray):
        n = len(widths)
        with np.errstate(over="ignore"):
            coin = (np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
        units, points, coins = np.ones(n, np.int64), widths.astype(np.int64), coin
        self.lanes = [(units, points, None)]
        height = 0
        while len(units) > 1:
            height += LANE_BITS
            raised = (coins & np.uint64((1 << height) - 1)) == 0
            raised[0] = True                                   # the head stands on every lane
            below = np.flatnonzero(raised)
            units, points, coins = np.add.reduceat(units, below), np.add.reduceat(points, below), coins[below]
            self.lanes.append((units, points, below))

    def points_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        node = passed = points = 0
        for units, widths, below in reversed(self.lanes):
            while node < len(units) and passed + units[node] <= rank:
                passed += int(units[node])
                points += int(widths[node])
                node += 1
            if below is not None:
                # Beyond the last node of a lane nothing is left below either.
                node = int(below[node]) if node < len(below) else len(self.lanes[0][0])
            if passed == rank:
                break
        return points


def unit_widths(text: str, pattern: str = LINES) -> np.ndarray:
    """Code points of each unit, left to right; the units make up the whole text."""
    if pattern == LINES:
        widths = np.fromiter(map(len, text.split("\n")), np.int64) + 1
        widths[-1] -= 1                                        # nothing, or a last line without line end
        return widths if widths[-1] else widths[:-1]
    widths = np.array([len(m.group()) for m in re.finditer(pattern, text)], np.int64)
    if widths.sum() != len(text):
        raise ValueError(f"units {pattern!r} do not cover the text")
    return widths


def cut(text: str, h1: int, h2: int, pattern: str = LINES) -> tuple[int, int, int]:
    """(units, code points of the prefix, code points of prefix and middle)."""
    widths = unit_widths(text, pattern)
    n = len(widths)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n:
        return 0, 0, 0
    index = SkipList(widths)
    return n, index.points_before(low), index.points_before(high)


def draws(id_col: str, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers of a document's id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE,
                   sentinels: tuple[str, str, str] = SENTINELS, pattern: str = LINES,
                   names: tuple[str, str, str, str, str] = ("n", "form", "prefix_chars", "middle_chars", "output"),
                   keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default) and five columns called ``names``: units, form
    (plain, psm or spm), code points of prefix and middle (null if plain), transformed text."""
    check_sentinels(sentinels)
    before, after, middle_mark = sentinels
    columns = docs.columns if keep is None else keep
    h = draws(id_col, seed)
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns], F.lit(0).alias("__none")).alias("row"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        h[0].alias("h1"), h[1].alias("h2"),
        (h[2] % 100 < rate).alias("taken"), (h[3] % 100 < spm_rate).alias("suffix_first"))

    def transform(text, h1, h2, taken, suffix_first):
        n, a, b = cut(text, h1, h2, pattern)
        if not text or not taken or any(s in text for s in sentinels):
            return n, "plain", None, None, text
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        out = f"{after}{suffix}{before}{prefix}{middle_mark}{middle}" if suffix_first else \
            f"{before}{prefix}{after}{suffix}{middle_mark}{middle}"
        return n, "spm" if suffix_first else "psm", a, b - a, out

    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())

    def run(batches):
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("text", "h1", "h2", "taken", "suffix_first")))
            done, start, size = [], 0, 0
            for i, row in enumerate(rows, 1):
                done.append(transform(*row))
                size += len(row[0])
                if size >= SLICE_BYTES or i == b.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [b.column("row").slice(start, i - start),
                         *(pa.array(c, k) for c, k in zip(zip(*done), kinds))],
                        names=["row", "n", "form", "prefix", "middle", "output"])
                    done, start, size = [], i, 0

    schema = T.StructType([packed.schema["row"], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                           T.StructField("prefix", T.LongType()), T.StructField("middle", T.LongType()),
                           T.StructField("output", T.StringType())])
    return packed.mapInArrow(run, schema).select(
        *[F.col("row").getField(c).alias(c) for c in columns],
        *[F.col(c).alias(name) for c, name in zip(("n", "form", "prefix", "middle", "output"), names)])


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text before the transformation, from its output and form."""
    check_sentinels(sentinels)
    parts = F.split(output, "|".join(f"\\Q{s}\\E" for s in sentinels), -1)     # '', two outer parts, middle
    part = lambda i: F.get(parts, F.lit(i))
    return (F.when(form == "psm", F.concat(part(1), part(3), part(2)))
            .when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = fill_in_middle(spark, docs, keep=["doc_id"])
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP11_SQL = """
WITH base AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS h FROM documents),
drawn AS (SELECT doc_id, t, string_split(t, chr(10)) AS p,
    CASE WHEN t = '' THEN 0 ELSE len(string_split(t, chr(10))) - (right(t, 1) = chr(10))::INT END AS n,
    ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3,
    ('0x' || h[25:32])::BIGINT AS h4 FROM base),
ranked AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM drawn),
cut AS (SELECT *, CASE WHEN a = 0 THEN '' ELSE array_to_string(p[1:a], chr(10)) || CASE WHEN a < len(p) THEN chr(10) ELSE '' END END AS pre,
    CASE WHEN b = 0 THEN '' ELSE array_to_string(p[1:b], chr(10)) || CASE WHEN b < len(p) THEN chr(10) ELSE '' END END AS upto,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
         WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM ranked),
parts AS (SELECT *, substr(upto, length(pre) + 1) AS mid, substr(t, length(upto) + 1) AS suf FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
           ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts
"""
