"""Best-fit decreasing packing of tokenised documents into sequences.

Tokenising is one pass of Arrow batches: texts are split at white space, each
distinct word of a slice is encoded once (and kept in a bounded cache of the
worker), and ids are gathered by array indexing. Only documents longer than a
sequence are cut. Packing deals the pieces, by a hash, to chunks of about
``PIECES_PER_CHUNK``; each chunk is packed by best-fit decreasing with a
segment tree over remaining capacities, which finds the tightest open
sequence in logarithmic time. A chunk leaves about one sequence partly
filled (with pieces of 500 tokens 0.1 % of its sequences, with pieces of 50 tokens
1 %), and bounds a task's memory at any size of the input. ``WordEncoder`` knows the
rules of the production tokenizer's file; other files need their own. Placement moves only (row id, length); ids stay where they are
until ``packed_sequences`` joins them.

Defined cases: a null text is the empty text and gives the end id alone.
Repeated rows are packed each. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import sys
import types
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import stash, table

CAPACITY = 4096
END_ID = 1
PIECES_PER_CHUNK = 8192
SLICE_BYTES = 2 << 20
CACHED_WORDS, CACHED_PARTS = 200_000, 400_000
CACHED_LENGTH = 64

# Letters of one Latin-1 word with closing punctuation: the tokenizer's own
# rules make one part of the letters and one of the punctuation.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([,.;:!?|*#$%&()]*)")
# White space for Python and Arrow, or the start of a special token: encode whole.
_ODD = "<\\||[\x1c-\x1f]"


class WordEncoder:
    """Ids of texts by the tokenizer, through a cache of white-space words.

    Holds for tokenizers that never let a token cross white space; the
    operator is tested against the plain encoding of whole texts.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        # Byte-level alphabet: printable bytes stand for themselves, others follow U+0100.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        odd = [b for b in range(256) if b not in set(plain)]
        self.alphabet = {b: 256 + i for i, b in enumerate(odd)}

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def part(self, part: str) -> bytes:
        got = self.parts.get(part)
        if got is None:
            mapped = part.encode().decode("latin-1").translate(self.alphabet)
            got = np.array([t.id for t in self.tokenizer.model.tokenize(mapped)], dtype="<u4").tobytes()
            self.parts[part] = got
        return got

    def word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            m = _PLAIN.fullmatch(word)
            if m and len(word) <= CACHED_LENGTH:
                letters, marks = m.groups()
                got = self.part(letters.lower()) + (self.part(marks) if marks else b"")
            else:
                got = self.whole(word) if word else b""
            if len(word) <= CACHED_LENGTH:
                self.words[word] = got
        return got

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, offsets of the texts in them)."""
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        if len(self.parts) > CACHED_PARTS:
            self.parts.clear()
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        if odd.any():
            texts_plain = pc.if_else(pa.array(odd), "", texts)
        else:
            texts_plain = texts
        split = pc.utf8_split_whitespace(texts_plain)
        coded = pc.dictionary_encode(split.flatten())
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        own = [self.word(w) for w in coded.dictionary.to_pylist()]
        n_of = np.array([len(x) // 4 for x in own], dtype=np.int64)
        base = np.r_[0, np.cumsum(n_of)]
        ids = np.frombuffer(b"".join(own), dtype="<u4")
        n = n_of[at] if len(at) else np.zeros(0, np.int64)
        upto = np.r_[0, np.cumsum(n)]
        gather = np.repeat(base[at] - upto[:-1], n) + np.arange(upto[-1])
        tokens = ids[gather]
        words_upto = split.offsets.to_numpy() - split.offsets[0].as_py()
        offsets = upto[words_upto]
        if odd.any():
            pieces, total, out = [], 0, [0]
            for i, whole in enumerate(odd.tolist()):
                one = np.frombuffer(self.whole(texts[i].as_py()), "<u4") if whole \
                    else tokens[offsets[i]:offsets[i + 1]]
                pieces.append(one)
                total += len(one)
                out.append(total)
            return np.concatenate(pieces), np.array(out)
        return tokens, offsets


def worker_encoder(spec: str) -> WordEncoder:
    """The encoder of this Python worker: it lives as long as the worker, not the task."""
    held = sys.modules.setdefault("_word_encoders", types.ModuleType("_word_encoders"))
    key = "e" + hashlib.sha256(spec.encode()).hexdigest()
    if key not in vars(held):
        vars(held).clear()
        vars(held)[key] = WordEncoder(spec)
    return vars(held)[key]


def _slices(sizes: np.ndarray):
    """Row ranges of about ``SLICE_BYTES`` each."""
    upto, start = np.cumsum(sizes), 0
    while start < len(sizes):
        done = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, done + SLICE_BYTES, side="right")))
        yield start, end
        start = end


def tokenized_pieces(spark: SparkSession, docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                     text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
                     keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids if ``keep_ids``).

    A document is its ids and then ``end_id``; longer ones than ``capacity``
    are cut into pieces of that length, the last of which may be shorter.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())     # one vocabulary file, a few MB

    def run(batches):
        encoder = worker_encoder(spec.value)
        for b in batches:
            texts = pc.fill_null(b.column(1), "")
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            for lo, hi in _slices(sizes):
                tokens, offsets = encoder.encode(texts.slice(lo, hi - lo))
                cut_ids, row, piece, start, crc, length = [], [], [], [], [], []
                for i in range(hi - lo):
                    ids = np.append(tokens[offsets[i]:offsets[i + 1]], np.uint32(end_id)).astype("<u4")
                    for n, at in enumerate(range(0, len(ids), capacity)):
                        part = ids[at:at + capacity]
                        row.append(lo + i)
                        piece.append(n)
                        start.append(at)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        if keep_ids:
                            cut_ids.append(part.astype(np.int32))
                columns = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                           pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array(cut_ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, schema)


class OpenSequences:
    """Segment tree over remaining capacities: how many open sequences have each."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._add(room, 1)

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Take the open sequence with the least room that holds ``length``: (room, sequence)."""
        count, node = self.count, length + self.size
        while not count[node]:
            while node & 1:          # a right child: its later neighbour hangs higher up
                node >>= 1
            if not node:
                return None
            node += 1
            if node & (node - 1) == 0:   # past the last leaf of this level
                return None
        while node < self.size:
            node <<= 1
            if not count[node]:
                node += 1
        room = node - self.size
        self._add(room, -1)
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length; no length may exceed ``capacity``."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, made = OpenSequences(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        found = tree.tightest(length)
        if found is None:
            room, at = capacity, made
            made += 1
        else:
            room, at = found
        sequence[i], offset[i] = at, capacity - room
        if room > length:
            tree.put(room - length, at)
    return sequence, offset


def best_fit_pack(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY,
                  pieces_per_chunk: int = PIECES_PER_CHUNK) -> DataFrame:
    """``pieces`` (any columns, one of them ``length``) with sequence_id and offset."""
    held = stash(spark, pieces.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    chunks = max(1, round(held.count() / pieces_per_chunk))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("__row", ignore_index=True)
        sequence, offset = best_fit_decreasing(rows["length"].to_numpy(), capacity)
        return pd.DataFrame({"__row": rows["__row"], "sequence_id": (np.int64(key[0]) << 32) + sequence,
                             "offset": offset})

    placed = held.select("__row", "length", F.pmod(F.xxhash64("__row"), F.lit(chunks)).alias("__chunk")) \
        .groupBy("__chunk").applyInPandas(pack, "__row long, sequence_id long, offset long")
    return held.join(placed, "__row").drop("__row")


def packed_sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, ids (its pieces' ids in order of offset)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Pieces of ``docs`` (see ``tokenized_pieces``) with their place in a sequence."""
    return best_fit_pack(spark, tokenized_pieces(spark, docs, tokenizer_path))


def production_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack_documents(spark, docs, production_tokenizer()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
