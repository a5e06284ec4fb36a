"""Packing documents into sequences by cutting-stock column generation.

A document's ids are cut into full sequences and one rest; the lengths of all
pieces, rounded up to ``grain``, form a histogram of at most capacity / grain
classes. The cutting-stock linear program over that histogram (rows: classes,
columns: patterns of classes that fit one sequence) is solved by column
generation: a knapsack dynamic program prices new patterns with the duals.
Patterns are rounded down and the few remaining pieces are packed first-fit
decreasing. Only the histogram reaches the driver; its size is fixed by
``grain``. Pieces are ranked within their class in buckets, so no class is
sorted in one task, and the ranks decide the pattern, sequence and slot.

Defined results: a null or empty text is a document of the end id alone;
repeated rows are documents of their own; a null id is an id; an empty table
gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import marks
from .common import arrow_rows, trimmed, write_table
from .words import column_chunks

CACHE_CHARS = 5_000_000  # characters of the words whose ids a task keeps; results don't depend on it
BATCH_ROWS = 2000  # texts that a worker holds
CHUNK_BYTES = 4_000_000  # texts whose new words are encoded together (a longer text alone)
# white space that str.split() and the tokenizer may not treat alike
_ODD_SPACE = "[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]"
_TOKENIZERS: dict = {}


def _byte_letters() -> np.ndarray:
    """The printable character (UTF-16) that stands for each byte in a byte-level
    vocabulary: printable bytes for themselves, the others from 256 on; spaces stay, as they separate words."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    out = np.arange(256)
    out[others] = 256 + np.arange(len(others))
    out[ord(" ")] = ord(" ")
    return out.astype("<u2")


class WordIds:
    """Ids (unsigned little-endian 32-bit) of words, and so of texts whose
    tokenizer never joins characters across white space: each word is encoded
    once and kept until CACHE_CHARS are held or the task ends.

    If the tokenizer lower-cases and splits letters from punctuation, texts are
    lower-cased and cut there first; words of Latin letters or of punctuation
    go to its BPE model directly, many new ones in a call, and all others
    through the whole tokenizer."""

    #: Fixed value: the split of the tokenizer that may take the direct way.
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    _LETTER, _MARK = "[A-Za-zÀ-ÖØ-öø-ÿ]", "[.,;:!?()*$%&#+=/-]"
    _PLAIN = f"^({_LETTER}+|{_MARK}+)$"
    _LETTERS = _byte_letters()

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.tokenizer = Tokenizer.from_str(definition)
        steps = json.loads(definition)
        split = ((steps.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0].get("pattern")
        kinds = [n["type"] for n in (steps.get("normalizer") or {}).get("normalizers", [])]
        suffix = steps["model"].get("end_of_word_suffix")
        self.direct = split == {"Regex": self.SPLIT} and kinds == ["NFC", "Replace", "Lowercase"] and bool(suffix)
        if self.direct:
            self.model = Tokenizer(self.tokenizer.model)  # neither normalizer nor split
            self.model.pre_tokenizer = WhitespaceSplit()
            vocab = steps["model"]["vocab"]
            self.closes = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a word
            self.closes[[k for token, k in vocab.items() if token.endswith(suffix)]] = True
            # marks that join the character before, and tokens looked for before lower-casing
            self.fixed = "|".join(["[\u0300-\u036f]", *(re.escape(t["content"].lower())
                                                       for t in steps.get("added_tokens") or [])])
        self.forget()

    def forget(self) -> None:
        """All words go; the tokenizer stays."""
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.chars = 0

    def __len__(self) -> int:
        return len(self.words)

    @staticmethod
    def cached(definition: str) -> WordIds:
        key = hashlib.md5(definition.encode()).digest()
        if key not in _TOKENIZERS:
            _TOKENIZERS[key] = WordIds(definition)
        return _TOKENIZERS[key]

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _model_ids(self, words: pa.Array, at_once: int = 10_000) -> pa.Array:
        """Ids of words that the split leaves whole."""
        parts = []
        for at in range(0, len(words), at_once):
            raw = np.frombuffer(" ".join(words.slice(at, at_once).to_pylist()).lower().encode(), np.uint8)
            spelled = self._LETTERS[raw].tobytes().decode("utf-16-le")
            parts.append(np.array(self.model.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, "<u4"))
        ids = np.concatenate(parts)
        ends = np.concatenate([[0], np.flatnonzero(self.closes[ids]) + 1]) * 4
        if len(ends) != len(words) + 1:  # a model that leaves out letters
            return pa.array(map(self.whole, words.to_pylist()), pa.large_binary())
        return pa.Array.from_buffers(pa.large_binary(), len(words),
                                     [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids.tobytes())])

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Where the ids of ``words`` (distinct) are held."""
        held = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False).copy()
        new = np.flatnonzero(held < 0)
        if len(new):
            words = words.take(pa.array(new))
            plain = np.zeros(len(new), bool)
            if self.direct:
                plain = pc.match_substring_regex(words, self._PLAIN).to_numpy(zero_copy_only=False)
            ways = [words.filter(pa.array(plain)), words.filter(pa.array(~plain))]
            held[np.concatenate([new[plain], new[~plain]])] = len(self) + np.arange(len(new))
            ids = [self._model_ids(ways[0])] if len(ways[0]) else []
            ids.append(pa.array(map(self.whole, ways[1].to_pylist()), pa.large_binary()))
            self.words, self.ids = pa.concat_arrays([self.words, *ways]), pa.concat_arrays([self.ids, *ids])
            self.chars += pc.sum(pc.utf8_length(words)).as_py()
        return held

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text (null as empty)."""
        if self.chars > CACHE_CHARS:
            self.forget()
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(texts, _ODD_SPACE)
        parts = pc.if_else(odd, "", texts)
        if self.direct:
            lower = pc.ascii_lower(parts)
            cut = pc.replace_substring_regex(lower, f"({self._LETTER})({self._MARK})", r"\1 \2")
            parts = pc.if_else(pc.match_substring_regex(lower, self.fixed), parts, cut)
        parts = pc.ascii_split_whitespace(parts)
        begins, parts = parts.offsets.to_numpy(), parts.flatten().dictionary_encode()
        held = pa.array(self._learn(parts.dictionary)).take(parts.indices)
        ids = self.ids.take(held)
        at = np.concatenate([[0], np.cumsum(pc.binary_length(ids).to_numpy(zero_copy_only=False))])[begins].tolist()
        packed = ids.buffers()[2]
        for k, whole in enumerate(odd.to_pylist()):
            if whole:
                yield self.whole(texts[k].as_py())
            else:
                yield packed[at[k]:at[k + 1]].to_pybytes() if at[k + 1] > at[k] else b""

    def encode(self, text: str) -> bytes:
        return next(self.encode_all(pa.array([text])))


def encode_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 2048,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, length, doc_tokens, ids``: full pieces, then the
    rest, as a written table. The driver reads the tokenizer's definition (a fixed few MB)."""
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds.cached(definition.value)
        try:
            for batch in batches:
                kind = batch.schema.field("doc_id").type
                out, held = [], 0
                encoded = (ids for texts in column_chunks(batch.column("text"), CHUNK_BYTES)
                           for ids in words.encode_all(texts))
                for doc, ids in zip(batch.column("doc_id").to_pylist(), encoded):
                    ids += end
                    n = len(ids) // 4
                    for at in range(0, n, capacity):
                        out.append((doc, at, min(capacity, n - at), n, ids[4 * at:4 * (at + capacity)]))
                    held += len(ids)
                    if held > 4_000_000:
                        yield _pieces(out, kind)
                        out, held = [], 0
                if out:
                    yield _pieces(out, kind)
        finally:
            words.forget()  # the worker outlives the task

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    pieces = rows.mapInArrow(trimmed(cut), f"doc_id {kind}, start long, length long, doc_tokens long, ids binary")
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        return write_table(pieces, "pack-pieces")


def _pieces(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = [("doc_id", kind), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
             ("ids", pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), types)],
                                      schema=pa.schema(types))


def best_pattern(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: class k (1..capacity) has size k and value
    ``values[k - 1]``. The best total value and how often each class is used."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, int)
    for c in range(1, capacity + 1):
        gain = values[:c] + best[c - 1::-1][:c]
        k = int(np.argmax(gain))
        if gain[k] > best[c - 1]:
            best[c], last[c] = gain[k], k + 1
        else:
            best[c] = best[c - 1]
    use, c = np.zeros(capacity, int), capacity
    while c > 0:
        if last[c]:
            use[last[c] - 1] += 1
            c -= last[c]
        else:
            c -= 1
    return float(best[capacity]), use


def column_generation(demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns (uses per class 1..capacity) and how many sequences follow
    each, together covering ``demand`` exactly or a little more."""
    rows = np.nonzero(demand)[0]  # classes that occur
    if not len(rows):
        return []
    d = demand[rows].astype(float)
    columns = [np.zeros(capacity, int) for _ in rows]
    for column, k in zip(columns, rows):
        column[k] = capacity // (k + 1)
    inverse = np.diag([1.0 / (capacity // (k + 1)) for k in rows])
    amount = inverse @ d
    for _ in range(50 * capacity):  # ends by price; any basis on the way is a valid packing
        dual = inverse.sum(axis=0)  # every pattern costs one sequence
        values = np.zeros(capacity)
        values[rows] = dual
        price, use = best_pattern(values, capacity)
        if price <= 1 + 1e-7:
            break
        step = inverse @ use[rows]
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, amount / step, np.inf)
        out = int(np.argmin(ratio))
        columns[out] = use
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        amount = np.maximum(inverse @ d, 0)
    whole = np.floor(amount + 1e-9).astype(int)
    left = demand - sum((c * n for c, n in zip(columns, whole)), np.zeros(capacity, int))
    patterns = [(c, int(n)) for c, n in zip(columns, whole) if n]
    # the remainder of the rounding, first-fit decreasing (at most one sequence per basis column)
    room: list[int] = []
    held: list[np.ndarray] = []
    for k in range(capacity - 1, -1, -1):
        for _ in range(max(0, int(left[k]))):
            at = next((i for i, r in enumerate(room) if r > k), None)
            if at is None:
                room.append(capacity)
                held.append(np.zeros(capacity, int))
                at = len(room) - 1
            room[at] -= k + 1
            held[at][k] += 1
    return patterns + [(h, 1) for h in held]


def _slots(patterns: list[tuple[np.ndarray, int]]) -> list[tuple]:
    """(class, first rank, end rank, uses per sequence, first sequence)."""
    out, rank, sequence = [], {}, 0
    for use, n in patterns:
        for k in np.nonzero(use)[0]:
            first = rank.get(k, 0)
            rank[k] = first + n * int(use[k])
            out.append((int(k) + 1, first, rank[k], int(use[k]), sequence))
        sequence += n
    return out


def layout(pieces: DataFrame, capacity: int = 2048, grain: int = 8, bucket_rows: int = 65536) -> DataFrame:
    """``uid, sequence_id, offset`` for ``pieces`` (uid: any unique value, doc_id, start, length)."""
    spark = pieces.sparkSession
    buckets = max(64, pieces.count() // bucket_rows)
    rows = pieces.select("uid", "doc_id", "start", "length",
                         F.ceil(F.col("length") / grain).cast("int").alias("class"),
                         F.pmod(F.xxhash64("doc_id", "start", "length"), F.lit(buckets)).alias("bucket"))
    counts = write_table(rows.groupBy("class", "bucket").agg(F.count(F.lit(1)).alias("n")), "pack-histogram")
    demand = np.zeros(capacity // grain, int)
    for k, n in counts.groupBy("class").agg(F.sum("n")).collect():  # at most capacity / grain rows
        demand[k - 1] = n
    slots = spark.createDataFrame(_slots(column_generation(demand, capacity // grain)),
                                  "class int, first long, end long, uses long, sequence long")
    upto = Window.partitionBy("class").orderBy("bucket")
    before = counts.withColumn("before", F.sum("n").over(upto) - F.col("n")).drop("n")
    ranked = (rows.withColumn("k", F.row_number().over(
        Window.partitionBy("class", "bucket").orderBy("doc_id", "start", "length", "uid")) - 1)
        .join(before, ["class", "bucket"]).withColumn("rank", F.col("before") + F.col("k"))
        .select("uid", "length", "class", "rank"))
    # the slots are bounded by the number of classes, whatever the number of pieces
    placed = ranked.join(F.broadcast(slots.withColumnRenamed("class", "_class")),
                         (F.col("class") == F.col("_class")) & (F.col("rank") >= F.col("first"))
                         & (F.col("rank") < F.col("end")))
    placed = placed.select("uid", "length", "class", "rank",
                           (F.col("sequence") + F.floor((F.col("rank") - F.col("first")) / F.col("uses")))
                           .cast("long").alias("sequence_id"))
    inside = Window.partitionBy("sequence_id").orderBy(F.col("class").desc(), "rank")
    return placed.select("uid", "sequence_id",
                         (F.sum("length").over(inside) - F.col("length")).alias("offset"))


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 2048, grain: int = 8,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, ids`` (binary,
    little-endian unsigned 32-bit), ``sequence_id, offset``."""
    pieces = marks.scan(encode_pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col))
    rows = marks.placed(pieces)
    place = layout(rows.select(F.struct("file", "at").alias("uid"), "row.doc_id", "row.start", "row.length"), capacity, grain)
    # the ids stay in their files; each scan reads where its pieces go
    spot = marks.save(place.select("uid.file", "uid.at", "sequence_id", "offset"), "pack-layout")
    return (rows.withColumn("spot", spot.of(F.col("file"), F.col("at")))
            .select("row.*", "spot.sequence_id", "spot.offset"))
