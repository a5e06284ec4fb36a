"""Removal of long repeated byte strings by blockwise suffix sorting.

A byte goes if some string of ``LENGTH`` bytes that covers it also starts
elsewhere. Two suffixes tie that long only if they do from a common sample
position of a difference cover modulo ``PERIOD``: for any two positions i and
j some shift below PERIOD takes both to samples, where the strings agree for
the remaining LENGTH - PERIOD + 1 bytes. So

1. the samples (9 % of the positions) are ranked into classes of equal
   strings, bucket by bucket, and only whether a class repeats is kept, in a
   Bloom filter of a fixed size (a false positive costs work, nothing else);
2. only suffixes with a repeated sample ahead take part in the suffix sort.
   They are dealt to buckets by the digest of their first LENGTH bytes, and
   each bucket is sorted on its own: equal neighbours are ties of full length.
   The order of a bucket is that of 64-bit digests rather than of bytes, as
   only ties are wanted;
3. each bucket answers every block of documents with one bit per suffix, and
   the blocks remove the bytes covered.

A block of documents sends each digest once, so a string that occurs
everywhere is one entry per block. A task holds one block or one bucket.

Defined results: a null text is empty; rows that repeat id and text count as
two documents, so all they share is removed from both; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_table
from .words import U, mix, powers

LENGTH = 400
#: A perfect difference set modulo 133 (every non-zero
#: difference occurs exactly once).
PERIOD = 133
COVER = np.array([0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109])
FILTER_BITS = 27  # the filter holds 2 ** FILTER_BITS bits (16 MB) at any input size
PROBES = 4
BLOCK = 3_000_000  # bytes of text in a block (a longer text alone)
_VALUE = np.random.default_rng(400).integers(1, 1 << 63, 256, dtype=np.uint64)


def prefix_sums(joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    power, inverse = powers(len(joined))
    total = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(_VALUE[joined] * power, out=total[1:])
    return total, inverse


def digests(total: np.ndarray, inverse: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """64-bit digests of the strings of ``length`` bytes that start at ``at``."""
    return mix((total[at + length] - total[at]) * inverse[at])


def sample_positions(sizes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Cover samples of all documents of a block whose string fits its document."""
    at = [np.zeros(0, np.int64)]
    need = length - PERIOD + 1
    for size, start in zip(sizes, starts):
        if size >= length:
            p = (np.arange(0, size - need + 1, PERIOD)[:, None] + COVER).ravel()
            at.append(start + p[p <= size - need])
    return np.concatenate(at)


def by_bucket(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys with the bucket (their low bits) turned to the
    front, each one's count, and where each bucket begins."""
    turned = (keys << U(64 - bits)) | (keys >> U(bits))
    turned, counts = np.unique(turned, return_counts=True)
    begins = np.searchsorted(turned >> U(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    return turned, counts, begins


def _short(turned: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits behind the bucket."""
    return (turned << U(bits)) >> U(32)


def to_bytes(ascending: np.ndarray) -> bytes:
    """Differences of sorted values, byte plane by byte plane: the upper
    planes are zeros, which the shuffle's compression takes away."""
    steps = np.diff(ascending, prepend=np.zeros(1, np.uint64)).astype("<u8")
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def from_bytes(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _probe_bits(short: np.ndarray, segment: int) -> np.ndarray:
    """PROBES bit numbers below 2 ** segment for each 32-bit value."""
    a = mix(short + U(1))
    b = (a >> U(32)) | U(1)
    return np.stack([(a + U(k) * b) & U((1 << segment) - 1) for k in range(PROBES)])


class Filter:
    """Bloom filter in one segment per bucket."""

    def __init__(self, data: np.ndarray, bits: int, segment: int):
        self.data, self.bits, self.segment = data, bits, segment

    def holds(self, keys: np.ndarray) -> np.ndarray:
        turned = (keys << U(64 - self.bits)) | (keys >> U(self.bits))
        short = _short(turned, self.bits)
        base = (turned >> U(64 - self.bits)) << U(self.segment)
        out = np.ones(len(keys), bool)
        for bit in _probe_bits(short, self.segment):
            at = base + bit
            out &= (self.data[at >> U(3)] >> (at & U(7)).astype(np.uint8)) & 1 == 1
        return out


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of consecutive rows of about BLOCK bytes."""
    first, texts, held = 0, [], 0
    for k, text in enumerate(batch.column("text")):
        raw = (text.as_py() or "").encode()
        if texts and held + len(raw) > BLOCK:
            yield first, texts
            first, texts, held = k, [], 0
        texts.append(raw)
        held += len(raw)
    if texts:
        yield first, texts


def _layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), sizes, np.cumsum(sizes) - sizes


def repeated_samples(rows: DataFrame, bits: int, length: int, filter_bits: int) -> Filter:
    """The filter of the sample strings that occur more than once."""
    segment = max(filter_bits - bits, 10)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _blocks(batch):
                joined, sizes, starts = _layout([t for t in texts if len(t) >= length])
                if not len(joined):
                    continue
                total, inverse = prefix_sums(joined)
                at = sample_positions(sizes, starts, length)
                turned, counts, begins = by_bucket(digests(total, inverse, at, length - PERIOD + 1), bits)
                short, often = _short(turned, bits), counts > 1
                buckets = np.flatnonzero(np.diff(begins))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets, pa.int32()),
                     pa.array([to_bytes(short[begins[k]:begins[k + 1]]) for k in buckets], pa.binary()),
                     pa.array([to_bytes(short[begins[k]:begins[k + 1]][often[begins[k]:begins[k + 1]]])
                               for k in buckets], pa.binary())], ["bucket", "once", "often"])

    def wide(column: pa.ChunkedArray) -> np.ndarray:
        return np.concatenate([from_bytes(b) for b in column.to_pylist()])

    def rank(table: pa.Table) -> pa.Table:
        values = np.sort(wide(table.column("once")))
        again = np.concatenate([values[1:][values[1:] == values[:-1]], wide(table.column("often"))])
        data = np.zeros((1 << segment) // 8, np.uint8)
        at = _probe_bits(again, segment).ravel()
        np.bitwise_or.at(data, at >> U(3), np.uint8(1) << (at & U(7)).astype(np.uint8))
        return pa.table({"bucket": table.column("bucket")[:1], "data": pa.array([data.tobytes()], pa.binary())})

    sent = rows.select("text").mapInArrow(send, "bucket int, once binary, often binary")
    data = np.zeros((1 << (segment + bits)) // 8, np.uint8)
    one = (1 << segment) // 8
    for bucket, part in sent.groupBy("bucket").applyInArrow(rank, "bucket int, data binary").collect():  # a fixed size in all
        data[bucket * one:(bucket + 1) * one] = np.frombuffer(part, np.uint8)
    return Filter(data, bits, segment)


def candidates(total: np.ndarray, inverse: np.ndarray, sizes: np.ndarray, starts: np.ndarray, known: Filter,
               length: int) -> np.ndarray:
    """Positions of a block whose suffix has a repeated sample within PERIOD."""
    samples = sample_positions(sizes, starts, length)
    samples = samples[known.holds(digests(total, inverse, samples, length - PERIOD + 1))]
    ahead = np.zeros(len(total), np.int32)
    ahead[samples] = 1
    ahead = np.concatenate([[0], np.cumsum(ahead)])
    out = [np.zeros(0, np.int64)]
    for size, start in zip(sizes, starts):
        if size >= length:
            at = np.arange(start, start + size - length + 1)
            out.append(at[ahead[np.minimum(at + PERIOD, start + size)] > ahead[at]])
    return np.concatenate(out)


def _cut(raw: bytes, at: np.ndarray, length: int) -> tuple[int, int, str]:
    """Bytes removed, runs removed and the digest of what stays, for the
    starts ``at`` (ascending) of repeated strings."""
    if not len(at):
        return 0, 0, hashlib.sha256(raw).hexdigest()
    new = np.concatenate([[True], np.diff(at) > length])
    first = at[new]
    last = np.concatenate([at[:-1][new[1:]], at[-1:]]) + length
    kept, before = hashlib.sha256(), 0
    for a, b in zip(first, last):
        kept.update(raw[before:a])
        before = b
    kept.update(raw[before:])
    return int((last - first).sum()), len(first), kept.hexdigest()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   filter_bits: int = FILTER_BITS, bucket_bytes: int = 16_000_000,
                   with_runs: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_removed``,
    ``n_spans``, ``kept_sha256``, and ``with_runs`` the removed byte ranges as
    ``runs`` (array of start and end)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]
    n_bytes = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = max(6, int(np.ceil(np.log2(max(n_bytes // bucket_bytes, 1)))))
    sc = docs.sparkSession.sparkContext
    known = sc.broadcast(repeated_samples(rows, bits, length, filter_bits))  # 2 ** filter_bits bits

    # documents without candidates are done; the others are written in blocks
    def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_type = batch.schema.field("id").type
            shape = pa.schema([("ids", pa.list_(id_type)), ("texts", pa.list_(pa.binary())),
                               ("n", pa.list_(pa.int64())), ("sha", pa.list_(pa.string()))])
            for first, texts in _blocks(batch):
                ids = batch.column("id").slice(first, len(texts)).to_pylist()
                joined, sizes, starts = _layout(texts)
                total, inverse = prefix_sums(joined)
                at = candidates(total, inverse, sizes, starts, known.value, length)
                some = np.diff(np.searchsorted(at, np.concatenate([starts, [len(joined)]]))) > 0
                done = [k for k in range(len(texts)) if not some[k]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([[i for i, s in zip(ids, some) if s], [ids[k] for k in done]], shape[0].type),
                     pa.array([[t for t, s in zip(texts, some) if s], None], shape[1].type),
                     pa.array([None, [len(texts[k]) for k in done]], shape[2].type),
                     pa.array([None, [hashlib.sha256(texts[k]).hexdigest() for k in done]], shape[3].type)],
                    schema=shape)

    sieved = rows.mapInArrow(sieve, f"ids array<{kind}>, texts array<binary>, n array<long>, sha array<string>")
    sieved = write_table(sieved.filter(F.size("ids") > 0).withColumn("block", F.monotonically_increasing_id()),
                         "suffix-blocks")
    blocks = sieved.filter("texts is not null").select("block", "ids", "texts")
    plain = (sieved.filter("sha is not null").select(F.explode(F.arrays_zip("ids", "n", "sha")).alias("d"))
             .select(F.col("d.ids").alias("id"), F.col("d.n").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
                     F.lit(0).cast("long").alias("n_spans"), F.col("d.sha").alias("kept_sha256"),
                     F.array().cast("array<struct<start:long,end:long>>").alias("runs")))

    def suffixes(texts: list[bytes]) -> tuple:
        joined, sizes, starts = _layout(texts)
        total, inverse = prefix_sums(joined)
        at = candidates(total, inverse, sizes, starts, known.value, length)
        return at, digests(total, inverse, at, length), starts

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, texts in zip(batch.column("block").to_pylist(), batch.column("texts")):
                turned, _, begins = by_bucket(suffixes(texts.as_py())[1], bits)
                buckets = np.flatnonzero(np.diff(begins))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets, pa.int32()), pa.array([block] * len(buckets), pa.int64()),
                     pa.array([to_bytes(turned[begins[k]:begins[k + 1]]) for k in buckets], pa.binary())], ["bucket", "block", "keys"])

    def sort_bucket(table: pa.Table) -> pa.Table:
        parts = [from_bytes(k) for k in table.column("keys").to_pylist()]
        ordered = np.sort(np.concatenate(parts))
        again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        answers = []
        for part in parts:
            at = np.searchsorted(again, part)
            hit = again[np.minimum(at, len(again) - 1)] == part if len(again) else np.zeros(len(part), bool)
            answers.append(np.packbits(hit).tobytes())
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                         "bits": pa.array(answers, pa.binary())})

    answers = (blocks.mapInArrow(send, "bucket int, block long, keys binary").groupBy("bucket")
               .applyInArrow(sort_bucket, "block long, bucket int, bits binary"))
    answers = write_table(answers, "suffix-answers")

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.slice(0, 1).to_pylist()[0]
        texts = row["texts"]
        at, keys, starts = suffixes(texts)
        turned, counts, begins = by_bucket(keys, bits)
        again = counts > 1
        for bucket, packed in zip(right.column("bucket").to_pylist(), right.column("bits").to_pylist()):
            a, b = begins[bucket], begins[bucket + 1]
            again[a:b] |= np.unpackbits(np.frombuffer(packed, np.uint8), count=b - a).astype(bool)
        own = (keys << U(64 - bits)) | (keys >> U(bits))
        hit = at[again[np.searchsorted(turned, own)]] if len(at) else at
        ends = np.concatenate([starts, [starts[-1] + len(texts[-1])]])
        where = np.searchsorted(hit, ends)
        results, runs = [], []
        for k, raw in enumerate(texts):
            mine = hit[where[k]:where[k + 1]] - starts[k]
            results.append((len(raw), *_cut(raw, mine, length)))
            runs.append(_runs(mine, length) if with_runs else [])
        n, removed, spans, sha = zip(*results)
        return pa.table({"id": pa.array(row["ids"], left.schema.field("ids").type.value_type),
                         "n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                         "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(sha, pa.string()),
                         "runs": pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))})

    cut = (blocks.groupBy("block").cogroup(answers.withColumnRenamed("block", "to").groupBy("to"))
           .applyInArrow(remove, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                 "runs array<struct<start:long,end:long>>"))
    both = plain.unionByName(cut).withColumnRenamed("id", id_col)
    return both if with_runs else both.drop("runs")


def _runs(at: np.ndarray, length: int) -> list[dict]:
    if not len(at):
        return []
    new = np.concatenate([[True], np.diff(at) > length])
    last = np.concatenate([at[:-1][new[1:]], at[-1:]]) + length
    return [{"start": int(a), "end": int(b)} for a, b in zip(at[new], last)]
