"""Quality classifier: a weak-label model trains a hashed linear scorer.

Two targets, low quality and toxicity, each with overlapping labellers that
vote bad (1), good (0) or abstain (-1): shares of shouted, symbol-laden,
repeated and fragment words for quality; words of a lexicon (words that the
labelled rows set apart) for toxicity; and the human label
where there is one. Expectation-maximisation over the counts of all
documents' vote patterns (at most 3 ** labellers rows) estimates every
labeller's accuracies and each document's posterior without trusting any of
them. The posteriors of a bounded sample train two logistic scorers on hashed
words and word shapes; all documents are scored in one pass.

The sample holds about SAMPLE_ROWS rows at any size: labels are joined first,
then half of it (less, if there are fewer) is drawn from the labelled rows and
the rest from the others, by a hash of id and text, so many rows of one id are
drawn apart and equal rows count once. The lexicon comes from word counts over
all labelled documents; counts of votes and scoring cover all documents.

Defined results: null and empty texts get the votes of no words (all
heuristics abstain) and are judged by the intercept; several labels of one id
count by majority, a tie abstains; repeated rows get equal scores; without
labels the human labellers and the lexicon abstain, and a target whose
labellers all abstain rejects nothing; an empty table gives an empty result;
other columns are ignored by ``score`` and carried through by ``keep``.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import marks
from .common import arrow_rows, give_back, trimmed, write_table
from .words import U, shingle_sets, text_chunks, word_table

SAMPLE_ROWS = 8192
BATCH_ROWS = 2000  # texts that a worker holds
BITS = 18
BEGINNINGS = (4, 5)  # bytes
SHAPES = ("shouted", "symbols", "repeated", "fragments")
SHARE = 0.15  # of a document's words; above it a shape votes bad
LEAST = 8  # smallest shingles that tell near copies in the sample
LEAST_WORDS = 4  # with fewer words the shapes abstain
QUALITY, TOXIC = (*SHAPES, "human"), ("lexicon", "lexicon_share", "human")


def _lut(*spans: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, np.int64)
    for a, b in spans:
        out[a:b] = 1
    return out


_UPPER, _LOWER = _lut((0x41, 0x5B)), _lut((0x61, 0x7B))
_PUNCT = _lut((0x21, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x7F))


def features(texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Shares of word shapes (one row per text), distinct hashed words and
    word beginnings per text (split at punctuation too), and the number of words."""
    joined, first, end, hashes, begins = word_table(texts)
    sums = [np.concatenate([[0], np.cumsum(lut[joined])]) for lut in (_UPPER, _LOWER, _PUNCT)]
    upper, lower, punct = (s[end] - s[first] for s in sums)
    length = end - first
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    if len(hashes):
        same[begins[:-1][begins[:-1] < len(hashes)]] = False
    shapes = np.stack([(upper >= 2) & (lower == 0), punct >= 2, same, (length == 1) & (punct == 1)])
    counts = np.diff(begins)
    total = np.concatenate([np.zeros((4, 1), np.int64), np.cumsum(shapes, axis=1)], axis=1)
    shares = ((total[:, begins[1:]] - total[:, begins[:-1]]) / np.maximum(counts, 1)).T
    bare = word_table(texts, _PUNCT.astype(bool), BEGINNINGS)
    slots = (np.column_stack([bare[3], *bare[5:]]) >> U(64 - BITS)).astype(np.int32)
    words = [np.unique(slots[a:b]) for a, b in zip(bare[4][:-1], bare[4][1:])]
    return shares, words, counts


def votes(shares: np.ndarray, words: list[np.ndarray], counts: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
    """One row per text: the votes of SHAPES, lexicon and lexicon_share."""
    fires = shares > SHARE
    # a shape that does not fire says good only of documents that no other one marks
    out = np.where(fires, 1, np.where(fires.any(axis=1, keepdims=True), -1, 0))
    out[counts < LEAST_WORDS] = -1
    if not len(lexicon):
        return np.column_stack([out, np.full((len(out), 2), -1)])
    hits = np.array([len(np.intersect1d(w, lexicon, assume_unique=True)) for w in words], np.int64)
    sizes = np.array([max(len(w), 1) for w in words])
    lex = np.column_stack([hits >= 1, np.where((hits == 0) | (hits / sizes > 0.01), hits > 0, -1)]).astype(np.int64)
    lex[counts == 0] = -1
    return np.column_stack([out, lex])


def em(patterns: np.ndarray, weight: np.ndarray, rounds: int = 500) -> tuple[float, np.ndarray]:
    """Two-class label model. ``patterns``: votes (-1, 0, 1) per row and
    labeller. Returns the prior of bad and per labeller (P(vote bad | bad),
    P(vote bad | good)). Starts from the votes' own share of bad."""
    voted, bad = patterns >= 0, patterns == 1
    post = np.where(voted.any(axis=1), np.where(bad.any(axis=1), 0.9, 0.05), 0.1)
    prior, rates = 0.1, np.zeros((patterns.shape[1], 2))
    for _ in range(rounds):
        old = post
        prior = float(np.clip((post @ weight) / weight.sum(), 1e-4, 0.5))
        for k in range(patterns.shape[1]):
            for c, p in enumerate((post, 1 - post)):
                w = p * weight * voted[:, k]
                rates[k, c] = ((w @ bad[:, k]) + (0.5 if c == 0 else 0.05)) / (w.sum() + 1.0)
        post = posterior(patterns, prior, rates)
        if np.abs(post - old).max() < 1e-7:
            break
    return prior, rates


def posterior(patterns: np.ndarray, prior: float, rates: np.ndarray) -> np.ndarray:
    """P(bad | votes) per row."""
    logit = np.full(len(patterns), np.log(prior / (1 - prior)))
    for k, (b, g) in enumerate(np.clip(rates, 1e-6, 1 - 1e-6)):
        logit += np.where(patterns[:, k] == 1, np.log(b / g), 0)
        logit += np.where(patterns[:, k] == 0, np.log((1 - b) / (1 - g)), 0)
    return 1 / (1 + np.exp(-logit))


def train(shares: np.ndarray, words: list[np.ndarray], target: np.ndarray, rounds: int = 300,
          penalty: float = 1e-3, least_rows: int = 4, features_used: int = 2048) -> np.ndarray:
    """Logistic regression on soft targets with an L1 penalty on the words, so
    that only words that set the classes apart count (Adam with a proximal
    step, full batches): weights of the hashed words, the shapes and the
    intercept. Of the words that ``least_rows`` rows hold, the
    ``features_used`` that depend most on the target take part."""
    rows = np.repeat(np.arange(len(words), dtype=np.int32), [len(w) for w in words])
    slots = np.concatenate(words) if words else np.zeros(0, np.int32)
    held = np.bincount(slots, minlength=1 << BITS)
    mean = target.mean() if len(target) else 0.0
    # squared standardised difference of the target with and without the word
    apart = ((np.bincount(slots, target[rows], 1 << BITS) - held * mean) ** 2 / np.maximum(held, 1))
    apart[held < least_rows] = 0
    taken = np.zeros(1 << BITS, bool)
    taken[np.argsort(-apart, kind="stable")[:features_used]] = True
    taken &= apart > 0
    here = taken[slots]
    rows, slots = rows[here], slots[here]
    used = np.flatnonzero(taken)
    at = (np.cumsum(taken, dtype=np.int32) - 1)[slots]  # position among the used ones
    del here, slots
    w, dense = np.zeros(len(used)), np.zeros(shares.shape[1] + 1)
    x = np.column_stack([shares, np.ones(len(shares))])
    state = [np.zeros(len(used) + len(dense)) for _ in range(2)]
    for step in range(1, rounds + 1):
        z = np.bincount(rows, w[at], len(words)) + x @ dense
        gap = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / max(len(words), 1)
        grad = np.concatenate([np.bincount(at, gap[rows], len(used)), x.T @ gap + 1e-5 * dense])
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad ** 2
        scale = 0.05 / (np.sqrt(state[1] / (1 - 0.99 ** step)) + 1e-8)
        move = scale * state[0] / (1 - 0.9 ** step)
        w, dense = w - move[:len(used)], dense - move[len(used):]
        w = np.sign(w) * np.maximum(np.abs(w) - np.minimum(scale[:len(used)] * penalty, 1.0), 0)
    out = np.zeros((1 << BITS) + len(dense), np.float64)
    out[used], out[1 << BITS:] = w, dense
    return out


@dataclass
class Model:
    """Weights per target, and the label models they were trained with."""

    weights: dict[str, np.ndarray]
    lexicon: np.ndarray
    labellers: dict[str, dict[str, tuple[float, float]]]
    priors: dict[str, float]

    def score(self, target: str, shares: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
        w = self.weights[target]
        z = np.array([w[k].sum() for k in words]) + shares @ w[1 << BITS:-1] + w[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def find_lexicon(rows: DataFrame, label_of: Callable[[pa.Array, pa.Array], pa.StructArray]) -> np.ndarray:
    """Hashed words that at least 3 and 3 % of the labelled toxic rows hold and
    hardly any other labelled row: 95 % of the rows with the word are toxic.
    ``rows``: file, at, text; ``label_of`` tells their labels by position. Of
    rows with one smallest shingle (near copies would count many times) one of
    each label counts."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = pc.struct_field(label_of(batch.column("file"), batch.column("at")), "toxic").fill_null(-1)
            known = pc.greater_equal(toxic, 0)
            toxic = toxic.filter(known)
            done = 0
            for texts in text_chunks(batch.column("text").filter(known)):
                _, words, _ = features(texts)
                lead = [int(s[0]) - (1 << 63) if len(s) else None for s in shingle_sets(texts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lead, pa.int64()), toxic.slice(done, len(texts)),
                     pa.array([zlib.compress(np.diff(w, prepend=0).astype("<i4").tobytes(), 1) for w in words],
                              pa.binary())], ["lead", "toxic", "words"])
                done += len(texts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, 1 << BITS), np.int64)
        rows = 0
        for batch in batches:
            for toxic, words in zip(batch.column("toxic").to_pylist(), batch.column("words").to_pylist()):
                held[toxic, np.cumsum(np.frombuffer(zlib.decompress(words), "<i4"))] += 1
                rows += toxic
        at = np.flatnonzero(held.any(axis=0))
        # word -1 counts the toxic rows
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(held[1, at], rows)),
                                          pa.array(np.append(held[0, at], 0))], ["word", "yes", "no"])

    one = (rows.select("file", "at", "text").mapInArrow(trimmed(extract), "lead long, toxic int, words binary")
           .filter("lead is not null").groupBy("lead", "toxic").agg(F.min("words").alias("words")))
    counts = (one.select("toxic", "words").mapInArrow(trimmed(count), "word long, yes long, no long")
              .groupBy("word").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")))
    found = counts.filter("word = -1 or (yes >= 3 and yes >= 0.95D * (yes + no))").collect()  # at most 2 ** BITS
    rows = sum(r["yes"] for r in found if r["word"] == -1)
    return np.array(sorted(r["word"] for r in found if r["word"] >= 0 and r["yes"] >= 0.03 * rows), np.int32)


def without_near_copies(least: list[list[int]]) -> list[int]:
    """Indices of rows of which fewer than half of the LEAST smallest
    shingles stand in an earlier row: near copies would vote many times."""
    seen: set[int] = set()
    out = []
    for k, smallest in enumerate(least):
        if 2 * sum(s in seen for s in smallest) < max(len(smallest), 1):
            out.append(k)
        seen.update(smallest)
    return out


def _human(labels: DataFrame) -> DataFrame:
    def vote(c):
        share = F.avg(F.col(c).cast("double"))
        return F.when(share > 0.5, 1).when(share < 0.5, 0).otherwise(-1).cast("int")
    return (labels.filter("doc_id is not null").groupBy("doc_id")
            .agg(vote("quality").alias("quality"), vote("toxic").alias("toxic"))
            .select(F.col("doc_id").alias("_id"),
                    F.when(F.col("quality") >= 0, 1 - F.col("quality")).otherwise(-1).alias("low"), "toxic"))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
        text_col: str = "text") -> Model:
    """``labels``: doc_id, quality (1 good, 0 bad), toxic (1 bad)."""
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        return _fit(docs, labels, sample_rows, id_col, text_col)


def _fit(docs: DataFrame, labels: DataFrame, sample_rows: int, id_col: str, text_col: str) -> Model:
    placed = marks.placed(marks.scan(docs, "quality-rows")).select(
        "file", "at", F.col(f"row.{id_col}").alias("id"), F.col(f"row.{text_col}").alias("text"))
    # the labels go to their rows by position: no text moves for them
    labelled = write_table(placed.select("file", "at", "id").join(_human(labels), F.col("id") == F.col("_id"))
                           .select("file", "at", "low", "toxic"), "quality-labelled")
    own = marks.save(labelled, "quality-labels")
    label_of = own.reader()
    known = (F.col("low") >= 0) | (F.col("toxic") >= 0)
    sizes = {True: labelled.filter(known).count()}
    sizes[False] = docs.count() - sizes[True]
    part = {True: min(sizes[True], max(sample_rows // 2, sample_rows - sizes[False]))}
    part[False] = sample_rows - part[True]
    below = {k: int(min(1.0, part[k] / max(sizes[k], 1)) * (1 << 30)) for k in part}
    share = F.when(known, below[True]).otherwise(below[False])
    # the labels of what either share could draw, then the draw
    drawn = (placed.withColumn("h", F.xxhash64(F.lit("sample"), "id", "text"))
             .filter(F.pmod("h", F.lit(1 << 30)) < max(below.values()))
             .withColumn("human", own.of(F.col("file"), F.col("at")))
             .select("id", "text", "h", *[F.coalesce(F.col("human")[c], F.lit(-1)).alias(c) for c in ("low", "toxic")])
             .filter(F.pmod("h", F.lit(1 << 30)) < share).dropDuplicates(["h"]))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_pylist()
            done = 0
            for texts in text_chunks(batch.column("text")):
                shares, words, counts = features(texts)
                least = [s[:LEAST].astype("<u8").tobytes() for s in shingle_sets(texts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[done:done + len(texts)], batch.schema.field("id").type),
                     pa.array([s.astype("<f8").tobytes() for s in shares], pa.binary()),
                     pa.array([w.astype("<i4").tobytes() for w in words], pa.binary()),
                     pa.array(counts, pa.int64()), pa.array(least, pa.binary()),
                     *[batch.column(c).slice(done, len(texts)) for c in ("low", "toxic")]],
                    ["id", "shares", "words", "n", "least", "low", "toxic"])
                done += len(texts)

    kind = dict(placed.dtypes)["id"]
    found = drawn.mapInArrow(  # about sample_rows rows
        trimmed(extract), f"id {kind}, shares binary, words binary, n long, least binary, low int, toxic int").collect()
    found.sort(key=lambda r: (r["id"] is None, r["id"], r["words"]))
    found = [found[k] for k in without_near_copies([np.frombuffer(r["least"], "<u8").tolist() for r in found])]
    shares = np.array([np.frombuffer(r["shares"], "<f8") for r in found]).reshape(len(found), len(SHAPES))
    words = [np.frombuffer(r["words"], "<i4") for r in found]
    counts = np.array([r["n"] for r in found], np.int64)
    low, toxic = (np.array([r[c] for r in found], np.int64) for c in ("low", "toxic"))
    lexicon = find_lexicon(placed, label_of)

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            human = label_of(batch.column("file"), batch.column("at"))
            own = [pc.struct_field(human, c).fill_null(-1) for c in ("low", "toxic")]
            done = 0
            for texts in text_chunks(batch.column("text")):
                v = votes(*features(texts), lexicon)
                code = ((v + 1) * 3 ** np.arange(v.shape[1])).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code, pa.int64()), *(c.slice(done, len(texts)) for c in own)], ["code", "low", "toxic"])
                done += len(texts)

    counted = (placed.select("file", "at", "text").mapInArrow(trimmed(cast), "code long, low int, toxic int")
               .groupBy("code", "low", "toxic").agg(F.count(F.lit(1)).alias("n")).collect())  # at most 3 ** 8 patterns
    n = np.array([r["n"] for r in counted], np.float64)
    heuristics = np.array([[(r["code"] // 3 ** k) % 3 - 1 for k in range(len(SHAPES) + 2)] for r in counted],
                          np.int64).reshape(len(counted), len(SHAPES) + 2)
    own = votes(shares, words, counts, lexicon) if found else np.zeros((0, len(SHAPES) + 2), np.int64)
    model = Model({}, lexicon, {}, {})
    for target, names, mine, mark in (("low", QUALITY, slice(0, len(SHAPES)), "low"),
                                      ("toxic", TOXIC, slice(len(SHAPES), None), "toxic")):
        patterns = np.column_stack([heuristics[:, mine], np.array([r[mark] for r in counted], np.int64)])
        sample = np.column_stack([own[:, mine], low if mark == "low" else toxic])
        if not len(n) or not (patterns == 1).any():  # nothing is known to be bad
            model.weights[target] = np.zeros((1 << BITS) + len(SHAPES) + 1)
            model.weights[target][-1] = -30.0
            model.priors[target], model.labellers[target] = 0.0, {}
            continue
        prior, rates = em(patterns, n)
        model.priors[target] = prior
        model.labellers[target] = {name: (float(b), float(g)) for name, (b, g) in zip(names, rates)}
        model.weights[target] = train(shares, words, posterior(sample, prior, rates))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``p_low``, ``p_toxic``, ``kept``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: 2 * 2 ** BITS weights
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in text_chunks(batch.column("text")):
                shares, words, _ = features(texts)
                low, toxic = (shared.value.score(t, shares, words) for t in ("low", "toxic"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(done, len(texts)), pa.array(low), pa.array(toxic),
                     pa.array((low <= 0.5) & (toxic <= 0.5))], ["id", "p_low", "p_toxic", "kept"])
                done += len(texts)

    kind = dict(rows.dtypes)["id"]
    return (rows.mapInArrow(trimmed(judge), f"id {kind}, p_low double, p_toxic double, kept boolean")
            .withColumnRenamed("id", id_col))


def keep(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that both scorers accept, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def accepted(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for column in columns:
                out = [np.zeros(0, bool)]
                for texts in text_chunks(column):
                    shares, words, _ = features(texts)
                    out.append((shared.value.score("low", shares, words) <= 0.5)
                               & (shared.value.score("toxic", shares, words) <= 0.5))
                yield pa.array(np.concatenate(out))
        finally:
            give_back()

    return docs.filter(accepted(F.col(text_col)))
