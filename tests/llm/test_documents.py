"""Operators on documents against brute-force versions on odd rows."""

import hashlib
import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from streamlake.llm import exact_dedup, jobs, minhash, mixing, packing, quality, suffix_dedup, token_counts, words

from .conftest import LONG, ODD, PROSE

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
small = duckdb.sql(f"select doc_id, text, source from '{SF_SMALL}/documents.parquet'").fetchall()


def as_sorted(rows):
    return sorted(rows, key=repr)


# exact dedup

def exact_brute(docs):
    norm = [re.sub(r"[\x20\x09-\x0d]+", " ", t or "") for _, t, _ in docs]
    groups = defaultdict(list)
    for (i, _, _), t in zip(docs, norm):
        groups[t].append(i)
    out, seen = [], set()
    for (i, _, _), t in zip(docs, norm):
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[t]), i == keep and (i, t) not in seen, hashlib.sha256(t.encode()).hexdigest()))
        seen.add((i, t))
    return as_sorted(out)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(odd_docs, weak):
    from pyspark.sql import functions as F
    hash_fn = (lambda t: F.substring(exact_dedup.content_hash(t), 1, 0)) if weak else exact_dedup.content_hash
    got = exact_dedup.mark(odd_docs, hash_fn=hash_fn)
    assert as_sorted(map(tuple, got.collect())) == exact_brute(ODD)


def test_drop_copies(odd_docs, no_docs):
    kept = exact_dedup.drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    want = [(i, s) for i, _, _, k, s in exact_brute(ODD) if k]
    got = [(r["doc_id"], hashlib.sha256(re.sub(r"[\x20\x09-\x0d]+", " ", r["text"] or "").encode()).hexdigest())
           for r in kept.collect()]
    assert as_sorted(got) == as_sorted(want)
    assert exact_dedup.drop_copies(no_docs).collect() == [] == exact_dedup.mark(no_docs).collect()


# near duplicates

def shingles(text, width=5):
    w = WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    return frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1)) or frozenset([tuple(w)] if w else [])


def near_brute(docs, percent):
    sets = [shingles(t) for _, t, _ in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    for a, b in {(a, b) for h in holders.values() for a in h for b in h if a < b}:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    ids = defaultdict(list)
    for k in range(len(docs)):
        ids[root(k)].append(docs[k][0])
    out = []
    for k, (i, _, _) in enumerate(docs):
        known = [x for x in ids[root(k)] if x is not None]
        low = min(known) if known else None
        out.append((i, len(sets[k]), low, i == low))
    return as_sorted(out)


def test_near_duplicates(odd_docs, no_docs):
    got = minhash.group(odd_docs).drop("key")
    assert as_sorted(map(tuple, got.collect())) == near_brute(ODD, 85)
    assert minhash.group(no_docs).collect() == []


def test_near_duplicates_of_generated_groups(ctx):
    rng = np.random.default_rng(3)
    docs = []
    for group in range(12):  # chains and stars of edits around the threshold
        base = [f"w{x}" for x in rng.integers(0, 5000, 80)]
        for _ in range(int(rng.integers(1, 25))):
            own = list(base)
            for at in rng.integers(0, 80, int(rng.integers(0, 3))):
                own[at] = f"e{rng.integers(0, 10**6)}"
            docs.append((len(docs), " ".join(own), None))
    docs += [(len(docs) + k, t, s) for k, (_, t, s) in enumerate(small)]
    df = ctx.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    got = as_sorted(map(tuple, minhash.group(df).drop("key").collect()))
    assert got == near_brute(docs, 85)


@pytest.mark.parametrize("percent, edits", [(85, 3), (80, 4)])
def test_near_duplicates_of_large_stars(ctx, percent, edits):
    """Copies that are alike only through their base, copies whose base is
    missing, and pairs inside such a crowd."""
    rng = np.random.default_rng(percent)
    docs = []

    def copy(words, n):
        own = list(words)
        for at in rng.choice(len(own), n, replace=False):
            own[at] = f"e{rng.integers(0, 10**9)}"
        docs.append((len(docs), " ".join(own), None))
        return own

    for copies, with_base in ((400, True), (300, False)):
        base = [f"w{x}" for x in rng.integers(0, 5000, 200)]
        own = [copy(base, edits) for _ in range(copies)]
        for k in range(0, 20, 2):
            copy(own[k], 1)
        if with_base:
            copy(base, 0)
    df = ctx.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    got = as_sorted(map(tuple, minhash.group(df, percent=percent).drop("key").collect()))
    assert got == near_brute(docs, percent)


def test_drop_near_copies(odd_docs, no_docs):
    kept = minhash.drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    groups = defaultdict(set)
    for i, n, component, _ in near_brute(ODD, 80):
        groups[component].add(i)
    texts = Counter(shingles(t) for _, t in rows)
    assert all(n == 1 for s, n in texts.items() if s)
    assert sum(n for s, n in texts.items() if not s) == sum(not shingles(t) for _, t, _ in ODD)
    assert {1, 9, 7, 11, 12}.issubset({i for i, _ in rows}) and not {2, 3, 10, 14} & {i for i, _ in rows}
    assert minhash.drop_near_copies(no_docs).collect() == []


def test_components_of_a_long_chain(ctx):
    edges = ctx.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 1001)], "a long, b long")
    assert {r["root"] for r in minhash.components(edges).collect()} == {0, 1000}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aAbé \t\n😀"), max_size=40), min_size=1, max_size=6))
def test_shingle_sets(texts):
    sets = words.shingle_sets([t.encode() for t in texts], 3)
    brute = [shingles(t, 3) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in brute]
    for a, x in zip(sets, brute):
        for b, y in zip(sets, brute):
            assert len(np.intersect1d(a, b)) == len(x & y)


# repeated spans

def spans_brute(docs, length):
    raw = [(t or "").encode() for _, t, _ in docs]
    count = Counter(r[p:p + length] for r in raw for p in range(len(r) - length + 1))
    out = []
    for (i, _, _), r in zip(docs, raw):
        gone = bytearray(len(r))
        for p in range(len(r) - length + 1):
            if count[r[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        runs = sum(1 for p in range(len(r)) if gone[p] and not (p and gone[p - 1]))
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((i, len(r), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return as_sorted(out)


def test_repeated_spans(odd_docs, no_docs, ctx):
    docs = [(i, t[:9000] if t else t, s) for i, t, s in ODD]
    df = ctx.createDataFrame(docs, "doc_id long, text string, source string").repartition(4)
    got = as_sorted(map(tuple, suffix_dedup.remove_repeats(df).collect()))
    assert got == spans_brute(docs, 400)
    assert suffix_dedup.remove_repeats(no_docs).collect() == []
    assert suffix_dedup.remove_repeats(odd_docs).count() == len(ODD)


def test_repeated_spans_with_a_full_filter(ctx):
    """A filter that lets everything through (as at a huge size) changes nothing."""
    rng = np.random.default_rng(1)
    passage = "".join(chr(97 + c) for c in rng.integers(0, 26, 700))
    docs = []
    for k in range(40):
        fill = "".join(chr(97 + c) for c in rng.integers(0, 26, 500))
        a, n = int(rng.integers(0, 300)), int(rng.integers(390, 700))
        docs.append((k, fill[:int(rng.integers(0, 500))] + passage[a:a + n] + fill[::-1][:100], None))
    df = ctx.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    want = spans_brute(docs, 400)
    assert as_sorted(map(tuple, suffix_dedup.remove_repeats(df).collect())) == want
    assert as_sorted(map(tuple, suffix_dedup.remove_repeats(df, filter_bits=7).collect())) == want
    for row in suffix_dedup.remove_repeats(df, with_runs=True).collect():
        assert sum(r["end"] - r["start"] for r in row["runs"]) == row["n_removed"]


def test_cover_meets_every_difference():
    p, cover = suffix_dedup.PERIOD, suffix_dedup.COVER
    assert {(a - b) % p for a in cover for b in cover} == set(range(p))


# mixing

def target_brute(sizes, weights=(1, 2, 3), cap=3):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    fixed = {}
    while True:
        rest = sum(sizes.values()) - sum(fixed.values())
        free = sum(weight[s] for s in order if s not in fixed)
        share = {s: fixed.get(s, rest * weight[s] / free if free else 0) for s in order}
        over = [s for s in order if s not in fixed and share[s] > cap * sizes[s]]
        if not over:
            return share
        fixed |= {s: cap * sizes[s] for s in over}


@pytest.mark.parametrize("which", ["odd", "small"])
def test_mixing(ctx, odd_docs, which):
    docs = ODD if which == "odd" else small
    df = odd_docs if which == "odd" else ctx.createDataFrame(small, "doc_id long, text string, source string")
    rows = mixing.mix(df).collect()
    sizes = [(i, s, len(WORD.findall((t or "").encode()))) for i, t, s in docs]
    assert as_sorted((r["doc_id"], r["source"], r["size"]) for r in rows) == as_sorted(sizes)
    total, taken, largest = Counter(), Counter(), Counter()
    for _, s, n in sizes:
        total[s] += n
        largest[s] = max(largest[s], n)
    want = target_brute(total)
    for r in rows:
        assert r["source_size"] == total[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    for s in total:
        assert abs(taken[s] - want[s]) <= largest[s]
        if which == "small" and max(largest[s], 1) * 20 < want[s]:
            assert taken[s] == pytest.approx(want[s], rel=0.02)
    if which == "odd":  # reruns agree
        again = mixing.mix(df.repartition(7)).collect()
        assert as_sorted(map(tuple, rows)) == as_sorted(map(tuple, again))


def test_mix_rows(odd_docs, no_docs):
    copies = Counter()
    for r in mixing.mix(odd_docs).collect():
        copies[(r["doc_id"], r["source"], r["size"])] += r["copies"]
    out = mixing.repeat_rows(odd_docs)
    assert out.columns == odd_docs.columns
    got = Counter((r["doc_id"], r["source"], len(WORD.findall((r["text"] or "").encode()))) for r in out.collect())
    assert got == +copies
    assert mixing.repeat_rows(no_docs).collect() == []


def test_equal_ids_reach_the_target(ctx, monkeypatch):
    """Rows of one id (none, or one for all) and of one size gain copies one by one."""
    monkeypatch.setattr(mixing, "RUN", 100)
    docs = [(None, "ten words " * 5, "s1")] * 1000 + [(7, "and ten more words " * 3, "s2")] * 700
    docs += [(k, "w " * 20, "s3") for k in range(500)]
    df = ctx.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mixing.mix(df.repartition(3)).collect()
    taken, target, size = Counter(), {}, {}
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]], size[r["source"]] = r["target"], r["size"]
    assert len(rows) == len(docs)
    for s in target:
        assert 0 <= target[s] - taken[s] <= size[s], (s, taken, target)
    again = mixing.mix(df.repartition(7)).collect()
    assert as_sorted(map(tuple, rows)) == as_sorted(map(tuple, again))
    out = mixing.repeat_rows(df.repartition(5)).groupBy("doc_id", "source").count().collect()
    want = Counter()
    for r in rows:
        want[(r["doc_id"], r["source"])] += r["copies"]
    assert {(r["doc_id"], r["source"]): r["count"] for r in out} == dict(want)


# packing

def test_packing(odd_docs, no_docs):
    tokenizer = Tokenizer.from_file(jobs.WORD_BPE)
    pieces = packing.pack(odd_docs, jobs.WORD_BPE).collect()
    want = Counter()
    for i, t, _ in ODD:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want[(i, tuple(ids))] += 1
    own = defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4")
        assert len(ids) == p["length"] <= 2048
        own[(p["doc_id"], p["doc_tokens"])].append((p["start"], tuple(ids.tolist())))
    got = Counter()
    for (i, n), parts in own.items():
        parts.sort()
        several = max(Counter(s for s, _ in parts).values())
        if len({t for s, t in parts if s == 0}) == several > 1:  # other texts of equal length
            for _, t in parts:
                got[(i, t)] += 1
            continue
        for k in range(several):
            joined = tuple(x for _, t in parts[k::several] for x in t)
            assert len(joined) == n
            got[(i, joined)] += 1
    assert got == want
    check_sequences(pieces)
    assert packing.pack(no_docs, jobs.WORD_BPE).collect() == []


def check_sequences(pieces):
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences)


def test_packing_pads_little(ctx):
    df = ctx.createDataFrame(small * 3, "doc_id long, text string, source string")
    pieces = packing.pack(df, jobs.WORD_BPE).select("sequence_id", "offset", "length").collect()
    n = check_sequences(pieces)
    assert sum(p["length"] for p in pieces) > 0.97 * 2048 * n


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 32), st.integers(0, 60)), min_size=1, max_size=32))
def test_column_generation_covers_the_demand(items):
    demand = np.zeros(32, int)
    for k, n in items:
        demand[k - 1] += n
    patterns = packing.column_generation(demand, 32)
    made = sum((use * n for use, n in patterns), np.zeros(32, int))
    size = np.arange(1, 33)
    assert (made >= demand).all() and all((use * size).sum() <= 32 for use, _ in patterns)
    room = []  # first-fit decreasing over all items
    for k in range(31, -1, -1):
        for _ in range(demand[k]):
            at = next((i for i, r in enumerate(room) if r > k), None)
            if at is None:
                room.append(32)
                at = len(room) - 1
            room[at] -= k + 1
    assert sum(n for _, n in patterns) <= len(room) + len(np.nonzero(demand)[0])


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([*"aÅΣσς'sé ́\x1c\x85\xa0\u2028\t\n", "<|endoftext|>"]),
                         st.characters(blacklist_categories=["Cs"])), max_size=60).map("".join))
def test_words_encode_as_the_whole_text(text):
    ids = Tokenizer.from_file(jobs.WORD_BPE).encode(text, add_special_tokens=False).ids
    with open(jobs.WORD_BPE, encoding="utf-8") as f:
        own = packing.WordIds.cached(f.read())
    assert np.frombuffer(own.encode(text), "<u4").tolist() == ids


def test_forms_of_a_word_are_encoded_once():
    with open(jobs.WORD_BPE, encoding="utf-8") as f:
        own = packing.WordIds(f.read())
    calls, model = [], own.model
    own.model = SimpleNamespace(
        encode_batch_fast=lambda texts, **k: calls.append(texts) or model.encode_batch_fast(texts, **k))
    texts = ["Home home, HOME... (home)", None, "", "\u00c9t\u00e9 \u00e9t\u00e9. home", "odd\u2028space Home",
             "Home<|endoftext|> HOME <|ENDOFTEXT|>", "H\u0331ome E\u0301t\u00e9, \u4e2d", " home, "] * 3
    tokenizer = Tokenizer.from_file(jobs.WORD_BPE)
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["cut off", *texts], kind).slice(1)
        assert [np.frombuffer(ids, "<u4").tolist() for ids in own.encode_all(column)] == want
    assert len(calls) == 1 and {"home", "home,", "HOME..."} & set(own.words.to_pylist()) == {"home"}
    own.direct = False  # another tokenizer: every word by the whole of it
    own.forget()
    assert [np.frombuffer(ids, "<u4").tolist() for ids in own.encode_all(pa.array(texts))] == want


def test_words_go_with_the_task(ctx):
    """A worker outlives its tasks and would hold the words of all of them."""
    docs = ctx.range(4000).selectExpr("id as doc_id", "concat_ws(' ', md5(string(id)), 'and', md5(string(-id))) as text")
    assert packing.encode_pieces(docs.repartition(8), jobs.WORD_BPE).count() == 4000

    def held(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(map(len, packing._TOKENIZERS.values()))])], ["n"])

    assert all(r["n"] == 0 for r in ctx.range(0, 16, 1, 16).mapInArrow(held, "n long").collect())


def test_chunks_of_texts_are_small_and_do_not_change_them():
    texts = [f"Tale {k} of MANY words, {k * k}!".encode() * (1 + k % 50) for k in range(2000)]
    chunks = list(words.text_chunks(pa.array([t.decode() for t in texts])))
    assert [t for c in chunks for t in c] == texts and max(sum(map(len, c)) for c in chunks) <= 200_000
    whole, parts = quality.features(texts), [quality.features(c) for c in chunks]
    assert np.array_equal(whole[0], np.concatenate([p[0] for p in parts]))
    assert all(map(np.array_equal, whole[1], [w for p in parts for w in p[1]]))
    assert np.array_equal(whole[2], np.concatenate([p[2] for p in parts]))


# token counts

@given(st.lists(st.sampled_from(["a", "Bc", ".", "!", "?", " ", "\n", ")", "é", "  "]), max_size=20).map("".join))
def test_sentences_cover_the_text(text):
    borders = token_counts.sentences(text) if text else np.array([0, 0])
    assert borders[0] == 0 and borders[-1] == len(text) and (np.diff(borders) > 0).all() == bool(text)
    for b in borders[1:-1]:
        assert text[b - 1].isspace() and not (text[b - 1] == "\n" and text[b] == "\n")


def test_tokens_over_sentence_borders(ctx):
    """The rules decide where a token goes that begins with the space before a sentence."""
    docs = ctx.createDataFrame([(1, "One two. Three four! Five")], "doc_id long, text string")
    got = {}
    for rule in token_counts.RULES:
        rows = token_counts.section_tokens(docs, jobs.BYTE_RANKS, public_tokenizers.PATTERN, rule,
                                           token_counts.sentences).orderBy("section").collect()
        assert [(r["start"], r["end"]) for r in rows] == [(0, 9), (9, 21), (21, 25)]
        got[rule] = ([r["tokens"] for r in rows], sum(r["crossing"] for r in rows))
    total = sum(got["most"][0])
    assert got["most"] == got["last"] and got["most"][1] == 2
    assert got["first"][0][0] == got["most"][0][0] + 1 and sum(got["first"][0]) == total == sum(got["last"][0])


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_section_tokens(odd_docs, no_docs, rule):
    counts = token_counts.section_tokens(odd_docs, jobs.BYTE_RANKS, public_tokenizers.PATTERN, rule)
    encoding, _ = token_counts._encoding(open(jobs.BYTE_RANKS, "rb").read(), public_tokenizers.PATTERN)
    got = defaultdict(Counter)
    for r in counts.collect():
        got[r["doc_id"]][(r["section"], r["start"], r["end"], r["tokens"], r["crossing"])] += 1
    want = defaultdict(Counter)
    for i, t, _ in ODD:
        borders = [0] + [k + 1 for k, c in enumerate(t or "") if c == "\n" and k + 1 < len(t)] + [len(t or "")]
        tokens, crossing, at = [0] * (len(borders) - 1), [0] * (len(borders) - 1), 0
        char_of = [k for k, c in enumerate(t or "") for _ in c.encode()]
        for token in encoding.encode_ordinary(t or ""):
            chars = char_of[at:(at := at + len(encoding.decode_single_token_bytes(token)))]
            homes = [max(k for k in range(len(borders) - 1) if borders[k] <= c) for c in sorted(set(chars))]
            home = {"first": homes[0], "last": homes[-1], "most": max(sorted(set(homes)), key=homes.count)}[rule]
            tokens[home] += 1
            crossing[home] += homes[0] != homes[-1]
        for k in range(len(tokens)):
            want[i][(k, borders[k], borders[k + 1], tokens[k], crossing[k])] += 1
    assert got == want
    assert token_counts.section_tokens(no_docs, jobs.BYTE_RANKS, public_tokenizers.PATTERN).collect() == []


@pytest.mark.parametrize("rule, want", [("first", [1, 0, 2]), ("last", [0, 1, 2]), ("most", [0, 1, 2])])
def test_crossing_rule(rule, want):
    # tokens 0-2 | 2-7 | 7-9 over sections 0-3, 3-7, 7-9: the first ends in 0, the second crosses
    first, after = np.array([2, 7, 8]), np.array([7, 8, 9])
    tokens, crossing = token_counts.attribute(first, after, np.array([0, 3, 7, 9]), rule)
    assert tokens.tolist() == want and crossing.sum() == 1


# quality

def test_label_model_finds_the_accuracies():
    rng = np.random.default_rng(5)
    bad = rng.random(20000) < 0.2
    true = [(0.9, 0.05), (0.6, 0.02), (0.7, 0.1), (0.95, 0.03)]
    votes = np.column_stack([np.where(rng.random(len(bad)) < np.where(bad, b, g), 1, 0) for b, g in true])
    votes[rng.random(votes.shape) < 0.3] = -1
    patterns, weight = np.unique(votes, axis=0, return_counts=True)
    prior, rates = quality.em(patterns, weight.astype(float))
    assert prior == pytest.approx(0.2, abs=0.02)
    assert rates == pytest.approx(np.array(true), abs=0.04)


def test_quality_held_out(ctx):
    """Fitted on one part of the labels, held against the other."""
    sf = "/root/testdata/sf0.1"
    docs = ctx.read.parquet(f"{sf}/documents.parquet")
    labels = ctx.read.parquet(f"{sf}/labels.parquet")
    model = quality.fit(docs, labels.filter("doc_id % 2 = 0"))
    rows = quality.score(docs, model).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    good = [r for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    low = [r for r in rows if r["quality"] == 0]
    toxic = [r for r in rows if r["toxic"] == 1]
    assert sum(r["kept"] for r in good) >= 0.97 * len(good)
    assert sum(r["p_low"] > 0.5 for r in low) >= 0.95 * len(low)
    assert sum(not r["kept"] for r in toxic) >= 0.8 * len(toxic)


def test_quality_of_few_labels(ctx):
    """Labels of a small part of the documents all shape the model, also where
    many rows share a null id."""
    rng = np.random.default_rng(6)
    prose = lambda k: " ".join(f"w{x}" for x in rng.integers(0, 3000, 40)) + (" foulword" if k % 10 == 0 else "")
    docs = [(k, prose(k)) for k in range(3000)] + [(None, prose(1)) for _ in range(1000)]
    df = ctx.createDataFrame(docs, "doc_id long, text string").repartition(4)
    labels = ctx.createDataFrame([(k, 1, int(k % 10 == 0)) for k in range(200)], "doc_id long, quality int, toxic int")
    model = quality.fit(df, labels, sample_rows=400)
    assert len(model.lexicon)
    kept = {r["doc_id"]: r["kept"] for r in quality.score(df, model).filter("doc_id is not null").collect()}
    assert not any(kept[k] for k in range(0, 3000, 10))
    assert sum(kept.values()) >= 0.97 * 2700


def test_quality_odd_rows(ctx, odd_docs, no_docs):
    labels = ctx.createDataFrame([(1, 1, 0), (1, 0, 0), (3, None, 1), (None, 0, 1), (99, 0, 0)],
                                 "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        model = quality.fit(odd_docs, known)
        assert quality.score(odd_docs, model).count() == len(ODD)
        assert quality.keep(odd_docs, model).columns == odd_docs.columns
    assert quality.score(no_docs, quality.fit(no_docs, labels)).collect() == []


def test_very_long_rows_are_there():
    assert len(LONG) > 200_000 and len(PROSE) > 700


# quality classifier against brute force

def brute_votes(text):
    """Shapes of words counted one by one: bad (1), good (0) or abstain (-1)."""
    found = WORD.findall((text or "").encode())
    punct = {*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)}
    counts = [0, 0, 0, 0]
    for k, w in enumerate(found):
        upper, lower = sum(0x41 <= c <= 0x5A for c in w), sum(0x61 <= c <= 0x7A for c in w)
        counts[0] += upper >= 2 and not lower
        counts[1] += sum(c in punct for c in w) >= 2
        counts[2] += k > 0 and found[k - 1].lower() == w.lower()
        counts[3] += len(w) == 1 and w[0] in punct
    if len(found) < quality.LEAST_WORDS:
        return [-1] * 4
    fires = [c / len(found) > quality.SHARE for c in counts]
    return [1 if f else -1 if any(fires) else 0 for f in fires]


def test_classifier_equals_brute_force(ctx, odd_docs):
    docs = ctx.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(odd_docs.select("doc_id", "text"))
    texts = [r["text"] for r in docs.collect()]
    found = quality.features([(t or "").encode() for t in texts])
    got = quality.votes(*found, np.zeros(0, np.int32))[:, :4]
    assert got.tolist() == [brute_votes(t) for t in texts]
    model = quality.fit(docs, ctx.read.parquet(f"{SF_SMALL}/labels.parquet"))
    # the posterior is Bayes' rule over the labellers' rates, pattern by pattern
    for target, names in (("low", quality.QUALITY), ("toxic", quality.TOXIC)):
        rates = np.array([model.labellers[target][n] for n in names])
        for pattern in ([1, 1, -1], [0, 1, 0], [-1, -1, 1]):
            votes = (pattern * 2)[:len(names)]
            bad, good = model.priors[target], 1 - model.priors[target]
            for v, (b, g) in zip(votes, np.clip(rates, 1e-6, 1 - 1e-6)):
                bad, good = bad * (b if v == 1 else 1 - b if v == 0 else 1), good * (g if v == 1 else 1 - g if v == 0 else 1)
            assert quality.posterior(np.array([votes]), model.priors[target], rates)[0] == pytest.approx(bad / (bad + good))
    # every row's scores, each text alone
    want = Counter()
    for i, t in ((r["doc_id"], r["text"]) for r in docs.collect()):
        shares, words_, _ = quality.features([(t or "").encode()])
        low, toxic = (float(model.score(x, shares, words_)[0]) for x in ("low", "toxic"))
        want[(i, round(low, 9), round(toxic, 9), low <= 0.5 and toxic <= 0.5)] += 1
    rows = quality.score(docs, model).collect()
    assert Counter((r["doc_id"], round(r["p_low"], 9), round(r["p_toxic"], 9), r["kept"]) for r in rows) == want
    assert quality.keep(docs, model).count() == sum(r["kept"] for r in rows)
