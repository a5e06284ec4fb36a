"""URL filter, neighbours, chat windows, the registered queries and the pipeline."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from streamlake.llm import ann, chat, jobs, url_filter

# URL filter

URLS = [None, "", "no scheme", "://", "http://", "http://ORG", "https://a.b.Example.ORG/en/12?x", "x://example.org/es/",
        "ftp://example.org/es", "http://notexample.org/es/", "http://m.com/fr/", "http://m.com/de/x#y", "http://com/fr",
        "a://b://c.com/de/", "http://x.com?/de/", "http://é.com/fr/\n", "http://example.org/en/1", "http://example.org/en/",
        "http://.org/", "http://org./", "HTTP://EXAMPLE.ORG/EN/1"]


def url_brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host):]
    for c in "?#":
        path = path.split(c, 1)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, _, rule, verdict = max(fits, default=(0, 0, None, default))
    return host, path, rule, verdict


def test_url_filter(ctx):
    pages = ctx.createDataFrame([(k, u, "x", "y", "z") for k, u in enumerate(URLS + URLS[5:7])],
                                "page_id long, url string, host string, row string, hit string")
    got = url_filter.match(pages, jobs.URL_RULES)
    assert got.columns == ["page_id", "url", "row", "hit", "host", "path", "rule", "verdict"]
    for r in got.collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == url_brute(r["url"], jobs.URL_RULES), r["url"]
    assert url_filter.match(pages.limit(0), jobs.URL_RULES).collect() == []
    assert {r["verdict"] for r in url_filter.match(pages, [], default="block").collect()} == {"block"}


def test_equal_digests_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda s: 7)
    rules = [("block", "a.com", "/"), ("allow", "b.com", "/x")]
    url_filter.DigestArray.write(rules, str(tmp_path / "all"))
    array, _ = url_filter.DigestArray.open(str(tmp_path / "all"))
    found = array.find([b"a.com/", b"b.com/x", b"c.com/"])
    assert [array.string(i) if i >= 0 else None for i in found] == [b"a.com/", b"b.com/x", None]


# neighbours

def near_brute(vectors, queries, k):
    out = {}
    for q in queries:
        d = sorted((math.sqrt(((np.array(v) - np.array(vectors[q])) ** 2).sum()), i)
                   for i, v in vectors.items() if i != q and len(v) == len(vectors[q]))
        out[q] = d[:k]
    return out


def test_neighbours_of_odd_rows(ctx):
    rows = [(k, [float(k % 7), 1.0, float(k % 3)], k) for k in range(60)]  # many equal vectors
    rows += [(100, None, 0), (101, [0.0, 0.0, 0.0], 0), (102, [1.0, None, 2.0], 0), (103, [float("nan"), 1.0, 1.0], 0),
             (104, [float("inf"), 1.0, 1.0], 0), (None, [1.0, 1.0, 1.0], 0), (105, [], 0), (106, [1.0, 2.0], 0),
             (200, [3.0, 4.0], 0), (3, [3.0, 1.0, 0.0], 9)]
    table = ctx.createDataFrame(rows, "vec_id long, embedding array<double>, v int")
    got = defaultdict(list)
    for r in ann.nearest(table, F.col("vec_id") % 10 == 0, shard_rows=20).collect():
        got[r["query_id"]].append((r["rank"], r["score"], r["vec_id"]))
    valid = {i: v for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
             and any(v)}
    want = near_brute(valid, [q for q in valid if q % 10 == 0], 10)
    assert {q: [(k + 1, *x) for k, x in enumerate(w)] for q, w in want.items() if w} == {
        q: sorted(g) for q, g in got.items()}
    assert ann.nearest(table.limit(0), F.col("vec_id") % 10 == 0).collect() == []


def test_recall(ctx):
    sf = "/root/testdata/sf0.1"
    table = ctx.read.parquet(f"{sf}/embeddings.parquet")
    data = {r["vec_id"]: r["embedding"] for r in table.collect()}
    ids = np.array(list(data))
    x = np.array(list(data.values()))
    got = defaultdict(dict)
    for r in ann.nearest(table, F.col("vec_id") % 100 == 0, shard_rows=1024).collect():
        got[r["query_id"]][r["vec_id"]] = r["score"]
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - np.array(data[q])) ** 2).sum(axis=1))
        best = [i for _, i in sorted(zip(d, ids)) if i != q][:10]
        hits += len(set(best) & set(got[q]))
        total += len(best)
        for i, s in got[q].items():
            assert s == pytest.approx(d[ids == i][0], abs=1e-12)
    assert hits >= 0.9 * total


# chat

TEXTS = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "~", "\n", "a", "é", "<", "[", "n"]),
                 max_size=12).map("".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(TEXTS, TEXTS, st.integers(0, 30)), min_size=1, max_size=12), st.integers(1, 60),
       st.integers(0, 30))
def test_windows_round_trip(turns, budget, history):
    turns = [(["user", "assistant", "system", r][n % 4], t, n) for r, t, n in turns]
    cutter = chat._Windows(budget, history)
    windows = [w for t in turns for w in cutter.add(*t)] + [cutter.close()]
    read, targets = [], []
    for w in windows:
        parsed = list(chat.parse(w["formatted"]))
        read += [(r, t) for r, t, _, _ in parsed[w["repeated"]:]]
        targets += [chat.unescape(w["formatted"][s["start"]:s["end"]]) for s in w["loss"]]
        new = turns[len(read) - len(parsed[w["repeated"]:]):len(read)]
        assert w["tokens"] <= budget or len(new) == 1
        if turns[0][0] == "system" and w["window"]:
            assert parsed[0][:2] == turns[0][:2]
    assert read == [(r, t) for r, t, _ in turns]
    assert targets == [t for r, t, _ in turns if r == "assistant"]


def test_chat_query(ctx):
    rows = duckdb.sql(f"select * from '{SF_SMALL}/conversations.parquet'").fetchall() + list(jobs.TRAP)
    got = {r["conv_id"]: r for r in jobs.queries()["op10_chat_windows"](ctx, SF_SMALL).collect()}
    conversations = defaultdict(list)
    for c, k, role, text in sorted(rows, key=lambda r: (r[0], r[1])):
        conversations[c].append((role, text or ""))
    assert set(got) == set(conversations)
    for c, turns in conversations.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c]["loss_chars"] == len(loss)
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_odd_rows(ctx):
    rows = [(1, 0, "system", "be kind", "q"), (1, 1, "user", None, "q"), (1, 1, "user", None, "q"),
            (1, 2, None, "who?", "q"), (1, 3, "assistant", "x y z " * 4000, "q"), (None, None, "assistant", "", "q"),
            (None, 0, None, None, "q")]
    table = ctx.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string")
    windows = chat.format_windows(table, jobs.BYTE_RANKS, public_tokenizers.PATTERN)
    assert {r["conv_id"]: r["n_turns"] for r in chat.read_back(windows).collect()} == {1: 5, None: 2}
    none = chat.format_windows(table.limit(0), jobs.BYTE_RANKS, public_tokenizers.PATTERN)
    assert chat.read_back(none).collect() == []


def test_long_conversations_are_cut_into_blocks(ctx, monkeypatch):
    """Turns of any block appear once, with the system turn and the history before them."""
    monkeypatch.setattr(chat, "BLOCK", 20)
    monkeypatch.setattr(chat, "CARRIED", 6)
    from streamlake.operators import ranges
    monkeypatch.setattr(ranges, "MAX_RANGES", 5)
    rows = [(1, 0, "system", "be kind")] + [(1, k, ["assistant", "user"][k % 2], f"turn {k} of one") for k in range(1, 137)]
    rows += [(2, k, ["user", "assistant"][k % 2], f"turn {k} of two") for k in range(41)]
    rows += [(None, k, "assistant", "same") for k in range(45)] + [(3, 0, "system", "short"), (3, 1, "user", "hi")]
    table = ctx.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    windows = chat.format_windows(table, jobs.BYTE_RANKS, public_tokenizers.PATTERN, budget=40, history=15)
    held = defaultdict(list)
    for w in windows.collect():
        held[w["conv_id"]].append(w)
    for c, own in held.items():
        own.sort(key=lambda w: w["window"])
        assert len({w["window"] for w in own}) == len(own)
        want = [(r, t) for i, _, r, t in sorted((x for x in rows if x[0] == c), key=lambda x: x[1])]
        new = []
        for w in own:
            parsed = [(r, t) for r, t, _, _ in chat.parse(w["formatted"])]
            fresh, repeated = parsed[w["repeated"]:], parsed[:w["repeated"]]
            if want[0][0] == "system" and new:
                assert repeated[0] == want[0]
                repeated = repeated[1:]
            if c != 3 and new:  # history: the turns just before, as many as fit
                assert repeated and repeated == new[-len(repeated):]
            new += fresh
        assert new == want
    got = {r["conv_id"]: r for r in chat.read_back(windows).collect()}
    for c, own in held.items():
        turns = [(r, t) for i, _, r, t in sorted((x for x in rows if x[0] == c), key=lambda x: x[1])]
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c]["loss_chars"] == sum(len(t) for r, t in turns if r == "assistant")


# queries and pipeline

def test_queries_match_sql(ctx):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, sql in jobs.oracle_sql().items():
        df = E.queries()[name](ctx, SF_SMALL)
        res = con.execute(sql)
        at = [[d[0] for d in res.description].index(c) for c in df.columns]
        assert Counter(map(tuple, df.collect())) == Counter(tuple(r[k] for k in at) for r in res.fetchall()), name


def test_pipeline(ctx):
    docs = ctx.read.parquet(f"{SF_SMALL}/documents.parquet")
    sizes = [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(ctx, docs, SF_SMALL)
        if k < 4:
            assert out.columns == docs.columns
            docs = corpus_pipeline.write_table(out, f"test-{name}")
            sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3]
    pieces = out.collect()
    want = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
    assert Counter(p["doc_id"] for p in pieces if p["start"] == 0) == want
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "near_dedup",
                                                      "source_mixing", "packing"]


def test_pipeline_of_nothing(ctx):
    docs = ctx.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(ctx, docs, SF_SMALL)
        assert out.collect() == []


def test_pipeline_of_odd_rows(ctx, odd_docs):
    """Nulls, repeated ids, equal texts and clashing columns through all stages."""
    docs, held = odd_docs, [Counter(odd_docs.select("doc_id", "text").collect())]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(ctx, docs, SF_SMALL)
        if k < 4:
            assert out.columns == odd_docs.columns
            docs = corpus_pipeline.write_table(out, f"odd-{name}")
            held.append(Counter(docs.select("doc_id", "text").collect()))
    scored, exact, near, mixed = held[1:]
    assert not scored - held[0] and not exact - scored and not near - exact and set(mixed) <= set(near)
    norm = {re.sub(r"[\x20\x09-\x0d]+", " ", r["text"] or "") for r in scored}
    assert len(exact) == sum(exact.values()) == len(norm)
    assert Counter(r["doc_id"] for r in out.collect() if r["start"] == 0) == Counter(
        i for (i, _), n in mixed.items() for _ in range(n))
