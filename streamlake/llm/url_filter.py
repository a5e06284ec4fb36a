"""URL filter over a sorted digest array.

Rules (host, path prefix) become 64-bit xxhash keys in one sorted array. The
array and the rule strings are written as ``.npy`` files, shipped once per
executor (``SparkContext.addFile``) and memory-mapped there, so the Python
workers of a host share its pages. A URL's candidate keys (each host suffix
at a label boundary times each rule-path length) are probed with a
vectorised binary search; a hit counts only if the stored full string equals
the candidate.

Defined results: a null URL, or one without ``://``, has an empty host and
path and gets the default verdict; of rules that fit, the longest string
wins, then the one with the longer host; a rule given twice counts once, its
last verdict wins. Empty tables give empty results; other columns pass
through, clashing output names are replaced.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

_OPEN: dict[str, tuple] = {}
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) as columns; null or no ``://`` gives two empty strings."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    low = F.translate(host, _UPPER, _UPPER.lower())
    return F.coalesce(low, F.lit("")), F.coalesce(path, F.lit(""))


def _mapped(path: str) -> np.ndarray:
    try:
        return np.load(path, mmap_mode="r")
    except ValueError:  # an empty array cannot be mapped
        return np.load(path)


class DigestArray:
    """Sorted keys, the strings they stand for and their verdicts, on disk."""

    def __init__(self, keys: np.ndarray, ends: np.ndarray, text: np.ndarray, block: np.ndarray):
        self.keys, self.ends, self.text, self.block = keys, ends, text, block

    @staticmethod
    def write(rules: Sequence[tuple[str, str, str]], stem: str) -> list[str]:
        """``rules``: (verdict, host, path prefix starting with ``/``). Returns the files."""
        rows = {}
        for verdict, host, path in rules:
            if verdict not in ("allow", "block") or not host or not path.startswith("/"):
                raise ValueError(f"not a rule: {(verdict, host, path)}")
            rows[(host.translate(str.maketrans(_UPPER, _UPPER.lower())) + path).encode()] = verdict == "block"
        order = sorted(rows, key=lambda s: (xxhash.xxh64_intdigest(s), s))
        strings = b"".join(order)
        arrays = (("keys", np.array([xxhash.xxh64_intdigest(s) for s in order], np.uint64)),
                        ("ends", np.cumsum([len(s) for s in order], dtype=np.int64)),
                        ("text", np.frombuffer(strings, np.uint8)),
                        ("block", np.array([rows[s] for s in order], bool)),
                        ("lengths", np.array(sorted({len(p.encode()) for _, _, p in rules}), np.int64)))
        for name, a in arrays:
            np.save(f"{stem}-{name}.npy", a)
        return [f"{stem}-{name}.npy" for name, _ in arrays]

    @staticmethod
    def open(stem: str) -> tuple[DigestArray, np.ndarray]:
        """The memory-mapped array and the path lengths that occur in it."""
        if stem not in _OPEN:
            part = {n: _mapped(f"{stem}-{n}.npy") for n in ("keys", "ends", "text", "block", "lengths")}
            lengths = part.pop("lengths")
            _OPEN[stem] = DigestArray(**part), lengths
        return _OPEN[stem]

    def string(self, i: int) -> bytes:
        return self.text[self.ends[i - 1] if i else 0:self.ends[i]].tobytes()

    def find(self, candidates: list[bytes]) -> np.ndarray:
        """Index of each candidate in the array, or -1."""
        if not candidates or not len(self.keys):
            return np.full(len(candidates), -1)
        probe = np.fromiter((xxhash.xxh64_intdigest(c) for c in candidates), np.uint64, len(candidates))
        at, end = np.searchsorted(self.keys, probe), np.searchsorted(self.keys, probe, "right")
        found = np.full(len(candidates), -1)
        for k in np.nonzero(at < end)[0]:  # equal keys: confirm the strings
            found[k] = next((i for i in range(at[k], end[k]) if self.string(i) == candidates[k]), -1)
        return found


def ship(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> str:
    """Build the array on the driver and send its files to the executors."""
    name = f"urlfilter-{uuid.uuid4().hex}"
    for path in DigestArray.write(rules, os.path.join(tempfile.mkdtemp(prefix="urlfilter-"), name)):
        spark.sparkContext.addFile(path)
    return name


def match(pages: DataFrame, rules: Sequence[tuple[str, str, str]], url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``."""
    name = ship(pages.sparkSession, rules)

    @pandas_udf("struct<rule:string,block:boolean>")
    def probe(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        array, lengths = DigestArray.open(os.path.join(SparkFiles.getRootDirectory(), name))
        for hosts, paths in batches:
            candidates, owner, rank = [], [], []
            for k, (host, path) in enumerate(zip(hosts, paths)):
                path, suffix = path.encode(), host
                while suffix:
                    s = suffix.encode()
                    for n in lengths:
                        if n > len(path):
                            break
                        candidates.append(s + path[:n])
                        owner.append(k)
                        rank.append((len(s) + int(n), len(s)))
                    suffix = suffix.partition(".")[2]
            best: dict[int, tuple] = {}
            hits = array.find(candidates)
            for j in np.nonzero(hits >= 0)[0]:
                if owner[j] not in best or rank[j] > best[owner[j]][0]:
                    best[owner[j]] = rank[j], int(hits[j])
            rule = [array.string(best[k][1]).decode() if k in best else None for k in range(len(hosts))]
            yield pd.DataFrame({"rule": rule, "block": [bool(array.block[best[k][1]]) if k in best else None
                                                        for k in range(len(hosts))]})

    host, path = split_url(F.col(url_col))
    own = ("host", "path", "rule", "verdict")
    # whole rows travel as one column, so their names cannot clash with these
    named = pages.select(F.struct(*[F.col(c) for c in pages.columns if c not in own or c == url_col]).alias("row"),
                         host.alias("host"), path.alias("path")).withColumn("hit", probe("host", "path"))
    verdict = (F.when(F.col("hit.block").isNull(), F.lit(default))
               .when(F.col("hit.block"), F.lit("block")).otherwise(F.lit("allow")))
    return named.select("row.*", "host", "path", F.col("hit.rule").alias("rule"), verdict.alias("verdict"))
