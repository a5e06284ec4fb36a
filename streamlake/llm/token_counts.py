"""Token counts per section by offset-mapped attribution.

Each document is encoded once, whole, so counts add up to what a model would
see. The tokens' byte lengths give their character spans, which are joined to
the sections' spans by a sorted interval join inside the batch. A token that
crosses a section's border is allocated by a rule:

* ``first``: to the section with its first character;
* ``last``: to the section with its last character;
* ``most``: to the section with most of its characters, the earlier of equals.

A section is a line with its newline (``lines``), a sentence with the white
space after it (``sentences``, where tokens that begin with that space cross
the border), or any spans given.

Defined results: a null or empty text has one empty section 0 without tokens;
repeated rows are counted each; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = ("first", "last", "most")
_SENTENCE_END = re.compile(r"[.!?]+[\"')\]]*[ \t]+\n*|\n+")
_ENCODINGS: dict = {}


def _encoding(ranks: bytes, pattern: str):
    """The encoding and the byte length of each id."""
    key = hashlib.md5(ranks).digest()
    if key not in _ENCODINGS:
        import tiktoken
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        lengths = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            lengths[rank] = len(token)
        _ENCODINGS[key] = (tiktoken.Encoding("sections", pat_str=pattern, mergeable_ranks=table, special_tokens={}),
                           lengths)
    return _ENCODINGS[key]


def lines(text: str) -> np.ndarray:
    """Where the lines of a text begin, then the text's length."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    ends = np.flatnonzero(codes == 10) + 1
    return np.concatenate([[0], ends[ends < len(codes)], [len(codes)]])


def sentences(text: str) -> np.ndarray:
    """Where the sentences of a text begin, then the text's length. A sentence
    ends after the white space that follows its end marks, or a line's end."""
    ends = [m.end() for m in _SENTENCE_END.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return np.array([0, *ends])


def token_spans(raw: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and character after the last one, per token of the
    UTF-8 text ``raw``; a token that holds part of a character covers it."""
    end = np.cumsum(lengths)
    char = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) - 1  # character of each byte
    return char[end - lengths], char[end - 1] + 1


def attribute(first: np.ndarray, after: np.ndarray, borders: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Per section the tokens allocated to it, and how many of them cross a
    border. ``borders``: section starts and the end of the last one."""
    n = len(borders) - 1
    a = np.searchsorted(borders, first, "right") - 1
    b = np.searchsorted(borders, after - 1, "right") - 1
    to = a.copy() if rule != "last" else b.copy()
    crossing = a != b
    if rule == "most":
        for k in np.flatnonzero(crossing):  # few: tokens over a border
            parts = np.minimum(borders[a[k] + 1:b[k] + 2], after[k]) - np.maximum(borders[a[k]:b[k] + 1], first[k])
            to[k] = a[k] + int(np.argmax(parts))
    return np.bincount(to, minlength=n), np.bincount(to[crossing], minlength=n)


def section_tokens(docs: DataFrame, ranks_path: str, pattern: str, rule: str = "most",
                   sections: Callable[[str], np.ndarray] = lines, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per section: id, ``section`` (from 0), ``start``, ``end``
    (characters), ``tokens``, ``crossing`` (those allocated over a border).
    The driver reads the rank file (a fixed few MB) and broadcasts it."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    with open(ranks_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, lengths = _encoding(ranks.value, pattern)
        for batch in batches:
            kind = batch.schema.field("id").type
            ids, parts, held = [], [], 0
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                text = text.as_py() or ""
                borders = sections(text) if text else np.array([0, 0])
                if text:
                    own = lengths[np.array(encoding.encode_ordinary(text), np.int64)]
                    tokens, crossing = attribute(*token_spans(text.encode(), own), borders, rule)
                else:
                    tokens = crossing = np.zeros(1, np.int64)
                ids += [doc] * len(tokens)
                parts.append(np.stack([np.arange(len(tokens)), borders[:-1], borders[1:], tokens, crossing]))
                held += len(tokens)
                if held > 50_000:
                    yield _section_rows(ids, parts, kind)
                    ids, parts, held = [], [], 0
            if ids:
                yield _section_rows(ids, parts, kind)

    schema = f"id {dict(rows.dtypes)['id']}, section long, start long, end long, tokens long, crossing long"
    return rows.mapInArrow(count, schema).withColumnRenamed("id", id_col)


def _section_rows(ids: list, parts: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, kind), *map(pa.array, np.concatenate(parts, axis=1))],
                                      ["id", "section", "start", "end", "tokens", "crossing"])
