"""BPE encoding and decoding of whole texts by tree concatenation.

A text of more than ``leaf`` characters is cut into leaves that tasks encode in parallel. The leaves of a document
then meet in a tree: to join two neighbours, the last and first ``k`` tokens around the cut are encoded anew
as one window, ``k`` growing until both sides agree exactly. A side agrees where the window's outer tokens equal the
neighbour's own up to a place that any text splits at (a space between two other characters), or, inside one
unbroken run of letters, in one token at least: a sequence of BPE tokens is the encoding of its text if each
adjacent pair is the encoding of its own text, and then every pair stands in one of the three encodings. A window that
has grown over both neighbours is their encoding outright. Cuts never fall into the string of a special token.

Defined cases: null and empty texts have no ids, an empty decoded text and the hashes of nothing. Repeated rows
are encoded once each. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaria.llm.bpe import Codec, codec
from voltaria.session import stage

LEAF_CHARS = 32_768
FIRST_WINDOW = 16


def cut_points(text: str, size: int, special: list[str]) -> list[int]:
    """Positions that cut a text into pieces of about ``size``, none inside a special token's string."""
    cuts, at = [0], size
    while at < len(text):
        moved = True
        while moved:
            moved = False
            for token in special:
                found = text.find(token, max(0, at - len(token) + 1), at + len(token) - 1)
                if 0 <= found < at < found + len(token):
                    at, moved = found + len(token), True
        if at < len(text):
            cuts.append(at)
        at += size
    return [*cuts, len(text)]


def _splits(data: bytes, at: int) -> bool:
    """Whether every text with these bytes starts a new piece at ``at``: a single space between two ASCII non-spaces."""
    return 0 < at < len(data) - 1 and data[at] == 32 and 32 < data[at - 1] < 127 and 32 < data[at + 1] < 127


def join(left: list[int], right: list[int], tool: Codec, first: int = FIRST_WINDOW) -> list[int]:
    """Ids of the concatenation of two encoded texts."""
    if not left or not right:
        return left or right
    pieces, k = tool.pieces, first
    while True:
        i, j = min(k, len(left)), min(k, len(right))
        while i < len(left) and pieces[left[-i]][0] & 0xC0 == 0x80:
            i += 1
        while j < len(right) and pieces[right[j]][0] & 0xC0 == 0x80:
            j += 1
        tail, head = left[len(left) - i :], right[:j]
        data = b"".join(pieces[t] for t in (*tail, *head))
        text = data.decode("utf-8", "replace")
        window = tool.encode(text)
        letters = text.isalpha()
        if _agrees(tail, window, data, pieces, i == len(left), letters, forward=True) and _agrees(head, window, data, pieces, j == len(right), letters, forward=False):
            return left[: len(left) - i] + window + right[j:]
        k *= 2


def _agrees(own: list[int], window: list[int], data: bytes, pieces: dict[int, bytes], whole: bool, letters: bool, forward: bool) -> bool:
    if whole:
        return True
    a, b = (own, window) if forward else (own[::-1], window[::-1])
    at, same = (0 if forward else len(data)), 0
    for x, y in zip(a, b):
        if x != y:
            return False
        same += 1
        if letters:
            return same >= 1
        at += len(pieces[x]) if forward else -len(pieces[x])
        if _splits(data, at):
            return True
    return False


def tree(parts: list[list[int]], tool: Codec) -> list[int]:
    """Join neighbours pairwise until one sequence is left."""
    while len(parts) > 1:
        parts = [join(parts[i], parts[i + 1], tool) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0] if parts else []


def digest(ids: list[int], tool: Codec) -> tuple[int, str, str]:
    """Number of ids, SHA-256 of the ids, SHA-256 of the decoded text."""
    raw = np.array(ids, dtype="<u4").tobytes()
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(tool.decode(ids).encode("utf-8", "replace")).hexdigest()


_OUT = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("ids", pa.list_(pa.int32()))]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", leaf: int = LEAF_CHARS, keep_ids: bool = False) -> DataFrame:
    """One row per row: the key, n_tokens, ids_sha256, decoded_sha256, and the ids themselves with ``keep_ids``."""
    plain = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = plain.schema["key"].dataType.simpleString()

    def row(key_value, found: list[int], tool: Codec) -> tuple:
        return (key_value, *digest(found, tool), found if keep_ids else None)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        special = list(tool.special)
        for batch in batches:
            keys, out, uid, part, piece = [], [], [], [], []
            for i, value in enumerate(batch.column(1)):
                whole = value.as_py() or ""
                if len(whole) <= leaf:
                    keys.append(i)
                    out.append(row(None, tool.encode(whole), tool))
                    uid.append(None)
                    part.append(None)
                    piece.append(None)
                    continue
                name, cuts = secrets.randbits(63), cut_points(whole, leaf, special)
                for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    keys.append(i)
                    out.append((None,) * 5)
                    uid.append(name)
                    part.append(n)
                    piece.append(whole[a:b])
            columns = [batch.column(0).take(pa.array(keys, pa.int64()))]
            columns += [pa.array([o[n + 1] for o in out], kind_) for n, (_, kind_) in enumerate(_OUT)]
            columns += [pa.array(uid, pa.int64()), pa.array(part, pa.int64()), pa.array(piece, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["key", *(n for n, _ in _OUT), "uid", "part", "piece"])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in batches:
            ids = [tool.encode(value.as_py()) for value in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ids, pa.list_(pa.int32()))], ["key", "uid", "part", "ids"])

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        tool = codec(path)
        parts = [ids.tolist() for ids in frame.sort_values("part")["ids"]]
        whole = tree(parts, tool)
        return pd.DataFrame([row(frame["key"].iloc[0], whole, tool)], columns=["key", *(n for n, _ in _OUT)])

    result = "n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>"
    first = stage(plain.mapInArrow(leaves, f"key {kind}, {result}, uid long, part long, piece string"), "leaves")
    short = first.where("uid is null").select("key", *(n for n, _ in _OUT))
    long = first.where("uid is not null").select("key", "uid", "part", "piece").repartition("uid", "part")
    tokens = long.mapInArrow(encoded, f"key {kind}, uid long, part long, ids array<int>")
    done = short.unionByName(tokens.groupBy("uid").applyInPandas(joined, f"key {kind}, {result}"))
    return done.select(F.col("key").alias(key), "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if keep_ids else []))
