"""Alignment of two tokenizers' tokens by lockstep vectorised merging.

Every text is encoded by A (byte-level BPE, of a space and the text) and by B (a sentencepiece model, which adds the space
itself), special tokens' strings as plain text. The token ends of all documents of a block stand one after the other
in two arrays; one state vector holds each lane's A pointer, B pointer and the starts of its open group. A step
compares the two ends of all lanes at once: where they meet it emits a cut, which closes the group, and advances both; else it advances
the pointer of the smaller end. Finished lanes are compacted away. A long document gets several lanes, which start
at places where an A end was found among the B ends, so a step's vector stays long and the number of steps small;
without such a place it stays one lane. A group of p A tokens and q B tokens holds p * q links.

Blocks are filled with whole documents up to ``BLOCK_BYTES`` of text. A block gives each of its documents' different links once, as
places in the block's sorted list of different id pairs, and that list with the number of its documents that hold each pair. So
the corpus-wide counts are sums over blocks, made before and after one shuffle, and they come back as one
row per block and pair, however many documents or copies hold the pair; a cogroup by block then finishes its documents.

Defined cases: texts that are null or empty, or whose A or B bytes, joined, are not a space and the text (characters that the
model normalises, such as U+2581), have no tokens: zeros and an empty digest. Repeated rows count as documents of their
own; null keys stay null; other columns are ignored; an empty table gives no rows. A text of any length is one document of one block.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaria.llm.bpe import codec
from voltaria.session import stage

BLOCK_BYTES = 4 << 20
#: A tokens between two places at which a long document may be cut into lanes.
LANE_TOKENS = 192
_held: dict[tuple[str, str], Pair] = {}


class Pair:
    """The two tokenizers, their tokens' bytes and byte lengths, and the decimal ids with what follows them."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = codec(path_a).fast
        self.other = Tokenizer.from_file(path_a)
        self.other.encode_special_tokens = True
        self.other.no_truncation()
        self.other.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = codec(path_a).pieces
        self.pieces_a = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        self.pieces_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.sizes_a = np.array([len(p) for p in self.pieces_a], np.int64)
        self.sizes_b = np.array([len(p) for p in self.pieces_b], np.int64)
        self.n_b = len(self.pieces_b)
        numbers = max(len(self.pieces_a), self.n_b)
        # Four tables behind each other: an id before the next id, before the bar, before the next group, at the end.
        self.numbers = numbers
        self.decimals = np.array([f"{i}{mark}".encode() for mark in (",", "|", ";", "") for i in range(numbers)])

    def _piece(self, i: int) -> bytes:
        name = self.b.id_to_piece(i)
        return bytes([int(name[1:-1], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B by text; both empty where the tokens' bytes are not a space and the text."""
        none = np.zeros(0, np.int64)
        many = self.b.encode(texts, num_threads=1)
        for text, ids_b in zip(texts, many):
            whole = " " + text
            ids_a = self.a.encode_ordinary(whole) if text.isascii() or max(text) < "ɐ" else self.other.encode(whole, add_special_tokens=False).ids
            data = whole.encode()
            same = text and b"".join(map(self.pieces_a.__getitem__, ids_a)) == data and b"".join(map(self.pieces_b.__getitem__, ids_b)) == data
            yield (np.array(ids_a, np.int64), np.array(ids_b, np.int64)) if same else (none, none)


def pair(path_a: str, path_b: str) -> Pair:
    """The pair of two files, kept by the Python worker."""
    if (path_a, path_b) not in _held:
        _held[path_a, path_b] = Pair(path_a, path_b)
    return _held[path_a, path_b]


def lanes(ends_a: list[np.ndarray], ends_b: list[np.ndarray], width: int = LANE_TOKENS) -> np.ndarray:
    """``a, a_end, b, b_end`` (positions in the joined arrays) of each lane of documents with tokens."""
    out, a, b = [], 0, 0
    for ea, eb in zip(ends_a, ends_b):
        if len(ea):
            at = np.arange(width - 1, len(ea) - 1, width)
            to = np.searchsorted(eb, ea[at])
            met = eb[np.minimum(to, len(eb) - 1)] == ea[at]
            cut_a, cut_b = at[met] + 1, to[met] + 1
            out.append(np.stack([np.concatenate([[0], cut_a]) + a, np.concatenate([cut_a, [len(ea)]]) + a, np.concatenate([[0], cut_b]) + b, np.concatenate([cut_b, [len(eb)]]) + b]))
        a, b = a + len(ea), b + len(eb)
    return np.concatenate(out, axis=1) if out else np.zeros((4, 0), np.int64)


def merged(ends_a: np.ndarray, ends_b: np.ndarray, ways: np.ndarray) -> np.ndarray:
    """Groups ``a, a_end, b, b_end`` in order: all lanes walk in lockstep, one comparison a step."""
    a, last_a, b, last_b = ways
    from_a, from_b, groups = a.copy(), b.copy(), []
    while len(a):
        x, y = ends_a[a], ends_b[b]
        cut = x == y
        a, b = a + (x <= y), b + (y <= x)
        if cut.any():
            groups.append(np.stack([from_a[cut], a[cut], from_b[cut], b[cut]]))
            from_a, from_b = np.where(cut, a, from_a), np.where(cut, b, from_b)
            live = a < last_a
            if not live.all():
                a, last_a, b, last_b, from_a, from_b = (v[live] for v in (a, last_a, b, last_b, from_a, from_b))
    if not groups:
        return np.zeros((4, 0), np.int64)
    found = np.concatenate(groups, axis=1)
    return found[:, np.argsort(found[0], kind="stable")]


def links(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the A and B tokens of all links, group by group."""
    p, q = groups[1] - groups[0], groups[3] - groups[2]
    n = p * q
    group = np.repeat(np.arange(len(n)), n)
    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return groups[0][group] + within // q[group], groups[2][group] + within % q[group]


def written(tools: Pair, ids_a: np.ndarray, ids_b: np.ndarray, groups: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The decimal text of all tokens in order of groups, each with the mark that follows it, as fixed-width bytes.

    ``last`` tells the groups that end a document. The order is that of both arrays merged: an A token stands behind the B
    tokens of earlier groups, a B token behind the A tokens of its group and earlier ones.
    """
    p, q = groups[1] - groups[0], groups[3] - groups[2]
    codes = np.empty(len(ids_a) + len(ids_b), np.int64)
    mark_a, mark_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    mark_a[groups[1] - 1] = 1
    mark_b[groups[3] - 1] = np.where(last, 3, 2)
    codes[np.arange(len(ids_a)) + np.repeat(groups[2], p)] = ids_a + mark_a * tools.numbers
    codes[np.arange(len(ids_b)) + np.repeat(groups[1], q)] = ids_b + mark_b * tools.numbers
    return tools.decimals[codes]


def aligned(tools: Pair, texts: list[str], lane: int = LANE_TOKENS) -> dict[str, np.ndarray | list]:
    """The block's figures: per document ``n_a, n_b, n_groups, n_links, sha, starts`` (of its part of ``place, times``: its
    different links as places in ``pairs``, and how often), and per pair ``pairs, held`` (its number of documents)."""
    ids_a, ids_b, ends_a, ends_b = [], [], [], []
    for x, y in tools.encode(texts):
        ids_a.append(x)
        ids_b.append(y)
        ends_a.append(np.cumsum(tools.sizes_a[x]))
        ends_b.append(np.cumsum(tools.sizes_b[y]))
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
    all_a, all_b = (np.concatenate([*ids, np.zeros(0, np.int64)]) for ids in (ids_a, ids_b))
    groups = merged(np.concatenate([*ends_a, np.zeros(0, np.int64)]), np.concatenate([*ends_b, np.zeros(0, np.int64)]), lanes(ends_a, ends_b, lane))
    doc_of = np.repeat(np.arange(len(texts)), n_a)
    group_doc = doc_of[groups[0]]
    last = np.concatenate([group_doc[1:] != group_doc[:-1], np.ones(min(1, len(group_doc)), bool)])
    at_a, at_b = links(groups)
    link_doc = doc_of[at_a]
    pairs, place = np.unique(all_a[at_a] * tools.n_b + all_b[at_b], return_inverse=True)
    own, times = np.unique(link_doc * len(pairs) + place, return_counts=True)
    own_doc, own_place = np.divmod(own, max(1, len(pairs)))
    text = written(tools, all_a, all_b, groups, last)
    stops = np.cumsum(n_a + n_b)
    sha = [hashlib.sha256(text[e - n : e].tobytes().replace(b"\0", b"")).hexdigest() if n else "" for e, n in zip(stops.tolist(), (n_a + n_b).tolist())]
    count = lambda x: np.bincount(x, minlength=len(texts)).astype(np.int64)
    return {
        "n_a": n_a, "n_b": n_b, "n_groups": count(group_doc), "n_links": count(link_doc), "sha": sha,
        "starts": np.concatenate([[0], np.cumsum(count(own_doc))]), "place": own_place, "times": times, "pairs": pairs, "held": np.bincount(own_place, minlength=len(pairs)),
    }


_FIGURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_NAMES = ["block", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "place", "times", "pairs", "held"]


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", block: int = BLOCK_BYTES, lane: int = LANE_TOKENS) -> DataFrame:
    """One row per row: the key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    plain = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = plain.schema["key"].dataType.simpleString()

    def rows(keys: list, texts: list[str], key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        found = aligned(pair(path_a, path_b), texts, lane)
        n = len(texts)
        lists = lambda name, offsets, dtype, item: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found[name].astype(dtype), item))
        none = lambda m, item: pa.nulls(m, pa.list_(item))
        number = secrets.randbits(63)
        figures = [pa.array(found[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
        own = [lists("place", found["starts"], np.int32, pa.int32()), lists("times", found["starts"], np.int32, pa.int32())]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, number)), pa.array(keys, key_type), *figures, pa.array(found["sha"]), *own, none(n, pa.int64()), none(n, pa.int32())], _NAMES)
        if m := len(found["pairs"]):
            whole = [lists("pairs", [0, m], np.int64, pa.int64()), lists("held", [0, m], np.int32, pa.int32())]
            zeros = [pa.array([0], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.nulls(1, key_type), *zeros, pa.array([""]), none(1, pa.int32()), none(1, pa.int32()), *whole], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, texts, size, key_type = [], [], 0, None
        for batch in batches:
            key_type = batch.schema.field(0).type
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys.append(name)
                texts.append(value or "")
                size += len(texts[-1]) + 64
                if size >= block:
                    yield from rows(keys, texts, key_type)
                    keys, texts, size = [], [], 0
        if keys:
            yield from rows(keys, texts, key_type)

    lists = "place array<int>, times array<int>, pairs array<long>, held array<int>"
    staged = stage(plain.mapInArrow(run, f"block long, key {kind}, {_FIGURES}, {lists}"), "aligned")
    held = staged.where("pairs is not null").select("block", F.explode(F.arrays_zip("pairs", "held")).alias("p")).select("block", F.col("p.pairs").alias("pair"), F.col("p.held").alias("held"))
    counts = stage(held.groupBy("pair").agg(F.sum("held").alias("count")), "pairs")
    n_b = pair(path_a, path_b).n_b
    first = F.floor(F.col("pair") / n_b).alias("first")
    most = counts.groupBy(first).agg(F.max("count").alias("most"))
    known = counts.select("pair", "count", first).join(most, "first").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    back = held.select(F.col("block").alias("part"), "pair").join(known, "pair").select("part", "pair", "count", "best")

    def finish(own: pa.Table, known: pa.Table) -> pa.Table:
        order = np.argsort(known.column("pair").to_numpy())
        count, best = known.column("count").to_numpy()[order], known.column("best").to_numpy()[order]
        sums, bests = [], []
        for place, times in zip(own.column("place"), own.column("times")):
            at, n = place.values.to_numpy(), times.values.to_numpy().astype(np.int64)
            sums.append(int((count[at] * n).sum()))
            bests.append(int(n[best[at]].sum()))
        out = own.select(["key", "n_a", "n_b", "n_groups", "n_links"])
        out = out.append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))
        return out.append_column("groups_sha256", own.column("groups_sha256"))

    own = staged.where("pairs is null").select("block", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "place", "times")
    out = f"key {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return own.groupBy("block").cogroup(back.groupBy("part")).applyInArrow(finish, out).withColumnRenamed("key", key)
