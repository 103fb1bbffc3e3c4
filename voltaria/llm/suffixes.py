"""Suffix-array dedup: bytes covered by a string of ``WINDOW`` bytes that also starts elsewhere.

A full suffix array sends some ``WINDOW`` bytes per byte of text. Here it is sparse: each window of the text picks an anchor,
the leftmost least of the hashes of its strings of ``ANCHOR`` bytes, so equal windows pick equal anchors at equal offsets.
Consecutive windows of one anchor form a run; only runs whose anchor string occurs twice can hold a repeat. The
suffixes that start at such runs, cut where their last window ends, are sorted in each task into front-coded runs, dealt
by hash and merged with a loser tree that never compares known prefixes again (``runs``). A string that two or more
places hold is repeated with all its windows. For a run whose string is unique although its anchor is not, the
windows it shares in part are found among all distinct strings of that anchor by 64-bit window hashes.

Texts that occur more than once as a whole are repeated throughout; one of them stands for all in the sort.

Defined cases: null counts as empty; texts of fewer bytes than a window keep all; repeated rows are copies of each
other; equal keys may have different texts; other columns are ignored; matches never cross texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaria.llm import stream
from voltaria.llm.runs import coded, decoded, merged
from voltaria.llm.text import prefix_hash, signed, slices, span_hash
from voltaria.session import stage

WINDOW, ANCHOR = 200, 100
#: Window starts handled at once, and the bits that hold a position beside its hash.
_REGION, _POSITION_BITS = 8 << 20, 24
_RUN_BYTES, _BUCKET_ROWS = 32 << 20, 40_000


def anchors(data: np.ndarray, offsets: np.ndarray, window: int, anchor: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows: text number, first window within its text, anchor less first window, windows, anchor hash."""
    for begin in range(0, len(data), _REGION):
        part = data[begin : begin + _REGION + window - 1]
        if len(part) < window:
            return
        n, width = len(part) - window + 1, window - anchor + 1
        prefix = prefix_hash(part)
        at = np.arange(len(part) - anchor + 1)
        hashes = span_hash(prefix, at, at + anchor)
        low = np.uint64((1 << _POSITION_BITS) - 1)
        least, step = (hashes & ~low) | at.astype(np.uint64), 1
        while step * 2 <= width:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if step < width:
            least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
        chosen = (least[:n] & low).astype(np.int64)
        starts = np.arange(n)
        text = np.searchsorted(offsets, begin + starts, side="right") - 1
        inside = begin + starts + window <= offsets[text + 1]
        new = np.ones(n, dtype=bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
        new |= ~inside
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, n))
        ok = inside[first]
        first, size = first[ok], size[ok]
        # windows that leave their text end a run
        yield text[first], begin + first - offsets[text[first]], chosen[first] - first, size, hashes[chosen[first]]


def _anchor_rows(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            none = np.zeros(0, np.int64)
            sign, item, meta = [none], [none], [none]
            for row, data, offsets in slices(batch.column(1)):
                for text, first, lead, size, value in anchors(data, offsets, window, anchor):
                    sign.append(signed(value))
                    item.append(ids[row + text] + first)
                    meta.append((first << 16) + (lead << 8) + size)
            yield stream.batch(*(np.concatenate(x) for x in (sign, item, meta)), (none, none, none))

    return run


_RUN = "bucket long, prefix binary, rest binary, blob binary, held binary, refs binary"


def _sorted_runs(window: int, buckets: int):
    """Front-coded runs of the suffixes at repeated anchors, one row per run and bucket."""

    def flush(pieces: dict[bytes, list[tuple]]) -> pa.RecordBatch:
        dealt: dict[int, list[bytes]] = {}
        for string in pieces:
            dealt.setdefault(int.from_bytes(hashlib.blake2b(string, digest_size=6).digest(), "little") % buckets, []).append(string)
        rows = []
        for bucket, strings in dealt.items():
            strings.sort()
            refs = [pieces[s] for s in strings]
            held = np.array([len(r) for r in refs], "<u4").tobytes()
            rows.append((bucket, *coded(strings), held, np.array([x for r in refs for x in r], "<i8").tobytes()))
        columns = [pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[c] for r in rows], pa.binary()) for c in range(1, 6))]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "prefix", "rest", "blob", "held", "refs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[bytes, list[tuple]] = {}
        size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                row, passive, raw = batch.column(0)[i].as_py(), batch.column(2)[i].as_py(), batch.column(1)[i].as_py().encode()
                for found in batch.column(3)[i].as_py():
                    meta = found["meta"]
                    first, lead, windows = meta >> 16, (meta >> 8) & 255, meta & 255
                    string = raw[first : first + windows + window - 1]
                    pieces.setdefault(string, []).append((row, first, found["sign"], lead, int(passive)))
                    size += len(string) + 96
                if size > _RUN_BYTES:
                    yield flush(pieces)
                    pieces, size = {}, 0
        if pieces:
            yield flush(pieces)

    return run


_PIECE = [("row", pa.int64()), ("first", pa.int64()), ("sign", pa.int64()), ("lead", pa.int64()), ("passive", pa.int64()), ("windows", pa.int64()), ("held", pa.int64()), ("string", pa.binary())]
_PIECE_KIND = "row long, first long, sign long, lead long, passive long, windows long, held long, string binary"


def _merge(window: int):
    def run(table: pa.Table) -> pa.Table:
        parts = [table.column(c).to_pylist() for c in ("prefix", "rest", "blob", "held", "refs")]
        held = [np.frombuffer(x, "<u4").tolist() for x in parts[3]]
        refs = [np.frombuffer(x, "<i8").reshape(-1, 5) for x in parts[4]]
        seen = [[0, 0] for _ in held]  # strings and references taken from each run
        out: list[tuple] = []
        group: list[np.ndarray] = []
        last: bytes | None = None

        def close() -> None:
            if last is None:
                return
            rows = np.concatenate(group)
            for n, ref in enumerate(rows.tolist()):
                out.append((*ref, len(last) - window + 1, len(rows), last if n == 0 else None))

        for k, shared, string in merged([decoded(p, r, b) for p, r, b in zip(*parts[:3])]):
            if last is None or shared != len(string) or shared != len(last):
                close()
                group, last = [], string
            number, at = seen[k]
            group.append(refs[k][at : at + held[k][number]])
            seen[k] = [number + 1, at + held[k][number]]
        close()
        return pa.table({name: pa.array([o[c] for o in out], kind) for c, (name, kind) in enumerate(_PIECE)})

    return run


def _window_rows(window: int):
    """A hash of each window of the given strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        for batch in batches:
            row, first, passive = (batch.column(c).to_numpy() for c in range(3))
            for begin in range(0, batch.num_rows, 4096):
                strings = batch.column(3).slice(begin, 4096).to_pylist()
                sizes = np.array([len(s) for s in strings])
                data = np.frombuffer(b"".join(strings), dtype=np.uint8)
                opens = np.cumsum(sizes) - sizes
                counts = sizes - window + 1
                owner = np.repeat(np.arange(len(strings)), counts)
                within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
                at = opens[owner] + within
                sign = signed(span_hash(prefix_hash(data), at, at + window))
                position = first[begin + owner] + within
                yield stream.batch(sign, row[begin + owner] + position, position * 2 + passive[begin + owner], (none, none, none))

    return run


def _removed(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                raw = np.frombuffer(batch.column(1)[i].as_py().encode(), dtype=np.uint8)
                spans = np.array([(s["first"], s["windows"]) for s in batch.column(2)[i].as_py()], dtype=np.int64).reshape(-1, 2)
                change = np.zeros(len(raw) + 1, dtype=np.int64)
                np.add.at(change, spans[:, 0], 1)
                np.add.at(change, spans[:, 0] + spans[:, 1] - 1 + window, -1)
                gone = np.cumsum(change)[:-1] > 0
                opens = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and gone[0])
                out.append((int(gone.sum()), opens, hashlib.sha256(raw[~gone].tobytes()).hexdigest()))
            columns = [pa.array([o[c] for o in out], kind) for c, kind in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["row", "n_removed", "n_spans", "kept_sha256"])

    return run


def repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int | None = None) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256`` for every row."""
    anchor = anchor or max(1, window // 2)
    body = F.coalesce(F.col(text), F.lit(""))
    plain = docs.select(F.xxhash64(F.col(key), F.col(text)).alias("row"), body.alias("text"))
    whole = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(key), F.col(text)).alias("row"), F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body.cast("binary"), 256).alias("sha"))
    whole = stage(whole, "texts")
    classes = whole.where(F.col("n_bytes") >= window).groupBy("sha").agg(F.count("*").alias("n"), F.min("row").alias("first_row")).where("n > 1")
    copies = stage(whole.join(classes, "sha").select("row", (F.col("row") == F.col("first_row")).alias("stands")).distinct(), "copies")

    found = stage(stream.shared(plain.mapInArrow(_anchor_rows(window, anchor), stream.KIND), distinct=False), "anchors")
    starts = found.select((F.col("item") - F.shiftright("meta", 16)).alias("row"), "sign", "meta")
    lists = starts.groupBy("row").agg(F.collect_set(F.struct("meta", "sign")).alias("found"))
    lists = lists.join(copies, "row", "left").where("stands is null or stands")
    lists = lists.select("row", F.col("stands").isNotNull().alias("passive"), "found")
    texts = stage(plain.join(lists, "row").select("row", "text", "passive", "found"), "repeating")

    buckets = 1 + found.count() // _BUCKET_ROWS
    sorted_ = texts.mapInArrow(_sorted_runs(window, buckets), _RUN)
    pieces = stage(sorted_.groupBy("bucket").applyInArrow(_merge(window), _PIECE_KIND), "suffixes")
    whole_runs = pieces.where("held > 1 and passive = 0").select("row", "first", "windows")
    strings = pieces.where("string is not null")
    partial = strings.groupBy("sign").agg(F.count("*").alias("n"), F.min(F.when(F.col("passive") == 0, F.col("held"))).alias("least")).where("n > 1 and least = 1")
    parts = strings.join(partial.select("sign"), "sign", "left_semi").select("row", "first", F.when((F.col("held") > 1) | (F.col("passive") == 1), 1).otherwise(0).cast("long").alias("passive"), "string")
    windows = stream.shared(parts.mapInArrow(_window_rows(window), stream.KIND), distinct=False)
    position = F.shiftright("meta", 1)
    windows = windows.where("meta % 2 = 0").select((F.col("item") - position).alias("row"), position.alias("first"), F.lit(1).cast("long").alias("windows"))
    spans = whole_runs.unionByName(windows).groupBy("row").agg(F.collect_list(F.struct("first", "windows")).alias("spans"))
    active = texts.where("not passive").select("row", "text").dropDuplicates(["row"])
    cut = active.join(spans, "row").mapInArrow(_removed(window), "row long, n_removed long, n_spans long, kept_sha256 string")
    gone = copies.select("row", F.lit(True).alias("copy"))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    result = whole.join(stage(cut, "cut"), "row", "left").join(gone, "row", "left")
    copied = F.col("copy").isNotNull()
    return result.select(
        F.col("key").alias(key),
        "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, empty).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
