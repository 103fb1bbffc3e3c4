"""Benchmark decontamination by greedy string tiling.

Words are runs of ASCII letters and digits or non-ASCII characters, A-Z lowered. A seed is a window of ``seed`` words of
a benchmark item (the whole item where it is shorter). Documents meet items on shared seeds; within the runs
of words that a document shares with an item through seeds, the longest non-overlapping matches are marked again and
again, found by running Karp-Rabin hashes of shrinking length. The item's share of marked words is its coverage, so
passages count whatever their order, and one document word covers one item word only. Pairs of coverage ``threshold`` or
more are contaminated.

The seeds travel as a broadcast only while their counted bytes stay within ``broadcast_bytes``; beyond that the same
seeds are joined by Spark, documents giving their distinct seed hashes. A document that covers enough of an item shares
``threshold * words / seed`` of its seed positions or more; so each item leaves out as many of its commonest seeds, less one, and a
phrase found in many documents and items does not pair them all.

Defined cases: null, empty and wordless texts on either side match nothing; an item repeated in the benchmark
gives a pair per row; a repeated document row gives its pairs each time; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltaria.llm.text import alphanumeric, signed, slices, window_hash, word_hashes
from voltaria.session import stage

SEED_WORDS, THRESHOLD = 4, 0.6
BROADCAST_BYTES = 32 << 20
_LONGEST_FIRST = 32
_MOD, _BASE = (1 << 61) - 1, 1_000_003


def texts_as_words(column: pa.Array) -> Iterator[np.ndarray]:
    """Word hashes of each text."""
    for _, data, offsets in slices(column):
        words, _, _, first = word_hashes(data, offsets, alphanumeric(data))
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            yield words[a:b]


def seeds_of(words: np.ndarray, seed: int) -> np.ndarray:
    """Seed hashes at each position; one for a text of fewer words."""
    if not len(words):
        return words
    return window_hash(words, min(seed, len(words)))


def _rolling(words: list[int], open_: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """Position and Karp-Rabin hash of every window of ``length`` unmarked words."""
    top, value, run = pow(_BASE, length - 1, _MOD), 0, 0
    for i, word in enumerate(words):
        if not open_[i]:
            value = run = 0
            continue
        if run == length:
            value = (value - words[i - length] * top) % _MOD
            run -= 1
        value = (value * _BASE + word) % _MOD
        run += 1
        if run == length:
            yield i - length + 1, value


def tiles(item: list[int], text: list[int], least: int) -> list[tuple[int, int, int]]:
    """Longest matches first: item position, text position and length of each tile of ``least`` words or more.

    Of equal matches the first in the item goes first, then the first in the text. A pass keeps one match per item position, the
    longest, and marks them in that order until one is cut short by another; then it looks again. So it holds one match per
    item word, however often a word repeats, and a position that has all it can get is not compared further.
    """
    free_item, free_text, found = [True] * len(item), [True] * len(text), []
    length = max(least, min(len(item), _LONGEST_FIRST))
    while True:
        ends = _ends(free_item)
        table: dict[int, list[int]] = {}
        for at, value in _rolling(item, free_item, length):
            table.setdefault(value, []).append(at)
        best: dict[int, tuple[int, int]] = {}
        before: dict[int, int] = {}
        last = -1
        for at, value in _rolling(text, free_text, length) if table else ():
            starts = table.get(value)
            if starts is None:
                continue
            reach: dict[int, int] = {}
            for start in tuple(starts):
                # One word further along the match of the position before it: no need to compare again.
                n = before.get(start - 1, 0) - 1 if last == at - 1 else 0
                if n < length:
                    n = 0
                    while start + n < ends[start] and at + n < len(text) and free_text[at + n] and item[start + n] == text[at + n]:
                        n += 1
                reach[start] = n
                if n >= length and n > best.get(start, (0, 0))[0]:
                    best[start] = (n, at)
                    if start + n == ends[start]:
                        starts.remove(start)
                        if not starts:
                            del table[value]
            before, last = reach, at
            if not table:
                break
        for start, (n, at) in sorted(best.items(), key=lambda b: (-b[1][0], b[0])):
            if not all(free_item[start : start + n]) or not all(free_text[at : at + n]):
                break  # what is left of it, or another copy, may still be longer than the next
            found.append((start, at, n))
            free_item[start : start + n] = [False] * n
            free_text[at : at + n] = [False] * n
        if best:
            continue
        if length == least:
            return found
        length = max(least, length // 2)


def _ends(open_: list[bool]) -> list[int]:
    """For each position the end of the run of unmarked words that it lies in."""
    ends, end = [0] * len(open_), len(open_)
    for i in range(len(open_) - 1, -1, -1):
        if not open_[i]:
            end = i
        ends[i] = end
    return ends


def _inside(hit: np.ndarray, words: int, least: int) -> np.ndarray:
    """Positions of the words that lie in a window marked in ``hit``."""
    inside = np.zeros(words, dtype=bool)
    for shift in range(least):
        inside[shift : shift + len(hit)] |= hit
    return np.flatnonzero(inside)


def coverage(item: np.ndarray, text: np.ndarray, seed: int, threshold: float = 0.0) -> tuple[int, int]:
    """Words of the item that tiles cover, and the number of tiles; only what lies in shared seeds is compared.

    Tiles lie within shared seeds, so an item whose shared seeds hold less than ``threshold`` of its words is not tiled: 0, 0.
    """
    least = min(seed, len(item))
    if not least or len(text) < least:
        return 0, 0
    own, other = window_hash(item, least), window_hash(text, least)
    bound = len(_inside(np.isin(own, other), len(item), least))
    if not bound or bound < threshold * len(item):
        return 0, 0
    at = _inside(np.isin(other, own), len(text), least)
    cut = np.flatnonzero(np.diff(at) > 1) + 1
    parts: list[int] = []
    for n, run in enumerate(np.split(text[at] >> np.uint64(3), cut)):
        parts += ([-1 - n] if n else []) + run.tolist()
    made = tiles((item >> np.uint64(3)).tolist(), parts, least)
    return sum(n for _, _, n in made), len(made)


class Index:
    """Item words and their seeds, in arrays that a task can search."""

    def __init__(self, items: list[np.ndarray], seed: int):
        self.items, self.seed = items, seed
        hashes = [np.unique(seeds_of(words, seed)) for words in items]
        flat = np.concatenate([np.zeros(0, np.uint64), *hashes])
        owner = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
        order = np.argsort(flat, kind="stable")
        self.hashes, self.owner = flat[order], owner[order]
        self.short = sorted({len(w) for w in items if 0 < len(w) < seed})
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[(flat >> np.uint64(44)).astype(np.int64)] = True

    def candidates(self, text: np.ndarray) -> list[int]:
        """Items that share a seed with a text."""
        found: set[int] = set()
        for width in (*self.short, self.seed):
            grams = window_hash(text, width)
            grams = grams[self.bits[(grams >> np.uint64(44)).astype(np.int64)]]
            if len(grams):
                grams = np.unique(grams)
                low, high = np.searchsorted(self.hashes, grams, "left"), np.searchsorted(self.hashes, grams, "right")
                for a, b in zip(low.tolist(), high.tolist()):
                    found.update(self.owner[a:b].tolist())
        return sorted(found)


_PAIR = "item_words long, covered_words long, tiles long, coverage double"


def _rows(keys: pa.Array, picked: list[int], items: pa.Array, values: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = [pa.array([v[c] for v in values], pa.int64()) for c in range(3)]
    share = pa.array([v[1] / v[0] for v in values], pa.float64())
    return pa.RecordBatch.from_arrays([keys.take(pa.array(picked, pa.int64())), items, *columns, share], ["key", "item", "item_words", "covered_words", "tiles", "coverage"])


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    seed: int = SEED_WORDS,
    threshold: float = THRESHOLD,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Pairs ``key, item_key, item_words, covered_words, tiles, coverage`` of coverage ``threshold`` or more."""
    plain = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    items = benchmark.select(F.col(item_key).alias("item"), F.col(item_text).alias("item_text"))
    key_kind, item_kind = plain.schema["key"].dataType.simpleString(), items.schema["item"].dataType.simpleString()
    kind = f"key {key_kind}, item {item_kind}, {_PAIR}"
    # A word of text takes a hash and a seed of 16 bytes or less; a word and its space take two bytes at least.
    size = items.agg(F.sum(F.octet_length("item_text") + 16) * 16).first()[0] or 0
    found = _broadcast(plain, items, kind, seed, threshold) if size <= broadcast_bytes else _joined(plain, items, kind, seed, threshold)
    return found.select(F.col("key").alias(key), F.col("item").alias(item_key), "item_words", "covered_words", "tiles", "coverage")


def _broadcast(plain: DataFrame, items: DataFrame, kind: str, seed: int, threshold: float) -> DataFrame:
    table = items.toArrow()
    held = plain.sparkSession.sparkContext.broadcast((table.column(0).combine_chunks(), table.column(1).combine_chunks()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, item_texts = held.value
        index = Index(list(texts_as_words(item_texts)), seed)
        for batch in batches:
            picked, owners, values = [], [], []
            for i, words in enumerate(texts_as_words(batch.column(1))):
                for n in index.candidates(words):
                    covered, made = coverage(index.items[n], words, seed, threshold)
                    if covered >= threshold * len(index.items[n]):
                        picked.append(i)
                        owners.append(n)
                        values.append((len(index.items[n]), covered, made))
            yield _rows(batch.column(0), picked, names.take(pa.array(owners, pa.int64())), values)

    return plain.mapInArrow(run, kind)


def _joined(plain: DataFrame, items: DataFrame, kind: str, seed: int, threshold: float) -> DataFrame:
    def of_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hashes = [np.zeros(0, int)], [np.zeros(0, np.uint64)]
            for i, words in enumerate(texts_as_words(batch.column(1))):
                unique = np.unique(np.concatenate([window_hash(words, w) for w in widths]))
                rows.append(np.full(len(unique), i))
                hashes.append(unique)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.concatenate(rows))), pa.array(signed(np.concatenate(hashes)))], ["id", "seed"])

    def of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hashes, places, sizes = [np.zeros(0, int)], [np.zeros(0, np.uint64)], [np.zeros(0, int)], [np.zeros(0, int)]
            for i, words in enumerate(texts_as_words(batch.column(1))):
                unique, counts = np.unique(seeds_of(words, seed), return_counts=True)
                rows.append(np.full(len(unique), i))
                hashes.append(unique)
                places.append(counts)
                sizes.append(np.full(len(unique), len(words)))
            at = pa.array(np.concatenate(rows))
            columns = [batch.column(0).take(at), pa.array(signed(np.concatenate(hashes))), *[pa.array(np.concatenate(c).astype(np.int64)) for c in (places, sizes)]]
            yield pa.RecordBatch.from_arrays(columns, ["item_row", "seed", "places", "words"])

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picked, values = [], []
            for i, (words, item) in enumerate(zip(texts_as_words(batch.column(1)), texts_as_words(batch.column(3)))):
                covered, made = coverage(item, words, seed, threshold)
                if len(item) and covered >= threshold * len(item):
                    picked.append(i)
                    values.append((len(item), covered, made))
            yield _rows(batch.column(0), picked, batch.column(2).take(pa.array(picked, pa.int64())), values)

    names = items.withColumn("id", F.xxhash64("item", "item_text"))
    rows = plain.withColumn("id", F.xxhash64("key", "text"))
    item_seeds = stage(names.select("id", "item_text").mapInArrow(of_items, "item_row long, seed long, places long, words long").distinct(), "seeds")
    # At most ``seed`` numbers.
    widths = sorted(r[0] for r in item_seeds.select(F.least("words", F.lit(seed))).distinct().collect())
    if not widths:
        return plain.sparkSession.createDataFrame([], kind)
    doc_seeds = rows.select("id", "text").mapInArrow(of_documents, "id long, seed long")
    met = stage(doc_seeds.join(item_seeds.select("seed").distinct(), "seed", "left_semi").distinct(), "met")
    often = met.groupBy("seed").agg(F.count("*").alias("n"))
    upto = F.sum("places").over(Window.partitionBy("item_row").orderBy(F.desc("n"), "seed").rowsBetween(Window.unboundedPreceding, 0))
    needed = F.ceil(F.col("words") * F.lit(threshold) / F.least("words", F.lit(seed)) - 1e-9)
    telling = item_seeds.join(often, "seed").withColumn("upto", upto).where(F.col("upto") >= needed)
    pairs = stage(met.join(telling.select("seed", "item_row"), "seed").select("id", "item_row").distinct(), "pairs")
    names = names.select(F.col("id").alias("item_row"), "item", "item_text").withColumn("n", F.lit(1))
    wide = pairs.join(rows, "id").join(names, "item_row").select("key", "text", "item", "item_text")
    return wide.mapInArrow(tile, kind)
