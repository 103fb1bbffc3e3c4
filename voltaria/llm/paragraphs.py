"""Substring dedup of repeated paragraphs and passages.

Paragraphs are lines of ``least`` words or more. MinHash values of their five-word shingles form bands; the number of bands
and of values per band is tuned so that a pair at the threshold meets with a chance of ``RECALL`` or more at the fewest
bands. Paragraphs that meet are verified on their exact shingle sets, linked into components (``linking``), and all but the
first paragraph of a component are removed.

A passage inside longer paragraphs is found on sentences (cut after ``.``, ``!``, ``?`` and at line ends) of ``GLUE`` words or
more: two neighbouring sentences that an earlier document holds as neighbours are repeated, and so is a single
sentence of ``least`` words. A run of repeated pairs of ``least`` words together is a passage to remove. The earlier document
is the one of the smaller row id, so of all holders of a passage exactly the first keeps it. Shorter sentences
take part in the run around them; where they follow each other, ``GLUE`` of them count as one.

Whatever its punctuation, a run of words is found on windows of ``least`` words: of any ``least`` consecutive windows of a text
the leftmost of least hash is a unit, so each run of ``2 * least - 1`` words holds one wherever it stands, and units of a
longer run leave no word out between them. What units an earlier document holds is repeated; the run is extended at both ends
word by word as far as the first holder of its outermost unit goes on alike. Shorter runs are found if they hold a unit.

Row ids are hashes of key and text. Defined cases: null and empty texts and texts of short lines have nothing to remove;
repeated rows of one key and text share a row id and are treated alike, the text is kept; null keys are allowed; a
text whose every unit goes becomes empty (``deduplicated`` then drops the row). Other columns are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltaria.llm import stream
from voltaria.llm.linking import link_sets
from voltaria.llm.text import mix, powers, signed, slices, window_hash, word_hashes
from voltaria.session import stage

LEAST_WORDS, GLUE, WIDTH, PERCENT, RECALL = 25, 4, 5, 80, 0.999
_BASE, _INVERSE = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(pow(0xC2B2AE3D27D4EB4F, -1, 1 << 64))
#: Marks in meta: a window of words, a long sentence, a band, a pair of sentences.
_WINDOW, _SENTENCE, _BAND, _PAIR = 0, 1, 2, 3
#: Bits that hold the place of a window beside its hash.
_PLACE_BITS = 28


def tuned(percent: int = PERCENT, recall: float = RECALL, noise: float = 0.4) -> tuple[int, int]:
    """Bands and values per band: the fewest bands of that recall at which pairs of ``noise`` likeness mostly miss."""
    share, best = percent / 100, None
    for rows in range(1, 9):
        bands = next(b for b in range(1, 10_000) if 1 - (1 - share**rows) ** b >= recall)
        if 1 - (1 - noise**rows) ** bands <= 0.5 and (best is None or bands < best[0]):
            best = (bands, rows)
    return best


class Units(NamedTuple):
    """Units of the texts of a slice: word ranges, hash, text number, and number within the text."""

    a: np.ndarray
    b: np.ndarray
    hash: np.ndarray
    text: np.ndarray
    index: np.ndarray


def _sequence(words: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(mix(words) * powers(_BASE, len(words)), out=total[1:])
    return mix((total[b] - total[a]) * powers(_INVERSE, len(words) + 1)[a] + (b - a).astype(np.uint64))


def _units(words: np.ndarray, breaks: np.ndarray, first: np.ndarray, least: int) -> Units:
    """Word runs between breaks (``breaks[i]``: one before word i) of ``least`` words or more."""
    a = np.flatnonzero(breaks)
    b = np.append(a[1:], len(words)) if len(a) else a
    long = b - a >= least
    a, b = a[long], b[long]
    text = np.searchsorted(first, a, side="right") - 1
    opens = np.searchsorted(text, np.arange(len(first)))
    return Units(a, b, _sequence(words, a, b), text, np.arange(len(a)) - opens[text])


def parsed(data: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Units, Units]:
    """Word hashes, word starts, word ends, paragraphs and sentences of a slice of texts."""
    words, starts, ends, first = word_hashes(data, offsets)
    if not len(words):
        none = np.zeros(0, dtype=np.int64)
        empty = Units(none, none, none.astype(np.uint64), none, none)
        return words, starts, ends, empty, empty
    lines = np.cumsum(data == 10)
    new_line = np.ones(len(words), dtype=bool)
    new_line[1:] = lines[starts[1:]] != lines[ends[:-1] - 1]
    new_line[first[:-1][first[:-1] < len(words)]] = True
    stop = data[ends - 1]
    after = np.zeros(len(words), dtype=bool)
    after[1:] = ((stop == 46) | (stop == 33) | (stop == 63))[:-1]
    return words, starts, ends, _units(words, new_line, first, least), _units(words, _gathered(new_line, new_line | after), first, GLUE)


def _gathered(new_line: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Sentence starts; of short sentences that follow each other within a line, ``GLUE`` make one."""
    starts = np.flatnonzero(breaks)
    short = np.diff(np.append(starts, len(breaks))) < GLUE
    follows = np.zeros(len(starts), dtype=bool)
    follows[1:] = short[1:] & short[:-1] & ~new_line[starts[1:]]
    at = np.arange(len(starts))
    number = at - np.maximum.accumulate(np.where(follows, 0, at))
    breaks = breaks.copy()
    breaks[starts[follows & (number % GLUE != 0)]] = False
    return breaks


def _windows(words: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the chosen windows of ``least`` words, and their texts."""
    n = len(words) - least + 1
    if n < least:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, low = np.arange(n), np.uint64((1 << _PLACE_BITS) - 1)
    chosen, step = (_sequence(words, at, at + least) & ~low) | at.astype(np.uint64), 1
    while step * 2 <= least:
        chosen = np.minimum(chosen[:-step], chosen[step:])
        step *= 2
    if step < least:
        chosen = np.minimum(chosen[: len(chosen) - (least - step)], chosen[least - step :])
    starts = np.arange(len(chosen))
    text = np.searchsorted(first, starts, side="right") - 1
    inside = starts + 2 * least - 1 <= first[text + 1]
    places = np.unique((chosen[inside] & low).astype(np.int64))
    return places, np.searchsorted(first, places, side="right") - 1


def _minhash(words: np.ndarray, units: Units, bands: int, rows: int) -> np.ndarray:
    """Band hashes of each paragraph: units x bands."""
    grams = window_hash(words, WIDTH)
    at, ends = units.a, units.b - WIDTH + 1
    cuts = np.stack([at, ends], axis=1).ravel()
    grams = np.append(grams, np.uint64(2**64 - 1))
    out = np.zeros((len(at), bands), dtype=np.uint64)
    for band in range(bands):
        value = np.full(len(at), band + 1, dtype=np.uint64)
        for row in range(rows):
            seed = mix(np.array([band * rows + row + 1], dtype=np.uint64))[0]
            value = mix(value * _BASE + np.minimum.reduceat((grams ^ seed) * (seed | np.uint64(1)), cuts)[::2])
        out[:, band] = value
    return out


def _emit(least: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            sign, item, meta, own = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [(np.zeros(0, np.int64),) * 3]
            for row, data, offsets in slices(batch.column(1)):
                words, starts, _, paragraphs, sentences = parsed(data, offsets, least)
                first = np.searchsorted(starts, offsets)
                places, texts = _windows(words, first, least)
                sign.append(signed(_sequence(words, places, places + least)))
                item.append(ids[row + texts])
                meta.append(_WINDOW + (places - first[texts] << 18))
                if len(paragraphs.a):
                    pid = (paragraphs.hash >> np.uint64(1)).astype(np.int64)
                    own.append((ids[row + paragraphs.text], pid, paragraphs.index))
                    at = np.sort(np.unique(pid, return_index=True)[1])  # in order of place, as reduceat wants them
                    new = pid[at]
                    chosen = Units(*(x[at] for x in paragraphs))
                    sign.append(signed(_minhash(words, chosen, bands, rows).ravel()))
                    item.append(np.repeat(new, bands))
                    meta.append(np.full(len(new) * bands, _BAND, np.int64))
                if len(sentences.a):
                    size = np.minimum(sentences.b - sentences.a, 255)
                    long = np.flatnonzero(sentences.b - sentences.a >= least)
                    sign.append(signed(sentences.hash[long]))
                    item.append(ids[row + sentences.text[long]])
                    meta.append(_SENTENCE + (size[long] << 2) + (sentences.index[long] << 18))
                    pair = np.flatnonzero(sentences.text[1:] == sentences.text[:-1])
                    sign.append(signed(mix(sentences.hash[pair] * _BASE + sentences.hash[pair + 1])))
                    item.append(ids[row + sentences.text[pair]])
                    meta.append(_PAIR + (size[pair] << 2) + (size[pair + 1] << 10) + (sentences.index[pair] << 18))
            yield stream.batch(*(np.concatenate(x) for x in (sign, item, meta)), tuple(np.concatenate(x) for x in zip(*own)))

    return run


def _sets(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, sizes, sets = [], [], []
            for row, data, offsets in slices(batch.column(0)):
                words, _, _, units, _ = parsed(data, offsets, least)
                grams = window_hash(words, WIDTH)
                for a, b, h in zip(units.a.tolist(), units.b.tolist(), units.hash.tolist()):
                    items.append(h >> 1)
                    sets.append(np.unique(signed(grams[a : b - WIDTH + 1])))
                    sizes.append(len(sets[-1]))
            cuts = pa.array(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32))
            values = pa.array(np.concatenate([np.zeros(0, np.int64), *sets]))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(cuts, values)], ["item", "size", "hashes"])

    return run


def row_id(key: str, text: str) -> Column:
    """The id that repeated rows share."""
    return F.xxhash64(F.col(key), F.col(text))


def repeated_units(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """Units to remove: ``row, kind`` (paragraph, passage or run), ``first`` and ``last`` (paragraph, sentence or word number), ``words``, ``keeper`` (row id)."""
    bands, rows = tuned(percent)
    plain = docs.select(row_id(key, text).alias("row"), F.col(text).alias("text"))
    kept = stage(stream.shared(plain.mapInArrow(_emit(least, bands, rows), stream.KIND)), "units")
    return stage(_paragraphs(plain, kept, least, percent).unionByName(_passages(kept, least)).unionByName(_runs(plain, kept, least)), "repeats")


def _paragraphs(plain: DataFrame, kept: DataFrame, least: int, percent: int) -> DataFrame:
    own = kept.where("forced").select(F.col("sign").alias("row"), F.col("item").alias("paragraph"), F.col("meta").alias("index"))
    buckets = stage(kept.where((F.col("meta") % 4 == _BAND) & ~F.col("forced")).select(F.col("sign").alias("bucket"), "item").distinct(), "bands")
    wanted = buckets.select(F.col("item").alias("paragraph")).distinct()
    holders = own.join(wanted, "paragraph", "left_semi").groupBy("paragraph").agg(F.min("row").alias("row")).select("row")
    sets = plain.join(holders, "row", "left_semi").select("text").mapInArrow(_sets(least), "item long, size long, hashes array<long>")
    sets = sets.join(wanted.withColumnRenamed("paragraph", "item"), "item", "left_semi").dropDuplicates(["item"])
    found = link_sets(buckets, stage(sets, "candidates"), percent)
    linked = own.join(found.select(F.col("node").alias("paragraph"), "component"), "paragraph", "left")
    linked = stage(linked.select("row", "index", F.coalesce("component", "paragraph").alias("component")), "linked")
    first = linked.groupBy("component").agg(F.min("row").alias("keeper"), F.count("*").alias("n")).where("n > 1")
    # The keeper's row keeps its first paragraph of the component; other rows keep none.
    mine = linked.join(first, "component").withColumn("at", F.min("index").over(Window.partitionBy("component", "row")))
    gone = mine.where("row <> keeper or index > at").distinct()
    return gone.select("row", F.lit("paragraph").alias("kind"), F.col("index").alias("first"), F.col("index").alias("last"), F.lit(None).cast("long").alias("words"), "keeper")


def _passages(kept: DataFrame, least: int) -> DataFrame:
    part = lambda shift: F.shiftright("meta", shift) % 256
    rows = kept.where((F.col("meta") % 4).isin(_SENTENCE, _PAIR) & ~F.col("forced")).select(
        "sign", F.col("item").alias("row"), (F.col("meta") % 4 == _PAIR).alias("pair"), part(2).alias("words"), part(10).alias("more"), F.shiftright("meta", 18).alias("index")
    )
    owners = rows.groupBy("sign").agg(F.min("row").alias("keeper"))
    later = rows.join(owners, "sign").where("row <> keeper").dropDuplicates(["row", "pair", "index"])
    island = F.when(F.col("pair"), F.col("index") - F.row_number().over(Window.partitionBy("row", "pair").orderBy("index"))).otherwise(F.col("index"))
    runs = later.withColumn("island", island).groupBy("row", "pair", "island").agg(
        F.min("index").alias("first"),
        (F.max("index") + F.when(F.col("pair"), 1).otherwise(0)).alias("last"),
        (F.sum("words") + F.max_by("more", "index")).alias("words"),
        F.min("keeper").alias("keeper"),
    )
    return runs.where(F.col("words") >= least).select("row", F.lit("passage").alias("kind"), "first", "last", "words", "keeper")


def _runs(plain: DataFrame, kept: DataFrame, least: int) -> DataFrame:
    """Runs of words that units of earlier documents cover, extended at both ends."""
    rows = kept.where((F.col("meta") % 4 == _WINDOW) & ~F.col("forced")).select("sign", F.col("item").alias("row"), F.shiftright("meta", 18).alias("at"))
    owners = rows.groupBy("sign").agg(F.min(F.struct(F.col("row").alias("keeper"), F.col("at").alias("place"))).alias("held"))
    later = rows.join(owners, "sign").where("row <> held.keeper").select("row", "at", "held").dropDuplicates(["row", "at"])
    turn = Window.partitionBy("row").orderBy("at")
    apart = later.withColumn("new", F.coalesce(F.col("at") - F.lag("at").over(turn) > least, F.lit(True)).cast("long"))
    islands = apart.withColumn("island", F.sum("new").over(turn)).groupBy("row", "island").agg(
        F.min("at").alias("first"), (F.max("at") + least).alias("end"), F.min_by("held", "at").alias("left"), F.max_by("held", "at").alias("right"), F.min("held.keeper").alias("keeper")
    )
    islands = stage(islands, "islands")
    sides = [
        islands.select("row", "island", F.lit(side).alias("side"), F.col("row").alias("r0"), F.col(own).alias("w0"), F.col(f"{held}.keeper").alias("r1"), (F.col(f"{held}.place") + more).alias("w1"))
        for side, own, held, more in ((0, "first", "left", 0), (1, "end", "right", least))
    ]
    edges = sides[0].unionByName(sides[1])
    asked = edges.select(F.col("r0").alias("row"), F.col("w0").alias("word"), "side").unionByName(edges.select(F.col("r1").alias("row"), F.col("w1").alias("word"), "side"))
    asked = stage(asked.distinct().groupBy("row").agg(F.collect_list(F.struct("word", "side")).alias("asked")), "edges")
    around = plain.join(asked, "row").select("row", "text", "asked").mapInArrow(_around(least), "row long, word long, side int, words array<long>")
    around = stage(around.dropDuplicates(["row", "word", "side"]), "around")
    for n in (0, 1):
        edges = edges.join(around.select(F.col("row").alias(f"r{n}"), F.col("word").alias(f"w{n}"), "side", F.col("words").alias(f"words{n}")), [f"r{n}", f"w{n}", "side"])
    alike = F.zip_with("words0", "words1", lambda x, y: F.coalesce(x == y, F.lit(False)))
    more = edges.select("row", "island", "side", F.when(F.array_position(alike, False) > 0, F.array_position(alike, False) - 1).otherwise(F.size("words0")).alias("more"))
    more = more.groupBy("row", "island").agg(F.sum(F.when(F.col("side") == 0, F.col("more"))).alias("before"), F.sum(F.when(F.col("side") == 1, F.col("more"))).alias("after"))
    found = islands.join(more, ["row", "island"]).select("row", (F.col("first") - F.col("before")).alias("first"), (F.col("end") + F.col("after") - 1).alias("last"), "keeper")
    return found.select("row", F.lit("run").alias("kind"), "first", "last", (F.col("last") - F.col("first") + 1).alias("words"), "keeper")


def _around(least: int):
    """Up to ``least`` word hashes before (side 0, the nearest first) or from (side 1) the asked words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column(0).to_numpy(), []
            for row, data, offsets in slices(batch.column(1)):
                words, _, _, first = word_hashes(data, offsets)
                words = signed(words)
                for i in range(len(offsets) - 1):
                    a, b = int(first[i]), int(first[i + 1])
                    for x in batch.column(2)[row + i].as_py():
                        at = a + x["word"]
                        near = words[max(a, at - least) : at][::-1] if x["side"] == 0 else words[at : min(b, at + least)]
                        out.append((ids[row + i], x["word"], x["side"], near))
            types = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], ["row", "word", "side", "words"])

    return run


def duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """Removed units with keys: ``key, kind, first, last, words, kept_in`` (smallest key of the rows that keep it)."""
    units = repeated_units(docs, key, text, least, percent)
    names = docs.select(row_id(key, text).alias("row"), F.col(key).alias("key"))
    keepers = names.groupBy(F.col("row").alias("keeper")).agg(F.min("key").alias("kept_in"))
    return units.join(names, "row").join(keepers, "keeper", "left").select(F.col("key").alias(key), "kind", "first", "last", "words", "kept_in")


def cleaned(text: str, paragraphs: list[int], passages: list[tuple[int, int]], least: int = LEAST_WORDS, words: list[tuple[int, int]] = ()) -> str:
    """A text without the given paragraphs, sentence runs and word runs; emptied lines go with them."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    _, starts, ends, units, sentences = parsed(raw, np.array([0, len(raw)]), least)
    keep = np.ones(len(raw), dtype=bool)
    for n in paragraphs:
        keep[starts[units.a[n]] : ends[units.b[n] - 1]] = False
    for a, b in passages:
        keep[starts[sentences.a[a]] : ends[sentences.b[b] - 1]] = False
    for a, b in words:
        keep[starts[a] : ends[b]] = False
    if keep.all():
        return text
    lines, before = [], text.split("\n")
    for old, new in zip(before, raw_lines(raw, keep)):
        if new == old or new.strip():
            lines.append(new if new == old else " ".join(new.split(" ")).strip(" "))
    return "\n".join(lines)


def raw_lines(raw: np.ndarray, keep: np.ndarray) -> list[str]:
    """The kept bytes of each line; line ends stay where they are."""
    keep = keep | (raw == 10)
    return raw[keep].tobytes().decode("utf-8", "replace").split("\n")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = "n_chars", least: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the repeated units; rows emptied by that go, ``length`` (if given) is counted anew."""
    units = repeated_units(docs, key, text, least, percent)
    gone = units.groupBy("row").agg(
        F.collect_list(F.when(F.col("kind") == "paragraph", F.col("first"))).alias("lines"),
        F.collect_list(F.when(F.col("kind") == "passage", F.struct("first", "last"))).alias("runs"),
        F.collect_list(F.when(F.col("kind") == "run", F.struct("first", "last"))).alias("words"),
    )
    fields = docs.columns
    wide = docs.select(row_id(key, text).alias("__row"), F.struct(*(F.col(f"`{c}`") for c in fields)).alias("doc"))
    wide = wide.join(gone.withColumnRenamed("row", "__row"), "__row", "left").select(f"doc.*", F.col("lines").alias("__lines"), F.col("runs").alias("__runs"), F.col("words").alias("__words"))
    position = fields.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, out, stay = list(batch.columns), [], []
            lines, runs, words = (batch.column(len(fields) + n) for n in range(3))
            for i, value in enumerate(batch.column(position)):
                whole, a = value.as_py(), lines[i].as_py() or []
                b, c = ([(r["first"], r["last"]) for r in x[i].as_py() or []] for x in (runs, words))
                new = cleaned(whole, a, b, least, c) if whole and (a or b or c) else whole
                out.append(new)
                stay.append(bool(new) or not (a or b or c))
            columns[position] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns[: len(fields)], fields).filter(pa.array(stay))

    result = wide.mapInArrow(run, docs.schema)
    return result.withColumn(length, F.length(text).cast(docs.schema[length].dataType)) if length in fields else result
