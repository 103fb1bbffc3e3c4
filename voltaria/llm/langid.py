"""Language identification by compression.

Each language gets a zstandard raw-content dictionary: excerpts of labelled documents, at most
``DICTIONARY_BYTES`` in all, taken from the documents of least hash of their id in each of ``SAMPLE_CELLS`` cells. That
bound on the labelled sample is the only limit; a prediction reads the whole text. Letters are lower-cased and what lies
between them becomes one space. The text is cut into blocks of ``BLOCK_BYTES`` (at a character), every block is compressed
with every dictionary, and the language of the smallest total wins (ties: the first in alphabetical order).
Equal blocks keep the margin independent of length; a block of fewer than ``SHORT_BYTES`` is repeated, as zstandard would
store it raw.

``score`` is ``1 / (1 + (best / other) ** SHARPNESS)`` for the smallest and second smallest total: 0.5 for a tie, near 1 for
a clear win. ``rejected`` is set where the margin ``1 - best / other`` is below ``margin``, and for ``und``.

Defined cases: null text and text without a letter give ``und``, score 0, rejected. One learned language wins with
score 1. No learned language gives ``und``. Null labels and labels of texts without letters teach nothing. Repeated rows are
predicted alike; only the text and label columns named by the caller are read; other columns pass through ``predict``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SAMPLE_CELLS = 256
DICTIONARY_BYTES = 96 << 10
BLOCK_BYTES = 2048
LEVEL, SEARCH_LOG, LEAST_MATCH = 6, 3, 4
SHORT_BYTES = 256
SHARPNESS = 20.0
MARGIN = 0.01


def learn(labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", cells: int = SAMPLE_CELLS, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Dictionary bytes per language from a bounded sample; the sampled rows are those of least id hash per cell."""
    rank = F.xxhash64(F.col(key).cast("string"))
    rows = labelled.where(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}"))
    rows = rows.select(F.col(label).cast("string").alias("label"), rank.alias("rank"), F.col(text).alias("text"))
    picked = rows.groupBy("label", F.pmod("rank", F.lit(cells)).alias("cell")).agg(F.min("rank").alias("rank")).select("label", "rank")
    excerpt = F.substring("text", 1, 2 * size // cells).alias("excerpt")
    sample = rows.join(picked, ["label", "rank"], "left_semi").groupBy("label", "rank").agg(F.min(excerpt).alias("excerpt"))
    out: dict[str, list[bytes]] = {}
    part = size // cells
    for row in sorted(sample.collect(), key=lambda r: (r["label"], r["rank"])):
        out.setdefault(row["label"], []).append(letters(row["excerpt"]).encode("utf-8", "replace")[: 2 * part])
    return {name: b" ".join(parts)[:size] for name, parts in sorted(out.items())}


def letters(text: str) -> str:
    """The text's letters in lower case, with one space for what lies between."""
    import regex

    return regex.sub(r"[^\p{L}]+", " ", text.lower())


def blocks(data: bytes, size: int = BLOCK_BYTES) -> Iterator[bytes]:
    """The text's bytes in pieces of about ``size``, cut between characters; the last piece takes a short rest."""
    start, n = 0, len(data)
    while n - start > size + size // 2:
        end = start + size
        while data[end] & 0xC0 == 0x80:
            end += 1
        yield data[start:end]
        start = end
    yield data[start:]


def totals(data: bytes, compressors: list) -> list[int]:
    """Compressed size of a text under each dictionary."""
    sums = [0] * len(compressors)
    for block in blocks(data):
        if len(block) < SHORT_BYTES:  # said again, so that it is stored compressed and not raw
            block *= 1 + SHORT_BYTES // max(1, len(block))
        for i, compressor in enumerate(compressors):
            sums[i] += len(compressor.compress(block))
    return sums


def judge(sums: list[int], names: list[str], margin: float) -> tuple[str, float, bool]:
    """Language, score and rejection for the sizes under each dictionary."""
    if not sums:
        return "und", 0.0, True
    if len(sums) == 1:
        return names[0], 1.0, False
    order = sorted(range(len(sums)), key=lambda i: (sums[i], i))
    ratio = sums[order[0]] / sums[order[1]]
    return names[order[0]], 1.0 / (1.0 + ratio**SHARPNESS), 1.0 - ratio < margin


def predict(docs: DataFrame, model: dict[str, bytes], text: str = "text", margin: float = MARGIN) -> DataFrame:
    """``docs`` with lang_pred, score and rejected; columns of these names in the input are replaced."""
    names = sorted(model)
    plain = docs.drop("lang_pred", "score", "rejected")
    position = plain.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        import zstandard

        letter = regex.compile(r"\p{L}")
        compressors = []
        for name in names:
            content = zstandard.ZstdCompressionDict(model[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            parameters = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, strategy=zstandard.STRATEGY_GREEDY, search_log=SEARCH_LOG, min_match=LEAST_MATCH, write_content_size=0, write_checksum=0, write_dict_id=0
            )
            content.precompute_compress(compression_params=parameters)
            compressors.append(zstandard.ZstdCompressor(dict_data=content, compression_params=parameters))
        for batch in batches:
            found = []
            for value in batch.column(position):
                whole = value.as_py()
                if not whole or not letter.search(whole):
                    found.append(("und", 0.0, True))
                else:
                    found.append(judge(totals(letters(whole).encode("utf-8", "replace"), compressors), names, margin))
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "lang_pred", "score", "rejected"])

    schema = StructType(list(plain.schema.fields)).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return plain.mapInArrow(run, schema)


def held_out(key: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", margin: float = MARGIN) -> DataFrame:
    """``key, held_out, lang_pred, score, rejected`` for every row, learned from the rows that are not held out."""
    model = learn(docs.where(~held_out(key)), key, text, label)
    rows = docs.select(F.col(key), held_out(key).alias("held_out"), F.col(text))
    return predict(rows, model, text, margin).drop(text)
