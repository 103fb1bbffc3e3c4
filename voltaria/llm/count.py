"""Token counts of whole texts by overlap resynchronisation.

A text of more than ``chunk`` characters is cut into chunks that each also cover the first ``overlap`` characters of
the next one. Tasks encode chunks independently and note, within both overlaps, how many tokens precede each
stable boundary: a token start at a single space between two ASCII non-spaces, where every text splits whatever
surrounds it. Two neighbours are spliced at the first boundary that both found; where an overlap has none, the
document is taken again with overlaps twice as wide, at last as one chunk. Boundaries of which a special token's
string could still reach across the chunk's end are not used.

Defined cases: null and empty texts have 0 bytes and 0 tokens. Repeated rows are counted each. Other columns are
ignored.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaria.llm.bpe import Codec, codec
from voltaria.session import stage

CHUNK_CHARS, OVERLAP_CHARS = 32_768, 512
LIMIT = 1024


def stable(text: str, tool: Codec, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions of stable boundaries in a chunk's UTF-8, and the tokens before each."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    ends = np.concatenate([[0], np.cumsum(tool.spans(ids))]).astype(np.int64)
    inner = np.flatnonzero((ends > 0) & (ends < len(data) - max((len(t) for t in tool.special), default=0) - 1))
    at = ends[inner]
    solid = (data > 32) & (data < 127)
    ok = (data[at] == 32) & solid[at - 1] & solid[at + 1]
    return at[ok], inner[ok]


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """One row per row: the key, n_bytes, n_tokens and over_limit."""
    plain = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = plain.schema["key"].dataType.simpleString()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in batches:
            sizes, counts, uids, texts = [], [], [], []
            for value in batch.column(1):
                whole = value.as_py() or ""
                sizes.append(len(whole.encode()))
                short = len(whole) <= chunk
                counts.append(len(tool.encode(whole)) if short else None)
                uids.append(None if short else secrets.randbits(63))
                texts.append(None if short else whole)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array(uids, pa.int64()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_bytes", "n_tokens", "uid", "text"])

    base = stage(plain.mapInArrow(first, f"key {kind}, n_bytes long, n_tokens long, uid long, text string"), "counts")
    done = base.where("uid is null").select("key", "n_bytes", "n_tokens")
    todo, wide = base.where("uid is not null").select("key", "n_bytes", "uid", "text"), overlap
    while not todo.isEmpty():
        found = stage(_spliced(todo.select("uid", "text"), path, chunk, wide), "splices")
        whole = todo.drop("text").join(found.where("n_tokens is not null"), "uid").select("key", "n_bytes", "n_tokens")
        done = done.unionByName(whole)
        todo = todo.join(found.where("n_tokens is null").select("uid"), "uid", "left_semi")
        wide *= 2
    return done.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _spliced(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """``uid, n_tokens``; null where two neighbours share no stable boundary in their overlap."""
    n = F.greatest(F.lit(1), F.ceil((F.length("text") - overlap) / chunk)).cast("long")
    pieces = texts.select("uid", "text", n.alias("parts")).select("uid", "parts", "text", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))).alias("part"))
    begin = F.col("part") * chunk
    reach = F.when(F.col("part") == F.col("parts") - 1, F.length("text")).otherwise(F.lit(chunk + overlap))
    pieces = pieces.select("uid", "part", "parts", F.substring("text", begin + 1, reach).alias("piece")).repartition("uid", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                part, parts, piece = (batch.column(c)[i].as_py() for c in (1, 2, 3))
                ids = tool.encode(piece)
                at, before = stable(piece, tool, ids)
                left = len(piece[:overlap].encode())
                right = len(piece[:chunk].encode())
                a, b = at < left, at >= right
                if part == parts - 1:
                    b &= False
                if part == 0:
                    a &= False
                out.append((part, parts, len(ids), at[a].tolist(), before[a].tolist(), (at[b] - right).tolist(), before[b].tolist()))
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 4
            columns = [pa.array([o[c] for o in out], kinds[c]) for c in range(7)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["uid", "part", "parts", "total", "left_at", "left_n", "right_at", "right_n"])

    lists = "left_at array<long>, left_n array<long>, right_at array<long>, right_n array<long>"
    ends = stage(pieces.mapInArrow(run, f"uid long, part long, parts long, total long, {lists}"), "chunks")
    after = ends.where("part > 0").select("uid", (F.col("part") - 1).alias("part"), F.col("left_at").alias("next_at"), F.col("left_n").alias("next_n"))
    joints = ends.where("part < parts - 1").select("uid", "part", "right_at", "right_n").join(after, ["uid", "part"])
    common = F.array_min(F.array_intersect("right_at", "next_at"))
    joints = joints.withColumn("at", common).select(
        "uid",
        F.element_at("right_n", F.array_position("right_at", F.col("at")).cast("int")).alias("kept"),
        F.element_at("next_n", F.array_position("next_at", F.col("at")).cast("int")).alias("skipped"),
    )
    # Each chunk but the last gives what stands before its splice, each but the first loses what stands before its own.
    sums = joints.groupBy("uid").agg(F.when(F.count("kept") == F.count("*"), F.sum(F.col("kept") - F.col("skipped"))).alias("joined"), F.count("*").alias("n"))
    last = ends.where("part = parts - 1").select("uid", "parts", "total")
    return last.join(sums, "uid", "left").select(
        "uid", F.when(F.col("parts") == 1, F.col("total")).otherwise(F.col("total") + F.col("joined")).alias("n_tokens")
    )
