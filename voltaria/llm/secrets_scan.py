"""Secret scans by fixed patterns and by dictionary-primed zstandard novelty.

The base patterns are fixed: ``assign`` (a sensitive name, an assignment sign, a value), ``access`` (key ids by their
prefix) and ``hex`` (long runs of hexadecimal digits). Matches are leftmost and do not overlap within a kind; those that are too
short are dropped afterwards.

Novelty adds spans of kind ``novel``. A candidate is a run of ``LEAST_CHARS`` or more of the characters in which secrets are
written, in a sensitive context (a sensitive word within ``REACH`` characters before it), that no base span touches. Its
marginal bytes are ``|Z(before + candidate + after)| - |Z(before + after)|``, where Z is zstandard primed with a raw-content
dictionary of the corpus's identifiers and the text around it is taken ``AROUND`` characters wide. Names and words are found
in the dictionary or nearby and cost little; a candidate that costs ``THRESHOLD`` bytes a character or more is reported.

The dictionary holds the most frequent words of the whole corpus (3 to 15 letters between other characters than those of a
candidate; underscores part words), counted in Spark with sums before the shuffle, the most frequent last, at most
``DICTIONARY_WORDS`` of them: its size never follows the corpus. A secret copied a thousand times does not get in, nor a part of it.

Defined cases: null and empty texts have no spans (the digest is that of the empty string). Texts are read whole, whatever their
length. Repeated rows give the same row each, null keys stay null, other columns are ignored, and an empty table gives no
rows. Spans are ordered by start, then kind as listed (assign, access, hex, novel).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The kinds in order, their patterns, and the least length of the part that must be long enough.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

LEAST_CHARS, REACH, AROUND = 16, 48, 256
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
SENSITIVE = re.compile(r"(?ai)passw|pwd|secret|token|key|credential|auth|bearer|private|signature|salt|session|cookie")
#: Bytes a character. Of long words in the test corpus 99 % cost less than 0.7, of random strings 99 % more than 0.72.
THRESHOLD = 0.75
DICTIONARY_WORDS = 4096

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """``start, kind, end`` of the matches of the fixed patterns."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def sizes(identifiers: bytes) -> Callable[[str], int]:
    """Compressed size of a text under a dictionary."""
    import zstandard

    parameters = zstandard.ZstdCompressionParameters.from_level(9, write_content_size=0, write_checksum=0, write_dict_id=0)
    content = zstandard.ZstdCompressionDict(identifiers, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(identifiers) >= 8 else None
    if content:
        content.precompute_compress(compression_params=parameters)
    tool = zstandard.ZstdCompressor(dict_data=content, compression_params=parameters)
    return lambda text: len(tool.compress(text.encode("utf-8", "replace")))


def novelty(text: str, start: int, end: int, size: Callable[[str], int]) -> float:
    """Marginal compressed bytes a character of ``text[start:end]`` in the text around it."""
    before, after = text[max(0, start - AROUND) : start], text[end : end + AROUND]
    return (size(before + text[start:end] + after) - size(before + after)) / (end - start)


def novel_spans(text: str, base: list[Span], size: Callable[[str], int], threshold: float = THRESHOLD) -> list[Span]:
    """Spans of novel strings in a sensitive context that no base span touches."""
    found, at, reach = [], 0, -1  # base spans that start before a candidate's end reach as far as ``reach``
    for m in CANDIDATE.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][2])
            at += 1
        if reach > m.start() or not SENSITIVE.search(text, max(0, m.start() - REACH), m.start()):
            continue
        if novelty(text, m.start(), m.end(), size) >= threshold:
            found.append((m.start(), 3, m.end()))
    return found


def identifiers(docs: DataFrame, text: str = "text", words: int = DICTIONARY_WORDS) -> bytes:
    """Raw dictionary content: the corpus's most frequent words, the most frequent last."""
    word = F.explode(F.split(F.col(text), "[^A-Za-z0-9+/=-]+")).alias("word")
    counts = docs.select(word).where(F.length("word").between(3, 15) & F.col("word").rlike("^[A-Za-z]+$")).groupBy("word").agg(F.count("*").alias("n"))
    rows = counts.orderBy(F.desc("n"), "word").limit(words).collect()
    return " ".join(r.word for r in reversed(rows)).encode()


def written(spans: list[Span]) -> str:
    """``kind:start:end`` of spans, joined by commas."""
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row: the key, n_assign, n_access, n_hex, base_sha256, spans, and n_novel."""
    plain = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = plain.schema["key"].dataType.simpleString()
    content = identifiers(plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = sizes(content)
        for batch in batches:
            counts: list[list[int]] = [[], [], [], []]
            digests, spans = [], []
            for value in batch.column(1):
                whole = value.as_py() or ""
                base = base_spans(whole)
                every = sorted(base + novel_spans(whole, base, size, threshold))
                for k in range(4):
                    counts[k].append(sum(s[1] == k for s in every))
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                spans.append(written(every))
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts[:3]), pa.array(digests), pa.array(spans, pa.string()), pa.array(counts[3], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"])

    out = plain.mapInArrow(run, f"key {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long")
    return out.withColumnRenamed("key", key)
