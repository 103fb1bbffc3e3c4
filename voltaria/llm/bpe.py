"""Byte-level BPE encoders inside tasks: ids as the tokenizers library gives them for a vocabulary file.

``Codec.encode`` returns the ids of a whole string. Where every character lies below U+0250 the same vocabulary
and pattern run in tiktoken, which is several times faster; other strings go to tokenizers itself. The two are
compared with each other in the tests. Strings of special tokens are found first, as the library's default has it.
"""

from __future__ import annotations

import json

import numpy as np

#: The pattern of the byte-level pre-tokenizer (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_held: dict[str, Codec] = {}


def _bytes_of() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable bytes stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Codec:
    """One vocabulary file, ready to encode and decode."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte = _bytes_of()
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.fast = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.pieces = {i: b for b, i in ranks.items()} | {i: t.encode() for t, i in self.special.items()}

    def encode(self, text: str) -> list[int]:
        """Ids of the whole text, special tokens recognised, none added."""
        if text.isascii() or max(text) < "ɐ":
            return self.fast.encode(text, allowed_special="all", disallowed_special=())
        return self.slow.encode(text, add_special_tokens=False).ids

    def decode(self, ids: list[int]) -> str:
        """As the library's ``decode(ids, skip_special_tokens=False)``."""
        return self.slow.decode(ids, skip_special_tokens=False)

    def spans(self, ids: list[int]) -> np.ndarray:
        """Byte length of each id."""
        pieces = self.pieces
        return np.fromiter((len(pieces[i]) for i in ids), dtype=np.int64, count=len(ids))


def codec(path: str) -> Codec:
    """The codec of a file, kept by the Python worker."""
    if path not in _held:
        _held[path] = Codec(path)
    return _held[path]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file; every executor has the same file."""
    import public_tokenizers

    return public_tokenizers.path(name)
