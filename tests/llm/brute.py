"""Plain versions of the operators for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

NAMES = ("key", "row", "sign", "item", "bucket", "slot", "uid", "label", "host", "text_crc32", "lang_pred", "block")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)


def table(spark, texts, ids=None, langs=None):
    """A documents table with extra columns whose names the operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    langs = langs or [None] * len(texts)
    rows = [(i, t, g, None, None if t is None else len(t), *("x" for _ in NAMES)) for i, t, g in zip(ids, texts, langs)]
    return spark.createDataFrame(rows, SCHEMA)


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())


def components(rows, percent=80):
    sets, root = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and shared * 100 >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def repeated(rows, window):
    count = Counter(b[k : k + window] for _, t in rows for b in [(t or "").encode()] for k in range(len(b) - window + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - window + 1):
            if count[b[k : k + window]] > 1:
                gone[k : k + window] = [True] * window
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)
