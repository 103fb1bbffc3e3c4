"""Whitening, secret scans and token alignment against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from brute import table
from voltaria.llm import align, secrets_scan, whiten
from voltaria.llm.bpe import vocabulary


def plain_whitening(vectors, top=16):
    """n, deviations, whitened values and shares of vectors (rows of equal length) by a dense eigenvalue routine."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    c = (n * fit - sums) / n
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:top], q[:, ::-1][:, :top]
    keep = e > 1e-12 * np.trace(v)
    apart = n * x - sums
    return n, [sum(int(t) ** 2 for t in row) for row in apart], (apart / n) @ (q[:, keep] / np.sqrt(e[keep])), (e / np.trace(v))[keep]


def whitened(spark, rows, **more):
    frame = spark.createDataFrame([(i, v, "x", 0.5) for i, v in rows], "vec_id long, embedding array<float>, key string, component double")
    return whiten.whiten(frame.repartition(3), **more)


def check_whitening(spark, rows, vectors, **more):
    found = defaultdict(list)
    for r in sorted(whitened(spark, rows, **more).collect(), key=lambda r: (r.vec_id, r.component)):
        found[r.vec_id].append(r)
    n, deviations, values, shares = plain_whitening([v for _, v in vectors])
    assert sorted(found) == sorted(i for i, _ in vectors)
    got = np.array([[r.whitened for r in found[i]] for i, _ in vectors])
    signs = np.sign((got * values).sum(axis=0))
    assert got.shape == values.shape and np.abs(got * signs - values).max() < 1e-8
    for (i, _), deviation in zip(vectors, deviations):
        for k, r in enumerate(found[i]):
            assert (r.n, r.deviation, r.component) == (n, deviation, k + 1)
            assert r.explained == pytest.approx(shares[k], rel=1e-9) and r.identity_error < 1e-9


def test_whitening_equals_a_dense_routine(spark, monkeypatch):
    r = np.random.default_rng(5)
    mix = r.standard_normal((48, 48)) * np.linspace(3, 0.4, 48)
    vectors = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(r.standard_normal((600, 48)) @ mix)]
    vectors += [(1000 + i, vectors[7][1]) for i in range(200)]
    odd = [(9000, None), (9001, [1.0] * 47 + [None]), (9002, [float("nan")] * 48), (9003, [float("-inf")] + [0.0] * 47), (9004, [1.0]), (9005, []), (9006, [3e38] * 48)]
    check_whitening(spark, vectors + odd, vectors)
    monkeypatch.setattr(whiten, "SMALL_PART", 500)
    monkeypatch.setattr(whiten, "FAN", 3)
    check_whitening(spark, vectors + odd, vectors)


def test_whitening_of_few_equal_and_no_vectors(spark):
    few = [(i, [float(i == j) * (j + 1) for j in range(20)]) for i in range(5)]
    check_whitening(spark, few, few)
    assert whitened(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]).count() == 0
    assert whitened(spark, [(1, None)]).count() == 0 and whitened(spark, []).count() == 0
    assert whitened(spark, []).columns == whitened(spark, few).columns


def test_filtered_iteration_on_flat_and_repeated_values():
    r = np.random.default_rng(2)
    q = np.linalg.qr(r.standard_normal((120, 120)))[0]
    for values in (np.linspace(1.1, 1.0, 120), np.r_[np.full(10, 5.0), np.linspace(2, 1, 110)], np.r_[1e6, np.linspace(1.2, 1e-9, 119)]):
        v = (q * values) @ q.T
        calls = []
        found, vectors, residual = whiten.leading(lambda x: calls.append(1) or v @ x, 120)
        assert np.abs(found - np.sort(values)[::-1][:16]).max() < 1e-10 * values.max()
        assert np.linalg.norm(v @ vectors - vectors * found, axis=0).max() < 1e-11 * values.max()
        assert residual <= 1e-11 and len(calls) < 400
    assert whiten.leading(lambda x: 0 * x, 50)[0].max() == 0


def plain_spans(text):
    text, out = text or "", []
    name = "|".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    for m in re.finditer(rf"""({name})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


PROSE = "the handler reads every value of the request and writes the config of the worker manager to disk again "


def test_base_spans_equal_the_patterns(spark):
    r = random.Random(8)
    parts = ["token", "Secret", "API_KEY", "apikey", "password", "ſecret", ":", "=", " ", '"', "'", "AKIA", "AKIA0123456789ABCD", "0123456789abcdef", "abcdef", "xyz", "é", "\n", "😀", "."]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(40))) for _ in range(400)] + [None, "", "token" + " " * 100_000 + "=" + "a" * 300_000, "0" * 200_000]
    rows = secrets_scan.scan(table(spark, texts)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        base = plain_spans(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(secrets_scan.written(base).encode()).hexdigest()
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(s[1] == k for s in base) for k in range(3)]
        spans = row.spans.split(",") if row.spans else []
        assert [s for s in spans if not s.startswith("novel")] == [s for s in secrets_scan.written(base).split(",") if s]
        assert len(spans) == len(base) + row.n_novel


def test_novelty_finds_random_strings_and_leaves_names(spark):
    r = random.Random(4)
    random_text = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(n))
    hidden = [random_text(32) for _ in range(60)]
    texts = [f"{PROSE}the bearer is {h} and {PROSE}" for h in hidden]
    texts += [f"{PROSE}the private key of config_worker_manager_value {PROSE}"] * 50 + [f"{PROSE}{random_text(32)} is no such thing here" for _ in range(20)]
    texts += [f"{PROSE}auth {hidden[0]} {PROSE}"] * 300
    rows = {x.doc_id: x for x in secrets_scan.scan(table(spark, texts).repartition(4)).collect()}
    for i, h in enumerate(hidden):
        at = texts[i].index(h)
        assert f"novel:{at}:{at + 32}" in rows[i].spans.split(",")
    assert all(rows[i].n_novel == 0 for i in range(60, 130)) and all(rows[i].n_novel == 1 for i in range(130, len(texts)))
    content = " ".join(w for w, _ in sorted(Counter(w for t in texts for w in re.split("[^A-Za-z0-9+/=-]+", t) if re.fullmatch("[A-Za-z]{3,15}", w)).items(), key=lambda p: (-p[1], p[0]))[: secrets_scan.DICTIONARY_WORDS][::-1])
    assert secrets_scan.identifiers(table(spark, texts)) == content.encode()


def test_scan_of_null_keys_and_no_rows(spark):
    secret = "token = 24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    rows = secrets_scan.scan(table(spark, [secret, secret, None], ids=[None, 4, 4])).collect()
    assert sorted((r.n_assign, r.n_hex) for r in rows) == [(0, 0), (1, 1), (1, 1)] and sum(r.doc_id is None for r in rows) == 1
    assert secrets_scan.scan(table(spark, [])).count() == 0


@pytest.fixture(scope="module")
def tools():
    return align.pair(vocabulary(), vocabulary("piece_bpe_32k.model"))


def plain_alignment(tools, texts):
    """Groups by the set of common ends, links and counts by plain loops; A's ids from the library itself."""
    docs = []
    for text in texts:
        a = tools.other.encode(" " + (text or ""), add_special_tokens=False).ids
        b = tools.b.encode(text or "")
        data = (" " + (text or "")).encode()
        if not text or b"".join(tools.pieces_a[i] for i in a) != data or b"".join(tools.pieces_b[i] for i in b) != data:
            a, b = [], []
        ends_a, ends_b = np.cumsum([len(tools.pieces_a[i]) for i in a]).tolist(), np.cumsum([len(tools.pieces_b[i]) for i in b]).tolist()
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            k, m = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append((a[i:k], b[j:m]))
            i, j = k, m
        docs.append((len(a), len(b), groups))
    count, most = Counter(), defaultdict(int)
    for _, _, groups in docs:
        count.update({(x, y) for p, q in groups for x in p for y in q})
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    for n_a, n_b, groups in docs:
        found = [(x, y) for p, q in groups for x in p for y in q]
        body = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        yield n_a, n_b, len(groups), len(found), sum(count[p] == most[p[0]] for p in found), sum(count[p] for p in found), hashlib.sha256(body.encode()).hexdigest() if n_a else ""


def test_alignment_equals_plain_loops(spark, tools):
    r = random.Random(6)
    pool = ["the", "word", " ", "  ", "\n", "é", "ß", "12", "…", "中文", "😀", "<|endoftext|>", "<s>", "<0x41>", "don't", "unbelievable", "tion", "\t", "ɐ"]
    texts = ["".join(r.choice(pool) for _ in range(r.randrange(60))) for _ in range(120)] + [None, "", "a", " ", "▁x", "ﬁ", "same words here", "same words here", "a\x00b", " " * 2000, "word " * 3000, "ab" * 2000]
    want = list(plain_alignment(tools, texts))
    assert sum(w[0] == 0 for w in want) >= 3
    frame = table(spark, texts).repartition(3)
    for block, lane in ((4 << 20, 192), (2000, 5)):
        rows = align.align(frame, vocabulary(), vocabulary("piece_bpe_32k.model"), block=block, lane=lane).collect()
        assert len(rows) == len(texts)
        for row in rows:
            assert tuple(row)[1:] == want[row.doc_id]


def test_alignment_of_null_keys_and_no_rows(spark, tools):
    rows = align.align(table(spark, ["some words", "some words", None], ids=[None, 3, 3]), vocabulary(), vocabulary("piece_bpe_32k.model")).collect()
    assert sorted((r.doc_id is None, r.n_a) for r in rows) == [(False, 0), (False, 2), (True, 2)]
    assert align.align(table(spark, []), vocabulary(), vocabulary("piece_bpe_32k.model")).count() == 0


def test_lockstep_steps_do_not_follow_the_longest_document(tools):
    ids = [x for x in tools.encode(["the words of a long text are read again " * 3000, "short words"])]
    ends_a, ends_b = [np.cumsum(tools.sizes_a[a]) for a, _ in ids], [np.cumsum(tools.sizes_b[b]) for _, b in ids]
    one, many = align.lanes(ends_a, ends_b, 1 << 30), align.lanes(ends_a, ends_b)
    assert one.shape[1] == 2 and many.shape[1] > 50 and (many[1] - many[0]).max() < 1000
    joined = [np.concatenate(ends_a), np.concatenate(ends_b)]
    assert np.array_equal(align.merged(*joined, one), align.merged(*joined, many))
