"""Tokens, languages, shards, sketches, pages and benchmark tiles against brute force."""

import hashlib
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from brute import table
from voltaria.llm import bpe, count, encode, iblt, langid, sharding, template, tiling
from voltaria.session import stage

PATH = bpe.vocabulary()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def awkward(seed, n=300):
    r = random.Random(seed)
    pool = ["a", "the", " ", "  ", "\n", "\t", "'s", "'re", "é", "ß", "12", "7", "!", "…", "中文", "😀", "<|endoftext|>", "<|endof", "ɏ", " ", "\x85", "word", "Ünï", "´"]
    return ["".join(r.choice(pool) for _ in range(r.randrange(0, 60))) for _ in range(n)]


def test_codec_equals_the_library(library):
    tool = bpe.Codec(PATH)
    for text in awkward(1):
        ids = library.encode(text, add_special_tokens=False).ids
        assert tool.encode(text) == ids
        assert tool.decode(ids) == library.decode(ids, skip_special_tokens=False)
        assert int(tool.spans(ids).sum()) == len(text.encode())
    r = random.Random(2)
    for _ in range(200):
        text = "".join(chr(r.randrange(0, 0x250)) for _ in range(80))
        assert tool.encode(text) == library.encode(text, add_special_tokens=False).ids


def long_texts():
    r = random.Random(3)
    letters = "".join(r.choice("abcdefgh") for _ in range(700))
    return ["".join(awkward(4, 40)), letters, "ab" * 300, "中文字" * 150, " " * 500, "x " * 300, "<|endoftext|>" * 60, "don't we'll " * 60, "😀é" * 120, "12345" * 90, "!?" * 200]


def test_tree_encoding(spark, library):
    texts = [*long_texts(), *awkward(5, 40), None, "", "same", "same"]
    for leaf in (13, 64, 10_000):
        rows = encode.encode(table(spark, texts), PATH, leaf=leaf, keep_ids=True).collect()
        assert len(rows) == len(texts)
        for row in rows:
            want = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
            assert row.ids == want and row.n_tokens == len(want)
            assert row.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
            assert row.decoded_sha256 == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()
    assert encode.encode(table(spark, []), PATH).count() == 0


def test_token_counts(spark, library):
    texts = [*long_texts(), *awkward(6, 40), None, "", "same", "same"]
    for chunk, overlap in ((40, 4), (64, 30), (10_000, 512)):
        rows = count.token_counts(table(spark, texts), PATH, chunk=chunk, overlap=overlap, limit=100).collect()
        assert len(rows) == len(texts)
        for row in rows:
            whole = texts[row.doc_id] or ""
            n = len(library.encode(whole, add_special_tokens=False).ids)
            assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(whole.encode()), n, n > 100)
    assert count.token_counts(table(spark, []), PATH).count() == 0


def test_language(spark):
    r = random.Random(1)
    words = {"aa": ["mira", "lopo", "santu", "veri"], "bb": ["thrig", "knost", "wulph", "gract"]}
    texts = [" ".join(r.choice(words[g]) for _ in range(40)) for g in ("aa", "bb") * 60]
    langs = ["aa", "bb"] * 60
    texts += [None, "", "12 34 !", texts[0] * 400, texts[1].upper()]
    langs += ["aa", None, "aa", "aa", "bb"]
    rows = {x.doc_id: x for x in langid.identify(table(spark, texts, langs=langs)).collect()}
    assert len(rows) == len(texts)
    assert all(rows[i].lang_pred == langs[i] for i in [*range(120), 123, 124])
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 and rows[i].rejected for i in (120, 121, 122))
    assert all(0 <= x.score <= 1 and x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in rows.values())
    assert langid.identify(table(spark, [])).count() == 0
    assert langid.identify(table(spark, ["abc"], langs=[None])).first().lang_pred == "und"
    one = langid.identify(table(spark, ["abc def"] * 9, langs=["aa"] * 9)).collect()
    assert {(x.lang_pred, x.score, x.rejected) for x in one} == {("aa", 1.0, False)}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = langid.identify(docs).where("held_out").collect()
    assert sum(r.lang_pred == truth[r.doc_id] for r in rows) >= 0.97 * len(rows)


def test_shards(spark):
    texts = ["é" * (i % 7) for i in range(500)] + [None, "", "", None]
    ids = [*range(500), 500, 3, 3, None]
    rows = sharding.shards(table(spark, texts, ids)).collect()
    slots = defaultdict(list)
    for x in rows:
        slots[x.shard].append(x.slot)
        assert x.grown_shard in (x.shard, 8) and x.law == "key"
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) == set(range(8))
    want = Counter((i, 1 if t is None else len(t.encode()) + 1, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts))
    assert Counter((x.doc_id, x.size, x.text_crc32) for x in rows) == want
    assert len({x.shard for x in rows if x.doc_id == 3}) == 1
    heavy = Counter(x.shard for x in sharding.shards(table(spark, texts, ids), weights=[1.0, 4.0]).collect())
    assert heavy[1] > 2.5 * heavy[0]
    assert sharding.shards(table(spark, [])).count() == 0


def likeness(a, b):
    a, b = ({p for p in x.split("\n") if p} for x in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def test_sketches(spark):
    r = random.Random(2)
    texts = ["\n".join(r.choice("abcdefgh") * r.randrange(0, 9) for _ in range(r.choice([0, 1, 5, 40]))) for _ in range(60)]
    texts += ["\n".join(f"line {i}" for i in range(900)), None, "", "é\nü" * 30, texts[0], texts[0]]
    rows = {x.doc_id: x for x in iblt.fingerprints(table(spark, texts)).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        own, after = text or "", texts[i - 1] or ""
        cut = len(own) // 3
        edited = own[: len(own) - cut] + after[:cut]
        x = rows[i]
        assert x.n_chars == len(own) and x.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert x.near_edited == pytest.approx(likeness(own, edited)) and x.near_next == pytest.approx(likeness(own, after))
    assert rows[0].fingerprint == rows[len(texts) - 1].fingerprint == rows[len(texts) - 2].fingerprint
    assert iblt.fingerprints(table(spark, [])).count() == 0
    lone = iblt.fingerprints(table(spark, ["a\nb\nc"])).first()
    assert lone.near_next == 1.0


def test_sketches_of_long_lines(spark):
    r = random.Random(4)
    word = lambda kind: "".join(r.choice(kind) for _ in range(r.randrange(2, 8)))
    texts = [" ".join(word("abcdenrst") for _ in range(n)) for n in (150, 400, 3000)] + [word("日本語文字列") * 150, "x" * 900]
    for x in iblt.fingerprints(table(spark, texts)).collect():
        assert x.near_edited >= 0.2 and x.near_edited > x.near_next


def test_slices_of_the_next_document(spark, monkeypatch):
    monkeypatch.setattr(iblt, "SLICE_BYTES", 200)
    r = random.Random(5)
    ids = r.sample(range(1000), 80)
    texts = [f"text {i}" for i in ids]
    got = {x.key: x.next_text for x in iblt.with_next(table(spark, texts, ids), "doc_id", "text").collect()}
    order = sorted(ids, reverse=True)
    assert got == {a: f"text {b}" for a, b in zip(order, [*order[1:], order[0]])}


def test_pages(spark):
    body = "<div class='bar'>Same<b> bar</b></div><div><p>Text {0} &amp;&nbsp;more</p></div><div id=x>Tail of site</div>"
    pages = [(i, "http://a.example/" + str(i), body.format(i)) for i in range(8)]
    pages += [
        (20, "http://b.example/", "<head><title>t</title><body><nav>m</nav><article><header><h1>H &lt;1&gt;</h1></header><p>one <i>two</i> <span class=ad>buy</span> three<script>'</p>'</script><p>four<ul><li>a<li>b</ul><section class=comments><article>no</article></section></article><footer>f"),
        (21, None, None),
        (22, "x", ""),
        (23, "http://b.example/", "plain  text\n here"),
        (24, "http://b.example/", "<p>cut <a href='x"),
        (24, "http://b.example/", "<p>cut <a href='x"),
    ]
    frame = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, host string, `row` string")
    rows = template.extract(frame).collect()
    got = {x.page_id: x.text for x in rows}
    assert len(rows) == len(pages)
    assert all(got[i] == f"Text {i} & more" for i in range(8))
    assert got[20] == "H <1>\none two three\nfour\na\nb"
    assert (got[21], got[22], got[23], got[24]) == ("", "", "plain text here", "cut")
    assert all(x.n_chars == len(x.text) for x in rows)
    assert template.extract(frame.limit(0)).count() == 0


def test_articles_of_copies_stay(spark):
    page = "<nav>m</nav><article><h1>T</h1><p>Same article text</p></article>"
    frame = spark.createDataFrame([(i, "http://a.example/", page) for i in range(9)], "page_id long, url string, html string")
    assert {x.text for x in template.extract(frame).collect()} == {"T\nSame article text"}


def test_templates_inside_articles(spark):
    same = "<p>Subscribe to our letter</p><ul><li>Buy now</li></ul><table><tr><td>Advert</td></tr></table>"
    page = "<article><h1>H {0}</h1>{1}<p>Own <b>text</b> {0} <span>read more of this</span></p>{2}</article>"
    pages = [(i, "http://a.example/", page.format(i, same, "")) for i in range(8)]
    pages += [(i, "http://b.example/", page.format(i, "", "<p>Seen on some pages</p>" if i < 220 else "")) for i in range(200, 300)]
    rows = template.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert len(rows) == len(pages) and all(x.text == f"H {x.page_id}\nOwn text {x.page_id}" for x in rows)


def test_marks_inside_articles():
    page = '<article><h2 id="related-work">R</h2><section id="social-impact"><p>S</p></section><p class="notice-period">N</p><div class="x ad">A</div></article>'
    assert [s.text for s in template.main_segments(template.parsed(page)) if s.text.strip()] == ["R", "S", "N"]


def bench(spark, items):
    return spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")


def test_tiling(spark):
    r = random.Random(6)
    item = [f"w{r.randrange(300)}" for _ in range(30)]
    moved = item[20:] + ["pad"] * 5 + item[:10] + ["pad"] + item[10:20]
    half = item[:12] + ["q"] * 30
    noise = [f"n{r.randrange(300)}" for _ in range(60)]
    texts = [" ".join(noise + item + noise), " ".join(moved).upper(), " ".join(half), " ".join(noise), None, "", "Tiny item", "a tiny, ITEM here", " ".join(item)]
    items = [" ".join(item), "tiny item", None, "", " ".join(item)]
    want = {(d, i) for d in (0, 1, 8) for i in (0, 4)} | {(6, 1), (7, 1)}
    for limit in (1 << 20, 0):
        rows = tiling.contaminated(table(spark, texts), bench(spark, items), broadcast_bytes=limit).collect()
        assert {(x.doc_id, x.item_id) for x in rows} == want and len(rows) == len(want)
    assert next(x for x in rows if (x.doc_id, x.item_id) == (1, 0)).tiles >= 3
    assert tiling.contaminated(table(spark, []), bench(spark, items)).count() == 0
    assert tiling.contaminated(table(spark, texts), bench(spark, [])).count() == 0


def test_tiles_take_the_longest_first():
    made = tiling.tiles([1, 2, 3, 4, 5, 6], [4, 5, 6, 9, 1, 2, 3, 4, 9, 5, 6], 2)
    assert made[0][2] == 4 and sum(n for _, _, n in made) == 6


def plain_tiles(item, text, least):
    """Greedy string tiling as defined: always the longest free match, then the first in the item, then in the text."""
    used, taken, found = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and i + n not in used and j + n not in taken and item[i + n] == text[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return found
        found.append((i, j, n))
        used.update(range(i, i + n))
        taken.update(range(j, j + n))


def test_tiles_equal_plain_greedy_tiling():
    r = random.Random(8)
    for _ in range(300):
        words = r.choice([2, 3, 8, 40])
        item, text = ([r.randrange(words) for _ in range(r.randrange(1, n))] for n in (45, 70))
        for _ in range(r.randrange(3)):
            a, p = r.randrange(len(item)), r.randrange(len(text) + 1)
            text[p:p] = item[a : a + r.randrange(1, 30)]
        least = min(r.choice([2, 4]), len(item))
        assert sorted(tiling.tiles(item, text, least)) == sorted(plain_tiles(item, text, least))


def test_contamination_equals_plain_tiling(spark):
    """Both ways of finding candidates against every document with every item; few words, so that common seeds abound."""
    r = random.Random(9)
    word = lambda: f"w{min(r.randrange(12), r.randrange(12))}"
    items = [" ".join(word() for _ in range(r.choice([1, 2, 3, 5, 12, 30]))) for _ in range(25)] + [None, ""]
    texts = [" ".join(word() for _ in range(r.randrange(0, 60))) for _ in range(60)] + [None, "", *items[3:8]]
    want = set()
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            a, b = (item or "").split(), (text or "").split()
            covered = sum(n for _, _, n in plain_tiles(a, b, min(4, len(a)))) if a else 0
            if a and covered >= 0.6 * len(a):
                want.add((d, i, covered))
    for limit in (1 << 20, 0):
        rows = tiling.contaminated(table(spark, texts), bench(spark, items), broadcast_bytes=limit).collect()
        assert len(rows) == len(want) and {(x.doc_id, x.item_id, x.covered_words) for x in rows} == want


def test_tiling_of_one_word_repeated_is_not_quadratic():
    one = np.full(400_000, 8, np.uint64)
    broken = np.tile(np.array([8] * 19 + [16], np.uint64), 5_000)
    start = time.time()
    assert tiling.coverage(one[:200], one, 4) == (200, 1)
    assert tiling.coverage(one[:60], broken, 4) == (57, 3)  # three runs of 19; the 3 words left are less than a seed
    assert tiling.coverage(np.concatenate([one[:30], np.arange(100, 1100, 8, dtype=np.uint64)]), one, 4, 0.6) == (0, 0)
    assert time.time() - start < 30


def test_templates_equal_plain_counting(spark):
    """Pages of known blocks; a block is expected to go by a plain count of the host's distinct pages that hold it."""
    r = random.Random(11)
    pages = []
    for host, n in (("a", 40), ("b", 12), ("c", 6), ("d", 4), (None, 20)):
        common = {f"{host} block {k} with words": r.random() for k in range(12)}
        for i in range(n):
            blocks = [b for b, share in common.items() if r.random() < share] + [f"own {host} {i} {r.random()}"]
            r.shuffle(blocks)
            pages += [(host, blocks)] * r.choice([1, 1, 3])
    held = defaultdict(lambda: defaultdict(set))
    every = defaultdict(set)
    for host, blocks in pages:
        every[host].add(tuple(blocks))
        for b in blocks:
            held[host][b].add(tuple(blocks))
    gone = {(h, b) for h, bs in held.items() for b, where in bs.items() if len(every[h]) >= 5 and len(where) >= len(every[h]) / 2 or len(where) >= max(10, len(every[h]) / 10)}
    rows = [(i if i % 7 else None, h and f"https://{h}.org/x", "<body>" + "".join(f"<div><p>{b}</p></div>" for b in bs)) for i, (h, bs) in enumerate(pages)]
    found = template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    want = Counter((i, u, "\n".join(b for b in bs if (h, b) not in gone)) for (i, u, _), (h, bs) in zip(rows, pages))
    assert Counter((x.page_id, x.url, x.text) for x in found) == want and len(gone) > 20


def test_broken_and_deep_pages_end_in_linear_time():
    n = 100_000
    start = time.time()
    text = lambda page: "".join(s.text for s in template.main_segments(template.parsed(page))).strip()
    assert text("x <a '" * n).startswith("x <a 'x <a '")
    assert text("<a 'x>'" * n).count("'") == n
    assert text("<a<a<a" * n) == "<a" * (3 * n - 1)
    assert text("<div>" * n + "in" + "</x>" * n + "</div>" * n + "out") == "in\nout"
    segments, subtrees = template.read_page("<div>a " * n)
    assert len(subtrees) == n and len({t.hash for t in subtrees}) == n
    assert text("<p>" + "<i>" * n + "<p>b</p>" * n).count("b") == n
    assert text("<table>" + "<div>" * n + "<td>c</td>" * n).count("c") == n
    assert time.time() - start < 60


def test_sketches_shuffle_and_write_no_digests(spark, monkeypatch):
    """Retries stay in their rows: only what no turn could peel is written, and the likeness is exact either way."""
    r = random.Random(6)
    texts = ["\n".join(f"{r.randrange(300)}" for _ in range(n)) for n in (3, 30, 120, 400, 120, 30, 900)]
    staged = {}

    def keep(rows, label):
        made = stage(rows, label)
        staged.setdefault(label, []).append(made)
        return made

    monkeypatch.setattr(iblt, "stage", keep)
    for turns in (2, 0):
        staged.clear()
        monkeypatch.setattr(iblt, "IN_ROW", turns)
        rows = {x.doc_id: x for x in iblt.fingerprints(table(spark, texts)).collect()}
        for i, text in enumerate(texts):
            assert rows[i].near_next == pytest.approx(likeness(text, texts[i - 1]))
        assert "digests" not in staged
        (first,) = staged["sketches"]
        assert "Exchange hashpartitioning(row" not in first._jdf.queryExecution().executedPlan().toString()
        left = first.selectExpr("sum(size(rest_e) + size(rest_b)) n", "sum(size_a + size_b + size_e) total").first()
        assert left.n * 20 <= left.total and (left.n > 0) == ("blocks" in staged)
