"""Set joins, paragraphs and repeated bytes against brute force."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from brute import components, repeated, table
from voltaria.llm import jaccard, linking, paragraphs, runs, suffixes, text

WORDS = [f"w{i}" for i in range(400)]


def varied(seed, n=40, size=60, groups=6):
    """Texts in groups of near copies, with short, empty and repeated ones."""
    r = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [r.choice(WORDS) for _ in range(r.choice([3, 5, 8, 20, size, 3 * size]))]
        for _ in range(n // groups):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                copy[r.randrange(len(copy))] = r.choice(WORDS)
            out.append(" ".join(copy))
    return [*out, None, "", " \n\t", "One", "one", out[0], out[0].upper()]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_jaccard_join(spark, seed):
    texts = varied(seed)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_join(table(spark, texts)).collect()}
    assert found == components(list(enumerate(texts)))


def test_jaccard_null_keys_and_empty_table(spark):
    rows = jaccard.jaccard_join(table(spark, ["a b c d e f", "a b c d e f", None], ids=[7, None, None])).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == Counter([(7, 2, 7), (None, 2, 7), (None, 0, None)])
    assert jaccard.jaccard_join(table(spark, [])).count() == 0


def test_signatures_meet_for_every_similar_pair():
    r = np.random.default_rng(5)
    for size in [1, 2, 3, 4, 5, 6, 9, 12, 20, 33, 60, 200, 700]:
        for _ in range(40):
            a = np.unique(r.integers(1, 2**63, size).astype(np.uint64))
            most = (2 * len(a) * 20) // 180
            swap = r.integers(0, most // 2 + 1) if most else 0
            b = np.unique(np.concatenate([a[swap:], r.integers(1, 2**63, swap).astype(np.uint64)]))
            shared = len(np.intersect1d(a, b))
            if shared * 100 < 80 * (len(a) + len(b) - shared):
                continue
            edges = jaccard.bands(80, 4096)
            signs = []
            for s in (a, b):
                k = int(np.searchsorted(edges, len(s), side="right")) - 1
                signs.append(set(np.concatenate([jaccard.signatures(s, j, edges[j], edges[j + 1], 80)[0] for j in (k, k + 1)]).tolist()))
            assert signs[0] & signs[1]


def test_linking_reaches_pairs_without_a_common_leader(spark):
    sets = {i: list(range(i, i + 50)) for i in range(30)}
    buckets = spark.createDataFrame([(1, i) for i in sets], "bucket long, item long")
    frame = spark.createDataFrame([(i, 50, s) for i, s in sets.items()], "item long, size long, hashes array<long>")
    found = {r.node: r.component for r in linking.link_sets(buckets, frame, 80).collect()}
    assert found == {i: 0 for i in sets}
    apart = spark.createDataFrame([(i, 50, [i * 1000 + j for j in range(50)]) for i in range(30)], "item long, size long, hashes array<long>")
    assert linking.link_sets(buckets, apart, 80).count() == 0


def test_checks_of_a_large_bucket_stay_few(spark, monkeypatch):
    """Copies of one set with a few changes, and sets that only meet in a bucket: checks counted, all links found."""
    r, checks = random.Random(9), []
    verified = linking.verified
    monkeypatch.setattr(linking, "verified", lambda pairs, *a, **k: checks.append(pairs.count()) or verified(pairs, *a, **k))
    near = {i: sorted(set(range(100)) - {r.randrange(100) for _ in range(4)} | {1000 + 10 * i + j for j in range(3)}) for i in range(400)}
    apart = {1000 + i: sorted(r.sample(range(10**6, 10**6 + 12_000), 100)) for i in range(400)}
    chain = {2000 + i: list(range(10**7 + i, 10**7 + i + 50)) for i in range(400)}
    frame = lambda sets: spark.createDataFrame([(i, len(s), s) for i, s in sets.items()], "item long, size long, hashes array<long>")
    for sets, spread, bound in ((near, 12, 4), (apart, 1, 16), (chain, 1, 24)):
        buckets = spark.createDataFrame([(b, i) for i in sets for b in range(spread)], "bucket long, item long")
        checks.clear()
        found = {x.node: x.component for x in linking.link_sets(buckets, frame(sets), 80).collect()}
        assert found == ({} if sets is apart else {i: min(sets) for i in sets})
        assert sum(checks) <= bound * len(sets), checks


def test_one_round_settles_a_group_around_one_head(spark, monkeypatch):
    r, staged, stage = random.Random(4), Counter(), linking.stage
    monkeypatch.setattr(linking, "stage", lambda df, label: staged.update([label]) or stage(df, label))
    base = list(range(1, 101))
    sets = [sorted(base[:-1] + [1000 + i]) for i in range(30)] + [sorted(r.sample(range(10**6, 10**9), 100)) for _ in range(30)]
    frame = spark.createDataFrame([(i, len(x), x) for i, x in enumerate(sets)], "item long, size long, hashes array<long>")
    buckets = spark.createDataFrame([(1, i) for i in range(len(sets))], "bucket long, item long")
    found = {x.node: x.component for x in linking.link_sets(buckets, frame, 80).collect()}
    assert found == {i: 0 for i in range(30)}
    assert (staged["heads"], staged["links"], staged["edges"]) == (1, 1, 1)


def test_labels_that_rounds_left_apart_are_joined(spark):
    links = spark.createDataFrame([(5, 3), (9, 8), (8, 5), (20, 21)], "a long, b long")
    labels = spark.createDataFrame([(3, 3), (5, 3), (8, 8), (9, 8), (20, 20), (21, 20)], "node long, component long")
    found = {x.node: x.component for x in linking._joined(links, labels).collect()}
    assert found == {3: 3, 5: 3, 8: 3, 9: 3, 20: 20, 21: 20}


@pytest.mark.parametrize("block", [1, 10**6])
def test_verified_pairs_need_four_shuffles(spark, block):
    r = random.Random(8)
    sets = {i: sorted(set(range(100)) - set(r.sample(range(100), r.choice([5, 9, 14])))) for i in range(12)}
    frame = spark.createDataFrame([(i, len(x), x) for i, x in sets.items()], "item long, size long, hashes array<long>")
    asked = [(a, b, 800) for a in sets for b in sets if a < b and b != 5]
    pairs = spark.createDataFrame([(b, a, n) for a, b, n in asked], "item long, head long, bytes long")
    like = lambda a, b: 100 * len({*sets[a]} & {*sets[b]}) >= 80 * len({*sets[a]} | {*sets[b]})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = linking.verified(pairs, frame, 80, block)
        assert sorted((x.b, x.a) for x in found.collect()) == sorted((a, b) for a, b, _ in asked if like(a, b))
        plan = linking.verified(pairs, frame, 80, block)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7)]
    found = {r.node: r.component for r in linking.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(20)}


def test_hashes_do_not_depend_on_the_batch():
    a, b = "Ab cd\n\x0bef  gh ij kl", "x ÿ ab"
    one = [s.tolist() for s in text.shingle_sets(pa.array([a, b, None, ""]))]
    assert one == [next(text.shingle_sets(pa.array([t]))).tolist() for t in (a, b, None, "")]
    assert [len(s) for s in one] == [2, 1, 0, 0]


def test_runs_merge_in_order():
    r = random.Random(4)
    lists = [sorted({bytes(r.choice(b"ab") for _ in range(r.randrange(1, 9))) for _ in range(40)}) for _ in range(5)]
    out = list(runs.merged([runs.decoded(*runs.coded(x)) for x in lists]))
    assert [s for _, _, s in out] == sorted(s for x in lists for s in x)
    before = b""
    for _, shared, string in out:
        assert shared == runs.common(before, string)
        before = string
    assert list(runs.merged([])) == [] and list(runs.merged([iter([])])) == []


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeated_bytes(spark, seed):
    r = random.Random(seed)
    parts = ["".join(r.choice("abcdé \n") for _ in range(r.choice([5, 20, 60]))) for _ in range(12)]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(0, 5))) for _ in range(40)]
    texts += [None, "", "z" * 70, "za" * 60, texts[0], texts[0], "q" * 19, "q" * 20, "p" * 21]
    ids = [*range(len(texts) - 1), len(texts) - 2]
    rows = suffixes.repeated_bytes(table(spark, texts, ids), window=20).collect()
    assert Counter(tuple(x) for x in rows) == repeated(list(zip(ids, texts)), 20)
    assert suffixes.repeated_bytes(table(spark, []), window=20).count() == 0


def sentence(r, n=9):
    return " ".join(r.choice(WORDS) for _ in range(n)).capitalize() + "."


def test_passages_and_paragraphs(spark):
    r = random.Random(8)
    passage = " ".join(sentence(r) for _ in range(6))
    own = [" ".join(sentence(r) for _ in range(8)) for _ in range(4)]
    near = own[3].split()
    near[30] = "changed"
    texts = [own[0] + " " + passage, passage + "\n" + own[1], own[2], own[3], "Short line.\n" + " ".join(near), "Short line.", None, ""]
    frame = table(spark, texts)
    units = paragraphs.duplicates(frame).collect()
    assert {frozenset((u.doc_id, u.kept_in)) for u in units} == {frozenset((0, 1)), frozenset((3, 4))}
    clean = {r.doc_id: r for r in paragraphs.deduplicated(frame).collect()}
    assert sum(passage in (clean[i].text if i in clean else "") for i in (0, 1)) == 1
    assert clean[2].text == texts[2] and clean[5].text == texts[5] and clean[6].text is None and clean[7].text == ""
    assert all(x.n_chars == (None if x.text is None else len(x.text)) for x in clean.values())
    assert all(own[i] in clean[i].text for i in (0, 1))
    assert paragraphs.deduplicated(table(spark, [])).count() == 0 and paragraphs.duplicates(table(spark, [])).count() == 0


@pytest.mark.parametrize("n, stop, line", [(50, "", 400), (50, "\u0964", 9), (60, "", 3), (50, ".", 400)])
def test_runs_without_whole_sentences(spark, n, stop, line):
    r = random.Random(n + line)
    words = lambda k: [f"w{r.randrange(10**6)}" for _ in range(k)]
    run = words(n)
    run[14], run[34] = run[14] + stop, run[34] + stop
    own = [(words(70), words(70)) for _ in range(6)]
    texts = [a + run + b for a, b in own[:5]] + [own[5][0] + own[5][1]]
    texts = ["\n".join(" ".join(t[i : i + line]) for i in range(0, len(t), line)) for t in texts]
    frame = table(spark, texts)
    units = [u for u in paragraphs.duplicates(frame).collect() if u.kind == "run"]
    assert Counter((u.first, u.last, u.words) for u in units) == {(70, 69 + n, n): 4} and len({u.kept_in for u in units}) == 1
    clean = [x.text.split() for x in sorted(paragraphs.deduplicated(frame).collect(), key=lambda x: x.doc_id)]
    assert sorted(t == a + b for t, (a, b) in zip(clean, own)) == [False] + [True] * 5 and sum(run[20] in t for t in clean) == 1


def test_repeated_rows_keep_their_text(spark):
    r = random.Random(9)
    body = " ".join(sentence(r) for _ in range(6))
    kept = paragraphs.deduplicated(table(spark, [body, body, body], ids=[1, 1, None])).collect()
    assert len([x for x in kept if x.text]) in (1, 2)


def test_bands_reach_the_recall():
    bands, rows = paragraphs.tuned()
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999
