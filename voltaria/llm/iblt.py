"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in DataFrame functions only.

Paragraphs are the non-empty lines of a text; lines above ``LONG`` characters are cut into pieces where their content says so
(after certain word ends and stops, at ``LEAST_PIECE`` to ``MOST_PIECE`` characters), so an edit changes only the pieces it meets. A text's set holds the 64-bit digest of each. A sketch has three rows of
``CELLS`` cells; a digest enters one cell of each row, which keeps count, XOR of digests and XOR of their checks. Two
sketches subtract cell by cell, and what remains is peeled: a cell of count 1 or -1 whose check fits holds one
differing digest, which is taken out of its cells until none is left. If cells remain, the comparison is retried
with a larger sketch: as many blocks of cells as the sets need, a digest's block being taken from bits that its cells
do not use. Of these only the blocks that do not peel are taken again, each cut in four by further hash bits. All this
stays in the pair's row, so digests are neither shuffled nor written; the few blocks left after some turns become rows.
The likeness of two versions is the Jaccard similarity of their digest sets, from set sizes and peeled differences.

The next document in descending key order comes from a window within slices of keys; the slices' bounds are
quantiles, and a slice's last row takes the first row of the next slice (after the last: of the first).

Defined cases: null text counts as empty; two texts without paragraphs are alike (1.0), one without and one with are
not (0.0); a single row is its own next; equal keys are ordered by a hash of the text, null keys come last; repeated
rows are rows of their own; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltaria.session import stage

ROWS, CELLS, ROUNDS = 3, 8, 10
SLICE_BYTES = 4 << 20
BLOCK_LOAD, SPLIT = 8, 4
#: Turns of cutting blocks anew within the row of their pair.
IN_ROW = 2
LONG, LEAST_PIECE, MOST_PIECE = 96, 64, 256
_PIECE = rf"(?s).{{{LEAST_PIECE},{MOST_PIECE}}}?(?:[dlnry.!?]\s|[^\x00-\x7F]\s|[。！？、।]|$)|.{{1,{MOST_PIECE}}}"
_BITS = CELLS.bit_length() - 1


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Use a value more than once without computing it again."""
    return F.transform(F.array(value), use)[0]


def check(digest: Column) -> Column:
    """The 32-bit check of a digest."""
    return F.shiftrightunsigned(F.xxhash64(digest), 32)


def cell_of(digest: Column, row: int) -> Column:
    """Index of a digest's cell in one row of the sketch, counted over all rows."""
    return F.pmod(F.shiftrightunsigned(digest, row * _BITS), F.lit(CELLS)) + F.lit(row * CELLS)


def digests(text: Column) -> Column:
    """Distinct digests of the paragraphs of a text, long ones in pieces."""
    lines = F.filter(F.split(text, "\n"), lambda p: p != "")
    pieces = F.transform(lines, lambda p: F.when(F.length(p) > LONG, F.regexp_extract_all(p, F.lit(_PIECE), F.lit(0))).otherwise(F.array(p)))
    return F.array_distinct(F.transform(F.flatten(pieces), lambda p: F.xxhash64(p)))


def _cell(n: Column, k: Column, h: Column) -> Column:
    return F.struct(n.cast("long").alias("n"), k.alias("k"), h.alias("h"))


def _xor(values: Column, of: Callable[[Column], Column]) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(of(x)))


def sketch(found: Column) -> Column:
    """The cells of a set of digests."""

    def row(r: int) -> Column:
        held = F.transform(F.sequence(F.lit(r * CELLS), F.lit(r * CELLS + CELLS - 1)), lambda c: F.filter(found, lambda d: cell_of(d, r) == c))
        return F.transform(held, lambda own: _cell(F.size(own), _xor(own, lambda d: d), _xor(own, check)))

    return F.concat(*(row(r) for r in range(ROWS)))


def printed(cells: Column) -> Column:
    """A sketch as text: for each cell count, digests and checks in hexadecimal."""
    return F.array_join(F.transform(cells, lambda c: F.concat(F.lpad(F.hex(c["n"]), 4, "0"), F.lpad(F.hex(c["k"]), 16, "0"), F.lpad(F.hex(c["h"]), 8, "0"))), "")


def _pure(cells: Column) -> Column:
    single = F.filter(cells, lambda c: (F.abs(c["n"]) == 1) & (c["h"] == check(c["k"])))
    return F.array_distinct(F.transform(single, lambda c: F.struct(c["k"].alias("k"), c["n"].alias("n"))))


def _without(cells: Column, pure: Column) -> Column:
    def left(cell: Column, index: Column) -> Column:
        own = F.filter(pure, lambda p: (index == cell_of(p["k"], 0)) | (index == cell_of(p["k"], 1)) | (index == cell_of(p["k"], 2)))
        return let(
            own,
            lambda gone: F.when(F.size(gone) == 0, cell).otherwise(
                _cell(
                    cell["n"] - F.aggregate(gone, F.lit(0).cast("long"), lambda a, p: a + p["n"]),
                    cell["k"].bitwiseXOR(_xor(gone, lambda p: p["k"])),
                    cell["h"].bitwiseXOR(_xor(gone, lambda p: check(p["k"]))),
                )
            ),
        )

    return F.transform(cells, left)


def peeled(one: Column, other: Column) -> Column:
    """Number of digests in which two sketches differ; null if they cannot be recovered."""
    rest = F.zip_with(one, other, lambda a, b: _cell(a["n"] - b["n"], a["k"].bitwiseXOR(b["k"]), a["h"].bitwiseXOR(b["h"])))

    def state(cells: Column, found: Column) -> Column:
        return let(cells, lambda c: F.struct(c.alias("cells"), _pure(c).alias("pure"), found.cast("long").alias("found")))

    def step(now: Column, _: Column) -> Column:
        return F.when(F.size(now["pure"]) == 0, now).otherwise(state(_without(now["cells"], now["pure"]), now["found"] + F.size(now["pure"])))

    last = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), state(rest, F.lit(0)), step)
    clean = lambda s: F.forall(s["cells"], lambda c: (c["n"] == 0) & (c["k"] == 0) & (c["h"] == 0))
    return let(last, lambda s: F.when(clean(s), s["found"]))


def likeness(a: Column, b: Column, differing: Column) -> Column:
    """Jaccard similarity from set sizes and the number of differing digests."""
    shared = (a + b - differing) / F.lit(2.0)
    return F.when(differing == 0, F.lit(1.0)).otherwise(shared / (shared + differing))


def _slice(key: Column, cuts: list[int]) -> Column:
    """Number of a key's slice, from the largest keys down: first among coarse cuts, then among the fine ones between."""
    width = max(1, round(len(cuts) ** 0.5))
    groups = [cuts[i : i + width] for i in range(0, len(cuts), width)] or [[]]
    coarse = F.array(*(F.lit(g[0]).cast("long") for g in groups[1:])) if len(groups) > 1 else F.array().cast("array<long>")
    fine = F.array(*(F.array(*(F.lit(c).cast("long") for c in g)) if g else F.array().cast("array<long>") for g in groups))
    above = F.size(F.filter(coarse, lambda c: c >= key))
    number = above * width + F.size(F.filter(F.element_at(fine, above + 1), lambda c: c >= key))
    return F.when(key.isNull(), F.lit(len(cuts))).otherwise(number)


def with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, text, next_text``: the text of the next row in descending key order, after the last that of the first."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 64).alias("bytes")).first()["bytes"] or 0
    n = max(1, -(-size // SLICE_BYTES))
    cuts: list[int] = []
    if n > 1:
        quantiles = rows.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 100 * n).alias("q")).first()["q"] or []
        cuts = sorted(set(quantiles), reverse=True)
    order = F.xxhash64("text")
    rows = rows.withColumn("slice", _slice(F.col("key").cast("long"), cuts))
    firsts = rows.groupBy("slice").agg(F.max(F.struct("key", order.alias("order"))).alias("head"))
    # One row per slice: the few heads meet in one small window.
    turn = Window.orderBy("slice")
    after = firsts.select(
        "slice", F.coalesce(F.lead("slice").over(turn), F.min("slice").over(turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next_slice")
    )
    heads = firsts.select("slice", F.col("head.key").alias("key"), F.col("head.order").alias("order"))
    head_rows = rows.select("slice", F.col("key").alias("k"), order.alias("o"), "text").join(
        heads.withColumnRenamed("slice", "s"), (F.col("slice") == F.col("s")) & F.col("k").eqNullSafe(F.col("key")) & (F.col("o") == F.col("order"))
    )
    head_texts = head_rows.groupBy("s").agg(F.first("text").alias("head_text"))
    follow = stage(after.join(head_texts, F.col("next_slice") == F.col("s")).select("slice", "head_text"), "heads")
    inside = Window.partitionBy("slice").orderBy(F.desc_nulls_last("key"), order.desc())
    led = rows.withColumn("lead", F.lead("text").over(inside))
    return led.join(follow, "slice").select("key", "text", F.coalesce("lead", "head_text").alias("next_text"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` for every row."""
    chars, cut = F.length("text"), F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.left(F.col("text"), chars - cut), F.when(cut > 0, F.left(F.col("next_text"), cut)).otherwise(""))
    rows = with_next(docs, key, text).select("key", chars.cast("long").alias("n_chars"), "text", edited.alias("edited"), "next_text")
    rows = rows.select(
        "key", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), digests(F.col("text")).alias("a"), digests(F.col("edited")).alias("e"), digests(F.col("next_text")).alias("b")
    )
    made = rows.withColumns({"sa": sketch(F.col("a")), "se": sketch(F.col("e")), "sb": sketch(F.col("b"))})
    made = made.withColumns({"gap_e": peeled(F.col("sa"), F.col("se")), "gap_b": peeled(F.col("sa"), F.col("sb")), "fingerprint": printed(F.col("sa")), "edited_fingerprint": printed(F.col("se"))})
    made = made.drop("sa", "se", "sb")
    for other in ("e", "b"):
        made = _retried(made, F.col("a"), F.col(other), f"gap_{other}", f"rest_{other}")
    sizes = [F.size(c).alias(f"size_{c}") for c in ("a", "e", "b")]
    # No digest is written, but for those of blocks that no turn above could peel.
    first = stage(
        made.select("key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", *sizes, "gap_e", "gap_b", "rest_e", "rest_b", F.monotonically_increasing_id().alias("row")), "sketches"
    )
    parts = [first.select("row", F.lit(c).alias("side"), F.explode(f"rest_{c}").alias("p")).select("row", "side", "p.x", "p.y") for c in ("e", "b")]
    gaps = _rest(parts[0].unionByName(parts[1]))
    if gaps is not None:
        for c in ("e", "b"):
            first = first.join(gaps.where(F.col("side") == c).select("row", F.col("gap").alias(f"more_{c}")), "row", "left")
            first = first.withColumn(f"gap_{c}", F.col(f"gap_{c}") + F.coalesce(f"more_{c}", F.lit(0)))
    return first.select(
        F.col("key").alias(key),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("size_a"), F.col("size_e"), F.col("gap_e")).alias("near_edited"),
        likeness(F.col("size_a"), F.col("size_b"), F.col("gap_b")).alias("near_next"),
    )


def _block(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def _held(blocks: Column) -> Column:
    return F.filter(blocks, lambda p: F.size(p["x"]) + F.size(p["y"]) > 0)


def _dealt(a: Column, b: Column) -> Column:
    """Two sets in as many blocks as they need, by bits of the digests that no cell uses; first in runs of blocks, then each run."""

    def deal(n: Column) -> Column:
        block = lambda d: F.pmod(F.shiftrightunsigned(d, ROWS * _BITS), n)

        def split(width: Column) -> Column:
            run = lambda r: _block(*(F.filter(s, lambda d: F.floor(block(d) / width) == r) for s in (a, b)))
            own = lambda p, j: _block(*(F.filter(p[s], lambda d: F.pmod(block(d), width) == j) for s in "xy"))
            runs = F.transform(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / width)), run)
            return F.flatten(F.transform(runs, lambda p: F.transform(F.sequence(F.lit(0).cast("long"), width - 1), lambda j: own(p, j))))

        return let(F.ceil(F.sqrt(n)).cast("long"), split)

    return _held(let(F.greatest(F.lit(2), F.ceil((F.size(a) + F.size(b)) / BLOCK_LOAD)).cast("long"), deal))


def _quartered(p: Column, turn: int) -> Column:
    """A block cut in ``SPLIT`` by further bits of its digests."""
    # The bits of one hash serve all turns but the last of its 62; then the next hash is taken.
    at = lambda d: F.pmod(F.shiftrightunsigned(F.xxhash64(F.lit(turn // 31), d), 2 * (turn % 31)), F.lit(SPLIT))
    return F.transform(F.sequence(F.lit(0), F.lit(SPLIT - 1)), lambda n: _block(F.filter(p["x"], lambda d: at(d) == n), F.filter(p["y"], lambda d: at(d) == n)))


def _retried(rows: DataFrame, a: Column, b: Column, gap: str, rest: str) -> DataFrame:
    """``gap`` of pairs whose first sketches could not be peeled, from sketches of as many blocks as the sets need; a block
    that cannot be peeled, and no other, is cut anew for ``IN_ROW`` turns. ``rest`` keeps those that are left then; the gap
    does not count them. A pair's blocks stay in its row, so this takes no shuffle."""
    tried = lambda blocks: F.transform(blocks, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), peeled(sketch(p["x"]), sketch(p["y"])).alias("gap")))
    whole = _block(F.array().cast("array<long>"), F.array().cast("array<long>"))
    none = F.filter(F.array(whole), lambda p: F.lit(False))
    blocks = F.when(F.col(gap).isNull(), _dealt(a, b)).otherwise(none)
    for turn in range(IN_ROW + 1):
        rows = rows.withColumn("_blocks", blocks).withColumn("_tried", tried(F.col("_blocks")))
        found = F.aggregate("_tried", F.lit(0).cast("long"), lambda n, p: n + F.coalesce(p["gap"], F.lit(0).cast("long")))
        failed = F.transform(F.filter("_tried", lambda p: p["gap"].isNull()), lambda p: _block(p["x"], p["y"]))
        rows = rows.withColumns({gap: F.coalesce(gap, F.lit(0).cast("long")) + found, rest: failed}).drop("_blocks", "_tried")
        blocks = _held(F.flatten(F.transform(rest, lambda p: _quartered(p, turn))))  # noqa: B023
    return rows


def _rest(failed: DataFrame) -> DataFrame | None:
    """``row, side, gap`` of the blocks ``row, side, x, y`` that could not be peeled in their row, or None without any: each is
    cut anew until all its pieces can be."""
    done, turn = None, IN_ROW
    while not failed.isEmpty():
        parts = failed.select("row", "side", F.explode(_held(_quartered(F.struct("x", "y"), turn))).alias("p")).select("row", "side", "p.x", "p.y")
        tried = stage(parts.withColumn("gap", peeled(sketch(F.col("x")), sketch(F.col("y")))), "blocks")
        good = tried.where("gap is not null").select("row", "side", "gap")
        done = good if done is None else done.unionByName(good)
        failed = tried.where("gap is null").drop("gap")
        turn += 1
    return None if done is None else stage(done.groupBy("row", "side").agg(F.sum("gap").alias("gap")), "gaps")
