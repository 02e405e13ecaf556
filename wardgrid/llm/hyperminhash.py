"""Near-duplicate documents by HyperMinHash sketches, banding and exact confirmation.

A document is its set of ``SHINGLE``-word shingles. One hash per shingle names one of ``BUCKETS`` buckets;
a bucket keeps, of its least second hash, the number of leading zeros (6 bits) and the next 10 bits.
Empty buckets borrow from a fixed order of others, so each band of 5 registers samples five shingles.
40 bands miss a pair at similarity 0.8 with probability (1 - 0.8**5)**40, about 1e-7.

1. Documents with equal sets are one node, so copies never meet in pairs.
2. In each band's group every node is paired with the least node only: rows grow with the input.
   Pairs that the sketches rule out (corrected for chance collisions, five standard deviations) go;
   the others are confirmed on full sets.
3. Components of the confirmed links follow. In groups that still hold nodes of several components, shingles that
   stand in one such node only are counted: they bound what a node and what a pair can reach, and rule out
   loosely related texts. The node with the least share of its own is then paired with its group.
4. What is left: nodes outside a small group's largest component are paired with the rest; large groups
   are compared in blocks, two bounded blocks to a task, by matrix products that emit links only.

Defined cases: null or wordless texts have the empty set and are linked with nothing; fewer words than a
shingle make one; repeated rows are copies; ``kept`` says whether a row bears its component's least doc_id, so rows that share it are
all kept; one row of each component is ``chosen``, the one with the least doc_id (a row without doc_id only if all lack it), then the
least identity, and one of equal rows; the component_id of a component whose rows all lack a doc_id is null; other columns do no
harm; empty tables give none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats, seqhash
from .components import components, extended
from .repeats import staged

SHINGLE, PERCENT = 4, 80
BANDS, ROWS = 40, 5
BUCKETS = BANDS * ROWS
MANTISSA = 10
#: Pairs of a mixed group that are compared one by one; larger groups are compared in blocks of so many nodes.
FEW_PAIRS, BLOCK = 256, 256
#: Equal rows that one generated array numbers.
EQUAL = 1 << 12

_U = np.uint64
_SKETCH = "doc_id long, doc long, mark long, n_shingles long, node long, sketch binary"


def shingle_sets(data: np.ndarray, at: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and where each text's begin."""
    data = seqhash.lower_ascii(data)
    starts, ends, before = seqhash.word_bounds(data, at)
    rolling = seqhash.Rolling(seqhash.word_hashes(data, starts, ends))
    words = np.diff(before)
    count = np.where(words == 0, 0, np.maximum(words - shingle + 1, 1))
    of = np.repeat(np.arange(len(words)), count)
    first = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + before[of]
    hashes = rolling.stretch(first, np.minimum(first + shingle, before[of + 1]))
    order = np.lexsort((hashes, of))
    of, hashes = of[order], hashes[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[new], np.searchsorted(of[new], np.arange(len(words) + 1))


def sketches(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of registers per text; 0 is an empty bucket."""
    texts = len(at) - 1
    of = np.repeat(np.arange(texts), np.diff(at))
    cell = of * BUCKETS + (((hashes >> _U(32)) * _U(BUCKETS)) >> _U(32)).astype(np.int64)
    second = seqhash.mix(hashes ^ _U(0xA0761D6478BD642F))
    order = np.lexsort((second, cell))
    cell, second = cell[order], second[order]
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    least = second[first] | _U(1)
    _, length = np.frexp((least >> _U(11)).astype(np.float64))  # exact: 53 bits
    zeros = 53 - length
    next_bits = (least << (zeros + 1).astype(_U)) >> _U(64 - MANTISSA)
    out = np.zeros(texts * BUCKETS, np.uint16)
    out[cell[first]] = ((zeros + 1) << MANTISSA) + next_bits.astype(np.int64)
    return out.reshape(texts, BUCKETS)


def _borrowing() -> np.ndarray:
    """For each bucket the order in which it looks for a full one; itself first."""
    rows = np.arange(BUCKETS)
    order = np.argsort(seqhash.mix((rows[:, None] * BUCKETS + rows + 1).astype(_U)), axis=1)
    itself = np.argsort(order != rows[:, None], axis=1, kind="stable")
    return np.take_along_axis(order, itself, axis=1)


def bands(registers: np.ndarray) -> np.ndarray:
    """One hash per band of each row; rows must not be empty."""
    look, full = _borrowing(), registers.copy()
    for step in range(1, 12):
        if full.all():
            break
        full = np.where(full == 0, registers[:, look[:, step]], full)
    for row in np.flatnonzero((full == 0).any(axis=1)):
        full[row] = registers[row][look[np.arange(BUCKETS), (registers[row][look] != 0).argmax(axis=1)]]
    full = full.reshape(len(full), BANDS, ROWS).astype(_U)
    h = seqhash.mix(full[:, :, 0] | full[:, :, 1] << _U(16) | full[:, :, 2] << _U(32) | full[:, :, 3] << _U(48))
    return seqhash.mix(h ^ (full[:, :, 4] | np.arange(1, BANDS + 1, dtype=_U) << _U(16)) * _U(0x9E3779B97F4A7C15))


def _described(docs: DataFrame, shingle: int) -> DataFrame:
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, at in seqhash.slices(batch["text"]):
                hashes, begins = shingle_sets(data, at, shingle)
                sizes = np.diff(begins)
                sums = np.zeros(len(hashes) + 1, _U)
                np.cumsum(seqhash.mix(hashes + _U(1)), dtype=_U, out=sums[1:])
                node = seqhash.mix((sums[begins[1:]] - sums[begins[:-1]]) ^ sizes.astype(_U))
                sketch = [r.tobytes() for r in sketches(hashes, begins)]
                part = batch.slice(row, len(sizes))
                columns = [*(part[c] for c in ("doc_id", "doc", "mark")), pa.array(sizes), pa.array(seqhash.signed(node)), pa.array(sketch, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _SKETCH.split(", ")])

    return repeats.identified_with_id(docs).mapInArrow(describe, _SKETCH)


def _banded(nodes: DataFrame) -> DataFrame:
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                part = batch.slice(low, 2000)
                registers = np.frombuffer(b"".join(part["sketch"].to_pylist()), np.uint16).reshape(-1, BUCKETS)
                keys = seqhash.signed(bands(registers).ravel())
                node = np.repeat(part["node"].to_numpy(), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(node)], names=["band", "node"])

    return nodes.select("node", "sketch").mapInArrow(explode, "band long, node long")


def estimate(one: np.ndarray, two: np.ndarray, n_one: np.ndarray, n_two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Similarity of rows of registers without what chance collisions add, and its standard deviation at 0.8."""
    filled = np.maximum(((one != 0) | (two != 0)).sum(axis=1), 1)
    agree = ((one == two) & (one != 0)).sum(axis=1) / filled
    zeros = np.arange(40)
    load = [np.maximum(n, 1)[:, None] / BUCKETS for n in (n_one, n_two)]
    exactly = [np.exp(-x * 2.0 ** -(zeros + 1)) - np.exp(-x * 2.0**-zeros) for x in load]
    chance = (exactly[0] * exactly[1]).sum(axis=1) / 2**MANTISSA
    return (agree - chance) / (1 - chance), np.sqrt(0.16 / filled)


def _plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs that sketches and sizes do not rule out."""
    side = lambda end: nodes.select(F.col("node").alias(end), F.col("sketch").alias(f"sketch_{end}"), F.col("n_shingles").alias(f"n_{end}"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (np.frombuffer(b"".join(batch[f"sketch_{e}"].to_pylist()), np.uint16).reshape(-1, BUCKETS) for e in "ab")
            sizes = [batch[f"n_{e}"].to_numpy() for e in "ab"]
            likely, deviation = estimate(one, two, *sizes)
            keep = (likely >= percent / 100 - 5 * deviation) & (100 * np.minimum(*sizes) >= percent * np.maximum(*sizes))
            yield pa.RecordBatch.from_arrays([batch["a"].filter(pa.array(keep)), batch["b"].filter(pa.array(keep))], names=["a", "b"])

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(judge, "a long, b long")


def _sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(node, items): the full sets of the wanted nodes, sorted, from one document of each."""
    places = nodes.join(wanted, "node", "left_semi").select("node", "place.doc", "place.mark")
    texts = repeats.identified(docs).join(places, ["doc", "mark"]).select("node", "text")

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, at in seqhash.slices(batch["text"]):
                hashes, begins = shingle_sets(data, at, shingle)
                sets = [hashes[a:b].tobytes() for a, b in zip(begins[:-1], begins[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch["node"].slice(row, len(sets)), pa.array(sets, pa.binary())], names=["node", "items"])

    return texts.mapInArrow(full_sets, "node long, items binary").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are as similar as asked for."""
    side = lambda end: sets.select(F.col("node").alias(end), F.col("items").alias(f"items_{end}"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["items_a"], batch["items_b"], strict=True):
                one, two = (np.frombuffer(v.as_buffer(), _U) for v in (x, y))
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(mask), batch["b"].filter(mask)], names=["a", "b"])

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(confirm, "a long, b long")


def _sharing(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, size, shared): how many shingles each wanted node has, and how many of them stand in another one too.

    Shingles are counted with one row per shingle and task.
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, items in zip(batch["node"], batch["items"], strict=True):
                own = np.frombuffer(items.as_buffer(), _U)
                of = np.full(len(own), node.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(seqhash.signed(own))], names=["node", "item"])

    each = sets.join(wanted, "node", "left_semi").mapInArrow(explode, "node long, item long")
    alone = each.groupBy("item").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1")
    alone = alone.groupBy("node").agg(F.count("*").alias("alone"))
    sizes = sets.join(wanted, "node", "left_semi").select("node", (F.octet_length("items") / 8).cast("long").alias("size"))
    return sizes.join(alone, "node", "left").select("node", "size", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("shared"))


def _may_link(one: str, two: str, percent: int) -> str:
    """SQL condition: sizes and shared shingles of two nodes allow the similarity asked for."""
    most = f"least({one}shared, {two}shared)"
    return f"100 * {most} >= {percent} * ({one}size + {two}size - {most})"


def _mixed(rooted: DataFrame) -> DataFrame:
    """Groups with nodes of several components: band, main (the largest component), all (its nodes), outside (nodes of others)."""
    sizes = rooted.groupBy("band", "root").agg(F.count("*").alias("n"))
    return (
        sizes.groupBy("band")
        .agg(F.count("*").alias("roots"), F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("all"))
        .where("roots > 1")
        .select("band", F.col("top.root").alias("main"), "all", (F.col("all") - F.col("top.n")).alias("outside"))
    )


def _crowds(banded: DataFrame, roots: DataFrame, sharing: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (band, node, root, size, shared) of mixed groups whose node may still be linked, and ``_mixed`` of them."""
    rooted = _with_root(banded, roots).join(sharing, "node").where(f"100 * shared >= {percent} * size")
    rooted = staged(rooted, "rooted")
    mixed = staged(_mixed(rooted), "mixed")
    return staged(rooted.join(mixed.select("band"), "band", "left_semi"), "meeting"), mixed


def _central_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Each group's node with the least share of shingles of its own, with the group's nodes of other components."""
    order = F.struct((F.col("shared") / F.col("size")).alias("share"), (-F.col("node")).alias("order"), "node", "root", "size", "shared")
    centre = staged(rows.groupBy("band").agg(F.max(order).alias("centre")).select("band", "centre.*").drop("order", "share").toDF("band", "c_node", "c_root", "c_size", "c_shared"), "centres")
    met = rows.join(centre, "band").where("root <> c_root").where(_may_link("", "c_", percent))
    return met.select(F.least("c_node", "node").alias("a"), F.greatest("c_node", "node").alias("b")).distinct()


def _outsider_pairs(rows: DataFrame, mixed: DataFrame, percent: int) -> DataFrame:
    """Pairs across components in small groups, of nodes outside the largest component with the others."""
    return _across(rows, mixed.where(F.col("outside") * F.col("all") <= FEW_PAIRS), percent).distinct()


def _links_in_blocks(rows: DataFrame, mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across components in large groups, found block by block.

    Groups with one largest component form a unit; its nodes are dealt to blocks of about ``BLOCK``. A task
    holds two blocks and counts the common shingles of all their nodes by matrix products; only links leave it.
    """
    large = mixed.where(F.col("outside") * F.col("all") > FEW_PAIRS).select("band", "main")
    unit = staged(rows.join(large, "band").select("main", "node", "root").distinct(), "units")
    many = unit.groupBy("main").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    placed = unit.join(many, "main").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).join(sets, "node")
    blocks = staged(placed.groupBy("main", "block").agg(F.collect_list(F.struct("node", "root", "items")).alias("nodes")), "blocks")
    one = blocks.select("main", F.col("block").alias("one"), F.col("nodes").alias("nodes_a"))
    two = blocks.select("main", F.col("block").alias("two"), F.col("nodes").alias("nodes_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch["nodes_a"], batch["nodes_b"], strict=True):
                (node_x, root_x, items_x), (node_y, root_y, items_y) = (
                    (v.values.field("node").to_numpy(), v.values.field("root").to_numpy(), [np.frombuffer(b.as_buffer(), _U) for b in v.values.field("items")]) for v in (x, y)
                )
                both = _common(items_x, items_y)
                sizes = [np.array([len(s) for s in items]) for items in (items_x, items_y)]
                linked = 100 * both >= percent * (sizes[0][:, None] + sizes[1] - both)
                i, k = np.nonzero(linked & (root_x[:, None] != root_y))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node_x[i], node_y[k])), pa.array(np.maximum(node_x[i], node_y[k]))], names=["a", "b"])

    return one.join(two, "main").where("one <= two").select("nodes_a", "nodes_b").mapInArrow(compare, "a long, b long").distinct()


def _common(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many items each set of ``one`` shares with each set of ``two``."""
    shared = np.intersect1d(np.unique(np.concatenate(one)), np.unique(np.concatenate(two)), assume_unique=True)
    found = np.zeros((len(one), len(two)), np.int64)
    for low in range(0, len(shared), 8192):
        part = shared[low : low + 8192]
        sides = []
        for sets in (one, two):
            table = np.zeros((len(sets), len(part)), np.float32)
            for row, items in enumerate(sets):
                at = np.searchsorted(part, items)
                at = at[(at < len(part)) & (part[np.minimum(at, len(part) - 1)] == items)]
                table[row, at] = 1
            sides.append(table)
        found += (sides[0] @ sides[1].T).astype(np.int64)
    return found


def _across(rows: DataFrame, mixed: DataFrame, percent: int) -> DataFrame:
    rows = rows.join(mixed.select("band", "main"), "band")
    outside = rows.where("root <> main").select("band", *(F.col(c).alias(f"x_{c}") for c in ("node", "root", "size", "shared")))
    meet = outside.join(rows, "band").where("x_root <> root and (root = main or x_node < node)").where(_may_link("", "x_", percent))
    return meet.select(F.least("x_node", "node").alias("a"), F.greatest("x_node", "node").alias("b"))


def _with_root(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (least doc_id reachable over links), kept (whether that is its own doc_id; null
    equals null here) and chosen (one row of each component, also where rows share a doc_id)."""
    described, named = _named(docs, shingle, percent)
    empty = described.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("chosen"))
    alike = ["doc_id", "n_shingles", "node", "doc", "mark"]
    equal = described.where("n_shingles > 0").groupBy(alike).agg(F.count("*").alias("rows"))
    numbered = equal.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(EQUAL).cast("long"))))
    numbered = numbered.withColumn("number", F.explode(F.sequence("from", F.least(F.col("rows"), F.col("from") + EQUAL) - 1)))
    chosen = (F.col("number") == 0) & (F.col("doc") == F.col("chosen.doc")) & (F.col("mark") == F.col("chosen.mark"))
    full = numbered.join(named, "node").select("doc_id", "n_shingles", F.col("chosen.doc_id").alias("component_id"), chosen.alias("chosen"))
    found = full.unionByName(empty)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "chosen")


def representatives(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc, mark) of the row that each component of documents with words keeps; rows equal to it share them."""
    return _named(docs, shingle, percent)[1].select("chosen.doc", "chosen.mark").distinct()


def _named(docs: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The described documents, and (node, chosen): the row of the node's component that is kept."""
    described = staged(_described(docs, shingle), "described")
    nodes = staged(
        described.where("n_shingles > 0")
        .groupBy("node")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("lacks"), "doc_id", "doc", "mark")).alias("place"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")),
        "nodes",
    )
    banded = staged(_banded(nodes), "bands")
    groups = staged(banded.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("hub")).where("n > 1").select("band", "hub"), "hubs")
    banded = staged(banded.join(groups, "band"), "groups")
    sets = staged(_sets(banded.select("node").distinct(), nodes, docs, shingle), "sets")
    hubs = banded.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    first = staged(_plausible(hubs, nodes, percent), "pairs")
    links = staged(_confirmed(first, sets, percent), "links")
    roots = staged(components(links), "roots")
    banded = banded.drop("hub")
    met = _with_root(banded, roots)
    met = staged(met.join(_mixed(met).select("band"), "band", "left_semi").select("node").distinct(), "met")
    sharing = staged(_sharing(sets, met), "sharing")
    rows, _ = _crowds(banded, roots, sharing, percent)
    central = _central_pairs(rows, percent).join(first, ["a", "b"], "left_anti")
    central = staged(_plausible(central, nodes, percent), "central")
    roots = staged(extended(roots, _confirmed(central, sets, percent)), "roots")
    rows, mixed = _crowds(banded, roots, sharing, percent)
    second = _outsider_pairs(rows, mixed, percent).join(first, ["a", "b"], "left_anti").join(central, ["a", "b"], "left_anti")
    second = staged(_plausible(second, nodes, percent), "second")
    more = _confirmed(second, sets, percent).unionByName(_links_in_blocks(rows, mixed, sets, percent))
    roots = staged(extended(roots, more), "roots")
    rooted = _with_root(nodes.select("node", "place"), roots)
    least = staged(rooted.groupBy("root").agg(F.min("place").alias("chosen")), "least")
    return described, staged(rooted.join(least, "root").select("node", "chosen"), "named")
