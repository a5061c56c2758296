"""Near-duplicate documents by DartMinHash signatures, banded joining and exact checks.

A document is the weighted set of its five-word shingles (fewer words: one shingle of
all), weight = number of occurrences. Element e with weight w owns the region
[0, w) x [0, inf); hashed darts fall on it as a Poisson process: one for each unit of
weight and rank on average, the same for every document that holds the element. Each
dart names one of ``COORDINATES`` coordinates, and a coordinate keeps the dart of least
rank, so two documents agree in a coordinate with the probability of their weighted
Jaccard similarity. Only ranks up to about k (ln k + 2) / weight are looked at, more
where a coordinate stays empty.

Texts that agree in all words are one node. Nodes that share a band of the signature are
candidates. In each bucket all nodes are checked against one leader, another in each
band. Buckets with a node that isn't linked with the leader check all nodes against the one with the
least share of shingles that nobody else has, and the links found are closed to components. Then every
pair of one bucket in two components is checked too, but for those whose common shingles can't
be enough by two upper bounds, so within the buckets no link is lost although groups of copies are not expanded into pairs. Links need an exact weighted Jaccard
similarity of ``similarity`` (0.8). A pair at 0.8 misses all buckets with a chance of
(1 - 0.8^ROWS)^BANDS = 5e-5.

Texts without words (null and empty ones too) are no duplicates of anything. Repeated
rows are copies. Columns beyond id and text don't matter and clash with nothing.
Nodes have 64-bit hashes of all words as names; two texts meet by chance with n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqframe.llm.common import HEAVY, Tokens, add_columns, field, heavy_keys, mix, quoted, rolling, spread_join, written

SHINGLE = 5
ROWS, BANDS = 5, 25
COORDINATES = ROWS * BANDS
#: Cells whose darts are thrown at once.
DARTS_TOGETHER = 1 << 18
#: Bytes of a stored cell: two texts of a million words have about one false cell in common.
CELL_BYTES = 5
#: Links that one task of a round of components takes, so that few links make few tasks.
LINKS_TOGETHER = 500_000
#: Nodes of a bucket that one task compares with the others.
COMPARED_TOGETHER = 256
#: 64-bit words of the bitmaps that bound what two sets have in common.
BITMAP_WORDS = 32
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 16)]))


def weighted_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name of each text, its cells, where each text's cells begin): a cell is one unit of one element's weight.

    Cells of a text are in ascending order of their hash.
    """
    t = Tokens(texts)
    counts = np.diff(t.first)
    with np.errstate(over="ignore"):
        place = np.arange(len(t.hash)) - np.repeat(t.first[:-1], counts)
        powers = np.cumprod(np.full(int(counts.max(initial=0)) + 1, 0x5851F42D4C957F2D, np.uint64))
        total = np.concatenate(([np.uint64(0)], np.cumsum(t.hash * powers[place], dtype=np.uint64)))
        names = mix(total[t.first[1:]] - total[t.first[:-1]] + counts.astype(np.uint64))
    shingles = rolling(t.hash, SHINGLE)
    text = np.repeat(np.arange(len(counts)), counts)
    inside = place + SHINGLE <= counts[text] if len(text) else np.empty(0, bool)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    owner = np.concatenate((text[inside], short))
    value = np.concatenate((shingles[inside], names[short]))
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    at = np.arange(len(value))
    repeat = at - np.maximum.accumulate(np.where(fresh, at, 0)) if len(value) else at
    with np.errstate(over="ignore"):
        cells = mix(value + repeat.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    first = np.searchsorted(owner, np.arange(len(counts) + 1))
    return names, cells, first


def signatures(cells: np.ndarray, first: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """(texts, k) darts kept by each coordinate; a text without cells has the largest value everywhere."""
    sizes = np.diff(first)
    out = np.full(len(sizes) * k, np.iinfo(np.uint64).max, np.uint64)
    need = k * (np.log(k) + 2)
    todo, begin = np.flatnonzero(sizes > 0), np.zeros(len(sizes), np.int64)
    end = np.where(sizes > 0, np.maximum(1, np.ceil(need / np.maximum(1, sizes))), 0).astype(np.int64)
    while len(todo):
        layers = end[todo] - begin[todo]
        # every cell of the texts still to do, once for each unit of rank, a bounded number at a time
        ends = np.cumsum(sizes[todo] * layers)
        for low in range(0, int(ends[-1]), DARTS_TOGETHER):
            flat = np.arange(low, min(low + DARTS_TOGETHER, int(ends[-1])))
            which = np.searchsorted(ends, flat, side="right")
            owner = todo[which]
            within = flat - (ends[which] - sizes[owner] * layers[which])
            layer = within // sizes[owner] + begin[owner]
            cell = cells[first[owner] + within % sizes[owner]]
            with np.errstate(over="ignore"):
                seed = mix(cell + layer.astype(np.uint64) * np.uint64(0xA24BAED4963EE407) + np.uint64(1))
            darts = np.searchsorted(_POISSON, (seed >> np.uint64(11)).astype(np.float64) / float(1 << 53))
            owner, layer, seed = np.repeat(owner, darts), np.repeat(layer, darts), np.repeat(seed, darts)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(darts) - darts, darts)
            with np.errstate(over="ignore"):
                dart = mix(seed + (nth.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
            rank = (layer.astype(np.uint64) << np.uint64(44)) | (dart >> np.uint64(20))
            coordinate = (mix(dart) % np.uint64(k)).astype(np.int64)
            np.minimum.at(out, owner * k + coordinate, rank)
        empty = (out.reshape(-1, k)[todo] == np.iinfo(np.uint64).max).any(axis=1)
        todo = todo[empty]
        begin[todo], end[todo] = end[todo], 2 * end[todo]
    return out.reshape(-1, k)


def bands(kept: np.ndarray) -> np.ndarray:
    """(texts, BANDS) hashes of the rows of each band."""
    blocks = kept.reshape(len(kept), BANDS, ROWS)
    with np.errstate(over="ignore"):
        out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(kept), BANDS)).copy()
        for row in range(ROWS):
            out = mix(out * np.uint64(0xD6E8FEB86659FD93) + blocks[:, :, row])
    return out


def signed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, node, n, bands, cells) of each document; cells are the leading bytes of hashes."""

    def make():
        def step(texts: pa.Array):
            names, cells, first = weighted_sets(texts)
            sizes = np.diff(first)
            keys = bands(signatures(cells, first)).view(np.int64)
            packed = np.ascontiguousarray(cells.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - CELL_BYTES :])
            rows = [packed[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.where(sizes > 0, BANDS, 0)))), pa.int32()), pa.array(keys[sizes > 0].reshape(-1)))
            return [pa.array(names.view(np.int64)), pa.array(sizes.astype(np.int32)), lists, pa.array(rows, pa.binary())]

        return step

    fields = [field("node", "bigint"), field("n", "int"), field("bands", "array<bigint>"), field("cells", "binary")]
    return add_columns(docs.select(F.col(quoted(doc_id)).alias("id"), F.col(quoted(text)).alias("__body")), "__body", fields, make, drop_text=True)


def unpacked(cells: pa.Scalar) -> np.ndarray:
    raw = np.frombuffer(cells.as_buffer(), np.uint8).reshape(-1, CELL_BYTES)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :CELL_BYTES] = raw
    return wide.view("<u8").reshape(-1)


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those pairs (a, b) of a table whose sets have an exact weighted Jaccard similarity of at least ``similarity``."""
    left = sets.select(F.col("node").alias("a"), F.col("cells").alias("cells_a"))
    right = sets.select(F.col("node").alias("b"), F.col("cells").alias("cells_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("cells_a"), batch.column("cells_b"), strict=True):
                both = np.concatenate((unpacked(x), unpacked(y)))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(shared >= similarity * (len(both) - shared) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    heavy = heavy_keys(pairs, "a", "b")
    joined = spread_join(spread_join(pairs, left, "a", heavy), right, "b", heavy)
    return joined.select("a", "b", "cells_a", "cells_b").mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node of each connected component, for all nodes with a link.

    Large-star and small-star steps alternate, each written to the shared folder, until nothing changes.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")

    def degrees(rows: DataFrame, side: str):
        """(edges, a sum over their hashes, most edges of one node on that side)"""
        one = rows.groupBy(side).agg(F.count("*").alias("c"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
        return one.agg(F.coalesce(F.sum("c"), F.lit(0)), F.sum("h"), F.coalesce(F.max("c"), F.lit(0))).first()

    def with_least(rows: DataFrame, spread: float | None) -> DataFrame:
        """rows (u, v) with m, the least v of each u."""
        if spread is None:
            return rows.withColumn("m", F.min("v").over(Window.partitionBy("u")))
        least = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("c"))
        return spread_join(rows, least.drop("c"), "u", least.filter(F.col("c") > spread).select(F.col("u").alias("key")))

    state = degrees(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "u")
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # hubs are dealt over tasks
        limit = max(2 * state[0] / HEAVY, HEAVY)
        spread = limit if state[2] > limit else None
        tasks = max(8, int(state[0] // LINKS_TOGETHER))
        large = with_least(both, spread).coalesce(tasks).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        # of each node's smaller neighbours all but the least go to the least
        small = with_least(large, spread).coalesce(tasks).select(F.explode(F.array("u", "v")).alias("e"), "m").select(F.col("e").alias("u"), F.col("m").alias("v"))
        small = small.filter("u <> v").distinct().coalesce(tasks)
        edges = written(small, "links")
        now = degrees(edges, "v")
        if now[:2] == state[:2]:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _in_mixed_buckets(rows: DataFrame, roots: DataFrame, heavy: DataFrame | None) -> DataFrame:
    """Bucket rows with the root of their node and the bucket's number of nodes, of those buckets that hold more than one root."""
    placed = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).drop("leader", "leader_n", "size")
    mixed = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size")).filter("lo < hi").select("key", "size")
    return spread_join(placed, mixed, "key", heavy)


def unique_mass(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, alone): cells of each of the nodes that none of the others has; nodes without such are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, cells in zip(batch.column("node").to_pylist(), batch.column("cells"), strict=True):
                values = unpacked(cells).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), node, np.int64)), pa.array(values)], names=["node", "cell"])

    rows = sets.join(nodes, "node", "left_semi").select("node", "cells").mapInArrow(run, "node bigint, cell bigint")
    once = rows.groupBy("cell").agg(F.count("*").alias("c"), F.min("node").alias("node")).filter("c = 1")
    return once.groupBy("node").agg(F.count("*").alias("alone"))


def _bitmaps(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, bits, m0, m1, ...): a bitmap of BITMAP_WORDS words with a bit for each cell's hash, and how many bits are set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, bits = [], []
            for cells in batch.column("cells"):
                place = unpacked(cells) % np.uint64(64 * BITMAP_WORDS)
                marks = np.zeros(64 * BITMAP_WORDS, np.uint8)
                marks[place] = 1
                words.append(np.packbits(marks).view(np.int64))
                bits.append(int(marks.sum()))
            columns = np.array(words, np.int64).reshape(len(words), BITMAP_WORDS).T
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(bits, pa.int32()), *[pa.array(c) for c in columns]], names=["node", "bits", *[f"m{k}" for k in range(BITMAP_WORDS)]])

    schema = "node bigint, bits int, " + ", ".join(f"m{k} bigint" for k in range(BITMAP_WORDS))
    return sets.join(nodes, "node", "left_semi").select("node", "cells").mapInArrow(run, schema)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(documents, links): one row (id, node, root, n) for each document, and the links (a, b) between nodes.

    Documents with the same root are one group.
    """
    table = written(signed(docs, doc_id, text), "signatures")
    keys = table.filter("n > 0").select(F.explode("bands").alias("key"), "node", "n").groupBy("key", "node").agg(F.min("n").alias("n"))
    keys = written(keys, "keys")
    heavy = heavy_keys(keys, "key")
    chosen = keys.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "node"), "node", "n")).alias("lead"), F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("key", F.col("lead.node").alias("leader"), F.col("lead.n").alias("leader_n"))
    buckets = written(spread_join(keys, chosen, "key", heavy).select("key", "node", "n", "leader", "leader_n"), "buckets")
    near = lambda x, y: F.least(x, y) >= similarity * F.greatest(x, y)
    first = written(buckets.filter((F.col("node") != F.col("leader")) & near("n", "leader_n")).select(F.greatest("node", "leader").alias("a"), F.least("node", "leader").alias("b")).distinct(), "pairs")
    # one row with cells for each node that is in a bucket with others
    wanted = buckets.select("node").distinct()
    # copies of a node meet before the shuffle; an inner join, because a semi join would be moved before the aggregation
    sets = table.filter("n > 0").groupBy("node").agg(F.first("cells").alias("cells")).join(wanted, "node")
    sets = written(sets, "sets")
    links = written(similar(first, sets, similarity), "similar")
    # buckets with a node that isn't linked with the leader: their nodes meet the one with the least unique share, which edited copies are nearest to
    tied = links.select(F.col("a").alias("l_a"), F.col("b").alias("l_b"))
    apart = buckets.withColumn("l_a", F.greatest("node", "leader")).withColumn("l_b", F.least("node", "leader")).join(tied.withColumn("tied", F.lit(True)), ["l_a", "l_b"], "left").drop("l_a", "l_b")
    apart = apart.withColumn("apart", F.col("tied").isNull() & (F.col("node") != F.col("leader"))).drop("tied")
    open_ = apart.groupBy("key").agg(F.max("apart").alias("open"), F.count("*").alias("size")).filter("open").drop("open")
    placed = spread_join(apart, open_, "key", heavy).select("key", "node", "n", "leader", "apart", "size")
    placed = written(placed.join(unique_mass(sets, placed.select("node").distinct()), "node", "left").withColumn("shared", F.col("n") - F.coalesce("alone", F.lit(0))), "mixed")
    best = placed.groupBy("key").agg(F.min(F.struct(-F.col("shared") / F.col("n"), "node", "n")).alias("b")).select("key", F.col("b.node").alias("node_"), F.col("b.n").alias("n_"))
    second = spread_join(placed, best, "key", heavy).filter((F.col("node") != F.col("node_")) & near("n", "n_")).select(F.greatest("node", "node_").alias("a"), F.least("node", "node_").alias("b")).distinct()
    second = written(second.join(first, ["a", "b"], "left_anti"), "pairs")
    links = links.unionByName(written(similar(second, sets, similarity), "similar"))
    roots = components(links)
    # pairs of a bucket that lie in two components, where what both share with any other node could be enough:
    # |x and y| is at most the shared part of either, and a similarity s needs s / (1 + s) of both sizes
    placed = written(_in_mixed_buckets(placed.select("key", "node", "n", "shared"), roots, heavy), "mixed")
    # and it is at most the number of common bits of two bitmaps, and of cells that share a bit with another of their text
    placed = placed.join(_bitmaps(sets, placed.select("node").distinct()), "node")
    maps = [f"m{k}" for k in range(BITMAP_WORDS)]
    # nodes of a bucket meet in blocks: a node is in one block, and goes to all blocks of its bucket to be compared
    blocks = F.ceil(F.col("size") / COMPARED_TOGETHER)
    mine = placed.withColumn("block", F.pmod(F.xxhash64("node"), blocks))
    other = placed.select("key", *[F.col(c).alias(c + "_") for c in ("node", "n", "root", "shared", "bits", *maps)], F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"))
    least = similarity / (1 + similarity) * (F.col("n") + F.col("n_")) - 1e-9
    common = reduce(lambda a, b: a + b, [F.bit_count(F.col(m).bitwiseAND(F.col(m + "_"))) for m in maps])
    enough = (F.least("shared", "shared_") >= least) & (common + F.least(F.col("n") - F.col("bits"), F.col("n_") - F.col("bits_")) >= least)
    rest = mine.join(other, ["key", "block"]).filter((F.col("root") < F.col("root_")) & near("n", "n_") & enough).select(F.greatest("node", "node_").alias("a"), F.least("node", "node_").alias("b")).distinct()
    rest = written(rest.join(first, ["a", "b"], "left_anti").join(second, ["a", "b"], "left_anti"), "pairs")
    more = written(similar(rest, sets, similarity), "similar")
    if not more.head(1):
        return _with_roots(table, roots), links
    # the last links join components, of which there are far fewer than nodes
    named = roots.withColumnRenamed("root", "to")
    lifted = more
    for side in ("a", "b"):
        lifted = lifted.join(named.withColumnRenamed("node", side), side, "left").withColumn(side, F.coalesce("to", side)).drop("to")
    over = components(lifted.select("a", "b")).select(F.col("node").alias("root"), F.col("root").alias("top"))
    final = roots.join(over, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    final = final.unionByName(over.join(roots.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), F.col("top").alias("root")))
    return _with_roots(table, final), links.unionByName(more)


def _with_roots(table: DataFrame, roots: DataFrame) -> DataFrame:
    """(id, node, root, n) of each document, stored."""
    rows = table.select("id", "node", "n")
    return written(spread_join(rows, roots, "node", heavy_keys(rows, "node"), "left").select("id", "node", F.coalesce("root", "node").alias("root"), "n"), "documents")


def group_classes(documents: DataFrame) -> DataFrame:
    """(doc_id, class_id, class_size): the least id of the group and its number of documents."""
    sizes = documents.filter("n > 0").groupBy("root").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"))
    joined = spread_join(documents, sizes, "root", heavy_keys(documents, "root"), "left")
    alone = F.col("n") == 0
    return joined.select(F.col("id").alias("doc_id"), F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.when(alone, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = 0.8) -> DataFrame:
    """The documents with one of each group left, that of least id, with their own columns."""
    documents, _ = near_duplicates(docs, doc_id, text, similarity)
    kept = documents.filter("n > 0").groupBy("root").agg(F.min(F.struct("id", "node")).alias("k")).select(F.col("k.id").alias("id"), F.col("k.node").alias("node"))
    kept = written(kept, "kept")

    def make():
        def step(texts: pa.Array):
            t = weighted_sets(texts)
            return [pa.array(t[0].view(np.int64)), pa.array(np.diff(t[2]).astype(np.int32))]

        return step

    body = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"), F.col(quoted(text)).alias("__body"), F.col(quoted(doc_id)).alias("id"))
    named = add_columns(body, "__body", [field("node", "bigint"), field("n", "int")], make, drop_text=True)
    doubled = documents.filter("n > 0").groupBy("id", "node").count().filter("count > 1").select("id", "node")
    flagged = kept.join(doubled.withColumn("many", F.lit(True)), ["id", "node"], "left")
    flagged = flagged.select(F.col("id").alias("k_id"), F.col("node").alias("k_node"), F.coalesce("many", F.lit(False)).alias("many"))
    left = named.join(flagged, F.col("id").eqNullSafe(F.col("k_id")) & (F.col("node") == F.col("k_node")), "left").filter(F.col("k_node").isNotNull() | (F.col("n") == 0))
    single = left.filter(~F.coalesce("many", F.lit(False)))
    # rows of one id and text: any one of them
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(64))
    many = left.filter(F.coalesce("many", F.lit(False))).withColumn("salt", salt)
    for keys in (["id", "node", "salt"], ["id", "node"]):
        many = many.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(1)))).filter("r = 1").drop("r")
    return single.select("row.*").unionByName(many.select("row.*")) if flagged.filter("many").head(1) else left.select("row.*")
