"""Near duplicates: a Jaccard self-join of word five-grams by MinHash banding.

Texts with the same set of five-grams are one node, so copies are never expanded. Nodes that
share a band's hash meet in a bucket; buckets with the same members in several bands are kept
once. Every pair in a kept bucket is compared on the full sets, and counted in the first band that
brings it together. A bucket's texts are dealt to blocks, and two blocks make a tile, which one task
compares. A large bucket has SPREAD blocks, so that its pairs are spread over tasks and each text
goes to SPREAD tiles; only beyond a bound in bytes or texts does it have more. A tile gives each
text's number of links and its component in the tile, never pairs. Tiles' components are merged to
classes by contraction, which shrinks the graph each round.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import U64, Words, map_slices, mix, slices, text_bytes, written

SHINGLE = 5
#: Texts of a bucket that a block holds before the bucket is cut, and the blocks it is cut into.
TILE, SPREAD = 128, 8
#: Bytes of sets and texts that a block holds at most, on average; larger buckets have more blocks.
BLOCK_BYTES, BLOCK_TEXTS = 8 << 20, 4096
#: Texts whose pairs are compared at a time within a tile.
SIDE = 512


def choose_bands(threshold: float = 0.8, rows: int = 5, recall: float = 0.998) -> int:
    """Bands of ``rows`` values so that a pair at the threshold meets with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Sorted distinct hashes of the five-word runs of each text.

    A text of one to four words has one, of all its words; a text without words has none.
    """
    words = Words(*text_bytes(column))
    grams, room = words.grams(SHINGLE)
    out = []
    for a, b, n in zip(words.first[:-1].tolist(), words.first[1:].tolist(), words.counts.tolist()):
        if n >= SHINGLE:
            out.append(np.unique(grams[a : b - SHINGLE + 1]))
        elif n:
            acc = np.array([n], U64)
            for h in words.hashes[a:b]:
                acc = mix(acc ^ h)
            out.append(acc)
        else:
            out.append(np.zeros(0, U64))
    return out


class Banding:
    """Band hashes and set digests of shingle sets."""

    def __init__(self, bands: int, rows: int, seed: int = 7):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.bands, self.rows = bands, rows
        self.xor = draw.integers(0, 1 << 63, bands * rows, dtype=U64)
        self.times = draw.integers(0, 1 << 63, bands * rows, dtype=U64) * U64(2) + U64(1)

    def of(self, sets: list[np.ndarray]) -> np.ndarray:
        """(texts, bands) hashes; a row of an empty set means nothing."""
        sizes = np.array([len(x) for x in sets], np.int64)
        some = np.flatnonzero(sizes)
        out = np.zeros((len(sets), self.bands), U64)
        if not len(some):
            return out
        every, starts = np.concatenate([sets[k] for k in some]), np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
        for band in range(self.bands):
            acc = np.full(len(some), band + 1, U64)
            for k in range(band * self.rows, (band + 1) * self.rows):
                acc = mix(acc ^ np.minimum.reduceat((every ^ self.xor[k]) * self.times[k], starts))
            out[some, band] = acc
        return out


def _digest(shingles: np.ndarray, text: str) -> tuple[int, int]:
    """Two 64-bit keys of a set; of the text itself if the set is empty."""
    raw = shingles.tobytes() if len(shingles) else b"\0" + text.encode()
    whole = hashlib.blake2b(raw, digest_size=16).digest()
    return int.from_bytes(whole[:8], "little", signed=True), int.from_bytes(whole[8:], "little", signed=True)


def signatures(docs: DataFrame, banding: Banding) -> DataFrame:
    """doc_id, k1, k2 (keys of the text's set), grams (their number) and bands (none for a text without words); _text_key and _text_digest, if ``docs`` has them."""
    carried = [c for c in ("doc_id", "_text_key", "_text_digest") if c in docs.columns]

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text"))
        keys = [_digest(x, (text.as_py() or "") if not len(x) else "") for x, text in zip(sets, batch.column("text"))]
        bands = banding.of(sets).view(np.int64)
        lists = [row if len(x) else row[:0] for x, row in zip(sets, bands)]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in carried), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array([len(x) for x in sets], pa.int64()), pa.array(lists, pa.list_(pa.int64()))],
            [*carried, "k1", "k2", "grams", "bands"],
        )

    kinds = {"doc_id": "doc_id long, ", "_text_key": "_text_key long, ", "_text_digest": "_text_digest string, "}
    return map_slices(docs.select(*carried, "text"), "text", sign, "".join(kinds[c] for c in carried) + "k1 long, k2 long, grams long, bands array<long>")


def _memberships(nodes: DataFrame) -> DataFrame:
    """(bucket, band, low, high, block, k1, k2, doc_id, _text_key, copies): a row per node and tile it takes part in."""
    held = nodes.where("doc_id is not null").select("k1", "k2", "doc_id", "_text_key", "copies", "grams", F.posexplode("bands").alias("band", "bucket"))
    key = F.xxhash64("k1", "k2")
    stats = held.groupBy("bucket", "band").agg(F.count("*").alias("n"), F.sum("grams").alias("grams"), F.bit_xor(key).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "k1", "k2")).alias("y")).where("n > 1")
    # The same members meet in many bands; the first of those buckets serves for all.
    kept = stats.groupBy("n", "x", "y").agg(F.min(F.struct("band", "bucket")).alias("first"), F.min("grams").alias("all_grams")).select("first.*", "n", "all_grams")
    members = held.join(kept, ["bucket", "band"])
    blocks = F.greatest(F.least(F.ceil(F.col("n") / TILE), F.lit(SPREAD)), F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(8 * F.col("all_grams") / BLOCK_BYTES)).cast("int")
    members = members.withColumn("block", F.pmod(F.xxhash64(F.lit(2), "k1"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return members.select("bucket", "band", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "k1", "k2", "doc_id", "_text_key", "copies")


class _Side:
    """Up to SIDE texts of a tile: their places in it, and their shingles in order with the texts that hold each."""

    def __init__(self, places: np.ndarray, sets: list[np.ndarray]):
        self.places, self.sizes = places, np.array([len(sets[k]) for k in places])
        every, owner = np.concatenate([sets[k] for k in places]), np.repeat(np.arange(len(places)), self.sizes)
        order = np.argsort(every, kind="stable")
        every, self.owner = every[order], owner[order]
        self.starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        self.shingles, self.counts = every[self.starts], np.diff(np.append(self.starts, len(every)))

    def holds(self, at: np.ndarray) -> np.ndarray:
        """Matrix of which text holds which of the shingles at ``at``."""
        size = self.counts[at]
        places = np.repeat(self.starts[at] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        out = np.zeros((len(self.places), len(at)), np.float32)
        out[self.owner[places], np.repeat(np.arange(len(at)), size)] = 1
        return out


def _shared(a: _Side, b: _Side, frequent: int = 64) -> np.ndarray:
    """Matrix of how many shingles each text of ``a`` shares with each of ``b``.

    Shingles of many pairs go through a matrix product, in chunks; the others add their few pairs.
    """
    _, in_a, in_b = np.intersect1d(a.shingles, b.shingles, assume_unique=True, return_indices=True)
    na, nb = len(a.places), len(b.places)
    pairs = a.counts[in_a] * b.counts[in_b]
    rare = pairs <= frequent
    many = pairs[rare]
    k = np.arange(many.sum()) - np.repeat(np.concatenate([[0], np.cumsum(many)[:-1]]), many) if len(many) else np.zeros(0, np.int64)
    width = np.repeat(b.counts[in_b[rare]], many)
    rows = a.owner[np.repeat(a.starts[in_a[rare]], many) + k // np.maximum(width, 1)]
    cols = b.owner[np.repeat(b.starts[in_b[rare]], many) + k % np.maximum(width, 1)]
    out = np.bincount(rows * nb + cols, minlength=na * nb).reshape(na, nb)
    common = np.flatnonzero(~rare)
    for k in range(0, len(common), 4096):
        part = common[k : k + 4096]
        out += (a.holds(in_a[part]) @ b.holds(in_b[part]).T).astype(np.int64)
    return out


def _merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` with the labels of linked places a and b made one, the least."""
    p, q = label[a], label[b]
    apart = p != q
    if not apart.any():
        return label
    p, q, root = p[apart], q[apart], np.arange(len(label))
    while True:
        least = root.copy()
        np.minimum.at(least, p, root[q])
        np.minimum.at(least, q, root[p])
        least = least[least]
        if (least == root).all():
            return root[label]
        root = least


def _tile_links(band: int, across: bool, blocks: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], bands: np.ndarray, threshold: tuple[int, int]):
    """(places with links, their components' least places, new linked texts, new linked documents) of a tile.

    ``across``: pairs inside a block are another tile's.
    """
    m = len(sets)
    label, linked_any = np.arange(m), np.zeros(m, bool)
    texts, documents = np.zeros(m, np.int64), np.zeros(m, np.int64)
    cut = lambda at: [_Side(at[k : k + SIDE], sets) for k in range(0, len(at), SIDE)]
    if across:
        left, right = cut(np.flatnonzero(blocks == blocks.min())), cut(np.flatnonzero(blocks != blocks.min()))
        pairs = [(a, b) for a in left for b in right]
    else:
        left = cut(np.arange(m))
        pairs = [(a, b) for k, a in enumerate(left) for b in left[k:]]
    for a, b in pairs:
        linked = _shared(a, b) * (threshold[0] + threshold[1]) >= threshold[0] * (a.sizes[:, None] + b.sizes[None, :])
        if a is b:
            np.fill_diagonal(linked, False)
        if not linked.any():
            continue
        linked_any[a.places] |= linked.any(1)
        linked_any[b.places] |= linked.any(0)
        rows, cols = np.nonzero(linked)
        label = _merged(label, a.places[rows], b.places[cols])
        for k in range(band):  # pairs that met in an earlier band are counted there
            linked &= bands[a.places, k][:, None] != bands[b.places, k][None, :]
        texts[a.places] += linked.sum(1)
        documents[a.places] += linked @ copies[b.places]
        if a is not b:
            texts[b.places] += linked.sum(0)
            documents[b.places] += copies[a.places] @ linked
    some = np.flatnonzero(linked_any)
    return some, label[some], texts[some], documents[some]


def _links(members: DataFrame, docs: DataFrame, banding: Banding, threshold: tuple[int, int]) -> DataFrame:
    """(tile, node, root, texts, documents) from every tile; nodes and roots are (k1, k2)."""

    def verify(batches):
        held: dict | None = None

        def close():
            keys = np.array(held["node"], np.int64).reshape(-1, 2)
            _, first = np.unique(keys, axis=0, return_index=True)  # a repeated row is one text
            if len(first) < 2:
                return None
            band, low, high = held["key"][1:]
            blocks = np.array(held["block"])[first]
            if low != high and (blocks == blocks[0]).all():
                return None
            out = _tile_links(band, low != high, blocks, np.array(held["copies"])[first], [held["set"][k] for k in first], np.array([held["bands"][k] for k in first]), threshold)
            if not len(out[0]):
                return None
            keys = keys[first]
            tile = int.from_bytes(hashlib.blake2b(repr(held["key"]).encode(), digest_size=8).digest(), "little", signed=True)
            columns = [np.full(len(out[0]), tile), *keys[out[0]].T, *keys[out[1]].T, *out[2:]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["tile", "k1", "k2", "r1", "r2", "texts", "documents"])

        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                sets = shingle_sets(part.column("text"))
                bands = banding.of(sets)
                keys = zip(*(part.column(c).to_pylist() for c in ("bucket", "band", "low", "high")))
                rest = zip(*(part.column(c).to_pylist() for c in ("block", "k1", "k2", "copies")))
                for key, (block, k1, k2, copies), shingles, row in zip(keys, rest, sets, bands):
                    if held is None or held["key"] != key:
                        if held is not None and (out := close()) is not None:
                            yield out
                        held = {"key": key, "block": [], "node": [], "copies": [], "set": [], "bands": []}
                    for name, value in (("block", block), ("node", (k1, k2)), ("copies", copies), ("set", shingles), ("bands", row)):
                        held[name].append(value)
        if held is not None and (out := close()) is not None:
            yield out

    tiles = members.join(docs.select("doc_id", "_text_key", "text"), ["doc_id", "_text_key"])  # ids may repeat with other texts
    tiles = tiles.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "band", "low", "high", "k1", "k2")
    found = tiles.select("bucket", "band", "low", "high", "block", "k1", "k2", "copies", "text").mapInArrow(verify, "tile long, k1 long, k2 long, r1 long, r2 long, texts long, documents long")
    return found.select("tile", F.struct("k1", "k2").alias("node"), F.struct(F.col("r1").alias("k1"), F.col("r2").alias("k2")).alias("root"), "texts", "documents")


def merge_components(members: DataFrame) -> DataFrame:
    """(node, label) of every node in ``members`` (comp, node); nodes of overlapping comps share a label.

    Each round every node goes over to the least node that any of its comps holds, and the graph is
    written anew among those; the labels of the rounds are put together at the end, last first.
    """
    graph, rounds = members.distinct(), []
    while True:
        least = graph.groupBy("comp").agg(F.min("node").alias("least"))
        step = written(graph.join(least, "comp").groupBy("node").agg(F.min("least").alias("label")), "component-step")
        if step.where("node <> label").isEmpty():
            break
        rounds.append(step)
        graph = written(graph.join(step, "node").select("comp", F.col("label").alias("node")).distinct(), "component-graph")
    if not rounds:
        return step
    out = rounds.pop()
    while rounds:
        out = rounds.pop().withColumnRenamed("label", "via").join(out.withColumnsRenamed({"node": "via"}), "via").select("node", "label")
    return out


def near_duplicates(docs: DataFrame, threshold: tuple[int, int] = (4, 5), rows: int = 5, recall: float = 0.998) -> DataFrame:
    """doc_id, class_id, n_links, n_copies of every row of ``docs``.

    Two texts are linked if the Jaccard similarity of their five-gram sets is at least the threshold
    (numerator, denominator). n_links: other rows whose texts have the same set or are linked.
    n_copies: other rows of the same set. class_id: the least doc_id in the row's linked class. Texts
    without words (null as empty) are only alike if equal; very long ones are compared whole. A text
    that only rows without an id have is not compared, and its class is null. Repeated rows are copies
    of each other; ids may repeat. Other columns, of whatever names, are ignored; an empty table gives
    no rows.
    """
    signed, known = _classed(docs.select("doc_id", "text"), threshold, rows, recall)
    return signed.select("doc_id", "k1", "k2").join(known.drop("label"), ["k1", "k2"]).select("doc_id", "class_id", "n_links", "n_copies")


def class_survivors(docs: DataFrame, threshold: tuple[int, int] = (4, 5), rows: int = 5, recall: float = 0.998) -> DataFrame:
    """(doc_id, _text_digest) of one text of each class of ``near_duplicates``: that of the least id, then the least digest.

    Ids may repeat with different texts, which are in classes of their own; equal rows are one. ``docs``
    has doc_id, text and _text_digest; null texts count as empty. Rows without an id don't count. An
    empty table gives no rows.
    """
    signed, known = _classed(docs.select("doc_id", "text", "_text_digest"), threshold, rows, recall)
    found = signed.where("doc_id is not null").select("doc_id", "_text_digest", "k1", "k2").join(known.select("k1", "k2", "label"), ["k1", "k2"])
    return found.groupBy("label").agg(F.min(F.struct("doc_id", "_text_digest")).alias("first")).select("first.*")


def _classed(docs: DataFrame, threshold: tuple[int, int], rows: int, recall: float) -> tuple[DataFrame, DataFrame]:
    """The signatures, and k1, k2, label, class_id, n_copies, n_links of each set; a class is a label."""
    banding = Banding(choose_bands(threshold[0] / threshold[1], rows, recall), rows)
    docs = docs.withColumn("_text_key", F.xxhash64("text"))
    signed = written(signatures(docs, banding), "jaccard-signed")
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "_text_key"))).alias("first")
    nodes = signed.groupBy("k1", "k2").agg(first, F.count("*").alias("copies"), F.first("grams").alias("grams"), F.first("bands").alias("bands"))
    nodes = written(nodes.select("k1", "k2", "first.*", "copies", "grams", "bands"), "jaccard-nodes")
    links = written(_links(_memberships(nodes), docs, banding, (threshold[0], threshold[1])), "jaccard-links")
    return signed, _classes(nodes, links)


def _classes(nodes: DataFrame, links: DataFrame) -> DataFrame:
    counts = links.groupBy("node").agg(F.sum("documents").alias("linked"))
    labels = merge_components(links.select(F.struct("tile", "root").alias("comp"), "node"))
    known = nodes.select(F.struct("k1", "k2").alias("node"), "doc_id", "copies").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    known = written(known.join(counts, "node", "left"), "jaccard-known")
    least = known.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    return known.join(least, "label").select("node.*", "label", "class_id", (F.col("copies") - 1).alias("n_copies"), (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
