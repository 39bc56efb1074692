"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits, of which each is set if it is set in over half the
hashes of the text's word shingles. Two fingerprints within ``radius`` bits must
be within radius // segments bits in at least one of the segments that the bits
are cut into. So each fingerprint is stored in one table a segment under that
segment's value, and looks up every value in the small Hamming ball around its
own; what it finds is compared over all 64 bits inside the join's condition.

Equal fingerprints are one node of the graph, whatever their number, so exact
copies never form pairs. Before the lookups, fingerprints that agree outside one
block of ``radius`` neighbouring bits are merged: they are within the radius
of each other, at most 2 ** radius share a block's key, and one is linked to each
of the others, so a dense cloud of near copies shrinks to few groups at a linear
price. The lookups then only return links between different groups. Links and
components stay in Spark tables.

Nulls and odd rows: a null text counts as empty; a text without words has
fingerprint zero; a null doc_id is linked like any other but never names a
component unless all ids of it are null. Repeated rows share a fingerprint and
so a component. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, row_hash, shuffle_width, stored
from .components import components

BITS = 64


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(tokens), seed)]
    else:
        joined = b" ".join(tokens)
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
        starts = [0, *(ends[:-words] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1:].tolist())]
    counts = np.zeros(BITS, np.int64)
    h = np.array(hashes, dtype=">u8")
    for a in range(0, len(h), 1 << 14):  # 64 bytes a shingle while they are counted
        part = h[a:a + (1 << 14)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(h)).tobytes(), "big")


def _fingerprints(words: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.fromiter((fingerprint(t.as_py(), words, seed) for t in b.column("text")), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row_hash"), pa.array(found.view(np.int64))], names=["doc_id", "row_hash", "fp"])
    return run


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, row_hash, fp) of every row; row_hash tells rows of one doc_id apart."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash(F.col("doc_id").cast("long"), F.col("text")).alias("row_hash"), "text")
    return texts.mapInArrow(_fingerprints(words, seed), "doc_id long, row_hash long, fp long")


def ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with at most ``radius`` set."""
    return [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def block_links(nodes: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b): of the fingerprints (column fp) that differ in one block of ``radius`` bits only, the least with each other one."""
    outside = [((1 << BITS) - 1) & ~(((1 << radius) - 1) << at) for at in range(0, BITS, radius)]
    masks = F.array(*[F.lit(m - (1 << BITS) if m >> (BITS - 1) else m).cast("long") for m in outside])
    keys = nodes.select("fp", F.posexplode(masks).alias("block", "mask")).select("fp", "block", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    # A key has 2 ** radius fingerprints at most, for they are all different.
    groups = keys.groupBy("block", "key").agg(F.sort_array(F.collect_set("fp")).alias("fps")).where(F.size("fps") > 1)
    return groups.select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, 1 << radius)).alias("b"))


def links(nodes: DataFrame, radius: int = 3, segments: int = 2) -> DataFrame:
    """(a, b), a < b: the pairs of different fingerprints (column fp) within ``radius`` bits.

    With a column ``group``, only pairs of different groups. With two segments of
    32 bits, a ball has 33 values, and chance agreements are one in 4 billion:
    lookups grow as the number of fingerprints. They are joined by a merge, never
    broadcast: Spark counts an exploded row once, so lookups 33 times as many as the
    nodes would go to the driver whenever the nodes' file is under the threshold.
    """
    width = BITS // segments
    low = (1 << width) - 1
    found = None
    if "group" not in nodes.columns:
        nodes = nodes.withColumn("group", F.col("fp"))
    for s in range(segments):
        value = F.shiftrightunsigned("fp", s * width).bitwiseAND(F.lit(low))
        table = nodes.select(F.col("fp").alias("b"), F.col("group").alias("group_b"), value.alias("value"))
        masks = F.array(*[F.lit(m).cast("long") for m in ball(width, radius // segments)])
        looks = nodes.select(F.col("fp").alias("a"), F.col("group").alias("group_a"), value.alias("own"), F.explode(masks).alias("mask"))
        looks = looks.select("a", "group_a", F.col("own").bitwiseXOR(F.col("mask")).alias("value"))
        near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
        other = (F.col("a") < F.col("b")) & (F.col("group_a") != F.col("group_b"))
        got = looks.hint("merge").join(table, (looks["value"] == table["value"]) & other & near).select("a", "b", "group_a", "group_b")
        found = got if found is None else found.unionByName(got)
    return found


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, segments: int = 2, seed: int = 42) -> DataFrame:
    """(doc_id, row_hash, fp, component, component_id) of every row; component_id is the least doc_id reachable over links, component a fingerprint of it."""
    rows = stored(fingerprints(docs, words, seed), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    # Each fingerprint becomes a row a block, so its few bytes are spread over all tasks first.
    spread = nodes.select("fp").repartition(shuffle_width(docs.sparkSession))
    merged = components(block_links(spread, radius)).select(F.col("node").alias("fp"), F.col("component").alias("group"))
    nodes = stored(nodes.join(merged, "fp", "left").withColumn("group", F.coalesce("group", "fp")), "groups")
    between = links(nodes.select("fp", "group"), radius, segments).select(F.col("group_a").alias("a"), F.col("group_b").alias("b"))
    member = components(between.distinct()).withColumnRenamed("node", "group")
    named = stored(nodes.join(member, "group", "left").withColumn("component", F.coalesce("component", "group")), "members")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(least, "component").select("fp", "component", "component_id"), "fp")


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs, of each component only the one with the least doc_id (then row hash; null ids last), once."""
    groups = near_duplicates(docs, **how)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row_hash"))
    kept = groups.groupBy("component").agg(least.alias("kept")).select(F.col("kept.doc_id").alias("_doc"), F.col("kept.row_hash").alias("_row"))
    name, doc, row = (fresh(x, docs.columns) for x in ("_hash", "_doc", "_row"))
    kept = kept.withColumnsRenamed({"_doc": doc, "_row": row})
    named = docs.withColumn(name, row_hash(F.col("doc_id").cast("long"), F.col("text")))
    met = named.join(kept, (named[name] == kept[row]) & named["doc_id"].eqNullSafe(kept[doc]), "left_semi")
    return met.dropDuplicates([name, "doc_id"]).select(*[F.col(f"`{c}`") for c in docs.columns])
