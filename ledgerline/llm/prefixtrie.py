"""The prefix trie of rebuilt conversations, over fingerprints that compose without any text being rebuilt.

A run of turns is an element (B ** n, sum of t_i * B ** i) of a monoid, in three lanes
modulo 2 ** 31 - 1; (s, v) * (s', v') = (s s', v + s v'). A rebuilt conversation is the
head of its base followed by its own turns after the first few; the
fingerprint of each of its prefixes is the product of the base head's element
and of an own run's, whose sums are running sums over positions. Only these numbers, the
word counts and references to stored turns move; no conversation is put together.

A node is a depth and a fingerprint. That equal numbers stand for equal turns is
verified, not assumed: every turn's role and text are compared with those of the stored
turn that its hash group refers to, and all members of a node have to agree in their parent's
fingerprint and their last turn's hash, so by induction in all turns. If any
comparison fails, everything is done again with other hashes.

Sums over subtrees take one pass whatever the depth: each node is charged to its
smallest member, whose path goes through all of the node's ancestors. A member is
the smallest of all nodes of its path from some depth on, so what it is charged
with below a node is its total, or a running sum on its own nodes.

Skew: positions and running sums are taken within blocks of ``BLOCK`` turns
(or of a sorted range) and shifted by the sums of the blocks before, so a conversation
with a third of all turns is many tasks'. Nodes are counted by partial aggregates. The
conversations that end in a node are put in order by ranges and joined
to texts of some 64 KB before one task hashes a node's texts one after the other.

Nulls and odd rows: turns are ordered by turn (null first), then role, then md5 of
the text; repeated rows are turns of their own. Null roles and texts are empty. The rows of a
null conv_id are one conversation without a base and with h = 0, which counts as a member but
names nothing: it is larger than all ids and has no decimal. c % 20 has the sign of c. Extra columns
are ignored. Without conversations there are no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_width, stored

PRIME = (1 << 31) - 1
BASES = (1_223_041_067, 911_382_323, 1_640_531_527)
LANES = range(len(BASES))
BLOCK, CHUNK_BYTES = 4096, 1 << 16
FAMILY, HEADS = 20, 4
NODE = ["depth", "f0", "f1", "f2"]


def power(base: int, exponent: Column) -> Column:
    """base ** exponent modulo PRIME, by the bits of the exponent."""
    squares = [base]
    while len(squares) < 40:
        squares.append(squares[-1] ** 2 % PRIME)
    bits = F.array(*[F.lit(x).cast("long") for x in squares])
    step = F.aggregate(
        F.zip_with(bits, F.sequence(F.lit(0), F.lit(len(squares) - 1)), lambda b, i: F.when(F.call_function("shiftright", exponent, i).bitwiseAND(F.lit(1)) == 1, b).otherwise(F.lit(1).cast("long"))),
        F.lit(1).cast("long"), lambda x, y: x * y % PRIME)
    return step


def head_value(lane: int, n: Column) -> Column:
    """The value of the first n turns (at most HEADS - 1) of column ``head``."""
    out = F.lit(0).cast("long")
    for i in range(HEADS - 1):
        t = F.get(F.col("head"), F.lit(i))[f"t{lane}"]
        out = out + F.when(n > i, t * F.lit(BASES[lane] ** i % PRIME).cast("long") % PRIME).otherwise(F.lit(0).cast("long"))
    return out % PRIME


def turn_rows(conversations: DataFrame, seed: int = 0) -> DataFrame:
    """Every turn, stored in order: conv_id, role, text, t0-t2 (the turn's hash), words, part and at (the stored turn's reference)."""
    empty = F.lit("")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    hashes = {f"t{k}": F.pmod(F.xxhash64(F.lit(seed * len(BASES) + k), "role", "text"), F.lit(PRIME).cast("long")) for k in LANES}
    rows = rows.withColumns(hashes | {"words": F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), "tie": F.md5("text")})
    order = ["conv_id", "turn", "role", "tie"]
    dealt = rows.repartitionByRange(shuffle_width(conversations.sparkSession), *order).sortWithinPartitions(*order)
    return stored(dealt.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}).drop("turn", "tie"), "turns")


def placed(turns: DataFrame) -> DataFrame:
    """turns with place, a turn's number in its conversation from 0."""
    # A conversation has one row a part here.
    parts = turns.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = parts.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), (upto - F.col("n")).alias("before"))
    within = Window.partitionBy("conv_id", "part").orderBy("at")
    rows = turns.drop("role", "text").withColumn("nth", F.row_number().over(within) - 1)
    met = rows.join(parts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    return met.select("conv_id", (F.col("nth") + F.col("before")).alias("place"), "t0", "t1", "t2", "words")


def running(rows: DataFrame, key: str, place: str, sums: dict[str, str]) -> DataFrame:
    """rows with the sums (new name: column) up to and with each place, by blocks of places; values modulo nothing."""
    rows = rows.withColumn("block", F.expr(f"{place} div {BLOCK}"))
    within = Window.partitionBy(key, "block").orderBy(place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(key, "block").agg(*[F.sum(c).alias(c) for c in sums.values()])
    blocks = blocks.select(F.col(key).alias("b_key"), F.col("block").alias("b_block"), *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"b_{n}") for n, c in sums.items()])
    rows = rows.withColumns({n: F.sum(c).over(within) for n, c in sums.items()})
    met = rows.join(blocks, F.col(key).eqNullSafe(F.col("b_key")) & (F.col("block") == F.col("b_block")))
    return met.withColumns({n: F.col(n) + F.col(f"b_{n}") for n in sums}).drop("b_key", "b_block", "block", *[f"b_{n}" for n in sums])


def conversation_facts(places: DataFrame) -> DataFrame:
    """conv_id, n_own, h, head (the base's first turns) and n_head (how many of them begin the conversation)."""
    own = places.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    own = own.withColumns({"h": F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")) % HEADS, "base": F.col("conv_id") - F.col("conv_id") % FAMILY})
    # Three rows a base at most.
    heads = places.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEADS - 1)).groupBy(F.col("conv_id").alias("head_of"))
    heads = heads.agg(F.sort_array(F.collect_list(F.struct("place", "t0", "t1", "t2", "words"))).alias("head"))
    met = own.join(heads, F.col("base") == F.col("head_of"), "left")
    return met.select("conv_id", "n_own", "h", "head", F.least("h", F.coalesce(F.size("head"), F.lit(0))).alias("n_head"))


def memberships(places: DataFrame) -> DataFrame:
    """conv_id, the node (depth, f0-f2), its parent's p0-p2, its last turn's t0-t2 and words, and whether the conversation ends there."""
    facts = stored(conversation_facts(places), "conversations")
    length = F.col("n_head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))
    zero = F.lit(0).cast("long")
    d = F.col("depth")
    heads = facts.select("conv_id", "head", (length == 0).alias("whole"), length.alias("length"), F.explode(F.sequence(F.lit(0), F.col("n_head"))).alias("depth"))
    last = lambda c: F.when(d > 0, F.get(F.col("head"), d - 1)[c]).otherwise(zero)
    heads = heads.select(
        "conv_id", d.cast("long").alias("depth"), *[head_value(k, d).alias(f"f{k}") for k in LANES], *[head_value(k, d - 1).alias(f"p{k}") for k in LANES],
        *[last(f"t{k}").alias(f"t{k}") for k in LANES], last("words").alias("words"), (d == F.col("length")).alias("ends"))
    own = places.join(facts.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).where(F.col("place") >= F.col("h"))
    own = own.withColumn("k", F.col("place") - F.col("h"))
    own = own.withColumns({f"s{k}": F.col(f"t{k}") * power(BASES[k], F.col("k")) % PRIME for k in LANES} | {f"v{k}": head_value(k, F.col("n_head")) for k in LANES}).drop("head", "c")
    own = running(own, "conv_id", "k", {f"upto{k}": f"s{k}" for k in LANES})

    def joined(k: int, run: Column) -> Column:
        shift = F.lit(0).cast("long")
        for n in range(HEADS):
            shift = F.when(F.col("n_head") == n, F.lit(BASES[k] ** n % PRIME).cast("long")).otherwise(shift)
        return (F.col(f"v{k}") + shift * (run % PRIME) % PRIME) % PRIME

    own = own.select(
        "conv_id", (F.col("n_head") + F.col("k") + 1).cast("long").alias("depth"), *[joined(k, F.col(f"upto{k}")).alias(f"f{k}") for k in LANES],
        *[joined(k, F.col(f"upto{k}") - F.col(f"s{k}")).alias(f"p{k}") for k in LANES], "t0", "t1", "t2", "words", (F.col("place") == F.col("n_own") - 1).alias("ends"))
    return heads.unionByName(own)


def turns_differ(turns: DataFrame) -> bool:
    """Whether turns of one hash have different roles or texts: each is compared with the turn its hash group refers to."""
    t = ["t0", "t1", "t2"]
    groups = turns.groupBy(*t).agg(F.count("*").alias("n"), F.min(F.struct("part", "at")).alias("ref")).where("n > 1").select(F.col("ref.part").alias("part"), F.col("ref.at").alias("at"))
    refs = turns.join(groups, ["part", "at"]).select(*t, F.col("role").alias("ref_role"), F.col("text").alias("ref_text"))
    return not turns.join(refs, t).where("role <> ref_role or text <> ref_text").isEmpty()


def _nodes(members: DataFrame) -> DataFrame:
    same = ["p0", "p1", "p2", "t0", "t1", "t2"]
    nodes = members.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("words").alias("words"), *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"{c}_most") for c in same])
    return nodes.withColumn("agree", F.expr(" and ".join(f"{c} = {c}_most" for c in same))).drop(*[f"{c}_most" for c in same])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, first, ids): the decimal ids of rows in order, joined to texts of CHUNK_BYTES."""
    def out(rows: list) -> pa.RecordBatch:
        columns = [*zip(*[(*node, first, ",".join(ids)) for node, first, ids in rows])]
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:5]], pa.array(columns[5], pa.string())], names=[*NODE, "first", "ids"])

    now, first, ids, size, done = None, 0, [], 0, []
    for b in batches:
        for *node, conv_id in zip(*[b.column(c).to_pylist() for c in (*NODE, "conv_id")]):
            if node != now or size > CHUNK_BYTES:
                if ids:
                    done.append((now, first, ids))
                now, first, ids, size = node, conv_id, [], 0
            ids.append(str(conv_id))
            size += len(ids[-1]) + 1
        if done:
            yield out(done)
            done = []
    if ids:
        yield out([(now, first, ids)])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, sha): SHA-256 over a node's texts, which come in order; none is kept."""
    def out(rows: list) -> pa.RecordBatch:
        columns = [*zip(*[(*node, sha) for node, sha in rows])]
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.string())], names=[*NODE, "sha"])

    now, sha, done = None, None, []
    for b in batches:
        for *node, ids in zip(*[b.column(c).to_pylist() for c in (*NODE, "ids")]):
            if node != now:
                if sha:
                    done.append((now, sha.hexdigest()))
                now, sha = node, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        if done:
            yield out(done)
            done = []
    if sha:
        yield out([(now, sha.hexdigest())])


def ends_hashes(members: DataFrame) -> DataFrame:
    """(node, sha) of the nodes in which conversations end: SHA-256 of their decimal ids, ascending, joined by commas."""
    ends = members.where("ends and conv_id is not null").select(*NODE, "conv_id")
    dealt = ends.repartitionByRange(shuffle_width(members.sparkSession), *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    keys = "depth long, f0 long, f1 long, f2 long"
    chunks = dealt.mapInArrow(_chunks, f"{keys}, first long, ids string")
    return chunks.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(_hashed, f"{keys}, sha string")


def prefix_trie(conversations: DataFrame, max_tries: int = 8) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node."""
    for seed in range(max_tries):
        turns = turn_rows(conversations, seed)
        if turns_differ(turns):
            continue
        members = stored(memberships(stored(placed(turns), "places")), "members")
        nodes = stored(_nodes(members), "nodes")
        if nodes.where("not agree").isEmpty():
            break
    else:
        raise RuntimeError(f"hashes met in {max_tries} tries")

    up = ["depth", "p0", "p1", "p2"]
    children = nodes.where("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children")).withColumn("depth", F.col("depth") - 1).withColumnsRenamed({f"p{k}": f"f{k}" for k in LANES})
    nodes = nodes.join(children, NODE, "left").withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "gain": (F.col("n_convs") - 1) * F.col("words")})
    nodes = stored(nodes, "nodes_children")
    # The root has one row, and may be the parent of a third of all nodes.
    root = nodes.where("depth = 0").select("conv_id").first()
    parents = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(f"f{k}").alias(f"p{k}") for k in LANES], F.col("conv_id").alias("parent_conv_id"))
    below = nodes.where("depth > 1").join(parents, up, "left").select(*NODE, "parent_conv_id")
    top = nodes.where("depth < 2").select(*NODE, F.when(F.col("depth") == 1, F.lit(root["conv_id"] if root else None).cast("long")).alias("parent_conv_id"))

    charged = nodes.groupBy(F.col("conv_id").alias("c")).agg(F.min("depth").alias("from_depth"), F.sum("gain").alias("total"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    charged = stored(charged, "charged")
    met = members.select("conv_id", *NODE).join(charged, F.col("conv_id").eqNullSafe(F.col("c")))
    sums = met.groupBy(*NODE).agg(F.sum("leaf").alias("n_leaves"), F.sum(F.when(F.col("depth") < F.col("from_depth"), F.col("total")).otherwise(0)).alias("others"))
    own = running(nodes.select("conv_id", *NODE, "gain"), "conv_id", "depth", {"upto": "gain"})
    own = own.join(charged, F.col("conv_id").eqNullSafe(F.col("c"))).select(*NODE, (F.col("total") - F.col("upto") + F.col("gain")).alias("mine"))
    out = nodes.join(below.unionByName(top), NODE).join(sums, NODE).join(own, NODE).join(ends_hashes(members), NODE, "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"), "n_leaves",
        (F.col("others") + F.col("mine")).alias("saved_tokens"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
