"""Token budgets for a mixture of sources, with DataFrame operations alone.

Weights sit on a tree of domain, language and source. A token budget goes from the
root down: each node's budget is divided among its children in proportion to
their weights, a child being able to use at most its tokens times ``max_epochs``.
What a child cannot use goes to its siblings, in proportion to their weights,
until none has room; only what a whole subtree cannot use is left to the subtree's
own siblings. All amounts are whole numbers, computed exactly.

A leaf spends its budget in epochs: whole passes over its documents, then the
longest prefix, in an order seeded by epoch and doc_id, whose tokens
fit into what is left. The order's hash is cut into ``buckets`` ranges, whose sums
are added up in order, and only within a range documents are sorted: a leaf with a
third of all documents is spread over all ranges.

Nulls and odd rows: a null language or source is a node of its own, named
``(none)``; a null text has no tokens; a document without tokens is taken if
it lies in the prefix. Documents of equal order (equal ids) are taken together
or not at all. A leaf of weight 0 gets nothing. Extra columns are ignored. An empty
table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_hash, stored

NONE = "(none)"


@dataclass(frozen=True)
class Tree:
    """Weights by name at each level; names not listed have the level's default."""

    domains: dict[str, list[str]]
    other_domain: str = "other"
    domain_weights: dict[str, int] = field(default_factory=dict)
    lang_weights: dict[str, int] = field(default_factory=dict)
    source_weights: dict[str, int] = field(default_factory=dict)
    default: int = 1

    def domain(self) -> Column:
        out = F.lit(self.other_domain)
        for name, sources in self.domains.items():
            out = F.when(F.col("source").isin(sources), F.lit(name)).otherwise(out)
        return out

    def weight(self, level: str) -> Column:
        out = F.lit(self.default)
        for name, w in {"domain": self.domain_weights, "lang": self.lang_weights, "source": self.source_weights}[level].items():
            out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
        return out.cast("long")


#: The production mixture.
TREE = Tree(
    domains={"crawl": ["src0"], "news": ["src1", "src2", "src3", "src4", "src5", "src6"], "books": ["src7", "src8", "src9", "src10", "src11", "src12", "src13"]},
    domain_weights={"crawl": 4, "news": 3, "books": 2, "other": 1},
    lang_weights={"en": 6, "de": 2, "fr": 2, "es": 1},
)
MAX_EPOCHS, SEED, BUCKETS = 4, 17, 4096
LEAF = ["domain", "lang", "source"]


def token_rows(docs: DataFrame, tree: Tree = TREE) -> DataFrame:
    """(doc_id, row, domain, lang, source, n_tokens) of every row; tokens are words between blanks."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select(
        F.col("doc_id"), row_hash(F.col("doc_id"), F.col("text")).alias("row"),
        F.coalesce("lang", F.lit(NONE)).alias("lang"), F.coalesce("source", F.lit(NONE)).alias("source"),
        words.cast("long").alias("n_tokens"),
    ).withColumn("domain", tree.domain())


def shares(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``children`` (parent columns, name, weight, room, total) with budget: the parent's total divided by weight, none over its room.

    Children are filled up in the order of room to weight: one whose room is no
    more than its part of what is left is full; the others divide the rest.
    """
    up = Window.partitionBy(*parent)
    rows = children.withColumn("room", F.when(F.col("weight") > 0, F.col("room")).otherwise(F.lit(0).cast("long")))
    rows = rows.withColumn("weight", F.greatest("weight", F.lit(1).cast("long"))).withColumn("_ratio", F.col("room").cast("double") / F.col("weight").cast("double"))
    order = up.orderBy("_ratio", name)
    rows = rows.withColumns({
        "_before": F.sum("room").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("room"),
        "_weights": F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
    })
    rows = rows.withColumn("_full", F.col("room") * F.col("_weights") <= F.col("weight") * (F.col("total") - F.col("_before")))
    rows = rows.withColumns({
        "_used": F.sum(F.when(F.col("_full"), F.col("room")).otherwise(F.lit(0))).over(up),
        "_open": F.sum(F.when(F.col("_full"), F.lit(0)).otherwise(F.col("weight"))).over(up),
    })
    rest = F.expr("(total - _used) * weight div greatest(_open, 1L)")
    return rows.withColumn("budget", F.when(F.col("_full"), F.col("room")).otherwise(rest)).drop("_ratio", "_before", "_weights", "_full", "_used", "_open")


def leaf_budgets(rows: DataFrame, tree: Tree = TREE, budget_tokens: int | None = None, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(domain, lang, source, have, budget) of every leaf. ``budget_tokens``: as many as there are, if None."""
    leaves = rows.groupBy(*LEAF).agg(F.sum("n_tokens").alias("have")).withColumn("room", F.col("have") * max_epochs)
    total = F.sum("have").over(Window.partitionBy("root")) if budget_tokens is None else F.lit(budget_tokens).cast("long")
    domains = leaves.groupBy("domain").agg(F.sum("room").alias("room"), F.sum("have").alias("have")).withColumn("root", F.lit(0))
    domains = domains.withColumn("total", total).withColumn("weight", tree.weight("domain"))
    top = shares(domains, ["root"], "domain").select("domain", F.col("budget").alias("total"))
    langs = leaves.groupBy("domain", "lang").agg(F.sum("room").alias("room")).join(top, "domain").withColumn("weight", tree.weight("lang"))
    mid = shares(langs, ["domain"], "lang").select("domain", "lang", F.col("budget").alias("total"))
    low = leaves.join(mid, ["domain", "lang"]).withColumn("weight", tree.weight("source"))
    return shares(low, ["domain", "lang"], "source").select(*LEAF, "have", "budget")


def order_hash(seed: int, epoch: Column, doc_id: Column) -> Column:
    """60 bits that place a document in an epoch's order."""
    said = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(said), 1, 15), 16, 10).cast("long")


def select_rows(rows: DataFrame, budgets: DataFrame, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """The rows taken, with budget (the leaf's) and epochs, how often each is used."""
    leaf = budgets.where("have > 0").select(*LEAF, "budget", F.expr("budget div have").alias("passes"), F.expr("budget % have").alias("rest"))
    met = rows.join(leaf, LEAF).withColumn("place", order_hash(seed, F.col("passes"), F.col("doc_id")))
    met = met.withColumn("bucket", F.expr(f"cast(shiftright(shiftright(place, 30) * {buckets}, 30) as int)"))
    sums = met.groupBy(*LEAF, "bucket").agg(F.sum("n_tokens").alias("tokens"))
    upto = F.sum("tokens").over(Window.partitionBy(*LEAF).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sums = sums.withColumn("before", upto - F.col("tokens"))
    met = met.join(sums, [*LEAF, "bucket"])
    # Rows of equal place are peers, which the running sum counts together.
    peers = Window.partitionBy(*LEAF, "bucket").orderBy("place", "doc_id")
    fits = F.expr("before + tokens <= rest") | (F.col("before") + F.sum("n_tokens").over(peers) <= F.col("rest"))
    out = met.withColumn("epochs", (F.col("passes") + F.when(fits, 1).otherwise(0)).cast("int"))
    return out.where("epochs > 0").select("doc_id", "row", *LEAF, "n_tokens", "budget", "epochs")


def mixed(docs: DataFrame, tree: Tree = TREE, budget_tokens: int | None = None, max_epochs: int = MAX_EPOCHS, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, row, domain, lang, source, n_tokens, budget and epochs of the documents in the mixture."""
    rows = stored(token_rows(docs, tree), "tokens")
    budgets = stored(leaf_budgets(rows, tree, budget_tokens, max_epochs), "budgets")
    return select_rows(rows, budgets, seed, buckets)
