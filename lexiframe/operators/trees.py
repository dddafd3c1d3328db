"""Decision trees and forests, grown level by level from split statistics.

Rows hold a key, a label and their features as a map from feature number to bin (1 or more);
a feature that is missing is in bin 0, so sparse rows stay sparse. A split sends the rows
whose bin is at least a cut (or, for categories, in a set) to the right.

A level is one aggregate over the rows: the weight of every (tree, node, feature, bin, label)
that occurs. Which node a row is in follows from the splits found so far, an expression; no
row is moved or stored again. Sums of squares on both sides of each cut are running sums over
bins, whatever the number of classes; they and the fixed-point logarithms of the entropy are
whole numbers, so equal splits are equal on every partitioning: the highest gain wins, then
the lowest feature, then the lowest cut.

Bags are drawn by key: a row's weight in a tree is a Poisson number made from a digest. A
node tries the features that a digest of seed, tree, node and feature picks.

Splits are held on the driver: at most ``MAX_NODES`` of all trees together. ``operators.forest``
serves larger ones.
"""

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.scratch import materialise
from .lookup import lookup_join
from .split import DIGESTS
from .terms import term_counts

MAX_NODES = 4096
# The Poisson distribution with mean 1, summed up, in units of 2**-32.
POISSON = (1580030169, 3160060337, 3950075422, 4213413783, 4279248374, 4292415292, 4294609779)
#: Entropies are sums of x ln x in millionths.
SCALE = 1_000_000


@dataclass(frozen=True)
class Growth:
    """How to grow: ``share`` is the part of the features that a node tries."""

    trees: int = 1
    depth: int = 5
    impurity: str = "gini"  # gini, entropy
    share: float = 1.0
    bagged: bool = False
    seed: int = 234
    categories: frozenset[int] = frozenset()

    def __post_init__(self):
        if self.impurity not in ("gini", "entropy"):
            raise ValueError(f"unknown impurity {self.impurity!r}")
        if self.trees << self.depth > MAX_NODES:
            raise ValueError(f"{self.trees} trees of depth {self.depth} may have more than {MAX_NODES} nodes")


@dataclass
class Split:
    feature: int
    cut: int
    right: list[int] | None  # the bins of a category feature
    gain: float

    def goes_right(self, bins: str) -> Column:
        found = F.coalesce(F.element_at(bins, F.lit(self.feature)), F.lit(0))
        return found >= self.cut if self.right is None else found.isin(self.right)


@dataclass
class Forest:
    """Splits and majority labels by (tree, node); the root is 1, the children of n are 2n and 2n + 1."""

    growth: Growth
    splits: dict[tuple[int, int], Split] = field(default_factory=dict)
    labels: dict[tuple[int, int], object] = field(default_factory=dict)

    def node(self, tree: int, bins: str, at: int = 1) -> Column:
        """The node that a row ends in."""
        split = self.splits.get((tree, at))
        if split is None:
            return F.lit(at)
        left, right = (self.node(tree, bins, 2 * at + side) for side in (0, 1))
        return F.when(split.goes_right(bins), right).otherwise(left)

    def depth(self, tree: int = 0) -> int:
        return max((n.bit_length() for t, n in self.splits if t == tree), default=0)


def digest(*parts) -> Column:
    text = F.concat_ws(":", *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def bag_weight(growth: Growth, tree: int, key: str) -> Column:
    """How often a row is in the bag of a tree."""
    if not growth.bagged:
        return F.lit(1)
    drawn = digest(growth.seed, tree, F.col(key))
    return reduce(Column.__add__, [(drawn >= edge).cast("int") for edge in POISSON])


def _level(rows: DataFrame, forest: Forest, level: int, key: str) -> DataFrame:
    """``(tree, node, feature, bin, label, n)`` of the nodes of a level; feature -1 has the totals."""
    g = forest.growth
    places = F.array(
        *(
            F.struct(F.lit(t).alias("tree"), forest.node(t, "bins").alias("node"), bag_weight(g, t, key).alias("w"))
            for t in range(g.trees)
        )
    )
    entries = F.concat(F.array(F.struct(F.lit(-1).alias("feature"), F.lit(0).alias("bin"))), _entries("bins"))
    placed = rows.select("label", "bins", F.inline(places)).where((F.col("node") >= 1 << level) & (F.col("w") > 0))
    each = placed.select("tree", "node", "w", "label", F.inline(entries))
    if g.share < 1:
        tried = digest(g.seed, F.col("tree"), F.col("node"), F.col("feature")) < round(g.share * DIGESTS)
        each = each.where((F.col("feature") < 0) | tried)
    return each.groupBy("tree", "node", "feature", "bin", "label").agg(F.sum("w").alias("n"))


def _entries(bins: str) -> Column:
    return F.transform(F.map_entries(bins), lambda e: F.struct(e["key"].alias("feature"), e["value"].alias("bin")))


def _in_order(stats: DataFrame, totals: DataFrame, categories: frozenset[int]) -> DataFrame:
    """Add ``place``, the order of bins: bins, or categories by the share of the node's commonest label."""
    if not categories:
        return stats.withColumn("place", F.col("bin"))
    major = totals.groupBy("tree", "node").agg(F.min(F.struct(-F.col("t"), "label"))["label"].alias("major"))
    common = F.sum(F.when(F.col("label") == F.col("major"), F.col("n")).otherwise(0))
    by_share = Window.partitionBy("tree", "node", "feature").orderBy(F.desc("share"), "bin")
    of = ["tree", "node", "feature", "bin"]
    ranked = (
        stats.where(F.col("feature").isin(*categories))
        .join(F.broadcast(major), ["tree", "node"])
        .groupBy(*of)
        .agg((common / F.sum("n")).alias("share"))
        .select(*of, F.row_number().over(by_share).alias("place"))
    )
    plain = stats.where(~F.col("feature").isin(*categories)).withColumn("place", F.col("bin"))
    return plain.unionByName(stats.join(ranked, of))


def _weighed(x: Column, impurity: str) -> Column:
    """What is summed over labels: x squared, or x ln x in millionths."""
    if impurity == "gini":
        return x * x
    return F.when(x > 0, F.round(x * F.ln(x.cast("double")) * SCALE).cast("long")).otherwise(F.lit(0).cast("long"))


def _gain(parts: list[tuple[Column, Column]], impurity: str) -> Column:
    """Fall of the impurity, times rows; parts are (sum over labels, rows) right, left, both."""
    if impurity == "gini":
        right, left, both = (s / n.cast("double") for s, n in parts)
    else:
        right, left, both = ((s - _weighed(n, impurity)).cast("double") for s, n in parts)
    return right + left - both


def _cuts(stats: DataFrame, impurity: str, categories: frozenset[int]) -> DataFrame:
    """``(tree, node, feature, place, gain)`` of every cut with rows on both sides."""
    totals = stats.where("feature < 0").select("tree", "node", "label", F.col("n").alias("t"))
    whole = totals.groupBy("tree", "node").agg(
        F.sum("t").alias("rows"), F.sum(_weighed(F.col("t"), impurity)).alias("both")
    )
    of_label = Window.partitionBy("tree", "node", "feature", "label").orderBy(F.desc("place"))
    right = F.sum("n").over(of_label.rowsBetween(Window.unboundedPreceding, 0))
    ordered = _in_order(stats.where("feature >= 0"), totals, categories)
    steps = ordered.join(totals, ["tree", "node", "label"]).withColumn("r", right)

    def change(now: Column, before: Column) -> Column:
        return _weighed(now, impurity) - _weighed(before, impurity)

    r, t, n = F.col("r"), F.col("t"), F.col("n")
    of = ["tree", "node", "feature"]
    changes = steps.groupBy(*of, "place").agg(
        F.sum("n").alias("n"),
        F.sum(change(r, r - n)).alias("right"),
        F.sum(change(t - r, t - r + n)).alias("left"),
    )
    upward = Window.partitionBy(*of).orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, 0)
    sums = changes.select(*of, "place", *(F.sum(c).over(upward).alias(c) for c in ("n", "right", "left")))
    known = sums.join(F.broadcast(whole), ["tree", "node"]).where("n < rows")
    rows, n = F.col("rows"), F.col("n")
    parts = [(F.col("right"), n), (F.col("both") + F.col("left"), rows - n), (F.col("both"), rows)]
    return known.select(*of, "place", _gain(parts, impurity).alias("gain"))


def _grown(stats: DataFrame, growth: Growth) -> list:
    """The best split of each node, with the bins that go right."""
    least = 1e-9 if growth.impurity == "gini" else 0.5
    cuts = _cuts(stats, growth.impurity, growth.categories).where(F.col("gain") > least)
    best = cuts.groupBy("tree", "node").agg(F.max(F.struct("gain", -F.col("feature"), -F.col("place"))).alias("best"))
    best = best.select("tree", "node", (-F.col("best.col2")).alias("feature"), (-F.col("best.col3")).alias("cut"), "best.gain")
    if not growth.categories:
        return best.withColumn("right", F.lit(None).cast("array<int>")).collect()
    totals = stats.where("feature < 0").select("tree", "node", "label", F.col("n").alias("t"))
    places = _in_order(stats.where(F.col("feature").isin(*growth.categories)), totals, growth.categories)
    right = (
        places.select("tree", "node", "feature", "bin", "place").distinct()
        .join(F.broadcast(best), ["tree", "node", "feature"])
        .where("place >= cut")
        .groupBy("tree", "node")
        .agg(F.array_sort(F.collect_set("bin")).alias("right"))
    )
    return best.join(right, ["tree", "node"], "left").collect()


def grow(rows: DataFrame, growth: Growth, key: str = "key", label: str = "label", bins: str = "bins") -> Forest:
    """Fit on ``(key, label, bins)``; every level is stored statistics and a few collected splits.

    Rows without a label are left out; null bins are no features.
    """
    forest = Forest(growth)
    rows = rows.where(F.col(label).isNotNull()).select(key, F.col(label).alias("label"), F.col(bins).alias("bins"))
    for level in range(growth.depth + 1):
        last = level == growth.depth
        entries = _level(rows, forest, level, key)
        # after the last split only labels are asked for
        entries = entries.where("feature < 0") if last else entries
        stats = materialise(entries, "split-statistics")
        majority = F.min(F.struct(-F.col("n"), "label"))["label"].alias("label")
        for r in stats.where("feature < 0").groupBy("tree", "node").agg(majority).collect():
            forest.labels[r["tree"], r["node"]] = r["label"]
        if last:
            break
        found = _grown(stats, growth)
        for r in found:
            forest.splits[r["tree"], r["node"]] = Split(r["feature"], r["cut"], r["right"], r["gain"])
        if not found:
            break
    return forest


def vote(df: DataFrame, forest: Forest, bins: str = "bins", out: str = "prediction") -> DataFrame:
    """Add the label that most trees give; of equally many the lowest."""
    votes = []
    for tree in range(forest.growth.trees):
        found = forest.node(tree, bins)
        leaves = {n: x for (t, n), x in forest.labels.items() if t == tree and (t, n) not in forest.splits}
        if not leaves:
            raise ValueError(f"tree {tree} was grown on no rows")
        cases = [F.when(found == n, F.lit(x)) for n, x in leaves.items()]
        votes.append(F.coalesce(*cases))
    all_votes = F.array_sort(F.array(*votes))
    counted = F.transform(
        F.array_distinct(all_votes),
        lambda v: F.struct((-F.size(F.filter(all_votes, lambda x: x == v))).alias("n"), v.alias("label")),
    )
    return df.withColumn(out, F.array_min(counted)["label"])


def importances(forest: Forest) -> dict[int, float]:
    """The share of each used feature in the gains, averaged over trees that have splits."""
    total: dict[int, float] = {}
    trees = sorted({t for t, _ in forest.splits})
    for tree in trees:
        gains = {n: s for (t, n), s in forest.splits.items() if t == tree}
        whole = sum(s.gain for s in gains.values())
        for node in sorted(gains):
            s = gains[node]
            total[s.feature] = total.get(s.feature, 0.0) + s.gain / whole / len(trees)
    return total


def equal_bins(df: DataFrame, columns: list[str], bins: int) -> DataFrame:
    """Add ``bins``: numeric columns in so many bins of equal width each, from one aggregate; null is bin 0."""
    ends = df.agg(*(f(c).cast("double").alias(f"{f.__name__}_{i}") for i, c in enumerate(columns) for f in (F.min, F.max))).first()
    pairs = []
    for i, c in enumerate(columns):
        low, high = ends[f"min_{i}"], ends[f"max_{i}"]
        width = (high - low) if low is not None and high > low else 1.0
        at = F.floor((F.col(c).cast("double") - F.lit(low or 0.0)) / F.lit(width) * bins).cast("int")
        pairs += [F.lit(i), F.when(at.isNull(), 0).otherwise(F.least(at, F.lit(bins - 1)) + 1)]
    return df.withColumn("bins", F.create_map(*pairs))


def word_bins(
    df: DataFrame, vocabulary: DataFrame, id_col: str, words: str = "words", most: int = 3, keep: tuple = ()
) -> DataFrame:
    """``(id, *keep, bins)``: counts up to ``most`` of the words of ``(word, feature)``."""
    counts = lookup_join(term_counts(df, id_col, words, keep), vocabulary.select("word", "feature"), "word")
    # other words are left out before rows meet; each document keeps the row of its first word, or without words its only one
    counts = counts.where(F.col("feature").isNotNull() | (F.coalesce("first_pos", F.lit(0)) == 0))
    entry = F.when(F.col("feature").isNotNull(), F.struct("feature", F.least("tf", F.lit(most)).cast("int")))
    return counts.groupBy(id_col, *keep).agg(F.map_from_entries(F.collect_list(entry)).alias("bins"))
