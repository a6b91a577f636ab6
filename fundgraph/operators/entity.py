"""Provider names to parent groups.

Names are compared by token-sort similarity.  Pairs are found without comparing
all names.  Where few characters may differ, names meet in the common subsequence that
the threshold asks for: its number per name depends on the name's length alone.  Other names
are indexed under their rarest q-grams only, as many as the score threshold needs, and only
names sharing such a gram within the allowed lengths are scored.  No pair that reaches
the threshold is lost.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import clean_name, is_person, sorted_ratio_at_least, token_sort
from ..session import cut, discard
from .pairs import shared_key_pairs
from .ranking import dense_index

GRAM_SIZES = (3, 2, 1)

#: Subsequences that the two names of a pair may have to be indexed under; beyond it grams are.
SUBSEQUENCES = 1000


class Bounds:
    """Length and shared-gram bounds that a score >= ``threshold`` implies.

    With s = |a| + |b| and common subsequence L >= tau*s (tau = threshold/200):
    the shorter length is at least ratio = tau/(1-tau) of the longer, and the
    strings share at least (2q-1)L - (q-1)s - (q-1) occurrence-numbered q-grams.
    """

    def __init__(self, threshold: float):
        self.tau = threshold / 200.0
        self.ratio = self.tau / (1 - self.tau)

    def common(self, s: int) -> int:
        """Length of a common subsequence that is certain for the length sum s."""
        return math.ceil(self.tau * s - 1e-9)

    def by_subsequence(self, lengths: set[int], most: int = SUBSEQUENCES) -> tuple[list[int], dict[int, set[int]]]:
        """Length sums whose pairs meet in common subsequences, and per number of characters left out the lengths that need it."""
        met: dict[int, list[tuple[int, int]]] = {}
        for n in lengths:
            for m in range(math.ceil(n * self.ratio - 1e-9), n + 1):
                if m in lengths and self.common(n + m) <= m:
                    met.setdefault(n + m, []).append((n, m))
        sums, left_out = [], {}
        for s, pairs in met.items():
            if all(math.comb(n, self.common(s)) + math.comb(m, self.common(s)) <= most for n, m in pairs):
                sums.append(s)
                for n in {n for pair in pairs for n in pair}:
                    left_out.setdefault(n - self.common(s), set()).add(n)
        return sorted(sums), left_out

    def slope(self, q: int) -> float:
        return (2 * q - 1) * self.tau - (q - 1)

    def first_sum(self, q: int) -> float:
        """Smallest s for which at least one shared q-gram is certain."""
        return math.ceil(q / self.slope(q) - 1e-9) if self.slope(q) > 1e-9 else math.inf

    def sums(self, q: int) -> tuple[float, float]:
        """Range [lo, hi) of s handled with grams of size q."""
        bigger = [self.first_sum(g) for g in GRAM_SIZES if g > q]
        hi = min(bigger, default=math.inf)
        return (0 if q == min(GRAM_SIZES) else min(self.first_sum(q), hi)), hi


def grams(c: str, q: int) -> Column:
    """Distinct q-grams of a string: a repeated gram is numbered by occurrence."""
    x = F.col(c)
    raw = F.transform(F.sequence(F.lit(1), F.length(x) - (q - 1)), lambda i: F.substr(x, i, F.lit(q)))
    return F.transform(
        raw, lambda g, i: F.concat(g, F.lit("#"), F.size(F.filter(F.slice(raw, 1, i + 1), lambda h: h == g)).cast("string"))
    )


def subsequences(c: str, k: int) -> Column:
    """Hashes of what is left of a string when any k of its characters are left out."""
    state = F.array(F.struct(F.col(c).alias("t"), F.lit(1).alias("p")))

    def without(s: Column) -> Column:
        # places from that of the character left out before on, so that no choice comes twice
        places = F.when(s["p"] <= F.length(s["t"]), F.sequence(s["p"], F.length(s["t"]))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.struct(F.concat(F.substr(s["t"], F.lit(1), i - 1), F.substr(s["t"], i + 1)).alias("t"), i.alias("p")))

    for _ in range(k):
        state = F.flatten(F.transform(state, without))
    return F.array_distinct(F.transform(state, lambda s: F.xxhash64(s["t"])))


def _meeting(names: DataFrame, sums: list[int], left_out: dict[int, set[int]]) -> DataFrame:
    """Pairs of names of these length sums that have a common subsequence of the length needed."""
    # a name becomes up to hundreds of keys, so the short table of names is dealt to all tasks first
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    coded = cut(dense_index(names, ["name"], "n").repartition(tasks, "n"), "names")
    parts = [
        coded.filter(F.col("len").isin(sorted(lengths))).select("n", "len", F.explode(subsequences("name", k)).alias("key"))
        for k, lengths in sorted(left_out.items())
    ]
    keep = (F.col("a_len") + F.col("b_len")).isin(sums)
    found = shared_key_pairs(reduce(DataFrame.union, parts), "key", "n", keep, ("len",)).select("a", "b").distinct()
    a, b = (coded.select(F.col("n").alias(x), F.col("name").alias(f"_{x}")) for x in "ab")
    return found.join(a, "a").join(b, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))


def _candidates(names: DataFrame, q: int, bounds: Bounds, settled: list[int] | None = None) -> DataFrame:
    """Pairs of names whose length sum belongs to gram size q, but is not ``settled``, and that share a rare gram."""
    lo, hi = bounds.sums(q)
    n = F.col("len")
    partner_max, partner_min = F.floor(n / bounds.ratio + 1e-9), F.ceil(n * bounds.ratio - 1e-9)
    part = names.filter((n >= q) & (n + partner_max >= lo))
    if hi != math.inf:
        part = part.filter(n + partner_min < hi)
    least_sum = F.greatest(n + partner_min, F.lit(lo))
    need = F.greatest(F.lit(1), F.ceil(bounds.slope(q) * least_sum - (q - 1) - 1e-9)).cast("int")
    rows = part.select("name", "len", need.alias("need"), F.explode(grams("name", q)).alias("gram"))
    freq = rows.groupBy("gram").agg(F.count("*").alias("freq")).filter("freq > 1")
    # grams held by one name cannot join; they still count as that name's rarest
    lone = (n - (q - 1)) - F.col("held")
    shared = rows.join(freq, "gram")
    by_name = Window.partitionBy("name").orderBy("freq", "gram")
    held = Window.partitionBy("name")
    index = (
        shared.withColumn("pos", F.row_number().over(by_name))
        .withColumn("held", F.count("*").over(held))
        .filter(F.col("pos") + lone <= (n - (q - 1)) - F.col("need") + 1)
        .select("gram", "name", "len")
    )
    total = F.col("a_len") + F.col("b_len")
    short, longer = F.least("a_len", "b_len"), F.greatest("a_len", "b_len")
    keep = (short >= longer * bounds.ratio - 1e-9) & (total >= lo)
    if hi != math.inf:
        keep = keep & (total < hi)
    if settled:
        keep = keep & ~total.isin(settled)
    return shared_key_pairs(index, "gram", "name", keep, ("len",)).select("a", "b").distinct()


def candidate_pairs(distinct: DataFrame, bounds: Bounds) -> DataFrame:
    """(a, b): pairs of names, among them all that reach the threshold; ``distinct``: name, len."""
    lengths = {r[0] for r in distinct.select("len").distinct().collect()}
    sums, left_out = bounds.by_subsequence(lengths)
    parts = [_meeting(distinct, sums, left_out)] if sums else []
    open_lengths = sorted({x for n in lengths for m in lengths if min(n, m) >= max(n, m) * bounds.ratio - 1e-9 and n + m not in sums for x in (n, m)})
    if open_lengths:
        rest = distinct.filter(F.col("len").isin(open_lengths))
        parts += [_candidates(rest, q, bounds, sums) for q in GRAM_SIZES if bounds.sums(q)[0] < bounds.sums(q)[1]]
    # a pair has one length sum, so the parts do not overlap
    return reduce(DataFrame.union, parts) if parts else distinct.select(F.col("name").alias("a"), F.col("name").alias("b")).limit(0)


def similar_names(names: DataFrame, col: str = "name", threshold: float = 85) -> DataFrame:
    """(a, b, score) with a < b for all different token-sorted names scoring >= threshold."""
    bounds = Bounds(threshold)
    distinct = names.select(F.col(col).alias("name")).distinct().filter("name <> ''")
    distinct = cut(distinct.withColumn("len", F.length("name")), "names")
    scored = candidate_pairs(distinct, bounds).withColumn("score", sorted_ratio_at_least("a", "b", threshold))
    return cut(scored, "pairs").filter("score is not null")


def similar_pairs(managers: DataFrame, threshold: float = 85) -> DataFrame:
    """Similar clean names of a manager table."""
    return similar_names(managers.select(token_sort("name_clean").alias("name")), "name", threshold)


def drop_persons(managers: DataFrame, col: str = "name") -> DataFrame:
    return managers.withColumn("is_person", is_person(col)).filter(~F.col("is_person"))


def greedy_groups(rows: DataFrame, pairs: DataFrame, order_by: tuple[str, ...] = ("ein", "name")) -> DataFrame:
    """Parent group of every EIN: ein, parent_group_id.

    ``rows``: ein, sorted_name and the order columns; ``pairs``: (a, b) similar
    names.  Result of the sequential rule "the next EIN without a group opens one
    with its first name and takes every EIN that has a similar name", computed in
    parallel rounds.  All EINs sharing a first name give at most one leader (it
    takes the others), so candidates are kept per name: the earliest open EIN of
    a name leads if no similar name of its rows has an earlier open candidate.
    No two EINs are ever paired; every step is a join or minimum over rows.
    """
    order = F.struct(*order_by)
    per_ein = rows.groupBy("ein").agg(
        F.min(order).alias("rank"), F.min_by("sorted_name", order).alias("first_name")
    )
    ranked = dense_index(per_ein.select("ein", "first_name", *[F.col(f"rank.{c}").alias(f"o_{c}") for c in order_by]), [f"o_{c}" for c in order_by], "rank")
    eins = cut(ranked.select("ein", "first_name", "rank"), "eins")
    ein_names = cut(
        rows.select("ein", F.col("sorted_name").alias("name")).distinct().join(eins.select("ein", "rank"), "ein"), "ein_names"
    )
    both = pairs.select("a", "b").union(pairs.select("b", "a"))
    near = cut(both.toDF("name", "other").union(ein_names.select("name", F.col("name").alias("other")).distinct()), "near")

    def reach(per_name: DataFrame) -> DataFrame:
        """Smallest value over the names similar to each name (itself included)."""
        return near.join(per_name.select(F.col("name").alias("other"), "value"), "other").groupBy("name").agg(F.min("value").alias("value"))

    leaders: DataFrame | None = None
    open_eins = eins
    while True:
        candidate = open_eins.groupBy(F.col("first_name").alias("name")).agg(F.min("rank").alias("value"))
        heads = candidate.select(F.col("value").alias("rank"), F.col("name").alias("first_name"))
        # a candidate leads when nothing open ahead of it could take it first
        ahead = ein_names.join(heads.select("rank"), "rank").join(reach(candidate), "name").groupBy("rank").agg(F.min("value").alias("ahead"))
        new = heads.join(ahead, "rank").filter("ahead >= rank").select(F.col("first_name").alias("name"), F.col("rank").alias("value"))
        leaders_next = cut(new if leaders is None else leaders.union(new), "leaders")
        taken = ein_names.join(reach(leaders_next), "name").filter("value <= rank").select("rank").distinct()
        rest = cut(open_eins.join(taken, "rank", "left_anti"), "open")
        if leaders is not None:
            discard(leaders, open_eins)
        leaders, open_eins = leaders_next, rest
        if rest.isEmpty():
            break
    ids = dense_index(leaders.select(F.col("value").alias("leader")), ["leader"], "parent_group_id")
    group = ein_names.join(reach(leaders), "name").groupBy("ein").agg(F.min("value").alias("leader"))
    return group.join(ids, "leader").select("ein", "parent_group_id")


def component_groups(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Alternative grouping: EINs linked through any chain of similar names."""
    from .components import connected_components

    own = rows.select(F.concat(F.lit("e:"), "ein").alias("src"), F.concat(F.lit("n:"), "sorted_name").alias("dst"))
    links = pairs.select(F.concat(F.lit("n:"), "a").alias("src"), F.concat(F.lit("n:"), "b").alias("dst"))
    comp = connected_components(own.union(links).distinct())
    eins = comp.filter(F.col("id").startswith("e:"))
    return eins.select(F.expr("substr(id, 3)").alias("ein"), F.expr("substr(component, 3)").alias("component"))


def prepare_managers(managers: DataFrame) -> DataFrame:
    """Clean names, drop person names, add the token-sorted form.

    The manager table is written first: it is far smaller than the payment lines
    it comes from, and Catalyst would push the name filter below that
    aggregation and run its patterns on every line.
    """
    m = cut(managers, "managers").withColumn("name_clean", clean_name("name"))
    return cut(drop_persons(m), "clean").withColumn("sorted_name", token_sort("name_clean"))


def enrich_managers(managers: DataFrame, threshold: float = 85, order_by: tuple[str, ...] = ("ein", "name")) -> DataFrame:
    """Manager rows (persons removed) with parent group, its size and the shared-parent flag."""
    m = cut(prepare_managers(managers), "managers")
    groups = greedy_groups(m, similar_pairs(m, threshold), order_by)
    out = m.drop("sorted_name").join(groups, "ein", "left")
    sizes = out.groupBy("parent_group_id").agg(F.count("*").alias("group_size"))
    return out.join(sizes, "parent_group_id", "left").withColumn("same_parent_flag", (F.col("group_size") > 1).cast("int"))
