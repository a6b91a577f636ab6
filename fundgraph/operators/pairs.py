"""Pairs of items that share a key, split so that no hot key lands in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

#: Rows of one key that a single join cell may hold on either side.
BLOCK = 2000


def shared_key_pairs(
    rows: DataFrame,
    key: str,
    item: str,
    keep: Column | None = None,
    extra: tuple[str, ...] = (),
    block: int = BLOCK,
) -> DataFrame:
    """One row (key, a, b) with a < b per pair of items sharing the key.

    ``rows`` holds distinct (key, item).  A key with n rows is cut into
    ceil(n/block) blocks by the item's hash and joined block against block, so a
    cell never sees more than about ``block`` rows per side whatever n is.
    ``keep`` may filter on a_<extra> / b_<extra> inside the join, before a row is
    emitted.
    """
    # a stored table of sizes makes the join a plain one, in which the engine splits a hot key;
    # the copies of its rows are then made by all tasks
    sizes = cut(rows.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1"), "sizes")
    cells = (
        rows.select(key, item, *extra)
        .join(sizes, key)
        .withColumn("_blocks", F.ceil(F.col("_n") / block).cast("int"))
        .withColumn("_own", F.pmod(F.xxhash64(item), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("_lo", F.least("_own", "_other"))
        .withColumn("_hi", F.greatest("_own", "_other"))
    )

    def side(p: str) -> DataFrame:
        renames = [F.col(c).alias(f"{p}_{c}") for c in extra]
        return cells.select(key, "_lo", "_hi", F.col(item).alias(p), F.col("_own").alias(f"{p}_own"), *renames)

    # a pair meets in every cell of its blocks; it counts only in its own cell
    here = (F.col("a") < F.col("b")) & (F.col("a_own") + F.col("b_own") == F.col("_lo") + F.col("_hi"))
    pairs = side("a").join(side("b"), [key, "_lo", "_hi"]).filter(here)
    if keep is not None:
        pairs = pairs.filter(keep)
    return pairs.drop("_lo", "_hi", "a_own", "b_own")


def co_client_pairs(fm: DataFrame, block: int = BLOCK) -> DataFrame:
    """(manager, fund_a, fund_b), fund_a < fund_b, for funds that share a manager."""
    d = cut(fm.select("manager_ein", "fund_ein").distinct(), "pairs")
    p = shared_key_pairs(d, "manager_ein", "fund_ein", block=block)
    return p.withColumnsRenamed({"a": "fund_a", "b": "fund_b"})


def _coded(c: Column) -> Column:
    """The whole number that a text is the plain spelling of, else null."""
    n = c.try_cast("bigint")
    return F.when(n.cast("string") == c, n)


def partner_lists(fm: DataFrame, block: int = BLOCK) -> DataFrame:
    """(fund_a, partners): per fund and block of a manager's clients, the clients behind the fund as one array.

    The array takes the place of a row per pair: what is shuffled is a fund's id once per list and the
    partners' ids alone, as numbers where every fund's id is one.  A manager's clients are cut into blocks
    of about ``block`` funds, so no array is longer, whatever the manager's size.
    """
    d = cut(fm.select("manager_ein", "fund_ein").filter("manager_ein is not null and fund_ein is not null").distinct(), "pairs")
    hubs = cut(d.groupBy("manager_ein").agg(F.count("*").alias("_n")).filter(F.col("_n") > block), "sizes")
    texts = dict(d.dtypes)["fund_ein"] != "string" or not d.filter(_coded(F.col("fund_ein")).isNull()).isEmpty()

    def lists(how: str) -> DataFrame:
        blocks = F.coalesce(F.ceil(F.col("_n") / block), F.lit(1)).cast("int")
        placed = d.join(hubs, "manager_ein", how).withColumn("_own", F.pmod(F.xxhash64("fund_ein"), blocks))
        # as long as a block
        return placed.groupBy("manager_ein", "_own").agg(F.sort_array(F.collect_list("fund_ein")).alias("clients"))

    def code(c: str | Column) -> Column:
        return F.col(c) if texts and isinstance(c, str) else c if texts else F.transform(c, lambda x: x.cast("bigint"))

    at = lists("left").select(code("clients").alias("clients")).select("clients", F.posexplode("clients").alias("_at", "fund_a"))
    near = at.select("fund_a", F.slice("clients", F.col("_at") + 2, F.size("clients")).alias("partners"))
    # blocks of one manager meet as two rows, which are dealt out before they are unfolded
    far = lists("inner")
    met = far.join(far.select("manager_ein", F.col("_own").alias("_other"), F.col("clients").alias("others")), "manager_ein").filter("_own <> _other")
    met = met.repartition("manager_ein", "_own", "_other").select("others", F.explode("clients").alias("a"))
    met = met.select(F.col("a") if texts else F.col("a").cast("bigint"), code(F.filter("others", lambda x: x > F.col("a"))))
    return near.union(met).filter(F.size("partners") > 0)


def shared_manager_counts(fm: DataFrame, block: int = BLOCK) -> DataFrame:
    """Shared managers per unordered fund pair, fund_a < fund_b.

    The lists are dealt by fund and only then unfolded, so pairs are counted where they are, without another shuffle.
    """
    pairs = partner_lists(fm, block).repartition("fund_a").select("fund_a", F.explode("partners").alias("fund_b"))
    counted = pairs.groupBy("fund_a", "fund_b").agg(F.count("*").alias("shared_managers"))
    kind = dict(fm.dtypes)["fund_ein"]
    return counted.select(F.col("fund_a").cast(kind), F.col("fund_b").cast(kind), "shared_managers")


def fund_fund_edges(fm: DataFrame, block: int = BLOCK) -> DataFrame:
    """Shared managers per ordered fund pair, both directions: every pair is counted
    once and then emitted in both directions from the same row."""
    both = F.explode(F.array(F.struct("fund_a", "fund_b"), F.struct(F.col("fund_b").alias("fund_a"), F.col("fund_a").alias("fund_b"))))
    counted = shared_manager_counts(fm, block).select(both.alias("p"), "shared_managers")
    return counted.select("p.fund_a", "p.fund_b", "shared_managers")


def shared_totals(fm: DataFrame) -> DataFrame:
    """Sum of shared managers over all partners of a fund, without building pairs.

    A fund meets clients(m) - 1 partners at each of its managers m, so the sum
    over partners equals the sum over managers: linear in the edges.
    """
    d = cut(fm.select("fund_ein", "manager_ein").distinct(), "pairs")
    clients = cut(d.groupBy("manager_ein").agg(F.count("*").alias("_clients")).filter("_clients > 1"), "sizes")
    return (
        d.join(clients, "manager_ein")
        .groupBy(F.col("fund_ein").alias("ein"))
        .agg(F.sum(F.col("_clients") - 1).alias("total_shared_managers"))
    )
