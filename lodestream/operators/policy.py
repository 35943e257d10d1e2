"""Policy decisions on recorded calls: bands, provenance of consent, remediation, criticality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Highest level that is free without consent, by tier and whether the call writes (fixed values).
FREE_BAND = {(1, False): 4, (1, True): 2, (2, False): 2, (2, True): 2, (3, False): 1, (3, True): 1}
#: Order of actions, the weakest first (fixed values).
ACTION_PRIORITY = {"allow": 0, "suppress": 1, "minimize": 2, "elicit": 3, "consent_gate": 4, "t3_block": 5, "vault_redirect": 6, "hard_deny": 7}
#: Part of the criticality by tier and by decision branch (fixed values).
TIER_WEIGHT = {3: 0.15, 2: 0.10, 1: 0.05}


def free_band(tier: Column, is_write: Column, default: int = 0) -> Column:
    found = F.lit(default)
    for (t, w), level in FREE_BAND.items():
        found = F.when((tier == t) & (is_write == F.lit(w)), level).otherwise(found)
    return found.cast("long")


def above_band(tier: Column, is_write: Column, level: Column, encrypted: Column | None = None) -> Column:
    """Why a call lies outside its band: a local write of level 3 or more that isn't encrypted, or missing authorization; '' within the band."""
    local = (tier == 1) & is_write & (level >= 3)
    reason = F.when(local, "local_write_above_band").when(level > free_band(tier, is_write), "missing_authorization").otherwise("")
    return F.when((reason == "local_write_above_band") & encrypted, "missing_authorization").otherwise(reason) if encrypted is not None else reason


def action(tier: Column, is_write: Column, level: Column) -> Column:
    """The decision on a single call without history: reads pass; local writes above the band are denied, other calls above it need
    consent; writes of level 2 or more within it are minimised."""
    reason = above_band(tier, is_write, level)
    return F.when(~is_write, "allow").when(reason == "local_write_above_band", "hard_deny").when(reason != "", "consent_gate").when(level >= 2, "minimize").otherwise("allow")


def priority(name: Column) -> Column:
    pairs = [F.lit(x) for item in ACTION_PRIORITY.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[name], F.lit(0))


def most_severe(df: DataFrame, by: list[str], action_col: str, order: str) -> DataFrame:
    """The action of highest priority of each group, the first of equal ones."""
    best = F.max_by(F.col(action_col), F.struct(priority(F.col(action_col)), -F.col(order)))
    return df.groupBy(*by).agg(best.alias(action_col), F.count("*").alias("n_calls"))


def later_reads(writes: DataFrame, reads: DataFrame, key: list[str], order: str) -> DataFrame:
    """Each write with its number of later reads of the same key, by one window over both (no self join)."""
    both = writes.select(*key, order, F.lit(True).alias("_w")).unionByName(reads.select(*key, order, F.lit(False).alias("_w")))
    after = Window.partitionBy(*key).orderBy(order, "_w").rowsBetween(1, Window.unboundedFollowing)
    counted = both.withColumn("n_reads", F.coalesce(F.sum((~F.col("_w")).cast("long")).over(after), F.lit(0)))
    return counted.filter("_w").drop("_w")


def remediation(n_reads: Column) -> Column:
    return F.when(n_reads >= 5, "exception").when(n_reads >= 3, "vault").when(n_reads >= 1, "manual").otherwise("none")


def criticality(level: Column, tier: Column, branch_weight: Column, has_action: Column) -> Column:
    weight = F.lit(0.0)
    for t, w in TIER_WEIGHT.items():
        weight = F.when(tier == t, w).otherwise(weight)
    return F.least(F.lit(1.0), F.round(0.15 * level + branch_weight + weight + F.when(has_action, 0.1).otherwise(0.0), 6))


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first k rows of each group (the feature is the limit)."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(name, n.cast("long")).filter(F.col(name) <= k)


def split_budget(df: DataFrame, by: list[str], order: list[Column], budget: int, name: str = "share") -> DataFrame:
    """Deals a group's budget over its rows, the remainder to the first ones."""
    n = F.count("*").over(Window.partitionBy(*by))
    k = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(name, (F.floor(F.lit(budget) / n) + (k <= F.lit(budget) % n).cast("long")).cast("long"))


def sample_per_group(df: DataFrame, by: list[str], key: Column, k: int) -> DataFrame:
    """A seeded sample of k rows of each group: the smallest digests of ``key``."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(F.md5(key.cast("string").cast("binary"))))
    return df.withColumn("_n", n).filter(F.col("_n") <= k).drop("_n")
