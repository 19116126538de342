"""Priority-ordered classification rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclebook.functions.text import blank_to_na, has_text, squish, ukey
from cyclebook.operators.ranking import keep_first
from cyclebook.schema import LOWEST_PRIORITY, RULE_COLUMNS
from cyclebook.sources.conform import add_missing_cols, union_all

RULE_KEYS = ("raw_product_key", "raw_price_basis_key", "raw_index_key",
             "raw_location_key", "raw_pipeline_key")
PRODUCT = "raw_product_key"
OUTCOMES = ("itf", "index_group", "key_id", "y_n")

Tiers = Sequence[tuple[dict[str, str], Sequence[str]]]


def active_flag(c: str):
    """Yes-words and blanks are active; everything else is not."""
    token = F.upper(squish(c))
    return F.when(~has_text(c), True).otherwise(token.isin("TRUE", "YES", "Y", "1"))


def prepare_rules(raw: DataFrame) -> DataFrame:
    """Active rules with matching keys; sheet order is kept in ``rule_ord``."""
    if "rule_ord" not in raw.columns:
        raw = raw.withColumn("rule_ord", F.monotonically_increasing_id())
    raw = add_missing_cols(raw, RULE_COLUMNS)
    priority = F.col("rule_priority").cast("string").try_cast("double")
    return (
        raw.withColumns({
            "active_bool": active_flag("active"),
            "rule_priority": F.coalesce(F.nanvl(priority, F.lit(None)), F.lit(LOWEST_PRIORITY)),
            **{f"{c}_key": ukey(c) for c in
               ("raw_product", "raw_price_basis", "raw_index", "raw_location", "raw_pipeline")},
            "key_id": blank_to_na("key_id"),
            "index_group": blank_to_na("index_group"),
            "itf": blank_to_na("index_trade_financial"),
            "y_n": blank_to_na("y_n"),
        })
        .filter(F.col("active_bool") & F.col("raw_product_key").isNotNull())
    )


def tier_table(rules: DataFrame, keys: Sequence[str], absent: Sequence[str], tag: str) -> DataFrame:
    """Best rule per key combination of one tier, outcomes prefixed with ``tag``."""
    rows = rules
    for k in keys:
        rows = rows.filter(F.col(k).isNotNull())
    for k in absent:
        rows = rows.filter(F.col(k).isNull())
    best = keep_first(rows, keys, [F.col("rule_priority").asc(), F.col("rule_ord").asc()])
    return best.select(*[F.col(k).alias(f"{tag}_{k}") for k in keys],
                       *[F.col(c).alias(f"{tag}_{c}") for c in OUTCOMES])


def product_rules(rules: DataFrame, tiers: Tiers) -> DataFrame:
    """One row per product: the best rules of all tiers, the most specific tier first."""
    more = [k for k in RULE_KEYS if k != PRODUCT and any(k in on for on, _ in tiers)]
    parts = []
    for i, (on, absent) in enumerate(tiers):
        table = tier_table(rules, list(on), absent, "t")
        parts.append(table.select(F.col(f"t_{PRODUCT}").alias("r_product"), F.struct(
            F.lit(i).alias("tier"),
            *[(F.col(f"t_{k}") if k in on else F.lit(None).cast("string")).alias(k) for k in more],
            *[F.col(f"t_{c}").alias(c) for c in OUTCOMES]).alias("rule")))
    return union_all(parts).groupBy("r_product").agg(F.sort_array(F.collect_list("rule")).alias("r_rules"))


def match_tiers(df: DataFrame, rules: DataFrame, tiers: Tiers) -> DataFrame:
    """Attach ``itf, index_group, key_id, y_n`` from the most specific tier that has each.

    A tier maps rule keys to trade columns and lists the rule keys that must be absent; the product is
    a key of every tier. Every outcome is taken on its own, so a trade may mix two rules. The trades
    meet the rules once, by product, and look through the few rules of theirs; a tier holds one rule per
    key combination, so trades are never multiplied. The rule side is small enough for Catalyst to
    broadcast, or carries a checked hint from ``load_reference``; else the trades move once, not once
    for each tier.
    """
    product = tiers[0][0][PRODUCT]
    lookup = product_rules(rules, tiers)
    out = df.join(lookup, df[product] == lookup["r_product"], "left")

    def fits(rule: Column) -> Column:
        found = F.lit(False)
        for i, (on, _) in enumerate(tiers):
            same = rule["tier"] == i
            for key, trade in on.items():
                if key != PRODUCT:
                    same &= rule[key] == F.col(trade)
            found |= F.coalesce(same, F.lit(False))
        return found

    if any(len(on) > 1 for on, _ in tiers):
        out = out.withColumn("r_rules", F.filter("r_rules", fits))
    return out.withColumns({
        f"r_{c}": F.try_element_at(F.filter(F.col(f"r_rules.{c}"), lambda x: x.isNotNull()), F.lit(1)) for c in OUTCOMES
    }).drop("r_product", "r_rules")


ONE_TIER = [({"raw_product_key": "product_key"}, ())]

# A price-basis rule beats a rule on the product alone.
MODERN_TIERS = [
    ({"raw_product_key": "product_key", "raw_price_basis_key": "price_basis_key"}, ()),
    ({"raw_product_key": "product_key"}, ("raw_price_basis_key",)),
]

NEON_TIERS = [
    ({"raw_product_key": "product_key", "raw_index_key": "index_key",
      "raw_pipeline_key": "pipeline_key"}, ()),
    ({"raw_product_key": "product_key", "raw_index_key": "index_key",
      "raw_location_key": "location_key"}, ("raw_pipeline_key",)),
    ({"raw_product_key": "product_key", "raw_index_key": "index_key"},
     ("raw_pipeline_key", "raw_location_key")),
    ({"raw_product_key": "product_key"},
     ("raw_index_key", "raw_pipeline_key", "raw_location_key")),
]


def neon_rules(rules: DataFrame) -> DataFrame:
    """Rules whose price basis stands in for a missing index."""
    return rules.withColumn("raw_index_key", F.coalesce("raw_index_key", "raw_price_basis_key"))
