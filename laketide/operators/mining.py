"""Data mining for the side lake (W4): frequent item sets and rules."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketide.session import shared_dir


def mine_itemsets(df: DataFrame, basket: str, item: str, support: float,
                  confidence: float, partitions: int | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """Frequent item sets and association rules over (basket, item) rows.

    Baskets are item sets (``collect_set`` per basket, so a repeated item
    counts once); MLlib's FP-Growth mines them in parallel (PFP: item-group
    conditional databases are built per partition, no candidate pairs).
    The basket table is checkpointed into the shared folder first: FP-Growth
    and the item-set and rule outputs each read it again, and a lost
    executor then re-reads files instead of redoing the grouping.
    Returns (itemsets, rules):

    * itemsets: ``items`` (sorted array), ``size``, ``freq``, ``support``
    * rules: ``antecedent``, ``consequent``, ``confidence``, ``lift``,
      ``support`` (of antecedent and consequent together)
    """
    shared_dir(df.sparkSession)
    baskets = (df.where(F.col(item).isNotNull())
               .groupBy(basket).agg(F.collect_set(F.col(item)).alias("items"))
               .checkpoint(eager=True))
    fp = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence)
    if partitions:
        fp = fp.setNumPartitions(partitions)
    model = fp.fit(baskets)
    n = baskets.count()
    itemsets = model.freqItemsets.select(
        F.array_sort("items").alias("items"), F.size("items").alias("size"),
        F.col("freq"), (F.col("freq") / F.lit(n)).alias("support"))
    rules = model.associationRules.select(
        F.array_sort("antecedent").alias("antecedent"),
        F.array_sort("consequent").alias("consequent"),
        "confidence", "lift", "support")
    return itemsets, rules
