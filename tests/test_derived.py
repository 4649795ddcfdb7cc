"""The derived tables: the key space of items grows with events, and one item stays hot."""

from pyspark.sql import functions as F

from changewatch.plans import items
from changewatch.sources import derived


def test_items_grow_and_one_is_hot(spark):
    sizes, hot = [], f"Q{78 * 400009 + 1}"
    for folder in ("sf0.001", "sf0.01", "sf0.1"):
        tables = derived.from_events(spark, f"/root/testdata/{folder}")
        usage = tables["entity_usage"]
        sizes.append(usage.count())
        assert usage.select("qid").distinct().count() == sizes[-1]
        links = tables["triples"].filter(F.col("predicate").isin("P31", "P279")).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("object") == hot).alias("hot")).head()
        assert links.hot > 0.25 * links.n
    assert sizes[0] <= 397 < sizes[1] < sizes[2] and sizes[2] > 9000
    facts = items.item_facts(tables["triples"], tables["entity_usage"].select(F.col("qid").alias("item")))
    most = facts.orderBy(F.desc("backlinks")).first()
    assert most.item == hot and most.backlinks > 1000
    assert facts.count() > 9000
