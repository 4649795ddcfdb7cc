"""Exact top-k search by inner product with the three-phase uniform threshold (operator 1)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from changewatch.llm.common import ship, written

CANDIDATES, QUERIES = 8192, 2048  # rows in a block


def whole_numbers(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256,
                  every_row: bool = False) -> DataFrame:
    """id and v, the components as floor(scale * x). Vectors that are null or hold null or non-finite components are left out, as
    are null ids. With ``every_row`` each other row counts, also where an id comes again; else, of several vectors with one id, the
    smallest does, so that repeated rows count once."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.when(finite, whole).alias("v"))
    rows = rows.where("id IS NOT NULL AND v IS NOT NULL")
    return rows if every_row else rows.groupBy("id").agg(F.min("v").alias("v"))


def product(a: str, b: str) -> Column:
    """Inner product; the shorter vector counts as filled up with zeros."""
    both = F.zip_with(a, b, lambda x, y: F.coalesce(x, F.lit(0)) * F.coalesce(y, F.lit(0)))
    return F.aggregate(both, F.lit(0).cast("long"), lambda total, x: total + x)


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    width = int(sizes.max(initial=0))
    filled = np.zeros((len(sizes), width), np.int64)
    filled[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return filled


def local_scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, exact: in doubles where no sum can reach 2**53, else in 64-bit numbers."""
    width = max(queries.shape[1], rows.shape[1])
    q, c = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (queries, rows))
    most = int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0)) * max(width, 1)
    if most < 1 << 53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, lists: int = 2) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` rows of ``vectors`` with the highest inner products (all, if fewer), ties
    to the smaller id. Both tables are as of ``whole_numbers``; a query's own row, that of its id and vector, is no candidate. Where ids
    come again, each row is a query and a candidate of its own.

    The components are cut into ``lists`` parts; a list holds the scores of one part, the score of a row is their sum.
    1. Each list gives its best rows for each query; they are scored exactly, and the k-th best score is the cutoff.
    2. A row whose every local score is below cutoff / lists is below the cutoff, so each list gives just the rows that
       reach that. The cutoffs travel with the queries.
    3. What was given by one list only and may still reach the cutoff is scored exactly.

    Equal vectors are searched for, and as, one: k + 1 of them are found for a query, so that it can leave itself out, and each gives
    its k + 1 smallest ids. So copies make no pairs. Queries and rows meet in blocks of bounded size. Vectors of unequal length are
    filled up with zeros; scores beyond 64 bits wrap."""
    spark = vectors.sparkSession
    ship(spark)
    depth = k + 1
    vectors, queries = written(vectors, "vectors"), written(queries, "queries")
    within = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    firsts = vectors.withColumn("n", within).where(F.col("n") <= depth).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    rows = written(firsts.withColumn("g", F.monotonically_increasing_id()), "rows")
    wanted = written(queries.select("v").distinct().withColumn("q", F.monotonically_increasing_id()), "wanted")
    n_rows, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).head()
    row_blocks = max(1, -(-n_rows // CANDIDATES))
    query_blocks = max(1, -(-wanted.count() // QUERIES))
    step = max(1, -(-(width or 1) // lists))
    parts = F.explode(F.transform(F.sequence(F.lit(0), F.lit(lists - 1)), lambda i: F.struct(
        i.alias("list"), F.slice("v", i * step + 1, F.lit(step)).alias("part"))))
    # both sides number blocks by one type: a key is dealt to a task by the hash of its value in its type
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    row_side = rows.select("g", block("g", row_blocks).alias("row_block"), parts.alias("p")).select(
        "g", "row_block", "p.list", "p.part").withColumn("query_block", every(query_blocks))

    def query_side(asked: DataFrame) -> DataFrame:
        return asked.select("q", "cutoff", block("q", query_blocks).alias("query_block"), parts.alias("p")).select(
            "q", "cutoff", "query_block", "p.list", "p.part").withColumn("row_block", every(row_blocks))

    def give(key: tuple[pa.Scalar, ...], own: pa.Table, asked: pa.Table) -> pa.Table:
        ids, candidates = own.column("g").to_numpy(), matrix(own.column("part"))
        names, asking = asked.column("q").to_numpy(), matrix(asked.column("part"))
        cutoffs = asked.column("cutoff").to_pylist()
        found: list[tuple[np.ndarray, ...]] = []
        for at in range(0, len(names), 256):
            scores = local_scores(asking[at:at + 256], candidates)
            for name, score, cutoff in zip(names[at:at + 256], scores, cutoffs[at:at + 256]):
                if cutoff is None:  # first phase: the best of this list, or all of a short one
                    best = np.argpartition(-score, depth)[:depth] if len(score) > depth else np.arange(len(score))
                else:
                    best = np.flatnonzero(score * lists >= cutoff)
                found.append((np.full(len(best), name), ids[best], score[best]))
        columns = [np.concatenate(column) for column in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(np.asarray(column, np.int64)) for column in columns], ["q", "g", "score"])

    def ask(asked: DataFrame) -> DataFrame:
        meet = ["list", "row_block", "query_block"]
        return row_side.groupBy(*meet).cogroup(query_side(asked).groupBy(*meet)).applyInArrow(
            give, "q long, g long, score long")

    def scored(pairs: DataFrame) -> DataFrame:
        full = pairs.join(rows, "g").join(wanted.withColumnRenamed("v", "w"), "q")
        return full.select("q", "g", product("v", "w").alias("score"))

    highest = Window.partitionBy("q").orderBy(F.desc("score"))
    first = scored(ask(wanted.withColumn("cutoff", F.lit(None).cast("long"))).select("q", "g").distinct())
    reached = first.withColumn("n", F.row_number().over(highest)).where(F.col("n") <= depth).groupBy("q").agg(
        F.min("score").alias("lowest"), F.count(F.lit(1)).alias("n"))
    # with fewer rows than asked for, every row counts
    least = F.when(F.col("n") == depth, F.col("lowest")).otherwise(F.lit(-(1 << 62)))
    cutoffs = wanted.join(reached, "q").select("q", "v", least.alias("cutoff"))
    cutoffs = written(cutoffs, "cutoffs")
    given = ask(cutoffs).groupBy("q", "g").agg(F.sum("score").alias("score"), F.count(F.lit(1)).alias("n"))
    given = written(given.join(cutoffs.select("q", "cutoff"), "q"), "given")
    whole = given.where(F.col("n") == lists).select("q", "g", "score")
    open_pairs = given.where((F.col("n") < lists) & (
        F.col("score") * lists + (lists - F.col("n")) * F.col("cutoff") >= F.col("cutoff") * lists)).select("q", "g")
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.col("ids")[0])
    results = whole.union(scored(open_pairs)).join(rows.select("g", "ids", F.col("v").alias("found")), "g").withColumn(
        "n", F.row_number().over(best)).where(F.col("n") <= depth)
    results = results.join(wanted, "q").select("q", F.col("found").eqNullSafe(F.col("v")).alias("own"), F.explode("ids").alias("vec_id"), "score")
    ranked = results.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")))
    tops = written(ranked.where(F.col("n") <= depth).groupBy("q").agg(
        F.sort_array(F.collect_list(F.struct("n", "vec_id", "score", "own"))).alias("top")), "results")
    own = F.array_position(F.transform("top", lambda x: x["own"] & (x["vec_id"] == F.col("query_id"))), F.lit(True))
    asked = queries.join(wanted, "v").join(tops, "q").select(F.col("id").alias("query_id"), "top").withColumn("at", own)
    others = asked.select("query_id", F.posexplode(F.filter("top", lambda x: x["n"] != F.col("at"))).alias("place", "x"))
    return others.where(F.col("place") < k).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


SQL = """
WITH whole AS (
  SELECT vec_id, CAST(list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
