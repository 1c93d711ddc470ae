"""Exact top-k inner products by Fagin's threshold algorithm.

The candidates are dealt into blocks. In a block, every dimension has its rows
sorted by value; a query goes down the lists of all dimensions at once, from
the top where its own component is positive and from the bottom where it is
negative. Each row met is scored in full. After each step the bound, the score
of a row that would sit at the current depth of every list, is compared with
the k-th best score known: below it, nothing unseen can enter, and the search
stops. On equality it goes on, for a smaller id would win the tie.

A first round searches one block per query; its k-th scores are the floor the
other blocks start from. Blocks hold at most about ``BLOCK_ROWS`` rows and meet
at most ``CHUNK_QUERIES`` queries at a time, so a task's memory is bounded.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelgrid.llm.scratch import Kept

BLOCK_ROWS = 8192
CHUNK_QUERIES = 512
FIRST_STEP = 16
FOUND = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id, x``: components as floor(scale * x); vectors with a null or non-finite component are left out."""
    x = F.col(vector_col)
    whole = (
        F.col("x").isNotNull()
        & ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    )
    return (
        vectors.select(F.col(id_col).alias("vec_id"), x.cast("array<double>").alias("x"))
        .filter(whole & F.col("vec_id").isNotNull())
        .select("vec_id", F.transform("x", lambda v: F.floor(v * F.lit(scale))).alias("x"))
    )


class Block:
    """Rows of one dimension count, with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.rows = rows[order]
        self.lists = np.argsort(self.rows, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(self.rows.T, self.lists, axis=1)

    def search(self, own: int, query: np.ndarray, k: int, floor: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of all rows that may be among the k best of the query, the best first."""
        n, d = self.rows.shape
        used = np.flatnonzero(query)
        rising = query[used] < 0
        seen = np.zeros(n, bool)
        scores = np.zeros(n, self.rows.dtype)
        depth, step = 0, FIRST_STEP
        best = np.zeros(0, np.int64)
        while depth < n:
            upto = min(n, depth + step)
            if len(used):
                down = self.lists[used[~rising], n - upto : n - depth]
                up = self.lists[used[rising], depth:upto]
                met = np.zeros(n, bool)
                met[down.ravel()] = True
                met[up.ravel()] = True
                new = np.flatnonzero(met & ~seen)
            else:  # every score is zero: ids in order
                new = np.arange(depth, upto)
            seen[new] = True
            scores[new] = self.rows[new] @ query
            new = new[self.ids[new] != own]
            best = np.concatenate([best, new])
            if len(best) > k:
                # ids rise with the position, so position order settles ties
                best = best[np.lexsort((best, -scores[best]))[:k]]
            depth, step = upto, step * 2
            if depth == n:
                break
            edge = np.where(rising, self.values[used, depth], self.values[used, n - 1 - depth])
            bound = int(edge @ query[used]) if len(used) else 0
            kth = int(scores[best].min()) if len(best) == k else None
            least = max((x for x in (kth, floor) if x is not None), default=None)
            if least is not None and bound < least:
                break
            if not len(used) and len(best) == k:
                break
        best = best[np.lexsort((best, -scores[best]))]
        return self.ids[best], scores[best]


def matrix(rows: pd.Series, largest: int) -> np.ndarray:
    """Components as doubles where every sum of products is exact, else as integers."""
    found = np.array(rows.tolist(), np.int64).reshape(len(rows), -1)
    return found.astype(np.float64) if found.shape[1] * largest * largest < 1 << 53 else found


def search_blocks(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """Search each (d, block, chunk) of ``queries`` in the same of ``candidates``."""
    columns = ["d", "block", "chunk", "vec_id", "x"]

    def find(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.set_axis(columns, axis=1)
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        largest = max(int(np.abs(np.array(x.tolist(), np.int64)).max(initial=0)) for x in (queries["x"], rows["x"]))
        block = Block(rows["vec_id"].to_numpy(), matrix(rows["x"], largest))
        parts = []
        for own, query, floor in zip(queries["vec_id"], matrix(queries["x"], largest), queries["floor"]):
            ids, scores = block.search(own, query, k, None if pd.isna(floor) else int(floor))
            parts.append((np.full(len(ids), own), ids, scores))
        owner, ids, scores = (np.concatenate(column).astype(np.int64) for column in zip(*parts))
        return pd.DataFrame({"query_id": owner, "vec_id": ids, "score": scores})

    # both sides come from one table, so the candidates' columns get names of their own
    renamed = candidates.select(*(F.col(c).alias(f"of_{c}") for c in columns))
    asked = queries.groupBy("d", "block", "chunk")
    return asked.cogroup(renamed.groupBy("of_d", "of_block", "of_chunk")).applyInPandas(find, FOUND)


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    is_query: str,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest integer inner products of each query.

    ``is_query`` is an SQL condition on ``vec_id``. Components become
    floor(scale * x). A vector that is null, or has a null or non-finite
    component or a null id, takes no part. Vectors meet only vectors of as many
    components. A row is no candidate of a query of its own id; of rows of equal
    id, one query and one candidate is kept, the first by components. Ties go to
    the smaller id. An empty table gives no rows, other columns are not looked at.
    """
    first = F.min(F.struct(F.size("x").alias("d"), "x")).alias("v")
    rows = Kept(
        quantised(vectors, id_col, vector_col, scale).groupBy("vec_id").agg(first).select("vec_id", "v.d", "v.x"),
        "vectors",
    ).df
    counts = rows.groupBy("d").agg(
        F.ceil(F.count("*") / F.lit(BLOCK_ROWS)).alias("blocks"),
        F.ceil(F.count_if(F.expr(is_query)) / F.lit(CHUNK_QUERIES)).alias("chunks"),
    )
    dealt = rows.join(counts, "d").filter("chunks > 0").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks"))
    chunk = F.pmod(F.xxhash64("vec_id", F.lit(1)), "chunks")
    asked = dealt.filter(is_query).withColumn("chunk", chunk).withColumn("floor", F.lit(None).cast("long"))
    columns = ["d", "block", "chunk", "vec_id", "x", "floor"]
    met = dealt.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    met = met.select("d", "block", "chunk", "vec_id", "x")
    home = Kept(search_blocks(asked.select(*columns), met, k), "home").df
    floors = home.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.min("score")).alias("floor")
    )
    others = (
        asked.drop("floor")
        .join(floors, F.col("vec_id") == F.col("query_id"), "left")
        .withColumn("home", F.col("block"))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .filter("block != home")
        .select(*columns)
    )
    away = search_blocks(others, met, k)
    return best_of(home.unionByName(away), k).select("query_id", "rank", "vec_id", "score")
