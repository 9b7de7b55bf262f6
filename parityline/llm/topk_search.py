"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Vectors become rows of integers. They are dealt by the hash of their id to blocks of about BLOCK, and each block's index is built
by one task: for every component its postings (vectors with a value other than zero) are cut into segments of one quantised
impact, the absolute value in steps of `width`, with its sign; segments lie in descending order of impact, in a few tiers. Query vectors
are dealt to blocks in the same way, and each pair of a query block and a candidate block is one group of bounded size.

In a group the segments are added to the scores of all open queries in descending impact, those of a tier by one matrix product. After each tier
every pair of query and candidate gets an upper bound: its score so far, plus the largest impact still to come times the largest query components that can meet
it, plus the rounding of quantised impacts. A query is closed only when few candidates can still reach its threshold, which is the
k-th best of exact scores; these candidates are all rescored exactly, so what is left out is left out on proof. Otherwise the
segments go on to the end, which bounds every score by its rounding alone. The k best of all blocks are ranked together.

Edge cases: vectors that are null or hold null, NaN or infinite components take no part, nor do vectors with an integer of
2**27 or more (a float of 2**21), whose scores could pass 64 bits, nor rows without an id. Of rows that share an id the
smallest vector counts. A shorter vector counts as zero beyond its end. Ties go to the smaller id; fewer than k
candidates give all of them; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parityline.llm.common import staged

K, SCALE, EVERY = 20, 64, 20
#: Vectors of a candidate block and of a query block; queries that are scored together; impacts that a component is quantised to.
BLOCK, QUERY_BLOCK, TOGETHER, LEVELS = 4096, 2048, 256, 64
LARGEST = 1 << 27
NEVER = -(1 << 62)
#: Shares of the postings that tiers end at, and the share of candidates that may be rescored before the last tier.
TIERS, FEW = (0.4, 0.6, 0.75, 0.9), 0.03


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """id, v (array<int>): floor(scale * x) of each component x; one row for each id."""
    x = F.transform(F.col(vec_col), lambda c: F.floor(c.cast("double") * scale))
    usable = F.forall(F.col(vec_col), lambda c: F.coalesce(F.abs(F.floor(c.cast("double") * scale)) < LARGEST, F.lit(False)) & ~F.isnan(c.cast("double")))
    rows = df.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & usable).select(F.col(id_col).cast("long").alias("id"), x.cast("array<int>").alias("v"))
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def _blocks(rows: DataFrame, n: int) -> DataFrame:
    return rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows, zeros after the end of shorter ones."""
    lists = vectors.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), max(sizes, default=0)), np.int32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


@dataclass
class Index:
    """Candidates of one block and their postings by descending impact, cut into tiers of segments."""

    ids: np.ndarray
    codes: np.ndarray  #: vectors as they are, one row each
    width: int  #: of a step of impact; at 1 a posting's impact is exact
    row: np.ndarray  #: of each posting
    component: np.ndarray
    impact: np.ndarray  #: signed, the middle of the step
    ends: np.ndarray  #: where each tier ends, always after the last posting of a step
    to_come: np.ndarray  #: the largest impact after each tier

    @classmethod
    def build(cls, ids: np.ndarray, codes: np.ndarray, levels: int = LEVELS) -> Index:
        width = max(1, -(-int(np.abs(codes).max(initial=0)) // levels))
        row, component = np.nonzero(codes)
        value = codes[row, component].astype(np.int64)
        level = (np.abs(value) - 1) // width
        order = np.lexsort((row, value < 0, component, -level))  # segment after segment
        row, component, value, level = row[order], component[order], value[order], level[order]
        middle = level * width + 1 + (width - 1) // 2
        steps = np.flatnonzero(level[1:] != level[:-1]) + 1
        ends = sorted({*(int(steps[np.searchsorted(steps, share * len(row))]) for share in TIERS if len(steps) and steps[-1] >= share * len(row)), len(row)})
        to_come = [(int(level[end]) + 1) * width if end < len(row) else 0 for end in ends]
        return cls(ids, codes, width, row, component, np.where(value < 0, -middle, middle), np.array(ends), np.array(to_come))

    def pack(self) -> dict[str, bytes | int]:
        parts = {name: np.ascontiguousarray(getattr(self, name), kind).tobytes() for name, kind in PACKED.items()}
        return parts | {"n_components": self.codes.shape[1], "width": self.width}

    @classmethod
    def unpack(cls, row: dict) -> Index:
        parts = {name: np.frombuffer(row[name], kind) for name, kind in PACKED.items()}
        parts["codes"] = parts["codes"].reshape(len(parts["ids"]), row["n_components"])
        return cls(width=row["width"], **parts)

    def tiers(self, kind: type) -> list[np.ndarray]:
        """The postings of each tier as a matrix of impacts, zero where a vector has no posting in it."""
        out = []
        for a, b in zip([0, *self.ends[:-1].tolist()], self.ends.tolist()):
            out.append(np.zeros(self.codes.shape, kind))
            out[-1][self.row[a:b], self.component[a:b]] = self.impact[a:b]
        return out


PACKED = {"ids": "<i8", "codes": "<i4", "row": "<u2", "component": "<u4", "impact": "<i4", "ends": "<i8", "to_come": "<i8"}
INDEX = "block int, n_components int, width int, " + ", ".join(f"{name} binary" for name in PACKED)


def _length(rows: np.ndarray) -> float:
    """The largest length of a row, rounded up."""
    return float(np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1)).max(initial=0)) + 1


def search(index: Index, query_ids: np.ndarray, queries: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the query, id, exact score) of each query's k best candidates in the block, its own id left out; ties to the smaller id."""
    d = max(index.codes.shape[1], queries.shape[1])
    codes, q = (np.pad(x, ((0, 0), (0, d - x.shape[1]))) for x in (index.codes, queries))
    n, m = len(codes), len(q)
    # By Cauchy and Schwarz no sum over some of the components passes the product of the lengths, so floats hold it exactly.
    most = (_length(codes) + index.width * d) * _length(q)
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    exact, long = codes.astype(np.int64), q.astype(np.int64)
    order = np.argsort(index.ids, kind="stable")
    spot = order[np.minimum(np.searchsorted(index.ids, query_ids, sorter=order), n - 1)]
    own = np.where(index.ids[spot] == query_ids, spot, -1)

    def scores(candidate: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact scores of pairs, so many at once that they take a few MB."""
        step = max(1, (1 << 19) // max(d, 1))
        parts = [np.einsum("ij,ij->i", exact[candidate[a : a + step]], long[query[a : a + step]]) for a in range(0, len(candidate), step)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    # What is still to come for a candidate with u postings left is at most the next impact times the u largest query components.
    size = np.sort(np.abs(long), axis=1)[:, ::-1]
    reach = np.concatenate((np.zeros((m, 1), np.int64), np.cumsum(size, axis=1)), axis=1).T
    rounding = (index.width // 2) * reach[-1]
    columns = np.ascontiguousarray(q[:, : index.codes.shape[1]].T.astype(kind))
    total, left = np.zeros((n, m), kind), np.count_nonzero(codes, axis=1)
    open_queries, cutoff = np.arange(m), None
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for postings, to_come in zip(index.tiers(kind), index.to_come.tolist()):
        total += postings @ columns[:, open_queries]  # all segments of the tier, for all open queries
        left = left - np.count_nonzero(postings, axis=1)
        if cutoff is None:
            # k candidates of the best so far, scored exactly, hold the threshold: the k-th best of all can only be higher.
            few = min(n, k + 1)
            best = np.argpartition(total, n - few, axis=0)[n - few :]
            pairs = best.ravel(), np.tile(np.arange(m), few)
            exactly = np.where(pairs[0] == own[pairs[1]], NEVER, scores(*pairs)).reshape(few, m)
            cutoff = np.sort(exactly, axis=0)[-k] if few > k else np.full(m, NEVER)
        least = cutoff[open_queries] - rounding[open_queries] - to_come * reach[:, open_queries]
        may = total >= least.astype(kind)[left]
        close = may.sum(axis=0) <= max(k, int(FEW * n)) if to_come else np.ones(len(open_queries), bool)
        candidate, place = np.nonzero(may[:, close])
        query = open_queries[close][place]
        keep = candidate != own[query]
        candidate, query = candidate[keep], query[keep]
        found.append((query, index.ids[candidate], scores(candidate, query)))
        open_queries, total = open_queries[~close], total[:, ~close]
        if not len(open_queries):
            break
    query, ids, score = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    first = np.searchsorted(query, query)
    keep = np.arange(len(query)) - first < k
    return query[keep], ids[keep], score[keep]


def top_k(vectors: DataFrame, every: int = EVERY, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id `every` divides its k best other rows."""
    rows = staged(integer_vectors(vectors, id_col, vec_col, scale), "vectors")
    asked = rows.filter(F.col("id") % every == 0)
    n, m = rows.count(), asked.count()
    n_blocks, n_query_blocks = max(1, -(-n // BLOCK)), max(1, -(-m // QUERY_BLOCK))

    def build(_, table):
        out = []
        # A block may hold some more rows than BLOCK; rows are numbered with 16 bits, which the hash fills only beyond all chance.
        for part in range(0, table.num_rows, 1 << 16):
            some = table.slice(part, 1 << 16)
            packed = Index.build(some["id"].to_numpy(), _matrix(some["v"])).pack()
            out.append({"block": some["block"][0].as_py(), **packed})
        return pa.Table.from_pylist(out, INDEX_ARROW)

    index = staged(_blocks(rows, n_blocks).groupBy("block").applyInArrow(build, INDEX), "impact-index")
    held = index.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1))))
    asked = _blocks(asked, n_query_blocks).withColumnRenamed("block", "query_block").groupBy("query_block").agg(F.collect_list(F.struct("id", "v")).alias("queries"))
    # One row of queries and one index for each pair of blocks.
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def find(_, held, asked):
        out = [pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})]
        for row in held.to_pylist():
            index = Index.unpack(row)
            for queries in asked["queries"]:
                rows = queries.values
                ids, q = rows.field("id").to_numpy(), _matrix(pa.chunked_array([rows.field("v")]))
                for a in range(0, len(ids), TOGETHER):
                    query, vec, score = search(index, ids[a : a + TOGETHER], q[a : a + TOGETHER], k)
                    out.append(pa.table({"query_id": ids[a : a + TOGETHER][query], "vec_id": vec, "score": score.astype(np.int64)}))
        return pa.concat_tables(out)

    pair = ["block", "query_block"]
    met = held.groupBy(*pair).cogroup(asked.groupBy(*pair)).applyInArrow(find, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


INDEX_ARROW = pa.schema([("block", pa.int32()), ("n_components", pa.int32()), ("width", pa.int32()), *[(name, pa.binary()) for name in PACKED]])


def op11_topk_search(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = f"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= {K}"""
