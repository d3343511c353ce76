"""Exact top-k search by inner product with a three-phase uniform threshold.

Every vector is a sum of `parts` runs of components, and each block of vectors
holds one local score list per run. Phase 1 gathers the best entries of every
local list and scores them in full; the k-th best of these over all blocks is a
safe cutoff. Phase 2 shares the cutoff evenly between the lists: an entry below
its share in every list can't reach the cutoff. Phase 3 scores the entries that
reach it in some list in full, and keeps those at or above the cutoff.

Equal vectors are searched once, under their smallest id, with their k + 1
smallest ids; that is all a result can name. Query blocks meet vector blocks in
a join on the number of the query block.

Defined results: a vector that is null, has no components or has a null or
non-finite one takes no part, nor does one without a vec_id, nor one so long that a
score could leave 64 bits (`LONGEST`); a repeated vec_id with the
same vector counts once; vectors meet only queries of their own length; ties go
to the smaller vec_id; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import mapped, staged

PARTS = 2
QUERY_BLOCK = 512
VECTOR_BLOCK = 8192
EXACT_FLOAT = 2**53
#: Squared length, in quantised units, from which on scores could leave 64 bits.
LONGEST = float(2**62)


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id and floor(scale * x) of each component, of the vectors that take part."""
    scaled = F.transform("embedding", lambda x: F.lit(float(scale)) * x.cast("double"))
    sound = F.forall("scaled", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = sound & (F.aggregate("scaled", F.lit(0.0), lambda a, x: a + x * x) < LONGEST)
    rows = vectors.select("vec_id", scaled.alias("scaled")).filter(F.col("vec_id").isNotNull() & (F.size("scaled") > 0) & F.coalesce(sound, F.lit(False)))
    return rows.select("vec_id", F.transform("scaled", lambda x: F.floor(x).cast("long")).alias("v")).distinct()


def _blocks(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Rows (dim, id, v) as one row per block: dim, block, ids and matrix as bytes, at most about `size` rows each."""
    counts = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}  # a row for each length of vectors
    parts = F.create_map(*[x for d, n in counts.items() for x in (F.lit(d), F.lit(max(1, -(-n // size))))]) if counts else None
    number = F.pmod(F.xxhash64("id"), F.element_at(parts, F.col("dim"))) if counts else F.lit(0).cast("long")

    def gather(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        ids = table.column("id").to_numpy()
        matrix = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                key: pa.array([table.column("block")[0].as_py()], pa.int64()),
                f"{key}_ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
                f"{key}_rows": pa.array([matrix.tobytes()], pa.binary()),
            }
        )

    return rows.select("dim", "id", "v", number.alias("block")).groupBy("dim", "block").applyInArrow(
        gather, f"dim int, {key} long, {key}_ids binary, {key}_rows binary"
    )


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: floats where they hold them, else whole numbers of any size."""
    if q.size and v.size and float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1] < EXACT_FLOAT:
        return q.astype(np.float64) @ v.astype(np.float64).T
    return q.astype(object) @ v.astype(object).T


def _matrix(ids: bytes, rows: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, dtype=np.int64)
    return ids, np.frombuffer(rows, dtype=np.int64).reshape(len(ids), -1)


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: int = 64, parts: int = PARTS) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best. `is_query`: a condition on vec_id."""
    best = k + 1
    points = staged(quantised(vectors, scale), "points")
    order = Window.partitionBy("v").orderBy("vec_id")
    few = points.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= best)
    distinct = few.groupBy("v").agg(F.min("vec_id").alias("id"), F.array_sort(F.collect_list("vec_id")).alias("ids"))  # at most k + 1 ids
    distinct = staged(distinct.withColumn("dim", F.size("v")), "distinct")
    asked = points.filter(is_query).join(distinct.select("v", "id"), "v").select(F.col("vec_id").alias("query_id"), F.col("id").alias("q"))
    asked = staged(asked, "asked")
    searched = distinct.join(asked.select(F.col("q").alias("id")).distinct(), "id", "left_semi").select("dim", "id", "v")
    q_blocks = staged(_blocks(searched, "qb", QUERY_BLOCK), "q_blocks")
    v_blocks = staged(_blocks(distinct.select("dim", "id", "v"), "vb", VECTOR_BLOCK), "v_blocks")
    pairs = v_blocks.join(q_blocks, "dim")  # few rows a length: every query block meets every vector block

    def split(dim: int) -> list[slice]:
        cuts = np.linspace(0, dim, min(parts, dim) + 1).astype(int)
        return [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]

    def gather(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        out_q, out_s = [], []
        for row in batch.to_pylist():
            q_ids, q = _matrix(row["qb_ids"], row["qb_rows"])
            v_ids, v = _matrix(row["vb_ids"], row["vb_rows"])
            lists = [_products(q[:, s], v[:, s]) for s in split(row["dim"])]
            take = min(best, len(v_ids))
            whole, found = sum(lists), []
            for scores in lists:
                if scores.dtype == object:
                    found.append(np.argsort(scores, axis=1)[:, -take:])
                else:
                    found.append(np.argpartition(scores, len(v_ids) - take, axis=1)[:, -take:])
            for i, (q_id, at) in enumerate(zip(q_ids.tolist(), np.concatenate(found, axis=1))):
                top = sorted((int(x) for x in whole[i, np.unique(at)]), reverse=True)[:best]
                out_q += [q_id] * len(top)
                out_s += top
        return pa.RecordBatch.from_arrays([pa.array(out_q, pa.int64()), pa.array(out_s, pa.int64())], ["q", "score"])

    local = mapped(pairs, gather, "q long, score long")
    ranked = local.withColumn("_n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))).filter(F.col("_n") <= best)
    cutoffs = ranked.groupBy("q").agg(F.min("score").alias("cutoff"), F.count("*").alias("n"))
    cutoffs = cutoffs.select("q", F.when(F.col("n") >= best, F.col("cutoff")).alias("cutoff"))
    with_cutoff = searched.join(cutoffs, searched["id"] == cutoffs["q"], "left").select("dim", "id", "v", "cutoff")
    cut_blocks = staged(_cut_blocks(with_cutoff, q_blocks), "cut_blocks")
    longest = staged(
        distinct.groupBy("dim").agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("most")), "longest"
    )
    again = v_blocks.join(cut_blocks, "dim").join(F.broadcast(longest), "dim")  # a row for each length of vectors

    def resolve(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        cols: list[list] = [[], [], []]
        for row in batch.to_pylist():
            q_ids, q = _matrix(row["qb_ids"], row["qb_rows"])
            v_ids, v = _matrix(row["vb_ids"], row["vb_rows"])
            cutoff = np.frombuffer(row["cutoffs"], dtype=np.int64)
            none = cutoff == np.iinfo(np.int64).min
            runs = split(row["dim"])
            lists = [_products(q[:, s], v[:, s]) for s in runs]
            # by Cauchy-Schwarz no local score is under -least, so that local scores plus `least` share the cutoff
            least = [np.sqrt((q[:, s].astype(np.float64) ** 2).sum(axis=1) * row["most"]) * (1 + 1e-9) for s in runs]
            share = (cutoff.astype(np.float64) * (1 - np.sign(cutoff) * 1e-12) + sum(least)) / len(runs)
            over = np.zeros(lists[0].shape, dtype=bool)
            for scores, low in zip(lists, least):
                over |= np.asarray(scores >= (share - low - 1e-6)[:, None], dtype=bool)
            over[none] = True
            i, j = np.nonzero(over)
            score = sum(scores[i, j] for scores in lists)
            good = np.asarray((score >= cutoff[i]) | none[i], dtype=bool)
            cols[0].append(q_ids[i[good]])
            cols[1].append(v_ids[j[good]])
            cols[2].append(np.array([int(x) for x in score[good]], dtype=np.int64))
        made = [pa.array(np.concatenate(c)) for c in cols]
        return pa.RecordBatch.from_arrays(made, ["q", "id", "score"])

    hits = mapped(again, resolve, "q long, id long, score long")
    named = hits.join(distinct.select("id", "ids"), "id").select("q", "score", F.explode("ids").alias("vec_id"))
    top = named.withColumn("_n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).filter(F.col("_n") <= best)
    found = asked.join(top, "q").filter(F.col("query_id") != F.col("vec_id"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _cut_blocks(rows: DataFrame, q_blocks: DataFrame) -> DataFrame:
    """The query blocks with each row's cutoff, in the order of the block's ids; the least long stands for none."""
    none = np.iinfo(np.int64).min
    numbered = mapped(
        q_blocks,
        lambda batch: pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([np.frombuffer(x, dtype=np.int64) for x in batch.column("qb_ids").to_pylist()])),
                pa.array(np.repeat(batch.column("qb").to_numpy(), [len(x) // 8 for x in batch.column("qb_ids").to_pylist()])),
            ],
            ["id", "qb"],
        ),
        "id long, qb long",
    )

    def gather(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        table = table.sort_by("id")
        matrix = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        cut = table.column("cutoff").fill_null(int(none)).to_numpy().astype(np.int64)
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                "qb_ids": pa.array([table.column("id").to_numpy().tobytes()], pa.binary()),
                "qb_rows": pa.array([matrix.tobytes()], pa.binary()),
                "cutoffs": pa.array([cut.tobytes()], pa.binary()),
            }
        )

    return rows.join(numbered, "id").groupBy("dim", "qb").applyInArrow(gather, "dim int, qb_ids binary, qb_rows binary, cutoffs binary")
