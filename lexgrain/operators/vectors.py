"""Records for embedding, a vector table with upsert and resume, and exact nearest neighbours."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrain.functions import text

#: Queries that are compared with all rows in one pass.
QUERY_BLOCK = 2_000


def records(items: DataFrame) -> DataFrame:
    """id, document, metadata of export rows (id, source, source_id, context, text, url); short texts are left out."""
    doc = text.embedding_text(F.col("context"), F.col("text"))
    made = items.select("id", doc.alias("document"), text.metadata(F.col("source"), F.col("source_id"), F.col("url"), F.coalesce("text", F.lit(""))).alias("metadata"))
    return made.where(F.col("document").isNotNull())


def counters(items: DataFrame) -> DataFrame:
    """processed, skipped_short, skipped_json, truncated of parsed JSON lines (with `bad`)."""
    body = text.strip(F.coalesce("text", F.lit("")))
    short = F.length(body) <= text.LEAST_CHARS
    whole = text.strip(F.concat(F.lit("passage: "), text.strip(F.coalesce("context", F.lit(""))), F.lit(" "), body))
    good = ~F.col("bad")
    return items.agg(
        F.count_if(good & ~short).alias("processed"), F.count_if(good & short).alias("skipped_short"), F.count_if(F.col("bad")).alias("skipped_json"),
        F.count_if(good & ~short & (F.length(whole) > text.EMBED_CHARS)).alias("truncated"),
    )


def pending(items: DataFrame, done: DataFrame) -> DataFrame:
    """Records that the vector table does not hold yet."""
    return items.join(done.select("id").distinct(), "id", "left_anti")


def embed(items: DataFrame, model: Callable[[list[str]], np.ndarray], batch: int = 64) -> DataFrame:
    """id, embedding, error: `model` on batches of documents; a failing batch is halved down to single rows."""

    def safe(texts: list[str]) -> list[tuple[list[float] | None, str | None]]:
        try:
            return [(list(map(float, v)), None) for v in model(texts)]
        except Exception as e:
            if len(texts) == 1:
                return [(None, str(e)[:200])]
            half = len(texts) // 2
            return safe(texts[:half]) + safe(texts[half:])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), batch):
                part = b.iloc[at : at + batch]
                got = safe(part["document"].tolist())
                yield pd.DataFrame({"id": part["id"].tolist(), "embedding": [v for v, _ in got], "error": [e for _, e in got]})

    return items.select("id", "document").mapInPandas(work, "id string, embedding array<float>, error string")


def nearest(rows: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, key, score: the k rows of greatest cosine similarity to each query (not itself), exactly.

    Queries go to the workers in blocks of bounded size; each partition keeps its k best rows of a query, and
    the k best of those are the result, so what is shuffled is k rows a query and partition.  Ties go to the lower
    key; null, empty and zero vectors have no neighbours; vectors of another length are not compared.
    """
    listed = queries.where(F.size(vector) > 0).select(key, vector)
    parts = max(1, -(-listed.count() * 2 // block))
    kind = rows.schema[key].dataType.simpleString()
    out = None
    for part in range(parts):
        block_rows = listed.where(F.pmod(F.xxhash64(key), F.lit(parts)) == part).collect()
        if not block_rows:
            continue
        found = rows.where(F.size(vector) > 0).select(key, vector).mapInArrow(_best(block_rows, k), f"query_id {kind}, {key} {kind}, score double")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return rows.select(F.col(key).alias("query_id"), key, F.lit(0.0).alias("score")).limit(0)
    splits = max(1, math.isqrt(out.rdd.getNumPartitions()))  # merged in two steps, so that no group is large
    some = _merged(out.withColumn("_s", F.spark_partition_id() % splits), ["query_id", "_s"], key, k)
    return _merged(some, ["query_id"], key, k).select("query_id", key, "score")


def _merged(found: DataFrame, groups: list[str], key: str, k: int) -> DataFrame:
    """The k best rows of each group, ties to the lower key."""
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col(key).alias("i"))))
    top = found.groupBy(*groups).agg(F.slice(ranked, 1, k).alias("top")).select(*groups, F.explode("top").alias("t"))
    return top.select(*groups, F.col("t.i").alias(key), (-F.col("t.s")).alias("score"))


def _best(block_rows: list, k: int):  # noqa: ANN202
    wide: dict[int, tuple[list, np.ndarray]] = {}
    for q in block_rows:
        v = np.asarray(q[1], np.float64)
        if (n := np.linalg.norm(v)) > 0:
            ids, vs = wide.setdefault(len(v), ([], []))
            ids.append(q[0])
            vs.append(v / n)
    wide = {d: (ids, np.stack(vs)) for d, (ids, vs) in wide.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[object, list] = {}
        for batch in batches:
            keys, arrays = batch.column(0), batch.column(1)
            lengths = arrays.value_lengths().to_numpy(zero_copy_only=False)
            for d, (ids, matrix) in wide.items():
                at = np.flatnonzero(lengths == d)
                if not len(at):
                    continue
                values = np.nan_to_num(arrays.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(-1, d)
                norms = np.linalg.norm(values, axis=1)
                own = keys.take(pa.array(at)).to_pylist()
                scores = matrix @ (values / np.where(norms > 0, norms, 1)[:, None]).T
                for qi, q in enumerate(ids):
                    heap = best.setdefault(q, [])
                    row = scores[qi]
                    few = np.argpartition(-row, min(k + 1, len(row) - 1))[: k + 2] if len(row) > k + 2 else range(len(row))
                    least = min(row[j] for j in few)
                    for j in np.flatnonzero(row >= least):
                        if norms[j] > 0 and own[j] != q:
                            item = (row[j], _Low(own[j]))
                            if len(heap) < k:
                                heapq.heappush(heap, item)
                            elif item > heap[0]:
                                heapq.heapreplace(heap, item)
        rows = [(q, i.value, float(s)) for q, heap in best.items() for s, i in heap]
        if rows:
            yield pa.record_batch([pa.array([r[c] for r in rows]) for c in range(3)], names=["query_id", "key", "score"])

    return work


class _Low:
    """Orders keys so that the lower one is the greater item."""

    __slots__ = ("value",)

    def __init__(self, value: object) -> None:
        self.value = value

    def __lt__(self, other: _Low) -> bool:
        return other.value < self.value
