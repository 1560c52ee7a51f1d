"""Nearest neighbours by inner product with an adaptive dimension scan.

Vectors get one more component that makes all of them equally long, so that the
nearest by distance are those of the largest inner product, and are turned by a
random rotation, after which any first dimensions are a fair sample of all. Lists
around trained centroids are cut into bounded parts that hold their vectors in
column blocks. A query scans the parts of its nearest lists block by block; after
each block a hypothesis test on the partial distance abandons candidates that are
unlikely to beat its current k-th best. Survivors are scored exactly on the
original vectors.

How many lists a query probes is measured: as many as hold the wanted share of the
nearest neighbours that sampled vectors have in the sample. The sample also bounds
each query's k-th best distance from above before any list is read; answers come from
the probed lists alone. A query that finds too few there is asked again with twice as
many lists, at last with all of them and without a bound.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedmill.session import stage

LISTS_MOST = 16_384
SAMPLE_PER_LIST = 40
ROUNDS = 6
RECALL = 0.96  # of the sampled neighbours, by the lists probed
BOUND_ROWS = 16_384  # most sampled rows that are sent along to bound distances
PART_ROWS = 2048  # vectors of a list that are scanned together
QUERY_ROWS = 2048  # queries that scan a part together
COLUMNS = 16
CONFIDENCE = 2.1  # of the test that abandons a candidate, in standard deviations times sqrt(dimension)
WARM = 64


def usable_vectors(table: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and v (array of float) of the rows that take part."""
    v = F.col(vector).cast("array<float>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        table.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
        .where(F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
        # -0.0 equals 0.0
        .withColumn("v", F.transform("v", lambda x: x + F.lit(0.0).cast("float")))
    )


def distinct_vectors(vectors: DataFrame, most: int) -> DataFrame:
    """(v, ids): each distinct vector with its ``most`` smallest ids. Copies leave before the shuffle."""
    first = Window.partitionBy("v").orderBy("vec_id")
    return (
        vectors.withColumn("place", F.row_number().over(first)).where(F.col("place") <= most)
        .groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as doubles, short ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def train_lists(sample: np.ndarray, lists: int, seed: int = 5) -> np.ndarray:
    """Centroids by a few rounds of k-means; empty lists restart at a random row."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), lists, replace=len(sample) < lists)].copy()
    for _ in range(ROUNDS):
        near = nearest_lists(sample, centroids, 1)[:, 0]
        held = np.bincount(near, minlength=lists)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, sample)
        centroids = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], sample[rng.choice(len(sample), lists)])
    return centroids


def nearest_lists(rows: np.ndarray, centroids: np.ndarray, number: int) -> np.ndarray:
    """The ``number`` nearest centroids of each row, nearest first."""
    out, half = [], 0.5 * (centroids ** 2).sum(axis=1)
    for i in range(0, len(rows), 1024):
        far = half - rows[i: i + 1024] @ centroids.T
        best = np.argpartition(far, min(number, len(half)) - 1, axis=1)[:, :number]
        out.append(np.take_along_axis(best, np.argsort(np.take_along_axis(far, best, 1), axis=1, kind="stable"), 1))
    return np.concatenate(out) if out else np.zeros((0, number), np.int64)


def needed_probes(sample: np.ndarray, asked: np.ndarray, centroids: np.ndarray, most: int, recall: float) -> int:
    """Lists to probe so that ``recall`` of the sampled neighbours of queries lie in them.

    ``asked`` are the first sampled rows as query points; all sampled rows are equally
    long, so the largest inner products are the nearest.
    """
    far = -(asked @ sample.T)
    far[np.arange(len(asked)), np.arange(len(asked))] = np.inf
    near = np.argsort(far, axis=1, kind="stable")[:, : min(most, len(sample) - 1)]
    if not near.size:
        return len(centroids)
    order = nearest_lists(asked, centroids, len(centroids))
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(centroids))[None, :].repeat(len(asked), 0), 1)
    held_by = nearest_lists(sample, centroids, 1)[:, 0]
    at = np.sort(np.take_along_axis(place, held_by[near], 1), axis=None)
    return int(at[min(len(at) - 1, int(recall * len(at)))]) + 1


def scan(query: np.ndarray, blocks: list[np.ndarray], most: int, start: float = np.inf) -> tuple[np.ndarray, np.ndarray]:
    """(candidates, squared distances) that may be among the ``most`` nearest of one part.

    ``blocks`` are dimensions x candidates. The first WARM candidates are measured in
    full and give the threshold, unless ``start`` is lower.
    """
    number, width = blocks[0].shape[1], sum(len(b) for b in blocks)
    edges = np.cumsum([0, *[len(b) for b in blocks]])
    warm = min(number, max(WARM, most))
    first = sum(((b[:, :warm] - query[a: a + len(b), None]) ** 2).sum(axis=0) for a, b in zip(edges, blocks))
    bound = min(start, np.partition(first, most - 1)[most - 1] if warm >= most else np.inf)
    alive, far = np.arange(warm, number), np.zeros(number - warm)
    for a, block in zip(edges, blocks):
        if not len(alive):
            break
        columns = block[:, warm:] if a == 0 else block[:, alive]
        far += ((columns - query[a: a + len(block), None]) ** 2).sum(axis=0)
        seen = a + len(block)
        # the estimate of the whole distance exceeds the bound by more than the test allows
        limit = bound * (1 + CONFIDENCE / np.sqrt(seen)) ** 2 * seen / width if seen < width else bound
        stay = far <= limit
        alive, far = alive[stay], far[stay]
    return np.concatenate([np.arange(warm), alive]), np.concatenate([first, far])


def nearest_by_inner_product(
    table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", most: int = 20, every: int = 20, recall: float = RECALL
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``most`` nearest found for each query.

    Queries are the rows whose id is divisible by ``every``, candidates every other
    row; nearness is the inner product in double precision on the original vectors,
    ties go to the smaller id. Vectors that are null, zero or hold null or non-finite
    components, and rows without an id, take no part; a missing component of a
    shorter vector counts as zero. Copies of a vector are searched as one: only the
    ``most`` + 1 smallest ids of equal vectors can be among the nearest. Without
    queries or candidates there are no rows.
    """
    spark = table.sparkSession
    vectors = usable_vectors(table, vec_id, vector).where(F.col("vec_id").isNotNull())
    reps = stage(
        distinct_vectors(vectors, most + 1).withColumn("rep", F.element_at("ids", 1)), "distinct-vectors"
    )
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    number, width, longest = reps.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(norm)).first()
    if not number:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lists = int(min(LISTS_MOST, max(1, round(number ** 0.5))))
    # a bounded sample in a random but repeatable order, for the centroids only
    sample = reps.orderBy(F.xxhash64("rep"), "rep").select("rep", "v").limit(lists * SAMPLE_PER_LIST).toArrow()

    def lifted(rows: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(longest - (rows ** 2).sum(axis=1), 0))
        return np.column_stack([rows, rest])

    def as_query(rows: np.ndarray) -> np.ndarray:
        """Rows at the length of the lifted ones, without a part in the last component."""
        length = np.sqrt(longest / np.maximum((rows ** 2).sum(axis=1), 1e-300))
        return np.column_stack([rows * length[:, None], np.zeros(len(rows))])

    rng = np.random.default_rng(3)
    rotation = np.linalg.qr(rng.standard_normal((width + 1, width + 1)))[0]
    original = _matrix(sample.column("v").combine_chunks(), width)
    sampled = lifted(original) @ rotation
    centroids = train_lists(sampled, lists)
    probes = needed_probes(sampled, as_query(original[:256]) @ rotation, centroids, most, recall)
    shared = spark.sparkContext.broadcast((rotation, centroids, sampled[:BOUND_ROWS].astype(np.float32)))

    def place(batches):
        rotation, centroids, _ = shared.value
        for batch in batches:
            rows = lifted(_matrix(batch.column("v"), width)) @ rotation
            near = nearest_lists(rows, centroids, 1)[:, 0]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("v"), pa.array(near, pa.int32())], names=["rep", "v", "list"]
            )

    def probe(probes: int, bounded: bool):
        def lists_of(batches):
            rotation, centroids, known = shared.value
            squares = (known ** 2).sum(axis=1)
            for whole in batches:
                for start in range(0, whole.num_rows, 256):
                    batch = whole.slice(start, 256)
                    rows = _matrix(batch.column("v"), width)
                    turned = as_query(rows) @ rotation
                    bound = np.full(len(rows), np.inf)
                    if bounded and len(known) > most:
                        far = squares[None, :] - 2 * turned.astype(np.float32) @ known.T
                        bound = np.partition(far, most, axis=1)[:, most] + longest
                    near = nearest_lists(turned, centroids, probes)
                    each = pa.array(np.repeat(np.arange(len(rows)), near.shape[1]))
                    yield pa.RecordBatch.from_arrays([
                        batch.column("rep").take(each), batch.column("v").take(each), pa.array(near.ravel(), pa.int32()),
                        pa.array(bound.astype(np.float64)).take(each),
                    ], names=["rep", "v", "list", "bound"])

        return lists_of

    kind = "rep long, v array<float>, list int"
    placed = reps.select("rep", "v").mapInArrow(place, kind)
    # a query row may be none of the smallest ids of its vector, so queries are looked up on their own
    asking = stage(
        vectors.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("v").alias("qv"))
        .join(reps.select("v", "rep"), F.col("qv") == F.col("v")).select("query_id", "rep", "v"), "queries",
    )
    distinct_queries = asking.dropDuplicates(["rep"]).select("rep", "v")
    sizes = placed.groupBy("list").count().select("list", F.ceil(F.col("count") / PART_ROWS).cast("int").alias("parts"))
    sizes = stage(sizes, "list-sizes")

    def spread(rows: DataFrame, plan: DataFrame, own: str, other: str, name: str, other_name: str) -> DataFrame:
        """Each row in the one part its hash names, met by every part of the other side."""
        return (
            rows.join(plan, "list").withColumn(name, F.pmod(F.xxhash64("rep"), F.col(own)).cast("int"))
            .withColumn(other_name, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            .select("list", "part", "asker", *[c for c in rows.columns if c != "list"])
        )

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        if not candidates.num_rows or not queries.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "rep": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        rotation, _, _ = shared.value
        rows = _matrix(candidates.column("v").combine_chunks(), width)
        ids = candidates.column("rep").to_numpy()
        order = np.argsort(ids, kind="stable")
        rows, ids = rows[order], ids[order]
        turned = (lifted(rows) @ rotation).T.astype(np.float32)
        blocks = [np.ascontiguousarray(turned[a: a + COLUMNS]) for a in range(0, width + 1, COLUMNS)]
        asked = _matrix(queries.column("v").combine_chunks(), width)
        points = (as_query(asked) @ rotation).astype(np.float32)
        wanted = min(most + 1, len(ids))
        out = []
        # the bounds were computed in single precision
        slack = 1e-4 * longest
        for q, point, own, bound in zip(asked, points, queries.column("rep").to_numpy(), queries.column("bound").to_numpy()):
            found, far = scan(point, blocks, wanted, bound + slack)
            found, far = found[far <= bound + slack], far[far <= bound + slack]
            if len(found) > 2 * wanted:
                found = found[np.argpartition(far, 2 * wanted - 1)[: 2 * wanted]]
            score = rows[found] @ q
            best = np.lexsort((ids[found], -score))[:wanted]
            out.append((np.full(len(best), own), ids[found[best]], score[best]))
        return pa.table(dict(zip(("query", "rep", "score"), map(np.concatenate, zip(*out)))))

    def answered(queries: DataFrame, probes: int, bounded: bool) -> DataFrame:
        """What each query finds in its nearest ``probes`` lists."""
        probed = stage(queries.mapInArrow(probe(probes, bounded), kind + ", bound double"), "probed-lists")
        asked = probed.groupBy("list").count().select("list", F.ceil(F.col("count") / QUERY_ROWS).cast("int").alias("askers"))
        # at most LISTS_MOST rows
        plan = F.broadcast(stage(sizes.join(asked, "list"), "list-parts"))
        left = spread(placed, plan, "parts", "askers", "part", "asker")
        right = spread(probed, plan, "askers", "parts", "asker", "part")
        hits = left.groupBy("list", "part", "asker").cogroup(right.groupBy("list", "part", "asker")).applyInArrow(
            search, "query long, rep long, score double"
        )
        by_score = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
        top = hits.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= most + 1)
        return stage(top.drop("place"), "answers")

    # a query is one of the candidates
    enough = min(most + 1, number)
    found, bounded = answered(distinct_queries, probes, True), True
    while probes < lists or bounded:
        full = found.groupBy("query").count().where(F.col("count") >= enough)
        short = stage(distinct_queries.join(full, F.col("rep") == F.col("query"), "left_anti"), "short-queries")
        if short.isEmpty():
            break
        bounded = probes < lists and 2 * probes < lists
        probes = min(2 * probes, lists)
        again = answered(short, probes, bounded)
        found = found.join(short.select(F.col("rep").alias("query")), "query", "left_anti").unionByName(again)
    listed = found.join(reps.select(F.col("rep").alias("r"), "ids"), F.col("rep") == F.col("r")).select(
        "query", "score", F.explode("ids").alias("vec_id")
    )
    by_query = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    listed = listed.withColumn("place", F.row_number().over(by_query)).where(F.col("place") <= most + 1)
    answers = listed.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("answers"))
    return (
        asking.select("query_id", "rep").join(answers, F.col("rep") == F.col("query"))
        .select("query_id", F.posexplode(F.slice(F.filter("answers", lambda a: a["vec_id"] != F.col("query_id")), 1, most)).alias("place", "a"))
        .select("query_id", (F.col("place") + 1).alias("rank"), "a.vec_id", "a.score")
    )
