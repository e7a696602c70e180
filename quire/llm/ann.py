"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of TABLES tables has functions floor((a.x + b) / WIDTH) on unit vectors, a
Gaussian (2-stable); their number grows with the logarithm of the rows. A query
visits buckets of a table in order of estimated success: its own, then perturbed
ones by the sum of squared distances to the walls that are crossed, out of the sets
that are expected to be best. How many it visits is measured: for SAMPLE queries, chosen by hash, the true neighbours are
found by one pass over all rows, and the probes are the fewest that reach SHARE
of them; if MOST_PROBES don't, the tables get fewer functions. Candidates of all
tables are reranked by cosine, computed in twice double precision on the vectors
as given and rounded once, so that parallel vectors tie.

Vectors equal in every component are one class, with its k + 1 smallest ids, and
equal queries are one query. The first functions of a table make up the region of
a bucket; a query goes to each region it visits once, with the keys of its probes
there. Regions of many rows or many queries are split into parts of PART_ROWS,
which meet each other; a part returns the k + 1 best classes of each query. Queries
with fewer than k neighbours found visit all rows of their vector's length, in the
same parts.

Vectors that are null, empty, zero or hold a null or non-finite component take no
part, nor do rows with a null id; vectors of another length than the query's
never meet it. Rows that repeat an id and vector are one; unlike vectors of one id
are candidates each, and the id's own vectors aren't its neighbours. Ties go to
the smaller id. An empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.spans import mix
from quire.llm.store import materialise, scratch

TABLES, WIDTH = 4, 2.5
SAMPLE, SHARE, MOST_PROBES = 256, 0.93, 4000
PART_ROWS = 4096
SEED = 7


def _functions(dim: int, table: int, hashes: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dim, table])
    return rng.standard_normal((dim, hashes)), rng.uniform(0, width, hashes)


def _key(cells: np.ndarray) -> np.ndarray:
    out = np.full(len(cells), cells.shape[1], np.uint64)
    for i in range(cells.shape[1]):
        out = mix(out ^ cells[:, i].astype(np.int64).view(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return mix(out).view(np.int64)


def perturbations(scores: np.ndarray, probes: int) -> list[tuple[tuple[int, ...], float]]:
    """The ``probes`` cheapest sets of perturbations, cheapest first, none moving one function both ways.

    ``scores``: 2 x functions, the squared distance to the wall below (0) and above (1).
    A heap holds sets as places in the sorted list of single ones; the top is
    replaced by its two successors: its last place shifted, or the next one added.
    """
    import heapq

    order = np.argsort(scores, axis=None, kind="stable")
    cost, m = scores.ravel()[order], scores.shape[1]
    heap: list[tuple[float, tuple[int, ...]]] = [(float(cost[0]), (0,))] if len(order) else []
    out: list[tuple[tuple[int, ...], float]] = [((), 0.0)]
    while heap and len(out) < probes:
        total, places = heapq.heappop(heap)
        moved = [int(order[p]) for p in places]
        if len({x % m for x in moved}) == len(moved):
            out.append((tuple(moved), total))
        last = places[-1]
        if last + 1 < len(order):
            heapq.heappush(heap, (total - float(cost[last]) + float(cost[last + 1]), (*places[:-1], last + 1)))
            heapq.heappush(heap, (total + float(cost[last + 1]), (*places, last + 1)))
    return out


@functools.lru_cache(maxsize=4)
def _template(hashes: int) -> np.ndarray:
    """Sets of perturbations (0 or 1 for each of the 2 * hashes places in order of distance), in their expected order.

    Places p and 2 * hashes - 1 - p are the two walls of one function, whatever the query. Twice
    as many sets as are ever visited, so that a query can choose by its own distances.
    """
    m = hashes
    place = np.arange(1, 2 * m + 1, dtype=np.float64)
    near, far = place * (place + 1) / (4 * (m + 1) * (m + 2)), 2 * m + 1 - place
    z = np.where(place <= m, near, 1 - far / (m + 1) + far * (far + 1) / (4 * (m + 1) * (m + 2)))
    sets = perturbations(np.stack([z[:m], z[:m - 1 : -1]]), 2 * MOST_PROBES)
    out = np.zeros((len(sets), 2 * m), np.float32)
    for row, (moves, _) in zip(out, sets, strict=True):
        row[[x if x < m else 3 * m - 1 - x for x in moves]] = 1
    return out


def _places(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The walls of a query's functions in order of squared distance, below (0 ...) and above (hashes ...), and those distances."""
    z = np.concatenate([low**2, (1 - low) ** 2])
    # Equal distances keep the two walls of a function at opposite places.
    m, side = len(low), np.argsort(np.minimum(z[: len(low)], z[len(low) :]), kind="stable")
    near = np.where(low[side] <= 0.5, side, side + m)
    order = np.concatenate([near, ((near + m) % (2 * m))[::-1]])
    return order, z[order]


def visited(cells: np.ndarray, low: np.ndarray, probes: int) -> np.ndarray:
    """The cells of the buckets that a query visits, most likely first; ``low``: place of each value in its cell, 0 to 1."""
    sets, m = _template(len(cells)), len(cells)
    order, z = _places(low)
    cost = sets @ z
    at = np.argsort(cost, kind="stable")[:probes]
    step = np.zeros((2 * m, m), np.float32)
    step[np.arange(2 * m), order % m] = np.where(order >= m, 1, -1)
    return cells + sets[at] @ step


def _rank(low: np.ndarray, step: np.ndarray) -> float:
    """When a query visits the bucket that lies ``step`` away: from 1, infinite if it doesn't."""
    if np.abs(step).max() > 1:
        return np.inf
    sets, m = _template(len(low)), len(low)
    order, z = _places(low)
    need = ((step[order % m] < 0) & (order < m)) | ((step[order % m] > 0) & (order >= m))
    if not ((sets @ need == need.sum()) & (sets.sum(1) == need.sum())).any():
        return np.inf
    return float((sets @ z < z[need].sum() - 1e-9).sum() + 1)


def hashes_for(rows: int) -> int:
    """Functions of a table, so that a bucket holds a few rows in hundreds of thousands of them."""
    return max(4, round(4.5 + math.log2(max(rows, 1)) / 2))


def leading_for(rows: int) -> int:
    """Functions of a region: each halves the rows or a bit more, and regions have PART_ROWS or so."""
    return max(0, round(math.log2(max(rows, 1) / PART_ROWS) / 1.2))


def _two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = a + b
    v = s - a
    return s, (a - (s - v)) + (b - v)


def _two_product(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = a * b
    x, y = a * 134217729.0, b * 134217729.0
    ah, bh = x - (x - a), y - (y - b)
    al, bl = a - ah, b - bh
    return p, ((ah * bh - p) + ah * bl + al * bh) + al * bl


def _dot2(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Products of rows, as an unevaluated sum of two doubles."""
    high, low = np.zeros(len(x)), np.zeros(len(x))
    for a, b in zip(x.T, y.T, strict=True):
        p, e = _two_product(a, b)
        high, s = _two_sum(high, p)
        low += s + e
    return _two_sum(high, low)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of x with that of y; the same for parallel vectors, whatever their lengths."""
    # Powers of two scale exactly and keep squares in range.
    x, y = (v * np.exp2(-np.frexp(np.abs(v).max(1, keepdims=True))[1].astype(float)) for v in (x, y))

    def times(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        p, e = _two_product(a[0], b[0])
        return _two_sum(p, e + (a[0] * b[1] + a[1] * b[0]))

    d = _dot2(x, y)
    above, below = times(d, d), times(_dot2(x, x), _dot2(y, y))
    q = above[0] / below[0]
    p, e = _two_product(q, below[0])
    q = q + ((above[0] - p) - e + above[1] - q * below[1]) / below[0]
    return np.copysign(np.sqrt(np.minimum(q, 1.0)), d[0])


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _vectors(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, v) of the rows that take part; v keeps its type."""
    df = rows.select(rows[f"`{vec_id}`"].cast("long").alias("id"), rows[f"`{embedding}`"].alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))) & ~F.isnan(x.cast("double")))
    return df.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def _doubles(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _cells(x: np.ndarray, table: int, hashes: int) -> np.ndarray:
    a, b = _functions(x.shape[1], table, hashes, WIDTH)
    return (_unit(x) @ a + b) / WIDTH


def _region(cells: np.ndarray, leading: int) -> np.ndarray:
    return _key(cells[:, :leading]) if leading else np.zeros(len(cells), np.int64)


def _by_length(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    n = np.asarray(pc.list_value_length(lists))
    for dim in np.unique(n):
        at = np.flatnonzero(n == dim)
        yield at, _doubles(lists.take(pa.array(at)), int(dim))


def _indexed(classes: DataFrame, hashes: int, leading: int) -> DataFrame:
    """first, ids, v and one row for each table: t, region, key."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regions, keys = np.zeros((TABLES, batch.num_rows), np.int64), np.zeros((TABLES, batch.num_rows), np.int64)
            for at, x in _by_length(batch.column(batch.schema.get_field_index("v"))):
                for t in range(TABLES):
                    cells = np.floor(_cells(x, t, hashes))
                    regions[t, at], keys[t, at] = _region(cells, leading), _key(cells)
            for t in range(TABLES):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, t, np.int32)), pa.array(regions[t]), pa.array(keys[t])], [*batch.schema.names, "t", "region", "key"])

    return classes.mapInArrow(place, f"{_schema(classes)}, t int, region long, key long")


def _probing(queries: DataFrame, hashes: int, leading: int, probes: int) -> DataFrame:
    """first, v and one row for each table and region that a query visits: t, region, keys."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, np.ndarray]] = []
            for at, x in _by_length(batch.column(batch.schema.get_field_index("v"))):
                for t in range(TABLES):
                    y = _cells(x, t, hashes)
                    cells = np.floor(y)
                    low = y - cells
                    for row, i in enumerate(at.tolist()):
                        moved = visited(cells[row], low[row], probes)
                        region, keys = _region(moved, leading), _key(moved)
                        out += [(i, t, int(r), keys[region == r]) for r in np.unique(region)]
            take = pa.array([x[0] for x in out], pa.int64())
            lists = pa.array([x[3] for x in out], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(c.take(take) for c in batch.columns), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.int64()), lists], [*batch.schema.names, "t", "region", "keys"])

    return queries.mapInArrow(place, f"{_schema(queries)}, t int, region long, keys array<long>")


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _best(s: np.ndarray, first: np.ndarray, x: np.ndarray, y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, cosine) of the k + 1 best of each row of s, -inf meaning no candidate; ties to the smaller ``first``.

    All within rounding of the last place are computed anew before they are cut.
    """
    bar = np.partition(s, s.shape[1] - k - 1, axis=1)[:, s.shape[1] - k - 1, None] - 1e-12 if s.shape[1] > k + 1 else -2.0
    r, j = np.nonzero((s >= bar) & np.isfinite(s))
    score = cosines(x[r], y[j]) if len(r) else np.zeros(0)
    order = np.lexsort((first[j], -score, r))
    r, j, score = r[order], j[order], score[order]
    keep = np.arange(len(r)) - np.searchsorted(r, r) <= k
    return r[keep], j[keep], score[keep]


def _meet(index: DataFrame, probe: DataFrame, k: int) -> DataFrame:
    """query_first, ids and score: each query's k + 1 best classes of every part that it visits.

    ``index``: first, ids, v, t, region, key; ``probe``: first, v, t, region, keys (null: all). A part
    has PART_ROWS or so of a region's rows, and as many of its queries.
    """
    count = lambda df, name: df.groupBy("t", "region").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias(name))
    parts = materialise(count(index, "row_parts").join(count(probe, "query_parts"), ["t", "region"]), "ann-parts")
    part = lambda name: F.pmod(F.xxhash64("first"), F.col(name)).cast("int")
    each = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    names = ["t", "region", "row_part", "query_part", "query", "first", "ids", "v", "key", "keys"]
    rows = index.join(parts, ["t", "region"]).withColumn("row_part", part("row_parts")).withColumn("query_part", each("query_parts"))
    asks = probe.join(parts, ["t", "region"]).withColumn("query_part", part("query_parts")).withColumn("row_part", each("row_parts"))
    none = lambda kind: F.lit(None).cast(kind)
    rows = rows.withColumns({"query": F.lit(False), "keys": none("array<long>")}).select(names)
    asks = asks.withColumns({"query": F.lit(True), "ids": none("array<long>"), "key": none("long")}).select(names)

    def rank(group: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        query = table["query"].to_numpy(zero_copy_only=False)
        dims = np.asarray(pc.list_value_length(table["v"]))
        first = table["first"].to_numpy()
        for dim in np.unique(dims[query]):
            q, c = np.flatnonzero(query & (dims == dim)), np.flatnonzero(~query & (dims == dim))
            if not len(c):
                continue
            x, y = (_doubles(table["v"].take(pa.array(at)), int(dim)) for at in (q, c))
            ux, uy, least = _unit(x), _unit(y), pc.list_element(table["ids"].take(pa.array(c)), 0).to_numpy()
            kinds, code = np.unique(table["key"].take(pa.array(c)).to_numpy(zero_copy_only=False), return_inverse=True)
            keys = table["keys"].take(pa.array(q)).to_pylist()
            for a in range(0, len(q), 256):
                asked = np.zeros((len(keys[a : a + 256]), len(kinds)), bool)
                for i, own in enumerate(keys[a : a + 256]):
                    if own is None:
                        asked[i] = True
                    else:
                        at = np.minimum(np.searchsorted(kinds, own), len(kinds) - 1)
                        asked[i, at[kinds[at] == own]] = True
                near = np.flatnonzero(asked.any(0)[code])  # only rows of buckets that some query visits
                if not len(near):
                    continue
                s = np.where(asked[:, code[near]], ux[a : a + 256] @ uy[near].T, -np.inf)
                r, j, score = _best(s, least[near], x[a : a + 256], y[near], k)
                ids = table["ids"].take(pa.array(c[near[j]])).combine_chunks()
                yield pa.RecordBatch.from_arrays([pa.array(first[q[a + r]]), ids, pa.array(score)], ["query_first", "ids", "score"])

    return rows.union(asks).groupBy("t", "region", "row_part", "query_part").applyInArrow(rank, "query_first long, ids array<long>, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """query_first, place, vec_id and score of the k + 1 best ids of each query class."""
    each = found.distinct().select("query_first", "score", F.explode("ids").alias("vec_id")).groupBy("query_first", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_first").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("place", place).where(F.col("place") <= k + 1).select("query_first", "place", "vec_id", "score")


def _true(classes: DataFrame, sample: dict[int, np.ndarray], k: int) -> DataFrame:
    """(query, score, v) of the k classes nearest to each sampled query but its own, by one pass over all."""
    ids = np.array(sorted(sample))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, first = batch.column(batch.schema.get_field_index("v")), batch.column(batch.schema.get_field_index("first")).to_numpy()
            for at, x in _by_length(lists):
                own = np.array([i for i in ids if len(sample[i]) == x.shape[1]], np.int64)
                if not len(own):
                    continue
                s = _unit(np.stack([sample[i] for i in own])) @ _unit(x).T
                s[own[:, None] == first[at]] = -np.inf
                n = min(k, s.shape[1])
                j = np.argpartition(-s, n - 1, axis=1)[:, :n]
                r = np.repeat(np.arange(len(own)), n)
                yield pa.RecordBatch.from_arrays([pa.array(own[r]), pa.array(s[r, j.ravel()]), lists.take(pa.array(at[j.ravel()]))], ["query", "score", "v"])

    kind = classes.schema["v"].dataType.simpleString()
    near = classes.mapInArrow(scan, f"query long, score double, v {kind}").where("score > -2")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    return near.withColumn("place", place).where(F.col("place") <= k)


def tune(classes: DataFrame, queries: DataFrame, n: int, k: int, sample: int = SAMPLE, share: float = SHARE) -> tuple[int, int]:
    """(functions, probes) of a table, measured on at most ``sample`` queries and their true neighbours, which the driver holds."""
    hashes = hashes_for(n)
    chosen = queries.orderBy(F.xxhash64("first"), "first").limit(sample).collect()
    vectors = {r["first"]: np.array(r["v"], np.float64) for r in chosen}
    if not vectors:
        return hashes, 1
    pairs = [(vectors[r["query"]], np.array(r["v"], np.float64)) for r in _true(classes, vectors, k).collect()]
    while pairs:
        ranks = np.full(len(pairs), np.inf)
        for t in range(TABLES):
            for i, (x, y) in enumerate(pairs):
                p, q = _cells(np.stack([x, y]), t, hashes)
                ranks[i] = min(ranks[i], _rank(p - np.floor(p), np.floor(q) - np.floor(p)))
        need = np.sort(ranks)[math.ceil(share * len(ranks)) - 1]
        if need <= MOST_PROBES or hashes <= 2:
            return hashes, int(min(need, MOST_PROBES))
        hashes -= 1
    return hashes, 1


def nearest(rows: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The k nearest rows of every row for which ``is_query`` (over column ``id``): query_id, rank, vec_id, score."""
    with scratch() as tables:
        vectors = _vectors(rows, vec_id, embedding)
        order = F.dense_rank().over(Window.partitionBy("v").orderBy("id"))
        classes = vectors.withColumn("_n", order).where(F.col("_n") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))
        classes = materialise(classes.select("ids", F.col("ids")[0].alias("first"), "v"), "ann-classes")
        if classes.groupBy("first").count().where("count > 1").limit(1).count():  # unlike vectors of one id: a hash names all classes but one
            place = F.row_number().over(Window.partitionBy("first").orderBy("v"))
            classes = classes.withColumn("place", place).withColumn("first", F.when(F.col("place") == 1, F.col("first")).otherwise(F.xxhash64("v"))).drop("place")
            classes = materialise(classes, "ann-classes")
        asked = vectors.where(is_query).distinct().join(classes.select("v", "first").hint("merge"), "v").select(F.col("id").alias("query_id"), F.col("first").alias("query_first"))
        asked = materialise(asked, "ann-asked")
        queries = materialise(classes.select("first", "v").join(asked.select(F.col("query_first").alias("first")).distinct().hint("merge"), "first", "left_semi"), "ann-queries")
        n = classes.count()
        hashes, probes = tune(classes, queries, n, k)
        leading = min(hashes, leading_for(n))
        index = _indexed(classes, hashes, leading)
        probe = materialise(_probing(queries, hashes, leading, probes), "ann-probes")
        found = materialise(_ranked(materialise(_meet(index, probe, k), "ann-found"), k), "ann-ranked")
        enough = found.groupBy("query_first").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > k).select(F.col("query_first").alias("first"))
        short = materialise(queries.join(enough.hint("merge"), "first", "left_anti"), "ann-short")
        if short.limit(1).count():
            whole = lambda df: df.withColumns({"t": F.lit(-1), "region": F.size("v").cast("long")})
            lengths = short.select(F.size("v").alias("n")).distinct()
            rest = classes.join(lengths, F.size("v") == F.col("n"), "left_semi")
            again = _ranked(_meet(whole(rest).withColumn("key", F.lit(0).cast("long")), whole(short).withColumn("keys", F.lit(None).cast("array<long>")), k), k)
            found = found.join(short.select(F.col("first").alias("query_first")).hint("merge"), "query_first", "left_anti").union(again)
        each = asked.join(found.hint("merge"), "query_first").where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        out = each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        return tables.keep(materialise(out, "ann-result"))
