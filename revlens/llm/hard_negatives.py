"""Hard-negative mining by exact integer scores.

Scores are inner products of integer vectors.  A matrix product runs modulo
several small primes in float32, where every sum stays below 2^24 and so is
exact; the exact signed score is put together from the residues by Chinese
remaindering, and the best rows within each score window are selected.

Rows are packed into tiles inside the tasks that read them, anchors into tiles
by hash.  Every row tile meets every anchor tile in an equi-join on the anchor
tile, salted so that one anchor tile spans many tasks; a task keeps only the
best few rows of each anchor, which are merged by anchor afterwards.  One pass
finds the positives, a second the negatives in the windows of their scores.

Defined results: rows with a null label, a null vector, or a null, NaN or
infinite component take no part; nor do vectors whose integers have a sum of
squares of 2^56 or more (a score would not be exact), or of another length than
most have (of equally common lengths the longest counts).  Rows with a null
identifier are no anchors, and as candidates come last among ties.  Repeated
rows are rows of their own (each is an "other row" to its copies), and a
repeated anchor gives its rows each time.  Windows of negative scores are empty.
An empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import col, shuffle_partitions, staged, table

SCALE = 256
ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 5
#: Negatives score from LOW / HIGH of the positive's score up to that score.
LOW, HIGH = 80, 100
#: Rows in a tile, anchors in a tile, anchors multiplied at once; anchor tiles a task keeps results of.
ROW_TILE = 4_096
ANCHOR_TILE = 1_024
ANCHOR_STEP = 128
OPEN_TILES = 16
SQUARES_BOUND = float(1 << 56)
NO_ID = (1 << 63) - 1  # stands for a null identifier inside tiles
LEAST = -(1 << 62)


# ---- exact products from residues ---------------------------------------------------------

def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def moduli(bound: int, k: int) -> tuple[list[int], int]:
    """(primes, columns at once): the largest primes whose residues, between -p/2 and p/2, give
    float32 sums below 2^24 over that many columns, enough of them for scores up to ``bound``."""
    step = max(1, min(k, 256))
    half = int(((1 << 24) / step) ** 0.5)
    primes, product, p = [], 1, 2 * min(half, 1 << 10) + 1
    while product <= 2 * bound + 1 or len(primes) < 2:
        if p * step // 2 * (p // 2) < 1 << 24 and p > 2 and is_prime(p):
            primes.append(p)
            product *= p
        p -= 1
        if p < 3:
            raise ValueError("scores too large for primes of this size")
    return primes, step


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Integers modulo p, between -p/2 and p/2, as float32."""
    r = np.mod(x, p)
    return (r - p * (r > p // 2)).astype(np.float32)


def centred(x: np.ndarray, p: int) -> np.ndarray:
    """Float32 integers below 2^24 in size modulo p, between -p/2 and p/2, in place."""
    x -= np.rint(x * np.float32(1.0 / p)) * np.float32(p)
    half = np.float32(p // 2)
    x -= (x > half) * np.float32(p)
    x += (x < -half) * np.float32(p)
    return x


def product_residue(a: np.ndarray, b: np.ndarray, p: int, step: int) -> np.ndarray:
    """(a @ b.T) modulo p from residues a and b, ``step`` columns at a time."""
    total = centred(a[:, :step] @ b[:, :step].T, p)
    for at in range(step, a.shape[1], step):
        total = centred(total + centred(a[:, at:at + step] @ b[:, at:at + step].T, p), p)
    return total


def remaindered(parts: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The signed integers with these residues: digits in mixed radix, each between -p/2 and p/2."""
    digits: list[np.ndarray] = []
    for i, (r, p) in enumerate(zip(parts, primes)):
        value, weight = r, 1
        for d, q in zip(digits, primes):  # take off the digits found, modulo p
            value = centred(value - centred(d * np.float32(weight), p), p)
            weight = weight * q % p
            weight -= p * (weight > p // 2)
        inverse = pow(weight, -1, p)
        digits.append(centred(value * np.float32(inverse - p * (inverse > p // 2)), p))
    out = digits[-1].astype(np.int64)
    for d, q in zip(digits[-2::-1], primes[-2::-1]):
        out = out * q + d.astype(np.int64)
    return out


# ---- the best rows of a tile --------------------------------------------------------------

def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(columns, scores) of the k highest allowed scores of every row; of equal scores the first
    columns; LEAST where there are fewer."""
    k = min(k, scores.shape[1])
    masked = np.where(allowed, scores, LEAST)
    width = scores.shape[1]
    if masked.max(initial=LEAST) < (1 << 62) // width and np.where(allowed, scores, 0).min(initial=0) > -(1 << 62) // width // 2:
        # score and place in one integer
        key = np.where(allowed, scores, -(1 << 62) // width) * width - np.arange(width)
        at = np.argpartition(key, width - k, axis=1)[:, width - k:]
        at = np.take_along_axis(at, np.argsort(-np.take_along_axis(key, at, axis=1), axis=1), axis=1)
    else:
        at = np.argsort(-masked, axis=1, kind="stable")[:, :k]
    return at, np.take_along_axis(masked, at, axis=1)


def merged(old, new, k: int):
    """The k best of two lists of (scores, ids, rows) per anchor; ties by id, then row."""
    if old is None:
        return new
    scores, ids, rows = (np.concatenate([a, b], axis=1) for a, b in zip(old, new))
    order = np.lexsort((rows, ids, -scores), axis=1)[:, :k]
    return tuple(np.take_along_axis(x, order, axis=1) for x in (scores, ids, rows))


# ---- tiles --------------------------------------------------------------------------------

TILE = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("ids", T.BinaryType()),
                     T.StructField("labels", T.BinaryType()), T.StructField("vectors", T.BinaryType())])


def integer_rows(rows: DataFrame, ident: str, vector: str, label: str, scale: int) -> DataFrame:
    """id, label and v (array of long) of the rows that take part."""
    v = col(vector)
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) * float(scale) >= SQUARES_BOUND))
    usable = rows.filter(F.coalesce(~bad & (F.size(v) > 0), F.lit(False)) & col(label).isNotNull())
    found = usable.select(col(ident).cast("long").alias("id"), col(label).cast("long").alias("label"),
                          F.transform(v, lambda e: F.floor(e.cast("double") * float(scale)).cast("long")).alias("v")) \
        .withColumn("squares", F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double"))) \
        .filter(F.col("squares") < SQUARES_BOUND)
    common = found.groupBy(F.size("v").alias("k")).count().orderBy(F.desc("count"), F.desc("k")).head()
    return found.filter(F.size("v") == (common["k"] if common else 0))


def row_tiles(rows: DataFrame, size: int = ROW_TILE) -> DataFrame:
    """Rows packed in their tasks: tile (a number of its own), n, ids, labels, vectors, in order of id."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, size):
                part = b.slice(at, size)
                ids = part.column(0).fill_null(NO_ID).to_numpy()
                order = np.argsort(ids, kind="stable")
                v = part.column(2).flatten().to_numpy().reshape(part.num_rows, -1)[order].astype(np.int32)  # below 2^28
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(ids)], pa.int32()), pa.array([ids[order].tobytes()]),
                     pa.array([part.column(1).to_numpy()[order].tobytes()]), pa.array([v.tobytes()])], names=TILE.names)

    return rows.select("id", "label", "v").mapInArrow(run, TILE).withColumn("tile", F.monotonically_increasing_id())


def anchors_of(tiles: DataFrame, every: int = ANCHOR_EVERY) -> DataFrame:
    """anchor (a number of its own: tile and place), id, label and v of the anchors, from the written tiles."""
    schema = "tile long, place int, id long, label long, v array<int>"

    def run(batches):
        for b in batches:
            for tile, n, ids, labels, vectors in zip(*(c.to_pylist() for c in b.columns)):
                ids, labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
                at = np.flatnonzero((ids % every == 0) & (ids != NO_ID))
                v = np.frombuffer(vectors, np.int32).reshape(n, -1)[at]
                ends = np.arange(len(at) + 1, dtype=np.int32) * v.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), tile)), pa.array(at.astype(np.int32)), pa.array(ids[at]), pa.array(labels[at]),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(v.ravel()))],
                    names=["tile", "place", "id", "label", "v"])

    return tiles.select("tile", "n", "ids", "labels", "vectors").mapInArrow(run, schema)


def met(tiles: DataFrame, anchors: DataFrame, n_anchors: int, extra: list[str], make: Callable, schema: T.StructType,
        anchor_tile: int = ANCHOR_TILE) -> DataFrame:
    """Every row tile with every anchor tile: ``make()`` gives a kernel (key, anchors, tile) -> state
    and a function that turns the state of an anchor tile into a record batch."""
    count = max(1, -(-n_anchors // anchor_tile))
    salts = max(1, -(-2 * shuffle_partitions(tiles.sparkSession) // count))
    key = F.pmod(F.xxhash64("tile", "place"), F.lit(count))
    grouped = anchors.groupBy(key.alias("a")).agg(F.collect_list(F.struct("tile", "place", "id", "label", "v", *extra)).alias("anchors"))
    spread = grouped.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    wide = tiles.withColumn("salt", F.pmod(F.xxhash64("tile"), F.lit(salts)).cast("int")) \
        .withColumn("a", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))))
    pairs = wide.join(spread, ["a", "salt"]).select("a", "anchors", "tile", "n", "ids", "labels", "vectors")

    def run(batches):
        kernel, finish = make()
        states: dict = {}
        for b in batches:
            for i in range(b.num_rows):
                a = b.column(0)[i].as_py()
                if a not in states:
                    if len(states) >= OPEN_TILES:
                        yield finish(states.pop(next(iter(states))))
                    items = b.column(1)[i].values
                    states[a] = {"anchors": items, "best": None}
                n = b.column(3)[i].as_py()
                ids, labels = (np.frombuffer(b.column(c)[i].as_py(), np.int64) for c in (4, 5))
                kernel(states[a], b.column(2)[i].as_py(), ids, labels, np.frombuffer(b.column(6)[i].as_py(), np.int32).reshape(n, -1))
        for state in states.values():
            yield finish(state)

    return pairs.mapInArrow(run, schema)


def field(items: pa.StructArray, name: str) -> pa.Array:
    return items.field(items.type.get_field_index(name))


def scores_by_step(state: dict, vectors: np.ndarray, primes: list[int], step: int):
    """(range of anchors, exact scores) of the anchors of a tile with the vectors."""
    if "residues" not in state:
        v = field(state["anchors"], "v").flatten().to_numpy().reshape(len(state["anchors"]), -1)
        state["residues"] = [residues(v, p) for p in primes]
    right = [residues(vectors, p) for p in primes]
    for at in range(0, len(state["anchors"]), ANCHOR_STEP):
        part = slice(at, at + ANCHOR_STEP)
        yield part, remaindered([product_residue(a[part], b, p, step) for a, b, p in zip(state["residues"], right, primes)], primes)


# ---- operator -----------------------------------------------------------------------------

def mine(rows: DataFrame, ident: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = ANCHOR_EVERY,
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
         row_tile: int = ROW_TILE, anchor_tile: int = ANCHOR_TILE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    kept = integer_rows(rows, ident, vector, label, scale)
    tiles = staged(row_tiles(kept, row_tile), "negatives-tiles")
    anchors = staged(anchors_of(tiles, every), "negatives-anchors")
    shape = kept.agg(F.max("squares").alias("s"), F.max(F.size("v")).alias("k")).head()
    n_anchors = anchors.count()
    # |score| is at most the largest squared length
    primes, step = moduli(int(shape["s"] or 0), shape["k"] or 1)

    found = T.StructType([T.StructField("tile", T.LongType()), T.StructField("place", T.IntegerType()),
                          T.StructField("positive_row", T.LongType()), T.StructField("positive_id", T.LongType()),
                          T.StructField("positive_score", T.LongType())])

    def make_positives():
        def kernel(state, tile, ids, labels, vectors):
            if "own" not in state:
                state["own"] = [field(state["anchors"], c).to_numpy() for c in ("label", "tile", "place")]
            own_label, own_tile, own_place = state["own"]
            out = []
            for part, scores in scores_by_step(state, vectors, primes, step):
                allowed = own_label[part, None] == labels[None, :]
                here = np.flatnonzero(own_tile[part] == tile)
                allowed[here, own_place[part][here]] = False  # not the anchor itself
                at, s = best(scores, allowed, positives)
                out.append((s, ids[at], tile * row_tile + at))
            state["best"] = merged(state["best"], tuple(np.concatenate(x) for x in zip(*out)), positives)

        def finish(state):
            s, ids, rows_ = state["best"]
            some = s > LEAST
            which = np.repeat(np.arange(len(s)), some.sum(axis=1))
            _, tile, place = state["own"]
            return pa.RecordBatch.from_arrays(
                [pa.array(tile[which]), pa.array(place[which]), pa.array(rows_[some]), pa.array(ids[some]), pa.array(s[some])],
                names=found.names)

        return kernel, finish

    # a few candidates per anchor and task
    order = Window.partitionBy("tile", "place").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    chosen = met(tiles, anchors, n_anchors, [], make_positives, found, anchor_tile) \
        .withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= positives) \
        .groupBy("tile", "place").agg(F.array_sort(F.collect_list(F.struct("nth", "positive_score", "positive_id"))).alias("pos"))
    with_positives = staged(anchors.join(chosen, ["tile", "place"]), "negatives-positives")

    result = T.StructType([T.StructField("tile", T.LongType()), T.StructField("place", T.IntegerType()),
                           T.StructField("nth", T.IntegerType()), T.StructField("anchor_id", T.LongType()),
                           T.StructField("positive_id", T.LongType()), T.StructField("positive_score", T.LongType()),
                           T.StructField("negative_row", T.LongType()), T.StructField("negative_id", T.LongType()),
                           T.StructField("negative_score", T.LongType())])

    def make_negatives():
        def kernel(state, tile, ids, labels, vectors):
            if "own" not in state:
                lists = field(state["anchors"], "pos")
                counts = np.diff(lists.offsets.to_numpy())
                items = lists.flatten()
                pos = np.full((len(counts), positives), -1, np.int64)
                names = np.zeros((len(counts), positives), np.int64)
                places = np.repeat(np.arange(len(counts)), counts), field(items, "nth").to_numpy() - 1
                pos[places] = field(items, "positive_score").to_numpy()
                names[places] = field(items, "positive_id").to_numpy()
                state["own"] = [field(state["anchors"], c).to_numpy() for c in ("label", "tile", "place", "id")]
                state["pos"], state["names"] = pos, names
                state["best"] = [None] * positives
            own_label, pos = state["own"][0], state["pos"]
            out: list[list] = [[] for _ in range(positives)]
            for part, scores in scores_by_step(state, vectors, primes, step):
                other = own_label[part, None] != labels[None, :]
                for j in range(positives):
                    top = pos[part, j][:, None]  # -1 where there is no positive: an empty window, as for any negative score
                    at, s = best(scores, other & (scores <= top) & (high * scores >= low * top) & (top >= 0), negatives)
                    out[j].append((s, ids[at], tile * row_tile + at))
            for j in range(positives):
                state["best"][j] = merged(state["best"][j], tuple(np.concatenate(x) for x in zip(*out[j])), negatives)

        def finish(state):
            _, tile, place, own = state["own"]
            columns = []
            for j, (s, ids, rows_) in enumerate(state["best"]):
                some = s > LEAST
                w = np.repeat(np.arange(len(s)), some.sum(axis=1))
                columns.append([tile[w], place[w], np.full(len(w), j + 1, np.int32), own[w], state["names"][w, j], state["pos"][w, j],
                                rows_[some], ids[some], s[some]])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*columns)], names=result.names)

        return kernel, finish

    within = Window.partitionBy("tile", "place", "nth").orderBy(F.desc("negative_score"), "negative_id", "negative_row")
    mined = met(tiles, with_positives, n_anchors, ["pos"], make_negatives, result, anchor_tile) \
        .withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= negatives)

    def shown(c: str) -> Column:
        return F.nullif(F.col(c), F.lit(NO_ID)).alias(c)

    return mined.select("anchor_id", shown("positive_id"), "rank", shown("negative_id"), "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh label is moved on by one."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", "embedding", moved.alias("label")))


ORACLE = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v, row_number() OVER () AS r
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, a.r AS ar, b.vec_id AS id, b.r, a.label = b.label AS same,
           list_dot_product(a.v, b.v)::BIGINT AS score
    FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.r <> b.r),
positives AS (
    SELECT ar, anchor_id, id AS positive_id, r AS pr, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, id, r) <= 5),
ranked AS (
    SELECT p.anchor_id, p.positive_id,
           row_number() OVER (PARTITION BY p.ar, p.pr ORDER BY s.score DESC, s.id, s.r)::INTEGER AS rank,
           s.id AS negative_id, p.positive_score, s.score AS negative_score
    FROM positives p JOIN scored s ON s.ar = p.ar AND NOT s.same
     AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""
