"""Hard negatives by Kronecker-packed products.

Components are whole numbers. Of a block of candidates the biased components of one dimension are fields of one wide
integer; it is multiplied once by each biased component of an anchor, and the sum over the dimensions holds all their
scores side by side, wide enough that no field reaches the next. Taking the bias off again gives the exact inner products.

Every anchor meets every row, block by block: both sides are dealt into blocks of bounded size and each pair of blocks
is one task's work, so no task holds more than two blocks. The first pass finds the positives, the second the negatives
within their bounds; what blocks find is merged by rank.

Rows with a null label or vector, or a component that is null or not finite (also once scaled), take no part. Rows that
repeat id, label and vector are one row; rows that share an id only are told apart, but are no positives of each
other. A null id is no anchor and comes last among equal scores. Of two vectors the shorter counts as filled up with 0.
An empty table gives no rows. Products that can't fit a long are refused with a ValueError.
"""

import math
from operator import mul

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship, stored

#: Bounds of a block; fewer rows where there are few in all, so that every core gets some.
ANCHORS, ROWS, LEAST_ROWS = 4096, 32768, 1024


def whole_numbers(vectors, width, scale):
    """Rows x width array of floor(scale * x) from an Arrow column of lists."""
    import pyarrow as pa

    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    found = np.zeros((len(lengths), width), np.int64)
    found[np.arange(width) < lengths[:, None]] = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
    return found


class Packed:
    """A block of candidates, one wide integer for each dimension."""

    def __init__(self, rows, bias):
        self.n, self.width = rows.shape
        self.bias = bias
        self.kind = "<u4" if self.width * (2 * bias) ** 2 < 1 << 32 else "<u8"
        columns = np.ascontiguousarray((rows + bias).T).astype(self.kind)
        self.wide = [int.from_bytes(column.tobytes(), "little") for column in columns]
        self.sums = rows.sum(axis=1)

    def scores(self, anchor):
        """Exact inner products of the anchor with every candidate."""
        factors = [int(a) + self.bias for a in anchor]
        fields = sum(map(mul, self.wide, factors)).to_bytes(self.n * int(self.kind[2]), "little")
        taken_off = self.bias * (int(anchor.sum()) + self.width * self.bias)
        return np.frombuffer(fields, self.kind).astype(np.int64) - (taken_off + self.bias * self.sums)


class Block:
    """Candidates in the order of their ids, the nulls last, ready to be scored."""

    def __init__(self, table, shape):
        width, bias, scale = shape
        ids = table.column("id").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        table = table.take(order)
        self.ids = [ids[i] for i in order]
        self.known = np.array([i is not None for i in self.ids], bool)
        self.numbers = np.array([i or 0 for i in self.ids], np.int64)
        self.labels = table.column("label").to_numpy()
        self.packed = Packed(whole_numbers(table.column("vector"), width, scale), bias)

    def ranked(self, anchor, wanted):
        """Wanted candidates (a mask) by score, and the scores."""
        scores = self.packed.scores(anchor)
        places = np.flatnonzero(wanted)
        order = places[np.argsort(-scores[places], kind="stable")]
        return order, scores[order]


def _pairs(shape, found_in, names):
    """The function of one pair of blocks, (anchors, candidates) to a table of `names`."""
    def of_blocks(left, right):
        import pyarrow as pa

        columns = {name: [] for name in names}
        if left.num_rows and right.num_rows:
            block = Block(right, shape)
            numbers = whole_numbers(left.column("vector"), shape[0], shape[2])
            for at, row in enumerate(left.drop_columns(["vector"]).to_pylist()):
                for values in found_in(block, row, numbers[at]):
                    for name, value in zip(names, values):
                        columns[name].append(value)
        return pa.table({name: pa.array(columns[name], pa.int64()) for name in names})

    return of_blocks


def _positives_in(many):
    def found_in(block, row, anchor):
        other = (block.labels == row["label"]) & ~(block.known & (block.numbers == row["id"]))
        order, scores = block.ranked(anchor, other)
        return [(row["row"], block.ids[i], int(s)) for i, s in zip(order[:many].tolist(), scores[:many].tolist())]

    return found_in


def _negatives_in(many, low, high):
    def found_in(block, row, anchor):
        order, scores = block.ranked(anchor, block.labels != row["label"])
        falling = -scores
        for p in row["positives"]:
            # low * p <= 100 * s <= high * p
            least, most = -(-low * p["score"] // 100), high * p["score"] // 100
            start = int(np.searchsorted(falling, -most, "left"))
            for i, s in zip(order[start : start + many].tolist(), scores[start : start + many].tolist()):
                if s >= least:
                    yield row["row"], p["nth"], block.ids[i], int(s)

    return found_in


def _met(anchors, rows, n_anchor_blocks, n_blocks, function, schema):
    """function of each pair of an anchor block and a block of rows."""
    def dealt(df, own, other, n_own, n_other, *key):
        return df.withColumn(own, F.pmod(F.xxhash64(*key), F.lit(n_own))).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))

    left = dealt(anchors, "a", "c", n_anchor_blocks, n_blocks, "row").select(*anchors.columns, F.col("a").cast("long"), F.col("c").cast("long"))
    right = dealt(rows, "c", "a", n_blocks, n_anchor_blocks, "row").select("id", "label", "vector", F.col("a").cast("long"), F.col("c").cast("long"))
    keep = [c for c in anchors.columns]

    def of_blocks(left, right):
        return function(left.select(keep), right)

    return left.groupBy("a", "c").cogroup(right.groupBy("a", "c")).applyInArrow(of_blocks, schema)


def hard_negatives(rows, is_anchor, id_col="vec_id", vector_col="embedding", label_col="label", positives=5, negatives=3,
                   low=50, high=95, scale=256):
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: of each anchor (a condition on `id`)
    and each of its first `positives` other rows of its label the first `negatives` rows of another label with
    low * positive_score <= 100 * negative_score <= high * positive_score. Higher scores come first, then smaller ids."""
    spark = rows.sparkSession
    ship(spark.sparkContext)
    vector = rows[vector_col]
    sound = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double") * scale) < float("inf"), F.lit(False)))
    taken = rows.where(rows[label_col].isNotNull() & vector.isNotNull() & sound).select(
        rows[id_col].cast("long").alias("id"), rows[label_col].cast("long").alias("label"), vector.alias("vector"))
    taken = stored(taken.dropDuplicates().withColumn("row", F.monotonically_increasing_id()), "vectors")
    anchors = taken.where(F.coalesce(is_anchor, F.lit(False)))
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    facts = taken.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(is_anchor, F.lit(False))).alias("anchors"),
                      F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width"), F.coalesce(F.max(largest), F.lit(0.0)).alias("most")).first()
    bias = math.floor(scale * facts["most"]) + 1
    width = max(facts["width"], 1)
    if width * bias * bias >= 1 << 62:
        raise ValueError("products of these components don't fit a long")
    cores = spark.sparkContext.defaultParallelism
    n_blocks = max(1, math.ceil(facts["n"] / min(ROWS, max(LEAST_ROWS, math.ceil(facts["n"] / (4 * cores))))))
    n_anchor_blocks = max(1, math.ceil(facts["anchors"] / ANCHORS))
    shape = (width, bias, scale)

    met = _met(anchors.select("row", "id", "label", "vector"), taken, n_anchor_blocks, n_blocks,
               _pairs(shape, _positives_in(positives), ("row", "positive_id", "score")), "row long, positive_id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("positive_id"))
    firsts = stored(met.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= positives), "positives")
    listed = firsts.groupBy("row").agg(F.collect_list(F.struct("nth", "score")).alias("positives"))
    asked = stored(anchors.join(listed, "row").select("row", "id", "label", "positives", "vector"), "asked")

    met = _met(asked, taken, n_anchor_blocks, n_blocks, _pairs(shape, _negatives_in(negatives, low, high), ("row", "nth", "negative_id", "negative_score")),
               "row long, nth long, negative_id long, negative_score long")
    best = Window.partitionBy("row", "nth").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    chosen = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    own = firsts.withColumn("nth", F.col("nth").cast("long")).join(asked.select("row", F.col("id").alias("anchor_id")), "row")
    return chosen.join(own, ["row", "nth"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", F.col("score").alias("positive_score"), "negative_score")
