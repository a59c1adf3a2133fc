"""Trie of conversation prefixes by range minima over sorted common prefixes.

A conversation is the sequence of its turns' digests. Sequences are sorted; for neighbours the number of equal first
turns is kept, and a sparse table of its minima over spans of 1, 2, 4, ... places. Each sequence brings the prefixes its
predecessor hasn't got; each of these, and its parent, binary-searches how far left and right the neighbours still share
so many turns. The interval is the node's members, so sums over subtrees are differences of running sums, without a stack.

The sorted order is cut into range partitions, worked off apart. Only a prefix of a partition's first or last sequence
can reach into another one. Those parts are merged by the digest of the prefix, and the trie of the boundary sequences
alone, two for each partition, adds up what lies below them. Copies of one conversation are sorted by conv_id too, so a
group of any size spreads over partitions, and the ids that end at one node are hashed as a stream of short pieces.

A conversation's turns are held, as digests of 16 bytes, in one row. Rows without a conv_id belong to no conversation;
rows that repeat everything are turns of their own; turns of one number are ordered by role, then text. An empty table
has no nodes. Only the named columns are looked at, so others of any name can't clash.
"""

import hashlib
from itertools import pairwise

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_broadcast, in_arrow, stored

#: Bytes of a turn's digest.
TOKEN = 16
#: Bounds of a range partition, and of the ids in one piece.
SEQUENCES, TURNS, PIECE = 32768, 262144, 512
#: What a partition says: a finished node, its part of a node that may go on elsewhere, a boundary sequence, ids.
NODE, PART, BOUNDARY, IDS = range(4)
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
SAID = ("kind int, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, own long, ends string, sequence binary")


def common(a, b):
    """Turns that two sequences share from their starts."""
    n = min(len(a), len(b)) // TOKEN
    if a[: n * TOKEN] == b[: n * TOKEN]:
        return n
    low = 0
    while n - low > 1:
        middle = (low + n) // 2
        if a[low * TOKEN : middle * TOKEN] == b[low * TOKEN : middle * TOKEN]:
            low = middle
        else:
            n = middle
    return low


def sparse(values, least):
    """Minima (by `least`) of spans of 1, 2, 4, ... places."""
    table = [values]
    while 2 << len(table) - 1 <= len(values):
        step = 1 << len(table) - 1
        table.append(least(table[-1][:-step], table[-1][step:]))
    return table


def extent_right(table, at, depth):
    """Last places of sequences that share `depth` turns with those at `at`; table: of common[k], of k - 1 and k."""
    at = at.copy()
    for j in range(len(table) - 1, -1, -1):
        step, values = 1 << j, table[j]
        begin = np.minimum(at + 1, len(values) - 1)
        at += step * ((at + 1 < len(values)) & (values[begin] >= depth))
    return at


def extent_left(table, at, depth):
    """First places of them."""
    at = at.copy()
    for j in range(len(table) - 1, -1, -1):
        step, values = 1 << j, table[j]
        at -= step * ((at >= step) & (values[np.maximum(at - step + 1, 0)] >= depth))
    return at


def range_least(table, left, right):
    """Minima of places left to right, both included."""
    level = np.frexp((right - left + 1).astype(np.float64))[1] - 1
    found = np.empty(len(left), table[0].dtype)
    for j in np.unique(level):
        own = level == j
        found[own] = np.minimum(table[j][left[own]], table[j][right[own] - (1 << j) + 1])
    return found


class Prefixes:
    """All distinct prefixes of sorted sequences, by their first sequence and then by depth.

    at, depth: a sequence that has it, the first one, and its turns; left, right: places of its members; parent: its
    parent's number (the root: -1); last: the number of the last prefix of its subtree.
    """

    def __init__(self, sequences):
        n = len(sequences)
        self.lengths = np.array([len(s) // TOKEN for s in sequences], np.int64)
        self.shared = np.array([-1, *(common(a, b) for a, b in pairwise(sequences))], np.int64)
        new = self.lengths - self.shared
        self.begin = np.cumsum(new) - new
        self.at = np.repeat(np.arange(n), new)
        self.depth = np.arange(new.sum()) - np.repeat(self.begin, new) + np.repeat(self.shared, new) + 1
        table = sparse(self.shared, np.minimum)
        self.left = extent_left(table, self.at, self.depth)
        self.right = extent_right(table, self.at, self.depth)
        above = extent_left(table, self.at, self.depth - 1)
        self.parent = np.where(self.depth > 0, self.begin[above] + self.depth - 2 - self.shared[above], -1)
        self.last = (self.begin + new - 1)[self.right]

    def children(self, counted):
        """Children of each, among those that are counted (a mask)."""
        below = self.parent[counted & (self.parent >= 0)]
        return np.bincount(below, minlength=len(self.at)).astype(np.int64)

    def below(self, values):
        """Sums of values over each prefix's subtree, its own value included."""
        running = np.concatenate([[0], np.cumsum(values)])
        return running[self.last + 1] - running[:-1]


def digests(sequence):
    """Digest of each prefix of a sequence, the empty one first."""
    state, found = hashlib.sha256(), []
    for start in range(0, len(sequence) + TOKEN, TOKEN):
        found.append(state.copy().digest()[:TOKEN])
        state.update(sequence[start : start + TOKEN])
    return found


def block_says(sequences, lengths_of_turns, ids):
    """Rows of SAID for one stretch of the sorted sequences. lengths_of_turns: code points of each turn, in lists."""
    p, n, ids = Prefixes(sequences), len(sequences), np.array(ids, np.int64)
    least = range_least(sparse(ids, np.minimum), p.left, p.right)
    edge = (p.left == 0) | (p.right == n - 1)
    members = p.right - p.left + 1
    own = np.array([lengths_of_turns[i][d - 1] if d else 0 for i, d in zip(p.at.tolist(), p.depth.tolist())], np.int64)
    inner = ~edge
    leaf = inner & (p.children(np.ones(len(p.at), bool)) == 0)
    children, leaves = p.children(inner), p.below(leaf.astype(np.int64))
    saved = p.below(np.where(inner, (members - 1) * own, 0))
    # the run of members that end at a prefix comes first
    same = np.concatenate([p.shared[1:] == p.lengths[1:], [False]]) & np.concatenate([p.lengths[1:] == p.lengths[:-1], [False]])
    run_end = np.flatnonzero(~same)[np.cumsum(np.concatenate([[0], ~same[:-1]]))] + 1
    first_keys, last_keys = digests(sequences[0]), digests(sequences[-1])

    def key(k):
        return first_keys[p.depth[k]] if p.left[k] == 0 else last_keys[p.depth[k]]

    for k in range(len(p.at)):
        left, depth, up = int(p.left[k]), int(p.depth[k]), int(p.parent[k])
        ending = ids[left : run_end[left]].tolist() if p.lengths[left] == depth else []
        row = dict(conv_id=int(least[k]), depth=depth, n_convs=int(members[k]), n_children=int(children[k]),
                   n_leaves=int(leaves[k]), saved_tokens=int(saved[k]), own=int(own[k]))
        if edge[k]:
            here = key(k)
            yield dict(row, kind=PART, key=here)
            for start in range(0, len(ending), PIECE):
                piece = ending[start : start + PIECE]
                yield dict(kind=IDS, key=here, conv_id=piece[0], ends=",".join(map(str, piece)))
        else:
            row["parent_key" if edge[up] else "parent_conv_id"] = key(up) if edge[up] else int(least[up])
            yield dict(row, kind=NODE, ends=hashlib.sha256(",".join(map(str, ending)).encode()).hexdigest())
    yield dict(kind=BOUNDARY, sequence=sequences[0])
    yield dict(kind=BOUNDARY, sequence=sequences[-1])


def boundary_says(sequences, merged):
    """Finished nodes, without their ends, of all prefixes of the boundary sequences. merged: by key the sums of parts."""
    sequences = sorted(set(sequences))
    p = Prefixes(sequences)
    keys, held = [], None
    for at, depth in zip(p.at.tolist(), p.depth.tolist()):
        if held is None or held[0] != at:
            held = at, digests(sequences[at])
        keys.append(held[1][depth])

    def column(name):
        return np.array([merged[key][name] for key in keys], np.int64)

    least, members = column("conv_id"), column("n_convs")
    children = column("n_children") + p.children(np.ones(len(keys), bool))
    leaves = column("n_leaves") + p.below((children == 0).astype(np.int64))
    saved = column("saved_tokens") + p.below((members - 1) * column("own"))
    for k, key in enumerate(keys):
        up = int(p.parent[k])
        yield dict(key=key, conv_id=int(least[k]), depth=int(p.depth[k]), parent_conv_id=int(least[up]) if up >= 0 else None,
                   n_convs=int(members[k]), n_children=int(children[k]), n_leaves=int(leaves[k]), saved_tokens=int(saved[k]))


def _batches(rows, schema, most=20_000):
    import pyarrow as pa

    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields, held = pa.schema([(name, kinds[kind]) for name, kind in map(str.split, schema.split(","))]), []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_pylist(held, fields)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, fields)


def _block(batches):
    sequences, turns, ids = [], [], []
    for batch in batches:
        sequences += batch.column(0).to_pylist()
        turns += batch.column(1).to_pylist()
        ids += batch.column(2).to_pylist()
    if ids:
        yield from _batches(block_says(sequences, turns, ids), SAID)


BOUNDARY_SAID = "key binary, " + ", ".join(f"{c} long" for c in COLUMNS)


def _boundary(batches):
    sequences, merged = [], {}
    for batch in batches:
        for row in batch.to_pylist():
            if row["sequence"] is not None:
                sequences.append(row["sequence"])
            else:
                merged[row["key"]] = row
    if sequences:
        yield from _batches(boundary_says(sequences, merged), BOUNDARY_SAID)


def _hashed(batches):
    """key and ends_sha256 of pieces sorted by key and then by id."""
    key, state = None, None
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if row["key"] != key:
                if state:
                    done.append(dict(key=key, ends_sha256=state.hexdigest()))
                key, state = row["key"], hashlib.sha256(row["ends"].encode())
            else:
                state.update(f",{row['ends']}".encode())
        yield from _batches(done, "key binary, ends_sha256 string")
    if state:
        yield from _batches([dict(key=key, ends_sha256=state.hexdigest())], "key binary, ends_sha256 string")


def turns_of(conversations, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"):
    """conv_id, pos (from 1), token (hex) and chars (code points) of every turn."""
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.where(conversations[conv_col].isNotNull()).select(
        conversations[conv_col].cast("long").alias("conv_id"), conversations[turn_col].alias("turn"), role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    said = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    token = F.substring(F.sha2(said.cast("binary"), 256), 1, 2 * TOKEN)
    return rows.select("conv_id", F.row_number().over(order).alias("pos"), token.alias("token"), F.length("text").cast("long").alias("chars"))


def sequences_of(turns):
    """conv_id, sequence (the digests) and chars (of each turn) from conv_id, pos, token and chars; a pos of 0 is no turn."""
    listed = F.array_sort(F.collect_list(F.when(F.col("pos") > 0, F.struct("pos", "token", "chars"))))
    return turns.groupBy("conv_id").agg(listed.alias("turns")).select(
        "conv_id", F.unhex(F.array_join(F.col("turns.token"), "")).alias("sequence"), F.col("turns.chars").alias("chars"))


def prefix_trie(turns):
    """A row for each distinct prefix of the conversations in turns (conv_id, pos, token, chars; see turns_of; a row of
    pos 0 makes a conversation known that may have no turn): COLUMNS and ends_sha256."""
    spark = turns.sparkSession
    sequences = stored(sequences_of(turns), "sequences")
    n, total = sequences.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("chars")), F.lit(0))).first()
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // SEQUENCES), -(-total // TURNS))
    order = "sequence", "conv_id"
    ordered = sequences.repartitionByRange(blocks, *order).sortWithinPartitions(*order).select("sequence", "chars", "conv_id")
    said = stored(in_arrow(ordered, _block, SAID), "trie-parts")

    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    parts = said.where(F.col("kind") == PART).groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.max("own").alias("own"), *sums)
    boundary = said.where(F.col("kind") == BOUNDARY).select("sequence").distinct()
    both = parts.withColumn("sequence", F.lit(None).cast("binary")).unionByName(boundary, allowMissingColumns=True)
    edges = stored(in_arrow(both.coalesce(1), _boundary, BOUNDARY_SAID), "trie-edges")

    pieces = said.where(F.col("kind") == IDS).select("key", "conv_id", "ends")
    hashed = in_arrow(pieces.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ends"), _hashed, "key binary, ends_sha256 string")
    nothing = F.lit(hashlib.sha256().hexdigest())
    across = edges.join(hashed, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))

    above = bounded_broadcast(edges.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above")), edges.count(), 64)
    within = said.where(F.col("kind") == NODE).drop("key").join(above, "parent_key", "left")
    within = within.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).withColumnRenamed("ends", "ends_sha256")
    return within.select(*COLUMNS, "ends_sha256").unionByName(across.select(*COLUMNS, "ends_sha256"))
