"""Byte-level BPE: encoding by a segment tree over byte positions, and decoding.

Each match of the pattern is encoded alone. Every byte position holds a leaf with the rank of the pair that
begins there (none: infinity); inner nodes hold the least (rank, position) below, so the root names the
leftmost pair of the lowest rank. A merge changes three leaves (the merged pair, the live neighbour on its
left, the position that died), each in a logarithmic number of steps.

Short matches go through many trees side by side in numpy arrays, one row a match; long ones through a tree
of their own. A worker remembers the ids of the chunks it has encoded, as bytes, up to a bound.
"""

import base64
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.chunks import chunks_of, sliced, texts_of
from tidemark.llm.common import in_arrow

#: Matches of more bytes get a tree of their own.
SHORT = 64
#: Matches merged side by side at a time; bounds the arrays to some MB.
SIDE_BY_SIDE = 4096
#: Chunks a worker has at hand; when full they become the old ones, of which those met again are kept.
REMEMBERED = 200_000
NONE = np.iinfo(np.int64).max


class Ranks:
    """A rank file: tokens by id, and the rank that joins two adjacent tokens."""

    def __init__(self, path):
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ids.items()}
        self.width = max(self.tokens) + 1
        joined = sorted(
            (self.ids[token[:cut]] * self.width + self.ids[token[cut:]], rank)
            for token, rank in self.ids.items() for cut in range(1, len(token))
            if token[:cut] in self.ids and token[cut:] in self.ids
        )
        self.pair_keys = np.array([k for k, _ in joined] + [NONE], dtype=np.int64)
        self.pair_ranks = np.array([r for _, r in joined] + [NONE], dtype=np.int64)
        self.bytes = np.array([self.ids[bytes([b])] for b in range(256)], dtype=np.int64)

    @cached_property
    def pairs(self):
        """Rank of each pair that joins, by key; for matches that get a tree of their own."""
        return dict(zip(self.pair_keys.tolist()[:-1], self.pair_ranks.tolist()[:-1]))

    def rank(self, left, right):
        """Rank of each pair of ids, NONE where they don't join."""
        keys = left * self.width + right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)


def merge_long(ranks, piece):
    """Ids of one match as int32 bytes, by one segment tree."""
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    ids = [int(ranks.bytes[b]) for b in piece]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pairs, width, none = ranks.pairs, ranks.width, (1 << 62, 0)
    tree = [none] * (2 * size)
    for i in range(n - 1):
        rank = pairs.get(ids[i] * width + ids[i + 1])
        if rank is not None:
            tree[size + i] = (rank, i)
    for node in range(size - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i, value):
        node = size + i
        tree[node] = value
        node >>= 1
        while node:
            least = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == least:
                break
            tree[node] = least
            node >>= 1

    def pair_at(i):
        rank = pairs.get(ids[i] * width + ids[after[i]]) if after[i] < n else None
        put(i, none if rank is None else (rank, i))

    while tree[1] is not none:
        rank, i = tree[1]
        dead = after[i]
        ids[i], ids[dead] = rank, -1
        after[i] = after[dead]
        if after[i] < n:
            before[after[i]] = i
        put(dead, none)
        pair_at(i)
        if before[i] >= 0:
            pair_at(before[i])
    return np.array([t for t in ids if t >= 0], np.int32).tobytes()


def merge_short(ranks, pieces):
    """Ids of each match as int32 bytes, by as many segment trees side by side."""
    lengths = np.array([len(p) for p in pieces])
    size = 1 << int(lengths.max() - 1).bit_length() if lengths.max() > 1 else 1
    rows = len(pieces)
    raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(rows, size)
    at = np.arange(size)
    ids = np.where(at < lengths[:, None], ranks.bytes[raw], -1)
    after = np.tile(at + 1, (rows, 1))
    before = np.tile(at - 1, (rows, 1))
    tree = np.full((rows, 2 * size), NONE)
    if size > 1:
        first = ranks.rank(ids[:, :-1], ids[:, 1:])
        first[(at[1:] >= lengths[:, None]) | (first == NONE)] = NONE // size
        tree[:, size : 2 * size - 1] = np.where(first == NONE // size, NONE, first * size + at[:-1])
        for node in range(size - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])

    def put(row, i, value):
        node = size + i
        tree[row, node] = value
        for _ in range(size.bit_length() - 1):
            node >>= 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    def pair_at(row, i):
        follows = after[row, i]
        there = follows < lengths[row]
        rank = ranks.rank(ids[row, i], ids[row, np.where(there, follows, 0)])
        joins = there & (rank != NONE)
        put(row, i, np.where(joins, np.where(joins, rank, 0) * size + i, NONE))

    live = np.flatnonzero(tree[:, 1] != NONE)
    while len(live):
        rank, i = np.divmod(tree[live, 1], size)
        dead = after[live, i]
        ids[live, i], ids[live, dead] = rank, -1
        follows = after[live, dead]
        after[live, i] = follows
        inside = follows < lengths[live]
        before[live[inside], follows[inside]] = i[inside]
        put(live, dead, NONE)
        pair_at(live, i)
        left = before[live, i]
        has = left >= 0
        pair_at(live[has], left[has])
        live = live[tree[live, 1] != NONE]
    left = ids >= 0
    flat, stops = ids[left].astype(np.int32).tobytes(), np.cumsum(4 * left.sum(axis=1)).tolist()
    return [flat[start:stop] for start, stop in zip([0] + stops, stops)]


class Codec:
    """Encodes texts by one rank file and pattern, and decodes ids."""

    def __init__(self, path, pattern):
        self.ranks, self.pattern, self.known, self.old = Ranks(path), regex.compile(pattern), {}, {}
        self.whole = {token: np.int32(rank).tobytes() for token, rank in self.ranks.ids.items()}

    def _learn(self, new):
        """Ids of chunks that aren't known yet."""
        split = [(c, [m.encode() for m in self.pattern.findall(c)]) for c in new]
        whole = self.whole
        todo = sorted({p for _, ps in split for p in ps if p not in whole}, key=len)
        short = [p for p in todo if len(p) <= SHORT]
        ids = {}
        for i in range(0, len(short), SIDE_BY_SIDE):
            ids.update(zip(short[i : i + SIDE_BY_SIDE], merge_short(self.ranks, short[i : i + SIDE_BY_SIDE])))
        for p in todo[len(short) :]:
            ids[p] = merge_long(self.ranks, p)
        for c, ps in split:
            self.known[c] = b"".join([whole[p] if p in whole else ids[p] for p in ps])

    def encode(self, texts):
        """Ids of each text, int32 arrays."""
        split = [chunks_of(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.old = {}, self.known
        missing = set(chain.from_iterable(split)).difference(self.known)
        again = missing.intersection(self.old)
        self.known.update((c, self.old[c]) for c in again)
        self._learn(missing - again)
        at_hand = self.known.__getitem__
        return [np.frombuffer(b"".join(map(at_hand, chunks)), np.int32) for chunks in split]

    def decode(self, ids):
        return b"".join(map(self.ranks.tokens.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))


@lru_cache(4)
def codec(path, pattern):
    return Codec(path, pattern)


def _lists(values):
    import pyarrow as pa

    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate([np.empty(0, np.int32), *values])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encode(docs, path, pattern, id_col="doc_id", text_col="text", decoded=False, batch_bytes=1 << 20):
    """The columns of docs that aren't the text, token_ids array<int> and, if asked for, decoded binary.

    One row for each row of docs; null and empty texts have no ids. `decoded` is what decode() makes of the
    ids. A column of docs that bears one of the new names gives way to the new one. Every executor needs the
    file at `path` (id ranks by token, as base64).
    """
    new = ["token_ids", "decoded"] if decoded else ["token_ids"]
    kept = [f for f in docs.schema.fields if f.name != text_col and f.name.lower() not in new]
    fields = [T.StructField("token_ids", T.ArrayType(T.IntegerType()))]
    if decoded:
        fields.append(T.StructField("decoded", T.BinaryType()))
    out = T.StructType(kept + fields)

    def encoded(batches):
        import pyarrow as pa

        coder = codec(path, pattern)
        for part in (p for batch in batches for p in sliced(batch, len(kept), batch_bytes)):
            ids = coder.encode(texts_of(part.column(len(kept))))
            columns = [part.column(i) for i in range(len(kept))] + [_lists(ids)]
            if decoded:
                columns.append(pa.array([coder.decode(i) for i in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    source = docs.select(*[docs[f"`{f.name}`"] for f in kept], F.col(text_col).cast("binary").alias("_text"))
    return in_arrow(source, encoded, out)


def decode(rows, path, pattern, ids_col="token_ids"):
    """The columns of rows that aren't the ids, and text string. Null ids give null; broken UTF-8 becomes U+FFFD."""
    kept = [f for f in rows.schema.fields if f.name not in (ids_col, "text")]
    out = T.StructType(kept + [T.StructField("text", T.StringType())])

    def plain(batches):
        import pyarrow as pa

        coder = codec(path, pattern)
        for batch in batches:
            texts = [None if i is None else coder.decode(i).decode("utf-8", "replace")
                     for i in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(kept))] + [pa.array(texts, pa.string())], names=out.names)

    return in_arrow(rows.select(*[rows[f"`{f.name}`"] for f in kept], rows[ids_col]), plain, out)
