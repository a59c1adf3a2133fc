"""Line dedup by winnowing over line hashes.

A line ends with a newline or a word of the least hash among LINE_WORDS consecutive ones, so no line has more words than
that and a passage is cut alike wherever it stands, but for a few words at its ends. Words are what stands between ASCII
white space. Lines are hashed. A unit
is as many whole lines as hold UNIT_WORDS words; of the units that lie within lines of WINDOW_WORDS words the one of least
hash is a fingerprint. A run of 30 words that two texts share holds, beyond three words at either end, 24 words of lines
that are cut alike, hence a whole window, so the texts share a fingerprint whatever signs the run has and whatever stands
around it.

Each fingerprint is joined with its first occurrence in the corpus (by id, then position), matches are extended both ways
word by word, and the later run is deleted.
"""

from functools import reduce
from itertools import chain, pairwise

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.chunks import sliced
from tidemark.llm.common import bounded_broadcast, in_arrow, keyed, ship, stored

LINE_WORDS, UNIT_WORDS, WINDOW_WORDS = 2, 10, 24
#: Stands for the end of a text.
END = 2**31 - 2
#: Bytes hashed at a time; a longer text is cut at white space.
PART = 1 << 20
#: Odd factors of the hashes of words, lines and units.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
BASE = 0xD1B54A32D192ED03
#: What separates words.
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def powers(n):
    """Powers of BASE and of its inverse, n of each."""
    if not hasattr(powers, "held") or len(powers.held[0]) < n:
        powers.held = [np.multiply.accumulate(np.full(n, base, np.uint64)) for base in (BASE, pow(BASE, -1, 1 << 64))]
    return [values[:n] for values in powers.held]


class Words:
    """Words of some bytes: their hashes, first and last bytes (the last one excluded), and after which of them a line
    ends by a newline (a mask)."""

    def __init__(self, data):
        parts, begin = [], 0
        while begin < len(data):
            stop = len(data)
            if stop - begin > PART:
                cut = max(data.rfind(blank, begin + 1, begin + PART) for blank in (b" ", b"\n", b"\t"))
                stop = cut if cut > 0 else min((at for at in (data.find(blank, begin + PART) for blank in (b" ", b"\n", b"\t")) if at > 0), default=stop)
            parts.append(self._part(data, begin, stop))
            begin = stop
        none = [np.empty(0, np.uint64)] + [np.empty(0, np.int64)] * 3
        self.hashes, self.starts, self.ends, lines = (np.concatenate(x) for x in zip(none, *parts))
        # newlines are counted on through the parts
        self.breaks = np.append(lines[1:] > lines[:-1], True)[: len(lines)]

    def _part(self, data, begin, stop):
        held = np.frombuffer(data, np.uint8, stop - begin, begin)
        word = np.concatenate([[False], ~BLANK[held], [False]])
        turns = np.flatnonzero(word[1:] != word[:-1])
        starts, ends = turns[::2], turns[1::2]
        power, back = powers(len(held) + 1)
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum((held.astype(np.uint64) + np.uint64(1)) * power[: len(held)], dtype=np.uint64)])
        hashes = mixed((running[ends] - running[starts]) * back[starts])
        newlines = np.cumsum(held == 10)
        lines = newlines[starts] + getattr(self, "newlines", 0)
        self.newlines = getattr(self, "newlines", 0) + (int(newlines[-1]) if len(held) else 0)
        return hashes, starts + begin, ends + begin, lines


def shortened(hashes):
    """The 32 bits of each hash that matches are extended by."""
    return (hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)


def mixed(values):
    values = values ^ values >> np.uint64(32)
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ values >> np.uint64(32)


def line_starts(hashes, breaks, ends):
    """First words of the lines of texts one after the other. breaks: after which words a line ends anyway (a mask);
    ends: of the texts, in words."""
    n = len(hashes)
    last = breaks.copy()
    windows = n - LINE_WORDS + 1
    if windows > 0:
        least = reduce(np.minimum, (hashes[k : k + windows] for k in range(LINE_WORDS)))
        within = np.ones(n, bool)
        for k in range(1, LINE_WORDS):
            within[np.maximum(ends - k, 0)] = False  # windows that reach into the next text
        for k in range(LINE_WORDS):
            last[k : k + windows] |= (hashes[k : k + windows] == least) & within[:windows]
    last[ends - 1] = True
    return np.flatnonzero(np.concatenate([[True], last[:-1]]))


def line_hashes(hashes, starts):
    place = np.arange(len(hashes)) - np.repeat(starts, np.diff(np.append(starts, len(hashes))))
    return mixed(np.add.reduceat(hashes * FACTORS[place], starts))


def line_units(lines, starts, before, n):
    """Hash of the unit that begins at each line (no unit where too few words follow). before: how many lines begin
    before each word, of n words."""
    ends = before[np.minimum(starts + UNIT_WORDS, n)]
    power, back = powers(len(lines))
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(lines * power, dtype=np.uint64)])
    return mixed((running[ends] - running[:-1]) * back)


def chosen_units(units, starts, before, text_begins, text_ends):
    """Which units (a mask) are the least of some window, or of their whole text if it is shorter; text_begins, text_ends:
    for each line those of its text, in words."""
    bounds = np.append(starts, text_ends[-1])
    at = np.flatnonzero((starts + WINDOW_WORDS <= text_ends) | (starts == text_begins))
    # a window ends before the first line that begins WINDOW_WORDS or more words on, and its units begin UNIT_WORDS before that
    goal = np.minimum(starts[at] + WINDOW_WORDS, text_ends[at])
    stop = before[bounds[before[goal]] - UNIT_WORDS + 1]
    most = int((stop - at).max(initial=0))
    least, chosen = units[at], np.zeros(len(units), bool)
    for k in range(1, most):
        own = at + k < stop
        least[own] = np.minimum(least[own], units[at[own] + k])
    for k in range(most):
        own = at + k < stop
        place = at[own] + k
        chosen[place[units[place] == least[own]]] = True
    return chosen


def text_fingerprints(hashes, breaks, counts):
    """Of texts one after the other (hashes of their words, where lines end anyway, and the number of words of each,
    UNIT_WORDS at least): hash and place, a word of its text, of every fingerprint, in two lists of arrays."""
    counts = np.asarray(counts, np.int64)
    if not len(counts):
        return [], []
    ends, n = np.cumsum(counts), len(hashes)
    starts = line_starts(hashes, breaks, ends)
    begun = np.zeros(n, np.int64)
    begun[starts] = 1
    before = np.concatenate([[0], np.cumsum(begun)])
    lines = before[ends] - before[ends - counts]
    units = line_units(line_hashes(hashes, starts), starts, before, n)
    places = np.flatnonzero(chosen_units(units, starts, before, np.repeat(ends - counts, lines), np.repeat(ends, lines)))
    values, found, ats = units[places], [], []
    cuts = np.searchsorted(places, np.append(before[ends - counts], len(starts))).tolist()
    for k, (begin, stop) in enumerate(pairwise(cuts)):
        own, of_own = places[begin:stop], values[begin:stop]
        if len(own) > 1 and (of_own[1:] == of_own[:-1]).any():
            keep = _thinned(own.tolist(), of_own.tolist(), (WINDOW_WORDS - UNIT_WORDS) // LINE_WORDS + 1)
            own, of_own = own[keep], of_own[keep]
        found.append(of_own.view(np.int64))
        ats.append((starts[own] - (ends[k] - counts[k])).astype(np.int32))
    return found, ats


def _thinned(places, values, window):
    """Numbers of the places to keep, of those in a row with one value only as many as leave one in each window."""
    kept = []
    for k, (at, value) in enumerate(zip(places, values)):
        before = kept[-1] if kept else None
        if not (kept and k + 1 < len(places) and values[before] == value == values[k + 1] and places[k + 1] <= places[before] + window):
            kept.append(k)
    return kept


def in_lists(values, kind):
    """An Arrow column of lists from arrays."""
    import pyarrow as pa

    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, kind), *values])))


def in_words(column):
    """Words of the texts of an Arrow column of UTF-8 bytes, one after the other, and how many each has."""
    texts = [b or b"" for b in column.to_pylist()]
    words = Words(b"\n".join(texts))
    ends = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(words.starts, ends)
    return words, np.diff(upto, prepend=0)


def word_hashes(rows):
    """id, mark, hashes (of each word) of rows of id, mark and text."""
    rows = rows.withColumn("text", F.col("text").cast("binary"))
    out = T.StructType([rows.schema["id"], rows.schema["mark"], T.StructField("hashes", T.ArrayType(T.IntegerType()))])

    def computed(batches):
        import pyarrow as pa

        for part in (p for batch in batches for p in sliced(batch, 2, 1 << 20)):
            words, counts = in_words(part.column(2))
            found = np.split(shortened(words.hashes), np.cumsum(counts)[:-1])
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), in_lists(found, np.int32)], names=out.names)

    return in_arrow(rows, computed, out)


def fingerprints(docs, id_col="doc_id", text_col="text", least_words=20):
    """id, mark, n_words, units and ats (hash and word of each fingerprint) of every text of least_words words."""
    rows = keyed(docs, id_col, text_col).withColumn("text", F.col("text").cast("binary"))
    out = T.StructType([rows.schema["id"], rows.schema["mark"], T.StructField("n_words", T.IntegerType()),
                        T.StructField("units", T.ArrayType(T.LongType())), T.StructField("ats", T.ArrayType(T.IntegerType()))])

    def computed(batches):
        import pyarrow as pa

        for part in (p for batch in batches for p in sliced(batch, 2, 1 << 20)):
            words, counts = in_words(part.column(2))
            keep = counts >= max(least_words, UNIT_WORDS)
            own = np.repeat(keep, counts)
            found, ats = text_fingerprints(words.hashes[own], words.breaks[own], counts[keep])
            taken = pa.array(np.flatnonzero(keep))
            columns = [pa.array(counts[keep], pa.int32()), in_lists(found, np.int64), in_lists(ats, np.int32)]
            yield pa.RecordBatch.from_arrays([part.column(0).take(taken), part.column(1).take(taken), *columns], names=out.names)

    return in_arrow(rows, computed, out)


def alike(a, b):
    """How many first elements of two arrays are equal."""
    n, at, step = min(len(a), len(b)), 0, 32
    while at < n:
        stop = min(at + step, n)
        differ = np.flatnonzero(a[at:stop] != b[at:stop])
        if len(differ):
            return at + int(differ[0])
        at, step = stop, step * 4
    return n


def extended(hashes, first_hashes, anchors):
    """Runs [start, end) of words that equal the first text's, from (word, first word) anchors, extended both ways."""
    n, m = len(hashes), len(first_hashes)

    def same(at, shift):
        return 0 <= at < n and 0 <= at - shift < m and hashes[at] == first_hashes[at - shift]

    def walked(at, shift):
        low = alike(hashes[:at][::-1], first_hashes[: at - shift][::-1])
        return at - low, at + alike(hashes[at:], first_hashes[at - shift :])

    runs, low, reached, inside = [], 0, 0, []
    # anchors within what is covered already wait, and go on from its ends only if their words do: the last ones
    # first, so that words that repeat many times are walked through once
    for at, first in chain(sorted(anchors), [(n, None)]):
        while inside and at >= reached:
            start, shift = inside.pop()
            if same(reached, shift) or same(low - 1, shift):
                start, end = walked(start, shift)
                runs.append((start, end))
                low, reached = min(low, start), max(reached, end)
        if first is None:
            break
        if at < reached:
            inside.append((at, at - first))
        elif same(at, at - first):
            low, reached = walked(at, at - first)
            runs.append((low, reached))
    return runs


def earlier_lines(docs, id_col="doc_id", text_col="text", least_words=20):
    """id, mark, matches: for each text that shares a fingerprint with an earlier one an array of first_id, hashes of that
    text's words around where they meet, as far as a run can reach, and the words (ats, first_ats, in `hashes`) where.

    Earlier: in a text of a smaller id (null first, then by mark), or earlier in the same text. A text is compared
    only with those that a fingerprint of its first occurs in, so a passage that thousands of texts share costs
    one pair for each of them. Rows that repeat id and text are one document.
    """
    texts = stored(fingerprints(docs, id_col, text_col, least_words), "fingerprints")
    # words of the text and place in one number: each column more is eight bytes more in every shuffled row
    prints = texts.select("id", "mark", F.shiftleft(F.col("n_words").cast("long"), 32).alias("n"), F.explode(F.arrays_zip("units", "ats")).alias("p")).select(
        "id", "mark", F.col("p.units").alias("unit"), (F.col("n") + F.col("p.ats")).alias("at"))
    place = F.struct("id", "mark", "at")
    at, first_at = (F.col(c).bitwiseAND((1 << 32) - 1).cast("int") for c in ("at", "first.at"))
    # most units come once and are counted without their places; the joins below read written tables, so that adaptive
    # execution can split the rows of a hot key
    repeated = stored(prints.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("unit"), "repeated-units")
    prints = stored(prints.join(repeated, "unit"), "repeated-prints")
    first = stored(prints.groupBy("unit").agg(F.min(place).alias("first")), "first-places")
    pairs = stored(
        prints.join(first, "unit").where(place != F.col("first"))
        .groupBy("id", "mark", F.col("first.id").alias("first_id"), F.col("first.mark").alias("first_mark"))
        # no run reaches further from an anchor than the later text does, so only so much of the first one goes along
        .agg(F.greatest(F.min(first_at - at), F.lit(0)).alias("low"), F.max(first_at + F.shiftright("at", 32).cast("int") - at).alias("high"),
             F.collect_set(F.struct(at.alias("at"), first_at.alias("first_at"))).alias("anchors")), "line-pairs")
    wanted = stored(pairs.select(F.col("first_id").alias("f_id"), F.col("first_mark").alias("f_mark")).distinct(), "first-texts")
    n, size = wanted.agg(F.count(F.lit(1)), F.coalesce(F.max(F.octet_length(F.col("f_id").cast("string"))), F.lit(0))).first()
    wanted = bounded_broadcast(wanted, n, 48 + size)
    rows = keyed(docs, id_col, text_col)
    theirs = word_hashes(rows.join(wanted, F.col("id").eqNullSafe(F.col("f_id")) & (F.col("mark") == F.col("f_mark")), "left_semi"))
    theirs = stored(theirs.dropDuplicates(["id", "mark"]), "first-words").select(F.col("id").alias("f_id"), F.col("mark").alias("f_mark"), "hashes")
    met = pairs.join(theirs, F.col("first_id").eqNullSafe(F.col("f_id")) & (F.col("first_mark") == F.col("f_mark")))
    match = F.struct("first_id", F.slice("hashes", F.col("low") + 1, F.col("high") - F.col("low")).alias("hashes"), F.col("anchors.at").alias("ats"),
                     F.transform("anchors.first_at", lambda a: a - F.col("low")).alias("first_ats"))
    return met.groupBy("id", "mark").agg(F.collect_list(match).alias("matches"))


def runs_of(data, matches, least_words):
    """(first byte, end, words, first id) of the runs of one text (UTF-8) to delete, in order and apart. matches: of each
    the first id, hashes, ats and first_ats. White space belongs to the word it follows."""
    words = Words(data)
    hashes, starts = shortened(words.hashes), words.starts.tolist()
    starts[:1] = [0] if starts else []
    found = []
    for first, first_hashes, ats, first_ats in matches:
        for start, end in extended(hashes, first_hashes, zip(ats, first_ats)):
            if end - start >= least_words:
                found.append((start, end, first))
    runs, reached = [], 0
    for start, end, first in sorted(found, key=lambda r: (r[0], -r[1])):
        start = max(start, reached)
        if start < end:
            runs.append((starts[start], starts[end] if end < len(starts) else len(data), end - start, first))
            reached = end
    return runs


def left_of(data, runs):
    """data without the runs: what lies before each, and after the last."""
    ends = [0, *(end for _, end, *_ in runs)]
    return b"".join(data[end:start] for end, start in zip(ends, [*(start for start, *_ in runs), len(data)]))


def in_characters(data, runs):
    """The runs by characters; one that reaches the end of the text ends at END."""
    upto = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
    return [(int(upto[a]), END if b == len(data) else int(upto[b]), *more) for a, b, *more in runs]


def _lists(column):
    """Arrays of the lists of an Arrow column, without copies."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in pairwise(offsets.tolist())]


def _cut_udf(id_type, least_words):
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    spans = T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("n_words", T.IntegerType()),
        T.StructField("first_id", id_type)]))
    kind = T.StructType([T.StructField("spans", spans), T.StructField("text", T.StringType())])
    names = spans.elementType.names

    @F.arrow_udf(kind)
    def cut(text: pa.Array, matches: pa.Array) -> pa.Array:
        inner = matches.values
        fields = [inner.field("first_id").to_pylist(), *(_lists(inner.field(c)) for c in ("hashes", "ats", "first_ats"))] if len(inner) else []
        begin, found = matches.offsets.to_pylist(), []
        for i, data in enumerate(text):
            runs = None
            if matches[i].is_valid:
                whole = data.as_py()
                met = [(f[0], f[1], f[2].tolist(), f[3].tolist()) for f in zip(*(f[begin[i] : begin[i + 1]] for f in fields))]
                runs = runs_of(whole, met, least_words)
            found.append({"spans": [dict(zip(names, r)) for r in in_characters(whole, runs)],
                          "text": left_of(whole, runs).decode("utf-8", "replace")} if runs else None)
        return pa.array(found, to_arrow_type(kind))

    return cut


def deduplicated(docs, id_col="doc_id", text_col="text", least_words=20):
    """Every row of docs: `row`, a struct of all its columns, the text without later repeated runs; `spans`, an array
    of start, end (characters of the old text), n_words and first_id of each deleted run (null: none); `before`, the
    old text. A run has at least least_words words, less where a longer one overlaps it. Null texts stay null."""
    ship(docs.sparkSession.sparkContext)
    met = earlier_lines(docs, id_col, text_col, least_words).select(
        F.col("id").alias("m_id"), F.col("mark").alias("m_mark"), "matches")
    names = [f.name for f in docs.schema.fields]
    others = [docs[f"`{n}`"].alias(n) for n in names if n != text_col]
    rows = docs.select(F.struct(*others).alias("others"), docs[id_col].alias("id"), docs[text_col].alias("text"),
                       F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))).alias("mark"))
    joined = rows.join(met, F.col("id").eqNullSafe(F.col("m_id")) & (F.col("mark") == F.col("m_mark")), "left")
    # only texts that met an earlier one go to Python
    text = F.when(F.col("matches").isNotNull(), F.col("text").cast("binary"))
    cut = _cut_udf(docs.schema[id_col].dataType, least_words)(text, F.col("matches"))
    found = joined.select("others", F.col("text").alias("before"), cut.alias("cut"))
    left = F.when(F.col("cut").isNull(), F.col("before")).otherwise(F.col("cut.text"))
    row = F.struct(*[left.alias(n) if n == text_col else F.col("others")[n].alias(n) for n in names])
    return found.select(row.alias("row"), F.col("cut.spans").alias("spans"), "before")


def drop_repeated(docs, id_col="doc_id", text_col="text", **options):
    """docs, all columns, without later repeated runs; a text of which nothing but white space is left goes."""
    found = deduplicated(docs, id_col, text_col, **options)
    left = F.col("spans").isNull() | F.col(f"row.{text_col}").rlike(r"\S")
    return found.where(left).select("row.*")
