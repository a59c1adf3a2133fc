"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A token enters as the vector of its word and the mean vector of all its character sequences of three to five, signs and
digits included, so words never seen, and words written with signs, are judged by their form. Tokens are what stands
between white space; a long one, such as a sentence of a language without spaces, is cut into overlapping pieces, so every
character of a text is read. Windows overlap by half, all windows of a text are scored, and the highest one is the text's
score. Labels are given to whole texts only: of a toxic text the windows that look worst are learned as toxic, chosen anew
after each round.
"""

from collections import Counter
from dataclasses import dataclass, replace
from itertools import chain
from math import log, sqrt

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.chunks import sliced, texts_of
from tidemark.llm.common import in_arrow

WINDOW, STRIDE = 32, 16
#: Sizes: a word's vector, a character sequence's vector, the state of each direction.
WORD_SIZE, GRAM_SIZE, STATE = 8, 8, 8
#: Characters of a piece of a long token, and how far the next one begins after it.
PIECE, STEP = 16, 10
#: Character sequences of a piece at most: of 3, 4 and 5 characters, its two ends marked, and its first 6 and 7.
GRAMS = sum(PIECE + 2 - n + 1 for n in (3, 4, 5)) + 2
#: Signs and digits around a word don't belong to it, but to its token.
AROUND = "".join(chr(i) for i in range(33, 127) if not chr(i).isalpha())
#: Tokens whose vectors are made side by side.
TOKENS = 8192
#: Windows scored side by side; bounds the arrays to some MB.
SIDE_BY_SIDE = 2048
#: Words a worker remembers at most; when full it forgets all of them and goes on.
REMEMBERED = 400_000


def tokens_of(text):
    """What stands between white space, in lower case; a long token as overlapping pieces."""
    tokens = text.lower().split()
    if max(map(len, tokens), default=0) <= PIECE:
        return tokens
    found = []
    for token in tokens:
        if len(token) <= PIECE:
            found.append(token)
        else:
            found += [token[i : i + PIECE] for i in range(0, len(token) - PIECE + STEP, STEP)]
    return found


def word_of(token):
    return token.strip(AROUND)


def grams(token):
    """All sequences of 3 to 5 characters, its ends marked, and its first 6 and 7."""
    marked, n = f"^{token}$", len(token)
    found = [marked[i : i + 3] for i in range(n)]
    found += [marked[i : i + 4] for i in range(n - 1)]
    found += [marked[i : i + 5] for i in range(n - 2)]
    if n >= 6:
        found.append(marked[:7])
        if n >= 7:
            found.append(marked[:8])
    return found


@dataclass
class Network:
    """Vocabularies (index 0: none) and parameters."""

    words: dict
    grams: dict
    weights: dict
    scale: float = 1.0
    threshold: float = 0.0
    scorer: object = None
    forms: object = None


class Forms:
    """Numbers of the known character sequences of many tokens at once: sequences of one length are looked up by a hash,
    and compared character by character where it is that of a known one."""

    LENGTHS = (3, 4, 5, 7, 8)
    BITS = 20

    def __init__(self, numbers):
        by_length = {n: sorted((g, i) for g, i in numbers.items() if len(g) == n) for n in self.LENGTHS}
        seed, self.tables = 0, None
        while self.tables is None:
            self.factors = np.random.default_rng(seed).integers(1, 1 << 63, max(self.LENGTHS), np.uint64) * np.uint64(2) + np.uint64(1)
            tables = [self._table(by_length[n], n) for n in self.LENGTHS]
            if all(len(np.unique(hashes)) == len(hashes) for hashes, *_ in tables):
                self.tables = tables
            seed += 1

    def _table(self, known, n):
        """Hashes in order, numbers and characters of the known sequences of n characters, and which leading bits they have."""
        points = _points(g for g, _ in known).reshape(len(known), n)
        hashes = (points * self.factors[:n]).sum(axis=1, dtype=np.uint64)
        order, some = np.argsort(hashes), np.zeros(1 << self.BITS, bool)
        some[hashes >> np.uint64(64 - self.BITS)] = True
        return hashes[order], np.array([i for _, i in known], np.int32)[order], points[order], some

    def of(self, tokens):
        """A row of GRAMS numbers for each token, the known ones first, in the order of grams(), then 0."""
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        marked = np.zeros((len(tokens), PIECE + 2), np.uint64)
        marked[:, 0] = ord("^")
        marked[:, 1:-1][np.arange(PIECE) < sizes[:, None]] = _points(tokens)
        marked[np.arange(len(tokens)), sizes + 1] = ord("$")
        found, first, hashes, done = np.zeros((len(tokens), GRAMS), np.int32), 0, 0, 0
        for n, table in zip(self.LENGTHS, self.tables):
            wide = PIECE + 3 - n if n <= 5 else 1
            hashes = hashes if done == 0 else hashes[:, :wide]
            for k in range(done, n):
                hashes = hashes + marked[:, k : k + wide] * self.factors[k]
            # a sequence lies within its marked token, one of the first 6 or 7 characters before the mark at its end
            within = np.arange(wide) + n <= sizes[:, None] + (2 if n <= 5 else 1)
            self._look_up(table, n, hashes, within, marked, found[:, first : first + wide])
            first, done = first + wide, n
        rows, known = np.zeros_like(found), found > 0
        rows[np.arange(GRAMS) < known.sum(axis=1)[:, None]] = found[known]
        return rows

    def _look_up(self, table, n, hashes, within, marked, found):
        known, numbers, points, some = table
        if not len(known):
            return
        row, at = np.nonzero(some[hashes >> np.uint64(64 - self.BITS)] & within)
        own = hashes[row, at]
        place = np.minimum(np.searchsorted(known, own), len(known) - 1)
        same = known[place] == own
        row, at, place = row[same], at[same], place[same]
        same = (marked[row[:, None], at[:, None] + np.arange(n)] == points[place]).all(axis=1)
        found[row[same], at[same]] = numbers[place[same]]


def _points(strings):
    """Code points of strings, one after the other."""
    return np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


def _inputs(net, tokens):
    """Numbers of the tokens' words, and of their character sequences (a row of GRAMS each; 0: not known)."""
    known = net.words.get
    ids = np.array([known(t.strip(AROUND), 0) for t in tokens], np.int64)
    if net.forms is None:
        net.forms = Forms(net.grams)
    rows = [net.forms.of(tokens[i : i + TOKENS]) for i in range(0, len(tokens), TOKENS)]
    return ids, np.concatenate([np.zeros((0, GRAMS), np.int32), *rows])


def _vectors(net, ids, rows):
    used = max(1, int((rows > 0).sum(axis=1).max(initial=0)))  # what is known comes first
    rows = rows[:, :used]
    form = net.weights["gram"][rows].sum(axis=1) / np.maximum((rows > 0).sum(axis=1), 1)[:, None].astype(np.float32)
    return np.concatenate([net.weights["word"][ids], form], axis=1)


def _project(net, vectors):
    w = net.weights
    return vectors @ w["in_f"] + w["bias_f"], vectors @ w["in_b"] + w["bias_b"]


def _run(projected, ids, mask, hidden, steps, keep):
    """States of one direction at each step; keep: also what the way back needs."""
    n, h = len(ids), np.zeros((len(ids), STATE), np.float32)
    states, kept = np.empty((ids.shape[1], n, STATE), np.float32), {}
    for t in steps:
        g = projected.take(ids[:, t], axis=0)
        u = h @ hidden
        gates = _sigmoid(g[:, : 2 * STATE] + u[:, : 2 * STATE])
        z, r = gates[:, :STATE], gates[:, STATE:]
        new = np.tanh(g[:, 2 * STATE :] + r * u[:, 2 * STATE :])
        live = mask[:, t, None]
        if keep:
            kept[t] = (h, u, z, r, new)
        h = h + live * (1 - z) * (new - h)
        states[t] = h
    return states, kept


def _forward(net, projected, ids, keep=False):
    """Logits of windows given by rows of word numbers (-1: padding)."""
    w, mask = net.weights, (ids >= 0).astype(np.float32)
    at, length = np.maximum(ids, 0), ids.shape[1]
    forth, kept_f = _run(projected[0], at, mask, w["hid_f"], range(length), keep)
    back, kept_b = _run(projected[1], at, mask, w["hid_b"], range(length - 1, -1, -1), keep)
    both = np.concatenate([forth, back], axis=2)
    seen = np.tanh(both @ w["att"] + w["att_bias"])
    score = seen @ w["att_out"] - 1e9 * (1 - mask.T)
    score = np.exp(score - score.max(axis=0))
    share = score / score.sum(axis=0)
    pooled = (share[:, :, None] * both).sum(axis=0)
    pooled *= (mask.sum(axis=1) > 0)[:, None]
    logit = pooled @ w["out"] + w["out_bias"]
    return logit, (mask, at, both, seen, share, pooled, kept_f, kept_b)


def _back_run(grad_states, kept, mask, hidden, steps):
    """Gradients of the projected inputs by step, and of the hidden weights."""
    grad_in, grad_hidden = {}, np.zeros_like(hidden)
    carry = np.zeros_like(grad_states[0])
    for t in steps:
        h, u, z, r, new = kept[t]
        total = grad_states[t] + carry
        live = mask[:, t, None]
        step = total * live
        d_new = step * (1 - z) * (1 - new * new)
        d_z = step * (h - new) * z * (1 - z)
        d_r = d_new * u[:, 2 * STATE :] * r * (1 - r)
        grad_in[t] = np.concatenate([d_z, d_r, d_new], axis=1)
        d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
        grad_hidden += h.T @ d_u
        carry = total * (1 - live) + step * z + d_u @ hidden.T
    return grad_in, grad_hidden


def _gradients(net, vectors, ids, target):
    """Loss and gradients for a batch of windows; the words' come as that of their vectors."""
    w, projected = net.weights, _project(net, vectors)
    logit, (mask, at, both, seen, share, pooled, kept_f, kept_b) = _forward(net, projected, ids, keep=True)
    p = _sigmoid(logit)
    d_logit = ((p - target) / len(ids)).astype(np.float32)
    grads = {"out": pooled.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
    d_pooled = d_logit[:, None] * w["out"]
    d_share = (both * d_pooled).sum(axis=2)
    d_both = share[:, :, None] * d_pooled
    d_score = share * (d_share - (share * d_share).sum(axis=0))
    grads["att_out"] = np.einsum("tna,tn->a", seen, d_score)
    d_seen = d_score[:, :, None] * w["att_out"] * (1 - seen * seen)
    grads["att"] = np.einsum("tnh,tna->ha", both, d_seen)
    grads["att_bias"] = d_seen.sum(axis=(0, 1))
    d_both = d_both + d_seen @ w["att"].T
    length, d_vectors = ids.shape[1], np.zeros_like(vectors)
    for side, kept, steps, part in (
        ("f", kept_f, range(length - 1, -1, -1), d_both[:, :, :STATE]), ("b", kept_b, range(length), d_both[:, :, STATE:])):
        d_in, grads["hid_" + side] = _back_run(part, kept, mask, w["hid_" + side], steps)
        flat = np.zeros((len(vectors), 3 * STATE), np.float32)
        np.add.at(flat, at.T.ravel(), np.concatenate([d_in[t] for t in range(length)]))
        grads["in_" + side], grads["bias_" + side] = vectors.T @ flat, flat.sum(axis=0)
        d_vectors += flat @ w["in_" + side].T
    loss = float(np.mean(np.logaddexp(0, logit) - target * logit))
    return loss, grads, d_vectors


class Adam:
    def __init__(self, weights, rate):
        self.weights, self.rate, self.t = weights, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, grads):
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            self.weights[k] -= (self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-6)).astype(np.float32)


def windows_of(numbers):
    """Overlapping windows of a text's word numbers, -1 beyond its end; a text without words has one of padding."""
    n = len(numbers)
    count = max(1, -(-(n - WINDOW) // STRIDE) + 1) if n > WINDOW else 1
    padded = np.full((count - 1) * STRIDE + WINDOW, -1, np.int64)
    padded[:n] = numbers
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]


def _log_odds(counts, totals, least):
    """Items by their log odds of toxic against other texts, drawn towards 0 by 1.64 standard errors."""
    found = {}
    for item in set(counts[0]) | set(counts[1]):
        a, b = counts[1][item], counts[0][item]
        if a + b >= least:
            odds = log((a + 0.5) / (totals[1] + 1)) - log((b + 0.5) / (totals[0] + 1))
            doubt = 1.64 * sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
            found[item] = max(0.0, odds - doubt) + min(0.0, odds + doubt)
    return found


def train(texts, labels, rounds=3, epochs=3, batch=128, rate=0.01, vocabulary=40_000, seed=5):
    """Network from texts and 0/1 labels, or None without both labels. A fifth of the texts only calibrates."""
    if len(set(labels)) < 2:
        return None
    random = np.random.default_rng(seed)
    split = [tokens_of(text) for text in texts]
    labels = np.array(labels)
    held = np.zeros(len(texts), bool)
    for label in (0, 1):
        own = np.flatnonzero(labels == label)
        held[own[: len(own) // 5]] = True
    learning = np.flatnonzero(~held)
    seen, forms = {0: Counter(), 1: Counter()}, {0: Counter(), 1: Counter()}
    for i in learning:
        own = set(split[i])
        seen[labels[i]].update(set(map(word_of, own)) - {""})
        forms[labels[i]].update(set(chain.from_iterable(map(grams, own))))
    totals = Counter(labels[learning].tolist())
    least = 3 if totals[1] < 200 else 5
    tables, odds = [], []
    for counts in (seen, forms):
        by_item = _log_odds(counts, totals, least)
        ranked = sorted(by_item, key=lambda x: (-abs(by_item[x]), x))[:vocabulary]
        tables.append({x: i for i, x in enumerate(ranked, 1)})
        odds.append(np.array([0.0] + [by_item[x] for x in ranked], np.float32))

    def normal(*shape):
        return random.normal(0, 1 / sqrt(shape[0]), shape).astype(np.float32)

    size, two = WORD_SIZE + GRAM_SIZE, 2 * STATE
    weights = {
        "word": 0.05 * random.normal(size=(len(odds[0]), WORD_SIZE)).astype(np.float32),
        "gram": 0.05 * random.normal(size=(len(odds[1]), GRAM_SIZE)).astype(np.float32),
        "in_f": normal(size, 3 * STATE), "in_b": normal(size, 3 * STATE), "hid_f": normal(STATE, 3 * STATE), "hid_b": normal(STATE, 3 * STATE),
        "bias_f": np.zeros(3 * STATE, np.float32), "bias_b": np.zeros(3 * STATE, np.float32),
        "att": normal(two, two), "att_bias": np.zeros(two, np.float32), "att_out": normal(two), "out": normal(two),
        "out_bias": np.full(1, -2.0, np.float32),
    }
    weights["word"][:, 0], weights["gram"][:, 0] = odds[0] / 3, odds[1] / 3
    net = Network(tables[0], tables[1], weights)
    words = sorted({w for own in split for w in own})
    number = {w: i for i, w in enumerate(words)}
    word_ids, forms_of = _inputs(net, words)
    windows = [windows_of([number[w] for w in own]) for own in split]
    formed = np.concatenate([odds[1][forms_of[i : i + TOKENS]].sum(axis=1) for i in range(0, len(words), TOKENS)] or [np.zeros(0, np.float32)])
    hint = np.maximum(odds[0][word_ids], formed / np.maximum((forms_of > 0).sum(axis=1), 1))
    dense = Adam({k: v for k, v in weights.items() if k not in ("word", "gram")}, rate)
    speed = {"word": np.zeros(len(odds[0]), np.float32), "gram": np.zeros(len(odds[1]), np.float32)}

    def scores():
        """Logit of each window of each text."""
        every = np.concatenate(windows)
        vectors = [_vectors(net, word_ids[i : i + TOKENS], forms_of[i : i + TOKENS]) for i in range(0, len(words), TOKENS)]
        projected = _project(net, np.concatenate([np.zeros((0, size), np.float32), *vectors]))
        found = np.concatenate([_forward(net, projected, every[i : i + SIDE_BY_SIDE])[0] for i in range(0, len(every), SIDE_BY_SIDE)])
        return np.split(found, np.cumsum([len(x) for x in windows])[:-1])

    def sparse_step(name, rows, grads):
        """Adagrad for the rows of a table that a batch touches."""
        speed[name] += np.bincount(rows, (grads * grads).mean(axis=1), len(speed[name])).astype(np.float32)
        np.subtract.at(weights[name], rows, 0.02 * grads / (np.sqrt(speed[name][rows])[:, None] + 1e-6))
        weights[name][0] = 0

    for turn in range(rounds):
        if turn:
            rated = scores()
        else:
            rated = [np.sort(np.where(w >= 0, hint[np.maximum(w, 0)], 0), axis=1)[:, -3:].sum(axis=1) for w in windows]
        chosen, target = [], []
        for i in learning:
            order = np.argsort(-rated[i], kind="stable")
            if labels[i]:
                take = [k for k in order[:3] if k == order[0] or rated[i][k] > (0 if turn else 2)]
            else:
                take = list(order[:2]) + list(random.choice(order[2:], min(2, len(order) - 2), replace=False) if len(order) > 2 else [])
            chosen += [windows[i][k] for k in take]
            target += [0.95 if labels[i] else 0.01] * len(take)
        chosen, target = np.array(chosen), np.array(target, np.float32)
        for _ in range(epochs):
            order = random.permutation(len(chosen))
            for i in range(0, len(order), batch):
                rows = chosen[order[i : i + batch]]
                local, inverse = np.unique(rows, return_inverse=True)
                inverse = inverse.reshape(rows.shape) - (local[0] < 0)
                local = local[local >= 0]
                if not len(local):
                    continue
                ids, forms = word_ids[local], forms_of[local]
                vectors = _vectors(net, ids, forms)
                _, grads, d_vectors = _gradients(net, vectors, inverse, target[order[i : i + batch]])
                dense.step(grads)
                sparse_step("word", ids, d_vectors[:, :WORD_SIZE])
                shares = d_vectors[:, WORD_SIZE:] / np.maximum((forms > 0).sum(axis=1), 1)[:, None]
                own, place = np.nonzero(forms)
                sparse_step("gram", forms[own, place], shares[own])
    top = np.array([r.max() for r in scores()])
    _calibrate(net, top[held], labels[held])
    return net


def _calibrate(net, top, labels):
    """Threshold of the best F1 on held-out texts (the middle of the best gap), and a logistic slope."""
    order = np.argsort(-top)
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(top) + 1) + labels.sum())
    last = int(np.flatnonzero(f1 >= f1.max() - 1e-9)[0])
    below = top[order[last + 1]] if last + 1 < len(top) else top[order[last]] - 1
    net.threshold = float((top[order[last]] + below) / 2)
    spread = np.median(top[order[: last + 1]]) - np.median(top[order[last + 1 :]]) if last + 1 < len(top) else 1.0
    net.scale = float(6.0 / max(spread, 1e-3))


#: The score that counts as toxic.
TOXIC = 0.7


def fit(docs, labels, id_col="doc_id", text_col="text", label_col="toxic", per_class=(1600, 1200), pieces=24, piece_chars=1000):
    """Network from the labelled rows of docs.

    A bounded sample trains it: of the rows labelled 0 and 1 at most per_class, those of least id hash. Of a text of more
    than `pieces` pieces of piece_chars characters the pieces of least hash are taken, wherever they stand; such a text
    labelled 1 is left out, since its label may stand for a piece that isn't among them. Scoring reads whole texts. The
    sample is the only thing that reaches the driver. Null labels, ids and
    texts are left out; an id labelled twice counts as toxic if any label says so. None without both labels.
    """
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("l_id")).agg(
        F.max((F.col(label_col) == 1).cast("int")).alias("label"))
    here = docs.where(docs[id_col].isNotNull() & docs[text_col].isNotNull())
    sizes = here.groupBy(docs[id_col].alias("l_id")).agg(F.min(F.length(docs[text_col])).alias("size"))
    marked = marked.join(sizes, "l_id").where((F.col("label") == 0) | (F.col("size") <= pieces * piece_chars)).withColumn("h", F.xxhash64("l_id", F.lit(11)))
    sample = [r for label, most in enumerate(per_class) for r in marked.where(F.col("label") == label).orderBy("h", "l_id").limit(most).collect()]
    if not sample:
        return None
    kind = docs.schema[id_col].dataType
    chosen = docs.sparkSession.createDataFrame([(r["l_id"], r["label"]) for r in sample], T.StructType([T.StructField("l_id", kind), T.StructField("label", T.IntegerType())]))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.length(docs[text_col]) - 1) / piece_chars).cast("int")), lambda i: F.struct(
        F.xxhash64(F.lit(13), i).alias("h"), F.substring(docs[text_col], i * piece_chars + 1, F.lit(piece_chars)).alias("piece")))
    drawn = F.array_join(F.slice(F.array_sort(cut), 1, pieces)["piece"], " ")
    whole = F.length(docs[text_col]) <= pieces * piece_chars
    rows = here.join(F.broadcast(chosen), docs[id_col] == chosen["l_id"]).select("l_id", "label", F.when(whole, docs[text_col]).otherwise(drawn).alias("drawn")).groupBy(
        "l_id").agg(F.min("drawn").alias("text"), F.max("label").alias("label"))
    rows = sorted(rows.collect(), key=lambda r: str(r["l_id"]))
    order = np.random.default_rng(3).permutation(len(rows))
    return train([rows[i]["text"] for i in order], [rows[i]["label"] for i in order])


class Scorer:
    """Scores texts; words are projected once and remembered."""

    def __init__(self, net):
        self.net = net
        self.forget()

    def forget(self):
        self.number, self.count = {}, 0
        self.projected = [np.zeros((1 << 14, 3 * STATE), np.float32) for _ in range(2)]  # padding reads row 0, also before there is a token

    def learn(self, tokens):
        for i in range(0, len(tokens), TOKENS):
            self._learn(tokens[i : i + TOKENS])

    def _learn(self, tokens):
        vectors = _vectors(self.net, *_inputs(self.net, tokens))
        stop = self.count + len(tokens)
        for side, rows in enumerate(_project(self.net, vectors)):
            while len(self.projected[side]) < stop:
                self.projected[side] = np.concatenate([self.projected[side], np.empty_like(self.projected[side])])
            self.projected[side][self.count : stop] = rows
        self.number.update(zip(tokens, range(self.count, stop)))
        self.count = stop

    def scores(self, texts):
        split = [tokens_of(t) for t in texts]
        if self.count > REMEMBERED:
            self.forget()
        new = list(set(chain.from_iterable(split)).difference(self.number))
        if new:
            self.learn(new)
        counts = list(map(len, split))
        numbers = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), np.int64, sum(counts))
        windows = list(map(windows_of, np.split(numbers, np.cumsum(counts)[:-1])))
        every = np.concatenate(windows)
        logits = np.concatenate([_forward(self.net, self.projected, every[i : i + SIDE_BY_SIDE])[0]
                                 for i in range(0, len(every), SIDE_BY_SIDE)])
        first = np.cumsum([0] + [len(w) for w in windows[:-1]])
        top = np.maximum.reduceat(logits, first)
        return _sigmoid(self.net.scale * (top - self.net.threshold) + log(TOXIC / (1 - TOXIC)))


def _scorer(net):
    """The scorer of a network; a worker keeps it from task to task."""
    if net is not None and net.scorer is None:
        net.scorer = Scorer(net)
    return net and net.scorer


def toxicity(docs, net, id_col="doc_id", text_col="text", batch_bytes=1 << 20):
    """id, score (0 to 1), predicted (1 from a score of 0.7) of every row.

    The score is that of the worst of all windows of the whole text; null and empty texts have that of a window
    without words, and without a network every score is 0. Other columns of docs are ignored.
    """
    out = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType()),
                        T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(net and replace(net, scorer=None, forms=None))  # bounded by the vocabulary

    def scored(batches):
        import pyarrow as pa

        scorer = _scorer(shared.value)
        for part in (p for batch in batches for p in sliced(batch, 1, batch_bytes)):
            texts = texts_of(part.column(1))
            found = scorer.scores(texts) if scorer else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(found, pa.float64()), pa.array((found >= TOXIC).astype(np.int32), pa.int32())], names=out.names)

    return in_arrow(docs.select(docs[id_col], F.col(text_col).cast("binary")), scored, out)
