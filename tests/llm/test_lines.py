"""Line dedup against plain comparison of all texts."""

import random
import re

import pytest

from tidemark.llm import line_dedup as L


def sentence(pick, words):
    return " ".join(f"w{pick.randrange(5000)}" for _ in range(words)).capitalize() + "."


def passage(pick, words):
    """Sentences of 5 to 12 words, words in all."""
    made = []
    while words:
        n = min(words, pick.randrange(5, 13))
        made.append(sentence(pick, n))
        words -= n
    return " ".join(made)


def corpus():
    pick = random.Random(6)
    shared = [passage(pick, 55 + 10 * i) for i in range(4)]
    texts = {}
    for i in range(40):
        parts = [passage(pick, pick.randrange(20, 120)) for _ in range(3)]
        for text in shared:
            if pick.random() < 0.4:
                parts.insert(pick.randrange(len(parts) + 1), text)
        texts[i] = pick.choice(("\n", " ", "\n\n")).join(parts)
    texts[40] = texts[3]
    texts[41] = "\n".join(["Only this one line here."] * 30)
    return texts, shared


@pytest.fixture(scope="module")
def cleaned(spark):
    texts, shared = corpus()
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in texts.items()], "doc_id long, text string, spans int, matches string").repartition(3)
    rows = L.deduplicated(docs).collect()
    return texts, shared, {r["row"]["doc_id"]: (r["row"]["text"], r["spans"] or []) for r in rows}


def words(text):
    return text.split()


def prints_of(*texts):
    """Per text the fingerprints and their places, of texts worked off together."""
    import pyarrow as pa

    held, counts = L.in_words(pa.array([t.encode() for t in texts]))
    found, ats = L.text_fingerprints(held.hashes, held.breaks, counts)
    return [(f.tolist(), a.tolist()) for f, a in zip(found, ats)]


def plain_lines(text):
    """Lines as lists of words: cut after newlines and words of the least hash of some LINE_WORDS."""
    held, last = [], set()
    for line in text.split("\n"):
        held += line.split()
        last.add(len(held) - 1)
    hashes = L.Words(text.encode()).hashes.tolist()
    assert len(hashes) == len(held)
    cuts = set(last) | {len(held) - 1}
    for i in range(len(held) - L.LINE_WORDS + 1):
        least = min(hashes[i : i + L.LINE_WORDS])
        cuts |= {k for k in range(i, i + L.LINE_WORDS) if hashes[k] == least}
    lines, line = [], []
    for k, word in enumerate(held):
        line.append(word)
        if k in cuts:
            lines.append(line)
            line = []
    return lines


@pytest.mark.parametrize("part", [64, 1 << 20])
def test_words(monkeypatch, part):
    monkeypatch.setattr(L, "PART", part)
    pick = random.Random(11)
    for n in (0, 1, 2, 50, 400):
        gaps = [" ", "\n", "\t ", "\n\n", "\r\x0b\x0c"]
        pieces = [(pick.choice(["a", "é", "漢字", "word", "x" * 70, "a\u00a0b"]), pick.choice(gaps)) for _ in range(n)]
        data = (pick.choice(["", " ", "\n"]) + "".join(w + g for w, g in pieces)).encode()
        found = L.Words(data)
        assert [data[a:b].decode() for a, b in zip(found.starts, found.ends)] == [w for w, _ in pieces]
        assert found.breaks.tolist() == ["\n" in g or k == n - 1 for k, (_, g) in enumerate(pieces)]
        assert len(set(found.hashes.tolist())) == len({w for w, _ in pieces})
        assert dict(zip([w for w, _ in pieces], found.hashes.tolist())) == {w: L.Words(w.encode()).hashes[0] for w, _ in pieces}


def plain_fingerprints(text):
    """Units (as tuples of lines) that some window must choose from, by window, beside the first words of all units."""
    lines = [tuple(line) for line in plain_lines(text)]
    begins = [sum(map(len, lines[:i])) for i in range(len(lines) + 1)]

    def reach(i, many):
        return next((k for k in range(i, len(lines) + 1) if begins[k] - begins[i] >= many), None)

    units = {i: reach(i, L.UNIT_WORDS) for i in range(len(lines)) if reach(i, L.UNIT_WORDS) is not None}
    windows = [{begins[k] for k, end in units.items() if k >= i and end <= reach(i, L.WINDOW_WORDS)} for i in range(len(lines)) if reach(i, L.WINDOW_WORDS) is not None]
    windows = windows or [{begins[k] for k in units}]
    return {begins[i]: tuple(lines[i:end]) for i, end in units.items()}, windows


def test_lines_have_few_words_and_are_cut_alike():
    pick = random.Random(1)
    for _ in range(100):
        run = " ".join(f"w{pick.randrange(99)}" for _ in range(40))
        a, b = (plain_lines(f"{rim} {run} {rim}") for rim in ("x y z", "other. start\nhere u v"))
        assert max(map(len, a + b)) <= L.LINE_WORDS
        inner = run.split()[5:-5]
        for lines in (a, b):
            joined = [w for line in lines for w in line]
            assert any(joined[i : i + len(inner)] == inner for i in range(len(joined)))


def test_fingerprints_are_window_minima_of_line_units():
    pick = random.Random(2)
    texts = [" ".join(f"w{pick.randrange(300)}" + pick.choice(["", "", ".", "\n", ","]) for _ in range(n)) for n in (20, 21, 25, 40, 90, 200)]
    texts += ["same " * 60, "a b c d " * 30]
    assert [p for t in texts for p in prints_of(t)] == prints_of(*texts)
    by_hash = {}
    for text, (prints, ats) in zip(texts, prints_of(*texts)):
        units, windows = plain_fingerprints(text)
        assert set(ats) <= set(units)
        for value, at in zip(prints, ats):
            assert by_hash.setdefault(value, units[at]) == units[at]
        assert all(window & set(ats) for window in windows)
        assert len(ats) < len(units) or len(units) < 4


def test_a_shared_run_of_thirty_words_shares_a_fingerprint():
    """Whatever signs it has, however few different words, and whatever stands around it."""
    pick = random.Random(3)
    for _ in range(600):
        many = pick.choice([2, 5, 50, 5000])

        def plain(n):
            return " ".join(f"w{pick.randrange(many)}" + pick.choice(["", "", ".", ",", "\n"]) for _ in range(n))

        run = plain(30)
        a, b = prints_of(f"{plain(pick.randrange(40))}\n{run} {plain(pick.randrange(40))}", f"{plain(pick.randrange(40))} {run}. {plain(pick.randrange(40))}")
        assert set(a[0]) & set(b[0])


def covered(texts, least=20):
    """Words of each text, in the order of ids, that lie in a run of `least` words seen before, by looking at all runs."""
    seen, found = set(), {}
    for i, text in sorted(texts.items()):
        held = words(text)
        found[i] = set()
        for k in range(len(held) - least + 1):
            run = tuple(held[k : k + least])
            if run in seen:
                found[i] |= set(range(k, k + least))
            seen.add(run)
    return found


def deleted_words(text, spans):
    places = [m.start() for m in re.finditer(r"\S+", text)]
    return {k for k, at in enumerate(places) if any(s["start"] <= at < s["end"] for s in spans)}


def test_deleted_runs_are_those_of_a_plain_comparison(cleaned):
    texts, _, found = cleaned
    plain = covered(texts)
    for i, (_, spans) in found.items():
        if i != 41:
            assert deleted_words(texts[i], spans) == plain[i]
    # of a text that repeats itself throughout only what its first period can be
    assert deleted_words(texts[41], found[41][1]) <= plain[41] and len(plain[41] - deleted_words(texts[41], found[41][1])) < 40


def test_deleted_runs_occur_in_the_text_they_name(cleaned):
    texts, _, found = cleaned
    for i, (left, spans) in found.items():
        for span in spans:
            run, first = words(texts[i][span["start"] : span["end"]]), span["first_id"]
            assert first < i or (first == i == 41)
            assert len(run) == span["n_words"] and " ".join(run) in " ".join(words(texts[first]))
        kept = [w for k, w in enumerate(words(texts[i])) if k not in deleted_words(texts[i], spans)]
        assert words(left) == kept


def test_passages_stay_once(cleaned):
    texts, shared, found = cleaned
    for text in shared:
        holders = [i for i, t in texts.items() if text in t]
        assert len(holders) > 3
        left = [i for i in holders if " ".join(words(text)) in " ".join(words(found[i][0]))]
        assert left == holders[:1]


def test_clean_texts_are_left_alone(cleaned):
    texts, shared, found = cleaned
    clean = [i for i, t in texts.items() if i < 40 and not any(s in t for s in shared)]
    assert clean and all(found[i] == (texts[i], []) for i in clean)


def test_copies_and_repeats(cleaned):
    texts, _, found = cleaned
    assert found[40][0] == ""
    assert 5 <= len(words(found[41][0])) < len(words(texts[41])) / 2


def test_drop_repeated_keeps_the_columns(spark):
    texts, _ = corpus()
    rows = [(i, t, len(t), 1) for i, t in texts.items()] + [(90, None, 0, 1), (91, "", 0, 1), (None, texts[0], 5, 1), (5, texts[5], 7, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, others int")
    kept = L.drop_repeated(docs)
    assert kept.columns == docs.columns
    found = {}
    for r in kept.collect():
        found.setdefault(r["doc_id"], []).append(r["text"])
    assert 40 not in found and found[90] == [None] and found[91] == [""]
    assert found[None] == [texts[0]] and 0 not in found  # a null id comes first
    assert len(found[5]) == 2 and len(set(found[5])) == 1  # repeated rows are one document
    assert L.drop_repeated(docs.limit(0)).collect() == []


def plainly_extended(hashes, first, anchors):
    """Lines of all runs, each walked from its anchor."""
    lines = set()
    for at, other in anchors:
        for step in (1, -1):
            k = 0
            while 0 <= at + k < len(hashes) and 0 <= other + k < len(first) and hashes[at + k] == first[other + k]:
                lines.add(at + k)
                k += step
    return lines


def test_extension_finds_every_line():
    pick = random.Random(4)
    for _ in range(500):
        first = [pick.randrange(4) for _ in range(pick.randrange(1, 30))]
        hashes = [pick.randrange(4) for _ in range(pick.randrange(1, 30))]
        anchors = [(i, j) for i in range(len(hashes)) for j in range(len(first)) if hashes[i] == first[j] and pick.random() < 0.2]
        runs = L.extended(L.np.array(hashes), L.np.array(first), anchors)
        assert {k for start, end in runs for k in range(start, end)} == plainly_extended(hashes, first, anchors)


def test_words_that_repeat_many_times_are_walked_once():
    n, hot = 40_000, L.np.full(40_000, 7)
    assert L.extended(hot, hot, [(i, 0) for i in range(1, n)]) == [(1, n)]
    covered = L.extended(hot, L.np.append(hot[: n // 2], 8), [(i, 0) for i in range(n)])
    assert covered[0][0] == 0 and max(end for _, end in covered) == n


def test_how_many_are_alike():
    pick = random.Random(5)
    for n in (0, 1, 31, 32, 33, 160, 1000):
        a = L.np.arange(n)
        for at in {0, n // 2, n - 1} & set(range(n)):
            b = L.np.append(a, pick.randrange(9))
            b[at] = -1
            assert L.alike(a, b) == at == L.alike(b, a)
        assert L.alike(a, L.np.append(a, 5)) == n


def test_a_long_first_text_sends_what_a_short_one_can_reach(spark):
    pick = random.Random(8)
    run = passage(pick, 40)
    long = f"{passage(pick, 3000)} {run} {passage(pick, 3000)}"
    docs = spark.createDataFrame([(1, long), (2, f"{passage(pick, 10)} {run}")], "doc_id long, text string")
    row = L.earlier_lines(docs).first()
    assert row["id"] == 2 and all(len(m["hashes"]) <= 100 for m in row["matches"])
    cut = {r["row"]["doc_id"]: r["spans"] for r in L.deduplicated(docs).collect()}
    assert cut[1] is None and [s["n_words"] for s in cut[2]] == [40]


def test_every_passage_of_fifty_words_is_found(spark):
    """Without a sign, and with few whole lines of its own, glued between other words: all but the copied run stays."""
    pick = random.Random(12)

    def plain(n):
        return " ".join(f"w{pick.randrange(50_000)}" for _ in range(n))

    runs = [plain(50) for _ in range(30)] + [f"{plain(16)}, {plain(18)}, {plain(16)}" for _ in range(30)] + [plain(30) for _ in range(30)]
    texts = [f"{plain(n)} {run} {plain(n)}" for run in runs for n in (8, 60)]
    found = L.deduplicated(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    deleted = {r["row"]["doc_id"]: [texts[r["row"]["doc_id"]][s["start"] : s["end"]].strip() for s in r["spans"] or []] for r in found}
    assert all(deleted[2 * i] == [] and deleted[2 * i + 1] == [run] for i, run in enumerate(runs))
