"""Language identification and toxicity: held-out accuracy, gradients and odd inputs."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_id, toxicity
from tidemark.llm.common import crc32_of

FOLDER = "/root/testdata/sf0.01"


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_languages_of_held_out_documents(spark):
    from tidemark.llm.queries import op3_language

    truth = {r["doc_id"]: r["lang"] for r in documents(spark).select("doc_id", "lang").collect()}
    rows = op3_language(spark, FOLDER).collect()
    assert len(rows) == len(truth) and all(r["held_out"] == brute.held_out(r["doc_id"], 4, 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.96
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_texts_have_a_language_or_none(spark):
    docs = documents(spark)
    model = language_id.fit(docs, samples=16)
    assert language_id.fit(docs, samples=16) == model
    german = docs.where("lang = 'de' and n_chars > 300").orderBy("doc_id").first()["text"]
    rows = [(1, None, 0), (2, "", 0), (3, "123 !! ??", 0), (4, "a" * 300_000, 0), (5, "the and for with", 0), (5, "the and for with", 0), (None, german, 0)]
    found = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, score int"), model).collect()
    by_id = {r["doc_id"]: (r["lang"], r["rejected"]) for r in found}
    assert len(found) == 7 and all(by_id[i] == ("und", True) for i in (1, 2, 3))
    assert by_id[5][0] == "en" and by_id[None][0] == "de" and by_id[4][0] in model.languages
    nothing = language_id.fit(docs.limit(0))
    assert {r["lang"] for r in language_id.identify(docs.limit(3), nothing).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), model).collect() == []


def test_narrow_margins_are_rejected():
    model = language_id.LanguageModel((("x", b"abc def ghi " * 9), ("y", b"abc def ghi " * 9)))
    assert language_id.classify(model, "abc def")[0::2] == ("x", True)


def test_gradients_are_those_of_the_loss():
    pick = np.random.default_rng(0)
    size, state = toxicity.WORD_SIZE + toxicity.GRAM_SIZE, toxicity.STATE
    shapes = {"in_f": (size, 3 * state), "in_b": (size, 3 * state), "hid_f": (state, 3 * state), "hid_b": (state, 3 * state), "bias_f": (3 * state,),
              "bias_b": (3 * state,), "att": (2 * state, 2 * state), "att_bias": (2 * state,), "att_out": (2 * state,), "out": (2 * state,), "out_bias": (1,)}
    net = toxicity.Network({}, {}, {k: 0.4 * pick.normal(size=s) for k, s in shapes.items()})
    vectors, ids, target = pick.normal(size=(7, size)), pick.integers(0, 7, (5, 6)), np.array([0, 1, 1, 0, 1.0])
    ids[0, 3:], ids[1, 5:] = -1, -1
    _, grads, d_vectors = toxicity._gradients(net, vectors, ids, target)
    for name, values in {**net.weights, "vectors": vectors}.items():
        got = d_vectors if name == "vectors" else grads[name]
        for _ in range(4):
            at = tuple(pick.integers(0, n) for n in values.shape)
            old, losses = values[at], []
            for step in (1e-3, -1e-3):
                values[at] = old + step
                losses.append(toxicity._gradients(net, vectors, ids, target)[0])
            values[at] = old
            assert abs((losses[0] - losses[1]) / 2e-3 - got[at]) < 2e-4, name


def test_windows_cover_the_text():
    for n in (0, 1, 31, 32, 33, 48, 49, 100, 1000):
        rows = toxicity.windows_of(np.arange(n))
        assert set(rows.ravel().tolist()) - {-1} == set(range(n)) and rows.shape[1] == toxicity.WINDOW
        if n > 32:
            assert rows[1][0] == toxicity.STRIDE


@pytest.fixture(scope="module")
def trained(spark):
    pick = random.Random(3)
    rows = []
    for i in range(500):
        words = [f"{pick.choice(('ba', 'lo', 'mi'))}{pick.choice(('ren', 'tus', 'kal'))}{pick.randrange(40)}" for _ in range(pick.randrange(5, 200))]
        bad = i % 4 == 0
        for _ in range(4 if bad else 0):
            words.insert(pick.randrange(len(words) + 1), pick.choice(("Vileword!", "zogrub", "xarth" + pick.choice("abcdefgh") * 3)))
        rows.append((i, " ".join(words), int(bad)))
    docs = spark.createDataFrame([(i, t, 0) for i, t, _ in rows], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, b) for i, _, b in rows] + [(None, 1), (9, None)], "doc_id long, toxic int")
    net = toxicity.fit(docs, labels.where(crc32_of(F.col("doc_id")) % 3 != 1))
    return docs, {i: b for i, _, b in rows}, net


def test_toxicity_of_held_out_documents(trained):
    docs, truth, net = trained
    found = [r for r in toxicity.toxicity(docs, net).collect() if brute.held_out(r["doc_id"], 3, 1)]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in found]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)


def test_odd_texts_have_a_score(spark, trained):
    _, _, net = trained
    rows = [(1, None), (2, ""), (3, "... 12"), (4, "ba " * 50_000 + "zogrub vileword zogrub"), (None, "lotus"), (2, "")]
    found = {r["doc_id"]: r["score"] for r in toxicity.toxicity(spark.createDataFrame(rows, "doc_id long, text string"), net).collect()}
    assert found[1] == found[2] < 0.7 > found[3] and found[4] > 0.7 > found[None]


def test_every_character_is_read():
    pick = random.Random(1)
    for n in (1, 3, 16, 17, 26, 27, 40, 500):
        token = "".join(chr(0x4E00 + pick.randrange(3000)) for _ in range(n))
        pieces = toxicity.tokens_of(f"  {token}\n")
        covered = [token.index(p) + k for p in pieces for k in range(len(p))]
        assert set(covered) == set(range(n)) and max(map(len, pieces)) <= toxicity.PIECE
    assert toxicity.tokens_of("Sh*t 1d10t!") == ["sh*t", "1d10t!"] and toxicity.word_of("1d10t!") == "d10t"
    assert {"^sh*", "h*t$", "sh*t"} <= set(toxicity.grams("sh*t")) and max(len(toxicity.grams("x" * 16)) for _ in "x") == toxicity.GRAMS


def test_sequences_are_found_for_many_tokens_at_once(monkeypatch):
    """Without a loop over the sequences of each token, and as a plain look-up of grams() finds them."""
    pick = random.Random(6)
    tokens = ["".join(pick.choice("ab*1\x00^$\u6bd2\U0001f600") for _ in range(pick.randrange(1, toxicity.PIECE + 1))) for _ in range(3000)]
    known = sorted({g for t in tokens[::2] for g in toxicity.grams(t)} | {"^ab", "b$"})
    pick.shuffle(known)
    net = toxicity.Network({}, {g: i for i, g in enumerate(known[: len(known) // 2], 1)}, {})
    wanted = [[net.grams[g] for g in toxicity.grams(t) if g in net.grams] for t in tokens]
    monkeypatch.setattr(toxicity, "grams", None)
    for some in (tokens, tokens[:1], []):
        _, rows = toxicity._inputs(net, some)
        assert rows.tolist() == [w + [0] * (toxicity.GRAMS - len(w)) for w in wanted[: len(some)]]


def test_signs_and_phrases_without_spaces_move_the_score():
    """Toxic words that are only known with signs in them, and ones glued into a long run."""
    pick, texts, labels = random.Random(4), [], []
    for i in range(400):
        bad = i % 3 == 0
        words = ["".join(pick.choice("abdelmnorstu") for _ in range(pick.randrange(3, 9))) for _ in range(60)]
        glued = "".join(chr(0x4E00 + pick.randrange(300)) for _ in range(30))
        if bad and i % 2:
            words[pick.randrange(60)] = "z*g" + pick.choice("rqx") + "#b"
        elif bad:
            glued = glued[:15] + "\u6bd2\u8bdd\u6bd2\u8bdd" + glued[15:]
        texts.append(" ".join(words + [glued]))
        labels.append(int(bad))
    scorer = toxicity.Scorer(toxicity.train(texts, labels))
    clean = "tale morn sode lune " * 10
    run = "".join(chr(0x4E00 + i) for i in range(40, 70))
    base, signs, plain, glued, unglued = scorer.scores([clean, clean + "z*gr#b", clean + "zgrb", clean + run[:11] + "\u6bd2\u8bdd\u6bd2\u8bdd" + run[11:], clean + run])
    assert signs > 0.7 > base and glued > 0.7 > unglued and plain < signs


def test_no_labels_no_network(spark, trained):
    docs, _, _ = trained
    for labels in (spark.createDataFrame([], "doc_id long, toxic int"), spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")):
        assert toxicity.fit(docs, labels) is None
    assert {r["score"] for r in toxicity.toxicity(docs.limit(5), None).collect()} == {0.0}
    assert toxicity.toxicity(docs.limit(0), None).collect() == []
