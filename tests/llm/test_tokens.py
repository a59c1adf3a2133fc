"""Token counts and byte-level BPE against the libraries whose files they read."""

import hashlib
import random

import brute
import public_tokenizers
import pytest

from tidemark.llm import byte_bpe
from tidemark.llm.chunks import by_bytes, chunks_of
from tidemark.llm.token_counts import Lengths, token_counts

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = [
    "", " ", "\n", "  a  b ", "don't  we'll 'S x's", "a\u00a0b \u2003c\u3000d", "x\x1c \x1dy!\x1c", "tab\t\tnew\r\n\r\nline ",
    "naïve Ünïcode ß 日本語 текст 🙂🙂 e\u0301", "1234567890 ²³ Ⅷ x9", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>c", "a" * 5000,
    "ab1" * 4000, "\u0301" * 300, " " * 3000 + "x", "www.mail6.example.com/?q=1&&%%$$##", "A!! B!! C!!", "\ufffd\u0000z",
]


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(4)
    letters = "abcXYZ éß日'0123 \n\t .,!?<|>\x1c\x85\u00a0\u2028²🙂"
    return ODD + ["".join(pick.choice(letters) for _ in range(pick.randrange(200))) for _ in range(300)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, -1, "x") for i, t in enumerate(texts)] + [(None, "no id", -1, "x"), (7000, None, -1, None), (3, texts[3], -1, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, token_ids string").repartition(3)


def test_chunks_make_up_the_text(texts):
    assert all("".join(chunks_of(t)) == t for t in texts)


def test_balanced_batches():
    assert list(by_bytes([5, 5, 50, 1, 1], 10)) == [(0, 2), (2, 3), (3, 5)]
    assert list(by_bytes([], 10)) == []


def test_lengths_are_those_of_the_library(texts):
    assert Lengths(JSON, 4000).of(texts) == brute.library_counts(texts)


def test_lengths_of_a_sentence_piece_model():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    assert Lengths(path, 4000).of(["Hello  there", "", "naïve"]) == [len(model.encode(t)) for t in ("Hello  there", "", "naïve")]


def test_token_counts(spark, docs, texts):
    found = token_counts(docs, JSON)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens"]
    rows = found.collect()
    assert len(rows) == len(texts) + 3
    by_id = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in rows}
    wanted = brute.library_counts(texts)
    assert all(by_id[i] == (len(t.encode()), n) for i, (t, n) in enumerate(zip(texts, wanted)))
    assert by_id[7000] == (0, 0) and by_id[None] == (5, 2)
    assert token_counts(docs.limit(0), JSON).collect() == []


def test_merges_by_tree_are_those_of_the_library(texts):
    coder = byte_bpe.Codec(RANKS, public_tokenizers.PATTERN)
    assert [ids.tolist() for ids in coder.encode(texts)] == brute.library_ids(texts)
    assert all(coder.decode(ids) == t.encode() for ids, t in zip(coder.encode(texts), texts))


def test_both_trees_merge_alike():
    ranks, pick = byte_bpe.Ranks(RANKS), random.Random(2)
    pieces = [bytes(pick.choice(b"theand ing\xc3\xa9!") for _ in range(pick.randrange(1, 60))) for _ in range(300)]
    assert byte_bpe.merge_short(ranks, pieces) == [byte_bpe.merge_long(ranks, p) for p in pieces]


def test_what_is_forgotten_is_learned_again(monkeypatch, texts):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 10)
    coder = byte_bpe.Codec(RANKS, public_tokenizers.PATTERN)
    found = [coder.encode([t])[0].tolist() for t in texts[:60] + texts[:20]]
    assert found == brute.library_ids(texts[:60] + texts[:20])


def test_encode_and_decode(spark, docs, texts):
    coded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, decoded=True)
    assert coded.columns == ["doc_id", "n_tokens", "token_ids", "decoded"]  # the clashing column gives way
    rows = {r["doc_id"]: r for r in coded.collect()}
    assert all(bytes(rows[i]["decoded"]) == t.encode() for i, t in enumerate(texts))
    assert rows[7000]["token_ids"] == [] and rows[0]["token_ids"] == []
    back = byte_bpe.decode(coded.drop("decoded"), RANKS, public_tokenizers.PATTERN).where("doc_id is not null")
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {**dict(enumerate(texts)), 7000: ""}
    assert byte_bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


def test_digest_of_a_query(spark, tmp_path, texts):
    from tidemark.llm.queries import op9_byte_bpe

    spark.createDataFrame(list(enumerate(texts[:40])), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in op9_byte_bpe(spark, str(tmp_path)).collect()}
    for i, (text, ids) in enumerate(zip(texts[:40], brute.library_ids(texts[:40]))):
        assert rows[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest() and rows[i]["n_tokens"] == len(ids)
