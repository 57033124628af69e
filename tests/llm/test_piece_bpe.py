"""Pieces against the library that defines them: every text, every id, odd rows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from ledgerloom.llm import queries
from ledgerloom.llm.piece_bpe import Decoder, Encoder, PieceModel, decode_documents, encode_documents

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return PieceModel.load(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids_of(encoder: Encoder, text: str) -> list[int]:
    return np.frombuffer(encoder.encode(text), dtype=np.int32).tolist()


def test_model_file_is_read_as_the_library_reads_it(model, library):
    assert len(model.pieces) == library.vocab_size()
    assert all(model.pieces[i] == library.id_to_piece(i) for i in range(len(model.pieces)))
    assert all(model.scores[i] == library.get_score(i) for i in range(len(model.pieces)))


def test_other_models_are_refused(tmp_path):
    with open(PATH, "rb") as file:
        data = bytearray(file.read())
    at = data.rindex(b"\x18\x01 \x00")  # the last message: text is changed before it is encoded
    data[at + 3] = 1
    (tmp_path / "other.model").write_bytes(bytes(data))
    with pytest.raises(ValueError, match="text as it is"):
        PieceModel.load(str(tmp_path / "other.model"))


def texts(model, rng: random.Random, n: int):
    odd = [" ", "  ", "\t", "\n", "▁", "a", "the", "ing", "é", "日", "語", "😀", "\0", "<s>", "<0x41>", "1", "'", "Ω", "ж", "́", "==", "aaaa", "�", "\xa0"]
    for k in range(n):
        size = rng.randrange(1, 40)
        if k % 4 == 0:
            yield "".join(rng.choice(odd) for _ in range(size))
        elif k % 4 == 1:
            yield "".join(rng.choice(" ab▁") for _ in range(size))
        elif k % 4 == 2:
            yield "".join(model.pieces[rng.randrange(259, 32000)] for _ in range(size // 2)).replace("▁", " ")
        else:
            letters = "".join(rng.choice("  abcdefghijklmnopqrstuvwxyz") for _ in range(size))
            yield " " * rng.randrange(70) + letters + " " * rng.randrange(40)


def test_encoding_is_the_librarys(model, library):
    encoder, decoder = Encoder(model), Decoder(model)
    for text in texts(model, random.Random(11), 4000):
        ids = library.encode(text)
        assert ids_of(encoder, text) == ids, text
        assert decoder.decode(ids) == library.decode(ids), text


def test_every_piece_is_its_own_encoding_or_the_librarys(model, library):
    encoder = Encoder(model)
    for piece in model.pieces[259:]:
        text = piece.replace("▁", " ")
        assert ids_of(encoder, text) == library.encode(text)


def test_long_texts_without_blanks(model, library):
    encoder = Encoder(model)
    for text in ("ab" * 50_000, "日本語" * 20_000, "a" * 65_537, " " * 9_999, "\n" * 5_000, "x" + " y" * 30_000):
        assert ids_of(encoder, text) == library.encode(text)


def test_decoding_any_ids_is_the_librarys(model, library):
    decoder, rng = Decoder(model), random.Random(12)
    assert decoder.decode([]) == ""
    for k in range(6000):
        size = rng.randrange(12)
        if k % 3:
            ids = [rng.randrange(259) if rng.random() < 0.7 else rng.randrange(32000) for _ in range(size)]
        else:
            ids = [rng.choice([0, 1, 2, 3 + 32, 28705, 259, 260, 3 + 0xE2, 3 + 0x96, 3 + 0x81]) for _ in range(size)]
        assert decoder.decode(ids) == library.decode(ids), ids
    with pytest.raises(ValueError, match="outside"):
        decoder.decode([32000])


def test_kept_units_and_pairs_are_bounded(model, monkeypatch, library):
    monkeypatch.setattr("ledgerloom.llm.piece_bpe.KEPT_UNITS", 8)
    monkeypatch.setattr("ledgerloom.llm.piece_bpe.KEPT_PAIRS", 5)
    encoder = Encoder(model)
    for text in texts(model, random.Random(13), 200):
        assert ids_of(encoder, text) == library.encode(text)
        assert len(encoder.kept) + len(encoder.kept.older) <= 8 and sum(map(len, encoder.pairs.values())) <= 5


ODD = [
    (1, "plain words and 123", "x"), (1, "plain words and 123", "x"), (2, None, None), (3, "", "y"), (None, "no id  ", "z"),
    (None, None, None), (4, " \t\n ", "x"), (5, "long " * 30_000, "x"), (6, "▁ é 日本 😀\0", "x"),
]


def test_operators_on_odd_rows(spark, library):
    docs = spark.createDataFrame(ODD, "doc_id bigint, text string, ids string").repartition(3)
    got = decode_documents(encode_documents(docs, PATH), PATH)
    assert got.columns == ["doc_id", "text", "ids", "decoded"]
    rows = got.collect()
    assert len(rows) == len(ODD)
    for row in rows:
        assert row["ids"] == library.encode(row["text"] or "")
        assert row["decoded"] == library.decode(row["ids"])
    replaced = encode_documents(docs.select("doc_id", "text"), PATH, out="text")
    assert dict(replaced.dtypes) == {"doc_id": "bigint", "text": "array<int>"}
    assert sorted(r["text"] for r in replaced.collect()) == sorted(r["ids"] for r in rows)
    none = spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>")
    assert decode_documents(none, PATH).collect()[0]["decoded"] is None
    assert encode_documents(docs.limit(0), PATH).collect() == []


def test_query_is_the_librarys_work(spark, library, tmp_path):
    docs = spark.createDataFrame(ODD, "doc_id bigint, text string, ids string")
    docs.selectExpr("*", "1 AS n_tokens", "2 AS decoded").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_piece_codec(spark, str(tmp_path))
    want = []
    for doc_id, text, _ in ODD:
        ids = library.encode(text or "")
        digest = [",".join(map(str, ids)), library.decode(ids)]
        want.append((doc_id, len(ids), *[hashlib.sha256(x.encode()).hexdigest() for x in digest]))
    assert got.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
