from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from clickmetrics.llm import pieces
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = pieces.PieceModel.from_file(PATH)
LIBRARY = SentencePieceProcessor(model_file=PATH)
LETTERS = "aaabeeiinnorst  ▁▁\n\t\r.0123é漢字🙂<>sx\x00​　́"


def expected(text):
    ids = LIBRARY.encode(text, add_bos=True, add_eos=True)
    return ids, LIBRARY.decode(ids)


def agree(text):
    codec = pieces.codec_of(MODEL)
    (packed,) = codec.encode([text])
    assert (np.frombuffer(packed, dtype="<u4").tolist(), codec.decode(packed)) == expected(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=LETTERS, max_size=40))
def test_mixed_letters(text):
    agree(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    agree(text)


@pytest.mark.parametrize(
    "text",
    [
        "", " ", "  \n", "▁", "<s>", "</s><unk>", "<0x41>", " " * 1000, "aaaa" * 25_000, "hahaha" * 20,
        "漢字" * 5_000, "tokenization of 12345 words, e.g. naïve ones", "a" + " " * 40 + "b",
    ],
)
def test_cases(text):
    agree(text)


def test_steps_and_heap_agree(monkeypatch):
    texts = [f"some words {i} and strengths{'en' * (i % 30)} of the\nsame ▁▁ kind" for i in range(60)]
    monkeypatch.setattr(pieces, "LONG_CHUNK", 5)
    monkeypatch.setattr(pieces, "CHUNKS_KEPT", 10)
    codec = pieces.PieceCodec(MODEL)
    for start in range(0, 60, 7):
        packed = codec.encode(texts[start : start + 7])
        ids = [np.frombuffer(p, dtype="<u4").tolist() for p in packed]
        assert ids == [expected(text)[0] for text in texts[start : start + 7]]


def test_a_chunk_is_segmented_once():
    codec = pieces.PieceCodec(MODEL)
    met = []
    whole = codec.segment_all
    codec.segment_all = lambda chunks: met.append(chunks) or whole(chunks)
    codec.encode(["the cat and the cat", "the dog"])
    codec.encode(["dog the and"])
    assert sorted(met[0]) == ["▁and", "▁cat", "▁dog", "▁the"]
    assert met[1:] == []


def test_ids_of_no_text_decode_as_in_the_library():
    codec = pieces.codec_of(MODEL)
    byte = {LIBRARY.piece_to_id(f"<0x{value:02X}>"): value for value in (0xE6, 0xBC, 0x41)}
    for ids in ([1, 2], [], [0, 1], [*byte], [LIBRARY.piece_to_id("▁▁"), 5], [1, 1, LIBRARY.piece_to_id("▁a")]):
        assert codec.decode(np.array(ids, dtype="<u4").tobytes()) == LIBRARY.decode(ids)


def test_models_whose_pieces_cross_blanks_are_refused():
    stored = sentencepiece_model_pb2.ModelProto.FromString(MODEL.content)
    stored.pieces[300].piece = "a▁b"
    with pytest.raises(ValueError, match="crosses"):
        pieces.PieceCodec(pieces.PieceModel(stored.SerializeToString()))
    stored = sentencepiece_model_pb2.ModelProto.FromString(MODEL.content)
    stored.trainer_spec.model_type = 1
    with pytest.raises(ValueError, match="BPE"):
        pieces.PieceCodec(pieces.PieceModel(stored.SerializeToString()))


def test_edges(documents, edge_texts):
    docs = documents([*edge_texts, "<s> x"])
    rows = pieces.piece_decode(pieces.piece_encode(docs, MODEL, into="size"), MODEL, "size", "plan")
    rows = rows.select("text", "size", "n_tokens", "plan").collect()
    assert len(rows) == len(edge_texts) + 1
    for row in rows:
        ids, text = expected(row.text or "")
        found = np.frombuffer(row.size, dtype="<u4").tolist()
        assert (found, row.plan, row.n_tokens) == (ids, text, len(ids))
    once = pieces.piece_round_trip(docs, MODEL, ids="size", decoded_text="plan")
    found = once.select("text", "size", "n_tokens", "plan").collect()
    key = lambda row: (row.text is None, row.text or "")
    assert [tuple(r) for r in sorted(found, key=key)] == [tuple(r) for r in sorted(rows, key=key)]
    assert set(once.columns) == set(docs.columns) | {"size", "n_tokens", "plan"}
    assert pieces.piece_round_trip(docs.limit(0), MODEL).count() == 0


def test_query_over_the_whole_table(spark, sf_dir):
    from clickmetrics.llm.queries import op13_pieces

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op13_pieces(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids, text = expected(texts[row.doc_id] or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
