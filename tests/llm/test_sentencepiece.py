import random

import numpy as np
import pytest
import sentencepiece
from farebox.llm.queries import QUERIES, piece_model_path
from farebox.llm.sentencepiece_bpe import PieceEncoder, PieceModel, encode_documents, read_model, utf8


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model_path())


@pytest.fixture(scope="module")
def encoder(spark):
    return PieceEncoder(PieceModel(read_model(spark, piece_model_path())), remembered=5000)


def texts(encoder):
    draw = random.Random(5)
    letters = "ab  \n▁éthe0019日本𝒳\x00\t<s>.,_²"
    pieces = [p.replace("▁", " ") for p in encoder.model.ids]
    yield from ("", " ", "  ", "▁", "a" * 3000, " " * 700, "ab" * 900, "ing" * 300 + "\n" * 40, "<s>x</s><unk>", "word.,_.²,")
    for _ in range(1500):
        yield "".join(draw.choice(letters) for _ in range(draw.randrange(60)))
        yield "".join(draw.choice(pieces) for _ in range(draw.randrange(20)))


def test_ids_and_text_equal_the_library(encoder, library):
    for text in texts(encoder):
        ids = library.encode(text, add_bos=True, add_eos=True)
        packed = encoder.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == ids, repr(text)
        assert encoder.decode(packed) == library.decode(ids), repr(text)


def test_whole_text_needs_no_cuts(encoder, library, spark):
    plain = PieceEncoder(encoder.model)
    plain.cut = lambda text: [text]
    for text in list(texts(encoder))[:600]:
        assert plain.encode(text) == encoder.encode(text)


def test_decoding_of_any_ids_equals_the_library(encoder, library):
    draw = random.Random(6)
    for _ in range(500):
        ids = [draw.choice((draw.randrange(3, 259), draw.randrange(3, 32000), 0, 1, 2)) for _ in range(draw.randrange(12))]
        assert encoder.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids), ids
    assert utf8(b"\xe6\x97a\xff") == "��a�"


def test_documents(spark, odd, no_documents, library):
    rows = encode_documents(odd, piece_model_path(), keep=("doc_id", "ids", "n")).collect()
    assert len(rows) == odd.count()
    want = sorted((x.doc_id or 0, np.array(library.encode(x.text or "", add_bos=True, add_eos=True), "<u4").tobytes()) for x in odd.collect())
    assert sorted((x.doc_id or 0, bytes(x.ids)) for x in rows) == want
    assert all(x.decoded == library.decode(np.frombuffer(x.ids, "<u4").tolist()) for x in rows)
    assert encode_documents(no_documents, piece_model_path()).collect() == []


def test_query_digests(spark, data, library):
    import hashlib

    texts = {x.doc_id: x.text for x in spark.read.parquet(f"{data}/documents.parquet").collect()}
    for x in QUERIES["op1_sentencepiece"](spark, data).collect():
        ids = library.encode(texts[x.doc_id] or "", add_bos=True, add_eos=True)
        assert x.n_tokens == len(ids)
        assert x.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert x.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
