import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import ODD, SF, documents, read
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.mark.parametrize("plane_bits", [1, 8])
@pytest.mark.parametrize("ids", [[], [0], [0] * 100, [1, 2, 3], [2**32 - 1, 0], list(range(70_000))])
def test_blocks_round_trip(ids, plane_bits):
    block = token_files.encode_block(np.array(ids, dtype=np.uint32), plane_bits)
    assert token_files.decode_block(block).tolist() == ids


def test_bad_blocks_are_refused():
    with pytest.raises(ValueError):
        token_files.decode_block(b"XXXX" + token_files.encode_block(np.array([1]))[4:])
    with pytest.raises(ValueError):
        token_files.encode_block(np.array([1]), 3)


@given(st.binary(max_size=200), st.binary(max_size=200))
def test_checksums_join(a, b):
    assert token_files.join_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def expected(text) -> list[int]:
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


ENCODER = token_files.Encoder(PATH)


@settings(max_examples=400, deadline=None)
@given(
    st.one_of(
        st.text(max_size=60),
        st.text(alphabet="abzAZ09'stredvml .,!?<|>\n\t\r\x0b\x0c\x1c\x85\xa0éÉßÿÿµªº×÷´΅ İΣσ日", max_size=60),
    )
)
def test_words_are_encoded_as_whole_texts_are(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ENCODER.by_chunk
    assert ENCODER.encode(text).tolist() == expected(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abzA09'sé .,<|>\n\t\x0b\xa0İΣ日", max_size=40)), max_size=8))
def test_many_texts_are_encoded_like_each(texts):
    for kind in (pa.string(), pa.large_string()):
        ids, counts = ENCODER.encode_all(pa.array([None, *texts], kind).slice(1))
        wanted = [expected(t) for t in texts]
        assert counts.tolist() == [len(w) for w in wanted]
        assert ids.tolist() == [i for w in wanted for i in w]


def test_slices_cover_all_texts(monkeypatch):
    monkeypatch.setattr(token_files, "SLICE_BYTES", 10)
    for texts in ([], ["a"], [None] * 5, ["x" * 35, "", "b", None, "yy" * 9, "c"]):
        array = pa.array(texts, pa.string())
        found = list(token_files._slices(array))
        assert [t for _, some in found for t in some.to_pylist()] == texts
        assert [at for at, _ in found] == np.cumsum([0] + [len(s) for _, s in found]).tolist()[:-1]


def test_long_words_are_not_remembered():
    word = "abcdefg0" * 50_000
    assert ENCODER.encode(word + " " + word).tolist() == expected(word + " " + word)
    assert word not in ENCODER.chunks


def test_corpus_words_are_encoded_alike():
    for text in read("documents").text[:150]:
        assert ENCODER.encode(text).tolist() == expected(text)
    assert ENCODER.encode("a <|endoftext|> b").tolist() == expected("a <|endoftext|> b")


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(token_files, "MEMO", 5)
    small = token_files.Encoder(PATH)
    for text in read("documents").text[:10]:
        assert small.encode(text).tolist() == expected(text)
        assert all(len(m) <= 5 and len(m.old) <= 5 for m in (small.chunks, small.pieces))


def check(rows, texts):
    """``rows`` as read; ``texts``: (doc_id, text) in ascending order."""
    start = 0
    rows = sorted(rows, key=lambda r: r.start)
    assert len(rows) == len(texts)
    for r, (doc_id, text) in zip(rows, texts):
        ids = np.array([*expected(text), 2], dtype="<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@pytest.mark.parametrize("block_ids, plane_bits", [(1 << 16, 8), (100, 1)])
def test_documents(spark, tmp_path, block_ids, plane_bits):
    path = str(tmp_path / "ids")
    df = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 300")
    token_files.write_token_files(df, path, PATH, 2, parts=3, block_ids=block_ids, plane_bits=plane_bits)
    docs = read("documents").query("doc_id < 300").sort_values("doc_id")
    check(token_files.read_documents(spark, path, block_ids).collect(), list(zip(docs.doc_id.tolist(), docs.text)))


def test_odd_rows(spark, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_token_files(documents(spark, ODD, clashing=True), path, PATH, 2, block_ids=50)
    order = sorted(((r[0], r[1]) for r in ODD), key=lambda r: (r[0] is not None, r[0] or 0))
    check(token_files.read_documents(spark, path, 50).collect(), order)
    empty = str(tmp_path / "none")
    token_files.write_token_files(documents(spark, []), empty, PATH, 2)
    assert token_files.read_documents(spark, empty).collect() == []
