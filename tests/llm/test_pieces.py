"""The SentencePiece operator against the library, and its spans against the text."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from ordermill.llm.pieces import Normaliser, Pieces, _fields
from ordermill.llm.sentencepieces import MODEL, encode_documents, op3_sentencepiece
from ordermill.llm.token_counts import count_tokens, op8_token_counts

PATH = public_tokenizers.path(MODEL)
SF_DIR = "/root/testdata/sf0.001"
HARD = [
    "", " ", "  ", "a ", " a", "a  b", "▁", "x▁ y", "a▁b", "<s> </s> <unk> <0x0A>", "\x00ab\x00", "😀 z",
    "a\n\nb \n c", "\ttab", "é ﬁ Ａ　①", "y" * 5000, "ab " * 3000, "á é",
]


@pytest.fixture(scope="module")
def tool():
    return Pieces(PATH)


@pytest.mark.parametrize("text", HARD)
def test_ids_are_the_librarys(tool, text):
    assert np.frombuffer(tool.encode(text), "<u4").tolist() == tool.library.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab é\n\t▁<s>😀.,　1"), max_size=60))
def test_ids_of_any_text(text):
    tool = Pieces(PATH) if not hasattr(test_ids_of_any_text, "tool") else test_ids_of_any_text.tool
    test_ids_of_any_text.tool = tool
    ids = np.frombuffer(tool.encode(text), "<u4")
    assert ids.tolist() == tool.library.encode(text)
    starts, ends = tool.spans(text, ids)
    data = text.encode()
    assert b"".join(data[a:b] for a, b in zip(starts, ends)) == data


def test_span_of_a_piece_is_what_it_stands_for(tool):
    text = "Hello  wörld\n!"
    ids = np.frombuffer(tool.encode(text), "<u4")
    starts, ends = tool.spans(text, ids)
    for piece, a, b in zip(ids.tolist(), starts, ends):
        source = text.encode()[a:b]
        name = tool.library.id_to_piece(piece)
        if tool.library.is_byte(piece):
            assert source == bytes([int(name[3:5], 16)])
        else:
            # the first piece also has the mark that no character stands for
            assert source == name.replace("▁", " ").encode() or a == 0 and source == name[1:].replace("▁", " ").encode()


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf"])
def test_compiled_map_is_walked_like_the_library_does(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec = next(value for number, value in _fields(library.serialized_model_proto()) if number == 3)
    normaliser = Normaliser(spec)
    normaliser.add_dummy_prefix = normaliser.escape_whitespaces = normaliser.remove_extra_whitespaces = True
    for text in [*HARD, "ﬁ Ａ　①  é é ㍿ ​ x ", "ｶﾞ ﾊﾟ", "①②③", "Ⅷ ½", "ÀÉ İ"]:
        got, origin = normaliser(text.encode())
        expected, places = library.normalize(text, with_offsets=True)
        assert got.decode() == expected
        # the library counts characters, this one bytes
        lead = [i for i, byte in enumerate(got) if byte & 0xC0 != 0x80]
        assert [len(text.encode()[: origin[i]].decode()) for i in lead] == list(places[: len(lead)])


def test_longest_prefix_wins():
    library = sentencepiece.SentencePieceNormalizer(rule_name="nfkc")
    normaliser = Normaliser(next(value for number, value in _fields(library.serialized_model_proto()) if number == 3))
    data = "ẹ́x".encode()
    size, new = normaliser.longest_prefix(data, 0)
    assert size > 1 and len(new) > 0
    assert normaliser.longest_prefix(b"x", 0) == (0, b"")


def test_query_against_the_library(spark, tool):
    docs = {row.doc_id: row.text or "" for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = {row.doc_id: row for row in op3_sentencepiece(spark, SF_DIR).collect()}
    assert set(rows) == set(docs)
    for doc_id, text in docs.items():
        ids = [1, *tool.library.encode(text), 2]
        assert rows[doc_id].n_tokens == len(ids)
        assert rows[doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[doc_id].decoded_sha256 == hashlib.sha256(tool.library.decode(ids).encode()).hexdigest()


def test_token_counts_against_the_library(spark, tool):
    docs = {row.doc_id: row.text or "" for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for row in op8_token_counts(spark, SF_DIR).collect():
        text = docs.pop(row.doc_id)
        n = len(tool.library.encode(text))
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 4096)
    assert not docs


def test_odd_rows(spark, tool):
    rows = [(1, None, "x"), (None, "", "y"), (1, None, "x"), (2, " two  spaces ", "z"), (2, "\n", None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, ids string")
    encoded = encode_documents(docs, PATH).collect()
    assert len(encoded) == 5
    assert sorted((row.doc_id or 0, row.decoded) for row in encoded) == [(0, ""), (1, ""), (1, ""), (2, "\n"), (2, " two  spaces ")]
    counted = sorted((row.doc_id or 0, row.n_bytes, row.n_tokens) for row in count_tokens(docs, PATH).collect())
    assert counted == sorted((d or 0, len(t or ""), len(tool.library.encode(t or ""))) for d, t, _ in rows)
    assert encode_documents(docs.limit(0), PATH).count() == 0
    assert count_tokens(docs.limit(0), PATH).count() == 0


def test_small_table_changes_no_count(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    full = sorted(map(tuple, count_tokens(docs, PATH).collect()))
    assert full == sorted(map(tuple, count_tokens(docs, PATH, frequent=3).collect()))


def test_token_counts_of_a_very_long_text(spark, tool):
    text = " ".join(f"word{i % 7919} é<s>" for i in range(150_000)) + "x" * 20_000
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    counted = {row.doc_id: (row.n_bytes, row.n_tokens) for row in count_tokens(docs, PATH).collect()}
    assert counted == {i: (len(t.encode()), len(tool.library.encode(t))) for i, t in ((1, text), (2, "short"))}
