from __future__ import annotations

import public_tokenizers
import pytest
import tiktoken
from hypothesis import HealthCheck, given, settings, strategies as st

from ledgerline.llm.byte_bpe import PerfectHash, decode_ids, encode_texts, encoder, load_ranks

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def theirs():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=load_ranks(PATH), special_tokens={})


def ours(text: str) -> list[int]:
    import numpy as np

    return np.frombuffer(encoder(PATH, PATTERN).encode(text), np.int32).tolist()


def test_every_character_in_every_place(theirs):
    """All code points, where it shows whether they are letters, numbers, blanks or none of these."""
    for chunk in range(0, 0x110000, 4096):
        chars = [chr(c) for c in range(chunk, chunk + 4096) if not 0xD800 <= c < 0xE000]
        for text in ("".join(f"{c}'s" for c in chars), "".join(f"a{c}b1{c}2 {c}" for c in chars)):
            assert ours(text) == theirs.encode_ordinary(text)


@pytest.mark.parametrize("char", ["\u0558", "\u058b", "\u088f", "\U0003d000"])
def test_characters_of_a_later_unicode(theirs, char):
    for text in (f"{char}'s", f"word {char} word", f"{char}1 a{char}b {char}{char}\n\n{char} x"):
        assert ours(text) == theirs.encode_ordinary(text)


def test_perfect_hash_is_minimal():
    keys = [f"k{n}".encode() for n in range(5_000)]
    table = PerfectHash(keys)
    assert sorted(table.find(k) for k in keys) == list(range(5_000))
    assert table.find(b"other") == -1 and PerfectHash([]).find(b"a") == -1


PIECES = st.sampled_from(
    [" ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\r\n", "\x1c", "\x85", " ", "　", "'s", "'ll", "word",
     " Wörter", "123", "...", "日本語", "\U0001f600", "é", "<|endoftext|>", "a" * 40, "'", "\\"]
)


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(parts=st.lists(st.one_of(PIECES, st.text(max_size=6)), max_size=12))
def test_ids_are_the_library_s(theirs, parts):
    text = "".join(parts)
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    assert ours(text) == theirs.encode_ordinary(text)


@pytest.mark.parametrize("text", ["hello \rworld", "hello \rworld world", "\rworld \rworld", "a\n\rb", "a \r b\r", "world \r\rworld"])
def test_carriage_returns_stay(theirs, text):
    encoder.cache_clear()
    for _ in range(2):
        assert ours(text) == theirs.encode_ordinary(text)
        assert ours("world hello") == theirs.encode_ordinary("world hello")


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(parts=st.lists(st.sampled_from([" \r", "\r", "\rword", " ", "\n", "word", "\r\n", " word", "\t"]), max_size=10))
def test_ids_beside_carriage_returns(theirs, parts):
    assert ours("".join(parts)) == theirs.encode_ordinary("".join(parts))


def test_caches_do_not_change_ids(theirs, monkeypatch, sf_rows):
    monkeypatch.setattr("ledgerline.llm.byte_bpe.WORDS", 50)
    monkeypatch.setattr("ledgerline.llm.byte_bpe.PIECES", 50)
    encoder.cache_clear()
    assert all(ours(t) == theirs.encode_ordinary(t) for _, t in sf_rows[:40])
    encoder.cache_clear()


def test_table(edge_docs, edge_rows, no_docs, theirs):
    coded = encode_texts(edge_docs, PATH, PATTERN)
    out = decode_ids(coded, PATH).select("doc_id", "text", "ids", "decoded").collect()
    assert len(out) == len(edge_rows)
    for row in out:
        assert row.ids == theirs.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()
    both = encode_texts(edge_docs, PATH, PATTERN, decoded_column="decoded").select("text", "ids", "decoded").collect()
    assert sorted((r.text or "", r.ids, bytes(r.decoded)) for r in both) == sorted(
        (r.text or "", r.ids, bytes(r.decoded)) for r in out
    )
    assert decode_ids(encode_texts(no_docs, PATH, PATTERN), PATH).count() == 0


def test_null_ids_decode_to_nothing(spark):
    df = spark.createDataFrame([(None,), ([],), ([0, 1],)], "ids array<int>").coalesce(1)
    got = [bytes(r.decoded) for r in decode_ids(df, PATH).collect()]
    by_id = {v: k for k, v in load_ranks(PATH).items()}
    assert got == [b"", b"", by_id[0] + by_id[1]]
