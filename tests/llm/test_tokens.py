"""Token files against the tokenizers library, by document and by place."""

import zlib

import numpy as np
import pytest

from aerolith.llm import dac
from aerolith.llm.queries import BYTE_BPE

from .test_operators import frame, texts  # noqa: F401

def test_token_codes():
    rng = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 3000):
        for bits in (8, 16):
            ids = rng.choice([0, 1, 255, 256, 50256, 65535, 65536, 2**32 - 1], n).astype(np.uint32)
            seg = dac.Segment(dac.encode_ids(ids, bits))
            assert (seg.all() == ids).all() and len(seg) == n
            assert all(seg[i] == ids[i] for i in range(0, n, 37))


def test_token_files(spark, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BYTE_BPE)
    texts = [*texts, "a <|endoftext|> b", "<|endoftext|>", "y " + "x" * 5000 + " z"]
    path = dac.write_token_files(frame(spark, texts), BYTE_BPE, segment_ids=500, file_segments=3)
    got = {r.doc_id: r for r in dac.read_token_files(spark, path).collect()}
    start, every = 0, []
    files = dac.TokenFiles(spark, path)
    for i, t in enumerate(texts):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
        every.append(ids)
        if i % 9 == 0:
            assert [files.token(i, k) for k in (0, len(ids) // 2, len(ids) - 1)] == [ids[0], ids[len(ids) // 2], 2]
    every = np.concatenate(every)
    assert [files.at(k) for k in (0, 777, len(every) - 1)] == every[[0, 777, -1]].tolist()
    for wrong, error in ((lambda: files.token(10**6, 0), KeyError), (lambda: files.token(5, 10**6), IndexError), (lambda: files.at(len(every)), IndexError)):
        with pytest.raises(error):
            wrong()
    files.close()
    assert dac.read_token_files(spark, dac.write_token_files(frame(spark, texts).limit(0), BYTE_BPE)).count() == 0


def test_token_files_of_repeated_and_null_ids(spark, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BYTE_BPE)
    rows = [(None, "one"), (7, texts[5]), (None, "two more"), (7, texts[6]), (7, texts[5]), (-3, None)]
    runs = [sorted((r.start, r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in dac.read_token_files(spark, dac.write_token_files(frame(spark, [t for _, t in some], [i for i, _ in some]), BYTE_BPE)).collect()) for some in (rows, rows[::-1])]
    assert runs[0] == runs[1] and [(n, i) for _, n, i, _, _ in runs[0]] == [(True, 0), (True, 0), (False, -3), (False, 7), (False, 7), (False, 7)]
    want = sorted(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sorted(r[3] for r in runs[0]) == want and [r[0] for r in runs[0]] == [sum(r[3] for r in runs[0][:k]) for k in range(6)]


def test_a_token_is_read_by_its_place():
    ids = np.random.default_rng(5).choice([3, 200, 300, 50256, 70000, 2**31], 5000).astype(np.uint32)
    raw, asked = dac.encode_ids(ids, 8, [None, 4, 4, 9], [10, 20, 4000, 5000]), []

    def read(at, n):
        asked.append(n)
        return raw[at : at + n]

    seg = dac.Segment(read)
    assert seg.find(4) == [1, 2] and seg.find(5) == [] and seg.document(0) == (None, 0, 10) and seg.document(3) == (9, 4000, 5000)
    asked.clear()
    assert [seg[i] for i in range(0, 5000, 7)] == ids[::7].tolist() and max(asked) <= dac.BLOCK // 8 and sum(asked) < 4 * 715 * 69


def test_cached_encoder_equals_the_library():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BYTE_BPE)
    enc = dac.CachedEncoder(BYTE_BPE, most=5)
    odd = ["", " ", "a b", " a", "a ", "\na", "a\n", "a\nb c", "a \n b", "don't  's", "x's y's", "a\u00a0b", "a\u2003b", "日本 語", "a\x1fb", "1 22\n333 !? 'll", "tab\tb", "\u00a0 x", "a <|endoftext|> b", "<|endoftext|>", "<|endof text|>", "x" * 3000 + " y", "é " * 300]
    for _ in range(2):
        assert [x.tolist() for x in enc.encode(odd)] == [tok.encode(t, add_special_tokens=False).ids for t in odd]


def test_cached_encoder_over_all_documents(spark):
    from tokenizers import Tokenizer

    tok, enc = Tokenizer.from_file(BYTE_BPE), dac.CachedEncoder(BYTE_BPE)
    some = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    assert [x.tolist() for x in enc.encode(some)] == [tok.encode(t, add_special_tokens=False).ids for t in some]
