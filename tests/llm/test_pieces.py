"""Pieces with seeded merge dropout against the library and brute force."""

import re

import numpy as np
import pytest

from aerolith.llm import pieces
from aerolith.llm.queries import PIECE_BPE

from .test_operators import frame, texts  # noqa: F401

def brute_dropout(sp, codec, doc, text):
    """All pairs of a word are looked at anew for each merge."""
    units = re.findall("\n|▁+[^▁\n]*|[^▁\n]+", "▁" + text.replace("▁", "\udc81").replace(" ", "▁")) if text else []
    keys = codec.keys_of(np.full(len(units), doc), np.arange(len(units))).tolist()
    score = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    ids = []
    for unit, key in zip(units, keys):
        parts, gone = [(c, i, i + 1) for i, c in enumerate(unit)], set()
        while True:
            found = [(-score[a[0] + b[0]], x, (a[1], b[1], b[2])) for x, (a, b) in enumerate(zip(parts, parts[1:])) if a[0] + b[0] in score and (a[1], b[1], b[2]) not in gone]
            if not found:
                break
            _, x, place = min(found)
            if codec.skips(np.array([key], np.uint64), *(np.array([p]) for p in place))[0]:
                gone.add(place)
            else:
                parts[x : x + 2] = [(parts[x][0] + parts[x + 1][0], place[0], place[2])]
        for p, _, _ in parts:
            ids += [sp.piece_to_id(p)] if p in score else [sp.piece_to_id(f"<0x{b:02X}>") for b in p.replace("\udc81", "▁").encode()]
    return ids


def test_pieces(spark, texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    plain = pieces.PieceCodec(PIECE_BPE, 0.0)
    odd = [" ", "\n", " \n a", "a\n\nb  c", "😀 hi\tthere", "\r\n z ", "ab" * 400, "日本語" * 200]
    for t in [*texts, *odd]:
        if t and "▁" not in t:
            assert plain.encode(0, t).tolist() == sp.encode(t)
    got = pieces.encoded(frame(spark, [*texts, *odd]), PIECE_BPE, rate=0.3, keep_ids=True).collect()
    assert len(got) == len(texts) + len(odd) and all(r.lossless for r in got)
    by = {r.doc_id: r.ids for r in got}
    assert by[0] == [] and by[1] == [] and len(by[5]) > len(plain.encode(0, texts[5]))
    again = pieces.encoded(frame(spark, [*texts, *odd]), PIECE_BPE, rate=0.3, keep_ids=True).collect()
    other = pieces.encoded(frame(spark, [*texts, *odd]), PIECE_BPE, rate=0.3, seed=2, keep_ids=True).collect()
    assert {r.doc_id: r.ids for r in again} == by != {r.doc_id: r.ids for r in other}
    codec = pieces.PieceCodec(PIECE_BPE, 0.3)
    assert all(by[i] == codec.encode(i, t or "").tolist() and by[i] == brute_dropout(sp, codec, i, t or "") for i, t in enumerate([*texts[:12], "x"]) if i < 12)
    assert pieces.encoded(frame(spark, texts).limit(0), PIECE_BPE).count() == 0
    unnamed = pieces.encoded(frame(spark, [texts[5], texts[5]], [None, 0]), PIECE_BPE, keep_ids=True).collect()
    assert unnamed[0].ids == unnamed[1].ids and {r.doc_id for r in unnamed} == {None, 0}


@pytest.mark.parametrize("rate", [0.1, 0.5, 1.0])
def test_dropout_equals_brute_force(rate, texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    codec, plain = pieces.PieceCodec(PIECE_BPE, rate), pieces.PieceCodec(PIECE_BPE, 0.0)
    odd = ["  a  b", "\n\nx \n y", "日本語" * 40, "é" * 90, "x" * 120, "\x1f▁ a▁b", "😀 hi\tthere", "\r\n z ", " ", "\n", "internationalisation " * 3]
    for doc, t in enumerate([*odd, *[x for x in texts if x and len(x) < 900][:10]]):
        ids = codec.encode(doc, t)
        assert ids.tolist() == brute_dropout(sp, codec, doc, t) and codec.decode(ids) == t
    ids = codec.encode(9, "international house " * 300)
    assert len(ids) > len(plain.encode(9, "international house " * 300))
    kinds = {tuple(ids[a:b].tolist()) for a, b in zip(range(0, len(ids)), range(4, len(ids)))}
    assert rate == 1 or len(kinds) > 20
