"""What encoding a token file costs per distinct piece and per id."""

from __future__ import annotations

import cProfile
import pstats

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from gildstar.llm import rans, token_file

PATH = public_tokenizers.path("word_bpe_49k.json")


def _texts(n: int) -> pa.Array:
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}x{'!?' * (i % 3)}" for i in range(n)]
    return pa.array([" ".join(words), "", "Don't É! a1 x<|endoftext|> ''"], pa.large_string())


def test_known_pieces_take_no_call_each():
    tokens, texts = token_file.WordTokens(PATH), _texts(5000)
    first = tokens.of_texts(texts, 2)
    profile = cProfile.Profile()
    again = profile.runcall(tokens.of_texts, texts, 2)
    assert pstats.Stats(profile).total_calls < 2000
    assert (again[0] == first[0]).all() and (again[1] == first[1]).all()


@pytest.mark.parametrize("held", [1, 300, 400_000])
def test_ids_are_the_library_s_whatever_is_forgotten(monkeypatch, held):
    monkeypatch.setattr(token_file, "_CACHED_PIECES", held)
    tokens = token_file.WordTokens(PATH)
    for texts in (_texts(500), _texts(1000), _texts(500), pa.array(["..."], pa.large_string())):
        ids, n = tokens.of_texts(texts, 2)
        wanted = [[*tokens.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts.to_pylist()]
        assert ids.tolist() == [i for x in wanted for i in x] and n.tolist() == [len(x) for x in wanted]


def test_small_ids_are_not_sorted(monkeypatch):
    ids = np.random.default_rng(3).integers(0, 50_000, 4000, dtype=np.uint32)
    plain = rans.encode(np.append(ids, np.uint32(1 << 31)), [2000, 2001])
    assert (rans.decode(plain) == np.append(ids, np.uint32(1 << 31))).all()
    for name in ("unique", "searchsorted"):
        own = getattr(np, name)
        monkeypatch.setattr(np, name, lambda a, *b, own=own, **c: own(a, *b, **c) if len(a) < 1000 else pytest.fail(name))
    frame = rans.encode(ids, [2000, 2000])
    monkeypatch.undo()
    assert (rans.decode(frame) == ids).all()
