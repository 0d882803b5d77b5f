"""The lattice looks up only lengths that some piece with the same first bytes has."""

import random

import numpy as np
import pyarrow as pa
from test_operators import every_path

from wayweave.llm import sentence_pieces


def test_lookups_follow_the_pieces(monkeypatch):
    rng = random.Random(3)
    listed = [(f"<0x{i:02X}>", 0, "byte") for i in range(256)]
    listed += [("▁", -5, "normal"), ("a", -3, "normal"), ("b", -3.5, "normal"), ("ab", -4, "normal"), ("aba", -4.5, "normal"), ("▁bab", -4.2, "normal")]
    listed += [("xyz" + "w" * k, -9, "normal") for k in range(1, 20)]
    v = sentence_pieces.vocabulary(listed)
    texts = ["".join(rng.choice("aab  é") for _ in range(rng.randint(0, 12))) for _ in range(60)] + ["xyzwwa", "xyzw xyz", "ab xyzwwww"]
    asked, find = [], sentence_pieces._find
    monkeypatch.setattr(sentence_pieces, "_find", lambda v, h: asked.append(len(h)) or find(v, h))
    for t, found in zip(texts[:60], sentence_pieces.encode(v, pa.array(texts[:60]), 4), strict=True):
        assert np.allclose([s for s, _ in found], every_path(v, t)[:4])
        assert all(sentence_pieces.decode_ids(v, p) == t.encode() for _, p in found)
    v.cache, asked[:] = None, []
    many = [" " + "ab" * rng.randint(10, 40) for _ in range(20)]
    list(sentence_pieces.encode(v, pa.array(many), 1))
    # one and two bytes at each node, and three where "aba" may begin
    assert sum(asked) <= 3 * sum(len(t) + 1 for t in many)
    for t, found in zip(texts[60:], sentence_pieces.encode(v, pa.array(texts[60:]), 2), strict=True):
        assert sentence_pieces.decode_ids(v, found[0][1]) == t.encode()
        assert any(len(v.spelled[i]) >= 4 for i in found[0][1].tolist())
