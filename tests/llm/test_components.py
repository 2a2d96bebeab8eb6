import random

import pandas as pd

from corpusprep.llm import components as c


def roots(edges):
    return {(u, v) for frame in c._contract(iter([pd.DataFrame(edges, columns=["u", "v"], dtype="int64")])) for u, v in frame.values.tolist()}


def test_contraction_in_bounded_memory_keeps_components(monkeypatch):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    whole = roots(edges)
    monkeypatch.setattr(c, "HELD_NODES", 5)
    frames = [pd.DataFrame(edges[i : i + 10], columns=["u", "v"]) for i in range(0, len(edges), 10)]
    handed = list(c._contract(iter(frames)))
    assert len(handed) > 10 and max(map(len, handed)) < 25
    assert roots([e for frame in handed for e in frame.values.tolist()]) == whole
