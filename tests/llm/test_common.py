import random

import numpy as np
import pyarrow as pa
from barcodeforge.llm import common as C
from barcodeforge.llm.components import connected_components


def test_span_hash_depends_on_the_bytes_alone():
    data = np.frombuffer(b"abcXabcYabXabc" * 3, np.uint8)
    h = C.SpanHasher(data)
    raw = data.tobytes()
    seen = {}
    for a in range(len(raw)):
        for b in range(a, min(len(raw), a + 9)):
            value = int(h(np.array([a]), np.array([b]))[0])
            assert seen.setdefault(raw[a:b], value) == value
    assert len(set(seen.values())) == len(seen)
    assert (h.every(4) == h(np.arange(len(raw) - 3), np.arange(len(raw) - 3) + 4)).all()


def test_runs_do_not_cross_rows_and_sliced_batches_keep_their_text():
    column = pa.array(["ab cd", None, "", "ef", " gh "])
    data, offsets = C.text_bytes(column)
    starts, ends, rows = C.spans(~C.IS_SPACE[data], offsets)
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == [b"ab", b"cd", b"ef", b"gh"]
    assert rows.tolist() == [0, 0, 3, 4]
    batch = pa.RecordBatch.from_arrays([column], ["text"]).slice(2)
    assert [p.column("text").to_pylist() for p in C.passes(iter([batch]), "text", 2)] == [["", "ef"], [" gh "]]


def test_bitmap(spark):
    cells = 1 << 16
    values = [0, 1, 7, 8, 32767, 32768, 40000, cells - 1]
    bits = C.bitmap(spark.createDataFrame([(v,) for v in values * 3], "cell bigint"), "cell", cells)
    assert np.flatnonzero(C.in_bitmap(bits, np.arange(cells))).tolist() == values


def test_components_of_stars_chains_and_random_edges(spark):
    rng = random.Random(3)
    edges = [(0, k) for k in range(1, 60)] + [(k, k + 1) for k in range(100, 160)] + [(500, 500), (7, None)]
    edges += [(rng.randint(1000, 1200), rng.randint(1000, 1200)) for _ in range(150)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in list(parent)}
    assert len(got) == len(parent)
    assert connected_components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0
