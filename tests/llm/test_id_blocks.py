"""The coder of id blocks: its format, and its order-0 counts."""

import zlib

import numpy as np

from tallyhouse.llm.id_blocks import _Predictor, decode_ids, encode_ids


def test_payload_is_that_of_the_format():
    """Payload and sizes as the first version of the coder wrote them."""
    for ids, wanted in (
        (np.zeros(5000, np.uint32), (1, 159502171, 1543026974)),
        (np.arange(20000, dtype=np.uint32) ** 2 % 7001, None),
        (np.r_[np.arange(300), 2_000_000, np.zeros(3000)].astype(np.uint32), None),
    ):
        kinds, sizes, payload = encode_ids(ids)
        assert np.array_equal(decode_ids(len(ids), kinds, sizes, payload), ids)
        if wanted:
            assert (kinds, zlib.crc32(payload), zlib.crc32(sizes.astype("<i8").tobytes())) == wanted


def test_counts_by_runs_are_sums_over_all_ids():
    for kinds in (1, 7, 8, 9, 1003):
        model, random = _Predictor(kinds, 64), np.random.default_rng(kinds)
        counts = np.ones(kinds, np.uint64)
        for _ in range(5):
            ids = random.integers(0, kinds, 64)
            model.guess(64)
            model.learn(64, ids, model.mix)
            np.add.at(counts, ids, np.uint64(24))
        edges = np.concatenate([[np.uint64(0)], np.cumsum(counts)])
        below, own = model.range_of(np.arange(kinds))
        assert np.array_equal(below, edges[:-1]) and np.array_equal(own, counts) and model.below[-1] == edges[-1]
        points = np.arange(edges[-1], dtype=np.uint64)
        assert np.array_equal(model.at(points), np.searchsorted(edges, points, "right") - 1)
