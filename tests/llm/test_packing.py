"""Packing against the plain tokenizer, and the differencing's own promises."""

import zlib

import numpy as np
import pytest

from rainfold.llm import packing
from rainfold.llm.q_llm import tokenizer_path
from tests.llm.data import awkward_rows, documents


@pytest.fixture(scope="module")
def packed(spark):
    rows = awkward_rows()
    return rows, packing.pack_documents(documents(spark, rows), tokenizer_path()).toPandas()


def test_pieces_are_the_plain_tokenizers_ids(packed):
    from tokenizers import Tokenizer

    rows, got = packed
    plain = Tokenizer.from_file(tokenizer_path())
    want = []
    for i, t, *_ in rows:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want += [(i is None, i or 0, a, m, zlib.crc32(ids[a:a + m].tobytes()), len(ids)) for a, m in packing.cuts(len(ids), 4096, 1024)]
    have = [(bool(np.isnan(r.doc_id)), int(np.nan_to_num(r.doc_id)), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got.itertuples()]
    assert sorted(have) == sorted(want)


def test_sequences_are_gapless_and_within_capacity(packed):
    _, got = packed
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g["offset"].tolist() == [0, *g["length"].cumsum().tolist()[:-1]]
        assert g["length"].sum() <= 4096


def test_differencing_is_even_and_window_count_rises():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 1024, 400)
    k = -(-lengths.sum() // 4096)
    sums = np.bincount(packing.differencing(lengths, k), lengths, k)
    assert sums.sum() == lengths.sum() and sums.max() - sums.min() < 64
    assert np.bincount(packing.windows(np.full(5, 60), 100)).tolist() == [1] * 5  # 300 ids in 3 windows can't be
    assert packing.differencing(np.array([8, 7, 6, 5, 4]), 2).tolist() in ([0, 0, 1, 1, 1], [1, 1, 0, 0, 0], [0, 1, 0, 1, 1], [1, 0, 1, 0, 0], [0, 1, 1, 0, 0], [1, 0, 0, 1, 1])


def test_cuts_cover_every_id_once():
    for n in (1, 1023, 1024, 1025, 4095, 4096, 4097, 20000):
        at = 0
        for a, m in packing.cuts(n, 4096, 1024):
            assert a == at and 0 < m <= 4096
            at += m
        assert at == n


def test_empty_table(spark):
    assert packing.pack_documents(documents(spark, []), tokenizer_path()).count() == 0
