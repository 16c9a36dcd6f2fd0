"""Words split in arrays, runs, and maps of stored arrays."""

import numpy as np
import pytest

from galaxia.llm import kneser_ney as K
from galaxia.llm import sharedfiles


@pytest.mark.parametrize("texts", [[], [""], ["", ""], [" a\tB\x0bc ", "", "d\r\ne\x0cf"], ["É\x1cx  y z", "a\x00b \ud800"],
                                   ["word " * 5000, "", "w" * 100_000]])
def test_split_is_the_plain_split(texts):
    words, sizes = K.split(texts)
    plain = [t.encode("utf-8", "replace").lower().split() for t in texts]
    assert words.to_pylist() == [w for x in plain for w in x]
    assert sizes.tolist() == [len(x) for x in plain]


def test_words_are_hashed_in_arrays(monkeypatch):
    import xxhash
    words = [b"", b"a", b"a\x00", b"\x00a", b"eight by", b"nine byte", b"eight by\x00", "d\u00e9j\u00e0".encode(), b"w" * 63, b"w" * 64]
    words += [b"word%d" % i for i in range(5000)]
    long = [b"w" * 65, b"w" * 64 + b"x", b"w" * 10_000]
    hashes = K.word_hash(words + long)
    assert len(set(hashes.tolist())) == len(words + long)
    again = K.word_hash(long[::-1] + words[::-1])    # whatever stands beside a word
    assert (again == hashes[::-1]).all()
    assert len(K.word_hash([])) == 0

    def one_by_one(word):
        raise AssertionError("a call for a short word")
    monkeypatch.setattr(xxhash, "xxh64_intdigest", one_by_one)
    assert (K.word_hash(words) == hashes[:len(words)]).all()
    got, _ = K.split([b" ".join(words[9:]).decode().upper()])
    assert (K.word_hash(got) == hashes[9:len(words)]).all()


@pytest.mark.parametrize("values", [
    np.zeros(0, np.uint64), np.full(5, 7, np.uint64), np.array([3, -1, 2, -1, 0]), np.array([9, 2, 9, 1], np.uint32),
    np.array([1 << 63, 0, (1 << 64) - 1, 1, (1 << 64) - 1, 2], np.uint64),                  # differ in low bits only
    np.random.default_rng(2).integers(0, 1 << 64, 3000, dtype=np.uint64),
    np.random.default_rng(3).integers(0, 5000, 9000, dtype=np.uint64) * np.uint64(3) ** np.uint64(np.arange(9000) % 33),
    np.append(np.random.default_rng(4).integers(0, 3, 9000, dtype=np.uint64), np.uint64((1 << 64) - 1))[::-1],
    np.append(np.arange(9000, dtype=np.uint64)[::-1], np.uint64((1 << 64) - 1)),           # one group of top bits
    np.append(np.arange(20_000, dtype=np.uint64) % np.uint64(5000) << np.uint64(40) | np.arange(20_000, dtype=np.uint64)[::-1] % np.uint64(7),
              np.uint64((1 << 64) - 1))])                                                  # thousands of groups
def test_order_and_distinct_values(values):
    assert (K.ascending(values) == np.argsort(values, kind="stable")).all()
    found, places = K.distinct(values)
    want, at = np.unique(values, return_inverse=True)
    assert found.dtype == values.dtype and (found == want).all() and (places == at).all()


def test_empty_model_encodes():
    ids, sizes = K.Model().encode(["a b", ""])
    assert ids.tolist() == [K.UNKNOWN, K.UNKNOWN, 0, 0] and sizes.tolist() == [3, 1]


def test_runs_add_up():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 50, 400).astype(np.uint64)
    parts = [np.unique(x, return_counts=True) for x in np.split(keys, [7, 7, 150])]
    merged = K.merge_runs([K.pack_run(*p) for p in parts])
    for a, b in zip(merged, np.unique(keys, return_counts=True), strict=True):
        assert (a == b).all()
    assert all(len(x) == 0 for x in K.merge_runs([K.pack_run(*parts[1])]))


@pytest.mark.parametrize("values", [np.zeros(0), np.zeros((2, 0), np.int64), np.arange(7, dtype=np.uint64), np.arange(6).reshape(2, 3),
                                    np.asfortranarray(np.arange(6).reshape(2, 3))])
def test_maps_are_the_arrays(values, tmp_path):
    got = sharedfiles.map_array(sharedfiles.write_array(str(tmp_path), "x", values))
    assert got.dtype == values.dtype and got.shape == values.shape and (got == values).all()
