"""Op 13 against a dictionary of all 100-byte strings, and its parts against plain Python."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL as SF
from galaxia.llm import queries, suffix_dedup

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def expected(rows):
    docs = sorted({(r.doc_id is not None, r.doc_id or 0, (r.text or "").encode()) for r in rows}, key=lambda d: d[:2])
    seen, out = {}, {}
    for known, doc, data in docs:
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            first = seen.setdefault(data[i:i + 100], (known, doc, data, i))
            if first != (known, doc, data, i):
                gone[i:i + 100] = b"\1" * 100
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[doc if known else None, data] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted(((r.doc_id, *out[r.doc_id, (r.text or "").encode()]) for r in rows), key=str)


def found(df, **given):
    return sorted((tuple(r) for r in suffix_dedup.suffix_dedup(df, **given).select(*COLUMNS).collect()), key=str)


def test_query_equals_a_dictionary_of_all_strings(spark):
    got = queries.op13_suffix_dedup(spark, SF)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(spark.read.parquet(f"{SF}/documents.parquet").collect())


@pytest.fixture(scope="module")
def passages(spark):
    """Passages around 100 bytes in many contexts, periodic texts and copies."""
    rng = random.Random(3)
    parts = ["".join(rng.choice("ab cé") for _ in range(n)) for n in (60, 90, 99, 100, 101, 130, 260)] + ["x" * 350, "ab" * 160]
    texts = ["".join(rng.choice(parts) + rng.choice(["", "-", "q" * rng.randrange(9)]) for _ in range(rng.randrange(1, 9))) for _ in range(90)]
    return spark.createDataFrame([(i % 80 - 5, t) for i, t in enumerate(texts)] + [(200, texts[0]), (200, texts[0]), (201, None)], "doc_id long, text string")


@pytest.mark.parametrize("limit,per", [(1, 7), (3, 40), (4096, 20_000)])
def test_any_division_gives_the_same(passages, limit, per):
    rows = [r for r in passages.collect()]
    ids = [r.doc_id for r in rows]
    single = passages.where(F.col("doc_id").isin([i for i in ids if ids.count(i) == 1]) | (F.col("doc_id") >= 200))
    assert found(single, limit=limit, per=per, stored=50) == expected(single.collect())


def test_odd_rows(odd, odd_extra, odd_rows, none, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STEP", 1 << 12)
    want = expected(odd_rows)
    assert found(odd) == want and found(odd_extra) == want
    assert found(none) == []


def test_collection_puts_equal_strings_in_one_class(tmp_path):
    rng = random.Random(1)
    base = ["".join(rng.choice("ab") for _ in range(200)) for _ in range(3)]
    strings = [rng.choice(base)[rng.randrange(40):][:rng.randrange(100, 160)].encode() for _ in range(40)]
    string, start, kind = suffix_dedup.Collection(strings, str(tmp_path)).windows()
    by_text, by_kind = {}, {}
    for i, a, k in zip(string, start, kind):
        by_text.setdefault(strings[i][a:a + 100], set()).add(k)
        by_kind.setdefault(k, set()).add(strings[i][a:a + 100])
    assert sum(len(s) - 99 for s in strings) == len(string)
    assert all(len(v) == 1 for v in by_text.values()) and all(len(v) == 1 for v in by_kind.values())
    assert not list(tmp_path.iterdir())      # no file is left


def test_segments_hold_every_window_once():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"abc ") for _ in range(n)) for n in (0, 99, 100, 101, 5000)] + [b"a" * 700]
    runs = suffix_dedup.Runs(texts)
    got = [(r, s + i) for r, s, n in zip(runs.row, runs.start, runs.length) for i in range(n - 99)]
    assert sorted(got) == [(r, i) for r, t in enumerate(texts) for i in range(len(t) - 99)]
    h = suffix_dedup.core_hashes(np.frombuffer(texts[4], dtype="u1"), 32)
    for r, s, a, own in zip(runs.row, runs.start, runs.anchor, runs.h):
        if r == 4:
            assert h[s + a] == own
