"""Queries with SQL against DuckDB, the others against the library or brute force,
on the whole small driver tables."""

import hashlib
import zlib

import duckdb
import pytest

import compare
from galaxia.llm.queries import ORACLE, QUERIES

from .conftest import SF


@pytest.mark.parametrize("name", ORACLE)
def test_oracle(spark, name):
    df = QUERIES[name](spark, SF)
    rows, columns = df.collect(), df.columns
    con = compare.duck(SF)
    cur = con.execute(ORACLE[name])
    theirs = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(theirs)
    own = sorted(tuple(r[c] for c in sorted(columns)) for r in rows)
    assert own == sorted(tuple(r[theirs.index(c)] for c in sorted(theirs)) for r in cur.fetchall())


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall()


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_tokens_and_text_are_the_librarys(spark, docs, tokenizer):
    def digest(s):
        return hashlib.sha256(s.encode()).hexdigest()
    found = {r.doc_id: r for r in QUERIES["op10_bpe_words"](spark, SF).collect()}
    assert len(found) == len(docs)
    for i, text in docs:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert (found[i].n_tokens, found[i].ids_sha256, found[i].decoded_sha256) == \
            (len(ids), digest(" ".join(map(str, ids))), digest(tokenizer.decode(ids, skip_special_tokens=False)))


def test_packing_of_all_documents(spark, docs, tokenizer):
    import numpy as np
    rows = QUERIES["op3_best_fit_packing"](spark, SF).collect()
    want = set()
    for i, text in docs:
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u4")
        want |= {(i, k // 4096, k, len(ids[k:k + 4096]), zlib.crc32(ids[k:k + 4096].tobytes())) for k in range(0, len(ids), 4096)}
    assert {tuple(r)[:5] for r in rows} == want and len(rows) == len(want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(bins) <= 1.02 * -(-sum(r.length for r in rows) // 4096) + 1


def test_base_of_the_language_model(spark, docs):
    import math
    from collections import Counter
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs}
    words = {i: [*t.encode().lower().split(), None] for i, t in docs}
    count = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    rows = QUERIES["op1_kneser_ney"](spark, SF).collect()
    for r in rows:
        ws = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ws), sum(w in count for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_languages_of_held_out_documents(spark):
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    rows = [r for r in QUERIES["op2_language_id"](spark, SF).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) >= 0.95 * len(rows) > 0
    assert all(0 <= r.score <= 1 for r in rows)


def test_personal_data_of_all_documents(spark, docs):
    from galaxia.llm import pii
    text = dict(docs)
    rows = QUERIES["op6_pii"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = pii.base_spans(text[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert {*pii.joined(base).split(",")} <= {*r.spans.split(","), ""}


def test_components_of_all_documents(spark):
    import numpy as np
    rows = QUERIES["op5_simhash"](spark, SF).collect()
    ids, fp = np.array([r.doc_id for r in rows]), np.array([int(r.fingerprint, 16) for r in rows], np.uint64)
    near = np.bitwise_count(fp[:, None] ^ fp) <= 4
    least = ids.copy()
    while True:
        new = np.array([least[n].min() for n in near])
        if (new == least).all():
            break
        least = new
    assert [r.component_id for r in rows] == least.tolist()
