"""Op 12 against a trie built in memory; sketches and windows of any size."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL as SF
from galaxia.llm import prefix_trie, queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
KIND = "conv_id long, turn long, role string, text string"


def expected(rows):
    own = defaultdict(list)
    for r in rows:
        if r.conv_id is not None:
            own[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    for turns in own.values():
        turns.sort()
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(t[2:] for t in own.get(c - c % 20, [])[:h] + turns[h:])
    members, children = defaultdict(set), defaultdict(set)
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members[s[:d]].add(c)
    for s in members:
        if s:
            children[s[:-1]].add(s)
    leaves, saved, out = {}, {}, []
    for s in sorted(members, key=len, reverse=True):
        m = members[s]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
        leaves[s] = sum(leaves[k] for k in children[s]) or 1
        saved[s] = (len(m) - 1) * words + sum(saved[k] for k in children[s])
        ends = ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(s))
        out.append((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(children[s]), leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df, **given):
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(df, **given).select(*COLUMNS).collect()), key=str)


def test_query_equals_a_trie_in_memory(spark):
    got = queries.op12_prefix_trie(spark, SF)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(spark.read.parquet(f"{SF}/conversations.parquet").collect())


@pytest.fixture(scope="module")
def shared(spark):
    """Conversations that share long beginnings, some equal, short, or turnless after rebuilding."""
    rows = []
    for c in range(70):
        for t in range((c * 5) % 9):
            rows.append((c, t, "user" if t % 2 else None, f"turn {t} {'same' if t < 5 or c % 3 else c}" if t != 3 else None))
    rows += [(200, None, "a", "no turn"), (200, None, "a", "no turn"), (200, 0, "a", "first"), (None, 1, "a", "lost"), (219, 5, "a", "x")]
    return spark.createDataFrame(rows, KIND)


@pytest.mark.parametrize("cells,span", [(1, 4096), (8, 2), (1 << 16, 1)])
def test_any_sketch_and_stretch_gives_the_same(shared, monkeypatch, cells, span):
    monkeypatch.setattr(prefix_trie, "SPAN", span)
    assert found(shared, cells=cells) == expected(shared.collect())


def test_other_columns_and_empty_tables(spark, shared):
    more = shared.withColumns({c: F.lit(7) for c in ("depth", "p1", "part", "pos", "words", "leaf")})
    assert found(more) == expected(shared.collect())
    assert found(spark.createDataFrame([], KIND)) == []
    assert found(spark.createDataFrame([(None, 1, "a", "b")], KIND)) == []


def test_one_conversation_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3000).select(F.lit(5).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"), (F.col("id") % 7).cast("string").alias("text"))
        got = prefix_trie.numbered(prefix_trie.turn_rows(df)).collect()
        assert sorted(r.pos for r in got) == list(range(1, 3001))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
