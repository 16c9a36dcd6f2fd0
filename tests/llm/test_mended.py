"""Cases that once failed: see the names."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import Row

from compare import compare, duck
from conftest import SF_SMALL as SF
from galaxia.llm import kneser_ney, line_dedup, pii, quality, toxicity, wordcodec


def test_plain_words_have_the_ids_of_the_library():
    texts = [t or "" for t in pq.read_table(f"{SF}/documents.parquet", columns=["text"])["text"].to_pylist()]
    words = {w for t in texts for w in t.encode().split()}
    rng = random.Random(4)
    alphabet = "abcXYZéÀßÿ÷×ŉİıſǅẞΣς'’.,-!<>|19½²ªﬁ́̌日"
    words |= {"".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 9))).encode() for _ in range(20_000)}
    words |= {w.encode() for w in ("<|endoftext|>", "<|ENDOFTEXT|>,", "it's,", "ÀÈ×÷?!..", "a" * 5000, "J̌,", "Ab)]}=")}
    c = wordcodec.WordCodec(wordcodec.vocabulary_path())
    assert c.merges is not None
    words = sorted(words)
    want = c.tok.encode_batch([w.decode() for w in words], add_special_tokens=False)
    bad = [w for w, ids, e in zip(words, c.encode_words(words), want) if ids != __import__("numpy").array(e.ids, dtype=c.dtype).tobytes()]
    assert bad == []


@pytest.mark.parametrize("length", [15_000, 25_000, 70_000])
def test_long_texts_train_the_crf(spark, length):
    rows = [(i, f"ring +1 (988) 555-24{i + 10} now or +44 20 7946 0{i + 100}, mail a{i}@x.org, host 10.0.0.{i}, in 1999 we saw 12 or {i} " + "word " * (length // 5)) for i in range(50)]
    model = pii.train(spark.createDataFrame(rows, "doc_id long, text string"))
    short = pii.train(spark.createDataFrame([(i, t[:140]) for i, t in rows], "doc_id long, text string"))
    assert model.w
    text = "call (988) 555-2485 now"
    assert pii.find(text, model)[1] == pii.find(text, short)[1] == [("phone", 5, 19)]


def test_repeated_rows_of_one_label_leave_the_others_in(spark):
    docs = [(0, "a fine day")] * 2500 + [(i, "you vile fool" if i % 2 else "a fine day") for i in range(1, 40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    got = toxicity.sample(spark.createDataFrame(docs, "doc_id long, text string"), labels)
    once = toxicity.sample(spark.createDataFrame(sorted(set(docs)), "doc_id long, text string"), labels)
    assert got == once and {y for _, y in got} == {0, 1}


@pytest.fixture(scope="module")
def bad_host(spark, tmp_path_factory):
    """Thirty hosts; of one, nearly all documents fail a rule that only hosts are judged by."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(3000):
        symbols = rng.random() < (0.9 if i % 30 == 7 else 0.03)
        text = " ".join(rng.choice(words) + ("#" if symbols else "") for _ in range(80))
        rows.append(Row(doc_id=i, text=text, lang="en", source=f"host{i % 30}", n_chars=len(text)))
    folder = str(tmp_path_factory.mktemp("hosts"))
    spark.createDataFrame(rows).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_a_bad_hosts_documents_go_and_others_stay(spark, bad_host, tmp_path):
    import duckdb
    docs = spark.read.parquet(f"{bad_host}/documents.parquet")
    got = quality.quality_rules(docs)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{bad_host}/documents.parquet/*.parquet'")
    ok, message = compare(got, con, quality.ORACLE)
    assert ok, message
    changed = {r.doc_id % 30 for r in got.where("NOT kept AND NOT base_failed").collect()}
    assert changed == {7}


def test_hosts_that_fail_alike_all_stay(spark):
    assert duck(SF) is not None
    got = quality.quality_rules(spark.read.parquet(f"{SF}/documents.parquet"))
    assert got.where("NOT host_ok").count() == 0


def test_texts_meet_their_dropped_lines_in_a_merge_join_at_every_size(spark):
    text = "a line that is long enough to count\nown line {}"
    docs = spark.createDataFrame([(i, text.format(i)) for i in range(5)], "doc_id long, text string")
    got = line_dedup.line_dedup(docs)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert [(r.n_lines, r.n_dropped) for r in got.orderBy("doc_id").collect()] == [(2, 1)] * 4 + [(2, 0)]


@pytest.mark.parametrize("order", [2, 3])
def test_a_bigram_is_looked_up_once_however_often_it_occurs(spark, monkeypatch, order):
    import numpy as np
    docs = spark.createDataFrame([(i, "a b a b c " * (i % 3 + 1)) for i in range(9)] + [(9, None)], "doc_id long, text string")
    model = kneser_ney.train(docs, order)
    ids, sizes = model.encode(["a b a b a b c new a b", "", "new new a", "b c a"])
    before = model.contexts(ids, sizes)
    ranks = model.pair_ranks(before, ids)
    want = model.log10(before, ids, kneser_ney.previous(ranks, sizes))
    asked = []
    look = kneser_ney.Model.ranks
    monkeypatch.setattr(kneser_ney.Model, "ranks", lambda self, keys: asked.extend(keys.tolist()) or look(self, keys))
    got = model.log10_texts(ids, sizes)
    assert len(asked) == len(set(asked)) == len(set(zip(before.tolist(), ids.tolist())))
    assert all(np.allclose(a, b, rtol=1e-12) for a, b in zip(got, want, strict=True))
