"""The methods' own parts against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from galaxia.llm import bpe_words, components, exact_dedup, kneser_ney, langid, packing, pii, quality, simhash, toxicity, wordcodec


# ---- op1


def test_mix_is_one_to_one():
    x = np.random.default_rng(0).integers(0, 1 << 64, 1000, dtype=np.uint64)
    assert (kneser_ney.unmix(kneser_ney.mix(x)) == x).all()


def test_runs_round_trip():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 64, 500, dtype=np.uint64))
    counts = np.arange(len(keys)) % 7 + 1
    a, b = kneser_ney.merge_runs([kneser_ney.pack_run(keys, counts), kneser_ney.pack_run(keys[::2], counts[::2])])
    assert (a == keys).all() and (b == counts + np.where(np.arange(len(keys)) % 2, 0, counts)).all()


def test_probabilities_sum_to_one(spark):
    texts = ["a b a c", "a b", "c a b b a", "", "d a b a c"]
    model = kneser_ney.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    words = model.ids_of(kneser_ney.word_hash([b"a", b"b", b"c", b"d", b"new"]))
    every = np.append(words, model.end).astype(np.uint32)
    for before in [*words, model.begin]:
        logs, _, _ = model.log10(np.full(len(every), before, np.uint32), every)
        assert np.isclose((10.0 ** logs).sum(), 1.0)


def test_large_counts(spark):
    model = kneser_ney.train(spark.createDataFrame([("x y " * 400,)] * 3, "text string"))
    x, y = model.ids_of(kneser_ney.word_hash([b"x", b"y"]))
    assert model.bigrams(np.array([x, y, y], np.uint32), np.array([y, x, model.end], np.uint32)).tolist() == [1200, 1197, 3]


def kneser_ney_by_hand(texts, order):
    """log10 P of a document: modified Kneser-Ney over tuples, plain counts at the
    highest order and after the begin, continuation counts elsewhere."""
    docs = [["<s>", *t.lower().split(), "</s>"] for t in texts]
    plain = [Counter(tuple(d[i:i + n]) for d in docs for i in range(len(d) - n + 1)) for n in range(1, order + 1)]
    counts = []
    for n in range(1, order + 1):
        if n == order:
            counts.append(plain[n - 1])
        else:
            before = Counter(g[1:] for g in plain[n])
            counts.append({g: c if n > 1 and g[0] == "<s>" else before[g] for g, c in plain[n - 1].items() if g != ("<s>",)})
    cut = [(0.0, *kneser_ney.discounts([sum(v == k for v in c.values()) for k in (1, 2, 3, 4)])) for c in counts]
    words = len({w for d in docs for w in d} - {"<s>"})

    def p(context, w):
        n = len(context)
        lower = p(context[1:], w) if n else 1 / (words + 1)
        after = [c for g, c in counts[n].items() if g[:-1] == context]
        if not after:
            return lower
        c = counts[n].get((*context, w), 0)
        return (c - cut[n][min(c, 3)] + sum(cut[n][min(k, 3)] for k in after) * lower) / sum(after)

    def score(text):
        d = ["<s>", *text.lower().split(), "</s>"]
        return sum(np.log10(p(tuple(d[max(0, i - order + 1):i]), d[i])) for i in range(1, len(d)))
    return score


@pytest.mark.parametrize("order", [2, 3])
def test_scores_of_longer_contexts(spark, order):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("aabbcdefg") for _ in range(rng.randint(0, 12))) for _ in range(60)] + ["a b c a b c " * 300]
    new = ["a b c a", "c b a", "new a b new b", "", "g", "g g g g f", "a b", "b c a b"]
    model = kneser_ney.train(spark.createDataFrame([(t,) for t in texts], "text string"), order)
    docs = spark.createDataFrame(list(enumerate(texts + new)), "doc_id long, text string")
    expected = kneser_ney_by_hand(texts, order)
    for r in kneser_ney.score(docs.withColumn("x", docs.doc_id), model, ["x"]).collect():
        assert np.isclose(r.score, expected((texts + new)[r.doc_id]))


def test_two_words_of_context_tell_more_than_one(spark):
    texts = ["x a b", "y a c"] * 20
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts * 4)], "doc_id long, text string")
    assert {r.score / r.n_tokens > -0.12 for r in kneser_ney.lm_scores(docs).collect()} == {True}
    assert {r.score / r.n_tokens > -0.12 for r in kneser_ney.lm_scores(docs, order=2).collect()} == {False}


def test_probabilities_of_two_words_sum_to_one(spark):
    texts = ["a b a c", "a b", "c a b b a", "", "d a b a c"]
    model = kneser_ney.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    words = model.ids_of(kneser_ney.word_hash([b"a", b"b", b"c", b"d", b"new"]))
    every = np.append(words, model.end).astype(np.uint32)
    for u, v in itertools.product([*words, model.begin], words):
        context = model.pair_ranks(np.array([u], np.uint32), np.array([v], np.uint32)).repeat(len(every))
        logs, _, _ = model.log10(np.full(len(every), v, np.uint32), every, context)
        assert np.isclose((10.0 ** logs).sum(), 1.0)


# ---- op2


def test_viterbi_is_best():
    rng = np.random.default_rng(2)
    for _ in range(30):
        s = rng.normal(0, 3, (1, 6, 3)).astype(np.float32)

        def value(path, s=s):
            return sum(s[0, t, k] for t, k in enumerate(path)) - 2.0 * sum(a != b for a, b in itertools.pairwise(path))
        best = max(itertools.product(range(3), repeat=6), key=value)
        assert np.isclose(value(langid.viterbi(s, 2.0)[0]), value(best), atol=1e-4)


def test_scripts_and_spans(spark):
    rows = [(i, t, g) for i, (t, g) in enumerate([("the house and the tree of the garden", "en"), ("дом и дерево в саду и на улице", "ru"),
                                                  ("das haus und der baum in dem garten", "de")] * 20)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    mixed = "the house of the garden дом и дерево в саду und der baum in dem garten das haus"
    [r] = langid.identify(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).collect()
    assert [s.lang for s in r.spans] == ["en", "ru", "de"] and r.lang_pred == "de"
    assert r.spans[1].words == 5


def test_unlearned(spark):
    docs = spark.createDataFrame([(1, "a b", None)], "doc_id long, text string, lang string")
    [r] = langid.identify(docs, langid.train(docs)).collect()
    assert (r.lang_pred, r.score) == ("und", 0.0)


# ---- op3


def test_fullest_combination():
    rng = random.Random(3)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(6)}
        slack = rng.randint(0, 60)
        taken = packing.fullest(slack, counts)
        assert all(0 < n <= counts[k] for k, n in taken)
        sums = {sum(c * k for k, c in zip(counts, p, strict=True)) for p in itertools.product(*[range(n + 1) for n in counts.values()])}
        assert sum(k * n for k, n in taken) == max(s for s in sums if s <= slack)


def test_plan_gives_every_piece_a_place():
    rng = random.Random(4)
    histogram = {rng.randint(1, 100): rng.randint(1, 50) for _ in range(40)}
    plan = packing.plan(histogram, 100)
    bins, given = {}, dict.fromkeys(histogram, 0)
    for length, rows in plan.groupby("length"):
        rows = rows.sort_values("rank").to_dict("records")
        for row, after in zip(rows, [*rows[1:], {"rank": histogram[length]}], strict=True):
            for n in range(after["rank"] - row["rank"]):
                bins.setdefault(row["bin"] + n // row["uses"], []).append((row["offset"] + n % row["uses"] * length, length))
                given[length] += 1
    assert given == histogram
    for parts in bins.values():
        assert sum(n for _, n in parts) <= 100
        assert all(a + n == b for (a, n), (b, _) in itertools.pairwise(sorted(parts)))


# ---- op4


@pytest.mark.parametrize("bits", [1, 3, 64])
def test_colliding_chunk_hashes_are_told_apart(spark, bits):
    rng = random.Random(5)
    long = ["".join(rng.choice("abcdtuvwxyz ") for _ in range(6000)) for _ in range(6)]
    texts = long + [long[0] + " ", long[1][:-1] + "!", long[2], "", " ", "short"] + [x[:3000] for x in long]
    rows = exact_dedup.exact_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), bits=bits).collect()
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t) for t in texts]
    for r in rows:
        same = [i for i, t in enumerate(norm) if t == norm[r.doc_id]]
        best = max(same, key=lambda i: (len(texts[i]), -i))
        assert (r.keep_id, r.group_size, r.kept) == (best, len(same), best == r.doc_id)
        assert r.text_sha256 == hashlib.sha256(norm[r.doc_id].encode()).hexdigest()


# ---- op5


def test_any_four_positions_hold_a_set():
    sets = simhash.position_sets()
    assert len(sets) == 20
    assert all(any(set(t) <= set(four) for t in sets) for four in itertools.combinations(range(8), 4))


@pytest.mark.parametrize("block", [4, 4096])
def test_links_keep_every_component(spark, block):
    rng = random.Random(6)
    fps = {rng.getrandbits(64) for _ in range(30)}
    for base in list(fps)[:6]:
        x = base
        for _ in range(25):
            for b in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << b
            fps.add(x)
    fps = np.array(sorted(fps), np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps) <= 4
    least = np.arange(len(fps))
    while (new := np.array([least[n].min() for n in near])).tolist() != least.tolist():
        least = new
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    found = dict(map(tuple, components.connected_components(simhash.links(df, block)).collect()))
    own = [found.get(int(x), int(x)) for x in fps.view(np.int64)]
    assert len(set(zip(own, least.tolist(), strict=True))) == len(set(own)) == len(set(least.tolist()))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    found = dict(map(tuple, components.connected_components(edges).collect()))
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


# ---- op6


def naive_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_base_spans():
    rng = random.Random(7)
    for _ in range(5000):
        t = "".join(rng.choice("a@.1 2+-(5)%é_") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == naive_spans(t)
    for t in ("4111 1111 1111 1111", "4" * 60_000, "a" * 60_000 + "@", "1." * 30_000, "+1" + "(" * 60_000, "a@" * 30_000):
        assert pii.base_spans(t) == (naive_spans(t) if len(t) < 100 else pii.base_spans(t))


@pytest.fixture(scope="module")
def crf():
    rng = random.Random(8)
    texts = []
    for _ in range(60):
        texts.append(rng.choice([f"call +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} now",
                                 f"card 4111 1111 1111 1111 and {rng.randint(1, 99)}", f"at 10.{rng.randint(0, 255)}.3.4 ok",
                                 f"write a{rng.randint(1, 99)}@mail.example.com, please", f"version {rng.randint(1, 9)}.0 of {rng.randint(1900, 2030)}"]))
    return pii.fit(texts, epochs=6)


def test_an_address_with_a_long_run_of_zeros():
    assert pii.base_spans("0" * 5000 + ".1.2.3") == [("ip", 0, 5006)]
    assert pii.base_spans("0" * 5000 + "256.1.2.3") == []


def test_dynamic_program_is_best(crf):
    def value(lattice, scores, path):   # path: (first, past, label, segment)
        return sum(scores[n] if n >= 0 else 0 for *_, n in path) + sum(crf.a[p, k] for p, k in itertools.pairwise([0, *[k for _, _, k, _ in path]]))

    def paths(lattice, t):
        if t == len(lattice.tokens):
            yield []
            return
        steps = [(t, t + 1, 0, -1)] + [(i, j, k, n) for n, (i, j, k, _) in enumerate(lattice.segments) if i == t]
        for s in steps:
            for rest in paths(lattice, s[1]):
                yield [s, *rest]
    for text in ("x (212) 555-0187 y", "4111.1111.1111.1111", "a 10.0.0.1 1234"):
        lattice = pii.Lattice(text, [m.span() for m in pii._TOKEN.finditer(text)], [])
        scores = crf.scores(lattice)
        best = max(paths(lattice, 0), key=lambda p: value(lattice, scores, p))
        assert crf.decode(lattice) == [(i, j, k) for i, j, k, n in best if n >= 0]


def test_gradient_of_the_likelihood(crf):
    text = "call +1 (212) 555-0187 or 10.0.0.1"
    [(tokens, inside)] = pii.windows(text, pii.base_spans(text))
    lattice = pii.Lattice(text, tokens, [])
    starts, past = {a: i for i, (a, _) in enumerate(tokens)}, {b: i + 1 for i, (_, b) in enumerate(tokens)}
    gold = {(starts[a], past[b], pii.LABELS.index(k)) for k, a, b in inside}
    _, da, expect = crf.gradient(lattice, gold)
    for p, k in ((0, 4), (0, 0), (4, 0), (0, 2)):
        old = crf.a[p, k]
        values = []
        for e in (1e-5, -1e-5):
            crf.a[p, k] = old + e
            values.append(crf.gradient(lattice, gold)[0])
        crf.a[p, k] = old
        assert np.isclose((values[0] - values[1]) / 2e-5, da[p, k], atol=1e-4)


def test_spans_the_patterns_miss_or_merge(crf):
    def found(t):
        return {(k, t[a:b]) for k, a, b in pii.find(t, crf)[1]}
    assert ("phone", "(988) 555-2485") in found("call (988) 555-2485 now")
    assert ("card", "4111.1111.1111.1111") in found("card 4111.1111.1111.1111 and")
    for clean in ("version 3.0 of 2024-01-02", "token = 8824c3a463b8b0d68516", "in 1999 and 2001 we saw 12 or 13"):
        assert found(clean) == set()


# ---- op8


def test_gradient_of_the_network():
    net = toxicity.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    described = toxicity.describe([b"idiot", b"the", b"of", b"ab", b"worthless,"], {b"idiot": 2.0})
    index, mask = toxicity._grid([np.array([0, 1, 2, 3]), np.array([4, 1]), np.array([2, 2, 0])])
    y = np.array([1.0, 0, 1])
    _, grad = net.gradients(described, index, mask, y)
    for name, g in grad.items():
        for i in np.flatnonzero(g.ravel())[:4]:
            w, values = net.p[name].reshape(-1), []
            old = w[i]
            for e in (1e-3, -1e-3):
                w[i] = old + e
                values.append(net.gradients(described, index, mask, y)[0])
            w[i] = old
            assert np.isclose((values[0] - values[1]) / 2e-3, g.ravel()[i], rtol=2e-2, atol=1e-5), name


def test_windows_overlap_and_cover():
    for n in (0, 1, 64, 65, 112, 113, 1000):
        w = toxicity.windows(n)
        assert {i for a, b in w for i in range(a, b)} == set(range(n))
        assert all(a2 < b for (_, b), (a2, _) in itertools.pairwise(w))


def test_a_passage_of_half_a_window_lies_in_one_whole():
    size = toxicity.WINDOW // 2
    w = toxicity.windows(1000)
    assert all(any(a <= at and at + size <= b for a, b in w) for at in range(1000 - size + 1))


def test_toxic_words_are_learned():
    rng = random.Random(9)

    def text(bad):
        words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(5, 300))]
        for _ in range(bad):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron,", "trash"]))
        return " ".join(words)
    rows = [(text(2 * y), y) for y in (0, 1) * 200]
    net = toxicity.fit([t for t, _ in rows[:300]], [y for _, y in rows[:300]])
    score = toxicity.Scorer(net).score([t for t, _ in rows[300:]])
    assert np.mean((score >= 0.5) == [y for _, y in rows[300:]]) >= 0.95


@pytest.mark.parametrize("long_class", [0, 1])
def test_a_class_of_long_documents_is_learned(spark, long_class):
    rng = random.Random(10)

    def text(label):
        n = 2500 if label == long_class else 100
        words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 5))) for _ in range(n)]
        return " ".join(w if not label or k % 9 else rng.choice(["idiot", "moron,", "trash"]) for k, w in enumerate(words))
    rows = [(k, text(k % 2), k % 2) for k in range(160)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    chosen = toxicity.sample(docs, labels)
    assert {y for _, y in chosen} == {0, 1}
    texts = {t for _, t, _ in rows}
    for t, y in chosen:
        if y != long_class:
            assert t in texts
        else:
            assert len(t) == toxicity.SAMPLE_WINDOWS and all(len(w.split()) <= toxicity.WINDOW and any(w in x for x in texts) for w in t)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert np.mean([(scores[k] >= 0.5) == y for k, _, y in rows]) >= 0.95


def test_a_labelled_class_without_text_is_logged(caplog):
    assert toxicity.fit(["a b c", " "], [0, 1]) is None
    assert "every text will score 0" in caplog.text


# ---- op9


def test_beta_prior():
    a, b = quality.beta_prior(1000, 10, 100, 1000 * 0.01 + 4.0)
    assert np.isclose(a / (a + b), 0.1) and 1 <= a + b <= 1000
    assert quality.beta_prior(0, 0, 0, 0.0) == (0.5, 0.5)
    assert sum(quality.beta_prior(50, 5, 0, 0.0)) <= 1.1


def test_bad_host_goes_small_hosts_are_shrunk(spark):
    good = " ".join(f"word{i}" for i in range(60))
    bad = good + " ### $$$ %%% &&& *** ||| <<< >>>" * 3
    rows = [(i, bad if h == "spam" else good, h) for i, h in enumerate(["spam"] * 200 + ["a", "b", "c", "d"] * 100)]
    rows.append((9999, bad, "tiny"))
    out = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    kept = {r.doc_id: r.kept for r in out}
    assert not any(kept[i] for i in range(200)) and all(kept[i] for i in range(200, 600)) and kept[9999]
    assert not any(r.base_failed for r in out)


# ---- op10


@pytest.mark.parametrize("size", [10, 8_000_000])
def test_ids_and_text_are_the_librarys_for_any_chunk(spark, odd, size):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = bpe_words.decode(bpe_words.encode(odd, size=size)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, bpe_words.round_trip(odd, size=size).collect()))
    texts = {}
    for r in odd.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    assert len(rows) == odd.count()
    for r in rows:
        want = [(" ".join(map(str, e.ids)), tok.decode(e.ids, skip_special_tokens=False))
                for e in tok.encode_batch(texts[r.doc_id], add_special_tokens=False)]
        assert (r.ids_text, r.decoded) in want


def test_a_chunk_without_its_ids_fails():
    left = pd.DataFrame([("k", 2, ["1"], b"", b"")], columns=["chunk", "n_words", "doc_ids", "sizes", "numbers"])
    right = pd.DataFrame([], columns=["chunk", "range", "ids", "sizes"])
    with pytest.raises(ValueError, match="partitions"):
        bpe_words._assemble(left, right)


def test_worker_cache_starts_over():
    c = wordcodec.WordCodec(wordcodec.vocabulary_path(), cache_words=2)
    whole = c.tok.encode("one two three four", add_special_tokens=False).ids
    assert c.encode("one two three four").tolist() == whole and c.encode("four one").tolist() == [whole[3], whole[0]]
