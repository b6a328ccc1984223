import zlib

import numpy as np
import pytest
from fixtures import awkward, docs_of, nothing
from gaugeworks.llm import lm_scoring
from gaugeworks.llm import window_model as model
from gaugeworks.llm.lm_scoring import MASKED_SHARE, ROUNDS, encoded, masked_tokens, score_documents, train, vocabulary, word_counts
from pyspark.sql import functions as F

NET = model.SMALL


def plain_probability(flat, ids, i, start, end):
    """Log-probability of token i, one token at a time."""
    p = model.views(flat.astype(np.float64))
    total = p["hidden"].copy()
    for row, offset in enumerate(model.OFFSETS):
        j = i + offset
        total = total + p["inputs"][row][ids[j] if start <= j < end else NET.edge]
    h = np.tanh(total)
    c, m = divmod(int(ids[i]), NET.members)
    upper, lower = p["classes"] @ h + p["class_bias"], p["members"][c] @ h + p["member_bias"][c]
    return upper[c] - np.log(np.exp(upper).sum()) + lower[m] - np.log(np.exp(lower).sum())


def test_probabilities_against_a_plain_version():
    r = np.random.default_rng(0)
    flat = model.initial(r.integers(0, 50, NET.vocabulary).astype(float))
    ids, ends = r.integers(0, NET.vocabulary, 40), np.array([7, 7, 8, 40])
    got = model.log_probabilities(flat, ids, model.contexts(ids, ends))
    start = 0
    for end in ends:
        for i in range(start, end):
            assert got[i] == pytest.approx(plain_probability(flat, ids, i, start, end), abs=1e-4)
        start = end


def test_large_weights_are_shifted_into_range():
    r = np.random.default_rng(4)
    flat = model.initial(np.ones(NET.vocabulary))
    for name in ("classes", "members"):
        model.views(flat)[name][...] *= 200
    ids = r.integers(0, NET.vocabulary, 3000)
    near = model.contexts(ids, np.array([3000]))
    got = model.log_probabilities(flat, ids, near)
    for i in (0, 5, 2999):
        assert got[i] == pytest.approx(plain_probability(flat, ids, i, 0, 3000), rel=1e-3)
    learner = model.Learner(flat)
    learner.step(ids, near)
    assert np.isfinite(learner.flat).all()


def test_gradient_lowers_the_loss_it_belongs_to():
    r = np.random.default_rng(1)
    ids = np.tile(np.array([3, 70, 900, 4000]), 300)
    near = model.contexts(ids, np.array([len(ids)]))
    flat = model.initial(np.ones(NET.vocabulary))
    learner = model.Learner(flat)
    grads = model.views(np.zeros_like(flat))
    for name, part, g in learner.gradient(ids, near):
        grads[name][part] += g
    learner.step(ids, near)
    for name, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        moved = []
        for step in (1e-2, -1e-2):
            other = flat.copy()
            model.views(other)[name][at] += step
            moved.append(-model.log_probabilities(other, ids, near).mean())
        assert (moved[0] - moved[1]) / 2e-2 == pytest.approx(g[at], rel=0.05, abs=1e-3)
    for _ in range(60):
        some = r.choice(len(ids), 256)
        learner.step(ids[some], near[:, some])
    before = model.log_probabilities(flat, ids, near).mean()
    assert model.log_probabilities(learner.flat, ids, near).mean() > before + 4


def test_vocabulary_grows_with_the_corpus():
    assert model.Net.for_tokens(0) == model.Net.for_tokens(200_000_000) == NET
    sizes = [model.Net.for_tokens(10**k) for k in (9, 10, 11, 14)]
    assert [s.vocabulary for s in sizes] == [1 << 13, 1 << 15, 1 << 17, 1 << 22]
    assert all(model.Net.of_ids(s.vocabulary) == s and s.classes in (s.members, 2 * s.members) for s in sizes)


@pytest.mark.parametrize("least", [1 << 13, 1 << 17])
def test_larger_vocabularies_score_the_same_way(spark, monkeypatch, least):
    monkeypatch.setattr(model, "LEAST_IDS", least)
    words = [f"w{i}" for i in range(9000)]
    docs = docs_of(spark, [(i, " ".join(words[(i * 307 + 6 * k) % 9000] for k in range(1500))) for i in range(30)])
    known, n = vocabulary(word_counts(docs))
    assert len(n) == least and len(known) == min(9000, least - least // 16) and n.sum() == 30 * 1500
    net, got = model.Net.of_ids(least), {r.doc_id: r for r in score_documents(docs).collect()}
    assert len(got) == 30 and all(r.n_tokens == 1500 and np.isfinite(r.log_likelihood) for r in got.values())
    flat = train(encoded(docs, known, "doc_id", "text", least).select("ids"), n)
    counts = {r.word: r.n for r in word_counts(docs).collect()}
    first_rare = least - least // 16
    of = lambda w: known.get(w, first_rare + zlib.crc32(w.encode()) % (least // 16))
    text = docs.filter("doc_id = 3").first().text.split()
    ids = np.array([of(w) for w in text])
    logs = model.log_probabilities(flat, ids, model.contexts(ids, np.array([len(ids)]), net), net)
    rare = [(w, i) for w, i in zip(text, ids) if i >= first_rare]
    # an end-to-end sum by hand: the network's, and each rare word's share of its id
    assert got[3].log_likelihood == pytest.approx(logs.sum() + sum(np.log(counts[w] / n[i]) for w, i in rare), rel=1e-3)


def test_counts_cover_all_words(spark):
    docs = docs_of(spark, [(1, "A b\na"), (2, None), (3, " b\tc ")])
    assert {r.word: r.n for r in word_counts(docs).collect()} == {"a": 2, "b": 2, "c": 1}
    known, n = vocabulary(word_counts(docs))
    assert known == {"a": 0, "b": 1, "c": 2} and n.sum() == 5
    ids = {r.doc_id: np.frombuffer(r.ids, "<u2").tolist() for r in encoded(docs, known, "doc_id", "text").collect()}
    assert ids == {1: [0, 1, 0], 2: [], 3: [1, 2]}


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = score_documents(docs).collect()
    assert len(rows) == docs.count()
    got = {r.doc_id: r for r in rows if r.doc_id is not None}
    for i in (1, 2, 3):
        assert (got[i].n_tokens, got[i].log_likelihood, got[i].mean_log_likelihood) == (0, 0.0, None)
    assert got[4].log_likelihood == pytest.approx(got[5].log_likelihood) == pytest.approx(got[6].log_likelihood)
    assert got[7].n_tokens == 60_000 and got[8].n_tokens == 1
    assert all(r.log_likelihood < 0 for r in rows if r.n_tokens)
    assert score_documents(nothing(spark)).count() == 0


def test_training_prefers_the_order_of_the_corpus(spark):
    r = np.random.default_rng(5)
    names = [f"w{i}" for i in range(40)]
    ordered = [(i, " ".join(names[(s + k) % 40] for k in range(60))) for i, s in enumerate(r.integers(0, 40, 400))]
    mixed = [(1000 + i, " ".join(r.permutation(t.split()))) for i, (_, t) in enumerate(ordered[:20])]
    got = score_documents(docs_of(spark, ordered + mixed), rounds=3, masked_share=0.9).withColumn("mixed", F.col("doc_id") >= 1000)
    mean = {x.mixed: x.m for x in got.groupBy("mixed").agg(F.avg("mean_log_likelihood").alias("m")).collect()}
    assert mean[False] > mean[True] + 0.3


def test_the_passes_learn_from_every_token():
    ids, ends = np.random.default_rng(2).integers(0, 4096, 5000), np.array([0, 700, 701, 5000])
    times = sum(masked_tokens(ids, ends, r / ROUNDS, MASKED_SHARE).astype(int) for r in range(ROUNDS))
    assert (times == 1).all()
    assert 2300 < masked_tokens(ids, ends, 0, MASKED_SHARE).sum() < 2700


@pytest.mark.parametrize("named", [1 << 16, 1, 0])
def test_rare_words_of_one_id_keep_their_own_share(spark, monkeypatch, named):
    monkeypatch.setattr(lm_scoring, "NAMED", named)  # the others are joined
    common = [f"c{i}" for i in range(3840)]
    rare = [w for w in (f"r{i}" for i in range(4000)) if zlib.crc32(w.encode()) % 256 == 7][:2]
    texts = [" ".join(common)] * 9 + [f"c0 {rare[0]} c1", f"c0 {rare[1]} c1", rare[0], f"c0 {rare[1]} {rare[1]} c1 " * 2]
    got = {r.doc_id: r for r in score_documents(docs_of(spark, list(enumerate(texts)))).collect()}
    assert len(got) == len(texts) and got[12].n_tokens == 8
    assert got[10].log_likelihood - got[9].log_likelihood == pytest.approx(np.log(5 / 2), abs=1e-4)
    known, n = vocabulary(word_counts(docs_of(spark, list(enumerate(texts)))))
    assert set(known) == set(common) and n[-256 + 7] == 7 and n.sum() == 9 * 3840 + 4 + 4 + 7
