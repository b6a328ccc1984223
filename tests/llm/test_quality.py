"""Classifier (5) and rules (6)."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from fixtures import PROSE, awkward, docs_of, nothing
from gaugeworks.llm import boosting, crf, quality_rules
from gaugeworks.llm.quality_classifier import held_out, keep_good, op5_quality_classifier, score_quality, statistics
from gaugeworks.llm.quality_rules import apply_rules, base_counts, line_features, op6_quality_rules, spliced, train
from gaugeworks.llm.scan import TextScan, byte_slices
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.01"


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_trees_find_a_rule_and_match_a_plain_walk():
    r = np.random.default_rng(1)
    x = r.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    forest = boosting.fit(x[:2000], y[:2000], trees=40)
    score = forest.score(x[2000:])
    assert ((score > 0.5) == (y[2000:] == 1)).mean() > 0.97
    for row, s in zip(x[2000:2020], score):
        total = forest.base
        for f, t, v in zip(forest.feature, forest.threshold, forest.value):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > t[node] else 1)
            total += v[node - len(f)]
        assert s == pytest.approx(1 / (1 + np.exp(-total)))


def test_trees_without_both_classes():
    assert boosting.fit(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == pytest.approx([0.9, 0.9])
    assert boosting.fit(np.zeros((5, 3)), np.ones(5)).score(np.zeros((1, 3)))[0] > 0.9


def test_statistics_of_any_text():
    n = len(statistics(""))
    for text in (None, "", " ", "\n", "a", "é" * 500, PROSE * 2000):
        got = statistics(text)
        assert len(got) == n and np.isfinite(got).all()


def test_classifier_on_awkward_rows(spark):
    docs = awkward(spark)
    got = score_quality(docs, labels_of(spark, [(4, 1, 0), (4, None, 0), (None, 1, 1), (7, 0, 0), (999, 1, 0)]))
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert keep_good(docs, labels_of(spark, [])).count() == docs.count()
    assert keep_good(docs, labels_of(spark, [])).columns == docs.columns
    assert keep_good(nothing(spark), labels_of(spark, [])).count() == 0


def test_classifier_on_held_out_documents(spark):
    got = {r.doc_id: r for r in op5_quality_classifier(spark, FOLDER).collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert len(got) == docs
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [x for x in labels if got[x.doc_id].held_out]
    assert np.mean([got[x.doc_id].predicted == x.quality for x in held]) > 0.95
    assert np.mean([got[x.doc_id].predicted for x in held if x.quality == 1]) > 0.98


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, copies = set(), 0
    for line in text.split("\n"):
        copies += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in seen
        seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if n[w] > 1:
            inside.update(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(inside)


TEXTS = [
    "", None, " \n\n ", "a\nb\na\n\na", "x " * 30, " lead\ttail ", "é ü\x1c\n|é ü\n|", "a b c d e f g h " * 3, "\n", "ab",
    "a b c d e f g h i", "p q r s t u v w\np q r s t u v w", PROSE * 300, "\x85 \xa0 \u2003",
]


@pytest.mark.parametrize("together", [True, False])
def test_rule_counts(together):
    for batch in [TEXTS] if together else [[t] for t in TEXTS]:
        scan = TextScan(pa.array(batch, pa.string()))
        got = [base_counts(scan)[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        assert [tuple(int(c[i]) for c in got) for i in range(len(batch))] == [brute_counts(t) for t in batch]
        assert len(line_features(scan)) == sum(len((t or "").split("\n")) for t in batch)


def test_byte_slices_cover_all_rows():
    texts = pa.array(["a" * 10, None, "", "b" * 100, "c", "d"])
    assert list(byte_slices(texts, 12))[0][0] == 0
    covered = [i for a, b in byte_slices(texts, 12) for i in range(a, b)]
    assert covered == list(range(6))


def test_viterbi_and_fit_against_all_labelings():
    r = np.random.default_rng(3)
    x = r.normal(size=(6, 2))
    chain = crf.Chain(r.normal(size=2), r.normal(size=(2, 2)))
    bounds = np.array([4, 4, 5, 6])  # one empty sequence
    got = chain.viterbi(x, bounds)
    start = 0
    for end in bounds:
        best = max(
            ([int(b) for b in np.binary_repr(m, end - start)] for m in range(2 ** (end - start))) if end > start else [[]],
            key=lambda y: sum(x[start + i] @ chain.weights * v for i, v in enumerate(y))
            + sum(chain.moves[a, b] for a, b in zip(y, y[1:])),
        )
        assert got[start:end].tolist() == best
        start = end
    y = (x[:, 0] > 0).astype(int)
    assert crf.fit(x, y, bounds, rounds=300).viterbi(x, bounds).tolist() == y.tolist()


def test_rules_on_awkward_rows(spark):
    docs = awkward(spark)
    chain = train(docs, labels_of(spark, []))
    rows = apply_rules(docs, chain).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        if r.doc_id is not None:
            want = brute_counts(texts[r.doc_id])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
            failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
            assert r.base_failed == failed and r.kept == (not failed)  # no labels: every line is content
    assert apply_rules(nothing(spark), chain).count() == 0


def test_rules_keep_clean_documents(spark):
    got = {r.doc_id: r for r in op6_quality_rules(spark, FOLDER).collect()}
    labels = [x for x in spark.read.parquet(f"{FOLDER}/labels.parquet").collect() if not got[x.doc_id].base_failed]
    assert np.mean([got[x.doc_id].kept for x in labels if x.quality == 1]) > 0.98
    assert np.mean([got[x.doc_id].kept for x in labels if x.quality == 0]) < 0.2


def test_a_mixed_text_is_parted_by_lines(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    chain = train(docs, labels)
    assert chain.moves[0, 0] > chain.moves[0, 1] and chain.moves[1, 1] > chain.moves[1, 0]
    rows = labels.filter(held_out(F.col("doc_id"))).join(docs, "doc_id").filter("length(text) > 0").orderBy("doc_id").collect()
    # repeated texts are the base rule's, whatever the field says
    counts = [(r, *brute_counts(r.text)) for r in rows]
    good, bad = ([r.text for r, n, *_, repeated in counts if r.quality == q and 100 * repeated <= 30 * n] for q in (1, 0))
    pairs = list(zip(good, bad))
    assert len(pairs) > 5
    for texts, kinds in (([f"{g}\n{b}" for g, b in pairs], (1, 0)), ([f"{b}\n{g}" for g, b in pairs], (0, 1))):
        scan = TextScan(pa.array(texts))
        got = chain.viterbi(line_features(scan), scan.doc_line[1:])
        lines = [[t.count("\n") + 1 for t in (pair if kinds[0] else pair[::-1])] for pair in pairs]
        want = np.repeat(np.tile(kinds, len(pairs)), np.concatenate(lines))
        assert got[want == 1].mean() > 0.9 and got[want == 0].mean() < 0.15


def test_training_sequences():
    bad, good = [np.zeros((3, 1)), np.zeros((2, 1))], [np.ones((4, 1)), np.ones((0, 1)), np.ones((1, 1))]
    x, y = spliced(bad, good)
    assert [len(v) for v in x] == [3, 2, 4, 0, 1, 7, 2]
    assert all((a[:, 0] == b).all() for a, b in zip(x, y))


def test_training_takes_a_bounded_run_of_lines(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_rules, "fit", lambda x, y, bounds: seen.append((len(x), bounds.tolist())))
    docs = docs_of(spark, [(i, "a line of text\n" * (5000 if i < 2 else 3)) for i in range(8)])
    train(docs, labels_of(spark, [(i, i % 2, 0) for i in range(8)]))
    lines = np.diff([0, *seen[0][1]])
    assert seen[0][0] == lines.sum() and lines.max() <= 2 * quality_rules.MAX_TRAIN_LINES
