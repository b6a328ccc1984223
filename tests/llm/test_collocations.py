import random
import re
from collections import Counter, defaultdict

import pytest
from fixtures import awkward, docs_of, nothing

from gaugeworks.llm import collocations as c


def brute_counts(rows):
    counts = defaultdict(Counter)
    for lang, text in rows:
        lowered = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for k in range(1, 5):
                counts["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return counts


def brute(rows, min_count, top):
    out = []
    for lang, f in brute_counts(rows).items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        found = {p: v for p, v in f.items() if len(p) > 1 and v >= min_count}
        kept = []
        for p, a in found.items():
            if any(
                len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in found.items()
            ):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def result(docs, min_count, top=c.TOP, **options):
    return sorted(tuple(r) for r in c.best_phrases(c.collocations(docs, min_count=min_count, **options), top).collect())


def pairs(docs):
    return [(r.lang, r.text) for r in docs.select("lang", "text").collect()]


def test_awkward_rows(spark):
    docs = awkward(spark)
    want = brute(pairs(docs), 3, 2000)
    assert want and result(docs, 3) == want


def made_up(seed, n):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "A", "ab", "é", "É", "x\0", "\0", "a\x01b", "b\x1c", "\U0010ffff", "the", "of"]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary[: rng.randint(1, 13)]) for _ in range(rng.randint(0, 30))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", "?!"]) for w in words)
        rows.append((i // 2, text, rng.choice(["en", "en", "de", None, "und", ""]), "s"))
    return rows


@pytest.mark.parametrize("range_rows", [50_000, 40, 7])
def test_made_up_texts_in_many_ranges(spark, range_rows, monkeypatch):
    monkeypatch.setattr(c, "SLICE_BYTES", 700)
    docs = docs_of(spark, made_up(range_rows, 400))
    want = brute(pairs(docs), 4, 50)
    assert len(want) > 100 and result(docs, 4, 50, range_rows=range_rows) == want


def test_full_filter_changes_nothing(spark, monkeypatch):
    docs = docs_of(spark, made_up(3, 200))
    monkeypatch.setattr(c, "MAX_BITS", 1 << 10)
    monkeypatch.setattr(c, "_has", lambda bits, h: h == h)
    assert result(docs, 4) == brute(pairs(docs), 4, 2000)


def test_cuts_ties_and_huge_counts(spark):
    big = 2**62
    n = {"a": big, "b": big - 1, "c": 7, "a b": big - 2, "b c": 7, "a b c": 7}
    counts = spark.createDataFrame([("en", p, v) for p, v in n.items()], "lang string, phrase string, n long")
    totals = spark.createDataFrame([("en", big)], "lang string, n long")
    got = {r.phrase: r for r in c.score_phrases(counts, totals).collect()}
    assert got["a b"].score == 2_000_000 * (big - 2) // (2 * big - 1)
    assert got["b c"].score == 0 and (got["b c"].l, got["b c"].r) == (big - 1, 7) and got["b c"].within
    # both cuts of "a b c" are 0 after flooring, so the first one counts
    assert (got["a b c"].l, got["a b c"].r) == (big, 7) and not got["a b c"].within and not got["a b"].within


def test_threshold_is_inclusive(spark):
    docs = docs_of(spark, [(i, "one two") for i in range(29)])
    assert result(docs, 30) == []
    docs = docs_of(spark, [(i, "one two. Three") for i in range(30)])
    assert result(docs, 30) == [("en", 1, "one two", 30, 30, 30, 90, 1_000_000)]
    covered = docs_of(spark, [(i, "one two three" if i < 80 else "one two") for i in range(100)])
    assert [r[2] for r in result(covered, 30)] == ["one two three"]
    covered = docs_of(spark, [(i, "one two three" if i < 79 else "one two") for i in range(100)])
    assert [r[2] for r in result(covered, 30)] == ["one two", "one two three"]


def test_borders_and_extensions():
    borders = [("en", "a", "b"), ("en", "a", "c"), ("en", "b")]
    assert c._places(("en", "a"), borders) == [0, 1, 2]
    assert c._places(("en", "a", "b"), borders) == [1]
    assert c._places(("en", "b"), borders) == [3]
    assert c._places(("de", "a"), borders) == [0]


def test_empty(spark):
    assert c.collocations(nothing(spark)).count() == 0
    assert result(docs_of(spark, [(1, None), (2, ""), (3, " .,\n")]), 1) == []
