import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from fixtures import awkward, docs_of, nothing
from gaugeworks.llm import spelling as sp
from gaugeworks.llm.common import table

FOLDER = "/root/testdata/sf0.001"


def brute_words(rows, min_chars=6, min_count=5, one_in=199):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= min_chars and c >= min_count}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def brute(words, ratio=5):
    # words with a letter taken out meet there; all that meet are compared
    met = {}
    for w in words:
        for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            met.setdefault(v, set()).add(w)
    others = {w: set() for w in words}
    for group in met.values():
        for a in group:
            others[a] |= {b for b in group if near(a, b)}
    form = {}
    for w, found in others.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(others[w]), None if form[w] is None else words[form[w]]))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_awkward_rows(spark):
    docs = awkward(spark)
    want = brute_words(pairs(docs), one_in=3)
    assert want and {r.word: r.n for r in sp.count_words(docs, one_in=3).collect()} == want
    assert result(sp.spelling_variants(sp.count_words(docs))) == brute(brute_words(pairs(docs)))


def test_runs_and_checksums_of_odd_letters(spark):
    long = "Abcdéfg" * 30
    text = f"École ÀÉÎÕÜ×÷ÿ naïveté_maïsons œuvre{long}œ ßßßßßßß x1234567 Straßeİstanbul ABCDEFG {long}"
    docs = docs_of(spark, [(i, text) for i in range(40)] + [(None, text)])
    for one_in in (1, 2, 199):
        got = {r.word: r.n for r in sp.count_words(docs, one_in=one_in).collect()}
        assert got == brute_words(pairs(docs), one_in=one_in) and got


def test_given_documents(spark):
    docs = table(spark, FOLDER, "documents")
    words = brute_words(pairs(docs), min_count=2)
    stored = sp.count_words(docs, min_count=2)
    assert {r.word: r.n for r in stored.collect()} == words
    want = brute(words)
    assert sum(r[1] is not None for r in want) > 50 and result(sp.spelling_variants(stored)) == want


def made_up(seed, n, letters):
    rng, words = random.Random(seed), {}
    for _ in range(n):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(6, 11)))
        for _ in range(rng.randint(1, 6)):
            words[w] = 5 * rng.choice([1, 1, 2, 5, 25, 125, 700])
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]])
            if len(w) < 6:
                break
    return words


@pytest.mark.parametrize("letters, longest, share", [("ab", 5, 0.001), ("abcé", 4, 0.0005), ("abcdefgÿ", 3, 0.002), ("ab", 6, 0.0)])
def test_no_near_word_is_missed(spark, letters, longest, share, monkeypatch):
    monkeypatch.setattr(sp, "LONGEST", longest)
    words = made_up(len(letters) + longest, 250, letters)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {(r.word, r.other) for r in sp.near_words(df, longest, share).collect()}
    want = {(a, b) for a in words for b in words if near(a, b)}
    assert got == want and len(got) > 100
    assert result(sp.spelling_variants(df)) == brute(words)


def test_bound_holds_for_every_edit():
    rng = random.Random(7)
    for seed in range(6):
        words = made_up(seed, 120, "abc")
        counts = Counter()
        for w in words:
            s = f"^{w}$"
            for q in range(2, 6):
                counts.update(s[i : i + q] for i in range(len(s) - q + 1))
        grams = sp.GramDictionary({g: n for g, n in counts.items() if n >= (1, 5, 20)[seed % 3]}, 2, 5)
        for w in rng.sample(sorted(words), 40):
            s = f"^{w}$"
            cut = grams.cut(s)
            bound = grams.touched(s, cut)
            for i in range(len(w) + 1):
                for x in {w[:i] + c + w[i:] for c in "abcz"} | {w[:i] + c + w[i + 1 :] for c in "abcz"} | {w[:i] + w[i + 1 :]}:
                    t = f"^{x}$"
                    common = Counter(s[p:e] for p, e in cut) & Counter(t[p:e] for p, e in grams.cut(t))
                    assert sum(common.values()) >= len(cut) - bound


def test_chain_of_forms(spark):
    words = {"aaaaaaa"[: 6] + "b" * i: 5**(i + 1) for i in range(12)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = result(sp.spelling_variants(df))
    assert got == brute(words) and {r[2] for r in got} == {max(words, key=len)}


def test_checksum_tables():
    tables = sp._crc_tables()
    scan = sp.RunScan(pa.array(["abcdef ghijklm", "abcdef"]), 6)
    assert sp._checksums([12, None], scan, tables).tolist() == [zlib.crc32(b) for b in (b"12:abcdef", b"12:ghijklm", b":abcdef")]


def test_empty(spark):
    assert sp.spelling_variants(sp.count_words(nothing(spark))).count() == 0
    assert sp.count_words(docs_of(spark, [(1, None), (2, "")])).count() == 0
