import re
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
import xxhash
from fixtures import PROSE, awkward, docs_of, nothing
from gaugeworks.llm import simhash
from gaugeworks.llm.components import component_roots
from gaugeworks.llm.simhash import covering, fingerprint, keep_one_per_group, near_groups, near_links


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    parts = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(fps, threshold):
    """Least member of each connected set, over all pairs."""
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in combinations(sorted(set(fps)), 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= threshold:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


@pytest.mark.parametrize("text", [None, "", " \n", "A b", "É Ü É ü a B c", "x " * 50, PROSE * 3, "a\x1cb c d e"])
def test_fingerprints(text):
    assert fingerprint(text) & (2**64 - 1) == brute(text)


@pytest.mark.parametrize("pieces, threshold", [(3, 4), (2, 4), (4, 4), (3, 2), (1, 1)])
def test_every_value_is_near_its_anchor_and_meets_all_close_ones(pieces, threshold):
    r = np.random.default_rng(pieces)
    top = 0
    for low, width, code, masks in covering(pieces, threshold):
        assert low == top
        top += width
        radius = threshold // pieces
        if width > 24:
            continue
        for _ in range(200):
            a = np.uint64(r.integers(0, 2**width))
            b = a
            for i in r.choice(width, r.integers(0, radius + 1), replace=False):
                b ^= np.uint64(1 << int(i))
            home = a ^ masks[int(simhash._syndromes(np.array([a]), code)[0])][0]
            assert int(home ^ a).bit_count() <= 1
            visited = b ^ masks[int(simhash._syndromes(np.array([b]), code)[0])]
            assert home in visited
    assert top == 64


def near_copies(n, seed=0):
    r = np.random.default_rng(seed)
    base = [int(x) for x in r.integers(0, 2**63, n)]
    out = list(base)
    for f in base[: n // 2]:
        for _ in range(4):
            for i in r.choice(64, r.integers(1, 7), replace=False):
                f ^= 1 << int(i)
            out.append(f)
    return out


@pytest.mark.parametrize("slice_rows, bucket_rows", [(4096, 150_000), (1, 20)])
def test_links_connect_as_all_pairs_do(spark, monkeypatch, slice_rows, bucket_rows):
    monkeypatch.setattr(simhash, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(simhash, "BUCKET_ROWS", bucket_rows)
    fps = near_copies(60) + [2**64 - 1 - (1 << i) for i in range(12)] + [0, 1, 31, 2**64 - 1]
    signed = np.array(sorted(set(fps)), dtype=np.uint64).view(np.int64).tolist()
    links = near_links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    want = groups_of(signed, 4)
    got = {f: f for f in signed} | {r.node: r.root for r in component_roots(links).collect()}
    assert got == want
    for r in links.collect():
        assert want[r.a] == want[r.b]


def test_a_group_gives_few_links():
    rows = pd.DataFrame({"part": [1] * 400, "fp": list(range(200)) * 2, "home": [True] * 200 + [False] * 200})
    assert len(simhash._compare(64)(rows)) == 199


def test_long_chains_have_one_root(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1000), (2000, 2001), (2001, 2000)]
    got = {r.node: r.root for r in component_roots(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {2001: 2000}


def test_groups_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, brute(r.text)) for r in docs.select("doc_id", "text").collect()]
    root = groups_of([f for _, f in rows], 4)
    least = {}
    for doc_id, f in rows:
        if doc_id is not None:
            least[root[f]] = min(doc_id, least.get(root[f], doc_id))
    want = sorted(((i, f, least.get(root[f])) for i, f in rows), key=str)
    got = sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in near_groups(docs).collect()), key=str)
    assert got == want
    kept = keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert len(kept.collect()) == len(set(root.values()))
    assert {1, 4, 7, 8, 9} <= {r.doc_id for r in kept.collect()}


def test_one_of_repeated_rows_stays(spark):
    docs = docs_of(spark, [(5, "same text")] * 7 + [(5, "other words here")] * 3 + [(None, "no id")] * 2)
    assert sorted(str(r.doc_id) + r.text for r in keep_one_per_group(docs).collect()) == ["5other words here", "5same text", "Noneno id"]


def test_empty(spark):
    assert near_groups(nothing(spark)).count() == 0
    assert keep_one_per_group(nothing(spark)).count() == 0


def test_one_row_stays_whatever_its_columns_are(spark):
    from pyspark.sql import functions as F

    docs = docs_of(spark, [(1, PROSE), (1, PROSE), (2, PROSE), (None, PROSE), (3, "another text of its own")])
    docs = docs.withColumns({"tags": F.create_map(F.lit("a"), F.lit(1)), "list": F.array(F.lit(None).cast("int"))})
    kept = keep_one_per_group(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
