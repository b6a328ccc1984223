import zlib

from fixtures import awkward, docs_of, nothing
from gaugeworks.llm.sharding import byte_shards


def check(docs, shards):
    rows = docs.select("doc_id", "text").collect()
    got = byte_shards(docs, shards).collect()
    assert len(got) == len(rows)
    want = []
    for r in rows:
        raw = (r.text or "").encode()
        want.append((r.doc_id, len(raw) + 16, zlib.crc32(raw)))
    order = lambda x: (x[0] is not None, x[0] or 0, x[2], x[1])
    want.sort(key=order)
    assert sorted([(r.doc_id, r["size"], r.text_crc32) for r in got], key=order) == want
    total, before, slots, place = sum(w[1] for w in want), 0, {}, []
    for w in want:
        s = min((2 * before + w[1]) * shards // (2 * total), shards - 1)
        place.append((*w, s, slots.setdefault(s, 0)))
        slots[s] += 1
        before += w[1]
    key = lambda x: (x[0] is not None, *[v or 0 for v in x])
    assert sorted([(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got], key=key) == sorted(place, key=key)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    return place


def test_awkward_rows(spark):
    check(awkward(spark), 5)


def test_shards_are_nearly_equal(spark):
    place = check(docs_of(spark, [(i * 7 % 1000, "x" * (i % 90)) for i in range(1000)]), 40)
    sizes = [sum(p[1] for p in place if p[3] == s) for s in range(40)]
    assert max(sizes) - min(sizes) <= 2 * (89 + 16)


def test_repeated_rows_get_their_own_slots(spark):
    check(docs_of(spark, [(1, "same")] * 300 + [(None, None)] * 20), 7)


def test_empty(spark):
    assert byte_shards(nothing(spark)).count() == 0
