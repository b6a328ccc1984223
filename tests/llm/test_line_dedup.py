import hashlib
from collections import Counter

from fixtures import DOCS, awkward, docs_of, nothing
from gaugeworks.llm.line_dedup import deduplicate_lines, drop_shared_lines


def key(line):
    line = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)


def brute(rows, min_docs):
    n = Counter()
    for _, text in rows:
        n.update({key(x) for x in (text or "").split("\n")})
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (key(x) and n[key(x)] >= min_docs)]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def digest(docs, min_docs=10):
    got = drop_shared_lines(docs, min_docs=min_docs).collect()
    return sorted(
        ((r.row.doc_id, r.lines.n_lines, r.lines.n_dropped, hashlib.sha256((r.lines.kept or "").encode()).hexdigest()) for r in got),
        key=str,
    )


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert digest(docs) == brute(rows, 10)
    assert digest(docs, 2) == brute(rows, 2)


def test_threshold_and_repeats_in_a_document(spark):
    nine = [(i, "nine\nx%d" % i) for i in range(9)] + [(50, "nine?\n" + "often\n" * 30)]
    docs = docs_of(spark, nine + [(60 + i, "TEN\n ten \nÉten") for i in range(10)])
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = digest(docs)
    assert got == brute(rows, 10)
    assert {g[2] for g in got if g[0] < 60} == {0} and {g[2] for g in got if g[0] >= 60} == {3}


def test_stage_keeps_columns_and_rows(spark):
    docs = awkward(spark)
    out = deduplicate_lines(docs)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == DOCS["n_chars"].dataType
    got = {r.doc_id: r for r in out.collect() if r.doc_id}
    assert got[1].text is None and got[2].text == "" and got[103].text.startswith("own text of 3")
    assert got[103].n_chars == len(got[103].text) and got[11].text.endswith("line 49")
    assert out.count() == docs.count()


def test_empty(spark):
    assert deduplicate_lines(nothing(spark)).count() == 0
