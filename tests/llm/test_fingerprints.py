import hashlib
import random

import pytest
from pyspark.sql import functions as F

from framewise.llm.fingerprints import compare_edits, containment, fingerprint, fingerprint_of, likeness, merged


def shingles(text, size=8):
    return {text[i : i + size] for i in range(max(1, len(text) - size + 1))} if text else set()


def brute(rows):
    ordered = sorted(((r["doc_id"], r["text"] or "") for r in rows if r["doc_id"] is not None), key=lambda r: r)
    pairs = [(k, t, ordered[(i + 1) % len(ordered)][1]) for i, (k, t) in enumerate(ordered)]
    pairs += [(None, r["text"] or "", "") for r in rows if r["doc_id"] is None]
    out = []
    for key, text, after in pairs:
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        a, b, c = map(fingerprint_of, (text, edited, after))
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, likeness(a, b), likeness(a, c)))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_brute_force(spark, docs_of):
    rnd = random.Random(1)
    docs = docs_of(["".join(rnd.choice("abc é\n") for _ in range(rnd.randrange(300))) for _ in range(200)], rnd.sample(range(10**12), 200)).repartition(7)
    for partitions in (1, 4, 50):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            assert found(compare_edits(docs)) == brute(docs.collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_odd_texts(odd_docs):
    clash = odd_docs.withColumns({"k": F.lit("x"), "range": F.lit(1), "key": F.lit(2)})
    assert found(compare_edits(clash)) == brute(odd_docs.collect())
    assert compare_edits(clash.limit(0)).collect() == []
    one = clash.where("doc_id = 8")
    assert found(compare_edits(one)) == brute(one.collect())


def test_equal_keys_and_no_keys(docs_of):
    docs = docs_of(["b text", "a text", "c text", "b text", "zz"], [5, 5, 5, 5, 1])
    assert found(compare_edits(docs)) == brute(docs.collect())
    assert {r["near_next"] for r in compare_edits(docs_of(["a", None], [None, None])).collect()} == {0.0, 1.0}


def test_likeness_estimates_shared_shingles():
    rnd = random.Random(2)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(20_000))
    edited = text[:15_000] + "".join(rnd.choice("abcdefgh ") for _ in range(5_000))
    a, b = shingles(text), shingles(edited)
    assert likeness(fingerprint_of(text), fingerprint_of(edited)) == pytest.approx(len(a & b) / len(a | b), abs=0.04)
    part = text[4_000:6_000]
    assert containment(fingerprint_of(part), fingerprint_of(text)) == 1.0
    assert likeness(fingerprint_of(part), fingerprint_of(text)) == pytest.approx(0.1, abs=0.03)
    union = merged(fingerprint_of(text), fingerprint_of(edited))
    assert containment(fingerprint_of(edited), union) == 1.0


def test_column(odd_docs):
    rows = fingerprint(odd_docs.withColumn("Fingerprint", F.lit(1))).collect()
    assert all(r["fingerprint"] == fingerprint_of(r["text"] or "") for r in rows)
    assert len({r["fingerprint"] for r in rows if r["text"] in (None, "")}) == 1
