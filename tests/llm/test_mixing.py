import hashlib
import math
from collections import Counter, defaultdict

import regex
from pyspark.sql import functions as F

from framewise.llm.mixing import GRID, mix_sources, source_weights


def tokens(text):
    return max(1, len(regex.findall(r"\p{L}+|\p{N}+|[^\x09-\x0D\x20\p{L}\p{N}]", text or "")))


def brute_weights(rows, entropy, repeats, budget=None):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += tokens(r["text"])
    total, n = sum(sizes.values()), len(sizes)
    share = {s: t / total for s, t in sizes.items()}

    def weights(a):
        z = sum(p**a for p in share.values())
        return {s: p**a / z for s, p in share.items()}

    def level(a):
        return -sum(w * math.log(w) for w in weights(a).values()) / math.log(n) if n > 1 else 1.0

    parts = range(GRID + 1)
    flat = max(p for p in parts if level(p / GRID) >= entropy - 1e-12)
    ratio = max(share.values()) / min(share.values())
    limit = min(p for p in parts if ratio ** (1 - p / GRID) <= repeats + 1e-12)
    w = weights(max(flat, limit) / GRID)
    length = budget or max(sizes[s] / w[s] for s in sizes)
    return {s: (sizes[s], round(length * w[s]) if budget else max(sizes[s], round(length * w[s]))) for s in sizes}


def brute_mix(rows, **options):
    budgets = brute_weights(rows, **options)
    md5 = lambda *x: hashlib.md5("-".join(map(str, x)).encode()).hexdigest()
    name = lambda x: "~" if x is None else x
    blocks = defaultdict(list)
    for r in rows:
        blocks[r["source"], int(md5(0, name(r["doc_id"]))[:3], 16)].append(r)
    out = []
    for source, (size, budget) in budgets.items():
        for epoch in range((budget - 1) // size + 1 if budget > 0 else 0):
            at = epoch * size
            for block in sorted((b for s, b in blocks if s == source), key=lambda b: md5(0, name(source), epoch, b)):
                content = blocks[source, block]
                filled, room, upto = sum(tokens(r["text"]) for r in content), budget - at, 0
                for r in sorted(content, key=lambda r: (md5(0, name(r["doc_id"]), epoch), r["doc_id"] or 0)):
                    upto += tokens(r["text"])
                    if room > 0 and (room >= filled or upto <= room):
                        out.append((r["doc_id"], source, epoch, block))
                at += filled
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "source", "epoch", "block").collect()), key=str)


def corpus(spark):
    rows = [(i, "word " * (i % 37), ["big", "big", "big", "big", "mid", "mid", "small"][i % 7] if i % 50 else None) for i in range(3000)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_against_brute_force(spark):
    docs = corpus(spark)
    rows = docs.collect()
    for options in ({"entropy": 0.95, "repeats": 50.0}, {"entropy": 0.99, "repeats": 3.0}, {"entropy": 0.9, "repeats": 9.0, "budget": 20_000}, {"entropy": 1.0, "repeats": 1.0}):
        assert found(mix_sources(docs, **options)) == brute_mix(rows, **options)


def test_every_document_is_drawn_and_weights_are_met(spark):
    docs = corpus(spark)
    weights = {r["_source"]: r for r in source_weights(docs, entropy=0.97, repeats=20.0).collect()}
    drawn = mix_sources(docs, entropy=0.97, repeats=20.0)
    assert {r["doc_id"] for r in drawn.collect()} == set(range(3000))
    total = Counter()
    for r in drawn.collect():
        total[r["source"]] += tokens(r["text"])
    whole = sum(total.values())
    for source, r in weights.items():
        assert abs(total[source] / whole - r["weight"]) < 0.01
        assert 0 <= r["budget"] - total[source] < 40


def test_place_orders_each_source(spark):
    rows = mix_sources(corpus(spark), repeats=20.0).collect()
    for r in rows:
        assert 0 <= r["place"] < 1
    for source in {r["source"] for r in rows}:
        own = sorted((r["place"], r["epoch"]) for r in rows if r["source"] == source)
        assert [e for _, e in own] == sorted(e for _, e in own)


def test_odd_texts_and_columns(odd_docs):
    clash = odd_docs.withColumns({"Epoch": F.lit("x"), "_block": F.lit(1), "budget": F.lit(2), "tokens": F.lit(3), "_s": F.lit(4)})
    mixed = mix_sources(clash)
    assert mixed.columns == ["doc_id", "text", "lang", "source", "_block", "budget", "tokens", "_s", "epoch", "block", "place"]
    assert {r["doc_id"] for r in mixed.collect()} == {r["doc_id"] for r in odd_docs.collect()}
    assert mix_sources(clash.limit(0)).collect() == []
    assert mix_sources(odd_docs, tokens=F.lit(0)).collect() == []
