import random
import re

import pytest
from pyspark.sql import functions as F

from framewise.llm import near_dedup
from framewise.llm.components import components
from framewise.llm.near_dedup import near_duplicates


def shingle_sets(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size, percent=80):
    sets = [shingle_sets(r["text"], size) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if a["doc_id"] is None or b["doc_id"] is None or not sets[i] or not sets[j]:
                continue
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) or a["doc_id"] == b["doc_id"]:
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            least[find(i)] = min(least.get(find(i), r["doc_id"]), r["doc_id"])
    return sorted(((r["doc_id"], len(sets[i]), least.get(find(i)) if r["doc_id"] is not None else None, r["doc_id"] is None or least[find(i)] == r["doc_id"]) for i, r in enumerate(rows)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def edited(rnd, words, times):
    words = list(words)
    for _ in range(times):
        words[rnd.randrange(len(words))] = f"w{rnd.randrange(1000)}"
    return " ".join(words)


def test_pages_of_one_template_are_hardly_compared():
    """1,500 texts, half of each a template: as many comparisons as there are similar pairs, not a million."""
    rnd = random.Random(1)
    template = " ".join(f"t{i}" for i in range(120))
    own = [" ".join(f"w{rnd.randrange(100_000)}" for _ in range(120)) for _ in range(1500)]
    # Some pages come twice, with one word changed.
    own[1400:] = [edited(rnd, o.split(), 1) for o in own[:100]]
    sets = [near_dedup.shingle_set(f"{template} {o}", 5) for o in own]
    pairs = {(min(i, int(j)), max(i, int(j))) for i, found in near_dedup.possible_pairs(sets, sets, 80) for j in found if i != j}
    similar = {p for p in pairs if near_dedup.linked(sets[p[0]], sets[p[1]], 80)}
    assert len(pairs) < 10 * len(sets) and similar == {(i, 1400 + i) for i in range(100)}


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_possible_pairs_hold_all_similar_ones(percent):
    rnd = random.Random(percent)
    texts = []
    for _ in range(12):
        words = [f"w{rnd.randrange(30)}" for _ in range(rnd.choice([1, 2, 5, 9, 30]))]
        texts += [edited(rnd, words, rnd.choice([0, 1, 2])) for _ in range(8)]
    sets = [near_dedup.shingle_set(t, 2) for t in texts]
    found = {i: set(map(int, js)) for i, js in near_dedup.possible_pairs(sets, sets[::-1], percent)}
    for i, a in enumerate(sets):
        assert {len(sets) - 1 - j for j, b in enumerate(sets) if near_dedup.linked(a, b, percent)} <= found[i]


@pytest.mark.parametrize("size", [2, 5])
def test_against_brute_force(docs_of, size):
    rnd = random.Random(size)
    texts = []
    for _ in range(25):
        words = [f"w{rnd.randrange(400)}" for _ in range(rnd.choice([3, 8, 30, 80]))]
        texts += [edited(rnd, words, rnd.choice([0, 1, 1, 2, 4])) for _ in range(rnd.choice([1, 2, 6, 12]))]
    texts += ["w1", "W1 ", "w1 w2", None, "", "a b c d", "a b c d e", "a b c d e f"]
    docs = docs_of(texts).orderBy(F.rand(1))
    assert found(near_duplicates(docs, size=size)) == brute(docs.collect(), size)


def test_large_group_of_near_copies_with_chains(docs_of, monkeypatch):
    """Small blocks, so that buckets are split; edits add up, so that many pairs aren't linked directly."""
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(near_dedup, "BLOCK_PAIRS", 50)
    rnd, texts = random.Random(9), []
    words = [f"v{i}" for i in range(60)]
    for _ in range(120):
        words[rnd.randrange(60)] = f"v{rnd.randrange(1000)}"
        texts.append(" ".join(words))
    docs = docs_of([*texts, *[texts[0]] * 60])
    assert found(near_duplicates(docs, size=2)) == brute(docs.collect(), 2)


def test_odd_texts_and_columns(odd_docs):
    clash = odd_docs.withColumns({"node": F.lit(1), "band": F.lit(2), "values": F.lit(3), "kept": F.lit(4)})
    assert found(near_duplicates(clash)) == brute(odd_docs.collect(), 5)
    assert near_duplicates(clash.limit(0)).collect() == []


def test_components_of_long_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5), (3000, 2999)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {i: 0 for i in range(201)} | {i: 1000 for i in range(1000, 1200)} | {2999: 2999, 3000: 2999}
    assert {r["node"]: r["component"] for r in rows} == want and len(rows) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_signatures_estimate_similarity():
    rnd = random.Random(4)
    a = " ".join(f"x{rnd.randrange(10**6)}" for _ in range(900))
    b = edited(rnd, a.split(), 60)
    one, two = (near_dedup.shingle_set(t, 2) for t in (a, b))
    common = len(set(one.tolist()) & set(two.tolist()))
    true = common / (len(one) + len(two) - common)
    guess = (near_dedup.signature(one) == near_dedup.signature(two)).mean()
    assert abs(guess - true) < 0.12
