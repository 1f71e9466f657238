"""The whole pipeline against its stages done plainly, one after the other, on a small corpus."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from framewise.llm import registry
from framewise.llm.encoding import Encoder
from framewise.llm.toxicity import train
from tests.llm import test_line_dedup, test_mixing, test_near_dedup, test_tokens, test_toxicity


def corpus():
    """Toxic texts, lines that many share, near and exact copies, nothing, and a text longer than a sequence."""
    rnd, rows = random.Random(11), []
    made = test_toxicity.made(11, 500)
    for i, text, toxic in made:
        if i % 9 == 4:
            text += f"\n{test_line_dedup.SHARED} {i % 3}\nthe end of number {i}"
        if i % 10 == 7:
            # Of an ordinary text before it, with hardly a word changed.
            words = made[i - 1][1].split()
            text, toxic = test_near_dedup.edited(rnd, words, i % 3 if len(words) > 60 else 0), 0
        rows.append((i, text, toxic, ["web", "web", "web", "web", "news", "mail", None][i % 7]))
    more = [None, "", "\n", " ".join(f"rare{rnd.randrange(10**6)}" for _ in range(3000))]
    return rows + [(600 + i, text, 0, "mail") for i, text in enumerate(more)]


def test_against_brute_force(spark, tmp_path, vocabulary, monkeypatch):
    rows, sf = corpus(), str(tmp_path)
    spark.createDataFrame([(*r[:2], "en", r[3], len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(r[0], r[2], 1) for r in rows], "doc_id long, toxic int, quality int").write.parquet(f"{sf}/labels.parquet")
    documents = registry.table(spark, sf, "documents")

    model = train(documents.select("doc_id", "text"), registry.table(spark, sf, "labels"), ~registry.held_out())
    docs = [{"doc_id": i, "text": text, "source": source} for i, text, _, source in rows]
    docs = [d for d in docs if test_toxicity.plain_score(d["text"], model) < 0.3]
    assert 80 < len(rows) - len(docs) < 130
    texts = {i: text for i, text, *_ in test_line_dedup.brute(docs)}
    assert sum(texts[d["doc_id"]] != d["text"] for d in docs) > 20
    docs = [d | {"text": texts[d["doc_id"]]} for d in docs]
    stays = {i for i, _, _, kept in test_near_dedup.brute(docs, 5) if kept}
    assert 20 < len(docs) - len(stays)
    docs = [d for d in docs if d["doc_id"] in stays]

    encoder = Encoder(vocabulary)
    ids = {d["doc_id"]: [*encoder.library_ids(d["text"] or "").tolist(), registry.END_ID] for d in docs}
    by_text = {d["text"]: len(ids[d["doc_id"]]) for d in docs}
    monkeypatch.setattr(test_mixing, "tokens", by_text.get)
    drawn = Counter(r[0] for r in test_mixing.brute_mix(docs, entropy=registry.MIX_ENTROPY, repeats=registry.MIX_REPEATS))
    assert set(drawn) == stays and max(drawn.values()) > 1

    packed = corpus_pipeline.run(spark, sf).collect()
    have, sequence = defaultdict(list), defaultdict(list)
    for r in packed:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
        have[r["doc_id"]].append((r["start"], r["length"]))
        sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(have) == stays
    for doc, parts in have.items():
        # Each id of each draw lies in exactly one piece.
        covered = Counter(at for start, length in parts for at in range(start, start + length))
        assert covered == dict.fromkeys(range(len(ids[doc])), drawn[doc])
    for content in sequence.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= 2048
    room = sorted(2048 - sum(x for _, x in c) for c in sequence.values())
    assert room == test_tokens.one_at_a_time([r["length"] for r in packed], 2048)
