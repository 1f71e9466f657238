from collections import defaultdict

from pyspark.sql import functions as F

from framewise.llm import line_dedup
from framewise.llm.line_dedup import drop_shared_lines, line_key, repeated_filter

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, least=20, documents=3):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))

    holders = defaultdict(set)
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            if r["doc_id"] is not None and len(key(line)) >= least:
                holders[key(line)].add(r["doc_id"])
    out = []
    for r in rows:
        lines = (r["text"] or "").split("\n")
        kept = [
            x for x in lines if r["doc_id"] is None or len(holders.get(key(x), ())) < documents or r["doc_id"] == max(holders[key(x)])
        ]
        text = "\n".join(kept) if len(kept) < len(lines) else r["text"]
        out.append((r["doc_id"], text, len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)


SHARED = "this line is in many documents"
LINES = [SHARED, f"  {SHARED.upper()}\t", "a line that only two documents hold", "short", "", "éèê êèé éèê êèé éèê é", "ÉÈÊ êèé éèê êèé éèê é"]


def test_against_brute_force(docs_of):
    texts = ["\n".join(LINES[j] for j in range(len(LINES)) if (i * 7 + j * 3) % 5 < 2 or (j == 2 and i < 2)) for i in range(40)]
    docs = docs_of([*texts, f"{SHARED}\n{SHARED}\nown words of this document only", None, SHARED], [*range(40), 90, 91, None])
    assert found(drop_shared_lines(docs)) == brute(docs.collect())
    assert found(drop_shared_lines(docs, least=3, documents=2)) == brute(docs.collect(), 3, 2)


def test_odd_texts_and_columns(odd_docs):
    clash = odd_docs.withColumns({"N_Lines": F.lit("x"), "_key": F.lit(1), "_line": F.lit(2)})
    cleaned = drop_shared_lines(clash, least=1, documents=2)
    assert cleaned.columns == ["doc_id", "text", "lang", "source", "_key", "_line", "n_lines", "n_dropped"]
    assert found(cleaned) == brute(odd_docs.collect(), 1, 2)
    assert drop_shared_lines(clash.limit(0)).collect() == []


def test_line_in_a_third_of_all_documents(docs_of):
    docs = docs_of([f"{SHARED}\nown line number {i} of this one" if i % 3 == 0 else f"another text, number {i}, alone" for i in range(900)])
    assert found(drop_shared_lines(docs)) == brute(docs.collect())


def test_full_filters_change_nothing(docs_of, monkeypatch):
    """With filters far too small every line is suspected; the exact step sorts them out."""
    monkeypatch.setattr(line_dedup, "_SEGMENT", 64)
    monkeypatch.setattr(line_dedup, "MOST", 64)
    docs = docs_of([f"{SHARED}\nown line number {i} of this one" for i in range(200)])
    assert len(repeated_filter(docs)) == 64
    assert found(drop_shared_lines(docs)) == brute(docs.collect())


def test_filter_holds_what_two_tasks_saw_once(docs_of):
    docs = docs_of([SHARED, *[f"number {i} " * 4 for i in range(50)], SHARED]).repartition(13)
    whole = bytearray(repeated_filter(docs))
    import numpy as np

    where, masks = line_dedup._places([line_key(SHARED.encode())], len(whole))
    assert line_dedup._seen(np.frombuffer(whole, np.uint8), where, masks).all()
    assert sum(bin(b).count("1") for b in whole) <= 8
