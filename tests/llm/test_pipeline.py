"""The whole pipeline against the plain versions of its stages, one after the other."""

import re

import numpy as np
from brute import decontaminate, jaccard, pii, quality
from test_operators import corpus, frame, prose
from tokenizers import Tokenizer

import corpus_pipeline
from rowsluice.llm.common import tokenizer_path

ITEMS = [("b1", prose(900, 30)), ("b2", None), ("b3", "two words")]


def redacted(text):
    out, at = "", 0
    for kind, start, end in re.findall(r"(\w+):(\d+):(\d+)", pii(text)[1]):
        start, end = int(start), int(end)
        if end > at:
            out += (text[at:start] if start > at else "") + f"[{kind}]"
            at = max(at, end)
    return out + text[at:]


def test_run(spark, folder):
    seen = set()
    rows = [r for r in corpus() if r[0] is not None and not (r[0] in seen or seen.add(r[0]))]
    rows += [(300, prose(31, 60) + ITEMS[0][1] + prose(32, 60)), (301, prose(33, 200) + "mail a.b@c.de or 10.2.3.4 or +1 (389) 555-5010 now " + prose(34, 20))]
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")

    texts = dict(rows)
    failed = {q[0] for q in quality(rows) if q[-1]}  # no host has a line often enough for more
    left = [(i, t) for i, t in rows if i not in failed]
    left = [(i, texts[i]) for i, _, root in jaccard(left) if i == root]
    left = [(i, texts[i]) for i, *_, bad in decontaminate(left, ITEMS) if not bad]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = {i: [*tokenizer.encode(redacted(t), add_special_tokens=False).ids, 2] for i, t in left}
    assert 300 not in want and 301 in want and len(want) > 5

    pieces, places = {}, {}
    for r in corpus_pipeline.run(spark, folder).collect():
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] <= 1024
        pieces.setdefault(r["doc_id"], []).append((r["piece"], ids))
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert {i: [x for _, ids in sorted(p) for x in ids] for i, p in pieces.items()} == want
    for parts in places.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 1024
