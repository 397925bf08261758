"""The whole run of the pipeline against a plain statement of its four stages."""

from __future__ import annotations

import bisect
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from test_text_operators import brute_score

from lexmill.llm import pii, toxicity
from lexmill.llm.queries import vocabulary


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))) if words else frozenset()


def least_of_groups(texts):
    """Ids that stay: the least of each group of texts linked by a similarity of 0.8."""
    sets = {i: shingles(t) for i, t in texts.items()}
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                label[high] = low
    return {i for i in ids if root(i) == i}


def best_fit(lengths, most=1024):
    """Sequences of the piece-by-piece rule, longest first."""
    room: list[int] = []
    for n in sorted(lengths, reverse=True):
        k = bisect.bisect_left(room, n)
        left = room.pop(k) - n if k < len(room) else most - n
        bisect.insort(room, left)
    return len(room)


def test_pipeline_by_brute_force(spark, sf_dir):
    tokenizers = pytest.importorskip("tokenizers")
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline as P

    library = tokenizers.Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    library.no_truncation(), library.no_padding()
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = toxicity.train(docs, labels)
    scores = {i: brute_score(t, model) if t else 0.0 for i, t in texts.items()}
    assert all(abs(x - 0.5) > 1e-6 for x in scores.values()) and any(x > 0.5 for x in scores.values())
    calm = {i: texts[i] for i, x in scores.items() if x < 0.5}
    kept = least_of_groups(calm)
    assert len(kept) < len(calm) < len(texts)
    clean = {i: pii.redact(texts[i], pii.find_spans(texts[i])) for i in kept}
    assert any(clean[i] != texts[i] for i in kept)
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in clean.items()}

    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in P.run(spark, sf_dir).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == kept
    for i, own in pieces.items():
        own.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert [r["start"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]
        assert sum(r["length"] for r in own) == len(ids[i]) and all(r["length"] == 1024 for r in own[1:]) and own[0]["length"] <= 1024
        assert all(r["ids_crc32"] == zlib.crc32(ids[i][r["start"] : r["start"] + r["length"]].tobytes()) for r in own)
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))] and sum(r["length"] for r in own) <= 1024
    assert len(sequences) <= 1.02 * best_fit([r["length"] for own in pieces.values() for r in own]) + 1
