"""The pipeline's last stage holds the sequences themselves."""

from __future__ import annotations

from collections import defaultdict

import public_tokenizers
from tidemark.llm import packing
from tokenizers import Tokenizer

import corpus_pipeline

from .common import documents, odd_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_last_stage_rebuilds_texts_and_sequences(spark):
    rows = odd_rows()
    rows += [(103, *rows[3][1:]), (103, "a cut one", "en", "s2", 9)]  # three of one doc_id
    out = corpus_pipeline.pack_sequences(spark, documents(spark, rows), "unused").collect()

    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    want = []
    for doc_id, text, *_ in rows:
        ids = [*own.encode(text or "", add_special_tokens=False).ids, packing.END]
        want.append((str(doc_id), b"".join(i.to_bytes(2, "little") for i in ids)))

    texts, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        texts[r["doc_id"], r["copy"]].append((r["piece"], r["start"], bytes(r["ids"])))
        sequences[r["sequence_id"]].append((r["offset"], bytes(r["ids"])))
    got = []
    for (doc_id, _), pieces in texts.items():
        assert [p for p, _, _ in sorted(pieces)] == list(range(len(pieces)))
        got.append((str(doc_id), b"".join(ids for _, _, ids in sorted(pieces))))
    assert sorted(got) == sorted(want)
    copies = defaultdict(set)
    for doc_id, copy in texts:
        copies[doc_id].add(copy)
    assert all(c == set(range(len(c))) for c in copies.values())
    for pieces in sequences.values():
        at = 0
        for offset, ids in sorted(pieces):
            assert offset == at
            at += len(ids) // 2
        assert at <= packing.CAPACITY
