import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.fixtures import documents
from tidewell.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


ODD = st.text(st.one_of(st.sampled_from(list(" \n\t.,'aAéßﬁ̸́<|>&=1½ 　\x1c\x85ıİ")), st.characters(codec="utf-8")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_ids_equal_those_of_the_whole_text(text):
    encode = packing._encoder(PATH)
    whole = Tokenizer.from_file(PATH) if not hasattr(test_ids_equal_those_of_the_whole_text, "t") else test_ids_equal_those_of_the_whole_text.t
    test_ids_equal_those_of_the_whole_text.t = whole
    for t in (text, f"word, {text}. it's <|endoftext|> {text},"):
        assert np.frombuffer(encode([t])[0], "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def test_pieces_and_places(spark, tok):
    long = " ".join(f"word{i}" for i in range(3000))
    df, rows = documents(spark, extra=[(600, long), (600, long), (601, long)])
    out = packing.pack(df, PATH, max_tokens=256).collect()
    want = sorted((d, p, p * 256, len(x), zlib.crc32(x.astype("<u4").tobytes())) for d, t in rows if d is not None for ids in [np.array(tok.encode(t or "", add_special_tokens=False).ids + [0])] for p in range(-(-len(ids) // 256)) for x in [ids[p * 256 : p * 256 + 256]])
    assert sorted(tuple(r[:5]) for r in out if r.doc_id is not None) == want
    assert sum(r.doc_id is None for r in out) == 1
    at = {}
    for r in out:
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in at.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 256
    assert len(at) <= -(-sum(r.length for r in out) // 256) * 1.1 + 1


def test_empty_table_and_kept_ids(spark):
    df, _ = documents(spark)
    assert packing.pack(df.limit(0), PATH).count() == 0
    r = packing.pack(df.where("doc_id = 504"), PATH, keep_ids=True).collect()
    assert zlib.crc32(r[0].ids) == r[0].ids_crc32


@pytest.mark.parametrize("measure", ["norm", "dot"])
def test_plan_keeps_every_capacity(measure):
    rng = random.Random(5)
    counts = {rng.randrange(1, 101): rng.randrange(1, 50) for _ in range(60)}
    kinds = packing.plan(counts, 100, max_docs=7, max_attention=9000, measure=measure) if max(counts) ** 2 <= 9000 else packing.plan({k: v for k, v in counts.items() if k <= 94}, 100, max_docs=7, max_attention=9000, measure=measure)
    placed = {}
    for many, held in kinds:
        assert sum(x * k for x, k in held.items()) <= 100
        assert sum(held.values()) <= 7
        assert sum(x * x * k for x, k in held.items()) <= 9000
        for x, k in held.items():
            placed[x] = placed.get(x, 0) + k * many
    assert placed == {k: v for k, v in counts.items() if k in placed}
    table = packing.places(kinds)
    for x in placed:
        ranks = sorted((a, a + m) for length, a, m, _, _ in table.tolist() if length == x)
        assert ranks[0][0] == 0 and ranks[-1][1] == placed[x] and all(p[1] == q[0] for p, q in zip(ranks, ranks[1:], strict=False))
