import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.fixtures import documents
from tidewell.llm import alignment, tallies, vocabularies

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WHOLE_A, WHOLE_B = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
WHOLE_A.encode_special_tokens = True
ALIGNER = alignment.Aligner(A, B)
ODD = st.text(st.one_of(st.sampled_from(list("  \n\t.,'aAsStTéßﬁ̸́<|>&=1½ 　\x1c\x85\x00ıİ日▁")), st.characters(codec="utf-8")), max_size=60)


def byte_of(token):
    """The bytes of an entry of the byte-level vocabulary, by its published table."""
    points = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table, n = {chr(b): b for b in points}, 0
    for b in range(256):
        if b not in points:
            table[chr(256 + n)] = b
            n += 1
    return bytes(table[c] for c in token)


def brute(text):
    """Tokens of the whole text as (id, end); None if their bytes differ from it."""
    if not text:
        return None
    e = WHOLE_A.encode(" " + text, add_special_tokens=False)
    b_ids = WHOLE_B.encode(text)
    a = [(i, byte_of(t)) for i, t in zip(e.ids, e.tokens, strict=True)]
    b = [(i, bytes([int(p[3:5], 16)]) if WHOLE_B.is_byte(i) else p.replace("▁", " ").encode()) for i, p in zip(b_ids, map(WHOLE_B.id_to_piece, b_ids), strict=True)]
    raw = (" " + text).encode()
    if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
        return None
    ended = []
    for tokens in (a, b):
        ends = np.cumsum([len(x) for _, x in tokens]).tolist()
        ended.append([(i, n) for (i, _), n in zip(tokens, ends, strict=True)])
    return ended


def groups_and_links(tokens):
    a, b = tokens
    cuts = sorted({n for _, n in a} & {n for _, n in b})
    groups, lo = [], 0
    for c in cuts:
        groups.append("|".join(",".join(str(i) for i, n in side if lo < n <= c) for side in (a, b)))
        lo = c
    return ";".join(groups), [(i, j) for i, n in a for j, m in b if n == m]


def expected(texts):
    told = [groups_and_links(t) if (t := brute(x)) else None for x in texts]
    count = Counter(p for x in told if x for p in x[1])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    out = []
    for x, t in zip(texts, told, strict=True):
        if not t:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b = brute(x)
        out.append((len(a), len(b), t[0].count("|"), len(t[1]), sum(count[p] == most[p[1]] for p in t[1]), sum(count[p] for p in t[1]), hashlib.sha256(t[0].encode()).hexdigest()))
    return out


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_chunks_have_the_groups_of_the_whole_text(text):
    for t in (text, f"word, {text} it's  <|endoftext|> {text},", f"{text}<s> <0x41> don't", f" {text} 日本 x"):
        got, want = [ALIGNER.aligned(list(dict.fromkeys(c))) for c in vocabularies.spaced(t)] if t else [], brute(t)
        if want is None:
            assert not t or any(None in x for x in got)
            continue
        info = {c: x for chunks in vocabularies.spaced(t) for c, x in zip(dict.fromkeys(chunks), ALIGNER.aligned(list(dict.fromkeys(chunks))), strict=True)}
        found = [info[c] for chunks in vocabularies.spaced(t) for c in chunks]
        groups, links = groups_and_links(want)
        assert ";".join(x[3] for x in found) == groups
        assert [p for x in found for p in x[4]] == [i << 32 | j for i, j in links]
        assert [sum(x[k] for x in found) for k in range(3)] == [len(want[0]), len(want[1]), groups.count("|")]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=30), st.data())
def test_bisection_lists_overlaps_and_unspanned_gaps(a, data):
    total = sum(a)
    cuts = sorted(data.draw(st.sets(st.integers(1, total), max_size=total)) | {total})
    b = np.diff([0, *cuts])
    first, last, ends = alignment.align(np.array(a), b)
    lo = 0
    for i, n in enumerate(a):
        over = [j for j, c in enumerate(cuts) if c > lo and c - b[j] < lo + n]
        assert (first[i], last[i]) == (over[0], over[-1])
        lo += n
        assert ends[i] == (lo in cuts)


@pytest.mark.parametrize("characters", [alignment.CHARACTERS, 500])
def test_equals_whole_texts(spark, monkeypatch, characters):
    monkeypatch.setattr(alignment, "CHARACTERS", characters)
    monkeypatch.setattr(tallies, "SPREAD", 2 if characters == 500 else tallies.SPREAD)
    monkeypatch.setattr(tallies, "RUN", 300)
    monkeypatch.setattr(vocabularies, "SLICE", 700)
    long = " ".join(f"word{i} <|endoftext|>x" for i in range(150))
    df, rows = documents(spark, extra=[(600, long), (600, long), (601, "a" * 3000), (602, "日本語" * 300), (603, "Ünï códe\u0301 <s> \x00 \u2028 it's 12"), (604, "a ▁ b c"), (605, "  two  blanks "), (606, "a▁ b")])
    got = sorted((r.doc_id if r.doc_id is not None else -1, *r[1:]) for r in alignment.alignment(df, A, B).collect())
    assert got == sorted((-1 if d is None else d, *x) for (d, _), x in zip(rows, expected([t for _, t in rows]), strict=True))


def test_empty_tables(spark):
    df, _ = documents(spark)
    assert alignment.alignment(df.limit(0), A, B).count() == 0
    got = alignment.alignment(df.where("text is null or doc_id = 501"), A, B).collect()
    assert [tuple(r[1:]) for r in got] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_new_chunks_are_encoded_together_and_come_apart(monkeypatch):
    aligner = alignment.Aligner(A, B)
    chunks = [" " + c for c in ["the", "don't", "x\ny", "½", "a▁", "▁b", "\ttab", "end\n", "日本", "", "(", "1́", "<s>", *(f"word{i}" for i in range(300))]]
    sent, encode = [], aligner.a.encode
    monkeypatch.setattr(aligner.a, "encode", lambda texts: sent.append(len(texts)) or encode(texts))
    got = aligner.aligned(chunks)
    assert sum(sent) < len(chunks)
    alone = alignment.Aligner(A, B)
    assert got == [alone._new([c])[0] for c in chunks] and None in got
    assert aligner.aligned(chunks) == got


def test_a_full_cache_keeps_what_blocks_ask_for(monkeypatch):
    monkeypatch.setattr(alignment, "CACHE", 4)
    aligner, new = alignment.Aligner(A, B), []
    own = aligner._new
    monkeypatch.setattr(aligner, "_new", lambda chunks: new.extend(chunks) or own(chunks))
    for i in range(6):
        aligner.begin()
        aligner.aligned([" the", " of", *(f" b{i}x{k}" for k in range(5))])
    assert new.count(" the") == new.count(" of") == 1 and len(aligner.known) <= 4
