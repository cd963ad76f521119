import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.fixtures import documents
from tidewell.llm import tallies, token_counts, vocabularies

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE, WORDS = Tokenizer.from_file(PATH), vocabularies.Words(PATH)
ODD = st.text(st.one_of(st.sampled_from(list(" \n\t.,'aAsStTéßﬁ̸́<|>&=1½ 　\x1c\x85ıİΣ")), st.characters(codec="utf-8")), max_size=60)


def whole(text):
    return len(WHOLE.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_pretokens_have_the_counts_of_the_whole_text(text):
    for t in (text, f"word, {text}. it's <|endoftext|> {text},", f"{text}<|startoftext|>{text} don't;"):
        pretokens = [p for chunks in WORDS.chunks(t) for c in chunks for p in WORDS.pretokens(c)]
        assert sum(WORDS.count(pretokens)) == whole(t)


def test_slices_of_long_texts(monkeypatch):
    text = " ".join(f"Wörd{i}, it's" + "\n" * (i % 3) for i in range(300))
    monkeypatch.setattr(vocabularies, "SLICE", 50)
    assert len(list(WORDS.chunks(text))) > 50
    assert sum(sum(WORDS.count(WORDS.pretokens(c))) for chunks in WORDS.chunks(text) for c in chunks) == whole(text)


@pytest.mark.parametrize("characters", [token_counts.CHARACTERS, 500])
def test_equals_the_library(spark, monkeypatch, characters):
    """Also with many blocks and salts."""
    monkeypatch.setattr(token_counts, "CHARACTERS", characters)
    monkeypatch.setattr(tallies, "SPREAD", 2 if characters == 500 else tallies.SPREAD)
    monkeypatch.setattr(tallies, "RUN", 300)
    long = " ".join(f"word{i} <|endoftext|>x" for i in range(3000))
    df, rows = documents(spark, extra=[(600, long), (600, long), (601, "a" * 5000), (602, "日本語" * 400), (603, "Ünï códe\u0301 <|EndOfText|> \x00 \u2028 it's 12")])
    got = sorted(((r.doc_id if r.doc_id is not None else -1), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(df, PATH).collect())
    want = sorted((-1 if d is None else d, len((t or "").encode()), whole(t or ""), whole(t or "") > 2048) for d, t in rows)
    assert got == want


def test_empty_tables(spark):
    df, _ = documents(spark)
    assert token_counts.token_counts(df.limit(0), PATH).count() == 0
    got = token_counts.token_counts(df.where("text is null or doc_id = 501"), PATH).collect()
    assert [r.n_tokens for r in got] == [0, 0]


def test_places_survive_packing():
    assert tallies.of_planes(tallies.planes([0, 1, 255, 256, 2**31, 2**32 - 1])).tolist() == [0, 1, 255, 256, 2**31, 2**32 - 1]
    assert tallies.of_planes(tallies.planes([3, 2**40], 8), 8).tolist() == [3, 2**40]
