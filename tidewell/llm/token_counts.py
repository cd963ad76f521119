"""Token counts of documents without their ids.

Texts are cut into pre-tokens, the units inside which a tokenizer merges. Each distinct pre-token of
the corpus is tokenised once and only the number of its pieces is kept; a document's count is the sum
of these numbers over its pre-tokens, each as often as it stands there. No list of ids is made for a
document at any time. `tallies` holds how the frequencies of documents and the numbers meet.

Edge cases. Null and empty texts have 0 tokens and 0 bytes. Special strings inside texts are special
tokens, as the library's default has it; nothing is added or cut off. Texts of any length are read
whole, a slice at a time; a text without white space is one chunk. Repeated rows are documents of
their own, doc_id may be null or repeat. Other columns are ignored. An empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tallies import blocks, looked_up, numbered, summed
from .vocabularies import Words

#: Pre-tokens of chunks that a worker keeps, characters of a block: the larger, the fewer lists hold a pre-token.
CACHE, CHARACTERS = 200_000, 1 << 24
_loaded: dict = {}
_pretokens: dict = {}


def _words(path: str) -> Words:
    if path not in _loaded:
        _loaded[path] = Words(path)
    return _loaded[path]


def frequencies(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Blocks of documents whose keys are pre-tokens."""

    def maker():
        words = _words(tokenizer)
        known = _pretokens.setdefault(tokenizer, {})

        def read(block, texts):
            for t in texts:
                yield (len(t.encode()),), [block.numbers(c) for c in words.chunks(t)]

        def spread(chunks):
            if len(known) > CACHE:
                known.clear()
            found = []
            for c in chunks:
                if (p := known.get(c)) is None:
                    p = words.pretokens(c)
                    if len(c) <= 64:
                        known[c] = p
                found.append(p)
            return np.array([len(p) for p in found], np.int64), *numbered([x for p in found for x in p])

        return read, spread

    return blocks(docs, {"n_bytes": "long"}, "string", maker, CHARACTERS)


def piece_counts(distinct: DataFrame, tokenizer: str) -> DataFrame:
    """distinct, one row a pre-token (key), with the number of its pieces."""

    def count(batches):
        words = _words(tokenizer)
        for batch in batches:
            pieces = pa.array(words.count(batch.column("key").to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pieces], names=[*batch.schema.names, "n_tokens"])

    return distinct.mapInArrow(count, "key string, salts long, n_tokens long")


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than limit tokens) of every document."""
    held = frequencies(docs, tokenizer)
    told = looked_up(held, lambda distinct: piece_counts(distinct, tokenizer), "n_tokens", totals=False)
    return summed(held, told, {"n_bytes": "long"}, "n_tokens").withColumn("over_limit", F.col("n_tokens") > limit)
