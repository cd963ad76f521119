"""Alignment of the tokens of two tokenizers over the same bytes, and how often the corpus aligns them alike.

Tokens are intervals of bytes. B's intervals are kept as sorted arrays of starts and ends; a bisection
with the two ends of an A token gives the run of B tokens that it overlaps. A gap between two A tokens
that no B token spans (the next run begins behind the last one) is a border of a group. Overlapping
tokens that end at the same byte are linked.

Both tokenizers begin anew at a blank between two other characters (see `vocabularies`), so such a
place is a border whatever stands around it. Documents are therefore cut there into chunks, each
distinct chunk of a block is encoded and aligned once, all new chunks of a run of texts in one
bisection, and a document's groups are those of its chunks, one after another. New chunks are encoded
RUN at a time as one text; where its tokens' bytes differ, or a chunk ends inside a token, each alone.

How many links of the corpus hold an id pair is summed over blocks (`tallies`); the highest number of
a B id is a window over its pairs, of which there are as many as A has ids at most. Both go back to
the blocks by pair; no row per link is ever shuffled.

Edge cases. Null and empty texts have no tokens, nor have texts whose tokens' bytes differ from theirs
(such as texts with U+2581, which `Pieces` gives back as a blank): zeros and ''. Texts of any length
are taken whole, a slice at a time; a text without blanks is one chunk. Strings of special tokens in a
text are plain text. Repeated rows are documents of their own and count as such. doc_id may be null or
repeat. Other columns are ignored. An empty table gives none.
"""

from __future__ import annotations

import hashlib
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tallies import blocks, looked_up, summed
from .vocabularies import Bytes, Pieces, joined, spaced

#: Aligned chunks that a worker keeps; longer ones than LONGEST characters are aligned anew in each block.
CACHE, LONGEST = 150_000, 32
#: Characters of a block; chunks that are encoded one after another.
CHARACTERS, RUN = 1 << 23, 128
#: The entry of a chunk whose tokens' bytes are not its own.
UNSOUND = -1, 0, 0, "", ()
OWN = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups_sha256": "string"}
_loaded: dict = {}


def align(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For tokens of these lengths over the same bytes: first and last B token that each A token overlaps, and which A tokens end a group."""
    a_end, b_end = a_lengths.cumsum(), b_lengths.cumsum()
    first = np.searchsorted(b_end, a_end - a_lengths, "right")
    last = np.searchsorted(b_end - b_lengths, a_end, "left") - 1
    spanned = first[1:] <= last[:-1]
    return first, last, np.append(~spanned, True)[: len(a_lengths)]


class Aligner:
    """Aligned chunks: for each its numbers of A tokens, B tokens and groups, its groups as text, and its links as pairs of ids."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b, self.known, self.found, self.full = Bytes(a_path), Pieces(b_path), {}, {}, False
        # an id and what stands behind it inside a group, and at the end of its side
        self.texts = [f"{i}{mark}" for last in "|;" for i in range(max(len(self.a.bytes), len(self.b.bytes))) for mark in (",", last)]
        self.sizes = np.array([len(x) for x in self.texts], np.int64)

    def begin(self) -> None:
        """Another block begins: of a cache that was full before the last one, what that one found there stays."""
        if self.full:
            self.known = self.found
        self.full, self.found = len(self.known) >= CACHE, {}

    def aligned(self, chunks: list[str]) -> list:
        """One entry a chunk; None where the tokens' bytes are not the chunk's."""
        known = self.known
        self.found.update((c, known[c]) for c in chunks if c in known)
        new = [c for c in chunks if c not in known]
        fresh = dict(zip(new, self._new(new), strict=True)) if new else {}
        out = [fresh[c] if c in fresh else known[c] for c in chunks]
        # the first chunks of a block are its frequent ones
        known.update(islice(((c, x) for c, x in fresh.items() if len(c) <= LONGEST), max(0, CACHE - len(known))))
        return out

    def _run(self, chunks: list[str], raw: bytes, a: list[int], b: list[int]):
        """The tokens of chunks that were encoded one after another, and where each chunk ends among them; None if their bytes differ or a chunk ends inside one."""
        if b"".join(map(self.a.bytes.__getitem__, a)) != raw or b"".join(map(self.b.bytes.__getitem__, b)) != raw:
            return None
        ends = np.cumsum([len(c.encode()) for c in chunks]) if len(chunks) > 1 else np.array([len(raw)])
        out = []
        for ids, lengths in ((np.array(a, np.int64), self.a.lengths), (np.array(b, np.int64), self.b.lengths)):
            upto = lengths[ids].cumsum()
            at = np.searchsorted(upto, ends, "right")
            if len(chunks) > 1 and (at.min() < 1 or (upto[at - 1] != ends).any()):
                return None
            out += [ids, at]
        return out

    def _new(self, chunks: list[str]) -> list:
        out, good, tokens, runs = [None] * len(chunks), [], [], joined(chunks, RUN)
        while runs:
            texts, apart = ["".join([chunks[i] for i in run]) for run in runs], []
            for run, text, a, b in zip(runs, texts, self.a.encode(texts), self.b.encode(texts), strict=True):
                if found := self._run([chunks[i] for i in run], text.encode(), a, b):
                    good += run
                    tokens.append(found)
                elif len(run) > 1:
                    apart += [[i] for i in run]
            runs = apart
        if not good:
            return out
        (a_ids, b_ids), upto = (np.concatenate([x[k] for x in tokens]) for k in (0, 2)), []
        for k in (0, 2):
            size = np.array([len(x[k]) for x in tokens])
            upto.append(np.concatenate([x[k + 1] for x in tokens]) + np.repeat(size.cumsum() - size, [len(x[k + 1]) for x in tokens]))
        a_lengths, b_lengths = self.a.lengths[a_ids], self.b.lengths[b_ids]
        _, last, ends = align(a_lengths, b_lengths)
        linked = np.flatnonzero(b_lengths.cumsum()[last] == a_lengths.cumsum())
        pairs = tuple((a_ids[linked] << 32 | b_ids[last[linked]]).tolist())
        a_cuts, b_cuts = np.append(0, np.flatnonzero(ends) + 1), np.append(0, last[ends] + 1)
        # a group's A tokens stand before its B tokens, behind those of the groups before
        b_ends = np.zeros(len(b_ids), np.int64)
        b_ends[b_cuts[1:] - 1] = 1
        text = np.empty(len(a_ids) + len(b_ids), np.int64)
        text[np.arange(len(a_ids)) + np.repeat(b_cuts[:-1], np.diff(a_cuts))] = 2 * a_ids + ends
        text[np.arange(len(b_ids)) + np.repeat(a_cuts[1:], np.diff(b_cuts))] = 2 * b_ids + b_ends + len(self.texts) // 2
        whole = "".join(map(self.texts.__getitem__, text.tolist()))
        # chunks end at borders of groups, and each link is the end of an A token
        cuts = [np.append(0, x) for x in (*upto, np.searchsorted(a_cuts, upto[0]), np.searchsorted(linked, upto[0]), self.sizes[text].cumsum()[upto[0] + upto[1] - 1])]
        n_a, n_b, n_groups = (np.diff(x).tolist() for x in cuts[:3])
        links, places = cuts[3].tolist(), cuts[4].tolist()
        for i, *size, k0, k1, c0, c1 in zip(good, n_a, n_b, n_groups, links, links[1:], places, places[1:], strict=False):
            out[i] = *size, whole[c0 : c1 - 1], pairs[k0:k1]
        return out


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Blocks of documents whose keys are linked id pairs (a << 32 | b)."""

    def maker():
        if (a_path, b_path) not in _loaded:
            _loaded[a_path, b_path] = Aligner(a_path, b_path)
        aligner, sizes, groups, links, last = _loaded[a_path, b_path], [np.zeros((0, 4), np.int64)], [], [], [None]

        def read(block, texts):
            if last[0] is not block:
                last[0] = block
                aligner.begin()
                sizes[0] = sizes[0][:0]
                groups.clear()
                links.clear()
            numbered = [[block.numbers(c) for c in spaced(t)] if t else [] for t in texts]
            found = [x or UNSOUND for x in aligner.aligned(list(islice(block.place, len(groups), None)))]
            sizes[0] = np.concatenate([sizes[0], np.array([(*x[:3], len(x[4])) for x in found], np.int64).reshape(-1, 4)])
            groups.extend([x[3] for x in found])
            links.extend([x[4] for x in found])
            for runs in numbered:
                total, digest, sound = np.zeros(4, np.int64), hashlib.sha256(), bool(runs)
                for k, run in enumerate(runs):
                    own = sizes[0][run]
                    if own[:, 0].min() < 0:
                        sound = False
                        break
                    total += own.sum(0)
                    digest.update((";" * (k > 0) + ";".join(map(groups.__getitem__, run.tolist()))).encode())
                yield ((*total.tolist(), digest.hexdigest()), runs) if sound else ((0, 0, 0, 0, ""), [])

        def spread(chunks):
            keys, number = np.unique(np.fromiter(chain.from_iterable(links), np.int64), return_inverse=True)
            return np.array([len(k) for k in links], np.int64), number, keys.tolist()

        return read, spread

    return blocks(docs, OWN, "bigint", maker, CHARACTERS)


def pair_counts(distinct: DataFrame) -> DataFrame:
    """distinct, one row an id pair (key) with its links (total), with whether no pair of its B id has more."""
    most = F.max("total").over(Window.partitionBy(F.col("key").bitwiseAND(0xFFFFFFFF)))
    return distinct.withColumn("n_best", (F.col("total") == most).cast("long")).withColumnRenamed("total", "count_sum")


def alignment(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    held = aligned(docs, a_path, b_path)
    told = looked_up(held, pair_counts, "n_best", "count_sum")
    return summed(held, told, OWN, "n_best", "count_sum").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
