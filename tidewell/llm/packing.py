"""Vector best-fit packing of tokenised documents into sequences.

A piece of L tokens asks for the vector (L tokens, 1 document, L * L attention pairs), so the
whole problem is told by how many pieces there are of each length: at most max_tokens numbers,
however many documents there are. The plan is made from those counts by best-fit decreasing: for
each length the open kinds of sequences that still hold the piece under every capacity are ranked
by the weighted norm of what would be left, or by the weighted dot product of demand and what is
left, and the tightest kind is filled first. A plan row says which pieces of a length, by their
rank, get which place; pieces find their rank in salted groups, so a length that a third of all
pieces share is dealt over many tasks.

Edge cases. Null text is empty: one piece that holds only the end id. Texts of any length are taken
whole and cut into pieces. Repeated rows are documents of their own; pieces that tie in every column
get places in any order. doc_id may be null. Other columns are ignored. Empty tables give none.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, session

#: SALTS groups a length at least, more beyond PER_SALT pieces a group.
MAX_TOKENS, SALTS, PER_SALT, CACHE = 2048, 256, 500_000, 1_000_000
_tokenizers: dict = {}


def _encoder(path: str):
    """A function from texts to their ids as little-endian 32-bit bytes.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its
    pieces between blanks, one after another; ids of frequent pieces are kept. New pieces of
    Latin letters only are encoded together, for each of them ends with one of the tokens that
    end a word; others are encoded one by one.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if path not in _tokenizers:
        tok = Tokenizer.from_file(path)
        ends = np.zeros(tok.get_vocab_size(), bool)
        ends[[i for t, i in tok.get_vocab().items() if t.endswith("</w>")]] = True
        _tokenizers[path] = tok, ends, {"": b""}
    tok, ends, cache = _tokenizers[path]

    def one_by_one(parts):
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in tok.encode_batch_fast(parts, add_special_tokens=False)]

    def learn(parts):
        """The ids of new pieces."""
        # one comma or full stop after a letter is a token of its own
        tail = {p for p in parts if p[-1] in ".," and len(p) > 1 and p[:-1].isalpha()}
        bare = {x for x in (p[:-1] if p in tail else p for p in parts) if x not in cache} | {".", ","}
        plain = [x for x in bare if x.isalpha() and max(x) < "\u0250"]
        out, rest = {}, bare.difference(plain)
        if plain:
            ids = np.asarray(tok.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = [0, *((np.flatnonzero(ends[ids]) + 1) * 4).tolist()]
            if len(cuts) == len(plain) + 1:
                raw = ids.tobytes()
                out = {x: raw[cuts[i] : cuts[i + 1]] for i, x in enumerate(plain)}
            else:
                rest = bare
        rest = list(rest)
        out.update(zip(rest, one_by_one(rest), strict=True))
        for p in tail:
            w = p[:-1]
            out[p] = (out[w] if w in out else cache[w]) + out[p[-1]]
        return out

    def encode(texts):
        if len(cache) > CACHE:
            cache.clear()
            cache[""] = b""
        parts = [t.replace("\n", " ").split(" ") for t in texts]
        got = [list(map(cache.get, p)) for p in parts]
        lacking = [None in g for g in got]
        new = {x for p, g, lack in zip(parts, got, lacking, strict=True) if lack for x, y in zip(p, g, strict=True) if y is None}
        fresh = learn(new) if new else {}
        cache.update((k, v) for k, v in fresh.items() if len(k) <= 64)
        return [b"".join([fresh[x] if y is None else y for x, y in zip(p, g, strict=True)] if lack else g) for p, g, lack in zip(parts, got, lacking, strict=True)]

    return encode


def _groups(column, chars: int = 1 << 19):
    """First row and texts of runs of about so many characters; null texts are empty."""
    lo, held, size = 0, [], 0
    for i, x in enumerate(column):
        held.append(x.as_py() or "")
        size += len(held[-1])
        if size > chars:
            yield lo, held
            lo, held, size = i + 1, [], 0
    if held:
        yield lo, held


def pieces(docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, little-endian 32-bit): each document's ids and a closing 0, cut only where longer than max_tokens."""
    session(docs.sparkSession)

    def cut(batches):
        encode, step = _encoder(tokenizer), 4 * max_tokens
        for batch in batches:
            out = []
            for lo, texts in _groups(batch.column("text")):
                for i, ids in enumerate(encode(texts)):
                    ids += b"\0\0\0\0"
                    for k, at in enumerate(range(0, len(ids), step)):
                        part = ids[at : at + step]
                        out.append((lo + i, k, at // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
            row, piece, start, length, crc, part = zip(*out, strict=True) if out else ((),) * 6
            cols = [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(part, pa.binary())] * keep_ids, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + keep_ids])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids)


def plan(counts: dict[int, int], max_tokens: int = MAX_TOKENS, max_docs: int | None = None, max_attention: int | None = None, weights=(1.0, 1e-3, 1e-3), measure: str = "norm") -> list[tuple[int, dict[int, int]]]:
    """Kinds of sequences, as (how many, {length: pieces of it}), for counts pieces of each length, by best-fit decreasing."""
    caps = np.array([max_tokens, max_docs or max_tokens, max_attention or max_tokens**2], float)
    weights = np.asarray(weights, float)
    left, many, holds = np.zeros((0, 3)), np.zeros(0, np.int64), []
    for length in sorted((x for x, c in counts.items() if c), reverse=True):
        todo, ask = counts[length], np.array([length, 1, length * length], float)
        if (ask > caps).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while todo:
            fits = np.flatnonzero((left >= ask).all(1) & (many > 0))
            if len(fits):
                rest = (left[fits] - ask) / caps
                rank = (weights * rest * rest).sum(1) if measure == "norm" else (weights * (ask / caps) * (left[fits] / caps)).sum(1)
                best = fits[np.argmin(rank)]
                n = min(todo, int(many[best]))
                room = int(min((left[best] // ask).min(), max(1, todo // n)))
                filled = holds[best] | {length: room}
                start = left[best] - room * ask
                many[best] -= n
            else:
                room = int(min((caps // ask).min(), todo))
                n, filled, start = todo // room, {length: room}, caps - room * ask
            todo -= n * room
            left, many = np.vstack([left, start]), np.append(many, n)
            holds.append(filled)
    return [(int(m), h) for m, h in zip(many, holds, strict=True) if m]


def places(kinds: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length, first rank, how many, first sequence, offset), sorted: the pieces of a length with these ranks stand there."""
    out, taken, seq = [], {}, 0
    for many, held in kinds:
        offset = 0
        for length, k in held.items():
            for _ in range(k):
                out.append((length, taken.get(length, 0), many, seq, offset))
                taken[length] = taken.get(length, 0) + many
                offset += length
        seq += many
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS, max_docs: int | None = None, max_attention: int | None = None, weights=(1.0, 1e-3, 1e-3), keep_ids: bool = False) -> DataFrame:
    """Every piece with its sequence_id and its offset there; sequences hold at most max_tokens tokens, max_docs pieces and max_attention attention pairs.

    Both measures are tried on the counts and the plan with fewer sequences is taken.
    """
    spark = docs.sparkSession
    cut = materialize(pieces(docs, tokenizer, max_tokens, keep_ids), "pieces")
    salts = max(SALTS, cut.count() // PER_SALT)
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    groups = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    counts = {int(r[0]): int(r[1]) for r in groups.groupBy("length").agg(F.sum("_n")).collect()}  # at most max_tokens rows
    tried = [plan(counts, max_tokens, max_docs, max_attention, weights, m) for m in ("norm", "dot")]
    table = places(min(tried, key=lambda kinds: sum(m for m, _ in kinds)))
    before = groups.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).drop("_n")
    rank = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = salted.withColumn("_local", rank).join(before, ["length", "_salt"]).withColumn("_rank", (F.col("_before") + F.col("_local")).cast("long"))
    shared = spark.sparkContext.broadcast(table)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.select(*names).schema) + ", sequence_id long, offset long"

    def put(batches):
        t = shared.value
        key = t[:, 0] << 44 | t[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            at = np.searchsorted(key, length << 44 | rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(t[at, 3] + rank - t[at, 1]), pa.array(t[at, 4])], names=[*names, "sequence_id", "offset"])

    return ranked.select(*names, "_rank").mapInArrow(put, schema)
