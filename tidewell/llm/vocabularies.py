"""Public tokenizers by the places where their texts come apart.

Each vocabulary cuts a text into chunks whose tokens don't depend on what stands beside them, chunks
into pre-tokens (the units in which the tokenizer merges), and counts or encodes these.

* `Words`: drops white space and never joins across it, so chunks stand between blanks and line
  ends (other white space stays inside chunks: which characters count as such is the library's
  matter); pre-tokens are those of the file's own pre-tokenizer, and special strings, which the
  library finds in the raw text.
* `Bytes`, `Pieces`: a blank belongs to the word after it. A blank between two other characters
  always begins a pre-token (no piece of these vocabularies goes on across it), so chunks are cut
  there; the text has one blank more at its start, which `Pieces` adds by itself.
"""

from __future__ import annotations

import os
import re

import numpy as np

#: A blank beside another blank, at an end, or beside the character that stands for it.
_JOINED = re.compile(r"[\s▁] | [\s▁]|^\s|\s$")
_BETWEEN = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
_BLANK = re.compile(r"[ \n]")
#: A chunk that may follow one that ends like it, and be followed by one that begins like it.
_WHOLE = re.compile(r" [^\s▁](?:.*[^\s▁])?", re.DOTALL)
#: Texts are cut into chunks a slice of so many characters at a time.
SLICE = 1 << 22


def _slices(text: str, cut: re.Pattern):
    """The text in slices that end before a place of cut; the blank there is in neither."""
    lo = 0
    while len(text) - lo > SLICE and (m := cut.search(text, lo + SLICE)):
        yield text[lo : m.start()]
        lo = m.end()
    yield text[lo:]


def spaced(text: str):
    """Lists of chunks of a blank and text; each begins with the blank before it."""
    for part in _slices(text, _BETWEEN):
        found = _BETWEEN.split(part) if _JOINED.search(part) else part.split(" ")
        yield [" " + c for c in found]


def joined(chunks: list[str], most: int) -> list[list[int]]:
    """Places of chunks in runs of at most so many, whose chunks come apart again where they are put one after another; others stand alone."""
    whole = [i for i, c in enumerate(chunks) if _WHOLE.fullmatch(c)]
    runs = [whole[i : i + most] for i in range(0, len(whole), most)]
    return runs + [[i] for i in sorted(set(range(len(chunks))).difference(whole))] if len(whole) < len(chunks) else runs


def _open(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Words:
    """A file of the tokenizers library whose normalizer folds white space and whose pre-tokenizer drops it."""

    def __init__(self, path: str):
        self.tokenizer = _open(path)
        self.special = {t.content: 1 for t in self.tokenizer.get_added_tokens_decoder().values()}
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._normal, self._pre, self._model = self.tokenizer.normalizer.normalize_str, self.tokenizer.pre_tokenizer.pre_tokenize_str, self.tokenizer.model

    def chunks(self, text: str):
        for part in _slices(text, _BLANK):
            yield part.replace("\n", " ").split(" ")

    def pretokens(self, chunk: str) -> list[str]:
        if not chunk:
            return []
        if chunk.isascii():
            if chunk.isalpha():  # one run of letters
                return [chunk.lower()]
            if chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
                return [chunk[:-1].lower(), chunk[-1]]
        out = []
        for part in self._special.split(chunk) if self._special else [chunk]:
            if part in self.special:
                out.append(part)
            elif part:
                out += [p for p, _ in self._pre(self._normal(part))]
        return out

    def count(self, pretokens: list[str]) -> list[int]:
        return [self.special.get(p) or len(self._model.tokenize(p)) for p in pretokens]


class Bytes:
    """A byte-level file of the tokenizers library without a normalizer; special strings in texts are plain text."""

    def __init__(self, path: str):
        self.tokenizer = _open(path)
        self.tokenizer.encode_special_tokens = True
        points = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(points)]
        back = {chr(b): b for b in points} | {chr(256 + i): b for i, b in enumerate(rest)}
        # an id's bytes: printable bytes stand for themselves, the others for the characters from 256 on
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]


class Pieces:
    """A sentencepiece model with byte fallback, which puts a blank before every text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, self.model.id_to_piece(i)) for i in range(self.model.get_piece_size()))]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, chunks: list[str]) -> list[list[int]]:
        """chunks begin with the blank that the model adds."""
        return self.model.encode([c[1:] for c in chunks], num_threads=1)
