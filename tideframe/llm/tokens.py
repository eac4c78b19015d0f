"""Token ids and token counts of chunks of text, by the tokenizers library.

A chunk is a maximal run of bytes without ASCII white space. The normaliser of a word-level
vocabulary turns white space into single spaces and its pre-tokenizer never lets a piece span
them, so a text's ids are those of its chunks in turn. A vocabulary of which that does not hold
is refused with an error.
"""

from __future__ import annotations

import os
import sys
from array import array

import public_tokenizers

from tideframe.llm.common import held_in_worker

VOCABULARY = "word_bpe_49k.json"
_REMEMBER, _AT_ONCE = 800_000, 1024


def tokenizer(vocabulary: str = VOCABULARY):
    """The library's tokenizer, with truncation and padding off."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker on each core already
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    found.no_truncation()
    found.no_padding()
    ids = lambda text: found.encode(text, add_special_tokens=False).ids
    for a, b in (("the", "of"), ("A", "."), ("x1", "\u00e9\u6f22"), (".", "the")):
        if any(ids(a + white + b) != ids(a) + ids(b) for white in (" ", "  ", "\n", "\t", "\r\n", " \v\f")):
            raise ValueError(f"{vocabulary} has pieces that span white space; its texts cannot be encoded a chunk at a time")
    return found


class ChunkIds:
    """Ids of chunks as little-endian unsigned 32-bit bytes; so many distinct chunks are remembered."""

    def __init__(self, vocabulary: str = VOCABULARY):
        assert sys.byteorder == "little" and array("I").itemsize == 4
        self.tokenizer, self.known = tokenizer(vocabulary), {}

    def encode(self, chunks: list[bytes]) -> list[bytes]:
        out = []
        for start in range(0, len(chunks), _AT_ONCE):  # an encoding takes many times the room of its ids
            found = self.tokenizer.encode_batch_fast([c.decode("utf-8", "replace") for c in chunks[start : start + _AT_ONCE]], add_special_tokens=False)
            out.extend(array("I", e.ids).tobytes() for e in found)
        return out

    def texts(self, texts: list[list[bytes]]) -> list[bytes]:
        """The ids of each text, given as its chunks."""
        known = self.known
        new = list(set().union(*texts).difference(known))
        known.update(zip(new, self.encode(new), strict=True))
        out = [b"".join(map(known.__getitem__, chunks)) for chunks in texts]
        for chunk in new[max(0, _REMEMBER - len(known) + len(new)) :]:
            del known[chunk]
        return out


def chunk_ids(vocabulary: str = VOCABULARY) -> ChunkIds:
    """One for each Python worker, whose tasks of a stage follow each other and share what it remembers."""
    return held_in_worker(f"chunk ids {vocabulary}", lambda: ChunkIds(vocabulary))
