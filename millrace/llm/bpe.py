"""Token ids of whole texts by a byte-level BPE file, with a cache of words.

Such tokenizers never join a character that is not white space with white space after
it, and a single space always goes with the word that follows. So a text may be cut
before each run of white space, and equal pieces have equal ids wherever they stand: pieces are
encoded once and looked up afterwards. Texts in which white space stands alone
(nearly all) are cut by plain splitting, others by a pattern. A text with rarer kinds of
white space, on which the engines might differ, is encoded in one go.

Where the vocabulary also lies beside the file as ranks, new pieces are encoded from
those, which gives the same ids in a third of the time; pieces that may hold a special
token's text always go through the tokenizer itself.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Sequence
from pathlib import Path

import numpy as np

from millrace.llm.common import worker_cache

UNIT = re.compile(r"\s*\S+|\s+")
RARE_SPACE = [chr(c) for c in (*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
RARE_IN_ASCII = RARE_SPACE[:4]
TOGETHER = ["  ", " \n", "\n ", "\n\n", "\t", "\r", "\x0b", "\x0c"]  # white space that does not stand alone, or is no space or line end
CACHE = 800_000  # pieces kept per worker, some 200 MB in all
LONGEST = 64  # characters of a piece worth keeping


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer file, as installed on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces(dict):
    """Piece to ids, found out when first asked for; `before` is put in front of the piece."""

    def __init__(self, encode, before: str):
        super().__init__()
        self._encode, self._before = encode, before

    def __missing__(self, piece: str) -> bytes:
        value = np.array(self._encode(self._before + piece), dtype="<u4").tobytes()
        if len(piece) <= LONGEST:
            self[piece] = value
        return value


def encoder(path: str) -> Encoder:
    """One encoder per worker process: later tasks find the pieces of earlier ones."""
    return worker_cache(("encoder", path), lambda: Encoder(path))


class Encoder:
    """Turns texts into ids, as little-endian unsigned 32-bit integers in bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already uses every core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._fast = self._ranked(Path(path).with_suffix(".tiktoken"))
        self._marks = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._alone, self._after_space = Pieces(self._piece, ""), Pieces(self._piece, " ")

    @staticmethod
    def _ranked(ranks: Path):
        if not ranks.exists():
            return None
        import public_tokenizers
        import tiktoken

        lines = map(bytes.split, ranks.read_bytes().splitlines())
        known = {base64.b64decode(token): int(rank) for token, rank in lines}
        return tiktoken.Encoding(ranks.name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={}).encode_ordinary

    def _whole(self, text: str) -> list[int]:
        return self._tokenizer.encode(text, add_special_tokens=False).ids

    def _piece(self, piece: str) -> list[int]:
        if self._fast is None or any(mark in piece for mark in self._marks):
            return self._whole(piece)
        return self._fast(piece)

    def _one(self, text: str) -> bytes:
        alone, after_space = self._alone.__getitem__, self._after_space.__getitem__
        if any(map(text.__contains__, RARE_IN_ASCII if text.isascii() else RARE_SPACE)):
            return np.array(self._whole(text), dtype="<u4").tobytes()
        if text[0] == " " or text[-1] == " " or any(map(text.__contains__, TOGETHER)):
            return b"".join(map(alone, UNIT.findall(text)))
        end, found = alone("\n"), []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            found.append(alone(first))
            found.extend(map(after_space, rest))
            found.append(end)
        return b"".join(found[:-1])

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text; a null text counts as empty."""
        found = []
        for text in texts:
            found.append(self._one(text) if text else b"")
            if len(self._alone) + len(self._after_space) > CACHE:
                self._alone.clear()
                self._after_space.clear()
        return found
