"""Token ids of whole texts by a public word-BPE vocabulary, with a bounded cache of pieces."""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np

from gaugeline.llm.caches import kept

#: A piece of lower-case text as the vocabulary's own splitting rule makes it, over Latin-1.
PIECE = re.compile(r"[a-zß-öø-ÿ]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^a-z0-9ß-öø-ÿ\s]+")
#: Texts and chunks that NFC leaves alone and for which PIECE equals the vocabulary's rule.
PLAIN = re.compile(r"[\x20-\x7Eß-öø-ÿÀ-ÖØ-Þ\n\t\r]*").fullmatch
CACHE_PIECES = 300_000
#: Longer pieces are computed each time, so that the cache is bounded in bytes too.
LONG = 64
#: The byte alphabet of such vocabularies: printable Latin-1 stands for itself, other bytes follow from 256 on.
SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
ALPHABET = dict(zip(SHOWN, SHOWN)) | {b: 256 + k for k, b in enumerate(x for x in range(256) if x not in set(SHOWN))}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Generations(dict):
    """Values of a function, kept in two generations of at most ``limit`` keys each.

    A full generation becomes the older one; what is still in use is taken over
    from there, so that frequent keys are never computed twice in a row.
    """

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.older = compute, limit, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) > LONG:
            return value
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class ChunkEncoder:
    """Ids of texts, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    The vocabulary drops white space, and nothing it does reaches across a
    blank. A text of printable ASCII and Latin-1 letters is cut by PIECE, and
    pieces not in the bounded cache go to the vocabulary's own merge rules. Any
    other text is cut at blanks first; what is still not plain is encoded whole.
    """

    def __init__(self, path: str | None = None, limit: int = CACHE_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        path = path or default_tokenizer()
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.special = [token["content"] for token in rules["added_tokens"]]
        self.tokens = self.whole.model.tokenize
        self.width = 2 if self.whole.get_vocab_size() <= 2**16 else 4
        self.pieces = Generations(self._piece, limit)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers; no text has no ids."""
        return [self.ids(text or "") for text in texts]

    def ids(self, text: str) -> bytes:
        if any(token in text for token in self.special):
            return self._whole(text)
        if PLAIN(text):
            return b"".join(map(self.pieces.__getitem__, PIECE.findall(text.lower())))
        return b"".join(map(self._chunk, text.replace("\n", " ").split(" ")))

    def _chunk(self, chunk: str) -> bytes:
        if PLAIN(chunk):
            return b"".join(map(self.pieces.__getitem__, PIECE.findall(chunk.lower())))
        return self._whole(chunk)

    def _whole(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(ALPHABET)
        found = [token.id for token in self.tokens(piece)]
        return struct.pack(f"<{len(found)}I", *found)


def encoder(path: str | None = None) -> ChunkEncoder:
    """The encoder of this worker process, so that its cache serves later tasks too."""
    return kept(("pieces", path), lambda: ChunkEncoder(path))
