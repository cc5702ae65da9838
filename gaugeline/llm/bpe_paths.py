"""Word-BPE ids by dynamic programming over prefixes, and the way back from ids to text."""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.subword import ALPHABET, PIECE, PLAIN, Generations, default_tokenizer

#: Compatible and incompatible token pairs a worker remembers.
CACHE_PAIRS = 600_000
CACHE_PIECES = 200_000
#: Stands for the word-end mark, which belongs to the character before it.
END = "\0"
NEVER = 2**62


class MergeRules:
    """Tokens as trees of merges, and which tokens may stand side by side.

    BPE applies the merge of the lowest rank first and the leftmost among equals.
    While a token grows, its last symbol is one after another the symbols of its
    right spine, each from its own rank until that of its parent; likewise the
    first symbol and the left spine. A border between two tokens holds if no merge
    of a symbol of the one with a symbol of the other has its turn while both
    are there. The rank of a merge must be above the ranks of its parts, which
    training gives; it is checked.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str):
        self.names = [""] * (max(vocabulary.values()) + 1)
        for name, number in vocabulary.items():
            self.names[number] = name
        self.shape = {  # the text of a token, its word-end mark as one character
            number: name.removesuffix(suffix) + END if name.endswith(suffix) else name for name, number in vocabulary.items()
        }
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rule: dict[tuple[int, int], int] = {}
        used: set[int] = set()
        for rank, merge in enumerate(merges):
            left, right = merge if isinstance(merge, (list, tuple)) else merge.split(" ")
            a, b, whole = vocabulary[left], vocabulary[right], vocabulary[left + right]
            used |= {a, b}
            if whole in used or whole in self.parts:
                raise ValueError(f"merge {rank} is not in the order of training")
            self.rank[whole], self.parts[whole], self.rule[a, b] = rank, (a, b), rank
        self.left = [self._spine(token, 0) for token in range(len(self.names))]
        self.right = [self._spine(token, 1) for token in range(len(self.names))]
        whole = {token for token in self.shape if token not in self.parts}
        for token in sorted(self.parts, key=self.rank.get):  # parts before wholes
            a, b = self.parts[token]
            if a in whole and b in whole and self.first_merge(a, b) == self.rank[token]:
                whole.add(token)
        self.reachable = whole

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """(symbol, rank of the merge that ends it), from a single character to the token."""
        spine, until = [(token, NEVER)], NEVER
        while token in self.parts:
            until, token = self.rank[token], self.parts[token][side]
            spine.append((token, until))
        return spine[::-1]

    def first_merge(self, u: int, v: int) -> int | None:
        """The rank of the first merge across the border of two tokens, if there is one."""
        ours, theirs = iter(self.right[u]), iter(self.left[v])
        (a, a_until), (b, b_until) = next(ours), next(theirs)
        while True:
            rank = self.rule.get((a, b))
            # of equal merges the leftmost comes first: before the border, inside u
            if rank is not None and rank < a_until and rank <= b_until:
                return rank
            if a_until == b_until == NEVER:
                return None
            if a_until <= b_until:
                a, a_until = next(ours)
            else:
                b, b_until = next(theirs)


class Borders(dict):
    """Whether BPE leaves two tokens as they are where they meet, by ``u << SHIFT | v``.

    Token number ``START`` stands for the beginning of a piece.
    """

    SHIFT, START = 24, 2**24 - 1

    def __init__(self, rules: MergeRules):
        super().__init__()
        self.rules = rules

    def __missing__(self, pair: int) -> bool:
        u, v = pair >> self.SHIFT, pair & self.START
        if len(self) >= CACHE_PAIRS:
            self.clear()
        self[pair] = holds = u == self.START or self.rules.first_merge(u, v) is None
        return holds


class PathEncoder:
    """``encode`` and ``decode`` of a word-BPE tokenizer file without its merge loop.

    Exactly one token ends the BPE of a prefix, and it is the one that ends the
    prefix as text, follows a border that holds, and leaves a shorter prefix. An
    automaton over all tokens (Aho-Corasick) gives the tokens that end each prefix;
    the first whose border with the last token of the remaining prefix holds is
    stored, and the stored tokens are followed back from the end. The work is
    linear in the length of a piece. Normalisation and splitting into pieces are
    the file's own rules, for plain texts by the equal pattern PIECE.
    """

    def __init__(self, path: str | None = None, limit: int = CACHE_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import ahocorasick
        from tokenizers import Tokenizer

        path = path or default_tokenizer()
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        model = rules["model"]
        self.rules = MergeRules(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.borders = Borders(self.rules)
        self.added = {token["content"]: token["id"] for token in rules["added_tokens"]}
        self.names = [*self.rules.names, *[""] * (max(self.added.values(), default=-1) + 1 - len(self.rules.names))]
        for name, number in self.added.items():
            self.names[number] = name
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split if self.added else lambda text: [text]
        own = Tokenizer.from_file(path)
        self.normalizer, self.splitter = own.normalizer, own.pre_tokenizer
        self.automaton = ahocorasick.Automaton()
        for token in self.rules.reachable:
            shape = self.rules.shape[token]
            self.automaton.add_word(shape, (token, len(shape)))
        self.automaton.make_automaton()
        self.plain = Generations(lambda piece: self.solve(piece if piece.isascii() else shown(piece)), limit)
        self.other = Generations(self.solve, limit)

    def last_tokens(self, piece: str) -> list[int]:
        """For each prefix of a piece in the byte alphabet its unique last token; -1 where there is none."""
        word, borders, shift = piece + END, self.borders, Borders.SHIFT
        last = [Borders.START] + [-1] * len(word)
        for end, (token, length) in self.automaton.iter(word):
            if last[end + 1] < 0:
                before = last[end + 1 - length]
                if before >= 0 and borders[before << shift | token]:
                    last[end + 1] = token
        if last[-1] < 0:
            raise ValueError(f"no token path for {piece[:50]!r}")
        return last

    def solve(self, piece: str) -> bytes:
        """Ids of one piece, little-endian unsigned 32-bit."""
        last, at, ids = self.last_tokens(piece), len(piece) + 1, []
        while at:
            ids.append(last[at])
            at -= len(self.rules.shape[last[at]])
        return struct.pack(f"<{len(ids)}I", *ids[::-1])

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text; no text has none."""
        out = []
        for k, part in enumerate(self.cut(text or "")):
            if k % 2:  # an added token's own string
                out.append(struct.pack("<I", self.added[part]))
            elif PLAIN(part):
                out += map(self.plain.__getitem__, PIECE.findall(part.lower()))
            else:  # no rule of such files reaches across a blank
                for chunk in part.replace("\n", " ").split(" "):
                    if PLAIN(chunk):
                        out += map(self.plain.__getitem__, PIECE.findall(chunk.lower()))
                    else:
                        split = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(chunk))
                        out += [self.other[piece] for piece, _ in split]
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids: the strings of their tokens, joined by blanks."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def shown(piece: str) -> str:
    """A piece in the byte alphabet of the vocabulary."""
    return piece.encode().decode("latin-1").translate(ALPHABET)


_encoders: dict[str | None, PathEncoder] = {}


def path_encoder(path: str | None = None) -> PathEncoder:
    """The encoder of this worker process, so that its caches serve later tasks too."""
    if path not in _encoders:
        _encoders[path] = PathEncoder(path)
    return _encoders[path]


def _mapped(frame: DataFrame, column: str, result: str, kind: str, work) -> DataFrame:
    """``frame`` (doc_id, column) with the column's values mapped by ``work`` in small batches."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                values = pa.array(map(work, part.column(1).to_pylist()), pa.string() if kind == "string" else pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), values], names=["doc_id", result])

    return frame.select("doc_id", column).mapInArrow(apply, f"doc_id long, {result} {kind}")


def encode_texts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Ids of every whole text: (doc_id, ids), ids being little-endian unsigned 32-bit integers.

    Null and empty text: no ids. A null doc_id is kept; repeated rows and
    doc_ids stay rows of their own; other columns of any name are left out. Texts of
    any length are encoded whole, in time linear in their length. Two tokens never
    tie: the last token of a prefix is unique. Empty table: no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _mapped(texts, "text", "ids", "binary", lambda text: path_encoder(tokenizer).encode(text))


def decode_ids(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The text of every row's ids: (doc_id, text); null ids give the empty text."""
    return _mapped(encoded, "ids", "text", "string", lambda ids: path_encoder(tokenizer).decode(ids or b""))


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Ids of every text and the text they decode to: (doc_id, ids, decoded).

    Both steps run in one pass; nulls, ties, repeated rows and names as in
    ``encode_texts``.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = path_encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ids = list(map(own.encode, part.column(1).to_pylist()))
                decoded = pa.array(map(own.decode, ids), pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), decoded], names=["doc_id", "ids", "decoded"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(apply, "doc_id long, ids binary, decoded string")


def round_trip_digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Per document the number of ids and digests of ids and decoded text."""
    return round_trip(docs, tokenizer).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
