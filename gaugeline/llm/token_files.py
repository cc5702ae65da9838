"""Token-id files: ids of many documents one after another, with Elias-Fano coded boundaries."""

from __future__ import annotations

import itertools
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.storage import open_input, open_output, shared_folder, stored
from gaugeline.llm.subword import encoder

END_ID = 2
MAGIC = b"TOKIDS01"
#: Bytes an id, ids, documents without a doc_id, bytes of both coded lists, magic.
TAIL = "<BQQQQ8s"
#: One bits between two samples of the select structure.
SAMPLE = 256
#: Ids read from a file at once.
BLOCK = 2**20


class EliasFano:
    """A non-decreasing list of n values below u in about n * (2 + log2(u / n)) bits.

    The low bits of each value stand side by side; the high bits are unary, a one
    bit at ``high + index``. Every SAMPLE-th one bit's place is stored, so that
    ``select`` looks at a stretch of bounded length on average.
    """

    HEAD = struct.Struct("<QQBQQQ")

    def __init__(self, n: int, base: int, low_bits: int, lows: np.ndarray, highs: np.ndarray, samples: np.ndarray):
        self.n, self.base, self.low_bits = n, base, low_bits
        self.lows, self.highs, self.samples = lows, highs, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n, base = len(values), int(values[0]) if len(values) else 0
        rest = (values - base).view(np.uint64)  # modulo 2**64, right for any span of signed values
        top = int(rest[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        lows = np.zeros((n, low_bits), np.uint8)
        for bit in range(low_bits):
            lows[:, bit] = (rest >> np.uint64(bit)) & np.uint64(1)
        ones = (rest >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        return cls(n, base, low_bits, np.packbits(lows.ravel(), bitorder="little"), np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype("<u8"))

    def to_bytes(self) -> bytes:
        parts = [self.lows.tobytes(), self.highs.tobytes(), self.samples.tobytes()]
        head = self.HEAD.pack(self.n, self.base % 2**64, self.low_bits, *map(len, parts))
        return head + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, base, low_bits, *sizes = cls.HEAD.unpack_from(data)
        at, parts = cls.HEAD.size, []
        for size in sizes:
            parts.append(data[at : at + size])
            at += size
        if at != len(data):
            raise ValueError("damaged boundary block")
        lows, highs = (np.frombuffer(x, np.uint8) for x in parts[:2])
        return cls(n, base - 2**64 if base >= 2**63 else base, low_bits, lows, highs, np.frombuffer(parts[2], "<u8"))

    def select(self, index: int) -> int:
        """The place of one bit number ``index`` among the high bits."""
        at, left = int(self.samples[index // SAMPLE]), index % SAMPLE
        while True:
            byte = at // 8
            bits = np.unpackbits(self.highs[byte : byte + 64], bitorder="little")[at - 8 * byte :]
            ones = np.flatnonzero(bits)
            if left < len(ones):
                return at + int(ones[left])
            left -= len(ones)
            at += len(bits)

    def __getitem__(self, index: int) -> int:
        """One value, without decoding the others."""
        if not 0 <= index < self.n:
            raise IndexError(index)
        start, low = index * self.low_bits, 0
        if self.low_bits:
            byte = start // 8
            word = int.from_bytes(self.lows[byte : byte + 9].tobytes(), "little")
            low = word >> (start - 8 * byte) & ((1 << self.low_bits) - 1)
        return self.base + ((self.select(index) - index) << self.low_bits | low)

    def decode(self) -> np.ndarray:
        """All values."""
        ones = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.n]
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(self.lows, count=self.n * self.low_bits, bitorder="little")
            bits = bits.reshape(self.n, self.low_bits)
            for bit in range(self.low_bits):
                out |= bits[:, bit].astype(np.uint64) << np.uint64(bit)
        return out.view(np.int64) + self.base


def write_token_files(
    docs: DataFrame, end_id: int = END_ID, tokenizer: str | None = None, folder: str | None = None
) -> DataFrame:
    """Write the ids of all texts in ascending doc_id order; returns the list of files.

    A range of doc_ids is a task and a file: magic, ids (16 bits each where the
    vocabulary allows it, else 32), Elias-Fano doc_ids, Elias-Fano boundaries and
    a tail with the sizes. The list has (number, file, n_docs, n_nulls, n_ids, start),
    start being the ids in all files before. A repeated task writes a file of
    another name, and only files of tasks that ended well are listed.

    Null text: the end id alone. Repeated rows: each is written; ties of doc_id
    follow the text. Null doc_id: first, counted in n_nulls. Empty table: no file.
    """
    folder = folder or shared_folder(docs.sparkSession, "token-files")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer)
        kind = f"<u{ids_of.width if end_id < 2**16 else 4}"
        end = np.array([end_id], "<u4").tobytes()
        out, names, ends, total, nulls = None, [], [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                if out is None:
                    file = f"{folder}/{uuid.uuid4().hex}.ids"
                    out = open_output(file)
                    out.write(MAGIC)
                part = batch.slice(at, 128)
                own = part.column(0).to_pylist()
                nulls += own.count(None)
                names += [x for x in own if x is not None]
                found = ids_of.encode(part.column(1).to_pylist())
                out.write(np.frombuffer(end.join([*found, b""]), "<u4").astype(kind))
                for ids in found:
                    total += len(ids) // 4 + 1
                    ends.append(total)
        if out is not None:
            blocks = [EliasFano.of(np.array(x, np.int64)).to_bytes() for x in (names, ends)]
            out.write(b"".join(blocks) + struct.pack(TAIL, int(kind[2]), total, nulls, *map(len, blocks), MAGIC))
            out.close()
            first = names[0] if names else None
            row = [first, nulls > 0, file, len(ends), nulls, total]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, (pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                names=["first", "nulls", "file", "n_docs", "n_nulls", "n_ids"],
            )

    ranged = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    files = stored(
        ranged.mapInArrow(write, "first long, nulls boolean, file string, n_docs long, n_nulls long, n_ids long"),
        "token-list",
    )
    ahead = Window.orderBy(F.col("nulls").desc(), F.col("first").asc_nulls_first())  # a row a file
    return files.select(
        (F.row_number().over(ahead) - 1).alias("number"), "file", "n_docs", "n_nulls", "n_ids",
        F.coalesce(F.sum("n_ids").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
    )


class TokenFile:
    """One file opened for reading; documents are fetched by their place in it."""

    def __init__(self, uri: str):
        self.input = open_input(uri)
        size = self.input.size()
        self.input.seek(size - struct.calcsize(TAIL))
        self.width, self.n_ids, self.n_nulls, names, ends, magic = struct.unpack(TAIL, self.input.read(struct.calcsize(TAIL)))
        self.input.seek(0)
        if magic != MAGIC or self.input.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"not a token-id file: {uri}")
        if size != len(MAGIC) + self.width * self.n_ids + names + ends + struct.calcsize(TAIL):
            raise ValueError(f"damaged token-id file: {uri}")
        self.input.seek(len(MAGIC) + self.width * self.n_ids)
        self.names = EliasFano.from_bytes(self.input.read(names))
        self.ends = EliasFano.from_bytes(self.input.read(ends))

    def __len__(self) -> int:
        return self.ends.n

    def doc_id(self, place: int) -> int | None:
        return None if place < self.n_nulls else self.names[place - self.n_nulls]

    def bounds(self, place: int) -> tuple[int, int]:
        """Start and end of a document's ids, from the select structure."""
        return (self.ends[place - 1] if place else 0), self.ends[place]

    def ids(self, start: int, end: int) -> np.ndarray:
        self.input.seek(len(MAGIC) + self.width * start)
        return np.frombuffer(self.input.read(self.width * (end - start)), f"<u{self.width}")

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Each document's id, start and ids: bounds by select, ids read BLOCK at a time."""
        low, block = 0, np.zeros(0, "<u2")
        for place in range(len(self)):
            start, end = self.bounds(place)
            if end > low + len(block):
                low, block = start, self.ids(start, min(self.n_ids, max(end, start + BLOCK)))
            yield self.doc_id(place), start, block[start - low : end - low]


def read_token_files(files: DataFrame) -> DataFrame:
    """The documents of listed files: (doc_id, start, n_tokens, ids_crc32)."""

    def read(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in groups:
            for name, before in zip(group["file"], group["start"]):
                rows = (
                    (doc, int(before) + start, len(ids), zlib.crc32(ids.astype("<u4")))
                    for doc, start, ids in TokenFile(name).documents()
                )
                while part := list(itertools.islice(rows, 1000)):
                    yield pd.DataFrame(part, columns=["doc_id", "start", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})

    spread = files.select("file", "start").repartition(files.sparkSession.sparkContext.defaultParallelism * 4, "file")
    return spread.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_offsets(docs: DataFrame, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """Write token-id files of all documents and read each document back."""
    return read_token_files(write_token_files(docs, end_id, tokenizer))
