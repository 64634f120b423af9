"""Best-fit packing of tokenised documents into sequences of a fixed length.

Bounded-space online best fit. Pieces reach a task in hash order and are placed block by block,
longest first within a block; a piece goes to the open sequence whose free space is the least
that holds it. The free spaces of the open sequences are the set bits of one integer, so the
search is a shift and a lowest-set-bit. When more than ``open_bins`` are open, the fullest
closes first. The number of tasks follows the bytes of the piece table (adaptive coalescing),
never the text, and each task leaves at most a few sequences part filled.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import slices

SEQUENCE_LENGTH = 2048
OPEN_BINS = 32_768
BLOCK = 65_536
END_ID = 0

PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)

#: From so much white space on, the fast pattern matcher may run out of stack.
LONG_BLANK = 10_000
_LONG_BLANK = re.compile(rf"(?<!\s)\s{{{LONG_BLANK}}}")

_tokenizers: dict[str, object] = {}


class ByteBpe:
    """The ids that ``tokenizers`` gives for a byte-level BPE file, without special tokens added.

    Plain text goes through ``tiktoken`` with the same vocabulary as ranks, which gives the same
    ids about five times faster; a text that holds a special token's string goes through
    ``tokenizers`` itself, which turns it into that token's id, and so does a text whose runs of white
    space are too long for the fast pattern matcher.
    """

    def __init__(self, name: str = "byte_bpe_50k"):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]

    def ids(self, text: str) -> np.ndarray:
        if not any(s in text for s in self.special) and not (len(text) >= LONG_BLANK and _LONG_BLANK.search(text)):
            try:
                return np.asarray(self.fast.encode_ordinary(text), dtype="<u4")
            except BaseException as error:  # its pattern matcher gives up by a panic, which is no Exception
                if type(error).__name__ != "PanicException":
                    raise
        return np.asarray(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u4")


def tokenizer(name: str) -> ByteBpe:
    if name not in _tokenizers:
        _tokenizers[name] = ByteBpe(name)
    return _tokenizers[name]


def cut(ids: np.ndarray, length: int = SEQUENCE_LENGTH) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of one document; only the first piece of a long one may be short."""
    n = len(ids)
    head = n if n <= length else (n % length or length)
    piece, start, size = 0, 0, head
    while start < n:
        yield piece, start, size, zlib.crc32(ids[start : start + size].tobytes())
        piece, start, size = piece + 1, start + size, length


def token_pieces(documents: DataFrame, length: int = SEQUENCE_LENGTH, vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row; a null text counts as empty.

    Every document ends with id 0, so an empty text is one piece of one id. A repeated row
    gives its pieces again; a null doc_id stays null. Other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(vocabulary)
        end = np.array([END_ID], dtype="<u4")
        for part in slices(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                ids = np.concatenate([bpe.ids(text), end]) if text else end
                rows += [(doc_id, *x) for x in cut(ids, length)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PIECES.types, strict=True)], schema=PIECES
            )

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class BestFit:
    """Open sequences by free space; place() gives the sequence and the offset for a length."""

    def __init__(self, length: int, open_bins: int, first_id: int = 0):
        self.length, self.most = length, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(length + 1)]
        self.mask = 0  # bit f is set while an open sequence has f places free
        self.n_open = 0
        self.next_id = first_id

    def place(self, size: int) -> tuple[int, int]:
        fits = self.mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            bin_id = self._take(free)
        else:
            free, bin_id = self.length, self.next_id
            self.next_id += 1
        left = free - size
        if left:
            self.by_free[left].append(bin_id)
            self.mask |= 1 << left
            self.n_open += 1
            if self.n_open > self.most:
                self._take((self.mask & -self.mask).bit_length() - 1)
        return bin_id, self.length - free

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        bin_id = bins.pop()
        if not bins:
            self.mask &= ~(1 << free)
        self.n_open -= 1
        return bin_id


def pack(pieces: DataFrame, length: int = SEQUENCE_LENGTH, open_bins: int = OPEN_BINS, block: int = BLOCK) -> DataFrame:
    """pieces with sequence_id and offset added; their other columns are doc_id, piece, start, length, ids_crc32.

    An empty table gives an empty table. Equal pieces are placed one after the other. A null length or one
    above ``length`` or below 1 is an error; other columns may be null.
    """
    out_schema = PIECES.append(pa.field("sequence_id", pa.int64())).append(pa.field("offset", pa.int64()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = BestFit(length, open_bins, TaskContext.get().partitionId() << 40)

        def placed(table: pa.Table) -> pa.RecordBatch:
            sizes = table.column("length").to_numpy()
            if table.column("length").null_count or len(sizes) and not 1 <= sizes.min() <= sizes.max() <= length:
                raise ValueError(f"piece lengths must lie in 1..{length}")
            ids, at = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
            for k in np.argsort(-sizes, kind="stable"):
                ids[k], at[k] = bins.place(int(sizes[k]))
            full = table.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(at))
            return full.cast(out_schema).combine_chunks().to_batches()[0]

        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= block:
                yield placed(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield placed(pa.Table.from_batches(held))

    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    order = F.xxhash64(*columns)
    dealt = pieces.select(*columns).repartition(order).sortWithinPartitions(order, *columns)
    return dealt.mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def pack_documents(documents: DataFrame, length: int = SEQUENCE_LENGTH) -> DataFrame:
    """Tokenise, cut and pack every document; see token_pieces() and pack()."""
    return pack(token_pieces(documents, length), length)
