"""Best-fit packing of token sequences with a bounded number of open bins.

Each document is tokenized whole and ends with one separator id. A document longer than a sequence is cut, its first piece takes
the remainder. Pieces go to the open bin with the least room that is enough for them, which a bitset keyed by free space finds in
one step; when too many bins are open, the fullest closes first. Each task packs its own documents as they stream by (of
``GROUP_ROWS`` or ``GROUP_BYTES`` of rows longer pieces go first), so documents are not shuffled and memory does not grow with the input: a task holds the pieces of its open bins.

What a task leaves in bins that are less full than ``full_enough`` it hands out without a place, ``most_open`` bins at most. Those pieces alone are
dealt to few tasks, one for ``REST_IDS`` ids, and packed again in the same way, so that the number of sequences hangs little on that of tasks.

Cases: a null or empty text is one separator id; repeated rows are packed each; an empty table gives no pieces; extra
columns are ignored; a text of any length is tokenized whole.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithscope.llm.frames import bounded_batches, stored

PIECES = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
NAMES = [c.split()[0] for c in PIECES.split(", ")]
REST_IDS = 1 << 23
GROUP_ROWS = 10_000
GROUP_BYTES = 64 << 20
SECOND = 1 << 62
"""Sequences of the second packing are numbered from here."""

_TOKENIZERS: dict[tuple[str, str | None], ByteTokenizer] = {}


class ByteTokenizer:
    """Ids of a byte-level BPE tokenizer, little-endian unsigned 32-bit.

    ``path`` is the tokenizer's file, and ids are what it gives without special tokens put around the text. With ``ranks_path``, the
    same vocabulary as ranks, Latin-1 texts take a three times faster encoder that gives the same ids; others, for which character
    tables of libraries may differ, and texts that hold an added token of the file, which ranks do not know, always take the first.
    """

    def __init__(self, path: str, ranks_path: str | None = None, pattern: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = None
        # A normalizer could make an added token of other characters.
        if ranks_path and (self.tokenizer.normalizer is None or not self.added):
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        if self.fast is not None and not any(token in text for token in self.added):
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()


def _tokenizer(path: str, ranks_path: str | None, pattern: str | None) -> ByteTokenizer:
    """One per Python worker."""
    if (path, ranks_path) not in _TOKENIZERS:
        _TOKENIZERS[path, ranks_path] = ByteTokenizer(path, ranks_path, pattern)
    return _TOKENIZERS[path, ranks_path]


class Packer:
    """Best fit into at most ``most_open`` open bins of ``capacity`` places."""

    def __init__(self, capacity: int, most_open: int, first_bin: int) -> None:
        self.capacity, self.most_open, self.next_bin = capacity, most_open, first_bin
        self.free_sizes = 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.n_open = 0
        self.closed: list[int] = []

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset in it) for a piece of 1 to ``capacity`` ids."""
        fitting = self.free_sizes >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(free)
        else:
            free, bin_ = self.capacity, self.next_bin
            self.next_bin += 1
        if free > length:
            self._open(bin_, free - length)
        else:
            self.closed.append(bin_)
        return bin_, self.capacity - free

    def left_over(self, full_enough: int) -> set[int]:
        """The open bins that hold fewer ids."""
        return {b for free in range(self.capacity - full_enough + 1, self.capacity + 1) for b in self.bins[free]}

    def _take(self, free: int) -> int:
        bin_ = self.bins[free].pop()
        if not self.bins[free]:
            self.free_sizes &= ~(1 << free)
        self.n_open -= 1
        return bin_

    def _open(self, bin_: int, free: int) -> None:
        self.bins[free].append(bin_)
        self.free_sizes |= 1 << free
        self.n_open += 1
        if self.n_open > self.most_open:
            self.closed.append(self._take((self.free_sizes & -self.free_sizes).bit_length() - 1))


Piece = tuple[int | None, int, int, int, bytes]
"""doc_id, piece, start, length, ids."""


def _rows(pieces: list[tuple]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    for lo in range(0, len(pieces), 2000):
        columns = zip(*pieces[lo : lo + 2000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=NAMES)


def _place_all(groups: Iterator[list[Piece]], packer: Packer, full_enough: int) -> Iterator[pa.RecordBatch]:
    """Rows of all pieces. A bin's rows go out when it closes; those of bins less full than ``full_enough`` come last, without a place."""
    held: dict[int, list[tuple]] = {}
    for pieces in groups:
        for piece in sorted(pieces, key=lambda p: -p[3]):
            bin_, offset = packer.place(piece[3])
            held.setdefault(bin_, []).append((*piece, bin_, offset))
        yield from _rows([row for b in packer.closed for row in held.pop(b)])
        packer.closed.clear()
    rest = packer.left_over(full_enough)
    yield from _rows([row for b, rows in held.items() if b not in rest for row in rows])
    yield from _rows([(*row[:5], None, None) for b in rest for row in held[b]])


def _together(batches: Iterator[pa.RecordBatch], pieces_of: Callable[[pa.RecordBatch], list[Piece]]) -> Iterator[list[Piece]]:
    """Pieces of as many batches as make ``GROUP_ROWS`` rows or ``GROUP_BYTES``: how well they pack does not hang on the size of batches."""
    group, rows, size = [], 0, 0
    for batch in batches:
        group += pieces_of(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= GROUP_ROWS or size >= GROUP_BYTES:
            yield group
            group, rows, size = [], 0, 0
    if group:
        yield group


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    ranks_path: str | None = None,
    pattern: str | None = None,
    capacity: int = 2048,
    separator: int = 0,
    most_open: int = 8192,
    full_enough: int | None = None,
) -> DataFrame:
    """One row per piece: its ids (little-endian unsigned 32-bit), place in its document and place in its sequence.

    ``full_enough`` ids (98 of a hundred places, if not given) are what a sequence needs to be left as it is when a task ends.
    """
    enough = capacity - capacity // 50 if full_enough is None else full_enough
    bounded_batches(docs.sparkSession)
    spread = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path, ranks_path, pattern)
        end = np.array([separator], dtype="<u4").tobytes()

        def cut(batch: pa.RecordBatch) -> list[Piece]:
            pieces = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = tokenizer.ids(text.as_py() or "") + end
                n = len(ids) // 4
                at = n % capacity or capacity
                pieces.append((doc, 0, 0, at, ids[: 4 * at]))
                for k in range(n // capacity if at < capacity else n // capacity - 1):
                    pieces.append((doc, k + 1, at, capacity, ids[4 * at : 4 * (at + capacity)]))
                    at += capacity
            return pieces

        yield from _place_all(_together(batches, cut), Packer(capacity, most_open, TaskContext.get().partitionId() << 40), enough)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _together(batches, lambda b: list(zip(*(b.column(c).to_pylist() for c in NAMES[:5]), strict=True)))
        yield from _place_all(pieces, Packer(capacity, most_open, SECOND + (TaskContext.get().partitionId() << 40)), 0)

    # Written once: tokenizing is most of the work, and both packings read it.
    placed = stored(spread.mapInArrow(first, PIECES), "pieces")
    rest = placed.filter("sequence_id is null")
    left = rest.agg(F.sum("length")).first()[0] or 0
    return placed.filter("sequence_id is not null").unionByName(rest.repartition(1 + left // REST_IDS).mapInArrow(second, PIECES))
