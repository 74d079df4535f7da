"""Tokenise documents and pack them into fixed-length sequences.

Every Spark task packs the rows it has read, as they come: an online best-fit with a bounded number
of open bins.  The open bins are kept by free space in a bitset (a Python integer, one bit per free
length), so the tightest bin that still holds a piece is the lowest set bit at or above the piece's
length.  When the bound is reached the fullest bin (the lowest set bit) closes first.

A task's bins that are still open at its end, but for nearly full ones, are not sequences yet: their
pieces go through the same best-fit again with those of up to 31 other tasks, and so on until one
group is left.  A group hands on the pieces of at most ``open_bins`` bins, so every merge is bounded,
and only these pieces (lengths, not texts, unless the ids are asked for) are shuffled.  Pieces come to
a merge in the order of a hash, each run of ``open_bins`` pieces longest first.  Every level is a
written table; a task that is run again gives the same sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from .scratch import Scratch

SEQUENCE_TOKENS = 4096
OPEN_BINS = 1024
CACHE_CHUNKS, CACHE_WORDS = 500_000, 400_000
_DIRECT = tuple(chr(c) for c in range(0x1C, 0x20))
#: The vocabulary's word pattern; runs of its words between white space are tokenised one by one.
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


class TwoGenerations:
    """A cache of bounded size: what the last generation did not use is forgotten.

    ``lacking`` moves what is known to the young generation; after ``young`` has been given the rest,
    it holds everything that was wanted.
    """

    def __init__(self, size: int):
        self.size = size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def lacking(self, wanted: set[str]) -> list[str]:
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        lack = wanted.difference(self.young)
        old = self.old
        again = [w for w in lack if w in old]
        self.young.update(zip(again, map(old.__getitem__, again)))
        lack.difference_update(again)
        return list(lack)

    def forget(self, words: list[str]) -> None:
        """Long words are not kept."""
        for w in words:
            if len(w) > 64:
                self.young.pop(w, None)


class ChunkTokenizer:
    """Ids of whole texts as little-endian uint32 bytes.

    The tokenizer never joins words across white space, so a text's ids are those of its space-free
    chunks in order, and a plain chunk's ids are those of its words.  Chunks and words are remembered
    up to a bounded number.  What is not plain (outside the Latin blocks, or with a mark that the
    tokenizer treats by context) goes to the tokenizer as it is, and so do whole texts with one of
    the four separators that only Python counts as white space.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.encode = Tokenizer.from_file(path)
        self.chunks, self.words = TwoGenerations(CACHE_CHUNKS), TwoGenerations(CACHE_WORDS)
        vocab = self.encode.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for w, i in vocab.items() if w.endswith("</w>")]] = True

    def _direct(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.encode.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        out = {}
        groups = [words[a : a + 500] for a in range(0, len(words), 500)]
        lines = self.encode.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for g, line in zip(groups, lines):
            ids = np.array(line.ids, "<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(g):
                raw, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
                out.update((w, raw[cuts[i] : cuts[i + 1]]) for i, w in enumerate(g))
            else:
                out.update(zip(g, self._direct(g)))
        return out

    def _encode_chunks(self, chunks: list[str]) -> dict[str, bytes]:
        """Most chunks are a word, or a word and one mark; only others need the pattern."""
        alone, marked, mixed, other, wanted = {}, {}, {}, [], set()
        for c in chunks:
            if not (c.isascii() or max(c) < "\u0250") or "<|" in c:
                other.append(c)
                continue
            low = c.lower()
            if low.isalpha():
                alone[c] = low
            elif low[-1] in ".,!?;:" and low[:-1].isalpha():
                marked[c] = low
            else:
                mixed[c] = found = _WORD.findall(low)
                wanted.update(found)
        wanted.update(alone.values())
        wanted.update([w[:-1] for w in marked.values()])
        wanted.update([w[-1] for w in marked.values()])
        missing = self.words.lacking(wanted)
        known = self.words.young
        known.update(self._encode_words(missing))
        out = {c: known[w] for c, w in alone.items()}
        out.update([(c, known[w[:-1]] + known[w[-1]]) for c, w in marked.items()])
        out.update([(c, b"".join([known[w] for w in found])) for c, found in mixed.items()])
        out.update(zip(other, self._direct(other)))
        self.words.forget(missing)
        return out

    def texts(self, texts: list[str]) -> list[bytes]:
        split = [None if any(c in t for c in _DIRECT) else t.split() for t in texts]
        wanted: set[str] = set()
        for s in split:
            if s is not None:
                wanted.update(s)
        missing = self.chunks.lacking(wanted)
        self.chunks.young.update(self._encode_chunks(missing))
        get = self.chunks.young.__getitem__
        out = [self._direct([t])[0] if s is None else b"".join(map(get, s)) for t, s in zip(texts, split)]
        self.chunks.forget(missing)
        return out


_TOKENIZERS: dict[str, ChunkTokenizer] = {}


def chunk_tokenizer(path: str) -> ChunkTokenizer:
    """One per Python worker, kept between tasks."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ChunkTokenizer(path)
    return _TOKENIZERS[path]


class BestFit:
    """Bounded-space online best-fit over bins of one capacity.

    ``closed`` collects the contents of bins that take no more pieces, as (bin number, rows).
    """

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.limit = capacity, open_bins
        self.free = 0  # bit f is set if an open bin has f free
        self.bins: dict[int, list[int]] = {}  # free space -> bin numbers
        self.held: dict[int, list] = {}  # bin number -> its rows
        self.closed: list[tuple[int, list]] = []
        self.made = 0

    def _take(self, space: int) -> int:
        stack = self.bins[space]
        number = stack.pop()
        if not stack:
            self.free &= ~(1 << space)
        return number

    def _close(self, number: int) -> None:
        self.closed.append((number, self.held.pop(number)))

    def place(self, size: int, row: tuple = ()) -> tuple[int, int]:
        """(bin number, offset) for a piece of 1 to ``capacity`` tokens; its bin holds (offset, row)."""
        fitting = self.free >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            space, number = self.capacity, self.made
            self.made += 1
            if size < space and len(self.held) >= self.limit:
                self._close(self._take((self.free & -self.free).bit_length() - 1))  # the fullest closes
            self.held[number] = []
        self.held[number].append((self.capacity - space, row))
        left = space - size
        if left:
            self.bins.setdefault(left, []).append(number)
            self.free |= 1 << left
        else:
            self._close(number)
        return number, self.capacity - space

    def finish(self, slack: int) -> list[tuple]:
        """Close open bins with at most ``slack`` free; the rows of all others."""
        rows = []
        for space, numbers in self.bins.items():
            for number in numbers:
                if space <= slack:
                    self._close(number)
                else:
                    rows += [row for _, row in self.held.pop(number)]
        self.bins, self.free = {}, 0
        return rows

    def take_closed(self) -> list[tuple[int, list]]:
        got, self.closed = self.closed, []
        return got


MERGED_TASKS = 32
_PIECE = ["doc_id", "piece", "start", "length", "ids_crc32"]


def _piece_schema(with_ids: bool) -> pa.Schema:
    ids = [("ids", pa.list_(pa.int32()))] if with_ids else []
    return pa.schema([("part", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                      ("ids_crc32", pa.int64()), *ids, ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _rows(schema: pa.Schema, part: int, base: int, closed: list[tuple[int, list]], left: list[tuple] = ()) -> pa.RecordBatch:
    """Closed bins with their sequence ids, and pieces without one."""
    out = [(part, *row, base + number, offset) for number, held in closed for offset, row in held]
    out += [(part, *row, None, None) for row in left]
    cols = list(zip(*out)) if out else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _pack_rows(tokenizer_path: str, capacity: int, open_bins: int, slack: int, end_id: int, with_ids: bool):
    """Pieces of the rows of one task, packed as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = chunk_tokenizer(tokenizer_path)
        fit, schema = BestFit(capacity, open_bins), _piece_schema(with_ids)
        part = TaskContext.get().partitionId()
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                ids, texts = (c.to_pylist() for c in batch.slice(at, 1024).columns)
                for doc, body in zip(ids, tok.texts([t or "" for t in texts])):
                    body += end
                    n = len(body) // 4
                    for piece, start in enumerate(range(0, n, capacity)):
                        length = min(capacity, n - start)
                        raw = body[4 * start : 4 * (start + length)]
                        more = (np.frombuffer(raw, "<i4"),) if with_ids else ()
                        fit.place(length, (doc, piece, start, length, zlib.crc32(raw), *more))
                yield _rows(schema, part, part << 32, fit.take_closed())
        left = fit.finish(slack)
        yield _rows(schema, part, part << 32, fit.take_closed(), left)

    return run


def _merge(level: int, capacity: int, open_bins: int, slack: int, with_ids: bool):
    """Rows sorted by part: the pieces of every part packed together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _piece_schema(with_ids)
        fit, part, waiting = BestFit(capacity, open_bins), None, []

        def place() -> None:
            for row in sorted(waiting, key=lambda r: -r[3]):
                fit.place(row[3], row)
            waiting.clear()

        def ended() -> pa.RecordBatch:
            nonlocal fit
            place()
            left = fit.finish(slack)
            got = _rows(schema, part, (level << 58) + (part << 32), fit.take_closed(), left)
            fit = BestFit(capacity, open_bins)
            return got

        for batch in batches:
            for number, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if number != part:
                    if part is not None:
                        yield ended()
                    part = number
                waiting.append(tuple(row))
                if len(waiting) == open_bins:
                    place()
                    yield _rows(schema, part, (level << 58) + (part << 32), fit.take_closed())
        if part is not None:
            yield ended()

    return run


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS,
    end_id: int = 1, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A document is its token ids and then ``end_id``; a null or empty text is ``end_id`` alone, so
    every row gets at least one piece.  Only documents longer than ``capacity`` are cut; a text of any
    length is tokenised whole.  A null or repeated doc_id stays as it is, each row with its own
    pieces; an empty table gives no rows; extra columns are ignored.  ``sequence_id`` is the level of
    the merge, the number of the task or group there, and its bin number.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    ids = ", ids array<int>" if with_ids else ""
    schema = f"part long, doc_id long, piece int, start long, length long, ids_crc32 long{ids}, sequence_id long, offset long"
    columns = [*_PIECE, *(["ids"] if with_ids else [])]
    rows = docs.selectExpr(f"cast(`{id_col}` AS long) AS doc_id", f"cast(`{text_col}` AS string) AS text")
    slack = capacity // 100
    level = 0
    table = scratch.write(rows.mapInArrow(_pack_rows(tokenizer_path, capacity, open_bins, slack, end_id, with_ids), schema))
    done = [table]
    parts = (table.agg(F.max("part")).first()[0] or 0) + 1
    while level == 0 or parts > 1:
        level, parts = level + 1, -(-parts // MERGED_TASKS)
        left = table.where("sequence_id IS NULL").select(F.floor(F.col("part") / MERGED_TASKS).alias("part"), *columns)
        by = ["part", F.xxhash64("doc_id", "piece", "ids_crc32"), "doc_id", "piece", "ids_crc32"]
        merged = left.repartition(parts, "part").sortWithinPartitions(*by)
        # the last group closes all its bins
        table = scratch.write(merged.mapInArrow(_merge(level, capacity, open_bins, slack if parts > 1 else capacity, with_ids), schema))
        done.append(table)
    out = [*_PIECE, "sequence_id", "offset", *(["ids"] if with_ids else [])]
    return reduce(DataFrame.unionByName, done).where("sequence_id IS NOT NULL").select(*out)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))
