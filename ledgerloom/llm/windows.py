"""Tokenise documents and pack them into windows by the sum-of-squares rule.

Every Spark task packs the rows it has read, as they come.  A document's full windows close at once;
what is left of it goes to the fill level, an open window or a new one, after which the sum over all
levels of the squared number of partly filled windows is least.  The numbers of windows are kept in an
array by level, so a choice is one pass over it.

Windows are padded unless their length is a power of two, and documents may be cut anywhere, so no
window has to be padded: where more than ``open_windows`` are open, and at a task's end, the fullest
open window is filled up from the emptiest, with whole pieces where they fit and one cut at most.  A
task hands on less than one window; these tails are packed again in groups of ``MERGED_TASKS`` tasks
until one group is left, whose tail is cut into powers of two.  Only tails (a window of ids a task at
most) are shuffled.  Every level is a written table; a task that is run again gives the same windows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from .packing import TwoGenerations
from .scratch import Scratch

WINDOW_TOKENS, OPEN_WINDOWS, MERGED_TASKS = 2048, 512, 256
CACHE_CHUNKS, LONG_CHUNK, JOINED = 400_000, 2000, 500
_CHUNK = re.compile(r"\s*\S+|\s+")
_SEPARATORS = tuple(chr(c) for c in range(0x1C, 0x20))


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteChunks:
    """Ids of whole texts of a byte-level vocabulary, as little-endian uint32 bytes.

    No pre-token has white space behind another character, so a text's ids are those of its chunks, cut
    before white space.  Mostly that is a single space between two other characters, and chunks are
    found by splitting at spaces; a text in which white space meets white space is cut by a pattern.
    Chunks are remembered up to a bounded number, new ones are encoded by the merge ranks.  Texts with
    a special token or with one of the four separators that only Python counts as white space, and
    chunks that are long or outside the Latin blocks, go to the tokenizer itself.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.encode = Tokenizer.from_file(path)
        with open(path) as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        letters = _byte_letters()
        vocab = {w: i for w, i in spec["model"]["vocab"].items() if w not in self.special}
        ranks = {bytes(map(letters.__getitem__, w)): i for w, i in vocab.items()}
        self.ranked = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.spaced = np.zeros(max(ranks.values()) + 1, bool)
        self.spaced[[i for w, i in ranks.items() if w.startswith(b" ")]] = True
        self.after_space, self.alone = TwoGenerations(CACHE_CHUNKS), TwoGenerations(CACHE_CHUNKS)

    def _direct(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.encode.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _plain(chunk: str) -> bool:
        return len(chunk) <= LONG_CHUNK and (chunk.isascii() or max(chunk) < "\u0250")

    def _encode_alone(self, chunks: list[str]) -> dict[str, bytes]:
        out = {c: np.array(self.ranked.encode_ordinary(c), "<u4").tobytes() for c in chunks if self._plain(c)}
        rest = [c for c in chunks if c not in out]
        return out | dict(zip(rest, self._direct(rest)))

    def _encode_after_space(self, chunks: list[str]) -> dict[str, bytes | None]:
        """None for chunks whose own edge is white space."""
        out: dict[str, bytes | None] = {c: None for c in chunks if not c or c[0].isspace() or c[-1].isspace()}
        plain = [c for c in chunks if c not in out and self._plain(c)]
        for a in range(0, len(plain), JOINED):
            part = plain[a : a + JOINED]
            ids = np.array(self.ranked.encode_ordinary(" " + " ".join(part)), "<u4")
            raw, cuts = ids.tobytes(), [*(4 * np.flatnonzero(self.spaced[ids])).tolist(), 4 * len(ids)]
            out.update((c, raw[cuts[i] : cuts[i + 1]]) for i, c in enumerate(part))
        rest = [c for c in chunks if c not in out]
        return out | dict(zip(rest, self._direct([" " + c for c in rest])))

    @staticmethod
    def _learn(cache: TwoGenerations, wanted: set[str], encode) -> list[str]:
        missing = cache.lacking(wanted)
        cache.young.update(encode(missing))
        return missing

    def texts(self, texts: list[str]) -> list[bytes]:
        direct = [any(x in t for x in self.special) or any(c in t for c in _SEPARATORS) for t in texts]
        split = [None if d else t.split(" ") for t, d in zip(texts, direct)]
        heads, wanted = set(), set()
        for s in split:
            if s is not None:
                heads.add(s[0])
                wanted.update(s[1:])
        known = self._learn(self.after_space, wanted, self._encode_after_space)
        get, rough = self.after_space.young.__getitem__, {}
        out: list[bytes | None] = []
        for i, s in enumerate(split):
            if s is None:
                out.append(self._direct([texts[i]])[0])
                continue
            try:
                out.append(b"".join(map(get, s[1:])))
                if s[0] and s[0][-1].isspace():  # a space behind it would not stand between two other characters
                    raise TypeError
            except TypeError:
                if len(out) > i:
                    out.pop()
                out.append(None)
                rough[i] = _CHUNK.findall(texts[i])
        heads.update(*rough.values())
        alone = self._learn(self.alone, heads, self._encode_alone)
        find = self.alone.young.__getitem__
        for i, s in enumerate(split):
            if out[i] is None:
                out[i] = b"".join(map(find, rough[i]))
            elif s is not None:
                out[i] = find(s[0]) + out[i]
        self.after_space.forget(known)
        self.alone.forget(alone)
        return out


_CHUNKERS: dict[str, ByteChunks] = {}


def byte_chunks(path: str) -> ByteChunks:
    """One per Python worker, kept between tasks."""
    if path not in _CHUNKERS:
        _CHUNKERS[path] = ByteChunks(path)
    return _CHUNKERS[path]


#: A piece in a window: (doc_id, start, ids as bytes, doc_tokens).
Piece = tuple[int | None, int, bytes, int]


class SumOfSquares:
    """Open windows by fill level; ``closed`` collects those that take no more pieces."""

    def __init__(self, capacity: int, open_windows: int):
        self.capacity, self.limit = capacity, open_windows
        #: what the sum of squares gains by one window more at a level, and loses by one window less;
        #: level 0 is a new window and a full one counts no more.  A level without windows cannot lose one.
        self.more = np.ones(capacity + 1, np.int64)
        self.more[capacity] = 0
        self.less = np.full(capacity + 1, -(1 << 40), np.int64)
        self.less[0] = 0
        self.at: dict[int, list[list[Piece]]] = {}
        self.n_open = 0
        self.closed: list[list[Piece]] = []

    def _count(self, level: int) -> None:
        n = len(self.at.get(level, ()))
        self.more[level] = 2 * n + 1
        self.less[level] = 2 * n - 1 if n else -(1 << 40)

    def _take(self, level: int) -> list[Piece]:
        window = self.at[level].pop()
        if not self.at[level]:
            del self.at[level]
        self.n_open -= 1
        self._count(level)
        return window

    def _put(self, level: int, window: list[Piece]) -> None:
        if level == self.capacity:
            self.closed.append(window)
        elif level:
            self.at.setdefault(level, []).append(window)
            self.n_open += 1
            self._count(level)

    def level_for(self, size: int) -> int:
        """The level that gives the least sum of squares; of equal ones the fullest."""
        change = self.more[size:] - self.less[: self.capacity + 1 - size]
        return self.capacity - size - int(np.argmin(change[::-1]))

    def place(self, piece: Piece) -> None:
        size = len(piece[2]) // 4
        level = self.level_for(size)
        window = self._take(level) if level else []
        window.append(piece)
        self._put(level + size, window)
        while self.n_open > self.limit:
            self._fill_fullest()

    def _fill_fullest(self) -> None:
        """Fill the fullest open window from the emptiest: whole pieces first, the largest that fit, then one cut."""
        high, low = max(self.at), min(self.at)
        window, source = self._take(high), self._take(low)
        need, rest = self.capacity - high, []
        for doc, start, raw, total in sorted(source, key=lambda p: -len(p[2])):
            size = len(raw) // 4
            if size <= need:
                window.append((doc, start, raw, total))
                need -= size
            else:
                rest.append((doc, start, raw, total))
        if need and rest:
            doc, start, raw, total = rest.pop(0)
            window.append((doc, start, raw[: 4 * need], total))
            rest.append((doc, start + need, raw[4 * need :], total))
            need = 0
        self._put(self.capacity - need, window)
        self._put(sum(len(p[2]) // 4 for p in rest), rest)

    def finish(self, last: bool = False) -> list[Piece]:
        """Close all windows; the pieces of less than one window are handed on, or cut into powers of two."""
        for level in [x for x in self.at if not x & (x - 1)]:
            while level in self.at:
                self.closed.append(self._take(level))
        while self.n_open > 1:
            self._fill_fullest()
        tail = self._take(next(iter(self.at))) if self.at else []
        while last and tail:
            need, window = 1 << (sum(len(p[2]) // 4 for p in tail).bit_length() - 1), []
            while need:
                doc, start, raw, total = tail.pop(0)
                cut = min(need, len(raw) // 4)
                window.append((doc, start, raw[: 4 * cut], total))
                if 4 * cut < len(raw):
                    tail.insert(0, (doc, start + cut, raw[4 * cut :], total))
                need -= cut
            self.closed.append(window)
        return tail


_SCHEMA = pa.schema([
    ("part", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("ids", pa.binary()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])
_COLUMNS = "part long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, sequence_id long, offset long"


def _rows(part: int, base: int, closed: list[list[Piece]], tail: list[Piece], with_ids: bool) -> pa.RecordBatch:
    """Closed windows numbered from ``base`` on, and tail pieces without a number but with their ids."""
    out = []
    for number, window in enumerate(closed, base):
        offset = 0
        for doc, start, raw, total in window:
            out.append((part, doc, start, len(raw) // 4, zlib.crc32(raw), total, raw if with_ids else None, number, offset))
            offset += len(raw) // 4
    out += [(part, doc, start, len(raw) // 4, zlib.crc32(raw), total, raw, None, None) for doc, start, raw, total in tail]
    cols = list(zip(*out)) if out else [()] * len(_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SCHEMA)], schema=_SCHEMA)


def _pack_rows(tokenizer_path: str, capacity: int, open_windows: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, fit = byte_chunks(tokenizer_path), SumOfSquares(capacity, open_windows)
        part = TaskContext.get().partitionId()
        made, end = part << 32, int(end_id).to_bytes(4, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                ids, texts = (c.to_pylist() for c in batch.slice(at, 1024).columns)
                for doc, body in zip(ids, chunks.texts([t or "" for t in texts])):
                    body += end
                    for start in range(0, len(body) // 4, capacity):
                        fit.place((doc, start, body[4 * start : 4 * (start + capacity)], len(body) // 4))
                yield _rows(part, made, fit.closed, [], with_ids)
                made += len(fit.closed)
                fit.closed.clear()
        tail = fit.finish()
        yield _rows(part, made, fit.closed, tail, with_ids)

    return run


def _merge(level: int, capacity: int, open_windows: int, last: bool, with_ids: bool):
    """Tail pieces sorted by part: those of every part packed together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, part, made = SumOfSquares(capacity, open_windows), None, 0

        def ended() -> pa.RecordBatch:
            tail = fit.finish(last)
            return _rows(part, made, fit.closed, tail, with_ids)

        for batch in batches:
            for number, *piece in zip(*(c.to_pylist() for c in batch.columns)):
                if number != part:
                    if part is not None:
                        yield ended()
                    fit, part, made = SumOfSquares(capacity, open_windows), number, (level << 58) + (number << 32)
                fit.place(tuple(piece))
            if part is not None and fit.closed:
                yield _rows(part, made, fit.closed, [], with_ids)
                made += len(fit.closed)
                fit.closed.clear()
        if part is not None:
            yield ended()

    return run


def pack_windows(docs: DataFrame, tokenizer_path: str, capacity: int = WINDOW_TOKENS, open_windows: int = OPEN_WINDOWS, end_id: int = 1,
                 with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, little-endian uint32).

    A document is its token ids and then ``end_id``; a null or empty text is ``end_id`` alone.  Texts of
    any length are tokenised whole.  Every id lies in one piece, and windows are full or, a few, have a
    power of two of ids, so nothing is padded.  A null or repeated doc_id stays as it is, each row
    with its own pieces; equal choices take the fullest level; an empty table gives no rows; extra
    columns are ignored.  ``sequence_id`` is the level of the merge, the task or group there, and a number.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "windows")
    rows = docs.selectExpr(f"cast(`{id_col}` AS long) AS doc_id", f"cast(`{text_col}` AS string) AS text")
    table = scratch.write(rows.mapInArrow(_pack_rows(tokenizer_path, capacity, open_windows, end_id, with_ids), _COLUMNS))
    done, level = [table], 0
    parts = (table.agg(F.max("part")).first()[0] or 0) + 1
    while level == 0 or parts > 1:
        level, parts = level + 1, -(-parts // MERGED_TASKS)
        tails = table.where("sequence_id IS NULL").select(F.floor(F.col("part") / MERGED_TASKS).alias("part"), "doc_id", "start", "ids", "doc_tokens")
        dealt = tails.repartition(parts, "part").sortWithinPartitions("part", F.desc(F.length("ids")), F.crc32("ids"), "doc_id", "start")
        table = scratch.write(dealt.mapInArrow(_merge(level, capacity, open_windows, parts == 1, with_ids), _COLUMNS))
        done.append(table)
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    return reduce(DataFrame.unionByName, done).where("sequence_id IS NOT NULL").select(*out)


def op12_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_windows(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
