"""Token ids as Arrow files of equal-length sequences and masks.

The documents' ids, each closed by an end id, follow one another in order of doc_id
and are cut into sequences of one length.  A part is an Arrow IPC file whose record
batches all have the same number of fixed-size lists (``ids``, ``mask``), so that the
place of any id follows from its number and a mapped file gives it without a copy;
the last sequence of a part is padded, mask false.  A second Arrow file lists doc_id,
start and length of the part's documents.  The manifest names the files that finished
tasks wrote; what a lost task left behind is in no manifest.
"""

from __future__ import annotations

import os
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, texts

SEQUENCE_IDS = 1_024
SEQUENCES_PER_BATCH = 256
DOCUMENTS_PER_BATCH = 16_384
END_ID = 1
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "part int, ids_file string, index_file string, n_docs bigint, n_tokens bigint"
#: Distinct blank-free pieces whose ids a worker remembers, and the longest one it remembers.
REMEMBERED, LONGEST = 200_000, 32


#: Word ends, while words are merged as ranked bytes; no text that holds it takes that way.
WORD_END = b"\x00"
#: The split pattern for text of ASCII characters without an apostrophe, which only its first matches need.
ASCII_PARTS = re.compile("[A-Za-z]+|[0-9]|[^A-Za-z0-9]+")
#: Marks that may follow a word; such a tail is a match of the split pattern of its own.
TAIL = ".,;:!?"
#: Below this character letters have one lower-case form each and no text needs composing.
PLAIN_BELOW = "\u0130"


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves; the other bytes, in order, have the characters from 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class RankedWords:
    """Ids of single lower-case words by the merges of a vocabulary whose words end in a suffix.

    The ids of such a vocabulary grow in the order of its merges, after those of single
    bytes without and with the suffix, so they are the ranks of a byte-pair encoder for
    words that end in ``WORD_END``.
    """

    def __init__(self, tokenizer, suffix: str):
        import tiktoken

        of = byte_alphabet()
        special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
        ranks = {}
        for token, number in tokenizer.get_vocab().items():
            if token not in special:
                body = token.removesuffix(suffix)
                ranks[bytes(of[c] for c in body) + (WORD_END if body != token else b"")] = number
        ranks.setdefault(WORD_END, tokenizer.get_vocab_size())
        self.merge = tiktoken.Encoding("words", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def encode(self, word: str) -> list[int]:
        return self.merge(word.encode() + WORD_END)


class Known(dict):
    """Ids of pieces met lately; a piece that is not there is encoded, and kept if it is short."""

    def __init__(self, encode, older: dict[str, bytes]):
        super().__init__({"": b""})
        self.encode, self.older = encode, older

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encode(piece)
        if len(piece) <= LONGEST:
            self[piece] = ids
        return ids


class Pieces:
    """Ids of a text, put together from the ids of its blank-free pieces.

    The tokenizer drops white space and none of its steps reaches across it, so the ids
    of a text are those of its pieces; a piece is encoded once as long as it is remembered.
    A short piece of ASCII characters, and a word of plain letters, alone or with marks
    behind it, is merged by ranks; every other piece goes through the library, and so does
    one with an apostrophe or a character that may begin a special token.  Special tokens hold no white space;
    ``special_as_text`` says whether they are cut like any other text or, the library's
    default, keep their id.
    """

    def __init__(self, path: str, special_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.words = RankedWords(self.tokenizer, self.tokenizer.model.end_of_word_suffix)
        #: Characters of pieces that the library has to cut; vertical tab and form feed are white space to it.
        self.cut = frozenset({"'", "\v", "\f", WORD_END.decode(), *(t.content[0] for t in self.tokenizer.get_added_tokens_decoder().values())})
        self.known = Known(self.encode_piece, {})

    def encode_piece(self, piece: str) -> bytes:
        word = piece.rstrip(TAIL)
        if len(piece) > LONGEST or not self.cut.isdisjoint(piece):
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        elif piece.isascii():
            ids = [i for part in ASCII_PARTS.findall(piece.lower()) for i in self.words.encode(part)]
        elif word.isalpha() and max(word) < PLAIN_BELOW:
            ids = self.words.encode(word.lower())
            if len(word) < len(piece):
                ids += self.words.encode(piece[len(word) :])
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def encode(self, batch: list[str]) -> list[bytes]:
        # The pieces met lately become the older ones when they fill half the room.
        if len(self.known) > REMEMBERED // 2:
            self.known.older = {}
            self.known = Known(self.encode_piece, self.known)
        of = self.known.__getitem__
        return [b"".join(map(of, t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "))) for t in batch]


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path, special_as_text=False)


def _filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


class SequenceWriter:
    """Cuts a stream of ids into sequences and writes full record batches of them."""

    def __init__(self, sink, dtype: np.dtype, length: int, per_batch: int):
        self.length, self.size, self.dtype = length, length * per_batch, dtype
        ids = pa.list_(pa.from_numpy_dtype(dtype), length)
        self.schema = pa.schema([("ids", ids), ("mask", pa.list_(pa.bool_(), length))])
        self.file = pa.ipc.new_file(sink, self.schema)
        self.waiting: list[bytes] = []
        self.count = self.written = 0

    def add(self, ids: bytes) -> None:
        self.waiting.append(ids)
        self.count += len(ids) // self.dtype.itemsize
        if self.count >= self.size:
            whole = np.frombuffer(b"".join(self.waiting), self.dtype)
            full = len(whole) // self.size * self.size
            for at in range(0, full, self.size):
                self._write(whole[at : at + self.size], self.size)
            self.waiting, self.count = [whole[full:].tobytes()], len(whole) - full

    def _write(self, ids: np.ndarray, used: int) -> None:
        mask = np.arange(len(ids)) < used
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), type=kind.type)
            for values, kind in ((ids, self.schema.field("ids")), (mask, self.schema.field("mask")))
        ]
        self.file.write_batch(pa.record_batch(columns, schema=self.schema))
        self.written += used

    def close(self) -> None:
        if self.count:
            rest = np.frombuffer(b"".join(self.waiting), self.dtype)
            padded = np.zeros(-(-len(rest) // self.length) * self.length, self.dtype)
            padded[: len(rest)] = rest
            self._write(padded, len(rest))
        self.file.close()


class TokenFile:
    """Random access to the ids, masks and sequences of one part."""

    def __init__(self, uri: str):
        fs, path = _filesystem(uri)
        # A local file is mapped: batches are then views of the file, not copies.
        self.source = pa.memory_map(path) if isinstance(fs, pyarrow.fs.LocalFileSystem) else fs.open_input_file(path)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self.size = self.file.get_batch(0).num_rows * self.length if self.file.num_record_batches else 0
        self.last: tuple[int, pa.RecordBatch | None] = (-1, None)

    def _batch(self, number: int) -> pa.RecordBatch:
        if self.last[0] != number:
            self.last = (number, self.file.get_batch(number))
        return self.last[1]

    def tokens(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from number ``start`` on; a view where they lie in one batch."""
        found, end = [], start + count
        while start < end:
            number, at = divmod(start, self.size)
            values = self._batch(number).column("ids").values.to_numpy(zero_copy_only=True)
            found.append(values[at : at + end - start])
            start += len(found[-1])
        return found[0] if len(found) == 1 else np.concatenate(found)

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of one sequence."""
        batch, row = divmod(number, self.size // self.length)
        record, at = self._batch(batch), slice(row * self.length, (row + 1) * self.length)
        ids = record.column("ids").values.to_numpy(zero_copy_only=True)[at]
        return ids, record.column("mask").values.slice(at.start, self.length).to_numpy(zero_copy_only=False)

    def close(self) -> None:
        self.last = (-1, None)
        self.source.close()


def write(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, sequence_ids: int = SEQUENCE_IDS,
    sequences_per_batch: int = SEQUENCES_PER_BATCH, parts: int | None = None,
) -> DataFrame:
    """Encode and write all rows below ``folder`` (shared by all executors); returns the manifest.

    Null and empty texts are just the end id.  Null ids come first; rows that repeat an
    id follow one another, ordered by a hash of the text and the text.  A part is written
    as a stream: a task holds a batch of rows and a record batch of sequences.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = texts(docs).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")

    def write_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own = TaskContext.get().partitionId(), pieces(tokenizer)
        fs, root = _filesystem(folder)
        fs.create_dir(root, recursive=True)
        name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}"
        files = [f"{name}.arrow", f"{name}.index.arrow"]
        end, start, n_docs = np.array([end_id], own.dtype).tobytes(), 0, 0
        writer = None
        for batch in batches:
            if writer is None:
                sinks = [fs.open_output_stream(f"{root}/{f}") for f in files]
                writer = SequenceWriter(sinks[0], own.dtype, sequence_ids, sequences_per_batch)
                index = pa.ipc.new_file(sinks[1], INDEX)
            for at in range(0, batch.num_rows, DOCUMENTS_PER_BATCH):
                some = batch.slice(at, DOCUMENTS_PER_BATCH)
                starts, counts = [], []
                for ids in own.encode(some.column(1).to_pylist()):
                    writer.add(ids + end)
                    starts.append(start)
                    counts.append(len(ids) // own.dtype.itemsize + 1)
                    start += counts[-1]
                index.write_batch(pa.record_batch([some.column(0), pa.array(starts, pa.int64()), pa.array(counts, pa.int64())], schema=INDEX))
                n_docs += some.num_rows
        if writer is not None:
            writer.close()
            index.close()
            for sink in sinks:
                sink.close()
            paths = [f"{folder.rstrip('/')}/{f}" for f in files]
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "ids_file": [paths[0]], "index_file": [paths[1]], "n_docs": pa.array([n_docs], pa.int64()), "n_tokens": pa.array([start], pa.int64())}
            )

    return stored(rows.mapInArrow(write_part, MANIFEST), "manifest")


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, all from the files."""
    files = manifest.count()
    # One row per part, so this running sum is over the names of files only.
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    listed = manifest.select("ids_file", "index_file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))

    def read_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = TokenFile(row["ids_file"])
                fs, path = _filesystem(row["index_file"])
                with fs.open_input_file(path) as index_source:
                    index = pa.ipc.open_file(index_source)
                    for number in range(index.num_record_batches):
                        some = index.get_batch(number)
                        starts, counts = some.column("start").to_numpy(), some.column("n_tokens").to_numpy()
                        sums = [zlib.crc32(ids.tokens(a, n).astype("<u4").tobytes()) for a, n in zip(starts.tolist(), counts.tolist())]
                        yield pa.RecordBatch.from_pydict(
                            {"doc_id": some.column("doc_id"), "start": pa.array(starts + row["base"], pa.int64()), "n_tokens": some.column("n_tokens"), "ids_crc32": pa.array(sums, pa.int64())}
                        )
                ids.close()

    # A part to a task: the rows are tiny, so their number has to be stated.
    return listed.repartition(max(1, files)).mapInArrow(read_part, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
