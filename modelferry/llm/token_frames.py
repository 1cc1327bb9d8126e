"""Token ids in files of independent zstandard frames.

A file holds whole documents in ascending ``doc_id``. Each document is its ids as little-endian unsigned 32-bit numbers,
in frames of its own of at most ``FRAME_BYTES`` (before compression), so a reader decompresses nothing but what it is
asked for. Behind them come a document table (ids, token counts, numbers of frames) and, last, the seek
table, both in skippable frames: any zstandard decoder reads the file as one stream of ids. The seek table is that
of the public seekable format: compressed size, size and checksum (low half of XXH64) of every frame, then their
number, a flag byte and a magic number. Documents are listed in the ``index`` beside the files, one row each; only files
named there count, so what a lost task left behind is never read.

Ids are those of the tokenizer file ``byte_bpe_50k.json``; they are made from the rank file of the same vocabulary, five times as
fast, and a test holds both equal. Texts are encoded where they lie and compressed at once. What travels afterwards is compressed frames: they are written to
the shared folder, dealt by range of (``doc_id``, row number) and put end to end. Rows equal in everything have different row numbers,
so an id with any number of rows spreads over tasks. A file ends at ``FILE_BYTES``; a longer document has a file to itself.

Defined cases: a null or empty text is its end id alone; a null ``doc_id`` comes first; rows with equal ids
follow each other, each counted on its own; other columns are ignored; an empty table gives an empty index and no file.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from modelferry.llm.best_fit_packing import RANKS, encoder
from modelferry.llm.common import raw
from modelferry.session import scratch_path
from modelferry.sources import storage
from modelferry.sources.artifact_files import locate

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
LEVEL = 3
FRAME_BYTES = 1 << 20
FILE_BYTES = 64 << 20
# Fixed values of the public frame formats.
SKIPPABLE_SEEK_TABLE, SKIPPABLE_DOCUMENTS = 0x184D2A5E, 0x184D2A50
SEEK_MAGIC, CHECKSUM_FLAG = 0x8F92EAB1, 0x80
ENTRY, FOOTER, HEADER = struct.Struct("<III"), struct.Struct("<IBI"), struct.Struct("<II")
DOCUMENT = np.dtype([("known", "u1"), ("doc_id", "<i8"), ("n_tokens", "<u8"), ("n_frames", "<u4")])
# Bytes of ids in one batch of rows read back.
BATCH_BYTES = 4 << 20


# -- ids ----------------------------------------------------------------------

def id_maker(ranks: str = RANKS):
    """Text -> ids. What the rank library gives up on (millions of blanks in a row) goes to the tokenizer file."""
    encode, slow = encoder(ranks).encode, []

    def ids(text: str) -> list[int]:
        try:
            return encode(text, allowed_special="all")
        except ValueError:
            if not slow:
                import public_tokenizers
                from tokenizers import Tokenizer

                os.environ["TOKENIZERS_PARALLELISM"] = "false"
                slow.append(Tokenizer.from_file(public_tokenizers.path(TOKENIZER)))
            return slow[0].encode(text, add_special_tokens=False).ids

    return ids


# -- one file -----------------------------------------------------------------

def frames(ids: bytes, frame_bytes: int = FRAME_BYTES, level: int = LEVEL) -> tuple[bytes, bytes]:
    """The frames of one document end to end, and their entries of the seek table."""
    data = memoryview(ids)
    packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
    parts, entries = [], []
    for first in range(0, len(data), frame_bytes):
        part = data[first:first + frame_bytes]
        parts.append(packer.compress(part))
        entries.append(ENTRY.pack(len(parts[-1]), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF))
    return b"".join(parts), b"".join(entries)


class FrameWriter:
    """Writes one file: documents, then both tables."""

    def __init__(self, out):
        self.out, self.size = out, 0
        self.entries: list[bytes] = []
        self.documents: list[tuple[bool, int, int, int]] = []

    def add(self, doc_id: int | None, n_tokens: int, data: bytes, entries: bytes) -> None:
        self.out.write(data)
        self.size += len(data)
        self.entries.append(entries)
        self.documents.append((doc_id is not None, doc_id or 0, n_tokens, len(entries) // ENTRY.size))

    def close(self) -> None:
        listed = zstandard.compress(np.array(self.documents, DOCUMENT).tobytes())
        body = HEADER.pack(SKIPPABLE_DOCUMENTS, len(listed)) + listed
        table = b"".join([*self.entries, ENTRY.pack(len(body), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)])
        table += FOOTER.pack(len(table) // ENTRY.size, CHECKSUM_FLAG, SEEK_MAGIC)
        self.out.write(body)
        self.out.write(HEADER.pack(SKIPPABLE_SEEK_TABLE, len(table)))
        self.out.write(table)
        self.out.close()


class FrameReader:
    """Reads documents of one file by their place in it."""

    def __init__(self, file):
        self.file = file
        end = file.size()
        n, flags, magic = FOOTER.unpack(self._bytes(end - FOOTER.size, FOOTER.size))
        if magic != SEEK_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        size = n * ENTRY.size
        table = np.frombuffer(self._bytes(end - FOOTER.size - size, size), "<u4").reshape(n, 3).astype(np.int64)
        self.places = np.concatenate([[0], np.cumsum(table[:, 0])])
        self.sizes, self.checksums = table[:, 1], table[:, 2]
        last = int(self.places[n - 1])
        listed = self._bytes(last + HEADER.size, int(table[n - 1, 0]) - HEADER.size)
        self.documents = np.frombuffer(zstandard.decompress(listed), DOCUMENT)
        self.first = np.concatenate([[0], np.cumsum(self.documents["n_frames"], dtype=np.int64)])
        self.unpacker = zstandard.ZstdDecompressor()
        #: Frames decompressed so far.
        self.opened = 0

    def _bytes(self, place: int, n: int) -> bytes:
        self.file.seek(place)
        data = self.file.read(n)
        if len(data) != n:
            raise ValueError(f"{n} bytes expected at {place}, {len(data)} found")
        return data

    def frame(self, i: int) -> bytes:
        data = self.unpacker.decompress(
            self._bytes(int(self.places[i]), int(self.places[i + 1] - self.places[i])), max_output_size=int(self.sizes[i]))
        self.opened += 1
        if len(data) != self.sizes[i] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.checksums[i]:
            raise ValueError(f"frame {i} does not have the bytes its entry tells")
        return data

    def doc_id(self, i: int) -> int | None:
        return int(self.documents["doc_id"][i]) if self.documents["known"][i] else None

    def ids(self, i: int) -> bytes:
        """Ids of the document at place ``i``, little-endian 32-bit."""
        data = b"".join(self.frame(k) for k in range(int(self.first[i]), int(self.first[i + 1])))
        if len(data) != 4 * int(self.documents["n_tokens"][i]):
            raise ValueError(f"document {i} does not have the ids its entry tells")
        return data


# -- many files ---------------------------------------------------------------

def encoded(docs: DataFrame, ranks: str = RANKS, end_id: int = END_ID) -> DataFrame:
    """Rows (doc_id, row, n_tokens, size, data, entries): the frames of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = id_maker(ranks)
        for batch in batches:
            packed, counts = [], []
            for text in raw(batch.column("text")):
                ids = [*encode(text.decode()), end_id]
                counts.append(len(ids))
                packed.append(frames(np.array(ids, "<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(counts, pa.int64()),
                 pa.array([len(d) for d, _ in packed], pa.int64()), pa.array([d for d, _ in packed], pa.binary()),
                 pa.array([e for _, e in packed], pa.binary())],
                names=["doc_id", "row", "n_tokens", "size", "data", "entries"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    return rows.mapInArrow(run, "doc_id long, row long, n_tokens long, size long, data binary, entries binary")


_INDEX = "part int, roll int, file string, place int, doc_id long, n_tokens long"


def write_frames(docs: DataFrame, path: str, ranks: str = RANKS, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> None:
    """Write the files and their index below ``path``, an address that all executors reach."""
    spark = docs.sparkSession
    staging = scratch_path(spark, "frames")
    encoded(docs, ranks, end_id).write.parquet(staging)
    staged = spark.read.parquet(staging)
    total = staged.agg(F.sum("size")).first()[0] or 0

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        system, folder = locate(f"{path}/files")
        system.create_dir(folder, recursive=True)
        roll, file = 0, None
        for batch in batches:
            rows = []
            for doc_id, n_tokens, data, entries in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "data", "entries"))):
                if file is not None and file.size + len(data) > file_bytes:
                    file.close()
                    roll, file = roll + 1, None
                if file is None:
                    name = f"ids-{part:06d}-{roll:04d}-{attempt}.zst"
                    file = FrameWriter(system.open_output_stream(f"{folder}/{name}", compression=None))
                rows.append((part, roll, name, len(file.documents), doc_id, n_tokens))
                file.add(doc_id, n_tokens, data, entries)
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            columns = zip(*rows) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["part", "roll", "file", "place", "doc_id", "n_tokens"])
        if file is not None:
            file.close()

    dealt = staged.drop("size").repartitionByRange(max(1, -(-total // file_bytes)), "doc_id", "row")
    dealt.sortWithinPartitions("doc_id", "row").mapInArrow(write, _INDEX).write.parquet(f"{path}/index")
    storage.remove(spark, staging)


def _index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_INDEX).parquet(f"{path}/index")


def _starts(index: DataFrame) -> DataFrame:
    """One row a file: file, ids of all files before it. There is one row to some ``FILE_BYTES``."""
    files = index.groupBy("part", "roll", "file").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part", "roll").rowsBetween(Window.unboundedPreceding, -1))
    return files.select("file", F.coalesce(before, F.lit(0)).alias("base"))


def _row_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, start, n_tokens, ids) in batches of some ``BATCH_BYTES``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3])
        if size > BATCH_BYTES or len(held) == 4096:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names=["doc_id", "start", "n_tokens", "ids"])


_ROWS = "doc_id long, start long, n_tokens long, ids binary"


def read_all(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) of every document, from the files; start counts all ids before it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                    system, place = locate(f"{path}/files/{name}")
                    with system.open_input_file(place) as file:
                        reader = FrameReader(file)
                        for i, n in enumerate(reader.documents["n_tokens"].tolist()):
                            yield reader.doc_id(i), base, n, reader.ids(i)
                            base += n
        return _row_batches(rows())

    files = _starts(_index(spark, path))
    return files.repartition(max(1, files.count())).mapInArrow(read, _ROWS)


def read_documents(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The same for the documents whose ``doc_id`` is in ``wanted``; no other frame is decompressed.

    The index is looked up by id, and the places found are dealt by file.
    """
    index = _index(spark, path)
    inside = F.sum("n_tokens").over(Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    placed = index.withColumn("inside", F.coalesce(inside, F.lit(0))).join(_starts(index), "file")
    ids = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    found = placed.join(ids, "doc_id", "left_semi").select("file", "place", (F.col("base") + F.col("inside")).alias("start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            name, reader = None, None
            for batch in batches:
                for file, place, start in zip(*(batch.column(c).to_pylist() for c in ("file", "place", "start"))):
                    if file != name:
                        system, at = locate(f"{path}/files/{file}")
                        name, reader = file, FrameReader(system.open_input_file(at))
                    yield reader.doc_id(place), start, int(reader.documents["n_tokens"][place]), reader.ids(place)
        return _row_batches(rows())

    return found.repartition("file").sortWithinPartitions("file", "place").mapInArrow(read, _ROWS)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the files, and read every document back from them."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_frames(docs, path)
    return read_all(spark, path)
