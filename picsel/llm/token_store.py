"""Token-id files: independent zstandard frames, a trailing seek table, a checksum per frame.

A file holds documents in ascending ``doc_id`` order:

* frames: each an independent zstandard frame of little-endian unsigned 32-bit ids, at most ``FRAME_IDS`` of them; a longer
  document goes on in the next frames;
* the seek table, itself a zstandard skippable frame: for each frame its compressed bytes, its ids and the crc32 of its
  decompressed bytes; for each document its id (and whether it has one), its first id in the file and its number of ids;
* a footer of fixed size: the seek table's length and crc32, the counts, and ``MAGIC``.

A reader takes the footer, the seek table and only the frames that hold the asked documents, and checks each against its
checksum. Files are written to a name of the attempt and then renamed, so a lost or repeated task leaves whole files only.

Odd rows: a null text is empty (its end id alone); documents without an id come first; rows with equal ids are ordered by
a hash of their text; an empty table gives no rows. A very long text goes over many frames. Other columns are not read, so their
names do not matter.
"""

from __future__ import annotations

import itertools
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from picsel.llm.bpe import Encoder, read_model
from picsel.llm.common import blocks, stage, stage_path, utf8

FRAME_IDS = 1 << 15
MAGIC = b"TOKFRAM1"
_SKIPPABLE = 0x184D2A5E
_FOOTER = struct.Struct("<QIQQ8s")  # table bytes, table crc32, frames, documents, magic
_FRAMES = np.dtype([("bytes", "<u4"), ("ids", "<u4"), ("crc", "<u4")])
_DOCS = np.dtype([("doc_id", "<i8"), ("has_id", "<u1"), ("first", "<u8"), ("ids", "<u8")])
#: Text of a file at most, and at least where there are enough files for all tasks; documents whose table entries are held unpacked.
FILE_BYTES, SMALL_FILE, TABLE_ROWS = 256 << 20, 8 << 20, 65_536
#: Words whose ids a worker remembers (about 200 bytes each).
MEMORY = 1_500_000


class WordIds:
    """Ids of texts as bytes; a worker remembers the ids of words it has seen, within a bound, for its later tasks too."""

    _of: dict[int, WordIds] = {}

    def __init__(self, model: str):
        self.encoder, self.known = Encoder.of(model), {}

    @classmethod
    def of(cls, model: str) -> WordIds:
        if hash(model) not in cls._of:
            cls._of[hash(model)] = cls(model)
        return cls._of[hash(model)]

    def __call__(self, raws: list[bytes]) -> list[bytes]:
        # the tokenizer lower-cases itself, but only after it has found special tokens
        texts = [(raw.lower() if self.encoder.lowers and b"<|" not in raw else raw).split() for raw in raws]
        words = set().union(*texts)
        if len(self.known) > MEMORY:
            self.known.clear()
        new = list(words.difference(self.known))
        ids, cuts = self.encoder.flat([w.decode("utf-8") for w in new])
        data, cuts = ids.tobytes(), (4 * cuts).tolist()
        self.known.update(zip(new, (data[a:b] for a, b in itertools.pairwise(cuts))))
        return [b"".join(map(self.known.__getitem__, words)) for words in texts]


class Writer:
    """Writes one file; ``add`` takes documents in order."""

    def __init__(self, out):
        self.out, self.frames, self.total = out, [], 0
        self.docs, self.full, self.n_docs = [], [], 0  # documents of late as tuples, earlier ones as packed tables
        self.open: list[bytes] = []
        self.held = 0
        self.pack = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def _frame(self, data: bytes) -> None:
        packed = self.pack.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data) // 4, zlib.crc32(data)))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id or 0, doc_id is not None, self.total, len(ids) // 4))
        self.n_docs += 1
        if len(self.docs) >= TABLE_ROWS:
            self._flush_docs()
        self.total += len(ids) // 4
        self.open.append(ids)
        self.held += len(ids)
        if self.held >= 4 * FRAME_IDS:
            data = b"".join(self.open)
            whole = len(data) - len(data) % (4 * FRAME_IDS)
            for i in range(0, whole, 4 * FRAME_IDS):
                self._frame(data[i:i + 4 * FRAME_IDS])
            self.open, self.held = [data[whole:]], len(data) - whole

    def _flush_docs(self) -> None:
        self.full.append(np.array(self.docs, _DOCS).tobytes())
        self.docs = []

    def close(self) -> None:
        if self.held:
            self._frame(b"".join(self.open))
        self._flush_docs()
        table = np.array(self.frames, _FRAMES).tobytes() + b"".join(self.full)
        table = zstandard.ZstdCompressor(level=3).compress(table)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(table) + _FOOTER.size) + table)
        self.out.write(_FOOTER.pack(len(table), zlib.crc32(table), len(self.frames), self.n_docs, MAGIC))


class Reader:
    """Reads the seek table of a file, then only the frames of the documents asked for."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - _FOOTER.size)
        length, crc, frames, docs, magic = _FOOTER.unpack(source.read(_FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        source.seek(size - _FOOTER.size - length)
        table = source.read(length)
        if zlib.crc32(table) != crc:
            raise ValueError("the seek table is damaged")
        table = zstandard.ZstdDecompressor().decompress(table)
        self.frames = np.frombuffer(table, _FRAMES, frames)
        self.docs = np.frombuffer(table, _DOCS, docs, frames * _FRAMES.itemsize)
        self.offset = np.r_[0, np.cumsum(self.frames["bytes"].astype(np.int64))]
        self.first = np.r_[0, np.cumsum(self.frames["ids"].astype(np.int64))]
        self.unpack, self.last = zstandard.ZstdDecompressor(), (None, b"")

    def _frame(self, k: int) -> bytes:
        if self.last[0] != k:
            self.source.seek(int(self.offset[k]))
            data = self.unpack.decompress(self.source.read(int(self.frames[k]["bytes"])))
            if zlib.crc32(data) != self.frames[k]["crc"]:
                raise ValueError(f"frame {k} is damaged")
            self.last = (k, data)
        return self.last[1]

    def find(self, doc_id: int) -> list[int]:
        """The places of a document id in the file."""
        return np.flatnonzero((self.docs["doc_id"] == doc_id) & (self.docs["has_id"] == 1)).tolist()

    def ids(self, i: int) -> bytes:
        """The ids of the file's i-th document, little-endian."""
        a, n = int(self.docs[i]["first"]), int(self.docs[i]["ids"])
        out, k = [], int(np.searchsorted(self.first, a, "right")) - 1
        while n:
            data, at = self._frame(k), a - int(self.first[k])
            got = data[4 * at:4 * (at + n)]
            out.append(got)
            a, n, k = a + len(got) // 4, n - len(got) // 4, k + 1
        return b"".join(out)


def _filesystem(uri: str):
    return pa.fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def files_for(size: int, tasks: int) -> int:
    """Number of files for ``size`` bytes of text: one a task, but none of more than ``FILE_BYTES`` and few of less than ``SMALL_FILE``."""
    return max(1, -(-size // FILE_BYTES), min(tasks, -(-size // SMALL_FILE)))


_MANIFEST = pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def write_files(docs: DataFrame, folder: str, model_path: str, end_id: int = 1) -> DataFrame:
    """Write the ids of ``doc_id, text`` below ``folder``; returns the manifest ``part, file, n_docs, n_tokens, start``.

    ``start`` is the number of ids in the files before; the manifest has one row per file.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(read_model(model_path))

    def run(it):
        part, ids, end = TaskContext.get().partitionId(), None, struct.pack("<I", end_id)
        writer = out = None
        fs, base = _filesystem(folder)
        name = f"part-{part:06d}"
        for block in blocks(it, "text", 4 << 20):
            if writer is None:
                fs.create_dir(base, recursive=True)
                draft = f"{base}/.{name}-{uuid.uuid4().hex}"
                out = fs.open_output_stream(draft)
                writer, ids = Writer(out), WordIds.of(model.value)
            for doc, own in zip(block.column(0).to_pylist(), ids([utf8(t) for t in block.column(1).to_pylist()])):
                writer.add(doc, own + end)
        if writer is not None:
            writer.close()
            out.close()
            fs.move(draft, f"{base}/{name}.tok")
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([f"{base}/{name}.tok"]), pa.array([writer.n_docs], pa.int64()),
                                              pa.array([writer.total], pa.int64())], schema=_MANIFEST)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = files_for(size, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # the hash tells rows with one id apart, so that many of them need not meet in one file
    order = F.col("doc_id").asc_nulls_first(), F.xxhash64("text")
    ordered = source.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    made = stage(ordered.mapInArrow(run, "part int, file string, n_docs long, n_tokens long"), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return made.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of all documents, read back through the seek tables."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(it):
        fs, _ = _filesystem(folder)
        for batch in it:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(file) as source:
                    reader = Reader(source, source.size())
                    for a in range(0, len(reader.docs), 4096):
                        docs = reader.docs[a:a + 4096]
                        crc = [zlib.crc32(reader.ids(i)) for i in range(a, a + len(docs))]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(docs["doc_id"].astype(np.int64), mask=docs["has_id"] == 0), pa.array(docs["first"].astype(np.int64) + start),
                            pa.array(docs["ids"].astype(np.int64)), pa.array(crc, pa.int64())], schema=schema)

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("file", "start").repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, model_path: str, end_id: int = 1) -> DataFrame:
    """Write ``docs`` to files in the shared folder and read them back."""
    folder = stage_path(docs.sparkSession, "tokens")
    return read_files(write_files(docs, folder, model_path, end_id), folder)
