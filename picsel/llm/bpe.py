"""BPE encoding and decoding through a distinct-word table.

The tokenizer splits at white space before it merges, so the pieces of a word do not depend on its neighbours. Words are runs
without ASCII white space (the tokenizer splits further inside them, at other spaces, punctuation and special tokens).

1. Spark cuts the documents into blocks of bounded text. A block keeps its distinct words and, for each document, the
   positions of its words in that list (by falling frequency, as a compressed byte-plane array). Blocks are written as a
   table bucketed by block.
2. The words of all blocks meet by hash bucket; each distinct word is encoded once. The number of buckets follows the number of distinct
   words of all blocks, estimated from the smallest hashes that the blocks keep, not the number of blocks.
3. Each bucket sends its blocks the ids of their words, which join the blocks by position; a task holds the words of a bucket and
   reads the blocks' lists as a stream. The ids of a block's words join
   the vocabulary by id: a table of fixed size (the model's), broadcast, so that pieces need no shuffle. The documents are
   put together from both by position.

What meets in a task is a block or a bucket, both of bounded size; a frequent word counts once a block.

Odd rows: a null text is empty (no tokens); rows are encoded one by one, so repeated or null ids are kept; a word longer than a
block is one word still; an empty table gives an empty result. A text longer than a block is a block of its own. Other columns are not read, so their names do
not matter.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from picsel.llm.common import blocks as slices
from picsel.llm.common import stage, stage_path, utf8

#: Text of a block, distinct words of a bucket (on average), and hashes that a block keeps for the estimate of their number.
BLOCK_BYTES = 32 << 20
BUCKET_WORDS = 50_000
SKETCH = 512


class Encoder:
    """Ids of words with the tokenizers library; one instance a worker and model.

    Many words are encoded as one text, and its ids are dealt back to the words by the bytes of their pieces (a byte is one
    character of a piece, word ends apart). If the bytes don't end where the words do, as when the tokenizer drops a character,
    the words are encoded one by one.
    """

    _known: dict[int, Encoder] = {}

    def __init__(self, model: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        end = json.loads(model)["model"].get("end_of_word_suffix")
        parts = json.loads(model)
        self.joins = bool(end) and "ByteLevel" in json.dumps(parts["pre_tokenizer"])
        special = [t["content"] for t in parts["added_tokens"]]
        # whether A-Z may be lower-cased before: the tokenizer does so itself, and special tokens all have the mark <|
        self.lowers = "Lowercase" in json.dumps(parts["normalizer"]) and all("<|" in t for t in special)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = np.zeros(max(vocab.values()) + 1, np.int64)
        for piece, i in vocab.items():
            self.size[i] = len(piece) - (len(end) if end and piece.endswith(end) else 0)

    @classmethod
    def of(cls, model: str) -> Encoder:
        if hash(model) not in cls._known:
            cls._known[hash(model)] = cls(model)
        return cls._known[hash(model)]

    def _each(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        text = " ".join(words)
        ids = np.array(self._each([text])[0], "<u4")
        sizes = map(len, words) if text.isascii() else (
            len(w) if w.isascii() else len(unicodedata.normalize("NFC", w).lower().encode("utf-8")) for w in words)
        ends = np.cumsum(np.fromiter(sizes, np.int64, len(words)))
        got = np.cumsum(self.size[ids])
        at = np.searchsorted(got, ends)
        if not len(got) or got[-1] != ends[-1] or (got[np.minimum(at, len(got) - 1)] != ends).any():
            return None
        return ids, at + 1

    def flat(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and where each word begins (and the last one ends)."""
        ids, cuts, total = [], [np.zeros(1, np.int64)], 0
        for i in range(0, len(words), 1024):
            some = words[i:i + 1024]
            got = self._joined(some) if self.joins else None
            if got is None:
                each = self._each(some)
                got = np.array([k for x in each for k in x], "<u4"), np.cumsum([len(x) for x in each])
            ids.append(got[0])
            cuts.append(got[1] + total)
            total += len(got[0])
        return np.concatenate(ids) if ids else np.empty(0, "<u4"), np.concatenate(cuts)

    def ids(self, words: list[str]) -> list[list[int]]:
        ids, cuts = self.flat(words)
        ids, cuts = ids.tolist(), cuts.tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]


def read_model(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def pieces(model: str) -> dict[int, bytes]:
    """The vocabulary: the piece of each id."""
    from tokenizers import Tokenizer
    return {i: p.encode("utf-8") for p, i in Tokenizer.from_str(model).get_vocab(with_added_tokens=True).items()}


def _pack(x: np.ndarray) -> bytes:
    """Byte planes of 32-bit numbers, compressed."""
    planes = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


_BLOCK = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("counts", pa.binary()), ("positions", pa.binary()), ("words", pa.binary()), ("least", pa.list_(pa.int64()))])
_BLOCK_DDL = "block long, ids array<long>, counts binary, positions binary, words binary, least array<long>"


def _to_blocks(block_bytes: int):
    def run(it):
        part, made, pack = TaskContext.get().partitionId(), 0, zstandard.ZstdCompressor(level=3)
        ids, counts, arrays, known, size = [], [], [], {}, 0

        def flush():
            x = np.concatenate(arrays)
            order = np.argsort(-np.bincount(x, minlength=len(known)), kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            names = list(known)
            return pa.RecordBatch.from_arrays([
                pa.array([part << 32 | made], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([_pack(np.array(counts))], pa.binary()),
                pa.array([_pack(rank[x])], pa.binary()), pa.array([pack.compress(b"\n".join([names[i] for i in order.tolist()]))], pa.binary()),
                pa.array([sorted(_hash(w) for w in names)[:SKETCH]], pa.list_(pa.int64()))], schema=_BLOCK)

        for piece in slices(it, "text", 1 << 20):
            for doc, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                raw = utf8(text)
                words = raw.split()
                if size and size + len(raw) > block_bytes:
                    yield flush()
                    made += 1
                    ids, counts, arrays, known, size = [], [], [], {}, 0
                ids.append(doc)
                counts.append(len(words))
                arrays.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint32, len(words)))
                size += len(raw)
        if ids:
            yield flush()
    return run


def _hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word, 1) >> 1


def distinct_words(table: DataFrame) -> int:
    """About how many distinct words the blocks have: exact below ``SKETCH``, else from the place of the ``SKETCH``-th smallest hash."""
    least = [r[0] for r in table.select(F.explode("least").alias("h")).distinct().orderBy("h").limit(SKETCH).collect()]
    return len(least) if len(least) < SKETCH else int((SKETCH - 1) * 2.0 ** 63 / max(1, least[-1]))


def _words(data: bytes) -> list[bytes]:
    return data.split(b"\n") if data else []


_LIST = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("words", pa.binary())])


def _to_buckets(n: int):
    """The words of each block by hash bucket, in the block's order."""
    def run(it):
        pack, unpack = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        for batch in it:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out: list[list[bytes]] = [[] for _ in range(n)]
                for w in _words(unpack.decompress(data)):
                    out[xxhash.xxh3_64_intdigest(w) % n].append(w)
                for i in range(0, n, 64):
                    some = [b for b in range(i, min(n, i + 64)) if out[b]]
                    if some:
                        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([block] * len(some), pa.int64()),
                                                          pa.array([pack.compress(b"\n".join(out[b])) for b in some], pa.binary())], schema=_LIST)
    return run


#: A row of the word table holds up to so many words of a bucket and their ids, in the same order.
TABLE_WORDS = 20_000
_WORD = pa.schema([("bucket", pa.int64()), ("words", pa.binary()), ("made", pa.binary())])


def _distinct(model):
    """Each distinct word of a bucket, encoded once; rows come sorted by bucket."""
    def run(it):
        unpack, pack, at, seen = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3), None, set()

        def flush():
            words = sorted(seen)
            for i in range(0, len(words), TABLE_WORDS):
                some = words[i:i + TABLE_WORDS]
                made = [" ".join(map(str, ids)).encode() for ids in Encoder.of(model.value).ids([w.decode("utf-8") for w in some])]
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([pack.compress(b"\n".join(some))], pa.binary()),
                                                  pa.array([pack.compress(b"\n".join(made))], pa.binary())], schema=_WORD)

        for batch in it:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("words").to_pylist()):
                if bucket != at:
                    yield from flush()
                    at, seen = bucket, set()
                seen.update(_words(unpack.decompress(data)))
        yield from flush()
    return run


def word_table(lists: DataFrame, model) -> DataFrame:
    """``bucket, words, made``: the distinct words of ``lists`` (``bucket, block, words``) and their ids, as compressed lines."""
    n = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = lists.select("bucket", "words").repartition(n, "bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(_distinct(model), "bucket long, words binary, made binary")


_BACK = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("made", pa.binary())])


def _answer(it):
    """For each block's list of a bucket: the ids of its words, in their order. The rows of a bucket come with its word table first."""
    unpack, pack, at, made = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3), None, {}
    for batch in it:
        blocks, buckets, out = [], [], []
        for bucket, block, words, ids in zip(*[batch.column(c).to_pylist() for c in ("bucket", "block", "words", "made")]):
            if bucket != at:
                at, made = bucket, {}
            if ids is not None:
                made.update(zip(_words(unpack.decompress(words)), unpack.decompress(ids).split(b"\n")))
            else:
                blocks.append(block)
                buckets.append(bucket)
                out.append(pack.compress(b"\n".join([made[w] for w in _words(unpack.decompress(words))])))
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(buckets, pa.int64()), pa.array(out, pa.binary())], schema=_BACK)


def _texts(n: int, vocabulary):
    """The documents of each block: ``doc_id``, number of ids, ids and decoded text."""
    def run(it):
        unpack = zstandard.ZstdDecompressor()
        for batch in it:
            for ids, counts, positions, words, answers in zip(*[batch.column(c).to_pylist() for c in ("ids", "counts", "positions", "words", "answers")]):
                got = {a["bucket"]: iter(unpack.decompress(a["made"]).split(b"\n")) for a in answers or ()}
                number = [next(got[xxhash.xxh3_64_intdigest(w) % n]) for w in _words(unpack.decompress(words))]
                del got, answers, words
                piece = {str(i).encode(): p for i, p in vocabulary.value.items()}
                text = [b" ".join(map(piece.__getitem__, x.split())) for x in number]
                size = np.array([x.count(b" ") + 1 if x else 0 for x in number], np.int64)
                x, end = _unpack(positions), np.cumsum(_unpack(counts))
                for a in range(0, len(ids), 256):
                    rows = []
                    for i in range(a, min(len(ids), a + 256)):
                        own = x[end[i - 1] if i else 0:end[i]]
                        own = own[size[own] > 0].tolist()  # a word without tokens leaves no trace
                        rows.append((ids[i], int(size[own].sum()), b" ".join([number[k] for k in own]), b" ".join([text[k] for k in own])))
                    yield rows
    return run


def _joined(docs: DataFrame, model_path: str, block_bytes: int, emit, ddl: str) -> DataFrame:
    spark, model = docs.sparkSession, read_model(model_path)
    if json.loads(model)["decoder"] is not None:
        raise ValueError("pieces are joined by a space, as by a tokenizer without a decoder")
    shared, vocabulary = spark.sparkContext.broadcast(model), spark.sparkContext.broadcast(pieces(model))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = f"picsel_blocks_{uuid.uuid4().hex}", stage_path(spark, "blocks")
    (source.mapInArrow(_to_blocks(block_bytes), _BLOCK_DDL).write.option("path", path).option("compression", "none")
     .bucketBy(parts, "block").saveAsTable(name))
    table = spark.table(name)
    n = max(1, distinct_words(table) // BUCKET_WORDS)
    lists = table.select("block", "words").mapInArrow(_to_buckets(n), "bucket long, block long, words binary")
    known = stage(word_table(lists, shared), "words")
    both = lists.withColumn("made", F.lit(None).cast("binary")).unionByName(known.withColumn("block", F.lit(None).cast("long")))
    both = both.repartition(parts, "bucket").sortWithinPartitions("bucket", F.col("made").isNull(), "block")
    answers = stage(both.select("bucket", "block", "words", "made").mapInArrow(_answer, "block long, bucket long, made binary"), "answers")
    back = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "made")).alias("answers"))  # the words of one block
    texts = _texts(n, vocabulary)

    def run(it):
        for rows in texts(it):
            yield emit(rows)

    return table.join(back, "block", "left").mapInArrow(run, ddl)


def encode_documents(docs: DataFrame, model_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, ids, decoded`` of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def emit(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([[int(i) for i in r[2].split()] for r in rows], pa.list_(pa.int32())),
                                           pa.array([r[3].decode("utf-8") for r in rows], pa.string())], schema=schema)
    return _joined(docs, model_path, block_bytes, emit, "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, model_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row: the ids in decimal, joined by a space, and the decoded text."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    sha = lambda data: hashlib.sha256(data).hexdigest()

    def emit(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                           pa.array([sha(r[2]) for r in rows]), pa.array([sha(r[3]) for r in rows])], schema=schema)
    return _joined(docs, model_path, block_bytes, emit, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
