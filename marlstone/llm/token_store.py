"""Token-id files: one zstandard frame per document under a shared dictionary.

A store is a folder with two tables.

``dictionary``  one row: the trained dictionary, its hash, the width of an id in bytes,
                the tokenizer's file name and the end id.
``blocks``      one row per block of consecutive documents: shard and block number, first
                and last doc_id, the dictionary's hash, ids before the block within its
                shard, the offset index (doc_id, offset, length, ids; fixed width) and the
                frames end to end.

Shards are ranges of doc_id, so blocks in (shard, block) order hold the documents in
ascending order. Reading one document opens the blocks whose range covers it, checks the
hash and decompresses its frame alone.

Cases: a null text is an empty one and still gets its end id. Null ids come first. Rows that
share an id all stay, ordered by their text's hash. An empty table gives a store without blocks. Too few
documents to train on give an empty dictionary. Texts of any length are encoded whole and
have one frame each; of a very long one the dictionary's sample takes the first SAMPLE_CHARS
characters. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.batches import raw, slices
from marlstone.llm.chunks import Memo, Ragged, distinct

#: Documents and id bytes that the dictionary is trained on at most, and its size.
TRAIN_DOCS, TRAIN_BYTES, DICT_BYTES = 512, 8 << 20, 112 << 10
#: Characters of a document that the dictionary's sample takes at most, so that the driver gets 128 MB at the very most.
SAMPLE_CHARS = 1 << 16
#: Frames gathered into one block.
BLOCK_BYTES = 1 << 20
LEVEL = 3
#: Chunks whose ids a worker remembers, about; and chunks encoded in a row.
MEMO, ROW = 1_000_000, 256

INDEX = np.dtype([("known", "u1"), ("doc_id", "<i8"), ("offset", "<u8"), ("size", "<u4"), ("n", "<u4")])

BLOCKS = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("first_doc", T.LongType()),
        T.StructField("last_doc", T.LongType()),
        T.StructField("dict_hash", T.StringType()),
        T.StructField("shard_start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("index", T.BinaryType()),
        T.StructField("frames", T.BinaryType()),
    ]
)

# White space of more than one byte in UTF-8, and that of one.
_WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_SPACE = b" \t\n\x0b\x0c\r"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(_SPACE)] = True


class Encoder:
    """Texts to ids, by way of the distinct chunks among them.

    A byte-level pre-tokenizer never carries a token from other characters into following
    white space, so a chunk of white space and the characters after it has the same ids alone
    as in its text. Each distinct chunk is encoded once by the tokenizers library, many of them
    in a row, and the row's ids are dealt out again by the bytes they stand for. Other kinds of
    tokenizers encode text by text.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = id_type(path)
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.by_chunk = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.width[i] = len(token)  # one character stands for a byte
        self.memo = Memo(self.kind, MEMO)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunks(self, chunks: Ragged) -> Ragged:
        """Ids of distinct chunks. Those that begin with a space and end in ASCII otherwise can stand in a row."""
        first, last = chunks.flat[chunks.at[:-1]], chunks.flat[chunks.at[1:] - 1]
        fits = (first == 32) & (last < 128) & ~_IS_SPACE[last]
        row, alone = np.flatnonzero(fits), np.flatnonzero(~fits)
        whole = chunks.take(alone)
        data = whole.flat.tobytes()
        single = [np.array(i, self.kind) for i in self._encode([data[a:b].decode() for a, b in zip(whole.at[:-1].tolist(), whole.at[1:].tolist())])]
        joined = chunks.take(row)
        data, edges = joined.flat.tobytes(), joined.at[::ROW].tolist() + [int(joined.at[-1])] * (len(row) % ROW > 0)
        ids = np.concatenate([np.zeros(0, self.kind), *[np.array(i, self.kind) for i in self._encode([data[a:b].decode() for a, b in zip(edges, edges[1:])])]])
        cuts = np.searchsorted(np.cumsum(self.width[ids]), joined.at[1:]) + 1
        size = np.zeros(len(chunks), np.int64)
        size[alone], size[row] = [len(x) for x in single], np.diff(cuts, prepend=0)
        both = Ragged(np.concatenate([np.zeros(0, self.kind), *single, ids]), np.concatenate([[0], np.cumsum(np.concatenate([size[alone], size[row]]))]))
        back = np.empty(len(chunks), np.int64)
        back[np.concatenate([alone, row])] = np.arange(len(chunks))
        return both.take(back)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and where each text's begin (n + 1)."""
        if not self.by_chunk:
            found = [np.array(i, self.kind) for i in self._encode(texts.to_pylist())]
            return np.concatenate([np.zeros(0, self.kind), *found]), np.concatenate([[0], np.cumsum([len(f) for f in found], dtype=np.int64)])
        data, offsets = raw(texts)
        if not len(data):
            return np.zeros(0, self.kind), np.zeros(len(offsets), np.int64)
        space, whole = _IS_SPACE[data], data.tobytes()
        for m in _WIDE_SPACE.finditer(whole):
            space[m.start() : m.end()] = True
        begins = np.empty(len(data), bool)
        begins[0], begins[1:] = True, space[1:] & ~space[:-1]
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        start = np.flatnonzero(begins)
        texts_ = Ragged(data, np.append(start, len(data)))
        hashes, first, which = distinct(texts_)
        known = self.memo.find(hashes, texts_, first)
        new = np.flatnonzero(known < 0)
        chunks = texts_.take(first[new])
        made = self._chunks(chunks)
        out = self.memo.with_rows(made, known, new).take(known[which])
        self.memo.add(hashes[new], chunks, made)
        return out.flat, out.at[np.searchsorted(start, offsets)]


def id_type(path: str) -> np.dtype:
    from tokenizers import Tokenizer

    return np.dtype("<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4")


_OPEN: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The tokenizer of this process; a worker keeps it, and what it remembers, from task to task."""
    if path not in _OPEN:
        _OPEN[path] = Encoder(path)
    return _OPEN[path]


def train_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary, or none (b"") if the samples don't suffice."""
    if len(samples) < 16 or sum(map(len, samples)) < 4096:
        return b""
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, max(1024, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def dict_hash(dictionary: bytes) -> str:
    import xxhash

    return xxhash.xxh3_128_hexdigest(dictionary)


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> None:
    """Tokenize ``docs`` and write a store to ``path``."""
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # The sample's hashes come first, without their texts; then the few texts up to the last of them.
    order = F.xxhash64("doc_id", "text")
    last = docs.select(order.alias("h")).orderBy("h").limit(TRAIN_DOCS).agg(F.max("h")).first()[0]
    picked = docs.where(order <= last).select(F.substring("text", 1, SAMPLE_CHARS).alias("text")).limit(TRAIN_DOCS) if last is not None else docs.select("text").limit(0)
    encode, kind, samples, size = encoder(tokenizer), id_type(tokenizer), [], 0
    for row in picked.toLocalIterator():
        ids = encode(pa.array([row.text]))[0].tobytes()
        if size + len(ids) <= TRAIN_BYTES:
            samples.append(ids)
            size += len(ids)
    trained = train_dictionary(samples)
    spark.createDataFrame([(bytearray(trained), dict_hash(trained), kind.itemsize, os.path.basename(tokenizer), end_id)], "dictionary binary, dict_hash string, width int, tokenizer string, end_id long").coalesce(1).write.parquet(f"{path}/dictionary")
    # Bounds of ranges are drawn from a sample of the keys at the driver: numbers, not texts.
    keyed = docs.withColumn("h", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").drop("h")
    ordered.mapInArrow(_packer(tokenizer, kind.str, trained, end_id), BLOCKS).write.parquet(f"{path}/blocks")


def _packer(tokenizer: str, kind: str, trained: bytes, end_id: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    tag = dict_hash(trained)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, press = encoder(tokenizer), zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(trained))
        end = np.array([end_id], kind).tobytes()
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        index: list[tuple] = []
        frames: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal block, before, size
            table = np.array(index, INDEX)
            known = [x[1] for x in index if x[0]]
            n = int(table["n"].sum())
            row = [shard, block, min(known, default=None), max(known, default=None), tag, before, n, table.tobytes(), b"".join(frames)]
            block, before, size = block + 1, before + n, 0
            index.clear()
            frames.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _ARROW)], names=BLOCKS.names)

        for batch in batches:
            for part in slices(batch, "text"):
                ids, cuts = encode(part.column(1))
                for doc, a, b in zip(part.column(0).to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist()):
                    frame = press.compress(ids[a:b].tobytes() + end)
                    index.append((doc is not None, doc or 0, size, len(frame), b - a + 1))
                    frames.append(frame)
                    size += len(frame)
                    if size >= BLOCK_BYTES:
                        yield close()
        if index:
            yield close()

    return pack


_ARROW = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]


def _header(spark: SparkSession, path: str) -> tuple[bytes, str, str]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    return bytes(row.dictionary), row.dict_hash, f"<u{row.width}"


def documents(table: np.ndarray, frames: bytes, trained: bytes) -> Iterator[tuple[int | None, np.ndarray, memoryview]]:
    """The index entries of a block with their frames."""
    view = memoryview(frames)
    for entry in table:
        at = int(entry["offset"])
        yield (int(entry["doc_id"]) if entry["known"] else None), entry, view[at : at + int(entry["size"])]


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a store: doc_id, start, n_tokens, ids_crc32.

    ``start`` adds the ids of earlier shards to those before the block in its shard; the
    shard totals are one row for each written partition.
    """
    trained, tag, kind = _header(spark, path)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("total")).orderBy("shard").collect()
    bases, at = {}, 0
    for row in totals:
        bases[row.shard], at = at, at + row.total

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor(dict_data=_dictionary(trained))
        for batch in batches:
            for row in batch.to_pylist():
                if row["dict_hash"] != tag:
                    raise ValueError(f"block {row['shard']}/{row['block']} needs dictionary {row['dict_hash']}")
                table, sums = np.frombuffer(row["index"], INDEX), []
                for _, entry, frame in documents(table, row["frames"], trained):
                    ids = np.frombuffer(opener.decompress(frame), kind)
                    if len(ids) != entry["n"]:
                        raise ValueError("a frame and its index differ")
                    sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                n = table["n"].astype(np.int64)
                start = bases[row["shard"]] + row["shard_start"] + np.cumsum(n) - n
                yield pa.RecordBatch.from_arrays([pa.array(table["doc_id"], mask=table["known"] == 0), pa.array(start), pa.array(n), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return blocks.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids of the named documents; only blocks whose range covers one are read."""
    trained, tag, kind = _header(spark, path)
    wanted = sorted(set(doc_ids))
    covers = F.exists(F.array(*[F.lit(d).cast("long") for d in wanted]), lambda d: d.between(F.col("first_doc"), F.col("last_doc")))
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").where((F.col("first_doc") <= wanted[-1]) & (F.col("last_doc") >= wanted[0]) & covers)

    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor(dict_data=_dictionary(trained))
        for batch in batches:
            for row in batch.to_pylist():
                if row["dict_hash"] != tag:
                    raise ValueError(f"block {row['shard']}/{row['block']} needs dictionary {row['dict_hash']}")
                table = np.frombuffer(row["index"], INDEX)
                hit = table[(table["known"] == 1) & np.isin(table["doc_id"], wanted)]
                found = [(doc, np.frombuffer(opener.decompress(frame), kind).astype(np.int64).tolist()) for doc, _, frame in documents(hit, row["frames"], trained)]
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.int64()), pa.array([i for _, i in found], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return blocks.select("first_doc", "last_doc", "shard", "block", "dict_hash", "index", "frames").mapInArrow(fetch, "doc_id long, ids array<long>")
