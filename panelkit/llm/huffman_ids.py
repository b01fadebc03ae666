"""Token ids in compact files: canonical length-limited Huffman code.

The tokenizers library encodes every text; ids are counted over the whole
corpus and the counts give one code, of at most ``MOST_BITS`` bits, by
package-merge. The code is canonical, so its file holds only the length of each id's code.

Files (Parquet in one folder, written and read by Spark, so any shared store
serves and a lost task's file is simply written again):

* ``codebook``: (id, bits).
* ``blocks``: (place, docs, lengths, payload, checkpoints). A block holds the
  ids of consecutive whole documents in ascending id order, about ``BLOCK_IDS``
  of them (a longer document alone). ``place`` orders the blocks, ``docs`` and
  ``lengths`` name its documents, ``payload`` is the bit string, ``checkpoints``
  the bit offset of every ``STRIDE``-th id. Each block is read without any other.
* ``index``: (place, start, n): how many ids stand before each block and in it.

Decoding looks the next ``MOST_BITS`` bits up in a table of (id, bits); all
checkpoints of a block go on in step, as one numpy vector.

Defined results: a null text counts as empty; every document ends with the
``end_id``. Null ids sort first; rows that agree in the id stand in the order
of their text hash. An empty table gives empty files.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import column_of, scratch_path, stage
from .token_chunks import PieceTable, encoded, joins_safely, ragged

MOST_BITS = 20
BLOCK_IDS = 1 << 16
STRIDE = 512
#: Ids that are decoded in step: a few blocks, or one large one.
DECODED = 1 << 20
#: Bytes of text looked up together: fewer, larger additions to the worker's table.
CHUNK_BYTES = (1 << 22) - (1 << 12)
#: Pieces a worker remembers.
PIECES = 1_500_000
_U = np.uint64

_tables: dict[str, PieceTable] = {}


# ----------------------------------------------------------------- tokenizer

def worker_table(path: str) -> PieceTable:
    """This worker's tokenizer behind a table of pieces; the vocabulary file lies at the same path on every node."""
    if path not in _tables:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)  # a special token's string in a text is that token, as in the plain call
        # a byte-level token has one character for each byte
        width = np.array([len(tokenizer.id_to_token(i) or "") for i in range(tokenizer.get_vocab_size())], np.int64)
        _tables[path] = PieceTable(lambda values: encode_pieces(tokenizer, width, values), PIECES)
    return _tables[path]


def encode_pieces(tokenizer, width: np.ndarray, values: list[str], at_once: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pieces one after the other, and how many each has. Pieces that may
    stand behind each other are encoded as one text; the bytes of its tokens tell where each ends."""
    safe = np.fromiter(map(joins_safely, values), bool, len(values))
    order = np.concatenate([np.flatnonzero(safe), np.flatnonzero(~safe)])
    together, apart = int(safe.sum()), [values[i] for i in order[int(safe.sum()):].tolist()]
    groups = [[values[i] for i in order[low:min(low + at_once, together)].tolist()] for low in range(0, together, at_once)]
    found = tokenizer.encode_batch_fast(["".join(g) for g in groups] + apart, add_special_tokens=False)
    parts, sizes = [], []
    for group, e in zip(groups, found):
        ids = np.array(e.ids, np.int32)
        ends = np.cumsum(np.fromiter((len(v.encode()) for v in group), np.int64, len(group)))
        last = np.searchsorted(np.cumsum(width[ids]), ends, "right")
        parts.append(ids)
        sizes.append(np.diff(last, prepend=0))
    for e in found[len(groups):]:
        parts.append(np.array(e.ids, np.int32))
        sizes.append(np.array([len(e.ids)], np.int64))
    ids, size = np.concatenate(parts), np.concatenate(sizes)
    back = np.argsort(order)
    return ids[ragged((np.cumsum(size) - size)[back], size[back])], size[back]


def tokenised(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """(doc_id, tie, ids), written. Ids are little-endian integers of 16 bits where all of a text fit, else of 32."""
    text = column_of(docs, text_col).cast("string")

    @F.arrow_udf(T.BinaryType())
    def encode(text: pa.Array) -> pa.Array:
        end = np.array([end_id], np.int32)
        table = worker_table(path)
        return pa.array([_narrow(np.append(ids[a:b], end)) for ids, at in encoded(text, table, CHUNK_BYTES)
                         for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())

    rows = docs.select(column_of(docs, id_col).alias("doc_id"), F.xxhash64(text).alias("tie"), encode(text).alias("ids"))
    return stage(rows, "ids")


def ordered(rows: DataFrame) -> DataFrame:
    """(place, doc_id, ids) in ascending id order over all partitions; ``place`` rises with it."""
    rows = rows.orderBy(F.col("doc_id").asc_nulls_first(), "tie")
    return rows.select(F.monotonically_increasing_id().alias("place"), "doc_id", "ids")


def _narrow(ids: np.ndarray) -> bytes:
    small = ids.max() < 1 << 16
    return (b"\0" if small else b"\1") + ids.astype("<u2" if small else "<u4").tobytes()


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u4" if raw[0] else "<u2", offset=1)


def count_ids(rows: DataFrame) -> pa.Table:
    """(id, n) over all texts; no more rows than the vocabulary has ids."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            raws = [raw.as_py() for raw in batch.column(0)]
            for wide in (False, True):
                ids = np.frombuffer(b"".join(raw[1:] for raw in raws if bool(raw[0]) is wide), "<u4" if wide else "<u2")
                own = np.bincount(ids)
                if len(own) > len(total):
                    total = np.pad(total, (0, len(own) - len(total)))
                total[:len(own)] += own
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    return rows.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()


# -------------------------------------------------------------------- code

def code_lengths(counts: np.ndarray, most: int = MOST_BITS) -> np.ndarray:
    """Bits of each symbol with a count, optimal under the limit, by package-merge."""
    used = np.flatnonzero(counts)
    if len(used) > 1 << most:
        raise ValueError(f"{len(used)} symbols do not fit {most} bits")
    bits = np.zeros(len(counts), np.int64)
    if len(used) == 1:
        bits[used] = 1
        return bits
    order = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[order].astype(np.float64)
    levels, weight = [], leaf  # of each level: which entries of its sorted list are packages
    for _ in range(most - 1):
        whole = len(weight) // 2 * 2
        package = weight[0:whole:2] + weight[1:whole:2]
        both = np.concatenate([leaf, package])
        rank = np.argsort(both, kind="stable")
        levels.append(rank >= len(leaf))
        weight = both[rank]
    take = 2 * len(leaf) - 2
    for is_package in [*reversed(levels), np.zeros(len(leaf), bool)]:
        packages = int(is_package[:take].sum())
        bits[order[:take - packages]] += 1
        take = 2 * packages
    return bits


def canonical_codes(bits: np.ndarray) -> np.ndarray:
    """Code of each symbol: by length, then by id."""
    codes = np.zeros(len(bits), _U)
    used = np.flatnonzero(bits)
    used = used[np.lexsort((used, bits[used]))]
    code, last = 0, 0
    for i in used.tolist():
        code <<= int(bits[i]) - last
        last = int(bits[i])
        codes[i] = code
        code += 1
    return codes


def pack(ids: np.ndarray, codes: np.ndarray, bits: np.ndarray, stride: int = STRIDE) -> tuple[bytes, np.ndarray]:
    """Bit string of the ids and the bit offset of every ``stride``-th."""
    length = bits[ids]
    ends = np.cumsum(length)
    at = ends - length
    value = codes[ids]
    word, over = at >> 6, (at & 63) + length - 64  # bits that do not fit the word
    fits = over <= 0
    first = np.where(fits, value << np.maximum(-over, 0).astype(_U), value >> np.maximum(over, 0).astype(_U))
    out = np.zeros(int(ends[-1] + 63 >> 6) + 1, _U)
    begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    out[word[begin]] = np.bitwise_or.reduceat(first, begin)
    out[word[~fits] + 1] |= value[~fits] << (64 - over[~fits]).astype(_U)
    return out[:int(ends[-1] + 63 >> 6)].astype(">u8").tobytes(), at[::stride]


class Decoder:
    """Table of the id and length for every string of ``most`` bits."""

    def __init__(self, bits: np.ndarray, most: int = MOST_BITS):
        self.most = most
        used = np.flatnonzero(bits)
        used = used[np.lexsort((used, bits[used]))]
        self.symbol = np.repeat(used, 1 << (most - bits[used])).astype(np.int32)
        self.length = bits[self.symbol].astype(np.int32)
        missing = (1 << most) - len(self.symbol)  # a code of one symbol fills half
        self.symbol, self.length = np.pad(self.symbol, (0, missing)), np.pad(self.length, (0, missing), constant_values=1)

    def unpack(self, payload: bytes, checkpoints: np.ndarray, n: int, stride: int = STRIDE) -> np.ndarray:
        """The n ids of one block."""
        return self.unpack_all([(payload, checkpoints, n)], stride)[0]

    def unpack_all(self, blocks: list[tuple[bytes, np.ndarray, int]], stride: int = STRIDE) -> list[np.ndarray]:
        """The ids of each block (payload, checkpoints, n): the checkpoints of all blocks are decoded in step."""
        words = np.frombuffer(b"".join(p for p, _, _ in blocks), ">u4").astype(_U)
        pairs = (words << _U(32)) | np.append(words[1:], _U(0))
        before = 8 * np.cumsum([0, *(len(p) for p, _, _ in blocks)])
        lanes = [len(c) for _, c, _ in blocks]
        start = np.concatenate([c.astype(np.int64) + b for (_, c, _), b in zip(blocks, before)])
        size = np.full(len(start), min(stride, max(n for _, _, n in blocks)), np.int64)  # ids behind each checkpoint
        ends = np.cumsum(lanes)
        size[ends - 1] = [n - (k - 1) * stride for k, (_, _, n) in zip(lanes, blocks)]
        order = np.argsort(-size, kind="stable")
        at, going = start[order], len(start) - np.searchsorted(np.sort(size), np.arange(size.max()), "right")
        out = np.zeros((int(size.max()), len(at)), np.int32)
        top = np.int64(64 - self.most)
        for i, m in enumerate(going.tolist()):
            here = at[:m]
            window = (pairs[here >> 5] >> (top - (here & 31)).astype(_U)).astype(np.int64) & ((1 << self.most) - 1)
            out[i, :m] = self.symbol[window]
            here += self.length[window]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        ids = out.T[back]
        whole = ids[np.arange(ids.shape[1]) < size[:, None]]
        return np.split(whole, np.cumsum([n for _, _, n in blocks])[:-1])


# -------------------------------------------------------------------- files

def write_ids(docs: DataFrame, folder: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
              block_ids: int = BLOCK_IDS) -> None:
    """Tokenise ``docs`` and write codebook, blocks and index to ``folder``. The ids are written once, unordered;
    the code comes from their counts, and blocks are packed where the sort delivers them."""
    spark = docs.sparkSession
    encoded_rows = tokenised(docs, path, id_col, text_col, end_id)
    counts = count_ids(encoded_rows)
    rows = ordered(encoded_rows)
    tally = np.zeros(max(counts.column("id").to_pylist(), default=0) + 1, np.int64)
    tally[counts.column("id").to_numpy()] = counts.column("n").to_numpy()
    bits = code_lengths(tally)
    used = np.flatnonzero(bits)
    spark.createDataFrame(list(zip(used.tolist(), bits[used].tolist())), "id long, bits long").coalesce(1).write.parquet(f"{folder}/codebook")

    shared = spark.sparkContext.broadcast((canonical_codes(bits), bits))
    schema = T.StructType([T.StructField("place", T.LongType()), T.StructField("docs", T.ArrayType(rows.schema["doc_id"].dataType)),
                           T.StructField("lengths", T.ArrayType(T.IntegerType())), T.StructField("payload", T.BinaryType()),
                           T.StructField("checkpoints", T.ArrayType(T.LongType()))])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a partition come in its order; a block ends where it is full."""
        codes, bits = shared.value
        places, held, docs, size = [], [], [], 0

        def made() -> pa.RecordBatch:
            payload, checkpoints = pack(np.concatenate(held), codes, bits)
            return pa.RecordBatch.from_arrays(
                [pa.array(places[:1], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), pa.concat_arrays([d for d in docs])),
                 pa.array([[len(x) for x in held]], pa.list_(pa.int32())), pa.array([payload], pa.binary()),
                 pa.array([checkpoints], pa.list_(pa.int64()))], ["place", "docs", "lengths", "payload", "checkpoints"])

        for batch in batches:
            for i, (place, raw) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2))):
                if held and (size >= block_ids or place != places[-1] + 1):
                    yield made()
                    places, held, docs, size = [], [], [], 0
                places.append(place)
                held.append(_wide(raw.as_py()))
                docs.append(batch.column(1).slice(i, 1))
                size += len(held[-1])
        if held:
            yield made()

    rows.select("place", "doc_id", "ids").mapInArrow(blocks, schema).write.option("compression", "none").parquet(f"{folder}/blocks")

    sizes = spark.read.parquet(f"{folder}/blocks").select(
        "place", F.shiftright("place", 33).alias("part"), F.aggregate("lengths", F.lit(0).cast("long"), lambda n, x: n + x).alias("n"))
    earlier = (Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n").alias("part_n"))
    parts = parts.select("part", F.coalesce(F.sum("part_n").over(Window.orderBy("part").rowsBetween(*earlier)), F.lit(0)).alias("part_start"))
    within = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("place").rowsBetween(*earlier)), F.lit(0))
    index = sizes.withColumn("within", within).join(parts, "part")
    index.select("place", (F.col("part_start") + F.col("within")).alias("start"), "n").write.parquet(f"{folder}/index")


def read_codebook(spark: SparkSession, folder: str) -> np.ndarray:
    """Bits of each id; no more rows than the vocabulary has ids."""
    book = spark.read.parquet(f"{folder}/codebook").toArrow()
    bits = np.zeros(max(book.column("id").to_pylist(), default=0) + 1, np.int64)
    bits[book.column("id").to_numpy()] = book.column("bits").to_numpy()
    return bits


def read_ids(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, decoded block by block; with
    ``digest`` the crc32 of the ids as unsigned 32-bit integers stands in for them."""
    shared = spark.sparkContext.broadcast(read_codebook(spark, folder))
    blocks = spark.read.parquet(f"{folder}/blocks")
    doc_type = blocks.schema["docs"].dataType.elementType
    last = T.StructField("ids_crc32", T.LongType()) if digest else T.StructField("ids", T.ArrayType(T.IntegerType()))
    schema = T.StructType([T.StructField("place", T.LongType()), T.StructField("doc_id", doc_type), T.StructField("before", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), last])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            held, size = [], 0
            for i in range(len(batch)):
                place, docs, lengths, payload, checkpoints = (batch.column(k)[i] for k in range(5))
                ends = np.cumsum(lengths.values.to_numpy().astype(np.int64))
                held.append((place.as_py(), docs.values, ends, (payload.as_py(), checkpoints.values.to_numpy(), int(ends[-1]))))
                size += int(ends[-1])
                if size >= DECODED or i + 1 == len(batch):
                    for (place, docs, ends, _), ids in zip(held, decoder.unpack_all([b for *_, b in held])):
                        yield made(place, docs, ends, ids)
                    held, size = [], 0

    def made(place: int, docs: pa.Array, ends: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        starts = np.append(0, ends[:-1])
        if digest:
            raw = memoryview(ids.astype("<u4").tobytes())
            value = pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64())
        else:
            value = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(ends), place)), docs, pa.array(starts), pa.array(ends - starts), value],
                                          [f.name for f in schema])

    decoded = blocks.select("place", "docs", "lengths", "payload", "checkpoints").mapInArrow(decode, schema)
    index = spark.read.parquet(f"{folder}/index").select("place", "start")
    return decoded.join(index, "place").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", last.name)


def written_and_read(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) as read back from files in the shared folder."""
    folder = scratch_path(docs.sparkSession, "token-ids")
    write_ids(docs, folder, path, id_col, text_col, end_id)
    return read_ids(docs.sparkSession, folder, digest=True)
