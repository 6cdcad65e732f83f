"""Token ids of a corpus as bit-plane shuffled, compressed blocks.

Format.  The ids of a part (a range of document ids) form one stream, cut into blocks of a fixed
number of ids.  A block is a header, the lengths of its compressed planes, and the planes::

    magic "TIDB" | version u8 | plane bits u8 (1 or 8) | planes u16 | ids u32    little-endian
    length u32, one for each plane
    zstandard frames, lowest plane first; planes above the highest set bit are left out

A plane holds the same bit (or byte) of every id of the block, so the rarely set upper planes
shrink to almost nothing.  Blocks are the rows of a Parquet table, beside the chunk index: part,
chunk number, number of ids, and the documents that the block holds pieces of.  Spark commits
whole tasks, so a lost executor leaves no half-written file, and any store will do.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialize, ship_package

MAGIC, VERSION = b"TIDB", 1
HEADER = struct.Struct("<4sBBHI")
BLOCK_IDS = 1 << 16
MEMO = 120_000  # words that a worker remembers, in each of two generations
MEMO_CHARS = 64  # longer ones are not remembered
SLICE_BYTES = 1 << 23  # text that is cut into words at a time; a longer text is one slice
PART_BYTES = 1 << 28  # text of a part, about


# ------------------------------------------------------------------------- the block format


def encode_block(ids: np.ndarray, plane_bits: int = 8, level: int = 3) -> bytes:
    """A block of ids below 2**32."""
    if plane_bits not in (1, 8):
        raise ValueError("planes are of 1 or 8 bits")
    ids = np.ascontiguousarray(ids, dtype="<u4")
    used = int(ids.max(initial=0)).bit_length()
    octets = ids.view(np.uint8).reshape(-1, 4)
    if plane_bits == 8:
        planes = [np.ascontiguousarray(octets[:, i]).tobytes() for i in range(-(-used // 8))]
    else:
        planes = [np.packbits(octets[:, i // 8] >> (i % 8) & 1, bitorder="little").tobytes() for i in range(used)]
    pack = zstandard.ZstdCompressor(level=level).compress
    packed = [pack(p) for p in planes]
    head = HEADER.pack(MAGIC, VERSION, plane_bits, len(packed), len(ids))
    return b"".join([head, struct.pack(f"<{len(packed)}I", *map(len, packed)), *packed])


def decode_block(block: bytes) -> np.ndarray:
    magic, version, plane_bits, n_planes, n = HEADER.unpack_from(block)
    if magic != MAGIC or version != VERSION or plane_bits not in (1, 8):
        raise ValueError("not a block of token ids")
    lengths = struct.unpack_from(f"<{n_planes}I", block, HEADER.size)
    at = HEADER.size + 4 * n_planes
    octets = np.zeros((n, 4), dtype=np.uint8)
    unpack = zstandard.ZstdDecompressor().decompress
    for i, length in enumerate(lengths):
        plane = np.frombuffer(unpack(block[at : at + length]), dtype=np.uint8)
        at += length
        if plane_bits == 8:
            octets[:, i] = plane
        else:
            octets[:, i // 8] |= np.unpackbits(plane, bitorder="little", count=n) << (i % 8)
    return octets.reshape(-1).view("<u4")


# ---------------------------------------------------------------------------- the tokenizer

# The settings of the tokenizer file for which words can be encoded one by one.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_SPLIT = {
    "type": "Split",
    "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}

# characters for which the rules below hold exactly: ASCII and the letters of Latin-1
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = ".,;:!?"
_SIMPLE = re.compile(rf"[!-~{_LETTERS}]*").fullmatch
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^0-9a-zß-öø-ÿ]+").findall


def _byte_alphabet() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves and move the others past 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(moved)}


class _Memo(dict):
    """Computes what it is asked for once, and forgets what was not asked for in two rounds of
    ``MEMO`` entries."""

    def __init__(self, compute: Callable[[str], bytes]):
        super().__init__()
        self.compute, self.old = compute, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= MEMO:
            self.old = self.copy()
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Encodes texts with a tokenizer file of the tokenizers library.

    Where the file's settings never join text across blanks, a text is encoded chunk by chunk,
    and chunks are remembered: the library's model sees each distinct word once.  Chunks with
    other characters than ASCII and Latin-1 letters, or with what may be a special token, and
    files with other settings, go through the whole library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        steps = (settings.get("pre_tokenizer") or {}).get("pretokenizers")
        self.by_chunk = (
            settings.get("normalizer") == _NORMALIZER
            and steps == [_SPLIT, _BYTES]
            and settings.get("post_processor") is None
            and all(t["content"].startswith("<|") for t in settings.get("added_tokens", []))
            and not settings.get("truncation")
            and not settings.get("padding")
        )
        self.model = self.tokenizer.model
        self.alphabet = _byte_alphabet()
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.chunks, self.pieces = _Memo(self._chunk), _Memo(self._piece)

    def _whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        spelled = piece.encode().decode("latin-1").translate(self.alphabet)
        return array(self.code, [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if _SIMPLE(chunk) and "<|" not in chunk:
            return b"".join(map(self.pieces.__getitem__, _PIECES(chunk.lower())))
        return self._whole(chunk)

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.large_string()))[0]

    def _distinct(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks in a row, and how many each has.  Most chunks are a word and
        perhaps a mark behind it: these share the ids of their word in lower case."""
        plain = pc.match_substring_regex(chunks, f"^[{_LETTERS}]+[{_MARKS}]?$")
        words = pc.utf8_lower(chunks.filter(plain))
        bare = pc.utf8_rtrim(words, characters=_MARKS)
        marked = pc.greater(pc.binary_length(words), pc.binary_length(bare)).to_numpy(zero_copy_only=False)
        numbered = bare.dictionary_encode()
        marks = pc.index_in(pc.utf8_slice_codeunits(words, -1), pa.array(list(_MARKS), words.type))
        found = [self.pieces[w] if len(w) <= MEMO_CHARS else self._piece(w) for w in numbered.dictionary.to_pylist()]
        first_mark = len(found)
        found += [self.pieces[m] for m in _MARKS] + [b""]
        first_other = len(found)
        found += [
            self.chunks[c] if len(c) <= MEMO_CHARS else self._chunk(c) for c in chunks.filter(pc.invert(plain)).to_pylist()
        ]
        is_plain = plain.to_numpy(zero_copy_only=False)
        parts = np.full((len(chunks), 2), first_other - 1, dtype=np.int64)  # nothing
        parts[is_plain, 0] = numbered.indices.to_numpy()
        parts[is_plain, 1] = np.where(marked, first_mark + pc.fill_null(marks, 0).to_numpy(), first_other - 1)
        parts[~is_plain, 0] = first_other + np.arange(len(found) - first_other)
        sizes = np.array([len(f) for f in found], dtype=np.int64) // np.dtype(self.code).itemsize
        ids, lengths = _laid_out(np.frombuffer(b"".join(found), dtype=self.code), sizes, parts.ravel())
        return ids, lengths.reshape(-1, 2).sum(axis=1)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has.  Nulls have none.

        Arrow cuts the texts into chunks and numbers the distinct ones; only these are encoded,
        and numpy lays out their ids in the order of the text.
        """
        texts = pc.fill_null(texts, "")
        if not self.by_chunk:
            coded = [self._whole(t) for t in texts.to_pylist()]
            counts = np.array([len(c) for c in coded], dtype=np.int64) // np.dtype(self.code).itemsize
            return np.frombuffer(b"".join(coded), dtype=self.code), counts
        for blank in "\n\t\r":
            texts = pc.replace_substring(texts, blank, " ")
        lists = pc.split_pattern(texts, " ")
        numbered = lists.flatten().dictionary_encode()
        ids, lengths = _laid_out(*self._distinct(numbered.dictionary), numbered.indices.to_numpy())
        ends = np.cumsum(lengths)
        words = np.cumsum(pc.list_value_length(lists).to_numpy())
        upto = np.concatenate(([0], ends))[words]
        return ids, np.diff(upto, prepend=0)


def _laid_out(known: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries numbered ``at`` in a row, and their lengths; ``known`` holds all entries in
    a row, of the given sizes."""
    begins = np.cumsum(sizes) - sizes
    lengths = sizes[at]
    before = np.cumsum(lengths) - lengths
    return known[np.repeat(begins[at] - before, lengths) + np.arange(int(lengths.sum()))], lengths


def _slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Runs of texts of about ``SLICE_BYTES``, each with its place."""
    if not len(texts):
        return
    run = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)) // SLICE_BYTES
    begins = np.concatenate(([0], np.flatnonzero(np.diff(run)) + 1, [len(texts)])).tolist()
    for a, b in zip(begins, begins[1:]):
        yield a, texts.slice(a, b - a)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker, with what it remembers."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# ------------------------------------------------------------------------------ writing


def _schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("chunk", T.LongType()),
            T.StructField("n_ids", T.IntegerType()),
            T.StructField("first_doc", T.LongType()),
            T.StructField("continues", T.BooleanType()),
            T.StructField("continued", T.BooleanType()),
            T.StructField("doc_ids", T.ArrayType(id_type)),
            T.StructField("lengths", T.ArrayType(T.IntegerType())),
            T.StructField("block", T.BinaryType()),
        ]
    )


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    parts: int | None = None,
    block_ids: int = BLOCK_IDS,
    plane_bits: int = 8,
) -> None:
    """Encodes every whole text, appends ``end_id``, and writes the ids to ``path`` in ascending
    order of ``id_col`` (nulls first): part by part, and within a part document by document.

    The documents are sorted across ``parts`` tasks (one for each ``PART_BYTES`` of text, and at
    least as many as shuffles use, if not given), which stream them: a task holds one Arrow batch,
    one slice of it cut into words, and one block.  A null text is an empty one; rows that repeat
    an id lie side by side in the order of a hash of their texts, so that different texts of one
    id can be dealt to several tasks; a document may span many blocks.  An empty table gives no
    blocks.  Other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    if not parts:
        size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    id_type = docs.schema[id_col].dataType
    schema = _schema(id_type)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, work = TaskContext.get().partitionId(), encoder(tokenizer_path)
        held, n_held, ids, lengths = [], 0, [], []
        chunk = n_docs = 0
        inside = False  # the block begins inside a document
        arrow_id = None

        def block(open_: bool) -> pa.RecordBatch:
            """What is held as one row; ``open_``: its last document goes on."""
            values = np.concatenate(held)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([chunk], pa.int64()),
                    pa.array([len(values)], pa.int32()),
                    pa.array([n_docs - len(ids)], pa.int64()),
                    pa.array([inside]),
                    pa.array([open_]),
                    pa.array([ids], pa.list_(arrow_id)),
                    pa.array([lengths], pa.list_(pa.int32())),
                    pa.array([encode_block(values, plane_bits)], pa.binary()),
                ],
                names=[f.name for f in schema],
            )

        def ended(names: pa.Array, texts: pa.Array) -> Iterator[tuple[object, np.ndarray]]:
            """Each document's id and token ids, the end id behind them."""
            for first, some in _slices(texts):
                found, counts = work.encode_all(some)
                ids = np.insert(found.astype("<u4"), np.cumsum(counts), end_id)
                stops = np.cumsum(counts + 1).tolist()
                for name, a, b in zip(names.slice(first, len(some)).to_pylist(), [0, *stops], stops):
                    yield name, ids[a:b]

        for batch in batches:
            arrow_id = batch.column(0).type
            for doc_id, rest in ended(batch.column(0), batch.column(1)):
                n_docs += 1
                while len(rest):
                    piece, rest = rest[: block_ids - n_held], rest[block_ids - n_held :]
                    held.append(piece)
                    ids.append(doc_id)
                    lengths.append(len(piece))
                    n_held += len(piece)
                    if n_held == block_ids:
                        yield block(len(rest) > 0)
                        inside = len(rest) > 0
                        held, n_held, ids, lengths = [], 0, [], []
                        chunk += 1
        if n_held:
            yield block(False)

    ordered = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(parts, "id", "tie")
        .sortWithinPartitions("id", "tie")
        .select("id", "text")
    )
    ordered.mapInArrow(encode, schema).write.parquet(path)


# ------------------------------------------------------------------------------ reading


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the polynomial of crc32, lowest power in bit 31."""
    product = 0
    for i in range(32):
        if a >> (31 - i) & 1:
            product ^= b
        b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
    return product


def join_crc(first: int, second: int, second_bytes: int) -> int:
    """crc32 of two byte strings in a row, from those of each."""
    power, base, n = 1 << 31, 1 << 23, second_bytes  # x**0 and x**8
    while n:
        if n & 1:
            power = _times(power, base)
        base = _times(base, base)
        n >>= 1
    return _times(power, first) ^ second


def read_documents(spark: SparkSession, path: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone.

    Every block is decoded by itself, in any task.  Only the pieces of documents that cross the
    border of a block are brought together; their checksums are joined by arithmetic.
    """
    ship_package(spark)
    table = spark.read.parquet(path)
    id_type = table.schema["doc_ids"].dataType.elementType

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                octets = np.ascontiguousarray(decode_block(row["block"])).view(np.uint8).data
                n = len(row["lengths"])
                ends = np.cumsum(row["lengths"], dtype=np.int64)
                starts = ends - row["lengths"]
                crcs = [zlib.crc32(octets[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                whole = np.ones(n, dtype=bool)
                whole[0] &= not row["continues"]
                whole[-1] &= not row["continued"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * n, pa.int32()),
                        pa.array(row["first_doc"] + np.arange(n)),
                        pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type),
                        pa.array(row["chunk"] * block_ids + starts),
                        pa.array(row["lengths"], pa.int64()),
                        pa.array(crcs, pa.int64()),
                        pa.array(whole),
                    ],
                    names=["part", "doc", "doc_id", "at", "n_tokens", "crc", "whole"],
                )

    pieces = table.mapInArrow(
        decode,
        T.StructType(
            [
                T.StructField("part", T.IntegerType()),
                T.StructField("doc", T.LongType()),
                T.StructField("doc_id", id_type),
                T.StructField("at", T.LongType()),
                T.StructField("n_tokens", T.LongType()),
                T.StructField("crc", T.LongType()),
                T.StructField("whole", T.BooleanType()),
            ]
        ),
    )
    pieces = materialize(pieces, "token-pieces")
    # one row for each part
    sizes = table.groupBy("part").agg(F.sum(F.col("n_ids").cast("long")).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins = sizes.select(F.col("part"), (F.sum("n").over(before) - F.col("n")).alias("begin"))

    @F.udf("long")
    def joined(found: list) -> int:
        crc = found[0]["crc"]
        for p in found[1:]:
            crc = join_crc(crc, p["crc"], 4 * p["n_tokens"])
        return crc

    whole = pieces.filter("whole").select("part", "doc_id", "at", "n_tokens", F.col("crc").alias("ids_crc32"))
    # a document's own pieces: one for each block that it touches
    parted = (
        pieces.filter("NOT whole")
        .groupBy("part", "doc")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.min("at").alias("at"),
            F.sum("n_tokens").alias("n_tokens"),
            F.array_sort(F.collect_list(F.struct("at", "n_tokens", "crc"))).alias("pieces"),
        )
        .select("part", "doc_id", "at", "n_tokens", joined("pieces").alias("ids_crc32"))
    )
    return (
        whole.unionByName(parted)
        .join(begins, "part")
        .select("doc_id", (F.col("begin") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
    )
