"""Token-id output as length-delimited binary records with an offset index (operator 1).

File format of a shard ``part-NNNNN.rec``: records end to end. A record is

    length   8 bytes  little-endian count of payload bytes
    check    4 bytes  masked crc32 of the length field
    payload  doc_id (8 bytes, signed), flags (1 byte: 1 if doc_id is null, 2 if ids are wide), then the ids,
             little-endian, 2 bytes each, or 4 bytes each where an id of the record is over 65535
    check    4 bytes  masked crc32 of the payload

The mask rotates the checksum by 15 bits and adds a constant, so that a checksum stored inside a
checksummed payload does not weaken it. ``part-NNNNN.idx`` holds the byte offset of each record of
the shard, 8 bytes each: a shuffled reader seeks to any record without reading the others.

Files are written by the tasks through pyarrow's file systems, under the folder the cluster shares.
A task writes to a name of its own attempt and moves the file to its final name when it is whole,
so a lost executor or a second attempt leaves either a whole file or none.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.storage import arrow_map

# Fixed values of the checksum mask.
MASK_ROTATE, MASK_ADD = 15, 0xA282EAD8
MEMO_WORDS = 400_000
# Texts, and characters of them, that are encoded together, and words in a string for the library: they bound memory.
TOGETHER, TOGETHER_CHARS, STRING_WORDS = 64, 1_000_000, 1_000

# The pattern of the byte-level splitter; FAST has its classes written out for texts of PLAIN characters.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
FAST = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\t-\r {_LETTERS}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")


def masked_crc32(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> MASK_ROTATE) | (crc << (32 - MASK_ROTATE))) + MASK_ADD) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc32(length)), payload, struct.pack("<I", masked_crc32(payload))))


def unframe(read: Callable[[int], bytes]) -> bytes | None:
    """The next payload of a stream; None at its end. Raises ValueError on a cut or damaged record."""
    head = read(12)
    if not head:
        return None
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked_crc32(head[:8]):
        raise ValueError("damaged record: its length does not match its checksum")
    n = struct.unpack("<Q", head[:8])[0]
    body = read(n + 4)
    if len(body) < n + 4 or struct.unpack("<I", body[n:])[0] != masked_crc32(body[:n]):
        raise ValueError("damaged record: its payload does not match its checksum")
    return body[:n]


def read_record(stream, offset: int) -> bytes:
    """The payload at a byte offset taken from the index."""
    stream.seek(offset)
    got = unframe(stream.read)
    if got is None:
        raise ValueError("no record at this offset")
    return got


def pack_ids(ids: bytes, null: bool) -> bytes:
    """Flags and ids of a record from ids as unsigned 32-bit integers."""
    wide = np.frombuffer(ids, "<u4")
    if len(wide) and int(wide.max()) > 0xFFFF:
        return bytes([null | 2]) + ids
    return bytes([int(null)]) + wide.astype("<u2").tobytes()


def unpack_ids(body: bytes) -> tuple[np.ndarray, bool]:
    """(ids as unsigned 32-bit integers, whether doc_id is null)."""
    return np.frombuffer(body, "<u4" if body[0] & 2 else "<u2", offset=1).astype("<u4"), bool(body[0] & 1)


class ByteBpeEncoder:
    """Ids of whole texts by the tokenizers library.

    BPE works inside pre-split words, so the library encodes each distinct word once and the ids are kept in a
    bounded memo. Texts with characters outside PLAIN, or with the opening of an added token, go to the library whole.
    New words that begin with a space go to it end to end, as one string: the splitter cuts before each such
    space, and as tokens are byte strings, their lengths tell where the ids of each word end.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.openings = {t.content[0] for t in self.tokenizer.get_added_tokens_decoder().values() if t.content}
        self.memo: dict[str, bytes] = {}
        self.aged: dict[str, bytes] = {}  # the memo before this one: words still in use are taken over from it
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.n_bytes = np.zeros(max(vocab.values(), default=-1) + 1, np.int64)
        for token, k in vocab.items():  # in the byte-level alphabet a character stands for a byte
            self.n_bytes[k] = len(token)

    def learn(self, words: list[str]) -> None:
        """Ids of ``words`` into the memo."""
        known = {w: ids for w in words if (ids := self.aged.get(w)) is not None}
        if known:
            self.memo.update(known)
            words = [w for w in words if w not in known]
        spaced, rest = [], []
        for w in words:
            (spaced if len(w) > 1 and w[0] == " " and w[1] not in "\t\n\v\f\r " else rest).append(w)
        if spaced:
            ends = np.array([len(w) if w.isascii() else len(w.encode()) for w in spaced]).cumsum()
            strings = ["".join(spaced[k:k + STRING_WORDS]) for k in range(0, len(spaced), STRING_WORDS)]
            ids = np.array([i for got in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False) for i in got.ids], "<u4")
            reached = self.n_bytes[ids].cumsum()
            last = np.searchsorted(reached, ends)
            if len(reached) and last[-1] < len(reached) and (reached[last] == ends).all():
                raw, to = ids.tobytes(), ((last + 1) * 4).tolist()
                self.memo.update(zip(spaced, [raw[i:j] for i, j in zip([0, *to[:-1]], to, strict=True)], strict=True))
            else:
                rest = words
        for w, got in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.memo[w] = np.array(got.ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; the new words of all of them are learned together."""
        if len(self.memo) > MEMO_WORDS:
            self.memo, self.aged = {}, self.memo
        memo, out, split = self.memo, [], []
        for k, text in enumerate(texts):
            if not PLAIN.fullmatch(text) or any(c in text for c in self.openings):
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes())
                continue
            words = FAST.findall(text)
            got = list(map(memo.get, words))
            if None in got:
                split.append((k, got, [(i, words[i]) for i, ids in enumerate(got) if ids is None]))
            out.append(b"" if None in got else b"".join(got))
        if split:
            self.learn(list(dict.fromkeys([w for _, _, missing in split for _, w in missing])))
        for k, got, missing in split:
            for i, w in missing:
                got[i] = memo[w]
            out[k] = b"".join(got)
        return out


def encoded_rows(encoder: ByteBpeEncoder | None, batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
    """(id, ids of the text) of each row, some rows at a time."""
    idents, texts, chars = [], [], 0
    for ident, text in zip(batch.column(0), batch.column(1), strict=True):
        idents.append(ident.as_py())
        texts.append(text.as_py() or "")
        chars += len(texts[-1])
        if len(texts) == TOGETHER or chars > TOGETHER_CHARS:
            yield from zip(idents, encoder.encode_all(texts), strict=True)
            idents, texts, chars = [], [], 0
    if texts:
        yield from zip(idents, encoder.encode_all(texts), strict=True)


_encoders: dict[str, ByteBpeEncoder] = {}


def worker_encoder(path: str) -> ByteBpeEncoder:
    """The encoder of this Python worker: its memo serves all tasks that the worker runs."""
    if path not in _encoders:
        _encoders[path] = ByteBpeEncoder(path)
    return _encoders[path]


def _store(uri: str):
    """(file system, path) of a folder; any scheme that pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else re.sub("^file:/*", "file:///", uri) if uri.startswith("file:") else "file://" + uri)


def write_records(docs: DataFrame, folder: str, path: str, end_id: int, shards: int,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, append ``end_id`` and write the records in ascending id order; run at once.

    Shards are ranges of ids, so reading them in turn gives the whole order; rows that share an id stay in one
    shard. Returns a table with one row for each shard file: shard, file, n_docs, n_tokens, first_token (ids in
    earlier shards). A null or empty text is the end id alone; null ids come first; other columns are not read.
    An empty table gives no file and an empty manifest.
    """
    spark = docs.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        shard, encoder, out, offsets, at, n_tokens = context.partitionId(), None, None, [], 0, 0
        name, mark = f"part-{shard:05d}", f"{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        tail = struct.pack("<I", end_id)
        for batch in batches:
            if out is None and batch.num_rows:
                store, base = _store(folder)
                store.create_dir(base, recursive=True)
                encoder, out = worker_encoder(path), store.open_output_stream(f"{base}/_{name}-{mark}.rec")
            for value, encoded in encoded_rows(encoder, batch):
                ids = encoded + tail
                record = frame(struct.pack("<q", value or 0) + pack_ids(ids, value is None))
                out.write(record)
                offsets.append(at)
                at, n_tokens = at + len(record), n_tokens + len(ids) // 4
        if out is None:
            return
        out.close()
        with store.open_output_stream(f"{base}/_{name}-{mark}.idx") as index:
            index.write(np.array(offsets, "<u8").tobytes())
        for kind in ("idx", "rec"):
            store.move(f"{base}/_{name}-{mark}.{kind}", f"{base}/{name}.{kind}")
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([f"{name}.rec"]),
                                          pa.array([len(offsets)], pa.int64()), pa.array([n_tokens], pa.int64())],
                                         names=["shard", "file", "n_docs", "n_tokens"])

    ordered = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
        .repartitionByRange(shards, "id").sortWithinPartitions("id", "text")
    rows = arrow_map(ordered, write, "shard int, file string, n_docs long, n_tokens long").collect()  # one row a shard file
    first, out = 0, []
    for r in sorted(rows):
        out.append((r.shard, r.file, r.n_docs, r.n_tokens, first))
        first += r.n_tokens
    return spark.createDataFrame(out, "shard int, file string, n_docs long, n_tokens long, first_token long")


def read_records(manifest: DataFrame, folder: str, shards: int) -> DataFrame:
    """Records of the shard files, checksums verified: doc_id, start (ids before it in all files), n_tokens,
    ids_crc32, shard, offset. Each file is read as a stream by one task."""
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("doc_id", T.LongType()), ("start", T.LongType()), ("n_tokens", T.LongType()), ("ids_crc32", T.LongType()),
        ("shard", T.IntegerType()), ("offset", T.LongType()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                store, base = _store(folder)
                rows, start, at = [], r["first_token"], 0
                with store.open_input_stream(f"{base}/{r['file']}", buffer_size=1 << 20) as stream:
                    while (payload := unframe(stream.read)) is not None:
                        ident, ids, null = struct.unpack("<q", payload[:8])[0], *unpack_ids(payload[8:])
                        n = len(ids)
                        rows.append((None if null else ident, start, n, zlib.crc32(ids.tobytes()), r["shard"], at))
                        start, at = start + n, at + len(payload) + 16
                        if len(rows) == 10_000:
                            yield _rows(rows, schema)
                            rows = []
                if start != r["first_token"] + r["n_tokens"]:
                    raise ValueError(f"{r['file']} does not hold the ids that the manifest counts")
                if rows:
                    yield _rows(rows, schema)

    return arrow_map(manifest.repartition(max(1, shards), "shard"), read, schema)


def _rows(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    types = [pa.int32() if isinstance(f.dataType, T.IntegerType) else pa.int64() for f in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=schema.names)


def shard_count(spark: SparkSession) -> int:
    """Shards for a write: as many as the session's shuffle partitions, the usual size of a task's share."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
