"""Token ids in fixed-width bit-packed files.

Layout of a file (little-endian)::

    magic, bits, ids per block | packed blocks | footer | footer length, magic
    footer: n_ids, n_docs, block byte offsets (one more than blocks),
            doc ids, doc validity, doc starts (ids before each, one more than docs)

Each id takes ``bits`` = the least that holds the vocabulary. A block packs a
fixed number of ids and starts on a byte, so block offsets give random access
(:func:`read_slice`) and numpy unpacks a block at once.

Documents are range-partitioned and sorted on their id; every task encodes
its range and writes files under unique names. Only the files of successful
tasks enter the manifest (one row per file), so retries leave no trace. Global
positions come from a running sum over the manifest.

Defined cases: null text is empty (one end id); null ids come first; rows
repeating an id stay separate documents; an empty table gives no files.
"""
from __future__ import annotations

import functools
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marginlens.llm.common import driver_table, open_fs, ship_package, staged
from marginlens.llm.pretokens import ByteLevelChunks, byte_symbols, slices, special_pattern, split_special
from marginlens.session import scratch_path

MAGIC = b"MLBITS01"
HEAD = struct.Struct("<8sII")
BLOCK_IDS = 1 << 16      # a multiple of 8, so every full block ends on a byte
ROLL_IDS = 1 << 27       # ids after which a task starts a new file
READ_DOCS = 4096


def bit_width(vocab_size: int) -> int:
    return max(1, (vocab_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` at ``bits`` bits each, least significant bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return flat.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


class TokenFileWriter:
    def __init__(self, out, bits: int):
        self.out, self.bits = out, bits
        self.at = HEAD.size
        self.offsets, self.doc_ids, self.starts = [self.at], [], [0]
        self.pending, self.n_pending, self.n_ids = [], 0, 0
        out.write(HEAD.pack(MAGIC, bits, BLOCK_IDS))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.pending.append(ids)
        self.n_pending += len(ids)
        self.n_ids += len(ids)
        self.starts.append(self.n_ids)
        if self.n_pending >= BLOCK_IDS:
            self._flush(self.n_pending // BLOCK_IDS * BLOCK_IDS)

    def _flush(self, upto: int) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.empty(0, np.uint32)
        for a in range(0, upto, BLOCK_IDS):
            data = pack(ids[a:min(a + BLOCK_IDS, upto)], self.bits)
            self.out.write(data)
            self.at += len(data)
            self.offsets.append(self.at)
        self.pending, self.n_pending = [ids[upto:].copy()], len(ids) - upto

    def close(self) -> None:
        if self.n_pending:
            self._flush(self.n_pending)
        valid = np.array([d is not None for d in self.doc_ids], np.uint8)
        footer = b"".join((
            struct.pack("<QQ", self.n_ids, len(self.doc_ids)),
            struct.pack("<Q", len(self.offsets)), np.array(self.offsets, "<u8").tobytes(),
            np.array([d or 0 for d in self.doc_ids], "<i8").tobytes(), valid.tobytes(),
            np.array(self.starts, "<u8").tobytes()))
        self.out.write(footer + struct.pack("<Q8s", len(footer), MAGIC))
        self.out.close()


class TokenFile:
    """Random access to a file's ids; blocks are read on demand."""

    def __init__(self, f):
        self.f = f
        size = f.size()
        f.seek(size - 16)
        length, magic = struct.unpack("<Q8s", f.read(16))
        if magic != MAGIC:
            raise ValueError("not a token file, or cut short")
        f.seek(0)
        _, self.bits, self.block_ids = HEAD.unpack(f.read(HEAD.size))
        f.seek(size - 16 - length)
        foot = f.read(length)
        self.n_ids, self.n_docs, n_off = struct.unpack("<QQQ", foot[:24])
        at = 24
        self.offsets = np.frombuffer(foot, "<u8", n_off, at)
        at += 8 * n_off
        self.doc_ids = np.frombuffer(foot, "<i8", self.n_docs, at)
        at += 8 * self.n_docs
        self.valid = np.frombuffer(foot, np.uint8, self.n_docs, at).astype(bool)
        at += self.n_docs
        self.starts = np.frombuffer(foot, "<u8", self.n_docs + 1, at).astype(np.int64)

    def block(self, k: int) -> np.ndarray:
        a, b = int(self.offsets[k]), int(self.offsets[k + 1])
        self.f.seek(a)
        n = min(self.block_ids, self.n_ids - k * self.block_ids)
        return unpack(self.f.read(b - a), self.bits, n)

    def pieces(self, start: int, stop: int, last: list) -> Iterator[np.ndarray]:
        """Ids ``start`` to ``stop`` block by block; ``last`` memoises the last block."""
        while start < stop:
            k = start // self.block_ids
            if not last or last[0] != k:
                last[:] = [k, self.block(k)]
            a = start - k * self.block_ids
            got = last[1][a:a + stop - start]
            yield got
            start += len(got)

    def read_slice(self, start: int, stop: int) -> np.ndarray:
        return np.concatenate([*self.pieces(start, stop, []), np.empty(0, np.uint32)])


@functools.cache
def byte_level_encoder(tokenizer_path: str):
    """``text -> little-endian 32-bit ids`` with the tokenizers library.

    The library's BPE model encodes each distinct piece; pieces are what its
    own pre-tokeniser cuts, so the ids are those of the whole text.
    """
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path)
    special = {t.content: i for i, t in tok.get_added_tokens_decoder().items()}
    pattern = special_pattern(list(special))

    tokenize, names = tok.model.tokenize, byte_symbols()

    def encode_new(pieces: list[str]) -> list[bytes]:
        out = []
        for piece in pieces:
            # the byte-level alphabet: printable ASCII stands for itself
            plain = piece.isascii() and piece.isprintable()
            symbols = piece.replace(" ", names[0x20]) if plain else "".join(map(names.__getitem__, piece.encode()))
            ids = [t.id for t in tokenize(symbols)]
            out.append(struct.pack(f"<{len(ids)}I", *ids))
        return out

    chunks = ByteLevelChunks(encode_new)

    def encode(text: str) -> bytes:
        out = []
        for k, part in enumerate(split_special(text, pattern)):
            if k % 2:
                out.append(struct.pack("<I", special[part]))
            else:
                out += [chunks.encode(s) for s in slices(part)]
        return b"".join(out)

    return encode, tok.get_vocab_size(with_added_tokens=True)


MANIFEST_SCHEMA = "part int, seq int, file string, n_docs long, n_ids long"


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and write ``docs`` in ascending id order; returns the manifest."""
    ship_package(docs.sparkSession)

    def write(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode, vocab = byte_level_encoder(tokenizer_path)
        bits = bit_width(max(vocab, end_id + 1))
        tail = struct.pack("<I", end_id)
        fs, root = open_fs(path)
        fs.create_dir(root, recursive=True)
        writer, seq, name = None, 0, ""

        def close():
            writer.close()
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "file": [name],
                "n_docs": [len(writer.doc_ids)], "n_ids": [writer.n_ids]})

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                if writer is None:
                    name = f"{part:06d}-{uuid.uuid4().hex}.bits"
                    writer = TokenFileWriter(fs.open_output_stream(f"{root}/{name}", compression=None), bits)
                data = encode(texts[i].as_py() or "") + tail
                writer.add(ids[i].as_py(), np.frombuffer(data, "<u4"))
                if writer.n_ids >= ROLL_IDS:
                    yield close()
                    writer, seq = None, seq + 1
        if writer is not None:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return staged(rows.mapInArrow(write, MANIFEST_SCHEMA), "token_manifest")


def read_documents(manifest: DataFrame, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    ship_package(manifest.sparkSession)

    def read(batches):
        fs, root = open_fs(path)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{root}/{row['file']}") as f:
                    t = TokenFile(f)
                    last: list = []
                    for a in range(0, t.n_docs, READ_DOCS):
                        b = min(a + READ_DOCS, t.n_docs)
                        crc = []
                        for k in range(a, b):
                            c = 0
                            for ids in t.pieces(int(t.starts[k]), int(t.starts[k + 1]), last):
                                c = zlib.crc32(ids.astype("<u4").tobytes(), c)
                            crc.append(c)
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": pa.array(t.doc_ids[a:b], mask=~t.valid[a:b]),
                            "start": pa.array(t.starts[a:b] + row["base"]),
                            "n_tokens": pa.array(np.diff(t.starts[a:b + 1])),
                            "ids_crc32": pa.array(crc, pa.int64())})

    # one row per file: the running sum over the manifest is small
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))
    files = staged(based.repartition(manifest.sparkSession.sparkContext.defaultParallelism * 4), "token_files")
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    manifest = write_token_files(driver_table(spark, sf_dir, "documents"), path,
                                 public_tokenizers.path("byte_bpe_50k.json"))
    return read_documents(manifest, path)
