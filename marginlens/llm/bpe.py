"""BPE encoding as a bounded-lookahead streaming transducer, and decoding.

A merge list is *proper* when both sides of every merge exist before it. For
such a list, whether a token is final depends on a bounded number of symbols
to its right: the right end of a token can only be taken by a merge of lower
rank than the one that absorbed it, and the partner of that merge can in turn
be disturbed only by a still lower one. Following these strictly falling ranks
gives the list's sufficient lookahead (:func:`sufficient_lookahead`). A word
is fed symbol by symbol; once more than a fixed number of symbols are waiting,
every token that ends at least the lookahead before the end is emitted and
forgotten, so memory stays constant however long the word is. Encoding may
restart at any emitted boundary, because a part of a valid tokenisation is the
tokenisation of its text. Every word goes through the transducer; words recur,
so a bounded memo of its output stands in front. What is left of a word at its
end is settled by a plain scan or a heap, whichever is faster for its length.

Decoding is an incremental machine: a token's symbols become bytes, bytes
become text as soon as a character is complete (byte-level decoder), or the
tokens' strings are joined by spaces (a file without decoder).

Defined cases: null text is empty (no ids, empty decoded text); white space is
dropped as the vocabulary's own pre-tokeniser does; special tokens in a text
are matched as the library matches them; an empty table gives an empty result.
"""
from __future__ import annotations

import bisect
import codecs
import functools
import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlens.llm.common import driver_table, ship_package
from marginlens.llm.pretokens import WordChunks, byte_symbols, slices, special_pattern, split_special

OUT_BYTES = 8 << 20  # text bytes encoded before a batch is sent back
SHORT_WORD = 48      # symbols up to which a plain scan beats a heap
MOST_WAITING = 2048  # symbols a word may hold beyond the lookahead


class Merges:
    """Ids, merge ranks and the sufficient lookahead of one vocabulary file."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rules: dict[tuple[int, int], tuple[int, int]] = {}
        made: dict[int, tuple[int, int, int]] = {}
        self.by_rank = [self.vocab[a + b] for a, b in pairs]
        self.proper = True
        for rank, (a, b) in enumerate(pairs):
            x, y, z = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.rules.setdefault((x, y), (rank, z))
            if z in made:
                self.proper = False  # two ways to the same token
            made[z] = (rank, x, y)
        for z, (rank, x, y) in made.items():
            if any(side in made and made[side][0] >= rank for side in (x, y)):
                self.proper = False
        self.made = made
        self.lookahead = self.sufficient_lookahead() if self.proper else None
        names = byte_symbols()
        self.inner = [self.vocab.get(c) for c in names]
        self.final = [self.vocab.get(c + self.suffix) for c in names]

    def sufficient_lookahead(self) -> int:
        """Symbols to the right of a token after which it can no longer change."""
        length: dict[int, int] = {}
        for z, (_, x, y) in sorted(self.made.items(), key=lambda m: m[1][0]):
            length[z] = length.get(x, 1) + length.get(y, 1)
        # per left side: ranks in rising order, and the furthest reach of the rules so far
        ranks: dict[int, list[int]] = {}
        reach: dict[int, list[int]] = {}

        def taken(token: int, below: int) -> int:
            """Reach of the rules that take ``token`` as left side at a rank under ``below``."""
            k = bisect.bisect_left(ranks.get(token, ()), below)
            return reach[token][k - 1] if k else 0

        def disturbed(token: int, below: int) -> int:
            most = taken(token, below)
            while token in self.made:
                rank, _, right = self.made[token]
                most = max(most, taken(right, rank))
                token = right
            return most

        for (x, y), (rank, _) in sorted(self.rules.items(), key=lambda r: r[1][0]):
            far = length.get(y, 1) + disturbed(y, rank)
            ranks.setdefault(x, []).append(rank)
            reach.setdefault(x, []).append(max(far, reach[x][-1] if reach.get(x) else 0))
        every = len(self.rules)
        return max((disturbed(t, every) for t in set(ranks) | set(self.made)), default=0)

    def merge(self, symbols: list[int]) -> list[tuple[int, int]]:
        """``(id, end)`` per token: lowest rank first, leftmost first."""
        n = len(symbols)
        rules = self.rules
        ids, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r[0], i, r[1]) for i in range(n - 1) if (r := rules.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, i, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or rules.get((ids[i], ids[j]), (-1,))[0] != rank:
                continue
            ids[i], ids[j] = made, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if r := rules.get((made, ids[k])):
                    heapq.heappush(heap, (r[0], i, r[1]))
            if (h := before[i]) >= 0 and (r := rules.get((ids[h], made))):
                heapq.heappush(heap, (r[0], h, r[1]))
        out, i = [], 0
        while i < n:
            out.append((ids[i], after[i]))
            i = after[i]
        return out

    def merge_short(self, ids: list[int]) -> list[int]:
        """:meth:`merge` for a few symbols, ids only: rescan the ranks after every merge."""
        none = (len(self.by_rank), -1)
        get, by_rank = self.rules.get, self.by_rank
        ranks = [get(pair, none)[0] for pair in zip(ids, ids[1:])]
        while ranks and (low := min(ranks)) < none[0]:
            i = ranks.index(low)
            ids[i:i + 2] = [by_rank[low]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), none)[0]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), none)[0]
        return ids

    def settle(self, symbols: list[int]) -> list[int]:
        """Ids of symbols after which no other can come."""
        return self.merge_short(symbols) if len(symbols) <= SHORT_WORD else [t for t, _ in self.merge(symbols)]

    def transduce(self, data: Iterable[bytes], waiting: int = MOST_WAITING) -> Iterator[int]:
        """Ids of one word whose bytes arrive in chunks."""
        inner, buf, held = self.inner, [], None  # the last byte is held: it may end the word
        limit = None if self.lookahead is None else self.lookahead + waiting
        for chunk in data:
            for a in range(0, len(chunk), MOST_WAITING):
                part = chunk[a:a + MOST_WAITING]
                if held is not None:
                    buf.append(inner[held])
                buf += map(inner.__getitem__, part[:-1])
                held = part[-1]
                if limit is not None and len(buf) > limit:
                    safe, done = len(buf) - self.lookahead, 0
                    for token, end in self.merge(buf):
                        if end > safe:
                            break
                        yield token
                        done = end
                    del buf[:done]
        if held is not None:
            buf.append(self.final[held])
            yield from self.settle(buf)


class Codec:
    """Encoder and decoder of one word-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.merges = Merges(spec)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = special_pattern(list(self.special))
        self.names = {i: s for s, i in self.merges.vocab.items()} | {i: s for s, i in self.special.items()}
        self.byte_level = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        back = {c: b for b, c in enumerate(byte_symbols())}
        if self.byte_level:
            # a special token's own string passes through as it is
            self.out = {i: bytes(back[c] for c in s) if all(c in back for c in s) else s.encode()
                        for i, s in self.names.items()}
        else:
            self.out = {i: s.encode() for i, s in self.names.items()}
        self.chunks = WordChunks(self._encode_new, self.normalise)

    def _encode_new(self, words: list[str]) -> list[bytes]:
        """New words through the transducer, one after another."""
        out, transduce = [], self.merges.transduce
        for w in words:
            ids = list(transduce((w.encode("utf-8", "surrogatepass"),)))
            out.append(struct.pack(f"<{len(ids)}I", *ids))
        return out

    @staticmethod
    def normalise(text: str) -> str:
        # lower case per code point: a final capital sigma stays an inner one
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def stream(self, text: str) -> Iterator[bytes]:
        """Ids as little-endian 32-bit integers, slice by slice of the text."""
        for k, part in enumerate(split_special(text, self.pattern)):
            if k % 2:
                yield struct.pack("<I", self.special[part])
            else:
                for s in slices(part):
                    yield self.chunks.encode(s)

    def encode(self, text: str) -> bytes:
        """All ids of the text."""
        return b"".join(self.stream(text))

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids and of the decoded text, in hex.

        Ids are emitted, decoded and hashed slice by slice: neither the ids nor
        the decoded text of the document are ever whole in memory.
        """
        ids_hash, text_hash, n = hashlib.sha256(), hashlib.sha256(), 0

        def emitted():
            nonlocal n
            for data in self.stream(text):
                ids_hash.update(data)
                n += len(data) // 4
                yield np.frombuffer(data, "<u4")

        for piece in self.decode(emitted()):
            text_hash.update(piece.encode())
        return n, ids_hash.hexdigest(), text_hash.hexdigest()

    def decode(self, chunks: Iterable[np.ndarray]) -> Iterator[str]:
        """Text of the ids in ``chunks``, each piece as soon as it is complete."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        joint = b"" if self.byte_level else b" "
        first = True
        for ids in chunks:
            if not len(ids):
                continue
            data = joint.join(map(self.out.__getitem__, ids.tolist()))
            yield machine.decode(data if first else joint + data)
            first = False
        yield machine.decode(b"", final=True)


@functools.cache
def codec(path: str) -> Codec:
    return Codec(path)


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, decoded`` per row: ids as little-endian 32-bit binary."""
    ship_package(docs.sparkSession)

    def run(batches):
        c = codec(tokenizer_path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            at, size, ids, decoded = 0, 0, [], []
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                data = c.encode(text)
                flat = np.frombuffer(data, "<u4")
                ids.append(data)
                decoded.append("".join(c.decode(flat[k:k + 65536] for k in range(0, len(flat), 65536))))
                size += len(text)
                if size >= OUT_BYTES or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [keys.slice(at, i + 1 - at), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                        names=["doc_id", "ids", "decoded"])
                    at, size, ids, decoded = i + 1, 0, [], []

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    key = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {key}, ids binary, decoded string")


def bpe_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per row."""
    ship_package(docs.sparkSession)

    def run(batches):
        c = codec(tokenizer_path)
        for batch in batches:
            found = [c.digests(t.as_py() or "") for t in batch.column(1)]
            n, ids, decoded = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                                              pa.array(decoded, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    key = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {key}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_digests(driver_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
