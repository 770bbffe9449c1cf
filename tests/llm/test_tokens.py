import random
import sys
import zlib

import numpy as np
import pytest

from marginlens.llm import bpe, pretokens, token_files

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

ODD = ["Hello  World's cÀfé <|endoftext|> 12 x_y", " 's 're 'll don't DON'T I'M we've !'s ''s 'sabc", "\n\n a\n b  \n",
       "ΑΣ ΣΑΣ İstanbul ǅ", "a b c\x85d", "①②½ 12٣", "é é ́x", "<|startoftext|>a<|endoftext|>", "a" * 5000,
       "😀😀 👨‍👩‍👧 'S", "\x1c\x1da b", "'", "''''ll", "日本語 テスト한국어 ไทย", " ", "", "a \n b\t\tc", "x" * 60 + " y"]


def _texts():
    rnd = random.Random(5)
    alphabet = "ab'srtelvmd  \n1é!Ω\t."
    return ODD + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 60))) for _ in range(400)]


def test_word_bpe_equals_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, lib = bpe.codec(path), Tokenizer.from_file(path)
    for text in _texts():
        want = lib.encode(text, add_special_tokens=False).ids
        ids = np.frombuffer(own.encode(text), "<u4")
        assert ids.tolist() == want, text
        cut = len(ids) // 2
        assert "".join(own.decode([ids[:cut], ids[cut:]])) == lib.decode(want, skip_special_tokens=False)


def test_byte_level_equals_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, _ = token_files.byte_level_encoder(path)
    lib = Tokenizer.from_file(path)
    for text in _texts():
        assert np.frombuffer(encode(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, text


def test_byte_level_decoder_is_incremental():
    own = bpe.Codec(public_tokenizers.path("byte_bpe_50k.json"))
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ["naïve 日本 😀 x", "😀", ""]:
        ids = np.array(lib.encode(text, add_special_tokens=False).ids, np.uint32)
        assert "".join(own.decode([ids[k:k + 1] for k in range(len(ids))])) == text


def test_transducer_holds_only_the_lookahead():
    m = bpe.codec(public_tokenizers.path("word_bpe_49k.json")).merges
    assert m.proper and 0 < m.lookahead < 1000
    rnd = random.Random(3)
    for waiting in (1, 7, 100):
        word = "".join(rnd.choice("thesinandreingtonXé") for _ in range(900)).encode()
        whole = [t for t, _ in m.merge([m.inner[b] for b in word[:-1]] + [m.final[word[-1]]])]
        assert list(m.transduce([word[:100], word[100:]], waiting)) == whole
        assert m.merge_short([m.inner[b] for b in word[:40]]) == [t for t, _ in m.merge([m.inner[b] for b in word[:40]])]


def test_lookahead_of_a_small_merge_list():
    def merges(*rules):
        vocab = {c: i for i, c in enumerate("abcd")}
        for a, b in rules:
            vocab[a + b] = len(vocab)
        return bpe.Merges({"model": {"vocab": vocab, "merges": [list(r) for r in rules]}})

    assert merges(("a", "b")).lookahead == 1
    assert merges(("b", "c"), ("a", "b")).lookahead >= 2  # whether a joins b depends on c
    assert merges(("a", "b"), ("ab", "c")).proper


def test_memo_is_bounded():
    calls = []
    memo = pretokens.Memo(lambda new: [calls.append(k) or k.encode() for k in new], most=5, longest=3)
    for k in range(50):
        assert memo([str(k % 7), "long-key"]) == [str(k % 7).encode(), b"long-key"]
        assert len(memo.known) <= 5


def test_slices_rejoin_and_cut_before_spaces():
    text = "ab cd  ef\n" * 300
    parts = list(pretokens.slices(text, 100))
    assert "".join(parts) == text and len(parts) > 10 and all(p[0].isspace() for p in parts[1:])


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 32])
def test_bit_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    data = token_files.pack(ids, bits)
    assert len(data) == -(-1001 * bits // 8)
    assert (token_files.unpack(data, bits, 1001) == ids).all()


def test_token_file_random_access(tmp_path, monkeypatch):
    from pyarrow import fs
    monkeypatch.setattr(token_files, "BLOCK_IDS", 64)
    local = fs.LocalFileSystem()
    path = str(tmp_path / "x.bits")
    rnd = np.random.default_rng(1)
    docs = [rnd.integers(0, 50257, n, dtype=np.uint32) for n in (0, 1, 63, 64, 65, 1000, 5)]
    w = token_files.TokenFileWriter(local.open_output_stream(path), 17)
    for k, d in enumerate(docs):
        w.add(None if k == 2 else k, d)
    w.close()
    t = token_files.TokenFile(local.open_input_file(path))
    whole = np.concatenate(docs)
    assert (t.read_slice(0, len(whole)) == whole).all() and (t.read_slice(120, 700) == whole[120:700]).all()
    assert t.valid.tolist() == [True, True, False, True, True, True, True]


def test_token_files_query_against_brute_force(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    rows = [(k * 3 % 101, t, "clash") for k, t in enumerate(_texts()[:80])] + [(500, None, "c"), (501, "w " * 40_000, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    from marginlens.session import scratch_path
    root = scratch_path(spark, "t")
    got = sorted(map(tuple, token_files.read_documents(token_files.write_token_files(docs, root, path), root).collect()))
    want, at = [], 0
    for doc, text, _ in sorted(rows, key=lambda r: r[0]):
        ids = np.array(lib.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want


def test_token_files_ties_nulls_and_empty(spark):
    from marginlens.session import scratch_path
    path = public_tokenizers.path("byte_bpe_50k.json")
    schema = "doc_id long, text string"
    root = scratch_path(spark, "t")
    docs = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], schema)
    got = token_files.read_documents(token_files.write_token_files(docs, root, path), root).collect()
    assert sorted((r.start, r.doc_id, r.n_tokens) for r in got) == [(0, None, 2), (2, 1, 2), (4, 1, 2)]
    root = scratch_path(spark, "t")
    empty = token_files.write_token_files(spark.createDataFrame([], schema), root, path)
    assert token_files.read_documents(empty, root).count() == 0


def test_bpe_dataframe_cases(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(1, "Hi there", "x"), (1, "Hi there", "x"), (None, None, "y"), (2, "", "z")],
                                 "doc_id long, text string, ids string")
    got = bpe.bpe_digests(docs, path).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in got) == [(-1, 0), (1, 2), (1, 2), (2, 0)]
    assert bpe.bpe_digests(docs.limit(0), path).count() == 0


def test_frequent_strings_stay_in_the_memo():
    asked = []
    memo = pretokens.Memo(lambda new: [asked.append(k) or k.encode() for k in new], most=20)
    for k in range(200):
        memo(["often", f"rare{k}"])
    assert asked.count("often") == 1 and len(memo.known) + len(memo.old) <= 20


def test_every_word_goes_through_the_transducer(monkeypatch):
    c = bpe.Codec(public_tokenizers.path("word_bpe_49k.json"))
    made, inner = [], c.merges.transduce
    monkeypatch.setattr(c.merges, "transduce", lambda data, *a: made.extend(out := list(inner(data, *a))) or iter(out))
    text = "streaming transducers emit tokens early once " + "x" * 5000
    assert sorted(np.frombuffer(c.encode(text), "<u4").tolist()) == sorted(made)  # words in any order


def test_digests_of_the_smallest_tables_equal_the_library(spark):
    import hashlib
    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op7_bpe(spark, "/root/testdata/sf0.001").collect()}
    for r in docs.select("doc_id", "text").collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        assert got[r.doc_id] == want


def test_long_documents_are_streamed(monkeypatch):
    import hashlib
    monkeypatch.setattr(bpe, "slices", lambda text: pretokens.slices(text, 200))
    c = bpe.Codec(public_tokenizers.path("word_bpe_49k.json"))
    text = "one two three <|endoftext|> four " * 500
    pieces = list(c.stream(text))
    assert len(pieces) > 100
    ids = b"".join(pieces)
    n, ids_hex, text_hex = c.digests(text)
    whole = "".join(c.decode([np.frombuffer(ids, "<u4")]))
    assert (n, ids_hex, text_hex) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(whole.encode()).hexdigest())


def _held(x):
    return sys.getsizeof(x) + sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in x.items())


def test_full_memos_leave_room_for_the_other_workers():
    """Three idle workers hold their memos beside an executor's JVM."""
    chunks = pretokens.WordChunks(lambda new: [b"\0" * 16 for _ in new], str)
    for a in range(0, 2_000_000, 5_000):
        chunks.encode(" ".join(f"word{k}" for k in range(a, a + 5_000)))
    memos = (chunks.chunks, chunks.pieces)
    assert sum(_held(m.known) + _held(m.old) for m in memos) < 130e6


def test_byte_level_words_with_punctuation_equal_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, _ = token_files.byte_level_encoder(path)
    lib = Tokenizer.from_file(path)
    rnd = random.Random(9)
    marks = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()] + ["é", "Ā", "×", "ª", "7", "…"]
    for _ in range(2_000):
        word = "".join(rnd.choice("abÉß") for _ in range(rnd.randint(1, 4)))
        text = " ".join(word + "".join(rnd.choice(marks) for _ in range(rnd.randint(0, 3))) for _ in range(3))
        assert np.frombuffer(encode(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, text
