"""Operators 1 and 10: exact against the tokenizers library, round trips, file format."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from webloom.llm import bpe, queries, records
from webloom.llm.storage import new_folder

from .conftest import table

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def naive_bpe(symbols, ranks):
    parts = list(symbols)
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get((parts[i], parts[i + 1]), 1 << 30))
        if (parts[best], parts[best + 1]) not in ranks:
            break
        parts[best:best + 2] = [parts[best] + parts[best + 1]]
    return parts


@pytest.mark.parametrize("merges", [
    [("a", "a")], [("a", "a"), ("aa", "a")], [("a", "a"), ("aa", "aa")], [("a", "b"), ("b", "c"), ("ab", "c"), ("a", "bc")],
    [("b", "a"), ("a", "b"), ("ba", "ba"), ("ab", "ab"), ("baba", "b")], []])
def test_automaton_accepts_exactly_the_bpe_tokens(merges):
    labels = ["a", "b", "c"] + [u + v for u, v in merges]
    vocab = {t: k for k, t in enumerate(dict.fromkeys(labels))}
    automaton, rng = bpe.TokenAutomaton(vocab, merges), random.Random(3)
    ranks = {m: k for k, m in enumerate(merges)}
    for _ in range(300):
        word = "".join(rng.choice("aabc") for _ in range(rng.randrange(1, 14)))
        assert [automaton.labels[t] for t in automaton.encode(word)] == naive_bpe(word, ranks), word


def texts():
    rng = random.Random(5)
    out = ["", " ", "don't DON'T we'll x²½ Σας ΑΣ İ ﬁ 日本 é 😀😀 \x1c \x85 a\xa0b", "<|endoftext|>x<|startoftext|> < |", "a" * 500, "12345 \r\n\n  x"]
    out += ["".join(rng.choice("abcdehinost '!.,1é\n") for _ in range(300)) for _ in range(60)]
    out += ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x370, 0x600), rng.randrange(0x3040, 0x3100), 32])) for _ in range(80)) for _ in range(60)]
    return out + table("sf0.001", "documents").text.tolist()


def test_word_bpe_equals_the_library():
    own, lib = bpe.WordBpe(WORD), Tokenizer.from_file(WORD)
    for t in texts():
        want = lib.encode(t, add_special_tokens=False).ids
        got = own.encode(t)
        assert np.frombuffer(got, "<u4").tolist() == want
        assert own.decode(got) == lib.decode(want, skip_special_tokens=False)


def test_byte_encoder_equals_the_library():
    own, lib = records.ByteBpeEncoder(BYTE), Tokenizer.from_file(BYTE)
    for t in texts():
        assert np.frombuffer(own.encode(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids


def test_bpe_documents_edges(edge_docs, empty_docs):
    rows = bpe.bpe_documents(edge_docs, WORD, outputs=("n_tokens", "ids", "decoded", "ids_sha256")).collect()
    assert len(rows) == 10
    null = next(r for r in rows if r.doc_id == 2)
    assert (null.n_tokens, null.ids, null.decoded, null.ids_sha256) == (0, [], "", hashlib.sha256(b"").hexdigest())
    assert bpe.bpe_documents(empty_docs, WORD).count() == 0


def test_record_frames():
    data = [b"", b"x", bytes(range(256)) * 9]
    blob = b"".join(map(records.frame, data))
    import io
    stream = io.BytesIO(blob)
    assert [records.unframe(stream.read) for _ in range(4)] == [*data, None]
    for k in range(len(blob)):
        broken = io.BytesIO(blob[:k] + bytes([blob[k] ^ 1]) + blob[k + 1:])
        with pytest.raises(ValueError):
            while records.unframe(broken.read) is not None:
                pass
    with pytest.raises(ValueError):
        records.unframe(io.BytesIO(blob[16:-1]).read) and records.unframe(io.BytesIO(records.frame(b"abc")[:-1]).read)


def test_record_ids_keep_their_width():
    for ids in ([], [0, 65535], [1, 65536]):
        packed = records.pack_ids(np.array(ids, "<u4").tobytes(), bool(ids))
        assert len(packed) == 1 + len(ids) * (4 if 65536 in ids else 2)
        got, null = records.unpack_ids(packed)
        assert got.tolist() == ids and null is bool(ids)


def test_op1_against_the_library(spark):
    docs, lib = table("sf0.001", "documents").sort_values("doc_id"), Tokenizer.from_file(BYTE)
    got = {r.doc_id: r for r in queries.op1_token_records(spark, "/root/testdata/sf0.001").collect()}
    start = 0
    for ident, text in zip(docs.doc_id, docs.text, strict=True):
        ids = np.array(lib.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        r = got.pop(ident)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got


def test_records_edges_and_index(spark, edge_docs, empty_docs):
    folder = new_folder(spark, "records")
    manifest = records.write_records(edge_docs, folder, BYTE, 2, 3)
    rows = records.read_records(manifest, folder, 3).orderBy("start").collect()
    assert len(rows) == 10 and rows[0].doc_id is None and rows[0].start == 0
    assert [r.doc_id for r in rows[1:]] == [1, 1, 2, 3, 4, 5, 6, 7, 7]
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {1}
    files = {r.shard: r.file for r in manifest.collect()}
    for r in rows:  # the index points at every record
        store, base = records._store(folder)
        with store.open_input_stream(f"{base}/{files[r.shard][:-4]}.idx") as f:
            offsets = np.frombuffer(f.read(), "<u8")
        assert r.offset in offsets
        with store.open_input_file(f"{base}/{files[r.shard]}") as f:
            payload = records.read_record(f, r.offset)
        assert struct.unpack("<q", payload[:8])[0] == (r.doc_id or 0)
    assert records.write_records(empty_docs, new_folder(spark, "records"), BYTE, 2, 3).count() == 0


def test_op10_against_the_library(spark):
    lib, docs = Tokenizer.from_file(WORD), table("sf0.001", "documents").set_index("doc_id").text
    for r in queries.op10_bpe_automaton(spark, "/root/testdata/sf0.001").collect():
        ids = lib.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_new_words_go_to_the_library_end_to_end():
    """New words go to the library as a few long strings, not one a word, and the ids are still the library's."""
    own, lib, rng = records.ByteBpeEncoder(BYTE), Tokenizer.from_file(BYTE), random.Random(8)
    sent = []

    class Counting:
        def encode_batch_fast(self, words, **kw):
            sent.extend(words)
            return lib.encode_batch_fast(words, **kw)
    own.tokenizer = Counting()
    for alphabet in ("abcdefghij", "aé çÀ1! ,'", "ab \n\t\v"):
        text = " ".join("".join(rng.choices(alphabet, k=rng.randint(1, 12))) for _ in range(2000))
        assert np.frombuffer(own.encode(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids
        if alphabet == "abcdefghij":
            assert len(sent) <= 4


def test_a_full_memo_keeps_the_words_in_use(monkeypatch):
    own, lib = records.ByteBpeEncoder(BYTE), Tokenizer.from_file(BYTE)
    monkeypatch.setattr(records, "MEMO_WORDS", 50)
    for k in range(40):
        text = "The harbour log of day " + " ".join(f"w{c}" for c in "abcdefghijklmnop"[k % 7:]) + f" x{'y' * k}"
        assert np.frombuffer(own.encode(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids
        assert len(own.memo) + len(own.aged) <= 2 * (50 + 30)
