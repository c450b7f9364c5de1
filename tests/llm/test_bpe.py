import re
import struct
import hashlib

import public_tokenizers
import regex
import tiktoken
from conftest import SF001
from llm_cases import DOCS, ODD, with_clashes

from affinity.llm import bpe

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
ENC = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def expected(text):
    ids = ENC.encode_ordinary(text or "")
    bits = b"".join(struct.pack("<I", i) for i in ids)
    return len(ids), hashlib.sha256(bits).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_whole_table_matches_library(spark):
    d = spark.read.parquet(f"{SF001}/documents.parquet")
    text = {r.doc_id: r.text for r in d.collect()}
    got = bpe.encode_and_decode(d).collect()
    assert len(got) == len(text)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(text[r.doc_id])


def test_chunks_and_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate([
        None, "", " ", "a" * 3000, " " * 500 + "x", ("word  it's 12'LL\n\n" * 40), "日本 語½Ⅷ" * 200, "x !? " * 300,
        "\x1c\x1d a\x85b c " * 60, "é" * 700 + " " * 300 + "\r\n" * 90, "'s" * 400, "1 " * 500])]
    rows += [(3, "a" * 3000), (None, "no id " * 100)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(str((i, *expected(t))) for i, t in rows)
    for chunk, overlap in ((bpe.CHUNK, bpe.OVERLAP), (100, 20), (64, 40)):
        e = bpe.decode(bpe.encode(with_clashes(d), RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap), RANKS)
        assert sorted(str(tuple(r)) for r in bpe.digests(e).collect()) == want, chunk


def test_odd_rows(spark):
    d = spark.createDataFrame(ODD, DOCS)
    got = bpe.encode_and_decode(with_clashes(d)).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str((r[0], *expected(r[1]))) for r in ODD)
    assert bpe.encode_and_decode(d.limit(0)).count() == 0


def test_fast_pattern_is_the_public_one_on_its_characters():
    assert bpe._PUBLIC == public_tokenizers.PATTERN
    slow, fast = regex.compile(bpe._PUBLIC), re.compile(bpe._PLAIN)
    simple = [chr(i) for i in range(0x3000) if re.match(f"[{bpe._SIMPLE}]", chr(i))]
    assert len(simple) > 400
    for c in simple:
        for s in (c, f"a{c}b", f" {c}1", f"  {c}", f"{c}{c}.", f"'{c}", f"{c} {c}s 1", f"1{c}'re"):
            assert slow.findall(s) == fast.findall(s), repr(s)


def test_long_pieces_merge_alike():
    c = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    for piece in (b"abcabcabd" * 7, b"aaaaaaa" * 8, "éàü".encode() * 9, b"thethethat"):
        many = c.merge_many([piece])[0]
        assert b"".join(struct.pack("<I", i) for i in c._merge_heap(piece)) == many
        assert [x for x in struct.unpack(f"<{len(many) // 4}I", many)] == ENC._encode_single_piece(piece)


def test_decoded_column_replaces_one_of_its_name(spark):
    d = spark.createDataFrame([(1, b"\x00" * 4, "mine"), (2, None, "mine")], "doc_id long, ids binary, Bytes string")
    out = bpe.decode(d, RANKS)
    assert out.columns == ["doc_id", "ids", "bytes"]
    assert {r.doc_id: bytes(r.bytes) for r in out.collect()} == {1: ENC.decode_bytes([0]), 2: b""}
