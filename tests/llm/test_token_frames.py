"""Token files against the tokenizer library, and their format against a plain decoder."""

import glob
import zlib

import numpy as np
import pytest
import zstandard

from modelferry.llm import token_frames as T
from modelferry.llm.common import prepare
from modelferry.session import scratch_path

TEXTS = [
    None, "", "a", "Hello, wörld!  <|endoftext|> x", "日本語" * 50, " \n\t ", "x" * 3000, "the cat " * 2000, "the cat " * 2000, "12345 67890",
    "a\n\nb\n", " x　 y  z ", "a  b   c \x1c d\x85e", "it's  we'll ' s", " ​ ᠎ q", "a\r\n b",
]


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_millions_of_blanks(tokenizer):
    text = "a" + " " * 2_000_000 + "b"
    assert T.id_maker()(text) == tokenizer.encode(text, add_special_tokens=False).ids


def packed(*numbers):
    return np.array(numbers, "<u4").tobytes()


def plain(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, T.END_ID]


def test_ranks_give_the_ids_of_the_tokenizer_file(tokenizer):
    """Every character that any definition takes for white space, and others that words are cut at."""
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace() or c in (0x85, 0x180E, 0x200B, 0x2060, 0xFEFF)]
    texts = [t for t in TEXTS if t] + [" " * 5000 + "a", "\n" * 3001, "é" * 2000]
    for a in spaces:
        texts += [f"a{a}b", f"a{a}{a}b", f"a {a}b", f"a{a} b {a}", f"{a}'s {a}1{a}", *(f"x{a}{b}y" for b in spaces)]
    for c in map(chr, [*range(0x21, 0x250), 0x2160, 0xB2, 0x660, 0x3B1, 0x1F600]):
        texts += [f"a{c}1{c}.{c}", f" {c}{c}b 7{c}", f"it's{c} don't've'll'{c}d'S", f"{c}'re{c} 'm9"]
    encode = T.id_maker()
    for text in texts:
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids, ascii(text[:50])


@pytest.fixture(scope="module")
def files(spark, tokenizer):
    """Small files: one row in three has the same id and text; long documents, null ids, clashing columns."""
    prepare(spark)
    rows = [(i, t, "x", i) for i, t in enumerate(TEXTS)] + [(None, "no id", "x", 1), (None, "no id", "x", 1)]
    rows += [(7, "the same text", "y", 2)] * 9 + [(100 + i, f"document {i} " * (i * 40), None, None) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, size long")
    path = scratch_path(spark, "small-files")
    T.write_frames(docs.repartition(5), path, file_bytes=150)
    return rows, path


def test_all_documents_come_back_in_order(spark, tokenizer, files):
    rows, path = files
    got = T.read_all(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    made = sorted((repr(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in got)
    assert made == sorted((repr(i), plain(tokenizer, t)) for i, t, _, _ in rows)
    assert len(glob.glob(f"{path}/files/*.zst".removeprefix("file:"))) > 5


def test_files_are_plain_zstandard_with_a_seek_table(spark, tokenizer, files):
    _, path = files
    of_files = sorted(glob.glob(f"{path}/files/*.zst".removeprefix("file:")))
    whole = b""
    for name in of_files:
        data = open(name, "rb").read()
        n, flags, magic = T.FOOTER.unpack(data[-9:])
        assert (flags, magic) == (0x80, 0x8F92EAB1)
        assert T.HEADER.unpack(data[-9 - 12 * n - 8:][:8]) == (0x184D2A5E, 12 * n + 9)
        with open(name, "rb") as file:
            whole += zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
    rows = T.read_all(spark, path).orderBy("start").collect()
    assert whole == b"".join(bytes(r.ids) for r in rows)


def test_only_requested_documents_are_opened(spark, tokenizer, files):
    rows, path = files
    wanted = spark.createDataFrame([(7,), (3,), (129,), (129,), (55_555,)], "doc_id long")
    got = T.read_documents(spark, path, wanted).collect()
    of_all = {(r.doc_id, r.start): bytes(r.ids) for r in T.read_all(spark, path).collect()}
    assert sorted(r.doc_id for r in got) == [3] + [7] * 10 + [129]
    assert all(of_all[r.doc_id, r.start] == bytes(r.ids) for r in got)
    import pyarrow.fs as fs

    name = glob.glob(f"{path}/files/*.zst".removeprefix("file:"))[0]
    reader = T.FrameReader(fs.LocalFileSystem().open_input_file(name))
    reader.ids(0)
    assert reader.opened == reader.documents["n_frames"][0]


def test_long_documents_have_several_frames_and_damage_is_seen(tmp_path):
    ids = packed(*range(100_000))
    data, entries = T.frames(ids, frame_bytes=64 << 10)
    with open(tmp_path / "a", "wb") as out:
        writer = T.FrameWriter(out)
        writer.add(1, 3, *T.frames(packed(0, 1, 2)))
        writer.add(2, len(ids) // 4, data, entries)
        writer.close()
    import pyarrow.fs as fs

    def reader():
        return T.FrameReader(fs.LocalFileSystem().open_input_file(str(tmp_path / "a")))

    assert reader().documents["n_frames"].tolist() == [1, 7]
    assert reader().ids(1) == ids
    whole = bytearray((tmp_path / "a").read_bytes())
    whole[len(whole) // 2] ^= 1
    (tmp_path / "a").write_bytes(bytes(whole))
    assert reader().ids(0) == packed(0, 1, 2)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        reader().ids(1)


def test_empty_table(spark):
    prepare(spark)
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert T.round_trip(docs).count() == 0


def test_query_columns(spark, tokenizer):
    from modelferry.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    start, expected = 0, []
    for d in docs:
        ids = plain(tokenizer, d.text)
        expected.append((d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = queries.op11_token_frames(spark, sf)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == expected
