"""Encoding, seekable files, flat files: exact round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.fs as pafs
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.llm import separators, token_files
from tallyloom.llm.encoding import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "B", "é", "²", "1", " ", "  ", "\n", ".", ",", "'s", "'", "_", "\t", "\xa0", "\0", "<|endoftext|>", "the", " of", "!", "\r\n", "中", "Ⅷ", "\x1c", "\x85"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("plain", [False, True])
def test_encoder_equals_the_library(library, plain):
    draw, enc = random.Random(3), Encoder(PATH, plain_specials=plain, cache_pieces=500)
    library.encode_special_tokens = plain
    for _ in range(600):
        texts = ["".join(draw.choices(PARTS, k=draw.randint(0, 25))) for _ in range(8)]
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == want
    library.encode_special_tokens = False


def test_new_words_are_encoded_together(library):
    """The library gets a few joined texts for many new words, and the ids are still each word's own."""
    draw, enc, sizes = random.Random(4), Encoder(PATH), []
    texts = [" ".join("".join(draw.choices("aeinorst\xe9,.\n'7", k=draw.randint(2, 9))).strip() or "x" for _ in range(500)) for _ in range(20)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    inner = enc._whole
    enc._whole = lambda batch: sizes.append(len(batch)) or inner(batch)
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == want
    assert sum(sizes) < 2000
    enc = Encoder(PATH)
    enc.spaced[:] = False  # as if other tokens held spaces: each piece by itself
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == want


def test_files_hold_every_document(spark, odd_docs, library):
    manifest = token_files.write_token_files(odd_docs, PATH)
    index = token_files.document_index(manifest)
    rows = sorted(token_files.read_documents(index).collect(), key=lambda r: r["start"])
    docs = odd_docs.select("doc_id", "text").collect()
    assert [r["doc_id"] for r in rows] == sorted((r["doc_id"] for r in docs), key=lambda x: (x is not None, x or 0))
    assert [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows[:-1])]).tolist()
    want = sorted((r["doc_id"] or -1, [*library.encode(r["text"] or "", add_special_tokens=False).ids, 0]) for r in docs)
    assert sorted((r["doc_id"] or -1, r["ids"]) for r in rows) == want
    digests = {r["start"]: r["ids_crc32"] for r in token_files.read_documents(index, digest_only=True).collect()}
    assert digests == {r["start"]: zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows}


def test_any_zstandard_reader_gets_the_ids(odd_docs):
    for m in token_files.write_token_files(odd_docs, PATH).collect():
        store, path = token_files.filesystem(m["file"])
        with store.open_input_file(path) as f:
            data = f.read()
        ids = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert len(ids) == 4 * m["n_ids"] and len(data) == m["n_bytes"]


def test_only_requested_documents_are_read(odd_docs):
    """Every other document's bytes may be damaged."""
    manifest = token_files.write_token_files(odd_docs, PATH)
    index = token_files.document_index(manifest)
    wanted = index.where("doc_id = 8").collect()[0]
    store, path = token_files.filesystem(wanted["file"])
    with store.open_input_file(path) as f:
        data = bytearray(f.read())
    own = range(wanted["offset"], wanted["offset"] + sum(wanted["sizes"]))
    tail = min(i for i in range(len(data)) if data[i : i + 4] == (0x184D2A5D).to_bytes(4, "little"))
    for i in range(tail):
        if i not in own:
            data[i] ^= 0xFF
    with store.open_output_stream(path, compression=None) as f:
        f.write(bytes(data))
    assert token_files.read_documents(index.where("doc_id = 8")).count() == 1
    data[own[0] + 9] ^= 0xFF
    with store.open_output_stream(path, compression=None) as f:
        f.write(bytes(data))
    with pytest.raises(Exception, match="checksum|ecompress"):
        token_files.read_documents(index.where("doc_id = 8")).collect()


def test_long_documents_have_several_frames(tmp_path):
    out = pafs.LocalFileSystem().open_output_stream(f"{tmp_path}/x.zst", compression=None)
    w = token_files.SeekableWriter(out, frame_ids=10)
    ids = np.arange(37, dtype="<u4").tobytes()
    w.add(5, ids)
    w.add(None, b"")
    w.finish()
    out.close()
    with pafs.LocalFileSystem().open_input_file(f"{tmp_path}/x.zst") as f:
        x = token_files.read_index(f, w.n_bytes)
        f.seek(0)
        data = f.read()
    assert x.n_frames.tolist() == [4, 1] and x.nulls.tolist() == [False, True]
    sizes, sums = x.frames[:4, 0].tolist(), x.frames[:4, 2].tolist()
    assert token_files._frames(data[: sum(sizes)], sizes, sums) == ids
    with pytest.raises(ValueError, match="checksum"):
        token_files._frames(data[: sum(sizes)], sizes, [*sums[:-1], sums[-1] ^ 1])


def test_no_documents(no_docs):
    manifest = token_files.write_token_files(no_docs, PATH)
    assert manifest.isEmpty() and token_files.read_documents(token_files.document_index(manifest)).isEmpty()
    names = separators.write_flat_files(no_docs, PATH, 50256)
    assert separators.document_lengths(separators.scan_blocks(names.where("ordinal = -1"), 50256)).isEmpty()


def test_flat_files_give_token_counts(odd_docs, library):
    names = separators.write_flat_files(odd_docs, PATH, 50256)
    library.encode_special_tokens = True
    for block in (1 << 22, 1000, 7):
        if block == 7:
            names = separators.write_flat_files(odd_docs.where(F.length("text") < 300), PATH, 50256)
        found = separators.scan_blocks(names.where("ordinal = -1"), 50256, block_ids=block)
        got = separators.document_lengths(found).join(names.where("ordinal >= 0").select("part", "ordinal", "doc_id"), ["part", "ordinal"], "full").collect()
        docs = [r for r in odd_docs.select("doc_id", "text").collect() if block != 7 or r["text"] is not None and len(r["text"]) < 300]
        want = sorted((r["doc_id"] or -1, len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs)
        assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in got) == want
        assert all(r["complete"] for r in got)


@pytest.mark.parametrize("block", [1, 2, 3, 5, 100])
def test_documents_across_blocks_and_open_ends(spark, tmp_path, block):
    draw, rows, want = random.Random(block), [], []
    for part in range(6):
        ids = [draw.choice([9, 1, 2, 3, 4]) for _ in range(draw.randint(0, 40))]
        (tmp_path / f"{part}").write_bytes(np.array(ids, "<u2").tobytes())
        rows.append((part, str(tmp_path / f"{part}"), 2 * len(ids)))
        start = ordinal = 0
        for i, x in enumerate(ids):
            if x == 9:
                want.append((part, ordinal, start, i - start, True))
                start, ordinal = i + 1, ordinal + 1
        if start < len(ids):
            want.append((part, ordinal, start, len(ids) - start, False))
    files = spark.createDataFrame(rows, "part int, file string, n_bytes long")
    got = separators.document_lengths(separators.scan_blocks(files, 9, block_ids=block)).collect()
    assert sorted(map(tuple, got)) == want
