"""Archives that are cut off, corrupted or come with a wrong dictionary are errors, never shorter results."""

import io
import struct

import numpy as np
import pytest
import zstandard

from millrace.llm import warc

RECORDS = [f"record {k} ".encode() * 50 for k in range(5)]


def archive(dictionary=b""):
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    pack = zstandard.ZstdCompressor(level=3, dict_data=shared, write_checksum=True)
    head = struct.pack("<II", warc.DICTIONARY_FRAME, len(dictionary)) + dictionary if dictionary else b""
    return head + b"".join(pack.compress(r) for r in RECORDS)


@pytest.fixture(scope="module")
def dictionary():
    rng = np.random.default_rng(0)
    words = [f"word{k}" for k in range(300)]
    return zstandard.train_dictionary(4096, [" ".join(rng.choice(words, 200)).encode() for _ in range(300)]).as_bytes()


def test_whole_archives(dictionary):
    for raw in (archive(), archive(dictionary)):
        assert list(warc.frames(io.BytesIO(raw), piece=7)) == RECORDS
    assert list(warc.frames(io.BytesIO(b""))) == []


@pytest.mark.parametrize("lost", [1, 5, 20])
def test_cut_off_frames(dictionary, lost):
    for raw in (archive()[:-lost], archive(dictionary)[:-lost]):
        with pytest.raises(warc.BadRecord):
            list(warc.frames(io.BytesIO(raw)))
    with pytest.raises(warc.BadRecord):
        list(warc.frames(io.BytesIO(archive(dictionary)[: 8 + len(dictionary) - lost])))


def test_corrupted_frames(dictionary):
    for raw in (archive(), archive(dictionary)):
        broken = bytearray(raw)
        broken[-10] ^= 0xFF
        with pytest.raises((warc.BadRecord, zstandard.ZstdError)):
            list(warc.frames(io.BytesIO(bytes(broken))))


def test_wrong_dictionary(dictionary):
    rng = np.random.default_rng(1)
    other = zstandard.train_dictionary(4096, [" ".join(rng.choice([f"other{k}" for k in range(300)], 200)).encode() for _ in range(300)]).as_bytes()
    raw = archive(dictionary)
    swapped = struct.pack("<II", warc.DICTIONARY_FRAME, len(other)) + other + raw[8 + len(dictionary):]
    with pytest.raises((warc.BadRecord, zstandard.ZstdError)):
        list(warc.frames(io.BytesIO(swapped)))
    with pytest.raises((warc.BadRecord, zstandard.ZstdError)):
        list(warc.frames(io.BytesIO(raw[8 + len(dictionary):])))
