"""Audio containers built byte by byte, in tables, in files and beside decoded audio."""

import struct

import pytest
from pyspark.sql import functions as F

from voxloom.functions import audio as A
from voxloom.functions import containers as N
from voxloom.operators import evaluation as E
from voxloom.operators.inference import transcribe
from voxloom.plans import evaluate
from voxloom.sources import corpus as S


def chunk(tag, body, order="<"):
    return tag + struct.pack(f"{order}I", len(body)) + body + b"\0" * (len(body) % 2)


def riff(*chunks, tag=b"RIFF"):
    return tag + struct.pack("<I", 4) + b"WAVE" + b"".join(chunks)


def fmt(kind, channels, rate, block, bits, extra=b""):
    return chunk(b"fmt ", struct.pack("<HHIIHH", kind, channels, rate, rate * block, block, bits) + extra)


def flac(samples, frames=b"", rate=44100, channels=2, least=4096):
    packed = rate << 44 | (channels - 1) << 41 | 15 << 36 | samples
    return b"fLaC\0\0\0\x22" + struct.pack(">HH", least, least) + b"\0" * 6 + packed.to_bytes(8, "big") + b"\0" * 16 + frames


def flac_frame(number, code, extra=b"", variable=False):
    """A frame's header with its checksum and a payload that looks like another sync code."""
    head = b"\xff" + (b"\xf9" if variable else b"\xf8") + bytes([code << 4 | 9, 0x18]) + chr(number).encode() + extra
    return head + bytes([N._crc8(head)]) + b"\xff\xf8\xff\xff\0\0\0\0\0" * 9


def page(payload, granule=0, serial=7):
    sizes = bytes([255] * (len(payload) // 255) + [len(payload) % 255])
    return b"OggS\0\0" + struct.pack("<qIIIB", granule, serial, 0, 0, len(sizes)) + sizes + payload


def vorbis(channels=1, rate=8000):
    return page(b"\x01vorbis" + struct.pack("<IBI", 0, channels, rate) + b"\0" * 14)


def mpeg(header, count, padded=False):
    word = int.from_bytes(header, "big")
    return b"".join((word | (1 << 9 if padded and k % 2 else 0)).to_bytes(4, "big") + b"\0" * (413 + (padded and k % 2)) for k in range(count))


def id3(data, size=300_000):
    return b"ID3\4\0\0" + bytes([size >> 21 & 127, size >> 14 & 127, size >> 7 & 127, size & 127]) + b"t" * size + data


def xing(frames, header=b"\xff\xfb\x90\xc4", side=17, encoder=b""):
    flags, fields = (1, b"") if not encoder else (15, b"\0" * 108)
    tag = struct.pack(">4sII", b"Info", flags, frames) + fields + encoder
    return header + b"\0" * side + tag + b"\0" * 600


FULL = b"LAME3.100" + b"\0" * 12 + (576 << 12 | 1000).to_bytes(3, "big")
RATE_80 = struct.pack(">HQ", 16383 + 15, 44100 << 48)
OTHER = struct.pack("<HHIH", 22, 32, 3, 3) + b"\0" * 14
ADPCM = struct.pack("<HH", 2, 505)
#: Over a minute of tags before the samples, beyond the head.
LONG = chunk(b"LIST", b"x" * 100_000)

CASES = {
    "float": (riff(fmt(3, 2, 48000, 8, 32), chunk(b"data", b"\0" * 80)), (48000, 2, 10)),
    "extensible": (riff(fmt(0xFFFE, 2, 48000, 8, 32, OTHER), chunk(b"data", b"\0" * 80)), (48000, 2, 10)),
    "mu-law": (riff(fmt(7, 1, 8000, 1, 8), chunk(b"data", b"\0" * 81)), (8000, 1, 81)),
    "ima": (riff(fmt(0x11, 1, 8000, 256, 4, ADPCM), chunk(b"fact", struct.pack("<I", 600)), chunk(b"data", b"\0" * 512)), (8000, 1, 600)),
    "ima without fact": (riff(fmt(0x11, 1, 8000, 256, 4, ADPCM), chunk(b"data", b"\0" * 300)), (8000, 1, 1010)),
    "unknown tag": (riff(fmt(0x161, 1, 8000, 256, 0), chunk(b"data", b"\0" * 300)), None),
    "far data": (riff(fmt(1, 1, 8000, 2, 16), LONG, chunk(b"data", b"\0" * 300)), (8000, 1, 150)),
    "far format": (riff(LONG, fmt(1, 1, 8000, 2, 16), chunk(b"data", b"\0" * 300)), (8000, 1, 150)),
    "rf64": (riff(chunk(b"ds64", struct.pack("<QQQI", 0, 400, 0, 0)), fmt(1, 1, 8000, 2, 16), b"data" + b"\xff" * 4 + b"\0" * 500, tag=b"RF64"), (8000, 1, 200)),
    "no data": (riff(fmt(1, 1, 8000, 2, 16)), None),
    "flac": (flac(123_456_789_012 % 2**36), (44100, 2, 123_456_789_012 % 2**36)),
    "flac with a tag": (id3(flac(5)), (44100, 2, 5)),
    "streamed flac": (flac(0, b"".join(flac_frame(k, 12) for k in range(200)) + flac_frame(200, 6, b"\x63")), (44100, 2, 200 * 4096 + 100)),
    "variable flac": (flac(0, flac_frame(0, 12, variable=True) + flac_frame(4096, 7, b"\x01\x00", variable=True)), (44100, 2, 4096 + 257)),
    "empty flac": (flac(0), None),
    "vorbis": (vorbis() + page(b"x" * 60_000, 9000) + page(b"x" * 60_000, 16001) + page(b"", -1), (8000, 1, 16001)),
    "two streams": (vorbis() + page(b"x", 500) + page(b"x", 900, serial=8), (8000, 1, 500)),
    "opus": (page(b"OpusHead\1\2" + struct.pack("<HI", 312, 16000) + b"\0\0\0") + page(b"x" * 60_000) * 4 + page(b"x", 48312), (48000, 2, 48000)),
    "flac in ogg": (page(b"\x7fFLAC\1\0\0\1" + flac(777)) + page(b"x", 700), (44100, 2, 777)),
    "other in ogg": (page(b"Speex   ") + page(b"x", 700), None),
    "mp3 by frames": (mpeg(b"\xff\xfb\x90\xc4", 40, True) + b"TAG" + b"\0" * 125, (44100, 1, 40 * 1152)),
    "mp3 with a tag": (id3(mpeg(b"\xff\xfb\x90\x04", 40, True)), (44100, 2, 40 * 1152)),
    "counted mp3": (xing(50), (44100, 1, 50 * 1152)),
    "counted stereo": (xing(50, b"\xff\xfb\x90\x04", 32, FULL), (44100, 2, 50 * 1152 - 1576)),
    "mpeg 2": (xing(50, b"\xff\xf3\x90\xc4", 9), (22050, 1, 50 * 576)),
    "vbri": (b"\xff\xfb\x90\x04" + b"\0" * 32 + b"VBRI" + b"\0" * 10 + struct.pack(">I", 9) + b"\0" * 100, (44100, 2, 9 * 1152)),
    "free mp3": (b"\xff\xfb\x00\xc4" + b"\0" * 100, None),
    "aiff": (b"FORM\0\0\0\0AIFF" + chunk(b"NAME", b"abc", ">") + chunk(b"COMM", struct.pack(">HIH", 2, 99, 16) + RATE_80, ">"), (44100, 2, 99)),
    "au": (struct.pack(">4sIIIII", b".snd", 28, 40, 3, 8000, 2) + b"note" + b"\0" * 40, (8000, 2, 10)),
    "open au": (struct.pack(">4sIIIII", b".snd", 24, 2**32 - 1, 1, 8000, 1) + b"\0" * 33, (8000, 1, 33)),
    "odd au": (struct.pack(">4sIIIII", b".snd", 24, 40, 23, 8000, 1) + b"\0" * 40, None),
    "text": (b"just words", None),
    "empty": (b"", None),
    "null": (None, None),
    "only a tag": (id3(b"", 10), None),
    "cut tag": (b"ID3\4", None),
    "cut flac": (flac(9)[:20], None),
    "cut ogg": (b"OggS\0\0", None),
}


def metadata(rows):
    found = {r.name: tuple(r.wav) if r.wav else (None,) * 3 for r in rows}
    return {n: w if w and None not in w else None for n, w in found.items()}


def test_bytes_in_a_table(spark):
    df = spark.createDataFrame([(n, bytearray(d) if d is not None else None) for n, (d, _) in CASES.items()], "name string, content binary")
    assert metadata(A.with_audio_metadata(df, F.col("content")).collect()) == {n: w for n, (_, w) in CASES.items()}


def test_ranges_of_files(spark, tmp_path):
    for n, (data, _) in CASES.items():
        if data is not None:
            (tmp_path / n).write_bytes(data)
    df = spark.createDataFrame([(n, None if n == "null" else str(tmp_path / n)) for n in [*CASES, "missing"]], "name string, path string")
    got = metadata(A.with_file_metadata(df, F.col("path"), S.open_files).collect())
    assert got == {n: w for n, (_, w) in CASES.items()} | {"missing": None}


def test_samples_row_by_row(spark, tmp_path):
    flacs = flac(8)
    (tmp_path / "a.flac").write_bytes(flacs)
    rows = [
        (1, (bytearray(flac(4)), "a.flac", [0.0], 1, 1)),
        (2, (None, "a.flac", [0.0], 1, 1)),
        (3, (bytearray(), f"{tmp_path}/a.flac", None, None, None)),
        (4, (None, " ", [0.0, 1.0, 2.0], None, 16000)),
        (5, (None, None, [0.0, 1.0], 8000, 16000)),
        (6, (None, "none.wav", [0.0], 1, 1)),
        (7, None),
    ]
    kind = "id int, audio struct<bytes: binary, path: string, array: array<double>, sampling_rate: int, sample_rate: int>"
    df = spark.createDataFrame(rows, kind)
    known = lambda w: tuple(w) if w and w.n_samples is not None else None
    got = {r.id: known(r.wav) for r in evaluate.with_sample_metadata(df, str(tmp_path)).collect()}
    want = {1: (44100, 2, 4), 2: (44100, 2, 8), 3: (44100, 2, 8), 4: (16000, 1, 3), 5: (8000, 1, 2), 6: None, 7: None}
    assert got == want
    unread = {r.id: known(r.wav) for r in evaluate.with_sample_metadata(df).collect()}
    assert unread == want | {2: None, 3: None}


@pytest.mark.parametrize("data", [b"\xff" * 200, flac(0) + b"\xff\xf8" * 300, riff(b"data"), b"FORM\0\0\0\0AIFCCOMM\0\0\0\2"])
def test_walkers_take_any_bytes(data):
    for walk in N.WALKERS.values():
        for end in range(0, len(data), 7):
            walk(data[:end], len(data))


WALKED = {
    "short": riff(chunk(b"LIST", b"abc"), fmt(1, 2, 16000, 4, 16), chunk(b"data", b"x" * 400)),
    "in the head": riff(chunk(b"LIST", b"abc"), fmt(1, 2, 16000, 4, 16), chunk(b"data", b"x" * 400_000)),
    "behind the head": riff(chunk(b"LIST", b"data" * 20_000), fmt(1, 1, 8000, 2, 16), chunk(b"data", b"x" * 300)),
    "at the head's end": riff(chunk(b"LIST", b"a" * (N.HEAD_BYTES - 50)), fmt(1, 1, 8000, 2, 16), chunk(b"data", b"x" * 300)),
    "many chunks": riff(*[chunk(b"junk", b"z")] * 300, fmt(1, 1, 8000, 1, 8), chunk(b"data", b"x" * 70_000)),
    "no format": riff(chunk(b"LIST", b"abc"), chunk(b"data", b"x" * 70_000)),
    "no end": riff(chunk(b"LIST", b"abc"), fmt(1, 1, 8000, 1, 8), b"LIST\xff\xff\xff\xff", b"x" * 70_000),
    "aiff": b"FORM\0\0\0\4AIFF" + chunk(b"NAME", b"n" * 99, ">") + chunk(b"COMM", struct.pack(">HIHHQ", 1, 40_000, 16, 0x400C, 0xFA << 56), ">") + chunk(b"SSND", b"x" * 80_000, ">"),
}


def test_walk_in_one_worker(spark):
    read = A.with_audio_metadata(spark.createDataFrame(list(WALKED.items()), "name string, data binary"), F.col("data"))
    assert read._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython ") == 1
    got = {r.name: r.wav and tuple(r.wav) for r in read.select("name", "wav").collect()}
    assert got == {name: N.walk_chunks(data, len(data)) or (None, None, None) for name, data in WALKED.items()}
    assert got["behind the head"] == (8000, 1, 150) and got["aiff"] == (16000, 1, 40_000)


def test_head_in_which_a_walk_ends(spark):
    rows = spark.createDataFrame([(name, data[: N.HEAD_BYTES]) for name, data in WALKED.items()], "name string, head binary")
    ends = N.walk_ends_in(F.col("head"), N.tag_at(F.col("head"), 0, b"FORM"))
    assert {r.name for r in rows.where(ends).collect()} == {"short", "in the head", "no format", "aiff"}


def test_counts_need_no_python_workers(spark):
    class Seen:
        get = {"ok": 3, "too_long": 0, "decode_failed": 2}

    counts = E.counted_statuses(spark, Seen)
    assert "ExistingRDD" not in counts._jdf.queryExecution().executedPlan().toString()
    assert counts.dtypes == [("status", "string"), ("samples", "bigint")]
    assert [tuple(r) for r in counts.collect()] == [("ok", 3), ("decode_failed", 2)]
    Seen.get = {"ok": 0}
    assert E.counted_statuses(spark, Seen).collect() == []


def test_samples_take_one_worker(spark):
    samples = spark.createDataFrame([(1, (WALKED["short"], None))], "id int, audio struct<bytes: binary, path: string>")
    heard = transcribe(evaluate.with_sample_metadata(samples), lambda: lambda batch, _: ["x"] * len(batch), "audio")
    plan = heard._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("ArrowEvalPython "), plan.count("MapInPandas ")) == (1, 1)
    assert [(r.wav.n_samples, r.prediction) for r in heard.collect()] == [(100, "x")]
