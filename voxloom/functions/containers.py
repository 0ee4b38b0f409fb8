"""Rate, channels and samples of audio containers, read from bounded ranges of a file.

A file is known by its ``head``, its ``tail`` and its ``size``, all without a leading
ID3 tag. What lies at known places is read by expressions: FLAC's stream info, the first
and last page of Ogg, Xing, Info and VBRI frames of MP3, AU headers. Chunks in any order
(WAV, RF64, AIFF) are walked in Python over the head, and files that carry no count of
their own (MP3 without such a frame, FLAC written as a stream) frame by frame.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

HEAD_BYTES = 64 * 1024
#: An Ogg page has less than half as many.
TAIL_BYTES = 128 * 1024
METADATA = "sample_rate long, channels long, n_samples long"

# Fixed values of the formats.
#: Samples a second of MPEG 1; MPEG 2 has half of it and 2.5 a quarter.
MPEG_RATES = [44100, 48000, 32000]
#: Thousand bits a second by layer: MPEG 1 layers I, II, III, then MPEG 2 layer I, and II with III.
MPEG_KBITS = [
    [0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448],
    [0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384],
    [0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320],
    [0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256],
    [0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160],
]
#: Bytes of a sample by AU encoding: mu-law, linear of 8 to 32 bits, float, double, A-law.
AU_BYTES = {1: 1, 2: 1, 3: 2, 4: 3, 5: 4, 6: 4, 7: 8, 27: 1}
#: WAV format tags whose blocks hold one sample of each channel: PCM, float, A-law, mu-law.
WAV_FRAMES = (1, 3, 6, 7)
#: Tags whose blocks hold as many samples as the format chunk says: MS ADPCM, IMA ADPCM, GSM 6.10.
WAV_BLOCKS = (2, 0x11, 0x31)
WAV_EXTENSIBLE = 0xFFFE
FLAC_BLOCKS = {1: 192, **{k: 576 << (k - 2) for k in range(2, 6)}, **{k: 256 << (k - 8) for k in range(8, 16)}}


def number(data: Column, at: Column | int, size: int, little: bool = False) -> Column:
    """The unsigned integer of ``size`` bytes at the 0-based byte ``at``; null beyond the end."""
    digits = F.hex(F.substring(data, (at if isinstance(at, Column) else F.lit(at)) + 1, F.lit(size)))
    if little:
        digits = F.concat(*[F.substring(digits, 2 * i + 1, 2) for i in range(size - 1, -1, -1)])
    return F.when(F.length(digits) == 2 * size, F.conv(digits, 16, 10).try_cast("bigint"))


def tag_at(data: Column, at: Column | int, tag: bytes) -> Column:
    at = at if isinstance(at, Column) else F.lit(at)
    return F.coalesce(F.substring(data, at + 1, F.lit(len(tag))) == F.lit(tag), F.lit(False))


def id3_bytes(data: Column) -> Column:
    """Length of the ID3 tag that a file begins with, 0 without one."""
    size = sum((number(data, 6 + i, 1).bitwiseAND(127) * (1 << (7 * (3 - i))) for i in range(4)), F.lit(0))
    footer = F.when(number(data, 5, 1).bitwiseAND(16) > 0, 10).otherwise(0)
    return F.when(tag_at(data, 0, b"ID3"), F.coalesce(size + 10 + footer, F.lit(0))).otherwise(0).cast("int")


def container(head: Column) -> Column:
    """'wav', 'aiff', 'flac', 'ogg', 'au' or 'mp3' by the first bytes, else null."""
    wave = tag_at(head, 8, b"WAVE") & (tag_at(head, 0, b"RIFF") | tag_at(head, 0, b"RF64") | tag_at(head, 0, b"BW64"))
    aiff = tag_at(head, 0, b"FORM") & (tag_at(head, 8, b"AIFF") | tag_at(head, 8, b"AIFC"))
    return (
        F.when(wave, "wav").when(aiff, "aiff").when(tag_at(head, 0, b"fLaC"), "flac")
        .when(tag_at(head, 0, b"OggS"), "ogg").when(tag_at(head, 0, b".snd"), "au")
        .when(_Mpeg(head).valid, "mp3")
    )


def _found(rate: Column, channels: Column, samples: Column) -> Column:
    return F.struct(
        rate.cast("long").alias("sample_rate"), channels.cast("long").alias("channels"),
        samples.cast("long").alias("n_samples"),
    )


def _stream_info(data: Column, at: Column | int) -> Column:
    """FLAC's: 20 bits of rate, 3 of channels, 5 of sample size, 36 of samples; 0 samples are unknown."""
    at = at if isinstance(at, Column) else F.lit(at)
    packed = F.hex(F.substring(data, at + 11, F.lit(8)))
    field = lambda start, size: F.conv(F.substring(packed, start, size), 16, 10).try_cast("bigint")
    samples = field(8, 9)
    channels = F.shiftright(field(6, 1), 1) + 1
    return F.when(F.length(packed) == 16, _found(field(1, 5), channels, F.when(samples > 0, samples)))


def _ogg(head: Column, tail: Column) -> Column:
    """Vorbis, Opus and FLAC in Ogg: what the first packet says, and the last page's position."""
    at = number(head, 26, 1) + 27
    serial = F.substring(head, 15, 4)
    # One character a byte, so that pages are found as text.
    pages = F.split(F.decode(tail, "ISO-8859-1"), r"OggS\x00")
    mine = F.transform(F.slice(pages, F.lit(2), F.greatest(F.size(pages) - 1, F.lit(0))), lambda p: F.encode(p, "ISO-8859-1"))
    none = F.lit(b"\xff" * 8)
    mine = F.filter(mine, lambda p: (F.substring(p, 10, 4) == serial) & (F.substring(p, 2, 8) != none))
    end = number(F.try_element_at(mine, F.lit(-1)), 1, 8, little=True)
    vorbis = _found(number(head, at + 12, 4, True), number(head, at + 11, 1), end)
    opus = _found(F.lit(48000), number(head, at + 9, 1), F.greatest(end - number(head, at + 10, 2, True), F.lit(0)))
    info = _stream_info(head, at + 17)
    flac = _found(info["sample_rate"], info["channels"], F.coalesce(info["n_samples"], end))
    return (
        F.when(tag_at(head, at, b"\x01vorbis"), vorbis).when(tag_at(head, at, b"OpusHead"), opus)
        .when(tag_at(head, at, b"\x7fFLAC"), flac)
    )


def _au(head: Column, size: Column) -> Column:
    start, claimed, encoding, channels = (number(head, at, 4) for at in (4, 8, 12, 20))
    known = F.create_map(*[F.lit(x) for item in AU_BYTES.items() for x in item])
    room = size - start
    payload = F.when(claimed == 0xFFFFFFFF, room).otherwise(F.least(claimed, room))
    block = F.try_element_at(known, encoding.cast("int")) * channels
    samples = F.when(block > 0, F.floor(F.try_divide(F.greatest(payload, F.lit(0)), block)))
    return _found(number(head, 16, 4), channels, samples)


class _Mpeg:
    """Fields of the MPEG audio frame at the beginning of ``head``."""

    def __init__(self, head: Column):
        word = F.coalesce(number(head, 0, 4), F.lit(0))
        bits = lambda shift, mask: F.shiftright(word, shift).bitwiseAND(mask)
        self.version, self.layer = bits(19, 3), bits(17, 3)
        rate = bits(10, 3)
        self.valid = (
            (bits(21, 2047) == 2047) & (self.version != 1) & (self.layer != 0) & (rate != 3)
            & ~bits(12, 15).isin(0, 15)
        )
        self.first = self.version == 3
        self.channels = F.when(bits(6, 3) == 3, 1).otherwise(2)
        rates = F.array(*map(F.lit, MPEG_RATES))
        parts = F.when(self.first, 1).when(self.version == 2, 2).otherwise(4)
        self.rate = F.get(rates, rate.cast("int")) / parts
        self.samples = F.when(self.layer == 3, 384).when((self.layer == 1) & ~self.first, 576).otherwise(1152)


def _mp3(head: Column) -> Column:
    """From the frame that names the number of frames, less the encoder's delay and padding."""
    frame = _Mpeg(head)
    one = frame.channels == 1
    at = F.when(frame.first, F.when(one, 21).otherwise(36)).otherwise(F.when(one, 13).otherwise(21))
    flags = F.coalesce(number(head, at + 4, 4), F.lit(0))
    has = lambda k: flags.bitwiseAND(1 << k) > 0
    frames = F.when(has(0), number(head, at + 8, 4))
    encoder = at + 8 + sum((F.when(has(k), n).otherwise(0) for k, n in enumerate((4, 4, 100, 4))), F.lit(0))
    known = tag_at(head, encoder, b"LAME") | tag_at(head, encoder, b"Lavc") | tag_at(head, encoder, b"Lavf")
    both = number(head, encoder + 21, 3)
    cut = F.when(known, F.coalesce(F.shiftright(both, 12) + both.bitwiseAND(4095), F.lit(0))).otherwise(0)
    xing = F.greatest(frames * frame.samples - cut, F.lit(0))
    vbri = number(head, 36 + 14, 4) * frame.samples
    samples = F.when(tag_at(head, at, b"Xing") | tag_at(head, at, b"Info"), xing).when(tag_at(head, 36, b"VBRI"), vbri)
    return F.when(samples.isNotNull(), _found(frame.rate, frame.channels, samples))


def fixed_metadata(kind: Column, head: Column, tail: Column, size: Column) -> Column:
    """What expressions can read, else null."""
    info = _stream_info(head, 8)
    flac = F.when(number(head, 4, 1).bitwiseAND(127) == 0, F.when(info["n_samples"].isNotNull(), info))
    return F.when(kind == "flac", flac).when(kind == "ogg", _ogg(head, tail)).when(kind == "au", _au(head, size)).when(
        kind == "mp3", _mp3(head)
    )


def walk_chunks(data: bytes, size: int) -> tuple[int, int, int] | None:
    """WAV, RF64 and AIFF with chunks in any order; ``data`` may be the head of ``size`` bytes.

    A WAV of blocks has the samples of its fact chunk, or as many as its blocks hold.
    """
    order = ">" if data[:4] == b"FORM" else "<"
    at, form, long_size, fact = 12, None, None, None
    while at + 8 <= len(data):
        tag, length = data[at : at + 4], struct.unpack_from(f"{order}I", data, at + 4)[0]
        body = at + 8
        if tag == b"COMM" and body + 18 <= len(data):
            channels, samples, _, exponent, mantissa = struct.unpack_from(">HIHHQ", data, body)
            return int(mantissa * 2.0 ** (exponent - 16446)), channels, samples
        if tag == b"ds64" and body + 24 <= len(data):
            long_size, fact = struct.unpack_from("<QQ", data, body + 8)
        elif tag == b"fact" and body + 4 <= len(data):
            count = struct.unpack_from("<I", data, body)[0]
            fact = fact if count == 0xFFFFFFFF else count
        elif tag == b"fmt " and body + 16 <= len(data):
            form = struct.unpack_from("<HHIIHH", data, body)
            kind = form[0]
            if kind == WAV_EXTENSIBLE and length >= 40 and body + 26 <= len(data):
                kind = struct.unpack_from("<H", data, body + 24)[0]
            held = struct.unpack_from("<H", data, body + 18)[0] if length >= 20 and body + 20 <= len(data) else 0
            form = (kind, *form[1:], held)
        elif tag == b"data":
            if long_size is not None and length == 0xFFFFFFFF:
                length = long_size
            return _wav_samples(form, min(length, size - body), fact)
        at = body + length + length % 2
    return None


def _wav_samples(form: tuple | None, payload: int, fact: int | None) -> tuple[int, int, int] | None:
    if form is None or not form[4]:
        return None
    kind, channels, rate, _, block, _, held = form
    if kind in WAV_FRAMES:
        return rate, channels, payload // block
    if kind in WAV_BLOCKS and held:
        most = -(-payload // block) * held
        return rate, channels, min(fact, most) if fact else most
    return None


def _mpeg_frames(data: bytes) -> tuple[int, int, int] | None:
    """All frames of an MPEG stream, from one header to the next."""
    at, total, first = 0, 0, None
    while at + 4 <= len(data):
        word = int.from_bytes(data[at : at + 4], "big")
        version, layer, kbits, rate = word >> 19 & 3, word >> 17 & 3, word >> 12 & 15, word >> 10 & 3
        if word >> 21 != 2047 or version == 1 or layer == 0 or kbits in (0, 15) or rate == 3:
            break
        hertz = MPEG_RATES[rate] >> {3: 0, 2: 1, 0: 2}[version]
        table = 3 - layer if version == 3 else 3 + (layer != 3)
        bits = MPEG_KBITS[table][kbits] * 1000
        samples = 384 if layer == 3 else 576 if layer == 1 and version != 3 else 1152
        padding = word >> 9 & 1
        at += (12 * bits // hertz + padding) * 4 if layer == 3 else samples // 8 * bits // hertz + padding
        total += samples
        first = first or (hertz, 1 if word >> 6 & 3 == 3 else 2)
    return (*first, total) if first else None


def _crc8(data: bytes) -> int:
    crc = 0
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc << 1 ^ 7) & 255 if crc & 128 else crc << 1
    return crc


def _flac_end(data: bytes, at: int, least: int) -> int | None:
    """Samples up to the end of the frame whose header is at ``at``, if one is."""
    if data[at + 1] & 0xFE != 0xF8:
        return None
    code, first = data[at + 2] >> 4, data[at + 4]
    # The number is coded as UTF-8 codes code points, up to seven bytes.
    more = 0 if first < 128 else next((k for k in range(1, 7) if not first >> (6 - k) & 1), 6)
    value = first if first < 128 else first & ((1 << (6 - more)) - 1)
    end = at + 5 + more
    for byte in data[at + 5 : end]:
        value = value << 6 | byte & 63
    extra = {6: 1, 7: 2}.get(code, 0)
    block = int.from_bytes(data[end : end + extra], "big") + 1 if extra else FLAC_BLOCKS.get(code, 0)
    end += extra + {12: 1, 13: 2, 14: 2}.get(data[at + 2] & 15, 0)
    if not block or end >= len(data) or _crc8(data[at:end]) != data[end]:
        return None
    return (value if data[at + 1] & 1 else value * least) + block


def _flac_frames(data: bytes) -> tuple[int, int, int] | None:
    """A FLAC stream without a count: its last frame says where it ends."""
    if len(data) < 42:
        return None
    least, packed = int.from_bytes(data[8:10], "big"), int.from_bytes(data[18:26], "big")
    at = data.rfind(b"\xff")
    while at > 42:
        end = _flac_end(data, at, least) if at + 6 < len(data) else None
        if end is not None:
            return packed >> 44, (packed >> 41 & 7) + 1, end
        at = data.rfind(b"\xff", 0, at)
    return None


WALKERS = {"wav": walk_chunks, "aiff": walk_chunks, "mp3": lambda d, _: _mpeg_frames(d), "flac": lambda d, _: _flac_frames(d)}


def walk_batches(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Metadata of (kind, bytes, size of the file); nulls where there is none."""
    for kinds, datas, sizes in parts:
        rows = []
        for kind, data, size in zip(kinds, datas, sizes):
            walk = WALKERS.get(kind) if data is not None else None
            rows.append((walk(data, int(size)) if walk else None) or (None, None, None))
        yield pd.DataFrame(rows, columns=["sample_rate", "channels", "n_samples"]).astype("Int64")


def head_suffices(kind: Column) -> Column:
    """Whether the walk needs the head alone, unless it ends beyond that."""
    return kind.isin("wav", "aiff")


def walk_ends_in(head: Column, big: Column, chunks: int = 64) -> Column:
    """Whether ``walk_chunks`` meets its last chunk among the first ones of a head; ``big`` is the byte order's.

    Where this says no, the walk may still end in the head.
    """
    length = F.octet_length(head)

    def is_last(at: Column) -> Column:
        return (tag_at(head, at, b"data") & (at + 8 <= length)) | (tag_at(head, at, b"COMM") & (at + 26 <= length))

    def following(at: Column, _: Column) -> Column:
        size = F.when(big, number(head, at + 4, 4)).otherwise(number(head, at + 4, 4, little=True))
        beyond = F.least(at + 8 + size + size % 2, length.cast("bigint"))
        return F.when(is_last(at) | size.isNull(), at).otherwise(beyond.cast("int"))

    last = F.aggregate(F.sequence(F.lit(1), F.lit(chunks)), F.lit(12), following)
    return F.coalesce(F.exists(F.array(last), is_last), F.lit(False))
