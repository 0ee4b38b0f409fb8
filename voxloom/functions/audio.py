"""Audio expressions: headers, durations, mono mix."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom import constants as C
from voxloom.functions import containers as N

_HEADER_BYTES = 44


def _little_endian(header: Column, start: int, size: int) -> Column:
    """An unsigned integer of ``size`` bytes at the 1-based byte offset ``start``."""
    first = 2 * start - 1
    digits = [F.substring(header, first + 2 * i, 2) for i in range(size - 1, -1, -1)]
    return F.conv(F.concat(*digits), 16, 10).try_cast("bigint")


def _tag_is(header: Column, start: int, tag: str) -> Column:
    return F.substring(header, 2 * start - 1, 8) == tag.encode().hex().upper()


def is_plain_wav(header: Column) -> Column:
    """RIFF/WAVE with a 16-byte integer PCM format chunk right before the data chunk.

    ``header`` holds the hex digits of the first 44 bytes.
    """
    return F.coalesce(
        (F.length(header) == 2 * _HEADER_BYTES)
        & _tag_is(header, 1, "RIFF")
        & _tag_is(header, 9, "WAVE")
        & _tag_is(header, 13, "fmt ")
        & (_little_endian(header, 17, 4) == 16)
        & (_little_endian(header, 21, 2) == 1)
        & _tag_is(header, 37, "data"),
        F.lit(False),
    )


def plain_wav_metadata(header: Column, size: Column) -> Column:
    """Struct of rate, channels and samples per channel of a plain header."""
    channels = _little_endian(header, 23, 2)
    block = channels * (_little_endian(header, 35, 2) / 8).cast("long")
    payload = F.least(_little_endian(header, 41, 4), size - _HEADER_BYTES)
    return F.struct(
        _little_endian(header, 25, 4).alias("sample_rate"),
        channels.alias("channels"),
        F.when(block > 0, F.floor(F.try_divide(payload, block))).cast("long").alias("n_samples"),
    )


def with_audio_metadata(df: DataFrame, data: Column, name: str = "wav") -> DataFrame:
    """Add a struct of sample_rate, channels and n_samples; null fields where unreadable.

    ``data`` is the whole file. Only its head goes to Python where chunks are walked, and
    all of it only if the head does not reach far enough or no header counts the samples.
    """
    skipped = F.when(N.id3_bytes(data) > 0, F.substring(data, N.id3_bytes(data) + 1, F.octet_length(data))).otherwise(data)
    staged = _ranged(df.withColumn("_vx_body", skipped), F.col("_vx_body"), F.octet_length("_vx_body"))
    return _read_ranges(staged, F.col("_vx_body"), name).drop("_vx_body")


def with_file_metadata(df: DataFrame, path: Column, opener: Callable, name: str = "wav") -> DataFrame:
    """The same of the files that ``path`` names, of which tasks read head and tail.

    A null path, and a file that cannot be opened, give null fields. ``opener`` gives the
    file system and the path of a URI.
    """

    def ranges(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [_file_ranges(uri, opener) if uri is not None else (None, None, None) for uri in part]
            yield pd.DataFrame(rows, columns=["head", "tail", "size"], dtype=object)

    def whole(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([_file_body(uri, opener) if uri is not None else None for uri in part], dtype=object)

    read = F.pandas_udf(ranges, "head binary, tail binary, size long")
    staged = df.withColumn("_vx_path", path)
    staged = staged.select("*", F.explode(F.array(read("_vx_path"))).alias("_vx_ranges"))
    staged = _ranged(staged, F.col("_vx_ranges.head"), F.col("_vx_ranges.size"), F.col("_vx_ranges.tail"))
    body = F.pandas_udf(whole, "binary")(F.when(F.col("_vx_whole"), F.col("_vx_path")))
    return _read_ranges(staged, body, name).drop("_vx_path", "_vx_ranges")


def _ranged(df: DataFrame, body: Column, size: Column, tail: Column | None = None) -> DataFrame:
    """Head, size and kind of each file, and what expressions read of it."""
    head = F.substring(body, 1, N.HEAD_BYTES)
    staged = df.withColumns({"_vx_head": head, "_vx_size": size.cast("long")})
    staged = staged.withColumns({
        "_vx_kind": N.container(F.col("_vx_head")), "_vx_hex": F.hex(F.substring("_vx_head", 1, _HEADER_BYTES)),
    })
    # Only Ogg tells its length at the end.
    if tail is None:
        tail = F.substring(body, F.greatest(F.lit(1), size - N.TAIL_BYTES + 1), F.lit(N.TAIL_BYTES))
    tail = F.when(F.col("_vx_kind") == "ogg", tail)
    plain = F.when(is_plain_wav(F.col("_vx_hex")), plain_wav_metadata(F.col("_vx_hex"), F.col("_vx_size")))
    fixed = F.coalesce(plain, N.fixed_metadata(F.col("_vx_kind"), F.col("_vx_head"), tail, F.col("_vx_size")))
    staged = staged.select("*", F.explode(F.array(fixed)).alias("_vx_fixed"))
    # A walk over the head is tried where it ends there, else one over the file: either way
    # in one Python worker of a task, as each holds memory of its own.
    kind, head = F.col("_vx_kind"), F.col("_vx_head")
    fits = (F.col("_vx_size") <= N.HEAD_BYTES) | N.walk_ends_in(head, N.tag_at(head, 0, b"FORM"))
    whole = _is_walked() & (kind != "ogg") & ~F.when(N.head_suffices(kind), fits).otherwise(False)
    return staged.withColumn("_vx_whole", F.coalesce(whole, F.lit(False)))


def _is_walked() -> Column:
    return F.col("_vx_fixed").isNull() & F.col("_vx_kind").isNotNull()


def _read_ranges(df: DataFrame, body: Column, name: str) -> DataFrame:
    on_head = _is_walked() & N.head_suffices(F.col("_vx_kind"))
    data = F.when(F.col("_vx_whole"), body).when(on_head, F.col("_vx_head"))
    walked = F.pandas_udf(N.walk_batches, N.METADATA)("_vx_kind", data, "_vx_size")
    metadata = F.when(F.col("_vx_fixed").isNotNull(), F.col("_vx_fixed")).otherwise(walked)
    # A one-element explode keeps filters on the result from repeating its parsing.
    read = df.select("*", F.explode(F.array(metadata)).alias(name))
    return read.drop("_vx_head", "_vx_size", "_vx_kind", "_vx_hex", "_vx_fixed", "_vx_whole")


def _after_id3(start: bytes) -> int:
    if start[:3] != b"ID3" or len(start) < 10:
        return 0
    size = start[6] << 21 | start[7] << 14 | start[8] << 7 | start[9]
    return size + 10 + (10 if start[5] & 16 else 0)


def _file_ranges(uri: str, opener: Callable) -> tuple[bytes | None, bytes | None, int | None]:
    try:
        system, path = opener(uri)
        with system.open_input_file(path) as source:
            begin = _after_id3(source.read(10))
            size = max(0, source.size() - begin)
            source.seek(begin)
            head = source.read(N.HEAD_BYTES)
            source.seek(begin + max(0, size - N.TAIL_BYTES))
            return head, source.read(N.TAIL_BYTES) if head[:4] == b"OggS" else None, size
    except OSError:
        return None, None, None


def _file_body(uri: str, opener: Callable) -> bytes:
    system, path = opener(uri)
    with system.open_input_file(path) as source:
        data = source.read()
    return data[_after_id3(data[:10]) :]


def array_metadata(audio: Column, kind: T.StructType) -> Column:
    """The same struct for decoded audio: ``array`` of samples, or of frames, and its rate.

    The rate is ``sampling_rate``, or ``sample_rate`` where there is none.
    """
    frames = audio["array"]
    by_frame = isinstance(kind["array"].dataType.elementType, T.ArrayType)
    channels = F.size(F.get(frames, F.lit(0))) if by_frame else F.lit(1)
    rates = [audio[name] for name in ("sampling_rate", "sample_rate") if name in kind.names]
    rate = F.coalesce(*rates) if rates else F.lit(None)
    known = frames.isNotNull()
    return F.struct(
        F.when(known, rate).cast("long").alias("sample_rate"),
        F.when(known, channels).cast("long").alias("channels"),
        F.when(known, F.size(frames)).cast("long").alias("n_samples"),
    )


def duration_seconds(n_samples: Column, sample_rate: Column) -> Column:
    """Seconds of audio, or null when the rate or count is unusable."""
    return F.when(sample_rate > 0, F.try_divide(n_samples.cast("double"), sample_rate.cast("double")))


def duration_status(seconds: Column, limit: float = C.MAX_AUDIO_SECONDS) -> Column:
    """'decode_failed', 'too_long' or 'ok'; exactly ``limit`` seconds is still ok."""
    return (
        F.when(seconds > limit, "too_long")
        .when(seconds.isNotNull(), "ok")
        .otherwise("decode_failed")
    )


def mono_mix(frames: Column) -> Column:
    """Mean over the channels of each frame of ``array<array<float>>``."""
    return F.transform(
        frames,
        lambda frame: (
            F.aggregate(frame, F.lit(0.0).cast("double"), lambda total, x: total + x.cast("double"))
            / F.size(frame)
        ).cast("float"),
    )
