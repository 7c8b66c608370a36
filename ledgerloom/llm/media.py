"""Media columns: texts as 8-bit WAV sound, short-time spectra, and spectral-peak pair fingerprints."""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import ship_package

#: The payload is padded with PAD to a positive multiple of UNIT bytes.
UNIT, PAD = 192, b" "
RATE = 8000
FRAME, HOP = 256, 192
#: Frequency bands (first bin, end bin); each frame may have one peak in each.
BANDS = ((2, 16), (16, 48), (48, 128))
#: A peak is paired with at most so many later ones, at most so many frames later.
FAN, REACH = 3, 16
_FRAMES = 4096
_HANN = np.hanning(FRAME + 1)[:-1].astype(np.float32)


def to_wav(payload: bytes) -> bytes:
    """One channel of unsigned 8-bit samples."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


def pad(data: bytes) -> bytes:
    return data + PAD * (-len(data) % UNIT if data else UNIT)


def n_frames(samples: int) -> int:
    """Frames that cover so many samples: one per HOP begun, at least one."""
    return max(1, -(-samples // HOP))


def frames_of(payload: bytes) -> np.ndarray:
    """The frames of a sound, with silence around it (FRAME - HOP for a payload of whole units, half of it on either
    side) so that its first and last samples are inside a frame and not at the window's zero."""
    samples = np.frombuffer(payload, np.uint8).astype(np.float32) - 128
    lead = (FRAME - HOP) // 2
    whole = (n_frames(len(samples)) - 1) * HOP + FRAME
    samples = np.concatenate((np.zeros(lead, np.float32), samples, np.zeros(whole - lead - len(samples), np.float32)))
    return np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP]


def peaks(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Frame and bin of each spectral peak: per frame and band its loudest bin, where it is louder than in the
    frames before and after and than the band's mean over the sound."""
    frames = frames_of(payload)
    tops, bins = [], []
    for a in range(0, len(frames), _FRAMES):  # long sounds in stretches, so that memory is bounded
        power = np.abs(np.fft.rfft(frames[a : a + _FRAMES] * _HANN, axis=1)).round(2)
        tops.append(np.stack([power[:, lo:hi].max(1) for lo, hi in BANDS], 1))
        bins.append(np.stack([power[:, lo:hi].argmax(1) + lo for lo, hi in BANDS], 1))
    top, at = np.concatenate(tops), np.concatenate(bins)
    wall = np.full((1, len(BANDS)), -1.0)
    before, after = np.concatenate((wall, top[:-1])), np.concatenate((top[1:], wall))
    f, b = np.nonzero((top >= before) & (top > after) & (top >= top.mean(0)))
    return f.astype(np.int32), at[f, b].astype(np.int32)


def pair_codes(frames: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(time, code) of peak pairs: code = first bin * 2**14 + second bin * 2**6 + frames between."""
    times, codes = [], []
    for k in range(1, FAN + 1):
        gap = frames[k:] - frames[:-k]
        near = gap <= REACH
        times.append(frames[:-k][near])
        codes.append((bins[:-k] << 14 | bins[k:] << 6 | gap)[near])
    t, c = np.concatenate(times), np.concatenate(codes)
    order = np.lexsort((c, t))
    return t[order], c[order]


SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, n_frames long, n_peaks long, fp_times array<int>, fp_codes array<int>"


def _media_batches(batches: Iterator[pa.RecordBatch], keep: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
            data = (text.as_py() or "").encode()
            media = to_wav(pad(data))
            back = from_wav(media)
            f, bins = peaks(back)
            t, c = pair_codes(f, bins)
            rows.append((doc, len(data), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media), hashlib.sha256(media).hexdigest(), n_frames(len(back)), len(f), t, c, media))
        cols = list(zip(*rows, strict=True)) or [[]] * 12
        kinds = [pa.int64()] * 3 + [pa.string()] + [pa.int64()] * 2 + [pa.string()] + [pa.int64()] * 2 + [pa.list_(pa.int32())] * 2
        names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "n_frames", "n_peaks", "fp_times", "fp_codes"]
        if keep:
            kinds, names = [*kinds, pa.binary()], [*names, "media"]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols, kinds, strict=False)], names)


def media_features(docs: DataFrame, keep_media: bool = False) -> DataFrame:
    """Per document: sizes and digests of its sound, and its fingerprint as two arrays, times (frames) and pair codes.

    The text's bytes are padded and written as WAV, and everything after n_bytes comes from the bytes read back.
    keep_media adds the sound itself (binary column media). Null texts are empty; equal texts give equal values;
    one row per input row; other columns are ignored. Nothing is shuffled.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _media_batches(batches, keep_media)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, SCHEMA + (", media binary" if keep_media else ""))


def op2_media(docs: DataFrame) -> DataFrame:
    """The contract's columns, and the fingerprint: fp_times and fp_codes. feature is frames:peaks:pairs:digest of them."""
    m = media_features(docs)
    coded = F.sha2(F.concat(F.array_join("fp_times", ","), F.lit(";"), F.array_join("fp_codes", ",")), 256)
    feature = F.concat_ws(":", F.col("n_frames").cast("string"), F.col("n_peaks").cast("string"), F.size("fp_codes").cast("string"), F.substring(coded, 1, 32))
    return m.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"), "fp_times", "fp_codes")
