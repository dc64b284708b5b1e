"""Training-example messages in protobuf wire format, and TFRecord framing.

Message layout (field numbers are the public Example schema):
  Example  { Features features = 1 }
  Features { map<string, Feature> feature = 1 }  (entries: key = 1, value = 2)
  Feature  { BytesList bytes_list = 1; FloatList float_list = 2; Int64List int64_list = 3 }
  BytesList { repeated bytes value = 1 }   Int64List { repeated int64 value = 1 (packed) }

Features written per record: ``image`` (float32 little-endian, H-W-C
order), ``label`` (int64), ``image_shape`` (int64 x3), ``image_path``
(UTF-8 bytes).  Map-entry order is not part of the format, so readers
compare decoded fields, never raw bytes.

TFRecord framing per record: u64 length, masked CRC-32C of the length
bytes, payload, masked CRC-32C of the payload (all little-endian).
"""

from __future__ import annotations

import struct

import numpy as np

from .crc32c import crc32c_many, masked


def _varint(n: int) -> bytes:
    if n < 0:
        n += 1 << 64
    out = bytearray()
    while True:
        b = n & 0x7F
        n >>= 7
        if n:
            out.append(b | 0x80)
        else:
            out.append(b)
            return bytes(out)


def _ld(field: int, payload: bytes) -> bytes:
    """Length-delimited field."""
    return _varint(field << 3 | 2) + _varint(len(payload)) + payload


def _bytes_feature(values: list[bytes]) -> bytes:
    return _ld(1, b"".join(_ld(1, v) for v in values))


def _int64_feature(values) -> bytes:
    packed = b"".join(_varint(int(v)) for v in values)
    return _ld(3, _ld(1, packed))


def encode_example(image: np.ndarray, label: int, shape, path: str) -> bytes:
    feats = [
        ("image", _bytes_feature([np.asarray(image, dtype="<f4").tobytes()])),
        ("label", _int64_feature([label])),
        ("image_shape", _int64_feature(shape)),
        ("image_path", _bytes_feature([path.encode("utf-8")])),
    ]
    entries = b"".join(_ld(1, _ld(1, k.encode()) + _ld(2, v)) for k, v in feats)
    return _ld(1, entries)


def _read_varint(buf: memoryview, i: int) -> tuple[int, int]:
    shift = 0
    out = 0
    while True:
        b = buf[i]
        i += 1
        out |= (b & 0x7F) << shift
        if not b & 0x80:
            return out, i
        shift += 7


def _fields(buf: memoryview):
    i = 0
    n = len(buf)
    while i < n:
        key, i = _read_varint(buf, i)
        f, wt = key >> 3, key & 7
        if wt == 2:
            ln, i = _read_varint(buf, i)
            yield f, buf[i : i + ln]
            i += ln
        elif wt == 0:
            v, i = _read_varint(buf, i)
            yield f, v
        elif wt == 5:
            yield f, buf[i : i + 4]
            i += 4
        elif wt == 1:
            yield f, buf[i : i + 8]
            i += 8
        else:
            raise ValueError(f"unsupported wire type {wt}")


def _decode_feature(buf: memoryview):
    for f, v in _fields(buf):
        if f == 1:  # bytes list
            return [bytes(x) for g, x in _fields(v) if g == 1]
        if f == 2:  # float list (packed or not)
            vals = []
            for g, x in _fields(v):
                if isinstance(x, memoryview):
                    vals.extend(np.frombuffer(bytes(x), dtype="<f4").tolist())
            return vals
        if f == 3:  # int64 list
            vals = []
            for g, x in _fields(v):
                if isinstance(x, int):
                    vals.append(x - (1 << 64) if x >= 1 << 63 else x)
                else:
                    j = 0
                    while j < len(x):
                        n, j = _read_varint(x, j)
                        vals.append(n - (1 << 64) if n >= 1 << 63 else n)
            return vals
    return []


def decode_example(data: bytes) -> dict:
    """Feature name -> list of values (bytes or ints)."""
    out = {}
    for f, feats in _fields(memoryview(data)):
        if f != 1:
            continue
        for g, entry in _fields(feats):
            if g != 1:
                continue
            key, val = None, None
            for h, x in _fields(entry):
                if h == 1:
                    key = bytes(x).decode("utf-8")
                elif h == 2:
                    val = _decode_feature(x)
            if key is not None:
                out[key] = val
    return out


def frame_records(payloads: list[bytes]) -> bytes:
    """TFRecord framing of a list of payloads."""
    if not payloads:
        return b""
    lens = [struct.pack("<Q", len(p)) for p in payloads]
    crcs = masked(crc32c_many(lens + payloads))
    n = len(payloads)
    parts = []
    for i, p in enumerate(payloads):
        parts.append(lens[i])
        parts.append(struct.pack("<I", int(crcs[i])))
        parts.append(p)
        parts.append(struct.pack("<I", int(crcs[n + i])))
    return b"".join(parts)


def read_records(data: bytes, verify: bool = True, chunk: int = 256):
    """Yield payloads from TFRecord bytes, checking both CRCs."""
    i = 0
    n = len(data)
    pending = []
    while i < n:
        if i + 12 > n:
            raise ValueError("truncated TFRecord header")
        (ln,) = struct.unpack_from("<Q", data, i)
        (lcrc,) = struct.unpack_from("<I", data, i + 8)
        start = i + 12
        end = start + ln
        if end + 4 > n:
            raise ValueError("truncated TFRecord payload")
        (pcrc,) = struct.unpack_from("<I", data, end)
        pending.append((data[i : i + 8], lcrc, data[start:end], pcrc))
        i = end + 4
        if len(pending) >= chunk:
            yield from _check(pending, verify)
            pending = []
    yield from _check(pending, verify)


def read_records_stream(stream, verify: bool = True, chunk: int = 64):
    """Like :func:`read_records` over a file-like object: one record and
    one verification chunk in memory at a time, whatever the file size."""
    pending = []
    while True:
        head = stream.read(12)
        if not head:
            break
        if len(head) < 12:
            raise ValueError("truncated TFRecord header")
        (ln,) = struct.unpack_from("<Q", head, 0)
        (lcrc,) = struct.unpack_from("<I", head, 8)
        payload = stream.read(ln)
        tail = stream.read(4)
        if len(payload) < ln or len(tail) < 4:
            raise ValueError("truncated TFRecord payload")
        (pcrc,) = struct.unpack_from("<I", tail, 0)
        pending.append((head[:8], lcrc, payload, pcrc))
        if len(pending) >= chunk:
            yield from _check(pending, verify)
            pending = []
    yield from _check(pending, verify)


def _check(items, verify: bool):
    if not items:
        return
    if verify:
        crcs = masked(crc32c_many([x[0] for x in items] + [x[2] for x in items]))
        n = len(items)
        for k, (_, lcrc, _, pcrc) in enumerate(items):
            if int(crcs[k]) != lcrc:
                raise ValueError("TFRecord length CRC mismatch")
            if int(crcs[n + k]) != pcrc:
                raise ValueError("TFRecord payload CRC mismatch")
    for x in items:
        yield x[2]
