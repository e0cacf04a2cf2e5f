"""PNG images as arrays, enough of the format to cut and stack pages: 8 bits a channel, not interlaced, grey or colour, with or without alpha."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Sequence

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Channels by colour type: grey, colour, grey and alpha, colour and alpha.
CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}


def read(content: bytes) -> np.ndarray:
    """Rows, columns and channels of an image."""
    if content[:8] != SIGNATURE:
        raise ValueError("no PNG image")
    at, packed, head = 8, b"", None
    while at + 12 <= len(content):
        (n,) = struct.unpack(">I", content[at : at + 4])
        kind, body = content[at + 4 : at + 8], content[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed += body
        at += 12 + n
    if head is None or head[2] != 8 or head[3] not in CHANNELS or head[6]:
        raise ValueError("a PNG image of another kind than 8 bits a channel, not interlaced")
    width, height, channels = head[0], head[1], CHANNELS[head[3]]
    rows = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(height, 1 + width * channels)
    out = np.zeros((height + 1, (width + 1) * channels), np.uint8)  # a black row above, a black pixel to the left
    for y in range(height):
        _unfilter(int(rows[y, 0]), rows[y, 1:], out[y], out[y + 1], channels)
    return out[1:, channels:].reshape(height, width, channels)


def _unfilter(kind: int, row: np.ndarray, above: np.ndarray, into: np.ndarray, c: int) -> None:
    """One row as the pixels it stands for: each byte adds to what its neighbours foretell."""
    if kind == 0:
        into[c:] = row
    elif kind == 1:
        into[c:] = np.cumsum(row.reshape(-1, c), axis=0, dtype=np.uint8).reshape(-1)
    elif kind == 2:
        into[c:] = row + above[c:]
    elif kind in (3, 4):
        left, up, corner = into, above.astype(np.int32), above.astype(np.int32)
        for i in range(len(row)):
            a, b, d = int(left[i]), int(up[i + c]), int(corner[i])
            guess = a + b >> 1 if kind == 3 else min((abs(b - d), 0, a), (abs(a - d), 1, b), (abs(a + b - 2 * d), 2, d))[2]
            into[i + c] = (int(row[i]) + guess) & 0xFF
    else:
        raise ValueError("a PNG image with an unknown filter")


def write(pixels: np.ndarray) -> bytes:
    height, width, channels = pixels.shape
    kind = {n: k for k, n in CHANNELS.items()}[channels]
    rows = np.zeros((height, 1 + width * channels), np.uint8)
    rows[:, 1:] = pixels.reshape(height, -1)
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def cut(pixels: np.ndarray, left: int, upper: int, right: int, lower: int) -> np.ndarray:
    """The part of an image inside a box, which is moved into the image where it sticks out; one pixel at least."""
    height, width = pixels.shape[:2]
    left, upper = max(0, min(left, width - 1)), max(0, min(upper, height - 1))
    return pixels[upper : max(upper + 1, min(lower, height)), left : max(left + 1, min(right, width))]


def stacked(parts: Sequence[np.ndarray], gap: int = 0) -> np.ndarray:
    """Images below each other on white, as wide as the widest, in colour without alpha."""
    plain = [p[:, :, :3] if p.shape[2] >= 3 else np.repeat(p[:, :, :1], 3, axis=2) for p in parts]
    width = max(p.shape[1] for p in plain)
    out = np.full((sum(p.shape[0] for p in plain) + gap * (len(plain) - 1), width, 3), 255, np.uint8)
    at = 0
    for p in plain:
        out[at : at + p.shape[0], : p.shape[1]] = p
        at += p.shape[0] + gap
    return out
