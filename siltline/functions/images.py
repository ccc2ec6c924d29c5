"""Images as arrays: sizes from headers, decoding of plain formats, and measures of sharpness and codes.

PNG (8 bits a sample, not interlaced), BMP (24 and 32 bits, uncompressed) and PNM are decoded here; for
other formats a decoder (bytes to an array [row, column] or [row, column, channel]) can be given."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column

from .expr import deferred

Decoder = Callable[[bytes], "np.ndarray | None"]


def image_size(content: bytes | None) -> tuple[int, int] | None:
    """(width, height) from the header; None if it is none of PNG, GIF, BMP, JPEG, WebP and PNM."""
    c = content or b""
    try:
        if c[:8] == b"\x89PNG\r\n\x1a\n":
            return struct.unpack(">II", c[16:24])
        if c[:4] == b"GIF8":
            return struct.unpack("<HH", c[6:10])
        if c[:2] == b"BM":
            w, h = struct.unpack("<ii", c[18:26])
            return w, abs(h)
        if c[:2] in (b"P5", b"P6"):
            return _pnm_header(c)[:2]
        if c[:4] == b"RIFF" and c[8:12] == b"WEBP":
            if c[12:16] == b"VP8X":
                return 1 + int.from_bytes(c[24:27], "little"), 1 + int.from_bytes(c[27:30], "little")
            if c[12:16] == b"VP8L":
                bits = int.from_bytes(c[21:25], "little")
                return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
            if c[12:16] == b"VP8 ":
                w, h = struct.unpack("<HH", c[26:30])
                return w & 0x3FFF, h & 0x3FFF
        if c[:2] == b"\xff\xd8":
            at = 2
            while at + 9 < len(c):
                marker, size = c[at + 1], int.from_bytes(c[at + 2 : at + 4], "big")
                if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                    h, w = struct.unpack(">HH", c[at + 5 : at + 9])
                    return w, h
                at += 2 + size
    except (struct.error, ValueError, IndexError):
        return None
    return None


def _pnm_header(c: bytes) -> tuple[int, int, int]:
    """Width, height and where the samples begin."""
    numbers, at = [], 2
    while len(numbers) < 3:
        while c[at : at + 1].isspace():
            at += 1
        end = at
        while c[end : end + 1].isdigit():
            end += 1
        numbers.append(int(c[at:end]))
        at = end
    return numbers[0], numbers[1], at + 1


def _png(c: bytes) -> np.ndarray | None:
    w, h, depth, kind, _, _, interlaced = struct.unpack(">IIBBBBB", c[16:29])
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}.get(kind)
    if depth != 8 or interlaced or channels is None:
        return None
    data, palette, at = b"", None, 8
    while at + 8 <= len(c):
        size, name = struct.unpack(">I4s", c[at : at + 8])
        if name == b"IDAT":
            data += c[at + 8 : at + 8 + size]
        elif name == b"PLTE":
            palette = np.frombuffer(c[at + 8 : at + 8 + size], np.uint8).reshape(-1, 3)
        at += 12 + size
    raw = np.frombuffer(zlib.decompress(data), np.uint8).reshape(h, 1 + w * channels)
    rows = np.zeros((h + 1, w * channels), np.int64)
    for y in range(h):
        how, line, up = raw[y, 0], raw[y, 1:].astype(np.int64), rows[y]
        if how in (0, 2):
            out = line + (up if how else 0)
        else:  # these depend on the pixel to the left
            out = line.copy()
            for x in range(len(line)):
                left = out[x - channels] if x >= channels else 0
                above, corner = up[x], up[x - channels] if x >= channels else 0
                if how == 1:
                    add = left
                elif how == 3:
                    add = (left + above) // 2
                else:
                    guess = left + above - corner
                    add = min((left, above, corner), key=lambda v: (abs(guess - v), (left, above, corner).index(v)))
                out[x] = (out[x] + add) & 255
        rows[y + 1] = out & 255
    pixels = rows[1:].astype(np.uint8).reshape(h, w, channels)
    return palette[pixels[:, :, 0]] if kind == 3 and palette is not None else pixels[:, :, :3] if channels >= 3 else pixels[:, :, 0]


def _bmp(c: bytes) -> np.ndarray | None:
    begin, (w, h), bits, packed = struct.unpack("<I", c[10:14])[0], struct.unpack("<ii", c[18:26]), struct.unpack("<H", c[28:30])[0], struct.unpack("<I", c[30:34])[0]
    if bits not in (24, 32) or packed:
        return None
    stride = (w * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(c[begin : begin + stride * abs(h)], np.uint8).reshape(abs(h), stride)[:, : w * bits // 8].reshape(abs(h), w, bits // 8)
    return (rows if h < 0 else rows[::-1])[:, :, 2::-1]


def decode(content: bytes | None, other: Decoder | None = None) -> np.ndarray | None:
    """The pixels, or None if they cannot be read."""
    c = content or b""
    try:
        if c[:8] == b"\x89PNG\r\n\x1a\n" and (found := _png(c)) is not None:
            return found
        if c[:2] == b"BM" and (found := _bmp(c)) is not None:
            return found
        if c[:2] in (b"P5", b"P6"):
            w, h, at = _pnm_header(c)
            channels = 3 if c[:2] == b"P6" else 1
            pixels = np.frombuffer(c[at : at + w * h * channels], np.uint8).reshape(h, w, channels)
            return pixels if channels == 3 else pixels[:, :, 0]
        return other(c) if other and c else None
    except (struct.error, ValueError, IndexError, zlib.error):
        return None


def grey(pixels: np.ndarray) -> np.ndarray:
    """Brightness from 0 to 255."""
    return pixels.astype(float) if pixels.ndim == 2 else np.rint(pixels[:, :, :3] @ np.array([0.299, 0.587, 0.114]))


def sharpness(pixels: np.ndarray) -> float:
    """Variance of the second differences of the brightness, borders mirrored."""
    g = grey(pixels)
    if min(g.shape) < 2:
        return 0.0
    p = np.pad(g, 1, mode="reflect")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g).var())


def _finders(dark: np.ndarray) -> list[tuple[float, float, float]]:
    """(row, column, module) of marks whose dark and light runs are as 1 : 1 : 3 : 1 : 1 both ways."""
    def runs(line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cuts = np.nonzero(np.diff(line))[0] + 1
        begin = np.r_[0, cuts]
        return begin, np.diff(np.r_[begin, len(line)])

    def marks(line: np.ndarray) -> list[tuple[float, float]]:
        begin, size = runs(line)
        found = []
        for i in range(len(size) - 4):
            five = size[i : i + 5]
            unit = five.sum() / 7
            if line[begin[i]] and unit >= 1.5 and (np.abs(five - unit * np.array([1, 1, 3, 1, 1])) <= unit * np.array([0.5, 0.5, 1.5, 0.5, 0.5])).all():
                found.append((begin[i] + five.sum() / 2, unit))
        return found

    out: list[tuple[float, float, float]] = []
    for y, line in enumerate(dark):
        for x, unit in marks(line):
            column = dark[:, min(int(x), dark.shape[1] - 1)]
            for yy, other in marks(column):
                if abs(yy - y) <= 2 * unit and abs(other - unit) <= 0.5 * unit and not any(abs(yy - a) + abs(x - b) <= 4 * unit for a, b, _ in out):
                    out.append((yy, x, unit))
    return out


def code_share(pixels: np.ndarray) -> float:
    """Share of the image that square two-dimensional codes take up: three of their corner marks, at a right
    angle and equal distances, span one; 0 without any.  A module of a code is 1.5 pixels or more."""
    g = grey(pixels)
    marks = _finders(g < (g.min() + g.max()) / 2) if g.size and g.max() > g.min() else []
    best = 0.0
    for i, a in enumerate(marks):
        for j, b in enumerate(marks):
            for c in marks[j + 1 :]:
                if i == j or c is a:
                    continue
                u, v = np.subtract(b[:2], a[:2]), np.subtract(c[:2], a[:2])
                m, n = np.hypot(*u), np.hypot(*v)
                alike = max(a[2], b[2], c[2]) <= 1.3 * min(a[2], b[2], c[2])
                if alike and min(m, n) > 0 and abs(m - n) <= 0.15 * max(m, n) and abs(u @ v) <= 0.15 * m * n:
                    best = max(best, (m + 7 * a[2]) * (n + 7 * a[2]) / g.size)
    return min(1.0, best)


def measures(other: Decoder | None = None) -> Callable[[Column], Column]:
    """(width, height, sharpness, code_share) of an image, null where it cannot be read."""

    def run(contents: pd.Series) -> pd.DataFrame:
        rows = []
        for c in contents:
            size, pixels = image_size(c), decode(c, other)
            if size is None and pixels is not None:
                size = pixels.shape[1], pixels.shape[0]
            rows.append((*(size or (None, None)), *((sharpness(pixels), code_share(pixels)) if pixels is not None and pixels.size else (None, None))))
        made = pd.DataFrame(rows, columns=["width", "height", "sharpness", "code_share"])
        return made.astype({"width": "Int64", "height": "Int64", "sharpness": "Float64", "code_share": "Float64"})

    run.__annotations__ = {"contents": pd.Series, "return": pd.DataFrame}
    return deferred(run, "width long, height long, sharpness double, code_share double")
