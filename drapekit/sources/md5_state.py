"""md5 that one task sets down and another takes up: hashlib does not give its state away.

The state after a multiple of 64 bytes is four 32-bit words.  They are read from and put into
OpenSSL's ``MD5_CTX`` (``openssl/md5.h``), in the library that hashlib itself uses.  Where that library
is not to be had, the same is worked out in Python: as right, but a few MB a second.
"""

from __future__ import annotations

import functools
import hashlib
import math
import struct

START = struct.pack("<4I", 0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


class Md5:
    """``update`` and ``hexdigest`` like hashlib's; ``Md5(state, n)`` goes on after n bytes, n and all
    that is given before ``state()`` being multiples of 64 bytes."""

    def __init__(self, state: bytes = START, n: int = 0):
        self.own = (_OpenSSL if _library() else _Plain)(state, n)

    def update(self, raw) -> None:
        self.own.update(raw)

    def state(self) -> bytes:
        return self.own.state()

    def hexdigest(self) -> str:
        return self.own.hexdigest()


@functools.cache
def _library():
    """OpenSSL's functions, if they are there and do as they should."""
    import ctypes

    try:
        import _hashlib

        lib = ctypes.CDLL(_hashlib.__file__)
        lib.MD5_Init.argtypes = [ctypes.c_void_p]
        lib.MD5_Update.argtypes = [ctypes.c_void_p, ctypes.c_void_p, ctypes.c_size_t]
        lib.MD5_Final.argtypes = [ctypes.c_void_p, ctypes.c_void_p]
        raw = bytes(range(256)) * 3
        first = _OpenSSL(START, 0, lib)
        first.update(raw[:448])
        second = _OpenSSL(first.state(), 448, lib)
        second.update(raw[448:])
        return lib if second.hexdigest() == hashlib.md5(raw).hexdigest() else None
    except (ImportError, OSError, AttributeError, TypeError):
        return None


class _OpenSSL:
    def __init__(self, state: bytes, n: int, lib=None):
        import ctypes

        self.lib = lib or _library()
        # A, B, C, D, Nl, Nh (bits so far), data[16], num; with room to spare
        self.words = (ctypes.c_uint32 * 64)()
        self.lib.MD5_Init(self.words)
        self.words[:6] = [*struct.unpack("<4I", state), n * 8 & 0xFFFFFFFF, n * 8 >> 32 & 0xFFFFFFFF]

    def update(self, raw) -> None:
        import pyarrow as pa

        held = pa.py_buffer(raw)
        if held.size:
            self.lib.MD5_Update(self.words, held.address, held.size)

    def state(self) -> bytes:
        return struct.pack("<4I", *self.words[:4])

    def hexdigest(self) -> str:
        import ctypes

        out = ctypes.create_string_buffer(16)
        self.lib.MD5_Final(out, self.words)
        return out.raw.hex()


_TURNS = [s for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in four * 4]
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]


class _Plain:
    def __init__(self, state: bytes, n: int):
        self.words, self.n, self.rest = struct.unpack("<4I", state), n, b""

    def update(self, raw) -> None:
        self.rest += bytes(raw)
        whole = len(self.rest) // 64 * 64
        for place in range(0, whole, 64):
            self._block(struct.unpack_from("<16I", self.rest, place))
        self.n, self.rest = self.n + whole, self.rest[whole:]

    def _block(self, m) -> None:
        a, b, c, d = self.words
        for i in range(64):
            if i < 16:
                f, g = d ^ (b & (c ^ d)), i
            elif i < 32:
                f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
            elif i < 48:
                f, g = b ^ c ^ d, (3 * i + 5) % 16
            else:
                f, g = c ^ (b | ~d & 0xFFFFFFFF), 7 * i % 16
            f = (f + a + _SINES[i] + m[g]) & 0xFFFFFFFF
            a, d, c = d, c, b
            b = (b + (f << _TURNS[i] | f >> 32 - _TURNS[i])) & 0xFFFFFFFF
        self.words = tuple((x + y) & 0xFFFFFFFF for x, y in zip(self.words, (a, b, c, d)))

    def state(self) -> bytes:
        return struct.pack("<4I", *self.words)

    def hexdigest(self) -> str:
        bits = (self.n + len(self.rest)) * 8
        self.update(b"\x80" + bytes((55 - len(self.rest)) % 64) + struct.pack("<Q", bits & (1 << 64) - 1))
        return self.state().hex()
