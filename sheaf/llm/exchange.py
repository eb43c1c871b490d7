"""A packed shuffle of (signature, owner) pairs that finds signatures with several owners.

A task sorts its pairs and sends one entry per distinct signature, the signature and its smallest owner,
to the bin of the signature. Pairs of a signature that has several owners inside the task need not
travel to that bin: they are spread over all bins and only pass through. So a signature that a
third of all rows share costs its bin one entry per task, and no bin or task gathers its owners.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa

SCHEMA = "bin int, direct boolean, sig binary, own binary, several binary"
_NAMES = ["bin", "direct", "sig", "own", "several"]
_DIRECT = 1 << 14  # pairs in one row that only passes through


def narrow(x: np.ndarray) -> bytes:
    """Integers as a base, a width and that many bytes each."""
    base = int(x.min()) if len(x) else 0
    rest = (x - np.int64(base)).view(np.uint64)
    width = max(1, (int(rest.max()).bit_length() + 7) // 8) if len(x) else 1
    body = np.ascontiguousarray(rest.view(np.uint8).reshape(-1, 8)[:, :width])
    return base.to_bytes(8, "little", signed=True) + bytes([width]) + body.tobytes()


def widen(raw: bytes) -> np.ndarray:
    base, width = int.from_bytes(raw[:8], "little", signed=True), raw[8]
    body = np.frombuffer(raw, np.uint8, offset=9).reshape(-1, width)
    out = np.zeros((len(body), 8), np.uint8)
    out[:, :width] = body
    return out.view(np.int64).ravel() + np.int64(base)


class Exchange:
    """``2**bits`` bins; of a signature, ``bits`` and ``8 * width`` further leading bits count."""

    def __init__(self, bits: int, width: int):
        self.bits, self.width = bits, width
        self.total = min(64, bits + 8 * width)

    def name(self, sig: np.ndarray) -> np.ndarray:
        """The part of a 64-bit signature that identifies it here."""
        return sig >> np.uint64(64 - self.total) if self.total < 64 else sig

    def pack(self, sig: np.ndarray, owner: np.ndarray, salt: int) -> pa.RecordBatch:
        """Rows to be grouped by ``bin`` for the pairs of one task (signed 64-bit owners)."""
        sig = self.name(sig)
        order = np.lexsort((owner, sig))
        sig, owner = sig[order], owner[order]
        if len(sig):
            new = np.r_[True, (sig[1:] != sig[:-1]) | (owner[1:] != owner[:-1])]
            sig, owner = sig[new], owner[new]
        at = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]][:len(sig)])
        count = np.diff(np.r_[at, len(sig)])
        rows: list[tuple] = []
        head, least, several = sig[at], owner[at], count > 1
        low = self.total - self.bits
        bins, start = np.unique(head >> np.uint64(low), return_index=True)
        for b, a, z in zip(bins.tolist(), start.tolist(), [*start[1:].tolist(), len(head)]):
            rest = (head[a:z] & np.uint64((1 << low) - 1)).view(np.int64)
            rows.append((b, False, narrow(rest), narrow(least[a:z]), np.packbits(several[a:z]).tobytes()))
        many = np.repeat(several, count)
        if many.any():
            ds, do, dm = sig[many], owner[many], np.repeat(least, count)[many]
            order = np.argsort(do, kind="stable")
            ds, do, dm = ds[order].view(np.int64), do[order], dm[order]
            for i, a in enumerate(range(0, len(ds), _DIRECT)):
                z = a + _DIRECT
                rows.append(((salt * 0x9E3779B1 + i * 0x85EBCA77 >> 7) % (1 << self.bits), True, narrow(ds[a:z]),
                             narrow(do[a:z]), narrow(dm[a:z])))
        cols = list(zip(*rows)) or [[]] * 5
        kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=_NAMES)

    def unpack(self, rows: pd.DataFrame) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
        """One bin: entries (signature, smallest owner of a task, whether the task has several), by
        signature and owner; and the direct pairs (signature, owner, smallest owner of the task)."""
        none = np.zeros(0, np.int64)
        sig, own, flag, ds, do, dm = [none], [none], [np.zeros(0, bool)], [none], [none], [none]
        for b, direct, s, o, f in zip(rows["bin"], rows["direct"], rows["sig"], rows["own"], rows["several"]):
            s, o = widen(s), widen(o)
            if direct:
                ds.append(s)
                do.append(o)
                dm.append(widen(f))
            else:
                sig.append(s | np.int64(np.uint64(int(b) << (self.total - self.bits)).view(np.int64)))
                own.append(o)
                flag.append(np.unpackbits(np.frombuffer(f, np.uint8), count=len(s)).astype(bool))
        s, o, f = np.concatenate(sig), np.concatenate(own), np.concatenate(flag)
        order = np.lexsort((o, s))
        return (s[order], o[order], f[order]), (np.concatenate(ds), np.concatenate(do), np.concatenate(dm))


def groups(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the runs of equal signatures."""
    at = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]][:len(sig)])
    return at, np.diff(np.r_[at, len(sig)])


def by_owner(sig: np.ndarray, owner: np.ndarray) -> pd.DataFrame:
    """(owner, sigs): each owner's signatures as bytes."""
    order = np.argsort(owner, kind="stable")
    sig, owner = sig[order], owner[order]
    at, count = groups(owner)
    raw = sig.astype("<i8").tobytes()
    return pd.DataFrame({"owner": owner[at], "sigs": [raw[8 * a:8 * (a + n)] for a, n in
                                                      zip(at.tolist(), count.tolist())]})
