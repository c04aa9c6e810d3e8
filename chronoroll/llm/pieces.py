"""SentencePiece encoding that keeps the byte span of every piece in the original text, and decoding.

A text is normalised by the model's compiled character map: at each place the
longest prefix found in its double-array trie is replaced (all places of a
block walk the trie together), anything else is copied, spaces are trimmed and
escaped as the model says. Each normalised byte remembers the original byte it
came from. The normalised texts are then segmented with the model's vocabulary
(by the ``sentencepiece`` library, its own normaliser switched off), and the
ends of the pieces are projected through the alignment to spans of the original
bytes. Ids are decoded by the surfaces of their pieces.

The model travels to the workers once, as a broadcast variable of its file.

Defined cases: a null or empty text has the begin and end ids alone; repeated
rows are encoded each; an empty table gives an empty result; extra columns are
carried, those named like a result column are replaced. A model with
user-defined pieces, which its normaliser must not touch, is an error. Where
spaces are trimmed, U+2581 written at the end of a text stays.
"""

from __future__ import annotations

import codecs
import hashlib
import struct
from collections.abc import Iterator
from functools import cached_property
from itertools import chain, groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import words as W

SPACE = "▁"
FIELDS = {"n_tokens": T.LongType(), "ids": T.BinaryType(), "spans": T.BinaryType(), "decoded": T.StringType()}
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6
#: Appended to a model file: field 3 (the normaliser) without map (2), added space (3), trimming (4) and escapes (5).
_NO_NORMALISER = bytes([3 << 3 | 2, 8, 2 << 3 | 2, 0, 3 << 3, 0, 4 << 3, 0, 5 << 3, 0])


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at:at + size]
            at += size


class CharacterMap:
    """Longest-prefix replacement through a compiled character map (double-array trie and its strings)."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0]
        self.units = np.frombuffer(blob, "<u4", size // 4, 4)
        self.pool = np.frombuffer(blob, np.uint8, offset=4 + size)
        self.ends = np.flatnonzero(self.pool == 0)

    def _child(self, unit: np.ndarray) -> np.ndarray:
        return (unit >> np.uint32(10)) << ((unit & np.uint32(512)) >> np.uint32(6))

    def longest(self, buf: np.ndarray, at: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(length, place of the replacement) of the longest key at each of the places ``at``; length 0 is none."""
        length, value = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        alive = np.arange(len(at))
        node = np.full(len(at), self._child(self.units[:1])[0], np.uint32)
        step = 0
        while len(alive):
            more = at[alive] + step < limit[alive]
            alive, node = alive[more], node[more]
            byte = buf[at[alive] + step].astype(np.uint32)
            node = node ^ byte
            fits = node < len(self.units)
            unit = self.units[np.where(fits, node, 0)]
            fits &= (unit & np.uint32(0x800000FF)) == byte
            alive, node, unit = alive[fits], node[fits], unit[fits]
            node = node ^ self._child(unit)
            leaf = (unit >> np.uint32(8)) & np.uint32(1) == 1
            length[alive[leaf]] = step + 1
            value[alive[leaf]] = self.units[node[leaf]] & np.uint32(0x7FFFFFFF)
            step += 1
        return length, value

    def apply(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, offsets, where each byte's original begins, where it ends) of texts after replacement."""
        start = np.flatnonzero((buf & 0xC0) != 0x80)
        size = np.diff(np.append(start, len(buf)))
        text = np.searchsorted(off, start, "right") - 1
        length, value = self.longest(buf, start, off[text + 1])
        taken = np.ones(len(start), bool)
        covered = 0
        for i in np.flatnonzero(length > size).tolist():  # a key of several characters covers those after its first
            if start[i] >= covered:
                covered = int(start[i] + length[i])
                taken[i + 1:int(np.searchsorted(start, covered))] = False
        start, size, text, length, value = (x[taken] for x in (start, size, text, length, value))
        mapped = length > 0
        src = np.where(mapped, value + len(buf), start)
        new = np.where(mapped, self.ends[np.minimum(np.searchsorted(self.ends, value), len(self.ends) - 1)] - value, size)
        ahead = np.cumsum(new) - new
        take = np.repeat(src - ahead, new) + np.arange(int(new.sum()))
        total = np.append(ahead, int(new.sum()))
        stop = start + np.where(mapped, length, size)
        return np.concatenate([buf, self.pool])[take], total[np.searchsorted(text, np.arange(len(off)))], np.repeat(start, new), np.repeat(stop, new)


class Model:
    """A vocabulary and its normaliser, read from the bytes of a model file."""

    def __init__(self, data: bytes):
        pieces, norm, trainer = [], {}, {}
        for f, v in _fields(data):
            if f == 1:
                d = dict(_fields(v))
                pieces.append((d.get(1, b"").decode(), struct.unpack("<f", d[2])[0] if 2 in d else 0.0, d.get(3, _NORMAL)))
            elif f == 2:
                trainer = dict(_fields(v))
            elif f == 3:
                norm = dict(_fields(v))
        if any(k == _USER for _, _, k in pieces):
            raise ValueError("models with user-defined pieces are not taken")
        self.map = CharacterMap(norm[2]) if norm.get(2) else None
        self.dummy, self.trim, self.escape = (bool(norm.get(k, 1)) for k in (3, 4, 5))
        self.suffix = bool(trainer.get(24, 0))
        self.fallback = bool(trainer.get(35, 0))
        by_name = {p: i for i, (p, _, k) in enumerate(pieces) if k == _CONTROL}
        self.begin = by_name.get(trainer.get(46, b"<s>").decode(), -1)
        self.end = by_name.get(trainer.get(47, b"</s>").decode(), -1)
        self.control = {i for i, (_, _, k) in enumerate(pieces) if k == _CONTROL}
        self.unknown = {i for i, (_, _, k) in enumerate(pieces) if k == _UNKNOWN}
        special = {_BYTE: lambda p: bytes([int(p[3:5], 16)]), _UNKNOWN: lambda p: trainer.get(44, " ⁇ ".encode()), _CONTROL: lambda p: b""}
        self.surface = [special.get(k, lambda p: p.replace(SPACE, " ").encode())(p) for p, _, k in pieces]
        #: Bytes that a piece takes of the normalised text (a byte piece: one of its character's).
        self.width = np.array([1 if k == _BYTE else len(p.encode()) for p, _, k in pieces])
        self.is_byte = np.array([k == _BYTE for _, _, k in pieces])
        #: Bytes that a piece stands for.
        self.bytes_of = np.array([len(x) for x in self.surface])
        self.data = data

    @cached_property
    def own(self):
        """The library with the model as it is."""
        import sentencepiece
        return sentencepiece.SentencePieceProcessor(model_proto=self.data)

    @cached_property
    def segments(self):
        """The library without the model's normaliser."""
        import sentencepiece
        return sentencepiece.SentencePieceProcessor(model_proto=self.data + _NO_NORMALISER)

    @staticmethod
    def of(data: bytes) -> Model:
        """The model of a file's bytes, read once in a process."""
        held = W._held()
        key = "pieces" + hashlib.sha256(data).hexdigest()
        if key not in held:
            held[key] = Model(data)
        return held[key]

    # ---- normalisation

    def normalise(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, offsets, original place of each byte, original end of each text) of the normalised texts."""
        if self.map:
            nbuf, noff, place, stop = self.map.apply(buf, off)
        else:
            begin = np.flatnonzero((buf & 0xC0) != 0x80)
            size = np.diff(np.append(begin, len(buf)))
            nbuf, noff, place, stop = buf, off, np.repeat(begin, size), np.repeat(begin + size, size)
        blank = nbuf == 0x20
        lead, spent = off[:-1].copy(), off[1:].copy()
        if self.trim:
            for t in np.flatnonzero(np.diff(noff) > 0).tolist():  # what is trimmed at the ends belongs to no piece
                k, end = int(noff[t]), int(noff[t + 1])
                while k < end and blank[k] and place[k] == lead[t]:
                    lead[t] = stop[k]
                    k += 1
                while end > k and blank[end - 1]:
                    end -= 1
                    spent[t] = place[end]
            before = np.ones(len(nbuf), bool)
            before[1:] = blank[:-1]
            before[noff[noff < len(nbuf)]] = True
            keep = ~(blank & before)
            total = np.append(0, np.cumsum(keep))
            nbuf, place, blank, noff = nbuf[keep], place[keep], blank[keep], total[noff]
            last = noff[1:][np.diff(noff) > 0] - 1
            keep = np.ones(len(nbuf), bool)
            keep[last[blank[last]]] = False  # one space at most is left there
            total = np.append(0, np.cumsum(keep))
            nbuf, place, blank, noff = nbuf[keep], place[keep], blank[keep], total[noff]
        # a space becomes three bytes; the added one stands before the first byte of each text, or behind the last
        mark = np.frombuffer((SPACE if self.escape else " ").encode(), np.uint8)
        full = np.flatnonzero(np.diff(noff) > 0)
        added = full if self.dummy else full[:0]
        size = np.where(blank, len(mark), 1)
        ends = np.append(0, np.cumsum(size))
        extra = np.zeros(len(noff), np.int64)
        extra[1:][added] = len(mark)
        extra = np.cumsum(extra)
        out = np.empty(int(ends[-1] + extra[-1]), np.uint8)
        at_place = np.empty(len(out), np.int64)
        text = np.repeat(np.arange(len(noff) - 1), np.diff(noff))
        to = ends[:-1] + extra[text] + (0 if self.suffix or not self.dummy else len(mark))
        new_off = ends[noff] + extra
        out[to] = nbuf
        at_place[to] = place
        for k, b in enumerate(mark.tolist()):
            out[to[blank] + k] = b
            at_place[to[blank] + k] = place[blank]
            spot = (new_off[added + 1] - len(mark) if self.suffix else new_off[added]) + k
            out[spot] = b
            at_place[spot] = spent[added] if self.suffix else lead[added]
        return out, new_off, at_place, spent

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, each text's first id, span starts, span ends) of a block of texts; spans count from the text's first byte.

        Like the library, of the bytes of one unknown character the last has the span, those before it an empty one.
        """
        nbuf, noff, place, spent = self.normalise(buf, off)
        raw = nbuf.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(noff.tolist(), noff[1:].tolist())]
        if self.fallback:
            ids = self.segments.encode(texts, num_threads=1)
            got = np.fromiter(chain.from_iterable(ids), np.int64)
            width = self.width[got]
        else:  # unknown characters in a row are one piece of any width
            found = [self.segments.encode(t, return_type="proto").pieces for t in texts]
            ids = [[x.id for x in p] for p in found]
            got = np.fromiter(chain.from_iterable(ids), np.int64)
            width = np.array([x.end - x.begin for p in found for x in p], np.int64)
        cut = np.cumsum([0, *map(len, ids)])
        ends = np.cumsum(width)
        text = np.repeat(np.arange(len(off) - 1), np.diff(cut))
        # the place behind a text's last byte is the text's end, not the next text's first byte
        start = place[ends - width] if len(got) else ends
        end = np.append(place, len(buf))[ends]
        last = cut[1:][np.diff(cut) > 0] - 1
        end[last] = spent[text[last]]
        byte = self.is_byte[got]
        if byte.any():
            lead = (nbuf[np.minimum(ends - width, len(nbuf) - 1)] & 0xC0) != 0x80
            group = np.cumsum(lead | ~byte)
            inner = byte & np.append((group[1:] == group[:-1]) & byte[1:], False)
            end[inner] = start[inner]
        return got, cut, start - off[text], end - off[text]

    # ---- decoding

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; bytes that make no character become U+FFFD, each."""
        surface = self.surface
        i = next((i for i in ids if i not in self.control), None)
        cut = (self.dummy or self.trim) and i is not None and not self.is_byte[i] and i not in self.unknown and surface[i][:1] == b" "
        if self.control.isdisjoint(ids[1:-1]):
            try:
                return b"".join([surface[i] for i in ids])[int(cut):].decode()
            except UnicodeDecodeError:
                pass
        # bytes in a row are decoded together, but not with those behind another piece
        codecs.register_error("chronoroll_each", lambda e: ("\ufffd" * (e.end - e.start), e.end))
        runs = [b"".join([surface[i] for i in run]) for _, run in groupby(ids, lambda i: bool(self.is_byte[i]))]
        return "".join([r.decode("utf-8", "chronoroll_each") for r in runs])[int(cut):]


def encode(docs: DataFrame, model: str, *, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids``, ``spans`` and ``decoded``; ``model`` is the path of a model file.

    ``ids`` holds little-endian unsigned 32-bit ids, begin and end included;
    ``spans`` a start and an end for each id, likewise, in bytes of the
    original text (the begin id lies at 0, the end id at the text's length).
    """
    with open(model, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # the file of a vocabulary

    def measure(buf: np.ndarray, off: np.ndarray) -> dict:
        m = Model.of(shared.value)
        got, cut, start, end = m.encode(buf, off)
        n = len(off) - 1
        at = np.arange(len(got)) + 2 * np.repeat(np.arange(n), np.diff(cut)) + 1
        cut = cut + 2 * np.arange(n + 1)
        ids = np.empty(int(cut[-1]), "<u4")
        spans = np.zeros((int(cut[-1]), 2), "<u4")
        ids[at], spans[at, 0], spans[at, 1] = got, start, end
        ids[cut[:-1]], ids[cut[1:] - 1] = m.begin, m.end
        spans[cut[1:] - 1] = np.diff(off)[:, None]
        listed = ids.tolist()
        return {"n_tokens": np.diff(cut), "ids": _binary(ids, cut, 4), "spans": _binary(spans, cut, 8),
                "decoded": [m.decode(listed[a:b]) for a, b in zip(cut.tolist(), cut[1:].tolist())]}

    return W.add_columns(docs, text, FIELDS, measure)


def _binary(values: np.ndarray, cut: np.ndarray, size: int) -> list[bytes]:
    raw = values.tobytes()
    return [raw[a:b] for a, b in zip((cut[:-1] * size).tolist(), (cut[1:] * size).tolist())]
