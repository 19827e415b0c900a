"""BPE pieces with byte fallback, by a table of each prefix's last token.

In byte-pair encoding by merge order, the encoding of every prefix of a text
ends in one certain token, and a token ends a prefix exactly if it stays as it is
next to the token that ends the prefix before it. So one left-to-right pass over
the automaton's matches fills a table with one token per prefix, and the ids are
read off backwards.
"""

from __future__ import annotations

import hashlib
import re
import sys
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
# Segments up to this many characters are remembered, in two generations of so many per worker.
CACHED_LENGTH = 40
CACHED_SEGMENTS = 120_000
CACHED_PAIRS = 250_000


class PieceModel:
    """Vocabulary of a merge-type piece model (pieces, scores, kinds) and its automaton."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        import ahocorasick

        self.score: dict[str, float] = {}
        self.packed_id: dict[str, bytes] = {}
        self.byte: dict[int, int] = {}
        self.bytes_of: list[bytes | None] = []
        automaton = ahocorasick.Automaton()
        known: set[str] = set()
        joined = set()
        for number, (piece, score, kind) in enumerate(pieces):
            text: bytes | None = None
            if kind == NORMAL:
                self.packed_id[piece], self.score[piece] = packed_ids([number]), score
                automaton.add_word(piece, (piece, len(piece)))
                known.update(piece)
                joined.update(zip(piece, piece[1:], strict=False))
                text = piece.replace(SPACE, " ").encode()
            elif kind == BYTE:
                self.byte[int(piece[3:5], 16)] = number
                text = bytes([int(piece[3:5], 16)])
            elif kind == UNKNOWN:
                text = b" \xe2\x81\x87 "
            elif kind != CONTROL:
                raise ValueError(f"pieces of kind {kind} are not supported")
            self.bytes_of.append(text)
        automaton.make_automaton()
        self.automaton, self.known = automaton, known
        self._stays: dict[tuple[str, str], bool] = {}
        self._self: dict[str, bool] = {}
        # No piece goes on with a space sign after another character, so texts fall apart before one.
        if any(b == SPACE != a for a, b in joined):
            self.segments = re.compile(r".+", re.S)
        else:
            apart = "".join(c for c in "\n\t\r" if c not in known)
            self.segments = re.compile(f"[{apart}]|{SPACE}*[^{SPACE}{apart}]+|{SPACE}+" if apart else f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def merged(self, text: str) -> list[str]:
        """Pieces after all merges, best score first and leftmost among equals."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = []
        for i in range(len(parts) - 1):
            score = self.score.get(parts[i] + parts[i + 1])
            if score is not None:
                heap.append((-score, i, parts[i] + parts[i + 1]))
        heapify(heap)
        while heap:
            _, i, whole = heappop(heap)
            j = after[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or parts[i] + parts[j] != whole:
                continue
            parts[i], parts[j] = whole, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
                near = whole + parts[after[i]]
                if near in self.score:
                    heappush(heap, (-self.score[near], i, near))
            if before[i] >= 0:
                near = parts[before[i]] + whole
                if near in self.score:
                    heappush(heap, (-self.score[near], before[i], near))
        return [p for p in parts if p is not None]

    def stays(self, left: str, right: str) -> bool:
        """True if ``left`` and ``right`` side by side are the encoding of their text."""
        pair = (left, right)
        known = self._stays.get(pair)
        if known is None:
            if len(self._stays) >= CACHED_PAIRS:
                self._stays.clear()
            # A piece that joins both would be merged.
            known = left + right not in self.score and self.merged(left + right) == [left, right]
            self._stays[pair] = known
        return known

    def reachable(self, piece: str) -> bool:
        known = self._self.get(piece)
        if known is None:
            known = self._self[piece] = self.merged(piece) == [piece]
        return known

    def pieces(self, text: str) -> list[str]:
        """The encoding of ``text`` (space signs in place, not empty) as pieces."""
        # last[i]: the piece that ends the encoding of the first i characters.
        last: list[str | None] = [None] * (len(text) + 1)
        stays = self._stays
        for place, (piece, size) in self.automaton.iter(text):
            end = place + 1
            if last[end]:
                continue  # at most one match fits; longer ones come first
            start = end - size
            if start:
                left = last[start] or text[start - 1]
                fits = stays.get((left, piece))
                if fits or fits is None and self.stays(left, piece):
                    last[end] = piece
            elif self.reachable(piece):
                last[end] = piece
        out, end = [], len(text)
        while end:
            piece = last[end] or text[end - 1]
            out.append(piece)
            end -= len(piece)
        out.reverse()
        return out

    def packed(self, segment: str) -> bytes:
        """Ids of ``segment`` as little-endian 32-bit bytes; unknown characters fall back to bytes."""
        return b"".join([
            self.packed_id.get(piece) or packed_ids([self.byte[b] for b in piece.encode()]) for piece in self.pieces(segment)
        ])


class Encoder(dict):
    """Texts to ids as little-endian 32-bit bytes; as a dict, segments to their bytes."""

    def __init__(self, model: PieceModel, begin: int, end: int):
        super().__init__()
        self.model, self.begin, self.end = model, packed_ids([begin]), packed_ids([end])
        self.older: dict[str, bytes] = {}

    def __missing__(self, segment: str) -> bytes:
        packed = self.older.get(segment) or self.model.packed(segment)
        if len(segment) <= CACHED_LENGTH:
            if len(self) >= CACHED_SEGMENTS:
                self.older = dict(self)
                self.clear()
            self[segment] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids with begin and end; a text that is not empty gets a space in front."""
        body = b""
        if text:
            signs = SPACE + text.replace(" ", SPACE)
            body = b"".join(map(self.__getitem__, self.model.segments.findall(signs)))
        return self.begin + body + self.end

    def decode(self, packed: bytes) -> bytes:
        """The text of ids in UTF-8: control ids and the space in front go, stray bytes become U+FFFD."""
        ids = array("I")
        ids.frombytes(packed)
        if sys.byteorder == "big":
            ids.byteswap()
        table = self.model.bytes_of
        plain = [i for i in ids if table[i] is not None]
        text = b"".join([table[i] for i in plain])
        # A space that fell back to its byte isn't the one in front.
        if text[:1] == b" " and plain[0] != self.model.byte.get(32):
            text = text[1:]
        try:
            text.decode()
        except UnicodeDecodeError:
            text = text.decode(errors="replace").encode()
        return text


def packed_ids(ids: list[int]) -> bytes:
    return b"".join([i.to_bytes(4, "little") for i in ids])


def read_pieces(path: str) -> tuple[list[tuple[str, float, int]], int, int]:
    """Pieces of a model file with the settings supported here, and the begin and end ids."""
    from sentencepiece import sentencepiece_model_pb2 as formats

    proto = formats.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    norm, trained = proto.normalizer_spec, proto.trainer_spec
    if (
        trained.model_type != 2 or norm.name != "identity" or not norm.add_dummy_prefix or norm.remove_extra_whitespaces
        or not norm.escape_whitespaces or trained.treat_whitespace_as_suffix or not trained.byte_fallback
    ):
        raise ValueError("only merge-type models with byte fallback, no normalisation and a space in front are supported")
    return [(p.piece, p.score, p.type) for p in proto.pieces], trained.bos_id, trained.eos_id


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a model file, one per worker process."""
    if path not in _ENCODERS:
        pieces, begin, end = read_pieces(path)
        _ENCODERS[path] = Encoder(PieceModel(pieces), begin, end)
    return _ENCODERS[path]


def digests(path: str, texts: Iterator[str]) -> Iterator[tuple[int, str, str]]:
    """(number of ids, SHA-256 of the ids, SHA-256 of the decoded text) per text."""
    work = encoder(path)
    for text in texts:
        packed = work.encode(text)
        yield len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(work.decode(packed)).hexdigest()
