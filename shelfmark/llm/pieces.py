"""SentencePiece encoding that keeps track of the original bytes.

A text is normalised by the longest prefixes that the model's compiled
character map knows; each replacement is recorded, so that every position of the
normalised text leads back to the source. The library merges the normalised text
into pieces, and these are projected to spans of the source's bytes.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from dataclasses import dataclass
from itertools import compress

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame

from shelfmark.llm.frames import append_columns

SPACE = "▁"
codecs.register_error("one-by-one", lambda e: ("�", e.start + 1))


class CharacterMap:
    """A compiled character map: a double-array trie of byte prefixes and their replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.texts = blob[4 + size :]
        #: first bytes of any known prefix
        self.first = bytes(b for b in range(256) if self._step(self._root(), b)) if size else b""
        self.known = re.compile(b"[" + re.escape(self.first) + b"]") if self.first else None

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _root(self) -> int:
        return self._offset(self.units[0])

    def _step(self, node: int, byte: int) -> int | None:
        """The unit reached by ``byte``, if there is one."""
        at = node ^ byte
        if at < len(self.units) and self.units[at] & 0x800000FF == byte:
            return at
        return None

    def longest(self, data: bytes, start: int) -> tuple[int, str] | None:
        """Length and replacement of the longest known prefix of ``data[start:]``."""
        node, found = self._root(), None
        for i in range(start, len(data)):
            at = self._step(node, data[i])
            if at is None:
                break
            node = at ^ self._offset(self.units[at])
            if self.units[at] >> 8 & 1:
                found = i - start + 1, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        length, text = found
        return length, self.texts[text : self.texts.index(b"\0", text)].decode()


@dataclass
class Normalised:
    """A normalised text and, for each of its characters, the source characters behind it.

    ``starts`` and ``ends`` are None where the text is the source's own, character
    by character. The dummy prefix, if any, stands before them.
    """

    text: str
    dummy: int
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None

    def source(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The source characters behind ranges of ``text``."""
        starts, ends = np.maximum(starts - self.dummy, 0), np.maximum(ends - self.dummy, 0)
        if self.starts is None:
            return starts, ends
        if not len(self.starts):
            return starts * 0, ends * 0
        some = ends > starts
        first = self.starts[np.minimum(starts, len(self.starts) - 1)]
        return first, np.where(some, self.ends[np.maximum(ends - 1, 0)], first)


@dataclass
class Model:
    """What encoding and decoding need of a SentencePiece model file."""

    merger: bytes  # the model file without its normalisation
    plain: frozenset[int]  # ids of pieces that aren't bytes or control marks
    end: int
    surfaces: list[bytes]
    lengths: list[int]  # normalised characters that a piece consumes
    character_map: bytes
    dummy_prefix: bool
    trim: bool
    escape: bool

    @classmethod
    def from_file(cls, path: str) -> Model:
        from sentencepiece import sentencepiece_model_pb2 as files

        proto = files.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        spec, pieces = proto.normalizer_spec, list(proto.pieces)
        kinds = files.ModelProto.SentencePiece
        if any(p.type == kinds.USER_DEFINED for p in pieces) or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("user-defined pieces and white space as suffix are not read")
        if not proto.trainer_spec.byte_fallback:
            raise ValueError("only models with byte pieces are read")
        surfaces, lengths = [], []
        for p in pieces:
            if p.type == kinds.BYTE:
                byte = int(p.piece[3:5], 16)
                surfaces.append(bytes([byte]))
                lengths.append(int(byte & 0xC0 != 0x80))
            elif p.type == kinds.UNKNOWN:
                surfaces.append(proto.trainer_spec.unk_surface.encode())
                lengths.append(1)
            elif p.type == kinds.CONTROL:
                surfaces.append(b"")
                lengths.append(0)
            else:
                surfaces.append(p.piece.replace(SPACE, " ").encode())
                lengths.append(len(p.piece))
        character_map, dummy_prefix, trim = spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces
        spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces = b"", False, False
        return cls(
            proto.SerializeToString(), frozenset(i for i, p in enumerate(pieces) if p.type == kinds.NORMAL),
            next(i for i, p in enumerate(pieces) if p.piece == (proto.trainer_spec.eos_piece or "</s>")),
            surfaces, lengths, character_map, dummy_prefix, trim, spec.escape_whitespaces,
        )


class Codec:
    """Encoding and decoding with a model; one for each task."""

    def __init__(self, model: Model):
        self.model = model
        self.map = CharacterMap(model.character_map)
        self.space = SPACE if model.escape else " "
        self.merger = sentencepiece.SentencePieceProcessor(model_proto=model.merger)
        self.lengths = np.array(model.lengths, np.int64)
        self.silent = frozenset(i for i, s in enumerate(model.surfaces) if not s)

    # Normalisation

    def normalise(self, text: str) -> Normalised:
        """The normalised text and what it came from; an empty text stays empty."""
        if not text:
            return Normalised("", 0)
        starts = ends = None
        if self.map.known:
            text, starts, ends = self._mapped(text)
        if self.model.trim:
            if starts is None:
                starts = np.arange(len(text))
                ends = starts + 1
            text, starts, ends = _trimmed(text, starts, ends)
        dummy = int(self.model.dummy_prefix and (bool(text) or not self.model.trim))
        return Normalised((" " * dummy + text).replace(" ", self.space), dummy, starts, ends)

    def _mapped(self, text: str) -> tuple[str, np.ndarray, np.ndarray]:
        """The longest known prefixes replaced, all else kept."""
        data, out, starts, ends = text.encode(), [], [], []
        at = copied = source = 0  # bytes, bytes, source characters

        def keep(to: int) -> None:
            nonlocal source
            plain = data[copied:to].decode()
            here = np.arange(source, source + len(plain))
            out.append(plain)
            starts.append(here)
            ends.append(here + 1)
            source += len(plain)

        while (hit := self.map.known.search(data, at)):
            found = self.map.longest(data, hit.start())
            if found is None:  # one whole character further
                at = hit.start() + 1
                while at < len(data) and data[at] & 0xC0 == 0x80:
                    at += 1
                continue
            keep(hit.start())
            length, new = found
            at = copied = hit.start() + length
            taken = len(data[hit.start() : at].decode())
            out.append(new)
            starts.append(np.full(len(new), source))
            ends.append(np.full(len(new), source + taken))
            source += taken
        keep(len(data))
        return "".join(out), np.concatenate(starts), np.concatenate(ends)

    # Encoding

    def encode_arrays(self, text: str | None) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Ids of the whole text with the end id, and where each one's source bytes start and end.

        All byte pieces of one character have the span of that character; the end
        id has the empty span at the end. A null text counts as empty.
        """
        text = text or ""
        normalised = self.normalise(text)
        ids = self.merger.encode(normalised.text)
        taken = self.lengths[np.array(ids, np.int64)]
        ends = np.cumsum(taken)
        starts = ends - taken
        if not taken.all():  # later bytes look back to the first
            first = np.maximum.accumulate(np.where(taken > 0, np.arange(len(taken)), 0))
            starts, ends = starts[first], ends[first]
        starts, ends = normalised.source(starts, ends)
        size = len(text)
        if not text.isascii():
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            widths = (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF) + 1
            offsets = np.zeros(size + 1, np.int64)
            np.cumsum(widths, out=offsets[1:])
            starts, ends, size = offsets[starts], offsets[ends], int(offsets[-1])
        return [*ids, self.model.end], np.append(starts, size), np.append(ends, size)

    def encode(self, text: str | None) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids and their spans of source bytes, as pairs."""
        ids, starts, ends = self.encode_arrays(text)
        return ids, list(zip(starts.tolist(), ends.tolist()))

    # Decoding

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: control ids are silent, bytes that form no character become U+FFFD."""
        surfaces, plain = self.model.surfaces, self.model.plain
        runs = [ids]
        if not self.silent.isdisjoint(ids[:-1]):  # bytes on both sides of a control id are apart
            cuts = [i for i, x in enumerate(ids) if x in self.silent]
            runs = [ids[a + 1 : b] for a, b in zip([-1, *cuts], [*cuts, len(ids)])]
        text = "".join([b"".join([surfaces[i] for i in r]).decode("utf-8", "one-by-one") for r in runs])
        first = next((i for i in ids if surfaces[i]), None)
        return text[1:] if self.model.dummy_prefix and text[:1] == " " and first in plain else text


def _trimmed(text: str, starts: np.ndarray, ends: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """Spaces dropped at both ends and after a space."""
    space = np.frombuffer(text.encode("utf-32-le"), np.uint32) == ord(" ")
    words = np.flatnonzero(~space)
    if not len(words):
        return "", starts[:0], ends[:0]
    keep = ~space | np.append(~space[1:], False)
    keep[: words[0]] = keep[words[-1] + 1 :] = False
    return "".join(compress(text, keep.tolist())), starts[keep], ends[keep]


PIECES = "ids array<int>, spans array<struct<start:int,end:int>>, decoded string"


def with_pieces(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, ``spans`` of source bytes, and the text ``decoded`` from the ids.

    A null or empty text has the end id only. The model is broadcast: its size is
    that of a vocabulary file. Columns of ``docs`` that bear these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        codec = Codec(shared.value)

        def batch(texts):
            found = [codec.encode(t) for t in texts]
            return [[f[0] for f in found], [f[1] for f in found], [codec.decode(f[0]) for f in found]]
        return batch

    return append_columns(docs, text, start, PIECES)


def digests(docs: DataFrame, model: Model, text: str = "text", with_ids: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens, ids_sha256, decoded_sha256, covered``, and ``ids`` if wanted.

    ``covered`` is the number of source bytes inside at least one span; it equals
    the length of the text where the map drops nothing. A null text counts as empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        codec = Codec(shared.value)
        numbers = [str(i) for i in range(len(codec.model.surfaces))]

        def one(value):
            ids, starts, ends = codec.encode_arrays(value)
            reached = np.maximum.accumulate(ends)
            new = ends - np.maximum(starts, np.append(0, reached[:-1]))
            return (
                len(ids), hashlib.sha256(" ".join([numbers[i] for i in ids]).encode()).hexdigest(),
                hashlib.sha256(codec.decode(ids).encode()).hexdigest(), int(np.maximum(new, 0).sum()),
                *([np.array(ids, np.int32)] if with_ids else []),
            )

        return lambda texts: list(zip(*map(one, texts))) if texts else [[]] * (4 + with_ids)

    return append_columns(
        docs, text, start, "n_tokens bigint, ids_sha256 string, decoded_sha256 string, covered bigint"
        + ", ids array<int>" * with_ids
    )
