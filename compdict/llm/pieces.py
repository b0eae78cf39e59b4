"""Exact SentencePiece encoding (merge type) by backtracking, and decoding.

The model's own library only supplies the vocabulary; encoding and decoding are done here.
A sequence of pieces is the encoding of a text exactly when each adjacent pair stays apart
under re-merging and its first piece is whole, so the encoder takes the longest match at a
position, checks it against the piece before it, falls back to shorter matches, and marks
positions that cannot be a border.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from compdict.llm.common import held, ship, slices

SPACE = "▁"
# Latin, Greek and Cyrillic letters; ASCII punctuation.
LETTERS, MARKS = r"A-Za-zÀ-ÖØ-öø-ʯͰ-ϿЀ-ӿ", r"!-/:-@\[-`{-~"
# Cached chunks and pairs in a worker; a full cache is emptied.
CACHE = 200_000
CACHE_CHARS = 48


def chunk_pattern(pieces) -> str:
    """A pattern whose matches cut a text only where no piece of the vocabulary reaches across.

    Cuts before a space symbol, around a line feed, and between a letter and ASCII punctuation,
    each only if no piece has such a pair of characters inside.
    """
    inside = {a + b for p in pieces for a, b in zip(p, p[1:])}
    if any(b == SPACE != a for a, b in inside):
        return "(?s:.+)"
    if any("\n" in pair for pair in inside):
        return f"{SPACE}*[^{SPACE}]+|{SPACE}+"
    rest = rf"{SPACE}*[^{SPACE}\n]+|\n|{SPACE}+"
    if any(re.fullmatch(f"[{LETTERS}][{MARKS}]", pair) for pair in inside):
        return rest
    return rf"{SPACE}*+[{MARKS}]*+[{LETTERS}]++(?![^{LETTERS}{MARKS}{SPACE}\n])|{rest}"


class Vocabulary:
    """Pieces, scores and byte pieces of a model file; chunks that no piece crosses."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        self.byte_value = {i: int(p[3:5], 16) for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.byte_id = {v: i for i, v in self.byte_value.items()}
        self.unknown = model.unk_id()
        self.special = {i for i, s in enumerate(special) if s}
        self.id = {p: i for i, p in enumerate(self.pieces) if not special[i] and i not in self.byte_value}
        self.score = {p: model.get_score(i) for p, i in self.id.items()}
        self.chunk = re.compile(chunk_pattern(self.id))
        self.matches = ahocorasick.Automaton()
        for p in self.id:
            self.matches.add_word(p, len(p))
        self.matches.make_automaton()

    def chunks(self, text: str) -> list[str]:
        """The text as the model sees it: one space before it, spaces as their symbol."""
        return self.chunk.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def ids_of(self, piece: str) -> list[int]:
        at = self.id.get(piece)
        if at is not None:
            return [at]
        return [self.byte_id.get(b, self.unknown) for b in piece.encode()]


class Codec:
    def __init__(self, path: str):
        self.v = Vocabulary(path)
        self.said = [p.replace(SPACE, " ") for p in self.v.pieces]
        self.plain = set(self.v.id.values())
        self._pairs: dict[tuple[str | None, str], bool] = {}
        self._shorter: dict[str, str | None] = {}
        self._whole: dict[str, bool] = {}
        self._chunks: dict[str, tuple[str, str]] = {}

    def merge(self, text: str) -> list[str]:
        """Plain merging: the adjacent pair whose union has the best score first, leftmost of equals."""
        score, parts = self.v.score, list(text)
        while True:
            best, at = None, -1
            for i, s in enumerate([score.get(a + b) for a, b in zip(parts, parts[1:])]):
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def whole(self, piece: str) -> bool:
        known = self._whole.get(piece)
        if known is None:
            known = self._whole[piece] = self.merge(piece) == [piece]
        return known

    def compatible(self, left: str | None, right: str) -> bool:
        """Whether two pieces stay apart, or a first piece whole, when their characters are merged."""
        if len(self._pairs) >= CACHE:
            self._pairs.clear()
        apart = self.whole(right) if left is None else self.merge(left + right) == [left, right]
        self._pairs[left, right] = apart
        return apart

    def shorter(self, piece: str) -> str | None:
        """The next shorter prefix that is a piece or a single character."""
        if piece not in self._shorter:
            n = len(piece) - 1
            while n > 1 and piece[:n] not in self.v.id:
                n -= 1
            self._shorter[piece] = piece[:n] if n else None
            if len(self._shorter) > CACHE:
                self._shorter.clear()
                return piece[:n] if n else None
        return self._shorter[piece]

    def split(self, chunk: str) -> list[str]:
        """The chunk's pieces by backtracking."""
        if chunk in self.v.id and self.whole(chunk):
            return [chunk]
        n = len(chunk)
        longest = [1] * n
        for end, length in self.v.matches.iter(chunk):
            start = end - length + 1
            if length > longest[start]:
                longest[start] = length
        failed = bytearray((n >> 3) + 1)
        pairs, out = self._pairs, []
        at, before, piece = 0, None, chunk[: longest[0]]
        while at < n:
            while piece:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    fits = pairs.get((before, piece))
                    if self.compatible(before, piece) if fits is None else fits:
                        break
                piece = self.shorter(piece)
            if piece:
                out.append(piece)
                at, before = end, piece
                if at < n:
                    piece = chunk[at : at + longest[at]]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= len(piece)
                before = out[-1] if out else None
                piece = self.shorter(piece)
        return out

    def encode(self, text: str) -> list[int]:
        return [i for c in self.v.chunks(text) for p in self.split(c) for i in self.v.ids_of(p)]

    def spell(self, ids: list[int]) -> str:
        """The pieces of the ids in a row; runs of byte pieces are read as UTF-8."""
        if self.plain.issuperset(ids):
            return "".join([self.said[i] for i in ids])
        out, run = [], bytearray()
        for i in ids:
            value = self.v.byte_value.get(i)
            if value is not None:
                run.append(value)
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            if i not in self.v.special:
                out.append(self.said[i])
            elif i == self.v.unknown:
                out.append(" ⁇ ")
        if run:
            out.append(_utf8(bytes(run)))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; the space that encoding puts first is taken off again."""
        said = self.spell(ids)
        return said[1:] if said.startswith(" ") else said

    def _chunk(self, chunk: str) -> tuple[str, str]:
        ids = [i for p in self.split(chunk) for i in self.v.ids_of(p)]
        made = ",".join(map(str, ids)), self.spell(ids)
        if len(chunk) <= CACHE_CHARS:
            if len(self._chunks) >= CACHE:
                self._chunks.clear()
            self._chunks[chunk] = made
        return made

    def round_trip(self, text: str) -> tuple[str, str]:
        """Ids joined by commas, and the text they decode to."""
        get, new = self._chunks.get, self._chunk
        both = [get(c) or new(c) for c in self.v.chunks(text)]
        said = "".join([b[1] for b in both])
        return ",".join([b[0] for b in both]), said[1:] if said.startswith(" ") else said


def _utf8(run: bytes) -> str:
    """Each byte that is not part of a character becomes one replacement character."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for n in (1, 2, 3, 4):
                try:
                    out.append(run[at : at + n].decode())
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


def codec(path: str) -> Codec:
    """One codec a worker process and model."""
    return held(("codec", path), lambda: Codec(path))


def encode(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text", full: bool = True) -> DataFrame:
    """Encode every whole text and decode it again.

    Returns the ID, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, with ``full``,
    ``ids`` and ``decoded`` themselves.  A null text counts as empty: no ids, an empty decoded
    text.  Rows stay as they are: repeated rows and null IDs give a row each, in the task that
    reads them; other columns of ``docs`` are not carried.  Texts of any length are encoded whole.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (
        ", ids array<int>, decoded string" if full else ""
    )

    def run(batches):
        c = codec(model)
        for batch in slices(batches):
            n, shas, backs, lists, said = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                ids, decoded = c.round_trip(text or "")
                n.append(ids.count(",") + 1 if ids else 0)
                shas.append(hashlib.sha256(ids.encode()).hexdigest())
                backs.append(hashlib.sha256(decoded.encode()).hexdigest())
                if full:
                    lists.append([int(i) for i in ids.split(",")] if ids else [])
                    said.append(decoded)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(shas, pa.string()), pa.array(backs, pa.string())]
            if full:
                columns += [pa.array(lists, pa.list_(pa.int32())), pa.array(said, pa.string())]
            names = [id_column, "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

    return ship(docs).select(id_column, text_column).mapInArrow(run, schema)
