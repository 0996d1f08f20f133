"""SentencePiece BPE: exact encoding by backtracking over longest matches, and decoding.

The library merges, again and again, the adjacent pair whose joined piece has the best score (leftmost on ties).
A row of pieces is the result of that process exactly if each two neighbours, joined and merged anew, come out as the
same two pieces. So the encoder walks forward: an Aho-Corasick automaton over the reachable pieces gives the longest
piece at every place; a piece is taken if it is compatible with the one before; if not, its next shorter prefix piece
is tried; if none is left, the place is marked as failed in a bitfield and the last piece is shortened instead. No
place fails twice, so the work is linear in the text.

Where no piece of the vocabulary holds a blank mark behind another character, a line end, or a letter before
a full stop or comma, nothing can merge over those places. Texts are then cut there, and the ids of a cut are remembered in a
bounded table. The driver finds the reachable pieces and their prefixes once and sends them; a task builds its automaton from
them and lets go of it, and of what it remembers, when it ends, so nothing stays in a worker that other stages use again.

Nulls encode as empty text. Empty text gives the begin and end ids only and decodes to empty text. Repeated rows and
null ids are kept as they are; a column of the input that clashes with a result column is replaced by the result.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MARK = "▁"
LETTERS = "a-zA-ZÀ-ÖØ-öø-ÿ"
REMEMBERED = 100_000


NONE = -1


class PieceModel:
    """Pieces, scores and kinds of a SentencePiece BPE model with identity normalisation and byte fallback."""

    def __init__(self, proto: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        model.ParseFromString(proto)
        rules, kinds = model.normalizer_spec, pb.ModelProto.SentencePiece
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback:
            raise ValueError("only BPE models with byte fallback are supported")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models that keep the text as it is are supported")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.unknown, self.unknown_surface = model.trainer_spec.unk_id, model.trainer_spec.unk_surface
        self.dummy_prefix = rules.add_dummy_prefix
        self.begin, self.end = model.trainer_spec.bos_id, model.trainer_spec.eos_id
        self.pieces = [p.piece for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.byte_ids = [0] * 256
        self.bytes_of: dict[int, int] = {}
        for i, p in enumerate(model.pieces):
            if p.type == kinds.BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_ids[value], self.bytes_of[i] = i, value
        self.silent = {i for i, p in enumerate(model.pieces) if p.type == kinds.CONTROL}
        inner = re.compile(rf"[^{MARK}]{MARK}|\n|[{LETTERS}][.,]")
        self.cuttable = not any(inner.search(p) for p in self.ids)
        reachable = {p for p in self.ids if len(p) == 1 or self.merged(p) == [p]}
        #: For every reachable piece its longest proper prefix that is reachable, or NONE.
        self.prefixes = {self.ids[p]: next((self.ids[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in reachable), NONE) for p in reachable}

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by plain merging. Defines compatibility; the encoder calls it on pairs only."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]


class PieceEncoder:
    """Backtracking encoder and decoder of one model, for one task. Pieces are numbers; NONE is a character outside."""

    NONE = NONE

    def __init__(self, model: PieceModel, remembered: int = REMEMBERED):
        self.model, self.remembered = model, remembered
        self.automaton = ahocorasick.Automaton()
        self.shorter, self.length = [self.NONE] * len(model.pieces), [1] * (len(model.pieces) + 1)
        for number, prefix in model.prefixes.items():
            piece = model.pieces[number]
            self.automaton.add_word(piece, (len(piece) - 1, number))
            self.length[number], self.shorter[number] = len(piece), prefix
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.units: dict[str, bytes] = {}
        self.codes = [i.to_bytes(4, "little") for i in range(len(model.pieces))]
        self.high = np.zeros(len(model.pieces), bool)
        self.surface = list(model.pieces)
        for i, value in model.bytes_of.items():
            self.high[i] = value > 127
            self.surface[i] = chr(value) if value < 128 else ""
        for i in model.silent:
            self.surface[i] = ""
        self.surface[model.unknown] = model.unknown_surface
        words = rf"{MARK}*(?:[{LETTERS}]+(?=[.,])|[^{MARK}\n]+)|{MARK}+|\n+"
        self.cut = re.compile(words).findall if model.cuttable else lambda text: [text]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two pieces stay apart when merged anew."""
        if len(self.pairs) >= self.remembered:
            self.pairs.clear()
        pieces = [self.model.pieces[left], self.model.pieces[right]]
        fits = self.pairs[left << 32 | right] = self.model.merged("".join(pieces)) == pieces
        return fits

    def longest(self, text: str) -> list[int]:
        """The longest piece that begins at each place: the automaton reports matches by their ends."""
        found = [self.NONE] * len(text)
        for stop, (back, number) in self.automaton.iter(text):
            found[stop - back] = number  # a later match from the same place ends later, so it is longer
        return found

    def split(self, text: str) -> list[int]:
        """Pieces of a text by number; a character outside the vocabulary merges with nothing."""
        longest, end, none = self.longest(text), len(text), self.NONE
        known, shorter, length, compatible = self.pairs.get, self.shorter, self.length, self.compatible
        failed = bytearray(end // 8 + 1)
        out: list[int] = []
        last, at = none, 0
        while at < end:
            piece = longest[at]
            fits = piece == none
            while True:
                if not fits:
                    stop = at + length[piece]
                    if not failed[stop >> 3] >> (stop & 7) & 1:
                        fits = last == none or known(last << 32 | piece)
                        if fits is None:
                            fits = compatible(last, piece)
                if fits:
                    out.append(piece)
                    at += length[piece]
                    last = piece
                    break
                piece = shorter[piece]
                while piece == none:
                    failed[at >> 3] |= 1 << (at & 7)
                    dropped = out.pop()
                    at -= length[dropped]
                    piece = shorter[dropped]
                    last = out[-1] if out else none
        return out

    def unit(self, text: str) -> bytes:
        """Ids of one cut as little-endian 32-bit integers."""
        codes, pieces = self.codes, self.split(text)
        if self.NONE not in pieces:
            packed = b"".join([codes[x] for x in pieces])
        else:
            parts, at = [], 0
            for x in pieces:
                parts.append(codes[x] if x != self.NONE else self.spelled(text[at]))
                at += self.length[x]
            packed = b"".join(parts)
        if len(text) <= 64:
            if len(self.units) >= self.remembered:
                self.units.clear()
            self.units[text] = packed
        return packed

    def spelled(self, character: str) -> bytes:
        """Byte pieces of a character outside the vocabulary."""
        return b"".join(self.model.byte_ids[b].to_bytes(4, "little") for b in character.encode())

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text with begin and end, packed as little-endian unsigned 32-bit integers."""
        ends = np.array([self.model.begin, self.model.end], "<u4").tobytes()
        if not text:
            return ends
        escaped = (MARK if self.model.dummy_prefix else "") + text.replace(" ", MARK)
        known, unit = self.units.get, self.unit
        return ends[:4] + b"".join([known(x) or unit(x) for x in self.cut(escaped)]) + ends[4:]

    def decode(self, packed: bytes) -> str:
        """Text of packed ids: marks become blanks, the one in front goes, runs of byte pieces are read as UTF-8."""
        ids = np.frombuffer(packed, "<u4")
        surface, high = self.surface, self.high[ids]
        if not high.any():
            text = "".join([surface[i] for i in ids.tolist()])
        else:
            parts: list[str] = []
            edges = np.flatnonzero(np.diff(np.r_[False, high, False].astype(np.int8)))
            done = 0
            for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                parts += [surface[i] for i in ids[done:start].tolist()]
                parts.append(utf8(bytes(self.model.bytes_of[i] for i in ids[start:stop].tolist())))
                done = stop
            text = "".join(parts + [surface[i] for i in ids[done:].tolist()])
        if self.model.dummy_prefix and text.startswith(MARK):
            text = text[1:]
        return text.replace(MARK, " ")


def utf8(run: bytes) -> str:
    """Bytes as UTF-8; each byte that begins no whole character gives one replacement character."""
    out, at = [], 0
    while at < len(run):
        try:
            out.append(run[at:].decode())
            break
        except UnicodeDecodeError as error:
            good = at + error.start
            out.append(run[at:good].decode() + "�")
            at = good + 1
    return "".join(out)


def encode_documents(
    docs: DataFrame, model_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Adds to the ``keep`` columns the packed ids of each whole text and the text decoded from them.

    ``ids`` is binary (little-endian unsigned 32-bit, begin and end ids included), ``decoded`` a string. The model
    file is read once on the driver and sent along; its size does not depend on the data.
    """
    spark = docs.sparkSession
    keep = tuple(c for c in keep if c not in ("ids", "decoded"))
    model = spark.sparkContext.broadcast(pickle.dumps(PieceModel(read_model(spark, model_path))))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(pickle.loads(model.value))
        for batch in batches:
            source = batch.column(len(keep))
            for start in range(0, len(source), 256):
                part = source.slice(start, 256).to_pylist()
                ids = [encoder.encode(x) for x in part]
                yield pa.record_batch(
                    [batch.column(i).slice(start, 256) for i in range(len(keep))]
                    + [pa.array(ids, pa.binary()), pa.array([encoder.decode(x) for x in ids], pa.string())],
                    [*keep, "ids", "decoded"],
                )

    return docs.select(*keep, docs[text].cast("string").alias("__text")).mapInArrow(run, schema)


def read_model(spark, path: str) -> bytes:
    """Bytes of a model file; a path with a scheme is read through Spark."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).first()["content"])
    with open(path, "rb") as file:
        return file.read()

