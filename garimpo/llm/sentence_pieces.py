"""Encoding into pieces of a SentencePiece file and decoding back.

An Aho-Corasick automaton over all pieces reads a text once.  At every place its
output links name the pieces that end there, each relaxes the best score of that
place, and the best path is read back from the end.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import tokenizer_file
from .shared import Recent, kept, slices

MARK = "▁"


class Pieces:
    """The pieces of a model file: segmentation of highest total score.

    Ties go to the longer last piece.  A character without a piece of its own may
    stand alone at ten below the least score and is written as its UTF-8 bytes'
    pieces (as the unknown piece where the file has none).  Text is taken as it is, with one mark in
    front, spaces as marks.
    """

    def __init__(self, model: str):
        read = sentencepiece.SentencePieceProcessor(model_file=model)
        self.automaton, self.bytes, self.text = ahocorasick.Automaton(), {}, []
        least, singles, inner, crossing = 0.0, set(), set(), False
        for i in range(read.get_piece_size()):
            piece = read.id_to_piece(i)
            if read.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.text.append(bytes([int(piece[3:5], 16)]))
            elif read.is_control(i) or read.is_unknown(i) or read.is_unused(i):
                self.text.append(" ⁇ ".encode() if read.is_unknown(i) else b"")
            else:
                score = read.get_score(i)
                self.automaton.add_word(piece, (len(piece), i, score))
                self.text.append(piece.replace(MARK, " ").encode())
                least = min(least, score)
                crossing |= bool(re.search(f"[^{MARK}]{MARK}", piece))
                if len(piece) == 1:
                    singles.add(piece)
                else:
                    inner |= set(piece)
        self.automaton.make_automaton()
        self.unknown, self.lone, self.singles = read.unk_id(), least - 10, singles
        # No piece runs from one word into the next, or over a break, so those are segmented alone.
        breaks = "".join(c for c in "\n\r\t" if c not in inner)
        self.unit = re.compile(".+" if crossing else f"{MARK}+[^{MARK}{breaks}]*|[^{MARK}{breaks}]+|[{breaks}{MARK}]", re.DOTALL)
        self.known = Recent()

    def units(self, text: str) -> list[str]:
        return self.unit.findall(MARK + text.replace(" ", MARK)) if text else []

    def segment(self, unit: str) -> list[int]:
        """Ids of the best path over one unit."""
        n = len(unit)
        score, back = [0.0] * (n + 1), [(0, -1)] * (n + 1)
        if self.singles.issuperset(unit):  # every place is a piece's end
            score[1:] = [float("-inf")] * n
            for end, (size, i, value) in self.automaton.iter(unit):
                got = score[end + 1 - size] + value
                if got > score[end + 1]:
                    score[end + 1], back[end + 1] = got, (end + 1 - size, i)
            ids = []
            while n:
                n, i = back[n]
                ids.append(i)
            return ids[::-1]
        reached = 0

        def alone(end: int) -> None:
            """Close places without a piece's end by a lone character."""
            score[end] = score[end - 1] + self.lone
            back[end] = (end - 1, -1)

        for end, (size, i, value) in self.automaton.iter(unit):
            end += 1
            while reached < end:
                reached += 1
                alone(reached)
                if unit[reached - 1] in self.singles:
                    score[reached] = float("-inf")
            got = score[end - size] + value
            if got > score[end]:
                score[end], back[end] = got, (end - size, i)
        while reached < n:
            reached += 1
            alone(reached)
        ids: list[int] = []
        while n:
            start, i = back[n]
            if i >= 0:
                ids.append(i)
            else:
                ids += [self.bytes.get(b, self.unknown) for b in reversed(unit[start:n].encode())]
            n = start
        return ids[::-1]

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.packed(text), dtype="<i4")

    def packed(self, text: str) -> bytes:
        """Ids of a text as 32-bit little-endian integers."""
        units, known = self.units(text), self.known
        try:
            return b"".join(map(known.young.__getitem__, units))
        except KeyError:  # units not met lately
            for unit in known.missing(units):
                known.add(unit, np.array(self.segment(unit), dtype="<i4").tobytes())
            return b"".join(map(known.young.__getitem__, units))

    def decode(self, ids: list[int] | np.ndarray) -> str:
        out = b"".join(map(self.text.__getitem__, ids))
        return out.removeprefix(b" ").decode(errors="replace")


def _pieces(model: str) -> Pieces:
    """The model's pieces, made once a worker process."""
    held = kept(model)
    if "pieces" not in held:
        held["pieces"] = Pieces(tokenizer_file(model))
    return held["pieces"]


def encode_pieces(texts: DataFrame, model: str, verify: bool = False) -> DataFrame:
    """All columns of ``texts`` and ids (array of int), n_ids: the pieces of column text.

    ``model`` is a public file's name, which each executor finds for itself, or a path.  Null and
    empty texts have no ids.  With ``verify`` also round_trip: whether decoding gives the text back (but
    for marks, which become spaces).  Columns of these names are replaced.  A batch leaves in slices
    of bounded size; a longer text is alone.
    """
    rest = [c for c in texts.columns if c not in ("ids", "n_ids", *["round_trip"] * verify)]

    def run(batches):
        pieces = _pieces(model)
        for batch in batches:
            texts_ = [t or "" for t in batch.column("text").to_pylist()]
            for low, high in slices(texts_):
                ids = [pieces.packed(t) for t in texts_[low:high]]
                offsets = np.r_[0, np.cumsum([len(x) // 4 for x in ids])].astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"), pa.int32())
                out = batch.slice(low, high - low).select(rest)
                out = out.append_column("ids", pa.ListArray.from_arrays(offsets, flat))
                out = out.append_column("n_ids", pa.array(np.diff(offsets).astype(np.int64)))
                if verify:
                    same = [
                        pieces.decode(np.frombuffer(x, "<i4").tolist()) == t.replace(MARK, " ") for x, t in zip(ids, texts_[low:high])
                    ]
                    out = out.append_column("round_trip", pa.array(same, pa.bool_()))
                yield out

    shape = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in rest)
    return texts.select(*rest).mapInArrow(run, f"{shape}, ids array<int>, n_ids long" + ", round_trip boolean" * verify)


def decode_pieces(rows: DataFrame, model: str, to: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and the text of column ids; null ids give null.

    Decoding undoes encoding but for marks (U+2581) in a text, which become spaces.
    """
    rest = [c for c in rows.columns if c != to]

    def run(batches):
        pieces = _pieces(model)
        for batch in batches:
            made = [pieces.decode(ids.values.to_pylist()) if ids.is_valid else None for ids in batch.column("ids")]
            yield batch.select(rest).append_column(to, pa.array(made, pa.string()))

    shape = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in rest)
    return rows.select(*rest).mapInArrow(run, f"{shape}, `{to}` string")


def checked(texts: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, n_ids and round_trip: whether decoding gives the text back (null as empty)."""
    return encode_pieces(texts.select("doc_id", "text"), model, verify=True).select("doc_id", "ids", "n_ids", "round_trip")
