"""SentencePiece encoding and decoding with the pieces and scores of a model file.

An Aho-Corasick automaton over all pieces goes through the text once. At each place it reports the pieces that end
there (the longest at the automaton's state, shorter ones along its output links), and each relaxes
the best score of the place behind it: a Viterbi search for the segmentation with the highest sum of scores.
Characters in no piece count as unknown and become byte pieces where the model has them.

No piece of the usual vocabularies has a word mark behind another character, so a best segmentation of the whole
text is made of best segmentations of its words, and repeated words are looked up. If a
vocabulary has such a piece, the text is one unit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

#: The mark that stands for a space.
MARK = "▁"
# Numbers of the piece types in a model file; how much worse an unknown character is than any piece.
NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6
UNKNOWN_PENALTY = 10.0
#: Words kept with their pieces at a time, and the length up to which they are.
_CACHE, _CACHED_CHARS = 1 << 16, 64
#: Rows whose ids are given back at a time: ids take more memory than their text.
_ROWS = 200
_NEVER = float("-inf")


@dataclass(frozen=True)
class PieceModel:
    """Pieces of a model, in the order of their ids. Small (the size of the vocabulary) and sent to executors."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    types: tuple[int, ...]
    dummy_prefix: bool
    byte_fallback: bool

    @staticmethod
    def load(path: str) -> PieceModel:
        """Read a model file on the driver. Models that rewrite characters or blanks are turned down."""
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        rules = proto.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models that keep the text as it is can be used")
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models with the space mark behind words cannot be used")
        return PieceModel(
            tuple(p.piece for p in proto.pieces),
            tuple(p.score for p in proto.pieces),
            tuple(p.type for p in proto.pieces),
            rules.add_dummy_prefix,
            proto.trainer_spec.byte_fallback,
        )


class Encoder:
    """A model made ready to encode and decode."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.automaton = ahocorasick.Automaton()
        text_pieces = [i for i, kind in enumerate(model.types) if kind in (NORMAL, USER_DEFINED) and model.pieces[i]]
        for i in text_pieces:
            self.automaton.add_word(model.pieces[i], (len(model.pieces[i]), model.scores[i], i))
        if text_pieces:
            self.automaton.make_automaton()
        self.empty = not text_pieces
        self.single = {model.pieces[i] for i in text_pieces if len(model.pieces[i]) == 1}
        self.unknown_score = min((model.scores[i] for i in text_pieces), default=0.0) - UNKNOWN_PENALTY
        self.lengths = [len(piece) for piece in model.pieces]
        self.unknown_id = next((i for i, kind in enumerate(model.types) if kind == UNKNOWN), 0)
        by_words = not any(MARK in model.pieces[i].lstrip(MARK) for i in text_pieces)
        self.units = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if by_words else "(?s).+").findall
        # two generations: when the young one is full it becomes the old one, so frequent words stay
        self.young: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}

    @cached_property
    def byte_ids(self) -> dict[int, int]:
        return {int(self.model.pieces[i][1:-1], 16): i for i, kind in enumerate(self.model.types) if kind == BYTE}

    @cached_property
    def surface(self) -> list[bytes]:
        """What each id stands for in a decoded text; control pieces for nothing."""
        out = []
        for piece, kind in zip(self.model.pieces, self.model.types):
            if kind == BYTE:
                out.append(bytes([int(piece[1:-1], 16)]))
            elif kind in (NORMAL, USER_DEFINED):
                out.append(piece.replace(MARK, " ").encode())
            else:
                out.append(" ⁇ ".encode() if kind == UNKNOWN else b"")
        return out

    def _segment(self, unit: str) -> list[int]:
        """Ids of the best segmentation of a unit; of equal ones, that with the longer last pieces."""
        n = len(unit)
        # best[i] is the best score up to and with character i; best[-1], the last, is that of nothing
        best = [_NEVER] * n + [0.0]
        back = [-1] * n  # the piece that ends here; -1 for an unknown character
        if self.single.issuperset(unit):
            for end, (length, score, piece) in self.automaton.iter(unit):
                total = best[end - length] + score
                if total > best[end]:
                    best[end] = total
                    back[end] = piece
        else:
            at = 0
            for end, (length, score, piece) in () if self.empty else self.automaton.iter(unit):
                self._pass_unknown(unit, best, back, at, end)
                at = end
                total = best[end - length] + score
                if total > best[end]:
                    best[end], back[end] = total, piece
            self._pass_unknown(unit, best, back, at, n)
        ids: list[int] = []
        end = n - 1
        while end >= 0:
            piece = back[end]
            if piece >= 0:
                ids.append(piece)
                end -= self.lengths[piece]
                continue
            if self.model.byte_fallback:
                ids += (self.byte_ids[b] for b in reversed(unit[end].encode()))
            elif not ids or ids[-1] != self.unknown_id:
                ids.append(self.unknown_id)
            end -= 1
        ids.reverse()
        return ids

    def _pass_unknown(self, unit: str, best: list[float], back: list[int], at: int, upto: int) -> None:
        """Relax places at to upto - 1, all of whose pieces are known, by the way of an unknown character."""
        for i in range(at, upto):
            if unit[i] not in self.single:
                total = best[i - 1] + self.unknown_score
                if total > best[i]:
                    best[i], back[i] = total, -1

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        marked = text.replace(" ", MARK)
        if self.model.dummy_prefix:
            marked = MARK + marked
        ids: list[int] = []
        young = self.young
        for unit in self.units(marked):
            found = young.get(unit)
            if found is None:
                found = self.old.get(unit) or self._segment(unit)
                if len(unit) <= _CACHED_CHARS:
                    if len(young) >= _CACHE:
                        self.old, self.young = young, {}
                        young = self.young
                    young[unit] = found
            ids += found
        return ids

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


@lru_cache(maxsize=1)
def _encoder(model: PieceModel) -> Encoder:
    """One encoder per worker: tasks that follow each other there find the words of the ones before."""
    return Encoder(model)


def encode(docs: DataFrame, model: PieceModel, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, ids (ARRAY<INT>), n_tokens (BIGINT), round_trip (BOOLEAN).

    `round_trip` tells whether decoding the ids gives the text again; only a text that holds the space mark
    itself (it decodes to a space) does not. An empty text has no ids, a NULL one has NULL ids, 0
    tokens and a NULL round trip. Texts of any length are encoded whole. Repeated rows stay repeated; an empty
    table gives an empty result. Other columns are neither read nor returned.
    """

    @F.pandas_udf("ids array<int>, round_trip boolean")
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(model)
        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                found, same = [], []
                for value in batch.iloc[at : at + _ROWS]:
                    ids = None if value is None else encoder.encode(value)
                    same.append(None if value is None else encoder.decode(ids) == value)
                    found.append(None if ids is None else np.array(ids, dtype=np.int32))
                yield pd.DataFrame({"ids": pd.Series(found, dtype=object), "round_trip": pd.Series(same, dtype=object)})

    rows = docs.select(F.col(id_col).alias(id_col), pieces(F.col(text)).alias("found"))
    return rows.select(
        id_col,
        "found.ids",
        F.coalesce(F.size("found.ids"), F.lit(0)).cast("long").alias("n_tokens"),
        "found.round_trip",
    )


def decode(ids: Column, model: PieceModel) -> Column:
    """Text of an ids column; NULL for NULL. Ids outside the vocabulary are an error."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(model)
        for batch in batches:
            yield pd.Series([None if x is None else encoder.decode(x.tolist()) for x in batch], dtype=object)

    return texts(ids)
