"""SentencePiece encoding and decoding with an Aho-Corasick automaton over the pieces.

A text gets a space in front, spaces become the vocabulary's sign for them, and the
segmentation with the highest sum of piece scores is found in one pass (Viterbi): the
automaton runs over the characters once, and at every position its output links give all pieces
that end there, longest first, each of which may improve the best score of that position. Of
equal sums the one whose last piece is longer wins. A character that is no piece counts
``UNKNOWN`` below the lowest score and becomes one piece per UTF-8 byte.

No piece holds a space after another character or a line feed, so a text is cut there
first, and the pieces of a recurring part are looked up.

Decoding joins the pieces and drops the space in front: the text comes back exactly, except
that the vocabulary's own sign for a space comes back as a space.

Results: null and empty texts have no pieces; repeated rows each come out; a null id is kept;
an empty table gives no rows; further columns of the input are ignored.
"""

import re
from array import array
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from tillwise.llm.tables import sliced, table
from tillwise.llm.vocabulary import vocabulary_path

SPACE = "▁"  # fixed value: the vocabulary's sign for a space
UNKNOWN = 10.0
_PART = re.compile(f"\n+|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
_REMEMBERED, _SHORT = 150_000, 48


class Pieces:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i)
                                        or model.is_byte(i) or model.is_unused(i))]
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            piece = model.id_to_piece(i)
            self.automaton.add_word(piece, (i, len(piece), model.get_score(i)))
        self.automaton.make_automaton()
        self.unknown = min(model.get_score(i) for i in plain) - UNKNOWN
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = [b""] * len(ids)
        for i in plain:
            self.bytes[i] = model.id_to_piece(i).replace(SPACE, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([b])
        self.known: dict[str, bytes] = {}  # two generations
        self.before: dict[str, bytes] = {}
        self.unfaithful: set[str] = set()

    def _best(self, part: str) -> array:
        """Viterbi over one part, whose spaces are replaced."""
        n = len(part)
        best = array("d", [0.0]) + array("d", [-np.inf]) * n
        last_id, last_size = array("i", [-1]) * (n + 1), array("i", [1]) * (n + 1)
        unknown, at = self.unknown, 0  # positions up to ``at`` have their best score
        for end, (piece, size, score) in self.automaton.iter(part):
            end += 1
            while at < end:  # a character that no piece covers alone
                at += 1
                best[at] = best[at - 1] + unknown
            score += best[end - size]
            if score > best[end]:
                best[end], last_id[end], last_size[end] = score, piece, size
        ids, at = [], n
        while at > 0:
            if last_id[at] >= 0:
                ids.append(last_id[at])
            else:
                ids += [self.byte_ids[b] for b in reversed(
                    part[at - 1].encode("utf-8", "surrogatepass"))]
            at -= last_size[at]
        return array("i", reversed(ids))

    def _learn(self, parts: set[str]) -> dict[str, bytes]:
        """Ids of parts that are not known. Long ones are not remembered; they come back."""
        if len(self.known) > _REMEMBERED:
            self.known, self.before = {}, self.known
        long = {}
        for part in parts.difference(self.known):
            ids = self.before.get(part)
            if ids is None:
                ids = self._best(part).tobytes()
                if b"".join([self.bytes[i] for i in memoryview(ids).cast("i")]) != part.replace(
                        SPACE, " ").encode("utf-8", "surrogatepass"):
                    self.unfaithful.add(part)
            (self.known if len(part) <= _SHORT else long)[part] = ids
        return long

    def encoded(self, text: str | None) -> tuple[bytes, bool]:
        """The ids of a text as 32-bit numbers, and whether they decode to it. Decoding joins what the
        parts decode to, so each distinct part is decoded once, when it is learnt."""
        if not text:
            return b"", True
        parts = _PART.findall(SPACE + text.replace(" ", SPACE))
        distinct = set(parts)
        known = self.known
        if not distinct <= known.keys():
            long = self._learn(distinct)
            # a new generation may have begun, and long parts are in none
            known = {p: self.known.get(p) or long[p] for p in distinct} if (
                long or known is not self.known) else known
        faithful = not self.unfaithful or self.unfaithful.isdisjoint(distinct)
        return b"".join(map(known.__getitem__, parts)), faithful

    def encode(self, text: str | None) -> array:
        return array("i", self.encoded(text)[0])

    def decode(self, ids) -> str:
        data = b"".join(map(self.bytes.__getitem__, ids))
        return data[1:].decode("utf-8", "surrogatepass")


@cache
def pieces_of(path: str) -> Pieces:
    """One automaton per process."""
    return Pieces(path)


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = pieces_of(path)
    for batch in sliced(batches):
        ids, ends, back = bytearray(), [0], []
        for text in batch.column("text"):
            own, faithful = model.encoded(text.as_py())
            ids += own
            ends.append(len(ids) // 4)
            back.append(faithful)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(ends), pa.int64()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(
                 np.frombuffer(ids, np.int32))), pa.array(back, pa.bool_())],
            names=["doc_id", "n_pieces", "ids", "round_trip"])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_pieces, ids, round_trip) per row of ``docs`` (doc_id, text)."""
    return docs.select("doc_id", "text").mapInArrow(
        lambda b: _encode(b, path), "doc_id long, n_pieces long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) per row of ``encoded`` (doc_id, ids); null ids give an empty text."""
    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces_of(path)
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(
                    [model.decode(x.as_py() or []) for x in batch.column("ids")], pa.string())],
                names=["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(back, "doc_id long, text string")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), vocabulary_path())
