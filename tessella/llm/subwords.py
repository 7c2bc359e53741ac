"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model file is compiled into four machines, once per worker:

* the *normaliser*: one state with an arc for each character; a space gives the
  meta symbol, any other character itself, and one meta symbol comes first;
* the *pieces*: a trie whose arcs read characters, from the end of a piece to
  its beginning, and whose final arcs write the piece;
* the *bytes*: where no piece begins, an arc for a character that writes its
  bytes, at ``FALLBACK`` each;
* the *neighbours*: a state for each piece, and an arc from one to the next that
  costs ``PIECE``, or infinitely much.  The model is of the BPE kind, whose
  result is not the path of largest score but the segmentation in which no merge
  over a border would have come before those that made the pieces beside it.
  The arc between two pieces is infinite where there is such a merge.  It is
  found in their merge trees: a part at the right edge of one piece and a part
  at the left edge of the other make a piece that outranks what consumes them.

Their composition with an input is relaxed from left to right in the tropical
semiring (sums along a path, the least of all paths); a state is a place and
the piece written last.  The shortest path to the end is the encoding.
Characters that no piece joins are cut first.  The distinct pieces of white
space and word in a batch are searched once; a worker remembers them.
"""

from __future__ import annotations

import zlib
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame

from tessella.llm.common import SLICE_BYTES, claim_worker, map_slices
from tessella.llm.words import PieceTable, bytes_of, pieces_of

MODEL, META = "piece_bpe_32k.model", "▁"
#: Pieces and their ids that a worker remembers, neighbours, what lies between cuts (in each of two generations), bytes of a piece that is remembered.
CACHED, CACHED_IDS, NEIGHBOURS, GENERATION, LONG = 300_000, 2_000_000, 400_000, 120_000, 64
#: Weights of the arcs.
PIECE, FALLBACK, INFINITE = 1, 8, float("inf")
#: White space that is in no piece, but for the space itself.
_CONTROLS = "\t\n\v\f\r"


def _metas(data: np.ndarray) -> np.ndarray:
    """Where the input has the meta symbol itself: it may run on into the one of a following space."""
    return np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)) if len(data) > 2 else np.zeros(0, np.int64)


class Transducer:
    """The compiled machines of one model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or spec.precompiled_charsmap or not spec.escape_whitespaces or spec.remove_extra_whitespaces:
            raise ValueError("only BPE models with the identity normaliser are supported")
        self.prefix = " " if spec.add_dummy_prefix else ""
        self.normaliser = str.maketrans({" ": META})
        self.names = [p.piece for p in proto.pieces]
        self.pieces = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        self.score = {p.piece: p.score for p in proto.pieces if p.type == 1}
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == 6}
        self.trie: dict = {}
        for piece in self.pieces:
            node = self.trie
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = piece
        self.joined = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        self.parts = {p: self._last_merge(p) for p in self.pieces if len(p) > 1}
        self.edges: dict[tuple[str, int], list[tuple[str, float]]] = {}
        self.costs: dict[str, dict[str, float]] = {}
        self.n_costs = 0
        #: ids of what lies between two cuts, in two generations
        self.between: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        # pieces of text may be cut before white space that no piece of the model holds
        self.blank = np.zeros(256, bool)
        self.blank[[32, *(ord(c) for c in _CONTROLS if not any(c in p for p in self.joined))]] = True
        self.known = PieceTable(CACHED, CACHED_IDS, LONG)
        # what each id writes when decoded, end to end
        byte_of = {i: bytes([b]) for b, i in self.byte.items()}
        control = {i for i, p in enumerate(proto.pieces) if p.type in (2, 3)}
        written = [byte_of.get(i, b"" if i in control else n.replace(META, " ").encode()) for i, n in enumerate(self.names)]
        self.written_n = np.array([len(w) for w in written], np.int64)
        self.written_at = np.cumsum(self.written_n) - self.written_n
        self.written = np.frombuffer(b"".join(written), np.uint8)

    def _last_merge(self, piece: str) -> tuple[str, str]:
        """The two parts whose merge makes a piece; only used when the machines are compiled."""
        symbols = list(piece)
        while len(symbols) > 2:
            found = [(-s, i) for i in range(len(symbols) - 1) if (s := self.score.get(symbols[i] + symbols[i + 1])) is not None]
            if not found:
                raise ValueError(f"no merges make the piece {piece!r}")
            i = min(found)[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return tuple(symbols)

    def _edge(self, piece: str, side: int) -> list[tuple[str, float]]:
        """The parts at the left (0) or right (1) edge of a piece, each with the score of the merge that consumes it."""
        found = self.edges.get((piece, side))
        if found is None:
            found, part, consumed = [], piece, -np.inf
            while True:
                found.append((part, consumed))
                if part not in self.parts:
                    break
                part, consumed = self.parts[part][side], self.score[part]
            self.edges[piece, side] = found
        return found

    def neighbours(self, left: str, right: str) -> float:
        """The weight of the arc from one piece to the next.  Of merges of equal score the leftmost comes first."""
        score = self.score
        for x, x_consumed in self._edge(left, 1):
            for y, y_consumed in self._edge(right, 0):
                s = score.get(x + y)
                if s is not None and s > x_consumed and s >= y_consumed:
                    return INFINITE
        return PIECE

    def shortest_path(self, text: str) -> list[str]:
        """The pieces of the path of least weight through the composition with ``text``; characters without a piece stand for their bytes.

        A beginning of the text has one segmentation without infinite arcs, so
        of the arcs into a place one at most is finite, and the least weight is
        known where it is met.
        """
        costs, trie, end = self.costs, self.trie, len(text)
        # by place: the least weight so far, and the piece that ends there
        weight: list[float] = [0] + [INFINITE] * end
        last = [""] * (end + 1)
        for to in range(1, end + 1):
            node, at, arcs = trie, to, []
            while at:
                node = node.get(text[at - 1])
                if node is None:
                    break
                at -= 1
                if "" in node:
                    arcs.append(node[""])
            if not arcs or len(arcs[0]) != 1:
                arcs.insert(0, text[to - 1])
            for piece in reversed(arcs):
                at = to - len(piece)
                if weight[at] is INFINITE:
                    continue
                row = costs.get(before := last[at])
                if row is None:
                    row = costs[before] = {}
                cost = row.get(piece)
                if cost is None:
                    cost = row[piece] = (self.neighbours(before, piece) if before else PIECE) + (0 if piece in self.pieces else FALLBACK * len(piece.encode()))
                    if cost == INFINITE:
                        cost = row[piece] = INFINITE
                    self.n_costs += 1
                if cost is not INFINITE:
                    weight[to], last[to] = weight[at] + cost, piece
                    break
        if self.n_costs > NEIGHBOURS:
            costs.clear()
            self.n_costs = 0
        if weight[end] is INFINITE:
            raise ValueError("the machines have no path")
        path, at = [], end
        while at:
            path.append(last[at])
            at -= len(last[at])
        return path[::-1]

    def _ids(self, text: str) -> bytes:
        """The ids of a normalised text; what lies between two characters that no piece joins is searched by itself."""
        joined, known = self.joined, self.between
        cuts = [i for i, pair in enumerate(map(add, text, text[1:]), 1) if pair not in joined]
        out = []
        for begin, cut in zip([0, *cuts], [*cuts, len(text)], strict=True):
            part = text[begin:cut]
            ids = known.get(part)
            if ids is None:
                ids = self.before.get(part)
                if ids is None:
                    ids = np.array([i for p in self.shortest_path(part) for i in self._written_as(p)], "<u4").tobytes()
                if len(part) <= LONG:
                    if len(known) > GENERATION:
                        self.before, self.between = known, {}
                        known = self.between
                    known[part] = ids
            out.append(ids)
        return b"".join(out)

    def _written_as(self, piece: str) -> list[int]:
        i = self.pieces.get(piece)
        return [self.byte[b] for b in piece.encode()] if i is None else [i]

    def of_pieces(self, pieces: list[bytes]) -> list[bytes]:
        return [self._ids(p.decode().translate(self.normaliser)) for p in pieces]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's ids end; null and empty texts have none."""
        texts = pc.fill_null(texts, "")
        led = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(self.prefix, texts, ""))
        return self.known.take(*pieces_of(led, self.blank, _metas), self.of_pieces)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit bytes."""
        return self.encode_column(pa.array([text], pa.string()))[0].astype("<u4").tobytes()

    def decode_column(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the ids of all texts write, as bytes, and where each text ends: pieces read backwards through the machines."""
        n = self.written_n[ids]
        byte_ends = np.concatenate([[0], np.cumsum(n)])
        out = self.written[np.repeat(self.written_at[ids] - byte_ends[:-1], n) + np.arange(byte_ends[-1])]
        text_ends = byte_ends[ends]
        if self.prefix:
            begin = np.concatenate([[0], text_ends[:-1]])
            full = begin < text_ends
            drop = begin[full][out[begin[full]] == 32]
            keep = np.ones(len(out), bool)
            keep[drop] = False
            out, text_ends = out[keep], text_ends - np.searchsorted(drop, text_ends)
        return out, text_ends

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no text become the replacement character."""
        flat = np.frombuffer(ids, "<u4")
        return self.decode_column(flat, np.array([len(flat)]))[0].tobytes().decode("utf-8", "replace")


_machines: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    claim_worker("subwords", _machines.clear)
    if path not in _machines:
        _machines[path] = Transducer(path)
    return _machines[path]


def _split(values: np.ndarray, ends: np.ndarray) -> list[bytes]:
    data, width = memoryview(np.ascontiguousarray(values)).cast("B"), values.itemsize
    return [data[a * width : b * width] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def encode_pieces(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids`` (little-endian unsigned 32-bit) of each text; null text is empty and has no ids."""
    path = path or public_tokenizers.path(MODEL)
    return map_slices(docs.select("doc_id", "text"), lambda b: {"doc_id": b.column(0), "ids": list(map(bytes, _split(*transducer(path).encode_column(b.column(1)))))}, "doc_id long, ids binary")


def decode_pieces(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` of ids."""
    path = path or public_tokenizers.path(MODEL)
    return map_slices(encoded.select("doc_id", "ids"), lambda b: {"doc_id": b.column(0), "text": [transducer(path).decode(i) for i in b.column(1).to_pylist()]}, "doc_id long, text string", "ids")


def piece_round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_pieces, ids_crc32, decoded_equal`` of each row, in one narrow pass.

    ``decoded_equal`` tells whether decoding gives the text back; it does but
    for texts that hold the meta symbol itself, which decodes as a space.  Null
    text is empty (no pieces).  Repeated rows and null ids are rows of their
    own.  A text of any length is searched whole; what no piece of up to ``LONG``
    bytes holds is not remembered.  Other columns are ignored.  An empty table
    gives no rows.
    """
    path = path or public_tokenizers.path(MODEL)

    def run(batch: pa.RecordBatch) -> dict:
        machine = transducer(path)
        data, text_ends = bytes_of(batch.column(1))
        ids, ends = machine.encode_column(batch.column(1))
        back, back_ends = machine.decode_column(ids, ends)
        return {
            "doc_id": batch.column(0), "n_bytes": np.diff(text_ends, prepend=0), "n_pieces": np.diff(ends, prepend=0), "ids_crc32": [zlib.crc32(i) for i in _split(ids.astype("<u4"), ends)],
            "decoded_equal": [a == b for a, b in zip(_split(data, text_ends), _split(back, back_ends), strict=True)],
        }

    return map_slices(docs.select("doc_id", "text"), run, "doc_id long, n_bytes long, n_pieces long, ids_crc32 long, decoded_equal boolean", limit=2 * SLICE_BYTES)
