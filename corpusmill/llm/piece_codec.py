"""SentencePiece encoding and decoding of distinct marked words.

The text, with a space before it, is cut into marked words: spaces with the word after them, and single line ends.  No
piece reaches across such a cut, so the segmentation of a text is that of its marked words, and each task segments each
distinct one once.  A BPE model's scores are merge ranks: the adjacent pair with the best score is merged, the leftmost
of equals, until none is a piece (``merged_pieces``).  A unigram model's are log probabilities: the segmentation with the
greatest sum wins (``best_pieces``), over the sorted words as a trie: a word keeps the forward scores of the prefix it
shares with the word before.  A character without a piece becomes its UTF-8 bytes as byte pieces.

The model is read on the driver and broadcast (32,000 pieces, under 2 MB).  Decoding is lossless: the mark itself,
U+2581, has no piece here and goes by bytes, where ``SentencePieceProcessor.encode`` takes it for a space; all else is
encoded as there.  A task holds a run of rows of about ``CHUNK_BYTES`` of text (or one longer text, whole) and at most
``CACHE_BYTES`` of known words.  Defined cases: null text encodes to null ids, 0 tokens, and decodes to null; empty text
to no ids; texts of any length are encoded whole; repeated rows are encoded one by one; an empty table gives an empty
result; other columns are carried along; the output columns ``token_ids``, ``n_tokens``, ``decoded`` replace input columns
of those names.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusmill.llm.tables import lean

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_COST = 10.0
#: Bytes of distinct marked words, by estimate, that a task keeps before it drops all but those of the text at hand, and of text
#: that it encodes at a time.
CACHE_BYTES, CHUNK_BYTES = 48 << 20, 1 << 18
#: Estimate of what a known word takes besides its characters and ids.
WORD_BYTES = 240
_WORD = re.compile(r"\n| *[^ \n]+| +")
#: Characters up to which a word's best pair is found by looking through all.
SCAN_CHARS = 48
_NONE = float("-inf")


@dataclass(frozen=True)
class Pieces:
    """Text -> (id, score) of the ordinary pieces, the id of each byte's piece, the bytes of each id, and whether scores are merge ranks."""

    ordinary: dict[str, tuple[int, float]]
    byte_ids: tuple[int, ...]
    surface: tuple[bytes, ...]
    longest: int
    unknown_score: float
    merges: bool


def load_pieces(path: str = MODEL_PATH) -> Pieces:
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto.FromString(open(path, "rb").read()).trainer_spec
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary, byte_ids, surface = {}, [0] * 256, []
    for i in range(model.get_piece_size()):
        text = model.id_to_piece(i).replace("▁", " ")
        if model.is_byte(i):
            value = int(text[3:5], 16)
            byte_ids[value] = i
            surface.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            surface.append(b"")
        else:
            ordinary[text] = (i, model.get_score(i))
            surface.append(text.encode())
    scores = [s for _, s in ordinary.values()]
    return Pieces(ordinary, tuple(byte_ids), tuple(surface), max(map(len, ordinary)), min(scores) - UNKNOWN_COST, spec.model_type == spec.BPE)


def best_pieces(words: list[str], pieces: Pieces) -> Iterator[list[int]]:
    """The ids of each of the sorted ``words``."""
    get, longest, unknown = pieces.ordinary.get, pieces.longest, pieces.unknown_score
    before, score, back = "", [0.0], [(0, -1)]
    for word in words:
        shared, most = 0, min(len(before), len(word))
        while shared < most and before[shared] == word[shared]:
            shared += 1
        del score[shared + 1 :], back[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            best, via = score[end - 1] + unknown, (end - 1, -1)
            for start in range(max(0, end - longest), end):
                found = get(word[start:end])
                if found and score[start] + found[1] > best:
                    best, via = score[start] + found[1], (start, found[0])
            score.append(best)
            back.append(via)
        ids, at = [], len(word)
        while at:
            start, piece = back[at]
            ids += [piece] if piece >= 0 else [pieces.byte_ids[b] for b in reversed(word[start:at].encode("utf-8", "surrogatepass"))]
            at = start
        ids.reverse()
        yield ids
        before = word


def _scan(word: str, score: Callable[[str], float]) -> list[str]:
    parts = list(word)
    pair = [score(a + b) for a, b in zip(parts, parts[1:])]  # noqa: B905
    while pair:
        best = max(pair)
        if best == _NONE:
            break
        i = pair.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pair[i]
        if i:
            pair[i - 1] = score(parts[i - 1] + parts[i])
        if i < len(pair):
            pair[i] = score(parts[i] + parts[i + 1])
    return parts


def _queued(word: str, score: Callable[[str], float]) -> list[str]:
    """As ``_scan``, in n log n steps: a heap of pairs, of which those whose sides have changed since are passed over."""
    parts, n = list(word), len(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(-s, i, i + 1, 2) for i in range(n - 1) if (s := score(word[i : i + 2])) != _NONE]
    heapq.heapify(heap)
    while heap:
        _, i, j, size = heapq.heappop(heap)
        if not parts[i] or not parts[j] or len(parts[i]) + len(parts[j]) != size:
            continue
        parts[i] += parts[j]
        parts[j], k = "", after[j]
        after[i] = k
        if k < n:
            before[k] = i
        for a, b in ((before[i], i), (i, k)):
            if a >= 0 and b < n and (s := score(parts[a] + parts[b])) != _NONE:
                heapq.heappush(heap, (-s, a, b, len(parts[a]) + len(parts[b])))
    return [p for p in parts if p]


def merged_pieces(words: list[str], pieces: Pieces) -> Iterator[list[int]]:
    """The ids of each of the ``words`` by the model's merge order."""
    get, none = pieces.ordinary.get, (0, _NONE)
    score = lambda t: get(t, none)[1]
    for word in words:
        ids = []
        for p in (_scan if len(word) <= SCAN_CHARS else _queued)(word, score):
            found = pieces.ordinary.get(p)
            ids += [found[0]] if found else [pieces.byte_ids[b] for b in p.encode("utf-8", "surrogatepass")]
        yield ids


class Encoder:
    """Encodes runs of texts; keeps the segmentations of distinct marked words."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.held = 0

    def keep(self, words: list[str]) -> None:
        """Drops all known words but these; the frequent ones are in any run of text."""
        index = np.array([self.known[w] for w in words], np.int64)
        self.flat, self.sizes = self._ids(index), self.sizes[index]
        self.known = {w: i for i, w in enumerate(words)}
        self.held = len(words) * WORD_BYTES + sum(map(len, words)) + 4 * len(self.flat)

    def _ids(self, index: np.ndarray) -> np.ndarray:
        """The ids of known words, given by number, one after the other."""
        count = self.sizes[index]
        ends, begins = np.cumsum(count), np.cumsum(self.sizes) - self.sizes
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(begins[index] - (ends - count), count)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, end of each text in them)."""
        found = [_WORD.findall(" " + t) if t else [] for t in texts]
        distinct = {w for ws in found for w in ws}
        if self.held > CACHE_BYTES:
            self.keep([w for w in distinct if w in self.known])
        fresh = sorted(distinct.difference(self.known))
        if fresh:
            ids = list((merged_pieces if self.pieces.merges else best_pieces)(fresh, self.pieces))
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh)), strict=True))
            self.sizes = np.append(self.sizes, np.array([len(x) for x in ids], np.int64))
            self.flat = np.append(self.flat, np.array([i for x in ids for i in x], np.int32))
            self.held += len(fresh) * WORD_BYTES + sum(map(len, fresh)) + 4 * sum(map(len, ids))
        get = self.known.__getitem__
        index = np.array([get(w) for ws in found for w in ws], np.int64)
        if not len(index):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        ends = np.cumsum(self.sizes[index])
        return self._ids(index), np.concatenate([[0], ends])[np.cumsum([len(ws) for ws in found])]


def decode_ids(ids: np.ndarray, surface: tuple[bytes, ...]) -> str:
    """The text of ids; the space before the text is dropped again."""
    return b"".join([surface[i] for i in ids.tolist()])[1:].decode("utf-8", "replace")


def _runs(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about CHUNK_BYTES of text, at least one row each."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(upto):
        end = int(np.searchsorted(upto, (upto[first - 1] if first else 0) + CHUNK_BYTES, "right"))
        yield first, max(first + 1, end)
        first = max(first + 1, end)


def _encoded(model: Broadcast, column: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.value)
        for batch in batches:
            for a, b in _runs(batch.column(column)):
                part = batch.slice(a, b - a)
                texts = part.column(column).to_pylist()
                ids, ends = encoder.encode([t or "" for t in texts])
                null = np.array([t is None for t in texts])
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32), mask=np.append(null, False))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids))
                names = [n for n in part.schema.names if n not in ("token_ids", "n_tokens")]
                sizes = np.diff(np.concatenate([[0], ends]))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(sizes), lists], [*names, "n_tokens", "token_ids"])

    return run


def _decoded(model: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surface = model.value.surface
        for batch in batches:
            lists = batch.column("token_ids")
            texts = [decode_ids(x.values.to_numpy(zero_copy_only=False), surface) if x.is_valid else None for x in lists]
            names = [n for n in batch.schema.names if n != "decoded"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts, pa.string())], [*names, "decoded"])

    return run


def _schema(df: DataFrame, drop: tuple[str, ...], add: list[T.StructField]) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name not in drop] + add)


_IDS = [T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.ArrayType(T.IntegerType()))]


def _model(df: DataFrame, path: str) -> Broadcast:
    return df.sparkSession.sparkContext.broadcast(load_pieces(path))


def encoded(docs: DataFrame, column: str = "text", path: str = MODEL_PATH) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``token_ids``."""
    return docs.mapInArrow(lean(_encoded(_model(docs, path), column)), _schema(docs, ("n_tokens", "token_ids"), _IDS))


def decoded(rows: DataFrame, path: str = MODEL_PATH) -> DataFrame:
    """``rows`` (with ``token_ids``) with ``decoded``."""
    return rows.mapInArrow(lean(_decoded(_model(rows, path))), _schema(rows, ("decoded",), [T.StructField("decoded", T.StringType())]))


def round_trip(docs: DataFrame, column: str = "text", path: str = MODEL_PATH) -> DataFrame:
    """``encoded`` and ``decoded`` in one pass of each task: adds ``n_tokens``, ``token_ids`` and ``decoded``."""
    model = _model(docs, path)
    encode, decode = _encoded(model, column), _decoded(model)
    add = [*_IDS, T.StructField("decoded", T.StringType())]
    return docs.mapInArrow(lean(lambda batches: decode(encode(batches))), _schema(docs, ("n_tokens", "token_ids", "decoded"), add))
